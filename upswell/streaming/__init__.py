"""Structured Streaming forms of the two incremental jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from upswell.operators.merge import merge_into
from upswell.operators.tables import batch_done, current_version, read_current, upsert_by_key, write_version
from upswell.sources.feeds import filter_relevant_news

#: Spark's local property that names the streaming query a job belongs to; it outlives restarts from one checkpoint folder.
QUERY_ID = "sql.streaming.queryId"
EVENT_KEY = ["company_id", "source_url", "event_type"]


def stream_news(source: DataFrame, keep_days: int | None = None) -> DataFrame:
    """Relevant headlines, one per link, in whatever order they come.

    State is one key per link, for ever. With ``keep_days`` a key is dropped once the watermark has passed it, and a
    headline that comes more than so many days behind the latest one is dropped too.
    """
    linked = filter_relevant_news(source).filter(F.coalesce("link", F.lit("")) != "")
    if keep_days is None:
        return linked.dropDuplicates(["link"])
    return linked.withWatermark("fetched_at", f"{int(keep_days)} days").dropDuplicatesWithinWatermark(["link"])


def upsert_batch(root: str, keys: list[str] | None = None):
    """``foreachBatch`` function merging a micro-batch into the versioned table at ``root``.

    The log of versions names the streaming query and its batch, so a batch that is sent again after a
    failure changes nothing, while a query with a new checkpoint folder, which counts from 0 again, goes on.
    Outside a streaming query the batch number is the version number. A stored row with a larger
    ``ingest_ord`` than the batch's stays, so the table does not depend on how rows are cut into batches.
    """
    key = keys or EVENT_KEY

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version, stream = current_version(spark, root), spark.sparkContext.getLocalProperty(QUERY_ID)
        if batch_done(spark, root, stream, batch_id) if stream else version is not None and version >= batch_id:
            return
        target = read_current(spark, root)
        if target is None:
            target = batch.limit(0)
        following = 0 if version is None else version + 1
        write_version(upsert_by_key(target, batch, key, [F.col("ingest_ord").desc()], newest="ingest_ord"), root, following if stream else batch_id, stream=stream, batch=batch_id)

    return merge


def stream_event_upserts(source: DataFrame, root: str, checkpoint: str, buckets: int = 16) -> DataStreamWriter:
    """Writer that merges events by (company, source URL, type); call ``start`` on it.

    A micro-batch rewrites only the buckets of companies it holds. The row with the largest ``ingest_ord`` stays, so a batch that is sent
    again, other cuts into batches and a new checkpoint folder all give the same table.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_into(batch, root, EVENT_KEY, [F.col("ingest_ord").desc()], by=["company_id"], buckets=buckets, newest="ingest_ord")

    return source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)

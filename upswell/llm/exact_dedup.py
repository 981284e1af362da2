"""Exact duplicates against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest. A batch of documents is reduced
to one row per digest (combined before the shuffle, so a text that makes up a third of all
rows costs one row per task), anti-joined with the index by sort-merge on the bucketing, and
what is new is appended. The index side of that join is never shuffled again; each append adds a sorted file to a bucket,
and a bucket of several files is sorted when it is read.

Cases: a null text counts as empty; texts of white space alone are equal to the empty text;
rows that agree in doc_id and length are ordered by their place in the table; an empty batch appends nothing;
further columns of the input are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from upswell.llm.common import new_folder, rows_of, squeezed, store, text_key

ENTRY = "digest binary, keep_id long, keep_row long, n_chars long, group_size long, batch string"


def digest_rows(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, row (a number of its own), digest (SHA-256 of the text without white space), n_chars and ``more``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
        F.unhex(F.sha2(squeezed(text), 256)).alias("digest"), F.length(text).cast("long").alias("n_chars"), *more,
    )


class DigestIndex:
    """A persistent index of text digests."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        """``path``: a shared folder; a new one under the checkpoint folder if not given.
        ``buckets``: about one per 100 MB of index; as many as the session shuffles by default."""
        self.spark = spark
        self.path = path or new_folder(spark, "digest-index")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex}"
        # the layout is declared, so that an index written by an earlier session is found again
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({ENTRY}) USING parquet LOCATION '{self.path}' "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS"
        )

    def entries(self) -> DataFrame:
        return self.spark.table(self.table)

    def batches(self) -> DataFrame:
        return self.entries().select("batch").distinct()

    def add(self, rows: DataFrame, batch: str) -> DataFrame:
        """Append the digests of a batch (``digest_rows``) that the index lacks; returns the batch's rows with
        keep_id, keep_row, group_size (rows of the batch with this digest) and kept.

        Within the batch the row with most characters stays, then the smallest doc_id. A digest
        that an earlier batch brought keeps that batch's row, and no row of this batch stays.
        A batch that is added again after a failure appends nothing that is there already.
        """
        best = F.struct((-F.col("n_chars")).alias("short"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
        groups = rows.groupBy("digest").agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("group_size"))
        groups = store(
            groups.select("digest", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), (-F.col("best.short")).alias("n_chars"), "group_size"),
            "digest-groups",
        )
        known = self.entries()
        new = groups.join(known.hint("merge"), "digest", "left_anti").withColumn("batch", F.lit(batch))
        new.select("digest", "keep_id", "keep_row", "n_chars", "group_size", "batch").write.bucketBy(self.buckets, "digest").sortBy("digest").mode(
            "append"
        ).format("parquet").saveAsTable(self.table)
        self.spark.catalog.refreshTable(self.table)
        held = self.entries().select("digest", "keep_id", "keep_row", "batch")
        # stored without its bucketing: both sides of the next join are then shuffled, and a hot digest can be split
        sized = store(held.join(groups.select("digest", "group_size").hint("merge"), "digest"), "digest-held")
        out = rows.join(sized, "digest")
        kept = (F.col("batch") == batch) & (F.col("row") == F.col("keep_row"))
        return out.select("doc_id", "row", "digest", "n_chars", "keep_id", "keep_row", "group_size", kept.alias("kept"))


def dedupe(docs: DataFrame, index: DigestIndex | None = None, batch: str = "0") -> DataFrame:
    """One row per document of the batch: which row of its text stays, here or in an earlier batch."""
    rows = store(digest_rows(docs), "digests")
    return (index or DigestIndex(docs.sparkSession)).add(rows, batch)


def kept_rows(docs: DataFrame, index: DigestIndex | None = None, batch: str = "0") -> DataFrame:
    """The rows of a batch that stay, with all their columns."""
    texts = docs.select("doc_id", "text")
    stays = store(digest_rows(texts, text_key(F.col("text")).alias("k_text")), "digests")
    found = (index or DigestIndex(docs.sparkSession)).add(stays.drop("k_text"), batch)
    named = stays.join(found.filter("kept").select("row"), "row", "left_semi")
    return rows_of(docs, named.select(F.col("doc_id").alias("k_id"), "k_text"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table as one batch into a new index."""
    found = dedupe(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP7_SQL = r"""
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM (
  SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
    first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY length(coalesce(text, '')) DESC, doc_id) AS keep_id
  FROM (SELECT doc_id, text, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents))
"""

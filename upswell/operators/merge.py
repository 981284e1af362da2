"""Stored tables that are merged in place: hash buckets as a partition column, and only the buckets a batch touches rewritten.

A merge reads the touched buckets (partition pruning), merges, stores the result beside the table, notes that it is complete, and then lets
Spark overwrite exactly those partitions. A merge that is lost half-way is finished by the next one from what is stored beside the
table, before it reads anything. Merging the same batch again gives the same table.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from upswell.operators.tables import read_if_there, upsert_by_key

BUCKET = "_bucket"
#: Notes of a table's merges: a complete copy beside the table (done false), then the finished overwrite (done true).
NOTE = "seq long, done boolean, buckets int, kind string"


def _last_note(spark: SparkSession, root: str) -> Row | None:
    notes = read_if_there(spark, f"{root}/merges", NOTE)
    return None if notes is None else notes.orderBy(F.desc("seq"), F.desc("done")).limit(1).first()


def _note(spark: SparkSession, root: str, seq: int, done: bool, buckets: int, kind: str) -> None:
    row = spark.range(1).select(F.lit(seq).cast("long").alias("seq"), F.lit(done).alias("done"), F.lit(buckets).alias("buckets"), F.lit(kind).alias("kind"))
    row.coalesce(1).write.mode("append").parquet(f"{root}/merges")


def _with_bucket(df: DataFrame, by: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int"))


def _touched(rows: DataFrame, by: Sequence[str], buckets: int) -> list[int]:
    """At most ``buckets`` numbers."""
    return sorted(r[0] for r in _with_bucket(rows.select(*by), by, buckets).select(BUCKET).distinct().collect())


def _overwrite(rows: DataFrame, root: str) -> None:
    """Replace the partitions that ``rows`` has, and no other."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(f"{root}/table")


def _finish(spark: SparkSession, root: str) -> Row | None:
    """Apply what a lost merge has left beside the table; the latest note."""
    last = _last_note(spark, root)
    if last is not None and not last.done:
        kind = StructType.fromJson(json.loads(last.kind))
        _overwrite(spark.read.schema(kind).parquet(f"{root}/pending"), root)
        _note(spark, root, last.seq, True, last.buckets, last.kind)
    return last


def _table(spark: SparkSession, root: str, note: Row, buckets: Sequence[int] | None = None) -> DataFrame:
    rows = spark.read.schema(StructType.fromJson(json.loads(note.kind))).parquet(f"{root}/table")
    return (rows if buckets is None else rows.filter(F.col(BUCKET).isin(list(buckets)))).drop(BUCKET)


def read_merged(spark: SparkSession, root: str, of: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame | None:
    """The table, or only the buckets that rows of ``of`` (by the columns the buckets are made of) fall into; None where nothing is stored."""
    note = _finish(spark, root)
    if note is None:
        return None
    return _table(spark, root, note, None if of is None else _touched(of, by, note.buckets))


def merge_into(
    batch: DataFrame, root: str, keys: Sequence[str], order: Sequence[Column] | None = None, by: Sequence[str] = (), buckets: int = 64,
    keep: Sequence[str] = (), newest: str | None = None,
) -> None:
    """Insert or merge ``batch`` by ``keys`` into the table at ``root``. ``order``, ``keep`` and ``newest`` are those of ``upsert_by_key``.

    Buckets are numbered by a hash of ``by`` (some of the keys; all by default). Their number is fixed by the first merge: choose it
    so that a bucket is what one task can rewrite.
    """
    spark, by = batch.sparkSession, list(by or keys)
    last = _finish(spark, root)
    buckets = buckets if last is None else last.buckets
    touched = _touched(batch, by, buckets)
    if not touched:
        return
    stored = batch.limit(0) if last is None else _table(spark, root, last, touched)
    merged = _with_bucket(upsert_by_key(stored, batch, keys, order, keep, newest), by, buckets)
    # a partition column comes last when it is read back
    merged.repartition(F.col(BUCKET)).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(f"{root}/pending")
    seq, kind = 0 if last is None else last.seq + 1, merged.schema.json()
    _note(spark, root, seq, False, buckets, kind)
    _overwrite(spark.read.schema(merged.schema).parquet(f"{root}/pending"), root)
    _note(spark, root, seq, True, buckets, kind)

"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from upswell.session import shared_folder

#: The six white-space characters of the contracts: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Deletes the shuffle files of a query when it ends, instead of after a garbage collection of the driver.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors share."""
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write once as Parquet in the shared folder and read back: lineage is cut there, and
    an executor lost later costs no recomputation. The shuffles of that write end with it: nothing reads them again."""
    spark = df.sparkSession
    path, before = new_folder(spark, name), spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def squeezed(text: Column) -> Column:
    """The text without white space."""
    return F.translate(text, SPACES, "")


def n_words(text: Column) -> Column:
    """Number of maximal runs of other characters than white space; 0 for null."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "w")
    return F.length(F.translate(marked, SPACES, "")).cast("long")


def rows_of(docs: DataFrame, keepers: DataFrame) -> DataFrame:
    """The rows of ``docs`` named by ``keepers`` (columns k_id, k_text = ``text_key``), each named row once.

    Rows that agree in id and text are one document here: one of them is returned. Null ids
    match null ids. All columns of ``docs`` are returned, whatever their names.
    """
    names = docs.columns
    wide = docs.select(F.struct(*[docs[f"`{c}`"] for c in names]).alias("row"), *row_key(docs["doc_id"], text_key(docs["text"])))
    kept = wide.join(keepers.select(*row_key(F.col("k_id"), F.col("k_text"))), KEY, "left_semi").dropDuplicates(KEY)
    return kept.select(*[F.col("row")[c].alias(c) for c in names])


KEY = ["key_none", "key_id", "key_text"]


def row_key(doc_id: Column, key: Column) -> list[Column]:
    """A document's id, null or not, and its ``text_key`` as the columns ``KEY``, never null: joins and duplicates by them share one shuffle."""
    return [doc_id.isNull().alias(KEY[0]), F.coalesce(doc_id, F.lit(0)).cast("long").alias(KEY[1]), key.alias(KEY[2])]


def text_key(text: Column) -> Column:
    """64-bit key of a text, with null unlike the empty text; used only together with doc_id."""
    return F.xxhash64(text.isNull(), text)

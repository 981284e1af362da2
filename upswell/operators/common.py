"""Shared building blocks: keep-first, batch numbering, running counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upswell.session import stored


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key. Each task drops all but its own first row per key before
    the shuffle (group-limit window), so one hot key costs one row per task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).filter("_nth = 1").drop("_nth")


def spread_nulls(key: Column, row_id: Column) -> Column:
    """Join key whose NULLs are spread over all partitions instead of one.

    A NULL never matches in an equi-join; here it becomes a value that cannot
    occur, different for each row.
    """
    return F.coalesce(key, F.concat(F.lit("\u0000"), row_id.cast("string")))


def with_row_index(df: DataFrame, order: Sequence[Column], name: str = "row_index") -> DataFrame:
    """Gap-free 0-based index in a global order, without one task seeing all rows.

    Only the order's own columns are sorted and stored; the rows, whatever they carry, are joined to them once. Rows that are equal in
    the order follow one another in any order.
    """
    keys = [f"_k{i}" for i in range(len(order))]
    keyed = df.withColumns(dict(zip(keys, order)))
    counts = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    places = running_totals(counts, [], keys, "_n").select(*[F.col(k).alias(f"_of{k}") for k in keys], (F.col("_upto") - F.col("_n")).alias("_first"), F.col("_n").alias("_many"))
    rows = keyed.join(places, [F.col(k).eqNullSafe(F.col(f"_of{k}")) for k in keys])
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    index = F.when(F.col("_many") == 1, F.col("_first")).otherwise(F.col("_first") + nth - 1)
    return rows.withColumn(name, index).select(*df.columns, name)


def running_totals(df: DataFrame, group: Sequence[str], order: Sequence[str], weight: str) -> DataFrame:
    """Adds ``_upto`` (sum of ``weight`` in the group up to the row, by ``order``) and ``_total`` (of the group). Rows are unique by group and order.

    A group may hold a third of all rows, so no task sorts a whole one: rows are range-partitioned by group and order and stored once, sums
    run within a partition, and the totals of a group's earlier partitions (a frame of one row per group and partition) are added.
    """
    group, order = list(group), list(order)
    cut = stored(df.repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id()))
    totals = cut.groupBy(*group, "_part").agg(F.sum(weight).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"_of_{c}") for c in group], F.col("_part").alias("_of_part"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy(*group)).alias("_total"),
    )
    within = Window.partitionBy(*group, "_part").orderBy(*order)
    summed = cut.withColumn("_upto", F.sum(weight).over(within))
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in group] + [F.col("_part") == F.col("_of_part")]
    joined = summed.join(offsets, same).withColumn("_upto", F.col("_before") + F.col("_upto"))
    return joined.select(*df.columns, "_upto", "_total")


def cohort_ranks(df: DataFrame, cohort: Sequence[str], value: str) -> DataFrame:
    """Per distinct (cohort, value): rows equal to it, rows at or below it, cohort size. Equal values are counted before anything is sorted."""
    counts = df.groupBy(*cohort, value).agg(F.count(F.lit(1)).alias("n_equal"))
    return running_totals(counts, cohort, [value], "n_equal").withColumnsRenamed({"_upto": "n_at_or_below", "_total": "n_cohort"})

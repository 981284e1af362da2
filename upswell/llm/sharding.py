"""Shards of near-equal bytes by sampled splitters.

Rows are laid out along a key (doc_id, then a hash of the text, then size). A size-weighted sample
of keys gives splitters at its quantiles, which cut the key line into ranges; the bytes and rows
of every range are then counted exactly, and ranges with too many of either are subdivided by
samples of their own. The ranges' totals give each range its exact offset, and rows within a
range are ordered by key, so a row's place on the line of all bytes is exact: a shard is an equal part of that line
and its bytes differ from the mean by less than one document, whatever the sample was.

A row of more bytes than a range should have is a range of its own from the start.

Splitters are searched in two steps of about the square root of their number. No range is
larger than about ``range_rows`` rows unless its rows share one key; rows with one doc_id are told apart by the
hash and size, and identical rows by a salt, so a key that holds a third of all rows is cut too.

Cases: a null text has size 1 and the checksum of no bytes; null ids come first; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from upswell.llm.common import store

SAMPLES_PER_RANGE = 48
#: A range is overfull beyond this many times the bytes or rows it should have.
OVERFULL = 2.0
ROUNDS = 6


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the sort key of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = rows.withColumn("salt", F.monotonically_increasing_id())
    return store(rows, "shard-sizes")


def _key() -> Column:
    return F.struct(F.coalesce(F.col("doc_id"), F.lit(-(2**63))).alias("doc_id"), F.col("text_crc32"), F.col("size"), F.col("salt"))


def _draw(rows: DataFrame, rate: Column | float) -> DataFrame:
    """Keys drawn with probability size * rate; a row for which that is above 1 counts as that many."""
    chance = F.col("size") * rate
    u = (F.xxhash64("doc_id", "salt", F.lit(17)) % 1000003 + 1000003) % 1000003 / F.lit(1000003.0)
    return rows.filter(u < chance).withColumn("weight", F.greatest(F.lit(1.0), chance))


def _quantiles(sample: DataFrame, parts: int, by: list[str]) -> DataFrame:
    """The keys at which the running weight of a sample passes a multiple of total / parts, for each ``by`` on its own."""
    line = Window.partitionBy(*by).orderBy("key")
    all_of = Window.partitionBy(*by)
    step = F.sum("weight").over(all_of) / parts
    sample = sample.withColumn("upto", F.sum("weight").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("step", step)
    cell = F.floor(F.col("upto") / F.col("step"))
    return sample.withColumn("cell", cell).filter(cell > F.floor((F.col("upto") - F.col("weight")) / F.col("step"))).filter(F.col("cell") < parts).select("key")


def _range_of(splitters: list, key: Column) -> Column:
    """Number of splitters that are not above the key, found in two steps."""
    if not splitters:
        return F.lit(0)
    lit = [F.struct(*[F.lit(v).cast("long").alias(n) for n, v in zip(("doc_id", "text_crc32", "size", "salt"), s)]) for s in splitters]
    width = max(1, int(len(lit) ** 0.5))
    blocks = [lit[i : i + width] for i in range(0, len(lit), width)]

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda s: s <= key))

    heads = F.array(*[b[0] for b in blocks])
    block = below(heads)
    inside = F.element_at(F.array(*[F.array(*b) for b in blocks]), block)
    return F.when(block == 0, 0).otherwise((block - 1) * width + below(inside))


def _counted(keyed: DataFrame, points: list) -> tuple[DataFrame, DataFrame]:
    """Rows with their range, and the exact rows and bytes of every range of these points."""
    ranged = keyed.withColumn("range", _range_of(points, F.col("key")))
    return ranged, store(ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")), "shard-ranges")


def splitters_for(rows: DataFrame, ranges: int) -> tuple[list, DataFrame]:
    """Sampled splitters, subdivided until no range is overfull, and the exact rows and bytes of every range.

    The driver holds the splitters and one row per range, never keys of a range.
    """
    total = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    n, size = total[0] or 0, total[1] or 0
    if n == 0:
        return [], rows.limit(0).select(F.lit(0).alias("range"), F.lit(0).alias("n"), F.lit(0).alias("bytes"))
    keyed = rows.withColumn("key", _key())
    first = _draw(keyed, SAMPLES_PER_RANGE * ranges / size)
    points = {tuple(r.key) for r in _quantiles(first, ranges, []).collect()}
    # fewer than ``ranges`` rows are that long; salts are distinct, so the key with the next salt ends such a row's range
    for r in keyed.filter(F.col("size") > size / ranges).select("key").collect():
        points |= {tuple(r.key), (*r.key[:-1], r.key[-1] + 1)}
    points = sorted(points)
    ranged, counts = _counted(keyed, points)
    for _ in range(ROUNDS):
        full = counts.filter(((F.col("n") > OVERFULL * n / ranges) | (F.col("bytes") > OVERFULL * size / ranges)) & (F.col("n") > 1))
        found = {r.range: r for r in full.withColumn("parts", F.ceil(F.greatest(F.col("n") * ranges / n, F.col("bytes") * ranges / size))).collect()}
        if not found:
            break
        # samples of the overfull ranges alone: as many by rows as by bytes, since either may be what is too much
        by_rows, by_bytes = (
            F.element_at(F.create_map(*[F.lit(x) for k, r in found.items() for x in (k, SAMPLES_PER_RANGE * r.parts / r[of])]), F.col("range")) for of in ("n", "bytes")
        )
        inside = ranged.filter(F.col("range").isin(list(found)))
        u = (F.xxhash64("doc_id", "salt", F.lit(29)) % 1000003 + 1000003) % 1000003 / F.lit(1000003.0)
        chance = by_rows + by_bytes * F.col("size")
        drawn = inside.filter(u < chance).withColumn("weight", F.greatest(F.lit(1.0), chance))
        more = {tuple(r.key) for r in _quantiles(drawn, 2 * max(r.parts for r in found.values()), ["range"]).collect()}
        if not more - set(points):
            break
        points = sorted({*points, *more})
        ranged, counts = _counted(keyed, points)
    return points, counts


def shard(rows: DataFrame, shards: int = 16, range_rows: int = 1_000_000) -> DataFrame:
    """Adds shard and slot to ``measured`` rows."""
    n = rows.count()
    points, counts = splitters_for(rows, max(8 * shards, -(-n // range_rows)))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    offsets = counts.select("range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"), F.sum("bytes").over(whole).alias("bytes_all"))
    offsets = store(offsets, "shard-offsets")
    keyed = rows.withColumn("key", _key()).withColumn("range", _range_of(points, F.col("key")))
    inside = Window.partitionBy("range").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = keyed.withColumn("upto", F.sum("size").over(inside)).join(offsets, "range")
    middle = (F.col("bytes_before") + F.col("upto")) * 2 - F.col("size")
    shard_no = F.least(F.lit(shards - 1), F.floor(middle * shards / (F.col("bytes_all") * 2))).cast("int")
    placed = store(placed.withColumn("shard", shard_no).select("doc_id", "size", "text_crc32", "salt", "range", "shard"), "shard-places")
    # ranks: rows of the shard in earlier ranges, then the order within the range
    per = placed.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n"))
    per = per.withColumn("first", F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    own = F.row_number().over(Window.partitionBy("shard", "range").orderBy(_key())) - 1
    return placed.withColumn("own", own).join(per.select("shard", "range", "first"), ["shard", "range"]).withColumn("slot", F.col("first") + F.col("own")).drop("own", "first")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(measured(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

"""Interval algebra: islands, coverage, overlaps and block segmentation, as sorted sweeps.

What a sweep carries along (the furthest end, the depth) is a prefix maximum or sum. Rows are cut into
ranges of the order, also inside a key; each range is swept by itself, and what the ranges before it
add up to is carried in. So a key of any size is swept by as many tasks as there are ranges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transpark.plans.storage import materialise

PIECE = "piece_"


def in_pieces(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """df dealt to ranges of (keys, order), with the range in PIECE. It is checkpointed, so that all
    that is computed of it sees the same ranges. Rows of equal keys and order share a range."""
    spark = df.sparkSession
    ranges = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return materialise(df.repartitionByRange(ranges, *keys, *order).withColumn(PIECE, F.spark_partition_id()))


def prefix(df: DataFrame, keys: list[str], order: list[str], how, value: Column, name: str, own: bool = True) -> DataFrame:
    """df (of ``in_pieces``, by the same order) with ``name``: F.max or F.sum of a value over the rows
    of the key so far, with or without the row itself; null before the first row.

    A range has one key at most that began in an earlier range, so there are fewer totals to carry
    in than ranges; only these are broadcast. Rows that aren't in pieces are swept a key a task.
    """
    if PIECE not in df.columns:
        return df.withColumn(name, how(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if own else -1)))
    total, carried = f"{name}_total", f"{name}_carried"
    totals = df.groupBy(*keys, PIECE).agg(how(value).alias(total), F.count("*").alias("n_"))
    before = Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*[F.col(k).alias(f"{k}_k") for k in keys], F.col(PIECE).alias("p_"), how(total).over(before).alias(carried)).where(F.col(carried).isNotNull())
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"{k}_k")) for k in keys], F.col(PIECE) == F.col("p_"))
    here = Window.partitionBy(*keys, PIECE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    swept = df.withColumn(name, how(value).over(here)).join(F.broadcast(carry), same, "left")
    both = F.greatest(name, carried) if how is F.max else F.when(F.col(name).isNull() & F.col(carried).isNull(), None).otherwise(F.coalesce(name, F.lit(0)) + F.coalesce(carried, F.lit(0)))
    return swept.withColumn(name, both).drop(*[f"{k}_k" for k in keys], "p_", carried)


def islands(df: DataFrame, keys: list[str], start: str, end: str, slack: int = 0, spread: bool = True) -> DataFrame:
    """df with ``island``: a new one starts where ``start`` is beyond all earlier ends plus slack.

    Touching intervals share an island, adjacent ones (end + 1 = start) don't unless slack is 1.
    Islands of a key are numbered from 1, by place. Where the data model bounds the rows of a key,
    ``spread`` = False saves the ranges: a key is then one task's.
    """
    swept = prefix(in_pieces(df, keys, start, end) if spread else df, keys, [start, end], F.max, F.col(end), "reach_", own=False)
    fresh = F.when(F.col("reach_").isNull() | (F.col(start) > F.col("reach_") + slack), 1).otherwise(0)
    marked = swept.withColumn("fresh_", fresh)
    return prefix(marked, keys, [start, end], F.sum, F.col("fresh_"), "island").drop("reach_", "fresh_", PIECE)


def merge_intervals(df: DataFrame, keys: list[str], start: str = "start", end: str = "end", slack: int = 0) -> DataFrame:
    """The union of intervals per key: keys, start, end."""
    return islands(df, keys, start, end, slack).groupBy(*keys, "island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("island")


def covered_length(df: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Bases that the intervals of a key cover, ends included."""
    return merge_intervals(df, keys, start, end).groupBy(*keys).agg(F.sum(F.col(end) - F.col(start) + 1).alias("covered"))


def depth_runs(df: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Runs [start, end) of equal depth of half-open intervals, depth 0 left out: a sweep over ends."""
    events = df.where(F.col(start) < F.col(end)).select(*keys, F.explode(F.array(F.struct(F.col(start).alias("at"), F.lit(1).alias("step")), F.struct(F.col(end).alias("at"), F.lit(-1).alias("step")))).alias("e"))
    steps = events.groupBy(*keys, F.col("e.at").alias("at")).agg(F.sum("e.step").alias("step"))
    pieces = in_pieces(steps, keys, "at")
    depths = prefix(pieces, keys, ["at"], F.sum, F.col("step"), "depth")
    # A run ends at the next place; that of a range's last row is the first of the next range.
    here = Window.partitionBy(*keys, PIECE).orderBy("at")
    firsts = pieces.groupBy(*keys, PIECE).agg(F.min("at").alias("first_"))
    nexts = firsts.withColumn("next_", F.lead("first_").over(Window.partitionBy(*keys).orderBy(PIECE))).where("next_ is not null")
    nexts = nexts.select(*[F.col(k).alias(f"{k}_k") for k in keys], F.col(PIECE).alias("p_"), "next_")
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"{k}_k")) for k in keys], F.col(PIECE) == F.col("p_"))
    swept = depths.withColumn("until", F.lead("at").over(here)).join(F.broadcast(nexts), same, "left")
    return swept.where("depth > 0").select(*keys, F.col("at").alias("start"), F.coalesce("until", "next_").alias("end"), "depth")


def without_overlap(left: DataFrame, right: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Rows of left that overlap no interval of right (ends included): a sorted sweep, no pairs.

    The right side is merged first; of disjoint intervals only the last one that starts at or
    before a row's end can reach the row's start.
    """
    lanes = merge_intervals(right.select(*keys, start, end), keys, start, end)
    rows = left.select(*keys, F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("row"), F.col(end).alias("at"), F.lit(1).alias("turn"), F.lit(None).cast("long").alias("reach"))
    marks = lanes.select(*keys, F.lit(None).cast(rows.schema["row"].dataType).alias("row"), F.col(start).alias("at"), F.lit(0).alias("turn"), F.col(end).cast("long").alias("reach"))
    # Merged lanes are disjoint, so the last one's end is the furthest.
    pieces = in_pieces(rows.unionByName(marks), keys, "at", "turn")
    swept = prefix(pieces, keys, ["at", "turn"], F.max, F.col("reach"), "last").where("turn = 1")
    return swept.where(F.col("last").isNull() | (F.col("last") < F.col(f"row.{start}"))).select("row.*")


def merge_blocks(blocks: DataFrame, keys: list[str], gap: int = 50) -> DataFrame:
    """Blocks of a key merged where q_start is at most ``gap`` past the ends so far.

    The first block gives r_start, q_start and read_len; ends are the largest.
    """
    marked = islands(blocks, keys, "q_start", "q_end", gap)
    first = lambda c: F.min(F.struct("q_start", "q_end", c))[c].alias(c)
    return marked.groupBy(*keys, "island").agg(first("r_start"), F.max("r_end").alias("r_end"), F.min("q_start").alias("q_start"), F.max("q_end").alias("q_end"), first("read_len")).drop("island")


def segment_pairs(pairs: DataFrame, keys: list[str], order: str = "ord", tolerance: int = 5, least: int = 1) -> DataFrame:
    """Aligned pairs (q, r) cut into blocks where q or r moves by more than the tolerance."""
    by = Window.partitionBy(*keys).orderBy(order)
    jump = (F.abs(F.col("q") - F.lag("q").over(by)) > tolerance) | (F.abs(F.col("r") - F.lag("r").over(by)) > tolerance)
    marked = pairs.withColumn("fresh", F.when(F.coalesce(jump, F.lit(False)), 1).otherwise(0)).withColumn("block", F.sum("fresh").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    ends = lambda c, f, name: f(c, order).alias(name)
    out = marked.groupBy(*keys, "block").agg(ends("r", F.min_by, "r_start"), ends("r", F.max_by, "r_end"), ends("q", F.min_by, "q_start"), ends("q", F.max_by, "q_end"))
    return out.where(F.col("r_end") - F.col("r_start") + 1 >= least)


def greedy_filter(features: DataFrame, keys: list[str], order: list[str], ratio: float = 0.8) -> DataFrame:
    """Features kept in order unless they overlap a kept one by more than ``ratio``.

    The fold runs inside one key's array; keys should be bounded (features of one contig).
    """
    item = F.struct(*order, *[F.col(c) for c in features.columns if c not in (*keys, *order)])
    packed = features.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("items"))
    kind = packed.schema["items"].dataType.simpleString()

    def clash(a: Column, b: Column) -> Column:
        shared = F.greatest(F.lit(0), F.least(a["end"], b["end"]) - F.greatest(a["start"], b["start"]) + 1)
        return shared / F.least(a["end"] - a["start"] + 1, b["end"] - b["start"] + 1) > ratio

    kept = F.aggregate("items", F.array().cast(kind), lambda acc, x: F.when(F.exists(acc, lambda y: clash(x, y)), acc).otherwise(F.concat(acc, F.array(x))))
    return packed.select(*keys, F.inline(kept))


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """(bin, n) of equal-width bins between the least and the largest value; data for plots. Null
    and NaN values are in no bin; the two bounds are scalar subqueries."""
    v = df.select(F.col(value).cast("double").alias("v")).where(~F.isnan("v"))
    bounds = v.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    placed = v.withColumns({"lo": bounds.select("lo").scalar(), "hi": bounds.select("hi").scalar()})
    nth = F.least(F.lit(bins - 1), F.floor(F.coalesce(F.try_divide((F.col("v") - F.col("lo")) * bins, F.col("hi") - F.col("lo")), F.lit(0.0))))
    return placed.groupBy(nth.cast("long").alias("bin")).agg(F.count("*").alias("n"))

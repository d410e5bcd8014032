"""Alignment hits: best hits, merged subjects, composite scores, ranking and packing."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transpark.functions.sequences import protein_span, stranded
from transpark.operators.intervals import islands
from transpark.plans.storage import ship_by_value


def good_hits(hits: DataFrame, identity: float = 80.0, evalue: float = 1e10) -> DataFrame:
    """Hits of enough identity. The e-value limit of 1e10 lets everything pass, as compatible
    tools do; give 1e-10 for a strict one."""
    return hits.where((F.col("pident") >= identity) & (F.col("evalue") < evalue))


def best_hits(hits: DataFrame, order: list[str], threshold: float = 50.0, identity: float = 80.0, evalue: float = 1e10, offsets: DataFrame | None = None, scale: int = 3) -> DataFrame:
    """The best hit of each query: (length / slen) * pident above the threshold, ties by ``order``.

    One partial aggregation instead of a sort. ``offsets`` (qseqid, offset) turns protein hits into
    nucleotide spans; queries without an offset are dropped.
    """
    scored = good_hits(hits, identity, evalue).withColumn("score", F.col("length") / F.col("slen") * F.col("pident")).where(F.col("score") > threshold)
    first = F.struct((-F.col("score")).alias("less"), *order, "sseqid", "qstart", "qend", "score")
    best = scored.groupBy("qseqid").agg(F.min(first).alias("b")).select("qseqid", "b.sseqid", "b.score", "b.qstart", "b.qend")
    if offsets is not None:
        best = best.join(offsets, "qseqid").withColumn("p", protein_span(F.col("qstart"), F.col("qend"), F.col("offset"), scale))
        best = best.withColumn("qstart", F.col("p.start")).withColumn("qend", F.col("p.end")).drop("p", "offset")
    return best.withColumn("s", stranded(F.col("qstart"), F.col("qend"))).select("qseqid", "sseqid", "score", "s.start", "s.end", "s.strand")


def merged_subjects(hits: DataFrame, keys: list[str], order: list[str], threshold: float = 80.0, identity: float = 80.0, evalue: float = 1e10) -> DataFrame:
    """The best (query, subject) of each key by covered subject length / slen * mean identity.

    Ties go to the lesser (query, subject); the strand is always 1.
    """
    pair = [*keys, "qseqid", "sseqid"]
    kept = good_hits(hits, identity, evalue).withColumns({"start": F.least("sstart", "send"), "end": F.greatest("sstart", "send")})
    # One shuffle by pair, whose hits are few: islands, what is told of each, and of all of a pair.
    each = islands(kept, pair, "start", "end", spread=False).groupBy(*pair, "island").agg(
        (F.max("end") - F.min("start") + 1).alias("bases"), F.min(F.struct(*order, "slen")).alias("head"), F.sum("pident").alias("idents"), F.count("*").alias("n"),
        F.min(F.least("qstart", "qend")).alias("start"), F.max(F.greatest("qstart", "qend")).alias("end"),
    )
    stats = each.groupBy(*pair).agg(F.sum("bases").alias("covered"), F.min("head")["slen"].alias("slen"), (F.sum("idents") / F.sum("n")).alias("mean_identity"), F.min("start").alias("start"), F.max("end").alias("end"))
    scored = stats.withColumn("score", F.col("covered") / F.col("slen") * F.col("mean_identity")).where(F.col("score") > threshold)
    best = F.min(F.struct((-F.col("score")).alias("less"), "qseqid", "sseqid", "score", "covered", "start", "end")).alias("b")
    return scored.groupBy(*keys).agg(best).select(*keys, "b.qseqid", "b.sseqid", "b.score", "b.covered", "b.start", "b.end", F.lit(1).alias("strand"))


def length_penalty(length: Column, mean: float, std: float, max_z: float, one_sided: bool) -> Column:
    """Standardised distance from the mean length, at most max_z; 0 below it if one-sided."""
    z = F.least(F.abs(length - mean) / F.lit(std if std else 1.0), F.lit(max_z))
    return F.when(length < mean, 0.0).otherwise(z) if one_sided else z


def _power(base: float | None, exponent: float | None) -> float | None:
    if base is None or exponent is None:
        return None
    try:
        return math.pow(base, exponent)
    except OverflowError:
        return math.inf
    except ValueError:
        return math.inf if base == 0 else math.nan


def power(base: Column, exponent: Column) -> Column:
    """base ^ exponent to the last bit as the C library has it, which SQL engines and sequential tools
    share. The JVM's own differs in the last bit for one pair in eleven, and with it the order of
    candidates whose hits are a last bit apart. Bases below zero are not meant."""

    def kernel(bases: pa.Array, exponents: pa.Array) -> pa.Array:
        return pa.array([_power(b, e) for b, e in zip(bases.to_pylist(), exponents.to_pylist(), strict=True)], pa.float64())

    return F.arrow_udf(kernel, "double")(base.cast("double"), exponent.cast("double"))


def composite_score(ant: Column, ins: Column, xeno: Column, n_ant: Column, n_ins: Column, n_xeno: Column, length: Column, components: Column | None, kind: int, mean: float = 5850.0, std: float = 2586.0, max_z: float = 20.0, one_sided: bool = True) -> Column:
    """The candidate score of kind 0, 1 or 2 from summed hit scores and their numbers.

    The exponent shrinks with the distance from the mean length and, where ``components`` is given,
    with the square root of |components - 2|; without it kind 2 is the older form. A negative
    exponent of a zero base is an error in sequential tools; here it is null.
    """
    z = length_penalty(length, mean, std, max_z, one_sided)
    if components is not None:
        z = z + F.sqrt(F.abs(components - 2))
    e = 1 - z / max_z
    powered = lambda b: F.when((b == 0) & (e < 0), None).otherwise(power(b, e))
    has = lambda n: F.when(n > 0, 1.0).otherwise(0.0)
    if kind == 0:
        return powered(ant + ins + xeno)
    if kind == 1:
        return powered(100.0 * has(n_ant) + 100.0 * has(n_ins) + 100.0 * has(n_xeno))
    if kind == 2 and components is not None:
        return 90.0 * has(n_ant + n_xeno) * has(n_ins) + power(F.lit(10.0), e)
    if kind == 2:
        return powered(F.when(ant + xeno == 0, 50.0).otherwise(ant + xeno) * has(n_ins))
    raise ValueError(f"no score of kind {kind}")


def score_inputs(features: DataFrame, keys: list[str]) -> DataFrame:
    """Summed scores and numbers of features by kind: ant, ins, xeno, n_ant, n_ins, n_xeno, n_comp."""
    kinds = {"ant": "Antibiotics", "ins": "InsertionSequences", "xeno": "Xenobiotics", "comp": "CompTNs"}
    sums = [F.sum(F.when(F.col("r_type") == t, F.col("score")).otherwise(0.0)).alias(k) for k, t in kinds.items() if k != "comp"]
    return features.groupBy(*keys).agg(*sums, *[F.count(F.when(F.col("r_type") == t, 1)).alias(f"n_{k}") for k, t in kinds.items()])


def rank_candidates(scored: DataFrame, keys: list[str], score: str, order: list[str], threshold: float = 50.0) -> DataFrame:
    """Candidates above the threshold with their rank in their key, best first, ties by order."""
    return scored.where(F.col(score) > threshold).withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score), *order)))


def pack_features(features: DataFrame, keys: list[str], order: list[str], kinds: dict[str, str]) -> DataFrame:
    """One row per key with the number, ';'-joined products and ';'-joined spans of each kind.

    kinds: short name -> r_type. Features are packed by ``order``.
    """
    item = F.struct(*order, "product", F.col("start").alias("s_"), F.col("end").alias("e_"))
    out = []
    for short, kind in kinds.items():
        packed = F.sort_array(F.collect_list(F.when(F.col("r_type") == kind, item)))
        out += [
            F.count(F.when(F.col("r_type") == kind, 1)).alias(f"n_{short}"),
            F.array_join(F.transform(packed, lambda x: x["product"].cast("string")), ";").alias(f"{short}_products"),
            F.array_join(F.transform(packed, lambda x: F.concat_ws("-", x["s_"], x["e_"])), ";").alias(f"{short}_spans"),
        ]
    return features.groupBy(*keys).agg(*out)


def hit_counts(hits: DataFrame, coverage: float = 0.5) -> DataFrame:
    """Hits and distinct subjects per query, of hits that cover enough of the query."""
    kept = hits.where(F.col("length") / F.col("qlen") >= coverage)
    return kept.groupBy("qseqid").agg(F.count("*").alias("hits"), F.array_join(F.sort_array(F.collect_set("sseqid")), ",").alias("subjects"))


def joined_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Counts of several hit tables side by side: a full outer join with zeros and empty lists."""
    out = None
    for name, table in tables.items():
        own = table.select("qseqid", F.col("hits").alias(f"{name}_hits"), F.col("subjects").alias(f"{name}_subjects"))
        out = own if out is None else out.join(own, "qseqid", "full")
    filled = [c for n in tables for c in (F.coalesce(f"{n}_hits", F.lit(0)).alias(f"{n}_hits"), F.coalesce(f"{n}_subjects", F.lit("")).alias(f"{n}_subjects"))]
    return out.select("qseqid", *filled)


def top_summary(scored: DataFrame, score: str, order: list[str], n: int = 5) -> DataFrame:
    """The n best rows, ties by order (a top-k report)."""
    return scored.orderBy(F.desc(score), *order).limit(n)


ship_by_value(__name__)

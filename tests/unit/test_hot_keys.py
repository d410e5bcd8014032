"""Sweeps over one key that holds all rows: equal to sequential code, and spread over tasks."""

import random

import pytest
from pyspark.sql import functions as F

from transpark.operators import alignments as A
from transpark.operators import intervals as I


def plain_islands(spans, slack):
    out, reach = [], None
    for s, e in sorted(spans):
        if reach is None or s > reach + slack:
            out.append([s, e])
        out[-1][1] = reach = max(out[-1][1], e)
    return [tuple(x) for x in out]


@pytest.mark.parametrize("slack", [0, 7])
def test_islands_of_a_hot_key(spark, slack):
    rng = random.Random(slack)
    hot = [("hot", s, s + rng.choice([0, 1, 3, 30])) for s in (rng.randint(0, 40_000) for _ in range(6000))]
    hot += [("hot", 5_000, 9_000), ("hot", 20_000, 20_000)] + [("hot", 30_000, 30_010)] * 500
    few = [(rng.choice(["a", "b", None, "z"]), s, s + 2) for s in range(0, 400, 3)]
    df = spark.createDataFrame(hot + few, "k string, start int, end int").repartition(3)
    pieces = I.in_pieces(df, ["k"], "start", "end")
    assert pieces.where("k = 'hot'").select(I.PIECE).distinct().count() > 4
    got = [tuple(r) for r in I.merge_intervals(df, ["k"], slack=slack).collect()]
    want = [(k, *x) for k in ("hot", "a", "b", "z", None) for x in plain_islands([r[1:] for r in hot + few if r[0] == k], slack)]
    assert sorted(got, key=str) == sorted(want, key=str)
    rows = I.islands(df, ["k"], "start", "end", slack).where("k = 'hot'")
    assert rows.agg(F.min("island"), F.max("island")).first() == (1, len([w for w in want if w[0] == "hot"]))
    same = I.islands(df, ["k"], "start", "end", slack, spread=False)
    assert same.columns == ["k", "start", "end", "island"] and same.exceptAll(I.islands(df, ["k"], "start", "end", slack)).isEmpty()


def test_depth_of_a_hot_key(spark):
    rng = random.Random(3)
    spans = [("r", s, s + rng.randint(0, 60)) for s in (rng.randint(0, 3000) for _ in range(4000))]
    got = I.depth_runs(spark.createDataFrame(spans, "k string, start int, end int"), ["k"]).collect()
    depth = [0] * 3100
    for _, s, e in spans:
        for p in range(s, e):
            depth[p] += 1
    told = [0] * 3100
    for r in got:
        assert r.start < r.end and not any(told[r.start : r.end])
        told[r.start : r.end] = [r.depth] * (r.end - r.start)
    assert told == depth


def test_anti_join_of_a_hot_key(spark):
    rng = random.Random(4)
    left, right = ([("k", s, s + rng.randint(0, 5)) for s in (rng.randint(0, 60_000) for _ in range(n))] for n in (2500, 1500))
    right.append(("k", 100, 9_000))
    a, b = (spark.createDataFrame(x, "k string, start int, end int") for x in (left, right))
    covered = set()
    for _, s, e in right:
        covered.update(range(s, e + 1))
    want = [x for x in left if not any(p in covered for p in range(x[1], x[2] + 1))]
    assert sorted(map(tuple, I.without_overlap(a, b, ["k"]).collect())) == sorted(want)


def test_one_reference_is_swept_by_many_tasks(spark):
    spans = spark.range(50_000).select(F.lit("ref").alias("ref"), (F.col("id") * 3 + 1).alias("q_start"), (F.col("id") * 3 + 2 + F.col("id") % 5).alias("q_end"))
    want = plain_islands([(i * 3 + 1, i * 3 + 2 + i % 5) for i in range(50_000)], 0)
    merged = A.merged_alignments(spans, ["ref"])
    assert sorted((r.q_start, r.q_end) for r in merged.collect()) == want


def test_coverage_at_any_zoom(spark):
    """Means and maxima of all levels, base by base."""
    rng = random.Random(6)
    spans = [("r", s, s + rng.randint(1, 90)) for s in (rng.randint(0, 2500) for _ in range(300))]
    runs = I.depth_runs(spark.createDataFrame(spans, "k string, start int, end int"), ["k"])
    depth = [0] * 4096
    for _, s, e in spans:
        for p in range(s, e):
            depth[p] += 1
    want = {}
    for level in range(3, 9):
        for b in range(4096 >> level):
            own = depth[b << level : (b + 1) << level]
            if any(own):
                want[level, b] = (sum(own) / len(own), max(own))
    assert {(r.level, r.bin): (r["mean"], r.top) for r in A.coverage_tree(runs, ["k"], 3, 6).collect()} == want


def test_tasks_of_a_coverage_tree_have_few_bins(spark, monkeypatch):
    """One key of 32,000 bins: these are dealt to tasks of about BINS each, once for all levels."""
    monkeypatch.setattr(A, "BINS", 1000)
    runs = spark.createDataFrame([("r", 0, 200_000, 2), ("r", 200_000, 256_000, 1)], "k string, start int, end int, depth long")
    tree = A.coverage_tree(runs, ["k"], 3, 6)
    per_task = tree.where("level = 3").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task < 8000
    assert {(r.level, r.n, r.top) for r in tree.groupBy("level").agg(F.count("*").alias("n"), F.max("top").alias("top")).collect()} == {(n, 256_000 >> n, 2) for n in range(3, 9)}
    assert tree._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1

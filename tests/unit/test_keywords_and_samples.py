"""Keyword tables, and samples built side by side."""

import random
import threading

from pyspark.sql import functions as F

from transpark.operators import enrich as E
from transpark.plans import runner


def test_keyword_tables(spark):
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abAB é") for _ in range(n))
    words = list({word(rng.randint(1, 4)) for _ in range(120)}) + ["", None, "ab", "AB"]
    texts = [(i, word(rng.randint(0, 40))) for i in range(150)] + [(500, None), (501, ""), (1, "ab ab")]
    df = spark.createDataFrame(texts, "id long, body string").withColumn("keyword", F.lit("x"))
    table = spark.createDataFrame([(w,) for w in words], "keyword string")
    want = sorted((i, k) for i, t in texts if t is not None for k in {w.lower() for w in words if w} if k in t.lower())
    for most in (1_000_000, 40):
        assert sorted(map(tuple, E.keyword_matches(df, table, "body", ["id"], most=most).collect())) == want
    assert E.keyword_matches(df, table.limit(0), "body", ["id"]).count() == 0
    assert E.keyword_matches(df.limit(0), table, "body", ["id"]).count() == 0
    ranked = spark.createDataFrame([("AB", "one", 2), ("é", "two", 1), ("ab", "three", 3)], "keyword string, class string, rank int")
    got = {r.id: r["class"] for r in E.keyword_table_classes(df.where("id <> 1"), ranked, "body", ["id"]).collect()}
    assert got == {i: "two" if "é" in (t or "") else "one" if "ab" in (t or "").lower() else "other" for i, t in texts if i != 1}


def test_a_slow_sample_does_not_hold_up_others(spark, tmp_path):
    done = threading.Event()

    def build(sample):
        if sample == "slow":
            assert done.wait(60), "the others never came"
        if sample == "last":
            done.set()
        if sample == "bad":
            raise ValueError("no reads")
        return spark.range(3).withColumn("s", F.lit(sample))

    names = ["slow", "a", "bad", "b", "last"]
    told = {r.sample: r.error for r in runner.run_samples(spark, names, build, str(tmp_path), at_once=2).collect()}
    assert {s: e for s, e in told.items() if e} == {"bad": "ValueError: no reads"} and set(told) == set(names)
    assert spark.read.parquet(str(tmp_path)).count() == 12


def test_one_sample_is_cancelled_alone(spark, tmp_path):
    begun = threading.Event()

    def build(sample):
        if sample != "stuck":
            return spark.range(5)
        begun.set()

        def wait(batches):
            import time

            time.sleep(90)
            yield from batches

        return spark.range(1).mapInArrow(wait, "id long")

    def cancel():
        begun.wait(60)
        for _ in range(60):
            runner.cancel_sample(spark, "stuck")
            if finished.wait(0.5):
                return

    finished = threading.Event()
    thread = threading.Thread(target=cancel)
    thread.start()
    told = {r.sample: r.error for r in runner.run_samples(spark, ["stuck", "x", "y"], build, str(tmp_path)).collect()}
    finished.set()
    thread.join()
    assert told["x"] is None and told["y"] is None and "cancelled" in told["stuck"].lower()
    assert not runner._finished(spark, str(tmp_path / "sample=stuck")) and runner._finished(spark, str(tmp_path / "sample=x"))

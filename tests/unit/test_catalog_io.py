"""Round trips and the queries of the second catalogue module, against their SQL."""

import inspect

import duckdb
import pytest

from transpark import catalog, catalog_io

SF = "/root/testdata/sf0.001"
NAMES = sorted(n for n, f in catalog.queries().items() if inspect.getmodule(f) is catalog_io)


@pytest.fixture(scope="module")
def con():
    out = duckdb.connect()
    for t in catalog.TABLES:
        out.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return out


def shown(rows):
    return sorted(repr([round(float(v), 6) if isinstance(v, float) else v for v in r]) for r in rows)


@pytest.mark.parametrize("name", [*NAMES, "path_dedupe", "kmer_dedupe", "greedy_nonoverlap", "graph_quality", "histogram30"])
def test_queries_against_sql(spark, con, name):
    got = catalog.queries()[name](spark, SF)
    cur = con.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(got.columns)
    assert shown(tuple(r) for r in got.select(*[f"`{n}`" for n in names]).collect()) == shown(cur.fetchall())


def test_frequent_kmers_and_long_chains(spark):
    """A repeat that all sequences share makes no pairs; chains end in order, also one by one."""
    from pyspark.sql import functions as F

    from transpark.operators import similarity as N

    rows = [(i, "ACGT" * 12 + "".join("ACGT"[(i * 7919 + j * j * (i + 3)) % 4] for j in range(90))) for i in range(120)]
    rows += [(200 + i, rows[i][1][: 130 - i] + "G" * i) for i in range(20)]
    seqs = spark.createDataFrame(rows, "ord long, seq string")
    every = {(r.later, r.earlier): (r.shared, r.size) for r in N.containment_pairs(seqs, 11).where("percent >= 60").collect()}
    rare = {(r.later, r.earlier): (r.shared, r.size) for r in N.containment_pairs(seqs, 11, least=60.0).collect()}
    assert every == rare and rare
    chain = spark.range(1, 60).select(F.col("id").alias("later"), (F.col("id") - 1).alias("earlier"))
    items = spark.range(60).withColumnRenamed("id", "ord")
    for most in (20, 1000):
        assert sorted(r.ord for r in N.resolve_greedy(items, chain, most=most).collect()) == list(range(0, 60, 2))


def test_tags_are_found_anywhere_in_a_header(spark):
    import random

    from transpark.plans.pipelines import tag_sequences

    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("ab_") for _ in range(n))
    tags = [(f"CT{i:03d}", rng.choice("xy"), word(rng.choice([0, 2, 3, 5]))) for i in range(30)]
    records = list({(rng.choice("xyz"), word(rng.randint(0, 9))) for _ in range(60)})
    want = {}
    for s, d in records:
        fits = [t for t, sample, c in tags if sample == s and c in d]
        if fits:
            want[s, d] = min(fits)
    got = tag_sequences(spark.createDataFrame(tags, "ct_tag string, sample string, cycle_id string"), spark.createDataFrame([(s, d, f"{s}/{d}") for s, d in records], "sample string, description string, seq string"))
    assert {tuple(r.seq.split("/")): r.ct_tag for r in got.collect()} == want


def test_molecule_of_what_several_part_files_hold(spark):
    from pyspark.sql import functions as F

    from transpark.plans import pipelines

    records = spark.createDataFrame([("/x/k=k1/part-0.txt", "ACGT"), ("/x/k=k1/part-1.txt", "MKV"), ("/x/k=k2/part-0.txt", "ACGT")], "file string, seq string")
    assert sorted(map(tuple, pipelines.molecule(records, catalog_io.last_folder()).collect())) == [("k1", True), ("k2", False)]
    assert pipelines.molecule(records).where(F.col("protein")).count() == 1


def test_alignment_files_grow_in_number(spark, monkeypatch):
    import glob

    monkeypatch.setattr(catalog_io, "ROWS_A_FILE", 1000)
    path = catalog_io.bam_files(spark, SF).removeprefix("file:")
    rows = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert 3 < len(glob.glob(f"{path}/*.bam")) <= -(-rows // 1000)
    assert catalog.queries()["io_bam"](spark, SF).count() == rows

"""Binary alignments: splits of any size give the records of the file, regions open their blocks only."""

import json
import random

import pytest

from transpark.sources import bam as B

REFS = [("chr1", 9_000_000), ("chr2", 500_000), ("empty", 10), ("chr3", 80_000)]


def some_rows(rng, n):
    rows = []
    for i in range(n):
        ref = rng.choice(["chr1", "chr1", "chr2", "chr3", "*"])
        length = rng.choice([0, 5, 100, 3000]) if i % 50 else 150_000  # some are longer than a block
        cigar = "*" if ref == "*" or not length else f"{length}M" + rng.choice(["", "2D1M", "3I5N"])
        rows.append((f"read/{i}", rng.choice([0, 16, 2048]) if ref != "*" else 4, ref, rng.randint(1, 70_000) if ref != "*" else 0, rng.randint(0, 60), cigar, length, rng.choice(["", "chr2,5,-,9M,3,0;"])))
    at = {n: i for i, (n, _) in enumerate(REFS)}
    return sorted(rows, key=lambda r: (at.get(r[2], 9), r[3]))


@pytest.fixture(scope="module")
def written(tmp_path_factory):
    rows = some_rows(random.Random(3), 600)
    path = tmp_path_factory.mktemp("bam") / "x.bam"
    with open(path, "wb") as f:
        out = B.Output(f, REFS)
        for r in rows:
            out.write(*r)
        index = out.close()
    path.with_name("x.bam.bai").write_bytes(index)
    return str(path), rows


def splits(path, n, **options):
    reader = B.Reader({"path": path, "splitbytes": str(n), **options})
    return reader, reader.partitions()


@pytest.mark.parametrize("n", [5_000, 33_333, 70_000, 250_000, 10**9])
def test_splits_give_each_record_once(written, n):
    path, rows = written
    _, parts = splits(path, n)
    assert len(parts) == -(-B.listed(path)[0][1] // n)
    assert [r for p in parts for r in B.records(p)] == rows


def test_regions_open_their_blocks_only(written, tmp_path):
    path, rows = written
    low, high = B.index_range(path, 1)
    data = bytearray(open(path, "rb").read())
    head = B.Blocks(path).read(0)[1]
    for i in range(head, low >> 16):
        data[i] = 0
    end = B.Blocks(path).read(high >> 16)[1]
    for i in range(end, len(data)):
        data[i] = 0
    broken = tmp_path / "y.bam"
    broken.write_bytes(data)
    (tmp_path / "y.bam.bai").write_bytes(open(path + ".bai", "rb").read())
    for n in (20_000, 10**9):
        reader, parts = splits(str(broken), n, ref="chr2")
        got = [r for p in parts for b in reader.read(p) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        assert got == [r for r in rows if r[2] == "chr2"]
    assert splits(path, 1000, ref="empty")[1] == [] and splits(path, 1000, ref="none")[1] == []


def test_source_and_sink(spark, written, tmp_path):
    path, rows = written
    data, refs = B.read_bam(spark, path, split_bytes=9_000)
    assert data.rdd.getNumPartitions() >= 3 and sorted(map(tuple, data.collect())) == sorted(rows)
    assert sorted(map(tuple, refs.collect())) == sorted(REFS)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    assert sorted(map(tuple, B.read_bam(spark, path)[0].where("ref = 'chr3' and mapq > 9").collect())) == sorted(r for r in rows if r[2] == "chr3" and r[4] > 9)
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    out = str(tmp_path / "out")
    B.write_bam(data.repartition(3), out, REFS)
    again = B.read_bam(spark, out, split_bytes=4_000)[0]
    assert sorted(map(tuple, again.collect())) == sorted(rows) and len(B.listed(out)) == 3
    assert B.read_bam(spark, out, "chr2")[0].count() == sum(r[2] == "chr2" for r in rows)


def test_magic_inside_of_blocks_starts_no_split(tmp_path):
    """Incompressible names that hold heads of blocks: a block that no block follows isn't one."""
    rng = random.Random(5)
    path = tmp_path / "m.bam"
    rows = [("".join(chr(rng.randint(33, 126)) for _ in range(200)), 0, "chr1", i, 9, "3M", 3, "") for i in range(1, 900)]
    with open(path, "wb") as f:
        out = B.Output(f, json.loads(json.dumps(REFS)))
        for r in rows:
            out.write(*r)
        out.close()
    data = open(path, "rb").read()
    fake = B.MAGIC + bytes(8) + b"BC\x02\x00" + b"\x10\x00"
    assert B.Blocks(str(path)).first(0) == 0
    for n in (7_000, 50_000):
        assert [r for p in splits(str(path), n)[1] for r in B.records(p)] == rows
    (tmp_path / "f.bin").write_bytes(fake + bytes(50) + data)
    assert B.Blocks(str(tmp_path / "f.bin")).first(0) == len(fake) + 50

import random
import re

from transpark.operators import alignments as A


def slow_blocks(cigar, pos, gap):
    q, r, pairs = 0, pos, []
    for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar):
        n = int(n)
        if op in "M=X":
            pairs += [(q + i, r + i) for i in range(n)]
        q += n if op in "MISH=X" else 0
        r += n if op in "MDN=X" else 0
    out = []
    for p in pairs:
        if out and p[0] - out[-1][-1][0] <= gap and p[1] - out[-1][-1][1] <= gap:
            out[-1].append(p)
        else:
            out.append([p])
    return [(b[0][0], b[-1][0], b[0][1], b[-1][1]) for b in out]


def test_blocks_of_random_cigars(spark):
    rng = random.Random(1)
    rows = [("3S", 5), ("4H5M2I1D6M3S", 9), ("*", 1)]
    for _ in range(60):
        rows.append(("".join(f"{rng.randint(1, 9)}{rng.choice('MID=XN')}" for _ in range(rng.randint(1, 9))), rng.randint(0, 50)))
    df = spark.createDataFrame(rows, "cigar string, pos int")
    from pyspark.sql import functions as F

    for r in df.withColumn("b", A.cigar_blocks(F.col("cigar"), F.col("pos"), 4)).collect():
        assert [tuple(x) for x in r.b] == slow_blocks(r.cigar, r.pos, 4), r.cigar


def test_read_blocks(spark):
    cols = "read string, flag int, ref string, pos int, cigar string, seq_len int"
    rows = [("r", 0, "c_transposon", 1, "60M600I40M", 700), ("r", 4, "c_transposon", 1, "60M", 60), ("short", 0, "c_cargo", 1, "9M", 9), ("h", 16, "c_cargo_2", 11, "50H60M", 60)]
    refs = spark.createDataFrame([("c_transposon", 100), ("c_cargo", 100), ("c_cargo_2", 100)], "ref string, length int")
    got = {(b.read, b.annot, b.r_start, b.r_end, b.q_start, b.q_end, b.read_len) for b in A.read_blocks(spark.createDataFrame(rows, cols), refs, least=20).collect()}
    assert got == {("r", "transposon", 0, 59, 0, 59, 700), ("r", "transposon", 60, 99, 660, 699, 700), ("h", "cargo", 10, 69, 50, 109, 110)}
    assert {tuple(r) for r in A.longest_reads(spark.createDataFrame(rows, cols)).collect()} == {("r", 700), ("short", 9), ("h", 110)}
    assert A.close_alignments(spark.createDataFrame(rows, cols), 0.5).count() == 3

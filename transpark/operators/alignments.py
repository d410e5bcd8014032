"""Read blocks from alignments, straight from their CIGARs: no base is ever a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transpark.functions.sequences import cigar_ops, contig_kind, hard_clips
from transpark.operators.intervals import depth_runs, merge_blocks, merge_intervals
from transpark.plans.storage import materialise

BLOCK = "struct<q_start:int,q_end:int,r_start:int,r_end:int>"


def cigar_blocks(cigar: Column, pos: Column, gap: int) -> Column:
    """Aligned blocks (q_start, q_end, r_start, r_end; 0-based, ends included) of a CIGAR.

    pos is 0-based. A block ends where the query or the reference jumps by more than ``gap``
    between aligned pairs; query positions count hard clips at the start.
    """
    none = F.lit(None).cast(BLOCK)
    start = F.struct(F.lit(0).alias("q"), pos.cast("int").alias("r"), none.alias("open"), F.array().cast(f"array<{BLOCK}>").alias("done"))

    def step(s: Column, op: Column) -> Column:
        n, kind = op["len"], op["op"]
        pair = kind.isin("M", "=", "X")
        fresh = F.struct(s["q"].alias("q_start"), (s["q"] + n - 1).alias("q_end"), s["r"].alias("r_start"), (s["r"] + n - 1).alias("r_end"))
        longer = F.struct(s["open"]["q_start"].alias("q_start"), (s["q"] + n - 1).alias("q_end"), s["open"]["r_start"].alias("r_start"), (s["r"] + n - 1).alias("r_end"))
        jump = (s["q"] - s["open"]["q_end"] > gap) | (s["r"] - s["open"]["r_end"] > gap)
        cut = pair & s["open"].isNotNull() & jump
        opened = F.when(~pair, s["open"]).when(s["open"].isNull() | jump, fresh).otherwise(longer)
        return F.struct(
            (s["q"] + F.when(pair | kind.isin("I", "S", "H"), n).otherwise(0)).alias("q"),
            (s["r"] + F.when(pair | kind.isin("D", "N"), n).otherwise(0)).alias("r"),
            opened.alias("open"),
            F.when(cut, F.concat(s["done"], F.array(s["open"]))).otherwise(s["done"]).alias("done"),
        )

    end = lambda s: F.when(s["open"].isNull(), s["done"]).otherwise(F.concat(s["done"], F.array(s["open"])))
    return F.aggregate(cigar_ops(cigar), start, step, end)


def read_blocks(alignments: DataFrame, references: DataFrame, gap: int = 500, least: int = 100, shorter: float = 0.5, longer: float = 5000, merge_gap: int | None = 50) -> DataFrame:
    """Blocks (read, annot, r_start, r_end, q_start, q_end, read_len) of mapped alignments.

    alignments: (read, flag, ref, pos 1-based, cigar, seq_len), references: (ref, length). Reads
    count whose length, hard clips included, is within ref * (1 - shorter) and ref * (1 + longer);
    blocks count from ``least`` reference bases on; those of a read and kind are merged over gaps of
    at most merge_gap (None: not at all).
    """
    rows = alignments.where(F.col("flag").bitwiseAND(F.lit(4)) == 0).join(references, "ref").withColumn("read_len", F.col("seq_len") + hard_clips(F.col("cigar")))
    rows = rows.where(F.col("read_len").between(F.col("length") * (1 - shorter), F.col("length") * (1 + longer)))
    each = rows.select("read", contig_kind(F.col("ref")).alias("annot"), "read_len", F.explode(cigar_blocks(F.col("cigar"), F.col("pos") - 1, gap)).alias("b"))
    blocks = each.select("read", "annot", "b.*", "read_len").where(F.col("r_end") - F.col("r_start") + 1 >= least)
    return blocks.select("read", "annot", "r_start", "r_end", "q_start", "q_end", "read_len") if merge_gap is None else merge_blocks(blocks, ["read", "annot"], merge_gap)


def longest_reads(alignments: DataFrame) -> DataFrame:
    """(read, read_len): the longest length of a read over its alignments, hard clips included."""
    return alignments.groupBy("read").agg(F.max(F.col("seq_len") + hard_clips(F.col("cigar"))).alias("read_len"))


def close_alignments(alignments: DataFrame, identity: float = 0.9) -> DataFrame:
    """Alignments whose matched bases are enough of the aligned query."""
    from transpark.functions.sequences import identity as share
    from transpark.functions.sequences import query_span

    return alignments.where(share(F.col("cigar"), query_span(F.col("cigar"))) >= identity)


def splittable(final: DataFrame, score: str = "score2", spans: str = "is_spans", least: float = 50.0) -> DataFrame:
    """Candidates with enough score and at least one element range."""
    return final.where(F.col(score).isNotNull() & ~F.isnan(score) & (F.col(score) >= least) & (F.coalesce(F.trim(spans), F.lit("")) != ""))


def cycle_records(final: DataFrame, records: DataFrame, key: str = "cycle", **limits) -> DataFrame:
    """Candidates fit to be split with the sequence of their record (key, seq); empty ones don't count."""
    return splittable(final, **limits).join(records.where(F.length("seq") > 0).select(key, "seq"), key)


def reads_by_contig(alignments: DataFrame) -> DataFrame:
    """(ref, read, alignments, low, high): a contig's reads, a row each, with what they cover."""
    return alignments.groupBy("ref", "read").agg(F.count("*").alias("alignments"), F.min("pos").alias("low"), F.max("pos").alias("high"))


def merged_alignments(spans: DataFrame, keys: list[str], start: str = "q_start", end: str = "q_end") -> DataFrame:
    """The union of aligned spans per key; spans that start or end at 0 are left out first."""
    return merge_intervals(spans.where((F.col(start) != 0) & (F.col(end) != 0)), keys, start, end)


def coverage(spans: DataFrame, references: DataFrame, circular: DataFrame) -> DataFrame:
    """(ref, circular, start, end, depth): runs of equal depth over half-open spans (ref, read, start,
    end) cut at the reference's end, for all reads and for those in ``circular`` (read)."""
    cut = spans.join(references.select("ref", "length"), "ref").withColumn("end", F.least("end", "length"))
    marked = cut.join(circular.select("read").distinct().withColumn("is_circular", F.lit(True)), "read", "left")
    each = marked.withColumn("circular", F.explode(F.when(F.col("is_circular"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    return depth_runs(each.select("ref", "circular", "start", "end"), ["ref", "circular"])


#: Smallest bins of a task that adds them up.
BINS = 500_000


def coverage_tree(runs: DataFrame, keys: list[str], base: int = 8, levels: int = 12) -> DataFrame:
    """(keys, level, bin, mean, top): mean and largest depth of bins of 2^level bases, for ``levels`` sizes
    from 2^base on, so that any zoom of a plot is read from one table. runs: (keys, start, end, depth) as
    ``coverage`` gives them; bins without a covered base are left out, and count as depth 0 in means.

    Runs are cut at the largest bins and dealt by these, to as many tasks as keep BINS of the smallest
    each; a task then has all that is below its largest bins. It adds the smallest bins up from the runs and
    each larger size from these: a bin's bases and its largest depth are sums and maxima of its parts'.
    """
    size, high = 1 << base, base + levels - 1
    runs = materialise(runs.select(*keys, F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "depth"))
    # Where a bin lies, for bins of 2^bits bases.
    at = lambda c, bits: F.shiftright(c, bits)
    bins = runs.agg(F.sum(at(F.col("end") - 1, base) - at(F.col("start"), base) + 1)).first()[0] or 0
    shares = max(int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-bins // BINS))
    cut = runs.select(*keys, "start", "end", "depth", F.explode(F.sequence(at(F.col("start"), high), at(F.col("end") - 1, high))).alias("top_"))
    edge = lambda n: F.shiftleft(F.col("top_") + n, high)
    dealt = cut.select(*keys, "top_", F.greatest("start", edge(0)).alias("start"), F.least("end", edge(1)).alias("end"), "depth").repartition(shares, *keys, "top_")
    parts = dealt.select(*keys, "top_", "start", "end", "depth", F.explode(F.sequence(at(F.col("start"), base), at(F.col("end") - 1, base))).alias("bin"))
    shared = F.least(F.col("end"), (F.col("bin") + 1) * size) - F.greatest(F.col("start"), F.col("bin") * size)
    bottom = parts.groupBy(*keys, "top_", "bin").agg(F.sum(F.col("depth") * shared).alias("bases"), F.max("depth").alias("top"))
    above = bottom.select(*keys, "top_", "bases", "top", "bin", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("up"))
    tree = above.groupBy(*keys, "top_", (F.col("up") + base).alias("level"), F.expr("shiftright(bin, up)").alias("bin")).agg(F.sum("bases").alias("bases"), F.max("top").alias("top"))
    return tree.select(*keys, "level", "bin", (F.col("bases") / F.pow(F.lit(2.0), F.col("level"))).alias("mean"), "top")

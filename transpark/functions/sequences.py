"""Scalar functions on sequences, identifiers and alignments: plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The complement of each base, case kept.
BASES, COMPLEMENTS = "ACGTacgt", "TGCAtgca"


def reverse_complement(seq: Column) -> Column:
    """Reverse complement; any character but ACGTacgt is an error."""
    good = seq.rlike(f"^[{BASES}]*$")
    return F.when(seq.isNull() | good, F.reverse(F.translate(seq, BASES, COMPLEMENTS))).otherwise(F.raise_error(F.concat(F.lit("not a DNA sequence: "), seq)))


def canonical(seq: Column) -> Column:
    """The lesser of a sequence and its reverse complement."""
    return F.least(seq, reverse_complement(seq))


def flip_sign(node: Column) -> Column:
    """+ for - and - for + (in whole ids: every sign)."""
    return F.translate(node, "+-", "-+")


def strip_sign(node: Column) -> Column:
    """A node id without its last sign."""
    return F.regexp_replace(node, "[+-]$", "")


def overlap_length(overlap: Column) -> Column:
    """n of 'nM'; null for anything else, as '*'."""
    return F.regexp_extract(overlap, r"^(\d+)M$", 1).try_cast("int")


def kmers(seq: Column, k: int, block: int = 256) -> Column:
    """All k-mers in order, repeats included; none in shorter sequences.

    A substring is found by walking there, so the sequence is cut into overlapping blocks first
    and k-mers are taken from the blocks: long sequences cost nearly linear time.
    """
    last = F.length(seq) - k + 1
    blocks = F.transform(F.sequence(F.lit(1), last, F.lit(block)), lambda b: F.substring(seq, b, F.lit(block + k - 1)))
    each = F.transform(blocks, lambda x: F.transform(F.sequence(F.lit(1), F.length(x) - k + 1), lambda i: F.substring(x, i, F.lit(k))))
    return F.when(F.length(seq) >= k, F.flatten(each)).otherwise(F.array().cast("array<string>"))


def kmer_set(seq: Column, k: int) -> Column:
    """Distinct k-mers."""
    return F.array_distinct(kmers(seq, k))


def kmer_chunks(seq: Column, k: int) -> Column:
    """Non-overlapping k-mers from the start; the rest is dropped."""
    return F.when(F.length(seq) >= k, F.transform(F.sequence(F.lit(1), F.length(seq) - k + 1, F.lit(k)), lambda i: F.substring(seq, i, F.lit(k)))).otherwise(F.array().cast("array<string>"))


def id_length(name: Column) -> Column:
    """The number after '-len' in a candidate id, else 0."""
    return F.coalesce(F.regexp_extract(name, r"-len(\d+)-", 1).try_cast("int"), F.lit(0))


def id_components(name: Column) -> Column:
    """The number after '-comp' in a candidate id, else 0."""
    return F.coalesce(F.regexp_extract(name, r"-comp(\d+)-", 1).try_cast("int"), F.lit(0))


def max_range_length(ranges: Column) -> Column:
    """Largest |end - start| of 's-e;s-e'; malformed parts are skipped, 0 if none is left."""
    good = F.filter(F.split(ranges, ";"), lambda p: F.trim(p).rlike(r"^\d+-\d+$"))
    spans = F.transform(good, lambda p: F.abs(F.split(F.trim(p), "-")[1].cast("int") - F.split(F.trim(p), "-")[0].cast("int")))
    return F.coalesce(F.array_max(spans), F.lit(0))


def antibiotic_names(full: Column) -> Column:
    """(product, gene): the last but one and the last field between bars."""
    parts = F.split(full, r"\|")
    product = F.when(F.size(parts) >= 2, F.try_element_at(parts, F.lit(-2))).otherwise(full)
    return F.struct(product.alias("product"), F.element_at(parts, -1).alias("gene"))


def xenobiotic_names(full: Column) -> Column:
    """(product, gene) from the first bar field, split at a colon; the gene falls back to all."""
    first = F.split(F.split(full, r"\|")[0], ":")
    return F.struct(first[0].alias("product"), F.coalesce(F.try_element_at(first, F.lit(2)), full).alias("gene"))


def sample_and_kmer(basename: Column) -> Column:
    """(sample, kmer) from a file name: fields before the first dot, split at underscores."""
    parts = F.split(F.substring_index(basename, ".", 1), "_")
    return F.struct(parts[0].alias("sample"), F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")).alias("kmer"))


def protein_span(qstart: Column, qend: Column, offset: Column, scale: int = 3) -> Column:
    """Nucleotide (start, end) of a protein hit; offset is the ORF's start (1-based, so one too
    many, as compatible tools have it). scale 1 adds the offset only."""
    start = (qstart - 1) * 3 + 1 + offset if scale == 3 else qstart + offset
    return F.struct(start.alias("start"), (qend * scale + offset).alias("end"))


def stranded(start: Column, end: Column) -> Column:
    """(start, end, strand) with start <= end; strand -1 if they were swapped."""
    return F.struct(F.least(start, end).alias("start"), F.greatest(start, end).alias("end"), F.when(start > end, -1).otherwise(1).alias("strand"))


def overlap_ratio(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Inclusive overlap over the shorter length."""
    shared = F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(s1, s2) + 1)
    return shared / F.least(e1 - s1 + 1, e2 - s2 + 1)


def large_overlap(s1: Column, e1: Column, s2: Column, e2: Column, least: int = 300) -> Column:
    """Whether two blocks overlap by more than ``least``."""
    size = F.least(e1, e2) - F.greatest(s1, s2)
    return (size >= 1) & (size > least)


def cigar_ops(cigar: Column) -> Column:
    """(len, op) of a CIGAR string."""
    return F.transform(F.regexp_extract_all(cigar, F.lit(r"(\d+[MIDNSHP=X])"), 1), lambda x: F.struct(F.regexp_extract(x, r"^(\d+)", 1).cast("int").alias("len"), F.right(x, F.lit(1)).alias("op")))


def _span(cigar: Column, ops: str) -> Column:
    kept = F.filter(cigar_ops(cigar), lambda o: F.lit(ops).contains(o["op"]))
    return F.aggregate(kept, F.lit(0), lambda acc, o: acc + o["len"])


def query_span(cigar: Column) -> Column:
    """Query bases that a CIGAR covers."""
    return _span(cigar, "MI=X")


def reference_span(cigar: Column) -> Column:
    """Reference bases that a CIGAR covers."""
    return _span(cigar, "MDN=X")


def match_span(cigar: Column) -> Column:
    """Bases of the M operations."""
    return _span(cigar, "M")


def all_span(cigar: Column) -> Column:
    """Bases of all operations."""
    return _span(cigar, "MIDNSHP=X")


def soft_clips(cigar: Column) -> Column:
    """(left, right) soft-clip lengths, 0 if none."""
    take = lambda p: F.coalesce(F.regexp_extract(cigar, p, 1).try_cast("int"), F.lit(0))
    return F.struct(take(r"^(\d+)S").alias("left"), take(r"(\d+)S$").alias("right"))


def hard_clips(cigar: Column) -> Column:
    """Bases of all hard clips."""
    return _span(cigar, "H")


def supplementary(sa: Column) -> Column:
    """(ref, start, end) of each part of an SA tag; the end adds the M operations to the start."""
    parts = F.filter(F.split(sa, ";"), lambda p: F.size(F.split(p, ",")) >= 4)

    def one(p: Column) -> Column:
        f = F.split(p, ",")
        start = f[1].cast("int")
        return F.struct(f[0].alias("ref"), start.alias("start"), (start + match_span(f[3])).alias("end"))

    return F.transform(parts, one)


def identity(cigar: Column, query_length: Column) -> Column:
    """Matched bases over the aligned query length, 0 if that is 0."""
    return F.coalesce(F.try_divide(match_span(cigar), query_length), F.lit(0.0))


def pattern_centre(start: Column, end: Column, read_length: Column) -> Column:
    """Centre of a stretch as a share of the read, within 0 and 1."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (start + end) / 2 / read_length))


def safe_filename(name: Column) -> Column:
    """Letters, digits, _ and - only, 60 characters at most."""
    return F.left(F.regexp_replace(name, "[^A-Za-z0-9_-]", "_"), F.lit(60))


def candidate_tag(n: Column, prefix: str = "CT") -> Column:
    """CT001; wider past 999."""
    return F.format_string(prefix + "%03d", n)


def run_of_read(read: Column) -> Column:
    """What comes before the first dot of a read id."""
    return F.substring_index(read, ".", 1)


def is_protein(seq: Column) -> Column:
    """Whether a sequence has characters that DNA has not."""
    return F.upper(seq).rlike("[^ATGCN]")


def cycle_of_summary(name: Column) -> Column:
    """The cycle id in a mapping summary's file name."""
    return F.regexp_extract(name, r"srr_summary_?(Cycle_.+?)_split\.fasta\.txt", 1)


def contig_kind(name: Column) -> Column:
    """transposon, cargo or unknown, by a contig's name."""
    return F.when(name.rlike(r"_transposon(_\d+)?$"), "transposon").when(name.rlike(r"_cargo(_\d+)?$"), "cargo").otherwise("unknown")


def exact_round(value: Column, digits: int) -> Column:
    """A double rounded by its exact binary value, half to even: 2.675 to two digits is 2.67, as it is
    a little less than that; 0.0625 to three digits is 0.062.

    The product with the power of ten is kept as two doubles (halves of 26 and 27 bits multiply without
    loss), so that its distance from a tie is known exactly. Numbers whose product reaches 2^53 have no
    digits to lose and stay.
    """
    split, power = 134217729.0, float(10**digits)
    high = lambda x: x * split - (x * split - x)
    power_high = power * split - (power * split - power)
    x = F.abs(value)
    x_high = high(x)
    product = x * power
    rest = ((x_high * power_high - product) + x_high * (power - power_high) + (x - x_high) * power_high) + (x - x_high) * (power - power_high)
    whole = F.floor(product).cast("double")
    over = product - whole - 0.5
    up = (over > 0) | ((over == 0) & ((rest > 0) | ((rest == 0) & (whole % 2 == 1))))
    rounded = (whole + F.when(up, 1.0).otherwise(0.0)) / power * F.when(value < 0, -1.0).otherwise(1.0)
    return F.when(F.isnan(value) | (product >= float(1 << 53)), value).otherwise(rounded)


def number_or_zero(value: Column, digits: int) -> Column:
    """A number rounded by its exact value; 0 for what isn't one."""
    return exact_round(F.coalesce(value.try_cast("double"), F.lit(0.0)), digits)


def metadata_line(product: Column, genes: Column, score: Column) -> Column:
    """A one-line description with defaults for what is missing."""
    return F.concat(F.coalesce(product, F.lit("Unknown")), F.lit(" | "), F.array_join(F.coalesce(genes, F.array().cast("array<string>")), "; "), F.lit(" | "), F.format_string("%.2f", F.coalesce(score, F.lit(0.0))))

"""Mixing sources to target weights with a low-discrepancy schedule.

Slot n of the mix takes the golden-ratio point n * phi mod 1, found in integers of 31 bits, and
gives the slot to the source whose share of the cumulative targets holds the point. Slots are
ranked per source; the r-th slot of a source takes the r-th block of equally many words from the
source's shuffled, repeating stream. Ranks and stream offsets are prefix sums in two levels (chunks
of slots, buckets of documents), so no source meets in one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, ship_by_value, small_or_not

#: The points' modulus, and its share that is the golden ratio's fraction (odd).
POINTS, GOLDEN = 1 << 31, 1327217885
WEIGHTS, SHARE, REPEATS = (5, 2, 1), 1.5, 2
BLOCK_WORDS = 256
CHUNK, BIN_BITS = 1 << 13, 19
WORD = r"[^\x20\x09-\x0D]+"


def _above(order: str, *by: str) -> Window:
    return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """Targets of sources (source, source_size), a row each; a small table of one row per source.

    Sources by code point, null last, take the weights in turn. All targets together are ``share``
    of all words; none is above ``repeats`` times its source's words, and what that leaves over is
    shared by weight among the others.
    """
    ordered = sizes.withColumn("s_ix", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ordered = ordered.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), F.col("s_ix") % len(weights) + 1).cast("double")).withColumn("cap", F.col("source_size") * float(repeats))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), "s_ix").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    total = F.sum("source_size").over(whole) * share
    free = (total - F.coalesce(F.sum("cap").over(by_ratio), F.lit(0.0))) / (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(by_ratio), F.lit(0.0)))
    full = ordered.withColumn("full", free * F.col("w") > F.col("cap"))
    part = lambda c: F.coalesce(F.sum(F.when(F.col("full"), F.col(c))).over(whole), F.lit(0.0))
    rate = F.try_divide(total - part("cap"), F.sum("w").over(whole) - part("w"))
    return full.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(rate * F.col("w"))).select("s_ix", "source", "source_size", "target")


def schedule(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Slots of the mix: slot, s_ix, rank, first_word, end_word (in the source's repeating stream).

    A source has as many slots as its target needs; its last block is cut to the target. Slots that
    the points left short for a source (a few at most) follow at the end.
    """
    spark = targets.sparkSession
    quota = targets.withColumn("words", F.round("target").cast("long")).withColumn("slots", F.ceil(F.col("words") / block_words))
    run = F.sum("target").over(Window.orderBy("s_ix"))
    whole = F.sum("target").over(Window.partitionBy())
    bounds = quota.withColumn("hi", F.when(whole > 0, F.floor(run / whole * POINTS)).otherwise(0).cast("long"))
    bounds = bounds.withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("s_ix")), F.lit(0).cast("long")))
    bounds = cut(bounds.where("slots > 0").select("s_ix", "words", "slots", "lo", "hi"))
    n, sources = (x or 0 for x in bounds.agg(F.sum("slots"), F.max("s_ix") + 1).first())
    bins = bounds.where("hi > lo").select("s_ix", "lo", "hi", F.explode(F.sequence(F.shiftright("lo", BIN_BITS), F.shiftright(F.col("hi") - 1, BIN_BITS))).alias("bin"))
    points = spark.range(n).select(F.col("id").alias("slot"), F.pmod(F.pmod(F.col("id"), F.lit(POINTS)) * F.lit(GOLDEN), F.lit(POINTS)).alias("u"))
    points = points.withColumn("bin", F.shiftright("u", BIN_BITS)).join(small_or_not(bins), "bin").where("u >= lo and u < hi")
    given = points.select("slot", "s_ix", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    counts = cut(given.groupBy("chunk", "s_ix").agg(F.count("*").alias("in_chunk")))
    offsets = counts.withColumn("before", F.coalesce(F.sum("in_chunk").over(_above("chunk", "s_ix")), F.lit(0).cast("long")))
    ranked = given.withColumn("own", F.row_number().over(Window.partitionBy("chunk", "s_ix").orderBy("slot")) - 1)
    ranked = ranked.join(small_or_not(offsets.select("chunk", "s_ix", "before")), ["chunk", "s_ix"]).select("slot", "s_ix", (F.col("before") + F.col("own")).alias("rank"))
    had = counts.groupBy("s_ix").agg(F.sum("in_chunk").alias("had"))
    short = bounds.join(had, "s_ix", "left").withColumn("had", F.coalesce("had", F.lit(0).cast("long"))).where("had < slots")
    late = short.select("s_ix", F.explode(F.sequence("had", F.col("slots") - 1)).alias("rank")).select((F.lit(n) + F.col("rank") * sources + F.col("s_ix")).alias("slot"), "s_ix", "rank")
    every = ranked.unionByName(late).join(small_or_not(bounds.select("s_ix", "words", "slots")), "s_ix").where("rank < slots")
    first = F.col("rank") * block_words
    return every.select("slot", "s_ix", "rank", first.alias("first_word"), F.least(first + block_words, F.col("words")).alias("end_word"))


def streams(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Each row's place in its source's shuffled stream: doc_id, source, size, hash (of the text),
    bucket, place, start.

    The order is by md5 of the id; rows of one id follow by size and hash. (source, bucket, place)
    is unique.
    """
    key = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.xxhash64(text).alias("hash"), key.alias("key"))
    rows = cut(rows.withColumn("bucket", F.substring("key", 1, 3)))
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    before = sums.withColumn("before", F.coalesce(F.sum("in_bucket").over(_above("bucket", "source")), F.lit(0).cast("long")))
    before = cut(before.select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"), "before"))
    order = Window.partitionBy("source", "bucket").orderBy("key", "size", "hash")
    placed = rows.withColumn("place", F.row_number().over(order)).withColumn("own", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    placed = placed.join(small_or_not(before), F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
    return cut(placed.select("doc_id", "source", "size", "hash", "bucket", "place", (F.col("before") + F.coalesce("own", F.lit(0).cast("long"))).alias("start")))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """The mix as (documents, segments).

    documents: doc_id, source, size, source_size, target, taken (words the mix takes from the row,
    repeats counted), first_slot and segments (the first slot that takes from it, or null, and how
    many pieces slots take), a row for each row of docs. segments: slot, doc_id, source, hash (of
    the text), the words [from_word, to_word) of the document that the slot takes, and offset, how
    many words of the slot come before them. ``emit`` makes texts of them.

    Words are runs between ASCII white space; null and blank texts have size 0 and are never taken.
    The null source is a source of its own and the last. Rows of equal or null ids are rows of
    their own. A source without words has target 0; an empty table gives an empty mix. Results
    depend on ids and texts only, not on partitions. Columns other than the named are ignored.
    """
    placed = streams(docs, doc_id, text, source)
    sizes = placed.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = cut(source_targets(sizes, weights, share, repeats))
    named = targets.select("s_ix", F.col("source").alias("t_source"), "source_size", "target")
    rows = placed.join(small_or_not(named), F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    turns = rows.where("size > 0").withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    at = F.col("start") + F.col("turn") * F.col("source_size")
    laid = turns.withColumn("at", at).where(F.col("at") < F.round("target")).withColumn("rank", F.explode(F.sequence(F.floor(F.col("at") / block_words), F.floor((F.col("at") + F.col("size") - 1) / block_words))))
    slots = schedule(targets, block_words)
    begin, end = F.greatest("at", "first_word"), F.least(F.col("at") + F.col("size"), F.col("end_word"))
    pieces = laid.join(slots, ["s_ix", "rank"]).where(end > begin)
    pieces = pieces.select("slot", "s_ix", "doc_id", "source", "hash", "bucket", "place", (begin - F.col("at")).alias("from_word"), (end - F.col("at")).alias("to_word"), (begin - F.col("first_word")).alias("offset"))
    taken = pieces.groupBy("s_ix", "bucket", "place").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"), F.min("slot").alias("first_slot"), F.count("*").alias("segments"))
    none = F.lit(0).cast("long")
    out = rows.join(taken, ["s_ix", "bucket", "place"], "left").select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", none).alias("taken"), "first_slot", F.coalesce("segments", none).alias("segments"))
    return out, pieces.select("slot", "offset", "doc_id", "source", "hash", "from_word", "to_word")


_WORD = re.compile(WORD)


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and their segments -> the segments' texts."""
    for batch in batches:
        for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
            starts, ends = zip(*(m.span() for m in _WORD.finditer(row["text"])), strict=True)
            parts = row["parts"]
            said = [row["text"][starts[p["from_word"]] : ends[p["to_word"] - 1]] for p in parts]
            columns = [pa.array([p[c] for p in parts], pa.int64()) for c in ("slot", "offset", "from_word", "to_word")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([row["doc_id"]] * len(parts), batch.column("doc_id").type), pa.array([row["source"]] * len(parts), batch.column("source").type), pa.array(said, pa.string())], names=["slot", "offset", "from_word", "to_word", "doc_id", "source", "text"])


def emit(docs: DataFrame, segments: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself, to be read by slot and offset: slot, offset, doc_id, source, from_word,
    to_word and text (as in the document, from the first of these words to the last).

    Documents meet their segments by id, source and text hash, in one shuffle. Rows that repeat all
    three share their segments and are read once.
    """
    ids = ("doc_id", "source", "hash")
    parts = segments.groupBy(*[F.col(c).alias(f"p_{c}") for c in ids]).agg(F.sort_array(F.collect_list(F.struct("slot", "offset", "from_word", "to_word"))).alias("parts"))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    again = small_or_not(cut(texts.groupBy(*[F.col(c).alias(f"a_{c}") for c in ids]).count().where("count > 1").drop("count")))
    known = [F.col(c).eqNullSafe(F.col(f"a_{c}")) for c in ids]
    once = texts.join(again, known, "left_anti").unionByName(texts.join(again, known, "left_semi").dropDuplicates(list(ids)))
    met = once.join(parts, [F.col(c).eqNullSafe(F.col(f"p_{c}")) for c in ids]).select("doc_id", "source", "text", "parts")
    kinds = {f.name: f.dataType.simpleString() for f in met.schema}
    return met.mapInArrow(_cut_out, f"slot long, offset long, from_word long, to_word long, doc_id {kinds['doc_id']}, source {kinds['source']}, text string").select("slot", "offset", "doc_id", "source", "from_word", "to_word", "text")


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document, and the slots that take them."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))[0].select("doc_id", "size", "source_size", "target", "taken", "first_slot", "segments")


_SQL = rf"""
WITH r AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT size, md5(coalesce(doc_id::VARCHAR, '')) k FROM documents),
p AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT a FROM r),
s AS (SELECT source, sum(size)::BIGINT source_size FROM r GROUP BY source),
o AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 ix FROM s),
w AS (SELECT *, CAST([{", ".join(map(str, WEIGHTS))}][(ix % {len(WEIGHTS)} + 1)::INT] AS DOUBLE) w, source_size * {float(REPEATS)}::DOUBLE cap FROM o),
f AS (SELECT *, (sum(source_size) OVER () * {SHARE}::DOUBLE - coalesce(sum(cap) OVER z, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER z, 0)) * w > cap AS filled FROM w
      WINDOW z AS (ORDER BY cap / w, ix ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN filled THEN cap ELSE (sum(source_size) OVER () * {SHARE}::DOUBLE - coalesce(sum(cap) FILTER (filled) OVER (), 0)) / (sum(w) OVER () - coalesce(sum(w) FILTER (filled) OVER (), 0)) * w END target FROM f),
b AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 ix, round(target)::BIGINT q, ceil(round(target) / {BLOCK_WORDS})::BIGINT slots,
      CASE WHEN sum(target) OVER () > 0 THEN floor(sum(target) OVER (ORDER BY source NULLS LAST) / sum(target) OVER () * {POINTS})::BIGINT ELSE 0 END hi FROM t),
v AS (SELECT *, coalesce(lag(hi) OVER (ORDER BY ix), 0) lo, sum(slots) OVER ()::BIGINT n FROM b),
y AS (SELECT ix, slot, row_number() OVER (PARTITION BY ix ORDER BY slot) - 1 r FROM (SELECT unnest(range(max(n))) slot FROM v) JOIN v ON slots > 0 AND slot * {GOLDEN} % {POINTS} >= lo AND slot * {GOLDEN} % {POINTS} < hi),
x AS (SELECT ix, slot, r FROM y JOIN v USING (ix) WHERE r < slots UNION ALL
      SELECT ix, n + r * (SELECT max(ix) + 1 FROM v WHERE slots > 0) + ix, r FROM (SELECT v.*, unnest(range((SELECT count(*) FROM y WHERE y.ix = v.ix), slots)) r FROM v)),
e AS (SELECT ix, slot, r * {BLOCK_WORDS} first, least((r + 1) * {BLOCK_WORDS}, q) last FROM x JOIN v USING (ix)),
j AS (SELECT p.doc_id, p.source, p.k, size, source_size, target, ix, a + turn * source_size place FROM p JOIN v ON p.source IS NOT DISTINCT FROM v.source, range({REPEATS}) o(turn))
"""
SQL = f"""{_SQL}, h AS (SELECT j.doc_id, count(*) segments, min(slot) first_slot, sum(least(place + size, last) - greatest(place, first)) taken FROM j JOIN e ON j.ix = e.ix AND first < place + size AND last > place WHERE size > 0 GROUP BY ALL)
SELECT p.doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT taken, first_slot, coalesce(segments, 0)::BIGINT segments
FROM p JOIN v ON p.source IS NOT DISTINCT FROM v.source LEFT JOIN h ON p.doc_id = h.doc_id
"""

#: The mix itself, by slot and offset.
EMIT_SQL = rf"""{_SQL}, said AS (SELECT doc_id, source, regexp_extract_all(text, '{WORD}') m, string_split_regex(text, '{WORD}') g FROM documents),
piece AS (SELECT slot, greatest(place, first) - first AS "offset", j.doc_id, j.source, greatest(place, first) - place from_word, least(place + size, last) - place to_word FROM j JOIN e ON j.ix = e.ix AND first < place + size AND last > place WHERE size > 0)
SELECT slot, "offset", n.doc_id, n.source, from_word, to_word, array_to_string(list_transform(range(from_word + 1, to_word + 1), lambda i: m[i] || CASE WHEN i < to_word THEN g[i + 1] ELSE '' END), '') AS text
FROM piece n JOIN said o ON n.doc_id = o.doc_id AND n.source IS NOT DISTINCT FROM o.source
"""

ship_by_value(__name__)

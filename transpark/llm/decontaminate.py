"""Benchmark decontamination by spaced seeds.

Fixed masks pick some of the tokens in a window and ignore the others, so a window still meets
its counterpart when ignored tokens were replaced. Seeds of documents and benchmark are joined on
their hash; around each diagonal that got a hit the aligned tokens are compared and the best
segment is scored, +1 for an equal token and -4 for another, which holds segments above 80 %.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, small_or_not

#: 1 is a compared token, 0 an ignored one.
MASKS = ("1101101", "11001011", "101100101")
MISMATCH = 4
MIN_SCORE = 12
TOKEN_GAP = r"[^\p{L}\p{N}]+"
MOST_BITS = 1 << 24


def _offsets(mask: str) -> list[int]:
    return [i for i, bit in enumerate(mask) if bit == "1"]


def _token_hashes(text: Column) -> Column:
    return F.transform(F.split(F.lower(F.coalesce(text, F.lit(""))), TOKEN_GAP), lambda w: F.xxhash64(w))


def _seed(tokens: Column, m: int, mask: str, start: Column) -> Column:
    """The hash of a mask's compared tokens, in the window that starts there."""
    return F.xxhash64(F.lit(m), *[F.get(tokens, start + o) for o in _offsets(mask)])


def _seeds(tokens: Column, m: int, mask: str) -> Column:
    """Seed hash of every window of one mask, in order of position; none in shorter texts."""
    last = F.size(tokens) - F.lit(len(mask))
    hashed = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: _seed(tokens, m, mask, i))
    return F.when(last >= 0, hashed).otherwise(F.array().cast("array<bigint>"))


def _pair(a: Column, b: Column) -> Column:
    """A hash of two neighbouring token hashes."""
    return F.shiftrightunsigned(a, 1).bitwiseXOR(b)


def _anchor(mask: str) -> int:
    """Where two neighbouring compared tokens are in a mask; in a mask of one token, that token."""
    return 0 if mask == "1" else mask.index("11")


def _word(p: Column, words: int) -> Column:
    return F.shiftrightunsigned(p, 6).bitwiseAND(F.lit(words - 1).cast("long")).cast("int")


def _bitset(texts: DataFrame, singles: bool) -> tuple[list[int], int]:
    """A bit for each pair of neighbouring tokens of the items (and each token, with ``singles``),
    in 64-bit words; 32 bits a pair, up to MOST_BITS, beyond which more pairs of documents pass."""
    tokens, n = F.col("b_tokens"), F.size("b_tokens")
    pairs = texts.where(n > 1).select(F.explode(F.zip_with(F.slice(tokens, F.lit(1), n - 1), F.slice(tokens, F.lit(2), n - 1), _pair)).alias("p"))
    if singles:
        pairs = pairs.unionByName(texts.where(n == 1).select(_pair(tokens[0], tokens[0]).alias("p")))
    pairs = pairs.distinct()
    words = max(256, min(MOST_BITS, 1 << (32 * pairs.count()).bit_length()) // 64)
    bit = F.expr("shiftleft(1L, CAST(p & 63 AS INT))")
    found = pairs.groupBy(_word(F.col("p"), words).alias("w")).agg(F.bit_or(bit).alias("b")).collect()
    bits = [0] * words
    for r in found:
        bits[r.w] = r.b
    return bits, words


def _candidates(tokens: DataFrame, bits: list[int], words: int, masks: list[str]) -> DataFrame:
    """(d_id, d_start, seed) of the windows whose pair of neighbouring compared tokens may be in an
    item, by the bits; tokens: (d_id, d_tokens). Only these are hashed, not every window."""
    held = F.split(F.lit(",".join(map(str, bits))), ",").cast("array<bigint>")  # folded to a constant

    def there(p: Column, i: Column) -> Column:
        return F.when(F.getbit(F.get(held, _word(p, words)), p.bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1, i)

    column = F.col("d_tokens")
    pairs = F.zip_with(column, F.slice(column, F.lit(2), F.size(column)), _pair)
    places = {"pair": F.array_compact(F.transform(pairs, there))}
    if "1" in masks:
        places["one"] = F.array_compact(F.transform(F.transform(column, lambda t: _pair(t, t)), there))

    def windows(kind: str) -> Column:
        own = [(m, mask) for m, mask in enumerate(masks) if (mask == "1") == (kind == "one")]
        each = lambda i: F.array(*[F.struct(F.lit(len(mask)).alias("n"), (i - _anchor(mask)).alias("start"), _seed(column, m, mask, i - _anchor(mask)).alias("seed")) for m, mask in own])
        return F.flatten(F.transform(F.col(kind), each))

    marked = tokens.select("d_id", "d_tokens", *[p.alias(k) for k, p in places.items()])
    found = marked.select("d_id", F.size("d_tokens").alias("d_n"), F.explode(F.concat(*map(windows, places))).alias("s"))
    return found.where("s.start >= 0 and s.start + s.n <= d_n").select("d_id", F.col("s.start").alias("d_start"), "s.seed")


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    masks: tuple[str, ...] = MASKS,
    min_score: int = MIN_SCORE,
) -> DataFrame:
    """Benchmark items found in documents, one row per pair.

    Returns doc_id, item_id, item_words, seed_hits (seeds on the diagonal that has most), score
    (the best segment's score over the diagonals that got a hit) and equal_words (aligned words that
    are equal, of the diagonal that has most). A pair counts if its score reaches ``min_score``, or
    80 % of the item's words where that is less, or if 80 % of the item's words are equal.

    Tokens are lower-cased runs of letters and digits, so case and punctuation don't matter. Items
    take every mask that fits; those shorter than all masks are found where all of their words
    occur in a row, be it one word. Null and empty texts, and items without a word, are in no pair.
    Repeated items and repeated documents give one row per pair of ids; a null id is an id like
    others. Columns other than the named ones are ignored.
    """
    items = benchmark.select(
        F.col(item_id).alias("b_id"),
        F.filter(F.split(F.lower(F.coalesce(F.col(item_text), F.lit(""))), TOKEN_GAP), lambda w: w != "").alias("b_words"),
    ).where(F.size("b_words") > 0)
    # Items of equal text are searched once.
    texts = items.groupBy("b_words").agg(F.min("b_id").alias("b_any"))
    texts = cut(texts.select(F.xxhash64("b_words", F.size("b_words")).alias("b_key"), F.transform("b_words", lambda w: F.xxhash64(w)).alias("b_tokens")))
    length, shortest = F.size("b_tokens"), min(map(len, masks))
    # Lengths below the shortest mask: a handful at most.
    short = sorted(r[0] for r in texts.where(length < shortest).select(length).distinct().collect())
    every = [*masks, *("1" * n for n in short)]
    seeds = None
    for m, mask in enumerate(every):
        fits = length >= len(mask) if m < len(masks) else length == len(mask)
        own = texts.where(fits).select("b_key", F.posexplode(_seeds(F.col("b_tokens"), m, mask)).alias("b_pos", "seed"))
        seeds = own if seeds is None else seeds.unionByName(own)

    tokens = docs.select(F.col(doc_id).alias("d_id"), _token_hashes(F.col(text)).alias("d_tokens"))
    met = _candidates(tokens, *_bitset(texts, 1 in short), every).join(small_or_not(seeds), "seed").select("d_id", "b_key", (F.col("d_start") - F.col("b_pos")).alias("diagonal"))
    hits = cut(met.groupBy("d_id", "b_key", "diagonal").agg(F.count("*").alias("hits")))

    # Only documents with hits are read and compared again.
    wanted = small_or_not(hits.select(F.col("d_id").alias("w_id")).distinct())
    found = docs.select(F.col(doc_id).alias("d_id"), F.col(text).alias("d_text"))
    found = found.join(wanted, F.col("d_id").eqNullSafe(F.col("w_id")), "left_semi")
    found = found.select(F.col("d_id").alias("f_id"), _token_hashes(F.col("d_text")).alias("d_tokens"))
    # A document's tokens are in one row for each item, however many diagonals they met on.
    lanes = hits.groupBy("d_id", "b_key").agg(F.collect_list(F.struct("diagonal", "hits")).alias("lanes"))
    pairs = found.join(small_or_not(cut(lanes)), F.col("f_id").eqNullSafe(F.col("d_id"))).join(small_or_not(texts), "b_key")
    state = F.struct(F.lit(0).alias("here"), F.lit(0).alias("best"), F.lit(0).alias("equal"))
    none = F.struct(F.lit(0).cast("long").alias("hits"), F.lit(0).alias("best"), F.lit(0).alias("equal"))

    def compared(diagonal: Column) -> Column:
        def step(acc: Column, j: Column) -> Column:
            equal = F.coalesce(F.get(F.col("d_tokens"), j + diagonal) == F.get(F.col("b_tokens"), j), F.lit(False))
            here = F.greatest(acc["here"] + F.when(equal, 1).otherwise(-MISMATCH), F.lit(0))
            return F.struct(here.alias("here"), F.greatest(acc["best"], here).alias("best"), (acc["equal"] + equal.cast("int")).alias("equal"))

        return F.aggregate(F.sequence(F.lit(0), F.size("b_tokens") - 1), state, step)

    def best(acc: Column, lane: Column) -> Column:
        # The inner fold is taken once: a one-element array holds its result for the three fields.
        told = F.transform(F.array(compared(lane["diagonal"])), lambda t: F.struct(F.greatest(acc["hits"], lane["hits"]).alias("hits"), F.greatest(acc["best"], t["best"]).alias("best"), F.greatest(acc["equal"], t["equal"]).alias("equal")))
        return F.get(told, F.lit(0))

    scored = pairs.withColumn("told", F.aggregate("lanes", none, best))
    by_text = scored.groupBy(F.col("d_id").alias("l_id"), "b_key").agg(F.max("told.hits").alias("seed_hits"), F.max("told.best").alias("score"), F.max("told.equal").alias("equal_words"))
    keyed = items.select("b_id", F.size("b_words").alias("item_words"), F.xxhash64("b_words", F.size("b_words")).alias("b_key")).distinct()
    share = F.ceil(F.col("item_words") * 0.8)
    return (
        by_text.join(small_or_not(keyed), "b_key")
        .where((F.col("score") >= F.least(F.lit(min_score), share)) | (F.col("equal_words") >= share))
        .groupBy("l_id", "b_id")
        .agg(*[F.max(c).cast("long").alias(c) for c in ("item_words", "seed_hits", "score", "equal_words")])
        .select(F.col("l_id").alias("doc_id"), F.col("b_id").alias("item_id"), "item_words", "seed_hits", "score", "equal_words")
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Documents in which no benchmark item was found, with all their columns.

    Rows are told apart by id and text, so rows of an equal id, or without one, have their own fate.
    """
    row, leak = fresh(docs, "_row"), fresh(docs, "_leak")
    keyed = docs.withColumn(row, F.struct(F.col(doc_id).alias("id"), F.xxhash64(text).alias("text")))
    leaks = cut(find_leaks(keyed, benchmark, row, text, **options).select(F.col("doc_id").alias(leak)).distinct())
    return keyed.join(small_or_not(leaks), F.col(row).eqNullSafe(F.col(leak)), "left_anti").drop(row)


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Benchmark items in the documents."""
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _seed_sql(mask: str, words: str) -> str:
    picked = " || ' ' || ".join(f"{words}[i + {o}]" for o in _offsets(mask))
    return f"'{mask}' || ' ' || {picked}"


SHORTEST = min(map(len, MASKS))
ALL_MASKS = [(m, f">= {len(m)}") for m in MASKS] + [("1" * n, f"= {n}") for n in range(1, SHORTEST)]
SQL = (
    rf"""
WITH d AS (SELECT doc_id, string_split_regex(lower(coalesce(text, '')), '{TOKEN_GAP}') w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '{TOKEN_GAP}'), lambda x: x <> '') v FROM benchmark),
bi AS (SELECT * FROM b WHERE len(v) > 0),
bs AS ("""
    + " UNION ALL ".join(f"SELECT item_id, i, {_seed_sql(m, 'v')} s FROM (SELECT item_id, v, unnest(range(1, len(v) - {len(m)} + 2)) i FROM bi WHERE len(v) {fit})" for m, fit in ALL_MASKS)
    + "), ds AS ("
    + " UNION ALL ".join(f"SELECT doc_id, i, {_seed_sql(m, 'w')} s FROM (SELECT doc_id, w, unnest(range(1, len(w) - {len(m)} + 2)) i FROM d WHERE EXISTS (FROM bi WHERE len(v) {fit}))" for m, fit in ALL_MASKS)
    + f"""),
h AS (SELECT doc_id, item_id, ds.i - bs.i g, count(*) hits FROM ds JOIN bs USING (s) GROUP BY ALL),
c AS (SELECT h.*, len(v) n, j, CASE WHEN j + g >= 1 AND w[j + g] = v[j] THEN 1 ELSE -{MISMATCH} END x
      FROM h JOIN d USING (doc_id) JOIN bi USING (item_id), unnest(range(1, len(v) + 1)) t(j)),
p AS (SELECT *, sum(x) OVER z z, sum(CASE WHEN x = 1 THEN 1 ELSE 0 END) OVER z y FROM c WINDOW z AS (PARTITION BY doc_id, item_id, g ORDER BY j)),
q AS (SELECT *, z - least(0, coalesce(min(z) OVER (PARTITION BY doc_id, item_id, g ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) e FROM p)
SELECT doc_id, item_id, max(n)::BIGINT item_words, max(hits)::BIGINT seed_hits, max(greatest(e, 0))::BIGINT score, max(y)::BIGINT equal_words
FROM q GROUP BY doc_id, item_id HAVING max(e) >= least({MIN_SCORE}, ceil(max(n) * 0.8)) OR max(y) >= ceil(max(n) * 0.8)
"""
)

"""Spelling variants: words one edit apart, by bands of a letter-parity mask.

A word's mask has a bit for each class of letters, which tells whether the word has an odd number of
them. One insertion or deletion flips one bit, one replacement at most two; so of three bands that the
mask is split into, one at least is equal after a replacement, and two after an insertion. An edit
also leaves the first or the second half of the shorter word as it is. Words meet where a band, that
half and the length (less one for the longer word) are equal, and pairs are verified.

The half keeps buckets from growing with the square of the vocabulary; without it a band alone has
a few hundred values.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, ship_by_value, stored

#: Letters of words, from frequent to rare; the order spreads frequent ones over bands.
LETTERS = "etaoinshrdlucmfwypvbgkjqxz" + "".join(map(chr, range(0xC0, 0x100)))
RUN = re.compile(r"[a-zÀ-ÿ]+")
CLASSES, BANDS = 63, 3
LEAST_LETTERS, LEAST_COUNT, MORE = 5, 3, 2
TYPO = 97
#: Words that a task adds up before it passes them on.
FLUSH = 300_000


def _counted(least: int, typo: int):
    """Documents (id as text, text) -> words and how often they occur, summed within the task."""
    run = re.compile(RUN.pattern[:-1] + f"{{{least},}}")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1), strict=True):
                text, lead = t.as_py(), f"{i.as_py() or ''}:"
                if not text:
                    continue
                # Only A-Z change in UTF-8 bytes that are lower-cased.
                for word, n in Counter(run.findall(text.encode().lower().decode())).items():
                    if typo:
                        h = zlib.crc32((lead + word).encode())
                        if h % typo == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least:
                                continue
                    found[word] += n
                if len(found) >= FLUSH:
                    yield rows()
                    found.clear()
        if found:
            yield rows()

    return kernel


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, typo: int = TYPO) -> DataFrame:
    """(word, n) of runs of letters with at least ``least`` letters and ``least_count`` occurrences.

    Runs are of A-Z, a-z and U+00C0 to U+00FF, of which A-Z are lower-cased. Where ``typo`` divides
    the crc32 of ``id:run``, the run loses the letter at that crc32 modulo its length (0: none does).
    Null texts have no words, a null id is empty in the checksum.
    """
    rows = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"))
    counts = rows.mapInArrow(_counted(least, typo), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def letter_mask(word: Column) -> Column:
    """A bit for each class of letters: whether the word has an odd number of them."""
    one = F.lit(1).cast("long")
    bits = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.call_function("shiftleft", one, F.pmod(F.position(F.substr(word, i, F.lit(1)), F.lit(LETTERS)), F.lit(CLASSES)).cast("int")))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseXOR(b))


def _band(mask: Column, band: int) -> Column:
    return mask.bitwiseAND(F.lit(sum(1 << c for c in range(CLASSES) if c % BANDS == band)).cast("long"))


def _keys(word: Column, mask: Column, length: Column, bands: int) -> list[Column]:
    """A key for each band and half; halves are those of a word of ``length`` letters."""
    half = F.floor(length / 2).cast("int")
    sides = (F.left(word, half), F.right(word, length - half))
    return [F.xxhash64(F.lit(2 * b + s), _band(mask, b), side, length) for b in range(bands) for s, side in enumerate(sides)]


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n), a row for each direction, of distinct words (word, n) that differ by
    exactly one inserted, deleted or replaced letter. Empty words and those of other letters may be
    in ``words``: letters that aren't known share a class."""
    word, length = F.col("word"), F.length("word")
    masked = words.select("word", "n", letter_mask(word).alias("mask"))
    own = _keys(word, F.col("mask"), length, BANDS)
    # Of the three bands two are equal after an insertion: any two of them tell it.
    longer = _keys(word, F.col("mask"), length - 1, BANDS - 1)
    index = masked.select(F.explode(F.array(*own)).alias("key"), word.alias("a"), F.col("n").alias("a_n"))
    asked = F.concat(F.transform(F.array(*own), lambda k: F.struct(k.alias("key"), F.lit(False).alias("longer"))), F.when(length > 0, F.transform(F.array(*longer), lambda k: F.struct(k.alias("key"), F.lit(True).alias("longer")))).otherwise(F.array().cast("array<struct<key:bigint,longer:boolean>>")))
    probes = masked.select(F.inline(asked), word.alias("b"), F.col("n").alias("b_n"))
    met = index.join(probes, "key").where((F.length("b") - F.length("a") == F.col("longer").cast("int")) & (F.col("longer") | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
    pairs = met.select("a", "a_n", "b", "b_n").distinct()
    there = F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n"))
    back = F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    return pairs.select(F.inline(F.array(there, back)))


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last word of each chain of forms, by pointer jumping. A
    form is more frequent than its word, so there is no circle and chains are short."""
    up = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        above = up.select(F.col("word").alias("w_"), F.col("root").alias("r_"))
        higher = cut(up.join(above, up["root"] == above["w_"], "left").select("word", F.coalesce("r_", "root").alias("root"), F.col("r_").isNotNull().alias("moved")))
        up = higher.select("word", "root")
        if higher.where("moved").isEmpty():
            return up


def group_variants(words: DataFrame, more: float = MORE) -> DataFrame:
    """Words (word, n), each once, with their spelling: word, form, root, n, n_near, form_n.

    A word's form is its near word of the largest n (of equal ones the first by code points) if that
    is at least ``more`` times the word's, otherwise null; ``more`` must be above 1. root: the last
    form that following forms leads to, the word itself without one. An empty table gives an empty
    result; rows without a word are left out, other columns are ignored.
    """
    if more <= 1:
        raise ValueError("a form must be more frequent than its word")
    words = stored(words.select("word", F.col("n").cast("long").alias("n")).where("word is not null"), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_words(words).groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    strong = -F.col("best.less") >= F.col("n") * more
    near = cut(near.select("word", "n_near", F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n")))
    roots = follow(near.where("form is not null"))
    full = words.join(near, "word", "left").join(roots, "word", "left")
    return full.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def op12_spelling(spark, sf_dir: str) -> DataFrame:
    """Spelling variants of the documents' words."""
    return group_variants(count_words(spark.read.parquet(f"{sf_dir}/documents.parquet")))


#: The checksum of `id:run`, byte by byte through a table; words; pairs that are equal once a letter is
#: left out of one or of both; roots by a recursive query.
SQL = rf"""
WITH RECURSIVE t AS (SELECT list(list_reduce(list_prepend(b, range(8)), lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY b) tab FROM range(256) r(b)),
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{00C0}}-\x{{00FF}}]+')) w FROM documents),
g AS (SELECT w, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) x, count(*) n FROM r WHERE length(w) >= {LEAST_LETTERS} GROUP BY doc_id, w),
h AS (SELECT w, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)), lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)])), 4294967295) h FROM g, t),
c AS (SELECT CASE WHEN h % {TYPO} = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END word, sum(n)::BIGINT n FROM h GROUP BY 1 HAVING sum(n) >= {LEAST_COUNT} AND length(word) >= {LEAST_LETTERS}),
d AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) s FROM c, unnest(range(1, length(word) + 1)) u(i)),
p AS (SELECT DISTINCT a.word w, b.word v, b.n m FROM d a JOIN d b ON a.s = b.s AND a.i = b.i AND a.word <> b.word
      UNION SELECT d.word, c.word, c.n FROM d JOIN c ON d.s = c.word UNION SELECT c.word, d.word, d.n FROM d JOIN c ON d.s = c.word),
b AS (SELECT c.word, c.n, count(v) n_near, arg_min(v, (-m, v)) v, max(m) m FROM c LEFT JOIN p ON c.word = p.w GROUP BY ALL),
f AS (SELECT word, n, n_near, CASE WHEN m >= {MORE} * n THEN v END form, CASE WHEN m >= {MORE} * n THEN m END form_n FROM b),
z AS (SELECT word, word top FROM f UNION ALL SELECT z.word, f.form FROM z JOIN f ON z.top = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, z.top root, f.n, f.n_near, f.form_n FROM f JOIN z USING (word) JOIN f e ON e.word = z.top AND e.form IS NULL
"""

ship_by_value(__name__)

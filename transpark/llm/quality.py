"""Quality rules as a ledger of bit masks.

Every rule is evaluated once; the ledger keeps the measurements and, for each document, a mask of
the rules it fails. Policies are versioned masks, applied to the ledger without reading texts
again, and ablations are bitwise aggregations over it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import hash_words, mix64, ship_by_value

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = regex.compile(r"\p{Lu}+")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper")

#: Rule name -> condition of failure over the measurements; the bit is the position. Rules are only
#: ever appended, so that old ledgers stay readable.
RULES = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 10 * word_chars",
    "duplicate_lines": "100 * n_dup_lines > 30 * n_lines",
    "long_words": "word_chars > 25 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "shouting": "100 * n_upper > 50 * word_chars",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_windows"]
#: Versioned policies: the rules whose failure rejects.
POLICIES = {"base-1": BASE, "2024-1": sum(BIT.values())}
#: Of documents labelled good, repeated lines reject ten for one bad document: the rule no longer counts.
POLICIES["2024-2"] = POLICIES["2024-1"] & ~BIT["duplicate_lines"]
POLICY = "2024-2"


def _repeated(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    h = hash_words(words)
    c = np.uint64(0x9E3779B97F4A7C15)
    w = mix64(mix64(mix64(h[: n - 2]) * c + h[1 : n - 1]) * c + h[2:])
    order = np.sort(w)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return 0
    at = np.minimum(np.searchsorted(twice, w), len(twice) - 1)
    hit = twice[at] == w
    covered = np.zeros(n, bool)
    for j in range(3):
        covered[j : n - 2 + j] |= hit
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES; null is empty."""
    text = text or ""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    chars = len(text) - sum(map(text.count, BLANKS))
    upper = sum(map(len, UPPER.findall(text)))
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines), len(lines) - len(set(lines)), _repeated(words), upper


def _measured(texts: pa.Array) -> list[pa.Array]:
    rows = [measure(t.as_py()) for t in texts]
    return [pa.array(x, pa.int64()) for x in (zip(*rows, strict=True) if rows else [[]] * len(MEASURES))]


def _kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), *_measured(batch.column(1))], names=["doc_id", *MEASURES])


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: dict[str, str] = RULES) -> DataFrame:
    """One row per document: doc_id, the measurements and ``fails``, the mask of failed rules.

    Words are runs between ASCII white space, lines are split at line feeds and count if they have
    a word. A null text is empty: it has no words and fails ``few_words``. Rows of equal or null
    ids keep rows of their own; very long texts are measured whole; other columns are ignored.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{m} long" for m in MEASURES)
    measured = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(_kernel, schema)
    return measured.withColumn("fails", failure_mask(rules))


def failure_mask(rules: dict[str, str] = RULES) -> Column:
    """The mask of failed rules, over the measurements."""
    fails = F.lit(0).cast("long")
    for i, condition in enumerate(rules.values()):
        fails = fails.bitwiseOR(F.when(F.expr(condition), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return fails


def apply_policy(entries: DataFrame, policy: str = POLICY) -> DataFrame:
    """The ledger with ``kept``: none of the policy's rules failed."""
    return entries.withColumn("kept", F.col("fails").bitwiseAND(F.lit(POLICIES[policy]).cast("long")) == 0)


def sole_rule(policy: str = POLICY) -> Column:
    """The only rule of a policy that a document fails, without which it would be kept; else null."""
    held = F.col("fails").bitwiseAND(F.lit(POLICIES[policy]).cast("long"))
    return F.coalesce(*[F.when(held == BIT[n], n) for n in RULES if BIT[n] & POLICIES[policy]])


def ablations(entries: DataFrame, policy: str = POLICY) -> DataFrame:
    """What each rule of a policy rejects: rule, failing, and rescued (kept if that rule were gone)."""
    mask = POLICIES[policy]
    held = F.col("fails").bitwiseAND(F.lit(mask).cast("long"))
    masks = entries.select(held.alias("held")).groupBy("held").count()
    rules = [F.struct(F.lit(n).alias("rule"), F.lit(BIT[n]).cast("long").alias("bit")) for n in RULES if BIT[n] & mask]
    each = masks.select("held", "count", F.explode(F.array(*rules)).alias("r"))
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("held").bitwiseAND(F.col("r.bit")) != 0, F.col("count")).otherwise(0)).alias("failing"),
        F.sum(F.when(F.col("held") == F.col("r.bit"), F.col("count")).otherwise(0)).alias("rescued"),
    )


def keep_good(docs: DataFrame, text: str = "text", policy: str = POLICY) -> DataFrame:
    """The rows that a policy keeps, unchanged: a ledger that carries the rows, under the policy's mask.

    Each row is judged by its own text, so rows of equal or null ids have their own fate.
    """
    names = docs.columns

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _measured(batch.column(names.index(text)))
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(batch.columns, names=names), pa.StructArray.from_arrays(found, names=list(MEASURES))], names=["row", "m"])

    schema = StructType([StructField("row", docs.schema), StructField("m", StructType([StructField(m, LongType()) for m in MEASURES]))])
    entries = docs.mapInArrow(judged, schema).select("row", "m.*").withColumn("fails", failure_mask())
    return apply_policy(entries, policy).where("kept").select("row.*")


def op9_quality(spark, sf_dir: str) -> DataFrame:
    """The quality ledger of the documents under the current policy."""
    judged = apply_policy(ledger(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    failed = F.col("fails").bitwiseAND(F.lit(BASE).cast("long")) != 0
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept"), "fails", sole_rule().alias("sole_rule"))


W = r"'[^\x20\x09-\x0D]+'"
SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, {W}) w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {W})) l FROM t),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) n FROM (SELECT doc_id, i, w[i] a, w[i + 1] b, w[i + 2] c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) i FROM w))),
r AS (SELECT doc_id, count(DISTINCT i + j) n FROM g, range(0, 3) o(j) WHERE g.n > 1 GROUP BY doc_id),
m AS (SELECT w.doc_id, len(w)::BIGINT n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT word_chars, length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT n_symbols,
  len(l)::BIGINT n_lines, (len(l) - len(list_distinct(l)))::BIGINT n_dup_lines, coalesce(r.n, 0)::BIGINT n_repeat_words, length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g'))::BIGINT n_upper FROM w LEFT JOIN r USING (doc_id)),
f AS (SELECT *, {" + ".join(f"(CASE WHEN {c} THEN {1 << i} ELSE 0 END)" for i, c in enumerate(RULES.values()))} f FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (f & {BASE}) <> 0 base_failed, (f & {POLICIES[POLICY] | BASE}) = 0 kept, f::BIGINT fails,
  CASE f & {POLICIES[POLICY]} {" ".join(f"WHEN {BIT[n]} THEN '{n}'" for n in RULES if BIT[n] & POLICIES[POLICY])} END sole_rule FROM f
"""

ship_by_value(__name__)

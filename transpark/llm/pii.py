"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

The base kinds (email, ip, card, phone) follow fixed patterns and are always reported once their
validator passes; further kinds (iban, ssn, secret) are reported if their score reaches a threshold.
Secrets are keys of known form and values that a name such as token or password is set to; these
must be as random as keys are.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import ship_by_value

#: Kinds in their order, and the patterns of the base ones.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "secret")
BASE_KINDS = KINDS[:4]
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
#: A key of known form, or a value of 16 characters and more that a telling name is set to.
KEY = re.compile(r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,})(?![A-Za-z0-9])")
PRIVATE = re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]*-----END [A-Z ]{0,40}PRIVATE KEY-----)?")
ASSIGNED = re.compile(r"(?i)(?:token|secret|api[_-]?key|access[_-]?key|passw(?:or)?d|auth)[\"']?\x20{0,3}[:=]\x20{0,3}[\"']?([A-Za-z0-9_+/=.-]{16,})")
RANDOM_BITS = 2.5
DIGIT = re.compile(r"[0-9]")
SPARE = re.compile(r"[^0-9]+")
#: Words within WINDOW characters before a span that speak for its kind.
CONTEXT = {
    "email": ("mail", "contact"),
    "ip": ("ip", "address", "server", "host"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto"),
    "ssn": ("ssn", "social", "security"),
    "secret": ("token", "secret", "key", "password", "auth"),
}
WINDOW, THRESHOLD = 40, 0.5
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.3, "secret": 0.6}
BONUS = 0.2
SPANS = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"


def luhn(digits: str) -> bool:
    """Whether the last digit is the Luhn check digit of the others."""
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def mod97(code: str) -> bool:
    """Whether an IBAN's letters and digits pass the mod-97 test."""
    code = code.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def as_random_as_a_key(value: str) -> bool:
    """Whether a value has digits and letters and RANDOM_BITS of entropy a character."""
    n = len(value)
    bits = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    return bits >= RANDOM_BITS and any(c.isdigit() for c in value) and any(c.isalpha() for c in value)


def _secrets(text: str) -> Iterator[tuple[int, int]]:
    """Keys of known form, and assigned values that look random; none inside another."""
    found = [m.span() for p in (KEY, PRIVATE) for m in p.finditer(text)]
    if "=" in text or ":" in text:
        found += [m.span(1) for m in ASSIGNED.finditer(text) if as_random_as_a_key(m[1])]
    last = 0
    for start, end in sorted(found, key=lambda s: (s[0], -s[1])):
        if start >= last:
            yield start, end
            last = end


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@...``, found from the @ so that long runs cost once."""
    last = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            last = m.end()


def _octet(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) < 3 or len(digits) == 3 and int(digits) <= 255


def _proposals(text: str) -> Iterator[tuple[str, int, int]]:
    if "@" in text:
        yield from (("email", *m) for m in _emails(text))
    if "PRIVATE KEY-----" in text or "AKIA" in text or DIGIT.search(text):
        yield from (("secret", *m) for m in _secrets(text))
    if not DIGIT.search(text):
        return
    if "." in text:
        yield from (("ip", *m.span()) for m in IP.finditer(text) if all(map(_octet, m[0].split("."))))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := SPARE.sub("", m[0])) <= 19 and luhn(d):
            yield "card", *m.span()
    if "+" in text:
        yield from (("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(SPARE.sub("", m[0])) <= 15)
    yield from (("iban", *m.span()) for m in IBAN.finditer(text) if mod97(m[0]))
    if "-" in text:
        yield from (("ssn", *m.span()) for m in SSN.finditer(text))


def find_spans(text: str | None) -> list[tuple[str, int, int, float, bool]]:
    """Spans (kind, start, end, score, base) by start, then kind; code points, end exclusive."""
    text = text or ""
    out = []
    for kind, start, end in _proposals(text):
        before = text[max(0, start - WINDOW) : start].lower()
        score = min(1.0, PRIOR[kind] + BONUS * any(w in before for w in CONTEXT[kind]))
        if kind in BASE_KINDS or score >= THRESHOLD:
            out.append((kind, start, end, score, kind in BASE_KINDS))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def redact_text(text: str | None) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans are one."""
    if text is None:
        return None
    out, at, last = [], 0, 0
    for kind, start, end, _, _ in find_spans(text):
        if start >= last:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = last = max(last, end)
    return "".join(out) + text[at:] if out else text


def _span_array(texts: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("base", pa.bool_())]))
    names = ("kind", "start", "end", "score", "base")
    return pa.array([[dict(zip(names, s, strict=True)) for s in find_spans(t.as_py())] for t in texts], kind)


def find_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``spans`` (kind, start, end, score, base) of every row.

    A null text is empty and has no spans. Rows of equal or null ids keep rows of their own, long
    texts are searched whole, other columns are ignored.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _span_array(batch.column(1))], names=["doc_id", "spans"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(kernel, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, spans {SPANS}")


def redact(docs: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """The rows with personal data replaced in ``text``; ``length`` names a column to hold its new
    number of code points. Null texts stay null, other columns as they are."""
    names = docs.columns
    at = names.index(text)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = pa.array([redact_text(t.as_py()) for t in batch.column(at)], pa.string())
            columns = [clean if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = StructType([StructField(f.name, f.dataType) for f in docs.schema])
    out = docs.mapInArrow(kernel, schema)
    return out.withColumn(length, F.length(text).cast(docs.schema[length].dataType)) if length in names else out


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op8_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data in the documents."""
    found = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, lambda s: s == F.lit(k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]  # noqa: B023
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def _found_sql(place: int, pattern: str, valid: str, group: int = 0) -> str:
    """Matches with their starts: what splitting leaves between them tells where they are."""
    text = pattern.replace("'", "''")
    start = "list_sum(list_transform(g[1:k], lambda x: length(x)))::BIGINT + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0)::BIGINT"
    return f"""SELECT doc_id, {place} place, '{KINDS[place]}' kind, s + length(whole) - length(w) s, w FROM (
      SELECT doc_id, {start} s, m[k] whole, v[k] w FROM (
        SELECT doc_id, m, v, g, unnest(range(1, len(m) + 1)) k FROM (
          SELECT doc_id, regexp_extract_all(t, '{text}') m, regexp_extract_all(t, '{text}', {group}) v, string_split_regex(t, '{text}') g FROM d))) WHERE {valid}"""


_DIGITS = "regexp_replace(w, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN ascii({_DIGITS}[-i]) - 48 ELSE (ascii({_DIGITS}[-i]) - 48) * 2 // 10 + (ascii({_DIGITS}[-i]) - 48) * 2 % 10 END)) % 10 = 0"
_OCTETS = "list_bool_and(list_transform(string_split(w, '.'), lambda x: length(ltrim(x, '0')) < 4 AND coalesce(TRY_CAST(ltrim(x, '0') AS INT), 0) < 256))"
#: States the base kinds and assigned secrets. IBANs, social security numbers and keys of known form
#: (patterns that look around) are left to the tests; a table that has any differs in ``spans``.
SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') t FROM documents),
f AS (
{_found_sql(0, "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+([.][A-Za-z0-9-]+)+", "true")} UNION ALL
{_found_sql(1, "[0-9]+([.][0-9]+)([.][0-9]+)([.][0-9]+)", _OCTETS)} UNION ALL
{_found_sql(2, "[0-9]([ -]?[0-9])+", f"length({_DIGITS}) BETWEEN 12 AND 19 AND {_LUHN}")} UNION ALL
{_found_sql(3, "[+][0-9][ ().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15")} UNION ALL
{_found_sql(6, ASSIGNED.pattern, f"list_entropy(string_split(w, '')) >= {RANDOM_BITS} AND regexp_matches(w, '[0-9]') AND regexp_matches(w, '[A-Za-z]')", 1)}),
l AS (SELECT *, kind || ':' || s || ':' || (s + length(w)) x FROM f)
SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') n_{k}" for k in BASE_KINDS)},
  sha256(coalesce(string_agg(x, ',' ORDER BY s, place) FILTER (place < 4), '')) base_sha256, coalesce(string_agg(x, ',' ORDER BY s, place), '') spans
FROM d LEFT JOIN l USING (doc_id) GROUP BY doc_id
"""

#: doc_id and the text with each span replaced; overlapping spans are one.
REDACT_SQL = f"""
WITH f AS (SELECT doc_id, text t, spans FROM documents JOIN ({SQL}) USING (doc_id)),
s AS (SELECT doc_id, t, list_transform(list_filter(string_split(spans, ','), lambda x: x <> ''), lambda x: {{'k': upper(split_part(x, ':', 1)), 's': split_part(x, ':', 2)::BIGINT, 'e': split_part(x, ':', 3)::BIGINT, 'o': '', 'z': 0::BIGINT}}) x FROM f),
r AS (SELECT doc_id, t, list_reduce(list_prepend({{'k': '', 's': 0::BIGINT, 'e': 0::BIGINT, 'o': '', 'z': 0::BIGINT}}, x),
  lambda a, y: {{'k': '', 's': 0::BIGINT, 'e': 0::BIGINT, 'o': a['o'] || CASE WHEN y['s'] >= a['z'] THEN substr(t, a['z'] + 1, y['s'] - a['z']) || '[' || y['k'] || ']' ELSE '' END, 'z': greatest(a['z'], y['e'])}}) a FROM s)
SELECT doc_id, CASE WHEN a['z'] = 0 THEN t ELSE a['o'] || substr(t, a['z'] + 1) END AS text FROM r
"""

ship_by_value(__name__)

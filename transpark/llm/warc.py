"""WARC archives: written by Spark's text sink, read back by boundary-chain verification.

A record ends with two line ends, which is the text sink's separator, so archives are ordinary
splittable files. Reading splits at the magic line: every occurrence is a candidate, with the
offset of its successor from its own header. From the start of each file pointers are followed by
jumping, and only reached candidates are records; magic inside a payload is never reached. Runs of
candidates that follow each other are contracted before the jumps.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, shared_path, ship_by_value, small_or_not

#: Fixed values of the format.
MAGIC, END = "WARC/1.1\r\n", "\r\n\r\n"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html;charset=utf-8\r\nContent-Length: "
DATE = "2024-01-01T00:00:00Z"
MIN_BYTES = 0
#: Bytes of a file whose candidates are put in order together.
STRETCH = 1 << 26


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: each 5 hex digits are 4 base32 digits."""
    digits = F.sha1(payload)
    letters = []
    for g in range(8):
        value = F.conv(F.substring(digits, 5 * g + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(ALPHABET), F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*letters)


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = MIN_BYTES) -> None:
    """Write a record for every row to archives at ``path``, one file for each task.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with the smallest id is
    the response and others revisit it (rows that share that smallest id are all responses, and so
    are rows without an id). A null payload is empty; a null url has no target line; control
    characters and spaces in urls are percent-encoded. Other columns are ignored.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "digest": base32_sha1(F.col("payload"))})
    groups = rows.where(F.col("size") >= min_bytes).groupBy(F.col("digest").alias("g_digest")).agg(F.count("*").alias("n"), F.min("id").alias("first"))
    groups = cut(groups.where("n > 1").select("g_digest", "first"))
    told = rows.join(small_or_not(groups), F.col("digest") == F.col("g_digest"), "left")
    revisit = (F.col("size") >= min_bytes) & F.col("first").isNotNull() & F.col("id").isNotNull() & (F.col("id") != F.col("first"))
    target = F.col("url")
    for code in [*range(33), 127]:
        target = F.replace(target, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    head = F.concat(
        F.when(revisit, "WARC-Type: revisit\r\n").otherwise("WARC-Type: response\r\n"),
        _line("WARC-Record-ID", _urn(F.col("id"))),
        _line("WARC-Date", F.lit(DATE)),
        F.coalesce(_line("WARC-Target-URI", target), F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("WARC-Payload-Length", F.col("size").cast("string")),
        F.when(revisit, F.concat(_line("WARC-Refers-To", _urn(F.col("first"))), _line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
    )
    http = F.concat(F.lit(HTTP), F.col("size").cast("string"), F.lit(END))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    record = F.concat(F.lit(MAGIC), head, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END), block)
    told.select(record.alias("value")).write.option("lineSep", END).option("compression", "none").text(path)


def _header(name: str) -> Column:
    found = F.regexp_extract(F.concat(F.lit("\r\n"), F.col("head")), rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)


def _payload(block: Column) -> Column:
    """What follows the HTTP head of a block (binary)."""
    skip = F.octet_length(F.substring_index(block.cast("string"), END, 1)) + len(END)
    return F.substring(block, skip + 1, F.octet_length(block))


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """The stretches between magic lines, with file, block and an order within the block."""
    read = spark.read.option("lineSep", MAGIC).text(path)
    return read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth"), "value")


def _last_before(rows: DataFrame, value: Column, name: str, also_own: bool) -> DataFrame:
    """Adds the last non-null value of the rows before each one in its file (or of its own), in two
    levels: within stretches of STRETCH bytes, and between these, so no file is one task's."""
    rows = rows.withColumn("_v", value).withColumn("_s", F.floor(F.col("start") / STRETCH))
    ends = rows.groupBy("file", "_s").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("start"))).alias("_e"))
    earlier = Window.partitionBy("file").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("file", "_s", F.last("_e", ignorenulls=True).over(earlier).alias("_e"))
    within = Window.partitionBy("file", "_s").orderBy("start").rowsBetween(Window.unboundedPreceding, 0 if also_own else -1)
    own = rows.withColumn(name, F.last("_v", ignorenulls=True).over(within))
    return own.join(ends, ["file", "_s"]).withColumn(name, F.coalesce(name, "_e")).drop("_v", "_s", "_e")


def reachable(candidates: DataFrame) -> DataFrame:
    """(file, start) of the candidates (file, start, next) on the chain from offset 0 of each file."""
    near = _last_before(candidates, F.struct("start", "next"), "prior", also_own=False)
    # A run starts where the candidate before doesn't lead here, or where another one leads here.
    from_prior = F.coalesce(F.col("prior.next") == F.col("start"), F.lit(False))
    follow = near.select("file", F.col("prior.start").alias("from")).where(from_prior)
    others = candidates.where("next is not null").join(follow, (candidates["file"] == follow["file"]) & (candidates["start"] == follow["from"]), "left_anti")
    leaps = others.select("file", F.col("next").alias("start")).distinct().withColumn("entered", F.lit(True))
    marked = near.withColumn("joins", from_prior).drop("prior").join(leaps, ["file", "start"], "left")
    head = F.when(F.col("joins") & F.col("entered").isNull(), F.lit(None)).otherwise(F.col("start"))
    runs = cut(_last_before(marked, head, "head", also_own=True).select("file", "start", "next", "head"))
    jump = cut(runs.groupBy("file", "head").agg(F.max_by("next", "start").alias("next")))
    most = jump.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    reached, jump = jump.where("head = 0").select("file", "head"), jump.where("next is not null")
    for _ in range(max(0, most - 1).bit_length()):
        more = reached.join(jump, ["file", "head"]).select("file", F.col("next").alias("head"))
        reached = cut(reached.unionByName(more))
        jump = cut(jump.join(jump.select("file", F.col("head").alias("next"), F.col("next").alias("beyond")), ["file", "next"]).select("file", "head", F.col("beyond").alias("next")))
    return runs.join(reached, ["file", "head"], "left_semi").select("file", "start")


def _block(value: str, skipped: int) -> Column:
    return F.substring(F.col(value).cast("binary"), F.col("body").cast("int") + skipped + 1, F.col("length").cast("int"))


def _verified(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """All chunks with their offsets, and those that start a record, with its header fields."""
    rows = _chunks(spark, path).withColumn("head", F.substring_index("value", END, 1)).withColumn("size", F.octet_length("value").cast("long"))
    rows = rows.withColumn("length", F.expr("try_cast(regexp_extract(concat('\\r\\n', head), '(?i)\\r\\nContent-Length:[ \\t]*([0-9]+)', 1) AS BIGINT)"))
    rows = rows.withColumn("body", F.octet_length("head").cast("long") + len(END))
    whole = F.coalesce(F.col("body") + F.col("length") + len(END) == F.col("size"), F.lit(False))
    # A chunk that is one whole record says its payload's digest right here.
    parts = rows.withColumn("whole", whole).withColumn("payload", F.when(whole, _payload(_block("value", 0))))
    held = ["file", "block", "nth", "size", "length", "body", "whole", F.when(F.col("length").isNotNull(), F.col("head")).alias("head")]
    parts = cut(parts.select(*held, F.when(F.col("whole"), base32_sha1(F.col("payload"))).alias("read_digest"), F.octet_length("payload").cast("long").alias("read_bytes")))
    step = F.col("size") + len(MAGIC)
    zero = F.lit(0).cast("long")
    order = Window.partitionBy("file", "block").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("own", F.coalesce(F.sum(step).over(order), zero)).join(_before_blocks(parts.select("file", "block", step.alias("step"))), ["file", "block"])
    placed = placed.withColumn("start", F.col("before") + F.col("own") - len(MAGIC))
    placed = cut(placed.where("start >= 0").withColumn("next", F.col("start") + len(MAGIC) + F.col("body") + F.col("length") + len(END)).drop("before", "own", "block", "nth"))
    records = placed.join(reachable(placed.select("file", "start", "next")), ["file", "start"], "left_semi")
    told = records.withColumns({
        "page": F.regexp_extract(_header("WARC-Record-ID"), "^<urn:page:(.*)>$", 1),
        "target": _header("WARC-Target-URI"),
        "record_type": _header("WARC-Type"),
        "stated_digest": F.regexp_extract(_header("WARC-Payload-Digest"), "^sha1:(.*)$", 1),
        "stated_bytes": _header("WARC-Payload-Length").try_cast("long"),
        "refers_to": F.regexp_extract(_header("WARC-Refers-To"), "^<urn:page:(.*)>$", 1),
    })
    return placed, cut(told.drop("head", "size"))


def _before_blocks(steps: DataFrame) -> DataFrame:
    """(file, block, before): the bytes of a file's blocks before each one; steps: (file, block, step)."""
    blocks = steps.groupBy("file", "block").agg(F.sum("step").alias("in_block"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select("file", "block", F.coalesce(F.sum("in_block").over(earlier), F.lit(0).cast("long")).alias("before"))


def _within_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks (file, block, value) in a task's order -> with the bytes of the block's chunks before."""
    block, own = None, 0
    for batch in batches:
        sizes = [x + len(MAGIC) for x in pc.binary_length(batch.column(2)).to_pylist()]
        before = []
        for key, size in zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), sizes, strict=True):
            if key != block:
                block, own = key, 0
            before.append(own)
            own += size
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(before, pa.int64()), batch.column(2)], names=["file", "block", "own", "value"])


def _placed_values(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, value) of all chunks: a read of its own, that derives offsets by itself."""
    chunks = _chunks(spark, path).drop("nth")
    before = _before_blocks(chunks.select("file", "block", (F.octet_length("value").cast("long") + len(MAGIC)).alias("step")))
    placed = chunks.mapInArrow(_within_blocks, "file string, block long, own long, value string")
    # A block that the sums don't have was split in another way: this then fails rather than lose it.
    known = F.coalesce("before", F.raise_error(F.concat(F.lit("splits changed while reading "), "file")).cast("long"))
    return placed.join(small_or_not(before), ["file", "block"], "left").select("file", (known + F.col("own") - len(MAGIC)).alias("start"), "value")


def _joined(spark: SparkSession, path: str, placed: DataFrame, records: DataFrame) -> DataFrame:
    """(file, start, payload) of records that magic lines cut up, fetched again and put in order.

    Chunks are known by their offset, so it doesn't matter how this read is split; a record that
    isn't found whole fails the query.
    """
    broken = records.select("file", "start", F.struct("start", "next", "body", "length").alias("own"))
    owned = _last_before(placed.select("file", "start").join(broken, ["file", "start"], "left"), F.col("own"), "r", also_own=True)
    inside = cut(owned.where("start < r.next").select("file", "start", F.col("r.start").alias("r_start"), F.col("r.body").alias("body"), F.col("r.length").alias("length")))
    pieces = _placed_values(spark, path).join(small_or_not(inside), ["file", "start"])
    piece = F.struct("start", F.concat(F.lit(MAGIC), "value").alias("value"))
    whole = pieces.groupBy("file", "r_start", "body", "length").agg(F.array_join(F.transform(F.sort_array(F.collect_list(piece)), lambda p: p["value"]), "").alias("value"))
    found = F.octet_length("value") >= F.col("body") + F.col("length") + len(MAGIC)
    checked = F.when(found, _payload(_block("value", len(MAGIC)))).otherwise(F.raise_error(F.concat(F.lit("archive changed while it was read: "), "file")).cast("binary"))
    return whole.select("file", F.col("r_start").alias("start"), checked.alias("payload"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Verified records: file, start, page (text of the id), target, record_type, digest,
    payload_bytes, refers_to (text of an id) and ``intact`` (payload, digest and length agree).

    Digest and length are those of the payload as read, for revisits as stated. Bytes that no chain
    from a file's start reaches are no records; a file that doesn't start with the magic line, or an
    empty one, has none. A payload that holds magic lines is put together from its chunks.
    """
    placed, told = _verified(spark, path)
    broken = told.where("not whole")
    if not broken.isEmpty():
        joined = _joined(spark, path, placed, broken)
        joined = joined.select("file", "start", base32_sha1(F.col("payload")).alias("j_digest"), F.octet_length("payload").cast("long").alias("j_bytes"))
        told = told.join(joined, ["file", "start"], "left").withColumns({"read_digest": F.coalesce("j_digest", "read_digest"), "read_bytes": F.coalesce("j_bytes", "read_bytes")})
    revisit = F.col("record_type") == "revisit"
    return told.select(
        "file", "start", "page", "target", "record_type",
        F.when(revisit, F.col("stated_digest")).otherwise(F.col("read_digest")).alias("digest"),
        F.when(revisit, F.col("stated_bytes")).otherwise(F.col("read_bytes")).alias("payload_bytes"),
        "refers_to",
        (revisit | (F.col("read_digest").eqNullSafe(F.col("stated_digest")) & F.col("read_bytes").eqNullSafe(F.col("stated_bytes")))).alias("intact"),
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The payloads (binary) of all verified response records: page, target, payload."""
    placed, told = _verified(spark, path)
    told = told.where("record_type = 'response'")
    single = cut(told.where("whole").select("file", "start", "body", "length", "page", "target"))
    out = _placed_values(spark, path).join(small_or_not(single), ["file", "start"])
    out = out.select("page", "target", _payload(_block("value", 0)).alias("payload"))
    broken = told.where("not whole")
    return out.unionByName(_joined(spark, path, placed, broken).join(broken.select("file", "start", "page", "target"), ["file", "start"]).select("page", "target", "payload"))


def op5_warc(spark, sf_dir: str) -> DataFrame:
    """All pages written to archives in the shared folder and read back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = shared_path(spark, "archives")
    write_archives(pages, path)
    kind = pages.schema["page_id"].dataType
    as_id = lambda c: F.when(F.col(c) != "", F.col(c)).cast(kind)
    found = read_archives(spark, path)
    return found.select(as_id("page").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", as_id("refers_to").alias("refers_to"), "intact")


B32 = " || ".join(f"substr('{ALPHABET}', ((('0x' || substr(d, {5 * g + 1}, 5))::BIGINT >> {s}) & 31) + 1, 1)" for g in range(8) for s in (15, 10, 5, 0))
SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') h, sha1(coalesce(html, '')) d FROM pages),
f AS (SELECT *, strlen(h)::BIGINT n, min(page_id) OVER (PARTITION BY h) r FROM p)
SELECT page_id, n payload_bytes, {B32} payload_digest, CASE WHEN n >= {MIN_BYTES} AND page_id <> r THEN 'revisit' ELSE 'response' END record_type,
  CASE WHEN n >= {MIN_BYTES} AND page_id <> r THEN r END refers_to, true intact FROM f
"""

ship_by_value(__name__)

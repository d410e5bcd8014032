"""Cross-tokenizer alignment: the tokens of two vocabularies over the same bytes.

Tokens are byte ranges. The ranges of B are a static interval index; each range of A is a stabbing
query on it, two bisections that tell the run of B tokens that it overlaps. A gap between two
neighbouring B tokens that no A range spans is where both end: a group boundary.

Texts are cut into units, white space and the word after it, where neither vocabulary can have a
token that spans the cut (`Vocabularies` derives the cuts from the pieces). So a unit is encoded and
aligned once a task, however often it occurs, and texts are sums over their units.

How many documents hold a pair of ids is counted over the corpus: chunks of documents send their
distinct pairs, in blocks of A ids, and ask for the totals of these only. Pairs are bounded by the
vocabularies; a block's messages are dealt in salts, and partial sums meet in a Spark aggregation.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship_by_value, stored

TOKENIZERS = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Characters of a chunk, units that a task remembers, blocks of A ids, chunks of a salt.
CHUNK_CHARS, REMEMBERED, BLOCKS, SALT_CHUNKS = 4_000_000, 500_000, 96, 1024
#: Characters of the texts that units are encoded in.
JOINED = 20_000
SPACE = "▁"
UNIT = re.compile(r"\s*\S+|\s+")


def byte_letters() -> dict[str, int]:
    """The letter of each byte in byte-level vocabularies: printable ones are themselves, the
    others follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def piece_bytes(piece: str) -> bytes:
    """A piece in UTF-8, with U+2581 as space and <0xHH> as that byte."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(SPACE, " ").encode()


class Vocabularies:
    """Both tokenizers, each id's bytes, and where texts can be cut."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        words = self.a.get_vocab()
        self.bytes_a = [b""] * (1 + max(words.values()))
        for word, i in words.items():
            self.bytes_a[i] = bytes(letters[c] for c in word) if all(c in letters for c in word) else word.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [piece_bytes(p) for p in pieces]
        self.prefix = self.b.piece_to_id(SPACE)
        # White space that no piece has after a character that isn't, nor after the space that B adds.
        self.cuts = "".join(c for c in "\t\n " if not any(re.search(rf"[^\s{SPACE}]{c}" if c != " " else rf"[^\s{SPACE}][ {SPACE}]", p) or c != " " and SPACE + c in p for p in pieces))
        self.inside = re.compile(rf"[^\S{self.cuts}]" if self.cuts else r"[\s\S]")

    def units(self, text: str) -> list[str]:
        """The text in units; other white space than that of the cuts stays inside of them."""
        if not self.inside.search(text):
            return UNIT.findall(text)
        return re.split(rf"(?<=\S)(?=[{self.cuts}])", text) if self.cuts else [text]

    def joined(self, units: list[str]) -> tuple[list[str], list[list[int]]]:
        """Texts of about JOINED characters that units make up, and the places of these. White space
        at a unit's end would grow together with the next one's: such a unit is a text of its own."""
        texts, members, size = [], [], JOINED
        for i, u in enumerate(units):
            if size >= JOINED or u[0] not in self.cuts or u[-1].isspace():
                texts.append([])
                members.append([])
                size = 0
            texts[-1].append(u)
            members[-1].append(i)
            size = JOINED if u[-1].isspace() or not self.cuts else size + len(u)
        return list(map("".join, texts)), members

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both for each unit, a piece of a text that a space was put before."""
        a = [e.ids for e in self.a.encode_batch(units, add_special_tokens=False)]
        spaced = [u[0] == " " for u in units]
        b = self.b.encode([u[1:] if s else u for u, s in zip(units, spaced, strict=True)], num_threads=1)
        for i, s in enumerate(spaced):
            if not s:
                b[i] = b[i][1:]  # the space that B adds isn't in the text here
            elif len(units[i]) == 1:
                b[i] = [self.prefix]
        return a, b


def overlaps(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each A range [start, end) the run [first, last) of B ranges that it overlaps; B's are in
    order and disjoint, so both of their bounds are sorted: the index is bisected."""
    return np.searchsorted(b_end, a_start, "right"), np.searchsorted(b_start, a_end, "left")


def group_ends(first: np.ndarray, last: np.ndarray, n_b: int) -> np.ndarray:
    """Whether a group ends with each B token: no A range spans the gap after it."""
    spanned = np.zeros(n_b + 1, np.int64)
    wide = last - first > 1
    np.add.at(spanned, first[wide], 1)
    np.add.at(spanned, last[wide] - 1, -1)
    return np.cumsum(spanned[:n_b]) == 0


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of n values each, one after another."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(n) else 0) + np.repeat(first - (ends - n), n)


class Units:
    """Units that were encoded and aligned: their counts, groups as text, and pairs of ids."""

    def __init__(self, both: Vocabularies):
        self.both, self.place = both, {}
        self.size_a, self.size_b = (np.array(list(map(len, x)), np.int64) for x in (both.bytes_a, both.bytes_b))
        self.signs_a, self.signs_b = _signs(len(self.size_a), ("", ",", ";")), _signs(len(self.size_b), ("|", ","))
        self.groups: list[str] = []
        self.wrong: list[int] = []  # places of units whose bytes aren't those of their tokens
        self.counts = np.empty((0, 4), np.int64)  # tokens of A and B, groups, links
        self.codes = np.empty(0, np.int64)  # a pair's code, unit by unit, in the order of links
        self.starts = np.zeros(1, np.int64)

    def add(self, units: list[str]) -> None:
        """Encode and align units. They are encoded many at a time, as texts that units stand one behind
        another in; should such a text not come back byte by byte, its units are looked at alone."""
        joined, members = self.both.joined(units)
        ids_a, ids_b = [], []
        for one, of in zip(joined, members, strict=True):
            a, b = self._encoded([one])
            if a is None and len(of) > 1:
                alone = [self._encoded([units[i]]) for i in of]
                ids_a += [x if x is not None else _NONE for x, _ in alone]
                ids_b += [x if x is not None else _NONE for _, x in alone]
                bad = [i for i, (x, _) in zip(of, alone, strict=True) if x is None]
            else:
                ids_a.append(_NONE if a is None else a)
                ids_b.append(_NONE if b is None else b)
                bad = of if a is None else []
            self.wrong += [len(self.groups) + i for i in bad]
        lost = np.isin(np.arange(len(units)), [i - len(self.groups) for i in self.wrong])
        self._align(units, np.concatenate([_NONE, *ids_a]), np.concatenate([_NONE, *ids_b]), lost)

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray | None, np.ndarray | None]:
        """Ids of a text in both; None where they don't give back its bytes."""
        both = self.both
        (a,), (b,) = both.encode(texts)
        raw = texts[0].encode()
        if b"".join(map(both.bytes_a.__getitem__, a)) != raw or b"".join(map(both.bytes_b.__getitem__, b)) != raw:
            return None, None
        return np.array(a, np.int64), np.array(b, np.int64)

    def _align(self, units: list[str], ids_a: np.ndarray, ids_b: np.ndarray, lost: np.ndarray) -> None:
        # No token of a unit reaches into the next one, so all of them are aligned at once.
        end_a, end_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        first, last = overlaps(end_a - self.size_a[ids_a], end_a, end_b - self.size_b[ids_b], end_b)
        n_links = last - first
        code = np.repeat(ids_a, n_links) * len(self.size_b) + ids_b[_ranges(first, n_links)]
        ends = group_ends(first, last, len(ids_b))
        group_of_b = np.cumsum(ends) - ends
        group_of_a = group_of_b[first] if len(first) else first
        unit_ends = np.cumsum(np.where(lost, 0, np.fromiter((len(u.encode()) for u in units), np.int64, len(units))))
        unit_of_a, unit_of_b = np.searchsorted(unit_ends, end_a, "left"), np.searchsorted(unit_ends, end_b, "left")
        n_a, n_b, n_groups = (np.bincount(x, minlength=len(units)) for x in (unit_of_a, unit_of_b, unit_of_b[ends]))
        links = np.bincount(unit_of_a, n_links, len(units)).astype(np.int64)
        # Signs before each id: A's begin a group, unless it is the unit's first one with ";", B's follow "|".
        start_a, start_b = np.diff(group_of_a, prepend=-1) > 0, np.diff(group_of_b, prepend=-1) > 0
        sign_a = np.where(start_a, np.where(np.diff(unit_of_a, prepend=-1) > 0, 0, 2), 1)
        order = np.argsort(np.concatenate([group_of_a * 2, group_of_b * 2 + 1]), kind="stable")
        told = np.concatenate([self.signs_a[sign_a, ids_a], self.signs_b[np.where(start_b, 0, 1), ids_b]])[order].tolist()
        bounds = [0, *np.cumsum(n_a + n_b).tolist()]
        for k, u in enumerate(units):
            self.place[u] = len(self.groups)
            self.groups.append("".join(told[bounds[k] : bounds[k + 1]]))
        self.counts = np.concatenate([self.counts, np.stack([n_a, n_b, n_groups, links], 1)])
        self.codes = np.concatenate([self.codes, code])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(links)])

    def of(self, texts: list[str | None]) -> list[np.ndarray]:
        """Places of the units of each text; none where tokens don't give the text's bytes."""
        parts = [self.both.units(" " + t) if t else [] for t in texts]
        self._meet(dict.fromkeys(u for p in parts for u in p))
        placed = [np.fromiter(map(self.place.__getitem__, p), np.int64, len(p)) for p in parts]
        if self.wrong:  # such texts are judged whole, as their units' faults might even out
            whole = {i: " " + texts[i] for i, p in enumerate(placed) if np.isin(p, self.wrong).any()}
            self._meet(dict.fromkeys(whole.values()))
            for i, text in whole.items():
                at = self.place[text]
                placed[i] = np.array([] if at in self.wrong else [at], np.int64)
        return placed

    def _meet(self, units: dict[str, None]) -> None:
        if new := [u for u in units if u not in self.place]:
            self.add(new)


_NONE = np.empty(0, np.int64)


def _signs(n: int, signs: tuple[str, ...]) -> np.ndarray:
    """Each id as text behind each of the signs."""
    return np.array([[f"{s}{i}" for i in range(n)] for s in signs], object)


def _pack(x: np.ndarray) -> bytes:
    """Numbers as compressed bytes, all lowest ones first."""
    x = np.ascontiguousarray(x)
    raw = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpack(blob: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little")
    raw = np.frombuffer(pa.decompress(blob[8:], size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


COUNTS = ("n_a", "n_b", "n_groups", "n_links")
CHUNK = f"docs array<struct<doc_id:long,{','.join(f'{c}:long' for c in COUNTS)},groups:string,pairs:int>>, places binary, times binary, blocks array<struct<block:int,n:int,codes:binary,docs:binary>>"


def _chunks(path_a: str, path_b: str, told: str, chunk_chars: int, blocks: int):
    """Documents (id, text) -> chunks: what is known of each document, the places of its pairs among
    the chunk's sorted ones and how often it has each; and these pairs with their documents, by block."""

    def chunk(units: Units, ids: list, texts: list) -> dict:
        parts = units.of(texts)
        n = np.array([len(p) for p in parts])
        doc, unit = np.repeat(np.arange(len(parts)), n), np.concatenate([np.empty(0, np.int64), *parts])
        counts = np.zeros((len(parts), 4), np.int64)
        for c in range(4):
            counts[:, c] = np.bincount(doc, units.counts[unit, c], len(parts))
        both, times = np.unique(doc * len(units.groups) + unit, return_counts=True)
        doc, unit = np.divmod(both, max(1, len(units.groups)))
        length = units.starts[unit + 1] - units.starts[unit]
        doc, times, code = np.repeat(doc, length), np.repeat(times, length), units.codes[_ranges(units.starts[unit], length)]
        # Sorted by block, then by code, so that a block's pairs stand together.
        block = code // len(units.size_b) % blocks
        top = np.int64(len(units.size_a) * len(units.size_b))
        codes, place = np.unique(block * top + code, return_inverse=True)
        held, of = np.unique(doc * max(1, len(codes)) + place, return_inverse=True)
        times = np.bincount(of, times, len(held)).astype(np.int64)
        doc, place = np.divmod(held, max(1, len(codes)))
        pairs, steps = np.bincount(doc, minlength=len(parts)), np.diff(place, prepend=0)
        docs_of = np.bincount(place, minlength=len(codes))
        full = np.unique(codes // top)
        lows = [*np.searchsorted(codes, full * top).tolist(), len(codes)]
        groups = [";".join(map(units.groups.__getitem__, p.tolist())) for p in parts]
        if told == "sha256":
            groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
        return {
            "docs": [{"doc_id": i, **dict(zip(COUNTS, c, strict=True)), "groups": g, "pairs": p} for i, c, g, p in zip(ids, counts.tolist(), groups, pairs.tolist(), strict=True)],
            "places": _pack(steps.astype(np.int32)),
            "times": _pack(times.astype(np.int32)),
            "blocks": [{"block": int(f), "n": b - a, "codes": _pack(np.diff(codes[a:b] - f * top, prepend=0)), "docs": _pack(docs_of[a:b].astype(np.int32))} for f, a, b in zip(full, lows, lows[1:], strict=False)],
        }

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Vocabularies(path_a, path_b)
        units, ids, texts, size = Units(both), [], [], 0
        kinds = pa.schema([
            ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("groups", pa.string()), ("pairs", pa.int32())]))),
            ("places", pa.binary()), ("times", pa.binary()),
            ("blocks", pa.list_(pa.struct([("block", pa.int32()), ("n", pa.int32()), ("codes", pa.binary()), ("docs", pa.binary())]))),
        ])
        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1), strict=True):
                ids.append(i.as_py())
                texts.append(t.as_py())
                size += len(texts[-1] or "") + 50
                if size >= chunk_chars:
                    yield pa.RecordBatch.from_pylist([chunk(units, ids, texts)], kinds)
                    ids, texts, size = [], [], 0
                    if len(units.groups) > REMEMBERED:
                        units = Units(both)
        if ids:
            yield pa.RecordBatch.from_pylist([chunk(units, ids, texts)], kinds)

    return kernel


def _codes(rows: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
    parts = [np.cumsum(_unpack(x.as_py(), np.int64)) for x in rows.column("codes")]
    return parts, np.concatenate([np.empty(0, np.int64), *parts])


def _add_up(table: pa.Table) -> pa.Table:
    """Messages of a block and salt -> pairs and the documents that hold them."""
    _, codes = _codes(table)
    docs = np.concatenate([_unpack(x.as_py(), np.int32) for x in table.column("docs")])
    found, at = np.unique(codes, return_inverse=True)
    return pa.table({"code": found, "n": np.bincount(at, docs, len(found)).astype(np.int64)})


def _answer(asked: pa.Table, totals: pa.Table) -> pa.Table:
    """Messages of a block and salt, and the block's totals -> those of each message's pairs, in
    order, doubled, plus 1 where it is the highest of its A id."""
    parts, codes = _codes(asked)
    known, n = totals.column("code").to_numpy(), totals.column("n").to_numpy()
    order = np.argsort(known)
    at = order[np.searchsorted(known, codes, sorter=order)] if len(known) else codes
    value = n[at] * 2 + totals.column("best").to_numpy(zero_copy_only=False)[at]
    cuts = np.cumsum([len(p) for p in parts])[:-1]
    told = [_pack(v) for v in np.split(value, cuts)] if parts else []  # a salt may have no message of a block
    return pa.table({"chunk": asked.column("chunk"), "block": asked.column("block"), "totals": pa.array(told, pa.binary())})


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks with answers -> a row for each document."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            value = np.concatenate([np.empty(0, np.int64), *(_unpack(x["totals"], np.int64) for x in sorted(row["answers"] or [], key=lambda x: x["block"]))])
            docs, n = row["docs"], np.array([d["pairs"] for d in row["docs"]])
            # Places were told as steps over the whole chunk: documents follow one another in them.
            place, times = np.cumsum(_unpack(row["places"], np.int32).astype(np.int64)), _unpack(row["times"], np.int32).astype(np.int64)
            doc = np.repeat(np.arange(len(docs)), n)
            add = lambda x: np.bincount(doc, x, len(docs)).astype(np.int64)  # noqa: B023, E731
            columns = [pa.array([d[c] for d in docs], pa.int64()) for c in ("doc_id", *COUNTS)]
            columns += [pa.array(add(times * (value[place] & 1))), _exact_sums(doc, times * (value[place] >> 1), len(docs)), pa.array([d["groups"] for d in docs], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *COUNTS, "n_best", "count_sum", "groups"])


def _exact_sums(at: np.ndarray, x: np.ndarray, n: int) -> pa.Array:
    """Sums of whole numbers by place, beyond what a double holds exactly."""
    ends = np.concatenate(([0], np.cumsum(x)))
    bounds = np.searchsorted(at, np.arange(n + 1))
    return pa.array(ends[bounds[1:]] - ends[bounds[:-1]], pa.int64())


def align_tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizers: str = TOKENIZERS, file_a: str = FILE_A, file_b: str = FILE_B, groups: str = "text", chunk_chars: int = CHUNK_CHARS, blocks: int = BLOCKS, salt_chunks: int = SALT_CHUNKS) -> DataFrame:
    """Alignment of the tokens of A and B in every row's whole text, with a space before it.

    Returns doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups (``a1,a2|b1;a3|b2,b3``,
    or with groups="sha256" only its hash). Links are pairs of occurrences whose bytes overlap. The
    count of a pair of ids is the number of rows that hold it linked; n_best counts links whose pair
    has the highest count of its A id, ties included, count_sum adds the counts of all links.

    Null and empty texts, and texts whose A or B tokens don't give back their bytes, have no tokens:
    zeros and an empty string; their rows count in no pair. Strings of special tokens are plain text.
    Rows of equal or null ids are rows of their own. An empty table gives an empty result; columns
    other than the two named are ignored. ``tokenizers`` is a folder that all workers have.
    """
    paths = (f"{tokenizers}/{file_a}", f"{tokenizers}/{file_b}")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    chunks = stored(rows.mapInArrow(_chunks(*paths, groups, chunk_chars, blocks), CHUNK).withColumn("chunk", F.monotonically_increasing_id()), "align-chunks")
    # Chunks are numbered partition by partition, so their hash deals them to salts evenly.
    salts = max(1, -(-chunks.count() // salt_chunks))
    sent = chunks.select("chunk", F.pmod(F.xxhash64("chunk"), F.lit(salts)).cast("int").alias("salt"), F.inline("blocks"))
    partial = sent.select("block", "salt", "codes", "docs").groupBy("block", "salt").applyInArrow(_add_up, "code long, n long")
    size_b = Vocabularies(*paths).b.get_piece_size()
    of_a = F.floor(F.col("code") / size_b)
    counted = partial.groupBy("code").agg(F.sum("n").alias("n")).withColumn("a", of_a)
    # An A id has as many pairs as B has pieces, at most.
    best = (F.col("n") == F.max("n").over(Window.partitionBy("a"))).alias("best")
    totals = stored(counted.select("code", "n", best, F.pmod("a", F.lit(blocks)).cast("int").alias("block")), "align-totals")
    each = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    asked = sent.select("chunk", "block", "salt", "codes").groupBy("block", "salt")
    answers = asked.cogroup(each.groupBy("block", "salt")).applyInArrow(_answer, "chunk long, block int, totals binary")
    answers = answers.groupBy("chunk").agg(F.collect_list(F.struct("block", "totals")).alias("answers"))
    full = chunks.select("chunk", "docs", "places", "times").join(answers, "chunk", "left")
    out = ", ".join(f"{c} long" for c in ("doc_id", *COUNTS, "n_best", "count_sum"))
    return full.mapInArrow(_finish, f"{out}, groups string")


def op11_tokenalign(spark, sf_dir: str) -> DataFrame:
    """Alignment of the documents' tokens in two vocabularies."""
    found = align_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), groups="sha256")
    return found.withColumnRenamed("groups", "groups_sha256")


ship_by_value(__name__)

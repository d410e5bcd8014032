"""Secrets in texts: fixed patterns, and a linear-chain conditional random field beside them.

The field tags tokens as begin of a secret, inside one, or outside. A token is a run of letters and
digits or a single other character; its features are its shape, that of the run of non-blank
characters it stands in, its neighbours, the words before, and what kind of file the text is. The
best tags are those of the Viterbi path over all tokens of the whole text: no pattern decides where
the field looks.

A token's score is the sum of what it adds alone, and its run, its neighbours and its text. Marks are
counted for all characters of many texts at a time; tokens and runs that have the same marks have the
same features, which are made once. Paths are cut into blocks that are gone through side by side for
each tag that may come before them, then linked.

The field is fitted here. A bounded number of windows is drawn from all documents, by hash: around
stretches that look open (digits among letters, values that a telling name is set to), and anywhere.
What the fixed patterns find in them is a secret. Keys of public forms, and things that look like
keys but aren't, are also put into the drawn surroundings, so that forms that the corpus has not yet
seen are known by their shape.
"""

from __future__ import annotations

import functools
import random
import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, ship_by_value

#: Kinds in their order, and the patterns of the base ones.
KINDS = ("assign", "access", "hex", "secret")
BASE_KINDS = KINDS[:3]
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_VALUE = 12
#: What opens a stretch, around which windows are drawn.
DIGIT, LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")
NUMBERED, LONG, LEAST_RUN = re.compile(r"(?<!\S)[^\s0-9]*[0-9]\S*"), re.compile(r"(?<!\S)\S{20,}"), 8
MIXED = re.compile(r"[a-z][A-Z]|[A-Za-z][_=+][A-Za-z0-9]")
NAMED = re.compile(r"(?:passw(?:or)?d|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|client[_-]?key|auth|bearer|credential)s?[\"']?(?:\x20{0,3}(?::=|=>|[:=])\x20{0,3}|\x20is\x20|\x20)[\"']?([^\s\"']{6,})", re.IGNORECASE | re.ASCII)
TELLING = ("pass", "pwd", "secret", "token", "key", "auth", "bearer", "cred")
TOKEN, BLANK, LAST_BLANK = re.compile(r"[A-Za-z0-9]+|[^A-Za-z0-9\s]"), re.compile(r"\s"), re.compile(r"\s\S*\Z")
#: Characters drawn before and after a stretch, and of a window drawn anywhere; tokens before one
#: that may tell.
BEFORE, AFTER, WINDOW, BACK = 80, 40, 240, 5
#: The draw: stretches, and the longest of these; keys and decoys put into them; rounds and step of
#: the fit, and its prior. Windows drawn anywhere.
DRAWN, LONGEST, KEYS, DECOYS, ROUNDS, STEP, PRIOR = 2000, 400, 1500, 3000, 100, 0.3, 0.02
ANYWHERE = 1000
#: Characters that a span of the field has at least.
LEAST_SPAN = 8
OUTSIDE, BEGIN, INSIDE = range(3)
BANNED = -1e9
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"
ALNUM = string.ascii_letters + string.digits
#: Characters of the texts that are decoded together, and tokens of a block of a path.
TOGETHER, BLOCK = 500_000, 128
#: Classes of characters: others, blanks, letters and digits beyond ASCII, and those in ASCII.
OTHER, WHITE, BEYOND, LOWER, UPPER, FIGURE = range(6)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """What the fixed patterns find: kind, start, end; kind by kind, leftmost and non-overlapping."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE] if "=" in text or ":" in text else []
    # Shorter runs of a kind can't hold a longer one, so the least length may stand in the pattern.
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def telling(text: str) -> bool:
    """Whether a name that tells of secrets is in a text."""
    low = text.lower()
    return any(name in low for name in TELLING)


def stretches(text: str) -> list[list[tuple[int, int]]]:
    """Open runs (start, end), those with only white space between them in one list."""
    found = [m.span() for m in (NUMBERED.finditer(text) if DIGIT.search(text) else ()) if m.end() - m.start() >= LEAST_RUN and LETTER.search(m[0])]
    found += [m.span() for m in LONG.finditer(text) if MIXED.search(m[0])]
    if telling(text):
        found += [m.span(1) for m in NAMED.finditer(text)]
    found.sort()
    out: list[list[tuple[int, int]]] = []
    for start, end in found:
        if out and start < out[-1][-1][1]:
            out[-1][-1] = (out[-1][-1][0], max(end, out[-1][-1][1]))
        elif out and text[out[-1][-1][1] : start].isspace():
            out[-1].append((start, end))
        else:
            out.append([(start, end)])
    return out


def file_kind(text: str) -> str:
    """Of what kind the file is, by its lines: settings, code, markup or prose; and its length."""
    lines = text.count("\n") + 1
    set_to = text.count("=") + text.count(": ") + text.count("{") + text.count(";")
    kind = "markup" if text.count("</") * 4 > lines else "code" if set_to * 2 > lines else "prose"
    return f"{kind}{min(6, len(text).bit_length() // 3)}"


def _bucket(n: int) -> int:
    return n if n < 4 else 3 + n.bit_length()


def _changes(x: str) -> int:
    """How often the class of neighbouring characters changes."""
    kinds = ["." if not c.isascii() else "9" if c.isdigit() else "A" if c.isupper() else "a" if c.islower() else "." for c in x[:200]]
    return sum(a != b for a, b in zip(kinds, kinds[1:], strict=False))


def _kinds(x: str) -> str:
    """Which of digits, small and capital letters there are."""
    return ("9" if DIGIT.search(x) else "") + ("a" if re.search("[a-z]", x) else "") + ("A" if re.search("[A-Z]", x) else "")


def _shape(x: str) -> str:
    return f"{_kinds(x)}{_bucket(len(x))}" if x.isalnum() else x


def _neighbour(x: str | None) -> str:
    """A neighbouring token: a telling name, or its shape."""
    return "none" if x is None else "telling" if telling(x) else _shape(x)


def _own(x: str) -> list[str]:
    """Features of a token alone; those that end in ``{told}`` are told from the words before it."""
    shape = _shape(x)
    out = ["bias", f"shape:{shape}", f"shaped:{shape}:{{told}}"]
    if x.isalnum() and x.isascii():
        changes, size = _bucket(_changes(x)), min(200, len(x))
        digits, upper = sum(map(str.isdigit, x[:200])) * 5 // size, sum(map(str.isupper, x[:200])) * 5 // size
        out += [f"changed:{changes}:{{told}}", f"length:{min(9, _bucket(len(x)))}:{{told}}", f"spread:{min(9, len(set(x)) // 3)}", f"mixed:{min(9, _bucket(len(x)))}:{changes}"]
        out += [f"changes:{changes}"] * (changes > 0) + [f"digits:{digits}"] * (digits > 0) + [f"upper:{upper}"] * (upper > 0) + ["hex"] * (HEX.fullmatch(x) is not None)
    return out


def _of_run(run: str) -> list[str]:
    """Features of a run of non-blank characters. What most runs lack is told only where it is, here
    and for tokens: else the many tokens outside would make all of that speak for outside."""
    kinds, spread = _kinds(run), min(9, len(set(re.findall("[A-Za-z0-9]", run))) // 4)
    size, changes = _bucket(len(run)), _bucket(_changes(run))
    out = [f"run:{size}", f"runchanges:{changes}", f"runmixed:{size}:{changes}", f"runspread:{spread}", f"runspread:{spread}:{kinds}"]
    out += ["at"] * ("@" in run) + ["link"] * ("://" in run or "www." in run)
    return out + [f"{name}:{n}" for name, n in (("slashes", min(3, run.count("/"))), ("dots", min(3, run.count(".")))) if n]


def featured(text: str, kind: str) -> list[tuple[int, int, list[str]]]:
    """All tokens (start, end, features) of a text."""
    out: list[tuple[int, int, list[str]]] = []
    found = [m[0] for m in TOKEN.finditer(text)]
    near = [_neighbour(x) for x in found]
    for run in re.finditer(r"\S+", text):
        whole = _of_run(run[0])
        for m in TOKEN.finditer(text, *run.span()):
            i, s = len(out), m.start()
            gap = "in" if s > run.start() else "line" if s == 0 or text[s - 1] == "\n" else "blank"
            told = "telling" if "telling" in near[max(0, i - BACK) : i] else "plain"
            one, two, ahead = near[i - 1] if i else "none", near[i - 2] if i > 1 else "none", near[i + 1] if i + 1 < len(near) else "none"
            around = [f"gap:{gap}", f"one:{one}", f"two:{two}", f"ahead:{ahead}", f"file:{kind}", f"pair:{one}:{_shape(m[0])}"]
            if m[0].isalnum() and m[0].isascii():
                around.append(f"head:{m[0][:3].lower()}")
            out.append((s, m.end(), [f.replace("{told}", told) if f.endswith("{told}") else f for f in _own(m[0])] + around + whole))
    return out


def viterbi(scores: np.ndarray, moves: np.ndarray) -> list[int]:
    """The best tags of a chain that starts after, and ends before, an outside token."""
    best, back = (scores[0] + moves[OUTSIDE]).tolist(), []
    step = moves.tolist()
    for row in scores[1:].tolist():
        of = [max(range(3), key=lambda a: best[a] + step[a][b]) for b in range(3)]  # noqa: B023
        best = [best[a] + step[a][b] + row[b] for b, a in enumerate(of)]
        back.append(of)
    tags = [max(range(3), key=lambda a: best[a] + step[a][OUTSIDE])]
    for of in reversed(back):
        tags.append(of[tags[-1]])
    return tags[::-1]


def paths(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best tags of chains, one behind another, as ``viterbi`` has them for each.

    Chains are cut into blocks, and all blocks take each step together: first for each tag before a
    block what its best paths add, then, as what is best before each block is known, again with the
    tags that paths come from."""
    tags = np.zeros(len(scores), np.uint8)
    if not len(scores):
        return tags
    ends = np.cumsum(lengths)
    blocks = -(-lengths // BLOCK)
    of = np.repeat(np.arange(len(lengths)), blocks)
    turn = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    first = (ends - lengths)[of] + turn * BLOCK
    size = np.minimum(BLOCK, ends[of] - first)
    order = np.argsort(-size, kind="stable")  # longest first: those that take a step are in front
    first, size, turn, of = first[order], size[order], turn[order], of[order]
    live = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    heads = place[np.cumsum(blocks)[blocks > 0] - blocks[blocks > 0]]  # where each chain's first block is
    count, begin = blocks[blocks > 0], np.cumsum(blocks)[blocks > 0] - blocks[blocks > 0]

    entry = np.full((len(order), 3), -np.inf)
    entry[heads, OUTSIDE] = 0
    if count.max() > 1:
        added = moves + scores[first][:, None, :]
        for t in range(1, size[0]):
            n = live[t]
            x = added[:n]
            added[:n] = np.maximum(np.maximum(x[:, :, :1] + moves[0], x[:, :, 1:2] + moves[1]), x[:, :, 2:] + moves[2]) + scores[first[:n] + t][:, None, :]
        for t in range(1, count.max()):
            here = begin[count > t] + t
            before, now = place[here - 1], place[here]
            entry[now] = (entry[before][:, :, None] + added[before]).max(1)
    came = np.zeros((len(scores), 3), np.uint8)
    best = entry
    for t in range(size[0]):
        n, at = live[t], first[: live[t]] + t
        x = best[:n, :, None] + moves
        come = x.argmax(1)
        came[at] = come
        best[:n] = np.take_along_axis(x, come[:, None, :], 1)[:, 0] + scores[at]

    # Backwards: what each last tag of a block leads to, then which one it is.
    leads = np.zeros((len(scores), 3), np.uint8)
    to = np.tile(np.arange(3, dtype=np.uint8), (len(order), 1))
    for t in range(size[0] - 1, -1, -1):
        at = first[: live[t]] + t
        leads[at] = to[: live[t]]
        to[: live[t]] = np.take_along_axis(came[at], to[: live[t]].astype(np.int64), 1)
    last = np.zeros(len(order), np.int64)
    tails = place[begin + count - 1]
    last[tails] = (best[tails] + moves[:, OUTSIDE]).argmax(1)
    for t in range(1, count.max()):
        here = (begin + count - 1 - t)[count > t]
        before, now = place[here], place[here + 1]
        last[before] = to[now, last[now]]
    for t in range(size[0]):
        at = first[: live[t]] + t
        tags[at] = leads[at, last[: live[t]]]
    return tags


@functools.cache
def _classes() -> np.ndarray:
    """The class of each character."""
    out = np.array([WHITE if c.isspace() else BEYOND if c.isalnum() else OTHER for c in map(chr, range(0x110000))], np.uint8)
    for kind, letters in ((LOWER, string.ascii_lowercase), (UPPER, string.ascii_uppercase), (FIGURE, string.digits)):
        out[[ord(c) for c in letters]] = kind
    return out


def _buckets(n: np.ndarray) -> np.ndarray:
    return np.where(n < 4, n, 3 + np.frexp(n.astype(float))[1])


class _Marks:
    """What is counted at once for all characters of a text of many."""

    def __init__(self, text: str):
        self.text, self.codes = text, np.frombuffer(text.encode("utf-32-le"), np.uint32)
        self.kinds = kinds = _classes()[self.codes]
        alnum, single = kinds >= LOWER, (kinds == OTHER) | (kinds == BEYOND)
        self.starts = np.flatnonzero(single | alnum & ~np.concatenate(([False], alnum[:-1])))
        self.ends = np.flatnonzero(single | alnum & ~np.concatenate((alnum[1:], [False]))) + 1
        self.opens = kinds != WHITE
        closes = np.flatnonzero(self.opens & np.concatenate((kinds[1:] == WHITE, [True]))) + 1
        self.opens[1:] &= kinds[:-1] == WHITE
        self.run_starts, self.run_ends = np.flatnonzero(self.opens), closes
        level = np.maximum(kinds, BEYOND)  # others, blanks and letters beyond ASCII are one class
        self.changed = np.cumsum(np.concatenate(([False], level[1:] != level[:-1])), dtype=np.int32)
        # A bit for each letter and digit.
        bit = np.where(kinds == LOWER, self.codes - 97, np.where(kinds == UPPER, self.codes - 65 + 26, np.where(kinds == FIGURE, self.codes - 48 + 52, 63)))
        self.bits = np.where(alnum, np.uint64(1) << bit.astype(np.uint64), np.uint64(0))
        self.counts = {}

    def count(self, name: str, mask, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How many characters of a mask are from starts to ends."""
        if name not in self.counts:
            self.counts[name] = np.concatenate(([0], np.cumsum(mask(), dtype=np.int32)))
        return self.counts[name][ends] - self.counts[name][starts]

    def of(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of what is from starts to ends: size, which kinds of letters and digits there are, bucket
        of changes, and how many distinct letters and digits."""
        size, near = ends - starts, np.minimum(ends, starts + 200)
        cuts = np.ravel(np.column_stack((starts, ends)))
        bits = np.bitwise_or.reduceat(np.append(self.bits, np.uint64(0)), cuts)[::2]
        has = [(bits & np.uint64(x)) > 0 for x in ((1 << 26) - 1, ((1 << 26) - 1) << 26, ((1 << 10) - 1) << 52)]
        return size, has[0] + 2 * has[1] + 4 * has[2], _buckets(self.changed[near - 1] - self.changed[starts]), np.bitwise_count(bits).astype(np.int64)

    def within(self, names: tuple[str, ...], starts: np.ndarray, lower: bool) -> np.ndarray:
        """Which of the tokens or runs that begin at starts have one of the names in them."""
        low = self.text.encode("latin-1", "replace")
        low, at = low.lower() if lower else low, []
        for name in map(str.encode, names):
            p = low.find(name)
            while p >= 0:
                at.append(p)
                p = low.find(name, p + 1)
        out = np.zeros(len(starts), bool)
        out[np.searchsorted(starts, np.array(at, np.int64), side="right") - 1] = True
        return out

    def tokens(self) -> np.ndarray:
        """A number for each token; tokens with the same one have the same features alone."""
        s, e = self.starts, self.ends
        size, kinds, changes, distinct = self.of(s, e)
        near = np.minimum(e, s + 200)
        digits = self.count("figures", lambda: self.kinds == FIGURE, s, near) * 5 // (near - s)
        upper = self.count("upper", lambda: self.kinds == UPPER, s, near) * 5 // (near - s)
        hexed = (size >= 16) & (self.count("hex", lambda: (self.kinds == FIGURE) | (self.kinds == LOWER) & (self.codes < 103), s, e) == size)
        out = 1 + _packed((kinds, 8), (_buckets(size), 64), (changes, 16), (digits, 8), (upper, 8), (hexed, 2), (np.minimum(9, distinct // 3), 16))
        return np.where(self.kinds[s] >= LOWER, out, np.where(self.kinds[s] == BEYOND, 0, -1 - self.codes[s].astype(np.int64)))

    def runs(self) -> np.ndarray:
        """A number for each run; runs with the same one have the same features."""
        s, e = self.run_starts, self.run_ends
        size, kinds, changes, distinct = self.of(s, e)
        ats, slashes, dots = (self.count(c, lambda: self.codes == ord(c), s, e) for c in "@/.")  # noqa: B023
        linked = self.within(("://", "www."), s, False)
        return _packed((kinds, 8), (_buckets(size), 64), (changes, 16), (ats > 0, 2), (linked, 2), (np.minimum(3, slashes), 4), (np.minimum(3, dots), 4), (np.minimum(9, distinct // 4), 16))


def _packed(*parts: tuple[np.ndarray, int]) -> np.ndarray:
    out = np.zeros(len(parts[0][0]), np.int64)
    for x, size in parts:
        out = out * size + x
    return out


class Decoder:
    """The field made ready to tag many texts."""

    def __init__(self, place: dict[str, int], weights: np.ndarray, moves: np.ndarray):
        self.place, self.weights, self.moves = place, weights, moves
        # All tokens of the fit have a shape, so a shape that it lacks has no weights as neighbour either.
        self.shapes = {f[6:]: i + 1 for i, f in enumerate(f for f in place if f.startswith("shape:"))}
        self.near = {"none": 0, **self.shapes}
        self.near["telling"] = self.telling = len(self.shapes) + 1
        self.unknown = len(self.shapes) + 2
        self.sides = np.zeros((3, self.unknown + 1, 3))
        for d, side in enumerate(("one", "two", "ahead")):
            for x, i in self.near.items():
                self.sides[d, i] = self.of([f"{side}:{x}"])
        self.pairs = np.repeat(self.sides[0][:, None, :], len(self.shapes) + 1, 1)
        for f, i in place.items():
            if f.startswith("pair:"):
                one, shape = (f[5], f[7:]) if f[5] == ":" else f[5:].split(":", 1)
                self.pairs[self.near[one], self.shapes[shape]] += weights[i]
        self.gaps = np.array([self.of([f"gap:{x}"]) for x in ("in", "line", "blank")])
        # What tokens add after plain and after telling words, with their shape and what they are as
        # neighbours; what runs add; each by the number that their marks give.
        self.tokens: tuple[dict[int, int], list] = ({}, [])
        self.runs: tuple[dict[int, int], list] = ({}, [])
        heads = sorted((sum(ord(c) << 7 * (2 - d) for d, c in enumerate(f[5:])), i) for f, i in place.items() if f.startswith("head:"))
        # The last one, with no weights, stands for all heads that the fit lacks.
        self.heads = np.array([h for h, _ in heads] + [1 << 21])
        self.head = np.concatenate((weights[[i for _, i in heads]].reshape(-1, 3), np.zeros((1, 3))))

    def of(self, feats: list[str]) -> np.ndarray:
        return self.weights[[self.place[f] for f in feats if f in self.place]].sum(0)

    def _token(self, x: str) -> list[float]:
        own, shape = _own(x), _shape(x)
        return [*(v for told in ("plain", "telling") for v in self.of([f.replace("{told}", told) if f.endswith("{told}") else f for f in own])), self.shapes.get(shape, 0), self.near.get(shape, self.unknown)]

    @staticmethod
    def _known(held: tuple[dict[int, int], list], numbers: np.ndarray, make) -> tuple[np.ndarray, np.ndarray]:
        """Rows of numbered things, made by ``make`` from the place of one that has the number."""
        at, found = pd.factorize(numbers)
        place, rows = held
        new = [i for i, x in enumerate(found.tolist()) if x not in place]
        if new:
            first = np.full(len(found), -1)
            first[at[::-1]] = np.arange(len(at))[::-1]
            for i in new:
                place[int(found[i])] = len(rows)
                rows.append(make(int(first[i])))
        return np.array([rows[place[x]] for x in found.tolist()]), at

    def _score(self, text: str, offset: int, offsets: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, ...]:
        """A piece of the joined texts: its tokens' starts and ends, and what is known of each."""
        marks = _Marks(text)
        s, e = marks.starts, marks.ends
        if not len(s):
            return ()
        rows, at = self._known(self.tokens, marks.tokens(), lambda i: self._token(text[s[i] : e[i]]))
        of_run, run_at = self._known(self.runs, marks.runs(), lambda i: self.of(_of_run(text[marks.run_starts[i] : marks.run_ends[i]])))
        near = rows[:, 7].astype(np.int16)[at]
        near[marks.within(TELLING, s, True)] = self.telling
        head = np.zeros(len(s), np.int64)
        small = np.append(np.where(marks.kinds == UPPER, marks.codes + 32, marks.codes), [0, 0]).astype(np.int64)
        for d in range(3):
            head = head * 128 + np.where(s + d < e, small[np.minimum(s + d, len(small) - 1)], 0)
        place = np.searchsorted(self.heads, head)
        place[(marks.kinds[s] < LOWER) | (self.heads[np.minimum(place, len(self.heads) - 1)] != head)] = len(self.heads) - 1
        gap = np.where(~marks.opens[s], 0, np.where((s == 0) | (marks.codes[s - 1] == 10), 1, 2))
        run = run_at[np.cumsum(marks.opens)[s] - 1]
        told = np.concatenate((rows[:, :3], rows[:, 3:6]))
        rest = of_run[run] + self.gaps[gap] + self.head[place] + kinds[np.searchsorted(offsets, s + offset, side="right") - 1]
        return s + offset, e + offset, near, rows[:, 6].astype(np.int16)[at], rest + told[at], rest + told[at + len(rows)]

    def scored(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all tokens in their texts, how many each text has, and their scores."""
        joined = "\n".join(texts)
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
        kinds = np.array([self.of([f"file:{file_kind(t)}"]) for t in texts]).reshape(-1, 3)
        pieces, low = [], 0
        while low < len(joined):
            blank = BLANK.search(joined, low + TOGETHER)  # pieces but the first start at a blank
            high = blank.start() if blank else len(joined)
            pieces.append(self._score(joined[low:high], low, offsets, kinds))
            low = high
        pieces = [x for x in pieces if x]
        if not pieces:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts), np.int64), np.zeros((0, 3))
        start, end, near, shape, plain, telling = (np.concatenate(x) for x in zip(*pieces, strict=True))
        del pieces
        text_of = np.searchsorted(offsets, start, side="right") - 1
        lengths = np.bincount(text_of, minlength=len(texts))
        depth = np.arange(len(start)) - np.repeat(np.cumsum(lengths) - lengths, lengths)

        def back(x: np.ndarray, d: int) -> np.ndarray:
            return np.where(depth >= d, np.concatenate((np.zeros(min(d, len(x)), x.dtype), x[: max(0, len(x) - d)])), 0)

        ahead = np.append(np.where(depth[1:] > 0, near[1:], 0), 0)
        told = np.any([back(near == self.telling, d) for d in range(1, BACK + 1)], 0)
        plain[told] = telling[told]
        plain += self.pairs[back(near, 1), shape] + self.sides[1][back(near, 2)] + self.sides[2][ahead]
        return start - offsets[text_of], end - offsets[text_of], lengths, plain

    def spans(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """Each text's secrets (start, end) by the best path over all of its tokens."""
        start, end, lengths, scores = self.scored(texts)
        tags = paths(scores, lengths, self.moves)
        begins, others = np.flatnonzero(tags == BEGIN), np.append(np.flatnonzero(tags != INSIDE), len(tags))
        lasts = others[np.searchsorted(others, begins, side="right")] - 1
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        for t, s, e in zip(np.repeat(np.arange(len(texts)), lengths)[begins].tolist(), start[begins].tolist(), end[lasts].tolist(), strict=True):
            out[t].append((s, e))
        return out


def likelihood(rows: list[np.ndarray], lengths: np.ndarray, tags: np.ndarray, weights: np.ndarray, moves: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log likelihood of tagged chains, one behind another, and its gradients by weights and moves.

    rows: the features of each token."""
    return _likelihood(np.array([len(r) for r in rows]), np.concatenate(rows), lengths, tags, weights, moves)


def _likelihood(each: np.ndarray, feats: np.ndarray, lengths: np.ndarray, tags: np.ndarray, weights: np.ndarray, moves: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The same of the features of all tokens and how many each has; all chains take each step
    together, the longest ones in front."""
    heads = np.cumsum(each) - each
    scores = np.stack([np.add.reduceat(w[feats], heads) for w in np.ascontiguousarray(weights.T)], 1)
    ends = np.cumsum(lengths)
    starts, longest = ends - lengths, int(lengths.max())
    first = starts[np.argsort(-lengths, kind="stable")]
    live = np.searchsorted(np.sort(-lengths), -np.arange(1, longest + 1), side="right")
    where = [first[: live[t]] + t for t in range(longest)]

    def add(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis)
        return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis))

    forward, backward = np.empty(scores.shape), np.empty(scores.shape)
    forward[first] = scores[first] + moves[OUTSIDE]
    for at_t in where[1:]:
        forward[at_t] = add(forward[at_t - 1][:, :, None] + moves, 1) + scores[at_t]
    total = add(forward[ends - 1] + moves[:, OUTSIDE], 1)
    backward[ends - 1] = moves[:, OUTSIDE]
    for at_t in where[:0:-1]:
        backward[at_t - 1] = add(moves + (scores[at_t] + backward[at_t])[:, None, :], 2)
    of = np.repeat(total, lengths)
    expected = np.exp(forward + backward - of[:, None])
    surplus = -expected
    surplus[np.arange(len(tags)), tags] += 1
    gain_w = np.stack([np.bincount(feats, np.repeat(x, each), len(weights)) for x in surplus.T], 1)
    gain_m, before = np.zeros((3, 3)), np.concatenate(([OUTSIDE], tags[:-1]))
    before[starts] = OUTSIDE
    np.add.at(gain_m, (before, tags), 1)
    np.add.at(gain_m, (tags[ends - 1], np.zeros(len(ends), int)), 1)
    gain_m[OUTSIDE] -= expected[starts].sum(0)
    later = np.ones(len(tags), bool)
    later[starts] = False
    later = np.flatnonzero(later)
    gain_m -= np.exp(forward[later - 1][:, :, None] + moves + (scores[later] + backward[later] - of[later, None])[:, None, :]).sum(0)
    gain_m[:, OUTSIDE] -= np.exp(forward[ends - 1] + moves[:, OUTSIDE] - total[:, None]).sum(0)
    truth = scores[np.arange(len(tags)), tags].sum() + moves[before, tags].sum() + moves[tags[ends - 1], OUTSIDE].sum()
    return float(truth - total.sum()), gain_w, gain_m


def _key(rng: random.Random) -> tuple[str, str, str]:
    """A made key of a public form: what stands before, the key, what stands after."""
    some = lambda n, letters=ALNUM: "".join(rng.choice(letters) for _ in range(n))
    form = rng.randrange(12)
    names = ("password", "passwd", "secret", "token", "api_key", "apikey", "auth", "access_key", "client_secret", "PASSWORD", "SECRET_KEY", "API_TOKEN")
    quote = rng.choice(['"', "'", "", ""])
    lead = rng.choice(names) + rng.choice([" = ", "=", ": ", ":", '": ']) + quote
    if form < 3:
        value = some(rng.randint(8, 15), ALNUM + "!@#$%&*") if form else some(rng.randint(20, 44), ALNUM + "+/")
        return lead, value if DIGIT.search(value) else value + some(1, string.digits), quote
    if form == 3:
        return lead, some(rng.choice([24, 32, 40, 64]), "0123456789abcdef"), quote
    if form == 4:
        return lead, "-".join(some(n, "0123456789abcdef") for n in (8, 4, 4, 4, 12)), quote
    value = {
        5: lambda: rng.choice(["ghp_", "gho_", "ghs_"]) + some(36),
        6: lambda: rng.choice(["xoxb-", "xoxp-"]) + some(11, string.digits) + "-" + some(24),
        7: lambda: rng.choice(["sk_live_", "rk_live_", "sk-", "pk_live_"]) + some(rng.choice([24, 32, 48])),
        8: lambda: "AIza" + some(35, ALNUM + "_-"),
        9: lambda: rng.choice(["glpat-", "npm_", "hf_", "dop_v1_"]) + some(rng.randint(20, 36)),
        10: lambda: "eyJ" + some(rng.randint(15, 30)) + ".eyJ" + some(rng.randint(20, 60)) + "." + some(rng.randint(20, 43), ALNUM + "_-"),
        11: lambda: some(rng.randint(32, 64), ALNUM + "+/") + rng.choice(["", "=", "=="]),
    }[form]()
    return (lead, value, quote) if rng.random() < 0.5 else (rng.choice(['"', "(", "", "Bearer ", "key "]), value, rng.choice(["", ".", ",", '"', ")"]))


def _decoy(rng: random.Random, words: list[str]) -> str:
    """Something that isn't a secret though it opens a stretch."""
    word, other = (rng.choice(words) for _ in range(2))
    digits = lambda n: "".join(rng.choice(string.digits) for _ in range(n))
    return rng.choice([
        lambda: f"{word}.{other}{digits(2)}@{word}{digits(2)}.{rng.choice(['com', 'org', 'example.net'])}",
        lambda: f"https://{word}.{rng.choice(['com', 'org'])}/{other}/{digits(4)}/{word}-{other}-{digits(3)}.html",
        lambda: f"{digits(4)}-{digits(2)}-{digits(2)}T{digits(2)}:{digits(2)}:{digits(2)}Z",
        lambda: f"v{digits(1)}.{digits(2)}.{digits(1)}-rc{digits(1)}",
        lambda: f"{word}_{other}_{digits(4)}.{rng.choice(['pdf', 'csv', 'tar.gz', 'py'])}",
        lambda: f"/{word}/{other}{digits(1)}/{word}.txt",
        lambda: f"{word}{other.title()}{word.title()}{digits(1)}",
        lambda: f"{word}{digits(rng.randint(1, 4))},",
        lambda: f"{digits(3)}-{word}-{digits(4)}",
        lambda: f"{word.upper()}-{digits(5)}",
        lambda: f"{word.title()}{other.title()}{word.title()}{other.title()}",
        lambda: f"{rng.choice(['password', 'secret', 'token', 'Token', 'api key'])}{rng.choice([': ', ' = ', ' is ', ' '])}{word}{other if rng.random() < 0.5 else ''}",
        lambda: f"{digits(3)}.{digits(2)}.{digits(1)}.{digits(2)}:{digits(4)}/{word}",
        lambda: f"{word}={digits(3)}&{other}={digits(2)}",
        lambda: f"{word}###{digits(3)}{other}***",
        lambda: "-".join("".join(rng.choice("0123456789abcdef") for _ in range(n)) for n in (8, 4, 4, 4, 12)),
        lambda: f"{digits(2)}{word[:2]}{digits(3)}{rng.choice(['px', 'kg', 'km', 'th'])}({other})",
    ])()


def _example(window: str, secret: list[tuple[int, int]], kind: str) -> tuple[list[list[str]], list[int]]:
    """A window's features and tags, where ``secret`` tells the spans of secrets."""
    tokens, tags, last = featured(window, kind), [], None
    for s, e, _ in tokens:
        of = next((x for x in secret if x[0] <= s and e <= x[1]), None)
        tags.append(OUTSIDE if of is None else INSIDE if of == last else BEGIN)
        last = of
    return [t[2] for t in tokens], tags


def examples(draw: list[tuple[str, str]]) -> list[tuple[list[list[str]], list[int]]]:
    """Tagged windows (text, kind of file), and keys and decoys put into their surroundings."""
    out = []
    for window, kind in draw:
        secret = [m.span(2) for m in ASSIGN.finditer(window) if len(m[2]) >= LEAST_VALUE and DIGIT.search(m[2])]
        secret += [s for s in ((m.start(), m.end()) for p in (ACCESS, HEX) for m in p.finditer(window) if LETTER.search(m[0])) if not any(x[0] <= s[0] < x[1] for x in secret)]
        out.append(_example(window, secret, kind))
    for made in range((KEYS + DECOYS) * bool(draw)):
        window, kind = draw[made % len(draw)]
        rng = random.Random(zlib.crc32(window.encode()) + made)
        words = [w for w in re.findall(r"[a-z]{3,12}", window) if not telling(w)] or ["word"]
        left, right = " ".join(rng.choice(words) for _ in range(rng.randint(0, 6))), " ".join(rng.choice(words) for _ in range(rng.randint(0, 3)))
        lead, value, tail = _key(rng) if made < KEYS else ("", _decoy(rng, words), rng.choice(["", ".", ","]))
        text = f"{left}{rng.choice([' ', chr(10)])}{lead}{value}{tail} {right}"
        at = len(text) - len(value) - len(tail) - 1 - len(right)
        feats, tags = _example(text, [(at, at + len(value))] if made < KEYS else [], kind)
        # Half of them are without the heads of tokens, so that keys are also known by their shape alone.
        out.append(([[f for f in x if not f.startswith("head:")] for x in feats] if made % 2 else feats, tags))
    return [x for x in out if x[1]]


def train(tagged: list[tuple[list[list[str]], list[int]]], rounds: int = ROUNDS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Feature names, their weights (one for each tag) and the moves' weights, by adaptive steps up
    the penalised likelihood; a secret can't be inside without a begin."""
    names = sorted({f for feats, _ in tagged for x in feats for f in x})
    place = {f: i for i, f in enumerate(names)}
    weights, moves = np.zeros((len(names), 3)), np.zeros((3, 3))
    moves[OUTSIDE, INSIDE] = BANNED
    if tagged:
        feats = np.array([place[f] for each, _ in tagged for x in each for f in x])
        sizes = np.array([len(x) for each, _ in tagged for x in each])
        lengths, tags = np.array([len(t) for _, t in tagged]), np.array([k for _, t in tagged for k in t])
        # Moves begin as the tags have them: else the first steps would only tell that most are outside.
        ends = np.cumsum(lengths)
        before = np.concatenate(([OUTSIDE], tags[:-1]))
        before[ends - lengths] = OUTSIDE
        seen = np.ones((3, 3))
        np.add.at(seen, (before, tags), 1)
        moves = np.log(seen / seen.sum(1, keepdims=True))
        moves[OUTSIDE, INSIDE] = BANNED
        past_w, past_m = np.full(weights.shape, 1e-8), np.full(moves.shape, 1e-8)
        for _ in range(rounds):
            _, gain_w, gain_m = _likelihood(sizes, feats, lengths, tags, weights, moves)
            gain_w, gain_m = gain_w - PRIOR * weights, gain_m - PRIOR * np.where(moves == BANNED, 0, moves)
            gain_m[OUTSIDE, INSIDE] = 0
            past_w, past_m = past_w + gain_w**2, past_m + gain_m**2
            weights, moves = weights + STEP * gain_w / np.sqrt(past_w), moves + STEP * gain_m / np.sqrt(past_m)
    return names, weights, moves


def _joined(text: str, added: list[tuple[int, int]]) -> list[tuple[str, int, int, bool]]:
    """Base spans, and those of the field that are long enough and touch none of these."""
    base = base_spans(text)
    out = [(k, s, e, True) for k, s, e in base]
    if added:
        taken = sorted((s, e) for _, s, e in base)
        lows = np.array([s for s, _ in taken])
        reach = np.maximum.accumulate(np.array([e for _, e in taken])) if taken else lows
        for s, e in added:
            before = int(np.searchsorted(lows, e))  # base spans that start before the end
            if e - s >= LEAST_SPAN and (before == 0 or reach[before - 1] <= s):
                out.append((KINDS[3], s, e, False))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def find_spans(text: str | None, place: dict[str, int], weights: np.ndarray, moves: np.ndarray) -> list[tuple[str, int, int, bool]]:
    """All spans (kind, start, end, base) by start, then kind. What the field finds anywhere in the
    text is added where no base span is."""
    text = text or ""
    return _joined(text, Decoder(place, weights, moves).spans([text])[0] if place else [])


def _around(text: str, start: int, end: int) -> str:
    """A window around a stretch, from and to a blank where there is one."""
    low, high = max(0, start - BEFORE), min(len(text), end + AFTER)
    left = BLANK.search(text, low, start) if low else None
    right = LAST_BLANK.search(text, end, high) if high < len(text) else None
    return text[left.end() if left else low : right.start() if right else high]


def _windows(drawn: int):
    """Texts -> windows around short stretches (open) and one a text anywhere, with their hash and
    the kind of file: of each, those of a task that can be among the first ones of all."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[int, tuple[str, str]]] = [{}, {}]

        def add(which: int, window: str, kind: str, most: int) -> None:
            draw = xxhash.xxh3_64_intdigest(window.encode()) >> 1
            held[which][draw] = min(held[which].get(draw, (window, kind)), (window, kind))
            if len(held[which]) > 4 * most + 1000:
                held[which] = {k: held[which][k] for k in sorted(held[which])[:most]}

        for batch in batches:
            for t in batch.column(0):
                text = t.as_py() or ""
                found = [r for r in stretches(text) if r[-1][1] - r[0][0] <= LONGEST]
                kind = file_kind(text)
                for r in found:
                    add(1, _around(text, r[0][0], r[-1][1]), kind, drawn)
                at = zlib.crc32(text.encode()) % max(1, len(text) - WINDOW)
                window = _around(text, at + BEFORE, at + WINDOW - AFTER) if len(text) > WINDOW else text
                if window and not window.isspace():
                    add(0, window, kind, ANYWHERE)
        rows = [(bool(k), d, *held[k][d]) for k, most in enumerate((ANYWHERE, drawn)) for d in sorted(held[k])[:most]]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.bool_(), pa.int64(), pa.string(), pa.string()), strict=True)], names=["open", "draw", "window", "kind"])

    return kernel


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The drawn windows -> one row with the field."""
    draw = sorted((w, k) for batch in batches for w, k in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True))
    names, weights, moves = train(examples(draw))
    yield pa.RecordBatch.from_arrays([pa.array([names], pa.list_(pa.string())), pa.array([weights.ravel().tolist()], pa.list_(pa.float64())), pa.array([moves.ravel().tolist()], pa.list_(pa.float64()))], names=["names", "weights", "moves"])


def fit(docs: DataFrame, text: str = "text", drawn: int = DRAWN) -> tuple[list[str], list[float], list[float]]:
    """The field, as names of features, weights and moves. It is fitted in one task on windows around
    ``drawn`` distinct stretches (of at most LONGEST characters) and on ANYWHERE others, the first
    ones by hash; how rows are dealt to partitions has no say. Without text the field is empty and
    adds nothing."""
    windows = cut(docs.select(F.col(text).alias("text")).mapInArrow(_windows(drawn), "open boolean, draw long, window string, kind string"))
    each = windows.groupBy("open", "draw").agg(F.min("window").alias("window"), F.min("kind").alias("kind"))
    first = [each.where(F.col("open") == which).orderBy("draw").limit(n).select("window", "kind") for which, n in ((True, drawn), (False, ANYWHERE))]
    sample = cut(first[0].union(first[1]))
    if sample.isEmpty():
        return [], [], []
    row = cut(sample.coalesce(1).mapInArrow(_fitted, "names array<string>, weights array<double>, moves array<double>")).first()
    return list(row.names), list(row.weights), list(row.moves)


def find_secrets(docs: DataFrame, field: tuple[list[str], list[float], list[float]], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``spans`` (kind, start, end, base; code points, end exclusive) of every row.

    Whole texts are searched; a null text is empty and has no spans. Rows of equal or null ids are
    rows of their own, other columns are ignored, and an empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(field)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights, moves = held.value
        place = {f: i for i, f in enumerate(names)}
        decoder = Decoder(place, np.array(weights).reshape(-1, 3), np.array(moves).reshape(-1, 3)) if names else None
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
        keys = ("kind", "start", "end", "base")
        for batch in batches:
            texts, spans = [t.as_py() or "" for t in batch.column(1)], []
            ends = np.cumsum([len(t) + 1 for t in texts])
            while len(spans) < len(texts):
                done = len(spans)
                some = texts[done : max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + TOGETHER)))]
                added = decoder.spans(some) if names else [[]] * len(some)
                spans += [[dict(zip(keys, s, strict=True)) for s in _joined(t, x)] for t, x in zip(some, added, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(kernel, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, spans {SPANS}")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find_secrets(docs, fit(docs))
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter(base, lambda s: s["kind"] == F.lit(k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]  # noqa: B023
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


ship_by_value(__name__)

"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from transpark.llm import spelling


def plain_words(rows, least=5, count=3):
    found = Counter()
    for i, t in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            found[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= least and n >= count}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(words, more=2):
    out = {}
    for w, n in words.items():
        near = sorted(((-words[v], v) for v in words if one_edit(w, v)))
        form = near[0][1] if near and -near[0][0] >= more * n else None
        out[w] = [form, n, len(near), words[form] if form else None]
    rows = []
    for w, (form, n, near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, near, form_n))
    return sorted(map(repr, rows))


def shown(df):
    return sorted(repr(tuple(r)) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def variants(rng, letters, size):
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(size)]
    words = []
    for _ in range(size * 12):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            i = rng.randrange(len(w) + 1)
            w[i : i + rng.randint(0, 1)] = [rng.choice(letters)] * rng.randint(0, 1)
        words.append("".join(w))
    return words


@pytest.mark.parametrize("letters", ["ab", "abcdef", "étàß÷×zqxa", "abcdefghijklmnopqrstuvwxyzéÀ"])
def test_against_all_pairs(spark, letters):
    rng = random.Random(len(letters))
    words = {}
    for w in variants(rng, letters, 30):
        words[w] = words.get(w, 0) + rng.choice([1, 2, 5])
    df = spark.createDataFrame([(w, n, "x") for w, n in words.items()], "word string, n int, near string")
    assert shown(spelling.group_variants(df)) == plain_groups(words)


def test_documents(spark):
    rng = random.Random(12)
    words = variants(rng, "abcdeÉé", 40)
    rows = [(i, " ".join(rng.choice(words).upper() if rng.random() < 0.2 else rng.choice(words) for _ in range(rng.randint(0, 200)))) for i in range(60)]
    rows += [(1, None), (2, ""), (None, rows[0][1]), rows[5], (3, "don't straße12naïve_x—straße " * 3), (4, "longword " * 100_000), (7, "z" * 70_000 + " " + "zy" * 30_000)]
    docs = spark.createDataFrame([(i, t, 1, "w") for i, t in rows], "doc_id long, text string, n int, word string").repartition(5)
    want = plain_words(rows)
    assert {r.word: r.n for r in spelling.count_words(docs).collect()} == want
    assert shown(spelling.group_variants(spelling.count_words(docs))) == plain_groups(want)


def test_edges(spark):
    def groups(rows):
        return shown(spelling.group_variants(spark.createDataFrame(rows, "word string, n long")))

    assert groups([]) == []
    assert groups([(None, 3)]) == []
    assert groups([("", 1), ("a", 2), ("b", 4)]) == plain_groups({"": 1, "a": 2, "b": 4})
    ties = {"house": 10, "mouse": 10, "louse": 5, "rouse": 4, "lousy": 2}
    assert groups(list(ties.items())) == plain_groups(ties)
    chain = {"a" * i: 3**i for i in range(1, 14)}
    assert groups(list(chain.items())) == plain_groups(chain)
    outside = {"日本語": 9, "日本": 3, "🙂a🙂": 1, "🙂b🙂": 4}
    assert groups(list(outside.items())) == plain_groups(outside)
    with pytest.raises(ValueError):
        spelling.group_variants(spark.createDataFrame([("a", 1)], "word string, n long"), more=1)


def test_masks(spark):
    """One edit leaves a band equal after a replacement, two after an insertion."""
    rng = random.Random(4)
    words = variants(rng, spelling.LETTERS[::7] + "abc", 40)
    df = spark.createDataFrame([(w,) for w in set(words)], "word string").select("word", spelling.letter_mask(spelling.F.col("word")).alias("m"))
    masks = {r.word: r.m for r in df.collect()}
    bands = [sum(1 << c for c in range(spelling.CLASSES) if c % 3 == b) for b in range(3)]
    for a in masks:
        for b in masks:
            if one_edit(a, b):
                equal = sum(masks[a] & x == masks[b] & x for x in bands)
                assert equal >= (1 if len(a) == len(b) else 2) and (masks[a] ^ masks[b]).bit_count() <= 2

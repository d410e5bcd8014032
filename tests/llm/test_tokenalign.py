"""Token alignment against whole texts, token by token."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import tokenizers

from transpark.llm import tokenalign

FOLDER = tokenalign.TOKENIZERS
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
TEXTS = [
    None, "", " ", "  ", "a", "plain words, and more words.", "  two  spaces \n and\n\n lines \t tabs\t\n", "don't we'll I'VE", "naïve Ärger 日本語 🙂🙂 é",
    "a▁b", "▁", "x ▁ y", "semi;\r\nwin {\r\n}\r", "\r", "\n", "\nfoo", " \r", "nb space em 　", "sep\x1c\x1d mix !\x1c a", "nul\0nul", "<s> </s> <unk> <0x0A> <|endoftext|>",
    "tab\tbetween\x0bvt\x0cff\x85nel", "ends in space ", "ends in spaces   ", "1234567890 " * 3, "word " * 3000, "x" * 3000, "plain words, and more words.", "﻿bom ​zero", "a \n b", "a\n b", "ﬁ Ａ",
]


@pytest.fixture(scope="module")
def both():
    a = tokenizers.Tokenizer.from_file(f"{FOLDER}/{tokenalign.FILE_A}")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{FOLDER}/{tokenalign.FILE_B}")
    return a, b


def plain(both, rows):
    """Every pair of tokens is looked at where their ranges overlap; nothing is cut or remembered."""
    a, b = both
    letters, names = tokenalign.byte_letters(), {i: w for w, i in a.get_vocab().items()}
    links, out = [], []
    for _, text in rows:
        raw = (" " + text).encode() if text else b""
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        bytes_x = [bytes(letters[c] for c in names[i]) for i in x]
        bytes_y = [tokenalign.piece_bytes(b.id_to_piece(i)) for i in y]
        if b"".join(bytes_x) != raw or b"".join(bytes_y) != raw:
            x, y, bytes_x, bytes_y = [], [], [], []
        end_x, end_y = np.cumsum([len(t) for t in bytes_x]).astype(int).tolist(), np.cumsum([len(t) for t in bytes_y]).astype(int).tolist()
        met, j = [], 0
        for i, e in enumerate(end_x):
            start = e - len(bytes_x[i])
            while j and end_y[j - 1] > start:
                j -= 1
            while j < len(y) and end_y[j] - len(bytes_y[j]) < e:
                if end_y[j] > start:
                    met.append((x[i], y[j]))
                j += 1
        cuts, groups, p, q = sorted(set(end_x) & set(end_y)), [], 0, 0
        for c in cuts:
            p2, q2 = end_x.index(c, p) + 1, end_y.index(c, q) + 1
            groups.append(",".join(map(str, x[p:p2])) + "|" + ",".join(map(str, y[q:q2])))
            p, q = p2, q2
        links.append(met)
        out.append([len(x), len(y), len(groups), len(met), ";".join(groups)])
    count = Counter(p for met in links for p in set(met))
    most = {}
    for (x, _), n in count.items():
        most[x] = max(most.get(x, 0), n)
    return sorted((repr((i, *o[:4], sum(count[p] == most[p[0]] for p in met), sum(count[p] for p in met), o[4])) for (i, _), o, met in zip(rows, out, links, strict=True)))


def shown(df):
    return sorted(repr(tuple(r)) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize(("chunk_chars", "blocks", "salt_chunks", "parts"), [(6_000_000, 96, 1024, 3), (300, 5, 2, 4)])
def test_against_whole_texts(spark, both, chunk_chars, blocks, salt_chunks, parts):
    rows = list(enumerate(TEXTS)) + [(3, "again"), (None, "null id"), (None, None)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, code string, n_a int").repartition(parts)
    got = tokenalign.align_tokens(df, chunk_chars=chunk_chars, blocks=blocks, salt_chunks=salt_chunks)
    assert shown(got) == plain(both, rows)
    assert tokenalign.align_tokens(df.limit(0)).count() == 0
    blank = tokenalign.align_tokens(df.where("text is null"))
    assert [tuple(r)[1:] for r in blank.select(*COLUMNS).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_random_characters(spark, both):
    """Units are cut only where whole texts have token boundaries of both."""
    rng = random.Random(11)
    letters = "ab1.,;'-(){}\r\n\t \x0b\x1c\x85 　 é日🙂́▁" + " " * 8
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(1, 40)))) for i in range(1500)]
    got = tokenalign.align_tokens(spark.createDataFrame(rows, "doc_id long, text string"), chunk_chars=5000)
    assert shown(got) == plain(both, rows)


def test_the_query_against_whole_texts(spark, both):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = []
    for r in map(eval, plain(both, rows)):
        want.append((*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else ""))
    got = [tuple(r) for r in tokenalign.op11_tokenalign(spark, sf).select(*COLUMNS[:-1], "groups_sha256").collect()]
    assert sorted(got) == sorted(want)


def test_ranges_with_gaps():
    """The index alone, on ranges that leave bytes out: runs are those that a look at all pairs gives."""
    rng = random.Random(5)
    for _ in range(200):
        sides = []
        for _ in range(2):
            at, side = 0, []
            for _ in range(rng.randint(0, 12)):
                at += rng.randint(0, 2)
                side.append((at, at + rng.randint(1, 4)))
                at = side[-1][1]
            sides.append(np.array(side, np.int64).reshape(-1, 2))
        a, b = sides
        first, last = tokenalign.overlaps(a[:, 0], a[:, 1], b[:, 0], b[:, 1])
        for (s, e), x, y in zip(a.tolist(), first.tolist(), last.tolist(), strict=True):
            assert list(range(x, max(x, y))) == [j for j, (p, q) in enumerate(b.tolist()) if p < e and q > s]

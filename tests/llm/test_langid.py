import math
from collections import Counter

from transpark.llm import langid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.op4_langid(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang", "text"), "doc_id").where("held_out and lang_pred <> 'und'").collect()
    right = sum(r.lang == r.lang_pred for r in got)
    assert right >= 0.97 * len(got), (right, len(got), [(r.doc_id, r.lang, r.lang_pred, r.text[:80]) for r in got if r.lang != r.lang_pred][:10])


def test_edge_rows(spark):
    rows = [(1, "ab cd " * 9, "x", "s"), (2, "xy zw " * 9, "y", "s"), (2, None, "x", "s"), (None, "12 34 !!", None, "s"), (4, "", "y", "s"), (5, "ab " * 300_000, None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = [(r.doc_id, r.lang_pred) for r in langid.identify(docs, langid.fit(docs)).collect()]
    assert sorted(got, key=str) == sorted([(1, "x"), (2, "y"), (2, "und"), (None, "und"), (4, "und"), (5, "x")], key=str)
    nothing = langid.fit(docs.where("lang = 'z'"))
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}
    assert langid.identify(docs.limit(0), nothing).count() == 0


def test_no_language_vanishes(spark):
    """A text that makes up a whole language, or most of one, is learnt, as are few others beside it."""
    rows = [(f"eins zwei drei {w}", "de") for w in ["vier"] * 20_000 + [f"h{i}e" for i in range(30)]]
    rows += [("uno dos tres", "es")] * 20_000 + [("un deux trois", "fr"), ("one two three", "en")]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    for per_language in (1, 5, 1000):
        model = langid.fit(docs, per_language=per_language)
        assert set(model.languages) == {"de", "es", "fr", "en"}
        assert [model.predict(t)[0] for t in ("uno dos tres", "un deux trois", "one two three")] == ["es", "fr", "en"]
    again = langid.fit(docs.repartition(3, "text"), per_language=5)
    assert (again.centres == langid.fit(docs, per_language=5).centres).all()


def bins_of(text):
    """Bins and counts, letter by letter."""
    found, out = [], Counter()
    for c in text.lower():
        if c.isalpha():
            found.append(ord(c))
        elif not found or found[-1]:
            found.append(0)
    if not any(found):
        return {}
    for n in range(1, langid.ORDERS + 1):
        for i in range(len(found) - n + 1):
            code = 0
            for x in found[i : i + n]:
                code = code * 1_114_111 + x
            mixed = ((code + 2**63) % 2**64 - 2**63) * 0x9E3779B1 + n * 0x85EBCA6B & 0x7FFFFFFFFFFFFFFF
            out[(mixed ^ mixed >> 29) % langid.BINS] += 1
    return out


def test_nearest_centroid_brute_force(spark):
    """With no more texts than centroids each text is one: the nearest text's language wins, ties go by name."""
    known = {"b": ["der hund und die katze", "das haus am see", "Über allen Gipfeln"], "a": ["the dog and the cat", "a house by the sea", "over all the hilltops"], "c": ["a house by the sea"]}
    texts = ["the hund", "see", "sea", "a house by the sea", "katze cat", "1 2 3", "", "über!", "xq"]
    docs = spark.createDataFrame([(t, lang) for lang, ts in known.items() for t in ts], "text string, lang string")
    model = langid.fit(docs)
    vectors = {(lang, t): bins_of(t) for lang, ts in known.items() for t in ts}
    df = Counter(b for v in vectors.values() for b in v)
    idf = lambda b: math.log((1 + len(vectors)) / (1 + df[b])) + 0.1 if b in df else math.log(1 + len(vectors))

    def weights(v):
        w = {b: (1 + math.log(n)) * idf(b) for b, n in v.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {b: x / norm for b, x in w.items()}

    for t in texts:
        lang, score, _ = model.predict(t)
        own = bins_of(t)
        if not own:
            assert (lang, score) == ("und", 0.0)
            continue
        mine = weights(own)
        near = [(sum(x * w.get(b, 0) for b, x in mine.items()), lang) for (lang, _), w in ((k, weights(v)) for k, v in vectors.items())]
        best = max(s for s, _ in near)
        assert abs(score - best) < 1e-5 and lang == min(x for s, x in near if s > best - 1e-6), t


def test_the_fit_is_plain_spherical_k_means(spark):
    """Centroids, limits and rejections of languages with more texts than centroids, step by step."""
    import random

    import numpy as np

    rng = random.Random(5)
    stems = {"a": ["the", "dog", "house", "sea", "over", "hill"], "b": ["der", "hund", "haus", "über", "katze", "see"]}
    known = {lang: list({" ".join(rng.choice(w) + rng.choice(["", "s", "en", "xq"]) for _ in range(rng.randint(2, 9))) for _ in range(30)}) for lang, w in stems.items()}
    docs = spark.createDataFrame([(t, lang) for lang, ts in known.items() for t in ts], "text string, lang string").repartition(3)
    model = langid.fit(docs)
    hashes = {r.text: r.h for r in docs.selectExpr("text", "xxhash64(text) h").collect()}
    every = [bins_of(t) for ts in known.values() for t in ts]
    df = Counter(b for v in every for b in v)
    idf = np.full(langid.BINS, math.log(1 + len(every)))
    for b, n in df.items():
        idf[b] = math.log((1 + len(every)) / (1 + n)) + 0.1
    assert np.allclose(model.idf, idf)

    def unit(x):
        return x / math.sqrt(sum(y * y for y in x))

    def vector(text):
        x = np.zeros(langid.BINS)
        for b, n in bins_of(text).items():
            x[b] = (1 + math.log(n)) * idf[b]
        return unit(x)

    at = 0
    for lang in sorted(known):
        rows = [vector(t) for t in sorted(known[lang], key=hashes.get)]
        centres = [unit(sum(rows) / len(rows))]
        while len(centres) < langid.CENTROIDS:  # the row that is farthest from all so far
            centres.append(min(rows, key=lambda r: round(max(float(r @ c) for c in centres), 6)))  # noqa: B023
        for _ in range(langid.ROUNDS):
            near = [max(range(len(centres)), key=lambda k: round(float(r @ centres[k]), 6)) for r in rows]  # noqa: B023
            centres = [unit(sum(m) / len(m)) if (m := [r for r, x in zip(rows, near, strict=True) if x == k]) else c for k, c in enumerate(centres)]
        told = model.centres[at : at + len(centres)]
        assert model.languages[at : at + len(centres)] == [lang] * len(centres)
        assert np.allclose(told, np.array(centres), atol=1e-4)
        close = sorted(max(float(r @ c) for c in centres) for r in rows)
        assert abs(model.limits[at] - np.quantile(close, langid.OUTSIDE)) < 1e-4
        at += len(centres)
    asked = [(t, lang) for lang, ts in known.items() for t in ts] + [("日本語のテキスト", None), ("zzz qqq jjj", None)]
    got = langid.identify(spark.createDataFrame(asked, "doc_id string, lang string").withColumn("text", langid.F.col("doc_id")), model).collect()
    told = {r.doc_id: (r.lang_pred, r.rejected) for r in got}
    # A rejected text keeps its nearest language.
    assert all(told[t][0] in known and told[t][1] for t, lang in asked if lang is None)
    assert all(told[t][0] == lang for t, lang in asked if lang) and sum(told[t][1] for t, lang in asked if lang) <= 2

"""Language identification by nearest centroid.

Texts are vectors of hashed character n-grams (1 to 3 letters, with word boundaries), weighted by
TF-IDF and normalised. Each language has a few centroids, found by spherical k-means over a bounded
sample of its labelled rows; a text takes the language of the centroid with the largest cosine. A
text farther from its centroid than nearly all of the training rows were is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, ship_by_value, small_or_not

BINS = 1 << 13
ORDERS = 3
#: Labelled rows per language that the centroids are fitted on, at most.
PER_LANGUAGE = 1000
CENTROIDS, ROUNDS = 4, 10
#: Share of training rows that the rejection distance leaves outside.
OUTSIDE = 0.005
UNKNOWN = "und"
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """Whether each code point is a letter; made once per process."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Bins and counts of a text's n-grams; both empty without letters."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letters = _is_letter()[points]
    if not letters.any():
        return np.empty(0, np.int64), np.empty(0)
    points = np.where(letters, points, 0)
    points = points[letters | np.concatenate(([True], letters[:-1]))]
    code, found = np.zeros(len(points), np.int64), []
    for n in range(1, ORDERS + 1):
        code = (code[: len(points) - n + 1] if n > 1 else code) * 1_114_111 + points[n - 1 :]
        mixed = (code * 0x9E3779B1 + n * 0x85EBCA6B) & 0x7FFFFFFFFFFFFFFF
        found.append((mixed ^ mixed >> 29) % BINS)
    counts = np.bincount(np.concatenate(found), minlength=BINS)
    bins = np.flatnonzero(counts)
    return bins, counts[bins].astype(float)


def _vector(bins: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    w = (1 + np.log(counts)) * idf[bins]
    return w / max(np.linalg.norm(w), 1e-12)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [grams(t.as_py()) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([b.tolist() for b, _ in out], pa.list_(pa.int32())), pa.array([c.tolist() for _, c in out], pa.list_(pa.float64()))], names=["lang", "draw", "bins", "counts"])


def _fit(idf: np.ndarray):
    """Spherical k-means over the sampled rows of one language."""

    def kernel(table: pa.Table) -> pa.Table:
        table = table.sort_by("draw")  # so that partitions have no say in ties
        rows = np.zeros((table.num_rows, BINS), np.float32)
        for i, (b, c) in enumerate(zip(table.column("bins").to_pylist(), table.column("counts").to_pylist(), strict=True)):
            rows[i, b] = _vector(np.array(b), np.array(c), idf)
        centres = [rows.mean(0)]
        centres[0] /= np.linalg.norm(centres[0])
        while len(centres) < min(CENTROIDS, len(rows)):
            centres.append(rows[np.argmin((rows @ np.array(centres).T).max(1))])
        centres = np.array(centres)
        for _ in range(ROUNDS):
            near = np.argmax(rows @ centres.T, 1)
            for k in range(len(centres)):
                if (near == k).any():
                    mean = rows[near == k].mean(0)
                    centres[k] = mean / np.linalg.norm(mean)
        limit = float(np.quantile((rows @ centres.T).max(1), OUTSIDE))
        return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * len(centres), pa.string()), "centre": pa.array([c.astype(np.float32).tobytes() for c in centres], pa.binary()), "limit": pa.array([limit] * len(centres))})

    return kernel


class Centroids:
    """The fitted model: languages, their centroids, rejection limits and the idf weights."""

    def __init__(self, languages: list[str], centres: np.ndarray, limits: np.ndarray, idf: np.ndarray):
        self.languages, self.centres, self.limits, self.idf = languages, centres, limits, idf

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, cosine, rejected) of a text."""
        bins, counts = grams(text)
        if not len(bins) or not self.languages:
            return UNKNOWN, 0.0, True
        near = self.centres[:, bins] @ _vector(bins, counts, self.idf)
        best = int(np.argmax(near))
        score = float(min(1.0, max(0.0, near[best])))
        return self.languages[best], score, score < self.limits[best]


def fit(labelled: DataFrame, lang: str = "lang", text: str = "text", per_language: int = PER_LANGUAGE) -> Centroids:
    """Centroids from labelled rows with letters; rows without a label aren't used.

    From each language up to ``per_language`` distinct texts are drawn, by their hash, so that a
    text counts once however often it is repeated, and no language is left out.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(F.col(lang).alias("lang"), F.xxhash64(text).alias("draw"), F.col(text).alias("text"))
    sizes = cut(rows.groupBy("lang").agg(F.approx_count_distinct("draw", 0.02).alias("n")))
    # Twice the texts that are wanted, as the number of distinct ones is an estimate within a few percent.
    share = F.pmod("draw", F.lit(1 << 30)) < F.lit(float(2 * per_language << 30)) / F.col("n")
    # The sizes are a row per language: joined by broadcast, so that only drawn texts are shuffled, once each.
    drawn = rows.join(small_or_not(sizes), "lang").where(share).groupBy("lang", "draw").agg(F.min("text").alias("text"))
    drawn = drawn.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("draw"))).where(F.col("nth") <= per_language)
    sample = cut(drawn.select("lang", "draw", "text").mapInArrow(_features, "lang string, draw long, bins array<int>, counts array<double>").where(F.size("bins") > 0))
    total = sample.count()
    idf = np.full(BINS, np.log(1 + total))
    for b, n in sample.select(F.explode("bins").alias("b")).groupBy("b").count().collect():
        idf[b] = np.log((1 + total) / (1 + n)) + 0.1
    model = sample.groupBy("lang").applyInArrow(_fit(idf), "lang string, centre binary, limit double").orderBy("lang").toArrow() if total else None
    if model is None:
        return Centroids([], np.empty((0, BINS)), np.empty(0), idf)
    centres = np.array([np.frombuffer(c.as_buffer(), np.float32) for c in model.column("centre")])
    return Centroids(model.column("lang").to_pylist(), centres, model.column("limit").to_numpy(), idf)


def identify(docs: DataFrame, model: Centroids, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score and rejected of every row, from its whole text alone.

    A null text, or one without a letter, is ``und`` with score 0 and rejected, as are all texts
    if the model knows no language. A rejected text keeps its nearest language in lang_pred; of
    equally near ones the first by name. Rows of equal or null ids are rows of their own; other
    columns are ignored.
    """
    # Arrays and lists only: broadcast values are pickled by reference, and workers need not have the package.
    held = docs.sparkSession.sparkContext.broadcast((model.languages, model.centres, model.limits, model.idf))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = Centroids(*held.value)
        for batch in batches:
            found = [sent.predict(t.as_py()) for t in batch.column(1)]
            columns = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(kernel, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, lang_pred string, score double, rejected boolean")


def held_out(doc_id: str = "doc_id"):
    """Rows that nothing is learnt from; a null id isn't one."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def op4_langid(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those that aren't held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(~held_out()))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


ship_by_value(__name__)

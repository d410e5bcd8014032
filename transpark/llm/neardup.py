"""Near-duplicate groups by min-max hashing.

Each permutation of the shingle hashes gives two signature values, its minimum and its maximum, so
a signature of 180 values costs 90 hash evaluations a shingle. Bands of 5 values put a pair of
similarity 0.8 into a common bucket with probability 1 - (1 - 0.8^5)^36 > 0.999999. Documents of
one shingle set are one node from the start. In a bucket, the member that shares most buckets
leads: it is tried against the members of other components and then retires; members that are
already connected are not tried. Large groups keep members that are almost, but not quite, similar to
many others; trying these in pairs would grow with the square of the group. So after two turns the
members of buckets that still hold several components are joined on prefixes: with the shingles of
each set ordered from rare to frequent, two similar sets share one so early that enough can follow
it, and what sets an edited copy apart is rare. Every link is confirmed on full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, fresh, hash_words, mix64, ship_by_value, small_or_not, word_lists
from .components import components, compose

PERMUTATIONS, BAND = 90, 5
#: Turns in which one member of each bucket leads.
TURNS = 2
SLICE = 256


def shingle_sets(texts: list, k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the k-word shingles of each text.

    A text of 1 to k - 1 words has its whole sequence as its only shingle; one without words none.
    """
    out = []
    for words in word_lists(texts):
        h = hash_words(words)
        n = len(h)
        if not n:
            out.append(h)
            continue
        w = min(k, n)
        s = mix64(h[: n - w + 1] + np.uint64(w))
        for j in range(1, w):
            s = mix64(s * np.uint64(0x9E3779B97F4A7C15) + h[j : n - w + 1 + j])
        out.append(np.unique(s))
    return out


def _band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """Bucket keys of non-empty sets, a row each."""
    rng = np.random.RandomState(20240917)
    half = PERMUTATIONS // BAND
    a = rng.randint(0, 2**62, PERMUTATIONS, dtype=np.int64).astype(np.uint64) * np.uint64(4) + np.uint64(1)
    b = rng.randint(0, 2**62, PERMUTATIONS, dtype=np.int64).astype(np.uint64)
    flat = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    keys = np.empty((len(sets), 2 * half), np.uint64)
    for band in range(half):
        low, high = np.full(len(sets), 2 * band, np.uint64), np.full(len(sets), 2 * band + 1, np.uint64)
        for j in range(band * BAND, (band + 1) * BAND):
            v = flat * a[j] + b[j]
            low = mix64(low * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(v, starts))
            high = mix64(high * np.uint64(0x9E3779B97F4A7C15) + np.maximum.reduceat(v, starts))
        keys[:, 2 * band], keys[:, 2 * band + 1] = low, high
    return keys.view(np.int64)


def _as_node(s: np.ndarray) -> int | None:
    x = xxhash.xxh3_64_intdigest(s.tobytes())
    return None if not len(s) else x - (1 << 64) if x >> 63 else x


def _signatures(k: int):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                sets = shingle_sets(part.column(1).to_pylist(), k)
                full = [i for i, s in enumerate(sets) if len(s)]
                bands: list = [None] * len(sets)
                if full:
                    for i, row in zip(full, _band_keys([sets[i] for i in full]), strict=True):
                        bands[i] = row
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([_as_node(s) for s in sets], pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "node", "bands"],
                )

    return kernel


def _full_sets(k: int, listed: bool = False):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                sets = [s for s in shingle_sets(batch.column(0).slice(at, SLICE).to_pylist(), k) if len(s)]
                members = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())) if listed else pa.array([s.tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([_as_node(s) for s in sets], pa.int64()), members], names=["node", "members"])

    return kernel


def _confirm(percent: int):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, sa, sb = (batch.column(i) for i in range(4))
            hold = []
            for x, y in zip(sa, sb, strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                z = np.concatenate((x, y))
                z.sort(kind="stable")
                same = int(np.count_nonzero(z[1:] == z[:-1]))
                hold.append(100 * same >= percent * (len(z) - same))
            keep = pa.array(hold, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], names=["a", "b"])

    return kernel


def _sets_of(wanted: DataFrame, texts: DataFrame, first: DataFrame, k: int, listed: bool = False) -> DataFrame:
    """(node, members) of wanted nodes; first: a row id for each node, texts: (row id, text)."""
    ids = cut(first.join(wanted, "node", "left_semi").select(F.col("first_id").alias("w_id")).distinct())
    rows = texts.join(small_or_not(ids), F.col("t_id").eqNullSafe(F.col("w_id")), "left_semi").select("t_text")
    sets = rows.mapInArrow(_full_sets(k, listed), f"node long, members {'array<long>' if listed else 'binary'}")
    return cut(sets.join(wanted, "node", "left_semi").dropDuplicates(["node"]))


def _confirmed(pairs: DataFrame, texts: DataFrame, first: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets are similar."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = _sets_of(wanted, texts, first, k)
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("a_set")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("members").alias("b_set")), "b")
    return cut(both.select("a", "b", "a_set", "b_set").mapInArrow(_confirm(percent), "a long, b long"))


def _prefix_pairs(rest: DataFrame, texts: DataFrame, first: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) of other components that can be similar, by their prefixes: exact.

    rest: (node, n, label). A pair with i and j rarer shingles before a common one shares at most
    min(n - i, n' - j); its first common one must leave enough for the threshold.
    """
    sets = _sets_of(rest.select("node"), texts, first, k, listed=True)
    words = sets.join(rest, "node").select("node", "n", "label", F.explode("members").alias("s"))
    often = words.groupBy("s").agg(F.count("*").alias("df"), F.min("label").alias("low"), F.max("label").alias("high"))
    placed = words.join(often, "s").withColumn("i", F.row_number().over(Window.partitionBy("node").orderBy("df", "s")) - 1)
    early = cut(placed.where((F.col("n") - F.col("i")) * 100 >= F.col("n") * percent).where("low <> high").select("s", "node", "n", "label", "i"))
    other = early.select("s", *[F.col(c).alias(f"o_{c}") for c in ("node", "n", "label", "i")])
    can = F.least(F.col("n") - F.col("i"), F.col("o_n") - F.col("o_i")) * (100 + percent) >= (F.col("n") + F.col("o_n")) * percent
    return early.join(other, "s").where((F.col("node") < F.col("o_node")) & (F.col("label") != F.col("o_label")) & can).select(F.col("node").alias("a"), F.col("o_node").alias("b"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The near-duplicate group of every row: doc_id, n_shingles, component_id, kept.

    Words are runs between ASCII white space, A-Z lower-cased; sets hold distinct k-word shingles.
    Rows are linked if 100 * intersection >= percent * union, component_id is the least id that
    links reach, ``kept`` marks rows whose id it is. A text of fewer than k words is one shingle.
    Null, empty and blank texts have no shingle, are linked with nothing and kept. Rows of an equal
    id are rows of their own, and share their fate only if their texts are linked; a null id counts
    as larger than all. An empty table gives an empty result; other columns are ignored.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    texts = docs.select(F.col(doc_id).alias("t_id"), F.col(text).alias("t_text"))
    rows = cut(texts.mapInArrow(_signatures(k), f"doc_id {kind}, n_shingles long, node long, bands array<long>"))
    nodes = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    first = nodes.select("node", "first_id")

    spread = nodes.select("node", "n", F.explode("bands").alias("band"))
    shared = spread.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    members = cut(spread.join(shared, "band"))
    reach = members.groupBy("node").agg(F.sum("size").alias("reach"))
    active = cut(members.drop("size").join(reach, "node").withColumn("label", F.col("node")))

    labels = None
    near_size = F.col("n") * 100 >= F.col("l_n") * percent
    for turn in range(TURNS + 1):
        # Buckets whose members are connected already have nothing more to tell.
        open_bands = active.groupBy("band").agg(F.max(F.struct("reach", "node", "n", "label")).alias("lead"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
        # Cut, so that both sides of the join are plain exchanges: Spark then splits a hot bucket.
        open_bands = cut(open_bands)
        if turn < TURNS:
            led = active.join(open_bands.select("band", F.col("lead.node").alias("l_node"), F.col("lead.n").alias("l_n"), F.col("lead.label").alias("l_label")), "band")
            led = cut(led.where("node <> l_node"))
            tried = led.where("label <> l_label")
            tried = tried.where(near_size & (F.col("l_n") * 100 >= F.col("n") * percent))
            pairs = tried.select(F.col("node").alias("a"), F.col("l_node").alias("b"))
            active = led.drop("l_node", "l_n", "l_label")
        else:
            rest = active.join(open_bands.select("band"), "band", "left_semi")
            rest = cut(rest.select("node", "n", "label").distinct())
            if rest.isEmpty():
                break
            pairs = _prefix_pairs(rest, texts, first, k, percent)
        pairs = cut(pairs.distinct())
        if pairs.isEmpty():
            if turn < TURNS:
                continue
            break
        links = _confirmed(pairs, texts, first, k, percent)
        if labels is not None:
            moved = labels.select(F.col("node"), F.col("label"))
            for end in ("a", "b"):
                links = links.join(moved.withColumnRenamed("node", end), end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
        labels = compose(labels, components(links))
        if labels is not None and turn < TURNS:
            active = cut(active.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))

    if labels is not None:
        # Only linked nodes meet their component, of which there is one row: a large one is split as well.
        linked = cut(first.join(labels, "node"))
        groups = cut(linked.groupBy("label").agg(F.min("first_id").alias("component_id")))
        found = linked.join(groups, "label").select("node", "component_id")
        first = first.join(found, "node", "left").select("node", F.coalesce("component_id", "first_id").alias("component_id"))
    else:
        first = first.withColumnRenamed("first_id", "component_id")
    first = cut(first)  # so that the join below can split a text of very many copies
    blank = rows.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    full = rows.where("node is not null").select("doc_id", "n_shingles", "node").join(first, "node").select("doc_id", "n_shingles", "component_id")
    return full.unionByName(blank).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows that stand for their group, one for each, with all their columns.

    Of rows that repeat both an id and a text one stays; rows of an equal id with other texts are
    documents of their own, also without an id. The least id stands for a group, of equal ones the
    least text hash.
    """
    # Rows are told apart by id and text; a null id counts as larger than all.
    row, other = fresh(docs, "_row"), fresh(docs, "_other")
    keyed = docs.withColumn(row, F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.xxhash64(text, F.col(text).isNull()).alias("text")))
    gone = cut(near_duplicates(keyed, row, text, **options).where("not kept").select(F.col("doc_id").alias(other)).distinct())
    left = keyed.join(small_or_not(gone), F.col(row).eqNullSafe(F.col(other)), "left_anti").drop(row)
    again = cut(docs.groupBy(F.col(doc_id).alias(other)).count().where("count > 1").select(other))
    if again.isEmpty():
        return left
    again, same = small_or_not(again), F.col(doc_id).eqNullSafe(F.col(other))
    return left.join(again, same, "left_anti").unionByName(left.join(again, same, "left_semi").dropDuplicates([doc_id, text]))


def op6_neardup(spark, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of two-word shingles are similar by 0.8 or more."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=2)


W = r"'[^\x20\x09-\x0D]+'"
def components_sql(k: int) -> str:
    """doc_id, n_shingles, component_id and kept for k-word shingles."""
    shingle = " || ' ' || ".join(f"w[i + {j}]" for j in range(k))
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {W}) w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < {k} THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - {k} + 2), lambda i: {shingle}) END) s FROM w),
x AS (SELECT doc_id, len(s) n, unnest(s) g FROM s),
c AS (SELECT a.doc_id a, b.doc_id b FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id AND a.n * 100 >= b.n * 80 AND b.n * 100 >= a.n * 80
      GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (max(a.n) + max(b.n) - count(*))),
e AS (SELECT a, b FROM c UNION ALL SELECT b, a FROM c),
r AS (SELECT doc_id, doc_id root FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id),
m AS (SELECT doc_id, min(root) component_id FROM r GROUP BY doc_id)
SELECT doc_id, len(s)::BIGINT n_shingles, component_id, doc_id = component_id kept FROM s JOIN m USING (doc_id)
"""


SQL = components_sql(2)

ship_by_value(__name__)

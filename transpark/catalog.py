"""The registered queries: every operator over a deterministic projection of whole tables.

The tables have no genomic columns, so adapters project hits, features, links, blocks, candidates
and sequences from them. An adapter is one SQL text that Spark and DuckDB both read; queries apply
the operators to it, and their SQL states the same result independently.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transpark.functions import sequences as S
from transpark.operators import components as C
from transpark.operators import enrich as E
from transpark.operators import graph as G
from transpark.operators import hits as H
from transpark.operators import intervals as I
from transpark.operators import reads as R
from transpark.operators import similarity as N
from transpark.plans.storage import materialise, stored

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "benchmark")
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}

ORD = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
ORD_SQL = ", ".join(ORD)
HITS = """SELECT l_orderkey AS qseqid, l_partkey AS sseqid, 100.0e0 - CAST(round(l_discount * 100) AS INT) * 2 AS pident, CAST(l_quantity AS INT) AS length, 50 AS slen, 60 AS qlen,
  (l_suppkey * 7) % 90 + 1 AS qstart, (l_partkey * 3) % 90 + 1 AS qend, l_linenumber * 5 AS sstart, l_linenumber * 5 + CAST(l_quantity AS INT) AS send, l_tax AS evalue,
  l_suppkey % 20 AS sample, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate FROM {lineitem}"""
LINKS = """SELECT l_orderkey AS graph_id, 'n' || (l_suppkey % 5) || CASE WHEN l_linenumber % 2 = 0 THEN '+' ELSE '-' END AS src, 'n' || (l_partkey % 5) || CASE WHEN CAST(l_quantity AS INT) % 2 = 0 THEN '+' ELSE '-' END AS dst,
  (l_partkey % 8) || 'M' AS overlap, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate FROM {lineitem}"""
SECONDS = {"spark": "timestampdiff(SECOND, TIMESTAMP_NTZ '2000-01-01 00:00:00', ts)", "duck": "(floor(epoch(ts))::BIGINT - 946684800)"}
FEATURES = """SELECT event_id, user_id, CASE event_type WHEN 'click' THEN 'Antibiotics' WHEN 'view' THEN 'InsertionSequences' WHEN 'purchase' THEN 'Xenobiotics' ELSE 'CompTNs' END AS r_type,
  event_type || (event_id % 7) AS product, value AS score, CAST(floor((sec - min(sec) OVER (PARTITION BY user_id)) / 60) AS BIGINT) AS start, CAST(floor((sec - min(sec) OVER (PARTITION BY user_id)) / 60) AS BIGINT) + CAST(floor(value * 5) AS BIGINT) AS "end"
  FROM (SELECT *, {seconds} AS sec FROM {events}) x"""
BLOCKS = """SELECT event_id, user_id, CASE WHEN event_type IN ('click', 'purchase') THEN 'cargo' ELSE 'transposon' END AS annot, CAST(floor((sec - min(sec) OVER (PARTITION BY user_id)) / 60) AS BIGINT) AS q_start,
  CAST(floor((sec - min(sec) OVER (PARTITION BY user_id)) / 60) AS BIGINT) + CAST(floor(value * 3) AS BIGINT) AS q_end, event_id % 1000 AS r_start, event_id % 1000 + CAST(floor(value) AS BIGINT) AS r_end, 20000 AS read_len
  FROM (SELECT *, {seconds} AS sec FROM {events}) x"""
CANDIDATES = """SELECT o_orderkey, o_custkey % 50 AS sample, CAST(floor(o_totalprice / 10) AS BIGINT) AS length, CAST(1 + o_orderkey % 6 AS INT) AS components,
  'Cycle_' || o_orderkey || '-len' || CAST(floor(o_totalprice / 10) AS BIGINT) || '-comp' || (1 + o_orderkey % 6) || '-' AS name,
  (o_orderkey % 900 + 1) || '-' || (o_orderkey % 900 + 1 + o_custkey % 800) || CASE WHEN o_custkey % 3 = 0 THEN ';' || (2000 + o_custkey % 500) || '-' || (2100 + o_custkey % 700) ELSE '' END AS is_spans,
  CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN (3000 + o_custkey % 100) || '-' || (3500 + o_custkey % 100) ELSE (1 + o_custkey % 3000) || '-' || (50 + o_custkey % 3000) END AS gene_spans,
  CASE o_orderkey % 5 WHEN 0 THEN 'blaTEM-1;tetA;blaOXA' WHEN 1 THEN 'sul1;dfrA12' WHEN 2 THEN '' WHEN 3 THEN 'aadA2;aac(3)-II;qnrS1;merA' ELSE 'mphA;unknown gene;ermB' END AS genes FROM {orders}"""
SEQS = {
    "spark": "SELECT doc_id, upper(regexp_replace(lower(coalesce(text, '')), '[^acgt]', '')) AS seq FROM {documents}",
    "duck": "SELECT doc_id, upper(regexp_replace(lower(coalesce(text, '')), '[^acgt]', '', 'g')) AS seq FROM documents",
}
RC = "reverse(translate({s}, 'ACGTacgt', 'TGCAtgca'))"
K = 31


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """An adapter over the tables it names."""
    sql = sql.replace("{seconds}", SECONDS["spark"]).replace('"end"', "`end`")
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in set(re.findall(r"\{(\w+)\}", sql))})


def duck(sql: str) -> str:
    """The same adapter for DuckDB, which has the tables by name."""
    return re.sub(r"\{(\w+)\}", r"\1", sql.replace("{seconds}", SECONDS["duck"]))


def query(name: str, sql: str | None = None):
    def add(f):
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return add


def _all() -> None:
    """Register the queries of the other module too; it needs this one's helpers."""
    import transpark.catalog_io  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _all()
    return dict(_SQL)


# Hits and scores --------------------------------------------------------------------------------

BEST_SQL = f"""h AS ({duck(HITS)}),
b AS (SELECT *, length / slen * pident AS score, row_number() OVER (PARTITION BY qseqid ORDER BY length / slen * pident DESC, {ORD_SQL}) AS rn FROM h WHERE pident >= 80 AND evalue < 1e10 AND length / slen * pident > 50)"""


@query("best_hit_per_query", f"WITH {BEST_SQL} SELECT qseqid, sseqid, round(score, 6) AS score, least(qstart, qend) AS start, greatest(qstart, qend) AS \"end\", CASE WHEN qstart > qend THEN -1 ELSE 1 END AS strand FROM b WHERE rn = 1")
def best_hit_per_query(spark, sf):
    return H.best_hits(view(spark, sf, HITS), ORD).withColumn("score", F.round("score", 6))


@query("best_hit_protein", f"""WITH {BEST_SQL}, o AS (SELECT o_orderkey AS qseqid, o_custkey % 1000 + 1 AS "offset" FROM orders),
p AS (SELECT b.qseqid, sseqid, round(score, 6) AS score, (qstart - 1) * 3 + 1 + "offset" AS s, qend * 3 + "offset" AS e FROM b JOIN o USING (qseqid) WHERE rn = 1)
SELECT qseqid, sseqid, score, least(s, e) AS start, greatest(s, e) AS "end", CASE WHEN s > e THEN -1 ELSE 1 END AS strand FROM p""")
def best_hit_protein(spark, sf):
    offsets = view(spark, sf, "SELECT o_orderkey AS qseqid, o_custkey % 1000 + 1 AS offset FROM {orders}")
    return H.best_hits(view(spark, sf, HITS), ORD, offsets=offsets).withColumn("score", F.round("score", 6))


MERGED_SQL = f"""WITH h AS ({duck(HITS)}), k AS (SELECT *, least(sstart, send) AS a, greatest(sstart, send) AS z FROM h WHERE pident >= 80 AND evalue < 1e10),
m AS (SELECT *, CASE WHEN a > max(z) OVER w OR max(z) OVER w IS NULL THEN 1 ELSE 0 END AS f FROM k WINDOW w AS (PARTITION BY sample, qseqid, sseqid ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
i AS (SELECT *, sum(f) OVER (PARTITION BY sample, qseqid, sseqid ORDER BY a, z ROWS UNBOUNDED PRECEDING) AS isl FROM m),
u AS (SELECT sample, qseqid, sseqid, isl, max(z) - min(a) + 1 AS n FROM i GROUP BY ALL),
c AS (SELECT sample, qseqid, sseqid, sum(n) AS covered FROM u GROUP BY ALL),
s AS (SELECT sample, qseqid, sseqid, 50 AS slen, avg(pident) AS p, min(least(qstart, qend)) AS start, max(greatest(qstart, qend)) AS e FROM k GROUP BY ALL),
r AS (SELECT s.*, covered, covered / slen * p AS score FROM s JOIN c USING (sample, qseqid, sseqid)),
"""


@query("merged_best_subject", MERGED_SQL + """b AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY score DESC, qseqid, sseqid) AS rn FROM r WHERE score > 80)
SELECT sample, qseqid, sseqid, round(score, 6) AS score, covered::BIGINT AS covered, start, e AS "end", 1 AS strand FROM b WHERE rn = 1""")
def merged_best_subject(spark, sf):
    return H.merged_subjects(view(spark, sf, HITS), ["sample"], ORD).withColumn("score", F.round("score", 6))


INPUTS_SQL = f"""f AS ({duck(FEATURES)}), s AS (SELECT user_id, sum(CASE WHEN r_type = 'Antibiotics' THEN score ELSE 0 END) AS ant, sum(CASE WHEN r_type = 'InsertionSequences' THEN score ELSE 0 END) AS ins, sum(CASE WHEN r_type = 'Xenobiotics' THEN score ELSE 0 END) AS xeno,
  count(*) FILTER (r_type = 'Antibiotics') AS n_ant, count(*) FILTER (r_type = 'InsertionSequences') AS n_ins, count(*) FILTER (r_type = 'Xenobiotics') AS n_xeno, count(*) FILTER (r_type = 'CompTNs') AS n_comp FROM f GROUP BY user_id),
c AS ({duck(CANDIDATES)}), j AS (SELECT c.*, coalesce(ant, 0.0) AS ant, coalesce(ins, 0.0) AS ins, coalesce(xeno, 0.0) AS xeno, coalesce(n_ant, 0) AS n_ant, coalesce(n_ins, 0) AS n_ins, coalesce(n_xeno, 0) AS n_xeno, CASE WHEN length < 5850 THEN 0.0 ELSE least(abs(length - 5850.0) / 2586.0, 20.0) END AS z
  FROM c LEFT JOIN s ON s.user_id = c.o_orderkey)"""
SCORES_SQL = """w AS (SELECT *, 1 - (z + sqrt(abs(components - 2))) / 20.0 AS e FROM j), t AS (SELECT *,
  CASE WHEN ant + ins + xeno = 0 AND e < 0 THEN NULL ELSE pow(ant + ins + xeno, e) END AS score0,
  CASE WHEN n_ant + n_ins + n_xeno = 0 AND e < 0 THEN NULL ELSE pow(100.0 * (n_ant > 0)::INT + 100.0 * (n_ins > 0)::INT + 100.0 * (n_xeno > 0)::INT, e) END AS score1,
  90.0 * (n_ant + n_xeno > 0)::INT * (n_ins > 0)::INT + pow(10.0, e) AS score2 FROM w)"""
OLD_SCORES_SQL = """w AS (SELECT *, 1 - z / 20.0 AS e FROM j), t AS (SELECT *,
  CASE WHEN ant + ins + xeno = 0 AND e < 0 THEN NULL ELSE pow(ant + ins + xeno, e) END AS score0,
  CASE WHEN (CASE WHEN ant + xeno = 0 THEN 50.0 ELSE ant + xeno END) * (n_ins > 0)::INT = 0 AND e < 0 THEN NULL ELSE pow((CASE WHEN ant + xeno = 0 THEN 50.0 ELSE ant + xeno END) * (n_ins > 0)::INT, e) END AS score2 FROM w)"""


def _inputs(spark, sf):
    inputs = H.score_inputs(view(spark, sf, FEATURES), ["user_id"])
    joined = view(spark, sf, CANDIDATES).join(inputs, F.col("o_orderkey") == F.col("user_id"), "left")
    return joined.fillna(0, ["ant", "ins", "xeno", "n_ant", "n_ins", "n_xeno", "n_comp"])


def _scored(spark, sf, kinds=(0, 1, 2), with_components=True):
    args = [F.col(c) for c in ("ant", "ins", "xeno", "n_ant", "n_ins", "n_xeno", "length")]
    comp = F.col("components") if with_components else None
    return _inputs(spark, sf).withColumns({f"score{k}": H.composite_score(*args, comp, k) for k in kinds})


@query("score_inputs", f"WITH {INPUTS_SQL} SELECT user_id, round(ant, 4) AS ant, round(ins, 4) AS ins, round(xeno, 4) AS xeno, n_ant, n_ins, n_xeno, n_comp FROM s")
def score_inputs(spark, sf):
    out = H.score_inputs(view(spark, sf, FEATURES), ["user_id"])
    return out.select("user_id", *[F.round(c, 4).alias(c) for c in ("ant", "ins", "xeno")], "n_ant", "n_ins", "n_xeno", "n_comp")


@query("composite_score_v4", f"WITH {INPUTS_SQL}, {SCORES_SQL} SELECT o_orderkey, round(score0, 5) AS score0, round(score1, 5) AS score1, round(score2, 5) AS score2 FROM t")
def composite_score_v4(spark, sf):
    return _scored(spark, sf).select("o_orderkey", *[F.round(f"score{k}", 5).alias(f"score{k}") for k in (0, 1, 2)])


@query("composite_score_v3", f"WITH {INPUTS_SQL}, {OLD_SCORES_SQL} SELECT o_orderkey, round(score0, 5) AS score0, round(score2, 5) AS score2 FROM t")
def composite_score_v3(spark, sf):
    return _scored(spark, sf, (0, 2), False).select("o_orderkey", F.round("score0", 5).alias("score0"), F.round("score2", 5).alias("score2"))


RANK_SQL = f"""WITH {BEST_SQL}, g AS (SELECT l_suppkey, qseqid, score FROM b WHERE rn = 1), c AS ({duck(CANDIDATES)}),
j AS (SELECT c.*, coalesce(g.score, 0.0) AS hit, 1 - (CASE WHEN length < 5850 THEN 0.0 ELSE least(abs(length - 5850.0) / 2586.0, 20.0) END + sqrt(abs(components - 2))) / 20.0 AS e FROM c LEFT JOIN g ON g.qseqid = c.o_orderkey),
t AS (SELECT *, CASE WHEN hit = 0 AND e < 0 THEN NULL ELSE pow(hit, e) END AS score0 FROM j)
SELECT sample, o_orderkey, round(score0, 5) AS score0, row_number() OVER (PARTITION BY sample ORDER BY score0 DESC, o_orderkey)::INT AS rank FROM t WHERE score0 > 20"""


@query("rank_candidates", RANK_SQL)
def rank_candidates(spark, sf):
    """Hits to ranked candidates: identity filter, best hit, score, threshold, rank."""
    best = H.best_hits(view(spark, sf, HITS), ORD).select("qseqid", "score")
    cand = view(spark, sf, CANDIDATES).join(best, F.col("o_orderkey") == F.col("qseqid"), "left").withColumn("hit", F.coalesce("score", F.lit(0.0)))
    zero, none = F.lit(0.0), F.lit(0)
    cand = cand.withColumn("score0", H.composite_score(F.col("hit"), zero, zero, none, none, none, F.col("length"), F.col("components"), 0))
    return H.rank_candidates(cand, ["sample"], "score0", ["o_orderkey"], 20.0).select("sample", "o_orderkey", F.round("score0", 5).alias("score0"), "rank")


KINDS = {"ant": "Antibiotics", "is": "InsertionSequences", "xeno": "Xenobiotics"}
_PACK = ", ".join(f"""count(*) FILTER (r_type = '{t}') AS n_{k}, coalesce(string_agg(product, ';' ORDER BY start, event_id) FILTER (r_type = '{t}'), '') AS {k}_products,
  coalesce(string_agg(start || '-' || "end", ';' ORDER BY start, event_id) FILTER (r_type = '{t}'), '') AS {k}_spans""" for k, t in KINDS.items())


@query("pack_features", f"WITH f AS ({duck(FEATURES)}) SELECT user_id, {_PACK} FROM f GROUP BY user_id")
def pack_features(spark, sf):
    return H.pack_features(view(spark, sf, FEATURES), ["user_id"], ["start", "event_id"], KINDS)


@query("hit_counts_full_outer", f"""WITH h AS ({duck(HITS)}), a AS (SELECT qseqid, count(*) AS hits, string_agg(DISTINCT sseqid::VARCHAR, ',' ORDER BY sseqid::VARCHAR) AS subjects FROM h WHERE length / qlen >= 0.5 AND sample % 2 = 0 GROUP BY 1),
b AS (SELECT qseqid, count(*) AS hits, string_agg(DISTINCT sseqid::VARCHAR, ',' ORDER BY sseqid::VARCHAR) AS subjects FROM h WHERE length / qlen >= 0.5 AND sample % 2 = 1 GROUP BY 1)
SELECT qseqid, coalesce(a.hits, 0) AS even_hits, coalesce(a.subjects, '') AS even_subjects, coalesce(b.hits, 0) AS odd_hits, coalesce(b.subjects, '') AS odd_subjects FROM a FULL JOIN b USING (qseqid)""")
def hit_counts_full_outer(spark, sf):
    hits = view(spark, sf, HITS).withColumn("sseqid", F.col("sseqid").cast("string"))
    parts = {n: H.hit_counts(hits.where(F.col("sample") % 2 == i)) for i, n in enumerate(("even", "odd"))}
    return H.joined_counts(parts)


@query("top5_summary", "SELECT o_orderkey, o_totalprice AS score FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def top5_summary(spark, sf):
    return H.top_summary(table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("score")), "score", ["o_orderkey"])


@query("category_summary", """SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'Novel' ELSE 'Known' END AS category, count(*) AS n, count(DISTINCT o_custkey % 50) AS samples FROM orders GROUP BY 1""")
def category_summary(spark, sf):
    cat = F.when(F.col("o_orderpriority") == "1-URGENT", "Novel").otherwise("Known")
    return table(spark, sf, "orders").groupBy(cat.alias("category")).agg(F.count("*").alias("n"), F.countDistinct(F.col("o_custkey") % 50).alias("samples"))


# Intervals --------------------------------------------------------------------------------------

ISLANDS_SQL = f"""WITH f AS ({duck(FEATURES)}), m AS (SELECT *, CASE WHEN start > max("end") OVER w OR max("end") OVER w IS NULL THEN 1 ELSE 0 END AS fresh FROM f WINDOW w AS (PARTITION BY user_id, r_type ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id, r_type ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS isl FROM m),
u AS (SELECT user_id, r_type, isl, min(start) AS start, max("end") AS "end" FROM i GROUP BY ALL)
"""


@query("interval_union", ISLANDS_SQL + 'SELECT user_id, r_type, start, "end" FROM u')
def interval_union(spark, sf):
    return I.merge_intervals(view(spark, sf, FEATURES), ["user_id", "r_type"])


@query("covered_length", ISLANDS_SQL + 'SELECT user_id, r_type, sum("end" - start + 1)::BIGINT AS covered FROM u GROUP BY ALL')
def covered_length(spark, sf):
    return I.covered_length(view(spark, sf, FEATURES), ["user_id", "r_type"])


COVERAGE_SQL = f"""WITH f AS ({duck(FEATURES)}), e AS (SELECT user_id, start AS p, 1 AS d FROM f WHERE start < "end" UNION ALL SELECT user_id, "end", -1 FROM f WHERE start < "end"),
s AS (SELECT user_id, p, sum(d) AS d FROM e GROUP BY ALL), r AS (SELECT user_id, p AS start, lead(p) OVER w AS "end", sum(d) OVER w AS depth FROM s WINDOW w AS (PARTITION BY user_id ORDER BY p))
SELECT user_id, start, "end", depth::BIGINT AS depth FROM r WHERE depth > 0"""


@query("interval_coverage", COVERAGE_SQL)
def interval_coverage(spark, sf):
    return I.depth_runs(view(spark, sf, FEATURES), ["user_id"])


@query("coverage_tree", f"""WITH c AS ({COVERAGE_SQL}), z AS (SELECT unnest(range(4, 7)) AS level), p AS (SELECT user_id, start, "end", depth, level, unnest(range(start >> level, (("end" - 1) >> level) + 1)) AS bin FROM c, z)
SELECT user_id, level::INT AS level, bin::BIGINT AS bin, round(sum(depth * (least("end", (bin + 1) << level) - greatest(start, bin << level))) / pow(2, level), 6) AS mean, max(depth)::BIGINT AS top FROM p GROUP BY user_id, level, bin""")
def coverage_tree(spark, sf):
    """Three levels, from bins of 16 bases on."""
    from transpark.operators.alignments import coverage_tree as tree

    runs = I.depth_runs(view(spark, sf, FEATURES), ["user_id"])
    return tree(runs, ["user_id"], 4, 3).withColumn("mean", F.round("mean", 6))


@query("overlap_anti_join", f"""WITH f AS ({duck(FEATURES)}) SELECT event_id, user_id, start, "end" FROM f x WHERE r_type = 'Xenobiotics' AND NOT EXISTS (SELECT 1 FROM f i WHERE i.r_type = 'InsertionSequences' AND i.user_id = x.user_id AND NOT (x."end" < i.start OR x.start > i."end"))""")
def overlap_anti_join(spark, sf):
    f = view(spark, sf, FEATURES)
    left = f.where("r_type = 'Xenobiotics'").select("event_id", "user_id", "start", "end")
    return I.without_overlap(left, f.where("r_type = 'InsertionSequences'"), ["user_id"])


@query("block_merge", f"""WITH b AS ({duck(BLOCKS)}), m AS (SELECT *, CASE WHEN q_start > max(q_end) OVER w + 50 OR max(q_end) OVER w IS NULL THEN 1 ELSE 0 END AS fresh FROM b WINDOW w AS (PARTITION BY user_id, annot ORDER BY q_start, q_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id, annot ORDER BY q_start, q_end ROWS UNBOUNDED PRECEDING) AS isl FROM m)
SELECT user_id, annot, arg_min(r_start, (q_start, q_end, r_start)) AS r_start, max(r_end) AS r_end, min(q_start) AS q_start, max(q_end) AS q_end, min(read_len) AS read_len FROM i GROUP BY user_id, annot, isl""")
def block_merge(spark, sf):
    return I.merge_blocks(view(spark, sf, BLOCKS), ["user_id", "annot"])


@query("block_segmentation", """WITH p AS (SELECT l_suppkey, l_orderkey AS o, l_linenumber AS ln, l_partkey AS pk, l_extendedprice AS x, l_orderkey AS q, l_orderkey + l_linenumber AS r FROM lineitem),
m AS (SELECT *, CASE WHEN abs(q - lag(q) OVER w) > 150 OR abs(r - lag(r) OVER w) > 150 THEN 1 ELSE 0 END AS f FROM p WINDOW w AS (PARTITION BY l_suppkey ORDER BY o, ln, pk, x)),
i AS (SELECT *, sum(f) OVER (PARTITION BY l_suppkey ORDER BY o, ln, pk, x ROWS UNBOUNDED PRECEDING) AS block FROM m)
SELECT l_suppkey, block::BIGINT AS block, arg_min(r, (o, ln, pk, x)) AS r_start, arg_max(r, (o, ln, pk, x)) AS r_end, arg_min(q, (o, ln, pk, x)) AS q_start, arg_max(q, (o, ln, pk, x)) AS q_end FROM i GROUP BY l_suppkey, block HAVING arg_max(r, (o, ln, pk, x)) - arg_min(r, (o, ln, pk, x)) + 1 >= 100""")
def block_segmentation(spark, sf):
    li = table(spark, sf, "lineitem").select("l_suppkey", F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").alias("ord"), F.col("l_orderkey").alias("q"), (F.col("l_orderkey") + F.col("l_linenumber")).alias("r"))
    return I.segment_pairs(li, ["l_suppkey"], "ord", 150, 100)


@query("greedy_nonoverlap", f"""WITH f AS ({duck(FEATURES)}), z AS (SELECT user_id, r_type, unnest(list_reduce(list_prepend([], list([{{'start': start, 'event_id': event_id, 'end': "end"}}] ORDER BY start, event_id)),
  lambda acc, x: CASE WHEN len(list_filter(acc, lambda y: greatest(0, least(x[1]['end'], y['end']) - greatest(x[1]['start'], y['start']) + 1) / least(x[1]['end'] - x[1]['start'] + 1, y['end'] - y['start'] + 1) > 0.8)) > 0 THEN acc ELSE acc || x END)) AS k FROM f GROUP BY user_id, r_type)
SELECT user_id, r_type, k['start'] AS start, k['event_id'] AS event_id, k['end'] AS "end" FROM z""")
def greedy_nonoverlap(spark, sf):
    return I.greedy_filter(view(spark, sf, FEATURES).select("user_id", "r_type", "start", "event_id", "end"), ["user_id", "r_type"], ["start", "event_id"])


@query("histogram30", """WITH e AS (SELECT value::DOUBLE AS v, min(value) OVER () AS lo, max(value) OVER () AS hi FROM events)
SELECT least(29, floor(coalesce((v - lo) * 30 / nullif(hi - lo, 0), 0)))::BIGINT AS bin, count(*) AS n FROM e GROUP BY 1""")
def histogram30(spark, sf):
    return I.histogram(table(spark, sf, "events"), "value")


def in_order(name: str, group: str, item: str, kind: str) -> str:
    """CTEs that go through ``items`` (group, item) in order and keep those that no kept one of
    ``conflicts`` (group, later, earlier) is in the way of: name (group, kept)."""
    return f"""{name}_l AS (SELECT i.{group}, i.{item}, list(c.earlier) FILTER (c.earlier IS NOT NULL) AS conf FROM items i LEFT JOIN conflicts c ON c.{group} = i.{group} AND c.later = i.{item} GROUP BY ALL),
{name} AS (SELECT {group}, unnest(list_reduce(list_prepend([]::{kind}[], list(list_prepend({item}, coalesce(conf, [])) ORDER BY {item})), lambda acc, x: CASE WHEN list_has_any(acc, x[2:]) THEN acc ELSE list_append(acc, x[1]) END)) AS kept FROM {name}_l GROUP BY {group})"""


# Sequences --------------------------------------------------------------------------------------


@query("reverse_complement", f"WITH s AS ({SEQS['duck']}) SELECT doc_id, md5({RC.format(s='seq')}) AS rc, length(seq) AS len FROM s")
def reverse_complement(spark, sf):
    return view(spark, sf, SEQS["spark"]).select("doc_id", F.md5(S.reverse_complement(F.col("seq"))).alias("rc"), F.length("seq").cast("long").alias("len"))


@query("kmer_set_size", f"WITH s AS ({SEQS['duck']}) SELECT doc_id, CASE WHEN length(seq) >= {K} THEN len(list_distinct(list_transform(range(1, length(seq) - {K} + 2), lambda i: substr(seq, i, {K})))) ELSE 0 END::INT AS n FROM s")
def kmer_set_size(spark, sf):
    return view(spark, sf, SEQS["spark"]).select("doc_id", F.size(S.kmer_set(F.col("seq"), K)).alias("n"))


FIRST_SQL = f"""s AS ({SEQS['duck']}), c AS (SELECT doc_id, seq, min(doc_id) OVER (PARTITION BY least(seq, {RC.format(s='seq')})) AS f FROM s), u AS (SELECT doc_id, seq FROM c WHERE doc_id = f AND length(seq) >= {K}),
a AS (SELECT doc_id, unnest(list_distinct(list_transform(range(1, length(seq) - {K} + 2), lambda i: substr(seq, i, {K})))) AS k FROM u),
z AS (SELECT doc_id, count(*) AS n FROM a GROUP BY 1), o AS (SELECT doc_id, k FROM a UNION SELECT doc_id, {RC.format(s='k')} FROM a),
p AS (SELECT a.doc_id AS later, o.doc_id AS earlier, count(*) AS shared, min(n) AS size FROM a JOIN o USING (k) JOIN z ON z.doc_id = a.doc_id WHERE o.doc_id < a.doc_id GROUP BY 1, 2)"""


@query("kmer_containment_pairs", f"WITH {FIRST_SQL} SELECT later, earlier, shared, size::INT AS size, round(shared * 100.0 / size, 6) AS percent FROM p WHERE shared * 100.0 / size >= 50")
def kmer_containment_pairs(spark, sf):
    seqs = stored(view(spark, sf, SEQS["spark"]), "seqs")
    kept = seqs.join(N.exact_copies(seqs, "doc_id").where("doc_id = first").select("doc_id"), "doc_id", "left_semi")
    return N.containment_pairs(kept, K, "doc_id", least=50.0).withColumn("percent", F.round("percent", 6))


DEDUPE_SQL = f""", items AS (SELECT 0 AS one, doc_id FROM c WHERE doc_id = f OR length(seq) < {K}), conflicts AS (SELECT 0 AS one, later, earlier FROM p WHERE shared * 100.0 / size >= 80), {in_order("kd", "one", "doc_id", "BIGINT")} SELECT kept AS doc_id FROM kd"""


@query("sequence_alignments")
def sequence_alignments(spark, sf):
    """Identity and spans of sequences that share most of their k-mers, aligned here."""
    from transpark.operators.pairwise import align_all

    hits = align_all(view(spark, sf, SEQS["spark"]), K, 60.0, "doc_id")
    return hits.select("qseqid", "sseqid", F.round("pident", 6).alias("pident"), "length", "mismatch", "gaps", "qstart", "qend", "sstart", "send", "score")


@query("kmer_sketched_pairs", f"WITH {FIRST_SQL} SELECT later, earlier, shared, size::INT AS size, round(shared * 100.0 / size, 6) AS percent FROM p WHERE shared * 100.0 / size >= 70")
def kmer_sketched_pairs(spark, sf):
    seqs = stored(view(spark, sf, SEQS["spark"]), "seqs")
    kept = seqs.join(N.exact_copies(seqs, "doc_id").where("doc_id = first").select("doc_id"), "doc_id", "left_semi")
    return N.sketched_pairs(kept, K, 70.0, "doc_id").withColumn("percent", F.round("percent", 6))


@query("kmer_dedupe", f"WITH {FIRST_SQL}{DEDUPE_SQL}")
def kmer_dedupe(spark, sf):
    return N.kmer_dedupe(view(spark, sf, SEQS["spark"]), K, 80.0, "doc_id").select("doc_id")


@query("kmer_dedupe_one_strand", f"WITH {FIRST_SQL.replace(f' UNION SELECT doc_id, {RC.format(s="k")} FROM a', '')}{DEDUPE_SQL}")
def kmer_dedupe_one_strand(spark, sf):
    return N.kmer_dedupe(view(spark, sf, SEQS["spark"]), K, 80.0, "doc_id", both_strands=False).select("doc_id")


SIM_SQL = f"""WITH s AS ({SEQS['duck']}), b AS (SELECT item_id, upper(regexp_replace(lower(text), '[^acgt]', '', 'g')) AS q FROM benchmark), j AS (SELECT doc_id, item_id, seq, q, {RC.format(s='seq')} AS rc FROM s JOIN b ON doc_id % (SELECT count(*) FROM b) = item_id)
"""


def _paired(spark, sf):
    b = table(spark, sf, "benchmark").select("item_id", F.upper(F.regexp_replace(F.lower("text"), "[^acgt]", "")).alias("q"))
    n = b.count()
    return view(spark, sf, SEQS["spark"]).withColumn("item_id", F.col("doc_id") % n).join(b, "item_id")


@query("chunk_similarity", SIM_SQL + """SELECT doc_id, item_id, round(len(list_filter(list_transform(range(1, length(q) - 6 + 2, 6), lambda i: substr(q, i, 6)), lambda k: contains(seq, k) OR contains(rc, k))) * 100.0 / nullif(len(range(1, length(q) - 6 + 2, 6)), 0), 6) AS percent FROM j""")
def chunk_similarity(spark, sf):
    return _paired(spark, sf).select("doc_id", "item_id", F.round(N.chunk_similarity(F.col("seq"), F.col("q"), 6), 6).alias("percent"))


@query("kmer_occurrence_similarity", SIM_SQL + """SELECT doc_id, item_id, round(len(list_filter(list_transform(range(1, length(q) - 6 + 2), lambda i: substr(q, i, 6)), lambda k: contains(seq, k) OR contains(rc, k))) * 100.0 / nullif(len(range(1, length(q) - 6 + 2)), 0), 6) AS percent FROM j""")
def kmer_occurrence_similarity(spark, sf):
    return _paired(spark, sf).select("doc_id", "item_id", F.round(N.occurrence_similarity(F.col("seq"), F.col("q"), 6), 6).alias("percent"))


@query("exact_copies", f"WITH s AS ({SEQS['duck']}) SELECT doc_id, min(doc_id) OVER (PARTITION BY least(seq, {RC.format(s='seq')})) AS first FROM s")
def exact_copies(spark, sf):
    return N.exact_copies(view(spark, sf, SEQS["spark"]), "doc_id")


CIGAR = """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, (l_suppkey % 9 + 1) || 'S' || CAST(l_quantity AS INT) || 'M' || (l_linenumber) || 'I' || (l_partkey % 30 + 1) || 'M' || (l_suppkey % 4 + 1) || 'D' || (l_partkey % 7 + 1) || 'H' AS cigar, l_suppkey % 9 + 1 AS s, CAST(l_quantity AS INT) + l_partkey % 30 + 1 AS m, l_linenumber AS i, l_suppkey % 4 + 1 AS d, l_partkey % 7 + 1 AS h FROM {lineitem}"""


@query("cigar_spans", f"WITH c AS ({duck(CIGAR)}) SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, (m + i)::INT AS query_span, (m + d)::INT AS ref_span, s::INT AS left_clip, 0 AS right_clip, h::INT AS hard, round(m / 100.0, 6) AS identity FROM c")
def cigar_spans(spark, sf):
    c = F.col("cigar")
    clips = S.soft_clips(c)
    return view(spark, sf, CIGAR).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", S.query_span(c).alias("query_span"), S.reference_span(c).alias("ref_span"), clips["left"].alias("left_clip"), clips["right"].alias("right_clip"), S.hard_clips(c).alias("hard"), F.round(S.identity(c, F.lit(100.0)), 6).alias("identity"))


@query("supplementary_parts", """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, 'ref' || (l_suppkey % 3) AS ref, (l_partkey + 1)::INT AS start, (l_partkey + 1 + l_quantity::INT)::INT AS "end" FROM lineitem""")
def supplementary_parts(spark, sf):
    sa = F.expr("'ref' || (l_suppkey % 3) || ',' || (l_partkey + 1) || ',+,' || l_linenumber || 'S' || CAST(l_quantity AS INT) || 'M,60,0;'")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", F.explode(S.supplementary(sa)).alias("p")).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "p.*")


@query("id_parsing", f"""WITH c AS ({duck(CANDIDATES)}) SELECT o_orderkey, length::INT AS len, components AS comp, greatest(o_custkey_mod, CASE WHEN m3 = 0 THEN abs(100 + b - a) ELSE 0 END)::INT AS max_is, 'CT' || lpad(o_orderkey::VARCHAR, greatest(3, length(o_orderkey::VARCHAR))::INT, '0') AS tag
FROM (SELECT c.*, o_custkey % 800 AS o_custkey_mod, o_custkey % 3 AS m3, o_custkey % 500 AS a, o_custkey % 700 AS b FROM c JOIN orders USING (o_orderkey))""")
def id_parsing(spark, sf):
    return view(spark, sf, CANDIDATES).select("o_orderkey", S.id_length(F.col("name")).alias("len"), S.id_components(F.col("name")).alias("comp"), S.max_range_length(F.col("is_spans")).alias("max_is"), S.candidate_tag(F.col("o_orderkey")).alias("tag"))


NAMES = "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'gb|acc' || p_partkey || '|ARO:3000' || (p_partkey % 9) || '|gene' || p_size WHEN 1 THEN p_name WHEN 2 THEN 'prod' || p_size || ':gene' || p_partkey || '|x' ELSE 'a|b' END AS full FROM {part}"


@query("name_parsing", f"""WITH n AS ({duck(NAMES)}), p AS (SELECT *, string_split("full", '|') AS a, string_split(string_split("full", '|')[1], ':') AS x FROM n)
SELECT p_partkey, CASE WHEN len(a) >= 2 THEN a[-2] ELSE "full" END AS ant_product, a[-1] AS ant_gene, x[1] AS xeno_product, coalesce(x[2], "full") AS xeno_gene FROM p""")
def name_parsing(spark, sf):
    out = view(spark, sf, NAMES).withColumn("a", S.antibiotic_names(F.col("full"))).withColumn("x", S.xenobiotic_names(F.col("full")))
    return out.select("p_partkey", F.col("a.product").alias("ant_product"), F.col("a.gene").alias("ant_gene"), F.col("x.product").alias("xeno_product"), F.col("x.gene").alias("xeno_gene"))


# Graphs -----------------------------------------------------------------------------------------

FLIP = "translate({c}, '+-', '-+')"
EDGES_SQL = f"""l AS ({duck(LINKS)}), k AS (SELECT *, least(src || '>' || dst, {FLIP.format(c="dst")} || '>' || {FLIP.format(c="src")}) AS pair FROM l),
f AS (SELECT *, row_number() OVER (PARTITION BY graph_id, pair ORDER BY {ORD_SQL}, src, dst, overlap) AS rn FROM k),
e AS (SELECT graph_id, src, dst, overlap FROM f WHERE rn = 1 UNION ALL SELECT graph_id, {FLIP.format(c="dst")}, {FLIP.format(c="src")}, overlap FROM f WHERE rn = 1 AND NOT (src = {FLIP.format(c="dst")} AND dst = {FLIP.format(c="src")}))"""


def _edges(spark, sf):
    return G.double_strands(view(spark, sf, LINKS), ["graph_id"], ORD)


def _stored_edges(spark, sf):
    """Edges for queries that need them several times."""
    return stored(_edges(spark, sf).select("graph_id", "src", "dst", "overlap"), "edges")


@query("strand_doubled_edges", f"WITH {EDGES_SQL} SELECT graph_id, src, dst, overlap FROM e")
def strand_doubled_edges(spark, sf):
    return _edges(spark, sf).select("graph_id", "src", "dst", "overlap")


WALKS = "SELECT w.graph_id, path || [dst] AS path FROM w JOIN e ON e.graph_id = w.graph_id AND e.src = path[-1] AND NOT list_contains(path, dst) AND len(path) < 25"
CYCLES_SQL = f"""WITH RECURSIVE {EDGES_SQL}, w AS (SELECT DISTINCT graph_id, [src] AS path FROM e UNION ALL {WALKS} AND dst > path[1]),
y AS (SELECT DISTINCT w.graph_id, path FROM w JOIN e ON e.graph_id = w.graph_id AND e.src = path[-1] AND e.dst = path[1])
"""


@query("simple_cycles", CYCLES_SQL + "SELECT graph_id, array_to_string(path, ',') AS path FROM y")
def simple_cycles(spark, sf):
    return G.simple_cycles(_edges(spark, sf), ["graph_id"]).select("graph_id", F.array_join("path", ",").alias("path"))


@query("hairpin_paths", f"""WITH RECURSIVE {EDGES_SQL}, w AS (SELECT DISTINCT graph_id, [src] AS path FROM e UNION ALL {WALKS})
SELECT DISTINCT w.graph_id, array_to_string(path, ',') AS path FROM w JOIN e ON e.graph_id = w.graph_id AND e.src = path[-1] AND e.dst = {FLIP.format(c="path[1]")}""")
def hairpin_paths(spark, sf):
    return G.hairpin_paths(_edges(spark, sf), ["graph_id"]).select("graph_id", F.array_join("path", ",").alias("path"))


@query("dfs_cycles")
def dfs_cycles(spark, sf):
    edges = _edges(spark, sf).withColumn("ord", F.row_number().over(Window.partitionBy("graph_id").orderBy(*ORD, "turn")))
    return G.dfs_cycles(edges.select("graph_id", "src", "dst", "ord"), ["graph_id"]).select("graph_id", "ord", F.array_join("path", ",").alias("path"), "hairpin")


def _nodes(edges):
    """A sequence for every node of every graph, made from its name."""
    n = edges.select("graph_id", F.explode(F.array("src", "dst")).alias("node")).distinct()
    plus = F.expr("repeat('ACGGT', 1 + CAST(substr(node, 2, 1) AS INT)) || repeat('T', CAST(graph_id % 5 AS INT)) || 'AACC'")
    return n.withColumn("seq", F.when(F.col("node").endswith("+"), plus).otherwise(S.reverse_complement(plus)))


NODES_SQL = f"""nn AS (SELECT graph_id, src AS node FROM e UNION SELECT graph_id, dst FROM e), nq AS (SELECT *, repeat('ACGGT', 1 + substr(node, 2, 1)::INT) || repeat('T', (graph_id % 5)::INT) || 'AACC' AS p FROM nn),
ns AS (SELECT graph_id, node, CASE WHEN ends_with(node, '+') THEN p ELSE {RC.format(s='p')} END AS seq FROM nq)"""


@query("path_sequence", CYCLES_SQL + f""", {NODES_SQL}, s AS (SELECT graph_id, path, i, path[i] AS a, path[i + 1] AS b FROM (SELECT graph_id, path, unnest(range(1, len(path) + 1)) AS i FROM y)),
q AS (SELECT s.graph_id, s.path, i, CASE WHEN b IS NULL THEN seq ELSE substr(seq, 1, greatest(0, length(seq) - (SELECT min(replace(overlap, 'M', '')::INT) FROM e WHERE e.graph_id = s.graph_id AND e.src = s.a AND e.dst = s.b))) END AS part FROM s JOIN ns ON ns.graph_id = s.graph_id AND ns.node = s.a)
SELECT graph_id, array_to_string(path, ',') AS path, string_agg(part, '' ORDER BY i) AS sequence, len(path)::INT AS components FROM q GROUP BY graph_id, path HAVING sum(length(part)) BETWEEN 20 AND 100""")
def path_sequence(spark, sf):
    edges = _stored_edges(spark, sf)
    paths = G.simple_cycles(edges, ["graph_id"]).withColumn("path_id", F.array_join("path", ","))
    out = G.path_sequences(paths, _nodes(edges), edges, ["graph_id"])
    return G.in_size(out, 20, 100, 1, 25).select("graph_id", F.col("path_id").alias("path"), "sequence", "components")


OVERLAP_SQL = CYCLES_SQL + f""", {NODES_SQL}, x AS (SELECT graph_id, path, array_to_string(path, ',') AS id FROM y), p AS (SELECT graph_id, id, unnest(path) AS node FROM x), pl AS (SELECT p.*, regexp_replace(p.node, '[+-]$', '') AS contig, length(seq) AS n FROM p JOIN ns USING (graph_id, node)),
t AS (SELECT graph_id, id, sum(n) AS total, list_sort(list(DISTINCT contig)) AS contigs FROM pl GROUP BY ALL),
m AS (SELECT a.graph_id, a.id AS later, b.id AS earlier, sum(CASE WHEN a.node = b.node THEN a.n ELSE 0 END) AS shared FROM pl a JOIN pl b ON a.graph_id = b.graph_id AND a.contig = b.contig AND b.id < a.id GROUP BY ALL),
o AS (SELECT m.graph_id, later, earlier, shared * 100.0 / greatest(a.total, b.total) AS percent, a.contigs = b.contigs AS same_contigs FROM m JOIN t a ON a.graph_id = m.graph_id AND a.id = later JOIN t b ON b.graph_id = m.graph_id AND b.id = earlier)
"""


@query("path_overlap_pairs", OVERLAP_SQL + "SELECT graph_id, later, earlier, round(percent, 6) AS percent, same_contigs FROM o")
def path_overlap_pairs(spark, sf):
    edges = _stored_edges(spark, sf)
    paths = G.simple_cycles(edges, ["graph_id"]).withColumn("path_id", F.array_join("path", ","))
    nodes = _nodes(edges).withColumn("len", F.length("seq"))
    return G.path_overlap(paths, nodes, ["graph_id"]).withColumn("percent", F.round("percent", 6))


@query("path_dedupe", OVERLAP_SQL + f""", items AS (SELECT graph_id, id FROM x), conflicts AS (SELECT graph_id, later, earlier FROM o WHERE same_contigs OR percent > 70), {in_order("z", "graph_id", "id", "VARCHAR")} SELECT graph_id, kept AS path FROM z""")
def path_dedupe(spark, sf):
    edges = _stored_edges(spark, sf)
    paths = G.simple_cycles(edges, ["graph_id"]).withColumn("id", F.array_join("path", ","))
    # A path's order within all graphs: its graph, then its text.
    paths = paths.withColumn("path_id", F.format_string("%012d %s", "graph_id", "id"))
    nodes = _nodes(edges).withColumn("len", F.length("seq"))
    return G.dedupe_paths(paths, nodes, ["graph_id"]).select("graph_id", F.col("id").alias("path"))


ROT = "SELECT l_orderkey * 10 + l_linenumber AS ord, substr(repeat(chr(65 + CAST(l_suppkey % 2 AS INT) * 2) || 'GT' || chr(67 + CAST(l_partkey % 2 AS INT) * 4) || 'AT', 2), CAST(1 + l_linenumber % 6 AS INT), 6) AS seq, l_partkey AS pk, l_suppkey AS sk, l_extendedprice AS x, l_orderkey FROM {lineitem}"


@query("rotation_duplicates", f"""WITH r AS ({duck(ROT)}), s AS (SELECT seq, min(ord) AS ord FROM r GROUP BY seq) SELECT a.ord AS later, b.ord AS earlier FROM s a JOIN s b ON b.ord < a.ord AND length(a.seq) = length(b.seq) AND (contains(a.seq || a.seq, b.seq) OR contains({RC.format(s='a.seq')} || {RC.format(s='a.seq')}, b.seq))""")
def rotation_duplicates(spark, sf):
    seqs = view(spark, sf, ROT).groupBy("seq").agg(F.min("ord").alias("ord"))
    return G.rotation_pairs(seqs)


@query("cycle_analysis")
def cycle_analysis(spark, sf):
    """From the nodes and edges of all graphs to named cycles, by a configuration."""
    from transpark.plans.config import from_dict
    from transpark.plans.pipelines import cycle_analysis as analysed

    options = from_dict({"options": {"min_size": 20, "max_size": 100, "min_components": 1, "max_components": 25, "kmer": 25, "kmer_threshold": 95.0}}).options
    edges = _stored_edges(spark, sf)
    nodes = stored(_nodes(edges).withColumn("len", F.length("seq")), "nodes")
    return analysed(nodes, edges, ["graph_id"], options)


@query("rotation_classes", f"""WITH r AS ({duck(ROT)}), d AS (SELECT ord, seq, {RC.format(s='seq')} AS back FROM r WHERE length(seq) > 0),
k AS (SELECT ord, (SELECT min(substr(t.s, i, t.n)) FROM (SELECT unnest([seq || seq, back || back]) AS s, length(seq) AS n) t, unnest(range(1, t.n + 1)) u(i)) AS key FROM d)
SELECT ord, min(ord) OVER (PARTITION BY key) AS "first", count(*) OVER (PARTITION BY key) AS members FROM k""")
def rotation_classes(spark, sf):
    return G.rotation_classes(view(spark, sf, ROT))


@query("graph_quality", f"""WITH {EDGES_SQL}, c AS (SELECT DISTINCT graph_id, regexp_replace(n, '[+-]$', '') AS contig FROM (SELECT graph_id, src AS n FROM e UNION SELECT graph_id, dst FROM e)), d AS (SELECT graph_id, contig || s AS node FROM c, (VALUES ('+'), ('-')) v(s)),
q AS (SELECT c.graph_id, count(*) AS contigs, (SELECT count(*) FROM f WHERE f.graph_id = c.graph_id AND rn = 1) AS links, (SELECT count(*) FROM d WHERE d.graph_id = c.graph_id AND NOT EXISTS (SELECT 1 FROM e WHERE e.graph_id = d.graph_id AND e.src = d.node)) AS dead_ends FROM c GROUP BY 1),
s AS (SELECT *, links / (contigs * (dead_ends + 1.0) * (dead_ends + 1.0)) AS score FROM q)
SELECT graph_id, contigs, links, dead_ends, round(score, 8) AS score, round((score - min(score) OVER ()) / (max(score) OVER () - min(score) OVER ()), 8) AS relative FROM s""")
def graph_quality(spark, sf):
    edges = materialise(_edges(spark, sf).select("graph_id", "src", "dst", "turn"))
    segments = edges.select("graph_id", F.explode(F.array("src", "dst")).alias("n")).select("graph_id", S.strip_sign(F.col("n")).alias("contig")).distinct()
    out = G.graph_quality(segments, edges, ["graph_id"])
    return out.withColumn("score", F.round("score", 8)).withColumn("relative", F.round("relative", 8))


COMP = "SELECT o_orderkey AS src, CASE WHEN o_orderkey % 3 = 0 THEN floor(o_orderkey / 3) * 2 + 1 ELSE o_orderkey END AS dst FROM {orders}"
COMP_SQL = f"""WITH RECURSIVE g AS ({duck(COMP)}), b AS (SELECT src::BIGINT AS a, dst::BIGINT AS b FROM g UNION SELECT dst::BIGINT, src::BIGINT FROM g), r AS (SELECT a AS node, a AS root FROM b UNION SELECT b.b, root FROM r JOIN b ON b.a = r.node), c AS (SELECT node, min(root) AS component FROM r GROUP BY node)
"""


@query("components", COMP_SQL + "SELECT node, component FROM c")
def components(spark, sf):
    return C.connected_components(view(spark, sf, COMP).select("src", F.col("dst").cast("long").alias("dst")))


@query("cluster_tags", COMP_SQL + """, s AS (SELECT component, count(*) AS size FROM c GROUP BY 1), n AS (SELECT *, row_number() OVER (ORDER BY size DESC, component) AS nth FROM s)
SELECT node, CASE WHEN size = 1 THEN 'Unique' ELSE 'CTCluster' || lpad(nth::VARCHAR, greatest(3, length(nth::VARCHAR))::INT, '0') END AS cluster, size FROM c JOIN n USING (component)""")
def cluster_tags(spark, sf):
    return C.cluster_tags(components(spark, sf))


# Enrichment -------------------------------------------------------------------------------------

ELEMENTS = """SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'ISFinder_IS26-MH' || p_size WHEN 1 THEN 'ISEcp1' WHEN 2 THEN 'ISCR' || p_size WHEN 3 THEN 'IS' || p_size WHEN 4 THEN 'Tn' || p_size WHEN 5 THEN 'tn_' || p_size WHEN 6 THEN 'IS1_' || p_size ELSE p_name END AS element FROM {part}"""
_known = ", ".join(f"('{n}', '{g}', '{f}')" for n, (g, f) in E.KNOWN.items())
_series = " ".join(f"WHEN regexp_matches(base, '^{p.lower()}\\b') THEN '{g}|{f}'" for p, g, f in sorted(E.SERIES, key=lambda s: -len(s[0])))


@query("family_lookup", f"""WITH n AS ({duck(ELEMENTS)}), b AS (SELECT *, lower(regexp_replace(trim(element), '^({"|".join(E.SOURCES)})', '')) AS fll FROM n), x AS (SELECT *, regexp_split_to_array(fll, '[_:-]')[1] AS base FROM b), k(name, g, f) AS (VALUES {_known}),
r AS (SELECT x.*, CASE WHEN k1.g IS NOT NULL THEN k1.g || '|' || k1.f WHEN k2.g IS NOT NULL THEN k2.g || '|' || k2.f {_series} WHEN regexp_matches(fll, '^is[0-9]') THEN upper(regexp_extract(fll, '^(is[0-9]+)', 1)) || '|' || upper(regexp_extract(fll, '^(is[0-9]+)', 1)) WHEN regexp_matches(fll, '^tn[0-9]') THEN 'Composite|Composite' ELSE 'Unknown|Unknown' END AS v
  FROM x LEFT JOIN k k1 ON k1.name = base LEFT JOIN k k2 ON k2.name = fll)
SELECT p_partkey, element, split_part(v, '|', 1) AS is_group, split_part(v, '|', 2) AS is_family FROM r""")
def family_lookup(spark, sf):
    return E.element_family(view(spark, sf, ELEMENTS), "element")


_class = " ".join(f"WHEN regexp_matches(g, '(?i){p}') THEN '{c}'" for p, c in E.CLASSES)
GENES = """SELECT p_partkey, CASE p_partkey % 12 WHEN 0 THEN 'blaTEM-' || p_size WHEN 1 THEN 'tetA' WHEN 2 THEN ' aac(3)-II' WHEN 3 THEN 'qnrS' || p_size WHEN 4 THEN 'sul' || (p_size % 10) WHEN 5 THEN 'vanA' WHEN 6 THEN 'putative merC' WHEN 7 THEN 'mcr-1' WHEN 8 THEN 'xrmtB' WHEN 9 THEN 'floR cat' WHEN 10 THEN 'OXA-48' ELSE p_name END AS gene FROM {part}"""


@query("class_inference", f"WITH n AS ({duck(GENES)}), g AS (SELECT *, trim(gene) AS g FROM n) SELECT p_partkey, gene, CASE {_class} ELSE 'Other' END AS class FROM g")
def class_inference(spark, sf):
    return view(spark, sf, GENES).withColumn("class", E.resistance_class(F.col("gene")))


@query("class_expansion", f"""WITH c AS ({duck(CANDIDATES)}), x AS (SELECT o_orderkey, unnest(string_split(genes, ';')) AS gene, generate_subscripts(string_split(genes, ';'), 1) AS pos FROM c WHERE genes <> ''),
k AS (SELECT *, (SELECT CASE {_class} ELSE 'Other' END FROM (SELECT trim(x.gene) AS g)) AS class FROM x), r AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey, class ORDER BY pos) AS rn FROM k)
SELECT o_orderkey, trim(gene) AS gene, class FROM r WHERE rn = 1 UNION ALL SELECT o_orderkey, 'None', 'None' FROM c WHERE genes = ''""")
def class_expansion(spark, sf):
    return E.expand_classes(view(spark, sf, CANDIDATES), "o_orderkey", "genes").select("o_orderkey", "gene", "class")


@query("ontology_join", """WITH g AS (SELECT p_partkey, 'gb::aro:30' || (p_partkey % 40) AS gene, p_partkey % 40 AS i FROM part) SELECT p_partkey, gene, CASE WHEN i < 25 THEN n_name END AS aro_name, CASE WHEN i < 25 THEN 'class' || n_regionkey END AS aro_class FROM g LEFT JOIN nation ON n_nationkey = i""")
def ontology_join(spark, sf):
    genes = view(spark, sf, "SELECT p_partkey, 'gb::aro:30' || (p_partkey % 40) AS gene FROM {part}")
    index = view(spark, sf, "SELECT 'ARO:30' || n_nationkey AS aro_id, n_name AS aro_name, 'class' || n_regionkey AS aro_class FROM {nation}")
    return E.with_ontology(genes, "gene", index)


@query("boundary_split", f"""WITH c AS ({duck(CANDIDATES)}), o AS (SELECT o_orderkey, o_custkey FROM orders), b AS (SELECT c.o_orderkey, length, o_orderkey % 900 + 1 AS t_start, CASE WHEN o_custkey % 3 = 0 THEN 2100 + o_custkey % 700 ELSE o_orderkey % 900 + 1 + o_custkey % 800 END AS t_end,
  CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 3000 + o_custkey % 100 ELSE 1 + o_custkey % 3000 END AS g_lo, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 3500 + o_custkey % 100 ELSE 50 + o_custkey % 3000 END AS g_hi FROM c JOIN o USING (o_orderkey)),
r AS (SELECT *, length - t_end AS rt, t_start - 1 AS lf FROM b),
s AS (SELECT *, CASE WHEN g_lo > t_end THEN t_end + 1 WHEN g_hi < t_start THEN g_lo WHEN g_lo IS NOT NULL THEN NULL WHEN rt >= lf AND rt > 0 THEN t_end + 1 WHEN lf > rt THEN 1 END AS cs,
  CASE WHEN g_lo > t_end THEN g_hi WHEN g_hi < t_start THEN t_start - 1 WHEN g_lo IS NOT NULL THEN NULL WHEN rt >= lf AND rt > 0 THEN length WHEN lf > rt THEN t_start - 1 END AS ce FROM r)
SELECT o_orderkey, t_start::BIGINT AS t_start, t_end::BIGINT AS t_end, CASE WHEN ce > cs AND cs <> 0 AND ce <> 0 THEN cs END AS c_start, CASE WHEN ce > cs AND cs <> 0 AND ce <> 0 THEN ce END AS c_end FROM s""")
def boundary_split(spark, sf):
    out = E.split_boundaries(view(spark, sf, CANDIDATES), "length", "is_spans", "gene_spans")
    return out.select("o_orderkey", *[F.col(c).cast("long").alias(c) for c in ("t_start", "t_end", "c_start", "c_end")])


ENZYMATIC = ("thenb", "erion", "reon")
XENO = ("inth", "atea")
EXCLUDED = ("ounderst", "schen")


@query("keyword_classifier", f"""SELECT doc_id, CASE WHEN {" OR ".join(f"contains(lower(text), '{k}')" for k in EXCLUDED)} THEN 'excluded' WHEN {" OR ".join(f"contains(lower(text), '{k}')" for k in ENZYMATIC)} THEN 'enzymatic' WHEN {" OR ".join(f"contains(lower(text), '{k}')" for k in XENO)} THEN 'xenobiotic' ELSE 'other' END AS class FROM documents""")
def keyword_classifier(spark, sf):
    return table(spark, sf, "documents").select("doc_id", E.keyword_class(F.col("text"), list(ENZYMATIC), list(XENO), list(EXCLUDED)).alias("class"))


@query("keyword_counts", " UNION ALL ".join(f"SELECT '{k}' AS keyword, count(*) AS n FROM documents WHERE contains(lower(text), '{k}') HAVING count(*) > 0" for k in ENZYMATIC + XENO + EXCLUDED))
def keyword_counts(spark, sf):
    return E.keyword_counts(table(spark, sf, "documents"), "text", list(ENZYMATIC + XENO + EXCLUDED))


WORDS_SQL = "SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{5,}')) AS keyword FROM benchmark"


def _keyword_table(spark, sf):
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{5,}"), F.lit(0))).alias("keyword")
    return table(spark, sf, "benchmark").select(words).distinct()


@query("keyword_table_counts", f"WITH k AS ({WORDS_SQL}) SELECT keyword, count(*) AS n FROM k JOIN documents ON contains(lower(text), keyword) GROUP BY keyword")
def keyword_table_counts(spark, sf):
    """Thousands of keywords in one pass."""
    found = E.keyword_matches(table(spark, sf, "documents"), _keyword_table(spark, sf), "text", ["doc_id"])
    return found.groupBy("keyword").agg(F.count("*").alias("n"))


@query("keyword_table_classes", f"WITH k AS (SELECT keyword, 'of' || (length(keyword) % 4) AS class, length(keyword) AS rank FROM ({WORDS_SQL}) WHERE length(keyword) > 9), m AS (SELECT doc_id, arg_min(class, (rank, class)) AS class FROM documents JOIN k ON contains(lower(text), keyword) GROUP BY doc_id) SELECT doc_id, coalesce(class, 'other') AS class FROM documents LEFT JOIN m USING (doc_id)")
def keyword_table_classes(spark, sf):
    words = _keyword_table(spark, sf).where(F.length("keyword") > 9)
    words = words.select("keyword", F.concat(F.lit("of"), F.length("keyword") % 4).alias("class"), F.length("keyword").alias("rank"))
    return E.keyword_table_classes(table(spark, sf, "documents"), words, "text", ["doc_id"])


@query("candidate_tags", "SELECT o_orderkey, 'CT' || lpad(n::VARCHAR, greatest(3, length(n::VARCHAR))::INT, '0') AS ct_tag FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS n FROM orders)")
def candidate_tags(spark, sf):
    return E.tag_candidates(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"]).select("o_orderkey", "ct_tag")


# Reads ------------------------------------------------------------------------------------------


@query("read_pattern_class", f"""WITH b AS ({duck(BLOCKS)}), s AS (SELECT user_id, string_agg(CASE WHEN annot = 'cargo' THEN 'c' ELSE 't' END, '' ORDER BY q_start, event_id) AS l FROM b GROUP BY 1)
SELECT user_id, CASE WHEN regexp_matches(l, 'c.*t.*c') THEN 'full' ELSE 'partial' END AS class FROM s WHERE regexp_matches(l, 'c.*t|t.*c')""")
def read_pattern_class(spark, sf):
    letters = R.read_letters(view(spark, sf, BLOCKS), "user_id", ["q_start", "event_id"])
    return letters.select("user_id", R.read_class(F.col("letters")).alias("class")).where("class is not null")


GAPS_SQL = f"""b AS ({duck(BLOCKS)}), g AS (SELECT user_id, event_id, q_start, q_end, annot AS prev_kind, lead(annot) OVER w AS next_kind, lead(q_start) OVER w - q_end AS gap FROM b WINDOW w AS (PARTITION BY user_id ORDER BY q_start, event_id)),
gg AS (SELECT * FROM g WHERE next_kind IS NOT NULL), e AS (SELECT prev_kind, next_kind, gap, count(*) AS n, min((user_id, q_start, event_id)) AS f FROM gg GROUP BY ALL),
m AS (SELECT prev_kind, next_kind, arg_min(gap, (-n, f)) AS mode_gap, sum(n) AS n, sum(gap * n) / sum(n) AS mean_gap, max(gap) AS max_gap FROM e GROUP BY ALL),
st AS (SELECT m.*, (SELECT coalesce(sum(e.n), 0) FROM e WHERE e.prev_kind = m.prev_kind AND e.next_kind = m.next_kind AND e.gap > greatest(201, trunc(m.mode_gap * 1.2))) AS large_n FROM m)"""


@query("gap_statistics", f"WITH {GAPS_SQL} SELECT prev_kind, next_kind, n::BIGINT AS n, round(mean_gap, 6) AS mean_gap, max_gap, mode_gap, large_n::BIGINT AS large_n FROM st")
def gap_statistics(spark, sf):
    gaps = R.block_gaps(view(spark, sf, BLOCKS), "user_id", ["q_start", "event_id"])
    return R.gap_statistics(gaps, ["user_id", "q_start", "event_id"]).withColumn("mean_gap", F.round("mean_gap", 6))


_starts = " UNION ALL ".join(
    f"SELECT user_id, '{p}' AS pattern, q_start AS start, lead_end[{len(p)}] AS \"end\" FROM r WHERE starts_with(spell, '{p}') AND len(list_filter(oks[1:{len(p) - 1}], lambda x: x)) = {len(p) - 1}" for p in R.PATTERNS
)
WINDOWS_SQL = f"""WITH {GAPS_SQL}, j AS (SELECT g.*, s.mode_gap, s.n, s.large_n, k.mode_gap AS back FROM g LEFT JOIN st s USING (prev_kind, next_kind) LEFT JOIN st k ON k.prev_kind = g.next_kind AND k.next_kind = g.prev_kind),
v AS (SELECT *, CASE WHEN next_kind IS NULL THEN false WHEN -gap > 300 THEN false WHEN gap <= 200 THEN true WHEN mode_gap IS NULL THEN gap <= 1000 WHEN gap > 5000 THEN false WHEN abs(gap - mode_gap) <= 200 THEN true
  WHEN gap > greatest(200, trunc(mode_gap * 1.2)) THEN large_n / n >= 0.25 WHEN back IS NOT NULL AND gap > greatest(200, trunc(least(back, 10000) * 1.2)) THEN true ELSE gap <= least(5000, greatest(1000, trunc(mode_gap * 1.5))) END AS ok FROM j),
r AS (SELECT user_id, q_start, string_agg(CASE WHEN prev_kind = 'cargo' THEN 'C' ELSE 'T' END, '') OVER w AS spell, list(q_end) OVER w AS lead_end, list(ok) OVER w AS oks FROM v WINDOW w AS (PARTITION BY user_id ORDER BY q_start, event_id ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING)),
p AS ({_starts})
"""


@query("adjacent_patterns", WINDOWS_SQL + 'SELECT user_id, pattern, start, "end" FROM p')
def adjacent_patterns(spark, sf):
    return R.pattern_windows(view(spark, sf, BLOCKS), "user_id", ["q_start", "event_id"])


@query("pattern_counts", WINDOWS_SQL + "SELECT user_id::VARCHAR AS run, pattern, count(*) AS n FROM p GROUP BY GROUPING SETS ((user_id, pattern), (pattern))")
def pattern_counts(spark, sf):
    return R.pattern_counts(adjacent_patterns(spark, sf), "user_id")


@query("insertions", f"WITH {GAPS_SQL} SELECT user_id, CASE WHEN prev_kind = 'cargo' THEN 'cargo-inserted-transposon' ELSE 'transposon-in-cargo' END AS event, count(*) AS n FROM gg WHERE -gap > 300 AND prev_kind <> next_kind GROUP BY ALL")
def insertions(spark, sf):
    return R.insertions(R.block_gaps(view(spark, sf, BLOCKS), "user_id", ["q_start", "event_id"]), "user_id")


PARTS = """SELECT l_orderkey AS read_id, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CASE WHEN l_suppkey % 2 = 0 THEN 'cargo' ELSE 'transposon' END AS kind, l_partkey % 900 AS start, l_partkey % 900 + CAST(l_quantity AS INT) * 10 AS "end" FROM {lineitem}"""


@query("circular_span", f"""WITH p AS ({duck(PARTS)}) SELECT read_id, count(*) AS parts, min(start) AS low, max("end") AS high, sum("end" - start)::BIGINT AS aligned FROM p GROUP BY read_id HAVING sum("end" - start) BETWEEN 1000 * 0.5 AND 1000 * 1.5 AND count(*) >= 2 AND min(start) < 100 AND max("end") > 900""")
def circular_span(spark, sf):
    return R.circular_by_span(view(spark, sf, PARTS), "read_id", 1000)


@query("circular_ordered", f"""WITH p AS ({duck(PARTS)}), n AS (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn FROM p), a AS (SELECT read_id, min(rn) AS t1 FROM n WHERE kind = 'cargo' AND "end" > 600 GROUP BY 1),
b AS (SELECT read_id, min(rn) AS t2 FROM n JOIN a USING (read_id) WHERE rn > t1 AND kind = 'transposon' AND start <= 300 AND "end" >= 200 GROUP BY 1)
SELECT DISTINCT read_id FROM n JOIN b USING (read_id) WHERE rn > t2 AND kind = 'cargo' AND start < 400""")
def circular_ordered(spark, sf):
    return R.circular_in_order(view(spark, sf, PARTS), "read_id", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], 1000, 500, 400, 300)


@query("circular_wrap", f"""WITH p AS ({duck(PARTS)}), c AS (SELECT read_id, count(*) AS n FROM p GROUP BY 1)
SELECT DISTINCT read_id FROM p JOIN c USING (read_id) WHERE ("end" > 900 AND start < 100) OR (n > 1 AND "end" > 900 AND start >= 100 AND EXISTS (SELECT 1 FROM p q WHERE q.read_id = p.read_id AND q.start < 100 AND q."end" <= 900 AND (p."end" - p.start) + (q."end" - q.start) > 500))""")
def circular_wrap(spark, sf):
    return R.circular_by_wrap(view(spark, sf, PARTS), "read_id", 1000, share=0.5)


# Merging and set operations ---------------------------------------------------------------------


@query("final_left_merge", """WITH m AS (SELECT user_id AS cycle, user_id % 50 AS sample, count(*) AS blocks FROM events GROUP BY 1, 2), s AS (SELECT DISTINCT o_custkey % 50 AS sample FROM orders ), f AS (SELECT o_orderkey AS cycle, o_custkey % 50 AS sample, o_totalprice AS score FROM orders)
SELECT m.sample, m.cycle, blocks, score FROM m SEMI JOIN s ON s.sample = m.sample LEFT JOIN f ON f.cycle = m.cycle AND f.sample = m.sample""")
def final_left_merge(spark, sf):
    from transpark.plans.pipelines import merge_final

    mapping = view(spark, sf, "SELECT user_id AS cycle, user_id % 50 AS sample, count(*) AS blocks FROM {events} GROUP BY 1, 2")
    scores = view(spark, sf, "SELECT o_orderkey AS cycle, o_custkey % 50 AS sample, o_totalprice AS score FROM {orders}")
    samples = view(spark, sf, "SELECT DISTINCT o_custkey % 50 AS sample FROM {orders}")
    return merge_final(mapping, scores, samples)


@query("sample_pairs", """SELECT trim(s) AS short_id, CASE WHEN trim(l) IN ('', '-', 'null', 'None') THEN NULL ELSE trim(l) END AS long_id FROM (SELECT ' S' || c_custkey || ' ' AS s, CASE c_custkey % 5 WHEN 0 THEN ' - ' WHEN 1 THEN 'null' WHEN 2 THEN '' WHEN 3 THEN ' L' || c_custkey ELSE NULL END AS l FROM customer)""")
def sample_pairs(spark, sf):
    from transpark.sources.readers import sample_pairs as pairs

    return pairs(view(spark, sf, "SELECT ' S' || c_custkey || ' ' AS s, CASE c_custkey % 5 WHEN 0 THEN ' - ' WHEN 1 THEN 'null' WHEN 2 THEN '' WHEN 3 THEN ' L' || c_custkey ELSE NULL END AS l FROM {customer}"), "s", "l")


@query("distinct_union", "SELECT p_partkey AS id FROM part UNION SELECT s_suppkey FROM supplier")
def distinct_union(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id")).union(table(spark, sf, "supplier").select("s_suppkey")).distinct()


@query("batching", "SELECT o_orderkey, floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 200)::BIGINT AS batch FROM orders")
def batching(spark, sf):
    from transpark.plans.pipelines import in_batches

    return in_batches(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 200)


@query("id_set_filter", "SELECT o_orderkey FROM orders SEMI JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') r ON o_orderkey = l_orderkey")
def id_set_filter(spark, sf):
    wanted = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf, "orders").select("o_orderkey").join(wanted, "o_orderkey", "left_semi")

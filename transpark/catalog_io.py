"""Round trips: queries that write a projection to the shared folder and read it back, and queries
of operators around reads, samples and identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transpark.catalog import FIRST_SQL, SEQS, K, duck, query, table, view
from transpark.functions import sequences as S
from transpark.operators import alignments as A
from transpark.operators import reads as R
from transpark.operators.similarity import exact_copies
from transpark.plans import pipelines as P
from transpark.plans import runner
from transpark.plans.config import from_dict
from transpark.plans.storage import shared_path, stored
from transpark.sources import bam as BAM
from transpark.sources import readers as IN
from transpark.sources import sinks as OUT

SEQ = "repeat(CASE {n} % 4 WHEN 0 THEN 'ACG' WHEN 1 THEN 'CGT' WHEN 2 THEN 'GTA' ELSE 'TAC' END, CAST(1 + {n} % 9 AS INT))"
PARTS = f"SELECT p_partkey AS id, 'part' || p_partkey AS name, {SEQ.format(n='p_partkey')} AS seq, CAST(p_size AS INT) AS size FROM {{part}}"
RC = "reverse(translate({s}, 'ACGT', 'TGCA'))"


def written(rows: DataFrame, name: str, *by: str, codec: str | None = None) -> str:
    """The path of rows (value) written as text, a folder for each value of ``by``."""
    path = shared_path(rows.sparkSession, name)
    out = rows.write.partitionBy(*by) if by else rows.write
    (out.option("compression", codec) if codec else out).text(path)
    return path


def last_folder(c: str = "file"):
    """The value after = in a file's folder."""
    return F.regexp_extract(c, r"=([^/=]*)/[^/]*$", 1)


GRAPH = f"SELECT n_nationkey % 3 AS g, n_nationkey AS n, {SEQ.format(n='n_nationkey')} AS seq FROM {{nation}}"
LINK = "SELECT CAST(s_suppkey % 3 AS INT) AS g, CAST(s_nationkey AS INT) AS a, CAST((s_nationkey * 7 + s_suppkey) % 25 AS INT) AS b FROM {supplier}"
_link = f"SELECT DISTINCT g, 'n' || least(a, b) || CASE WHEN a < 12 THEN '+' ELSE '-' END AS src, 'n' || greatest(a, b) || CASE WHEN b < 12 THEN '+' ELSE '-' END AS dst, ((a + b) % 6) || 'M' AS overlap FROM ({LINK}) WHERE a <> b"
FLIP = "translate({c}, '+-', '-+')"


@query("io_gfa", f"""WITH l AS ({duck(_link)}), e AS (SELECT g, src, dst, overlap FROM l UNION ALL SELECT g, {FLIP.format(c='dst')}, {FLIP.format(c='src')}, overlap FROM l), s AS ({duck(GRAPH)}), n AS (SELECT g, 'n' || n AS node, seq FROM s)
SELECT g::VARCHAR AS g, 'edge' AS kind, src AS a, dst AS b, overlap AS c FROM e UNION ALL SELECT g::VARCHAR, 'node', node || '+', seq, length(seq)::VARCHAR FROM n UNION ALL SELECT g::VARCHAR, 'node', node || '-', {RC.format(s='seq')}, length(seq)::VARCHAR FROM n""")
def io_gfa(spark, sf):
    segments = view(spark, sf, GRAPH).select("g", F.concat_ws("\t", F.lit("S"), F.concat(F.lit("n"), "n"), "seq", F.lit("LN:i:1")).alias("value"))
    names, sign = lambda c: F.expr(f"substr({c}, 1, length({c}) - 1)"), lambda c: F.right(c, F.lit(1))
    links = view(spark, sf, _link).select("g", F.concat_ws("\t", F.lit("L"), names("src"), sign("src"), names("dst"), sign("dst"), "overlap").alias("value"))
    other = view(spark, sf, "SELECT DISTINCT n_nationkey % 3 AS g, 'H\tVN:Z:1.0' AS value FROM {nation}")
    nodes, edges = IN.read_gfa(spark, written(other.unionByName(segments).unionByName(links), "gfa", "g", codec="gzip"))
    g = last_folder("graph").alias("g")
    return edges.select(g, F.lit("edge").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), F.col("overlap").alias("c")).unionByName(nodes.select(g, F.lit("node").alias("kind"), F.col("node").alias("a"), F.col("seq").alias("b"), F.col("len").cast("string").alias("c")))


@query("io_fasta", f"SELECT name || '-len' || length(seq) || '-comp' || size || '-' AS id, seq, length(seq)::INT AS length FROM ({duck(PARTS)})")
def io_fasta(spark, sf):
    path = shared_path(spark, "fasta")
    OUT.write_fasta(view(spark, sf, PARTS), path, OUT.cycle_header(F.col("name"), F.length("seq"), F.col("size")), F.col("seq"))
    return IN.read_fasta(spark, path).select("id", "seq", F.length("seq").alias("length"))


@query("io_split_fasta", f"SELECT 's' || size AS sample, name AS id, seq FROM ({duck(PARTS)})")
def io_split_fasta(spark, sf):
    path = shared_path(spark, "split")
    OUT.write_split_fasta(view(spark, sf, PARTS).withColumn("sample", F.concat(F.lit("s"), "size")), path, "sample", F.col("name"), F.col("seq"))
    return IN.read_fasta(spark, path).select(last_folder().alias("sample"), "id", "seq")


@query("io_merged_fasta", f"SELECT 'k=' || size || '|' || name AS header, seq FROM ({duck(PARTS)})")
def io_merged_fasta(spark, sf):
    path = shared_path(spark, "merged")
    OUT.write_split_fasta(view(spark, sf, PARTS).withColumnRenamed("size", "k"), path, "k", F.col("name"), F.col("seq"))
    merged = OUT.merged_fasta(IN.read_fasta(spark, path))
    return merged.select(F.regexp_replace("header", r"^(k=\d+)_[^|]*", "$1").alias("header"), "seq")


@query("io_cycles", f"SELECT name AS id, seq FROM ({duck(PARTS)}) WHERE id % 3 > 0")
def io_cycles(spark, sf):
    value = F.when(F.col("id") % 3 > 0, OUT.fasta_lines(F.col("name"), F.col("seq"))).when(F.col("id") % 2 > 0, F.lit("Error recursion")).otherwise("")
    path = written(view(spark, sf, PARTS).select((F.col("id") % 3).alias("k"), value.alias("value")), "cycles", "k")
    return IN.read_cycles(spark, path).select("id", "seq")


HIT = """SELECT 'q' || p_partkey AS qseqid, 's' || p_size AS sseqid, 90.5e0 + p_size % 9 AS pident, CAST(p_size AS INT) AS length, CAST(p_partkey % 100 AS INT) AS qstart, CAST(p_partkey % 100 + p_size AS INT) AS qend, 1e-5 AS evalue, 100 AS slen FROM {part}"""


def _hit_file(spark, sf):
    h = view(spark, sf, HIT)
    columns = ["qseqid", "sseqid", "pident", "length", F.lit(0), F.lit(0), "qstart", "qend", F.lit(1), "length", "evalue", F.lit(50.5), "slen", F.lit(60)]
    return written(h.select(F.concat_ws("\t", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in columns]).alias("value")), "hits")


@query("io_hits", f"SELECT qseqid, sseqid, pident, length, qstart, qend, evalue::DOUBLE AS evalue, slen::INT AS slen, 60 AS qlen FROM ({duck(HIT)})")
def io_hits(spark, sf):
    return IN.read_hits(spark, _hit_file(spark, sf)).select("qseqid", "sseqid", "pident", "length", "qstart", "qend", "evalue", "slen", "qlen")


@query("io_hits_positional", f"SELECT qseqid, sseqid, length AS align_len, qstart, qend FROM ({duck(HIT)})")
def io_hits_positional(spark, sf):
    return IN.read_hits_positional(spark, _hit_file(spark, sf))


@query("io_orfs", f"SELECT name || '_1' AS orf_id, size AS start, size + 30 AS \"end\" FROM ({duck(PARTS)})")
def io_orfs(spark, sf):
    path = shared_path(spark, "orfs")
    header = F.concat_ws(" # ", F.concat("name", F.lit("_1")), F.col("size").cast("string"), (F.col("size") + 30).cast("string"), F.lit("-1"), F.lit("ID=1_1"))
    OUT.write_fasta(view(spark, sf, PARTS), path, header, F.col("seq"))
    return IN.read_orfs(spark, path)


@query("io_gff", f"SELECT name AS seqid, size AS start, size + 99 AS \"end\", CASE WHEN id % 2 = 0 THEN '+' ELSE '-' END AS strand, 'g' || id AS id FROM ({duck(PARTS)}) WHERE size % 3 > 0")
def io_gff(spark, sf):
    kind = F.when(F.col("size") % 3 > 0, "CDS").otherwise("gene")
    line = F.concat_ws("\t", "name", F.lit("x"), kind, F.col("size").cast("string"), (F.col("size") + 99).cast("string"), F.lit("."), F.when(F.col("id") % 2 == 0, "+").otherwise("-"), F.lit("0"), F.concat(F.lit("ID=g"), F.col("id"), F.lit(";note=a")))
    return IN.read_gff(spark, written(view(spark, sf, PARTS).select(F.concat(line, F.lit("\n# comment\n")).alias("value")), "gff"))


SAM = """SELECT 'r' || o_orderkey AS read, CAST(CASE o_orderkey % 5 WHEN 0 THEN 4 WHEN 1 THEN 2048 ELSE 0 END AS INT) AS flag, 'ref' || (o_custkey % 3) AS ref, CAST(1 + o_orderkey % 400 AS INT) AS pos, CAST(20 + o_custkey % 60 AS INT) AS m, CAST(o_orderkey % 30 AS INT) AS h FROM {orders}"""


def _sam_file(spark, sf):
    rows = view(spark, sf, SAM)
    cigar = F.concat(F.when(F.col("h") > 0, F.concat(F.col("h"), F.lit("H"))).otherwise(""), F.col("m"), F.lit("M5I"), F.col("m"), F.lit("M"))
    line = F.concat_ws("\t", "read", F.col("flag").cast("string"), "ref", F.col("pos").cast("string"), F.lit("60"), cigar, F.lit("*"), F.lit("0"), F.lit("0"), F.expr("repeat('A', 2 * m + 5)"), F.lit("*"), F.concat(F.lit("SA:Z:"), "ref", F.lit(",9,+,5M,60,0;")))
    heads = view(spark, sf, "SELECT DISTINCT o_orderkey % 3 AS id FROM {orders}").select(F.concat(F.lit("@SQ\tSN:ref"), F.col("id"), F.lit("\tLN:"), (F.col("id") * 200 + 100)).alias("value"))
    return written(heads.unionByName(rows.select(line.alias("value"))), "sam")


@query("io_sam", f"SELECT read, flag, ref, pos, 2 * m + 5 AS seq_len, ref || ',9,+,5M,60,0;' AS sa FROM ({duck(SAM)}) WHERE ref = 'ref1' AND flag = 0")
def io_sam(spark, sf):
    rows, _ = IN.read_sam(spark, _sam_file(spark, sf), "ref1")
    return IN.mapped(rows, True).select("read", "flag", "ref", "pos", "seq_len", "sa")


@query("io_sam_references", "SELECT DISTINCT 'ref' || (o_orderkey % 3) AS ref, (o_orderkey % 3 * 200 + 100)::INT AS length FROM orders")
def io_sam_references(spark, sf):
    return IN.read_sam(spark, _sam_file(spark, sf))[1]


@query("read_length_filter", f"""WITH s AS ({duck(SAM)}), l AS (SELECT *, 2 * m + 5 + h AS read_len, (CASE ref WHEN 'ref0' THEN 100 WHEN 'ref1' THEN 300 ELSE 500 END) AS n FROM s WHERE flag & 4 = 0)
SELECT read, 'unknown' AS annot, (pos - 1)::INT AS r_start, (pos - 1 + 2 * m - 1)::INT AS r_end, h AS q_start, (h + 2 * m + 5 - 1)::INT AS q_end, read_len FROM l WHERE read_len BETWEEN n * 0.5 AND n * 1.5 AND 2 * m >= 60""")
def read_length_filter(spark, sf):
    rows, refs = IN.read_sam(spark, _sam_file(spark, sf))
    return A.read_blocks(rows, refs, gap=50, least=60, shorter=0.5, longer=0.5, merge_gap=None).select("read", "annot", "r_start", "r_end", "q_start", "q_end", "read_len")


@query("longest_reads", f"SELECT read, max(2 * m + 5 + h)::INT AS read_len FROM ({duck(SAM)}) GROUP BY read")
def longest_reads(spark, sf):
    return A.longest_reads(IN.read_sam(spark, _sam_file(spark, sf))[0])


@query("close_alignments", f"SELECT read FROM ({duck(SAM)}) WHERE 2 * m / (2 * m + 5) >= 0.95")
def close_alignments(spark, sf):
    return A.close_alignments(IN.read_sam(spark, _sam_file(spark, sf))[0], 0.95).select("read")


@query("reads_by_contig", f"SELECT ref, read, count(*) AS alignments, min(pos) AS low, max(pos) AS high FROM ({duck(SAM)}) GROUP BY ref, read")
def reads_by_contig(spark, sf):
    return A.reads_by_contig(IN.read_sam(spark, _sam_file(spark, sf))[0])


SPANS = "SELECT 'ref' || (l_suppkey % 3) AS ref, 'r' || l_orderkey AS read, CAST(l_partkey % 300 AS INT) AS start, CAST(l_partkey % 300 + l_quantity AS INT) AS \"end\" FROM {lineitem}"


@query("circular_coverage", f"""WITH s AS ({duck(SPANS)}), c AS (SELECT ref, read, start, least("end", CASE ref WHEN 'ref0' THEN 100 WHEN 'ref1' THEN 200 ELSE 300 END) AS "end", substr(read, 2)::BIGINT % 7 = 0 AS k FROM s), m AS (SELECT ref, false AS circular, start, "end" FROM c UNION ALL SELECT ref, true, start, "end" FROM c WHERE k),
e AS (SELECT ref, circular, pos, sum(step) AS step FROM (SELECT ref, circular, start AS pos, 1 AS step FROM m WHERE start < "end" UNION ALL SELECT ref, circular, "end", -1 FROM m WHERE start < "end") GROUP BY ALL),
d AS (SELECT ref, circular, pos AS start, lead(pos) OVER w AS "end", sum(step) OVER w AS depth FROM e WINDOW w AS (PARTITION BY ref, circular ORDER BY pos)) SELECT ref, circular, start, "end", depth::BIGINT AS depth FROM d WHERE depth > 0""")
def circular_coverage(spark, sf):
    refs = spark.range(3).select(F.concat(F.lit("ref"), F.col("id")).alias("ref"), ((F.col("id") + 1) * 100).cast("int").alias("length"))
    spans = view(spark, sf, SPANS)
    return A.coverage(spans, refs, spans.where(F.expr("CAST(substr(read, 2) AS BIGINT) % 7 = 0")).select("read"))


@query("polar_arcs", f"SELECT ref, read, start, \"end\", round(start * 2 * pi() / 400, 6) AS from_angle, round(\"end\" * 2 * pi() / 400, 6) AS to_angle FROM ({duck(SPANS)})")
def polar_arcs(spark, sf):
    arcs = R.polar_arcs(view(spark, sf, SPANS), 400)
    return arcs.withColumns({c: F.round(c, 6) for c in ("from_angle", "to_angle")})


@query("merged_alignments", f"""WITH s AS (SELECT ref, start, "end" FROM ({duck(SPANS)}) WHERE start % 5 > 0), k AS (SELECT *, CASE WHEN start > max("end") OVER w OR max("end") OVER w IS NULL THEN 1 ELSE 0 END AS f FROM s WINDOW w AS (PARTITION BY ref ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
i AS (SELECT *, sum(f) OVER (PARTITION BY ref ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS g FROM k) SELECT ref, min(start) AS q_start, max("end") AS q_end FROM i GROUP BY ref, g""")
def merged_alignments(spark, sf):
    spans = view(spark, sf, SPANS).select("ref", F.when(F.col("start") % 5 > 0, F.col("start")).otherwise(0).alias("q_start"), F.col("end").alias("q_end"))
    return A.merged_alignments(spans, ["ref"])


@query("io_fastq", f"SELECT name AS id, seq, repeat('I', length(seq)::INT) AS quality, length(seq)::INT AS length FROM ({duck(PARTS)}) WHERE id % 4 > 0")
def io_fastq(spark, sf):
    reads = view(spark, sf, PARTS).select(F.col("id").alias("n"), F.col("name").alias("id"), "seq", F.expr("repeat('I', length(seq))").alias("quality"))
    path = shared_path(spark, "fastq")
    OUT.write_fastq(reads, reads.where("n % 4 > 0").select("id"), path)
    return IN.read_fastq(spark, path)


@query("reads_with_lengths", f"SELECT 'part' || (o_custkey % 500) AS read, length(seq)::INT AS length, count(*) AS n FROM orders JOIN ({duck(PARTS)}) p ON p.id = o_custkey % 500 GROUP BY 1, 2")
def reads_with_lengths(spark, sf):
    path = shared_path(spark, "lengths")
    OUT.write_fasta(view(spark, sf, PARTS), path, F.col("name"), F.col("seq"))
    records = IN.read_fasta(spark, path).select(F.col("id").alias("read"), F.length("seq").alias("length"))
    reads = view(spark, sf, "SELECT 'part' || (o_custkey % 500) AS read, 1 AS one FROM {orders}")
    return R.with_lengths(reads, records).groupBy("read", "length").agg(F.count("*").alias("n"))


@query("known_read_lengths", "SELECT o_orderkey, o_custkey % 7 - 2 AS read_len FROM orders WHERE o_custkey % 7 > 2 AND o_orderkey % 5 > 0")
def known_read_lengths(spark, sf):
    reads = view(spark, sf, "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey % 7 - 2 END AS read_len FROM {orders}")
    return R.known_lengths(reads)


BLOCK = "SELECT 'SRR' || (l_suppkey % 9) || '.' || l_orderkey AS read, CASE WHEN l_linenumber % 2 = 0 THEN 'cargo' ELSE 'transposon' END AS annot, CAST(l_partkey % 500 AS INT) AS r_start, CAST(l_partkey % 500 + 90 AS INT) AS r_end, CAST(l_linenumber * 100 AS INT) AS q_start, CAST(l_linenumber * 100 + l_quantity AS INT) AS q_end, 5000 AS read_len FROM {lineitem}"


@query("io_blocks", f"SELECT read, annot, q_start, q_end, read_len, 2 * count(*) AS n FROM ({duck(BLOCK)}) GROUP BY ALL")
def io_blocks(spark, sf):
    path = shared_path(spark, "blocks")
    for _ in range(2):  # the sink appends
        OUT.write_blocks(view(spark, sf, BLOCK), path)
    return IN.read_annotated_blocks(spark, path).groupBy("read", "annot", "q_start", "q_end", "read_len").agg(F.count("*").alias("n"))


@query("pattern_counts_by_reference", f"SELECT split_part(read, '.', 1) AS run, CASE WHEN r_start % 3 = 0 THEN 'unknown' ELSE 'ref' || (r_start % 3) END AS ref, annot AS pattern, count(*) AS n FROM ({duck(BLOCK)}) GROUP BY ALL")
def pattern_counts_by_reference(spark, sf):
    windows = view(spark, sf, BLOCK).withColumn("pattern", F.col("annot")).withColumn("ref", F.when(F.col("r_start") % 3 > 0, F.concat(F.lit("ref"), F.col("r_start") % 3)))
    return R.pattern_counts_by_reference(windows, "read", "ref")


@query("io_summary_lines", f"""WITH c AS (SELECT split_part(read, '.', 1) AS run, annot AS pattern, count(*) AS n FROM ({duck(BLOCK)}) GROUP BY GROUPING SETS ((run, pattern), (pattern))), i AS (SELECT split_part(read, '.', 1) AS read, annot AS event, count(*) AS n FROM ({duck(BLOCK)}) GROUP BY ALL)
SELECT coalesce(run || ':', 'TOTAL:') || ' ' || string_agg(pattern || '=' || n, ', ' ORDER BY pattern) AS value FROM c GROUP BY run UNION ALL SELECT 'INSERTION ' || read || ': ' || string_agg(event || '=' || n, ', ' ORDER BY event) FROM i GROUP BY read""")
def io_summary_lines(spark, sf):
    windows = view(spark, sf, BLOCK).withColumn("pattern", F.col("annot"))
    insertions = windows.groupBy(S.run_of_read(F.col("read")).alias("read"), F.col("annot").alias("event")).agg(F.count("*").alias("n"))
    path = written(OUT.summary_lines(R.pattern_counts(windows, "read"), insertions), "summary")
    return IN.lines(spark, path).select("value")


TABLE = "SELECT CAST(s_suppkey AS STRING) AS SampleID, s_name AS CycleID, CAST(s_nationkey AS STRING) AS length, 'CT' || (s_suppkey % 50) AS ct_tag, 'x' AS other FROM {supplier}"
_table = duck(TABLE).replace("STRING", "VARCHAR")


@query("io_table", f"SELECT * FROM ({_table})")
def io_table(spark, sf):
    path = shared_path(spark, "final")
    OUT.write_table(view(spark, sf, TABLE), path)
    return IN.read_table(spark, path)


@query("io_enriched", f"SELECT 'rows' AS what, count(*) AS n FROM ({_table}) UNION ALL SELECT 'tags', count(DISTINCT ct_tag) FROM ({_table}) UNION ALL SELECT 'summary', count(*) FROM ({_table}) UNION ALL SELECT 'columns', 4 UNION ALL SELECT 'none', 0")
def io_enriched(spark, sf):
    rich, short, none = (shared_path(spark, x) for x in ("enriched", "short", "none"))
    rows = view(spark, sf, TABLE)
    told = [("tags", OUT.write_enriched(rows, rich)), ("summary", OUT.write_summary(rows, short)), ("none", OUT.write_enriched(rows.limit(0), none))]
    told += [("rows", IN.read_table(spark, rich, ",").count()), ("columns", len(IN.read_table(spark, short, ",").columns))]
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{w}', {n}L)" for w, n in told) + " AS t(what, n)")


@query("io_json", f"SELECT * FROM ({_table})")
def io_json(spark, sf):
    path = shared_path(spark, "json")
    OUT.write_json(view(spark, sf, TABLE), path)
    return spark.read.json(path).select("SampleID", "CycleID", "length", "ct_tag", "other")


@query("io_genbank", f"SELECT name, seq, 2 AS features, '1..' || length(seq) AS first FROM ({duck(PARTS)})")
def io_genbank(spark, sf):
    path = shared_path(spark, "genbank")
    one = lambda a, b, s: F.struct(F.lit(a).alias("start"), b.alias("end"), F.lit(s).alias("strand"), F.lit("p").alias("product"), F.lit("g").alias("gene"))
    rows = view(spark, sf, PARTS).withColumn("f", F.array(one(2, F.length("seq"), -1), one(1, F.length("seq"), 1)))
    OUT.write_genbank(rows, path, "name", "seq", "f")
    back = spark.read.option("lineSep", "\n//\n").text(path)
    seq = F.upper(F.regexp_replace(F.regexp_extract("value", r"(?s)\nORIGIN\n(.*)", 1), r"[^acgt]", ""))
    spans = F.regexp_extract_all("value", F.lit(r"CDS +([^\n]*)"), 1)
    return back.select(F.regexp_extract("value", r"^LOCUS +(\S+)", 1).alias("name"), seq.alias("seq"), F.size(spans).alias("features"), spans[0].alias("first"))


@query("io_accessions", "SELECT 'SRR' || s_suppkey AS accession FROM supplier")
def io_accessions(spark, sf):
    return IN.read_accessions(spark, written(view(spark, sf, "SELECT '  SRR' || s_suppkey || ' \n\n' AS value FROM {supplier}"), "accessions"))


TAXON = "SELECT 'IS' || p_partkey AS name, 'G' || (p_size % 9) AS grp, CASE p_partkey % 3 WHEN 0 THEN 'unknown' WHEN 1 THEN 'g' || (p_size % 9) ELSE 'F' || p_size END AS family FROM {part}"


@query("io_taxonomy", f"SELECT name, grp AS is_group, CASE WHEN starts_with(family, 'F') THEN family ELSE name END AS is_family FROM ({duck(TAXON)})")
def io_taxonomy(spark, sf):
    path = shared_path(spark, "taxonomy")
    OUT.write_table(view(spark, sf, TAXON).select("name", F.col("grp").alias("group"), "family"), path)
    return IN.read_taxonomy(spark, path)


@query("io_ontology", "SELECT 'ARO:' || p_partkey AS aro_id, p_name AS aro_name, p_brand AS aro_class FROM part")
def io_ontology(spark, sf):
    rows = view(spark, sf, "SELECT 'aro:' || p_partkey AS `ARO Accession`, p_name AS `ARO Name`, p_brand AS `Drug Class` FROM {part}")
    path = shared_path(spark, "ontology")
    OUT.write_table(rows.select(*[F.lit(str(i)).alias(f"c{i}") for i in range(9)], *rows.columns), path)
    return IN.read_ontology(spark, path)


@query("io_mapping_summary", "SELECT 'k' || s_suppkey % 40 AS run, 'n' || i AS key, CASE i WHEN 0 THEN max(s_suppkey) ELSE max(s_suppkey) + 1 END::VARCHAR AS value FROM supplier, range(2) r(i) GROUP BY s_suppkey % 40, i")
def io_mapping_summary(spark, sf):
    rows = view(spark, sf, "SELECT 'k' || s_suppkey % 40 AS run, max(s_suppkey) AS m FROM {supplier} GROUP BY s_suppkey % 40")
    value = F.concat(F.lit("SRR1: n0="), F.col("m"), F.lit(", n1=7\nnoise n0=9\n{'n1': "), F.col("m") + 1, F.lit("}"))
    back = IN.read_mapping_summary(spark, written(rows.select("run", value.alias("value")), "mapping", "run"))
    return back.select(last_folder().alias("run"), F.explode("values").alias("key", "value"))


@query("io_discover", "SELECT 'k' || n_regionkey AS k, sum(length(n_name) + 1)::BIGINT AS size FROM nation GROUP BY n_regionkey")
def io_discover(spark, sf):
    rows = view(spark, sf, "SELECT 'k' || n_regionkey AS k, n_name AS value FROM {nation}").repartition(1)
    found = IN.discover(spark, written(rows, "discover", "k"), "part-*.txt", 1)
    return found.select(last_folder("path").alias("k"), "size")


@query("io_contigs_to_gfa", f"SELECT 'S' || chr(9) || id || chr(9) || seq AS value FROM ({duck(PARTS)}) UNION ALL SELECT concat_ws(chr(9), 'L', id, '+', id + 1, '-', '0M') FROM ({duck(PARTS)}) UNION ALL SELECT concat_ws(chr(9), 'L', id, '-', id + 2, '+', '0M') FROM ({duck(PARTS)})")
def io_contigs_to_gfa(spark, sf):
    path = shared_path(spark, "contigs")
    OUT.write_fasta(view(spark, sf, PARTS), path, F.concat(F.lit("SRR5_"), F.col("id"), F.lit(" len L:+:"), F.col("id") + 1, F.lit(":- L:-:"), F.col("id") + 2, F.lit(":+")), F.col("seq"))
    return IN.contigs_to_gfa(spark, path)


@query("io_element_headers", f"SELECT 'IS_' || id AS name, CASE id % 3 WHEN 0 THEN 'G' ELSE 'F' END || size AS family, CASE id % 3 WHEN 1 THEN 'F' ELSE 'G' END || size AS \"group\" FROM ({duck(PARTS)})")
def io_element_headers(spark, sf):
    said = lambda turn, letter: F.when(F.col("id") % 3 == turn, "unknown").otherwise(F.concat(F.lit(letter), "size"))
    path = shared_path(spark, "elements")
    OUT.write_fasta(view(spark, sf, PARTS), path, F.concat_ws("_", F.lit("IS"), F.col("id").cast("string"), said(0, "F"), said(1, "G")), F.col("seq"))
    return IN.read_element_headers(spark, path)


@query("config_options", "SELECT l_returnflag, count(*) AS n, round(sum(abs(l_extendedprice::DECIMAL(18,2) - 5850.00::DECIMAL(18,2))))::BIGINT AS distance, 10::BIGINT AS patterns FROM lineitem WHERE l_linenumber <= 6 AND l_suppkey % 10 <= 5 GROUP BY l_returnflag")
def config_options(spark, sf):
    """Rows within the limits of a configuration: named options are taken, others keep their defaults."""
    c = from_dict({"options": {"path_limit": 6, "other": 1}, "tolerances": {"tolerance": 5}})
    rows = table(spark, sf, "lineitem").where((F.col("l_linenumber") <= c.options.path_limit) & (F.col("l_suppkey") % 10 <= c.tolerances.tolerance))
    far = F.sum(F.abs(F.col("l_extendedprice").cast("decimal(18,2)") - F.lit(c.options.mean).cast("decimal(18,2)")))
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(far).cast("long").alias("distance"), F.lit(len(c.patterns)).cast("long").alias("patterns"))


# Functions, filters and joins --------------------------------------------------------------------

NAMES = "SELECT o_orderkey, 'S' || o_custkey || CASE WHEN o_orderkey % 2 = 0 THEN '_k' || (o_orderkey % 99) ELSE '' END || '.fa.gz' AS base, 'srr_summary_Cycle_' || o_orderkey || '-len5_split.fasta.txt' AS told, 'a b/' || o_orderkey || repeat('-x', 40) AS odd, 'SRR' || o_custkey || '.' || o_orderkey AS read, 'c' || o_orderkey || CASE o_orderkey % 3 WHEN 0 THEN '_transposon_1' WHEN 1 THEN '_cargo' ELSE '' END AS contig FROM {orders}"


@query("name_functions", f"""SELECT o_orderkey, split_part(split_part(base, '.', 1), '_', 1) AS sample, split_part(split_part(base, '.', 1), '_', 2) AS kmer, 'Cycle_' || o_orderkey || '-len5' AS cycle, left(regexp_replace(odd, '[^A-Za-z0-9_-]', '_', 'g'), 60) AS file, split_part(read, '.', 1) AS run,
CASE o_orderkey % 3 WHEN 0 THEN 'transposon' WHEN 1 THEN 'cargo' ELSE 'unknown' END AS kind FROM ({duck(NAMES)})""")
def name_functions(spark, sf):
    c = S.sample_and_kmer(F.col("base"))
    return view(spark, sf, NAMES).select("o_orderkey", c["sample"].alias("sample"), c["kmer"].alias("kmer"), S.cycle_of_summary(F.col("told")).alias("cycle"), S.safe_filename(F.col("odd")).alias("file"), S.run_of_read(F.col("read")).alias("run"), S.contig_kind(F.col("contig")).alias("kind"))


PAIR = "SELECT l_orderkey, l_linenumber, CAST(l_partkey % 900 AS INT) AS s1, CAST(l_partkey % 900 + l_quantity * 20 AS INT) AS e1, CAST(l_suppkey % 700 AS INT) AS s2, CAST(l_suppkey % 700 + l_quantity * 15 AS INT) AS e2 FROM {lineitem}"


@query("overlap_functions", f"""SELECT l_orderkey, l_linenumber, round(greatest(0, least(e1, e2) - greatest(s1, s2) + 1) / least(e1 - s1 + 1, e2 - s2 + 1), 6) AS ratio, least(e1, e2) - greatest(s1, s2) > 300 AS large, round(greatest(0, least(1, (s1 + e1) / 2 / 1500)), 6) AS centre FROM ({duck(PAIR)})""")
def overlap_functions(spark, sf):
    a = [F.col(c) for c in ("s1", "e1", "s2", "e2")]
    return view(spark, sf, PAIR).select("l_orderkey", "l_linenumber", F.round(S.overlap_ratio(*a), 6).alias("ratio"), S.large_overlap(*a).alias("large"), F.round(S.pattern_centre(a[0], a[1], F.lit(1500)), 6).alias("centre"))


@query("number_functions", """SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 0.0 ELSE s_suppkey + 0.25 END::DOUBLE AS number, CASE s_suppkey % 4 WHEN 0 THEN 'Unknown' ELSE s_name END || ' | ' || CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'a; b' END || ' | ' || CASE WHEN s_suppkey % 6 = 0 THEN '0.00' ELSE (s_suppkey % 100) || '.50' END AS line FROM supplier""")
def number_functions(spark, sf):
    rows = view(spark, sf, "SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'bad' ELSE s_suppkey || '.25' END AS v, CASE s_suppkey % 4 WHEN 0 THEN NULL ELSE s_name END AS product, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE array('a', 'b') END AS genes, CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE s_suppkey % 100 + 0.5e0 END AS score FROM {supplier}")
    return rows.select("s_suppkey", S.number_or_zero(F.col("v"), 3).alias("number"), S.metadata_line(F.col("product"), F.col("genes"), F.col("score")).alias("line"))


@query("molecule_of_files", f"SELECT 'k' || size AS k, size % 2 = 0 AS protein FROM ({duck(PARTS)}) GROUP BY size")
def molecule_of_files(spark, sf):
    path = shared_path(spark, "molecule")
    rows = view(spark, sf, PARTS).withColumn("k", F.concat(F.lit("k"), "size")).withColumn("seq", F.when(F.col("size") % 2 == 0, F.concat("seq", F.lit("MKV"))).otherwise(F.col("seq")))
    OUT.write_split_fasta(rows, path, "k", F.col("name"), F.col("seq"))
    return P.molecule(IN.read_fasta(spark, path), last_folder()).select(F.col("file").alias("k"), "protein")


SPLIT = "SELECT 'part' || p_partkey AS cycle, CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN double('NaN') ELSE p_size * 4.0e0 END AS score2, CASE p_partkey % 5 WHEN 0 THEN ' ' ELSE '1-9' END AS is_spans FROM {part}"


@query("splittable_records", f"SELECT name AS cycle, size * 4.0::DOUBLE AS score2, '1-9' AS is_spans, seq FROM ({duck(PARTS)}) WHERE id % 4 > 1 AND id % 5 > 0 AND size * 4 >= 92")
def splittable_records(spark, sf):
    path = shared_path(spark, "records")
    OUT.write_fasta(view(spark, sf, PARTS), path, F.col("name"), F.col("seq"))
    records = IN.read_fasta(spark, path).select(F.col("id").alias("cycle"), "seq")
    return A.cycle_records(view(spark, sf, SPLIT), records, least=92.0).select("cycle", "score2", "is_spans", "seq")


@query("kmer_links", f"WITH {FIRST_SQL} SELECT later AS src, earlier AS dst FROM p WHERE shared * 100.0 / size >= 50")
def kmer_links(spark, sf):
    seqs = stored(view(spark, sf, SEQS["spark"]), "seqs")
    firsts = seqs.join(exact_copies(seqs, "doc_id").where("doc_id = first").select("doc_id"), "doc_id", "left_semi")
    return P.kmer_links(firsts, K, 50.0, "doc_id")


LINKED = "SELECT 'CT' || (l_partkey % 90) AS qseqid, 'CT' || (l_suppkey % 90) AS sseqid, 80.0e0 + l_linenumber * 3 AS pident, CAST(l_quantity AS INT) AS length, 50 AS slen, 60 AS qlen, 0.0e0 AS evalue FROM {lineitem}"


@query("similar_links", f"SELECT DISTINCT qseqid AS src, sseqid AS dst FROM ({duck(LINKED)}) WHERE qseqid <> sseqid AND pident >= 90 AND length / 50 * 100 >= 80")
def similar_links(spark, sf):
    return P.similar_links(view(spark, sf, LINKED))


TAGGED = "SELECT 'CT' || o_orderkey AS ct_tag, CASE o_orderkey % 3 WHEN 0 THEN ' Novel ' WHEN 1 THEN 'novel' ELSE 'Known' END AS category, 's' || (o_custkey % 9) AS sample FROM {orders}"


@query("novel_clusters", f"""WITH RECURSIVE n AS (SELECT ct_tag AS node, sample, substr(ct_tag, 3)::BIGINT AS i FROM ({duck(TAGGED)}) WHERE lower(trim(category)) = 'novel'), g AS (SELECT a.node, min(b.node) AS c, count(*) AS size FROM n a JOIN n b ON a.i // 10 = b.i // 10 GROUP BY a.node),
k AS (SELECT c, max(size) AS size, row_number() OVER (ORDER BY max(size) DESC, c) AS nth FROM g WHERE size > 1 GROUP BY c),
l AS (SELECT n.node, CASE WHEN g.size = 1 THEN 'Unique' ELSE 'CTCluster' || lpad(nth::VARCHAR, greatest(3, length(nth::VARCHAR))::INT, '0') END AS cluster, sample FROM n JOIN g USING (node) LEFT JOIN k USING (c))
SELECT node, cluster, count(DISTINCT sample) OVER (PARTITION BY cluster) AS n_samples FROM l""")
def novel_clusters(spark, sf):
    tagged = view(spark, sf, TAGGED)
    n = tagged.where(F.lower(F.trim("category")) == "novel").select("ct_tag", F.floor(F.expr("CAST(substr(ct_tag, 3) AS BIGINT)") / 10).alias("tens"))
    firsts = n.groupBy("tens").agg(F.min("ct_tag").alias("dst"))
    links = n.join(firsts, "tens").where("ct_tag <> dst").select(F.col("ct_tag").alias("src"), "dst")
    return P.cluster_novel(tagged, links)


@query("tag_sequences", """SELECT 'CT' || lpad(min(o_orderkey)::VARCHAR, 9, '0') AS ct_tag, 'seq' || (o_custkey % 50) AS seq FROM orders GROUP BY o_custkey % 50""")
def tag_sequences(spark, sf):
    tags = view(spark, sf, "SELECT 'CT' || lpad(CAST(o_orderkey AS STRING), 9, '0') AS ct_tag, 's' || (o_custkey % 50) AS sample, '_' || (o_custkey % 50) || '-' AS cycle_id FROM {orders}")
    records = view(spark, sf, "SELECT DISTINCT 's' || (o_custkey % 50) AS sample, 'Cycle_' || (o_custkey % 50) || '-len9' AS description, 'seq' || (o_custkey % 50) AS seq FROM {orders}")
    return P.tag_sequences(tags, records)


@query("short_ids", """WITH l AS (SELECT DISTINCT 'L' || lpad(c_custkey::VARCHAR, 7, '0') AS long_id, c_custkey FROM customer), u AS (SELECT long_id, row_number() OVER (ORDER BY long_id) AS n FROM l WHERE c_custkey % 4 = 0)
SELECT long_id, CASE WHEN c_custkey % 4 > 0 THEN 'S' || c_custkey || 'b' ELSE 'Unknown_SRR_' || n END AS short_id FROM l LEFT JOIN u USING (long_id)""")
def short_ids(spark, sf):
    long = view(spark, sf, "SELECT 'L' || lpad(CAST(c_custkey AS STRING), 7, '0') AS long_id FROM {customer}")
    pairs = view(spark, sf, "SELECT 'L' || lpad(CAST(c_custkey AS STRING), 7, '0') AS long_id, 'S' || c_custkey || CASE t WHEN 1 THEN 'a' ELSE 'b' END AS short_id, t AS ord FROM {customer}, (SELECT explode(array(1, 2)) AS t) WHERE c_custkey % 4 > 0")
    return P.short_ids(long, pairs)


@query("concatenated_frames", "SELECT s_suppkey AS id, s_name AS name, NULL::BIGINT AS region FROM supplier UNION ALL SELECT n_nationkey, NULL, n_regionkey FROM nation")
def concatenated_frames(spark, sf):
    return P.concatenated(view(spark, sf, "SELECT s_suppkey AS id, s_name AS name FROM {supplier}"), view(spark, sf, "SELECT n_nationkey AS id, CAST(n_regionkey AS BIGINT) AS region FROM {nation}"))


@query("category_order", "SELECT category, id, row_number() OVER (ORDER BY turn, id) AS nth FROM (SELECT 'b' AS category, s_suppkey AS id, 0 AS turn FROM supplier UNION ALL SELECT 'a', n_nationkey, 1 FROM nation)")
def category_order(spark, sf):
    return P.in_category_order({"b": view(spark, sf, "SELECT s_suppkey AS id FROM {supplier}"), "a": view(spark, sf, "SELECT n_nationkey AS id FROM {nation}")}, ["id"]).select("category", "id", "nth")


@query("organism_lookup", "SELECT 'CT' || lpad(row_number() OVER (ORDER BY s_suppkey)::VARCHAR, greatest(3, length(row_number() OVER (ORDER BY s_suppkey)::VARCHAR))::INT, '0') AS ct_tag, 's' || s_nationkey AS sample, coalesce(n_name, 'Unknown') AS organism FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON n_nationkey = s_nationkey")
def organism_lookup(spark, sf):
    final = view(spark, sf, "SELECT s_suppkey, 's' || s_nationkey AS sample, 'Novel' AS comp_products, 'IS26' AS is_products, 'blaTEM' AS ant_products FROM {supplier}")
    organisms = view(spark, sf, "SELECT 's' || n_nationkey AS sample, n_name AS organism FROM {nation} WHERE n_nationkey < 20")
    return P.enrich(final, ["s_suppkey"], None, organisms).select("ct_tag", "sample", "organism")


@query("sample_runs", "SELECT 's' || n_regionkey AS sample, n_regionkey <> 2 AS done, CASE WHEN n_regionkey = 2 THEN NULL ELSE count(*) END AS n FROM nation GROUP BY n_regionkey")
def sample_runs(spark, sf):
    """A run of which one sample fails, and a second one that only tries that one again."""
    out, built = shared_path(spark, "samples"), []

    def build(sample: str) -> DataFrame:
        built.append(sample)
        if sample == "s2":
            raise ValueError("no such sample")
        return table(spark, sf, "nation").where(F.concat(F.lit("s"), F.col("n_regionkey")) == sample)

    samples = [f"s{i}" for i in range(5)]
    runner.run_samples(spark, samples, build, out)
    told = runner.run_samples(spark, samples, build, out)
    if built.count("s2") != 2 or len(built) != 6:
        raise ValueError(f"samples were built again: {built}")
    rows = spark.read.parquet(out).groupBy("sample").agg(F.count("*").alias("n"))
    return told.join(rows, "sample", "left").select("sample", F.col("error").isNull().alias("done"), "n")


BAM_ROWS = """SELECT 'r' || l_orderkey || '/' || l_linenumber AS read, CAST((l_linenumber % 2) * 16 AS INT) AS flag, 'ref' || (l_suppkey % 3) AS ref, CAST(l_partkey * 37 + 1 AS INT) AS pos, CAST(l_linenumber AS INT) AS mapq,
CAST(l_quantity AS INT) || 'M' || CASE WHEN l_linenumber = 2 THEN '3D1M' ELSE '' END AS cigar, CAST(l_quantity AS INT) AS seq_len, CASE WHEN l_linenumber = 3 THEN 'ref0,7,+,9M,60,0;' ELSE '' END AS sa FROM {lineitem}"""


#: Alignments that a task sorts for its file.
ROWS_A_FILE = 500_000


def bam_files(spark, sf: str) -> str:
    """The path of lineitem's rows as alignments, in order within files."""
    path = shared_path(spark, "alignments")
    rows = view(spark, sf, BAM_ROWS)
    files = max(3, -(-rows.count() // ROWS_A_FILE))
    rows = rows.repartitionByRange(files, "ref", "pos").sortWithinPartitions("ref", "pos")
    BAM.write_bam(rows, path, [(f"ref{i}", 1_000_000) for i in range(3)])
    return path


@query("io_bam", f"SELECT * FROM ({duck(BAM_ROWS)})")
def io_bam(spark, sf):
    """Splits of 100 KB: many to a file."""
    return BAM.read_bam(spark, bam_files(spark, sf), split_bytes=100_000)[0]


@query("io_bam_region", f"SELECT * FROM ({duck(BAM_ROWS)}) WHERE ref = 'ref1'")
def io_bam_region(spark, sf):
    return BAM.read_bam(spark, bam_files(spark, sf), "ref1", split_bytes=100_000)[0]


ROUNDED = "SELECT l_orderkey, l_linenumber, CAST(l_suppkey * l_linenumber AS DOUBLE) / 16.0D AS x, CAST(l_partkey % 10000 AS DOUBLE) / 1000.0D + 0.005D AS y, CAST(l_extendedprice AS DOUBLE) / -7.0D AS z FROM {lineitem}"
ROUNDED_SQL = duck(ROUNDED).replace(".0D", ".0::DOUBLE").replace("0.005D", "0.005::DOUBLE")


@query("exact_rounding", f"SELECT l_orderkey, l_linenumber, format('{{:.3f}}', x)::DOUBLE AS x, format('{{:.2f}}', y)::DOUBLE AS y, format('{{:.1f}}', z)::DOUBLE AS z FROM ({ROUNDED_SQL})")
def exact_rounding(spark, sf):
    """Ties of binary fractions, ties of decimal texts that aren't ones, and any numbers."""
    rows = view(spark, sf, ROUNDED)
    return rows.select("l_orderkey", "l_linenumber", S.number_or_zero(F.col("x"), 3).alias("x"), S.number_or_zero(F.col("y"), 2).alias("y"), S.number_or_zero(F.col("z"), 1).alias("z"))

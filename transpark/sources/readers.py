"""Text formats as DataFrames. All go through Spark's readers, so any store and codec works."""

from __future__ import annotations

import io
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from transpark.functions.sequences import reverse_complement
from transpark.operators.graph import double_strands
from transpark.plans.storage import ship_by_value

_INTS = ("length", "mismatch", "gapopen", "qstart", "qend", "sstart", "send")
#: Columns of tabular hits.
HITS = StructType(
    [StructField("qseqid", StringType()), StructField("sseqid", StringType()), StructField("pident", DoubleType())]
    + [StructField(c, IntegerType()) for c in _INTS]
    + [StructField("evalue", DoubleType()), StructField("bitscore", DoubleType()), StructField("slen", IntegerType()), StructField("qlen", IntegerType())]
)
#: Columns of the final table.
FINAL = ("SampleID", "Kmer", "CycleID", "score0", "score1", "score2", "length", "components", "NumAnt", "AntNames", "AntCoords", "NumIS", "ISNames", "IScoords", "NumXeno", "XenoNames", "XenoCoords", "CompTN")


#: Names that don't end in .zst.
NOT_ZST = "{*[^t],*[^s]t,*[^z]st,*[^.]zst}"


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files (path, content) of zstd frames -> their lines, decompressed as they are read."""
    import zstandard

    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content.as_py()), read_across_frames=True)
            numbered = enumerate(io.TextIOWrapper(stream, "utf-8", newline="\n"))
            while rows := [(n, x.removesuffix("\n").removesuffix("\r")) for n, x in itertools.islice(numbered, 10_000)]:
                nth = pa.array([{"block": 0, "id": n} for n, _ in rows], pa.struct([("block", pa.int64()), ("id", pa.int64())]))
                yield pa.RecordBatch.from_arrays([pa.array([x for _, x in rows], pa.string()), pa.array([path.as_py()] * len(rows), pa.string()), nth], names=["value", "file", "nth"])


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, nth): the lines of text files in file order. Codecs that Spark's text reader knows by
    a file's name are its work; zstd, for which that needs a native library, is read a file a task."""
    read = spark.read.option("recursiveFileLookup", "true")
    text = read.option("pathGlobFilter", NOT_ZST).text(path).select("value", F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id")).alias("nth"))
    packed = _zst_lines(spark, path)
    return text if packed is None else text.unionByName(packed)


def _zst_lines(spark: SparkSession, path: str) -> DataFrame | None:
    packed = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.zst").format("binaryFile").load(path)
    return packed.select("path", "content").mapInArrow(_unpacked, "value string, file string, nth struct<block:bigint,id:bigint>") if packed.inputFiles() else None


def read_gfa(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of GFA files, by graph (the file): nodes (graph, node, seq, len) once for each
    strand; edges (graph, src, dst, overlap, nth, turn) strand-doubled, the first link of a pair
    counts. Other lines are ignored."""
    rows = lines(spark, path).withColumn("f", F.split("value", "\t"))
    segments = rows.where(F.col("f")[0] == "S").select(F.col("file").alias("graph"), F.col("f")[1].alias("name"), F.rtrim(F.col("f")[2]).alias("seq"))
    strands = F.array(F.struct(F.lit("+").alias("s"), F.col("seq").alias("q")), F.struct(F.lit("-").alias("s"), reverse_complement(F.col("seq")).alias("q")))
    nodes = segments.select("graph", "name", F.explode(strands).alias("x")).select("graph", F.concat("name", "x.s").alias("node"), F.col("x.q").alias("seq"), F.length("x.q").alias("len"))
    links = rows.where((F.col("f")[0] == "L") & (F.size("f") >= 6))
    links = links.select(F.col("file").alias("graph"), F.concat(F.col("f")[1], F.col("f")[2]).alias("src"), F.concat(F.col("f")[3], F.col("f")[4]).alias("dst"), F.trim(F.col("f")[5]).alias("overlap"), "nth")
    return nodes, double_strands(links, ["graph"], ["nth"])


def _records(spark: SparkSession, path: str) -> DataFrame:
    """(file, head, body) of FASTA records; a record is one row whatever its size."""
    read = spark.read.option("lineSep", "\n>").text(path, recursiveFileLookup=True)
    text = F.regexp_replace("value", "^>", "")
    parts = F.split(text, "\r?\n", 2)
    return read.select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("nth"), parts[0].alias("head"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("body")).where(F.col("head") != "")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(file, nth, id, description, seq): the id is the first word of the header."""
    return _records(spark, path).select("file", "nth", F.split("head", r"\s+")[0].alias("id"), F.col("head").alias("description"), F.regexp_replace("body", r"\s+", "").alias("seq"))


def read_cycles(spark: SparkSession, path: str, least_lines: int = 1) -> DataFrame:
    """FASTA records of cycle files that are neither empty nor start with an error."""
    rows = lines(spark, path)
    good = rows.groupBy("file").agg(F.min_by("value", "nth").alias("head"), F.count("*").alias("n")).where(~F.col("head").contains("Error") & (F.col("n") >= least_lines))
    return read_fasta(spark, path).join(good.select("file"), "file", "left_semi")


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Headerless tabular hits with 14 columns; empty files have none."""
    return spark.read.schema(HITS).csv(path, sep="\t", recursiveFileLookup=True)


def read_hits_positional(spark: SparkSession, path: str) -> DataFrame:
    """(qseqid, sseqid, align_len, qstart, qend) of tables with the default columns."""
    f = F.split("value", "\t")
    return lines(spark, path).where(F.size(f) >= 8).select(f[0].alias("qseqid"), f[1].alias("sseqid"), f[3].cast("int").alias("align_len"), f[6].cast("int").alias("qstart"), f[7].cast("int").alias("qend"))


def read_orfs(spark: SparkSession, path: str) -> DataFrame:
    """(orf_id, start, end) from '# '-separated gene headers."""
    p = F.split("description", " # ")
    return read_fasta(spark, path).where(F.size(p) >= 3).select(F.col("id").alias("orf_id"), p[1].cast("int").alias("start"), p[2].cast("int").alias("end"))


def read_gff(spark: SparkSession, path: str, kind: str = "CDS") -> DataFrame:
    """(seqid, start, end, strand, id) of features of one type."""
    f = F.split("value", "\t")
    rows = lines(spark, path).where(~F.col("value").startswith("#") & (F.trim("value") != "") & (F.size(f) >= 9))
    return rows.where(f[2] == kind).select(f[0].alias("seqid"), f[3].cast("int").alias("start"), f[4].cast("int").alias("end"), f[6].alias("strand"), F.regexp_extract(f[8], "ID=([^;]+)", 1).alias("id"))


def read_sam(spark: SparkSession, path: str, ref: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(alignments, references) of SAM text. alignments: (read, flag, ref, pos, mapq, cigar, seq_len,
    sa); references: (ref, length). Binary files are to be converted first."""
    rows, f = lines(spark, path), F.split("value", "\t")
    refs = rows.where(F.col("value").startswith("@SQ")).select(F.regexp_extract("value", r"\tSN:([^\t]+)", 1).alias("ref"), F.regexp_extract("value", r"\tLN:(\d+)", 1).cast("int").alias("length"))
    data = rows.where(~F.col("value").startswith("@") & (F.size(f) >= 11)).select(
        f[0].alias("read"), f[1].cast("int").alias("flag"), f[2].alias("ref"), f[3].cast("int").alias("pos"), f[4].cast("int").alias("mapq"), f[5].alias("cigar"),
        F.when(f[9] == "*", 0).otherwise(F.length(f[9])).alias("seq_len"), F.regexp_extract("value", r"\tSA:Z:([^\t]+)", 1).alias("sa"), "nth",
    )
    return (data if ref is None else data.where(F.col("ref") == ref)), refs


def mapped(alignments: DataFrame, primary_only: bool = False) -> DataFrame:
    """Alignments without unmapped ones, or also without secondary and supplementary ones."""
    bits = 4 | (256 | 2048 if primary_only else 0)
    return alignments.where(F.col("flag").bitwiseAND(F.lit(bits)) == 0)


def _carried(rows: DataFrame, value: Column, also: Column) -> DataFrame:
    """rows with ``last``, the last non-null value up to a line of its file, and ``before``, the sum
    of ``also`` over the lines before it: within blocks of the file, and between these."""
    rows = rows.withColumn("v_", value).withColumn("a_", also)
    ends = rows.groupBy("file", "nth.block").agg(F.max_by("v_", F.when(F.col("v_").isNotNull(), F.col("nth"))).alias("e_"), F.sum("a_").alias("s_"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(F.col("file").alias("f_"), F.col("block").alias("b_"), F.last("e_", ignorenulls=True).over(earlier).alias("e_"), F.coalesce(F.sum("s_").over(earlier), F.lit(0)).alias("s_"))
    within = Window.partitionBy("file", "nth.block").orderBy("nth")
    own = rows.withColumn("last", F.last("v_", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, 0))).withColumn("before", F.coalesce(F.sum("a_").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    own = own.join(ends, (F.col("file") == F.col("f_")) & (F.col("nth.block") == F.col("b_")))
    return own.withColumn("last", F.coalesce("last", "e_")).withColumn("before", F.col("before") + F.col("s_")).drop("v_", "a_", "e_", "s_", "f_", "b_")


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """(id, seq, quality, length): four lines a record, numbered per file."""
    rows = _carried(lines(spark, path), F.lit(None).cast("string"), F.lit(1)).withColumn("n", F.col("before"))
    quad = rows.groupBy("file", F.floor(F.col("n") / 4).alias("rec")).agg(*[F.max(F.when(F.col("n") % 4 == i, F.col("value"))).alias(c) for i, c in ((0, "head"), (1, "seq"), (3, "quality"))])
    return quad.where(F.col("head").startswith("@")).select(F.split(F.expr("substr(head, 2)"), r"\s+")[0].alias("id"), "seq", "quality", F.length("seq").alias("length"))


def read_annotated_blocks(spark: SparkSession, path: str) -> DataFrame:
    """(file, nth, read, annot, q_start, q_end, read_len) of annotated-read files: '>read' lines carry
    forward; lines without transposon or cargo are dropped. A read with its lines is one record, cut into
    lines where it is read, so that nothing is shuffled."""
    read = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", NOT_ZST).option("lineSep", "\n>").text(path)
    records = read.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    # Only the first record of a file still has its >, or is of no read: one row a file.
    firsts = records.where("block = 0").groupBy("file").agg(F.min(F.struct("id", F.col("value").startswith(">").alias("named"))).alias("f_"))
    firsts = F.broadcast(firsts.select(F.col("file").alias("file_"), F.col("f_.id").alias("id_"), F.col("f_.named").alias("named_")))
    told = records.join(firsts, (F.col("file") == F.col("file_")) & (F.col("id") == F.col("id_")), "left")
    text = F.when(F.col("named_"), F.expr("substr(value, 2)")).otherwise(F.col("value"))
    # A bare carriage return ends a line too.
    parts = told.select("file", "block", "named_", F.posexplode(F.split(text, "\r>")).alias("part", "body")).where((F.col("part") > 0) | F.coalesce("named_", F.lit(True)))
    own = parts.select("file", "block", F.split("body", "\r\n|\n|\r").alias("l")).select("file", "block", F.trim(F.col("l")[0]).alias("read"), F.explode("l").alias("value"))
    rows = own.select("file", F.struct("block", F.monotonically_increasing_id().alias("id")).alias("nth"), "read", "value")
    packed = _zst_lines(spark, path)
    if packed is not None:
        head = F.when(F.col("value").startswith(">"), F.trim(F.expr("substr(value, 2)")))
        carried = _carried(packed, head, F.lit(0)).where("last IS NOT NULL")
        rows = rows.unionByName(carried.select("file", "nth", F.col("last").alias("read"), "value"))
    pattern = r"\((transposon|cargo)\).*Read\s+(\d+)-(\d+)\s*\|\s*ReadLen=(\d+)"
    take = lambda i: F.regexp_extract("value", pattern, i)
    return rows.where(F.col("value").rlike(pattern)).select("file", "nth", "read", take(1).alias("annot"), take(2).cast("int").alias("q_start"), take(3).cast("int").alias("q_end"), take(4).cast("int").alias("read_len"))


def read_table(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A table with a header, all columns text."""
    return spark.read.csv(path, sep=sep, header=True)


def _missing(c: Column, sentinels: tuple[str, ...]) -> Column:
    t = F.trim(c)
    return F.when(~t.isin(*sentinels), t)


def sample_pairs(table: DataFrame, short: str, long: str, sentinels: tuple[str, ...] = ("", "-", "null", "None")) -> DataFrame:
    """(short_id, long_id): trimmed, sentinels are null; rows without a short id are dropped."""
    out = table.select(_missing(F.col(short), ("",)).alias("short_id"), _missing(F.col(long), sentinels).alias("long_id"))
    return out.where(F.col("short_id").isNotNull())


def read_accessions(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines."""
    return lines(spark, path).where(F.trim("value") != "").select(F.trim("value").alias("accession"))


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """(name, is_group, is_family) of a taxonomy TSV (name, group, family): the family is the third
    column unless unknown or equal to the group, then the name. The last of repeated names counts."""
    f = F.split("value", "\t")
    rows = lines(spark, path).where(F.size(f) >= 3)
    rows = rows.where(~F.lower(f[0]).isin("name", "is_name", "element"))
    own = (F.lower(F.trim(f[2])) != "unknown") & (F.lower(F.trim(f[2])) != F.lower(F.trim(f[1])))
    rows = rows.select(F.lower(F.trim(f[0])).alias("key"), "nth", F.trim(f[0]).alias("name"), F.trim(f[1]).alias("is_group"), F.when(own, F.trim(f[2])).otherwise(F.trim(f[0])).alias("is_family"))
    return rows.groupBy("key").agg(F.max_by(F.struct("name", "is_group", "is_family"), "nth").alias("r")).select("r.*")


def read_ontology(spark: SparkSession, path: str) -> DataFrame:
    """(aro_id, aro_name, aro_class) of an index TSV with a header of at least 12 columns."""
    table = read_table(spark, path)
    out = table.select(F.upper("ARO Accession").alias("aro_id"), F.col("ARO Name").alias("aro_name"), F.col("Drug Class").alias("aro_class"), F.monotonically_increasing_id().alias("nth"))
    return out.groupBy("aro_id").agg(F.max_by(F.struct("aro_name", "aro_class"), "nth").alias("r")).select("aro_id", "r.*")


def read_mapping_summary(spark: SparkSession, path: str) -> DataFrame:
    """(file, values): key=value pairs of run lines, overridden by those of dict lines."""
    rows = lines(spark, path)
    pairs = F.transform(F.regexp_extract_all("value", F.lit(r"(\w+)=([^,\s]+)"), 0), lambda p: F.struct(F.split(p, "=")[0].alias("k"), F.split(p, "=")[1].alias("v")))
    items = F.transform(F.regexp_extract_all("value", F.lit(r"'[^']+':\s*[^,}]+"), 0), lambda p: F.struct(F.regexp_extract(p, "'([^']+)'", 1).alias("k"), F.trim(F.regexp_extract(p, r":\s*(.*)$", 1)).alias("v")))
    run, other = F.col("value").rlike("^[SDE]RR"), F.col("value").startswith("{")
    found = rows.where(run | other).select("file", other.alias("strong"), "nth", F.explode(F.when(run, pairs).otherwise(items)).alias("p"))
    last = found.groupBy("file", F.col("p.k").alias("k")).agg(F.max_by(F.col("p.v"), F.struct("strong", "nth")).alias("v"))
    return last.groupBy("file").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "v")))).alias("values"))


def read_element_headers(spark: SparkSession, path: str) -> DataFrame:
    """(name, family, group) of element FASTA headers name_family_group; unknown is filled from the
    other field, the first of equal names counts."""
    rows = read_fasta(spark, path).withColumn("p", F.split("id", "_")).where(F.size("p") >= 3)
    family, group = F.element_at("p", -2), F.element_at("p", -1)
    fill = lambda a, b: F.when(F.lower(a) == "unknown", b).otherwise(a)
    name = F.array_join(F.slice("p", F.lit(1), F.size("p") - 2), "_")
    rows = rows.select(F.lower(name).alias("key"), "nth", name.alias("name"), fill(family, group).alias("family"), fill(group, family).alias("group"))
    return rows.groupBy("key").agg(F.min_by(F.struct("name", "family", "group"), "nth").alias("r")).select("r.*")


def contigs_to_gfa(spark: SparkSession, path: str) -> DataFrame:
    """GFA lines of contig FASTA whose headers list links as L:<sign>:<contig>; overlaps are 0M."""
    rows = read_fasta(spark, path).withColumn("contig", F.regexp_extract("description", r"^\w+?_(\d+)", 1)).where(F.col("contig") != "")
    links = F.transform(F.regexp_extract_all("description", F.lit(r"L:([+-]):(\d+):([+-])"), 0), lambda x: F.concat_ws("\t", F.lit("L"), F.col("contig"), F.split(x, ":")[1], F.split(x, ":")[2], F.split(x, ":")[3], F.lit("0M")))
    return rows.select(F.explode(F.concat(F.array(F.concat_ws("\t", F.lit("S"), "contig", "seq")), links)).alias("value"))


def discover(spark: SparkSession, path: str, pattern: str, least_size: int = 0) -> DataFrame:
    """(path, size) of files below a folder that match a glob and have ``least_size`` bytes."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select("path", F.col("length").alias("size"))
    return found.where(F.col("size") >= least_size)


ship_by_value(__name__)

"""Readers, sinks and composed plans on small files."""

import gzip
import struct

from pyspark.sql import functions as F

from transpark.operators.intervals import merge_blocks
from transpark.plans import pipelines as P
from transpark.plans.config import Options, from_dict
from transpark.sources import bam as B
from transpark.sources import readers as R
from transpark.sources import sinks as K
from transpark.streaming import stateless


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def text_of(path):
    return "".join(p.read_text() for p in sorted(path.glob("part-*")))


def test_gfa(spark, tmp_path):
    path = put(tmp_path / "g.gfa", "H\tx\nS\t1\tACGT\tLN:i:4\nS\t2\tGGC\nL\t1\t+\t2\t-\t2M\nL\t2\t+\t1\t-\t3M\nL\t1\t+\t1\t-\t1M\nP\tz\n")
    nodes, edges = R.read_gfa(spark, path)
    assert {(r.node, r.seq) for r in nodes.collect()} == {("1+", "ACGT"), ("1-", "ACGT"), ("2+", "GGC"), ("2-", "GCC")}
    assert {(r.src, r.dst, r.overlap) for r in edges.collect()} == {("1+", "2-", "2M"), ("2+", "1-", "2M"), ("1+", "1-", "1M")}


def test_fasta_and_headers(spark, tmp_path):
    path = put(tmp_path / "f.fasta", ">a one\nAC\nGT\n>b # 3 # 9 # 1 # ID=1\nGG\n>SRR1_7 x L:+:8:- L:-:9:+\nTT\n")
    got = {r.id: (r.description, r.seq) for r in R.read_fasta(spark, path).collect()}
    assert got["a"] == ("a one", "ACGT") and got["b"][1] == "GG" and len(got) == 3
    assert [tuple(r) for r in R.read_orfs(spark, path).collect()] == [("b", 3, 9)]
    assert [r.value for r in R.contigs_to_gfa(spark, path).collect()] == ["S\t7\tTT", "L\t7\t+\t8\t-\t0M", "L\t7\t-\t9\t+\t0M"]
    bad, empty = put(tmp_path / "c" / "x.fasta", "Error recursion\n"), put(tmp_path / "c" / "y.fasta", "")
    put(tmp_path / "c" / "z.fasta", ">k\nAA\n")
    assert bad and empty and [r.id for r in R.read_cycles(spark, str(tmp_path / "c")).collect()] == ["k"]
    (tmp_path / "q.fasta.gz").write_bytes(gzip.compress(b">z\nAC\n"))
    assert R.read_fasta(spark, str(tmp_path / "q.fasta.gz")).first().seq == "AC"
    out = R.read_element_headers(spark, put(tmp_path / "is.fna", ">IS_x_IS3_unknown\nA\n>is_X_IS4_IS4\nA\n>T1_unknown_IS9\nA\n")).collect()
    assert {tuple(r) for r in out} == {("IS_x", "IS3", "IS3"), ("T1", "IS9", "IS9")}


def test_tables(spark, tmp_path):
    hit = "q\ts\t99.5\t10\t0\t0\t1\t10\t5\t14\t1e-5\t50.1\t20\t30\n"
    r = R.read_hits(spark, put(tmp_path / "h" / "a.tsv", hit)).first()
    assert (r.pident, r.length, r.evalue, r.slen, r.qlen) == (99.5, 10, 1e-5, 20, 30)
    assert tuple(R.read_hits_positional(spark, str(tmp_path / "h")).first()) == ("q", "s", 10, 1, 10)
    gff = put(tmp_path / "x.gff", "# c\n\nc1\tp\tCDS\t3\t9\t.\t+\t0\tID=g1;a=b\nc1\tp\tgene\t3\t9\t.\t+\t0\tID=g2\n")
    assert [tuple(x) for x in R.read_gff(spark, gff).collect()] == [("c1", 3, 9, "+", "g1")]
    sam = put(tmp_path / "x.sam", "@SQ\tSN:ref\tLN:500\nr1\t0\tref\t7\t60\t5M\t*\t0\t0\tACGTA\t*\tSA:Z:ref,9,+,5M,60,0;\nr2\t4\t*\t0\t0\t*\t*\t0\t0\t*\t*\nr3\t2048\tref\t1\t1\t2H3M\t*\t0\t0\tACG\t*\n")
    data, refs = R.read_sam(spark, sam)
    assert tuple(refs.first()) == ("ref", 500) and data.count() == 3
    assert [x.read for x in R.mapped(data).collect()] == ["r1", "r3"] and [x.read for x in R.mapped(data, True).collect()] == ["r1"]
    assert data.where("read = 'r1'").first().sa == "ref,9,+,5M,60,0;" and R.read_sam(spark, sam, "ref")[0].count() == 2
    fq = put(tmp_path / "x.fastq", "@a 1\nACG\n+\nIII\n@b\nAC\n+\n@I\n")
    assert {(x.id, x.seq, x.quality) for x in R.read_fastq(spark, fq).collect()} == {("a", "ACG", "III"), ("b", "AC", "@I")}
    tax = put(tmp_path / "t.tsv", "name\tgroup\tfamily\nISa\tG\tunknown\nisA\tG\tF\nISb\tG\tg\nshort\tG\n")
    assert {tuple(x) for x in R.read_taxonomy(spark, tax).collect()} == {("isA", "G", "F"), ("ISb", "G", "ISb")}
    aro = put(tmp_path / "aro.tsv", "ARO Accession\tARO Name\tDrug Class\naro:1\tx\tc\nARO:1\ty\td\n")
    assert [tuple(x) for x in R.read_ontology(spark, aro).collect()] == [("ARO:1", "y", "d")]
    summary = put(tmp_path / "s.txt", "SRR1: full=3, partial=4\nnoise a=9\n{'full': 7, 'x': 1.5}\n")
    assert R.read_mapping_summary(spark, summary).first()["values"] == {"full": "7", "partial": "4", "x": "1.5"}
    acc = put(tmp_path / "acc.txt", "SRR1\n\n  SRR2 \n")
    assert [x.accession for x in R.read_accessions(spark, acc).collect()] == ["SRR1", "SRR2"]
    assert [x["path"].endswith("x.gff") for x in R.discover(spark, str(tmp_path), "*.gff").collect()] == [True]
    assert R.read_table(spark, tax).columns == ["name", "group", "family"]


def test_packed_text(spark, tmp_path):
    """gzip and zstd (of several frames) beside plain text: the same rows, links in order within files."""
    import zstandard

    text = "H\tVN:Z:1.0\nS\ta\tACGT\nS\tb\tGGG\r\nL\ta\t+\tb\t-\t2M\nL\tb\t+\ta\t-\t1M\n"
    pack = zstandard.ZstdCompressor().compress
    for name, data in (("x.gfa", text.encode()), ("y.gfa.gz", gzip.compress(text.encode())), ("z.gfa.zst", pack(text[:30].encode()) + pack(text[30:].encode())), ("notzst", text.encode())):
        (tmp_path / name).write_bytes(data)
    nodes, edges = R.read_gfa(spark, str(tmp_path))
    by = lambda rows, *c: {f: sorted(tuple(r[x] for x in c) for r in rows if r["graph"].endswith(f)) for f in ("x.gfa", "y.gfa.gz", "z.gfa.zst", "notzst")}
    for found in (by(nodes.collect(), "node", "seq", "len"), by(edges.collect(), "src", "dst", "overlap", "turn")):
        assert found["x.gfa"] and all(x == found["x.gfa"] for x in found.values())
    alone = R.read_gfa(spark, str(tmp_path / "z.gfa.zst"))[0]
    assert alone.count() == 4
    order = [r.value for r in R.lines(spark, str(tmp_path / "z.gfa.zst")).orderBy("nth").collect()]
    assert order == text.replace("\r", "").splitlines()


def test_binary_alignments(spark, tmp_path):
    """The binary form of alignments gives what their text does."""
    refs = [("ref0", 500), ("ref1", 90)]
    rows = [("r1", 0, 0, 6, 60, [(5, 0)], "ACGTA", "ref0,9,+,5M,60,0;"), ("r2", 4, -1, -1, 0, [], "", ""), ("r3", 2048, 1, 0, 1, [(2, 5), (3, 0), (1, 1)], "ACGT", "ref1,1,-,4M,1,0;")]
    out = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", len(refs))
    for name, length in refs:
        out += struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", length)
    for name, flag, ref, pos, mapq, ops, seq, sa in rows:
        packed = bytes((len(seq) + 1) // 2) + b"\xff" * len(seq)
        tags = b"NMi" + struct.pack("<i", 3) + b"XBBs" + struct.pack("<ihh", 2, 1, 2) + (b"SAZ" + sa.encode() + b"\0" if sa else b"") + b"ASc\1"
        body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, mapq, 0, len(ops), flag, len(seq), -1, -1, 0) + name.encode() + b"\0" + b"".join(struct.pack("<I", n << 4 | op) for n, op in ops) + packed + tags
        out += struct.pack("<i", len(body)) + body
    (tmp_path / "x.bam").write_bytes(b"".join(gzip.compress(out[i : i + 50]) for i in range(0, len(out), 50)))
    text = "".join(f"@SQ\tSN:{n}\tLN:{length}\n" for n, length in refs)
    for name, flag, ref, pos, mapq, ops, seq, sa in rows:
        cigar = "".join(f"{n}{'MIDNSHP=X'[op]}" for n, op in ops) or "*"
        text += "\t".join([name, str(flag), refs[ref][0] if ref >= 0 else "*", str(pos + 1), str(mapq), cigar, "*", "0", "0", seq or "*", "*", *([f"SA:Z:{sa}"] if sa else [])]) + "\n"
    plain, plain_refs = R.read_sam(spark, put(tmp_path / "sam" / "x.sam", text))
    binary, binary_refs = B.read_bam(spark, str(tmp_path / "x.bam"))
    assert sorted(map(tuple, binary.collect())) == sorted(map(tuple, plain.drop("nth").collect()))
    assert sorted(map(tuple, binary_refs.collect())) == sorted(map(tuple, plain_refs.collect()))
    assert B.read_bam(spark, str(tmp_path / "x.bam"), "ref1")[0].count() == 1


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("c1", "ACGT", 4, 2)], "name string, seq string, length int, components int")
    K.write_fasta(rows, str(tmp_path / "f"), K.cycle_header(F.col("name"), F.col("length"), F.col("components")), F.col("seq"))
    assert text_of(tmp_path / "f") == ">c1-len4-comp2-\nACGT\n"
    K.write_split_fasta(rows, str(tmp_path / "s"), "name", F.col("name"), F.col("seq"))
    assert text_of(tmp_path / "s" / "name=c1") == ">c1\nACGT\n"
    assert K.write_table(rows, str(tmp_path / "t")) == 1 and text_of(tmp_path / "t").startswith("name\tseq\tlength")
    assert K.write_table(rows.limit(0), str(tmp_path / "none")) == 0 and not (tmp_path / "none").exists()
    assert K.write_enriched(rows.withColumn("ct_tag", F.lit("CT001")), str(tmp_path / "e")) == 1
    assert K.write_summary(rows.withColumn("ct_tag", F.lit("CT001")), str(tmp_path / "sum")) == 1
    K.write_json(rows, str(tmp_path / "j"))
    assert '"name":"c1"' in text_of(tmp_path / "j")
    gb = rows.withColumn("f", F.expr("array(struct(3 as start, 4 as end, -1 as strand, 'p' as product, 'g' as gene), struct(1 as start, 2 as end, 1 as strand, 'q' as product, 'h' as gene))"))
    K.write_genbank(gb, str(tmp_path / "gb"), "name", "seq", "f")
    text = text_of(tmp_path / "gb")
    assert text.index("1..2") < text.index("complement(3..4)") and text.rstrip().endswith("//") and "        1 acgt" in text
    blocks = spark.createDataFrame([("r", "cargo", 1, 9, 0, 8, 50), ("r", "transposon", 1, 9, 10, 18, 50)], "read string, annot string, r_start int, r_end int, q_start int, q_end int, read_len int")
    for _ in range(2):
        K.write_blocks(blocks, str(tmp_path / "b"))
    back = R.read_annotated_blocks(spark, str(tmp_path / "b")).collect()
    assert len(back) == 4 and {(x.read, x.annot, x.q_start, x.q_end, x.read_len) for x in back} == {("r", "cargo", 0, 8, 50), ("r", "transposon", 10, 18, 50)}
    assert merge_blocks(blocks, ["read"]).first().q_end == 18
    reads = spark.createDataFrame([("a", "AC", "II"), ("b", "GG", "II")], "id string, seq string, quality string")
    K.write_fastq(reads, reads.where("id = 'b'"), str(tmp_path / "fq"))
    assert text_of(tmp_path / "fq") == "@b\nGG\n+\nII\n"
    assert K.merged_fasta(spark.createDataFrame([("file:/d/e.fasta", "h x", "AC")], "file string, description string, seq string")).first().header == "d_e|h x"
    counts = spark.createDataFrame([("S1", "CT", 2), ("S1", "TC", 1), (None, "CT", 2)], "run string, pattern string, n int")
    assert {r.value for r in K.summary_lines(counts).collect()} == {"S1: CT=2, TC=1", "TOTAL: CT=2"}


def test_cycle_analysis_and_scoring(spark):
    seq = {f"{i}": "ACGT" * 5 + "ACCA" * (i + 3) + "GATTACA" * (i + 1) for i in range(3)}
    back = {k: v[::-1].translate(str.maketrans("ACGT", "TGCA")) for k, v in seq.items()}
    nodes = spark.createDataFrame([("g", k + s, d[k], len(d[k])) for s, d in (("+", seq), ("-", back)) for k in seq], "graph string, node string, seq string, len int")
    links = [("0+", "1+"), ("1+", "2+"), ("2+", "0+"), ("1+", "0+")]
    turn = str.maketrans("+-", "-+")
    edges = spark.createDataFrame([("g", a, b, "2M") for x in links for a, b in (x, (x[1].translate(turn), x[0].translate(turn)))], "graph string, src string, dst string, overlap string")
    got = P.cycle_analysis(nodes, edges, ["graph"], Options(path_limit=5, min_size=10, max_size=1000, kmer=15, kmer_threshold=99.0)).collect()
    assert {r.components for r in got} == {2, 3} and all(r.name.startswith("Cycle_") for r in got)
    cycles = spark.createDataFrame([("s", r.name, r.length, r.components) for r in got], "sample string, cycle string, length int, components int")
    feats = spark.createDataFrame([(got[0].name, "Antibiotics", "blaTEM", 90.0, 1, 9), (got[0].name, "InsertionSequences", "IS26", 90.0, 20, 40), (got[0].name, "Xenobiotics", "x", 95.0, 30, 50)], "cycle string, r_type string, product string, score double, start int, end int")
    final = P.score_candidates(cycles, feats, "cycle", Options(score_threshold=1.0))
    row = final.where(F.col("cycle") == got[0].name).first()
    assert row.n_xeno == 0 and row.comp_products == "Novel" and row.n_comp == 1 and row.score0 > 200
    rich = P.enrich(final.where("n_ant > 0"), ["cycle"]).first()
    assert (rich.ct_tag, rich.category, rich.is_group, rich["class"], rich.organism) == ("CT001", "Novel", "IS6", "Beta-lactam", "Unknown")
    pairs = spark.createDataFrame([("L1", "S1", 1), ("L1", "S2", 2)], "long_id string, short_id string, ord int")
    names = P.short_ids(spark.createDataFrame([("L1",), ("L9",)], "long_id string"), pairs).collect()
    assert {tuple(r) for r in names} == {("L1", "S2"), ("L9", "Unknown_SRR_1")}
    tags = spark.createDataFrame([("CT001", "Novel", "a"), ("CT002", "novel ", "b"), ("CT003", "Known", "a"), ("CT004", "Novel", "a")], "ct_tag string, category string, sample string")
    hits = spark.createDataFrame([("CT001", "CT002", 95.0, 90, 100, 110, 0.0), ("CT001", "CT001", 99.0, 90, 90, 90, 0.0), ("CT004", "CT001", 80.0, 90, 90, 90, 0.0)], "qseqid string, sseqid string, pident double, length int, slen int, qlen int, evalue double")
    out = {(r.node, r.cluster, r.n_samples) for r in P.cluster_novel(tags, P.similar_links(hits)).collect()}
    assert out == {("CT001", "CTCluster001", 2), ("CT002", "CTCluster001", 2), ("CT004", "Unique", 1)}
    records = spark.createDataFrame([("a", "Cycle_1-len5", "AC")], "sample string, description string, seq string")
    who = spark.createDataFrame([("CT002", "a", "Cycle_1"), ("CT001", "a", "Cycle_1")], "ct_tag string, sample string, cycle_id string")
    assert tuple(P.tag_sequences(who, records).first()) == ("CT001", "AC")


def test_config():
    c = from_dict({"options": {"path_limit": 7, "other": 1}, "tolerances": {"tolerance": 5}})
    assert c.options.path_limit == 7 and c.options.mean == 5850.0 and c.tolerances.tolerance == 5 and list(c.patterns)[0] == "CT"


def test_streaming_hits(spark, tmp_path):
    hit = "q\ts\t{}\t50\t0\t0\t1\t10\t5\t14\t0\t50.1\t50\t60\n"
    put(tmp_path / "in" / "a.tsv", hit.format(99.0) + hit.format(70.0))
    stream = stateless.scored_hits(stateless.hit_stream(spark, str(tmp_path / "in")))
    run = stream.writeStream.format("memory").queryName("scored").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start()
    run.awaitTermination(60)
    assert [r.score for r in spark.table("scored").collect()] == [99.0]


def test_windowed_best_scores(spark):
    rows = [("q", 99.0, 50, 50, 0.0, "2024-01-01 00:01:00"), ("q", 90.0, 50, 50, 0.0, "2024-01-01 00:02:00"), ("q", 85.0, 50, 50, 0.0, "2024-01-01 00:11:00")]
    hits = spark.createDataFrame(rows, "qseqid string, pident double, length int, slen int, evalue double, at string").withColumn("at", F.col("at").cast("timestamp"))
    assert sorted(r.score for r in stateless.best_scores(hits, "at").collect()) == [85.0, 99.0]


def test_annotated_blocks_are_read_without_a_shuffle(spark, tmp_path, monkeypatch):
    """Files cut anywhere, without a first header, with > inside, other line ends and packed ones: rows
    are those of a line by line reader, in order; lines carry their read without being dealt."""
    import gzip
    import re

    line = "({}) Ref 1-9 | Read {}-{} | ReadLen=50"
    texts = {"a.txt": line.format("cargo", 1, 2) + "\n>r1 x \n" + "\n".join(line.format("cargo", i, i + 5) for i in range(200)) + "\n>>r2\n" + line.format("transposon", 3, 4) + "\nnoise > here\n" + line.format("other", 5, 6)}
    texts["b.txt"] = ">s1\r\n" + line.format("cargo", 7, 8) + "\r\n>s2\r" + line.format("cargo", 9, 10) + "\r>s3\r" + line.format("transposon", 11, 12) + "\r"
    texts["c.txt"] = ">" + line.format("cargo", 13, 14) + "\n>t\n"
    texts["d.txt.gz"] = ">u\n" + line.format("cargo", 15, 16) + "\n"
    want = []
    for name, text in texts.items():
        (tmp_path / name).write_bytes(gzip.compress(text.encode()) if name.endswith("gz") else text.encode())
        read = None
        for x in re.split("\r\n|\n|\r", text):
            read = x[1:].strip(" ") if x.startswith(">") else read
            hit = re.search(r"\((transposon|cargo)\).*Read\s+(\d+)-(\d+)", x)
            if hit and read is not None:
                want.append((name, read, hit[1], int(hit[2]), int(hit[3])))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        back = R.read_annotated_blocks(spark, str(tmp_path))
        rows = sorted(back.collect(), key=lambda x: (x.file, x.nth))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(x.file.split("/")[-1], x.read, x.annot, x.q_start, x.q_end) for x in rows] == want
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan

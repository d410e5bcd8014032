"""Text sinks. Rows are formatted by expressions and written by Spark's writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transpark.plans.storage import materialise

#: Columns of the short summary of an enriched table.
SUMMARY = ("ct_tag", "SampleID", "CycleID", "category", "length", "is_group", "is_family", "class", "gene", "score0", "score1", "score2")


def fasta_lines(header: Column, seq: Column) -> Column:
    """A record of two lines."""
    return F.concat(F.lit(">"), header, F.lit("\n"), seq)


def cycle_header(name: Column, length: Column, components: Column | None = None) -> Column:
    """name-len5850-comp3-, or without the components as older files have it."""
    out = F.concat(name, F.lit("-len"), length.cast("string"))
    return F.concat(out, F.lit("-comp"), components.cast("string"), F.lit("-")) if components is not None else out


def write_fasta(df: DataFrame, path: str, header: Column, seq: Column, mode: str = "error") -> None:
    """One record per row."""
    df.select(fasta_lines(header, seq).alias("value")).write.mode(mode).text(path)


def write_split_fasta(df: DataFrame, path: str, key: str, header: Column, seq: Column) -> None:
    """Records in a folder for each key."""
    df.select(key, fasta_lines(header, seq).alias("value")).write.partitionBy(key).text(path)


def write_table(df: DataFrame, path: str, sep: str = "\t", mode: str = "error") -> int:
    """A table with a header; nothing is written without rows. Returns the number of rows."""
    return _written(materialise(df), path, sep, mode)


def _written(df: DataFrame, path: str, sep: str, mode: str = "error") -> int:
    rows = df.count()
    if rows:
        df.write.mode(mode).csv(path, sep=sep, header=True)
    return rows


def write_enriched(df: DataFrame, path: str, tag: str = "ct_tag") -> int:
    """The enriched table as CSV; returns the number of distinct candidates."""
    df = materialise(df)
    if _written(df, path, ","):
        return df.select(tag).distinct().count()
    return 0


def write_summary(df: DataFrame, path: str) -> int:
    """The summary columns that the table has, as CSV; returns the number of rows."""
    return write_table(df.select(*[c for c in SUMMARY if c in df.columns]), path, ",")


def write_json(df: DataFrame, path: str) -> None:
    """One object per line."""
    df.write.json(path)


def genbank_record(name: Column, seq: Column, features: Column, date: Column) -> Column:
    """A GenBank text record; features: array of (start, end, strand, product, gene), by start."""
    sorted_ = F.array_sort(features)
    place = lambda f: F.when(f["strand"] < 0, F.concat(F.lit("complement("), f["start"].cast("string"), F.lit(".."), f["end"].cast("string"), F.lit(")"))).otherwise(F.concat_ws("..", f["start"].cast("string"), f["end"].cast("string")))
    one = lambda f: F.concat(F.lit("     CDS             "), place(f), F.lit('\n                     /gene="'), f["gene"], F.lit('"\n                     /product="'), f["product"], F.lit('"'))
    rows = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.length(seq) / 60)).cast("int")), lambda i: F.concat(F.lpad(((i - 1) * 60 + 1).cast("string"), 9, " "), F.lit(" "), F.trim(F.regexp_replace(F.lower(F.substring(seq, (i - 1) * 60 + 1, F.lit(60))), "(.{10})", "$1 "))))
    head = F.concat(F.lit("LOCUS       "), name, F.lit(" "), F.length(seq).cast("string"), F.lit(" bp    DNA     linear   UNK "), F.upper(F.date_format(date, "dd-MMM-yyyy")), F.lit("\nDEFINITION  "), name, F.lit("\nFEATURES             Location/Qualifiers\n"))
    return F.concat(head, F.array_join(F.transform(sorted_, one), "\n"), F.lit("\nORIGIN\n"), F.array_join(rows, "\n"), F.lit("\n//"))


def write_genbank(df: DataFrame, path: str, name: str, seq: str, features: str) -> None:
    """One record per row, dated today."""
    df.select(genbank_record(F.col(name), F.col(seq), F.col(features), F.current_date()).alias("value")).write.text(path)


def write_blocks(blocks: DataFrame, path: str) -> None:
    """Annotated reads as text, appended: a '>read' line and a line per block. Blocks are dealt by read
    and sorted, one line each; no read is held whole."""
    line = F.concat(F.lit("("), F.col("annot"), F.lit(") Ref "), F.concat_ws("-", "r_start", "r_end"), F.lit(" | Read "), F.concat_ws("-", "q_start", "q_end"), F.lit(" | ReadLen="), F.col("read_len").cast("string"))
    dealt = blocks.where("read IS NOT NULL").select("read", "annot", "r_start", "r_end", "q_start", "q_end", "read_len").repartition("read")
    numbered = dealt.select("read", "q_start", line.alias("line")).withColumn("nth", F.row_number().over(Window.partitionBy("read").orderBy("q_start", "line")))
    rows = numbered.where((F.col("nth") == 1) | F.col("line").isNotNull())
    rows.select(F.concat_ws("\n", F.when(F.col("nth") == 1, F.concat(F.lit(">"), "read")), "line").alias("value")).write.mode("append").text(path)


def write_fastq(reads: DataFrame, ids: DataFrame, path: str) -> None:
    """FASTQ records of the reads whose id is among ids (id)."""
    kept = reads.join(ids.select("id"), "id", "left_semi")
    kept.select(F.concat(F.lit("@"), "id", F.lit("\n"), "seq", F.lit("\n+\n"), "quality").alias("value")).write.text(path)


def merged_fasta(records: DataFrame) -> DataFrame:
    """Records renamed to folder_file|header, from (file, description, seq)."""
    p = F.split("file", "/")
    name = F.concat(F.element_at(p, -2), F.lit("_"), F.regexp_replace(F.element_at(p, -1), r"\.[^.]*$", ""), F.lit("|"), F.col("description"))
    return records.select(name.alias("header"), "seq")


def summary_lines(counts: DataFrame, insertions: DataFrame | None = None) -> DataFrame:
    """Text lines of pattern counts (run, pattern, n): per run and in total (run null); and of
    insertions (read, event, n), a line for each read."""
    who = F.coalesce(F.concat(F.col("run"), F.lit(":")), F.lit("TOTAL:"))
    packed = counts.groupBy(who.alias("who")).agg(F.sort_array(F.collect_list(F.struct("pattern", "n"))).alias("c"))
    listed = lambda name: F.array_join(F.transform("c", lambda x: F.concat_ws("=", x[name], x["n"].cast("string"))), ", ")
    out = packed.select(F.concat("who", F.lit(" "), listed("pattern")).alias("value"))
    if insertions is None:
        return out
    own = insertions.groupBy("read").agg(F.sort_array(F.collect_list(F.struct("event", "n"))).alias("c"))
    return out.unionByName(own.select(F.concat(F.lit("INSERTION "), F.col("read").cast("string"), F.lit(": "), listed("event")).alias("value")))

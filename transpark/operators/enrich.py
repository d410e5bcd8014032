"""Enrichment of candidates: element families, resistance classes, expansion, boundary split."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from transpark.plans.ordering import number_rows
from transpark.plans.storage import materialise, ship_by_value

# Names known by themselves: (name, group, family).
FAMILIES = [
    ("is1", "IS1", "IS1"),
    ("is1a", "IS1", "IS1"),
    ("is1b", "IS1", "IS1"),
    ("issen", "IS1", "ISSen"),
    ("issen1", "IS1", "ISSen"),
    ("issen2", "IS1", "ISSen"),
    ("is2", "IS3", "IS2"),
    ("is3", "IS3", "IS3"),
    ("is150", "IS3", "IS150"),
    ("isapl2", "IS3", "IS150"),
    ("isapl3", "IS3", "IS150"),
    ("is407", "IS3", "IS407"),
    ("is51", "IS3", "IS51"),
    ("is679", "IS3", "IS679"),
    ("is4", "IS4", "IS4"),
    ("is10", "IS4", "IS10"),
    ("is231", "IS4", "IS231"),
    ("is1151", "IS4", "IS1151"),
    ("is5", "IS5", "IS5"),
    ("is427", "IS5", "IS427"),
    ("is903", "IS5", "IS903"),
    ("is1031", "IS5", "IS1031"),
    ("is6", "IS6", "IS6"),
    ("is15", "IS6", "IS15"),
    ("is26", "IS6", "IS26"),
    ("is257", "IS6", "IS257"),
    ("is1936", "IS6", "IS1936"),
    ("is21", "IS21", "IS21"),
    ("is408", "IS21", "IS408"),
    ("is30", "IS30", "IS30"),
    ("is1655", "IS30", "IS1655"),
    ("isapl1", "IS30", "ISApl1"),
    ("is66", "IS66", "IS66"),
    ("is1133", "IS66", "IS1133"),
    ("is91", "IS91", "IS91"),
    ("iscr", "IS91", "ISCR"),
    ("iscr1", "IS91", "ISCR"),
    ("iscr2", "IS91", "ISCR"),
    ("iscr3", "IS91", "ISCR"),
    ("is110", "IS110", "IS110"),
    ("is492", "IS110", "IS492"),
    ("is200", "IS200/IS605", "IS200"),
    ("is605", "IS200/IS605", "IS605"),
    ("is608", "IS200/IS605", "IS608"),
    ("is256", "IS256", "IS256"),
    ("is1294", "IS256", "IS1294"),
    ("is1301", "IS256", "IS1301"),
    ("is481", "IS481", "IS481"),
    ("is630", "IS630", "IS630"),
    ("is869", "IS630", "IS869"),
    ("is701", "IS701", "IS701"),
    ("is982", "IS982", "IS982"),
    ("is1111", "IS1111", "IS1111"),
    ("is1380", "IS1380", "IS1380"),
    ("isecp", "IS1380", "ISEcp"),
    ("isecp1", "IS1380", "ISEcp"),
    ("isecp1b", "IS1380", "ISEcp"),
    ("is1595", "IS1595", "IS1595"),
    ("isncy", "IS1595", "ISNcy"),
    ("isas1", "ISAs1", "ISAs1"),
    ("is3000", "ISAs1", "ISAs1"),
    ("tn", "Composite", "Composite"),
]
# Prefixes of series, tried longest first: (prefix, group, family).
SERIES = [
    ("IS26", "IS6", "IS26"), ("IS10", "IS4", "IS10"), ("IS21", "IS21", "IS21"), ("IS30", "IS30", "IS30"), ("IS66", "IS66", "IS66"),
    ("IS91", "IS91", "IS91"), ("ISCR", "IS91", "ISCR"), ("IS110", "IS110", "IS110"), ("IS256", "IS256", "IS256"), ("IS481", "IS481", "IS481"),
    ("IS630", "IS630", "IS630"), ("IS701", "IS701", "IS701"), ("IS982", "IS982", "IS982"), ("IS1111", "IS1111", "IS1111"), ("IS1380", "IS1380", "IS1380"),
    ("IS1595", "IS1595", "IS1595"), ("ISEcp", "IS1380", "ISEcp"), ("ISApl", "IS256", "ISApl"), ("ISAs1", "ISAs1", "ISAs1"), ("IS6", "IS6", "IS6"),
    ("IS5", "IS5", "IS5"), ("IS4", "IS4", "IS4"), ("IS3", "IS3", "IS3"), ("IS2", "IS3", "IS2"), ("IS1", "IS1", "IS1"),
]
# Resistance classes by pattern, the first that is found counts.
CLASSES = [
    (r"\bbla\w*", "Beta-lactam"),
    (r"\baac[(\[]", "Aminoglycoside"),
    (r"\baph[(\[]", "Aminoglycoside"),
    (r"\bant[(\[]", "Aminoglycoside"),
    (r"\baad\w*", "Aminoglycoside"),
    (r"\barm\w*", "Aminoglycoside"),
    (r"\brmtA|rmtB|rmtC|rmtD|rmtE|rmtF|rmtG|rmtH\b", "Aminoglycoside"),
    (r"\btet[A-Z]?\b", "Tetracycline"),
    (r"\berm\w*", "Macrolide-Lincosamide-Streptogramin"),
    (r"\bmph\w*", "Macrolide"),
    (r"\bmsr\w*", "Macrolide"),
    (r"\bcfr\w*", "Phenicol-Oxazolidinone"),
    (r"\bcat\b|\bcml\b|\bflo\b", "Phenicol"),
    (r"\bsul[0-9]?\b", "Sulfonamide"),
    (r"\bdfr\w*", "Trimethoprim"),
    (r"\bqnr[A-Z]?\b", "Fluoroquinolone"),
    (r"\bacrA|acrB|mexA|mexB|oqxA|oqxB\b", "Fluoroquinolone"),
    (r"\bvan[A-Z]\b", "Glycopeptide"),
    (r"\bcol\w*|mcr\w*", "Colistin"),
    (r"\bmerA|merB|merC\b", "Mercury"),
    (r"\bqac\w*|emrA|emrB\b", "Quaternary-ammonium"),
    (r"\blnu\w*", "Lincosamide"),
    (r"\bvgb\w*|vat\w*\b", "Streptogramin"),
    (r"\bopa\w*|oxa\w*\b", "Beta-lactam"),
    (r"\bcps\w*|cfi\w*\b", "Cephalosporin"),
]
SOURCES = ("ISFinder_", "ISFDB_", "TNcentral_")
KNOWN = {name: (group, family) for name, group, family in FAMILIES}


def _pair(group: str | Column, family: str | Column) -> Column:
    lift = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.struct(lift(group).alias("is_group"), lift(family).alias("is_family"))


def element_names(name: Column) -> tuple[Column, Column]:
    """(full, base): the name without one database prefix, and its part before _, - or :."""
    full = F.regexp_replace(F.trim(name), "^(" + "|".join(SOURCES) + ")", "")
    return full, F.split(full, "[_:-]")[0]


def element_family(df: DataFrame, name: str, taxonomy: DataFrame | None = None) -> DataFrame:
    """df with is_group and is_family of an element name.

    Looked up in the taxonomy (name, is_group, is_family; broadcast by size only where Spark finds
    it small) by full name, then base; then in the known names, the series prefixes, IS + digits,
    Tn + digit; else Unknown.
    """
    full, base = element_names(F.col(name))
    out = df.withColumn("full_", F.lower(full)).withColumn("base_", F.lower(base))
    found = []
    if taxonomy is not None:
        for key in ("full_", "base_"):
            t = taxonomy.select(F.lower("name").alias("t_name"), _pair(F.col("is_group"), F.col("is_family")).alias(f"t_{key}")).dropDuplicates(["t_name"])
            out = out.join(t, out[key] == t["t_name"], "left").drop("t_name")
            found.append(F.col(f"t_{key}"))
    known = F.create_map(*[F.lit(x) for n, (g, f) in KNOWN.items() for x in (n, f"{g}|{f}")])
    for key in ("base_", "full_"):
        hit = F.try_element_at(known, F.col(key))
        found.append(F.when(hit.isNotNull(), _pair(F.split(hit, r"\|")[0], F.split(hit, r"\|")[1])))
    for prefix, group, family in sorted(SERIES, key=lambda s: -len(s[0])):
        found.append(F.when(F.col("base_").rlike(rf"^{prefix.lower()}\b"), _pair(group, family)))
    number = F.upper(F.regexp_extract("full_", r"^(is\d+)", 1))
    found += [F.when(number != "", _pair(number, number)), F.when(F.col("full_").rlike(r"^tn\d"), _pair("Composite", "Composite"))]
    out = out.withColumn("f_", F.coalesce(*found, _pair("Unknown", "Unknown")))
    return out.withColumn("is_group", F.col("f_.is_group")).withColumn("is_family", F.col("f_.is_family")).drop("full_", "base_", "f_", "t_full_", "t_base_")


def resistance_class(text: Column) -> Column:
    """The first class whose pattern is found, else Other."""
    trimmed = F.trim(text)
    out = None
    for pattern, name in CLASSES:
        test = trimmed.rlike("(?i)" + pattern)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise("Other")


def ontology_id(text: Column) -> Column:
    """The upper-case id of 'ARO:...' or 'ARO::...' names, else null."""
    found = F.upper(F.regexp_extract(text, r"(?i)^(?:.*::)?(ARO:\d+)$", 1))
    return F.when(found != "", found)


def with_ontology(df: DataFrame, gene: str, index: DataFrame) -> DataFrame:
    """df with aro_name and aro_class of genes named by ontology ids; index: (aro_id, aro_name, aro_class)."""
    i = index.select(F.upper("aro_id").alias("a_"), "aro_name", "aro_class").dropDuplicates(["a_"])
    return df.withColumn("o_", ontology_id(F.col(gene))).join(i, F.col("o_") == F.col("a_"), "left").drop("o_", "a_")


def expand_classes(candidates: DataFrame, tag: str, products: str) -> DataFrame:
    """One row per candidate and distinct class with the first gene of each, by position.

    ``products`` holds ';'-joined names; without any there is one row with class and gene None.
    """
    rows = candidates.select("*", F.posexplode_outer(F.when(F.coalesce(F.trim(products), F.lit("")) != "", F.split(products, ";"))).alias("at", "gene"))
    rows = rows.withColumn("gene", F.coalesce(F.trim("gene"), F.lit("None"))).where((F.col("gene") != "") | F.col("at").isNull())
    rows = rows.withColumn("class", F.when(F.col("at").isNull(), "None").otherwise(resistance_class(F.col("gene"))))
    w = Window.partitionBy(tag, "class").orderBy("at")
    return rows.withColumn("nth", F.row_number().over(w)).where("nth = 1").drop("nth", "at")


def tag_candidates(candidates: DataFrame, order: list[str], offset: int = 0) -> DataFrame:
    """Candidates numbered over the whole order and tagged CT001, CT002, ..."""
    numbered = number_rows(candidates, order, "nth_")
    return numbered.withColumn("ct_tag", F.format_string("CT%03d", F.col("nth_") + offset)).drop("nth_")


def split_boundaries(df: DataFrame, length: str, is_spans: str, gene_spans: str) -> DataFrame:
    """df with the transposon and cargo ranges: t_start, t_end, c_start, c_end (null: no cargo).

    The transposon runs from the first range's start to the end of the last range in order. Genes
    all to one side give the cargo up to the last or from the first of them; genes on both sides
    none; without genes the longer flank is cargo, the right one if equal and not empty.
    """

    def ranges(c: str) -> Column:
        good = F.filter(F.split(F.coalesce(F.col(c), F.lit("")), ";"), lambda p: F.trim(p).rlike(r"^\d+-\d+$"))
        pair = lambda p: F.struct(F.split(F.trim(p), "-")[0].cast("int").alias("s"), F.split(F.trim(p), "-")[1].cast("int").alias("e"))
        return F.sort_array(F.transform(good, pair))

    out = df.withColumn("i_", ranges(is_spans)).withColumn("g_", ranges(gene_spans)).where(F.size("i_") > 0)
    out = out.withColumn("t_start", F.col("i_")[0]["s"]).withColumn("t_end", F.element_at("i_", -1)["e"])
    low, high = F.array_min(F.transform("g_", lambda g: g["s"])), F.array_max(F.transform("g_", lambda g: g["e"]))
    right, left = F.col(length) - F.col("t_end"), F.col("t_start") - 1
    any_gene = F.size("g_") > 0
    after, before = any_gene & (low > F.col("t_end")), any_gene & (high < F.col("t_start"))
    c_start = F.when(after, F.col("t_end") + 1).when(before, low).when(any_gene, None).when((right >= left) & (right > 0), F.col("t_end") + 1).when(left > right, F.lit(1))
    c_end = F.when(after, high).when(before, F.col("t_start") - 1).when(any_gene, None).when((right >= left) & (right > 0), F.col(length)).when(left > right, F.col("t_start") - 1)
    out = out.withColumn("cs_", c_start).withColumn("ce_", c_end)
    cargo = (F.col("cs_") != 0) & (F.col("ce_") != 0) & (F.col("ce_") > F.col("cs_"))
    return out.withColumn("c_start", F.when(cargo, F.col("cs_"))).withColumn("c_end", F.when(cargo, F.col("ce_"))).drop("i_", "g_", "cs_", "ce_")


def keyword_class(text: Column, enzymatic: list[str], xenobiotic: list[str], excluded: list[str]) -> Column:
    """excluded, enzymatic, xenobiotic or other, by the first list with a keyword in the text."""
    has = lambda words: F.lower(text).rlike("|".join(map(_quoted, words)))
    return F.when(has(excluded), "excluded").when(has(enzymatic), "enzymatic").when(has(xenobiotic), "xenobiotic").otherwise("other")


def _quoted(word: str) -> str:
    return "".join(c if c.isalnum() or c == " " else "\\" + c for c in word)


def keyword_counts(df: DataFrame, text: str, keywords: list[str]) -> DataFrame:
    """(keyword, n): rows whose lower-cased text has the keyword; a row counts for each it has."""
    found = F.filter(F.array(*map(F.lit, keywords)), lambda k: F.lower(F.col(text)).contains(k))
    return df.select(F.explode(found).alias("keyword")).groupBy("keyword").agg(F.count("*").alias("n"))


#: Bytes of keywords that one automaton may be built of.
AUTOMATON_BYTES = 16_000_000


def keyword_matches(df: DataFrame, keywords: DataFrame, text: str, keep: list[str], keyword: str = "keyword", most: int = AUTOMATON_BYTES) -> DataFrame:
    """(keep, keyword): a row for each keyword of a table that a row's lower-cased text contains.

    Keywords are lower-cased and distinct; null and empty ones match nothing, and a null text has none.
    All are looked for in one pass over a text, by an automaton that each task builds of the keywords it
    was sent. A table of more than ``most`` bytes is dealt to several automata by hash, with a pass each.
    """
    table = materialise(keywords.select(F.lower(keyword).alias("w")).where(F.length("w") > 0).distinct())
    total = table.agg(F.sum(F.octet_length("w"))).first()[0] or 0
    blocks = -(-total // most)
    rows = df.select(*keep, F.lower(F.col(text)).alias("text_"))
    out = None
    for block in range(blocks):
        sent = df.sparkSession.sparkContext.broadcast([r.w for r in table.where(F.pmod(F.xxhash64("w"), F.lit(blocks)) == block).collect()])
        each = rows.mapInArrow(_matcher(sent, keep), StructType([*[df.schema[c] for c in keep], StructField("keyword", StringType())]))
        out = each if out is None else out.unionByName(each)
    return out if out is not None else rows.select(*keep, F.lit("").alias("keyword")).limit(0)


def _matcher(sent, keep: list[str]):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        words = sent.value
        automaton = ahocorasick.Automaton()
        for i, w in enumerate(words):
            automaton.add_word(w, i)
        automaton.make_automaton()
        for batch in batches:
            at, found = [], []
            for n, text in enumerate(batch.column(len(keep))):
                if text.is_valid:
                    hits = {i for _, i in automaton.iter(text.as_py())}
                    at += [n] * len(hits)
                    found += hits
            places = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(places) for c in range(len(keep))), pa.array([words[i] for i in found], pa.string())], names=[*keep, "keyword"])

    return kernel


def keyword_table_classes(df: DataFrame, keywords: DataFrame, text: str, keep: list[str], other: str = "other") -> DataFrame:
    """(keep, class): of the classes (keyword, class, rank) whose keywords a row's text contains, that of
    the least rank, otherwise ``other``. ``keep`` tells rows apart."""
    ranked = keywords.select(F.lower("keyword").alias("keyword"), "class", "rank")
    best = keyword_matches(df, keywords, text, keep).join(ranked, "keyword").groupBy(*keep).agg(F.min_by("class", F.struct("rank", "class")).alias("class"))
    return df.select(*keep).join(best, keep, "left").withColumn("class", F.coalesce("class", F.lit(other)))


ship_by_value(__name__)

"""Composed plans: cycles from graphs, scored candidates, clusters, final tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transpark.functions.sequences import is_protein
from transpark.operators import graph as G
from transpark.operators import hits as H
from transpark.operators.components import cluster_tags, connected_components
from transpark.operators.enrich import element_family, expand_classes, tag_candidates
from transpark.operators.intervals import without_overlap
from transpark.operators.pairwise import align_all
from transpark.operators.similarity import containment_pairs, kmer_dedupe
from transpark.plans.config import Options
from transpark.plans.ordering import number_rows
from transpark.plans.storage import materialise


def cycle_analysis(nodes: DataFrame, edges: DataFrame, keys: list[str], options: Options = Options()) -> DataFrame:
    """Cycles of graphs: keys, name, sequence, length, components, hairpin.

    Simple cycles are de-duplicated by path and sequence, filtered by size, then hairpins follow,
    and near-copies by k-mers go last. nodes: (keys, node, seq, len).
    """
    cycles = G.simple_cycles(edges, keys, options.path_limit).withColumn("text", F.array_join("path", ","))
    cycles = materialise(cycles.withColumn("path_id", F.concat_ws(" ", F.lit("0"), *keys, "text")))
    kept = G.dedupe_paths(cycles, nodes, keys).withColumn("hairpin", F.lit(False))
    back = G.hairpin_paths(edges, keys, options.path_limit).withColumn("text", F.array_join("path", ",")).withColumn("path_id", F.concat_ws(" ", F.lit("1"), *keys, "text")).withColumn("hairpin", F.lit(True))
    paths = materialise(kept.unionByName(back))
    built = G.path_sequences(paths, nodes, edges, keys).join(paths.select(*keys, "path_id", "hairpin"), [*keys, "path_id"])
    sized = G.in_size(built, options.min_size, options.max_size, options.min_components, options.max_components)
    distinct = materialise(G.distinct_cycles(sized, keys, "path_id"))
    left = kmer_dedupe(distinct, options.kmer, options.kmer_threshold, "path_id", "sequence")
    n = F.row_number().over(Window.partitionBy(*keys).orderBy("path_id"))
    name = F.concat(F.lit("Cycle_"), F.when(F.col("hairpin"), "reverseoriented_").otherwise(""), n.cast("string"))
    return left.withColumn("name", name).select(*keys, "name", "sequence", "length", "components", "hairpin")


def score_candidates(cycles: DataFrame, features: DataFrame, key: str, options: Options = Options()) -> DataFrame:
    """The final table: scored, filtered, ranked and packed candidates of each sample.

    cycles: (sample, key, length, components); features: (key, r_type, product, score, start, end).
    Xenobiotic features that overlap an insertion sequence are hidden, but count in the score. A
    candidate without a known composite transposon is Novel.
    """
    inputs = H.score_inputs(features, [key])
    joined = cycles.join(inputs, key, "left").fillna(0, ["ant", "ins", "xeno", "n_ant", "n_ins", "n_xeno", "n_comp"])
    args = [F.col(c) for c in ("ant", "ins", "xeno", "n_ant", "n_ins", "n_xeno", "length", "components")]
    scored = joined.withColumns({f"score{k}": H.composite_score(*args, k, options.mean, options.std, options.max_z, options.one_sided) for k in (0, 1, 2)})
    ranked = H.rank_candidates(scored, ["sample"], f"score{options.score_kind}", [key], options.score_threshold)
    seen = without_overlap(features.where("r_type = 'Xenobiotics'"), features.where("r_type = 'InsertionSequences'"), [key])
    shown = features.where("r_type <> 'Xenobiotics'").unionByName(seen)
    kinds = {"ant": "Antibiotics", "is": "InsertionSequences", "xeno": "Xenobiotics", "comp": "CompTNs"}
    packed = H.pack_features(shown, [key], ["start"], kinds)
    drop = [c for c in packed.columns if c != key and c in ranked.columns]
    out = ranked.drop(*drop).join(packed, key, "left")
    novel = F.coalesce(F.col("n_comp"), F.lit(0)) == 0
    return out.withColumn("comp_products", F.when(novel, "Novel").otherwise(F.col("comp_products"))).withColumn("n_comp", F.greatest(F.coalesce("n_comp", F.lit(0)), F.lit(1)))


def enrich(final: DataFrame, order: list[str], taxonomy: DataFrame | None = None, organisms: DataFrame | None = None, offset: int = 0) -> DataFrame:
    """The enriched table: tags, category, element family of the first element, one row a class."""
    tagged = tag_candidates(final, order, offset)
    tagged = tagged.withColumn("category", F.when(F.col("comp_products") == "Novel", "Novel").otherwise("Known"))
    tagged = tagged.withColumn("first_is", F.coalesce(F.split("is_products", ";")[0], F.lit("")))
    out = expand_classes(element_family(tagged, "first_is", taxonomy), "ct_tag", "ant_products")
    if organisms is None:
        return out.withColumn("organism", F.lit("Unknown"))
    return out.join(organisms.select("sample", "organism"), "sample", "left").withColumn("organism", F.coalesce("organism", F.lit("Unknown")))


def cluster_novel(enriched: DataFrame, links: DataFrame, order: str = "sample") -> DataFrame:
    """(node, cluster, n_samples) of novel candidates, from links (src, dst) between their tags. A tag in
    several rows counts for the sample of the first by ``order``."""
    novel = enriched.where(F.lower(F.trim("category")) == "novel").groupBy(F.col("ct_tag").alias("node")).agg(F.min_by("sample", order).alias("sample"))
    tags = cluster_tags(connected_components(links, novel.select("node"))).join(novel, "node")
    samples = tags.groupBy("cluster").agg(F.countDistinct("sample").alias("n_samples"))
    return tags.join(samples, "cluster").select("node", "cluster", "n_samples")


def similar_links(hits: DataFrame, identity: float = 90.0, coverage: float = 80.0, evalue: float = 1e-10) -> DataFrame:
    """(src, dst) of hits between different sequences that are close enough."""
    near = (F.col("pident") >= identity) & (F.col("length") / F.least("qlen", "slen") * 100 >= coverage) & (F.col("evalue") <= evalue)
    return hits.where((F.col("qseqid") != F.col("sseqid")) & near).select(F.col("qseqid").alias("src"), F.col("sseqid").alias("dst")).distinct()


def tag_sequences(tags: DataFrame, records: DataFrame) -> DataFrame:
    """(ct_tag, seq): records of the tag's sample whose header holds its cycle id, first tag wins.

    Headers are cut into all their pieces of the lengths that the sample's cycle ids have, which are
    a few, and these are joined to the ids: tags and records of a sample aren't compared in pairs.
    """
    keyed = tags.select("sample", "ct_tag", "cycle_id")
    lengths = keyed.select("sample", F.length("cycle_id").alias("n_")).where("n_ is not null").distinct()
    cut = F.transform(F.sequence(F.lit(1), F.length("description") - F.col("n_") + 1), lambda i: F.substring("description", i, F.col("n_")))
    pieces = F.when(F.length("description") >= F.col("n_"), F.array_distinct(cut))
    rows = records.join(lengths, "sample").select("sample", "description", "seq", F.explode(pieces).alias("cycle_id"))
    met = rows.join(keyed, ["sample", "cycle_id"])
    return met.groupBy("sample", "description").agg(F.min_by(F.struct("ct_tag", "seq"), "ct_tag").alias("m")).select("m.*")


def merge_final(mapping: DataFrame, scores: DataFrame, samples: DataFrame) -> DataFrame:
    """Mapping rows of samples that have scores, with the score of their cycle where there is one."""
    return mapping.join(samples, "sample", "left_semi").join(scores, ["sample", "cycle"], "left")


def short_ids(long: DataFrame, pairs: DataFrame) -> DataFrame:
    """long (long_id) with short_id; ids without a pair are Unknown_SRR_n, numbered by their order."""
    last = pairs.groupBy("long_id").agg(F.max_by("short_id", "ord").alias("short_id"))
    out = long.join(last, "long_id", "left")
    lost = number_rows(out.where(F.col("short_id").isNull()).select("long_id").distinct(), ["long_id"], "n")
    return out.join(lost, "long_id", "left").select("long_id", F.coalesce("short_id", F.concat(F.lit("Unknown_SRR_"), F.col("n").cast("string"))).alias("short_id"))


def in_batches(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """df with ``batch``: rows in order, ``size`` to a batch."""
    return number_rows(df, order, "n_").withColumn("batch", F.floor((F.col("n_") - 1) / size)).drop("n_")


def molecule(records: DataFrame, of: Column | None = None) -> DataFrame:
    """(file, protein): whether any record of a file has characters that DNA has not. Where Spark wrote
    a folder of part files for what is one file elsewhere, ``of`` tells the whole that a row belongs to."""
    return records.groupBy((F.col("file") if of is None else of).alias("file")).agg(F.max(is_protein(F.col("seq"))).alias("protein"))


def concatenated(*frames: DataFrame) -> DataFrame:
    """All rows of frames whose columns may differ; missing ones are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def in_category_order(frames: dict[str, DataFrame], order: list[str]) -> DataFrame:
    """All rows with ``category`` (a frame's name) and ``nth``, their place by category in the order
    of the frames, then by ``order``."""
    parts = [f.withColumn("category", F.lit(name)).withColumn("turn_", F.lit(i)) for i, (name, f) in enumerate(frames.items())]
    return number_rows(concatenated(*parts), ["turn_", *order], "nth").drop("turn_")


def kmer_links(seqs: DataFrame, k: int, percent: float, order: str = "ord", seq: str = "seq") -> DataFrame:
    """(src, dst) of sequences that share enough k-mers, for clusters without an alignment table."""
    return containment_pairs(seqs, k, order, seq, least=percent).select(F.col("later").alias("src"), F.col("earlier").alias("dst"))


def sequence_links(seqs: DataFrame, identity: float = 90.0, coverage: float = 80.0, evalue: float = 1e-10, k: int = 11, order: str = "ord", seq: str = "seq") -> DataFrame:
    """(src, dst) of sequences that are close enough by alignments made here; they are what clusters need
    where no table of hits is given. Candidates share a twentieth of the k-mers that the identity and
    coverage leave on average."""
    shared = 100.0 * (identity / 100.0) ** k * coverage / 100.0 / 20.0
    return similar_links(align_all(seqs, k, shared, order, seq), identity, coverage, evalue)

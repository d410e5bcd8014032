"""Operators against independent sequential code on small inputs."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from transpark import catalog
from transpark.functions import sequences as S
from transpark.operators import enrich as E
from transpark.operators import graph as G
from transpark.operators import hits as H
from transpark.operators import intervals as I
from transpark.operators import reads as R
from transpark.operators import similarity as N

COMP = str.maketrans("ACGTacgt", "TGCAtgca")


def rc(s):
    return s[::-1].translate(COMP)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_scalar_functions(spark):
    L = F.lit
    assert one(spark, S.reverse_complement(L("AaCGt"))) == rc("AaCGt")
    with pytest.raises(Exception, match="not a DNA"):
        one(spark, S.reverse_complement(L("ACN")))
    assert one(spark, S.kmers(L("ACG"), 5)) == [] and one(spark, S.kmers(L("ACGA"), 3)) == ["ACG", "CGA"]
    assert one(spark, S.kmer_chunks(L("ACGTACG"), 3)) == ["ACG", "TAC"]
    assert one(spark, S.overlap_length(L("12M"))) == 12 and one(spark, S.overlap_length(L("*"))) is None
    assert one(spark, S.max_range_length(L("5-9;x;30-2;7"))) == 28 and one(spark, S.max_range_length(L(""))) == 0
    assert one(spark, S.candidate_tag(L(1234))) == "CT1234" and one(spark, S.candidate_tag(L(7))) == "CT007"
    assert one(spark, S.query_span(L("5S10M2I3D4="))) == 16 and one(spark, S.reference_span(L("5S10M2I3D4="))) == 17
    assert [tuple(x) for x in one(spark, S.supplementary(L("r,7,+,3S10M,60,1;q,1,-,4M2I,60,0;")))] == [("r", 7, 17), ("q", 1, 5)]
    assert tuple(one(spark, S.stranded(L(9), L(3)))) == (3, 9, -1)
    assert one(spark, S.safe_filename(L("a b/c" + "x" * 80))) == ("a_b_c" + "x" * 80)[:60]
    assert one(spark, S.cycle_of_summary(L("srr_summary_Cycle_12_split.fasta.txt"))) == "Cycle_12"
    assert one(spark, S.contig_kind(L("Cycle_1_2_3_transposon_1"))) == "transposon"


def test_rounding_is_that_of_the_exact_value(spark):
    rng = random.Random(9)
    some = [0.0, -0.0, 2.675, 0.0625, -0.0625, 1.005, 0.5, 1.5, 2.5, -2.5, 1e15 + 0.5, 1e300, -1e-300, 5e-324, 0.125, 4503599627370497.5, 123456789.0005]
    some += [rng.uniform(-1000, 1000) for _ in range(3000)] + [rng.randint(-(10**6), 10**6) / 10 ** rng.randint(1, 5) for _ in range(3000)] + [rng.randint(-99999, 99999) / 2 ** rng.randint(1, 12) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in some], "x double")
    for digits in (0, 1, 2, 3, 6):
        for r in df.select("x", S.exact_round(F.col("x"), digits).alias("r")).collect():
            assert r.r == round(r.x, digits), (r.x, digits, r.r)
    odd = spark.createDataFrame([("nan",), ("x",), (None,), ("1.25",)], "x string").select(S.number_or_zero(F.col("x"), 1).alias("r")).collect()
    assert str([r.r for r in odd]) == "[nan, 0.0, 0.0, 1.2]"


def test_occurrence_similarity_random(spark):
    rng = random.Random(4)
    pairs = [("".join(rng.choice("ACGT"[: rng.randint(1, 4)]) for _ in range(rng.randint(0, 30))), "".join(rng.choice("ACG") for _ in range(rng.randint(0, 30)))) for _ in range(300)]
    got = spark.createDataFrame(pairs, "one string, two string").select("one", "two", N.occurrence_similarity(F.col("one"), F.col("two"), 3).alias("p")).collect()
    for r in got:
        every = [r.two[i : i + 3] for i in range(len(r.two) - 2)]
        assert r.p == (100.0 * sum(x in r.one or x in rc(r.one) for x in every) / len(every) if every else None)


def merged(spans):
    out = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def test_intervals_random(spark):
    rng = random.Random(3)
    spans = [(k, s, s + rng.randint(0, 9)) for k in "ab" for s in [rng.randint(0, 80) for _ in range(25)]]
    other = [(k, s, s + rng.randint(0, 4)) for k in "ab" for s in [rng.randint(0, 80) for _ in range(6)]]
    df, od = (spark.createDataFrame(x, "k string, start int, end int") for x in (spans, other))
    got = {(r.k, r.start, r.end) for r in I.merge_intervals(df, ["k"]).collect()}
    assert got == {(k, *m) for k in "ab" for m in merged([x[1:] for x in spans if x[0] == k])}
    free = sorted(tuple(r) for r in I.without_overlap(df, od, ["k"]).collect())
    assert free == sorted(x for x in spans if not any(y[0] == x[0] and not (x[2] < y[1] or x[1] > y[2]) for y in other))
    depth = {(r.k, p): r.depth for r in I.depth_runs(df, ["k"]).collect() for p in range(r.start, r.end)}
    want = {}
    for k, s, e in spans:
        for p in range(s, e):
            want[k, p] = want.get((k, p), 0) + 1
    assert depth == want
    kept = sorted(tuple(r) for r in I.greedy_filter(df, ["k"], ["start"], 0.5).select("k", "start", "end").collect())
    slow = []
    for x in sorted(spans):
        clash = [y for y in slow if y[0] == x[0] and max(0, min(x[2], y[2]) - max(x[1], y[1]) + 1) / min(x[2] - x[1] + 1, y[2] - y[1] + 1) > 0.5]
        if not clash:
            slow.append(x)
    assert kept == sorted(slow)
    assert I.merge_intervals(df.limit(0), ["k"]).count() == 0


def test_best_hit_ties_and_filters(spark):
    cols = "qseqid string, sseqid string, pident double, length int, slen int, qstart int, qend int, evalue double, ord int"
    rows = [("q", "late", 90.0, 50, 50, 9, 2, 0.0, 2), ("q", "early", 90.0, 50, 50, 1, 5, 0.0, 1), ("q", "low", 79.0, 50, 50, 1, 5, 0.0, 0), ("p", "edge", 100.0, 25, 50, 1, 2, 0.0, 0)]
    got = H.best_hits(spark.createDataFrame(rows, cols), ["ord"]).collect()
    assert [(r.qseqid, r.sseqid, r.start, r.end, r.strand) for r in got] == [("q", "early", 1, 5, 1)]


def greedy(n, conflicts):
    kept = []
    for i in range(n):
        if not any((i, j) in conflicts for j in kept):
            kept.append(i)
    return kept


def test_greedy_resolution_random(spark):
    rng = random.Random(5)
    for n in (1, 8, 14):
        conflicts = {(i, j) for i in range(n) for j in range(i) if rng.random() < 0.25}
        items = spark.range(n).withColumnRenamed("id", "ord")
        pairs = spark.createDataFrame(sorted(conflicts), "later long, earlier long") if conflicts else spark.createDataFrame([], "later long, earlier long")
        assert sorted(r.ord for r in N.resolve_greedy(items, pairs).collect()) == greedy(n, conflicts)


def kset(s, k):
    return {s[i : i + k] for i in range(len(s) - k + 1)}


def test_kmer_dedupe_random(spark):
    rng = random.Random(7)
    base = "".join(rng.choice("ACGT") for _ in range(60))
    seqs = []
    for _ in range(14):
        s = list(base[rng.randint(0, 20) :])
        for _ in range(rng.randint(0, 3)):
            s[rng.randrange(len(s))] = rng.choice("ACGT")
        s = "".join(s)
        seqs.append(rc(s) if rng.random() < 0.4 else s)
    seqs += ["ACG", "ACG", seqs[2]]
    kept = []
    for i, s in enumerate(seqs):
        own = kset(s, 6)
        if not any(own and 100 * len(own & (kset(seqs[j], 6) | kset(rc(seqs[j]), 6))) / len(own) >= 70 for j in kept):
            kept.append(i)
    df = spark.createDataFrame(list(enumerate(seqs)), "ord long, seq string")
    assert sorted(r.ord for r in N.kmer_dedupe(df, 6, 70.0).collect()) == kept


def test_sketches_find_what_sets_find(spark):
    """Recall against exact pairs, for long sequences by sketches and for short ones by whole sets."""
    rng = random.Random(13)
    seqs = []
    for length in (3000, 3000, 2000, 60, 40):
        base = "".join(rng.choice("ACGT") for _ in range(length))
        for _ in range(12):
            s = list(base[: rng.randint(length // 2, length)])
            for _ in range(rng.randint(0, length // 60)):
                s[rng.randrange(len(s))] = rng.choice("ACGT")
            seqs.append("".join(s) if rng.random() < 0.6 else rc("".join(s)))
    rng.shuffle(seqs)
    df = spark.createDataFrame([*enumerate(seqs), (100, "ACG"), (101, None)], "ord long, seq string")
    exact = {tuple(r) for r in N.containment_pairs(df, 11, least=70.0).collect()}
    found = {tuple(r) for r in N.sketched_pairs(df, 11, 70.0).collect()}
    assert found <= exact and len(found) >= 0.97 * len(exact) and len(exact) > 100
    short = {i for i, s in enumerate(seqs) if len(s) < 100}
    assert {x for x in exact if x[0] in short} <= found
    assert N.sketched_pairs(df.limit(0), 11, 70.0).count() == 0


def flip(n):
    return n.translate(str.maketrans("+-", "-+"))


def test_graph_random(spark):
    rng = random.Random(11)
    links = [(g, i, f"c{rng.randint(0, 3)}{rng.choice('+-')}", f"c{rng.randint(0, 3)}{rng.choice('+-')}", "2M") for g in range(4) for i in range(5)]
    edges = G.double_strands(spark.createDataFrame(links, "g int, ord int, src string, dst string, overlap string"), ["g"], ["ord"])
    want = set()
    for g, _, a, b, _o in links:
        want |= {(g, a, b), (g, flip(b), flip(a))}
    assert sorted((r.g, r.src, r.dst) for r in edges.collect()) == sorted(want)
    cycles, hairpins = set(), set()
    for g in range(4):
        own = {(a, b) for x, a, b in want if x == g}
        nodes = sorted({n for e in own for n in e})
        for k in (1, 2, 3, 4):
            for p in itertools.permutations(nodes, k):
                if all(e in own for e in zip(p, p[1:])):
                    if p[0] == min(p) and (p[-1], p[0]) in own:
                        cycles.add((g, p))
                    if (p[-1], flip(p[0])) in own:
                        hairpins.add((g, p))
    assert {(r.g, tuple(r.path)) for r in G.simple_cycles(edges, ["g"], 4).collect()} == cycles
    assert {(r.g, tuple(r.path)) for r in G.hairpin_paths(edges, ["g"], 4).collect()} == hairpins
    numbered = edges.withColumn("ord", F.row_number().over(catalog.Window.partitionBy("g").orderBy("ord", "turn"))).select("g", "src", "dst", "ord")
    found = G.dfs_cycles(numbered, ["g"], 8).collect()
    spin = lambda p: tuple(p[p.index(min(p)) :] + p[: p.index(min(p))])
    assert found and all((r.g, spin(r.path)) in cycles for r in found if not r.hairpin and len(r.path) <= 4)
    again = G.dfs_cycles(numbered, ["g"], 8, repeat_pairs=True).collect()
    assert len(again) >= len(found) and {tuple(r.path) for r in again} == {tuple(r.path) for r in found}
    # A search that leaves a node early comes upon other pairs, but each path is simple and closes.
    for r in G.dfs_cycles(numbered, ["g"], 8, one_back_edge=True).collect():
        close = (r.path[-1], flip(r.path[0]) if r.hairpin else r.path[0])
        assert len(set(r.path)) == len(r.path) and all((r.g, *e) in want for e in [*zip(r.path, r.path[1:]), close])
    single = G.dfs_cycles(numbered, ["g"], 8, all_paths=False).collect()
    assert {(r.g, tuple(r.path)) for r in single} <= {(r.g, tuple(r.path)) for r in found}


def test_path_sequence_and_rotation(spark):
    nodes = spark.createDataFrame([(1, "a+", "ACGTT"), (1, "b+", "TTGG"), (1, "c+", "GGA")], "g int, node string, seq string")
    edges = spark.createDataFrame([(1, "a+", "b+", "2M"), (1, "b+", "c+", "*"), (1, "b+", "a+", "1M")], "g int, src string, dst string, overlap string")
    paths = spark.createDataFrame([(1, "x", ["a+", "b+"]), (1, "y", ["b+", "c+"]), (1, "z", ["b+"])], "g int, path_id string, path array<string>")
    assert {(r.path_id, r.sequence) for r in G.path_sequences(paths, nodes, edges, ["g"]).collect()} == {("x", "ACGTTGG"), ("z", "TTGG")}
    seqs = ["ACGTTT", "GTTTAC", rc("TTACGT"), "ACGTTA", "ACG"]
    got = {tuple(r) for r in G.rotation_pairs(spark.createDataFrame(list(enumerate(seqs)), "ord int, seq string")).collect()}
    want = {(i, j) for i in range(5) for j in range(i) if len(seqs[i]) == len(seqs[j]) and (seqs[j] in seqs[i] * 2 or seqs[j] in rc(seqs[i]) * 2)}
    assert got == want


def test_rotation_classes(spark):
    """Rotations of one sequence on both strands are one class however many there are; periodic ones too."""
    rng = random.Random(2)
    base = "".join(rng.choice("ACGT") for _ in range(400))
    seqs = [(base[i % 400 :] + base[: i % 400]) if i % 2 else rc(base[i % 400 :] + base[: i % 400]) for i in range(10_000)]
    seqs += ["ACAC", "CACA", "GTGT", "ACGACG", "A" * 50, "T" * 50, "", None, "ACCA"]
    got = {r.ord: (r.first, r.members) for r in G.rotation_classes(spark.createDataFrame(list(enumerate(seqs)), "ord long, seq string")).collect()}
    assert {got[i] for i in range(10_000)} == {(0, 10_000)}
    assert [got.get(10_000 + i) for i in range(9)] == [(10_000, 3)] * 3 + [(10_003, 1)] + [(10_004, 2)] * 2 + [None, None, (10_008, 1)]


def test_enrichment(spark):
    names = [("ISFinder_IS26-MH257753",), ("IS10",), ("ISEcp1",), ("ISCR9",), ("IS4321",), ("Tn3",), ("nothing",), ("  ",)]
    got = [(r.is_group, r.is_family) for r in E.element_family(spark.createDataFrame(names, "n string").coalesce(1), "n").collect()]
    assert got == [("IS6", "IS26"), ("IS4", "IS10"), ("IS1380", "ISEcp"), ("Unknown", "Unknown"), ("IS4321", "IS4321"), ("Composite", "Composite"), ("Unknown", "Unknown"), ("Unknown", "Unknown")]
    taxonomy = spark.createDataFrame([("IS26", "X", "Y")], "name string, is_group string, is_family string")
    first = E.element_family(spark.createDataFrame(names[:1], "n string"), "n", taxonomy).first()
    assert (first.is_group, first.is_family) == ("X", "Y")
    rows = [(1, 1000, "10-20;500-600", ""), (2, 1000, "10-20", "30-90"), (3, 1000, "400-500", "10-20;600-700"), (4, 1000, "900-990", "20-60"), (5, 1000, "", "1-2")]
    out = {r.id: (r.t_start, r.t_end, r.c_start, r.c_end) for r in E.split_boundaries(spark.createDataFrame(rows, "id int, length int, i string, g string"), "length", "i", "g").collect()}
    assert out == {1: (10, 600, 601, 1000), 2: (10, 20, 21, 90), 3: (400, 500, None, None), 4: (900, 990, 20, 899)}


def test_reads(spark):
    t = R.Tolerances()
    rows = [(-301, None, None, None, None, False), (-300, None, None, None, None, True), (900, None, None, None, None, True), (1001, None, None, None, None, False), (5001, 5001, 9, 0, None, False), (1100, 1000, 9, 0, None, True), (1300, 1000, 8, 2, None, True), (1300, 1000, 9, 2, None, False), (700, 1000, 9, 0, 100, True), (700, 2000, 9, 0, None, True)]
    df = spark.createDataFrame(rows, "gap int, mode int, n int, l int, back int, want boolean")
    assert all(r.got == r.want for r in df.withColumn("got", R.adjacent(F.col("gap"), F.col("mode"), F.col("n"), F.col("l"), F.col("back"), t)).collect())
    blocks = [("r", 0, 10, "transposon"), ("r", 20, 30, "cargo"), ("r", 40, 50, "transposon"), ("s", 0, 900, "cargo"), ("s", 100, 1000, "transposon")]
    b = spark.createDataFrame(blocks, "read string, q_start int, q_end int, annot string")
    assert {(r.read, r.pattern, r.start, r.end) for r in R.pattern_windows(b, "read", ["q_start"]).collect()} == {("r", "TC", 0, 30), ("r", "CT", 20, 50), ("r", "TCT", 0, 50)}
    assert [tuple(r) for r in R.insertions(R.block_gaps(b, "read", ["q_start"]), "read").collect()] == [("s", "cargo-inserted-transposon", 1)]


@pytest.mark.parametrize("name", ["rank_candidates", "merged_best_subject", "overlap_anti_join", "gap_statistics", "components", "class_expansion", "boundary_split", "block_merge"])
def test_queries_against_sql(spark, name):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in catalog.TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    got = catalog.queries()[name](spark, sf)
    cur = con.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(got.columns)
    show = lambda rows: sorted(repr([round(float(v), 6) if isinstance(v, float) else v for v in r]) for r in rows)
    assert show(tuple(r) for r in got.select(*[f"`{n}`" for n in names]).collect()) == show(cur.fetchall())


def test_path_queries_have_no_lowered_limit(spark):
    sf = "/root/testdata/sf0.001"
    after = {}
    for r in catalog.queries()["strand_doubled_edges"](spark, sf).collect():
        after.setdefault(r.graph_id, {}).setdefault(r.src, set()).add(r.dst)
    cycles, hairpins = set(), set()

    def walk(g, own, path):
        nexts = own.get(path[-1], ())
        if path[0] in nexts and path[0] == min(path):
            cycles.add((g, ",".join(path)))
        if flip(path[0]) in nexts:
            hairpins.add((g, ",".join(path)))
        for n in nexts:
            if n not in path:
                walk(g, own, [*path, n])

    for g, own in after.items():
        for n in own:
            walk(g, own, [n])
    long = {x for x in cycles if x[1].count(",") > 4}
    found = lambda name: {(r.graph_id, r.path) for r in catalog.queries()[name](spark, sf).collect()}
    assert long and found("simple_cycles") == cycles and found("hairpin_paths") == hairpins
    assert any(path.count(",") > 4 for _, path in found("dfs_cycles"))


def test_scores_a_bit_apart_rank_as_in_sql(spark):
    """Hits of 50.4 and the next double have the same power in SQL, so that the order decides."""
    import math

    from transpark.operators import hits as H

    rows = [(1, 0, 50.4), (2, 0, math.nextafter(50.4, 51))]
    zero, none = F.lit(0.0), F.lit(0)
    scored = spark.createDataFrame(rows, "ord int, sample int, hit double").withColumn("s", H.composite_score(F.col("hit"), zero, zero, none, none, none, F.lit(1000), F.lit(4), 0))
    assert {r.ord: r.rank for r in H.rank_candidates(scored, ["sample"], "s", ["ord"], 20.0).collect()} == {1: 1, 2: 2}
    got = spark.createDataFrame([(0.0, -1.0), (10.0, 400.0), (None, 1.0), (2.0, 0.5)], "b double, e double").select(H.power(F.col("b"), F.col("e")).alias("p"))
    assert [r.p for r in got.collect()] == [math.inf, math.inf, None, math.pow(2.0, 0.5)]


def test_pairs_by_classes_are_all_there(spark):
    """A frequent passage that is most of short sequences: no pair is lost, inverted repeats count."""
    from transpark.operators import similarity as N

    rng = random.Random(3)
    some = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    passage = some(60)
    rows = [(i, passage + some(rng.choice([5, 20, 30, 200]))) for i in range(60)]
    half = some(40)
    rows += [(60, half + S_rc(half)), (61, half), (62, some(300)), (63, half + S_rc(half) + some(30))]
    sets = {i: {s[j : j + 11] for j in range(len(s) - 10)} for i, s in rows}
    both = {i: x | {S_rc(k) for k in x} for i, x in sets.items()}
    for strands, other in ((True, both), (False, sets)):
        want = {(a, b, len(sets[a] & other[b]), len(sets[a])) for a in sets for b in sets if b < a and len(sets[a] & other[b]) * 100 >= 70 * len(sets[a])}
        for kind in ("long", "string"):
            df = spark.createDataFrame([(str(i).zfill(3) if kind == "string" else i, s) for i, s in rows], f"ord {kind}, seq string")
            for pairs in (N.sketched_pairs, N.containment_pairs):
                got = pairs(df, 11, least=70.0, both_strands=strands).collect()
                assert {(int(r.later), int(r.earlier), r.shared, r.size) for r in got} == want and len(got) == len(want)


def S_rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def test_small_graphs_are_walked_in_place_as_large_ones_by_joins(spark, monkeypatch):
    rng = random.Random(5)
    nodes = [f"n{i}{x}" for i in range(4) for x in "+-"]
    edges = spark.createDataFrame([(g, rng.choice(nodes), rng.choice(nodes)) for g in range(12) for _ in range(6 + 3 * (g % 3))], "g int, src string, dst string")
    for find in (G.simple_cycles, G.hairpin_paths):
        got = []
        for small in (1000, 10, 0):
            monkeypatch.setattr(G, "SMALL", small)
            got.append(sorted((r.g, ",".join(r.path)) for r in find(edges, ["g"], 5).collect()))
        assert got[0] and got[0] == got[1] == got[2]
    # Paths of all lengths come from one row a graph: no job for each length.
    monkeypatch.setattr(G, "_walks", None)
    monkeypatch.setattr(G, "SMALL", 256)
    assert G.simple_cycles(edges, ["g"], 5).count()


def test_depth_first_search_is_that_of_plain_recursion(spark):
    """All variants, path for path in order, on random graphs with ends that lead nowhere."""
    rng = random.Random(21)
    rows = [(g, i, f"c{rng.randint(0, 4)}{rng.choice('+-')}", f"c{rng.randint(0, 5)}{rng.choice('+-')}") for g in range(60) for i in range(rng.randint(1, 14))]

    def plain(links, limit, all_paths, repeat_pairs, one_back_edge):
        near, found, tried, done, seen = {}, [], set(), set(), set()
        for a, b in links:
            near.setdefault(a, []).append(b)

        def paths(path, dst):
            if len(path) < limit:
                for x in near.get(path[-1], []):
                    if x == dst:
                        yield [*path, x]
                    elif x not in path:
                        yield from paths([*path, x], dst)

        def first(path, dst):
            seen.add(path[-1])
            if path[-1] == dst:
                return path
            return next((p for x in near.get(path[-1], []) if x not in seen and (p := first([*path, x], dst))), None)

        def visit(node, on):
            for to in near.get(node, []):
                turned = to if to in on else flip(to)
                if turned in on:
                    if repeat_pairs or (turned, node) not in tried:
                        tried.add((turned, node))
                        seen.clear()
                        every = [[turned]] if turned == node else list(paths([turned], node)) if all_paths else [p for p in [first([turned], node)] if p]
                        found.extend((p, turned != to) for p in every)
                    if one_back_edge:
                        break
                elif to not in done:
                    visit(to, [*on, to])
            done.add(node)

        for root in list(near):
            visit(root, [root])
        return found

    df = spark.createDataFrame(rows, "g int, ord int, src string, dst string")
    for limit, *how in ((25, True, False, False), (3, True, True, False), (6, True, False, True), (25, False, False, False)):
        got = {}
        for r in sorted(G.dfs_cycles(df, ["g"], limit, *how).collect(), key=lambda r: (r.g, r.ord)):
            got.setdefault(r.g, []).append((r.path, r.hairpin))
        want = {g: x for g in range(60) if (x := plain([r[2:] for r in rows if r[0] == g], limit, *how))}
        assert got == want

"""Trees as intervals and in blocks of tokens, alignments in blocks, and similarity joins, against plain loops."""

import random
import re
import time

from pyspark.sql import functions as F

from genomill.operators import intervals, sequences, similarity
from genomill.sources import formats


def random_tree(n, seed, star=False):
    """Parents of nodes 1 to n; node 1 is the root, and every node's children are few (or, as a star, many of one)."""
    rng = random.Random(seed)
    return {v: None if v == 1 else 1 if star and rng.random() < 0.8 else rng.randint(max(1, v - 12), v - 1) for v in range(1, n + 1)}


def ancestors(parent, v):
    out = [v]
    while parent[out[-1]] is not None:
        out.append(parent[out[-1]])
    return out


def test_tour_and_common_ancestors(spark):
    parents = [random_tree(160, 1), {v + 1000: p and p + 1000 for v, p in random_tree(40, 2, star=True).items()}, {5000: None}]
    parent = {v: p for tree in parents for v, p in tree.items()}
    inner = {p for p in parent.values() if p}
    nodes = spark.createDataFrame([(v, p, f"n{v}", v not in inner) for v, p in parent.items()], "branch_id int, parent_branch_id int, branch_name string, is_tip boolean")
    tour = intervals.euler_tour(nodes)
    minima = intervals.range_minima(tour)
    above = {v: ancestors(parent, v) for v in parent}
    got = {r.node: r for r in tour.collect()}
    for v in parent:
        below = [u for u in parent if v in above[u]]
        assert {u for u in parent if got[v].pre <= got[u].pre <= got[v]["last"]} == set(below)
        assert got[v].depth == len(above[v]) - 1 and got[v].n_leaves == sum(u not in inner for u in below)
    sets = {k: random.Random(k).sample(sorted(parent), 1 + k % 5) for k in range(60)}
    sets[99] = [1, 5000]

    def mrca(vs):
        common = set.intersection(*[set(above[v]) for v in vs])
        return max(common, key=lambda v: len(above[v])) if common else None

    found = intervals.common_ancestors(spark.createDataFrame([(k, v) for k, vs in sets.items() for v in [*vs, vs[0]]], "k int, node int"), tour, minima, "k")
    assert {r.k: (r.n_members, r.mrca) for r in found.collect()} == {k: (len(set(vs)), mrca(vs)) for k, vs in sets.items() if mrca(vs)}
    tips = sorted(v for v in parent if v not in inner)
    want = {(a, b): len(above[a]) + len(above[b]) - 2 * len(above[mrca([a, b])]) for a in tips for b in tips if a < b and mrca([a, b])}
    assert {(r.tip_1, r.tip_2): r.distance for r in intervals.tip_distances(nodes, tour, minima).collect()} == want
    inside = {(r.node, r.top) for r in intervals.inside_of(tour, spark.createDataFrame([(3,), (1001,)], "node int")).collect()}
    assert inside == {(v, t) for t in (3, 1001) for v in parent if t in above[v]}


def test_trees_in_blocks_of_tokens(spark):
    rng = random.Random(3)

    def newick(depth):
        if depth == 0 or rng.random() < 0.2:
            return f"t{rng.randint(0, 99)}:{rng.randint(1, 9)}"
        return "(" + ",".join(newick(depth - 1) for _ in range(rng.randint(2, 4))) + ")" + rng.choice(["", f"i{rng.randint(0, 9)}", ":0.5"])

    deep = "(" * 150 + "a" + "".join(f",b{i})" for i in range(150)) + ";"
    trees = spark.createDataFrame([("x", newick(5) + ";"), ("y", newick(4) + ";"), ("deep", deep), ("star", "(" + ",".join("abcdefgh" * 20) + ");"), ("one", "tip;"), ("none", None)], "tree string, newick string")
    whole, small = (sorted(map(tuple, formats.read_trees(trees, b).collect()), key=lambda r: r[:2]) for b in (100_000, 7))
    assert whole == small and len([r for r in whole if r[0] == "deep"]) == 301
    by_id = {r[1]: r for r in whole if r[0] == "deep"}
    assert all(by_id[i][2] == (i - 1 if i else None) for i in range(150)) and by_id[150][3] == "a" and by_id[150][2] == 149 and by_id[300][2] == 0
    star = [r for r in whole if r[0] == "star"]
    assert len(star) == 161 and all(r[2] == 0 for r in star if r[1])


def test_alignments_in_blocks(spark):
    rng = random.Random(5)
    rows = [(f, g, "".join(rng.choice("AAAAAC-é") for _ in range(rng.choice([0, 1, 63, 64, 65, 200])))) for f in range(4) for g in range(5) if (f + g) % 3]
    rows.append((7, 1, "AAAA"))
    df = spark.createDataFrame(rows, "family int, genome int, seq string")
    width = {f: max(len(s) for x, _, s in rows if x == f) for f in {r[0] for r in rows}}
    seq = {(f, g): s for f, g, s in rows}
    genomes = spark.createDataFrame([(g,) for g in range(6)], "genome int")
    want = {g: "".join(seq.get((f, g), "").ljust(w, "-") for f, w in sorted(width.items())) for g in range(6)}
    assert {r.genome: r.seq for r in sequences.concat_alignments(df, genomes).collect()} == want
    mixed = {f: [i for i in range(w) if len({s[i] for (x, _), s in seq.items() if x == f and i < len(s)}) > 1] for f, w in width.items()}
    want = {(f, g): kept for (f, g), s in seq.items() if (kept := "".join(s[i] for i in mixed[f] if i < len(s)))}
    assert {(r.family, r.genome): r.seq for r in sequences.variable_sites(df).collect()} == want


def texts_of_families():
    """Groups of texts about the threshold, some far from their group's first, and copies."""
    rng = random.Random(8)
    out = []
    for g in range(12):
        base = [f"w{rng.randint(0, 3000)}" for _ in range(90)]
        for i in range(14):
            base = list(base) if i % 5 else list(base)
            for _ in range(rng.randint(0, 4)):  # changes add up, so that the last is unlike the first
                base[rng.randrange(90)] = f"e{rng.randint(0, 10**6)}"
            out.append(" ".join(base))
    return list(enumerate(out + out[:9] + ["", "", "short text", "two words", None]))


def jaccards(rows, k):
    sets = {i: {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} for i, t in rows if t is not None for w in [t.split(" ")]}
    return {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b and sets[a] & sets[b]}


def test_families_are_the_components_of_all_links(spark):
    rows = texts_of_families()
    family = {i: i for i, _ in rows}
    links = [pair for pair, s in jaccards(rows, 5).items() if s >= 0.75]
    for _ in rows:
        for a, b in links:
            family[a] = family[b] = min(family[a], family[b])
    got = {r.id: r.family for r in similarity.similarity_families(spark.createDataFrame(rows, "id int, text string"), 5, 0.75).collect()}
    assert got == family and len(set(family.values())) > 12


def test_prefixes_lose_no_similar_sketch(spark):
    df = spark.createDataFrame(texts_of_families(), "id int, text string")
    every = {(r.id_1, r.id_2): r for r in similarity.sketch_distances(df, 5, 40).collect()}
    for least in (0.3, 0.5, 0.8):
        assert {(r.id_1, r.id_2): r for r in similarity.sketch_distances(df, 5, 40, least).collect()} == {k: r for k, r in every.items() if r.jaccard >= least}
    own = similarity.sketches(df, 5, 40)
    assert similarity._prefixes(own, 0.8).count() < similarity._prefixes(own, 0.0).count() / 2


def test_pools_and_distances_of_many_tips(spark):
    """Links to the nearest tip make the pools that all near pairs make; blocks of any size give the same distances."""
    from genomill.operators import mapping, trees

    parent = random_tree(130, 11) | {v + 1000: p and p + 1000 for v, p in random_tree(60, 12, star=True).items()} | {5000: None}
    inner = {p for p in parent.values() if p}
    nodes = spark.createDataFrame([(v, p, f"n{v}", v not in inner) for v, p in parent.items()], "branch_id int, parent_branch_id int, branch_name string, is_tip boolean")
    tour = intervals.euler_tour(nodes)
    minima = intervals.range_minima(tour)
    distances = intervals.tip_distances(nodes, tour, minima).cache()
    assert sorted(intervals.tip_distances(nodes, tour, minima, 7).collect()) == sorted(distances.collect())
    for most in (2, 3, 5):
        assert sorted(mapping.pools(trees.near_tips(nodes, most)).collect()) == sorted(mapping.pool_populations(distances, most).collect())
    # the plan of the pools lists no pairs of tips, and each task of the catalogue has its share of the recipients
    assert trees.near_tips(nodes, 2).count() < len(parent)
    catalogue = trees.event_catalogue(nodes, 20)
    assert catalogue.count() == len(parent) ** 2 + 4 * len(parent) + 1
    assert catalogue.where("event_type = 'T'").select(F.spark_partition_id()).distinct().count() > 1


def test_pairs_of_lineages_are_summed_where_they_meet(spark):
    """Meetings are dealt by lineage and in many tasks: a sum over pairs needs no exchange of rows of pairs."""
    from genomill.operators import coevolution as co
    from genomill.operators.trees import settle

    rng = random.Random(4)
    rows = [(e, l, rng.randint(1, 100), l % 3) for e in range(40) for l in rng.sample(range(60), rng.choice([1, 5, 30]))]
    side = settle(spark.createDataFrame(rows, "event_id long, rlocds_id long, freq long, gene_family_id int"))
    sizes = settle(side.groupBy("event_id").count().withColumnRenamed("count", "_n"))
    want = sorted((a[1], b[1], a[0], a[2], b[2]) for a in rows for b in rows if a[0] == b[0] and a[1] <= b[1] and a[3] != b[3])
    kept = co.MEETINGS_A_TASK
    try:
        co.MEETINGS_A_TASK = 500
        for block in (2000, 7):
            met = co._met(side, sizes, "between_fams", block)
            assert sorted(map(tuple, met.collect())) == want and met.rdd.getNumPartitions() > 4
            summed = met.groupBy("rlocds_id_1", "rlocds_id_2").count()
            assert "rlocds_id_2" not in "".join(x for x in summed._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning" in x)
    finally:
        co.MEETINGS_A_TASK = kept


def test_copies_meet_as_one_sketch(spark, monkeypatch):
    """Ids of one text are one set when pairs are sought, and pairs of their own in the result."""
    seen, kept = [], similarity._prefixes
    monkeypatch.setattr(similarity, "_prefixes", lambda own, least: seen.append(own.count()) or kept(own, least))
    texts = ["a b c d e f g h", "a b c d e f g i", "x y z"]
    rows = [(10 * i + j, t) for i, t in enumerate(texts) for j in range(4)]
    got = {(r.id_1, r.id_2): r.jaccard for r in similarity.sketch_distances(spark.createDataFrame(rows, "id int, text string"), 5, 40, 0.5).collect()}
    want = {(a, b): 1.0 if s == t else 0.6 for a, s in rows for b, t in rows if a < b and (s == t or "x" not in s + t)}
    assert got == want and seen == [3]


def test_terms_meet_families_as_arrays(spark):
    """Terms of a protein named twice, a family of two proteins, proteins without terms; lines are made once for each set of domains."""
    from genomill.operators import annotation, counting

    genes = spark.createDataFrame([("g", 1, 11, "a"), ("g", 1, 12, "b"), ("h", 1, 11, "c"), ("h", 2, 13, "d"), ("g", 2, 14, "e")], "genome string, gene_family_id int, nr_protein_id int, cds_code string")
    terms = spark.createDataFrame([(11, "s"), (11, "t"), (11, "s"), (12, "t"), (13, "u"), (13, "u")], "nr_protein_id int, go_id string")
    clades = spark.createDataFrame([(7, "g", "clade"), (7, "h", "clade")], "clade int, genome string, side string")
    pan = [tuple(r) for r in annotation.pan_background(genes, terms, clades).collect()]
    assert sorted(pan, key=str) == sorted([(c, f, t) for c in (None, 7) for f, t in ((1, "s"), (1, "t"), (2, "u"), (2, None))], key=str)
    core = annotation.clade_core_background(genes, terms, clades)
    assert core.collect() == [] and annotation.clade_core_background(genes.where("cds_code <> 'b' AND cds_code <> 'c' OR cds_code = 'x'"), terms, clades.where("genome = 'g'")).where("gene_family_id = 1").count() == 2
    domains = spark.createDataFrame([(i, d) for i in range(50) for d in ("p", "q")] + [(99, "r"), (98, "p")], "nr_protein_id int, interpro_id string")
    named = spark.createDataFrame([("p", "one"), ("q", "two"), ("q", "one"), ("q", None)], "interpro_id string, go_id string")
    lines = counting.annotation_lines(domains, named)
    assert {tuple(r) for r in lines.collect()} == {(i, "one|two") for i in range(50)} | {(98, "one")}
    # no table of a protein's or a family's terms is made distinct or collected row by row
    keys = lambda df: re.findall(r"Aggregate \[([^\]]*)\]", df._jdf.queryExecution().optimizedPlan().toString())
    assert not any("nr_protein_id" in k for k in keys(lines))
    assert not any("go_id" in k for df in (annotation.pan_background(genes, terms, clades), core) for k in keys(df))


def test_small_trees_are_read_inside_their_rows(spark, monkeypatch):
    """Trees of few tokens are written once as texts and never shuffled; broken texts and large trees give the same nodes either way."""
    texts = {"a": "(x:1,(y:2,z)I:0.5)R;", "b": "tip;", "c": "((a,b),(c,d)", "d": "a)(b)", "e": "", "f": None, "g": " ( a b :1 , c )lab el:2 ; (d,e);", "h": "(,);", "j": "((((a))));", "m": "a,b;", "o": "(a)b)c(d)"}
    trees = spark.createDataFrame(list(texts.items()), "tree string, newick string")
    inside = formats.read_trees(trees.where("tree IN ('a', 'b', 'j')"))
    assert "Exchange" not in inside._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, inside.where("tree = 'a'").collect()), key=lambda r: r[1]) == [("a", 0, None, "R", None, False), ("a", 1, 0, "x", 1.0, True), ("a", 2, 0, "I", 0.5, False), ("a", 3, 2, "y", 2.0, True), ("a", 4, 2, "z", None, True)]
    got = sorted(map(tuple, formats.read_trees(trees).collect()), key=str)
    monkeypatch.setattr(formats, "SMALL_TREE", 0)
    assert sorted(map(tuple, formats.read_trees(trees).collect()), key=str) == got


def test_partners_travel_as_one_number(spark):
    """Where ids and frequencies are integers a lineage's partners are one array of 4 bytes each (8 for far ids); other types travel as they are."""
    from genomill.operators import coevolution as co

    rng = random.Random(6)
    ids = [-40, -3, 0, 5, 70, 2**20, 2**20 + 1]
    for kind, scale, wide in (("long", 1, "array<int>"), ("long", 2**24, "array<bigint>"), ("long", 2**40, None), ("string", 1, None)):
        rows = [(e, f"n{i:09d}" if kind == "string" else i * scale, rng.randint(0, 100), i % 3) for e in range(8) for i in rng.sample(ids, 4)]
        side = spark.createDataFrame(rows, f"event_id long, rlocds_id {kind}, freq long, gene_family_id int")
        met = co.lineage_matches(side.drop("gene_family_id"), None, "all")
        assert sorted(map(tuple, met.collect())) == sorted((a[1], b[1], a[0], a[2], b[2]) for a in rows for b in rows if a[0] == b[0] and a[1] <= b[1])
        assert {"rlocds_id_1": kind.replace("long", "bigint"), "freq_2": "bigint"}.items() <= dict(met.dtypes).items()
        packing = co._packing(side)
        assert (packing and f"array<{packing[1]}>") == wide


def test_settled_tables_leave_no_shuffle_files(spark):
    """Shuffle files go when the write that needed them ends; the session's own setting stays."""
    from pathlib import Path

    from genomill.operators.trees import settle

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    held = lambda: {p.name for f in folders for p in Path(f).rglob("shuffle_*.data")}
    before, kept = held(), spark.conf.get(key, None)
    settled = settle(spark.range(1000).repartition(7, "id"))
    for _ in range(50):  # executors are told, not waited for
        if held() <= before:
            break
        time.sleep(0.1)
    assert held() <= before and spark.conf.get(key, None) == kept
    assert settled.count() == 1000


def test_hashes_of_one_set_meet_nothing(spark):
    """Hashes that one set alone holds take no row; ids of several texts, empty texts and null ids give the distances of plain sets."""
    sets = spark.createDataFrame([(1, [1, 2, 3, 9]), (2, [1, 4, 5, 9]), (3, [6, 7])], "id int, sketch array<long>")
    assert sorted(map(tuple, similarity._prefixes(sets, 0.5).collect())) == [(1, 4, 1), (2, 4, 1)]
    assert sorted(map(tuple, similarity._prefixes(sets, 0.0).collect())) == [(1, 4, 1), (1, 4, 9), (2, 4, 1), (2, 4, 9)]
    single = similarity.sketches(spark.createDataFrame([(i, f"a b {i} c d") for i in range(20)], "id int, text string"), 2, 5)
    assert "Exchange" not in single._jdf.queryExecution().executedPlan().toString()
    rows = [(i % 9 if i % 5 else i, f"t{i % 4} u v w x{i % 3} y z {'q' * (i % 2)}") for i in range(40)] + [(3, ""), (50, ""), (51, ""), (52, None), (None, "u v w x")]
    words = {}
    for i, t in rows:
        if i is not None and t is not None:
            w = t.split(" ")
            words.setdefault(i, set()).update(tuple(w[j : j + 3]) for j in range(max(1, len(w) - 2)))
    want = {(a, b): len(words[a] & words[b]) / len(words[a] | words[b]) for a in words for b in words if a < b and words[a] & words[b]}
    df = spark.createDataFrame(rows, "id int, text string")
    for least in (0.0, 0.4):
        got = {(r.id_1, r.id_2): r.jaccard for r in similarity.sketch_distances(df, 3, 200, least).collect()}
        assert got == {k: round(v, 9) for k, v in want.items() if v >= least}

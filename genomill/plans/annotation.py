"""Queries over annotated pairs, vertices, communities and clades, and over sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from genomill.operators import annotation as ops
from genomill.operators import coevolution, counting, graphs, intervals, similarity, trees
from genomill.plans.coevolution import D15_SQL, d15_coevolution_scores
from genomill.plans.counting import BY_TAXON, SIDES, UNICOPY, _by_genome, _by_taxon, _genomes, _go
from genomill.plans.events import GO
from genomill.plans.graphs import GRAPH, LABELS, ROUNDS, _communities, _divided, _graph
from genomill.plans.trees import PATHS, SIZES, _tree, _walk
from genomill.plans.views import oracle, table, view

# an order's lines as the genes of a family, each under one of three flags as genomes: some families have one gene in each
FLAGGED = "SELECT l_orderkey AS gene_family_id, l_returnflag AS genome, concat(l_returnflag, '_', CAST(l_linenumber AS VARCHAR(20)), '_', CAST(l_partkey AS VARCHAR(20))) AS cds_code, l_partkey AS nr_protein_id FROM lineitem"
STATUS = "SELECT DISTINCT l_linestatus AS clade, l_returnflag AS genome, 'clade' AS side FROM lineitem"
# lineages as genes of the nation's family in the market segment as genome; a clade has the segments up to its own
GENES = "genes AS (SELECT taxid AS gene_family_id, assembly_id AS cds_code, species AS genome, assembly_id AS nr_protein_id FROM assemblies), sp AS (SELECT DISTINCT species FROM assemblies), cl AS (SELECT x.species AS clade, y.species AS genome FROM sp x JOIN sp y ON y.species <= x.species)"
SPECIFIC = GENES + """, specific AS (SELECT DISTINCT species AS clade, gene_family_id, CASE WHEN og_id % 2 = 1 THEN og_id END AS og_id FROM orthologous_groups JOIN assemblies ON assembly_id = rlocds_id),
e4 AS (SELECT DISTINCT s.clade, g.genome, g.gene_family_id, g.cds_code, g.nr_protein_id, s.og_id FROM specific s JOIN orthologous_groups o ON o.gene_family_id = s.gene_family_id AND o.og_id = s.og_id JOIN genes g ON g.cds_code = o.rlocds_id AND g.gene_family_id = s.gene_family_id JOIN cl ON cl.clade = s.clade AND cl.genome = g.genome
UNION SELECT DISTINCT s.clade, g.genome, g.gene_family_id, g.cds_code, g.nr_protein_id, s.og_id FROM specific s JOIN genes g USING (gene_family_id) JOIN cl ON cl.clade = s.clade AND cl.genome = g.genome WHERE s.og_id IS NULL)"""
COMMUNITY = f"m AS (SELECT node, community FROM l{ROUNDS} QUALIFY count(*) OVER (PARTITION BY community) <= 50)"


def _flagged(s, d):
    return s.sql(FLAGGED.replace("lineitem", "{lineitem}"), lineitem=table(s, d, "lineitem")), s.sql(STATUS.replace("lineitem", "{lineitem}"), lineitem=table(s, d, "lineitem"))


def _nodes(s, d, *columns):
    return view(s, d, "assemblies").select(F.col("assembly_id").alias("node"), *columns)


def _e4(s, d):
    a = view(s, d, "assemblies")
    genes = a.select(F.col("taxid").alias("gene_family_id"), F.col("assembly_id").alias("cds_code"), F.col("species").alias("genome"), F.col("assembly_id").alias("nr_protein_id"))
    groups = view(s, d, "orthologous_groups").withColumnRenamed("rlocds_id", "cds_code")
    specific = groups.join(a, F.col("assembly_id") == F.col("cds_code")).select(F.col("species").alias("clade"), "gene_family_id", F.when(F.col("og_id") % 2 == 1, F.col("og_id")).alias("og_id")).distinct()
    species = a.select("species").distinct()
    clades = species.select(F.col("species").alias("clade")).join(species.select(F.col("species").alias("genome")), F.col("genome") <= F.col("clade")).withColumn("side", F.lit("clade"))
    return ops.specific_gene_annotation(specific, groups, genes, clades, 1), clades


def e4_specific_gene_annotation(s, d):
    return _e4(s, d)[0].select("clade", "genome", "gene_family_id", "cds_code", "nr_protein_id", "og_id")


def e5_details_of_references(s, d):
    annotated, clades = _e4(s, d)
    return ops.specific_gene_details(annotated, _go(s, d), clades.groupBy("clade").agg(F.min("genome").alias("genome")))


def e5_details_of_all(s, d):
    return ops.specific_gene_details(_e4(s, d)[0], _go(s, d))


def e6_breaches_both(s, d):
    counts, clades = _by_taxon(s, d), view(s, d, "clade_members")
    return ops.specificity_breaches(counts, clades, counting.specific_presence(counts, clades, 0.4).select("clade", "gene_family_id"))


def _limits(s, d):
    return table(s, d, "region").select(F.col("r_regionkey").alias("clade"), (F.col("r_regionkey") + 1).alias("maxabsin"), F.lit(12).alias("maxpresout"), F.lit(3).alias("maxpresin"), (F.col("r_regionkey") + 6).alias("maxabsout"))


def e7_contrasts(s, d):
    supplier = table(s, d, "supplier")
    lists = supplier.groupBy(F.col("s_nationkey").alias("clade")).agg(F.array_join(F.array_sort(F.collect_list(F.col("s_suppkey").cast("string"))), ", ").alias("members"))
    beside = lists.select("clade", F.explode(F.array(F.col("clade") - 1, F.col("clade"), F.col("clade") + 1)).alias("_k")).join(lists.select(F.col("clade").alias("_k"), F.col("members").alias("_m")), "_k")
    return ops.contrast_with(lists.join(beside.groupBy("clade").agg(F.array_join(F.collect_list("_m"), ",").alias("backgroundclade")), "clade"), "backgroundclade")


def c22_aliased_matches(s, d):
    events = view(s, d, "species_tree_events").select(F.col("event_id").alias("id"), "event_type", F.col("don_branch_id").alias("don"), F.col("rec_branch_id").alias("rec"))
    aliases = view(s, d, "populations").select(F.col("node").alias("place"), F.concat(F.lit("P"), F.col("clade").cast("string")).alias("population"))
    return ops.matches_with_aliases(events, events, aliases)


def g4_shared_species(s, d):
    g = view(s, d, "replicons").join(view(s, d, "assemblies"), "assembly_id")
    return ops.shared_rows(*[g.where(F.col("replicon_type") == t).select("species", "taxid") for t in ("plasmid", "chromosome")])


def h4_sketch_distances(s, d):
    texts = view(s, d, "sequences").where("family IS NOT NULL AND genome IS NOT NULL").select(F.concat("family", F.lit("/"), "genome").alias("id"), F.col("seq").alias("text"))
    return similarity.sketch_distances(texts, 5, 200)


def h4_similar_sketches(s, d):
    return similarity.sketch_distances(_texts(s, d), 5, 200, 0.5)


def k7_similarity_families(s, d):
    return similarity.similarity_families(_texts(s, d), 5, 0.75)


def _texts(s, d):
    return view(s, d, "sequences").select(F.col("seq_id").alias("id"), F.col("seq").alias("text"))


def j3_clade_members(s, d):
    nodes, paths = _tree(s, d)
    return trees.clade_definition_members(nodes, paths, trees.clade_definitions(nodes, paths, 6))


def j4_branch_ages(s, d):
    nodes, paths = _tree(s, d)
    return trees.branch_ages(nodes.withColumn("length", F.col("branch_id") % 7 + F.lit(0.5)), paths, 2.0)


def j7_translated_events(s, d):
    """Branches of populations (named by their number) become the last common ancestors of their suppliers' leaves."""
    leaves = view(s, d, "populations").select(F.col("clade").alias("branch"), "node")
    events = table(s, d, "lineitem").select(F.col("l_orderkey").alias("lineage"), F.col("l_linenumber").alias("sample"), F.lit("T").alias("event_type"), F.floor(F.col("l_suppkey") / 7).alias("don"), (F.col("l_partkey") % 5).alias("rec"))
    return intervals.translate_events(events, leaves, *_walk(s, d)[1:])


def _sketch_sql(k, size, ids="concat(family, '/', genome)", known="family IS NOT NULL AND genome IS NOT NULL", least=1e-9):
    return f"""WITH t AS (SELECT {ids} AS id, string_split(seq, ' ') AS w FROM sequences WHERE {known} AND seq IS NOT NULL),
h AS (SELECT DISTINCT id, CAST('0x' || substr(md5(array_to_string(w[i:i + {k - 1}], ' ')), 1, 15) AS BIGINT) AS h FROM (SELECT id, w, unnest(generate_series(1, greatest(len(w) - {k - 1}, 1))) AS i FROM t)),
b AS (SELECT id, h FROM h QUALIFY row_number() OVER (PARTITION BY id ORDER BY h) <= {size}), k AS (SELECT id, list(h ORDER BY h) AS s FROM b GROUP BY 1),
m AS (SELECT DISTINCT x.id AS id_1, y.id AS id_2 FROM b x JOIN b y ON x.h = y.h AND x.id < y.id),
p AS (SELECT id_1, id_2, a.s AS s1, c.s AS s2, list_slice(list_sort(list_distinct(list_concat(a.s, c.s))), 1, {size}) AS u FROM m JOIN k a ON a.id = id_1 JOIN k c ON c.id = id_2),
j AS (SELECT id_1, id_2, round(len(list_intersect(list_intersect(s1, s2), u)) / len(u), 9) AS jaccard FROM p)
SELECT id_1, id_2, jaccard, round(-ln(2 * jaccard / (1 + jaccard)) / {k}, 9) + 0.0 AS distance FROM j WHERE jaccard >= {least}"""


# every pair of different texts that share a shingle is compared; links are followed to the end
K7_SQL = """WITH RECURSIVE t AS (SELECT seq_id AS id, string_split(seq, ' ') AS w FROM sequences WHERE seq IS NOT NULL),
h AS MATERIALIZED (SELECT DISTINCT id, CAST('0x' || substr(md5(array_to_string(w[i:i + 4], ' ')), 1, 15) AS BIGINT) AS h FROM (SELECT id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM t)),
n AS (SELECT id, count(*) AS n FROM h GROUP BY 1), k AS (SELECT x.id AS a, y.id AS b, count(*) AS k FROM h x JOIN h y ON x.h = y.h AND x.id < y.id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM k JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 4 * k >= 3 * (x.n + y.n - k)), u AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS node, a AS other FROM u UNION SELECT r.node, b FROM r JOIN u ON u.a = r.other), f AS (SELECT node AS id, min(other) AS family FROM r GROUP BY 1)
SELECT id, coalesce(family, id) AS family FROM (SELECT DISTINCT seq_id AS id FROM sequences) LEFT JOIN f USING (id)"""


def _full_sql(value, pairs):
    return f"WITH {BY_TAXON}, z AS (SELECT genome, {value} AS c FROM n GROUP BY 1), k AS (SELECT a.genome AS genome_1, b.genome AS genome_2, {pairs} AS k FROM n a JOIN n b ON a.gene_family_id = b.gene_family_id AND a.genome < b.genome GROUP BY 1, 2)"


QUERIES = {
    "c14_annotate_pairs": (lambda s, d: ops.annotate_pairs(d15_coevolution_scores(s, d), view(s, d, "assemblies").select(F.col("assembly_id").alias("rlocds_id"), "species", "taxid"), "rlocds_id_1", "rlocds_id_2", "rlocds_id"), oracle(f"WITH p AS ({D15_SQL}) SELECT p.*, x.species AS species_1, x.taxid AS taxid_1, y.species AS species_2, y.taxid AS taxid_2 FROM p LEFT JOIN assemblies x ON x.assembly_id = rlocds_id_1 LEFT JOIN assemblies y ON y.assembly_id = rlocds_id_2")),
    "c22_aliased_matches": (c22_aliased_matches, oracle("""WITH al AS (SELECT CAST(node AS VARCHAR) AS place, concat('P', CAST(clade AS VARCHAR)) AS population FROM populations),
x AS (SELECT event_id AS id, event_type, coalesce(CAST(don_branch_id AS VARCHAR), '') AS don, CAST(rec_branch_id AS VARCHAR) AS rec FROM species_tree_events),
d AS (SELECT id, event_type, don AS d, rec FROM x UNION SELECT id, event_type, population, rec FROM x JOIN al ON place = don),
r AS (SELECT id, event_type, d, rec AS r FROM d UNION SELECT id, event_type, d, population FROM d JOIN al ON place = rec), m AS (SELECT event_type, d, r, min(id) AS id_2 FROM r GROUP BY ALL)
SELECT r.id AS id_1, min(id_2) AS id_2 FROM r JOIN m USING (event_type, d, r) GROUP BY 1""")),
    "b22_filter_events": (lambda s, d: coevolution.filter_events(view(s, d, "gene_lineage_events").join(view(s, d, "species_tree_events").select("event_id", "event_type"), "event_id"), 100, 0.2, 0.45, ["D", "T"]).select("rlocds_id", "event_id", "freq", "event_type"), oracle("SELECT rlocds_id, event_id, freq, event_type FROM gene_lineage_events JOIN species_tree_events USING (event_id) WHERE freq >= 20 AND freq < 45 AND event_type IN ('D', 'T')")),
    "d7_core_families_of_orders": (lambda s, d: counting.core_families(counting.gene_counts(_flagged(s, d)[0], "genome"), 3), oracle(f"SELECT gene_family_id FROM (SELECT gene_family_id, genome, count(*) AS n FROM ({FLAGGED}) GROUP BY ALL) GROUP BY 1 HAVING count(*) = 3 AND max(n) = 1")),
    "d9_presence_grid": (lambda s, d: counting.presence_cumulative(_by_genome(s, d), 40), oracle(f"WITH {UNICOPY} SELECT g AS n_genomes, count(present) AS n_families FROM (SELECT unnest(generate_series(30, 40)) AS g) LEFT JOIN u ON present >= g GROUP BY 1")),
    "d26_clade_core_background": (lambda s, d: (lambda g: ops.clade_core_background(g[0], _go(s, d), g[1]))(_flagged(s, d)), oracle(f"""WITH {GO}, gn AS ({FLAGGED}), cl AS ({STATUS}), z AS (SELECT clade, count(*) AS n FROM cl GROUP BY 1),
h AS (SELECT clade, gene_family_id, count(*) AS s, count(DISTINCT genome) AS g, min({{'a': genome, 'b': cds_code, 'c': nr_protein_id}}) AS m FROM gn JOIN cl USING (genome) GROUP BY 1, 2)
SELECT DISTINCT clade, gene_family_id, m.b AS cds_code, go_id FROM h JOIN z USING (clade) JOIN go ON nr_protein_id = m.c WHERE s = n AND g = n""")),
    "d27_whole_background": (lambda s, d: ops.pan_background(_genomes(s, d).withColumnRenamed("taxid", "genome"), _go(s, d), view(s, d, "clade_members")), oracle(f"WITH {BY_TAXON}, {GO}, p AS (SELECT DISTINCT taxid AS genome, gene_family_id, nr_protein_id FROM g WHERE gene_family_id IS NOT NULL), t AS (SELECT p.*, go_id FROM p LEFT JOIN go USING (nr_protein_id)) SELECT DISTINCT NULL::BIGINT AS clade, gene_family_id, go_id FROM t UNION ALL SELECT DISTINCT clade, gene_family_id, go_id FROM t JOIN clade_members USING (genome) WHERE side = 'clade'")),
    "e1_presence_by_limits": (lambda s, d: counting.specific_presence(_by_taxon(s, d), view(s, d, "clade_members"), 0.4, _limits(s, d)), oracle(f"WITH {SIDES} SELECT clade, gene_family_id, has_in, has_out FROM s WHERE n_in - has_in <= clade + 1 AND has_out <= 12")),
    "e2_absence_by_limits": (lambda s, d: counting.specific_absence(_by_taxon(s, d), view(s, d, "clade_members"), 0.4, _limits(s, d)), oracle(f"WITH {SIDES} SELECT clade, gene_family_id, has_in, has_out FROM s WHERE has_in <= 3 AND n_out - has_out <= clade + 6")),
    "e4_specific_gene_annotation": (e4_specific_gene_annotation, oracle(f"WITH {SPECIFIC} SELECT * FROM e4")),
    "e5_details_of_all": (e5_details_of_all, oracle(f"WITH {SPECIFIC}, {GO} SELECT DISTINCT clade, gene_family_id, cds_code, go_id FROM e4 JOIN go USING (nr_protein_id)")),
    "e5_details_of_references": (e5_details_of_references, oracle(f"WITH {SPECIFIC}, {GO}, f AS (SELECT clade, min(genome) AS genome FROM cl GROUP BY 1) SELECT DISTINCT clade, gene_family_id, cds_code, go_id FROM e4 JOIN f USING (clade, genome) JOIN go USING (nr_protein_id)")),
    "e6_breaches_both": (e6_breaches_both, oracle(f"""WITH {SIDES}, p AS (SELECT clade, gene_family_id FROM s WHERE n_in - has_in <= round_even(n_in * 0.4, 0) AND has_out <= round_even(n_out * 0.4, 0)),
m AS (SELECT p.*, CAST(c.genome AS VARCHAR) AS genome, side, n.genome IS NOT NULL AS has FROM p JOIN clade_members c USING (clade) LEFT JOIN n ON n.genome = c.genome AND n.gene_family_id = p.gene_family_id)
SELECT clade, gene_family_id, coalesce(string_agg(genome, ',' ORDER BY genome) FILTER (side = 'clade' AND NOT has), '') AS lacking, coalesce(string_agg(genome, ',' ORDER BY genome) FILTER (side = 'contrast' AND has), '') AS having FROM m GROUP BY 1, 2""")),
    "e7_contrasts": (e7_contrasts, "SELECT s_nationkey AS clade, CAST(s_suppkey AS VARCHAR) AS genome, 'clade' AS side FROM supplier UNION ALL SELECT k, CAST(s_suppkey AS VARCHAR), 'contrast' FROM (SELECT DISTINCT s_nationkey AS k FROM supplier) JOIN supplier ON abs(s_nationkey - k) = 1"),
    "g4_shared_species": (g4_shared_species, oracle("SELECT species, taxid FROM replicons JOIN assemblies USING (assembly_id) WHERE replicon_type = 'plasmid' INTERSECT SELECT species, taxid FROM replicons JOIN assemblies USING (assembly_id) WHERE replicon_type = 'chromosome'")),
    "h1_jaccard_full": (lambda s, d: counting.jaccard_distances(_by_taxon(s, d), full=True), oracle(_full_sql("count(*)", "count(*)") + " SELECT x.genome AS genome_1, y.genome AS genome_2, coalesce(round(1 - k / (x.c + y.c - k), 9), 1.0) AS distance FROM z x JOIN z y ON x.genome < y.genome LEFT JOIN k ON genome_1 = x.genome AND genome_2 = y.genome")),
    "h2_bray_curtis_full": (lambda s, d: counting.bray_curtis(_by_taxon(s, d), full=True), oracle(_full_sql("sum(n)", "sum(least(a.n, b.n))") + " SELECT x.genome AS genome_1, y.genome AS genome_2, coalesce(round(1 - 2 * k / (x.c + y.c), 9), 1.0) AS distance FROM z x JOIN z y ON x.genome < y.genome LEFT JOIN k ON genome_1 = x.genome AND genome_2 = y.genome")),
    "h4_sketch_distances": (h4_sketch_distances, oracle(_sketch_sql(5, 200))),
    "h4_similar_sketches": (h4_similar_sketches, oracle(_sketch_sql(5, 200, "seq_id", "TRUE", least=0.5))),
    "k7_similarity_families": (k7_similarity_families, oracle(K7_SQL)),
    "i7_vertices": (lambda s, d: ops.annotate_vertices(graphs.association_graph(_graph(s, d)), view(s, d, "lineage_families").withColumnRenamed("rlocds_id", "node"), _nodes(s, d, "species")), oracle(f"WITH {GRAPH}, v AS (SELECT a AS node, count(*) AS degree, round(sum(weight), 6) AS strength FROM u GROUP BY 1) SELECT v.*, gene_family_id, species FROM v LEFT JOIN lineage_families ON rlocds_id = node LEFT JOIN assemblies ON assembly_id = node")),
    "i8_community_tables": (lambda s, d: ops.community_tables(*_divided(s, d), _nodes(s, d, "species", "taxid"), view(s, d, "replicons").select(F.col("assembly_id").alias("node"), F.col("replicon_type").alias("replicon"))), oracle(f"WITH {LABELS}, r AS (SELECT DISTINCT assembly_id, replicon_type FROM replicons) SELECT i.*, x.species AS species_1, x.taxid AS taxid_1, y.species AS species_2, y.taxid AS taxid_2, EXISTS (SELECT 1 FROM r p JOIN r q USING (replicon_type) WHERE p.assembly_id = i.a AND q.assembly_id = i.b) AS same_replicon FROM inside i LEFT JOIN assemblies x ON x.assembly_id = a LEFT JOIN assemblies y ON y.assembly_id = b")),
    "i9_community_events": (lambda s, d: ops.community_events(_communities(s, d), view(s, d, "gene_lineage_events"), view(s, d, "species_tree_events"), 50), oracle(f"WITH {LABELS}, {COMMUNITY} SELECT community, event_id, count(*) AS n_members, CAST(sum(freq) AS BIGINT) AS freq, event_type, don_branch_id, rec_branch_id FROM m JOIN gene_lineage_events ON rlocds_id = node JOIN species_tree_events USING (event_id) GROUP BY ALL")),
    "j3_clade_members": (j3_clade_members, oracle(SIZES + """, c AS (SELECT z.*, parent_branch_id AS p FROM sizes z JOIN species_tree ON branch_id = clade WHERE n_members > 1 AND parent_branch_id IS NOT NULL),
g AS (SELECT c.clade, ancestor AS background, row_number() OVER (PARTITION BY c.clade ORDER BY z.n_members - c.n_members < 6, CASE WHEN z.n_members - c.n_members < 6 THEN -distance ELSE distance END) AS r FROM c JOIN paths ON node = c.clade AND distance > 0 JOIN sizes z ON z.clade = ancestor),
lf AS (SELECT ancestor AS top, t.branch_name AS member FROM paths p JOIN tips USING (node) JOIN species_tree t ON t.branch_id = p.node), own AS (SELECT clade, member FROM c JOIN lf ON top = clade)
SELECT clade, 'clade' AS side, member FROM own UNION ALL SELECT c.clade, 'sister', member FROM c JOIN species_tree s ON s.parent_branch_id = c.p AND s.branch_id <> c.clade JOIN lf ON top = s.branch_id
UNION ALL SELECT g.clade, 'background', member FROM g JOIN lf ON top = background WHERE r = 1 AND NOT EXISTS (SELECT 1 FROM own o WHERE o.clade = g.clade AND o.member = lf.member)""")),
    "j4_branch_ages": (j4_branch_ages, oracle(PATHS + ", d AS (SELECT node, sum(CASE WHEN ancestor = 1 THEN 0 ELSE ancestor % 7 + 0.5 END)::DOUBLE AS d FROM paths GROUP BY 1) SELECT node AS branch_id, round(2.0 * (1 - d / (SELECT max(d) FROM d)), 9)::DOUBLE AS age FROM d")),
    "j7_translated_events": (j7_translated_events, oracle(PATHS + """, m AS (SELECT clade, node, count(*) OVER (PARTITION BY clade) AS n FROM populations),
a AS (SELECT clade, ancestor, sum(distance) AS d FROM m JOIN paths USING (node) GROUP BY clade, ancestor, n HAVING count(*) = n), mrca AS (SELECT clade, arg_min(ancestor, d) AS b FROM a GROUP BY 1)
SELECT DISTINCT l_orderkey AS lineage, l_linenumber AS sample, 'T' AS event_type, x.b AS don, y.b AS rec FROM lineitem LEFT JOIN mrca x ON x.clade = floor(l_suppkey / 7) LEFT JOIN mrca y ON y.clade = l_partkey % 5 WHERE x.b IS NULL OR y.b IS NULL OR x.b <> y.b""")),
}

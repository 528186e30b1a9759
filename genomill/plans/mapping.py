"""Queries over labels, members and populations."""

from __future__ import annotations

from pyspark.sql import functions as F

from genomill.functions.text import families_matching, find_families
from genomill.operators import mapping as ops
from genomill.operators import intervals
from genomill.operators import counting, trees
from genomill.plans.counting import GENOMES, _genomes
from genomill.plans.trees import PATHS, _tree, _walk
from genomill.plans.views import oracle, table, view

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
LABELS = "cds AS (SELECT code AS cds_code, code AS label, taxid AS gene_family_id, species AS clade FROM assemblies), rep AS (SELECT DISTINCT gene_family_id, clade AS clade_or_cds, gene_family_id || '-' || clade AS label FROM cds WHERE clade IN ('BUILDING', 'MACHINERY') UNION ALL SELECT gene_family_id, cds_code, 'R' || cds_code FROM cds WHERE clade = 'HOUSEHOLD'), ev AS (SELECT DISTINCT code AS label FROM assemblies JOIN gene_lineage_events ON rlocds_id = assembly_id WHERE freq >= 90 UNION ALL SELECT label FROM rep)"
OCCURRENCE = "n AS (SELECT gene_family_id, l_suppkey AS genome, count(*) AS n FROM coding_sequences WHERE gene_family_id IS NOT NULL GROUP BY 1, 2), pops AS (SELECT clade AS population, genome, node FROM populations), grid AS (SELECT f.gene_family_id AS clade, p.population, p.genome, coalesce(n, 0) AS n FROM (SELECT DISTINCT gene_family_id, population FROM n JOIN pops USING (genome)) f JOIN pops p USING (population) LEFT JOIN n ON n.gene_family_id = f.gene_family_id AND n.genome = p.genome), occ AS (SELECT clade, population, count(*) AS census, round(sum(n) / count(*), 9) AS mean, median(n)::DOUBLE AS median FROM grid GROUP BY 1, 2)"


def _labels(s, d):
    cds = view(s, d, "assemblies").select(F.col("code").alias("cds_code"), F.col("code").alias("label"), F.col("taxid").alias("gene_family_id"), F.col("species").alias("clade"))
    clades = cds.where("clade IN ('BUILDING', 'MACHINERY')").select("gene_family_id", F.col("clade").alias("clade_or_cds"), F.concat_ws("-", F.col("gene_family_id").cast("string"), "clade").alias("label")).distinct()
    rep = clades.unionByName(cds.where("clade = 'HOUSEHOLD'").select("gene_family_id", F.col("cds_code").alias("clade_or_cds"), F.concat(F.lit("R"), "cds_code").alias("label")))
    often = view(s, d, "gene_lineage_events").where("freq >= 90").select(F.col("rlocds_id").alias("assembly_id")).distinct()
    events = view(s, d, "assemblies").join(often, "assembly_id").select(F.col("code").alias("label")).unionByName(rep.select("label"))
    return cds, rep, events


def c11_label_to_family(s, d):
    return ops.label_to_family(*_labels(s, d))


def c12_label_to_cds(s, d):
    cds, rep, events = _labels(s, d)
    return ops.label_to_cds(cds, rep, cds.select("gene_family_id", "clade", "cds_code"), events)


def c21_replaced_labels(s, d):
    cds, rep, _ = _labels(s, d)
    return ops.replaced_labels(cds, rep, cds.select("gene_family_id", "clade", "cds_code"))


def _products(s, d):
    return view(s, d, "proteins").select(F.col("protein_family_id").alias("gene_family_id"), "product")


def d23_clade_frequencies(s, d):
    """Lines of text with half more than the customers of each segment in a nation."""
    sums = table(s, d, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    text = sums.groupBy("c_nationkey").agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws(":", "c_mktsegment", F.format_string("%d.5", "n")))), "\t").alias("_t"))
    lines = text.select((F.col("c_nationkey") % 5).alias("family"), F.concat_ws("\t", F.concat(F.lit("C"), F.col("c_nationkey").cast("string")), "_t").alias("value"))
    return ops.clade_frequencies(lines, SEGMENTS)


def _occurrence(s, d):
    populations = view(s, d, "populations").select(F.col("clade").alias("population"), "genome")
    return ops.population_occurrence(counting.gene_counts(view(s, d, "coding_sequences"), "l_suppkey").withColumnRenamed("gene_family_id", "clade"), populations)


def f6_ancestral_population(s, d):
    _, tour, minima = _walk(s, d)
    members = view(s, d, "populations").select(F.col("clade").alias("population"), "node")
    mrca = intervals.common_ancestors(members, tour, minima, "population").withColumnRenamed("mrca", "node")
    return ops.ancestral_population(_occurrence(s, d), mrca.join(tour, "node").select("population", "depth"))


def d20_member_annotation(s, d):
    genes = _genomes(s, d).join(view(s, d, "proteins").select("nr_protein_id", "product"), "nr_protein_id").select(F.col("assembly_id").alias("rlocds_id"), "product")
    return ops.member_annotation(view(s, d, "orthologous_groups"), genes, 1)


def k6_cds_families(s, d):
    brand = F.regexp_extract("protein_family_id", r"(\d+)$", 1).cast("int")
    proteins = view(s, d, "proteins").select("nr_protein_id", F.when(brand > 5, brand).alias("family_no"))
    return ops.cds_families(proteins, view(s, d, "coding_sequences"), 0)


QUERIES = {
    "c11_label_to_family": (c11_label_to_family, oracle(f"WITH {LABELS}, x AS (SELECT label, gene_family_id FROM cds UNION SELECT label, gene_family_id FROM rep) SELECT label, gene_family_id, row_number() OVER (ORDER BY label, gene_family_id) AS label_no FROM x WHERE label IN (SELECT label FROM ev)")),
    "c12_label_to_cds": (c12_label_to_cds, oracle(f"WITH {LABELS}, x AS (SELECT label, cds_code FROM cds UNION SELECT rep.label, cds_code FROM rep JOIN cds ON cds_code = clade_or_cds UNION SELECT rep.label, cds_code FROM rep JOIN cds ON clade = clade_or_cds AND cds.gene_family_id = rep.gene_family_id) SELECT * FROM x WHERE label IN (SELECT label FROM ev)")),
    "c19_translate_ids": (lambda s, d: ops.translate_ids(view(s, d, "replicons").select("genomic_accession", F.col("assembly_id").cast("string").alias("name")), view(s, d, "assemblies").select(F.col("assembly_id").cast("string").alias("old"), F.col("code").alias("new")), "name"), oracle("SELECT genomic_accession, code AS name FROM replicons JOIN assemblies USING (assembly_id)")),
    "c20_to_representative": (lambda s, d: ops.to_representative(view(s, d, "coding_sequences").select("nr_protein_id"), _same_product(s, d), "nr_protein_id").groupBy("nr_protein_id").agg(F.count("*").alias("n")), oracle("WITH r AS (SELECT nr_protein_id, min(nr_protein_id) OVER (PARTITION BY product) AS r FROM proteins) SELECT r AS nr_protein_id, count(*) AS n FROM coding_sequences JOIN r USING (nr_protein_id) GROUP BY 1")),
    "c20_expand_members": (lambda s, d: ops.expand_members(view(s, d, "coding_sequences").groupBy("nr_protein_id").agg(F.count("*").alias("n")), _same_product(s, d), "nr_protein_id"), oracle("WITH r AS (SELECT nr_protein_id, min(nr_protein_id) OVER (PARTITION BY product) AS r FROM proteins), c AS (SELECT nr_protein_id, count(*) AS n FROM coding_sequences GROUP BY 1) SELECT r.nr_protein_id, n FROM c JOIN r ON r.r = c.nr_protein_id")),
    "d20_member_annotation": (d20_member_annotation, oracle(f"WITH g AS ({GENOMES}) SELECT DISTINCT o.gene_family_id, og_id, product FROM orthologous_groups o JOIN g ON g.assembly_id = rlocds_id JOIN proteins USING (nr_protein_id)")),
    "b13_find_families": (lambda s, d: find_families(_products(s, d), ["Brand#7", "widget", "hot gear", "no such"]), oracle("WITH t AS (SELECT unnest(['Brand#7', 'widget', 'hot gear', 'no such']) AS term), i AS (SELECT DISTINCT term, protein_family_id AS gene_family_id FROM t JOIN proteins ON protein_family_id = term) SELECT * FROM i UNION SELECT term, protein_family_id FROM t JOIN proteins ON contains(product, term) WHERE protein_family_id IS NOT NULL AND term NOT IN (SELECT term FROM i)")),
    "b14_families_matching": (lambda s, d: families_matching(_products(s, d), "RED (widget|bolt)"), oracle("SELECT DISTINCT protein_family_id AS gene_family_id FROM proteins WHERE regexp_matches(product, '(?i)RED (widget|bolt)')")),
    "c21_replaced_labels": (c21_replaced_labels, oracle(f"WITH {LABELS}, a AS (SELECT gene_family_id, clade_or_cds AS cds_code, label, 0 AS k FROM rep UNION ALL SELECT c.gene_family_id, c.cds_code, r.label, 1 FROM cds c JOIN rep r ON r.gene_family_id = c.gene_family_id AND r.clade_or_cds = c.clade), f AS (SELECT gene_family_id, cds_code, label FROM a QUALIFY row_number() OVER (PARTITION BY gene_family_id, cds_code ORDER BY k, label) = 1) SELECT DISTINCT c.gene_family_id, c.cds_code, coalesce(f.label, c.cds_code) AS label FROM cds c LEFT JOIN f USING (gene_family_id, cds_code)")),
    "d23_clade_frequencies": (d23_clade_frequencies, "SELECT c_nationkey % 5 AS family, concat('C', c_nationkey) AS clade, " + ", ".join(f"CASE WHEN count(*) FILTER (c_mktsegment = '{x}') > 0 THEN count(*) FILTER (c_mktsegment = '{x}') + 0.5::DOUBLE ELSE 0::DOUBLE END AS \"{x}\"" for x in SEGMENTS) + " FROM customer GROUP BY c_nationkey"),
    "d21_clade_profiles": (lambda s, d: ops.clade_profiles(view(s, d, "assemblies").select(F.col("taxid").alias("clade"), "species"), SEGMENTS), oracle("SELECT taxid AS clade, " + ", ".join(f"count(*) FILTER (species = '{x}') AS \"{x}\"" for x in SEGMENTS) + " FROM assemblies GROUP BY 1")),
    "d22_population_occurrence": (_occurrence, oracle(f"WITH {OCCURRENCE} SELECT * FROM occ")),
    "f6_ancestral_population": (f6_ancestral_population, oracle(f"{PATHS}, {OCCURRENCE}, a AS (SELECT population, ancestor, sum(distance) AS d FROM pops JOIN paths USING (node) GROUP BY 1, 2 HAVING count(*) = (SELECT count(*) FROM pops p WHERE p.population = pops.population)), m AS (SELECT population, arg_min(ancestor, d) AS node FROM a GROUP BY 1), z AS (SELECT population, max(distance) AS depth FROM m JOIN paths USING (node) GROUP BY 1) SELECT clade, population FROM occ JOIN z USING (population) QUALIFY row_number() OVER (PARTITION BY clade ORDER BY median >= 0.5 AND census > 1 DESC, depth, census DESC, mean DESC, population) = 1")),
    "f9_name_populations": (lambda s, d: ops.name_populations(view(s, d, "assemblies").select(F.col("taxid").alias("population"), F.col("species").alias("label"))), oracle("WITH c AS (SELECT taxid AS population, substr(species, 1, 3) AS p, count(*) AS n FROM assemblies GROUP BY 1, 2), b AS (SELECT population, p FROM c QUALIFY row_number() OVER (PARTITION BY population ORDER BY n DESC, p) = 1) SELECT population, p || row_number() OVER (PARTITION BY p ORDER BY population) AS name FROM b")),
    "i10_pool_populations": (lambda s, d: ops.pools(trees.near_tips(view(s, d, "species_tree"), 4)), oracle(f"{PATHS}, e AS (SELECT a.node AS a, b.node AS b FROM paths a JOIN paths b USING (ancestor) WHERE a.node <> b.node AND a.node IN (SELECT node FROM tips) AND b.node IN (SELECT node FROM tips) GROUP BY 1, 2 HAVING min(a.distance + b.distance) <= 4), r AS (SELECT a AS node, a AS other FROM e UNION SELECT r.node, b FROM r JOIN e ON a = other), c AS (SELECT node, min(other) AS pool FROM r GROUP BY 1) SELECT pool, string_agg(node, ',' ORDER BY node) AS members FROM c GROUP BY 1")),
    "d29_og_report": (lambda s, d: ops.og_report(view(s, d, "lineage_families"), view(s, d, "orthologous_groups"), 1), oracle("SELECT count(*) AS n_lineages, count(og_id) AS n_in_groups, count(DISTINCT l.gene_family_id) AS n_families, count(DISTINCT o.gene_family_id) AS n_families_in_groups, count(DISTINCT o.gene_family_id || '-' || og_id) AS n_groups FROM lineage_families l LEFT JOIN orthologous_groups o USING (rlocds_id)")),
    "k6_cds_families": (k6_cds_families, oracle("WITH p AS (SELECT nr_protein_id, CASE WHEN CAST(substr(protein_family_id, 7) AS INT) > 5 THEN CAST(substr(protein_family_id, 7) AS INT) END AS family_no FROM proteins), l AS (SELECT nr_protein_id, count(*) AS n FROM p JOIN coding_sequences USING (nr_protein_id) WHERE family_no IS NULL GROUP BY 1) SELECT nr_protein_id, CAST(family_no AS BIGINT) AS family_no FROM p WHERE family_no IS NOT NULL UNION ALL SELECT nr_protein_id, row_number() OVER (ORDER BY nr_protein_id) + (SELECT max(family_no) FROM p) FROM l WHERE n > 1 UNION ALL SELECT nr_protein_id, 0 FROM l WHERE n = 1")),
}


def _same_product(s, d):
    proteins = view(s, d, "proteins")
    first = proteins.groupBy("product").agg(F.min("nr_protein_id").alias("representative"))
    return proteins.join(first, "product").select(F.col("nr_protein_id").alias("member"), "representative")

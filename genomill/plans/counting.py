"""Queries over the relational core, count matrices and clade contrasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from genomill.operators import counting as ops
from genomill.plans.views import oracle, table, view

GENOMES = "SELECT c.*, r.assembly_id, r.replicon_size, r.replicon_type, a.taxid, a.species, a.code FROM coding_sequences c JOIN replicons r USING (genomic_accession) JOIN assemblies a USING (assembly_id)"
BY_GENOME = f"g AS ({GENOMES}), n AS (SELECT gene_family_id, assembly_id AS genome, CAST(count(*) AS BIGINT) AS n FROM g WHERE gene_family_id IS NOT NULL GROUP BY ALL)"
BY_TAXON = f"g AS ({GENOMES}), n AS (SELECT gene_family_id, taxid AS genome, CAST(count(*) AS BIGINT) AS n FROM g WHERE gene_family_id IS NOT NULL GROUP BY ALL)"
UNICOPY = BY_GENOME + ", u AS (SELECT gene_family_id, count(*) AS present FROM n GROUP BY 1 HAVING max(n) = 1)"
SIDES = BY_TAXON + """, sizes AS (SELECT clade, count(*) FILTER (side = 'clade') AS n_in, count(*) FILTER (side = 'contrast') AS n_out FROM clade_members GROUP BY 1),
s AS (SELECT clade, gene_family_id, count(*) FILTER (side = 'clade') AS has_in, count(*) FILTER (side = 'contrast') AS has_out, any_value(n_in) AS n_in, any_value(n_out) AS n_out
FROM n JOIN clade_members USING (genome) JOIN sizes USING (clade) GROUP BY 1, 2)"""


def _genomes(spark, d):
    return ops.cds_genomes(view(spark, d, "coding_sequences"), view(spark, d, "replicons"), view(spark, d, "assemblies"))


def _by_genome(spark, d):
    return ops.gene_counts(_genomes(spark, d), "assembly_id")


def _by_taxon(spark, d):
    return ops.gene_counts(_genomes(spark, d), "taxid")


def _lineages(spark, d):
    return view(spark, d, "lineage_families").join(view(spark, d, "assemblies").select(F.col("assembly_id").alias("rlocds_id"), F.col("species").alias("genome")), "rlocds_id")


def _go(spark, d):
    return view(spark, d, "functional_annotations").join(view(spark, d, "interpro2go"), "interpro_id")


QUERIES = {
    "c1_build_proteins": (lambda s, d: ops.build_proteins(view(s, d, "proteins").select("nr_protein_id", "product"), view(s, d, "proteins").select("nr_protein_id", "protein_family_id")), oracle("SELECT nr_protein_id, protein_family_id, min(product) AS product FROM proteins GROUP BY 1, 2")),
    "c2_build_cds": (lambda s, d: ops.build_cds(view(s, d, "coding_sequences"), 0).groupBy("gene_family_id").agg(F.count("*").alias("n")), oracle("SELECT coalesce(gene_family_id, CASE WHEN nr_protein_id IS NOT NULL THEN 0 END) AS gene_family_id, count(*) AS n FROM coding_sequences GROUP BY 1")),
    "c3_cds_genomes": (lambda s, d: _genomes(s, d).groupBy("replicon_type", "species").agg(F.count("*").alias("n_cds"), F.countDistinct("assembly_id").alias("n_genomes")), oracle(f"WITH g AS ({GENOMES}) SELECT replicon_type, species, count(*) AS n_cds, count(DISTINCT assembly_id) AS n_genomes FROM g GROUP BY 1, 2")),
    "b1_cds_codes": (lambda s, d: ops.cds_codes(_genomes(s, d)).select("genomic_accession", "cds_code"), oracle(f"WITH g AS ({GENOMES}) SELECT genomic_accession, code || '_' || cds_no AS cds_code FROM g")),
    "c4_orphan_families": (lambda s, d: ops.orphan_families(view(s, d, "coding_sequences"), view(s, d, "proteins").where("protein_family_id NOT LIKE 'Brand#1%'")), oracle("SELECT DISTINCT gene_family_id FROM coding_sequences WHERE gene_family_id IS NOT NULL AND gene_family_id NOT IN (SELECT nr_protein_id FROM proteins WHERE protein_family_id NOT LIKE 'Brand#1%')")),
    "c5_exclude_families": (lambda s, d: ops.exclude(ops.family_sizes(_genomes(s, d)), view(s, d, "proteins").where("product LIKE '%blue%' OR protein_family_id = 'Brand#11'").select(F.col("nr_protein_id").alias("gene_family_id")), "gene_family_id"), oracle(f"WITH g AS ({GENOMES}) SELECT gene_family_id, count(*) AS size, count(DISTINCT assembly_id) AS genome_present FROM g WHERE gene_family_id NOT IN (SELECT nr_protein_id FROM proteins WHERE product LIKE '%blue%' OR protein_family_id = 'Brand#11') GROUP BY 1")),
    "c6_restrict_genomes": (lambda s, d: ops.restrict(_genomes(s, d), view(s, d, "assemblies").where("taxid IN (3, 7)").select("assembly_id"), "assembly_id").groupBy("code").agg(F.count("*").alias("n")), oracle(f"WITH g AS ({GENOMES}) SELECT code, count(*) AS n FROM g WHERE assembly_id IN (SELECT assembly_id FROM assemblies WHERE taxid IN (3, 7)) GROUP BY 1")),
    "c16_id_differences": (lambda s, d: ops.id_differences(view(s, d, "proteins").where("protein_family_id <> 'Brand#12'").select("nr_protein_id"), view(s, d, "coding_sequences").where("l_quantity > 25"), "nr_protein_id"), oracle("WITH a AS (SELECT DISTINCT nr_protein_id FROM proteins WHERE protein_family_id <> 'Brand#12'), b AS (SELECT DISTINCT nr_protein_id FROM coding_sequences WHERE l_quantity > 25) SELECT nr_protein_id, 'first' AS only_in FROM a WHERE nr_protein_id NOT IN (SELECT nr_protein_id FROM b) UNION ALL SELECT nr_protein_id, 'second' FROM b WHERE nr_protein_id NOT IN (SELECT nr_protein_id FROM a)")),
    "c17_repeated_keys": (lambda s, d: ops.repeated_keys(table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]), "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"),
    "c18_count_mismatches": (lambda s, d: ops.count_mismatches(view(s, d, "coding_sequences"), view(s, d, "coding_sequences").where("l_quantity > 2"), "genomic_accession"), oracle("WITH a AS (SELECT genomic_accession, count(*) AS n_first, count(*) FILTER (l_quantity > 2) AS n_second FROM coding_sequences GROUP BY 1) SELECT * FROM a WHERE n_first <> n_second")),
    "d1_family_sizes": (lambda s, d: ops.family_sizes(_genomes(s, d)), oracle(f"WITH g AS ({GENOMES}) SELECT gene_family_id, count(*) AS size, count(DISTINCT assembly_id) AS genome_present FROM g WHERE gene_family_id IS NOT NULL GROUP BY 1")),
    "d2_og_sizes": (lambda s, d: ops.og_sizes(view(s, d, "orthologous_groups"), _lineages(s, d).select("rlocds_id", "genome"), view(s, d, "lineage_families"), 1), oracle("WITH m AS (SELECT l.rlocds_id, l.gene_family_id, a.species AS genome FROM lineage_families l JOIN assemblies a ON a.assembly_id = l.rlocds_id) SELECT o.gene_family_id, CAST(o.og_id AS INT) AS og_id, count(*) AS size, count(DISTINCT genome) AS genome_present FROM orthologous_groups o JOIN m USING (rlocds_id) WHERE ortholog_col_id = 1 GROUP BY 1, 2 UNION ALL SELECT gene_family_id, NULL, count(*), count(DISTINCT genome) FROM m WHERE gene_family_id NOT IN (SELECT gene_family_id FROM orthologous_groups WHERE ortholog_col_id = 1) GROUP BY 1")),
    "d3_family_dims": (lambda s, d: ops.family_dims(view(s, d, "coding_sequences"), 1), oracle("SELECT gene_family_id, count(*) = 1 AS is_singleton, gene_family_id = 1 AS is_orfan FROM coding_sequences WHERE gene_family_id IS NOT NULL GROUP BY 1")),
    "d4_gene_counts": (_by_genome, oracle(f"WITH {BY_GENOME} SELECT * FROM n")),
    "a23_matrix": (lambda s, d: ops.matrix(_by_taxon(s, d), range(25)), oracle(f"WITH {BY_TAXON} SELECT gene_family_id, " + ", ".join(f"CAST(coalesce(sum(n) FILTER (genome = {i}), 0) AS BIGINT) AS g{i}" for i in range(25)) + " FROM n GROUP BY 1")),
    "d5_og_counts": (lambda s, d: ops.og_counts(_lineages(s, d), view(s, d, "orthologous_groups")), oracle("WITH m AS (SELECT l.rlocds_id, l.gene_family_id, a.species AS genome FROM lineage_families l JOIN assemblies a ON a.assembly_id = l.rlocds_id), c AS (SELECT m.gene_family_id, CAST(og_id AS INT) AS og_id, genome, count(*) AS n, m.gene_family_id || coalesce('-' || og_id, '') AS row_label FROM m LEFT JOIN orthologous_groups o USING (rlocds_id) GROUP BY ALL) SELECT *, count(*) OVER (PARTITION BY row_label) = 1 AS one_genome FROM c")),
    "d6_plasmid_families": (lambda s, d: ops.replicon_families(_genomes(s, d), "plasmid", 5), oracle(f"WITH g AS ({GENOMES}), c AS (SELECT gene_family_id, genomic_accession, count(*) AS n FROM g WHERE replicon_type = 'plasmid' AND gene_family_id IS NOT NULL GROUP BY 1, 2) SELECT * FROM c WHERE gene_family_id IN (SELECT gene_family_id FROM c GROUP BY 1 HAVING count(*) >= 5)")),
    "d7_core_families": (lambda s, d: ops.core_families(ops.gene_counts(_genomes(s, d).withColumn("gene_family_id", F.col("gene_family_id") % 7), "species").withColumn("n", F.least("n", F.lit(1))), 5), oracle(f"WITH g AS ({GENOMES}) SELECT gene_family_id % 7 AS gene_family_id FROM g WHERE gene_family_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT species) = 5")),
    "d8_pseudo_core": (lambda s, d: ops.pseudo_core(_by_genome(s, d), [20, 25, 30]), oracle(f"WITH {UNICOPY} SELECT gene_family_id, present, p AS min_genomes FROM u, (VALUES (20), (25), (30)) v(p) WHERE present >= p")),
    "d9_presence_cumulative": (lambda s, d: ops.presence_cumulative(_by_genome(s, d)), oracle(f"WITH {UNICOPY} SELECT p.present AS n_genomes, count(*) AS n_families FROM (SELECT DISTINCT present FROM u) p JOIN u ON u.present >= p.present GROUP BY 1")),
    "d10_missing_markers": (lambda s, d: ops.missing_markers(_by_genome(s, d), ops.unicopy_presence(_by_genome(s, d)).where("present >= 25"), view(s, d, "assemblies").select(F.col("assembly_id").alias("genome"))), oracle(f"WITH {UNICOPY}, f AS (SELECT gene_family_id FROM u WHERE present >= 25) SELECT assembly_id AS genome, (SELECT count(*) FROM f) - count(h.genome) AS n_missing FROM assemblies LEFT JOIN (SELECT genome FROM n JOIN f USING (gene_family_id)) h ON h.genome = assembly_id GROUP BY 1")),
    "d10_most_missing": (lambda s, d: ops.missing_markers(_by_genome(s, d), ops.unicopy_presence(_by_genome(s, d)).where("present >= 25"), view(s, d, "assemblies").select(F.col("assembly_id").alias("genome")), 20), oracle(f"WITH {UNICOPY}, f AS (SELECT gene_family_id FROM u WHERE present >= 25) SELECT assembly_id AS genome, (SELECT count(*) FROM f) - count(h.genome) AS n_missing FROM assemblies LEFT JOIN (SELECT genome FROM n JOIN f USING (gene_family_id)) h ON h.genome = assembly_id GROUP BY 1 ORDER BY n_missing DESC, genome LIMIT 20")),
    "f7_family_bands": (lambda s, d: ops.family_bands(ops.family_sizes(_genomes(s, d)), [(4, 24), (25, 34), (35, None)]), oracle(f"WITH g AS ({GENOMES}), z AS (SELECT gene_family_id, count(*) AS size, count(DISTINCT assembly_id) AS genome_present FROM g WHERE gene_family_id IS NOT NULL GROUP BY 1) SELECT *, CASE WHEN size < 25 THEN 1 WHEN size < 35 THEN 2 ELSE 3 END AS band FROM z WHERE size >= 4")),
    "b20_pangenome_class": (lambda s, d: ops.pangenome_class(ops.family_sizes(_genomes(s, d))), oracle(f"WITH g AS ({GENOMES}), z AS (SELECT gene_family_id, count(*) AS size, count(DISTINCT assembly_id) AS genome_present FROM g WHERE gene_family_id IS NOT NULL GROUP BY 1) SELECT *, CASE WHEN genome_present >= 0.98 * max(genome_present) OVER () THEN 'core' ELSE 'accessory' END AS pangenome, CASE WHEN (size - genome_present) / genome_present <= 0.10 THEN 'single-copy' ELSE 'multi-copy' END AS copies FROM z")),
    "h1_jaccard": (lambda s, d: ops.jaccard_distances(_by_taxon(s, d)), oracle(f"WITH {BY_TAXON}, p AS (SELECT * FROM n), z AS (SELECT genome, count(*) AS c FROM p GROUP BY 1), k AS (SELECT a.genome AS genome_1, b.genome AS genome_2, count(*) AS k FROM p a JOIN p b ON a.gene_family_id = b.gene_family_id AND a.genome < b.genome GROUP BY 1, 2) SELECT genome_1, genome_2, round(1 - k / (x.c + y.c - k), 9) AS distance FROM k JOIN z x ON x.genome = genome_1 JOIN z y ON y.genome = genome_2")),
    "h2_bray_curtis": (lambda s, d: ops.bray_curtis(_by_taxon(s, d)), oracle(f"WITH {BY_TAXON}, z AS (SELECT genome, sum(n) AS c FROM n GROUP BY 1), k AS (SELECT a.genome AS genome_1, b.genome AS genome_2, sum(least(a.n, b.n)) AS k FROM n a JOIN n b ON a.gene_family_id = b.gene_family_id AND a.genome < b.genome GROUP BY 1, 2) SELECT genome_1, genome_2, round(1 - 2 * k / (x.c + y.c), 9) AS distance FROM k JOIN z x ON x.genome = genome_1 JOIN z y ON y.genome = genome_2")),
    "e1_specific_presence": (lambda s, d: ops.specific_presence(_by_taxon(s, d), view(s, d, "clade_members"), 0.4), oracle(f"WITH {SIDES} SELECT clade, gene_family_id, has_in, has_out FROM s WHERE n_in - has_in <= round_even(n_in * 0.4, 0) AND has_out <= round_even(n_out * 0.4, 0)")),
    "e2_specific_absence": (lambda s, d: ops.specific_absence(_by_taxon(s, d), view(s, d, "clade_members"), 0.4), oracle(f"WITH {SIDES} SELECT clade, gene_family_id, has_in, has_out FROM s WHERE has_in <= round_even(n_in * 0.4, 0) AND n_out - has_out <= round_even(n_out * 0.4, 0)")),
    "e3_reference_genomes": (lambda s, d: ops.reference_genomes(view(s, d, "populations"), [7, 12, 3]), oracle("SELECT clade, arg_min(genome, CASE genome WHEN 7 THEN 1 WHEN 12 THEN 2 WHEN 3 THEN 3 ELSE 4 + genome END) AS genome FROM populations GROUP BY 1")),
    "e6_breaches": (lambda s, d: ops.breaches(_by_taxon(s, d), view(s, d, "clade_members"), ops.specific_presence(_by_taxon(s, d), view(s, d, "clade_members"), 0.4).select("clade", "gene_family_id")), oracle(f"WITH {SIDES}, p AS (SELECT clade, gene_family_id FROM s WHERE n_in - has_in <= round_even(n_in * 0.4, 0) AND has_out <= round_even(n_out * 0.4, 0)) SELECT clade, gene_family_id, string_agg(DISTINCT CAST(genome AS VARCHAR), ',' ORDER BY CAST(genome AS VARCHAR)) AS genomes FROM p JOIN n USING (gene_family_id) JOIN clade_members c USING (clade, genome) WHERE c.side = 'contrast' GROUP BY 1, 2")),
    "d17_annotation_lines": (lambda s, d: ops.annotation_lines(view(s, d, "functional_annotations"), view(s, d, "interpro2go")), oracle("SELECT nr_protein_id, string_agg(DISTINCT go_id, '|' ORDER BY go_id) AS go_terms FROM functional_annotations JOIN interpro2go USING (interpro_id) GROUP BY 1")),
    "d17_pathway_lines": (lambda s, d: ops.pathway_lines(view(s, d, "functional_annotations"), table(s, d, "part").select(F.concat("p_brand", F.lit("/"), "p_type").alias("interpro_id"), F.element_at(F.split("p_name", " "), 2).alias("db"), F.col("p_size").alias("pathway_id")).distinct()), oracle("WITH w AS (SELECT DISTINCT concat(p_brand, '/', p_type) AS interpro_id, concat(string_split(p_name, ' ')[2], ':', p_size) AS pathway FROM part WHERE p_name LIKE '% %' AND p_size IS NOT NULL) SELECT nr_protein_id, string_agg(DISTINCT pathway, '|' ORDER BY pathway) AS pathways FROM functional_annotations JOIN w USING (interpro_id) GROUP BY 1")),
    "d28_enrichment": (lambda s, d: ops.enrichment(view(s, d, "coding_sequences").where("gene_family_id IS NOT NULL AND l_quantity >= 45").select((F.col("l_suppkey") % 5).alias("study"), F.col("gene_family_id").alias("gene")), view(s, d, "proteins").select(F.col("nr_protein_id").alias("gene"), F.col("protein_family_id").alias("term"))), oracle("""WITH pop AS (SELECT nr_protein_id AS gene, protein_family_id AS term FROM proteins), st AS (SELECT DISTINCT l_suppkey % 5 AS study, gene_family_id AS gene FROM coding_sequences WHERE gene_family_id IS NOT NULL AND l_quantity >= 45),
t AS (SELECT count(*) AS a FROM pop), m AS (SELECT term, count(*) AS m FROM pop GROUP BY 1), n AS (SELECT study, count(*) AS n FROM st GROUP BY 1), k AS (SELECT study, term, count(*) AS k FROM st JOIN pop USING (gene) GROUP BY 1, 2),
x AS (SELECT *, unnest(generate_series(k, least(n, m))) AS i FROM k JOIN n USING (study) JOIN m USING (term), t)
SELECT study, term, k, n, m, a AS "all", round(least(1.0, sum(exp(lgamma(m + 1) - lgamma(i + 1) - lgamma(m - i + 1) + lgamma(a - m + 1) - lgamma(n - i + 1) - lgamma(a - m - n + i + 1) - lgamma(a + 1) + lgamma(n + 1) + lgamma(a - n + 1)))), 9) AS p FROM x GROUP BY 1, 2, 3, 4, 5, 6""")),
}

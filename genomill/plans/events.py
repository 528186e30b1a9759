"""Queries over events on branches, scores of lineage pairs and genes in order."""

from __future__ import annotations

from pyspark.sql import functions as F

from genomill.operators import counting
from genomill.operators import events as ops
from genomill.operators.coevolution import lineage_matches
from genomill.plans.coevolution import D15_SQL, d15_coevolution_scores
from genomill.plans.counting import BY_TAXON, GENOMES, SIDES, _by_taxon, _genomes
from genomill.plans.views import oracle, table, view

PROBS = [0.0, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]
EV = "ev AS (SELECT e.*, r.branch_name AS rec_branch, d.branch_name AS don_branch FROM species_tree_events e JOIN species_tree r ON r.branch_id = rec_branch_id LEFT JOIN species_tree d ON d.branch_id = don_branch_id)"
DENSITY = f"{EV}, dens AS (SELECT don_branch, rec_branch, event_type, count(*) AS n_lineages, sum(freq) / 100 AS cum_freq, round(avg(freq) / 100, 9) AS mean_freq FROM gene_lineage_events JOIN ev USING (event_id) WHERE freq >= 25 GROUP BY 1, 2, 3)"
SCORES = f"scores AS ({D15_SQL})"
PLACES = "places AS (SELECT rlocds_id, gene_family_id AS replicon, rlocds_id * 37 % 1000 AS place, 1000 AS size FROM lineage_families)"
SAME = f"{PLACES}, {SCORES.replace('>= 5000', '>= 500').replace('WHERE fa.gene_family_id <> fb.gene_family_id', 'WHERE a.rlocds_id <> b.rlocds_id AND fa.gene_family_id = fb.gene_family_id')}, same AS (SELECT rlocds_id_1, rlocds_id_2, a.replicon, score, least(abs(a.place - b.place), 1000 - abs(a.place - b.place)) AS distance FROM scores JOIN places a ON a.rlocds_id = rlocds_id_1 JOIN places b ON b.rlocds_id = rlocds_id_2 AND a.replicon = b.replicon)"
CONDENSE = SCORES + """, x AS (SELECT s.*, {'fam': a.gene_family_id, 'og': a.og_id} AS g1, {'fam': b.gene_family_id, 'og': b.og_id} AS g2 FROM scores s JOIN orthologous_groups a ON a.rlocds_id = rlocds_id_1 JOIN orthologous_groups b ON b.rlocds_id = rlocds_id_2 WHERE a.gene_family_id <> b.gene_family_id),
pairs AS (SELECT rlocds_id_1, rlocds_id_2, score, least(g1, g2).fam AS fam1, least(g1, g2).og AS og1, greatest(g1, g2).fam AS fam2, greatest(g1, g2).og AS og2 FROM x)"""
GO = "go AS (SELECT nr_protein_id, go_id FROM functional_annotations JOIN interpro2go USING (interpro_id))"


def _events(s, d):
    return ops.events_with_branches(view(s, d, "species_tree_events"), view(s, d, "species_tree"))


def _density(s, d):
    return ops.event_density(view(s, d, "gene_lineage_events"), _events(s, d), 100, 0.25)


def _pairs(s, d):
    return ops.og_pair_scores(d15_coevolution_scores(s, d), view(s, d, "orthologous_groups"), 1)


def _same(s, d):
    from genomill.operators.coevolution import coevolution_scores

    places = view(s, d, "lineage_families").select("rlocds_id", F.col("gene_family_id").alias("replicon"), (F.col("rlocds_id") * 37 % 1000).alias("place"), F.lit(1000).alias("size"))
    scores = coevolution_scores(view(s, d, "gene_lineage_events"), 100, view(s, d, "lineage_families"), "within_fams", 0.05).where("rlocds_id_1 <> rlocds_id_2")
    return ops.same_replicon_pairs(scores, places)


def _go(s, d):
    return view(s, d, "functional_annotations").join(view(s, d, "interpro2go"), "interpro_id").select("nr_protein_id", "go_id")


def _named(s, d):
    return _genomes(s, d).join(view(s, d, "proteins").select("nr_protein_id", "product"), "nr_protein_id")


def d13_lineage_event_freq(s, d):
    sampled = table(s, d, "lineitem").join(table(s, d, "orders"), F.expr("l_orderkey = o_orderkey")).select(F.col("o_custkey").alias("label"), F.col("l_linenumber").alias("sample"), F.col("l_partkey").alias("event_id"))
    return ops.lineage_event_freq(sampled, 7, 0.25)


def d24_match_stats(s, d):
    return ops.match_stats(lineage_matches(view(s, d, "gene_lineage_events"), view(s, d, "lineage_families")), 100, [0.1, 0.3])


def c13_og_pairs_on_replicons(s, d):
    genes = view(s, d, "orthologous_groups").join(view(s, d, "assemblies").select(F.col("assembly_id").alias("rlocds_id"), "species"), "rlocds_id")
    genes = genes.select("gene_family_id", "og_id", F.col("rlocds_id").alias("cds_code"), F.col("species").alias("replicon"), F.lit(1000).alias("size"), (F.col("rlocds_id") * 37 % 1000).alias("place"))
    return ops.og_pairs_on_replicons(_pairs(s, d).select("fam1", "og1", "fam2", "og2").distinct(), genes, 60)


def d20_lineage_genes(s, d):
    top = ops.top_associations(d15_coevolution_scores(s, d), least=0.6)
    lineages = top.select(F.explode(F.array("rlocds_id_1", "rlocds_id_2")).alias("rlocds_id"))
    return ops.lineage_genes(lineages, _named(s, d).select(F.col("assembly_id").alias("rlocds_id"), "product", "genomic_accession", "replicon_type", "gene_family_id"))


def e5_specific_details(s, d):
    return ops.specific_details(counting.specific_presence(_by_taxon(s, d), view(s, d, "clade_members"), 0.4), view(s, d, "proteins"), _go(s, d))


QUERIES = {
    "c9_events_with_branches": (lambda s, d: _events(s, d).select("event_id", "event_type", "don_branch", "rec_branch"), oracle(f"WITH {EV} SELECT event_id, event_type, don_branch, rec_branch FROM ev")),
    "c10_events_excluding": (lambda s, d: ops.events_excluding(view(s, d, "species_tree_events"), view(s, d, "species_tree"), ["N1", "N2", "Supplier#000000003"]).select("event_id", "rec_branch"), oracle(f"WITH {EV} SELECT event_id, rec_branch FROM ev WHERE rec_branch NOT IN ('N1', 'N2', 'Supplier#000000003')")),
    "d11_event_density": (_density, oracle(f"WITH {DENSITY} SELECT * FROM dens")),
    "d12_event_density_by_recipient": (lambda s, d: ops.event_density_by(_density(s, d), "rec"), oracle(f"WITH {DENSITY} SELECT event_type, rec_branch, CAST(sum(n_lineages) AS BIGINT) AS n_lineages, round(sum(cum_freq), 6) AS cum_freq FROM dens GROUP BY 1, 2")),
    "d12_event_density_by_donor": (lambda s, d: ops.event_density_by(_density(s, d), "don"), oracle(f"WITH {DENSITY} SELECT event_type, don_branch, CAST(sum(n_lineages) AS BIGINT) AS n_lineages, round(sum(cum_freq), 6) AS cum_freq FROM dens WHERE don_branch IS NOT NULL GROUP BY 1, 2")),
    "d13_lineage_event_freq": (d13_lineage_event_freq, "SELECT o_custkey AS label, l_partkey AS event_id, count(DISTINCT l_linenumber) AS freq FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2 HAVING count(DISTINCT l_linenumber) >= 1.75"),
    "d14_family_event_freq": (lambda s, d: ops.family_event_freq(view(s, d, "og_samples").withColumnRenamed("og", "event_id"), 7), oracle("SELECT family, og AS event_id, count(*) / 7 AS freq FROM og_samples GROUP BY 1, 2")),
    "f10_scenario_projection": (lambda s, d: ops.scenario_projection(view(s, d, "gene_lineage_events"), _events(s, d), 100), oracle(f"WITH {EV} SELECT rlocds_id, event_type, don_branch, rec_branch, sum(freq) / 100 AS freq FROM gene_lineage_events JOIN ev USING (event_id) GROUP BY 1, 2, 3, 4")),
    "d24_match_stats": (d24_match_stats, oracle("SELECT a.rlocds_id AS rlocds_id_1, b.rlocds_id AS rlocds_id_2, count(*) AS n_shared, sum(a.freq + b.freq) / 200 AS sum_mean, sum(a.freq * b.freq) / 10000 AS sum_joint, " + ", ".join(f"count(*) FILTER (least(a.freq, b.freq) >= {t}) AS n_shared_{i}, coalesce(sum(a.freq * b.freq) FILTER (least(a.freq, b.freq) >= {t}), 0) / 10000 AS sum_joint_{i}" for i, t in ((1, 10), (2, 30))) + " FROM gene_lineage_events a JOIN gene_lineage_events b ON a.event_id = b.event_id AND b.rlocds_id > a.rlocds_id JOIN lineage_families fa ON fa.rlocds_id = a.rlocds_id JOIN lineage_families fb ON fb.rlocds_id = b.rlocds_id WHERE fa.gene_family_id <> fb.gene_family_id GROUP BY 1, 2")),
    "c15_og_pair_scores": (_pairs, oracle(f"WITH {CONDENSE} SELECT * FROM pairs")),
    "d16_condense_scores": (lambda s, d: ops.condense_scores(_pairs(s, d)), oracle(f"""WITH {CONDENSE}, k AS (SELECT fam1, og1, fam2, og2, count(*) AS n_links FROM pairs GROUP BY ALL), b AS (SELECT fam1, og1, fam2, og2, l, max(score) AS best FROM (SELECT *, rlocds_id_1 AS l FROM pairs UNION ALL SELECT *, rlocds_id_2 FROM pairs) GROUP BY ALL)
SELECT fam1, og1, fam2, og2, any_value(n_links) AS n_links, count(*) AS n_best, round(avg(best), 9) AS mean, round(min(best), 9) AS "min", round(quantile_cont(best, 0.25), 9) AS q25, round(quantile_cont(best, 0.5), 9) AS q50, round(quantile_cont(best, 0.75), 9) AS q75, round(max(best), 9) AS "max" FROM b JOIN k USING (fam1, og1, fam2, og2) GROUP BY 1, 2, 3, 4""")),
    "d32_score_quantiles": (lambda s, d: ops.score_quantiles(d15_coevolution_scores(s, d), PROBS), oracle(f"WITH {SCORES} " + " UNION ALL ".join(f"SELECT {p}::DOUBLE AS prob, round(quantile_cont(score, {p}), 9) AS value FROM scores" for p in PROBS))),
    "f4_top_associations": (lambda s, d: ops.top_associations(d15_coevolution_scores(s, d), quantile=0.9), oracle(f"WITH {SCORES} SELECT * FROM scores WHERE score >= (SELECT quantile_cont(score, 0.9) FROM scores)")),
    "c13_same_replicon_pairs": (_same, oracle(f"WITH {SAME} SELECT * FROM same")),
    "c13_og_pairs_on_replicons": (c13_og_pairs_on_replicons, oracle(f"WITH {CONDENSE}, p AS (SELECT DISTINCT fam1, og1, fam2, og2 FROM pairs), w AS (SELECT o.gene_family_id AS fam, og_id AS og, rlocds_id AS cds, species AS replicon, 1000 AS size, rlocds_id * 37 % 1000 AS place FROM orthologous_groups o JOIN assemblies ON assembly_id = rlocds_id), m AS (SELECT fam1, og1, fam2, og2, a.replicon, a.cds AS cds_code_1, b.cds AS cds_code_2, least(abs(a.place - b.place), 1000 - abs(a.place - b.place)) AS distance FROM p JOIN w a ON a.fam = fam1 AND a.og = og1 JOIN w b ON b.fam = fam2 AND b.og = og2 AND b.replicon = a.replicon) SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY replicon ORDER BY md5(cds_code_1 || '/' || cds_code_2), cds_code_1, cds_code_2, fam1, og1, fam2, og2) <= 60")),
    "f5_row_sums": (lambda s, d: ops.row_sums(_same(s, d), 50), oracle(f"WITH {SAME} SELECT replicon, rlocds_id, round(sum(score), 6) AS total, round(coalesce(sum(score) FILTER (distance > 50), 0), 6) AS far FROM (SELECT *, rlocds_id_1 AS rlocds_id FROM same UNION ALL SELECT *, rlocds_id_2 FROM same) GROUP BY 1, 2")),
    "h3_score_distance_fit": (lambda s, d: ops.score_distance_fit(_same(s, d)), oracle(f"WITH {SAME} SELECT replicon, count(*) AS n, round(regr_slope(score, distance), 9) AS slope, round(regr_intercept(score, distance), 9) AS intercept FROM same GROUP BY 1")),
    "d18_lineage_annotation": (lambda s, d: ops.lineage_annotation(_named(s, d), "assembly_id"), oracle(f"WITH g AS ({GENOMES}) SELECT assembly_id, max(product) AS product, count(*) AS n_genes, count(DISTINCT assembly_id) AS n_genomes, count(*) FILTER (replicon_type = 'chromosome') AS n_chromosome, count(*) FILTER (replicon_type = 'plasmid') AS n_plasmid, CASE WHEN count(DISTINCT replicon_type) = 2 THEN 'both' ELSE max(replicon_type) END AS replicons FROM g JOIN proteins USING (nr_protein_id) GROUP BY 1")),
    "d19_family_annotation": (lambda s, d: ops.lineage_annotation(_named(s, d), "gene_family_id").where("gene_family_id IS NOT NULL"), oracle(f"WITH g AS ({GENOMES}) SELECT gene_family_id, max(product) AS product, count(*) AS n_genes, count(DISTINCT assembly_id) AS n_genomes, count(*) FILTER (replicon_type = 'chromosome') AS n_chromosome, count(*) FILTER (replicon_type = 'plasmid') AS n_plasmid, CASE WHEN count(DISTINCT replicon_type) = 2 THEN 'both' ELSE max(replicon_type) END AS replicons FROM g JOIN proteins USING (nr_protein_id) WHERE gene_family_id IS NOT NULL GROUP BY 1")),
    "d19_group_annotation": (lambda s, d: ops.lineage_annotation(_named(s, d).drop("gene_family_id").join(view(s, d, "orthologous_groups").select(F.col("rlocds_id").alias("assembly_id"), "gene_family_id", "og_id"), "assembly_id"), "gene_family_id", "og_id"), oracle(f"WITH g AS ({GENOMES}) SELECT o.gene_family_id, og_id, max(product) AS product, count(*) AS n_genes, count(DISTINCT assembly_id) AS n_genomes, count(*) FILTER (replicon_type = 'chromosome') AS n_chromosome, count(*) FILTER (replicon_type = 'plasmid') AS n_plasmid, CASE WHEN count(DISTINCT replicon_type) = 2 THEN 'both' ELSE max(replicon_type) END AS replicons FROM g JOIN proteins USING (nr_protein_id) JOIN orthologous_groups o ON o.rlocds_id = assembly_id GROUP BY 1, 2")),
    "d20_lineage_genes": (d20_lineage_genes, oracle(f"WITH {SCORES}, g AS ({GENOMES}), t AS (SELECT rlocds_id_1 AS r FROM scores WHERE score >= 0.6 UNION SELECT rlocds_id_2 FROM scores WHERE score >= 0.6) SELECT DISTINCT assembly_id AS rlocds_id, product, genomic_accession, replicon_type, gene_family_id FROM g JOIN proteins USING (nr_protein_id) JOIN t ON r = assembly_id")),
    "f2_adjacent_genes": (lambda s, d: ops.adjacent_genes(view(s, d, "ordered_genes").withColumn("replicon", F.concat_ws("/", "replicon", "event")), 2), oracle("SELECT * FROM (SELECT concat(replicon, '/', event) AS replicon, gene_rank AS gene_1, lead(gene_rank) OVER (PARTITION BY replicon, event ORDER BY gene_rank) AS gene_2 FROM ordered_genes) WHERE gene_2 - gene_1 <= 2")),
    "f3_event_blocks": (lambda s, d: ops.event_blocks(view(s, d, "ordered_genes"), 2), oracle("WITH l AS (SELECT *, coalesce(gene_rank - lag(gene_rank) OVER (PARTITION BY replicon, event ORDER BY gene_rank) > 3, false) AS begins FROM ordered_genes), b AS (SELECT *, sum(begins::INT) OVER (PARTITION BY replicon, event ORDER BY gene_rank) AS block FROM l) SELECT replicon, event, min(gene_rank) AS first_gene, max(gene_rank) AS last_gene, count(*) AS n_genes, round(sum(freq), 6) AS sum_freq, min(freq) AS min_freq, max(freq) AS max_freq, round(avg(freq), 6) AS mean_freq, round(median(freq), 6) AS median_freq FROM b GROUP BY replicon, event, block")),
    "d25_core_background": (lambda s, d: ops.core_background(counting.cds_codes(_genomes(s, d)), _go(s, d), 29), oracle(f"WITH g AS ({GENOMES}), {GO}, c AS (SELECT gene_family_id, min(code || '_' || cds_no) AS cds_code FROM g WHERE gene_family_id IS NOT NULL GROUP BY 1 HAVING count(*) = 29 AND count(DISTINCT assembly_id) = 29) SELECT DISTINCT gene_family_id, cds_code, go_id FROM c JOIN go ON nr_protein_id = gene_family_id")),
    "d27_pan_background": (lambda s, d: ops.pan_background(_genomes(s, d), _go(s, d), view(s, d, "clade_members")), oracle(f"WITH {BY_TAXON}, {GO} SELECT DISTINCT clade, gene_family_id, go_id FROM n JOIN clade_members USING (genome) LEFT JOIN go ON nr_protein_id = gene_family_id WHERE side = 'clade'")),
    "e5_specific_details": (e5_specific_details, oracle(f"WITH {SIDES}, {GO} SELECT DISTINCT clade, gene_family_id, product, go_id FROM s LEFT JOIN proteins p ON p.nr_protein_id = gene_family_id LEFT JOIN go ON go.nr_protein_id = gene_family_id WHERE n_in - has_in <= round_even(n_in * 0.4, 0) AND has_out <= round_even(n_out * 0.4, 0)")),
}

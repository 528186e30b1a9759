"""Queries over graphs and sequence tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from genomill.operators import graphs as ops
from genomill.operators import sequences as seqs
from genomill.operators.trees import settle
from genomill.plans.coevolution import D15_SQL, d15_coevolution_scores
from genomill.plans.views import oracle, view

ROUNDS = 3
FREQ = "f AS (SELECT family, a, b, count(*) AS freq FROM (SELECT x.family, x.gene AS a, y.gene AS b FROM og_samples x JOIN og_samples y ON x.family = y.family AND x.sample = y.sample AND x.og = y.og AND x.gene < y.gene UNION ALL SELECT family, min(gene), min(gene) FROM og_samples GROUP BY family, sample, og HAVING count(*) = 1) GROUP BY 1, 2, 3)"
GRAPH = f"e AS (SELECT rlocds_id_1 AS a, rlocds_id_2 AS b, score AS weight FROM ({D15_SQL})), u AS (SELECT a, b, weight FROM e UNION ALL SELECT b, a, weight FROM e), l0 AS (SELECT DISTINCT a AS node, a AS community FROM u)"
LABELS = GRAPH + "".join(f", w{i} AS (SELECT a, community, round(sum(weight), 6) AS w FROM u JOIN l{i} ON node = b GROUP BY 1, 2), l{i + 1} AS (SELECT a AS node, community FROM w{i} QUALIFY row_number() OVER (PARTITION BY a ORDER BY w DESC, community) = 1)" for i in range(ROUNDS)) + f", inside AS (SELECT x.community, a, b, weight FROM e JOIN l{ROUNDS} x ON x.node = a JOIN l{ROUNDS} y ON y.node = b AND x.community = y.community)"
CLUSTERS = "c AS (SELECT family || '/' || genome || '/' || CAST(length(seq) AS VARCHAR) AS cluster, seq_id AS member FROM sequences WHERE seq IS NOT NULL AND family IS NOT NULL AND genome IS NOT NULL)"


def _edges(s, d):
    return ops.majority_edges(ops.og_edge_freq(view(s, d, "og_samples")), 0.15, 7)


def _graph(s, d):
    return d15_coevolution_scores(s, d).toDF("a", "b", "weight")


def _communities(s, d):
    return ops.label_propagation(_graph(s, d), ROUNDS)


def _divided(s, d):
    """The graph and its communities; its scores are computed once."""
    graph = settle(_graph(s, d))
    return graph, ops.label_propagation(graph, ROUNDS)


def _clusters(s, d):
    return view(s, d, "sequences").where("seq IS NOT NULL AND family IS NOT NULL AND genome IS NOT NULL").select(F.concat_ws("/", "family", "genome", F.length("seq").cast("string")).alias("cluster"), F.col("seq_id").alias("member"))


def g5_partition_agreement(s, d):
    named = view(s, d, "lineage_families").join(view(s, d, "assemblies").select(F.col("assembly_id").alias("rlocds_id"), "species"), "rlocds_id").select(F.col("gene_family_id").alias("family"), F.col("species").alias("og"), F.col("rlocds_id").alias("member"))
    groups = view(s, d, "orthologous_groups").select(F.col("gene_family_id").alias("family"), F.col("og_id").alias("og"), F.col("rlocds_id").alias("member"))
    return ops.partition_agreement(named, groups)


QUERIES = {
    "i1_og_edge_freq": (lambda s, d: ops.og_edge_freq(view(s, d, "og_samples")), oracle(f"WITH {FREQ} SELECT * FROM f")),
    "i2_majority_edges": (_edges, oracle(f"WITH {FREQ} SELECT * FROM f WHERE freq > 0.15 * 7")),
    "i3_components": (lambda s, d: ops.components(_edges(s, d), ("family",)), oracle(f"WITH RECURSIVE {FREQ}, g AS (SELECT family, a, b FROM f WHERE freq > 0.15 * 7), u AS (SELECT * FROM g UNION SELECT family, b, a FROM g), r AS (SELECT family, a AS node, a AS other FROM u UNION SELECT r.family, node, b FROM r JOIN u ON u.family = r.family AND u.a = other) SELECT family, node, min(other) AS component FROM r GROUP BY 1, 2")),
    "i5_label_propagation": (_communities, oracle(f"WITH {LABELS} SELECT * FROM l{ROUNDS}")),
    "i6_association_graph": (lambda s, d: ops.association_graph(_graph(s, d)), oracle(f"WITH {GRAPH} SELECT a AS node, count(*) AS degree, round(sum(weight), 6) AS strength FROM u GROUP BY 1")),
    "i8_community_edges": (lambda s, d: ops.community_edges(*_divided(s, d)), oracle(f"WITH {LABELS} SELECT * FROM inside")),
    "i9_small_communities": (lambda s, d: ops.small_communities(_communities(s, d), 50), oracle(f"WITH {LABELS} SELECT * FROM l{ROUNDS} QUALIFY count(*) OVER (PARTITION BY community) <= 50")),
    "i12_community_families": (lambda s, d: ops.community_families(_communities(s, d), view(s, d, "lineage_families").toDF("node", "family")), oracle(f"WITH {LABELS} SELECT DISTINCT community, gene_family_id AS family FROM l{ROUNDS} JOIN lineage_families ON rlocds_id = node")),
    "h5_community_cohesion": (lambda s, d: ops.community_cohesion(*_divided(s, d)), oracle(f"WITH {LABELS} SELECT community, count(*) AS n_edges, round(median(weight), 9) AS median_weight FROM inside GROUP BY 1")),
    "g5_partition_agreement": (g5_partition_agreement, oracle("WITH x AS (SELECT list_sort(list(rlocds_id)) AS k FROM lineage_families JOIN assemblies ON assembly_id = rlocds_id GROUP BY gene_family_id, species), y AS (SELECT list_sort(list(rlocds_id)) AS k FROM orthologous_groups GROUP BY gene_family_id, og_id) SELECT (SELECT count(*) FROM x) AS n_first, (SELECT count(*) FROM y) AS n_second, (SELECT count(*) FROM x JOIN y USING (k)) AS n_identical")),
    "k1_dereplicate": (lambda s, d: seqs.dereplicate(view(s, d, "sequences"), ["genome", "family"], "seq_id").select("genome", "family", "seq_id"), oracle("SELECT genome, family, min(seq_id) AS seq_id FROM sequences GROUP BY 1, 2")),
    "k2_identical_groups": (lambda s, d: seqs.identical_groups(view(s, d, "sequences")), oracle("SELECT sha256(seq) AS digest, min(seq_id) AS representative, count(*) AS n FROM sequences GROUP BY 1")),
    "k3_groups_as_lists": (lambda s, d: seqs.groups_as_lists(view(s, d, "sequences")), oracle("SELECT min(seq_id) AS representative, string_agg(seq_id, ',' ORDER BY seq_id) AS members FROM sequences GROUP BY seq HAVING count(*) > 1")),
    "k4_non_redundant": (lambda s, d: seqs.dereplicate(view(s, d, "sequences"), ["seq"], "seq_id").groupBy("genome").agg(F.count("*").alias("n"), F.sum("seq_id").alias("sum_ids")), oracle("SELECT genome, count(*) AS n, CAST(sum(seq_id) AS BIGINT) AS sum_ids FROM (SELECT seq, min(seq_id) AS seq_id, arg_min(genome, seq_id) AS genome FROM sequences GROUP BY 1) GROUP BY 1")),
    "f8_representatives": (lambda s, d: seqs.representatives(view(s, d, "sequences"), "genome", view(s, d, "sequences").where("length(seq) > 5000").select("seq_id")), oracle("SELECT genome, arg_min(seq_id, {'a': CASE WHEN length(seq) > 5000 THEN 0 ELSE 1 END, 'b': seq_id}) AS representative FROM sequences GROUP BY 1")),
    "f1_family_ids": (lambda s, d: seqs.assign_family_ids(_clusters(s, d), "FAM", 6), oracle(f"WITH {CLUSTERS}, z AS (SELECT cluster, row_number() OVER (ORDER BY cluster) AS no FROM (SELECT cluster FROM c GROUP BY 1 HAVING count(*) > 1)) SELECT cluster, member, 'FAM' || lpad(CAST(coalesce(no, 0) AS VARCHAR), 6, '0') AS family_id FROM c LEFT JOIN z USING (cluster)")),
    "k5_carry_over_ids": (lambda s, d: seqs.carry_over_ids(_clusters(s, d), view(s, d, "sequences").where("length(seq) > 2000").select(F.col("seq_id").alias("member"), (F.length("seq") % 97).alias("family_no"))), oracle(f"WITH {CLUSTERS}, p AS (SELECT seq_id AS member, length(seq) % 97 AS family_no FROM sequences WHERE length(seq) > 2000), m AS (SELECT cluster, min(family_no) AS lo, max(family_no) AS hi FROM c LEFT JOIN p USING (member) GROUP BY 1) SELECT cluster, CASE WHEN lo = hi THEN lo END AS family_no, lo <> hi AS conflict FROM m WHERE lo IS NOT NULL UNION ALL SELECT cluster, row_number() OVER (ORDER BY cluster) + (SELECT coalesce(max(family_no), 0) FROM p), false FROM m WHERE lo IS NULL")),
    "k8_concat_alignments": (lambda s, d: seqs.concat_alignments(view(s, d, "alignments"), view(s, d, "alignments")), oracle("WITH g AS (SELECT DISTINCT genome FROM alignments), w AS (SELECT family, max(length(seq)) AS w FROM alignments GROUP BY 1) SELECT genome, string_agg(rpad(coalesce(seq, ''), w::INT, '-'), '' ORDER BY family) AS seq FROM g CROSS JOIN w LEFT JOIN alignments USING (family, genome) GROUP BY 1")),
    "k9_variable_sites": (lambda s, d: seqs.variable_sites(view(s, d, "alignments")), oracle("WITH x AS (SELECT family, genome, i, substr(seq, i, 1) AS base FROM (SELECT *, unnest(generate_series(1, length(seq))) AS i FROM alignments)), v AS (SELECT family, i FROM x GROUP BY 1, 2 HAVING count(DISTINCT base) > 1) SELECT family, genome, string_agg(base, '' ORDER BY i) AS seq FROM x JOIN v USING (family, i) GROUP BY 1, 2")),
    "d30_base_frequencies": (lambda s, d: seqs.base_frequencies(view(s, d, "alignments")), oracle("SELECT family, base, count(*) AS n FROM (SELECT family, unnest(string_split(seq, '')) AS base FROM alignments) GROUP BY 1, 2")),
    "d31_describe": (lambda s, d: seqs.describe(view(s, d, "sequences").withColumn("n_chars", F.length("seq")), "genome", "n_chars"), oracle("SELECT genome, count(seq) AS n, round(avg(length(seq)), 6) AS mean, round(median(length(seq)), 6) AS median, round(quantile_cont(length(seq), 0.25), 6) AS q25, round(quantile_cont(length(seq), 0.75), 6) AS q75, round(var_samp(length(seq)), 3) AS variance FROM sequences GROUP BY 1")),
}

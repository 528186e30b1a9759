"""Queries over the species tree."""

from __future__ import annotations

from pyspark.sql import functions as F

from genomill.operators import intervals
from genomill.operators import trees as ops
from genomill.plans.views import oracle, view

PATHS = "WITH RECURSIVE paths AS (SELECT branch_id AS node, branch_id AS ancestor, 0 AS distance FROM species_tree UNION ALL SELECT p.node, t.parent_branch_id, distance + 1 FROM paths p JOIN species_tree t ON t.branch_id = p.ancestor WHERE t.parent_branch_id IS NOT NULL), tips AS (SELECT branch_id AS node, branch_name FROM species_tree WHERE is_tip)"
SIZES = PATHS + ", sizes AS (SELECT ancestor AS clade, count(*) AS n_members FROM paths JOIN tips USING (node) GROUP BY 1)"


# inner nodes 4k + 2 (k > 0) go, and their children hang on the node above: some nodes have three or four children
COLLAPSED = "WITH RECURSIVE collapsed_tree AS (SELECT branch_id, CASE WHEN parent_branch_id % 4 = 2 AND parent_branch_id > 2 THEN CAST(floor(parent_branch_id / 2) AS INT) ELSE parent_branch_id END AS parent_branch_id, branch_name, is_tip FROM species_tree WHERE is_tip OR branch_id % 4 <> 2 OR branch_id = 2), "


def _tree(s, d):
    nodes = view(s, d, "species_tree")
    return nodes, ops.closure(nodes)


def _walk(s, d):
    nodes = view(s, d, "species_tree")
    tour = intervals.euler_tour(nodes)
    return nodes, tour, intervals.range_minima(tour)


def j2_leaf_sets(s, d):
    nodes = view(s, d, "species_tree")
    return intervals.leaf_sets(nodes, intervals.euler_tour(nodes))


def j2_intervals(s, d):
    return intervals.euler_tour(view(s, d, "species_tree")).select("node", (F.col("last") - F.col("pre") + 1).alias("n_nodes"), "depth", "n_leaves")


def j3_clade_definitions(s, d):
    return ops.clade_definitions(*_tree(s, d), 6)


def j3_clades_of_pairs(s, d):
    up = F.col("parent_branch_id")
    nodes = view(s, d, "species_tree").where("is_tip OR branch_id % 4 <> 2 OR branch_id = 2").withColumn("parent_branch_id", F.when((up % 4 == 2) & (up > 2), F.floor(up / 2).cast("int")).otherwise(up))
    return ops.clade_definitions(nodes, ops.closure(nodes), 6)


def j4_branches_by_age(s, d):
    return ops.branches_by_age(_tree(s, d)[1], 2.0, older=0.1, younger=1.5, below=[2], without=[5])


def j6_event_lineages(s, d):
    return ops.event_lineages(*_tree(s, d), view(s, d, "species_tree_events").where("event_type <> 'S'").select(F.col("rec_branch_id").alias("node"), "event_id"))


def j10_population_nodes(s, d):
    return intervals.common_ancestors(view(s, d, "populations").select("clade", "node"), *_walk(s, d)[1:], "clade")


def j8_strict_groups(s, d):
    nodes, paths = _tree(s, d)
    return ops.strict_groups(nodes, paths, view(s, d, "branch_gains"))


def j9_unicopy_groups(s, d):
    return ops.unicopy_groups(_tree(s, d)[1], view(s, d, "populations").select("node", "species"))


def j12_select_clades(s, d):
    return ops.select_clades(view(s, d, "branch_support"), _tree(s, d)[1], [("support", ">=", 4)], [("mean", "support", "<=", 5), ("max", "support", "<", 9)], 2)


QUERIES = {
    "j2_leaf_sets": (j2_leaf_sets, oracle(PATHS + " SELECT ancestor, count(*) AS n_leaves, string_agg(branch_name, ',' ORDER BY branch_name) AS leaves FROM paths JOIN tips USING (node) GROUP BY 1")),
    "j2_intervals": (j2_intervals, oracle(PATHS + ", b AS (SELECT ancestor AS node, count(*) AS n_nodes, count(*) FILTER (node IN (SELECT node FROM tips)) AS n_leaves FROM paths GROUP BY 1), d AS (SELECT node, max(distance) AS depth FROM paths GROUP BY 1) SELECT node, n_nodes, CAST(depth AS BIGINT) AS depth, n_leaves FROM b JOIN d USING (node)")),
    "j3_clade_definitions": (j3_clade_definitions, oracle(SIZES + """, c AS (SELECT z.*, parent_branch_id AS p FROM sizes z JOIN species_tree ON branch_id = clade WHERE n_members > 1 AND parent_branch_id IS NOT NULL),
g AS (SELECT c.clade, ancestor AS background, z.n_members - c.n_members AS n_background, row_number() OVER (PARTITION BY c.clade ORDER BY z.n_members - c.n_members < 6, CASE WHEN z.n_members - c.n_members < 6 THEN -distance ELSE distance END) AS r FROM c JOIN paths ON node = c.clade AND distance > 0 JOIN sizes z ON z.clade = ancestor)
SELECT c.clade, c.n_members, s.branch_id AS sister, z.n_members AS n_sister, background, n_background FROM c JOIN species_tree s ON s.parent_branch_id = c.p AND s.branch_id <> c.clade JOIN sizes z ON z.clade = s.branch_id JOIN g ON g.clade = c.clade AND r = 1""")),
    "j3_clades_of_pairs": (j3_clades_of_pairs, oracle(COLLAPSED + SIZES.replace("species_tree", "collapsed_tree").removeprefix("WITH RECURSIVE ") + """, c AS (SELECT z.*, parent_branch_id AS p FROM sizes z JOIN collapsed_tree ON branch_id = clade WHERE n_members > 1 AND parent_branch_id IN (SELECT parent_branch_id FROM collapsed_tree GROUP BY 1 HAVING count(*) = 2)),
g AS (SELECT c.clade, ancestor AS background, z.n_members - c.n_members AS n_background, row_number() OVER (PARTITION BY c.clade ORDER BY z.n_members - c.n_members < 6, CASE WHEN z.n_members - c.n_members < 6 THEN -distance ELSE distance END) AS r FROM c JOIN paths ON node = c.clade AND distance > 0 JOIN sizes z ON z.clade = ancestor)
SELECT c.clade, c.n_members, s.branch_id AS sister, z.n_members AS n_sister, background, n_background FROM c JOIN collapsed_tree s ON s.parent_branch_id = c.p AND s.branch_id <> c.clade JOIN sizes z ON z.clade = s.branch_id JOIN g ON g.clade = c.clade AND r = 1""")),
    "j4_branches_by_age": (j4_branches_by_age, oracle(PATHS + ", d AS (SELECT node, max(distance) AS depth FROM paths GROUP BY 1), a AS (SELECT node AS branch_id, round(2.0 * (1 - depth / (SELECT max(depth) FROM d)), 9)::DOUBLE AS age FROM d) SELECT * FROM a WHERE age > 0.1 AND age < 1.5 AND branch_id IN (SELECT node FROM paths WHERE ancestor = 2) AND branch_id NOT IN (SELECT node FROM paths WHERE ancestor = 5)")),
    "j5_event_catalogue": (lambda s, d: ops.event_catalogue(view(s, d, "species_tree")), oracle("""WITH r AS (SELECT branch_id AS b, row_number() OVER (ORDER BY branch_id) - 1 AS r, count(*) OVER () AS n FROM species_tree)
SELECT t.i * n + r + 1 AS event_id, t.x AS event_type, CAST(NULL AS INT) AS don_branch_id, b AS rec_branch_id FROM r, (VALUES (0, 'D'), (1, 'L'), (2, 'S'), (3, 'O')) t(i, x)
UNION ALL SELECT 4 * count(*) + 1, 'O', NULL, NULL FROM species_tree
UNION ALL SELECT 4 * a.n + 2 + o.r * a.n + a.r, 'T', o.b, a.b FROM r a, r o WHERE o.r <> a.r UNION ALL SELECT 4 * n + 2 + n * n + r, 'T', NULL, b FROM r""")),
    "j6_event_lineages": (j6_event_lineages, oracle(PATHS + " SELECT DISTINCT p.node AS tip, event_id FROM paths p JOIN tips USING (node) JOIN species_tree_events e ON e.rec_branch_id = p.ancestor WHERE event_type <> 'S'")),
    "j8_strict_groups": (j8_strict_groups, oracle(PATHS + """, u AS (SELECT p.*, event_type, row_number() OVER (PARTITION BY p.node ORDER BY distance) AS r FROM paths p JOIN tips USING (node) JOIN branch_gains g ON g.node = ancestor WHERE event_type = 'T' OR distance > 0)
SELECT t.node AS tip, u.ancestor AS gain_node, CASE WHEN event_type = 'D' THEN c.ancestor END AS child FROM tips t LEFT JOIN u ON u.node = t.node AND r = 1 LEFT JOIN paths c ON c.node = t.node AND c.distance = u.distance - 1""")),
    "j9_unicopy_groups": (j9_unicopy_groups, oracle(PATHS + ", u AS (SELECT ancestor FROM paths JOIN populations USING (node) GROUP BY 1 HAVING count(*) = count(DISTINCT species)) SELECT node AS tip, arg_max(ancestor, distance) AS og_node FROM paths JOIN tips USING (node) JOIN u USING (ancestor) GROUP BY 1")),
    "j10_population_nodes": (j10_population_nodes, oracle(PATHS + ", m AS (SELECT clade, node, count(*) OVER (PARTITION BY clade) AS n_members FROM populations), a AS (SELECT clade, n_members, ancestor, sum(distance) AS d FROM m JOIN paths USING (node) GROUP BY 1, 2, 3 HAVING count(*) = n_members) SELECT clade, n_members, arg_min(ancestor, d) AS mrca FROM a GROUP BY 1, 2")),
    "j11_tip_distances": (lambda s, d: intervals.tip_distances(*_walk(s, d)), oracle(PATHS + " SELECT a.node AS tip_1, b.node AS tip_2, min(a.distance + b.distance) AS distance FROM paths a JOIN paths b USING (ancestor) WHERE a.node < b.node AND a.node IN (SELECT node FROM tips) AND b.node IN (SELECT node FROM tips) GROUP BY 1, 2")),
    "j12_select_clades": (j12_select_clades, oracle(PATHS + " SELECT ancestor AS node FROM paths p JOIN branch_support b ON b.node = ancestor JOIN branch_support w ON w.node = p.node WHERE distance BETWEEN 1 AND 2 AND b.support >= 4 GROUP BY 1 HAVING avg(w.support) <= 5 AND max(w.support) < 9")),
}

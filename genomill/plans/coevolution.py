"""Queries over event lineages and co-evolution scores."""

from __future__ import annotations

from genomill.operators import coevolution as ops
from genomill.plans.views import oracle, view

N, MIN_JOINT = 100, 0.5


def d15_coevolution_scores(spark, sf_dir):
    return ops.coevolution_scores(view(spark, sf_dir, "gene_lineage_events", {"lineitem": "l_orderkey", "orders": "o_orderkey"}), N, view(spark, sf_dir, "lineage_families"), "between_fams", MIN_JOINT)


D15_SQL = """SELECT a.rlocds_id AS rlocds_id_1, b.rlocds_id AS rlocds_id_2, CAST(sum(a.freq * b.freq) AS BIGINT) / 10000.0::DOUBLE AS score
FROM gene_lineage_events a JOIN gene_lineage_events b ON a.event_id = b.event_id AND b.rlocds_id >= a.rlocds_id
JOIN lineage_families fa ON fa.rlocds_id = a.rlocds_id JOIN lineage_families fb ON fb.rlocds_id = b.rlocds_id
WHERE fa.gene_family_id <> fb.gene_family_id GROUP BY 1, 2 HAVING sum(a.freq * b.freq) >= 5000"""

QUERIES = {
    "d15_coevolution_scores": (d15_coevolution_scores, oracle(D15_SQL)),
}

"""Stand-in views: the driver's tables in the roles of assemblies, replicons, coding sequences, lineages and trees.

The SQL runs unchanged in Spark and DuckDB, so the same text serves the queries and their oracles.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents conversations".split()

VIEWS = {
    "assemblies": "SELECT c_custkey AS assembly_id, c_nationkey AS taxid, c_mktsegment AS species, concat('G', CAST(c_custkey AS VARCHAR(20))) AS code FROM customer",
    "replicons": "SELECT o_orderkey AS genomic_accession, o_custkey AS assembly_id, CAST(1000 + o_orderkey % 5000 AS INT) AS replicon_size, CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'plasmid' ELSE 'chromosome' END AS replicon_type FROM orders",
    "coding_sequences": "SELECT l_orderkey AS genomic_accession, l_partkey AS nr_protein_id, CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_partkey END AS gene_family_id, l_quantity, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS cds_no FROM lineitem",
    "proteins": "SELECT p_partkey AS nr_protein_id, p_name AS product, p_brand AS protein_family_id FROM part",
    "functional_annotations": "SELECT p_partkey AS nr_protein_id, concat(p_brand, '/', p_type) AS interpro_id FROM part",
    "interpro2go": "SELECT DISTINCT concat(p_brand, '/', p_type) AS interpro_id, p_name AS go_id FROM part",
    "gene_lineage_events": "SELECT o_custkey AS rlocds_id, l_partkey AS event_id, CAST(least(sum(l_quantity), 100) AS BIGINT) AS freq FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey",
    "lineage_families": "SELECT c_custkey AS rlocds_id, c_nationkey AS gene_family_id FROM customer",
    "orthologous_groups": "SELECT c_custkey AS rlocds_id, c_nationkey AS gene_family_id, dense_rank() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment) AS og_id, 1 AS ortholog_col_id FROM customer WHERE c_acctbal >= 0",
    "species_tree": "SELECT CAST(s_suppkey + n_tips AS INT) AS branch_id, CAST(floor((s_suppkey + n_tips) / 2) AS INT) AS parent_branch_id, s_name AS branch_name, true AS is_tip FROM supplier CROSS JOIN (SELECT count(*) AS n_tips FROM supplier) z UNION ALL SELECT CAST(s_suppkey AS INT), CASE WHEN s_suppkey = 1 THEN NULL ELSE CAST(floor(s_suppkey / 2) AS INT) END, concat('N', CAST(s_suppkey AS VARCHAR(20))), false FROM supplier WHERE s_suppkey > 0",
    "species_tree_events": "SELECT p_partkey AS event_id, substr('DTLSO', CAST(p_size % 5 + 1 AS INT), 1) AS event_type, CASE WHEN p_size % 5 = 1 THEN CAST(p_partkey % (2 * n_tips - 1) + 1 AS INT) END AS don_branch_id, CAST(p_partkey * 7 % (2 * n_tips - 1) + 1 AS INT) AS rec_branch_id FROM part CROSS JOIN (SELECT count(*) AS n_tips FROM supplier) z",
    "populations": "SELECT CAST(floor(s_suppkey / 7) AS BIGINT) AS clade, s_suppkey AS genome, s_suppkey + n_tips AS node, s_nationkey AS species, 'clade' AS side FROM supplier CROSS JOIN (SELECT count(*) AS n_tips FROM supplier) z",
    "branch_gains": "SELECT s_suppkey AS node, CASE WHEN s_acctbal < 2000 THEN 'T' ELSE 'D' END AS event_type FROM supplier WHERE s_suppkey > 0 AND s_acctbal < 6000",
    "branch_support": "SELECT s_suppkey + n_tips AS node, CAST(floor((s_acctbal + 1000) / 1100) AS INT) AS support FROM supplier CROSS JOIN (SELECT count(*) AS n_tips FROM supplier) z UNION ALL SELECT s_suppkey, CAST(floor((s_acctbal + 1000) / 1100) AS INT) FROM supplier WHERE s_suppkey > 0",
    "clade_members": "SELECT r_regionkey AS clade, n_nationkey AS genome, CASE WHEN n_regionkey = r_regionkey THEN 'clade' ELSE 'contrast' END AS side FROM region CROSS JOIN nation",
    "og_samples": "SELECT l_suppkey AS family, l_linenumber AS sample, l_partkey AS gene, min(month(l_shipdate)) AS og FROM lineitem GROUP BY l_suppkey, l_linenumber, l_partkey",
    "ordered_genes": "SELECT user_id AS replicon, event_type AS event, value AS freq, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gene_rank FROM events",
    "sequences": "SELECT doc_id AS seq_id, lang AS genome, source AS family, text AS seq FROM documents",
    "alignments": "SELECT turn AS family, conv_id AS genome, text AS seq FROM conversations",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a table that is dealt by a key in each task.
ROWS_A_TASK = 250_000


def view(spark: SparkSession, sf_dir: str, name: str, deal: dict[str, str] | None = None) -> DataFrame:
    """The stand-in view `name` over the tables of `sf_dir`; nothing is registered in the catalogue.

    `deal` (table: key): tables dealt by a key over as many tasks as the largest of them needs, so that a task's share does not grow with them.
    """
    sql = VIEWS[name]
    used = [t for t in TABLES if re.search(rf"\b{t}\b", sql)]
    for t in used:
        sql = re.sub(rf"(?<=FROM |JOIN ){t}\b", "{" + t + "}", sql)
    given = {t: table(spark, sf_dir, t) for t in used}
    if deal:
        tasks = max(given[t].count() for t in deal) // ROWS_A_TASK + 1
        given |= {t: given[t].repartition(tasks, key) for t, key in deal.items()}
    return spark.sql(sql, **given)


def oracle(sql: str) -> str:
    """`sql` with the views it names as common table expressions in front."""
    needed = [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]
    ctes = ", ".join(f"{v} AS ({VIEWS[v]})" for v in needed)
    body = sql.strip()
    if not ctes:
        return body
    if m := re.match(r"WITH\s+(RECURSIVE\s+)?", body):
        return f"WITH {m[1] or ''}{ctes}, {body[m.end():]}"
    return f"WITH {ctes} {body}"

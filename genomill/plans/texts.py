"""Queries of text functions and readers, on texts made of the given tables' columns; the same SQL makes the texts in both engines."""

from __future__ import annotations

from pyspark.sql import functions as F

from genomill.functions import text as fn
from genomill.operators import graphs, trees
from genomill.plans.coevolution import D15_SQL, d15_coevolution_scores
from genomill.plans.graphs import LABELS, ROUNDS, _graph
from genomill.plans.trees import PATHS
from genomill.plans.views import oracle, table, view
from genomill.sources import formats, tables

PART = {
    "codes": "SELECT p_partkey AS assembly_id, concat(p_name, ' ', lower(p_type)) AS species, CASE WHEN p_partkey % 17 = 0 THEN concat('u', CAST(p_partkey % 34 AS VARCHAR(9))) END AS user_code, CASE WHEN p_size % 7 = 0 THEN concat('s', CAST(p_size AS VARCHAR(9))) END AS species_code FROM part",
    "crossed": "SELECT p_partkey AS id0, concat('Assembly: G', CAST(p_partkey AS VARCHAR(20)), '; BioProject: P', CAST(p_size AS VARCHAR(9)), ', Q', CAST(p_partkey % 3 AS VARCHAR(9)), '; SRA: ') AS refs, concat(CAST(p_partkey % 5 AS VARCHAR(9)), ', ', CAST(p_partkey % 7 AS VARCHAR(9))) AS pubmed FROM part",
    "products": "SELECT p_partkey, concat(p_name, '%2C ', p_type, '%3B', p_brand) AS product FROM part",
    "strains": "SELECT p_partkey, concat(p_name, CASE WHEN p_partkey % 9 = 0 THEN ' Laboratory stock' ELSE '' END) AS remark, CASE WHEN p_size % 2 = 0 THEN 'Escherichia coli' WHEN p_size % 5 > 0 THEN p_type END AS species, CASE p_size % 6 WHEN 0 THEN 'K-12 MG1655' WHEN 1 THEN 'BL21' WHEN 2 THEN 'O157' WHEN 3 THEN 'DE3x' ELSE NULL END AS strain FROM part",
    "organisms": "SELECT p_partkey, concat('[', p_name, '] (', lower(p_type), ')') AS organism, CASE p_size % 3 WHEN 1 THEN lower(p_type) WHEN 2 THEN p_brand END AS strain, concat('C', CAST(p_partkey AS VARCHAR(20))) AS code FROM part",
    "steps": "SELECT p_partkey AS node, concat('.T@a', CAST(p_partkey % 7 AS VARCHAR(9)), '->b', CAST(p_partkey % 5 AS VARCHAR(9)), '.D@c', CAST(p_partkey % 3 AS VARCHAR(9)), '.n', CAST(p_size AS VARCHAR(9))) AS label FROM part",
    "hits": "SELECT p_partkey AS nr_protein_id, p_partkey AS place, concat('md', CAST(p_partkey % 13 AS VARCHAR(9))) AS md5_digest, p_size AS seq_length, CASE WHEN p_partkey % 6 > 0 THEN concat(p_brand, '/', p_type) END AS interpro_id, p_name AS description, CASE WHEN p_size % 4 > 0 THEN replace(p_name, ' ', '|') END AS go_terms, CASE WHEN p_size % 3 > 0 THEN concat('KEGG: ', p_type, '|MetaCyc: ', p_brand) END AS pathways FROM part",
}
DATES = "SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d, CASE o_orderkey % 4 WHEN 0 THEN substr(CAST(o_orderdate AS VARCHAR(30)), 1, 10) WHEN 1 THEN substr(CAST(o_orderdate AS VARCHAR(30)), 1, 7) WHEN 2 THEN substr(CAST(o_orderdate AS VARCHAR(30)), 1, 4) ELSE concat(CAST(day(o_orderdate) AS VARCHAR(9)), '-', substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(3 * month(o_orderdate) - 2 AS INT), 3), '-', CAST(year(o_orderdate) AS VARCHAR(9))) END AS text FROM orders"
TERMS = [["cold", "small"], ["widget", "bolt", "gear"], ["red", "blue", "green"]]
STRAINS = "SELECT s_suppkey AS assembly_id, CASE WHEN s_suppkey % 5 = 0 THEN ' ' ELSE s_name END AS species, CASE s_suppkey % 4 WHEN 0 THEN 'a/b' WHEN 1 THEN 'c d' ELSE 'plain' END AS strain, CASE WHEN s_suppkey % 3 = 0 THEN concat('P-', CAST(s_suppkey AS VARCHAR(9))) ELSE concat('T', CAST(s_nationkey AS VARCHAR(9))) END AS locus_tag_prefix FROM supplier"


def _part(s, d, name):
    return s.sql(PART[name].replace("FROM part", "FROM {part}"), part=table(s, d, "part"))


def _with(name, sql):
    return f"WITH x AS ({PART[name]}) {sql}"


def b3_collection_dates(s, d):
    rows = s.sql(DATES.replace("FROM orders", "FROM {orders}"), orders=table(s, d, "orders"))
    return rows.select("o_orderkey", fn.collection_date(F.col("text")).alias("_d")).select("o_orderkey", "_d.*")


def b9_overrides(s, d):
    known = table(s, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.lit("seen").alias("note"))
    made = table(s, d, "customer").where("c_custkey % 3 = 0").select(F.floor(F.col("c_custkey") / 9).alias("key"), F.when(F.col("c_custkey") % 2 == 0, "name").otherwise("note").alias("field"), F.concat(F.lit("'"), "c_name", F.lit('"')).alias("value"))
    return fn.apply_overrides(known, made, "key", ["name", "note"])


def b7_replicon_types(s, d):
    rows = table(s, d, "orders").select("o_orderkey", F.map_filter(F.create_map(F.lit("genome"), F.when(F.col("o_orderkey") % 5 == 0, F.lower("o_orderstatus")), F.lit("chromosome"), F.when(F.col("o_orderkey") % 5 == 1, F.lit("1")), F.lit("plasmid-name"), F.when(F.col("o_orderkey") % 5 <= 2, F.lit("p")), F.lit("-"), F.lit("-")), lambda k, v: v.isNotNull()).alias("a"), F.when(F.col("o_orderkey") % 2 == 0, "ANONYMOUS DNA").otherwise("genomic DNA").alias("m"))
    return rows.select("o_orderkey", fn.replicon_type(F.col("a"), F.col("m")).alias("kind"))


def a11_clades(s, d):
    each = table(s, d, "supplier").groupBy("s_nationkey").agg(F.array_join(F.array_sort(F.collect_list("s_name")), "  ").alias("names"))
    return tables.read_clades(each.select(F.concat(F.lit(" constraint clade"), F.col("s_nationkey").cast("string"), F.lit(" -1 = "), "names", F.lit(" ;")).alias("value")).union(s.createDataFrame([("# no clade",)], "value string")))


def a13_lists(s, d):
    each = table(s, d, "supplier").groupBy("s_nationkey").agg(F.array_join(F.array_sort(F.collect_list("s_name")), "\t").alias("names"))
    return tables.read_lists(each.select(F.concat(F.lit("N"), F.col("s_nationkey").cast("string"), F.lit(": "), "names").alias("value")))


def a14_triangle(s, d):
    distances = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n_nationkey").cast("long")), lambda j: F.when(j < F.col("n_nationkey"), ((F.col("n_nationkey") * 7 + j * 3) % 11 / 2).cast("string")))
    return tables.read_triangle(table(s, d, "nation").select(F.col("n_nationkey").cast("int").alias("row"), F.concat_ws("\t", F.concat(F.lit("/tmp/"), "n_name", F.lit(".fna")), F.array_compact(distances)).alias("value")))


def a18_strain_errors(s, d):
    return tables.strain_errors(s.sql(STRAINS.replace("FROM supplier", "FROM {supplier}"), supplier=table(s, d, "supplier")))


def a6_taxon_names(s, d):
    nation = table(s, d, "nation")
    names = nation.select(F.col("n_nationkey").alias("taxid"), F.col("n_name").alias("name"), F.lit("scientific name").alias("kind")).unionByName(nation.select(F.col("n_nationkey").alias("taxid"), F.lit("other").alias("name"), F.lit("synonym").alias("kind")))
    merged = table(s, d, "supplier").select((F.col("s_suppkey") + 1000).alias("old"), F.col("s_nationkey").alias("new"))
    return tables.taxon_names(names, merged, merged.select(F.col("old").alias("taxid")).unionByName(nation.select(F.col("n_nationkey").alias("taxid"))))


def _annotations(s, d, name):
    loaded = table(s, d, "part").where("p_partkey % 10 = 3").select(F.col("p_partkey").alias("nr_protein_id"), F.lit("v1").alias("version"))
    return tables.split_annotations(_part(s, d, "hits"), loaded, "v1")[name]


FRESH = "f AS (SELECT * FROM x WHERE nr_protein_id % 10 <> 3), t AS (SELECT * FROM f WHERE interpro_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY interpro_id ORDER BY place) = 1)"


def a17_trees(s, d):
    """A caterpillar tree of each order: its lines' parts, joined one after another."""
    lines = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("q"), "l_extendedprice"))).alias("ls"))
    tip = lambda x: F.concat(F.lit("p"), x["l_partkey"].cast("string"), F.lit(":"), x["q"].cast("string"))
    text = F.aggregate(F.slice("ls", 2, 1000), tip(F.col("ls")[0]), lambda t, x: F.concat(F.lit("("), t, F.lit(","), tip(x), F.lit(")")))
    return formats.read_trees(lines.select(F.col("l_orderkey").alias("tree"), F.concat(text, F.lit(";")).alias("newick")))


TREES_SQL = """WITH o AS (SELECT l_orderkey AS tree, l_partkey, CAST(l_quantity AS INT) AS q, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INT), l_extendedprice) AS j, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem),
k AS (SELECT DISTINCT tree, n FROM o), i AS (SELECT tree, unnest(generate_series(0, n - 2)) AS id FROM k)
SELECT tree, CAST(id AS INT) AS branch_id, CASE WHEN id > 0 THEN CAST(id - 1 AS INT) END AS parent_branch_id, 'N' || id AS branch_name, CAST(NULL AS DOUBLE) AS length, false AS is_tip FROM i
UNION ALL SELECT tree, CAST(CASE WHEN n = 1 THEN 0 ELSE n - 2 + j END AS INT), CASE WHEN n > 1 THEN CAST(CASE WHEN j = 1 THEN n - 2 ELSE n - j END AS INT) END, 'p' || l_partkey, CAST(q AS DOUBLE), true FROM o"""

def _gff(s, d):
    """Each part as a gene with a coding sequence in two segments, each supplier as a region."""
    k, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    at = lambda n: (F.col("p_partkey") * 10 + n).cast("string")
    line = lambda region, kind, beg, end, attributes: F.concat_ws("\t", region, F.lit("src"), F.lit(kind), beg, end, F.lit("."), F.lit("+"), F.lit("0"), attributes)
    region = F.concat(F.lit("gnl|c|R"), size)
    gene = line(region, "gene", at(1), at(9), F.concat(F.lit("ID=gene-"), k, F.lit(";locus_tag=LT_"), k))
    cds = [line(region, "CDS", at(b), at(e), F.concat(F.lit("ID=cds-"), k, F.lit(";Parent=gene-"), k, F.lit(";protein_id=P"), k, F.lit(";product="), "p_name")) for b, e in ((1, 5), (7, 9))]
    genes = table(s, d, "part").select(F.explode(F.array(gene, *cds, F.lit("# comment"))).alias("value"))
    n = F.col("s_suppkey").cast("string")
    regions = table(s, d, "supplier").select(line(F.concat(F.lit("S"), n), "region", F.lit("1"), F.concat(F.lit("1"), n), F.concat(F.lit("ID=r;Dbxref=taxon:"), F.col("s_nationkey").cast("string"), F.lit(";Name=n"), n, F.when(F.col("s_suppkey") % 2 == 0, F.lit(";genome=chromosome")).otherwise(F.lit(";plasmid-name=p;plasmid=1")), F.lit(";strain=x"))).alias("value"))
    return formats.read_gff(genes.unionByName(regions), "ASM")


def a4_fasta(s, d):
    """Parts as records with tags and a sequence over two lines, written as text and read again."""
    k = F.col("p_partkey").cast("string")
    record = F.concat(F.lit(">prot"), k, F.lit(" [locus_tag=LT_"), k, F.lit("] [protein="), F.col("p_brand"), F.lit("]\n"), F.upper(F.replace("p_name", F.lit(" "), F.lit("\n"))))
    path = trees.shared_path(s, "fasta")
    table(s, d, "part").select(record.alias("value")).write.text(path)
    return tables.read_fasta(s, path).select("id", F.col("tags")["locus_tag"].alias("locus_tag"), F.col("tags")["protein"].alias("protein"), "seq")


def a12_scores(s, d):
    path = trees.shared_path(s, "scores")
    tables.write_scores(d15_coevolution_scores(s, d), path)
    return formats.load_scores(s, path, 4)


def a24_union_matrices(s, d):
    lines = table(s, d, "lineitem")
    matrix = lambda flags: lines.where(F.col("l_returnflag").isin(flags)).groupBy(F.col("l_partkey").alias("family")).pivot("l_returnflag", flags).agg(F.count(F.lit(1))).fillna(0)
    return formats.union_matrices(matrix(["A", "N"]), matrix(["R", "N"]))


TAGGED = "SELECT branch_id, parent_branch_id, CASE WHEN NOT is_tip AND branch_id % 7 = 3 THEN concat(branch_name, '_CC-clade', CAST(branch_id AS VARCHAR(9))) WHEN is_tip AND branch_id % 5 = 0 THEN concat(branch_name, '_RC-clade', CAST(branch_id % 3 AS VARCHAR(9))) ELSE branch_name END AS branch_name, is_tip FROM species_tree"


def b23_drop_tagged(s, d):
    nodes = s.sql(TAGGED.replace("FROM species_tree", "FROM {t}"), t=view(s, d, "species_tree"))
    return trees.drop_tagged(nodes, trees.closure(nodes)).select("branch_id", "branch_name")


def i11_reference_community(s, d):
    edges = _graph(s, d)
    node = edges.agg(F.min("a")).first()[0]
    return graphs.reference_community(edges, node, ROUNDS, 10**9)


QUERIES = {
    "b2_genome_codes": (lambda s, d: fn.genome_codes(_part(s, d, "codes")), _with("codes", ", c AS (SELECT assembly_id, upper(coalesce(user_code, species_code, concat(substr(string_split(species, ' ')[-2], 1, 3), substr(string_split(species, ' ')[-1], 1, 3)))) AS c FROM x) SELECT assembly_id, concat(c, CASE WHEN count(*) OVER (PARTITION BY c) > 1 THEN CAST(row_number() OVER (PARTITION BY c ORDER BY assembly_id) AS VARCHAR) ELSE '' END) AS code FROM c")),
    "b3_collection_dates": (b3_collection_dates, f"WITH x AS ({DATES}) SELECT o_orderkey, CAST(y AS INT) AS year, CASE WHEN o_orderkey % 4 <> 2 THEN CAST(m AS INT) END AS month, CASE WHEN o_orderkey % 4 IN (0, 3) THEN CAST(d AS INT) END AS day FROM x"),
    "b4_standard_terms": (lambda s, d: table(s, d, "part").select("p_partkey", fn.standard_term(F.col("p_name"), TERMS, default="none").alias("term")), "SELECT p_partkey, CASE " + " ".join(f"WHEN {' OR '.join(f'lower(p_name) LIKE ' + repr('%' + t + '%') for t in g)} THEN '{g[-1]}'" for g in TERMS) + " ELSE 'none' END AS term FROM part"),
    "b10_clinical_tags": (lambda s, d: table(s, d, "part").select("p_partkey", fn.clinical_tags(F.col("p_name"), TERMS).alias("tags")), "SELECT p_partkey, nullif(concat_ws(',', " + ", ".join(f"CASE WHEN {' OR '.join(f'lower(p_name) LIKE ' + repr('%' + t + '%') for t in g)} THEN '{g[0]}' END" for g in TERMS) + "), '') AS tags FROM part"),
    "b6_cross_references": (lambda s, d: fn.cross_references(_part(s, d, "crossed"), "id0", "refs", "pubmed"), "SELECT p_partkey AS id0, 'BioProject' AS db, 'P' || p_size AS id FROM part UNION ALL SELECT p_partkey, 'BioProject', 'Q' || p_partkey % 3 FROM part UNION ALL SELECT p_partkey, 'PubMed', CAST(p_partkey % 5 AS VARCHAR) FROM part UNION ALL SELECT p_partkey, 'PubMed', CAST(p_partkey % 7 AS VARCHAR) FROM part"),
    "b7_replicon_types": (b7_replicon_types, "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN lower(o_orderstatus) WHEN o_orderkey % 5 = 1 THEN 'chromosome' WHEN o_orderkey % 5 = 2 THEN 'plasmid' WHEN o_orderkey % 2 = 0 THEN 'chromosome' ELSE 'genomic' END AS kind FROM orders"),
    "b8_clean_products": (lambda s, d: _part(s, d, "products").select("p_partkey", fn.clean_product(F.col("product")).alias("product")), "SELECT p_partkey, concat(p_name, ', ', p_type, ';', p_brand) AS product FROM part"),
    "b9_overrides": (b9_overrides, "WITH m AS (SELECT CAST(floor(c_custkey / 9) AS BIGINT) AS key, max(c_name) FILTER (c_custkey % 2 = 0) AS n, max(c_name) FILTER (c_custkey % 2 = 1) AS t FROM customer WHERE c_custkey % 3 = 0 GROUP BY 1) SELECT s_suppkey AS key, coalesce(n, s_name) AS name, concat_ws('; ', 'seen', t) AS note FROM supplier LEFT JOIN m ON key = s_suppkey"),
    "b11_lab_strains": (lambda s, d: _part(s, d, "strains").select("p_partkey", fn.is_lab_strain([F.col("remark")], F.col("species"), F.col("strain")).alias("lab")), _with("strains", "SELECT p_partkey, lower(remark) LIKE '%laborator%' OR coalesce(species = 'Escherichia coli' AND (strain LIKE '%K-12%' OR strain LIKE '%BL21%' OR strain LIKE '%DE3%'), false) AS lab FROM x")),
    "b15_organism_labels": (lambda s, d: _part(s, d, "organisms").select("p_partkey", fn.organism_label(F.col("organism"), F.col("strain")).alias("label"), fn.tree_label(F.col("organism"), F.col("strain"), F.col("code")).alias("tip")), _with("organisms", ", l AS (SELECT *, CASE WHEN strain IS NULL OR ends_with(translate(organism, '[]()', ''), strain) THEN translate(organism, '[]()', '') ELSE concat(translate(organism, '[]()', ''), ' str. ', strain) END AS label FROM x) SELECT p_partkey, label, concat(regexp_replace(label, '[\\s.,:;()\\[\\]''/]+', '_', 'g'), '__', code) AS tip FROM l")),
    "b16_label_prefixes": (lambda s, d: table(s, d, "customer").select("c_custkey", fn.label_prefix(F.col("c_name"), "#").alias("prefix")), "SELECT c_custkey, string_split(c_name, '#')[1] AS prefix FROM customer"),
    "b17_cds_families": (lambda s, d: table(s, d, "part").select("p_partkey", fn.cds_family_id(F.col("p_brand"), "Brand#1", "CDS1-").alias("family")), "SELECT p_partkey, CASE WHEN starts_with(p_brand, 'Brand#1') THEN concat('CDS1-', substr(p_brand, 8)) ELSE p_brand END AS family FROM part"),
    "b21_explode_events": (lambda s, d: fn.explode_events(_part(s, d, "steps")), "SELECT p_partkey AS node, 0 AS place, 'T' AS event_type, 'a' || p_partkey % 7 AS don_branch, 'b' || p_partkey % 5 AS rec_branch FROM part UNION ALL SELECT p_partkey, 1, 'D', NULL, 'c' || p_partkey % 3 FROM part UNION ALL SELECT p_partkey, 2, 'S', NULL, 'n' || p_size FROM part"),
    "a6_taxon_names": (a6_taxon_names, "SELECT s_suppkey + 1000 AS taxid, s_nationkey AS current_taxid, n_name AS name FROM supplier JOIN nation ON n_nationkey = s_nationkey UNION ALL SELECT n_nationkey, n_nationkey, n_name FROM nation"),
    "a8_hits": (lambda s, d: _annotations(s, d, "hits"), _with("hits", f", {FRESH} SELECT DISTINCT nr_protein_id, interpro_id, 'v1' AS version FROM f")),
    "a8_proteins": (lambda s, d: _annotations(s, d, "proteins"), _with("hits", f", {FRESH} SELECT nr_protein_id, md5_digest, seq_length FROM f")),
    "a8_interpro": (lambda s, d: _annotations(s, d, "interpro"), _with("hits", f", {FRESH} SELECT interpro_id, description, go_terms, pathways FROM t")),
    "a8_go": (lambda s, d: _annotations(s, d, "go"), _with("hits", f", {FRESH} SELECT DISTINCT interpro_id, unnest(string_split(go_terms, '|')) AS go_id FROM t")),
    "a8_pathways": (lambda s, d: _annotations(s, d, "pathways"), _with("hits", f", {FRESH}, p AS (SELECT interpro_id, unnest(string_split(pathways, '|')) AS p FROM t) SELECT DISTINCT interpro_id, string_split(p, ': ')[1] AS db, string_split(p, ': ')[2] AS pathway_id FROM p")),
    "a11_clades": (a11_clades, "SELECT 'clade' || s_nationkey AS clade, s_name AS cds_code FROM supplier"),
    "a13_lists": (a13_lists, "SELECT 'N' || s_nationkey AS cluster, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_name) - 1 AS INT) AS place, s_name AS member FROM supplier"),
    "a14_triangle": (a14_triangle, "SELECT a.n_name AS a, b.n_name AS b, (greatest(a.n_nationkey, b.n_nationkey) * 7 + least(a.n_nationkey, b.n_nationkey) * 3) % 11 / 2 AS distance FROM nation a JOIN nation b ON a.n_nationkey <> b.n_nationkey"),
    "a17_trees": (a17_trees, TREES_SQL),
    "a18_strain_errors": (a18_strain_errors, f"WITH x AS ({STRAINS}) SELECT assembly_id, 'empty species' AS error FROM x WHERE trim(species) = '' UNION ALL SELECT assembly_id, 'character in locus_tag_prefix' FROM x WHERE locus_tag_prefix LIKE '%-%' UNION ALL SELECT assembly_id, 'character in strain' FROM x WHERE strain <> 'plain' UNION ALL SELECT assembly_id, 'repeated locus_tag_prefix' FROM (SELECT *, count(*) OVER (PARTITION BY locus_tag_prefix) AS n FROM x) WHERE n > 1"),
    "a3_genes": (lambda s, d: formats.gff_genes(_gff(s, d), formats.CODING), "SELECT 'P' || p_partkey AS product_id, 'R' || p_size AS region, 'LT_' || p_partkey AS locus_tag, p_partkey * 10 + 1 AS beg, p_partkey * 10 + 9 AS \"end\", '+' AS strand, p_name AS product FROM part"),
    "a3_replicons": (lambda s, d: formats.gff_replicons(_gff(s, d)), "SELECT 'S' || s_suppkey AS region, 'n' || s_suppkey AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'chromosome' ELSE 'plasmid' END AS kind, CAST('1' || s_suppkey AS BIGINT) AS size, CAST(s_nationkey AS BIGINT) AS taxid, 'x' AS strain FROM supplier"),
    "a4_fasta": (a4_fasta, "SELECT 'prot' || p_partkey AS id, 'LT_' || p_partkey AS locus_tag, p_brand AS protein, upper(replace(p_name, ' ', '')) AS seq FROM part"),
    "a7_species_codes": (lambda s, d: tables.read_species_codes(table(s, d, "nation").select(F.explode(F.array(F.concat(F.lit("NA"), F.col("n_nationkey").cast("string"), F.lit("X B     "), (F.col("n_nationkey") + 500).cast("string"), F.lit(": N="), "n_name"), F.lit("      C=common"), F.lit("<p>"))).alias("value"))), "SELECT 'NA' || n_nationkey || 'X' AS code, n_nationkey + 500 AS taxid FROM nation"),
    "a12_scores": (a12_scores, oracle(f"WITH x AS ({D15_SQL}) SELECT rlocds_id_1, rlocds_id_2, round(score, 6) AS score, 4 AS reconciliation_id FROM x")),
    "a24_union_matrices": (a24_union_matrices, "WITH m AS (SELECT l_partkey AS family, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'N') AS n, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY 1) SELECT family, a AS \"A\", n AS \"N\", 0 AS \"R\" FROM m WHERE a + n > 0 UNION ALL SELECT family, 0, n, r FROM m WHERE n + r > 0"),
    "b23_drop_tagged": (b23_drop_tagged, oracle(PATHS + f", t AS ({TAGGED}), gone AS (SELECT node FROM paths JOIN t ON t.branch_id = ancestor WHERE contains(t.branch_name, '_CC-clade')), x AS (SELECT branch_id FROM t WHERE is_tip AND contains(branch_name, '_RC-clade') QUALIFY row_number() OVER (PARTITION BY regexp_extract(branch_name, '(_RC-clade.*)$', 1) ORDER BY branch_name, branch_id) > 1) SELECT branch_id, branch_name FROM t WHERE branch_id NOT IN (SELECT node FROM gone) AND branch_id NOT IN (SELECT branch_id FROM x)")),
    "i11_reference_community": (i11_reference_community, oracle(f"WITH {LABELS} SELECT node FROM l{ROUNDS} WHERE community = (SELECT community FROM l{ROUNDS} ORDER BY node LIMIT 1)")),
}

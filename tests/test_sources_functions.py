"""Readers and column functions on small literal inputs."""

from pyspark.sql import functions as F

from genomill.functions import text as fn
from genomill.sources import tables as src


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_tsv_and_projection(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("x\ty\tz\n1\t\t\n\tb\tc\n")
    got = src.load_tsv(spark, str(tmp_path / "a.tsv"), {"z": "string", "x": "int", "y": "string"}, ["y"])
    assert sorted(rows(got), key=str) == sorted([(None, 1, ""), ("c", None, "b")], key=str)
    assert src.project_fields(got, ["id", "y"], {"id": "x"}).columns == ["id", "y"]


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">p1 [gene=abc] [locus=L 1]\nACG\nT\n>p2\nGG\n>p3\n")
    got = src.read_fasta(spark, str(tmp_path / "*.fa"))
    assert rows(got.select("file", "id", "tags", "seq"), "id") == [("a.fa", "p1", {"gene": "abc", "locus": "L 1"}, "ACGT"), ("a.fa", "p2", {}, "GG"), ("a.fa", "p3", {}, "")]


def test_names_codes_annotations(spark):
    names = spark.createDataFrame([(1, "A", "scientific name"), (1, "a", "synonym"), (2, "B", "scientific name")], "taxid int, name string, kind string")
    got = src.taxon_names(names, spark.createDataFrame([(9, 2)], "old int, new int"), spark.createDataFrame([(1,), (9,), (5,)], "taxid int"))
    assert rows(got, "taxid") == [(1, 1, "A"), (5, 5, None), (9, 2, "B")]
    assert rows(src.read_species_codes(lines(spark, "ECOLI B     562: N=Escherichia coli", "      C=x", "<p>", ""))) == [("ECOLI", 562)]
    wide = spark.createDataFrame([(5, 1, "m1", 9, "I1", "d", "G1|G2", "KEGG: 7|MC: 8"), (6, 1, "m0", 9, "I1", "later", "G9", None), (7, 2, "m2", 4, None, None, None, None), (1, 3, "m3", 5, "I1", "c", "G2", None), (8, 4, "m4", 6, "I2", "known", "G3", "")], "place int, nr_protein_id int, md5_digest string, seq_length int, interpro_id string, description string, go_terms string, pathways string")
    got = src.split_annotations(wide, spark.createDataFrame([(3, "v1")], "nr_protein_id int, version string"), "v1", spark.createDataFrame([("I2",)], "interpro_id string"))
    assert rows(got["proteins"], "nr_protein_id") == [(1, "m1", 9), (2, "m2", 4), (4, "m4", 6)]
    assert rows(got["hits"], "nr_protein_id") == [(1, "I1", "v1"), (2, None, "v1"), (4, "I2", "v1")]
    assert rows(got["interpro"]) == [("I1", "d", "G1|G2", "KEGG: 7|MC: 8")] and rows(got["go"], "go_id") == [("I1", "G1"), ("I1", "G2")]
    assert rows(got["pathways"], "db") == [("I1", "KEGG", "7"), ("I1", "MC", "8")]


def test_tree_dumps(spark, tmp_path):
    (tmp_path / "tree.tab").write_text("1\t\tN1\t0\n2\t1\tA\t1\n")
    (tmp_path / "events.tab").write_text("7\tT\t1\t2\n8\tS\t\t2\n")
    assert rows(src.load_species_tree(spark, str(tmp_path / "tree.tab")), "branch_id") == [(1, None, "N1", False), (2, 1, "A", True)]
    assert rows(src.load_tree_events(spark, str(tmp_path / "events.tab")), "event_id") == [(7, "T", 1, 2), (8, "S", None, 2)]


def test_groups_clades_lists(spark, tmp_path):
    (tmp_path / "FAM1.ogs").write_text(" a\t1\nb \t2\n")
    assert rows(src.load_groups(spark, str(tmp_path / "*.ogs"), ".ogs", 4), "og_id") == [("FAM1", "a", 1, 4), ("FAM1", "b", 2, 4)]
    (tmp_path / "FAM2.events").write_text("a\t7\t90\n")
    assert rows(src.load_event_lineages(spark, str(tmp_path / "*.events"), ".events", 3)) == [("FAM2", "a", 7, 90, 3)]
    assert rows(src.read_clades(lines(spark, "constraint clade0 -1 = a b;", "other")), "cds_code") == [("clade0", "a"), ("clade0", "b")]
    lists = src.read_lists(lines(spark, "k1: a\tb", "k2: c", "k2: c", "no"))
    families = spark.createDataFrame([("a", "F"), ("b", "F"), ("c", "F"), ("d", "O")], "member string, gene_family_id string")
    assert rows(src.lists_to_groups(lists, families, 2, "O"), "member") == [("F", "a", 1, 2), ("F", "b", 1, 2), ("F", "c", 2, 2)]
    assert rows(src.count_by_file(spark, str(tmp_path / "*.ogs"))) == [("FAM1.ogs", 2)]


def test_triangle_and_clusters(spark, tmp_path):
    table = spark.createDataFrame([(0, "x/A.fa"), (1, "x/B.fa\t0.5"), (2, "x/C.fa\t0.25\t0.75")], "row int, value string")
    assert rows(src.read_triangle(table), "a", "b") == [("A", "B", 0.5), ("A", "C", 0.25), ("B", "A", 0.5), ("B", "C", 0.75), ("C", "A", 0.25), ("C", "B", 0.75)]
    (tmp_path / "c.fa").write_text(">a x\nAC\n>b\nG\n\x00>c\nT\n")
    assert rows(src.read_clusters(spark, str(tmp_path / "c.fa")), "cluster", "place") == [(1, 0, "a"), (1, 1, "b"), (2, 0, "c")]


def test_strain_errors(spark):
    df = spark.createDataFrame([("a", "P1", "s"), ("b", "P_2", "s t"), ("c", "P1", None)], "assembly_id string, locus_tag_prefix string, strain string")
    assert rows(src.strain_errors(df), "assembly_id", "error") == [("a", "repeated locus_tag_prefix"), ("b", "character in locus_tag_prefix"), ("b", "character in strain"), ("c", "empty strain"), ("c", "repeated locus_tag_prefix")]


def test_sinks(spark, tmp_path):
    scores = spark.createDataFrame([(1, 2, 0.5), (1, 3, 0.25), (2, 3, 1.0)], "rlocds_id_1 int, rlocds_id_2 int, score double")
    src.write_scores(scores.coalesce(1), str(tmp_path / "s"), 2)
    assert sorted(x[1] for x in rows(src.count_by_file(spark, str(tmp_path / "s")))) == [1, 2]
    base = spark.createDataFrame([(1, "a"), (2, "b")], "col int, v string")
    src.replace_collection(base, str(tmp_path / "t"), "col")
    src.replace_collection(base.where("col = 2").withColumn("v", F.lit("new")), str(tmp_path / "t"), "col")
    assert rows(spark.read.parquet(str(tmp_path / "t")).select("col", "v"), "col") == [(1, "a"), (2, "new")]


def test_codes_and_dates(spark):
    df = spark.createDataFrame([(1, "Escherichia coli", None, None), (2, "Escherichia coli", None, None), (3, "Rhizobium sp.", None, None), (4, "x y", None, "ABC"), (5, "x y", "me", "ABC"), (6, "Solo", None, None)], "assembly_id int, species string, user_code string, species_code string")
    assert rows(fn.genome_codes(df), "assembly_id") == [(1, "ESCCOL1"), (2, "ESCCOL2"), (3, "RHIZOB"), (4, "ABC"), (5, "ME"), (6, "SOL")]
    dates = lines(spark, "2010-05-03", "2010-05", "2010", "03-May-2010", "May-2010", "n/a").select("value", fn.collection_date(F.col("value")).alias("d")).select("value", "d.*")
    assert {r[0]: r[1:] for r in rows(dates)} == {"2010-05-03": (2010, 5, 3), "2010-05": (2010, 5, None), "2010": (2010, None, None), "03-May-2010": (2010, 5, 3), "May-2010": (2010, 5, None), "n/a": (None, None, None)}


def test_terms_and_labels(spark):
    df = lines(spark, "from Stool sample", "blood", "rock", None)
    groups = [("stool", "faeces"), ("blood", "serum", "blood")]
    assert [r[0] for r in rows(df.select(fn.standard_term(F.col("value"), groups, default="other")))] == ["faeces", "blood", "other", "other"]
    assert [r[0] for r in rows(df.select(fn.clinical_tags(F.col("value"), groups)))] == ["stool", "blood", None, None]
    refs = spark.createDataFrame([("g", "BioProject: P1, P2; Assembly: X; BioSample: S")], "k string, v string")
    assert rows(fn.explode_cross_references(refs, "k", "v"), "id") == [("g", "BioProject", "P1"), ("g", "BioProject", "P2"), ("g", "BioSample", "S")]
    assert fn.min_genomes("12", 40) == 12 and fn.min_genomes("0.98", 40) == 39
    one = lines(spark, "E [coli]").select(fn.organism_label(F.col("value"), F.lit("K1")), fn.tree_label(F.col("value"), F.lit("K1"), F.lit("EC")), fn.cds_family_id(F.lit("PRT0001"), "PRT", "CDS"), fn.label_prefix(F.lit("EC_12")), fn.clean_product(F.lit("a%2C b%3Bc")))
    assert rows(one) == [("E coli str. K1", "E_coli_str_K1__EC", "CDS0001", "EC", "a, b;c")]


def test_overrides_and_events(spark):
    df = spark.createDataFrame([(1, "x", "n"), (2, "y", None)], "id int, host string, note string")
    new = spark.createDataFrame([(1, "host", "'h'"), (1, "note", "m"), (2, "note", "k")], "id int, field string, value string")
    assert rows(fn.apply_overrides(df, new, "id", ["host", "note"]), "id") == [(1, "h", "n; m"), (2, "y", "k")]
    nodes = spark.createDataFrame([(1, ".T@a->b.D@c.d")], "node int, label string")
    assert rows(fn.explode_events(nodes), "place") == [(1, 0, "T", "a", "b"), (1, 1, "D", None, "c"), (1, 2, "S", None, "d")]


def test_cross_references_of_all_kinds(spark):
    df = spark.createDataFrame([("g", "Assembly: A1; BioProject: P1, P2", "12, 13"), ("h", None, None)], "k string, v string, pmid string")
    added = spark.createDataFrame([("SRA", "S9", "h")], "db string, id string, k string")
    assert rows(fn.cross_references(df, "k", "v", "pmid", added), "k", "id") == [("g", "PubMed", "12"), ("g", "PubMed", "13"), ("g", "BioProject", "P1"), ("g", "BioProject", "P2"), ("h", "SRA", "S9")]
    assert fn.cross_references(df, "k", "v", "pmid").where("k = 'h'").isEmpty()


def test_find_families(spark):
    df = spark.createDataFrame([(1, "DNA ligase 2"), (2, "ligase"), (None, "ligase"), (3, None)], "gene_family_id int, product string")
    assert rows(fn.find_families(df, ["2", "ligase", "none"]), "term", "gene_family_id") == [("2", 2), ("ligase", 1), ("ligase", 2)]
    assert rows(fn.find_families(df, [])) == []
    assert rows(fn.families_matching(df, "LIGASE$").where("gene_family_id IS NOT NULL")) == [(2,)]


def test_replicon_types_and_lab_strains(spark):
    kinds = spark.createDataFrame([({"genome": "ANONYMOUS"}, "genomic DNA"), ({"genome": "mitochondrion"}, "genomic DNA"), ({"chromosome": "1"}, "genomic DNA"), ({"plasmid-name": "p"}, "genomic DNA"), ({}, "other RNA")], "a map<string,string>, m string")
    assert rows(kinds.select(fn.replicon_type(F.col("a"), F.col("m")))) == [("chromosome",), ("mitochondrion",), ("chromosome",), ("plasmid",), ("other",)]
    strains = spark.createDataFrame([("Laboratory stock", "X y", "1"), (None, "Escherichia coli", "K12"), (None, "Escherichia coli", None), ("soil", "X y", "K12")], "f string, s string, t string")
    assert rows(strains.select(fn.is_lab_strain([F.col("f")], F.col("s"), F.col("t")))) == [(True,), (True,), (False,), (False,)]


def test_code_dump(spark):
    genes = spark.createDataFrame([("lcl|AB1.1_cds_1", "X_1"), ("AB1.1_cds_2", "X_2")], "genbank_cds_id string, cds_code string")
    assert rows(src.dump_codes(genes)) == [("AB1.1_cds_1", "X_1"), ("AB1.1_cds_2", "X_2")]


def test_clade_frequencies(spark):
    from genomill.operators.mapping import clade_frequencies

    df = spark.createDataFrame([("F", "c1\tA:2\tB:0.5"), ("F", "c2"), ("G", "c1\tB:1\tB:3"), ("G", "")], "family string, value string")
    assert rows(clade_frequencies(df, ["B", "A"]), "family", "clade") == [("F", "c1", 0.5, 2.0), ("F", "c2", 0.0, 0.0), ("G", "c1", 3.0, 0.0)]


def test_similarity_families(spark):
    from genomill.operators.similarity import similarity_families

    base = " ".join(f"w{i}" for i in range(60))
    texts = spark.createDataFrame([(5, base), (2, base + " x"), (9, base), (7, "a b"), (8, "a b"), (1, None), (3, "q r s t u v"), (4, "")], "id int, text string")
    assert rows(similarity_families(texts, 5, 0.75), "id") == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 2), (7, 7), (8, 7), (9, 2)]
    assert rows(similarity_families(texts.where("id < 0"), 5, 0.75)) == []

"""Readers of annotation and tree formats, and graph and tree operators, on small literal inputs."""

from genomill.operators import graphs, trees
from genomill.sources import formats as src


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_gff(spark):
    text = ["##gff-version 3", "gnl|Lab|C1\tx\tregion\t1\t900\t.\t+\t.\tID=r;Dbxref=taxon:42;Name=ANONYMOUS;genome=chromosome;strain=K", "P|2\tx\tregion\t1\t90\t.\t+\t.\tID=s;Dbxref=taxon:42;mol_type=genomic DNA;plasmid=p=1", "C1\tx\tgene\t10\t99\t.\t-\t.\tID=g1;locus_tag=L1", "C1\tx\tCDS\t80\t99\t.\t-\t0\tParent=g1;protein_id=gnl|Lab|A;product=a", "C1\tx\tCDS\t9\t60\t.\t-\t0\tParent=g1;protein_id=gnl|Lab|A;product=a", "C1\tx\tCDS\t70\t75\t.\t-\t0\tParent=g1;protein_id=B;product=b", "C1\tx\tgene\t200\t300\t.\t+\t.\tID=g2;locus_tag=L2", "C1\tx\ttRNA\t200\t300\t.\t+\t.\tID=t1;Parent=g2", ">C1", "ACGT"]
    features = src.read_gff(lines(spark, *text), "ASM")
    assert rows(src.gff_replicons(features), "region") == [("C1", "ANONYMOUS", "chromosome", 900, 42, "K"), ("P.2", "", "plasmid", 90, 42, "")]
    assert rows(src.gff_genes(features, src.CODING), "beg") == [("A", "C1", "L1", 9, 99, "-", "a"), ("B", "C1", "L1_1", 70, 75, "-", "b")]
    assert rows(src.gff_genes(features, src.RNA), "beg") == [("t1", "C1", "L2", 200, 300, "+", "")]


def test_genbank(spark, tmp_path):
    pad = " " * 21
    (tmp_path / "a.gbff").write_text(f"LOCUS       X\nDBLINK      BioProject: P1\n            BioSample: S1\nREFERENCE   1\n   PUBMED   11\nREFERENCE   2\n   PUBMED   22\nFEATURES             Location/Qualifiers\n     source          1..9\n{pad}/organism=\"Genus\n{pad}species\"\n{pad}/focus\n{pad}/db_xref=\"taxon:5\"\n     gene            1..3\n{pad}/gene=\"no\"\n     source          4..5\n{pad}/organism=\"Other\"\n")
    assert rows(src.read_genbank(spark, str(tmp_path)), "qualifier") == [("a.gbff", "db_xref", '"taxon:5"'), ("a.gbff", "dbxref", "BioProject: P1;BioSample: S1"), ("a.gbff", "organism", '"Genus species"'), ("a.gbff", "pubmed_id", "11,22")]


def test_organisms(spark):
    given = [("Brady sp", "", "", "", ""), ("Rhizobium etli subsp. x serovar y str. Z 1", "", "", "", ""), ("Aphis gossypii symbiont", "S", "", "", "h"), ("Buchnera endosymbiont of Aphis fabae (bacterium)", "", "", "", ""), ("Brady japonicum USDA 6", "", "iso", "v", ""), ("Candidatus Liber", "", "", "", "")]
    got = {r.organism: (r.species, r.subspecies, r.serovar, r.strain, r.host, r.ecology) for r in src.parse_organism(spark.createDataFrame(given, "organism string, strain string, isolate string, serovar string, host string"), "Genus").collect()}
    assert list(got.values()) == [("Brady sp", "", "", "", "", ""), ("Rhizobium etli", "x", "y", "Z 1", "", ""), ("Genus sp.", "", "", "S", "Aphis gossypii", "symbiont"), ("Buchnera sp.", "", "", "", "Aphis fabae", "symbiont"), ("Brady japonicum", "", "v", "iso", "", ""), ("Candidatus Liber sp.", "", "", "", "", "")]


def test_transfers(spark):
    got = rows(src.read_transfers(lines(spark, "1:7,S,5,6@1;7,SL,5,6@0.5:2,3", "g_1:5,TL,5,9@1;5,TTD,5,5@1;5,TFD,5,8@1;5,D,5,5@1;x,DD,-1,-1@0.1", "no events")), "segment", "at", "event_type")
    assert got == [("1", 0, "S", None, "7", 1.0), ("1", 1, "L", None, "5", 0.5), ("1", 1, "S", None, "7", 0.5), ("g_1", 0, "L", None, "5", 1.0), ("g_1", 0, "T", "5", "9", 1.0), ("g_1", 1, "T", "5", "-1", 1.0), ("g_1", 2, "T", "-1", "8", 1.0), ("g_1", 3, "D", None, "5", 1.0), ("g_1", 4, "D", None, "-1", 0.1)]


def test_trees(spark):
    given = spark.createDataFrame([("a", "((A:1,B:2)x:0.5,(C,(D,E)));"), ("b", "(A,B)root;"), ("c", "A;")], "tree string, newick string")
    got = rows(src.read_trees(given), "tree", "branch_id")
    assert [(r[1], r[2], r[3], r[4], r[5]) for r in got if r[0] == "a"] == [(0, None, "N0", None, False), (1, 0, "x", 0.5, False), (2, 1, "A", 1.0, True), (3, 1, "B", 2.0, True), (4, 0, "N4", None, False), (5, 4, "C", None, True), (6, 4, "N6", None, False), (7, 6, "D", None, True), (8, 6, "E", None, True)]
    assert [r[3] for r in got if r[0] == "b"] == ["root", "A", "B"] and [r[1:] for r in got if r[0] == "c"] == [(0, None, "A", None, True)]
    nodes = src.read_trees(given).where("tree = 'a'")
    tagged = nodes.replace({"A": "A_RC-clade1", "C": "C_RC-clade1", "N6": "q_CC-clade3"}, subset="branch_name")
    assert [r[3] for r in rows(trees.drop_tagged(tagged, trees.closure(tagged)), "branch_id")] == ["N0", "x", "A_RC-clade1", "B", "N4"]


def test_small_loads(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("1\t2\t0.5\n3\t4\t0.25\n")
    loaded = src.load_scores(spark, str(tmp_path), 7)
    assert rows(loaded, "score") == [(3, 4, 0.25, 7), (1, 2, 0.5, 7)]
    both = loaded.union(src.load_scores(spark, str(tmp_path), 8))
    assert src.collection_rows(both, "reconciliation_id", 7, True).count() == src.collection_rows(both, "reconciliation_id", 7, False).count() == 2
    one, two = spark.createDataFrame([("f", 1, 2)], "family string, g1 int, g2 int"), spark.createDataFrame([(3, "o")], "g2 int, family string")
    assert rows(src.union_matrices(one, two), "family") == [("f", 1, 2), ("o", 0, 3)]
    assert rows(src.read_replaced(lines(spark, "f\tc\tl", "x"), 3), "label") == [("f", "c", "l", 3)]
    records = spark.createDataFrame([("lcl|1", {"locus_tag": "L", "protein_id": "P"}), ("lcl|2", {})], "id string, tags map<string,string>")
    assert rows(src.cds_keys(records), "genbank_cds_id") == [("L", "P", "lcl|1"), ("", "", "lcl|2")]


def test_unicity(spark):
    edges = spark.createDataFrame([(1, 2, 5.0), (2, 3, 1.0), (3, 4, 4.0), (4, 5, 3.0), (7, 8, 1.0)], "a long, b long, weight double")
    species = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (4, "x"), (5, "z"), (7, "x"), (8, "y")], "node long, species string")
    got = dict(rows(graphs.enforce_unicity(edges, species), "node"))
    assert sorted(got) == [1, 2, 3, 4, 5, 7, 8] and len({(got[n], s) for n, s in rows(species, "node")}) == 7
    assert got[1] == got[2] and got[3] == got[4] and got[7] == got[8] and len(set(got.values())) == 4
    clean = dict(rows(graphs.enforce_unicity(edges.where("a = 7"), species), "node"))
    assert clean == {7: 7, 8: 7}


def test_reference_community(spark):
    edges = spark.createDataFrame([(a, b, 9.0) for a in range(1, 5) for b in range(a + 1, 5)] + [(a, b, 9.0) for a in range(11, 15) for b in range(a + 1, 15)] + [(4, 11, 0.1)], "a long, b long, weight double")
    assert {r.node for r in graphs.reference_community(edges, 2, 4, 5).collect()} == {1, 2, 3, 4}

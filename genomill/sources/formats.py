"""Readers of annotation and tree formats, by text functions, joins and windows; and loads that replace a collection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genomill.operators.sequences import running_sum
from genomill.operators.trees import settle

#: Feature types whose rows go to the table of coding sequences, and those of RNA genes.
CODING, RNA = ["CDS"], ["rRNA", "tRNA", "ncRNA", "tmRNA", "SRP_RNA", "RNase_P_RNA", "antisense_RNA"]


def _attribute(name: str) -> Column:
    return F.try_element_at("attributes", F.lit(name))


def read_gff(lines: DataFrame, assembly: str) -> DataFrame:
    """A3: region, type, beg, end, strand, attributes (a map) of the feature lines of `lines` (value); comments and sequences left out.

    A region `gnl|centre|id` is its id; other bars become points, an empty beginning the assembly's name.
    """
    parts = lines.where("value NOT LIKE '#%' AND value NOT LIKE '>%'").select(F.split("value", "\t").alias("p")).where("size(p) >= 9")
    name = F.split(F.col("p")[0], r"\|")
    region = F.when(name[0] == "gnl", F.element_at(name, -1)).otherwise(F.concat_ws(".", F.when(name[0] == "", F.lit(assembly)).otherwise(name[0]), F.when(F.size(name) > 1, F.array_join(F.slice(name, 2, F.greatest(F.size(name) - 1, F.lit(1))), "."))))
    pairs = F.filter(F.split(F.col("p")[8], ";"), lambda x: x.contains("="))
    attributes = F.map_from_entries(F.transform(pairs, lambda x: F.struct(F.substring_index(x, "=", 1).alias("k"), F.regexp_replace(x, "^[^=]*=", ""))))
    return parts.select(region.alias("region"), F.col("p")[2].alias("type"), F.col("p")[3].cast("long").alias("beg"), F.col("p")[4].cast("long").alias("end"), F.col("p")[6].alias("strand"), attributes.alias("attributes"))


def gff_replicons(features: DataFrame) -> DataFrame:
    """A3: region, name, kind, size, taxid, strain of the regions that begin at 1; kind by `genome`, else by a chromosome or plasmid attribute, else the molecule's type."""
    kind = F.coalesce(_attribute("genome"), F.when(F.map_contains_key("attributes", "chromosome"), "chromosome").when(F.map_contains_key("attributes", "plasmid"), "plasmid").otherwise(F.split(F.coalesce(_attribute("mol_type"), F.lit("genomic")), " ")[0]))
    taxid = F.regexp_extract(F.coalesce(_attribute("Dbxref"), F.lit("")), r"taxon:(\d+)", 1).try_cast("long")
    return features.where("type = 'region' AND beg = 1").select("region", F.coalesce(_attribute("Name"), F.lit("")).alias("name"), kind.alias("kind"), F.col("end").alias("size"), taxid.alias("taxid"), F.coalesce(_attribute("strain"), F.lit("")).alias("strain")).distinct()


def gff_genes(features: DataFrame, types: list[str]) -> DataFrame:
    """A3: product_id, region, locus_tag, beg, end, strand, product of features of `types`, segments of one gene and product merged (smallest begin, largest end).

    Where the segments of a gene name several products, each but the first (by begin) has a locus tag with its number.
    """
    genes = features.where("type IN ('gene', 'pseudogene')").select("region", _attribute("ID").alias("parent"), _attribute("locus_tag").alias("locus_tag"))
    product = F.element_at(F.split(F.coalesce(_attribute("protein_id"), _attribute("ID"), F.lit("")), r"\|"), -1) if types == CODING else F.coalesce(_attribute("ID"), F.lit(""))
    own = features.where(F.col("type").isin(types)).select("region", _attribute("Parent").alias("parent"), product.alias("product_id"), "beg", "end", "strand", F.coalesce(_attribute("product"), F.lit("")).alias("product"))
    merged = own.join(genes, ["region", "parent"]).groupBy("region", "parent", "locus_tag", "product_id").agg(F.min("beg").alias("beg"), F.max("end").alias("end"), F.min("strand").alias("strand"), F.min_by("product", "beg").alias("product"))
    place = F.row_number().over(Window.partitionBy("region", "parent").orderBy("beg", "product_id")) - 1
    return merged.withColumn("_n", place).select("product_id", "region", F.when(F.col("_n") == 0, F.col("locus_tag")).otherwise(F.concat_ws("_", "locus_tag", F.col("_n").cast("string"))).alias("locus_tag"), "beg", "end", "strand", "product")


def cds_keys(records: DataFrame) -> DataFrame:
    """A4: locus_tag, protein_id, genbank_cds_id of FASTA records (id, tags): the key by which annotation finds a sequence."""
    tag = lambda name: F.coalesce(F.try_element_at("tags", F.lit(name)), F.lit(""))
    return records.select(tag("locus_tag").alias("locus_tag"), tag("protein_id").alias("protein_id"), F.col("id").alias("genbank_cds_id"))


def read_genbank(spark: SparkSession, path: str) -> DataFrame:
    """A5: file, qualifier, value of GenBank flat files: database links (`dbxref`, joined by `;`), `pubmed_id` (joined by `,`), and the qualifiers of the first source or region feature, with their continuation lines.

    Files are read record by record (they end with `//`), so that a large one is dealt over many tasks; the first record of a file
    tells of it, and sequences are left out before anything is moved.
    """
    whole = spark.read.text(path, lineSep="\n//\n").select(F.col("_metadata.file_name").alias("file"), F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("_at"), F.regexp_replace("value", "\r", "").alias("t"))
    records = whole.where("trim(t) <> ''").select("file", "_at", F.substring_index("t", "\nORIGIN", 1).alias("t"))
    files = records.groupBy("file").agg(F.min_by("t", "_at").alias("t"))
    head, rest = F.regexp_replace("t", r"(?s)\nFEATURES    .*$", ""), F.regexp_extract("t", r"(?s)\nFEATURES    [^\n]*\n(.*)$", 1)
    links = F.regexp_replace(F.regexp_extract(head, r"(?:^|\n)DBLINK      ([^\n]*(?:\n            [^\n]*)*)", 1), r"\n {12}", ";")
    pubmed = F.array_join(F.regexp_extract_all(head, F.lit(r"\n   PUBMED   ([^\n]*)"), 1), ",")
    block = F.concat(F.lit("\n"), F.regexp_extract(rest, r"(?:^|\n)     (?:source|region) [^\n]*((?:\n {21}[^\n]*)*)", 1))
    names, values = (F.regexp_extract_all(block, F.lit(r"\n {21}/([^=\n]+)=([^\n]*(?:\n {21}(?!/)[^\n]*)*)"), i) for i in (1, 2))
    found = F.zip_with(names, values, lambda k, v: F.struct(F.regexp_replace(F.lower(k), "^dbxref$", "db_xref").alias("qualifier"), F.regexp_replace(v, r"\n +", " ").alias("value")))
    every = F.concat(F.array(F.struct(F.lit("dbxref").alias("qualifier"), links.alias("value")), F.struct(F.lit("pubmed_id").alias("qualifier"), pubmed.alias("value"))), found)
    return files.select("file", F.explode(every).alias("q")).select("file", "q.qualifier", "q.value").where("value <> ''")


def parse_organism(rows: DataFrame, default_species: str = "") -> DataFrame:
    """`rows` (organism, strain, isolate, serovar, host; empty: unknown) with species, subspecies, serovar, strain, host, ecology by the organism's name.

    `X symbiont`: X is the host. `Y (endo)symbiont of X`: Y the species, X the host, a closing bracket left out. Else two words are
    the species, followed by `subsp. s`, `serovar v` or `sv. v`, `str. t`; a strain that isn't known is the isolate or the last word.
    """
    name = F.trim("organism")
    words = F.split(name, r"\s+")
    symbiont = name.contains("symbiont")
    of = r"^(.*?)\s*(?:(?:primary |secondary )?endo)?symbiont of\s+(.*)$"
    last = F.element_at(words, -1).endswith("symbiont")
    head = F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), " ")
    species = F.when(symbiont & last, "").when(symbiont, F.regexp_extract(name, of, 1)).otherwise(F.array_join(F.slice(words, 1, 2), " "))
    species = F.when(species == "", F.lit(default_species)).otherwise(species)
    genus = F.when(species.rlike(r"^(Candidatus )?[A-Z]\S*$"), F.concat(species, F.lit(" sp."))).otherwise(species)
    host = F.when(symbiont & last, head).when(symbiont, F.regexp_replace(F.regexp_extract(name, of, 2), r" \([^)]*\)$", "")).otherwise(F.col("host"))
    part = lambda pattern, other: F.when(~symbiont & name.rlike(pattern), F.regexp_extract(name, pattern, 1)).otherwise(other)
    strain = F.when(F.col("strain") != "", F.col("strain")).when(~symbiont & name.rlike(r" str\. \S"), F.regexp_extract(name, r" str\. (.+)$", 1)).when(~symbiont & (F.size(words) > 3), F.when(F.col("isolate") != "", F.col("isolate")).otherwise(F.element_at(words, -1))).otherwise("")
    return rows.select(*[c for c in rows.columns if c not in ("strain", "serovar", "host")], genus.alias("species"), part(r"^\S+ \S+ subsp\. (\S+)", F.lit("")).alias("subspecies"), part(r" (?:serovar|sv\.) (\S+)", F.col("serovar")).alias("serovar"), strain.alias("strain"), F.coalesce(host, F.lit("")).alias("host"), F.when(symbiont, "symbiont").otherwise("").alias("ecology"))


def read_transfers(lines: DataFrame, dead: str = "-1") -> DataFrame:
    """Segment, at, event_type, don, rec, freq of reconciliation lines `segment:events[:children]`, events `place,type,end,end@freq` joined by `;`.

    S and D are events of their place, DD of the dead; SL is a speciation and a loss in the end that is lost; transfers go from the
    place to its other end (TTD, TLTD: to the dead; TFD, TLFD: from the dead), TL also loses the gene in the giver.
    """
    parts = F.split("value", ":")
    events = lines.where("value LIKE '%:%'").select(parts[0].alias("segment"), F.posexplode(F.filter(F.split(parts[1], ";"), lambda x: x != "")).alias("at", "e"))
    fields = F.split(F.substring_index("e", "@", 1), ",")
    e = events.select("segment", "at", F.substring_index("e", "@", -1).cast("double").alias("freq"), fields[0].alias("o"), fields[1].alias("k"), fields[2].alias("x"), F.get(fields, F.lit(3)).alias("y"))
    other = F.when(F.col("x") == F.col("o"), F.col("y")).otherwise(F.col("x"))
    don, rec = F.when(F.col("k").endswith("FD"), F.lit(dead)).otherwise(F.col("o")), F.when(F.col("k").endswith("TD"), F.lit(dead)).otherwise(other)
    event = lambda kind, d, r: F.struct(F.lit(kind).alias("event_type"), d.cast("string").alias("don"), r.cast("string").alias("rec"))
    none, moved = F.lit(None), F.col("k").startswith("T")
    found = F.filter(F.array(
        F.when(F.col("k").isin("S", "SL"), event("S", none, F.col("o"))),
        F.when(F.col("k") == "SL", event("L", none, F.col("x"))),
        F.when(F.col("k") == "D", event("D", none, F.col("o"))).when(F.col("k") == "DD", event("D", none, F.lit(dead))),
        F.when(F.col("k").startswith("TL") & (don != dead), event("L", none, don)),
        F.when(moved, event("T", don, rec)),
    ), lambda x: x.isNotNull())
    return e.select("segment", "at", F.explode(found).alias("f"), "freq").select("segment", "at", "f.*", "freq")


#: Tokens of a tree that is read inside its row; larger ones are dealt over many tasks.
SMALL_TREE = 512
TOKENS = r"([(),;]|[^(),;\s][^(),;]*)"


def _sign(t: Column) -> Column:
    return t.isin("(", ")", ",", ";")


def _balanced(tokens: Column) -> Column:
    """Whether each closing bracket of a row's tokens has an opening one before it, and each opening one is closed."""
    step = lambda t: F.when(t == "(", 1).when(t == ")", -1).otherwise(0)
    depth = F.aggregate(tokens, F.struct(F.lit(0).alias("d"), F.lit(0).alias("low")), lambda x, t: F.struct((x["d"] + step(t)).alias("d"), F.least(x["low"], x["d"] + step(t)).alias("low")))
    return (depth["d"] == 0) & (depth["low"] == 0)


def _small_trees(trees: DataFrame) -> DataFrame:
    """tree, branch_id, parent_branch_id, label, is_tip of small trees with balanced brackets: each is read inside its row, by a stack of open brackets."""
    kind = "array<struct<branch_id:int,parent_branch_id:int,label:string,is_tip:boolean>>"
    start = F.struct(F.array().cast("array<int>").alias("open"), F.lit(0).alias("n"), F.array().cast(kind).alias("nodes"), F.lit("").alias("before"))

    def step(x: Column, item: Column) -> Column:
        t, above = item["t"], F.get(x["open"], F.size(x["open"]) - 2)
        top = F.get(x["open"], F.size(x["open"]) - 1)
        node = lambda number, parent, label, is_tip: F.concat(x["nodes"], F.array(F.struct(number.alias("branch_id"), parent.alias("parent_branch_id"), label.alias("label"), F.lit(is_tip).alias("is_tip"))))
        tip = ~_sign(t) & (x["before"] != ")")
        opened = F.when(t == "(", F.concat(x["open"], F.array(x["n"]))).when(t == ")", F.slice(x["open"], F.lit(1), F.size(x["open"]) - 1)).otherwise(x["open"])
        nodes = F.when(t == ")", node(top, above, F.when(~_sign(item["after"]), item["after"]), False)).when(tip, node(x["n"], top, t, True)).otherwise(x["nodes"])
        return F.struct(opened.alias("open"), (x["n"] + F.when((t == "(") | tip, 1).otherwise(0)).alias("n"), nodes.alias("nodes"), t.alias("before"))

    split = trees.select("tree", F.regexp_extract_all("newick", F.lit(TOKENS), 1).alias("ts"))
    items = F.transform("ts", lambda t, i: F.struct(t.alias("t"), F.get(F.col("ts"), i + 1).alias("after")))
    return split.select("tree", F.explode(F.aggregate(items, start, step, lambda x: x["nodes"])).alias("x")).select("tree", "x.*")


def read_trees(trees: DataFrame, block: int = 100_000) -> DataFrame:
    """Tree, branch_id (from 0 in pre-order), parent_branch_id, branch_name, length, is_tip of Newick texts `trees` (tree, newick).

    Inner nodes without a name are called N and their number. A tree of up to SMALL_TREE (and `block`) tokens is read inside its row,
    others in blocks of tokens (`_large_trees`). Names of trees are distinct; a null text has no nodes.
    """
    tokens = F.regexp_extract_all("newick", F.lit(TOKENS), 1)
    texts = trees.where("newick IS NOT NULL").select("tree", "newick", tokens.alias("_ts"))
    texts = settle(texts.select("tree", "newick", ((F.size("_ts") <= min(SMALL_TREE, block)) & _balanced(F.col("_ts"))).alias("_small")))
    found, large = _small_trees(texts.where("_small")), texts.where("NOT _small")
    if not large.isEmpty():
        found = found.unionByName(_large_trees(large, block))
    label = F.regexp_replace(F.coalesce("label", F.lit("")), ":.*$", "")
    return found.select("tree", "branch_id", "parent_branch_id", F.when(label != "", label).otherwise(F.concat(F.lit("N"), F.col("branch_id").cast("string"))).alias("branch_name"), F.regexp_extract(F.coalesce("label", F.lit("")), r":([^:]*)$", 1).try_cast("double").alias("length"), "is_tip")


def _large_trees(trees: DataFrame, block: int) -> DataFrame:
    """tree, branch_id, parent_branch_id, label, is_tip of trees of any size.

    Depths are sums over blocks of `block` tokens, carried from block to block, and brackets of one depth open and close in turn, so
    that numbers within a depth match them: a tree of any size is dealt over many tasks.
    """
    split = trees.select("tree", F.regexp_extract_all("newick", F.lit(TOKENS), 1).alias("ts"))
    beside = lambda i, step: F.get(F.col("ts"), i + step)
    items = F.transform("ts", lambda t, i: F.struct(i.cast("long").alias("at"), t.alias("t"), beside(i, -1).alias("_before"), beside(i, 1).alias("_after")))
    tokens = settle(split.select("tree", F.explode(items).alias("x")).select("tree", "x.*").withColumn("_step", F.when(F.col("t") == "(", 1).when(F.col("t") == ")", -1).otherwise(0)))
    tokens = settle(running_sum(tokens, ["tree"], "at", "_step", "d", block).withColumn("own", F.lit(1)))
    opens = settle(running_sum(settle(tokens.where("t = '('")), ["tree", "d"], "at", "own", "i", block))
    closing = tokens.where("t = ')'").select("tree", (F.col("d") + 1).alias("d"), "at", "own", F.when(~_sign(F.col("_after")), F.col("_after")).alias("label"))
    closes = running_sum(settle(closing), ["tree", "d"], "at", "own", "i", block).drop("at", "own")
    inner = opens.join(closes, ["tree", "d", "i"]).select("tree", "at", (F.col("d") - 1).alias("up"), "label", F.lit(False).alias("is_tip"))
    tips = tokens.where(~_sign(F.col("t")) & (F.coalesce("_before", F.lit("")) != ")")).select("tree", "at", F.col("d").alias("up"), F.col("t").alias("label"), F.lit(True).alias("is_tip"))
    nodes = settle(inner.unionByName(tips).withColumn("own", F.lit(1)))
    numbered = settle(running_sum(nodes, ["tree"], "at", "own", "_n", block).select("tree", "at", "up", "label", "is_tip", (F.col("_n") - 1).cast("int").alias("branch_id")))
    # the parent: the bracket of the depth above that opened last, that is, as many as have opened there so far
    asked = settle(nodes.select("tree", "at", F.col("up").alias("d"), F.lit(0).alias("own")).unionByName(opens.select("tree", "at", "d", F.lit(1).alias("own"))).withColumn("at2", 2 * F.col("at") + F.col("own")))
    above = running_sum(asked, ["tree", "d"], "at2", "own", "i", 2 * block).where("own = 0").select("tree", "at", "d", "i")
    parents = above.join(opens.select("tree", "d", "i", F.col("at").alias("parent")), ["tree", "d", "i"]).select("tree", "at", "parent")
    up = numbered.select("tree", F.col("at").alias("parent"), F.col("branch_id").alias("parent_branch_id"))
    return numbered.join(parents, ["tree", "at"], "left").join(up, ["tree", "parent"], "left").select("tree", "branch_id", "parent_branch_id", "label", "is_tip")


def load_scores(spark: SparkSession, path: str, collection: int) -> DataFrame:
    """rlocds_id_1, rlocds_id_2, score, reconciliation_id of score files in parts (tab-separated, no header)."""
    return spark.read.csv(path, sep="\t", schema="rlocds_id_1 long, rlocds_id_2 long, score double").withColumn("reconciliation_id", F.lit(collection))


def union_matrices(first: DataFrame, second: DataFrame) -> DataFrame:
    """The rows of two matrices of the same columns, whatever their order; a column that one lacks counts 0 there."""
    both = first.unionByName(second, allowMissingColumns=True)
    return both.fillna(0, [c for c, kind in both.dtypes if kind in ("bigint", "int")])


def collection_rows(df: DataFrame, column: str, collection: int, keep: bool) -> DataFrame:
    """The rows of one collection alone, or all but those."""
    own = F.coalesce(F.col(column) == collection, F.lit(False))
    return df.where(own if keep else ~own)


def read_replaced(lines: DataFrame, replace_id: int) -> DataFrame:
    """Family, clade_or_cds, label, replace_id of `family<tab>clade or cds<tab>label` lines."""
    p = F.split("value", "\t")
    return lines.where("value LIKE '%\t%\t%'").select(p[0].alias("gene_family_id"), p[1].alias("clade_or_cds"), p[2].alias("label"), F.lit(replace_id).alias("replace_id"))

"""Annotation of pairs, vertices, communities and clade-specific genes; contrasts of clades."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genomill.operators.graphs import community_edges, small_communities
from genomill.operators.trees import settle


def annotate_pairs(pairs: DataFrame, annotation: DataFrame, first: str, second: str, key: str) -> DataFrame:
    """C14: `pairs` with the annotation of both ends, its columns ending in _1 and _2."""
    for i, column in ((1, first), (2, second)):
        pairs = pairs.join(annotation.select(*[F.col(c).alias(column if c == key else f"{c}_{i}") for c in annotation.columns]), column, "left")
    return pairs


def annotate_vertices(vertices: DataFrame, *attributes: DataFrame) -> DataFrame:
    """Vertices (node, ...) with the columns of each table of attributes (node, ...), null where it has none."""
    return reduce(lambda df, own: df.join(own, "node", "left"), attributes, vertices)


def community_tables(edges: DataFrame, communities: DataFrame, annotation: DataFrame, places: DataFrame) -> DataFrame:
    """I8: edges inside communities with both ends' annotation (node, ...), and whether some replicon holds both. `places` (node, replicon)."""
    inside = community_edges(edges, communities)
    a, b = (places.select(F.col("node").alias(x), "replicon").distinct() for x in ("a", "b"))
    together = inside.select("a", "b").distinct().join(a, "a").join(b, ["b", "replicon"]).select("a", "b").distinct().withColumn("_t", F.lit(True))
    return annotate_pairs(inside, annotation, "a", "b", "node").join(together, ["a", "b"], "left").withColumn("same_replicon", F.coalesce("_t", F.lit(False))).drop("_t")


def community_events(communities: DataFrame, lineages: DataFrame, events: DataFrame, most: int) -> DataFrame:
    """Events of the members of communities with at most `most` of them: how many members have each, and their summed frequency."""
    own = small_communities(communities, most).join(lineages.withColumnRenamed("rlocds_id", "node"), "node")
    return own.groupBy("community", "event_id").agg(F.count("*").alias("n_members"), F.sum("freq").alias("freq")).join(events, "event_id")


def contrast_with(definitions: DataFrame, column: str) -> DataFrame:
    """Clade, genome, side of clade definitions (clade, members and others, comma lists): `column` names the contrast, less the clade itself."""
    lists = lambda c: definitions.select("clade", F.explode(F.split(c, ",")).alias("genome")).select("clade", F.trim("genome").alias("genome")).where("genome <> ''").distinct()
    inside = lists("members")
    outside = lists(column).join(inside, ["clade", "genome"], "left_anti")
    return inside.withColumn("side", F.lit("clade")).unionByName(outside.withColumn("side", F.lit("contrast")))


def specific_gene_annotation(specific: DataFrame, groups: DataFrame, genes: DataFrame, clades: DataFrame, collection: int) -> DataFrame:
    """Genes in the clade's genomes of what is specific to it: of a group its members, of a family without group all genes.

    `specific` (clade, gene_family_id, og_id or null), `groups` (gene_family_id, og_id, cds_code, ortholog_col_id), `genes` (gene_family_id, cds_code, genome, ...).
    """
    members = groups.where(F.col("ortholog_col_id") == collection).select("gene_family_id", "og_id", "cds_code")
    grouped = specific.where("og_id IS NOT NULL").join(members, ["gene_family_id", "og_id"]).join(genes, ["gene_family_id", "cds_code"])
    whole = specific.where("og_id IS NULL").join(genes, "gene_family_id")
    return grouped.unionByName(whole).join(clades.where("side = 'clade'").select("clade", "genome"), ["clade", "genome"]).distinct()


def specific_gene_details(annotated: DataFrame, terms: DataFrame, references: DataFrame | None = None) -> DataFrame:
    """E5: terms of specific genes (E4), those of each clade's reference genome alone if `references` (clade, genome) are given, else of all sequences."""
    if references is not None:
        annotated = annotated.join(references, ["clade", "genome"], "left_semi")
    return annotated.join(terms, "nr_protein_id").where("go_id IS NOT NULL").select("clade", "gene_family_id", "cds_code", "go_id").distinct()


def specificity_breaches(counts: DataFrame, clades: DataFrame, families: DataFrame) -> DataFrame:
    """For each of `families` (clade, gene_family_id) the clade's genomes that lack it and the contrast's that have it, as sorted lists."""
    inside = families.join(clades, "clade").join(counts.select("genome", "gene_family_id", F.lit(1).alias("_has")), ["genome", "gene_family_id"], "left")
    listed = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("genome").cast("string")))), ",")
    return inside.groupBy("clade", "gene_family_id").agg(listed((F.col("side") == "clade") & F.col("_has").isNull()).alias("lacking"), listed((F.col("side") == "contrast") & F.col("_has").isNotNull()).alias("having"))


def _term_sets(terms: DataFrame, rows_a_task: int = 1_000_000) -> DataFrame:
    """nr_protein_id, _terms: the distinct terms of each protein as one array. Rows of terms are dealt by number before they are collected, so that no task holds more as the table grows."""
    terms = terms.select("nr_protein_id", "go_id")
    return terms.repartition(terms.count() // rows_a_task + 1, "nr_protein_id").groupBy("nr_protein_id").agg(F.collect_set(F.struct("go_id")).alias("_terms"))


def clade_core_background(genes: DataFrame, terms: DataFrame, clades: DataFrame) -> DataFrame:
    """Per clade the families with exactly one gene in each of its genomes, the gene of the clade's first genome, and that gene's terms."""
    inside = clades.where("side = 'clade'").select("clade", "genome").distinct()
    sizes = inside.groupBy("clade").agg(F.count("*").alias("_n"))
    held = genes.where("gene_family_id IS NOT NULL").join(inside, "genome").groupBy("clade", "gene_family_id").agg(F.count("*").alias("_s"), F.countDistinct("genome").alias("_g"), F.min(F.struct("genome", "cds_code", "nr_protein_id")).alias("_m"))
    core = held.join(sizes, "clade").where("_s = _n AND _g = _n").select("clade", "gene_family_id", "_m.cds_code", "_m.nr_protein_id")
    # a family has one gene here, so that its distinct terms are those of one array
    return core.join(_term_sets(terms), "nr_protein_id").select("clade", "gene_family_id", "cds_code", F.explode("_terms.go_id").alias("go_id"))


def pan_background(genes: DataFrame, terms: DataFrame, clades: DataFrame, empty: bool = True) -> DataFrame:
    """The families and their terms in the whole set (clade null) and in each clade; `empty`: also families without terms (term null).

    Families and proteins are made distinct before they meet terms, and terms stay arrays until each family has its own.
    """
    own = settle(genes.where("gene_family_id IS NOT NULL").select("genome", "gene_family_id", "nr_protein_id").distinct())
    listed = clades.where("side = 'clade'").select("clade", "genome")
    held = own.select(F.lit(None).cast(clades.schema["clade"].dataType).alias("clade"), "gene_family_id", "nr_protein_id").distinct()
    held = held.unionByName(own.join(listed, "genome").select("clade", "gene_family_id", "nr_protein_id").distinct())
    known = held.join(_term_sets(terms), "nr_protein_id", "left" if empty else "inner")
    none = F.array(F.struct(F.lit(None).cast(terms.schema["go_id"].dataType).alias("go_id")))
    merged = known.groupBy("clade", "gene_family_id").agg(F.array_distinct(F.flatten(F.collect_list(F.coalesce("_terms", none)))).alias("_terms"))
    return merged.select("clade", "gene_family_id", F.explode("_terms.go_id").alias("go_id"))


def shared_rows(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows that both tables have, once each."""
    return first.intersect(second)


def matches_with_aliases(first: DataFrame, second: DataFrame, aliases: DataFrame) -> DataFrame:
    """Pairs of events (id, event_type, don, rec) that name the same places, each by its own name or by that of its population; an event of `first` counts once.

    `aliases` (place, population). Among several matches the one of the smallest id is taken.
    """

    aliases = aliases.select(F.col("place").cast("string").alias("place"), F.col("population").cast("string").alias("_p")).where("place IS NOT NULL")

    def named(events: DataFrame) -> DataFrame:
        for c in ("don", "rec"):
            own = F.coalesce(F.col(c).cast("string"), F.lit(""))
            events = events.withColumn(c, own).join(aliases.withColumnRenamed("place", c), c, "left").withColumn(f"{c}_name", F.explode(F.array_distinct(F.array(F.col(c), F.coalesce("_p", c))))).drop("_p")
        return events.select("id", "event_type", "don_name", "rec_name").distinct()

    keys = ["event_type", "don_name", "rec_name"]
    # the smallest of each name first, so that the join gives no more rows than `first` has names
    least = named(second).groupBy(*keys).agg(F.min("id").alias("id_2"))
    return named(first).join(least, keys).groupBy(F.col("id").alias("id_1")).agg(F.min("id_2").alias("id_2"))

"""Labels, members and populations: which gene a label stands for, what a group's members are, how clades spread over populations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genomill.operators.graphs import components
from genomill.operators.sequences import number_rows


def label_to_family(cds: DataFrame, replaced: DataFrame, events: DataFrame) -> DataFrame:
    """C11, G1: label, gene_family_id, label_no of genes and replaced labels that some event has; numbered in order."""
    named = cds.select("label", "gene_family_id").unionByName(replaced.select("label", "gene_family_id")).distinct()
    return number_rows(named.join(events.select("label"), "label", "left_semi"), ["label", "gene_family_id"], "label_no")


def label_to_cds(cds: DataFrame, replaced: DataFrame, collapsed: DataFrame, events: DataFrame) -> DataFrame:
    """Label, cds_code: genes themselves, single genes that a label replaced, and members of clades that one replaced.

    `cds` (cds_code), `replaced` (gene_family_id, clade_or_cds, label), `collapsed` (gene_family_id, clade, cds_code).
    """
    itself = cds.select(F.col("cds_code").alias("label"), "cds_code")
    single = replaced.withColumnRenamed("clade_or_cds", "cds_code").join(cds.select("cds_code"), "cds_code", "left_semi").select("label", "cds_code")
    clade = replaced.withColumnRenamed("clade_or_cds", "clade").join(collapsed, ["gene_family_id", "clade"]).select("label", "cds_code")
    return itself.unionByName(single).unionByName(clade).distinct().join(events.select("label"), "label", "left_semi")


def replaced_labels(cds: DataFrame, replaced: DataFrame, collapsed: DataFrame) -> DataFrame:
    """cds_code, label: the label that replaced a gene, or the first one (in order) that replaced a clade it was collapsed into; else itself.

    `cds` (cds_code, gene_family_id), `replaced` (gene_family_id, clade_or_cds, label), `collapsed` (gene_family_id, clade, cds_code).
    """
    key = ["gene_family_id", "cds_code"]
    single = replaced.select("gene_family_id", F.col("clade_or_cds").alias("cds_code"), "label", F.lit(0).alias("_by"))
    clade = collapsed.join(replaced.withColumnRenamed("clade_or_cds", "clade"), ["gene_family_id", "clade"]).select(*key, "label", F.lit(1).alias("_by"))
    first = single.unionByName(clade).groupBy(*key).agg(F.min_by("label", F.struct("_by", "label")).alias("label"))
    return cds.select(*key).distinct().join(first, key, "left").select(*key, F.coalesce("label", "cds_code").alias("label"))


def translate_ids(df: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """`column` by the names of a table (old, new); rows without a name go."""
    return df.withColumnRenamed(column, "old").join(names.select("old", "new"), "old").withColumnRenamed("new", column).select(*df.columns)


def to_representative(df: DataFrame, groups: DataFrame, column: str) -> DataFrame:
    """C20: `column` by the representative of its group (member, representative); others stay."""
    joined = df.join(groups.select(F.col("member").alias(column), F.col("representative").alias("_r")), column, "left")
    return joined.withColumn(column, F.coalesce("_r", column)).select(*df.columns)


def expand_members(df: DataFrame, groups: DataFrame, column: str) -> DataFrame:
    """C20: a row of each member of the group for each row of a representative."""
    joined = df.withColumnRenamed(column, "representative").join(groups.select("member", "representative"), "representative")
    return joined.withColumnRenamed("member", column).select(*df.columns)


def member_annotation(groups: DataFrame, genes: DataFrame, collection: int) -> DataFrame:
    """The distinct products of all members of each group of a collection. `genes` (rlocds_id, product)."""
    return groups.where(F.col("ortholog_col_id") == collection).join(genes, "rlocds_id").select("gene_family_id", "og_id", "product").distinct()


def clade_profiles(members: DataFrame, species: Sequence[str]) -> DataFrame:
    """Members of each clade by species, a column for each of the given species in order. `members` (clade, species)."""
    return members.groupBy("clade").pivot("species", list(species)).agg(F.count(F.lit(1))).fillna(0)


def clade_frequencies(lines: DataFrame, populations: Sequence[str]) -> DataFrame:
    """Family, clade, and a column for each population in order, from lines `clade<TAB>pop:freq<TAB>pop:freq`; absent ones are 0. `lines` (family, value).

    Of a population that a line names twice the last frequency counts.
    """
    cells = F.slice(F.split("value", "\t"), 2, F.greatest(F.size(F.split("value", "\t")) - 1, F.lit(0)))
    of = lambda p: F.element_at(F.concat(F.array(F.lit("0")), F.transform(F.filter("_f", lambda c: F.substring_index(c, ":", 1) == p), lambda c: F.substring_index(c, ":", -1))), -1)
    split = lines.where("value <> ''").select("family", F.substring_index("value", "\t", 1).alias("clade"), cells.alias("_f"))
    return split.select("family", "clade", *[of(p).try_cast("double").alias(p) for p in populations])


def population_occurrence(counts: DataFrame, populations: DataFrame) -> DataFrame:
    """Clade, population, census, mean and median of the counts over all members of a population, absent ones as 0.

    `counts` (clade, genome, n), `populations` (population, genome). No grid is made: zeros are counted, not written.
    """
    census = populations.groupBy("population").agg(F.count("*").alias("census"))
    seen = counts.join(populations, "genome").groupBy("clade", "population").agg(F.sum("n").alias("_sum"), F.array_sort(F.collect_list("n")).alias("_n")).join(census, "population")
    zeros = F.col("census") - F.size("_n")
    at = lambda i: F.when(i < zeros, F.lit(0)).otherwise(F.try_element_at("_n", (i - zeros + 1).cast("int")))
    median = (at(F.floor((F.col("census") - 1) / 2)) + at(F.floor(F.col("census") / 2))) / 2
    return seen.select("clade", "population", "census", F.round(F.col("_sum") / F.col("census"), 9).alias("mean"), median.alias("median"))


def ancestral_population(occurrence: DataFrame, depth: DataFrame) -> DataFrame:
    """the population that ranks first for each clade: at home (median 0.5 or more, more than one member), nearest to the root,
    largest, most frequent; ties to the smaller. `depth` (population, depth)."""
    home = ((F.col("median") >= 0.5) & (F.col("census") > 1)).cast("int")
    rank = F.struct(home, -F.col("depth"), F.col("census"), F.col("mean"), -F.col("population"))
    return occurrence.join(depth, "population").groupBy("clade").agg(F.max_by("population", rank).alias("population"))


def name_populations(members: DataFrame) -> DataFrame:
    """the most frequent three letters of a population's members (ties: the first), and a number among populations of these letters."""
    often = members.groupBy("population", F.substring("label", 1, 3).alias("_p")).agg(F.count("*").alias("_n"))
    best = often.groupBy("population").agg(F.min_by("_p", F.struct(-F.col("_n"), "_p")).alias("_p"))
    return best.select("population", F.concat("_p", F.row_number().over(Window.partitionBy("_p").orderBy("population")).cast("string")).alias("name"))


def pool_populations(distances: DataFrame, most: int) -> DataFrame:
    """Populations at most so many edges apart, directly or by way of others, as one: pool, members. `distances` (tip_1, tip_2, distance)."""
    return pools(distances.where(F.col("distance") <= most).select(F.col("tip_1").alias("a"), F.col("tip_2").alias("b")))


def pools(links: DataFrame) -> DataFrame:
    """Pool (its smallest member) and members of the components of links (a, b)."""
    return components(links).groupBy(F.col("component").alias("pool")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("node")), lambda x: x.cast("string")), ",").alias("members"))


def og_report(families: DataFrame, groups: DataFrame, collection: int) -> DataFrame:
    """Lineages and families, how many of them have a group in the collection, and the number of groups."""
    own = groups.where(F.col("ortholog_col_id") == collection).select("rlocds_id", "og_id")
    named = families.join(own, "rlocds_id", "left")
    has = F.col("og_id").isNotNull()
    return named.agg(F.count("*").alias("n_lineages"), F.count("og_id").alias("n_in_groups"), F.countDistinct("gene_family_id").alias("n_families"), F.countDistinct(F.when(has, F.col("gene_family_id"))).alias("n_families_in_groups"), F.countDistinct(F.when(has, F.struct("gene_family_id", "og_id"))).alias("n_groups"))


def cds_families(proteins: DataFrame, cds: DataFrame, orfan: int) -> DataFrame:
    """K6: nr_protein_id, family_no: a family of several proteins keeps its number; a lone protein with several genes gets a new one
    after the largest, with one gene the number of ORFans. `proteins` (nr_protein_id, family_no or null), `cds` (nr_protein_id)."""
    copies = cds.groupBy("nr_protein_id").agg(F.count("*").alias("_n"))
    lone = proteins.where("family_no IS NULL").join(copies, "nr_protein_id")
    top = proteins.agg(F.coalesce(F.max("family_no"), F.lit(0)).alias("_top"))
    new = number_rows(lone.where("_n > 1").select("nr_protein_id"), ["nr_protein_id"], "_no").join(top).select("nr_protein_id", (F.col("_no") + F.col("_top")).alias("family_no"))
    old = proteins.where("family_no IS NOT NULL").select("nr_protein_id", F.col("family_no").cast("long").alias("family_no"))
    return old.unionByName(new).unionByName(lone.where("_n = 1").select("nr_protein_id", F.lit(orfan).cast("long").alias("family_no")))

"""Events on branches, scores of lineage pairs, and genes in order: densities, condensation by groups, top pairs, blocks."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genomill.operators.ranks import quantiles
from genomill.operators.trees import settle


def events_with_branches(events: DataFrame, nodes: DataFrame) -> DataFrame:
    """Events with the names of their recipient and, if any, donor branch."""
    rec, don = (nodes.select(F.col("branch_id").alias(f"{x}_branch_id"), F.col("branch_name").alias(f"{x}_branch")) for x in ("rec", "don"))
    return events.join(rec, "rec_branch_id").join(don, "don_branch_id", "left")


def events_excluding(events: DataFrame, nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """Events whose recipient branch has none of the names."""
    return events_with_branches(events, nodes).where(~F.col("rec_branch").isin(*names))


def event_density(lineages: DataFrame, events: DataFrame, n: int, min_freq: float) -> DataFrame:
    """Per donor, recipient and type the lineages with such an event (in `min_freq` of the n samples or more), their summed and mean frequency."""
    often = lineages.where(F.col("freq") >= min_freq * n).join(events, "event_id")
    return often.groupBy("don_branch", "rec_branch", "event_type").agg(F.count("*").alias("n_lineages"), (F.sum("freq") / n).alias("cum_freq"), F.round(F.avg("freq") / n, 9).alias("mean_freq"))


def event_density_by(density: DataFrame, role: str) -> DataFrame:
    """Densities summed by recipient (`rec`) or donor (`don`) branch and type."""
    return density.where(F.col(f"{role}_branch").isNotNull()).groupBy("event_type", f"{role}_branch").agg(F.sum("n_lineages").alias("n_lineages"), F.round(F.sum("cum_freq"), 6).alias("cum_freq"))


def lineage_event_freq(sampled: DataFrame, n: int, min_freq: float) -> DataFrame:
    """Samples in which a lineage has an event, at least `min_freq` of n. `sampled` (label, sample, event_id), repeats count once."""
    return sampled.select("label", "sample", "event_id").distinct().groupBy("label", "event_id").agg(F.count("*").alias("freq")).where(F.col("freq") >= min_freq * n)


def family_event_freq(sampled: DataFrame, n: int) -> DataFrame:
    """Occurrences of an event in all samples of a family, over n."""
    return sampled.groupBy("family", "event_id").agg((F.count("*") / n).alias("freq"))


def scenario_projection(lineages: DataFrame, events: DataFrame, n: int) -> DataFrame:
    """event frequency of each lineage on each recipient branch, by type; transfers by their donor too."""
    return lineages.join(events, "event_id").groupBy("rlocds_id", "event_type", "don_branch", "rec_branch").agg((F.sum("freq") / n).alias("freq"))


def match_stats(matches: DataFrame, n: int, thresholds: Sequence[float]) -> DataFrame:
    """Per pair the shared events, their mean and joint frequencies summed, and the same where both frequencies reach each threshold (`_1`, `_2`, ...)."""
    joint, mean = F.col("freq_1") * F.col("freq_2"), F.col("freq_1") + F.col("freq_2")
    sums = [F.count("*").alias("n_shared"), (F.sum(mean) / (2 * n)).alias("sum_mean"), (F.sum(joint) / (n * n)).alias("sum_joint")]
    for i, t in enumerate(thresholds, 1):
        high = F.least("freq_1", "freq_2") >= t * n
        sums += [F.count(F.when(high, 1)).alias(f"n_shared_{i}"), (F.sum(F.when(high, joint).otherwise(0)) / (n * n)).alias(f"sum_joint_{i}")]
    return matches.groupBy("rlocds_id_1", "rlocds_id_2").agg(*sums)


def og_pair_scores(scores: DataFrame, groups: DataFrame, collection: int, within: bool = False) -> DataFrame:
    """Scores with the groups of both ends, the smaller (family, group) first, families differing unless `within`."""
    own = groups.where(F.col("ortholog_col_id") == collection)
    a, b = (own.select(F.col("rlocds_id").alias(f"rlocds_id_{i}"), F.struct(F.col("gene_family_id").alias("fam"), F.col("og_id").alias("og")).alias(f"_g{i}")) for i in (1, 2))
    pairs = scores.join(a, "rlocds_id_1").join(b, "rlocds_id_2")
    if not within:
        pairs = pairs.where("_g1.fam <> _g2.fam")
    first, last = F.least("_g1", "_g2"), F.greatest("_g1", "_g2")
    return pairs.select("rlocds_id_1", "rlocds_id_2", "score", first["fam"].alias("fam1"), first["og"].alias("og1"), last["fam"].alias("fam2"), last["og"].alias("og2"))


def condense_scores(pairs: DataFrame) -> DataFrame:
    """Per pair of groups the links, and over each lineage's best score in that pair (at either end): number, mean and quartiles."""
    key = ["fam1", "og1", "fam2", "og2"]
    ends = pairs.select(*key, "score", F.posexplode(F.array("rlocds_id_1", "rlocds_id_2")).alias("_end", "_l"))
    best = ends.groupBy(*key, "_l").agg(F.max("score").alias("_best"), F.count(F.when(F.col("_end") == 0, 1)).alias("_links"))
    out = best.groupBy(*key).agg(F.sum("_links").alias("n_links"), F.count("*").alias("n_best"), F.round(F.avg("_best"), 9).alias("mean"), F.percentile("_best", F.array(*map(F.lit, (0.0, 0.25, 0.5, 0.75, 1.0)))).alias("_q"))
    return out.select(*key, "n_links", "n_best", "mean", *[F.round(F.col("_q")[i], 9).alias(c) for i, c in enumerate(("min", "q25", "q50", "q75", "max"))])


def score_quantiles(scores: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Prob, value: exact quantiles of all scores, interpolated (null without scores)."""
    found = quantiles(settle(scores.select("score")), "score", probs)
    rows = [(float(p), None if v is None else round(v, 9)) for p, v in zip(probs, found, strict=True)]
    return scores.sparkSession.createDataFrame(rows, "prob double, value double")


def top_associations(scores: DataFrame, quantile: float | None = None, least: float | None = None) -> DataFrame:
    """pairs at or above a quantile of the scores, or a score. Scores are computed once."""
    if least is None:
        scores = settle(scores)
        least = quantiles(scores, "score", [quantile])[0]
    return scores.where(F.col("score") >= (math.inf if least is None else least))


def circular_distance(a: Column, b: Column, size: Column) -> Column:
    """The shorter way between two places on a ring."""
    return F.least(F.abs(a - b), size - F.abs(a - b))


def same_replicon_pairs(scores: DataFrame, places: DataFrame) -> DataFrame:
    """Pairs on one replicon, with their distance on its ring. `places` (rlocds_id, replicon, place, size)."""
    a, b = (places.select(F.col("rlocds_id").alias(f"rlocds_id_{i}"), "replicon", "size", F.col("place").alias(f"_p{i}")) for i in (1, 2))
    return scores.join(a, "rlocds_id_1").join(b, ["rlocds_id_2", "replicon", "size"]).select("rlocds_id_1", "rlocds_id_2", "replicon", "score", circular_distance(F.col("_p1"), F.col("_p2"), F.col("size")).alias("distance"))


def og_pairs_on_replicons(pairs: DataFrame, genes: DataFrame, most: int, salts: int = 16) -> DataFrame:
    """Genes of paired groups that lie on one replicon, with their distance on its ring; of a replicon with more than `most` such pairs, a sample of `most`.

    `pairs` (fam1, og1, fam2, og2, further columns), `genes` (gene_family_id, og_id, cds_code, replicon, size, place). The sample is
    the pairs of smallest digest, so that it is the same each time; it is drawn in two steps, first from parts of a replicon's
    pairs, so that no task orders all pairs of a large one.
    """
    first, second = (genes.select(F.col("gene_family_id").alias(f"fam{i}"), F.col("og_id").alias(f"og{i}"), F.col("cds_code").alias(f"cds_code_{i}"), "replicon", "size", F.col("place").alias(f"_p{i}")) for i in (1, 2))
    met = pairs.join(first, ["fam1", "og1"]).join(second, ["fam2", "og2", "replicon", "size"])
    met = met.withColumn("_d", F.md5(F.concat_ws("/", F.col("cds_code_1").cast("string"), F.col("cds_code_2").cast("string"))))
    order = ["_d", "cds_code_1", "cds_code_2", "fam1", "og1", "fam2", "og2"]
    for by in (["replicon", F.pmod(F.xxhash64("_d"), F.lit(salts))], ["replicon"]):
        met = met.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_r") <= most).drop("_r")
    return met.withColumn("distance", circular_distance(F.col("_p1"), F.col("_p2"), F.col("size"))).drop("_d", "_p1", "_p2", "size")


def row_sums(pairs: DataFrame, k: int) -> DataFrame:
    """per lineage the scores with all others on its replicon, and with those more than `k` places away."""
    both = pairs.select("replicon", "score", "distance", F.explode(F.array("rlocds_id_1", "rlocds_id_2")).alias("rlocds_id"))
    return both.groupBy("replicon", "rlocds_id").agg(F.round(F.sum("score"), 6).alias("total"), F.round(F.sum(F.when(F.col("distance") > k, F.col("score")).otherwise(0.0)), 6).alias("far"))


def score_distance_fit(pairs: DataFrame) -> DataFrame:
    """H3: least-squares line of score on distance per replicon."""
    return pairs.groupBy("replicon").agg(F.count("*").alias("n"), F.round(F.regr_slope("score", "distance"), 9).alias("slope"), F.round(F.regr_intercept("score", "distance"), 9).alias("intercept"))


def lineage_annotation(genes: DataFrame, *key: str) -> DataFrame:
    """Per lineage or group its largest product, genes, genomes, and on which kinds of replicon they lie."""
    counts = genes.groupBy(*key).agg(F.max("product").alias("product"), F.count("*").alias("n_genes"), F.countDistinct("assembly_id").alias("n_genomes"), F.count(F.when(F.col("replicon_type") == "chromosome", 1)).alias("n_chromosome"), F.count(F.when(F.col("replicon_type") == "plasmid", 1)).alias("n_plasmid"))
    c, p = F.col("n_chromosome") > 0, F.col("n_plasmid") > 0
    return counts.withColumn("replicons", F.when(c & p, "both").when(c, "chromosome").when(p, "plasmid").otherwise("none"))


def lineage_genes(lineages: DataFrame, genes: DataFrame) -> DataFrame:
    """All genes of the given lineages (rlocds_id), each once. `genes` (rlocds_id and what is told of a gene)."""
    return genes.join(lineages.select("rlocds_id").distinct(), "rlocds_id").distinct()


def adjacent_genes(genes: DataFrame, gap: int) -> DataFrame:
    """neighbours in the order of a replicon, at most `gap` numbers apart."""
    ahead = F.lead("gene_rank").over(Window.partitionBy("replicon").orderBy("gene_rank"))
    return genes.select("replicon", F.col("gene_rank").alias("gene_1"), ahead.alias("gene_2")).where(F.col("gene_2") - F.col("gene_1") <= gap)


def event_blocks(genes: DataFrame, gap: int) -> DataFrame:
    """runs of genes on a replicon that share an event, with at most `gap` others between two (below 0: any number)."""
    order = Window.partitionBy("replicon", "event").orderBy("gene_rank")
    between = F.col("gene_rank") - F.lag("gene_rank").over(order) - 1
    begins = F.coalesce((between > gap) & F.lit(gap >= 0), F.lit(False)).cast("int")
    dealt = genes.withColumn("_begins", begins).withColumn("_block", F.sum("_begins").over(order))
    return dealt.groupBy("replicon", "event", "_block").agg(F.min("gene_rank").alias("first_gene"), F.max("gene_rank").alias("last_gene"), F.count("*").alias("n_genes"), F.round(F.sum("freq"), 6).alias("sum_freq"), F.min("freq").alias("min_freq"), F.max("freq").alias("max_freq"), F.round(F.avg("freq"), 6).alias("mean_freq"), F.round(F.median("freq"), 6).alias("median_freq")).drop("_block")


def core_background(genomes: DataFrame, terms: DataFrame, n_genomes: int) -> DataFrame:
    """Terms of the smallest gene of each family that has one gene in each of `n_genomes` genomes. `terms` (nr_protein_id, go_id)."""
    core = genomes.where("gene_family_id IS NOT NULL").groupBy("gene_family_id").agg(F.count("*").alias("_s"), F.countDistinct("assembly_id").alias("_g"), F.min_by(F.struct("cds_code", "nr_protein_id"), F.struct("cds_code", "nr_protein_id")).alias("_m")).where((F.col("_s") == n_genomes) & (F.col("_g") == n_genomes))
    return core.select("gene_family_id", F.col("_m.cds_code").alias("cds_code"), F.col("_m.nr_protein_id").alias("nr_protein_id")).join(terms, "nr_protein_id").select("gene_family_id", "cds_code", "go_id").distinct()


def pan_background(genomes: DataFrame, terms: DataFrame, clades: DataFrame) -> DataFrame:
    """Per clade the families of its genomes with each of their terms (null: none)."""
    inside = genomes.where("gene_family_id IS NOT NULL").select(F.col("taxid").alias("genome"), "gene_family_id", "nr_protein_id").distinct().join(clades.where("side = 'clade'").select("clade", "genome"), "genome")
    return inside.select("clade", "gene_family_id", "nr_protein_id").distinct().join(terms, "nr_protein_id", "left").select("clade", "gene_family_id", "go_id").distinct()


def specific_details(families: DataFrame, proteins: DataFrame, terms: DataFrame) -> DataFrame:
    """E5: products and terms of the families specific to each clade."""
    named = proteins.select(F.col("nr_protein_id").alias("gene_family_id"), "product")
    return families.select("clade", "gene_family_id").join(named, "gene_family_id", "left").join(terms.withColumnRenamed("nr_protein_id", "gene_family_id"), "gene_family_id", "left").select("clade", "gene_family_id", "product", "go_id").distinct()

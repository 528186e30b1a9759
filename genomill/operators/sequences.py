"""Sequence tables (seq_id, genome, family, seq) and alignments (family, genome, seq): identical rows, numbering, concatenation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genomill.operators.trees import settle


def number_rows(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """`df` with a running number from 1 in the order of columns that identify a row.

    Rows are dealt by range and numbered within each part; only a count per part is summed in one place.
    """
    dealt = settle(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    counts = dealt.groupBy("_p").agg(F.count("*").alias("_n"))
    before = counts.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    return dealt.withColumn("_i", inside).join(before, "_p").withColumn(name, F.col("_i") + F.col("_before")).drop("_p", "_i", "_before")


def dereplicate(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """K1, K4: the first row of each key."""
    kept = df.groupBy(*key).agg(F.min_by(F.struct(*[c for c in df.columns if c not in key]), order).alias("_r"))
    return kept.select(*key, "_r.*").select(*df.columns)


def identical_groups(df: DataFrame) -> DataFrame:
    """K2: sequences that are equal: the smallest seq_id of the group, its size, its digest."""
    return df.groupBy(F.sha2("seq", 256).alias("digest")).agg(F.min("seq_id").alias("representative"), F.count("*").alias("n"))


def groups_as_lists(df: DataFrame) -> DataFrame:
    """K3: one row per group of two or more, its members listed in order."""
    return df.groupBy(F.sha2("seq", 256).alias("digest")).agg(F.array_sort(F.collect_list("seq_id")).alias("_m")).where(F.size("_m") > 1).select(F.col("_m")[0].alias("representative"), F.array_join(F.transform("_m", lambda x: x.cast("string")), ",").alias("members"))


def representatives(df: DataFrame, key: str, previous: DataFrame) -> DataFrame:
    """F8: one row of each key: one that `previous` (seq_id) names, if any, else the first."""
    known = df.join(previous.select("seq_id", F.lit(1).alias("_known")), "seq_id", "left")
    return known.groupBy(key).agg(F.min_by("seq_id", F.struct(F.col("_known").isNull().cast("int"), "seq_id")).alias("representative"))


def assign_family_ids(clusters: DataFrame, prefix: str, width: int) -> DataFrame:
    """padded running numbers of clusters of two or more, in order; all others share number 0. `clusters` (cluster, member)."""
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("_n"))
    numbered = number_rows(sizes.where("_n > 1").select("cluster"), ["cluster"], "_no")
    named = clusters.join(numbered, "cluster", "left")
    return named.select("cluster", "member", F.concat(F.lit(prefix), F.lpad(F.coalesce("_no", F.lit(0)).cast("string"), width, "0")).alias("family_id"))


def carry_over_ids(clusters: DataFrame, previous: DataFrame) -> DataFrame:
    """K5: cluster, family_no, conflict: a cluster with members of one previous family keeps its number; with several it is a conflict
    (no number); with none it is numbered after the largest. `clusters` (cluster, member), `previous` (member, family_no)."""
    met = clusters.join(previous, "member", "left").groupBy("cluster").agg(F.min("family_no").alias("_lo"), F.max("family_no").alias("_hi"))
    top = previous.agg(F.coalesce(F.max("family_no"), F.lit(0)).alias("_top"))
    new = number_rows(met.where("_lo IS NULL").select("cluster"), ["cluster"], "_no").join(top).select("cluster", (F.col("_no") + F.col("_top")).alias("family_no"), F.lit(False).alias("conflict"))
    old = met.where("_lo IS NOT NULL").select("cluster", F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).alias("family_no"), (F.col("_lo") != F.col("_hi")).alias("conflict"))
    return old.unionByName(new)


def running_sum(df: DataFrame, keys: Sequence[str], at: str, value: str, name: str, block: int = 100_000) -> DataFrame:
    """`df` (settled) with the sum of `value` over the rows of its keys up to its own, in the order of `at` (a long that tells rows apart).

    Rows are summed by blocks of `block` places, and blocks by their totals: a key may have any number of rows without one
    task that sorts them all.
    """
    keys = list(keys)
    cut = df.withColumn("_rs_block", F.floor(F.col(at) / block))
    totals = cut.groupBy(*keys, "_rs_block").agg(F.sum(value).alias("_rs_t"))
    before = totals.select(*keys, "_rs_block", (F.sum("_rs_t").over(Window.partitionBy(*keys).orderBy("_rs_block")) - F.col("_rs_t")).alias("_rs_before"))
    inside = F.sum(value).over(Window.partitionBy(*keys, "_rs_block").orderBy(at))
    return cut.withColumn("_rs_inside", inside).join(before, [*keys, "_rs_block"]).withColumn(name, F.col("_rs_inside") + F.col("_rs_before")).drop("_rs_block", "_rs_inside", "_rs_before")


def concat_alignments(rows: DataFrame, genomes: DataFrame) -> DataFrame:
    """K8: the rows of each genome joined in the order of families; gaps as wide as the family where it has none, nothing for empty families.

    Each family has its place in the whole, so that a genome's own rows tell where its gaps lie: no row is made for a family that
    a genome lacks. Of rows that repeat a genome and family each is joined, as a family of its own would be. A genome without rows is all gaps.
    """
    widths = rows.groupBy("family").agg(F.max(F.length("seq")).alias("_w")).where("_w > 0")
    numbered = number_rows(widths, ["family"], "_no")
    ends = running_sum(settle(numbered.withColumn("_all", F.lit(0))), ["_all"], "_no", "_w", "_end").drop("_all")
    ends = settle(ends.select("family", (F.col("_end") - F.col("_w")).alias("_from"), "_end", "_w"))
    placed = rows.select("family", "genome", F.coalesce("seq", F.lit("")).alias("seq")).join(ends, "family").select("genome", F.struct("_from", "_end", F.expr("rpad(seq, _w, '-')").alias("seq")).alias("_x"))
    own = placed.groupBy("genome").agg(F.array_sort(F.collect_list("_x")).alias("_xs"))
    total = ends.agg(F.coalesce(F.max("_end"), F.lit(0)).alias("_total"))
    gap = lambda n: F.repeat(F.lit("-"), F.greatest(n, F.lit(0)).cast("int"))
    before = lambda i: F.when(i == 0, 0).otherwise(F.get(F.col("_xs"), i - 1)["_end"])
    pieces = F.transform("_xs", lambda x, i: F.concat(gap(x["_from"] - before(i)), x["seq"]))
    last = F.coalesce(F.element_at("_xs", -1)["_end"], F.lit(0))
    known = genomes.select("genome").distinct().join(own, "genome", "left").join(total)
    return known.select("genome", F.concat(F.coalesce(F.array_join(pieces, ""), F.lit("")), gap(F.col("_total") - last)).alias("seq"))


#: Columns of an alignment that one mask covers.
MASK = 64


def variable_sites(rows: DataFrame) -> DataFrame:
    """K9: the alignment without the columns in which all rows of the family agree; rows without any other column go.

    Rows are cut into blocks of 64 columns. In each block every row is compared with the longest, as a mask of one bit a column;
    the masks of all rows together tell the columns to keep. Rows may differ in length: those that end before a column don't count there.
    """
    starts = F.expr(f"sequence(0, cast((length(seq) - 1) div {MASK} as int))")
    pieces = settle(rows.where("length(seq) > 0").select("family", "genome", "seq", F.explode(starts).alias("block")).select("family", "genome", "block", F.expr(f"substring(seq, block * {MASK} + 1, {MASK})").alias("piece")))
    longest = settle(pieces.groupBy("family", "block").agg(F.max_by("piece", F.struct(F.length("piece"), "piece")).alias("_long")))
    letters = F.sequence(F.lit(1), F.length("piece"))
    differs = F.transform(letters, lambda i: F.when(F.substring("piece", i, F.lit(1)) != F.substring("_long", i, F.lit(1)), F.call_function("shiftleft", F.lit(1).cast("long"), i - 1)).otherwise(F.lit(0).cast("long")))
    mask = F.aggregate(differs, F.lit(0).cast("long"), lambda m, x: m.bitwiseOR(x))
    masks = settle(pieces.join(longest, ["family", "block"]).groupBy("family", "block").agg(F.bit_or(mask).alias("_mask")).where("_mask <> 0"))
    keeps = F.filter(letters, lambda i: F.call_function("shiftrightunsigned", F.col("_mask"), i - 1).bitwiseAND(F.lit(1).cast("long")) == 1)
    kept = pieces.join(masks, ["family", "block"]).select("family", "genome", "block", F.array_join(F.transform(keeps, lambda i: F.substring("piece", i, F.lit(1))), "").alias("piece")).where("piece <> ''")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("block", "piece"))), lambda x: x["piece"])
    return kept.groupBy("family", "genome").agg(F.array_join(ordered, "").alias("seq"))


def base_frequencies(rows: DataFrame) -> DataFrame:
    """How often each base occurs in the rows of a family: a row for each base that a sequence has, not for each letter."""
    each = rows.select("family", "seq", F.explode(F.array_distinct(F.split("seq", ""))).alias("base"))
    times = F.when(F.col("base") == "", F.lit(1)).otherwise(F.length("seq") - F.length(F.replace("seq", "base", F.lit(""))))
    return each.groupBy("family", "base").agg(F.sum(times.cast("long")).alias("n"))


def describe(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean, median, quartiles (interpolated) and sample variance of a column; nulls don't count."""
    q = F.percentile(value, F.array(F.lit(0.25), F.lit(0.75)))
    return df.groupBy(key).agg(F.count(value).alias("n"), F.round(F.avg(value), 6).alias("mean"), F.round(F.median(value), 6).alias("median"), q.alias("_q"), F.round(F.var_samp(value), 3).alias("variance")).select(key, "n", "mean", "median", F.round(F.col("_q")[0], 6).alias("q25"), F.round(F.col("_q")[1], 6).alias("q75"), "variance")

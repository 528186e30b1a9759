"""Exact order statistics of a column over all rows, without all rows in one place."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genomill.operators.trees import settle


def values_at(df: DataFrame, column: str, ranks: Sequence[int]) -> dict[int, float]:
    """The values at `ranks` (from 0) in the order of a column; nulls don't count; ranks beyond the last are not in the answer.

    Equal values are counted first, so that a frequent one is a single row. Distinct values are dealt by range; the driver sees a
    count for each part, and only the parts that hold a rank are put in order, each by itself.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_v")).agg(F.count("*").alias("_n"))
    dealt = settle(counted.repartitionByRange("_v").withColumn("_p", F.spark_partition_id()))
    before, inside = 0, []
    for part, n in sorted((r["_p"], r["_n"]) for r in dealt.groupBy("_p").agg(F.sum("_n").alias("_n")).collect()):
        inside += [(part, r - before, r) for r in sorted(set(ranks)) if before <= r < before + n]
        before += n
    if not inside:
        return {}
    wanted = F.broadcast(df.sparkSession.createDataFrame(inside, "_p int, _at long, _rank long"))  # a row a rank
    up_to = F.sum("_n").over(Window.partitionBy("_p").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    placed = dealt.where(F.col("_p").isin(*{p for p, _, _ in inside})).withColumn("_end", up_to)
    found = placed.join(wanted, "_p").where((F.col("_at") < F.col("_end")) & (F.col("_at") >= F.col("_end") - F.col("_n")))
    return {r["_rank"]: r["_v"] for r in found.select("_rank", "_v").collect()}


def quantiles(df: DataFrame, column: str, probs: Sequence[float]) -> list[float | None]:
    """Quantiles of a column, interpolated between the two nearest values (all null if it has none). Two values a quantile come to the driver."""
    n = df.where(F.col(column).isNotNull()).count()
    if not n:
        return [None] * len(probs)
    places = [(n - 1) * p for p in probs]
    at = values_at(df, column, [f(x) for x in places for f in (math.floor, math.ceil)])
    return [float(at[lo] + (at[math.ceil(x)] - at[lo]) * (x - lo)) for x in places for lo in (math.floor(x),)]

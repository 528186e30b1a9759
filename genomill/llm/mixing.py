"""Mixing sources to target weights: temperature by bisection, realised as budgeted block permutations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genomill.llm.common import cut, table, veiled

#: Halvings of the exponent's interval, and how many of them one pass over the sources' shares decides.
HALVINGS, AT_ONCE = 40, 5


def _number(*parts: Column | str) -> Column:
    """A hash of these as text: 60 bits of md5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("long")


def _words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def temperature(shares: DataFrame, max_epochs: float | None = None, entropy: float | None = None) -> float:
    """The exponent for `shares` (_tokens per source), to 6 decimals; 1 if no source has tokens.

    With `max_epochs`: the smallest exponent in [0, 1] at which the most repeated source is shown at most that many times as
    often as the least repeated one. With `entropy` (nats): the largest exponent whose weights have that entropy at least.
    Either condition holds on one side of a point that bisection finds; if none holds in [0, 1], the nearer end is taken.
    """
    if (max_epochs is None) == (entropy is None):
        raise ValueError("give max_epochs or entropy")
    logs = shares.where("_tokens > 0").select(F.ln(F.col("_tokens").cast("double")).alias("x"))
    low, top = logs.agg(F.min("x"), F.max("x")).first()
    if low is None:
        return 1.0

    def fine(points: list[float]) -> list[bool]:
        """For each exponent, whether the condition holds there: by one aggregation over the shares, however many they are."""
        if max_epochs is not None:
            return [(1.0 - a) * (top - low) <= math.log(max_epochs) for a in points]
        e = [F.exp(a * (F.col("x") - top)) for a in points]
        sums = logs.agg(*[F.sum(x).alias(f"z{i}") for i, x in enumerate(e)], *[F.sum(x * a * (F.col("x") - top)).alias(f"u{i}") for i, (a, x) in enumerate(zip(points, e, strict=True))]).first()
        return [math.log(sums[f"z{i}"]) - sums[f"u{i}"] / sums[f"z{i}"] >= entropy for i in range(len(points))]

    if fine([0.0 if max_epochs is not None else 1.0])[0]:
        return 0.0 if max_epochs is not None else 1.0
    lo, hi = 0.0, 1.0
    for _ in range(HALVINGS // AT_ONCE):
        step = (hi - lo) / 2**AT_ONCE
        points = [lo + step * i for i in range(1, 2**AT_ONCE)]
        # the condition holds from some point on (repetition), or up to one (entropy)
        holds = fine(points)
        at = holds.index(True) if max_epochs is not None and True in holds else sum(holds) if max_epochs is None else len(points)
        lo, hi = lo + step * at, lo + step * (at + 1)
    return round(hi if max_epochs is not None else lo, 6)


def mix(docs: DataFrame, max_epochs: float | None = 2.0, entropy: float | None = None, budget: int | None = None, block_tokens: int = 200_000, seed: int = 1) -> DataFrame:
    """Rows of `docs`, each as often as its source's weight asks, with mix_epoch (from 1), mix_block and mix_rank (the block's place in that epoch).

    A source's share is its share of tokens (words between blanks); weights are shares to the power of `temperature`, summed to
    1. `budget` tokens are dealt by weight; without one, as many as show every document once at least, so that mixing drops
    nothing. A source's epochs are budget * weight / tokens, to 6 decimals. Its documents lie in hash blocks of about
    `block_tokens`; each epoch orders the blocks anew by a seeded hash. Whole epochs show every block; the last, partial one
    shows blocks in its order while they fit the rest of the budget, and of the first that doesn't, documents in hash order
    while they fit. A document without tokens belongs to each whole epoch, and to the partial one with its block.

    Null source: a source of its own. Null text: no tokens. Null doc_id: placed by its text. Repeated rows: each is a document.
    Columns of these three names are replaced, all others pass through. An empty table gives an empty result.
    """
    docs = docs.drop("mix_epoch", "mix_block", "mix_rank")
    named = docs.columns
    docs, columns, (doc_id, text, origin) = veiled(docs, "doc_id", "text", "source")
    source = F.coalesce(F.concat(F.lit("s"), origin.cast("string")), F.lit("-"))
    place = F.coalesce(doc_id.cast("string"), F.concat(F.lit("t"), text.cast("string")), F.lit(""))
    docs = docs.withColumns({"_s": source, "_n": _words(text), "_h": _number(place), "_tie": F.xxhash64(text)})
    totals = cut(docs.groupBy("_s").agg(F.sum("_n").alias("_tokens")))
    alpha = temperature(totals, max_epochs, entropy)
    raw = F.pow(F.col("_tokens").cast("double"), F.lit(alpha))
    scale = totals.where("_tokens > 0").agg(F.sum(raw).alias("z"), F.max(F.col("_tokens") / raw).alias("most")).first()
    unit = (scale["most"] if budget is None else budget / scale["z"]) if scale["z"] else 1.0
    epochs = F.when(F.col("_tokens") > 0, F.round(raw * unit / F.col("_tokens"), 6)).otherwise(1.0)
    plan = totals.select("_s", F.floor(epochs).alias("_whole"), F.floor((epochs - F.floor(epochs)) * F.col("_tokens")).alias("_rest"), F.greatest(F.lit(1), F.ceil(F.col("_tokens") / block_tokens)).alias("_blocks"))
    plan = cut(plan)
    placed = docs.join(plan, "_s").withColumn("_b", F.col("_h") % F.col("_blocks"))
    blocks = cut(placed.groupBy("_s", "_b").agg(F.sum("_n").alias("_bn"), F.first("_whole").alias("_whole"), F.first("_rest").alias("_rest")))
    shown = blocks.withColumn("mix_epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_whole") + 1)))
    order = Window.partitionBy("_s", "mix_epoch").orderBy(_number(F.lit(str(seed)), "_s", F.col("mix_epoch").cast("string"), F.col("_b").cast("string")), "_b")
    ranked = shown.withColumns({"mix_rank": F.row_number().over(order).cast("long"), "_end": F.sum("_bn").over(order)})
    partial = F.col("mix_epoch") > F.col("_whole")
    # what is left for documents of a block in the partial epoch: all (null), or a number of tokens
    left = F.when(~partial | (F.col("_end") <= F.col("_rest")), F.lit(None)).otherwise(F.col("_rest") - F.col("_end") + F.col("_bn"))
    ranked = cut(ranked.where(~partial | (F.col("_rest") > 0) & (F.col("_end") - F.col("_bn") < F.col("_rest"))).select("_s", "_b", "mix_epoch", "mix_rank", left.alias("_left")))
    rows = docs.join(plan.select("_s", "_blocks"), "_s").withColumn("_b", F.col("_h") % F.col("_blocks")).join(ranked, ["_s", "_b"])
    running = F.sum("_n").over(Window.partitionBy("_s", "_b").orderBy("_h", "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = rows.where("_left IS NULL")
    cut_off = rows.where("_left IS NOT NULL").withColumn("_run", running).where("_run <= _left")
    names = [*columns, "mix_epoch", F.col("_b").alias("mix_block"), "mix_rank"]
    return whole.select(*names).unionByName(cut_off.select(*names)).toDF(*named, "mix_epoch", "mix_block", "mix_rank")


_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('s' || source, '-') AS s,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS n,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 't' || text, '')), 1, 15) AS BIGINT) AS h
  FROM documents),
t AS (SELECT s, CAST(sum(n) AS BIGINT) AS tokens FROM d GROUP BY s),
{bisection}u AS (SELECT {unit} AS most FROM t, a WHERE tokens > 0),
e AS (
  SELECT s, tokens, CASE WHEN tokens > 0 THEN round(pow(CAST(tokens AS DOUBLE), alpha) * most / tokens, 6) ELSE 1.0 END AS epochs,
         greatest(1, CAST(ceil(tokens / {block}.0) AS BIGINT)) AS blocks
  FROM t, a, u),
p AS (SELECT s, CAST(floor(epochs) AS BIGINT) AS whole, CAST(floor((epochs - floor(epochs)) * tokens) AS BIGINT) AS rest, blocks FROM e),
x AS (SELECT d.*, p.whole, p.rest, d.h % p.blocks AS b FROM d JOIN p USING (s)),
bl AS (SELECT s, b, whole, rest, CAST(sum(n) AS BIGINT) AS bn FROM x GROUP BY ALL),
ep AS (SELECT bl.*, unnest(generate_series(1, whole + 1)) AS epoch FROM bl),
r AS (
  SELECT *, row_number() OVER o AS mix_rank, CAST(sum(bn) OVER o AS BIGINT) AS done
  FROM (SELECT *, CAST('0x' || substr(md5('1|' || s || '|' || epoch || '|' || b), 1, 15) AS BIGINT) AS k FROM ep)
  WINDOW o AS (PARTITION BY s, epoch ORDER BY k, b)),
sh AS (SELECT *, CASE WHEN epoch <= whole OR done <= rest THEN NULL ELSE rest - done + bn END AS room FROM r
       WHERE epoch <= whole OR (rest > 0 AND done - bn < rest)),
run AS (SELECT *, sum(n) OVER (PARTITION BY s, b ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM x)
SELECT run.doc_id, run.source, run.n AS n_tokens, CAST(sh.epoch AS BIGINT) AS mix_epoch, sh.b AS mix_block, sh.mix_rank
FROM run JOIN sh ON run.s = sh.s AND run.b = sh.b WHERE sh.room IS NULL OR run.upto <= sh.room
"""



_BISECTION = """span AS (SELECT max(ln(CAST(tokens AS DOUBLE))) - min(ln(CAST(tokens AS DOUBLE))) AS w FROM t WHERE tokens > 0),
b(i, lo, hi) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
  UNION ALL
  SELECT i + 1, CASE WHEN (1 - (lo + hi) / 2) * w <= ln(2.0) THEN lo ELSE (lo + hi) / 2 END,
         CASE WHEN (1 - (lo + hi) / 2) * w <= ln(2.0) THEN (lo + hi) / 2 ELSE hi END
  FROM b, span WHERE i < 40),
a AS (SELECT CASE WHEN (SELECT w FROM span) <= ln(2.0) THEN 0.0 ELSE round(hi, 6) END AS alpha FROM b WHERE i = 40),
"""
_ENTROPY_BISECTION = """x0 AS (SELECT list(ln(CAST(tokens AS DOUBLE)) ORDER BY tokens) AS l, max(ln(CAST(tokens AS DOUBLE))) AS top FROM t WHERE tokens > 0),
b(i, lo, hi) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
  UNION ALL
  SELECT i + 1, CASE WHEN fine THEN mid ELSE lo END, CASE WHEN fine THEN hi ELSE mid END
  FROM (SELECT i, lo, hi, mid, ln(list_sum(e)) - list_sum(list_transform(list_zip(e, l), lambda z: z[1] * mid * (z[2] - top))) / list_sum(e) >= {entropy} AS fine
        FROM (SELECT i, lo, hi, (lo + hi) / 2 AS mid, l, top, list_transform(l, lambda v: exp((lo + hi) / 2 * (v - top))) AS e FROM b, x0 WHERE i < 40))),
full_h AS (SELECT -sum(q * ln(q)) >= {entropy} AS ok FROM (SELECT tokens / sum(tokens) OVER () AS q FROM t WHERE tokens > 0)),
a AS (SELECT CASE WHEN (SELECT ok FROM full_h) THEN 1.0 ELSE round(lo, 6) END AS alpha FROM b WHERE i = 40),
"""


def _sql(bisection: str, unit: str, block: int) -> str:
    return _SQL.replace("{bisection}", bisection).replace("{unit}", unit).replace("{block}", str(block))


ALL, BUDGET, SMALL_BLOCK, ENTROPY = "max(tokens / pow(CAST(tokens AS DOUBLE), alpha))", 150_000, 5_000, 1.2
OP7_SQL = _sql(_BISECTION, ALL, 200_000)
OP7_BUDGET_SQL = _sql(_BISECTION, f"{BUDGET} / sum(pow(CAST(tokens AS DOUBLE), alpha))", SMALL_BLOCK)
OP7_ENTROPY_SQL = _sql(_ENTROPY_BISECTION.replace("{entropy}", str(ENTROPY)), ALL, SMALL_BLOCK)


def _digest(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs, **how).select("doc_id", "source", _words(F.col("text")).alias("n_tokens"), "mix_epoch", "mix_block", "mix_rank")


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(spark, sf_dir)


def op7_mix_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A budget of tokens, dealt in small blocks: partial epochs, and documents cut off inside a block."""
    return _digest(spark, sf_dir, budget=BUDGET, block_tokens=SMALL_BLOCK)


def op7_mix_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of a given entropy."""
    return _digest(spark, sf_dir, max_epochs=None, entropy=ENTROPY, block_tokens=SMALL_BLOCK)


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's weight asks, once at least; null sources and texts too, and an empty table stays empty."""
    return mix(docs).select(docs.columns)

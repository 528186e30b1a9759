"""Extendible hashing: a directory indexed by hash-prefix bits, where only oversized buckets split on another bit."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genomill.llm.common import cut, table, veiled

#: Bits of the hash (15 hexadecimal digits of md5).
BITS = 60
#: Bits below the starting depth that one round of the directory can use.
STEP = 5
#: Slots of a directory that may be broadcast: four numbers each, some 40 MB.
BROADCAST_ROWS = 1_000_000


def _prefix(depth: Column | int) -> Column:
    """The first `depth` bits of _h."""
    return F.shiftright("_h", BITS - depth) if isinstance(depth, int) else F.call_function("shiftright", F.col("_h"), F.lit(BITS) - depth)


def _directory(rows: DataFrame, start: int, limit: int) -> DataFrame:
    """Slots (_slot: the first start + STEP bits) of (_h, _bytes): depth and bytes of the bucket; depth null where still too large."""
    end = min(start + STEP, BITS)
    cells = rows.groupBy(_prefix(start).alias("_top"), _prefix(end).alias("_slot")).agg(F.sum("_bytes").alias("_sum"))
    depth, size = F.lit(None).cast("int"), F.lit(None).cast("long")
    for d in range(end, start - 1, -1):
        total = F.sum("_sum").over(Window.partitionBy("_top", F.shiftright("_slot", end - d)))
        depth, size = F.when(total <= limit, d).otherwise(depth), F.when(total <= limit, total).otherwise(size)
    return cut(cells.select("_slot", depth.alias("_depth"), size.alias("_size")))


def shard(docs: DataFrame, limit: int = 16 << 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with shard ("b" and the bits of its hash prefix), shard_part, shard_depth, shard_bytes; no part of a shard exceeds `limit` bytes.

    A row's size: the UTF-8 bytes of its text (null: 0). Its hash: md5 of key and text (null: empty). The directory starts with
    as many bits as leave several limits to a bucket; each bucket over the limit splits on one more bit, alone. What still
    exceeds the limit after all bits is one row repeated (its copies are cut into parts 0, 1, ... that fit), or one row larger
    than the limit: it has a part of its own, the only kind of part above the limit. All else has part 0. A directory is
    broadcast only if its counted slots are few; otherwise Spark joins by slot. Columns of these four names are replaced, all
    others pass through. An empty table gives an empty result.
    """
    docs = docs.drop("shard", "shard_part", "shard_depth", "shard_bytes")
    named = docs.columns
    docs, _, (key_column, text_column) = veiled(docs, key, text)
    hashed = F.md5(F.concat(F.coalesce(key_column.cast("string"), F.lit("")), F.lit("\x01"), F.coalesce(text_column.cast("string"), F.lit(""))))
    placed = docs.withColumns({"_h": F.conv(F.substring(hashed, 1, BITS // 4), 16, 10).cast("long"), "_bytes": F.coalesce(F.octet_length(text_column.cast("string")), F.lit(0)).cast("long")})
    rows = placed.select("_h", "_bytes")
    total = rows.agg(F.sum("_bytes")).first()[0] or 0
    start = min(BITS - STEP, max(0, int(math.log2(max(1, total / limit))) - 2))
    depth, size = F.lit(None).cast("int"), F.lit(None).cast("long")
    joined: list[str] = []
    while True:
        slots = _directory(rows, start, limit)
        end = min(start + STEP, BITS)
        known = slots.withColumnsRenamed({"_slot": f"_slot{end}", "_depth": f"_depth{end}", "_size": f"_size{end}"})
        if slots.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
            known = F.broadcast(known)
        placed = placed.withColumn(f"_slot{end}", _prefix(end)).join(known, f"_slot{end}", "left")
        depth, size = F.coalesce(depth, f"_depth{end}"), F.coalesce(size, f"_size{end}")
        joined += [f"_slot{end}", f"_depth{end}", f"_size{end}"]
        still = slots.where("_depth IS NULL").select(F.col("_slot").alias("_open"))
        if end == BITS or still.isEmpty():
            break
        rows, start = rows.withColumn("_open", _prefix(end)).join(still, "_open", "left_semi").select("_h", "_bytes"), end
    placed = placed.withColumns({"_depth": depth, "_size": size}).drop(*joined)
    placed = _parts(placed, limit) if end == BITS and not still.isEmpty() else placed.withColumn("_part", F.lit(0).cast("long"))
    at = F.coalesce("_depth", F.lit(BITS))
    bits = F.when(at == 0, "").otherwise(F.lpad(F.bin(_prefix(at)), at, F.lit("0")))
    out = placed.withColumns({"shard": F.concat(F.lit("b"), bits), "shard_part": F.col("_part"), "shard_depth": at, "shard_bytes": F.col("_size")})
    return out.select(*docs.columns, "shard", "shard_part", "shard_depth", "shard_bytes").toDF(*named, "shard", "shard_part", "shard_depth", "shard_bytes")


def _parts(placed: DataFrame, limit: int) -> DataFrame:
    """Numbers the parts of buckets that no bit divides (_depth null): their rows are equal, so any of them may have any number.

    Rows are counted in each input partition; a partition's rows follow those of the partitions before it, so no task has to
    hold a whole bucket.
    """
    each = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(limit) / F.col("_bytes")))
    marked = cut(placed.where("_depth IS NULL").withColumn("_pid", F.spark_partition_id()))  # written, so that both reads below see the same numbers
    counts = marked.groupBy("_h", "_pid").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_h").orderBy("_pid")
    offsets = counts.select("_h", "_pid", (F.sum("_n").over(before) - F.col("_n")).alias("_before"), F.sum("_n").over(Window.partitionBy("_h")).alias("_all"))
    inside = Window.partitionBy("_h", "_pid").orderBy(F.lit(0))
    numbered = marked.withColumn("_k", F.row_number().over(inside)).join(offsets, ["_h", "_pid"]).withColumn("_part", F.floor((F.col("_before") + F.col("_k") - 1) / each))
    numbered = numbered.withColumn("_size", F.least(each, F.col("_all") - F.col("_part") * each) * F.col("_bytes"))
    return numbered.select(*placed.columns, "_part").unionByName(placed.where("_depth IS NOT NULL").withColumn("_part", F.lit(0).cast("long")))


LIMIT, SMALL_LIMIT = 16 << 20, 64 << 10

_SQL = """
WITH h AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(1) || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents),
t AS (SELECT greatest(0, CAST(floor(log2(greatest(1.0, sum(n_bytes) / {limit}.0))) AS INT) - 2) AS d0 FROM h),
levels AS (
  SELECT d, h >> (60 - d) AS p, sum(n_bytes) AS s
  FROM h, (SELECT unnest(generate_series(0, 60)) AS d) WHERE d >= (SELECT d0 FROM t) GROUP BY d, p),
leaf AS (
  SELECT h.h, min(l.d) AS d FROM (SELECT DISTINCT h FROM h) h JOIN levels l ON l.p = h.h >> (60 - l.d) AND l.s <= {limit} GROUP BY h.h),
-- what no bit divides: copies of one row, dealt into parts that fit, or a row above the limit
whole AS (
  SELECT doc_id, n_bytes, h.h, (row_number() OVER (PARTITION BY h.h) - 1) // greatest(1, {limit} // n_bytes) AS part
  FROM h ANTI JOIN leaf ON h.h = leaf.h)
SELECT h.doc_id, h.n_bytes, 'b' || CASE WHEN f.d = 0 THEN '' ELSE lpad(bin(h.h >> (60 - f.d)), CAST(f.d AS INT), '0') END AS shard,
       CAST(0 AS BIGINT) AS shard_part, CAST(f.d AS INT) AS shard_depth, CAST(l.s AS BIGINT) AS shard_bytes
FROM h JOIN leaf f ON h.h = f.h JOIN levels l ON l.d = f.d AND l.p = h.h >> (60 - f.d)
UNION ALL
SELECT doc_id, n_bytes, 'b' || lpad(bin(h), 60, '0'), CAST(part AS BIGINT), 60, CAST(sum(n_bytes) OVER (PARTITION BY h, part) AS BIGINT) FROM whole
"""
OP5_SQL, OP5_SMALL_SQL = _SQL.format(limit=LIMIT), _SQL.format(limit=SMALL_LIMIT)


def _digest(spark: SparkSession, sf_dir: str, limit: int) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard(docs, limit).select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "shard", "shard_part", "shard_depth", "shard_bytes")


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(spark, sf_dir, LIMIT)


def op5_small_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of so few bytes that buckets split to many depths, and some documents exceed the limit by themselves."""
    return _digest(spark, sf_dir, SMALL_LIMIT)


def stage_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets its shard; null or empty texts too, an empty table stays empty, and other columns pass through."""
    return shard(docs, LIMIT)

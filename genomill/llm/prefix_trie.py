"""Prefix trie of conversations: nodes of all shared beginnings by ROLLUP over positional turn columns, block after block."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genomill.llm.common import cut, discard, prepare, table

#: Turn columns of the first blocks; the last figure holds for all that follow (grouping_id has 64 bits).
WIDTHS = (8, 16, 32)
#: Bytes of listed ids that a piece of a node's list holds.
PIECE_BYTES = 64 << 10


def positioned(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), role, text, turn_id (digest of both), bytes (of the text) of `conversations` (conv_id, turn, role, text), in the order of turn (null first), role, text.

    A null role or text is empty; rows with a null conv_id belong to no conversation and are left out. Rows are dealt by range,
    so that one conversation may span many tasks; only a count a conversation and part is summed beyond them.
    """
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    parts = cut(rows.repartitionByRange("conv_id", *order).withColumn("_p", F.spark_partition_id()))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("_p")) - F.col("n")
    counts = cut(parts.groupBy("conv_id", "_p").agg(F.count("*").alias("n")).select("conv_id", "_p", before.alias("_before")))
    inside = parts.withColumn("_i", F.row_number().over(Window.partitionBy("_p", "conv_id").orderBy(*order)))
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    found = cut(inside.join(counts, ["conv_id", "_p"]).select("conv_id", (F.col("_i") + F.col("_before")).alias("pos"), "role", "text", digest.alias("turn_id"), F.octet_length("text").cast("long").alias("bytes")))
    discard(parts)
    discard(counts)
    return found


def _key(offset: int, names: list[str]) -> Column:
    """Digest of a path inside the block that begins after `offset` turns; absent turns don't count."""
    return F.md5(F.concat_ws("|", F.lit(offset).cast("string"), F.col("prev").cast("string"), *[F.col(c)["id"] for c in names]))


def _digests(ends: DataFrame) -> DataFrame:
    """key, ends_sha256: SHA-256 of the conv_ids listed under a key, in numeric order. `ends` (key, conv_id).

    A key's ids are joined piece by piece by the parts of a range, however many there are; then one pass over the pieces feeds the digest.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, held, size = None, 0, [], 0
        for batch in batches:
            out = []
            for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if k != key or size > PIECE_BYTES:
                    if held:
                        out.append((key, first, ",".join(held)))
                    key, first, held, size = k, c, [], 0
                held.append(str(c))
                size += len(held[-1]) + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.string(), pa.int64(), pa.string()))], names=["key", "first", "ids"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.string()), pa.array([first], pa.int64()), pa.array([",".join(held)], pa.string())], names=["key", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            out = []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if k == key:
                    sha.update(b"," + ids.encode())
                    continue
                if sha is not None:
                    out.append((key, sha.hexdigest()))
                key, sha = k, hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.string()) for i in (0, 1)], names=["key", "ends_sha256"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.string()), pa.array([sha.hexdigest()], pa.string())], names=["key", "ends_sha256"])

    listed = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(pieces, "key string, first long, ids string")
    return listed.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digest, "key string, ends_sha256 string")


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The trie of all conversations' beginnings, a row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    `turns` (conv_id, pos, turn_id, bytes; pos from 1 without gaps), `members` (conv_id, n: its turns, 0 too), each conv_id once.
    A node is a distinct sequence of first turns, named by its smallest member and its depth; its members begin with it.
    Turns are laid out in columns, a block of them at a time, and a ROLLUP over the columns counts all beginnings together;
    conversations whose last node in a block has more members go on in the next block, under that node. Where a node has one
    member, what follows is a chain: its nodes come straight from the turns. A second ROLLUP, from the deepest block up, sums
    leaves and saved bytes over what hangs below. No members: no rows, no root.
    """
    spark = turns.sparkSession
    prepare(spark)
    root = members.agg(F.min("conv_id")).first()[0]
    if root is None:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    active, offset, blocks, ends, tails = members.select("conv_id", "n", F.lit(root).cast("long").alias("prev")), 0, [], [], []
    while True:
        width = WIDTHS[min(len(blocks), len(WIDTHS) - 1)]
        names = [f"t{j}" for j in range(1, width + 1)]
        inside = turns.where((F.col("pos") > offset) & (F.col("pos") <= offset + width)).select("conv_id", "pos", F.struct(F.col("turn_id").alias("id"), "bytes").alias("_t"))
        if blocks:
            inside = inside.join(active.select("conv_id"), "conv_id", "left_semi")
        laid = inside.groupBy("conv_id").agg(*[F.max(F.when(F.col("pos") == offset + j, F.col("_t"))).alias(c) for j, c in enumerate(names, 1)])
        wide = cut(active.join(laid, "conv_id", "left"))
        rolled = spark.sql(f"SELECT prev, {', '.join(names)}, grouping_id() AS g, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) AS longest FROM {{wide}} GROUP BY prev, ROLLUP({', '.join(names)})", wide=wide)
        at = F.lit(width) - F.bit_count("g")
        nodes = cut(rolled.withColumn("at", at).where(F.coalesce(*[F.when(F.col("at") == j, F.col(c).isNotNull()) for j, c in enumerate(names, 1)], F.lit(False))).drop("g"))
        blocks.append((offset, width, nodes))
        ends.append(wide.where(F.col("n") <= offset + width).select(_key(offset, names).alias("key"), "conv_id"))
        full = nodes.where((F.col("at") == width) & (F.col("longest") > offset + width)).select(_key(offset, names).alias("_k"), F.col("conv_id").alias("_node"), "n_convs")
        more = wide.where(F.col("n") > offset + width).select("conv_id", "n", _key(offset, names).alias("_k"))
        on = cut(more.join(full, "_k").select("conv_id", "n", F.col("_node").alias("prev"), "n_convs"))
        offset += width
        tails.append(on.where("n_convs = 1").select("conv_id", "n", F.lit(offset).alias("_from")))
        active = on.where("n_convs > 1").select("conv_id", "n", "prev")
        if active.isEmpty():
            break

    digests = ends[0]
    for more in ends[1:]:
        digests = digests.union(more)
    digests = cut(_digests(digests))

    found, below = [], None
    for start, width, nodes in reversed(blocks):
        names = [f"t{j}" for j in range(1, width + 1)]
        end = start + width
        last = F.coalesce(*[F.when(F.col("at") == j, F.col(c)["bytes"]) for j, c in enumerate(names, 1)])
        goes_on = (F.col("at") == width) & (F.col("longest") > end)
        own = nodes.withColumns({"_saved": (F.col("n_convs") - 1) * last, "_leaf": (F.col("longest") == start + F.col("at")).cast("long")})
        if below is not None:
            own = own.join(below.withColumnRenamed("prev", "conv_id").withColumn("at", F.lit(width)), ["conv_id", "at"], "left")
        else:
            own = own.withColumns({c: F.lit(None).cast("long") for c in ("_below_children", "_below_leaves", "_below_saved")})
        own = own.withColumns({"_children": F.when(goes_on, F.coalesce("_below_children", F.lit(1))).otherwise(0), "_leaf": F.when(goes_on, F.coalesce("_below_leaves", F.lit(1))).otherwise(F.col("_leaf")), "_saved": F.col("_saved") + F.coalesce("_below_saved", F.lit(0))})
        counts = ", ".join(f"count_if(at = {j}) AS c{j}" for j in range(1, width + 1))
        summed = spark.sql(f"SELECT prev, {', '.join(names)}, grouping_id() AS g, min(conv_id) AS conv_id, max(n_convs) AS n_convs, sum(_leaf) AS n_leaves, sum(_saved) AS saved_tokens, max(CASE WHEN at = {width} THEN _children END) AS last_children, {counts} FROM {{own}} GROUP BY prev, ROLLUP({', '.join(names)})", own=own)
        summed = cut(summed.withColumn("at", F.lit(width) - F.bit_count("g")))
        below = summed.where("at = 0").select("prev", F.col("c1").alias("_below_children"), F.col("n_leaves").alias("_below_leaves"), F.col("saved_tokens").alias("_below_saved"))
        held = F.coalesce(*[F.when(F.col("at") == j, F.col(c).isNotNull()) for j, c in enumerate(names, 1)], F.lit(False))
        children = F.coalesce(*[F.when(F.col("at") == j, F.col(f"c{j + 1}")) for j in range(1, width)], F.col("last_children"), F.lit(0))
        up = F.coalesce(*[F.when(F.col("at") == j, _key(start, names[: j - 1])) for j in range(2, width + 1)])
        inside = cut(summed.where(held).select("prev", "at", "conv_id", "n_convs", "n_leaves", "saved_tokens", children.cast("long").alias("n_children"), _key(start, names).alias("key"), up.alias("_up")))
        parents = inside.where(f"at < {width}").select(F.col("key").alias("_up"), F.col("conv_id").alias("_parent"))
        placed = inside.where("at > 1").join(parents, "_up").unionByName(inside.where("at = 1").withColumn("_parent", F.col("prev")))
        found.append(placed.select("conv_id", (F.col("at") + start).cast("long").alias("depth"), F.col("_parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "key"))

    total = below.select("_below_children", "_below_leaves", "_below_saved").first()  # none: no conversation has a turn
    size = members.count()
    children, leaves, saved = total if total else (0, 1, 0)
    top = spark.range(1).select(F.lit(root).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), *[F.lit(x).cast("long").alias(c) for x, c in ((size, "n_convs"), (children, "n_children"), (leaves, "n_leaves"), (saved, "saved_tokens"))], F.md5(F.lit(f"0|{root}")).alias("key"))
    for some in found:
        top = top.unionByName(some)
    ending = F.sha2(F.lit(""), 256)
    nodes = top.join(digests, "key", "left").drop("key").withColumn("ends_sha256", F.coalesce("ends_sha256", ending))
    alone = tails[0]
    for more in tails[1:]:
        alone = alone.union(more)
    chain = turns.join(alone, "conv_id").where("pos > _from")
    is_last = F.col("pos") == F.col("n")
    chain = chain.select("conv_id", F.col("pos").cast("long").alias("depth"), F.col("conv_id").alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"), F.when(is_last, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), F.when(is_last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(ending).alias("ends_sha256"))
    return nodes.unionByName(chain)


def node_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """`nodes` with role and text of each node's last turn (the root's: null). `turns` (conv_id, pos, role, text)."""
    last = turns.select("conv_id", F.col("pos").cast("long").alias("depth"), "role", "text")
    return nodes.join(last, ["conv_id", "depth"], "left")


def grafted(turns: DataFrame, every: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another: conv_id, pos, turn_id, bytes; and conv_id, n of each, turnless ones too.

    Conversation c begins with the first h turns of conversation c - c % `every` (all if fewer, none if there is no such), and goes on
    with its own after its first h, where h is the unsigned crc32 of c in decimal, modulo `most` + 1.
    """
    lengths = cut(turns.groupBy("conv_id").agg(F.max("pos").alias("n")))
    own = lengths.select("conv_id", "n", (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("_base"))
    base = lengths.select(F.col("conv_id").alias("_base"), F.col("n").alias("_n"))
    plan = cut(own.join(base, "_base", "left").select("conv_id", "h", "_base", "n", F.least("h", F.coalesce("_n", F.lit(0))).alias("_m")))
    rows = turns.select("conv_id", "pos", "turn_id", "bytes")
    kept = rows.join(plan.select("conv_id", "h", "_m"), "conv_id").where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("_m")).alias("pos"), "turn_id", "bytes")
    lent = rows.where(F.col("pos") <= most).withColumnRenamed("conv_id", "_base").join(plan.select("conv_id", "_base", "_m"), "_base").where("pos <= _m").select("conv_id", "pos", "turn_id", "bytes")
    return cut(kept.union(lent)), plan.select("conv_id", (F.col("_m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = positioned(table(spark, sf_dir, "conversations"))
    return prefix_trie(*grafted(turns))


#: crc32 of a decimal number: eight steps a character.
_CRC = "list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda ch: ascii(ch)::BIGINT)), lambda r, x: list_reduce(list_prepend(xor(r, x), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda s, z: CASE WHEN s % 2 = 1 THEN xor(s // 2, 3988292384::BIGINT) ELSE s // 2 END))"

OP12_SQL = f"""WITH o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, sha256(length(role) || ':' || role || text) AS t, octet_length(encode(text)) AS b
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
l AS (SELECT conv_id AS c, max(i) AS n FROM o GROUP BY 1), h AS (SELECT c, n, xor({_CRC}, 4294967295::BIGINT) % 9 AS h FROM l),
p AS (SELECT h.*, c - c % 5 AS base FROM h), m AS (SELECT p.c, p.h, p.base, least(p.h, coalesce(l.n, 0)) AS m, least(p.h, coalesce(l.n, 0)) + greatest(p.n - p.h, 0) AS n FROM p LEFT JOIN l ON l.c = p.base),
r AS (SELECT c, i - h + m AS i, t, b FROM m JOIN o ON conv_id = c AND i > h UNION ALL SELECT c, i, t, b FROM m JOIN o ON conv_id = base AND i <= m),
k AS (SELECT c, i, b, sha256(string_agg(t, '') OVER (PARTITION BY c ORDER BY i)) AS k FROM r UNION ALL SELECT c, 0, 0, 'root' FROM m),
q AS (SELECT k.*, lag(k) OVER (PARTITION BY k.c ORDER BY k.i) AS up, k.i = m.n AS last FROM k JOIN m ON m.c = k.c),
v AS (SELECT k, any_value(up) AS up, any_value(i) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(b) AS b, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '')) AS ends FROM q GROUP BY k),
ch AS (SELECT up AS k, count(*) AS n FROM v GROUP BY 1),
x AS (SELECT v.*, coalesce(ch.n, 0) AS n_children FROM v LEFT JOIN ch ON ch.k = v.k),
s AS (SELECT a.k, sum((x.n_convs - 1) * x.b) AS saved, count(*) FILTER (x.n_children = 0) AS leaves FROM x JOIN q d ON d.k = x.k AND d.c = x.conv_id JOIN q a ON a.c = d.c AND a.i <= d.i GROUP BY a.k)
SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, x.n_convs, x.n_children, s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, x.ends AS ends_sha256
FROM x JOIN s ON s.k = x.k LEFT JOIN v u ON u.k = x.up"""

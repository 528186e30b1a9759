"""Approximate nearest neighbours: a forest of random-projection trees, searched through one priority queue, candidates reranked exactly."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genomill.llm.common import cut, grouped, prepare, table

#: Rows of a leaf that a task holds at once; a larger leaf is searched in chunks.
CHUNK = 8192
#: What a leaf's visit costs besides its rows, in rows: its partial answer is written, shuffled and merged.
VISIT_ROWS = 2048
#: Trees are never cut above this depth where the sample allows it: a forest of undivided trees would be plain brute force.
MIN_DEPTH = 4


@dataclass
class Forest:
    """Complete binary trees: node i has children 2i + 1 and 2i + 2; `normals` (tree, node, dim), `cuts` (tree, node); cut at `depth`, `visits` leaves searched."""

    normals: np.ndarray
    cuts: np.ndarray
    depth: int
    visits: int

    def leaves(self, x: np.ndarray, depth: int) -> np.ndarray:
        """Leaf of each row in each tree."""
        out = np.zeros((len(self.normals), len(x)), np.int64)
        for t, (h, c) in enumerate(zip(self.normals, self.cuts, strict=True)):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (np.einsum("ij,ij->i", x, h[node]) > c[node])
            out[t] = node - (2**depth - 1)
        return out

    def order(self, q: np.ndarray, depth: int) -> np.ndarray:
        """For each query the place of every (tree, leaf) in its search order, as one number per leaf."""
        worst = []
        for h, c in zip(self.normals, self.cuts, strict=True):
            side = q @ h[: 2**depth - 1].T - c[: 2**depth - 1]
            level = np.zeros((len(q), 1))
            for d in range(depth):
                here = side[:, 2**d - 1 : 2 ** (d + 1) - 1]
                level = np.stack([np.maximum(level, here), np.maximum(level, -here)], axis=2).reshape(len(q), -1)
            worst.append(level)
        both = np.concatenate(worst, axis=1)
        place = np.empty(both.shape, np.int64)
        np.put_along_axis(place, both.argsort(axis=1, kind="stable"), np.arange(both.shape[1])[None, :], axis=1)
        return place

    def search(self, q: np.ndarray) -> list[tuple[int, int]]:
        """The (tree, leaf) pairs that a query visits: all trees share one queue, ordered by how far the query is on the wrong side of a cut."""
        inner = 2**self.depth - 1
        side = [h[:inner] @ q - c[:inner] for h, c in zip(self.normals, self.cuts, strict=True)]
        queue = [(0.0, t, 0) for t in range(len(side))]
        found: list[tuple[int, int]] = []
        while queue and len(found) < self.visits:
            far, t, node = heapq.heappop(queue)
            while node < inner:
                x = side[t][node]
                heapq.heappush(queue, (max(far, abs(x)), t, 2 * node + (1 if x > 0 else 2)))
                node = 2 * node + (2 if x > 0 else 1)
            found.append((t, node - inner))
        return found


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten(), np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _grow(x: np.ndarray, trees: int, depth: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Trees over sample rows: of 8 random directions the one along which a node's rows spread most, cut at their median."""
    normals, cuts = np.zeros((trees, 2**depth - 1, x.shape[1])), np.zeros((trees, 2**depth - 1))
    for t in range(trees):
        members = {0: np.arange(len(x))}
        for node in range(2**depth - 1):
            rows = members.pop(node)
            h = rng.normal(size=(8, x.shape[1]))
            h /= np.linalg.norm(h, axis=1, keepdims=True)
            if len(rows):
                p = x[rows] @ h.T
                best = int(p.std(axis=0).argmax())
                normals[t, node], cuts[t, node] = h[best], np.median(p[:, best])
                right = p[:, best] > cuts[t, node]
                members[2 * node + 1], members[2 * node + 2] = rows[~right], rows[right]
            else:
                normals[t, node] = h[0]
                members[2 * node + 1] = members[2 * node + 2] = rows
    return normals, cuts


def _exact(index: DataFrame, queries: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query number, vector) of the k nearest of a few queries by brute force over all rows, to measure recall against."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0), np.zeros(0, np.int64), np.zeros((0, queries.shape[1])))] * len(queries)
        for batch in batches:
            x, rep = _matrix(batch.column("v")), np.array(batch.column("rep"))
            score = queries @ x.T
            for i in range(len(queries)):
                s = np.where(rep == ids[i], -np.inf, score[i])
                top = np.argpartition(-s, min(k, len(s) - 1))[:k]
                s, r, v = (np.concatenate([a, b]) for a, b in zip(best[i], (s[top], rep[top], x[top]), strict=True))
                keep = np.lexsort((r, -s))[:k]
                best[i] = (s[keep], r[keep], v[keep])
        rows = [(i, float(a), int(b), c.tolist()) for i, x in enumerate(best) for a, b, c in zip(*x, strict=True) if np.isfinite(a)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["i", "s", "rep", "v"])

    rows = index.select("rep", "v").mapInArrow(run, "i long, s double, rep long, v array<double>")
    near = rows.withColumn("_r", F.row_number().over(Window.partitionBy("i").orderBy(F.desc("s"), "rep"))).where(F.col("_r") <= k).select("i", "v").toArrow()
    return np.array(near.column("i")), _matrix(near.column("v").combine_chunks()) if near.num_rows else np.zeros((0, queries.shape[1]))


def fit(index: DataFrame, n: int, k: int, recall: float, trees: int = 4, sample_rows: int = 65_536, sample_bytes: int = 64 << 20, probes: int = 128, seed: int = 5) -> Forest:
    """A forest over at most `sample_rows` rows and `sample_bytes` (drawn by a hash of the id), then its depth and its number of visits.

    For `probes` sample rows the true neighbours among all rows are found by brute force. For each depth the fewest leaves are
    sought that hold `recall` of them; of the depths, the one whose search costs least (rows of the visited leaves, and a fixed
    cost a visit) is taken. Where neighbours are well apart, trees come out deep and few leaves are visited; where all rows are
    about as far from each other, no index prunes much, and the forest stays shallow.
    """
    drawn = index.select("rep", F.col("v").cast("array<double>").alias("v"), F.xxhash64("rep").alias("_o")).orderBy("_o", "rep").limit(sample_rows).toArrow()
    ids, x = np.array(drawn.column("rep")), _matrix(drawn.column("v").combine_chunks())
    most = max(1, sample_bytes // (8 * x.shape[1]))
    ids, x = ids[:most], x[:most]
    depth = max(0, int(np.log2(max(1, len(x) / 32))))
    forest = Forest(*_grow(x, trees, depth, np.random.default_rng(seed)), 0, trees)
    q, own = x[:probes], ids[:probes]
    which, near = _exact(index, q, own, k)
    best = None
    for d in range(min(depth, MIN_DEPTH), depth + 1):
        place = forest.order(q, d)
        at = forest.leaves(near, d) + (np.arange(trees) * 2**d)[:, None]
        first = np.sort(place[which[None, :], at].min(axis=0)) if len(which) else np.zeros(0, np.int64)
        visits = int(first[min(len(first) - 1, int(np.ceil(recall * len(first))))]) + 1 if len(first) else trees
        cost = visits * (n / 2**d + VISIT_ROWS)
        if best is None or cost < best[0]:
            best = (cost, d, visits)
    return Forest(forest.normals, forest.cuts, best[1], best[2])


def nearest(vectors: DataFrame, k: int = 20, query: str = "vec_id % 20 = 0", recall: float = 0.95, trees: int = 4) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row of `vectors` (vec_id, embedding) that `query` selects its k nearest found among all others.

    Nearness is the largest inner product, in double precision on the original components; ties go to the smaller vec_id.
    Trees are fitted on a bounded sample (`fit`), but every row is indexed. Equal vectors are indexed once, with their k + 1
    smallest ids: no query's answer can hold more of them. Leaf candidates are scored exactly, leaf by leaf and in chunks.
    Rows with a null id, a null or zero vector, or null or non-finite components take no part, nor do vectors of another
    length than the most frequent one (of equally frequent ones the longer). A repeated vec_id stands for its smallest vector.
    Other columns are ignored. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    prepare(spark)
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL").where(usable)
    sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    answer = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], answer)
    dim = sizes[0]["dim"]
    rows = rows.where(F.size("v") == dim).groupBy("vec_id").agg(F.min("v").alias("v"))
    first = Window.partitionBy("v").orderBy("vec_id")
    equal = cut(rows.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("members")).select(F.col("members")[0].alias("rep"), "v", "members"))
    asked = rows.where(query).join(equal.select("rep", F.col("v").alias("_v")), F.col("v") == F.col("_v")).select(F.col("vec_id").alias("query_id"), F.col("rep").alias("qrep"))
    asked = cut(asked)
    index = equal.select("rep", "v")
    n = equal.count()
    forest = fit(index, n, k, recall, trees)
    shared = spark.sparkContext.broadcast(forest)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                leaf = f.leaves(_matrix(part.column("v")), f.depth)
                for t in range(len(leaf)):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(part.num_rows, t, np.int32)), pa.array(leaf[t]), part.column("rep"), part.column("v")], names=["tree", "leaf", "id", "v"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for batch in batches:
            x = _matrix(batch.column("v"))
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                pairs = [(i, t, leaf) for i in range(part.num_rows) for t, leaf in f.search(x[at + i])]
                i, t, leaf = (np.array(c, np.int64) for c in zip(*pairs, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(t.astype(np.int32)), pa.array(leaf), part.column("rep").take(pa.array(i)), part.column("v").take(pa.array(i))], names=["tree", "leaf", "id", "v"])

    kinds = "tree int, leaf long, id long, v array<double>"
    placed = cut(index.mapInArrow(place, kinds))
    chunks = placed.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    # at most trees * 2^depth rows, of which a fit on a bounded sample gives at most a few thousand
    chunks = F.broadcast(chunks)
    held = placed.join(chunks, ["tree", "leaf"]).select("tree", "leaf", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int").alias("chunk"), F.lit(0).alias("kind"), "id", "v")
    visitors = index.join(asked.select(F.col("qrep").alias("rep")).distinct(), "rep", "left_semi").mapInArrow(visit, kinds)
    visitors = visitors.join(chunks, ["tree", "leaf"]).select("tree", "leaf", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(1).alias("kind"), "id", "v")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, ids, x = None, np.zeros(0, np.int64), np.zeros((0, dim))
        for part in grouped(batches, ["tree", "leaf", "chunk", "kind"]):
            part = part.combine_chunks()
            key = tuple(part.column(c)[0].as_py() for c in ("tree", "leaf", "chunk"))
            own, vecs = np.array(part.column("id")), _matrix(part.column("v").combine_chunks())
            if part.column("kind")[0].as_py() == 0:
                here, ids, x = key, own, vecs
                continue
            if key != here:
                continue  # an empty chunk
            for at in range(0, len(own), 512):
                q, qid = vecs[at : at + 512], own[at : at + 512]
                rough = q @ x.T
                take = min(k + 4, len(ids))
                top = np.argpartition(-rough, take - 1, axis=1)[:, :take]
                exact = np.einsum("ijk,ik->ij", x[top], q)
                order = np.lexsort((ids[top], -exact), axis=1)[:, : k + 1]
                top, exact = np.take_along_axis(top, order, axis=1), np.take_along_axis(exact, order, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qid, top.shape[1])), pa.array(ids[top].ravel()), pa.array(exact.ravel())], names=["qrep", "rep", "score"])

    keys = ["tree", "leaf", "chunk"]
    together = held.unionByName(visitors)
    found = together.repartition(*keys).sortWithinPartitions(*keys, "kind").mapInArrow(score, "qrep long, rep long, score double")
    best = Window.partitionBy("qrep").orderBy(F.desc("score"), "rep")
    found = found.groupBy("qrep", "rep").agg(F.max("score").alias("score")).withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1).drop("_r")
    found = found.join(equal.select("rep", "members"), "rep").select("qrep", "score", F.explode("members").alias("vec_id"))
    one = Window.partitionBy("qrep").orderBy(F.desc("score"), "vec_id")
    # written, so that Spark can split the partition of a vector that very many queries share
    found = cut(found.withColumn("_r", F.row_number().over(one)).where(F.col("_r") <= k + 1).drop("_r"))
    ranked = asked.join(found, "qrep").where("vec_id <> query_id").withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))

"""Graphs as edge tables (columns a, b): sampled partitions, components, label propagation, communities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genomill.operators.trees import settle


def og_edge_freq(partitions: DataFrame) -> DataFrame:
    """Samples in which two genes of a family share a group; a gene alone in its group is linked to itself. `partitions` (family, sample, og, gene)."""
    key = ["family", "sample", "og"]
    a, b = (partitions.select(*key, F.col("gene").alias(x)) for x in ("a", "b"))
    pairs = a.join(b, key).where("a < b")
    alone = partitions.groupBy(*key).agg(F.min("gene").alias("a"), F.max("gene").alias("b")).where("a = b")
    return pairs.select("family", "a", "b").unionByName(alone.select("family", "a", "b")).groupBy("family", "a", "b").agg(F.count("*").alias("freq"))


def majority_edges(edges: DataFrame, share: float, n: int) -> DataFrame:
    """Edges found in more than `share` of n samples."""
    return edges.where(F.col("freq") > share * n)


def components(edges: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Keys, node, component (its smallest node), separately for each value of `keys`.

    Each round takes the smallest label among the neighbours, then the label of that label, so that long chains are halved.
    Rounds are cut by checkpoints; only the number of changed labels reaches the driver.
    """
    both = edges.select(*keys, "a", "b").unionByName(edges.select(*keys, F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = settle(both)
    labels = settle(both.groupBy(*keys, F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")))
    while True:
        near = both.join(labels.withColumnsRenamed({"node": "b", "label": "_near"}), [*keys, "b"]).groupBy(*keys, F.col("a").alias("node")).agg(F.min("_near").alias("_near"))
        better = labels.join(near, [*keys, "node"]).select(*keys, "node", F.col("label").alias("_old"), F.least("label", "_near").alias("label"))
        of_label = labels.select(*keys, F.col("node").alias("label"), F.col("label").alias("_far"))
        moved = settle(better.join(of_label, [*keys, "label"], "left").select(*keys, "node", "_old", F.least("label", F.coalesce("_far", "label")).alias("label")))
        labels = moved.drop("_old")
        if moved.where("label < _old").isEmpty():
            return labels.withColumnRenamed("label", "component")


def label_propagation(edges: DataFrame, rounds: int) -> DataFrame:
    """Node, community after so many rounds in which each node takes the label of the largest summed `weight` around it (ties: the smallest)."""
    both = settle(edges.select("a", "b", "weight").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "weight")))
    labels = both.select(F.col("a").alias("node"), F.col("a").alias("community")).distinct()
    for _ in range(rounds):
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a", "community").agg(F.round(F.sum("weight"), 6).alias("_w"))
        labels = settle(seen.groupBy(F.col("a").alias("node")).agg(F.max_by("community", F.struct("_w", -F.col("community"))).alias("community")))
    return labels


def association_graph(pairs: DataFrame) -> DataFrame:
    """Vertices of a table of pairs, with their degree and summed weight."""
    return pairs.select(F.explode(F.array("a", "b")).alias("node"), "weight").groupBy("node").agg(F.count("*").alias("degree"), F.round(F.sum("weight"), 6).alias("strength"))


def community_edges(edges: DataFrame, communities: DataFrame) -> DataFrame:
    """I8: edges with both ends in one community."""
    a, b = (communities.select(F.col("node").alias(x), "community") for x in ("a", "b"))
    return edges.join(a, "a").join(b, ["b", "community"]).select("community", "a", "b", "weight")


def community_cohesion(edges: DataFrame, communities: DataFrame) -> DataFrame:
    """H5: edges within each community and the median of their weights."""
    return community_edges(edges, communities).groupBy("community").agg(F.count("*").alias("n_edges"), F.round(F.median("weight"), 9).alias("median_weight"))


def community_families(communities: DataFrame, families: DataFrame) -> DataFrame:
    """The families present in each community. `families` (node, family)."""
    return communities.join(families, "node").select("community", "family").distinct()


def small_communities(communities: DataFrame, most: int) -> DataFrame:
    """Members of communities with at most `most` of them."""
    return communities.withColumn("_n", F.count("*").over(Window.partitionBy("community"))).where(F.col("_n") <= most).drop("_n")


def partition_agreement(first: DataFrame, second: DataFrame) -> DataFrame:
    """How many groups two partitions have, and how many of them have the same members. Both: (family, og, member)."""
    x, y = (d.groupBy("family", "og").agg(F.sha2(F.to_json(F.array_sort(F.collect_set("member"))), 256).alias("_key")).select("_key") for d in (first, second))
    both = x.withColumn("_1", F.lit(1)).join(y.withColumn("_2", F.lit(1)), "_key", "full_outer")
    return both.agg(F.count("_1").alias("n_first"), F.count("_2").alias("n_second"), F.count(F.col("_1") + F.col("_2")).alias("n_identical"))


def _weakest_links(edges: DataFrame, members: DataFrame, keys: list[str]) -> DataFrame:
    """The weakest edge of every shortest path between members of one species in one component (first of equals along the path).

    Paths grow by one edge a round, from the smaller end of each pair, as arrays of nodes; a pair is done once it is reached.
    """
    both = settle(edges.select(*keys, "a", "b", "weight").unionByName(edges.select(*keys, F.col("b").alias("a"), F.col("a").alias("b"), "weight")))
    x, y = (members.select(*keys, "component", "species", F.col("node").alias(n)) for n in ("x", "y"))
    waiting = settle(x.join(y, [*keys, "component", "species"]).where("x < y").select(*keys, "x", "y"))
    paths = waiting.select(*keys, "x", F.col("x").alias("end"), F.lit(None).cast("struct<weight:double,at:int,a:long,b:long>").alias("weak"), F.lit(0).alias("n")).distinct()
    seen = paths.select(*keys, "x", "end")
    found = None
    while not waiting.isEmpty():
        step = paths.join(both.withColumnRenamed("a", "end"), [*keys, "end"])
        edge = F.struct(F.col("weight").cast("double").alias("weight"), (F.col("n") + 1).alias("at"), F.least("end", "b").cast("long").alias("a"), F.greatest("end", "b").cast("long").alias("b"))
        step = step.select(*keys, "x", F.col("b").alias("end"), F.least(F.coalesce("weak", edge), edge).alias("weak"), (F.col("n") + 1).alias("n"))
        paths = settle(step.join(seen, [*keys, "x", "end"], "left_anti").distinct())
        if paths.isEmpty():
            break
        done = waiting.join(paths.withColumnRenamed("end", "y"), [*keys, "x", "y"]).select(*keys, "weak.a", "weak.b").distinct()
        found = done if found is None else found.unionByName(done)
        waiting = settle(waiting.join(paths.select(*keys, "x", F.col("end").alias("y")).distinct(), [*keys, "x", "y"], "left_anti"))
        seen = settle(seen.unionByName(paths.select(*keys, "x", "end").distinct()))
    return found.distinct() if found is not None else edges.select(*keys, "a", "b").limit(0)


def enforce_unicity(edges: DataFrame, species: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """I4: keys, node, component such that no component holds two genes of one species. `edges` (keys, a, b, weight), `species` (node, species).

    While some component does, the weakest edge of each shortest path between its genes of one species is dropped and components are
    found again. Genes left without edges are components of their own.
    """
    keys = list(keys)
    edges = settle(edges.select(*keys, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "weight").where("a <> b").distinct())
    nodes = edges.select(*keys, F.explode(F.array("a", "b")).alias("node")).distinct()
    while True:
        parts = settle(components(edges, tuple(keys)))
        held = parts.join(species, "node")
        bad = held.groupBy(*keys, "component", "species").count().where("count > 1").drop("count")
        members = settle(held.join(bad, [*keys, "component", "species"], "left_semi"))
        if members.isEmpty():
            return nodes.join(parts, [*keys, "node"], "left").withColumn("component", F.coalesce("component", "node"))
        inside = edges.join(members.select(*keys, "component").distinct().join(parts, [*keys, "component"]).select(*keys, F.col("node").alias("a")), [*keys, "a"], "left_semi")
        edges = settle(edges.join(_weakest_links(inside, members, keys), [*keys, "a", "b"], "left_anti"))


def reference_community(edges: DataFrame, node: int, rounds: int, most: int = 25) -> DataFrame:
    """Node: the community around a given node, found again inside itself until it has at most `most` members or no longer gets smaller."""
    edges = settle(edges)
    size = None
    while True:
        communities = settle(label_propagation(edges, rounds))
        own = communities.join(communities.where(F.col("node") == node).select("community"), "community", "left_semi").select("node")
        now = own.count()
        if now <= most or now == size:
            return own
        size = now
        edges = settle(edges.join(own.withColumnRenamed("node", "a"), "a", "left_semi").join(own.withColumnRenamed("node", "b"), "b", "left_semi"))

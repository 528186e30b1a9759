"""Trees as intervals: an Euler tour ranked by pointer jumping, clades as ranges of it, common ancestors by range minima.

None of this holds a row for each node and ancestor: a tour has two rows a node, range minima a row for each node and power of two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genomill.operators.sequences import number_rows
from genomill.operators.trees import settle


def euler_tour(nodes: DataFrame) -> DataFrame:
    """node, parent, pre (from 1), last (pre of its last descendant), depth (root: 0), leaf_from, n_leaves: each node's place in a walk over the tree.

    Children are visited by id; leaves (`is_tip`) of a clade are numbers leaf_from to leaf_from + n_leaves - 1 of the walk. The walk is a
    list of two elements a node, down and up, each naming the next; jumping over 1, 2, 4, ... of them, all know what lies ahead after
    log2 rounds, however deep the tree. Several roots are walked one after another.
    """
    rows = number_rows(nodes.select(F.col("branch_id").cast("long").alias("v"), F.col("parent_branch_id").cast("long").alias("p"), "is_tip"), ["p", "v"], "i")
    rows = settle(rows)
    first = rows.where("p IS NOT NULL").groupBy("p").agg(F.min("v").alias("child")).withColumnRenamed("p", "v")
    after = rows.select((F.col("i") - 1).alias("i"), F.col("p").alias("_p"), F.col("v").alias("_v"))
    known = rows.join(first, "v", "left").join(after, "i", "left").withColumn("beside", F.when(F.col("p").eqNullSafe(F.col("_p")), F.col("_v")))
    # element 2v goes down to v, 2v + 1 up from it
    down = F.struct((2 * F.col("v")).alias("e"), F.coalesce(2 * F.col("child"), 2 * F.col("v") + 1).alias("next"), F.lit(1).cast("long").alias("ahead"), F.col("is_tip").cast("long").alias("tips"), F.lit(1).cast("long").alias("level"))
    up = F.struct((2 * F.col("v") + 1).alias("e"), F.coalesce(2 * F.col("beside"), 2 * F.col("p") + 1).alias("next"), F.lit(0).cast("long").alias("ahead"), F.lit(0).cast("long").alias("tips"), F.lit(-1).cast("long").alias("level"))
    walk = settle(known.select(F.explode(F.array(down, up)).alias("_e")).select("_e.*"))
    while not walk.where("next IS NOT NULL").isEmpty():
        beyond = walk.select(F.col("e").alias("next"), F.col("next").alias("_next"), *[F.col(c).alias(f"_{c}") for c in ("ahead", "tips", "level")])
        added = [(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in ("ahead", "tips", "level")]
        walk = settle(walk.join(beyond, "next", "left").select("e", F.col("_next").alias("next"), *added))
    both = walk.select(F.expr("e div 2").alias("v"), (F.col("e") % 2 == 0).alias("_down"), "ahead", "tips", "level").groupBy("v").agg(*[F.max(F.when(F.col("_down") == side, F.col(c))).alias(f"{c}_{name}") for side, name in ((True, "down"), (False, "up")) for c in ("ahead", "tips", "level")])
    n = rows.agg(F.count("*").alias("_n"), F.sum(F.col("is_tip").cast("long")).alias("_tips"))
    placed = rows.join(both, "v").join(n)
    kind = nodes.schema["branch_id"].dataType
    return settle(placed.select(F.col("v").cast(kind).alias("node"), F.col("p").cast(kind).alias("parent"), (F.col("_n") - F.col("ahead_down") + 1).alias("pre"), (F.col("_n") - F.col("ahead_up")).alias("last"), (-F.col("level_down")).alias("depth"), (F.col("_tips") - F.col("tips_down") + 1).alias("leaf_from"), (F.col("tips_down") - F.col("tips_up")).alias("n_leaves")))


def range_minima(tour: DataFrame) -> DataFrame:
    """power, start, least (depth, parent): the shallowest node among the 2^power nodes of the walk from `start` on; ties: the first."""
    level = settle(tour.select(F.lit(0).alias("power"), F.col("pre").alias("start"), F.struct("depth", "pre", "parent").alias("least")))
    n, power, out = tour.count(), 0, level
    while 2 << power <= n:
        beside = level.select((F.col("start") - (1 << power)).alias("start"), F.col("least").alias("_least"))
        power += 1
        level = settle(level.join(beside, "start").select(F.lit(power).alias("power"), "start", F.least("least", "_least").alias("least")))
        out = out.unionByName(level)
    return out.select("power", "start", "least")


def _shallowest(pairs: DataFrame, minima: DataFrame, begin: Column, end: Column) -> DataFrame:
    """`pairs` with _least, the shallowest node of the walk from `begin` to `end` (none if that is empty): two powers of two cover any range."""
    asked = pairs.withColumns({"_from": begin, "_to": end}).withColumn("power", F.length(F.bin(F.col("_to") - F.col("_from") + 1)) - 1)
    for i, start in ((1, F.col("_from")), (2, F.expr("_to - shiftleft(1L, power) + 1"))):
        asked = asked.withColumn("start", start).join(minima.withColumnRenamed("least", f"_least_{i}"), ["power", "start"], "left").drop("start")
    return asked.withColumn("_least", F.least("_least_1", "_least_2")).drop("_from", "_to", "power", "_least_1", "_least_2")


def common_ancestors(members: DataFrame, tour: DataFrame, minima: DataFrame, key: str) -> DataFrame:
    """Key, n_members, mrca: the most recent common ancestor of each set of nodes; none if they lie in several trees. `members` (key, node).

    The first and the last member of the walk decide: the shallowest node after the first, up to the last, hangs on their ancestor.
    """
    placed = members.select(key, "node").distinct().join(tour.select("node", "pre"), "node")
    ends = placed.groupBy(key).agg(F.count("*").alias("n_members"), F.min("pre").alias("_pre_first"), F.max("pre").alias("_pre_last"), F.min_by("node", "pre").alias("_first"))
    alone = ends.where("_pre_first = _pre_last").select(key, "n_members", F.col("_first").alias("mrca"))
    met = _shallowest(ends.where("_pre_first < _pre_last"), minima, F.col("_pre_first") + 1, F.col("_pre_last"))
    return alone.unionByName(met.where("_least.parent IS NOT NULL").select(key, "n_members", F.col("_least.parent").alias("mrca")))


def leaf_sets(nodes: DataFrame, tour: DataFrame) -> DataFrame:
    """Ancestor, n_leaves, leaves: the leaves under each node, their number and sorted names. A clade is a range of leaf numbers."""
    names = nodes.where("is_tip").select(F.col("branch_id").alias("node"), "branch_name").join(tour.select("node", F.col("leaf_from").alias("_leaf")), "node").select("_leaf", "branch_name")
    inside = tour.where("n_leaves > 0").select(F.col("node").alias("ancestor"), "n_leaves", F.explode(F.expr("sequence(leaf_from, leaf_from + n_leaves - 1)")).alias("_leaf"))
    return inside.join(names, "_leaf").groupBy("ancestor", "n_leaves").agg(F.array_join(F.array_sort(F.collect_list("branch_name")), ",").alias("leaves"))


def tip_distances(nodes: DataFrame, tour: DataFrame, minima: DataFrame, block: int = 256) -> DataFrame:
    """tip_1 < tip_2, edges between them by way of their last common ancestor; tips of different trees have none. All pairs of tips are the result.

    Only neighbours in the walk ask for their common ancestor: that of two tips is the shallowest of those between them. Tips are dealt
    into blocks of the walk; a row for each two blocks holds the least depth between them, and meets the tips of both blocks, each with
    the least depth up to its block's edge, so that a pair is one sum and no row of a pair is shuffled. Pairs inside a block (the next
    tips up to its end) take their least depth from the gaps between. -1 stands for a gap between trees.
    """
    tips = settle(number_rows(tour.join(nodes.where("is_tip").select(F.col("branch_id").alias("node")), "node").select("node", "pre", "depth"), ["pre"], "k"))
    after = tips.select((F.col("k") - 1).alias("k"), F.col("pre").alias("_pre"))
    met = _shallowest(tips.join(after, "k").select("k", "pre", "_pre"), minima, F.col("pre") + 1, F.col("_pre"))
    # gap: depth of the common ancestor of a tip and the one before it
    gaps = met.select((F.col("k") + 1).alias("k"), F.when(F.col("_least.parent").isNotNull(), F.col("_least.depth") - 1).otherwise(-1).alias("gap"))
    dealt = settle(tips.join(gaps, "k", "left").select("k", F.expr(f"(k - 1) div {block}").alias("block"), "node", "depth", F.coalesce("gap", F.lit(-1)).alias("gap")))
    rows = Window.partitionBy("block").orderBy("k").rowsBetween
    placed = dealt.withColumn("low", F.min("gap").over(rows(Window.unboundedPreceding, 0))).withColumn("high", F.min("gap").over(rows(1, Window.unboundedFollowing)))
    # high: from a tip to the end of its block (of its last tip: no gap, so that none is less)
    each = F.struct("k", "node", "depth", "gap", "low", F.coalesce("high", F.lit(2**31 - 1)).alias("high"))
    blocks = settle(placed.groupBy("block").agg(F.array_sort(F.collect_list(each)).alias("tips"), F.min("gap").alias("least")))
    n = blocks.count()
    pairs = blocks.select(F.col("block").alias("_i")).join(F.broadcast(blocks.select(F.col("block").alias("_j"), "least")), F.col("_i") < F.col("_j"))
    between = F.min("least").over(Window.partitionBy("_i").orderBy("_j").rowsBetween(Window.unboundedPreceding, -1))
    pairs = settle(pairs.select("_i", "_j", F.coalesce(between, F.lit(2**31 - 1)).alias("_least")))
    own, other = (blocks.select(F.col("block").alias(b), F.col("tips").alias(f"_tips{b}")) for b in ("_i", "_j"))
    far = pairs.repartition(n // 8 + 1, "_i", "_j").join(F.broadcast(own), "_i").join(F.broadcast(other), "_j")
    far = far.select("_least", "_tips_j", F.explode("_tips_i").alias("_a")).select(F.col("_a.node").alias("_1"), F.col("_a.depth").alias("_d1"), F.least("_least", "_a.high").alias("_least"), F.explode("_tips_j").alias("_b"))
    far = far.select("_1", F.col("_b.node").alias("_2"), F.col("_d1"), F.col("_b.depth").alias("_d2"), F.least("_least", "_b.low").alias("_at"))
    ahead = F.expr(f"slice(tips, place + 2, {block})")
    near = blocks.repartition(n // 8 + 1, "block").select("tips", F.posexplode("tips").alias("place", "_a")).select("_a", ahead.alias("_next")).where(F.size("_next") > 0)
    near = near.select("_a", "_next", F.posexplode("_next").alias("_at", "_b")).select(F.col("_a.node").alias("_1"), F.col("_b.node").alias("_2"), F.col("_a.depth").alias("_d1"), F.col("_b.depth").alias("_d2"), F.array_min(F.slice(F.col("_next")["gap"], F.lit(1), F.col("_at") + 1)).alias("_at"))
    return far.unionByName(near).where("_at >= 0").select(F.least("_1", "_2").alias("tip_1"), F.greatest("_1", "_2").alias("tip_2"), (F.col("_d1") + F.col("_d2") - 2 * F.col("_at")).cast("int").alias("distance"))


def inside_of(tour: DataFrame, tops: DataFrame) -> DataFrame:
    """node, top: nodes in the clade of each of `tops` (node), itself included: a range of the walk, dealt by equal numbers."""
    ranges = tops.select("node").distinct().join(tour.select("node", "pre", "last"), "node")
    wanted = ranges.select(F.col("node").alias("top"), F.explode(F.expr("sequence(pre, last)")).alias("pre"))
    return wanted.join(tour.select("node", "pre"), "pre").select("node", "top")


def translate_events(events: DataFrame, leaves: DataFrame, tour: DataFrame, minima: DataFrame) -> DataFrame:
    """Events (lineage, sample, event_type, don, rec: branches of a collapsed tree) on the full tree's branches, once a lineage and sample.

    `leaves` (branch, node): the full tree's leaves that each collapsed branch stands for; a branch becomes their last common ancestor.
    Transfers whose ends become one branch are dropped.
    """
    mrca = settle(common_ancestors(leaves.select(F.col("branch").alias("_b"), "node"), tour, minima, "_b").select("_b", "mrca"))
    for c in ("don", "rec"):
        events = events.join(mrca.withColumnsRenamed({"_b": c, "mrca": f"_{c}"}), c, "left")
    moved = events.select("lineage", "sample", "event_type", F.col("_don").alias("don"), F.col("_rec").alias("rec"))
    return moved.where("don IS NULL OR rec IS NULL OR don <> rec").distinct()

"""Trees as tables (branch_id, parent_branch_id, branch_name, is_tip): closure, clades, ages, groups of genes."""

from __future__ import annotations

import operator
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COMPARISONS = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge, "==": operator.eq}
SUMMARIES = {"min": F.min, "max": F.max, "mean": F.avg, "median": F.median}


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share (`spark.checkpoint.dir`); in a temporary folder only where none is set and Spark is local."""
    sc = spark.sparkContext
    where = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not where:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        where = sc.getCheckpointDir()
    return f"{where}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files behind: they go as soon as the write ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def settle(df: DataFrame) -> DataFrame:
    """`df` written as Parquet into the shared folder and read back, so that its lineage ends, its shuffle files go and later plans know its size."""
    path = shared_path(df.sparkSession, "settled")
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def closure(nodes: DataFrame) -> DataFrame:
    """Node, ancestor, distance for each ancestor of a node, itself (0) included.

    Known paths are doubled in each round, so that a tree of depth h takes log2(h) joins.
    """
    nodes = nodes.select(F.col("branch_id").alias("node"), F.col("parent_branch_id").alias("ancestor"))
    pairs = settle(nodes.where("ancestor IS NOT NULL").withColumn("distance", F.lit(1)))
    reach = 1
    while True:
        far = pairs.where(F.col("distance") == reach).select("node", F.col("ancestor").alias("_mid"), F.col("distance").alias("_d"))
        on = pairs.select(F.col("node").alias("_mid"), "ancestor", "distance")
        more = settle(far.join(on, "_mid").select("node", "ancestor", (F.col("_d") + F.col("distance")).alias("distance")))
        if more.isEmpty():
            break
        pairs, reach = pairs.unionByName(more), reach * 2
    return pairs.unionByName(nodes.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("distance")))


def depths(paths: DataFrame) -> DataFrame:
    """Edges between each node and the root."""
    return paths.groupBy("node").agg(F.max("distance").alias("depth"))


def _tips(nodes: DataFrame) -> DataFrame:
    return nodes.where("is_tip").select(F.col("branch_id").alias("node"), "branch_name")


def clade_definitions(nodes: DataFrame, paths: DataFrame, least: int) -> DataFrame:
    """Each clade of two leaves or more whose parent has two children, with its sister and its background; under other nodes no clade is defined.

    The background is taken under the nearest ancestor that has `least` leaves outside the clade, else under the root.
    """
    sizes = paths.join(_tips(nodes), "node").groupBy(F.col("ancestor").alias("clade")).agg(F.count("*").alias("n_members"))
    parents = nodes.select(F.col("branch_id").alias("clade"), F.col("parent_branch_id").alias("_p"))
    paired = parents.where("_p IS NOT NULL").groupBy("_p").agg(F.count("*").alias("_c")).where("_c = 2").select("_p")
    clades = sizes.where("n_members > 1").join(parents.join(paired, "_p"), "clade")
    sisters = parents.select(F.col("clade").alias("sister"), "_p").join(sizes.select(F.col("clade").alias("sister"), F.col("n_members").alias("n_sister")), "sister")
    above = paths.where("distance > 0").select(F.col("node").alias("clade"), F.col("ancestor").alias("_a"), "distance").join(sizes.select(F.col("clade").alias("_a"), F.col("n_members").alias("_n")), "_a")
    outside = F.col("_n") - F.col("n_members")
    # ancestors with enough leaves come first, the nearest before others; of the rest, the farthest, which is the root
    order = F.struct((outside < least).cast("int"), F.when(outside < least, -F.col("distance")).otherwise(F.col("distance")))
    grown = clades.join(above, "clade").groupBy("clade").agg(F.min_by(F.struct(F.col("_a"), outside.alias("_o")), order).alias("_b"))
    return clades.join(sisters, "_p").where("sister <> clade").join(grown, "clade").select("clade", "n_members", "sister", "n_sister", F.col("_b._a").alias("background"), F.col("_b._o").alias("n_background"))


def near_tips(nodes: DataFrame, most: int) -> DataFrame:
    """Links (a, b) over which tips are connected just as over all pairs of tips at most so many edges apart.

    Each tip climbs `most` edges. Under an ancestor two tips are near if their ways there add up to `most` or less; then either is
    near to the tip of the shortest way (ties: the smallest), and a link to that one does. No pairs of tips are listed.
    """
    up = nodes.select(F.col("branch_id").alias("at"), F.col("parent_branch_id").alias("_up")).where("_up IS NOT NULL")
    here = _tips(nodes).select("node", F.col("node").alias("at"), F.lit(0).alias("way"))
    ways = here
    for _ in range(most):
        here = here.join(up, "at").select("node", F.col("_up").alias("at"), (F.col("way") + 1).alias("way"))
        ways = ways.unionByName(here)
    ways = settle(ways)
    first = ways.groupBy("at").agg(F.min(F.struct("way", "node")).alias("_f"))
    return ways.join(first, "at").where((F.col("way") + F.col("_f.way") <= most) & (F.col("node") != F.col("_f.node"))).select(F.col("_f.node").alias("a"), F.col("node").alias("b")).distinct()


def branches_by_age(paths: DataFrame, root_age: float, older: float | None = None, younger: float | None = None, below: Sequence[int] = (), without: Sequence[int] = ()) -> DataFrame:
    """Branches and their age, on a tree of edges of one length scaled so that the root has `root_age`.

    Kept are ages above `older` and below `younger`, branches under one of `below`, and none in the clade of one of `without`.
    """
    deep = depths(paths)
    aged = deep.join(deep.agg(F.max("depth").alias("_max"))).select(F.col("node").alias("branch_id"), F.round(root_age * (1 - F.col("depth") / F.col("_max")), 9).alias("age"))
    if older is not None:
        aged = aged.where(F.col("age") > older)
    if younger is not None:
        aged = aged.where(F.col("age") < younger)
    for listed, how in ((below, "left_semi"), (without, "left_anti")):
        if listed:
            aged = aged.join(paths.where(F.col("ancestor").isin(*listed)).select(F.col("node").alias("branch_id")), "branch_id", how)
    return aged


def event_catalogue(nodes: DataFrame, rows_a_task: int = 1000) -> DataFrame:
    """event_id, event_type, don_branch_id, rec_branch_id: D, L, S and O on each branch, T between two branches, O and T from outside (null).

    Branches are numbered by id, and ids of events follow from those numbers, so that the large table of transfers needs no sort
    and no shuffle: recipients are dealt by `rows_a_task` and each task meets all donors.
    """
    from genomill.operators.sequences import number_rows

    ids = settle(nodes.select(F.col("branch_id").alias("_b")))
    n = ids.agg(F.count("*").alias("_n"))
    rank = settle(number_rows(ids, ["_b"], "_no").select("_b", (F.col("_no") - 1).cast("long").alias("_r")).join(n))
    base = rank.repartition(rank.count() // rows_a_task + 1, "_b")
    one = base.select(F.posexplode(F.array(*map(F.lit, "DLSO"))).alias("_t", "event_type"), "_b", "_r", "_n").select((F.col("_t") * F.col("_n") + F.col("_r") + 1).alias("event_id"), "event_type", F.lit(None).cast("int").alias("don_branch_id"), F.col("_b").alias("rec_branch_id"))
    outside = n.select((4 * F.col("_n") + 1).alias("event_id"), F.lit("O").alias("event_type"), F.lit(None).cast("int").alias("don_branch_id"), F.lit(None).cast("int").alias("rec_branch_id"))
    donors = rank.select(F.col("_b").alias("don_branch_id"), F.col("_r").alias("_d")).unionByName(n.select(F.lit(None).cast("int").alias("don_branch_id"), F.col("_n").alias("_d")))
    moved = base.join(F.broadcast(donors)).where("_d <> _r").select((4 * F.col("_n") + 2 + F.col("_d") * F.col("_n") + F.col("_r")).alias("event_id"), F.lit("T").alias("event_type"), "don_branch_id", F.col("_b").alias("rec_branch_id"))
    return one.unionByName(outside).unionByName(moved)


def event_lineages(nodes: DataFrame, paths: DataFrame, events: DataFrame) -> DataFrame:
    """The events on the way from each tip to the root: tip, event_id. `events` (node, event_id)."""
    return paths.join(_tips(nodes), "node").select(F.col("node").alias("tip"), F.col("ancestor").alias("node")).join(events, "node").select("tip", "event_id").distinct()


def strict_groups(nodes: DataFrame, paths: DataFrame, gains: DataFrame) -> DataFrame:
    """Groups that a gain splits off: tip, gain_node, child (null: the backbone group).

    A transfer (T) makes one group of the tips under it that no later gain takes; a duplication (D) one for each of its children;
    a duplication on a tip is ignored. `gains` (node, event_type) holds the most recent gain of a node.
    """
    up = paths.join(_tips(nodes).select("node"), "node").join(gains.select(F.col("node").alias("ancestor"), "event_type"), "ancestor").where("NOT (event_type = 'D' AND distance = 0)")
    last = up.groupBy("node").agg(F.min_by(F.struct("ancestor", "event_type", "distance"), "distance").alias("_g"))
    child = paths.select("node", F.col("ancestor").alias("child"), (F.col("distance") + 1).alias("_d"))
    named = last.select("node", F.col("_g.ancestor").alias("gain_node"), F.col("_g.distance").alias("_d"), (F.col("_g.event_type") == "D").alias("_split")).join(child, ["node", "_d"], "left")
    return _tips(nodes).select("node").join(named, "node", "left").select(F.col("node").alias("tip"), "gain_node", F.when(F.col("_split"), F.col("child")).alias("child"))


def unicopy_groups(paths: DataFrame, species: DataFrame) -> DataFrame:
    """Per tip the topmost clade in which each species occurs once: tip, og_node. `species` (node, species) of the tips."""
    inside = paths.join(species, "node")
    single = inside.groupBy("ancestor").agg(F.count("*").alias("_n"), F.countDistinct("species").alias("_s")).where("_n = _s")
    return inside.join(single.select("ancestor"), "ancestor", "left_semi").groupBy(F.col("node").alias("tip")).agg(F.max_by("ancestor", "distance").alias("og_node"))


def select_clades(values: DataFrame, paths: DataFrame, stem: Sequence[tuple[str, str, float]], within: Sequence[tuple[str, str, str, float]], depth: int) -> DataFrame:
    """Nodes that meet each `stem` condition (column, comparison, threshold) and each `within` condition
    (summary, column, comparison, threshold) over the nodes at most `depth` edges below them. `values` (node, columns)."""
    keep: Column = F.lit(True)
    for column, sign, threshold in stem:
        keep &= COMPARISONS[sign](F.col(column), threshold)
    nodes = values.where(keep).select(F.col("node").alias("ancestor"))
    below = paths.where((F.col("distance") > 0) & (F.col("distance") <= depth)).join(nodes, "ancestor").join(values, "node")
    summed = below.groupBy("ancestor").agg(*[SUMMARIES[s](c).alias(f"_{i}") for i, (s, c, _, _) in enumerate(within)])
    keep = F.lit(True)
    for i, (_, _, sign, threshold) in enumerate(within):
        keep &= COMPARISONS[sign](F.col(f"_{i}"), threshold)
    return summed.where(keep).select(F.col("ancestor").alias("node"))


def clade_definition_members(nodes: DataFrame, paths: DataFrame, definitions: DataFrame) -> DataFrame:
    """Clade, side (clade, sister, background), member (name) of clade definitions; the background is without the clade's own leaves."""
    leaves = paths.join(_tips(nodes), "node").select(F.col("ancestor").alias("_top"), F.col("branch_name").alias("member"))
    listed = lambda column, side: definitions.select("clade", F.col(column).alias("_top")).join(leaves, "_top").select("clade", F.lit(side).alias("side"), "member")
    own = definitions.select(F.col("clade").alias("_top"), "clade").join(leaves, "_top").select("clade", "member")
    return own.select("clade", F.lit("clade").alias("side"), "member").unionByName(listed("sister", "sister")).unionByName(listed("background", "background").join(own, ["clade", "member"], "left_anti"))


def branch_ages(nodes: DataFrame, paths: DataFrame, root_age: float) -> DataFrame:
    """branch_id, age of each node by summed branch lengths (`nodes.length`; null: 0), scaled so that the root has `root_age` and the farthest leaf 0."""
    lengths = nodes.select(F.col("branch_id").alias("ancestor"), F.coalesce("length", F.lit(0.0)).alias("_l"))
    far = paths.join(lengths, "ancestor").join(nodes.where("parent_branch_id IS NULL").select(F.col("branch_id").alias("_root")), F.col("ancestor") == F.col("_root"), "left_anti").groupBy("node").agg(F.sum("_l").alias("_d"))
    deep = nodes.select(F.col("branch_id").alias("node")).join(far, "node", "left").select("node", F.coalesce("_d", F.lit(0.0)).alias("_d"))
    return deep.join(deep.agg(F.max("_d").alias("_m"))).select(F.col("node").alias("branch_id"), F.round(F.when(F.col("_m") > 0, root_age * (1 - F.col("_d") / F.col("_m"))).otherwise(root_age), 9).alias("age"))


def drop_tagged(nodes: DataFrame, paths: DataFrame, collapsed: str = "_CC-clade", replaced: str = "_RC-clade") -> DataFrame:
    """Nodes without those under a branch named with the tag `collapsed`, and of the leaves named with `replaced` and one same ending only the first by name."""
    tag = F.regexp_extract("branch_name", f"({replaced}.*)$", 1)
    gone = paths.join(nodes.where(F.col("branch_name").contains(collapsed)).select(F.col("branch_id").alias("ancestor")), "ancestor", "left_semi").select(F.col("node").alias("branch_id"))
    tagged = nodes.where(F.col("is_tip") & (tag != "")).withColumn("_t", tag)
    first = tagged.groupBy("_t").agg(F.min(F.struct("branch_name", "branch_id")).alias("_f")).select("_f.branch_id")
    extra = tagged.select("branch_id").join(first, "branch_id", "left_anti")
    return nodes.join(gone.union(extra).distinct(), "branch_id", "left_anti")

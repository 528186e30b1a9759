"""Event lineages: which pairs of gene lineages share events, and how strongly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genomill.operators.trees import settle


def filter_events(events: DataFrame, n: int, fmin: float = 0.0, fmax: float | None = None, types: Sequence[str] = ()) -> DataFrame:
    """Rows whose frequency is at least int(fmin * n) and below int(fmax * n), and whose type is in `types` (none: any type)."""
    keep: Column = F.col("freq") >= int(fmin * n)
    if fmax is not None:
        keep &= F.col("freq") < int(fmax * n)
    if types:
        keep &= F.col("event_type").isin(*types)
    return events.where(keep)


def _side(events: DataFrame, families: DataFrame | None) -> DataFrame:
    """event_id, rlocds_id, freq and, if families are given, gene_family_id of each event of a lineage, written once."""
    if families is not None:
        events = events.join(families.select("rlocds_id", "gene_family_id"), "rlocds_id")
    return settle(events.select("event_id", "rlocds_id", "freq", *(["gene_family_id"] if families is not None else [])))


#: Meetings that a task sums: pairs of lineages are dealt over as many tasks as keep each of them small.
MEETINGS_A_TASK = 1_000_000
#: Rows that a task puts in order or lists: the number of tasks follows the table, so that what one holds does not grow with it.
ROWS_A_TASK = 250_000


def _dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """`df` of about so many rows dealt by `keys`."""
    return df.repartition(int(rows // ROWS_A_TASK) + 1, *keys)


def _met_by(a: DataFrame, b: DataFrame, rows: int, *keys: str) -> DataFrame:
    """`a` joined with `b` by `keys`, both dealt over as many tasks as so many rows need."""
    n = int(rows // ROWS_A_TASK) + 1
    return a.repartition(n, *keys).join(b.repartition(n, *keys), list(keys))


def _packing(side: DataFrame) -> tuple[int, str] | None:
    """(base, type) if a partner's distance from a lineage and its frequency fit into one number, distance * base + frequency; else None."""
    kinds = dict(side.dtypes)
    if not {kinds["rlocds_id"], kinds["freq"]} <= {"tinyint", "smallint", "int", "bigint"}:
        return None
    first, last, least, most, known = side.agg(F.min("rlocds_id"), F.max("rlocds_id"), F.min("freq"), F.max("freq"), F.count("freq") == F.count("*")).first()
    if first is None or least is None or least < 0 or not known:
        return None
    largest = (last - first + 1) * (most + 1)
    return (most + 1, "int" if largest < 2**31 else "bigint") if largest < 2**62 else None


def _met(side: DataFrame, sizes: DataFrame, scope: str, block: int) -> DataFrame:
    """rlocds_id_1 <= rlocds_id_2, event_id, freq_1, freq_2: lineages that meet in an event, dealt by rlocds_id_1.

    The lineages of an event are listed, those of one with more than `block` of them in lists of about that many by a hash, which
    meet pairwise in many tasks. A lineage goes to its task once for each list, with its partners there as an array, and only
    there becomes a row for each: a sum over pairs of lineages needs no other shuffle. In the array a partner is one number, which
    holds its distance from the lineage and its frequency, wherever both are integers (`_packing`). `sizes` (event_id, _n; settled).
    """
    if scope not in ("between_fams", "within_fams", "all"):
        raise ValueError(f"no scope {scope}")
    member = F.struct(*[c for c in side.columns if c != "event_id"])
    rows, most = sizes.agg(F.sum("_n"), F.sum(F.col("_n") * (F.col("_n") + 1) / 2)).first()
    rows, most = rows or 0, most or 0
    hot = sizes.where(F.col("_n") > block).select("event_id", F.ceil(F.col("_n") / block).cast("int").alias("_k"))
    if hot.isEmpty():
        lists = _dealt(side, rows, "event_id").groupBy("event_id").agg(F.collect_list(member).alias("_own")).withColumn("_other", F.col("_own"))
    else:
        cold = _dealt(side.join(hot, "event_id", "left_anti"), rows, "event_id").groupBy("event_id").agg(F.collect_list(member).alias("_own")).withColumn("_other", F.col("_own"))
        dealt = settle(side.join(hot, "event_id").groupBy("event_id", F.expr("pmod(xxhash64(rlocds_id), _k)").alias("_b")).agg(F.collect_list(member).alias("_own")))
        pairs = dealt.join(dealt.select("event_id", F.col("_b").alias("_c"), F.col("_own").alias("_other")), "event_id").repartition("event_id", "_b", "_c")
        lists = cold.unionByName(pairs.select("event_id", "_own", "_other"))

    def partner(x: Column) -> Column:
        later = x["rlocds_id"] >= F.col("_a.rlocds_id")
        if scope == "all":
            return later
        alike = x["gene_family_id"] == F.col("_a.gene_family_id")
        return later & (alike if scope == "within_fams" else ~alike)

    met = lists.select("event_id", F.explode("_own").alias("_a"), "_other").select("event_id", F.col("_a.rlocds_id").alias("rlocds_id_1"), F.col("_a.freq").alias("freq_1"), F.filter("_other", partner).alias("_p")).where(F.size("_p") > 0)
    packing = _packing(side)
    tasks = int(most // MEETINGS_A_TASK) + 1
    if packing is None:
        met = met.select("event_id", "rlocds_id_1", "freq_1", F.col("_p.rlocds_id").alias("rlocds_id_2"), F.col("_p.freq").alias("freq_2"))
        met = met.repartition(tasks, "rlocds_id_1").withColumn("_p", F.explode(F.arrays_zip("rlocds_id_2", "freq_2")))
        return met.select("rlocds_id_1", F.col("_p.rlocds_id_2").alias("rlocds_id_2"), "event_id", "freq_1", F.col("_p.freq_2").alias("freq_2"))
    base, kind = F.lit(packing[0]).cast("bigint"), packing[1]
    met = met.withColumn("_p", F.transform("_p", lambda x: ((x["rlocds_id"].cast("bigint") - F.col("rlocds_id_1")) * base + x["freq"]).cast(kind)))
    met = met.repartition(tasks, "rlocds_id_1").withColumn("_p", F.explode("_p")).withColumn("_p", F.col("_p").cast("bigint"))
    id_type, freq_type = (side.schema[c].dataType for c in ("rlocds_id", "freq"))
    return met.select("rlocds_id_1", (F.col("rlocds_id_1") + F.call_function("div", F.col("_p"), base)).cast(id_type).alias("rlocds_id_2"), "event_id", "freq_1", (F.col("_p") % base).cast(freq_type).alias("freq_2"))


def lineage_matches(events: DataFrame, families: DataFrame | None = None, scope: str = "between_fams", block: int = 2000) -> DataFrame:
    """Pairs of lineages (rlocds_id_1 <= rlocds_id_2) with each event they share: event_id, freq_1, freq_2.

    `scope`: `between_fams` (families differ), `within_fams` (families agree) or `all`; the last two hold self-pairs.
    """
    side = _side(events, families)
    return _met(side, settle(side.groupBy("event_id").agg(F.count("*").alias("_n"))), scope, block)


def _marked(side: DataFrame, budget: float) -> tuple[DataFrame, DataFrame]:
    """`side` with _heavy, whether an event belongs to its lineage's prefix, and _bound, the most that it can add to a score of the lineage; and the sizes of events.

    The bound is the lineage's frequency times the event's largest. Events are ordered by bound for each partner they would
    give, so that hot events of little weight come first; those whose bounds add up to less than `budget` are left out of the prefix.
    """
    most = settle(side.groupBy("event_id").agg(F.max("freq").alias("_most"), F.count("*").alias("_n")))
    known = side.join(most, "event_id").withColumn("_bound", F.col("freq").cast("long") * F.col("_most").cast("long"))
    known = _dealt(known, most.agg(F.sum("_n")).first()[0] or 0, "rlocds_id")
    order = Window.partitionBy("rlocds_id").orderBy(F.col("_bound") / F.col("_n"), "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return settle(known.select(*side.columns, "_bound", (F.sum("_bound").over(order) >= budget).alias("_heavy"))), most


def prefix_scores(marked: DataFrame, sizes: DataFrame, scope: str, block: int) -> DataFrame:
    """rlocds_id_1, rlocds_id_2, _joint: summed products over the events that lie in both lineages' prefixes."""
    met = _met(marked.where("_heavy").drop("_heavy", "_bound"), sizes, scope, block)
    return met.groupBy("rlocds_id_1", "rlocds_id_2").agg(F.sum(F.col("freq_1").cast("long") * F.col("freq_2").cast("long")).alias("_joint"))


def coevolution_scores(events: DataFrame, n: int, families: DataFrame | None = None, scope: str = "between_fams", min_joint: float = 1.0, block: int = 2000, share: float = 0.25) -> DataFrame:
    """rlocds_id_1, rlocds_id_2, score = sum(freq_1 * freq_2) / n², of pairs that reach `min_joint`.

    Each lineage's events of least possible weight, up to `share` of the score to reach, are left out of its prefix. Two lineages
    lose less than that on either side, so that what they share in both prefixes must come to the score but those two bounds: only
    such pairs are candidates, and only for them the events left out are looked up. `share` (0 to 0.5) changes the work, not the
    result. Products are summed as integers and divided once, so that the score doesn't depend on the order of rows.
    """
    least = min_joint * n * n
    marked, sizes = _marked(_side(events, families), share * least)
    near = prefix_scores(marked, sizes, scope, block).where(F.col("_joint") >= (1 - 2 * share) * least)
    rows = marked.select("event_id", F.col("rlocds_id").alias("_l"), F.col("freq").cast("long").alias("_f"), "_bound", "_heavy")
    rest = rows.where("NOT _heavy").groupBy("_l").agg(F.sum("_bound").alias("_rest"))
    for i in (1, 2):
        near = near.join(rest.select(F.col("_l").alias(f"rlocds_id_{i}"), F.col("_rest").alias(f"_rest_{i}")), f"rlocds_id_{i}", "left")
    pair = ["rlocds_id_1", "rlocds_id_2"]
    near = settle(near.where(F.col("_joint") + F.coalesce("_rest_1", F.lit(0)) + F.coalesce("_rest_2", F.lit(0)) >= least).select(*pair, "_joint"))
    held, left = sizes.agg(F.sum("_n")).first()[0] or 0, rows.where("NOT _heavy").groupBy("_l").agg(F.count("*").alias("_n"))
    looked_up = [near.join(left.withColumnRenamed("_l", own), own).agg(F.sum("_n")).first()[0] or 0 for own in pair]
    left_out = []
    for own, other, partner, more in (("rlocds_id_1", "rlocds_id_2", "true", looked_up[0]), ("rlocds_id_2", "rlocds_id_1", "_heavy", looked_up[1])):
        light = near.select(*pair).join(rows.where("NOT _heavy").select(F.col("_l").alias(own), "event_id", F.col("_f").alias("_own")), own)
        theirs = rows.where(partner).select(F.col("_l").alias(other), "event_id", F.col("_f").alias("_other"))
        met = _met_by(light, theirs, held + more, other, "event_id")
        left_out.append(met.select(*pair, (F.col("_own") * F.col("_other")).alias("_joint")))
    joint = near.unionByName(left_out[0]).unionByName(left_out[1]).groupBy(*pair).agg(F.sum("_joint").alias("_joint"))
    return joint.where(F.col("_joint") >= least).select(*pair, (F.col("_joint") / F.lit(float(n * n))).alias("score"))

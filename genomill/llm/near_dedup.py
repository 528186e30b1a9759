"""MinHash near-duplicate detection: universal hash minima, banding, signature check, exact confirmation, star components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genomill.llm.common import NOT_BLANK, Words, cut, discard, grouped, mix64, picked, prepare, slices, table, veiled
from genomill.llm.graph import components

#: Multipliers and summands of the universal hashes (multiply-shift over 64 bits), from a fixed seed.
SEED = 20240611
#: Rows, and shingles, of a block of a band; columns of a block's shingle matrix at a time.
BLOCK, BLOCK_SHINGLES, COLUMNS = 1024, 2_000_000, 2048


def _family(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its distinct k-word shingles; fewer words: one for the whole sequence."""
    words = Words(column, NOT_BLANK)
    grams = words.grams(k)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(grams[a : b - k + 1])
        elif b > a:
            x = words.hash[a:b]
            yield mix64(np.array([(x * np.array([pow(3, i + 1) for i in range(b - a)], np.uint64)).sum(dtype=np.uint64) ^ np.uint64(b - a)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def _digest(s: np.ndarray) -> bytes:
    """Two checksums of a set of shingles: equal sets, equal digests."""
    return np.array([s.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix64(s ^ np.uint64(len(s))))], np.uint64).tobytes()


def signatures(docs: DataFrame, k: int, hashes: int) -> DataFrame:
    """doc_id, row_key, n_shingles, digest (of the set; null when empty), sig (a byte of each minimum; null when empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _family(hashes)
        for batch in slices(batches, "text"):
            n, digest, sig = [], [], []
            for s in shingle_sets(batch.column("text"), k):
                n.append(len(s))
                if not len(s):
                    digest.append(None)
                    sig.append(None)
                    continue
                digest.append(_digest(s))
                least = np.full(hashes, np.iinfo(np.uint64).max, np.uint64)
                for at in range(0, len(s), 512):
                    np.minimum(least, (s[at : at + 512, None] * a + b).min(axis=0), out=least)
                sig.append((mix64(least) >> np.uint64(56)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_key"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())], names=["doc_id", "row_key", "n_shingles", "digest", "sig"])

    return docs.select("doc_id", "row_key", "text").mapInArrow(run, "doc_id long, row_key long, n_shingles long, digest binary, sig binary")


def _sets(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """node, n, sig, shingles (binary): the full sets of `nodes` (node, doc_id, digest, sig), from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [(i, s) for i, (d, s) in enumerate(zip(batch.column("digest").to_pylist(), shingle_sets(batch.column("text"), k), strict=True)) if _digest(s) == d]
            rows = pa.array([i for i, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("node").take(rows), pa.array([len(s) for _, s in found], pa.int64()), batch.column("sig").take(rows), pa.array([s.tobytes() for _, s in found], pa.binary())], names=["node", "n", "sig", "shingles"])

    wanted = cut(nodes.select("node", F.col("doc_id").alias("_d"), "digest", "sig"))
    texts = picked(docs.where("text IS NOT NULL").select("doc_id", "text"), wanted.select(F.col("_d").alias("doc_id")))
    both = texts.join(wanted.hint("merge"), F.col("doc_id") == F.col("_d"))
    return both.select("node", "digest", "sig", "text").mapInArrow(run, "node long, n long, sig binary, shingles binary")


def _linked(pairs: DataFrame, sets: DataFrame, least: float, percent: int) -> DataFrame:
    """Pairs (a, b) whose signatures agree in the share `least` and whose full sets hold 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for sa, sb, x, y in zip(*(batch.column(c).to_pylist() for c in ("sig_a", "sig_b", "set_a", "set_b")), strict=True):
                if (np.frombuffer(sa, np.uint8) == np.frombuffer(sb, np.uint8)).mean() < least:
                    keep.append(False)
                    continue
                small, large = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
                at = np.searchsorted(large, small)
                inter = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                keep.append(100 * inter >= percent * (len(small) + len(large) - inter))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # sets of too unlike sizes can't be that similar: so a centre's set is sent no more often than sets of like size ask for it
    sizes = sets.select("node", "n")
    fit = pairs.join(sizes.withColumnsRenamed({"node": "b", "n": "n_b"}), "b").join(sizes.withColumnsRenamed({"node": "a", "n": "n_a"}), "a").where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent).select("a", "b")
    # always by a shuffle: what moves then follows the number of pairs at every size
    both = fit.join(sets.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"), F.col("shingles").alias("set_b")).hint("merge"), "b").join(sets.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"), F.col("shingles").alias("set_a")).hint("merge"), "a")
    return both.select("a", "b", "sig_a", "sig_b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of `left` shares with each of `right`: products of 0/1 matrices, COLUMNS shingles at a time."""
    x, y = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(x, y)
    rows = [np.repeat(np.arange(len(s)), [len(e) for e in s]) for s in (left, right)]
    places = []
    for flat, row in ((x, rows[0]), (y, rows[1])):
        at = np.searchsorted(shared, flat)
        hit = np.flatnonzero(shared[np.minimum(at, len(shared) - 1)] == flat) if len(shared) else np.zeros(0, np.int64)
        order = hit[np.argsort(at[hit], kind="stable")]
        places.append((at[order], row[order]))
    out = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, len(shared), COLUMNS):
        parts = []
        for (at, row), n in zip(places, out.shape, strict=True):
            a, b = np.searchsorted(at, [lo, lo + COLUMNS])
            m = np.zeros((n, min(COLUMNS, len(shared) - lo)), np.float32)
            m[row[a:b], at[a:b] - lo] = 1
            parts.append(m)
        out += parts[0] @ parts[1].T
    return out


def _forest(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> list[int]:
    """Places of links (a, b: row numbers) that join rows whose labels were not joined yet."""
    root = {x: x for x in set(label.tolist())}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, (x, y) in enumerate(zip(label[a].tolist(), label[b].tolist(), strict=True)):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append(i)
    return out


def _candidates(part: pa.Table | pa.RecordBatch, rows_a_band: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes and labels of a pair of blocks (band, i, j, _m, number, node, label, sig), and the row numbers of its candidates: other labels, agreeing signatures, no earlier band in common."""
    i, j, number = (part.column(c)[0].as_py() for c in ("i", "j", "number"))
    block, ids, label = (np.array(part.column(c)) for c in ("_m", "node", "label"))
    none = np.zeros(0, np.int64)
    if (label == label[0]).all():
        return ids, label, none, none
    sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint8).reshape(len(ids), -1)
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    pairs_a, pairs_b = [none], [none]
    for x in left.tolist():
        other = right[(label[right] != label[x]) & ((ids[right] > ids[x]) if i == j else True)]
        if not len(other):
            continue
        same = sig[other] == sig[x]
        keep = same.mean(axis=1) >= least
        if number and keep.any():
            keep[keep] = ~same[keep][:, : number * rows_a_band].reshape(int(keep.sum()), number, rows_a_band).all(axis=2).any(axis=1)
        if keep.any():
            pairs_a.append(np.full(int(keep.sum()), x))
            pairs_b.append(other[keep])
    return ids, label, np.concatenate(pairs_a), np.concatenate(pairs_b)


def _asked(rows: DataFrame, rows_a_band: int, least: float) -> DataFrame:
    """(band, i, j, _m, number, node, label): the `rows` (band, number, size, weight, node, label, sig) that are in a candidate pair of blocks i and j of their band.

    A band's rows are dealt into blocks by rows and by shingles, and pairs of blocks are compared each in a task of its own.
    """
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("weight") / BLOCK_SHINGLES)).cast("int")
    mine = F.pmod(F.xxhash64("node", F.lit(7)), blocks).cast("int")
    dealt = rows.withColumn("_m", mine).withColumn("_o", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("band", F.least("_m", "_o").alias("i"), F.greatest("_m", "_o").alias("j"), "_m", "number", "node", "label", "sig")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in grouped(batches, ["band", "i", "j"]):
            _, _, a, b = _candidates(part, rows_a_band, least)
            if len(a):
                yield from part.select(["band", "i", "j", "_m", "number", "node", "label"]).take(pa.array(np.union1d(a, b))).to_batches()

    return dealt.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j").mapInArrow(run, "band long, i int, j int, _m int, number int, node long, label long")


def _crossing(rows: DataFrame, rows_a_band: int, least: float, percent: int, sets: DataFrame | None = None) -> DataFrame:
    """Links (a, b) between `rows` (band, number, size, weight, node, label) of one band and different labels. `sets` (node, sig, shingles; none: `rows` hold them).

    Signatures are compared first, block by block; full sets go only to the blocks in which their nodes have a candidate, since
    nodes that are much alike meet in many bands and are candidates in the first of them. There the candidates are found again
    and confirmed: no task holds more than two blocks, and of the links only a spanning forest leaves it, so that what comes out
    grows with the documents, not with the pairs.
    """
    if sets is None:
        rows, sets = rows.drop("sig", "shingles"), rows.select("node", "sig", "shingles").dropDuplicates(["node"])
    asked = cut(_asked(rows.join(sets.select("node", "sig").hint("merge"), "node"), rows_a_band, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in grouped(batches, ["band", "i", "j"]):
            ids, label, a, b = _candidates(part, rows_a_band, least)
            if not len(a):
                continue
            ra, at_a = np.unique(a, return_inverse=True)
            rb, at_b = np.unique(b, return_inverse=True)
            held = part.column("shingles")
            left_sets, right_sets = ([np.frombuffer(held[r].as_py(), np.uint64) for r in x.tolist()] for x in (ra, rb))
            inter = _intersections(left_sets, right_sets)[at_a, at_b].astype(np.int64)
            union = np.array([len(s) for s in left_sets])[at_a] + np.array([len(s) for s in right_sets])[at_b] - inter
            good = np.flatnonzero(100 * inter >= percent * union)
            a, b = a[good], b[good]
            if tree := _forest(a, b, label):
                yield pa.RecordBatch.from_arrays([pa.array(ids[a[tree]]), pa.array(ids[b[tree]])], names=["a", "b"])

    full = asked.join(sets.select("node", "sig", "shingles").hint("merge"), "node")
    return full.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j").mapInArrow(run, "a long, b long")


def _classified(docs: DataFrame, k: int, percent: int, bands: int, rows: int, slack: float) -> DataFrame:
    """doc_id, row_key, n_shingles, component (a number; null without words), component_id of every row of `docs` (doc_id, text, row_key)."""
    sigs = cut(signatures(docs, k, bands * rows))
    full = sigs.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    # texts with equal sets are one node, numbered once and for all
    classes = cut(full.groupBy("digest").agg(F.min("doc_id").alias("rep")).withColumn("node", F.monotonically_increasing_id()))
    own = classes.select(F.col("digest").alias("_g"), F.col("rep").alias("_d"), "node")
    nodes = cut(full.join(own.hint("merge"), (F.col("digest") == F.col("_g")) & (F.col("doc_id") == F.col("_d"))).select("node", "doc_id", "digest", "n_shingles", "sig"))
    banded = nodes.select("node", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.expr("sig").substr(i * rows + 1, F.lit(rows))))).alias("number", "band"))
    sizes = cut(banded.groupBy("band").agg(F.count("*").alias("size")).where("size > 1"))
    members = cut(banded.join(sizes, "band").select("band", "number", "node", "size"))
    discard(sizes)
    sets = cut(_sets(docs, nodes.join(members.select("node").distinct().hint("merge"), "node", "left_semi"), k))

    # first each node against one centre: of the centres of its bands the one in most company, and likewise a band's centre of its members
    company = members.groupBy("node").agg(F.sum("size").alias("company"))
    centres = members.join(company.hint("merge"), "node").groupBy("band").agg(F.max_by("node", F.col("company")).alias("centre"), F.max("company").alias("company"))
    tried = members.select("band", "node").join(centres, "band").groupBy("node").agg(F.max_by("centre", F.col("company")).alias("centre")).where("centre <> node")
    near = cut(_linked(tried.select(F.col("centre").alias("a"), F.col("node").alias("b")), sets, percent / 100 - slack, percent))
    # then, in bands whose nodes are not all linked to one centre, those under different centres with each other
    label = near.select(F.col("b").alias("node"), F.col("a").alias("label"))
    named = members.join(label.hint("merge"), "node", "left").select("band", "number", "node", F.coalesce("label", "node").alias("label")).join(sets.select("node", "n").hint("merge"), "node")
    mixed = named.groupBy("band").agg(F.count("*").alias("size"), F.sum("n").alias("weight"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    still = named.join(mixed.select("band", "size", "weight"), "band")
    links = cut(_crossing(still.select("band", "number", "size", "weight", "node", "label"), rows, percent / 100 - slack, percent, sets))
    found = components(near.union(links), "a", "b")

    named = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = cut(named.groupBy("component").agg(F.min("rep").alias("component_id")))  # written, so that a large component can be split
    answer = cut(named.join(least, "component").select("digest", "component", "component_id"))
    for x in (members, sets):
        discard(x)
    return sigs.join(answer, "digest", "left").withColumn("component", F.when(F.col("doc_id").isNotNull(), F.col("component"))).select("doc_id", "row_key", "n_shingles", "component", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def _keyed(docs: DataFrame) -> DataFrame:
    """What takes part of `docs`: doc_id, text, row_key (tells apart the texts of a repeated doc_id)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("row_key", F.xxhash64("text"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 75, bands: int = 48, rows: int = 6, slack: float = 0.1) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reached over links), kept (doc_id = component_id).

    A link is 100 * |A ∩ B| >= percent * |A ∪ B| on the full sets of distinct k-word shingles (A-Z lower-cased; words end at
    blanks; a text of fewer words is one shingle). Candidates share a band of `rows` minima: at a similarity of 0.75 a pair
    misses all 48 bands with probability 8e-5, at 0.8 with 6e-7. Texts with equal sets become one class before any pairing.
    Signatures must agree in percent / 100 - slack of their minima (a pair at 0.75 fails that with probability 1e-4), then the
    full sets decide. Each class is first compared with one centre of its bands; then, in bands whose members are not all
    linked to one centre, members of different centres with each other, block by block: no candidate pair is left out unless
    a path already links it. Work in hot bands is dealt to many tasks, and only a spanning forest of the links is kept.

    Null or blank text: an empty set, linked with nothing. Null doc_id: returned, kept, component null. Rows that repeat a
    doc_id are each a document of that id. Other columns are ignored. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    out = _classified(_keyed(docs), k, percent, bands, rows, slack).select("doc_id", "n_shingles", "component_id")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def stage_minhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: a row with the group's smallest doc_id.

    Rows with a null doc_id, a null or a blank text stay. Where several rows of a group have its smallest doc_id, the one whose
    text hashes smallest stays, once. An empty table stays empty; other columns pass through, whatever their names.
    """
    prepare(spark)
    rows = cut(_classified(_keyed(docs), 5, 75, 48, 6, 0.1).where("component IS NOT NULL"))
    stays = rows.where("doc_id = component_id")
    # several rows with the smallest doc_id of a group: only where doc_ids repeat
    ties = stays.groupBy("component").agg(F.count("*").alias("n"), F.min("row_key").alias("least")).where("n > 1").select("component", "least")
    tied = cut(stays.join(ties, "component").select("doc_id", "row_key", "least"))
    lost = rows.where("doc_id <> component_id").select("doc_id", "row_key").union(tied.where("row_key <> least").select("doc_id", "row_key")).distinct().toDF("_lost_id", "_lost_key")
    own, _, (doc_id, text) = veiled(docs, "doc_id", "text")
    match = (doc_id.cast("long") == F.col("_lost_id")) & (F.xxhash64(text.cast("string")) == F.col("_lost_key"))
    own = own.join(lost, match, "left_anti")
    if not tied.isEmpty():
        again = tied.where("row_key = least").select("doc_id", "row_key").distinct().toDF("_lost_id", "_lost_key")
        one = own.join(again, match, "left_semi").withColumns({"_id": doc_id.cast("long"), "_key": F.xxhash64(text.cast("string"))}).dropDuplicates(["_id", "_key"]).drop("_id", "_key")
        own = own.join(again, match, "left_anti").unionByName(one)
    return own.toDF(*docs.columns)

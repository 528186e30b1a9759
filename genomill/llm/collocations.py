"""Phrases whose words occur together: Apriori levels over arrays of word ids, counted with double-array tries."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genomill.llm.common import _LOWER, cut, discard, lut_of, prepare, slices, table, utf8

#: Bytes between words, and bytes that end a piece of text.
BLANKS, ENDS = bytes([0x20, 0x09]), b".,;:!?" + bytes(range(0x0A, 0x0E))
_WORD, _END = lut_of(BLANKS + ENDS), ~lut_of(ENDS)
#: Words, or phrases in a trie, that are sent to the tasks at once (some 100 bytes each); more take several passes.
MOST = 1_000_000
#: Word positions that a task holds at a time, and rows of a batch that it gives.
POSITIONS, ROWS = 4_000_000, 200_000
#: Bits of a digit; a word's id is so many digits, each a step in the trie.
BITS = 10


@dataclass
class Tokens:
    """Words of a slice of texts: `words` as bytes, `row` of each, and whether a piece of text `begins` with it."""

    words: pa.Array
    row: np.ndarray
    begins: np.ndarray


def tokens(column: pa.Array) -> Tokens:
    """Words of each text, A-Z lower-cased: runs of bytes that are neither blanks nor ends of pieces."""
    raw, offsets = utf8(column)
    data = _LOWER[raw]
    inside = _WORD[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    starts[edges], ends[edges - 1] = inside[edges], inside[edges - 1]
    start, length = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    length -= start
    places = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length, out=places[1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(places), pa.py_buffer(data[inside])])
    row = np.searchsorted(offsets, start, "right") - 1
    piece = np.searchsorted(np.flatnonzero(_END[data]), start)
    begins = np.ones(len(start), bool)
    begins[1:] = (piece[1:] != piece[:-1]) | (row[1:] != row[:-1])
    return Tokens(words, row, begins)


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    for lang in pc.unique(batch.column("lang")).to_pylist():
        yield lang, batch.filter(pc.equal(batch.column("lang"), lang))


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, n of `docs` (lang, text). Tasks sum the words of several slices before they give them away."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def summed() -> pa.Table:
            t = pa.concat_tables(held).group_by(["lang", "word"]).aggregate([("n", "sum")])
            return pa.table({"lang": t["lang"], "word": t["word"], "n": t["n_sum"]})

        for batch in slices(batches, "text"):
            for lang, own in _by_lang(batch):
                found = tokens(own.column("text")).words.value_counts()
                words = found.field("values").cast(pa.large_string())
                held.append(pa.table({"lang": pa.array([lang] * len(words), pa.string()), "word": words, "n": found.field("counts")}))
            if sum(t.num_rows for t in held) > 2 * ROWS:
                held = [summed()]
                if held[0].num_rows > ROWS:
                    yield from held.pop().to_batches(ROWS)
        if held:
            yield from summed().to_batches(ROWS)

    return docs.select("lang", "text").mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _parts(df: DataFrame, n: int, *by: str) -> Iterator[DataFrame]:
    """`df` of n rows in as many parts of about MOST rows as it takes, dealt by a hash."""
    parts = max(1, -(-n // MOST))
    for i in range(parts):
        yield df.where(F.pmod(F.xxhash64(*by), F.lit(parts)) == i) if parts > 1 else df


def encoded(docs: DataFrame, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts as numbers of their words: (ids: int32 of each word, 0 between pieces, at the end and for words not listed), and id, lang, word, n of the listed ones.

    `words` (lang, word, n). Ids are given by falling n, so that frequent words share their high digits.
    """
    spark = docs.sparkSession
    rows, first, named = docs.select("lang", "text", F.lit(None).cast("binary").alias("ids")), 1, None
    n_words = words.count()
    parts = list(_parts(words, n_words, "lang", "word"))
    for i, part in enumerate(parts):
        own = part.select("lang", "word", "n").toArrow().combine_chunks().sort_by([("n", "descending"), ("lang", "ascending"), ("word", "ascending")])
        ids = pa.array(np.arange(first, first + own.num_rows, dtype=np.int32))
        own = own.append_column("id", ids)
        first += own.num_rows
        listed = cut(spark.createDataFrame(own.select(["id", "lang", "word", "n"])) if own.num_rows else spark.createDataFrame([], "id int, lang string, word string, n long"))
        named = listed if named is None else named.union(listed)
        by_lang = {lang: own.filter(pc.equal(own["lang"], lang)).combine_chunks() for lang in pc.unique(own["lang"]).to_pylist()}
        shared = spark.sparkContext.broadcast({lang: (t["word"].cast(pa.large_binary()).combine_chunks(), t["id"].to_numpy()) for lang, t in by_lang.items()})
        keep, begun = i < len(parts) - 1, i > 0

        def run(batches: Iterator[pa.RecordBatch], shared=shared, keep=keep, begun=begun) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                for lang, own in _by_lang(batch):
                    vocabulary, numbers = shared.value.get(lang, (pa.array([], pa.large_binary()), np.zeros(0, np.int32)))
                    found = tokens(own.column("text"))
                    coded = found.words.dictionary_encode()
                    at = pc.fill_null(pc.index_in(coded.dictionary, value_set=vocabulary), len(numbers)).to_numpy()
                    each = np.append(numbers, np.int32(0))[at][coded.indices.to_numpy()].astype(np.int32)
                    # a 0 before each piece but a row's first, and one at the end of a row
                    first_of = np.bincount(found.row[found.begins], minlength=own.num_rows)
                    size = np.maximum(np.bincount(found.row, minlength=own.num_rows) + first_of, 1)
                    places = np.concatenate([[0], np.cumsum(size)])
                    blank = np.concatenate([[0], np.cumsum(size == 1)])[:-1]  # rows without a word
                    out = np.zeros(places[-1], np.int32)
                    out[np.arange(len(each)) + np.cumsum(found.begins) - 1 + blank[found.row]] = each
                    if begun:
                        before = np.frombuffer(utf8(own.column("ids"))[0].tobytes(), np.int32)
                        out = np.where(before > 0, before, out)
                    ids = pa.array([out[a:b].tobytes() for a, b in zip(places, places[1:], strict=False)], pa.binary())
                    yield pa.RecordBatch.from_arrays([own.column("lang"), own.column("text"), ids], names=["lang", "text", "ids"]) if keep else pa.RecordBatch.from_arrays([ids], names=["ids"])

        before = rows
        rows = cut(rows.mapInArrow(run, "lang string, text string, ids binary" if keep else "ids binary"))
        discard(before)
        shared.destroy()
    return rows, named


class DoubleArray:
    """A double-array trie of phrases (a row of word ids each), with a digit of an id as a step; `phrase[state]` is a phrase's row, or -1."""

    def __init__(self, phrases: np.ndarray, largest: int):
        self.bits = BITS
        self.digits = max(1, -(-int(largest).bit_length() // BITS))
        n, self.k = phrases.shape
        at, parents, steps, first = np.zeros(n, np.int64), [], [], 1
        for j in range(self.k):
            for d in reversed(range(self.digits)):
                digit = (phrases[:, j].astype(np.int64) >> (BITS * d)) & ((1 << BITS) - 1)
                edge, inverse = np.unique((at << BITS) | digit, return_inverse=True)
                parents.append(edge >> BITS)
                steps.append(edge & ((1 << BITS) - 1))
                at = inverse + first
                first += len(edge)
        parent, step = np.concatenate(parents), np.concatenate(steps)  # by node 1, 2, ...; node 0 is the root
        base = self._bases(parent, step, first)
        slot = np.zeros(first, np.int64)
        slot[1:] = base[parent] + step
        self.base, self.check = np.zeros(self.size, np.int32), np.full(self.size, -1, np.int32)
        self.base[slot] = base
        self.check[slot[1:]] = slot[parent]
        self.phrase = np.full(self.size, -1, np.int32)
        self.phrase[slot[at]] = np.arange(n)

    def _bases(self, parent: np.ndarray, step: np.ndarray, nodes: int) -> np.ndarray:
        """Where the children of each node begin, so that no two share a slot. Large families first, each at a random free place or else at the end."""
        width, rng = 1 << BITS, np.random.default_rng(1)
        self.size = 4 * len(parent) + 4 * width
        used, base = np.zeros(self.size, bool), np.zeros(nodes, np.int64)
        owner, begin, many = np.unique(parent, return_index=True, return_counts=True)  # parents are in order, level after level
        pending = np.flatnonzero((many > 1) & (many <= 8))

        def alone(family: int) -> None:
            nonlocal used
            own = step[begin[family] : begin[family] + many[family]]
            tries = rng.integers(2 * width, self.size - width, 64)
            free = np.flatnonzero(~used[tries[:, None] + own].any(axis=1))
            if not len(free):
                used = np.concatenate([used, np.zeros(width, bool)])
                self.size += width
            place = int(tries[free[0]]) if len(free) else self.size - 2 * width
            if not len(free) and used[place + own].any():  # the end is in use too
                used = np.concatenate([used, np.zeros(width, bool)])
                self.size += width
                place = self.size - 2 * width
            base[owner[family]] = place
            used[place + own] = True

        large = np.flatnonzero(many > 8)
        for family in large[np.argsort(-many[large], kind="stable")].tolist():
            alone(family)
        for _ in range(64):
            if not len(pending):
                break
            slots = rng.integers(2 * width, self.size - width, len(pending))
            each = np.arange(8)[None, :] < many[pending][:, None]
            all_slots = slots[:, None] + step[np.minimum(begin[pending][:, None] + np.arange(8), len(step) - 1)]
            fits = ~(used[all_slots] & each).any(axis=1)
            claim = np.full(self.size, -1, np.int64)
            rows = np.flatnonzero(fits)
            who = np.broadcast_to(rows[:, None], (len(rows), 8))[each[rows]]
            claim[all_slots[rows][each[rows]]] = who
            won = rows[((claim[all_slots[rows]] == rows[:, None]) | ~each[rows]).all(axis=1)]
            used[all_slots[won][each[won]]] = True
            base[owner[pending[won]]] = slots[won]
            pending = np.delete(pending, won)
        for family in pending.tolist():
            alone(family)
        single = np.flatnonzero(many == 1)
        free = np.flatnonzero(~used[2 * width : self.size - width])[: len(single)] + 2 * width
        if len(free) < len(single):
            self.size += len(single) + width
            free = np.concatenate([free, np.arange(self.size - len(single) - width, self.size - width)])[: len(single)]
        base[owner[single]] = free - step[begin[single]]
        return base

    def rows_at(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in `ids` where a phrase begins, and its row. All places step together; those that find no way on fall out."""
        place = np.flatnonzero(ids[: len(ids) - self.k + 1] > 0)
        state = np.zeros(len(place), np.int32)
        for j in range(self.k):
            for d in reversed(range(self.digits)):
                after = self.base[state] + ((ids[place + j] >> (self.bits * d)) & ((1 << self.bits) - 1))
                ok = self.check[after] == state
                place, state = place[ok], after[ok]
        return place, self.phrase[state]


def _pass(ids: DataFrame, trie, k: int, first: int, whole: bool, last: bool) -> DataFrame:
    """no, next, n: how often each phrase of the trie occurs (next 0), and phrases of one word more that begin with one of it (next: the last word's id).

    A longer phrase counts only if its last word is listed and, where the trie holds all phrases of k words, its own last k words are one.
    `trie` None: phrases are the words themselves.
    """
    shared = ids.sparkSession.sparkContext.broadcast(trie)

    def work(flat: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        t = shared.value
        if t is None:
            place, row = np.flatnonzero(flat > 0), None
            row = flat[place] - 1
        else:
            place, row = t.rows_at(flat)
            counts += np.bincount(row, minlength=len(counts))
        if last:
            return
        after = flat[place + k]
        ok = after > 0
        if whole:
            ok[:-1] &= place[1:] == place[:-1] + 1
            ok[-1:] = False
        pairs, n = np.unique((row[ok].astype(np.int64) << 32) | after[ok], return_counts=True)
        for a in range(0, len(pairs), ROWS):
            some = pairs[a : a + ROWS]
            yield pa.RecordBatch.from_arrays([pa.array((some >> 32) + first), pa.array((some & 0xFFFFFFFF).astype(np.int32)), pa.array(n[a : a + ROWS])], names=["no", "next", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0 if shared.value is None else (shared.value.phrase >= 0).sum(), np.int64)
        held, size = [], 0
        for batch in batches:
            column = batch.column("ids")
            for some in ([column] if column.nbytes <= 4 * POSITIONS else [column.slice(i, 1) for i in range(len(column))]):
                flat = np.frombuffer(utf8(some)[0].tobytes(), np.int32)
                held.append(flat)
                size += len(flat)
                if size >= POSITIONS:
                    yield from work(np.concatenate(held), counts)
                    held, size = [], 0
        if size:
            yield from work(np.concatenate(held), counts)
        at = np.flatnonzero(counts)
        for a in range(0, len(at), ROWS):
            some = at[a : a + ROWS]
            yield pa.RecordBatch.from_arrays([pa.array(some + first), pa.array(np.zeros(len(some), np.int32)), pa.array(counts[some])], names=["no", "next", "n"])

    return ids.mapInArrow(run, "no long, next int, n long").groupBy("no", "next").agg(F.sum("n").alias("n"))


def phrase_counts(docs: DataFrame, least: int = 30, longest: int = 4) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Phrases of up to `longest` words that occur `least` times or more in a language: (ids, n), (id, lang, word, n) of their words, and (lang, n) of all words.

    Level by level: a phrase is a candidate only if it begins with a phrase that is frequent, and ends with one where all of
    them fit into one trie. Tasks sum candidates that occur in their texts, Spark sums those of all tasks, and those that can
    reach `least` go into a double-array trie; a pass over all texts counts its phrases and finds the next candidates.
    """
    spark = docs.sparkSession
    all_words = cut(word_counts(docs))
    totals = cut(all_words.groupBy("lang").agg(F.sum("n").alias("n")))
    ids, words = encoded(docs, all_words.where(F.col("n") >= least))
    discard(all_words)
    largest = words.agg(F.max("id")).first()[0] or 0
    found = words.select(F.array("id").alias("ids"), "n")
    if not largest:
        return found, words, totals
    pairs = cut(_pass(ids, None, 1, 1, True, False).where(F.col("n") >= least))
    level = cut(pairs.select(F.array(F.col("no").cast("int"), "next").alias("ids")))
    discard(pairs)
    for k in range(2, longest + 1):
        n = level.count()
        if not n:
            break
        first, after = 0, []
        parts = list(_parts(level, n, "ids"))
        for part in parts:
            phrases = part.toArrow()["ids"].combine_chunks()
            matrix = phrases.flatten().to_numpy().reshape(-1, k)
            order = np.lexsort(matrix.T[::-1])
            matrix = np.ascontiguousarray(matrix[order])
            listed = cut(spark.createDataFrame(pa.table({"no": np.arange(first, first + len(matrix)), "ids": pa.FixedSizeListArray.from_arrays(pa.array(matrix.ravel()), k).cast(pa.list_(pa.int32()))})))
            met = cut(_pass(ids, DoubleArray(matrix, largest), k, first, len(parts) == 1, k == longest).where(F.col("n") >= least))
            first += len(matrix)
            found = found.union(listed.join(met.where("next = 0"), "no").select("ids", "n"))
            after.append(listed.join(met.where("next > 0"), "no").select(F.concat("ids", F.array("next")).alias("ids")))
        if k < longest:
            longer = after[0]
            for more in after[1:]:
                longer = longer.union(more)
            before, level = level, cut(longer)
            discard(before)
    counted = cut(found)
    discard(ids)
    return counted, words, totals


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, top: int = 2000, percent: int = 80) -> DataFrame:
    """The `top` phrases of each language by cohesion: lang, rank, phrase, a, l, r, n, score.

    Phrases are 2 to `longest` words in a row within a piece of text; a counts their occurrences, overlaps included, and must reach
    `least`. Each cut of a phrase in two scores floor(2000000 * a / (l + r)) by the counts of its sides; the lowest score holds,
    then the earliest cut. A phrase goes if a longer one that holds its words in a row occurs at least `percent` % as often.
    n counts all words of the language. Order: score and a falling, then the phrase's bytes.

    `docs` (lang, text): a null lang is `und`, a null text empty; repeated rows all count; other columns are ignored. No words: no rows.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counted, words, totals = phrase_counts(rows, least, longest)
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    long = counted.where("size(ids) > 1").select("ids", F.col("n").alias("a"))
    cuts = long.withColumn("k", F.explode(F.expr("sequence(1, size(ids) - 1)")))
    cuts = cuts.withColumns({"_left": F.expr("slice(ids, 1, k)"), "_right": F.expr("slice(ids, k + 1, size(ids) - k)")})
    sides = [counted.select(F.col("ids").alias(key), F.col("n").alias(name)) for key, name in (("_left", "l"), ("_right", "r"))]
    scored = cuts.join(sides[0], "_left").join(sides[1], "_right")
    scored = scored.withColumn("score", F.expr("(CAST(2000000 AS decimal(7,0)) * CAST(a AS decimal(20,0))) div (CAST(l AS decimal(20,0)) + CAST(r AS decimal(20,0)))"))
    best = scored.groupBy("ids", "a").agg(F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("_b"))
    inside = counted.where("size(ids) > 2").select(F.col("n").alias("_longer"), F.explode(F.expr("flatten(transform(sequence(2, size(ids) - 1), w -> transform(sequence(1, size(ids) - w + 1), i -> slice(ids, i, w))))")).alias("ids"))
    held = inside.groupBy("ids").agg(F.max("_longer").alias("_longer"))
    kept = best.join(held, "ids", "left").where(F.coalesce(exact("_longer") * 100 < exact("a") * percent, F.lit(True)))
    kept = cut(kept.select("ids", "a", "_b.*"))
    spelt = kept.select("ids", F.posexplode("ids").alias("_i", "id")).join(words.select("id", "lang", "word"), "id")
    spelt = spelt.groupBy("ids").agg(F.min("lang").alias("lang"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_i", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    named = cut(kept.join(spelt, "ids").select("lang", "phrase", "a", "l", "r", "score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    near = named.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(16))).withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("_r") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""WITH d AS (SELECT doc_id, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t, row_number() OVER () AS d FROM documents),
p AS (SELECT lang, list_filter(string_split_regex(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')), '[\x20\x09]'), lambda x: x <> '') AS w FROM d),
g AS (SELECT lang, k, unnest(list_transform(generate_series(1, len(w) - k + 1), lambda i: w[i:i + k - 1])) AS w FROM p, generate_series(1, 4) s(k) WHERE len(w) >= k),
e AS MATERIALIZED (SELECT lang, w, any_value(k) AS k, count(*) AS f FROM g GROUP BY 1, 2),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM e WHERE k = 1 GROUP BY 1),
f AS MATERIALIZED (SELECT * FROM e WHERE f >= 30), c AS (SELECT * FROM f WHERE k > 1),
y AS MATERIALIZED (SELECT c.*, j, w[1:j] AS lw, w[j + 1:] AS rw FROM c, generate_series(1, 3) s(j) WHERE j < k),
x AS (SELECT y.lang, y.w, y.k, y.f AS a, j, l.f AS l, r.f AS r, CAST(2000000::HUGEINT * y.f // (l.f + r.f) AS BIGINT) AS score FROM y JOIN f l ON l.lang = y.lang AND l.w = y.lw JOIN f r ON r.lang = y.lang AND r.w = y.rw),
b AS (SELECT lang, w, k, a, arg_min({'l': l, 'r': r, 'score': score}, score * 10 + j) AS b FROM x GROUP BY ALL),
h AS (SELECT lang, w[i:i + m - 1] AS w, max(f) AS longer FROM c, generate_series(2, 3) s(m), generate_series(1, 3) z(i) WHERE m < k AND i + m - 1 <= k GROUP BY 1, 2),
o AS (SELECT b.lang, array_to_string(b.w, ' ') AS phrase, a, b.l AS l, b.r AS r, b.score AS score FROM b LEFT JOIN h ON h.lang = b.lang AND h.w = b.w WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM o) JOIN n USING (lang) WHERE rank <= 2000"""

"""Token ids as Re-Pair compressed blocks: tokenise, compress a block at a time, write, and read back from the files."""

from __future__ import annotations

import json
import os
import string
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genomill.llm.common import cut, prepare, shared_dir, slices, table

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: Ids of a block (a longer document has a block of its own); what compression holds in memory at once.
BLOCK_IDS = 1 << 19
#: A pair becomes a rule if it occurs so often in its block.
MIN_COUNT = 24
SCHEMA = "part int, block int, doc_ids binary, offsets binary, rules binary, spans binary, body binary, crc long"


# --- compression of one block -------------------------------------------------------------------------------------------


def repair(ids: np.ndarray, first_free: int) -> tuple[np.ndarray, np.ndarray]:
    """(rules, body): pairs of symbols, the i-th named first_free + i, and the sequence over ids and those names.

    Rounds go on until no adjacent pair occurs MIN_COUNT times (without overlaps). Each counts exactly and replaces a frequent pair
    wherever it is more frequent than the frequent pairs that overlap it; a pair with fewer than MIN_COUNT such places waits. The
    most frequent pair never waits, so that each round names a pair. A rule takes MIN_COUNT symbols away or more: their names stay under
    2^24 for any block of under 2^24 MIN_COUNT ids.
    """
    body, rules, free = ids.astype(np.int64), [np.zeros((0, 2), np.int64)], first_free
    at = np.arange(max(0, len(body) - 1))  # where pairs are that may be frequent: a pair of old symbols never gets more frequent
    while True:
        pair = (body[at] << 32) | body[at + 1]
        slot = ((pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
        often = np.flatnonzero(np.bincount(slot, minlength=1 << 20)[slot] >= MIN_COUNT)  # then exactly, for these alone
        at, pair = at[often], pair[often]
        # a pair that overlaps itself counts at every second place, from the first on
        counted = np.ones(len(at), bool)
        counted[1:] = (pair[1:] != pair[:-1]) | (at[1:] != at[:-1] + 1)
        if not counted.all():
            begin = np.maximum.accumulate(np.where(counted, np.arange(len(at)), 0))
            counted = (np.arange(len(at)) - begin) % 2 == 0
        values, counts = np.unique(pair[counted], return_counts=True)
        values, counts = values[counts >= MIN_COUNT], counts[counts >= MIN_COUNT]
        if not len(values):
            return np.concatenate(rules), body
        own = np.minimum(np.searchsorted(values, pair), len(values) - 1)
        keep = values[own] == pair
        at, own, counted = at[keep], own[keep], counted[keep]
        rank = np.where(counted, (counts * len(values) + np.arange(len(values)))[own], -1)
        wins = counted.copy()
        beside = at[1:] == at[:-1] + 1
        wins[1:] &= ~beside | (rank[1:] > rank[:-1])
        wins[:-1] &= ~beside | (rank[:-1] > rank[1:])
        named = np.bincount(own[wins], minlength=len(values)) >= MIN_COUNT
        wins &= named[own]
        where = at[wins]
        body[where] = (free - 1 + np.cumsum(named))[own[wins]]
        rules.append(np.stack([values[named] >> 32, values[named] & 0xFFFFFFFF], axis=1))
        free += len(rules[-1])
        left = np.ones(len(body), bool)
        left[where + 1] = False
        old = at[left[at]]
        body = body[left]
        here = where - np.arange(len(where))
        near = np.zeros(len(body) + 1, bool)
        near[old - np.searchsorted(where, old)] = near[here] = near[here - 1] = True
        at = np.flatnonzero(near[: len(body) - 1])


def lengths(rules: np.ndarray, first_free: int) -> np.ndarray:
    """Ids that each rule expands to."""
    out = np.ones(len(rules), np.int64)
    for i, (x, y) in enumerate(rules.tolist()):
        out[i] = (out[x - first_free] if x >= first_free else 1) + (out[y - first_free] if y >= first_free else 1)
    return out


def expand(body: np.ndarray, rules: np.ndarray, first_free: int) -> np.ndarray:
    """The ids that a stretch of the body stands for."""
    body = body.astype(np.int64)
    while len(body) and len(rules):
        named = body >= first_free
        if not named.any():
            break
        width = np.where(named, 2, 1)
        end = np.cumsum(width)
        out = np.empty(int(end[-1]), np.int64)
        out[(end - 1)[~named]] = body[~named]
        pairs = rules[body[named] - first_free]
        out[end[named] - 2], out[end[named] - 1] = pairs[:, 0], pairs[:, 1]
        body = out
    return body


def pack(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, first_free: int) -> dict[str, bytes | int]:
    """A block of documents as the columns of SCHEMA. `offsets`: end of each document in ids; `spans`: expansion length of each rule."""
    rules, body = repair(ids, first_free)
    squeeze = lambda x, kind: np.ascontiguousarray(x, kind).tobytes()
    body4 = np.ascontiguousarray(body, "<u4").view(np.uint8).reshape(-1, 4)[:, :3].T if len(body) else np.zeros((3, 0), np.uint8)  # planes of bytes; symbols stay under 2^24
    known = [-(1 << 63) if d is None else d for d in doc_ids]
    return {"doc_ids": squeeze(known, "<i8"), "offsets": squeeze(np.cumsum(counts), "<i8"), "rules": squeeze(rules, "<u4"), "spans": squeeze(lengths(rules, first_free), "<u4"), "body": np.ascontiguousarray(body4).tobytes(), "crc": zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())}


class Block:
    """A stored block, opened for reading."""

    def __init__(self, row: dict, first_free: int):
        load = lambda x, kind: np.frombuffer(row[x], kind).astype(np.int64)
        self.first_free, self.doc_ids, self.ends, self.spans = first_free, load("doc_ids", "<i8"), load("offsets", "<i8"), load("spans", "<u4")
        self.rules = load("rules", "<u4").reshape(-1, 2)
        planes = np.frombuffer(row["body"], np.uint8).reshape(3, -1).astype(np.int64)
        self.body = planes[0] | planes[1] << 8 | planes[2] << 16
        named = self.body >= first_free
        width = np.ones(len(self.body), np.int64)
        width[named] = self.spans[self.body[named] - first_free] if len(self.spans) else 1
        self.width, self.until = width, np.cumsum(width)
        # every id, then what each rule expands to, and where each symbol's stretch of it begins
        self.table = np.concatenate([np.arange(first_free), expand(np.arange(first_free, first_free + len(self.rules)), self.rules, first_free)])
        self.begin = np.concatenate([np.arange(first_free), first_free + np.cumsum(self.spans) - self.spans])

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids start to end (past the last) of the block: only the symbols that cover them are expanded."""
        if start >= end:
            return np.zeros(0, np.int64)
        a, b = int(np.searchsorted(self.until, start, "right")), int(np.searchsorted(self.until, end, "left")) + 1
        first = int(self.until[a - 1]) if a else 0
        width, until = self.width[a:b], self.until[a:b] - first
        places = np.repeat(self.begin[self.body[a:b]] - until + width, width) + np.arange(int(until[-1]))
        return self.table[places[start - first : end - first]]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.ends[i - 1]) if i else 0, int(self.ends[i]))


# --- tokenising ---------------------------------------------------------------------------------------------------------


class Encoder:
    """The tokenizer of a file, with a table of the blank-free pieces it has met: a piece's ids don't depend on its neighbours.

    That holds for tokenizers that split at blanks and drop them, and runs of letters from punctuation. Texts with blanks beyond
    ASCII, or with control characters that only some definitions of blanks include, are encoded whole.
    """

    MOST, MOST_IDS = 700_000, 8_000_000
    #: For Arrow's regular expressions.
    ODD = r"[\x00-\x08\x1c-\x1f\x7f-\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]"
    #: Latin letters, but the dotted capital I, which becomes two characters in lower case; ASCII punctuation but the apostrophe, with which contractions begin.
    LETTER, MARK = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}]", r"[!-&(-/:-@\[-`{-~]"
    MARKS = string.punctuation.replace("'", "")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.split = self.tokenizer.model.tokenize
        # byte-level models name bytes by printable characters: most by their own, the others by the next ones from 256 on
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        self.byte_names = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in printable)}
        # runs of letters can go to the model itself, in lower case, if the steps before it do nothing else to them
        every = pa.array(map(chr, range(1, 0x250)), pa.string())
        letters = every.filter(pc.match_substring_regex(every, self.LETTER)).to_pylist()
        probes = [*letters, "".join(letters[:52]), "".join(letters), "nowhere", "the", "Stra\u00dfe"]
        self.direct = all(self._ids(x) == self._model_ids(x.lower()) for x in probes)
        self.clear_pieces()
        self.clear_runs()

    def clear_pieces(self) -> None:
        self.index: dict[str, int] = {"": 0}
        self.flat, self.n_flat = np.zeros(1 << 16, np.int32), 0
        self.starts, self.sizes = np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int32)

    def clear_runs(self) -> None:
        """The runs that pieces are made of, in a table of their own: they cost the tokenizer's time. The first is empty."""
        self.runs: dict[str, int] = {"": 0}
        self.run_ids, self.n_run_ids = np.zeros(1 << 16, np.int32), 0
        self.run_starts, self.run_sizes = np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int32)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _model_ids(self, word: str) -> list[int]:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.byte_names)
        return [token.id for token in self.split(word)]

    def _add_runs(self, names: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n = len(self.runs)
        self.run_starts = self._room(self.run_starts, n, self.n_run_ids + np.cumsum(sizes) - sizes)
        self.run_sizes = self._room(self.run_sizes, n, sizes)
        self.run_ids = self._room(self.run_ids, self.n_run_ids, ids)
        self.n_run_ids += len(ids)
        self.runs.update(zip(names, range(n, n + len(names)), strict=True))

    def _learn(self, pieces: pa.Array) -> None:
        """Adds pieces. A run of Latin letters before punctuation is looked up by itself; new runs are split by the model, or else encoded in one go, other pieces one by one."""
        plain = pc.match_substring_regex(pieces, f"^{self.LETTER}+{self.MARK}*$")
        words = pc.if_else(plain, pc.ascii_rtrim(pieces, self.MARKS), pieces)
        tailed = pc.not_equal(pc.binary_length(words), pc.binary_length(pieces))
        tails = pc.replace_with_mask(pa.array([""] * len(pieces)), tailed, pc.replace_substring_regex(pieces.filter(tailed), f"^{self.LETTER}+", ""))
        if self.direct:
            words = pc.if_else(plain, pc.utf8_lower(words), words)
        words, tails = pc.dictionary_encode(words), pc.dictionary_encode(tails)
        known, letters = self.runs, self._listed(pc.match_substring_regex(words.dictionary, f"^{self.LETTER}+$"))
        names, ends = self._listed(words.dictionary), self._listed(tails.dictionary)
        one_by_one = [x for x in dict.fromkeys([*(x for x, run in zip(names, letters, strict=True) if not run), *ends]) if x not in known]
        if one_by_one:
            got = [self._ids(x) for x in one_by_one]
            self._add_runs(one_by_one, np.fromiter(chain.from_iterable(got), np.int32), np.fromiter(map(len, got), np.int32))
        new = [x for x in names if x not in known]
        if new and self.direct:
            got = [*map(self._model_ids, new)]
            self._add_runs(new, np.fromiter(chain.from_iterable(got), np.int32), np.fromiter(map(len, got), np.int32))
        elif new:
            got = self.tokenizer.encode(" ".join(new), add_special_tokens=False)
            sizes = np.bincount(np.array(got.word_ids, np.int64), minlength=len(new))
            if len(sizes) == len(new) and sizes.all():
                self._add_runs(new, np.array(got.ids, np.int32), sizes)
            else:  # a tokenizer that parts some run of letters
                got = [*map(self._ids, new)]
                self._add_runs(new, np.fromiter(chain.from_iterable(got), np.int32), np.fromiter(map(len, got), np.int32))
        both = np.empty((len(pieces), 2), np.int64)
        for i, (column, values) in enumerate(((words, names), (tails, ends))):
            both[:, i] = np.fromiter(map(known.__getitem__, values), np.int64, len(values))[column.indices.to_numpy()]
        part = self.run_sizes[both].astype(np.int64)
        flat, ends = part.ravel(), np.cumsum(part.ravel())
        add = self.run_ids[np.repeat(self.run_starts[both].ravel() - ends + flat, flat) + np.arange(int(ends[-1]))]
        sizes, n = part.sum(axis=1), len(self.index) - len(pieces)
        self.flat = self._room(self.flat, self.n_flat, add)
        self.starts = self._room(self.starts, n, self.n_flat + np.cumsum(sizes) - sizes)
        self.sizes = self._room(self.sizes, n, sizes)
        self.n_flat += len(add)

    @staticmethod
    def _listed(column: pa.Array) -> list:
        """As to_pylist, by way of numpy, which is faster."""
        return column.to_numpy(zero_copy_only=False).tolist()

    @staticmethod
    def _room(held: np.ndarray, n: int, add: np.ndarray) -> np.ndarray:
        if n + len(add) > len(held):
            held = np.concatenate([held, np.zeros(max(len(held), len(add)), held.dtype)])
        held[n : n + len(add)] = add
        return held

    def encode(self, texts: list[str | None] | pa.Array) -> list[np.ndarray]:
        """Ids of each text. Words are told apart and numbered by Arrow; each distinct one is looked up once."""
        if len(self.index) > self.MOST or self.n_flat > self.MOST_IDS:
            self.clear_pieces()
        if len(self.runs) > self.MOST or self.n_run_ids > self.MOST_IDS:
            self.clear_runs()
        if isinstance(texts, list):
            texts = pa.array(texts, pa.string())
        texts = texts.fill_null("")
        odd = pc.match_substring_regex(texts, self.ODD)
        whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()
        words = pc.ascii_split_whitespace(pc.if_else(odd, "", texts) if whole else texts)
        coded = pc.dictionary_encode(words.flatten())
        pieces = self._listed(coded.dictionary)
        at = np.fromiter(map(self.index.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            n = len(self.index)
            self.index.update(zip([pieces[i] for i in missing.tolist()], range(n, n + len(missing)), strict=True))
            self._learn(coded.dictionary.take(pa.array(missing)))
            at[missing] = np.arange(n, n + len(missing))
        at = at[coded.indices.to_numpy()]
        sizes = self.sizes[at].astype(np.int64)
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.starts[at] - ends + sizes, sizes) + np.arange(total)]
        offsets = np.array(words.offsets)
        until = np.concatenate([[0], ends])[offsets[1:] - offsets[0]].tolist()
        out = [ids[a:b] for a, b in zip([0, *until[:-1]], until, strict=True)]
        for i in whole:
            out[i] = np.array(self._ids(texts[i].as_py()), np.int32)
        return out


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# --- Spark ---------------------------------------------------------------------------------------------------------------


def write_ids(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Encode every whole text of `docs` (null: empty), append `end_id`, and write blocks in ascending order of doc_id to `path`.

    A row of the files (Parquet, so that any store that Spark reaches will do) is a block of at most `block_ids` ids, or of one
    longer document: its Re-Pair rules, the expansion length of each, and the body. Parts are ranges of doc_id. Null doc_ids
    come first; rows of one doc_id follow each other by text. Other columns are ignored; an empty table gives no blocks.
    """
    spark = docs.sparkSession
    prepare(spark)
    vocabulary = vocabulary or vocabulary_path()
    first_free = max(max(json.load(open(vocabulary))["model"]["vocab"].values()) + 1, end_id + 1, 1 << 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block = TaskContext.get().partitionId(), 0
        names, counts, held, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            x = pack(names, counts, np.concatenate(held), first_free)
            return pa.RecordBatch.from_pylist([{"part": part, "block": block, **x}], schema=pa.schema([("part", pa.int32()), ("block", pa.int32()), *[(c, pa.binary()) for c in ("doc_ids", "offsets", "rules", "spans", "body")], ("crc", pa.int64())]))

        encoder = _encoder(vocabulary)
        for batch in slices(batches, "text", 8 << 20):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text")), strict=True):
                if names and size + len(ids) + 1 > block_ids:
                    yield flush()
                    names, counts, held, size, block = [], [], [], 0, block + 1
                names.append(doc_id)
                counts.append(len(ids) + 1)
                held.append(np.append(ids, np.int32(end_id)))
                size += len(ids) + 1
        if names:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    dealt.mapInArrow(run, SCHEMA).write.option("compression", "zstd").parquet(path)


def read_ids(spark: SparkSession, path: str, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Per stored document, from the files: doc_id, part, block, place (in its block), n_tokens, ids (binary, little-endian unsigned 32-bit integers)."""
    first_free = max(max(json.load(open(vocabulary or vocabulary_path()))["model"]["vocab"].values()) + 1, end_id + 1, 1 << 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                stored = Block(row, first_free)
                ids = np.ascontiguousarray(stored.ids(0, int(stored.ends[-1])), "<u4")
                if zlib.crc32(ids.tobytes()) != row["crc"]:
                    raise ValueError(f"block {row['part']}/{row['block']} is damaged")
                n = len(stored.ends)
                docs = [ids[a:b].tobytes() for a, b in zip([0, *stored.ends[:-1].tolist()], stored.ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None if d == -(1 << 63) else d for d in stored.doc_ids.tolist()], pa.int64()), pa.array([row["part"]] * n, pa.int32()), pa.array([row["block"]] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array([len(x) // 4 for x in docs], pa.int64()), pa.array(docs, pa.binary())],
                    names=["doc_id", "part", "block", "place", "n_tokens", "ids"],
                )

    return spark.read.parquet(path).mapInArrow(run, "doc_id long, part int, block int, place int, n_tokens long, ids binary")


def positions(stored: DataFrame) -> DataFrame:
    """`stored` documents with `start`: the ids of all documents before them. Sums of parts and blocks first, then inside a block."""
    blocks = stored.groupBy("part", "block").agg(F.sum("n_tokens").alias("_n"))
    parts = blocks.groupBy("part").agg(F.sum("_n").alias("_pn"))
    in_order = Window.orderBy("part")
    parts = parts.select("part", (F.sum("_pn").over(in_order) - F.col("_pn")).alias("_p0"))
    blocks = blocks.withColumn("_b0", F.sum("_n").over(Window.partitionBy("part").orderBy("block")) - F.col("_n")).join(parts, "part").select("part", "block", (F.col("_p0") + F.col("_b0")).alias("_0"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part", "block").orderBy("place")) - F.col("n_tokens")
    return stored.withColumn("_in", inside).join(blocks, ["part", "block"]).withColumn("start", F.col("_0") + F.col("_in")).drop("_0", "_in")


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/ids-{uuid.uuid4().hex}"
    write_ids(table(spark, sf_dir, "documents"), path)
    stored = read_ids(spark, path)
    digest = cut(stored.select("doc_id", "part", "block", "place", "n_tokens", F.crc32("ids").alias("ids_crc32")))
    return positions(digest).select("doc_id", "start", "n_tokens", "ids_crc32")

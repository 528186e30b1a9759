"""Benchmark decontamination: Wu-Manber search over words, with block shifts, suffix buckets and direct comparison."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genomill.llm.common import WORD_CHARS, Words, prepare, cut, mix64, slices, table

#: Slots of a shift table for each block that it holds, rounded up to a power of two (hashed by block; a shared slot keeps the smaller shift).
SLOTS_A_BLOCK, LEAST_SLOTS = 4, 1 << 12


def _block(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the block of `size` words that ends at each index (from size - 1 on)."""
    return hashes if size == 1 else mix64(hashes[:-1] * np.uint64(3) + hashes[1:])


class Patterns:
    """Windows of one length: `shift` says how far a search may jump by the block it stands on; `buckets` has the windows by suffix block."""

    def __init__(self, length: int, windows: dict[bytes, set[str]]):
        self.length, self.block = length, min(2, length)
        self.buckets: dict[int, dict[bytes, set[str]]] = defaultdict(dict)
        texts = list(windows)
        words = Words(pa.array(texts, pa.binary()), WORD_CHARS)
        blocks = _block(words.hash, self.block)
        ends = np.arange(self.block - 1, length)
        held = blocks[words.first[:-1, None] + ends - self.block + 1] if texts else np.zeros((0, len(ends)), np.uint64)
        self.slots = max(LEAST_SLOTS, 1 << int(np.ceil(np.log2(SLOTS_A_BLOCK * max(1, len(np.unique(held)))))))
        self.shift = np.full(self.slots, min(255, length - self.block + 1), np.uint8)
        np.minimum.at(self.shift, (held & np.uint64(self.slots - 1)).astype(np.int64), np.broadcast_to(np.minimum(255, length - 1 - ends).astype(np.uint8), held.shape))
        for row, text in enumerate(texts):
            self.buckets[int(blocks[int(words.first[row]) + length - self.block])][text] = windows[text]

    def search(self, words: Words, blocks: dict[int, np.ndarray]) -> Iterator[tuple[int, int, set[str]]]:
        """(row, first word, items) of every occurrence."""
        block = blocks[self.block]
        jumps = self.shift[(block & np.uint64(self.slots - 1)).astype(np.int64)].tobytes()
        back, m, data = self.block - 1, self.length, words.data
        for row, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
            at = a + m - 1
            while at < b:
                jump = jumps[at - back]
                if jump:
                    at += jump
                    continue
                if bucket := self.buckets.get(int(block[at - back])):
                    here = b" ".join(data[words.start[i] : words.end[i]].tobytes() for i in range(at - m + 1, at + 1))
                    if here in bucket:
                        yield row, at - m + 1, bucket[here]
                at += 1


def windows_of(benchmark: list[tuple[str, str | None]], width: int) -> dict[int, dict[bytes, set[str]]]:
    """By length: each window (its words joined by blanks) and the items that have it."""
    found: dict[int, dict[bytes, set[str]]] = defaultdict(lambda: defaultdict(set))
    for item, text in benchmark:
        words = Words(pa.array([text], pa.string()), WORD_CHARS)
        parts = [words.data[s:e].tobytes() for s, e in zip(words.start, words.end, strict=True)]
        for i in range(max(1, len(parts) - width + 1) if parts else 0):
            window = parts[i : i + width]
            found[len(window)][b" ".join(window)].add(item)
    return found


def _scan(docs: DataFrame, patterns: list[Patterns]) -> DataFrame:
    """Adds what these patterns hit to the columns `_hits` (first word, past the last word; merged) and `_items`; sets `_n_words`."""
    shared = docs.sparkSession.sparkContext.broadcast(patterns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"), WORD_CHARS)
            blocks = {1: words.hash, 2: _block(words.hash, 2)}
            spans: dict[int, list[tuple[int, int]]] = defaultdict(list)
            names: dict[int, set[str]] = defaultdict(set)
            for p in shared.value:
                for row, first, items in p.search(words, blocks):
                    spans[row].append((first - int(words.first[row]), first - int(words.first[row]) + p.length))
                    names[row] |= items
            hits, items = batch.column("_hits").to_pylist(), batch.column("_items").to_pylist()
            for row in spans:
                merged: list[list[int]] = []
                for a, b in sorted([*zip(hits[row][::2], hits[row][1::2], strict=True), *spans[row]]):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                hits[row] = [x for pair in merged for x in pair]
                items[row] = sorted({*items[row], *names[row]})
            for name, column in (("_n_words", pa.array(np.diff(words.first), pa.int64())), ("_hits", pa.array(hits, pa.list_(pa.int64()))), ("_items", pa.array(items, pa.list_(pa.string())))):
                batch = batch.set_column(batch.schema.get_field_index(name), name, column)
            yield batch

    return docs.mapInArrow(run, docs.schema)


def find_benchmark(docs: DataFrame, benchmark: DataFrame, width: int = 10, max_words_a_pass: int = 400_000) -> DataFrame:
    """`docs` with _n_words, _hits (word spans, first and past-the-end in turn, merged), _items (sorted item_ids): what of `benchmark` occurs in each text.

    A-Z are lower-cased; words are runs of 0-9, a-z and everything beyond ASCII. A window is `width` consecutive words of an
    item; an item of fewer words, but not none, is one window. The patterns of a pass hold at most about `max_words_a_pass`
    words of items (checked by a count, before anything is sent out; one longer item is a pass of its own; building a full pass takes
    1.3 GB on the driver at its peak); a larger benchmark is searched in several passes over
    the documents, dealt by a hash of the item. Null texts and documents without words: no words, no hits. Items with a null
    item_id or without words: never found. Repeated items count once. Repeated or null doc_ids: each row by
    itself. Columns of these three names in `docs` are replaced; all others pass through.
    """
    spark = docs.sparkSession
    prepare(spark)
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = max(1, -(-size // (2 * max_words_a_pass)))  # a word and its gap: two characters at least
    out = docs.withColumns({"_n_words": F.lit(0).cast("long"), "_hits": F.array().cast("array<long>"), "_items": F.array().cast("array<string>")})
    for i in range(passes):
        part = [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == i).collect()]
        out = _scan(out, [Patterns(n, w) for n, w in sorted(windows_of(part, width).items())])
        if i < passes - 1:
            out = cut(out)
    return out


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_benchmark(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate(F.transform("_hits", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda s, x: s + x)
    return found.select("doc_id", F.col("_n_words").alias("n_words"), n_hit.alias("n_hit"), F.size("_items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("_items"), ","), 256).alias("items_sha256"), (F.size("_hits") > 0).alias("contaminated"))


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold any window of a benchmark item go."""
    return find_benchmark(docs, table(spark, sf_dir, "benchmark")).where("size(_hits) = 0").select(docs.columns)

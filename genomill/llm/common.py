"""Helpers that several corpus operators share: tables, shared scratch space, byte-level text in numpy."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genomill.operators.trees import shuffles_dropped

#: Bytes of text that a task turns into numpy arrays at a time.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession, size: str = "32m") -> None:
    """Before Python tasks: executors get this package (once a context), and Arrow batches end by bytes too, so that very long texts fit."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    sc = spark.sparkContext
    if getattr(sc, "_genomill_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    target = f"{tempfile.mkdtemp(prefix='genomill-')}/genomill.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(target)
    sc._genomill_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share (`spark.checkpoint.dir`); a temporary one only in local mode without it."""
    sc = spark.sparkContext
    if folder := sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None):
        return folder
    if folder := sc.getCheckpointDir():
        return folder
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage ends, its shuffle files go, a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._cut_path = path
    return back


def discard(df: DataFrame | None) -> None:
    """Delete what `cut` wrote, once nothing reads it any more."""
    if path := getattr(df, "_cut_path", None):
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def veiled(docs: DataFrame, *names: str) -> tuple[DataFrame, list[str], list[Column]]:
    """`docs` with columns named _0, _1, ..., so that no name an operator gives can clash; those names; and the columns once called `names`."""
    own = [f"_{i}" for i in range(len(docs.columns))]
    return docs.toDF(*own), own, [F.col(own[docs.columns.index(n)]) for n in names]


#: Ids that may be broadcast (about 100 bytes each in memory).
BROADCAST_IDS = 500_000


def picked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of `docs` whose doc_id is in `ids` (doc_id; written by `cut`): by a broadcast if they are counted to be few, else by a shuffle."""
    ids = ids.distinct()
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids.hint("merge"), "doc_id", "left_semi")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: empty) and the offsets of its rows, without decoding."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about `most` bytes of text, never less than a row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 (a bijection of 64-bit integers)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_CODES = mix64(np.arange(1, 257, dtype=np.uint64))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, np.uint64(b))]), dtype=np.uint64) for b in (_BASE, inverse)]
    return _POWERS[0], _POWERS[1]


def lut_of(separators: bytes) -> np.ndarray:
    """True for bytes that belong to words."""
    word = np.ones(256, bool)
    word[list(separators)] = False
    return word


#: Words without blanks: all but \x20 and \x09-\x0D.
NOT_BLANK = lut_of(bytes([0x20, *range(0x09, 0x0E)]))
#: Words of lower-case letters, digits and everything beyond ASCII, once A-Z are lower-cased.
WORD_CHARS = lut_of(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """Words of a slice of texts. `start`, `end`: bytes in `data` (A-Z lower-cased); `first`: index of each row's first word; `hash`: 64 bits a word."""

    def __init__(self, column: pa.Array, word: np.ndarray):
        raw, self.offsets = utf8(column)
        self.data = _LOWER[raw]
        n = len(self.data)
        inside = word[self.data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        edges = self.offsets[1:-1]
        edges = edges[(edges > 0) & (edges < n)]
        begins[edges] = inside[edges]  # a text never joins words with the next one
        ends[edges - 1] = inside[edges - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        up, down = _powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_CODES[self.data] * up[:n], out=total[1:], dtype=np.uint64)
        self.hash = mix64((total[self.end] - total[self.start]) * down[self.start])

    def grams(self, n: int) -> np.ndarray:
        """A hash for each n consecutive words, by the index of the first; also across rows: the caller skips those."""
        if len(self.hash) < n:
            return np.zeros(0, np.uint64)
        m = len(self.hash) - n + 1
        out = np.zeros(m, np.uint64)
        for i in range(n):
            out += self.hash[i : i + m] * np.uint64(pow(_BASE, i + 1, 1 << 64))
        return mix64(out)


    def stretches(self, n: int) -> np.ndarray:
        """As `grams`, for long stretches: by differences of one running sum."""
        m = len(self.hash) - n + 1
        if m < 1:
            return np.zeros(0, np.uint64)
        up, down = _powers(len(self.hash) + 1)
        total = np.zeros(len(self.hash) + 1, np.uint64)
        np.cumsum(self.hash * up[: len(self.hash)], out=total[1:], dtype=np.uint64)
        return mix64((total[n:] - total[:-n]) * down[:m])

    def ranges(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """A hash of the words lo to hi (past the last) for each pair of bounds."""
        up, down = _powers(len(self.hash) + 1)
        total = np.zeros(len(self.hash) + 1, np.uint64)
        np.cumsum(self.hash * up[: len(self.hash)], out=total[1:], dtype=np.uint64)
        return mix64((total[hi] - total[lo]) * down[lo])


def runs(keys: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal values: as many starts as there are runs, and the length."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows that arrive sorted by keys, group by group; only one group is held."""
    held: list[pa.RecordBatch] = []

    def key(batch: pa.RecordBatch, i: int) -> tuple:
        return tuple(batch.column(k)[i].as_py() for k in keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            x = batch.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= x[1:] != x[:-1]
        bounds = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:], strict=False):
            if held and a == 0 and key(held[-1], 0) != key(batch, 0) or held and a > 0:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)

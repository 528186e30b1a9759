"""Language identification: TF-IDF vectors of byte n-grams against several centroids a language, by cosine, with rejection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genomill.llm.common import cut, prepare, slices, table, utf8

DIMS = 4096
#: Bytes as the n-grams see them: A-Z lower-cased, all other ASCII but letters one blank; bytes beyond ASCII as they are.
_CLASS = np.arange(256, dtype=np.uint32)
_CLASS[:128] = 32
_CLASS[97:123] = np.arange(97, 123)
_CLASS[65:91] = np.arange(97, 123)


def features(column: pa.Array) -> np.ndarray:
    """Counts of hashed byte 2-grams and 3-grams of whole texts, a row for each text; n-grams of blanks only don't count."""
    raw, offsets = utf8(column)
    out = np.zeros((len(column), DIMS), np.float32)
    x = _CLASS[raw]
    if len(x) < 2:
        return out
    two = x[:-1] * np.uint32(256) + x[1:]
    three = two[:-1] * np.uint32(256) + x[2:]
    bin2 = ((two * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int32)
    bin3 = ((three * np.uint32(2246822519)) >> np.uint32(20)).astype(np.int32)
    blank2, blank3 = two == 32 * 257, x[1:-1] == 32
    bin2[blank2] = DIMS
    bin3[blank3] = DIMS
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        if b - a >= 2:
            out[i] = np.bincount(bin2[a : b - 1], minlength=DIMS + 1)[:DIMS]
        if b - a >= 3:
            out[i] += np.bincount(bin3[a : b - 2], minlength=DIMS + 1)[:DIMS]
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


#: Powers of two by which the number of n-grams is told apart; texts of like length that calibration needs; their quantile; share of it that is enough.
POWERS, ENOUGH, LOW, SHARE = 32, 200, 0.01, 0.6
#: Characters of the pieces cut from the beginning of labelled texts, so that there are enough short ones to calibrate by.
PIECES = (8, 16, 32, 64, 128)


def _power(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(counts.sum(axis=1), 1)).astype(int), POWERS - 1)


def _calibrated(score: np.ndarray, power: np.ndarray, otherwise: np.ndarray | float) -> np.ndarray:
    """Least cosine by power of two: SHARE of the low quantile of labelled texts of that length or half of it.

    Lengths of which there are too few texts keep `otherwise`; if that is one figure, shorter texts help out first.
    """
    out = np.zeros(POWERS) + otherwise
    for k in range(POWERS):
        for low in range(k - 1, -1 if np.ndim(otherwise) == 0 else k - 2, -1):
            like = score[(power <= k) & (power >= low)]
            if len(like) >= ENOUGH:
                out[k] = SHARE * np.quantile(like, LOW)
                break
    return out


@dataclass
class Centroids:
    """A fitted classifier: unit rows of `centres`, the language of each, inverse document frequencies, least cosine of an accepted text by centre and power of two of its n-grams."""

    idf: np.ndarray
    centres: np.ndarray
    langs: list[str]
    least: np.ndarray

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return _unit(np.log1p(counts) * self.idf)

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest centre, its cosine, and whether that is near enough, for each row."""
        cosine = self.vectors(counts) @ self.centres.T
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(len(best)), best].astype(np.float64), 0.0, 1.0)
        return best, score, score >= self.least[best, _power(counts)]


def _cluster(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Centres of spherical k-means, from k rows drawn far apart."""
    chosen = [int(rng.integers(len(x)))]
    while len(chosen) < min(k, len(x)):
        chosen.append(int((x @ x[chosen].T).max(axis=1).argmin()))
    centres = x[chosen]
    for _ in range(rounds):
        near = (x @ centres.T).argmax(axis=1)
        centres = _unit(np.stack([x[near == j].mean(axis=0) if (near == j).any() else centres[j] for j in range(len(centres))]))
    return centres


def fit(labelled: DataFrame, per_lang: int = 400, max_rows: int = 8000, clusters: int = 3, least: float = 0.02) -> Centroids:
    """Learn from `text` and `lang` of labelled rows, of which at most `per_lang` different texts a language (those of smallest hash) and about `max_rows` in all are used, one a language at least.

    Texts are drawn by hashes alone, first below a bound that the language's count gives, so that no task sees all rows of a
    frequent language. The model grows with the number of languages only. Rows with a null text or lang take no part. No labelled
    row at all: a classifier without languages. How near a text must be is calibrated on the sample and on short pieces of it, by
    language and length (by length alone where a language has too few such texts, and `least` where all have).
    """
    prepare(labelled.sparkSession)
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("text", F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("_h"))
    texts = cut(rows.groupBy("lang", F.pmod("_h", F.lit(256)).alias("_salt")).agg(F.approx_count_distinct("_h").alias("n")).groupBy("lang").agg(F.sum("n").alias("n")))
    n_langs = texts.count()
    per_lang = min(per_lang, max(1, max_rows // max(1, n_langs)))
    # twice as many as wanted are expected below the bound; the smallest hashes of a language with fewer are all of them
    share = F.least(F.lit(1.0), (4.0 * per_lang + 100) / F.col("n"))
    near = rows.join(F.broadcast(texts), "lang").where((F.col("_h").cast("double") / 2.0**64 + 0.5) <= share)
    drawn = cut(near.select("lang", "_h").distinct().withColumn("_r", F.row_number().over(Window.partitionBy("lang").orderBy("_h"))).where(F.col("_r") <= per_lang).drop("_r"))
    # at most max_rows pairs, or one a language
    drawn = rows.join(F.broadcast(drawn), ["lang", "_h"]).dropDuplicates(["lang", "_h"]).select("text", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts = features(batch.column("text"))
            heads = [x[: PIECES[-1]] for x in batch.column("text").to_pylist()]
            at = [np.flatnonzero(x) for x in counts]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array([i.astype("<u2").tobytes() for i in at], pa.binary()), pa.array([x[i].astype("<f4").tobytes() for i, x in zip(at, counts, strict=True)], pa.binary()), pa.array(heads, pa.string())], names=["lang", "bins", "counts", "head"])

    sample = drawn.mapInArrow(run, "lang string, bins binary, counts binary, head string").toArrow().combine_chunks().sort_by([("lang", "ascending"), ("head", "ascending"), ("bins", "ascending"), ("counts", "ascending")])
    counts = np.zeros((sample.num_rows, DIMS), np.float32)
    for i, (at, x) in enumerate(zip(sample.column("bins"), sample.column("counts"), strict=True)):
        counts[i, np.frombuffer(at.as_py(), "<u2")] = np.frombuffer(x.as_py(), "<f4")
    names, heads = np.array(sample.column("lang").to_pylist(), object), np.array(sample.column("head").to_pylist(), object)
    langs = sorted(set(names.tolist()))
    del sample
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + np.float32(1)
    rng = np.random.default_rng(7)
    centres, owners, scores, powers, of = [np.zeros((0, DIMS), np.float32)], [], [], [], []
    for lang in sorted(langs):
        own = counts[names == lang]
        found = _cluster(_unit(np.log1p(own) * idf), clusters, rng)
        centres.append(found)
        owners += [lang] * len(found)
        for some in (own, *(features(pa.array([h[:n] for h in heads[names == lang] if len(h) > n], pa.string())) for n in PIECES)):
            some = some[some.any(axis=1)]
            scores.append((_unit(np.log1p(some) * idf) @ found.T).max(axis=1))
            powers.append(_power(some))
            of += [lang] * len(some)
    floors = np.zeros((0, POWERS))
    if owners:
        score, power, of = np.concatenate(scores), np.concatenate(powers), np.array(of, object)
        pooled = _calibrated(score, power, least)
        by_lang = {lang: np.maximum(least, _calibrated(score[of == lang], power[of == lang], pooled)) for lang in langs}
        floors = np.stack([by_lang[lang] for lang in owners])
    return Centroids(idf, np.concatenate(centres).astype(np.float32), owners, floors)


def classified(column: pa.Array, m: Centroids) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score, and whether there is a letter and the text near enough, for each text."""
    has = np.array([bool(t) and any(map(str.isalpha, t)) for t in column.to_pylist()], bool)
    if not m.langs:
        return ["und"] * len(has), np.zeros(len(has)), np.zeros(len(has), bool)
    best, score, near = m.predict(features(column))
    return [m.langs[i] if h else "und" for i, h in zip(best.tolist(), has.tolist(), strict=True)], np.where(has, score, 0.0), has & near


def predict(docs: DataFrame, model: Centroids) -> DataFrame:
    """doc_id, lang_pred, score, rejected for every row, from the whole text only.

    `lang_pred` is the language of the nearest centroid, `score` its cosine (0 to 1). A null text or one without a letter:
    `und`, 0, rejected. Rejected are also texts whose nearest centroid is too far for their length (see `fit`); they keep the
    prediction. Null or repeated doc_ids: each row by itself. With no learned language every text is `und`. Equally near
    centroids: the language that sorts first.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in slices(batches, "text"):
            names, score, accepted = classified(batch.column("text"), m)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(~accepted)], names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def _fold():
    return F.crc32(F.col("doc_id").cast("string")) % 3


def fit_on_folds(docs: DataFrame) -> Centroids:
    """Learn from the documents whose crc32(doc_id as text) mod 3 is not 1."""
    return fit(docs.where(_fold() != 1))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, fit_on_folds(docs))
    return found.select("doc_id", F.coalesce(_fold() == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def stage_langid(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language ID rejects go; all columns pass through the scan that decides.

    Null texts, texts without a letter and those too far from every centroid go. Where no document tells its language nothing
    can be learned, and every document stays. Repeated rows share their fate; an empty table stays empty.
    """
    prepare(spark)
    model = fit_on_folds(docs)
    if not model.langs:
        return docs
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield batch.filter(pa.array(classified(batch.column("text"), shared.value)[2]))

    return docs.mapInArrow(run, docs.schema)

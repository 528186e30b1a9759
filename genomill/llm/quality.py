"""Quality of documents by attention over their passages: every passage is encoded, gated attention weighs them, their weighted sum is scored."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genomill.llm.common import NOT_BLANK, Words, cut, discard, prepare, slices, table, utf8

#: Words of a passage; hashed features, figures of style and hidden units of its encoding.
PASSAGE, DIMS, STYLE, HIDDEN, GATE = 64, 512, 10, 32, 16
_BYTES = np.arange(256)
_UPPER, _DIGIT = (_BYTES >= 65) & (_BYTES <= 90), (_BYTES >= 48) & (_BYTES <= 57)
_LETTER = _UPPER | (_BYTES >= 97) & (_BYTES <= 122) | (_BYTES >= 128)
_SIGN = ~(_LETTER | _DIGIT | (_BYTES <= 32))


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """An encoding of each passage of each text, and how many passages each text has: one at least, an empty one for a text without words.

    A passage is 64 words between blanks in a row, the last one shorter. It is encoded by hashed byte 3-grams (case kept, unit
    length) and by shares: capitals, digits and signs among its bytes, different words, words like the one before, lines, their length.
    """
    raw, _ = utf8(column)
    words = Words(column, NOT_BLANK)
    n_words = np.diff(words.first)
    many = np.maximum(-(-n_words // PASSAGE), 1)
    first = np.concatenate([[0], np.cumsum(many)])
    out = np.zeros((first[-1], DIMS + STYLE), np.float32)
    row = np.repeat(np.arange(len(column)), n_words)
    inside = np.arange(len(row)) - words.first[row]
    owner = first[row] + inside // PASSAGE
    size = np.bincount(owner, minlength=len(out))
    full = size > 0
    if not full.any():
        return out, many
    # the passage of each byte: from its first word on, or from the beginning of the text
    begins = np.zeros(len(out), np.int64)
    begins[owner[::-1]] = words.start[::-1]
    begins[first[:-1]] = words.offsets[:-1]
    place = np.repeat(np.arange(len(out)), np.diff(np.append(begins, len(raw))))
    text = np.repeat(np.arange(len(column)), many)
    length = np.maximum(np.bincount(place, minlength=len(out)), 1)
    for d in range(0, len(out), 4096):  # so that counts of a few thousand passages are held at a time
        a, b = np.searchsorted(place, [d, d + 4096])
        b = min(b + 2, len(raw))
        x, few = raw[a:b].astype(np.uint32), min(4096, len(out) - d)
        if b - a > 2:
            gram = (((x[:-2] * np.uint32(65536) + x[1:-1] * np.uint32(256) + x[2:]) * np.uint32(2654435761)) >> np.uint32(23)).astype(np.int64)
            own = text[place[a : b - 2]] == text[place[a + 2 : b]]
            out[d : d + few, :DIMS] = np.log1p(np.bincount(((place[a : b - 2] - d) * DIMS + gram)[own], minlength=few * DIMS).reshape(few, DIMS))
    out[~full] = 0
    out[:, :DIMS] /= np.maximum(np.linalg.norm(out[:, :DIMS], axis=1, keepdims=True), 1e-9)
    share = lambda mask: np.bincount(place, weights=mask[raw], minlength=len(out)) / length
    key = np.stack([owner.astype(np.uint64), words.hash])
    order = np.lexsort(key[::-1])
    fresh = np.ones(len(order), bool)
    fresh[1:] = (np.diff(owner[order]) > 0) | (words.hash[order][1:] != words.hash[order][:-1])
    again = np.zeros(len(owner), bool)
    again[1:] = (owner[1:] == owner[:-1]) & (words.hash[1:] == words.hash[:-1])
    n = np.maximum(size, 1)
    style = [share(_UPPER), share(_DIGIT), share(_SIGN), share(_BYTES == 10), share(_BYTES == 124), np.bincount(owner[order][fresh], minlength=len(out)) / n, np.bincount(owner, weights=again, minlength=len(out)) / n, np.minimum(length / n / 16, 4), np.log1p(size) / 4, np.bincount(owner, weights=words.end - words.start > 16, minlength=len(out)) / n]
    out[:, DIMS:] = np.where(full[:, None], np.stack(style, axis=1), 0)
    return out, many


@dataclass
class Attention:
    """Weights of the encoder (w, b), of the gated attention (v, g, a) and of the score (u, c); `shift` is added to the score's logit, `constant` stands for it where nothing could be learned."""

    p: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray
    shift: float = 0.0
    constant: float | None = None

    def forward(self, x: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, ...]:
        p, first = self.p, np.concatenate([[0], np.cumsum(many)[:-1]])
        h = np.maximum(x @ p["w"] + p["b"], 0)
        t, s = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["g"])))
        e = (t * s) @ p["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), many))
        weight = e / np.repeat(np.add.reduceat(e, first), many)
        z = np.add.reduceat(h * weight[:, None], first)
        return h, t, s, weight, z, z @ p["u"] + p["c"]

    def normal(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(np.float32) - self.mean) / self.scale

    def score(self, x: np.ndarray, many: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(many), self.constant)
        logit = self.forward(self.normal(x), many)[-1].astype(np.float64) + self.shift
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def _learn(x: np.ndarray, many: np.ndarray, y: np.ndarray, rounds: int, batch: int = 64, rate: float = 2e-3) -> Attention:
    """Adam on the log loss of documents in small batches; gradients by hand."""
    rng = np.random.default_rng(5)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    p = {"w": draw(x.shape[1], HIDDEN), "b": np.zeros(HIDDEN, np.float32), "v": draw(HIDDEN, GATE), "g": draw(HIDDEN, GATE), "a": draw(GATE), "u": draw(HIDDEN), "c": np.zeros(1, np.float32)}
    mean = np.zeros(x.shape[1], np.float32)
    mean[DIMS:] = x[:, DIMS:].mean(axis=0, dtype=np.float64)
    scale = np.ones(x.shape[1], np.float32)
    scale[DIMS:] = np.maximum(x[:, DIMS:].std(axis=0, dtype=np.float64), 1e-3)
    model = Attention(p, mean, scale)
    first, step = np.concatenate([[0], np.cumsum(many)]), 0
    moments = {k: (np.zeros_like(w), np.zeros_like(w)) for k, w in p.items()}
    for _ in range(rounds):
        order = rng.permutation(len(many))
        for some in np.array_split(order, max(1, len(order) // batch)):
            rows = np.concatenate([np.arange(first[i], first[i + 1]) for i in some])
            xb, mb = model.normal(x[rows]), many[some]
            h, t, s, weight, z, logit = model.forward(xb, mb)
            d = ((1 / (1 + np.exp(-logit)) - y[some]) / len(some)).astype(np.float32)
            starts = np.concatenate([[0], np.cumsum(mb)[:-1]])
            dz = np.repeat(d[:, None] * p["u"], mb, axis=0)
            pull = (h * dz).sum(axis=1) * weight
            de = pull - weight * np.repeat(np.add.reduceat(pull, starts), mb)
            dt, ds = de[:, None] * p["a"] * s * (1 - t * t), de[:, None] * p["a"] * t * s * (1 - s)
            dh = (dz * weight[:, None] + dt @ p["v"].T + ds @ p["g"].T) * (h > 0)
            grads = {"w": xb.T @ dh, "b": dh.sum(axis=0), "v": h.T @ dt, "g": h.T @ ds, "a": (t * s).T @ de, "u": z.T @ d, "c": d.sum(keepdims=True)}
            step += 1
            for k, g in grads.items():
                g = g + 1e-4 * p[k]
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def fit(docs: DataFrame, labels: DataFrame, per_label: int = 2000, longest: int = 64, rounds: int = 25) -> Attention:
    """Learn from `text` of `docs` (doc_id, text) and `quality` (0, 1; others don't count) of `labels` (doc_id, quality).

    At most `per_label` different texts a label are drawn, those of smallest hash, and used if they have up to `longest` passages
    (4,096 words); each is encoded whole. The two bounds hold the driver's share at some 250,000 passages of 1 KB. Scores are
    shifted to the share of label 1 among all different labelled texts. Null texts are empty. Texts of one label alone, or none:
    every score is the share of label 1, smoothed by one of each. Only ids and hashes of texts are shuffled.
    """
    prepare(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("_h", F.xxhash64("text"))
    known = labels.where("quality IN (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality"))
    held = cut(rows.select("doc_id", "_h").join(known, "doc_id").select("quality", "_h").distinct())
    sizes = {r.quality: r.n for r in held.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return Attention({}, np.zeros(0), np.zeros(0), constant=(n1 + 1) / (n0 + n1 + 2))
    # of many, only hashes below a bound are ordered: four times as many as wanted are expected there
    bound = F.when(F.col("quality") == 1, min(1.0, (4.0 * per_label + 100) / n1)).otherwise(min(1.0, (4.0 * per_label + 100) / n0))
    near = held.where(F.col("_h").cast("double") / 2.0**64 + 0.5 <= bound)
    drawn = cut(near.withColumn("_r", F.row_number().over(Window.partitionBy("quality").orderBy("_h"))).where(F.col("_r") <= per_label).select("quality", "_h"))
    texts = rows.select("text", "_h").join(F.broadcast(drawn), "_h").dropDuplicates(["quality", "_h"])  # 2 x per_label rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x, many = passages(batch.column("text"))
            ends = np.cumsum(many)
            coded = pa.array([x[b - m : b].astype("<f2").tobytes() if m <= longest else None for b, m in zip(ends, many, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("quality"), batch.column("_h"), coded], names=["quality", "h", "x"]).filter(coded.is_valid())

    sample = texts.select("quality", "_h", "text").mapInArrow(run, "quality int, h long, x binary").toArrow().sort_by([("h", "ascending"), ("quality", "ascending")])
    discard(held)
    discard(drawn)
    x = [np.frombuffer(b.as_py(), "<f2").reshape(-1, DIMS + STYLE) for b in sample["x"]]
    y = sample["quality"].to_numpy().astype(np.float32)
    if not 0 < y.sum() < len(y):  # one label has long texts only
        return Attention({}, np.zeros(0), np.zeros(0), constant=(n1 + 1) / (n0 + n1 + 2))
    many = np.array([len(b) for b in x])
    model = _learn(np.concatenate(x), many, y, rounds)
    model.shift = float(np.log(n1 / n0) - np.log(y.sum() / (len(y) - y.sum())))
    return model


def predict(docs: DataFrame, model: Attention) -> DataFrame:
    """`doc_id`, `score` for every row, from all passages of its text; a null text counts as empty, an empty one has one empty passage. Repeated or null doc_ids: each row by itself."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shared.value.score(*passages(batch.column("text"))))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")


def _fold():
    return F.crc32(F.col("doc_id").cast("string")) % 5


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs.where(_fold() != 0), table(spark, sf_dir, "labels").where(_fold() != 0))
    return predict(docs, model).select("doc_id", F.coalesce(_fold() == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))

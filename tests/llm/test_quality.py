"""The quality classifier: held-out accuracy, its passages by a plain loop, training, odd rows and one label only."""

import zlib

import numpy as np
import pyarrow as pa

from genomill.llm import quality


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = quality.op13_quality(spark, sf)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 50 and sum(p == y for p, y in held) / len(held) >= 0.95
    assert all(p for p, y in held if y)  # no good document is lost


def test_passages_by_a_plain_loop():
    texts = ["", None, "Z z " * 140_000, " \n", "One two two three. " * 50, "É" * 3000, "a | b\n!! C3 " + "long" * 9, "x " * 63 + "y", "x " * 65]
    x, many = quality.passages(pa.array(texts))
    i = 0
    for t, m in zip(texts, many.tolist(), strict=True):
        w = (t or "").split()
        assert m == max(1, -(-len(w) // 64))
        for k in range(m):
            own = w[64 * k : 64 * k + 64]
            style = x[i][quality.DIMS :]
            if not own:
                assert not x[i].any()
            else:
                assert np.isclose(style[5], len({s.lower() for s in own}) / len(own)) and np.isclose(style[8], np.log1p(len(own)) / 4)
                assert np.isclose(style[6], sum(a.lower() == b.lower() for a, b in zip(own, own[1:], strict=False)) / len(own))
                assert np.isclose(np.linalg.norm(x[i][: quality.DIMS]), 1) or len(" ".join(own)) < 3
            i += 1
    assert i == len(x)
    one = [quality.passages(pa.array([t]))[0] for t in texts]
    assert np.allclose(np.concatenate(one), x, atol=1e-6)  # neighbours in a slice change nothing


def test_training_lowers_the_loss():
    rng = np.random.default_rng(0)
    many = np.array([3, 1, 4])
    x = rng.standard_normal((8, quality.DIMS + quality.STYLE)).astype(np.float32)
    y = np.array([1, 0, 1], np.float32)

    def loss(m):
        p = 1 / (1 + np.exp(-m.forward(m.normal(x), many)[-1].astype(np.float64)))
        return -np.mean(np.log(np.where(y == 1, p, 1 - p)))

    before = quality._learn(x, many, y, 0)
    start = loss(before)
    trained = quality._learn(x, many, y, 60)
    assert loss(trained) < 0.2 * start
    weight = trained.forward(trained.normal(x), many)[3]
    assert np.allclose(np.add.reduceat(weight, [0, 3, 4]), 1)


SCHEMA = "doc_id long, text string, score string, quality int, x int"


def test_odd_rows_and_single_labels(spark):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(200)]
    good = [(i, " ".join(rng.choice(words, 80)), None, 1, 0) for i in range(60)]
    bad = [(100 + i, "BUY!! " * int(rng.integers(5, 300)), None, 0, 0) for i in range(40)]
    odd = [(None, None, None, None, 1), (500, "", None, 7, 1), (500, "", None, None, 1), (501, "long word " * 200_000, None, 1, 1), (502, " \t", None, 0, 1)]
    rows = spark.createDataFrame(good + bad + odd, SCHEMA)
    model = quality.fit(rows, rows, per_label=30, longest=8)
    got = quality.predict(rows, model).collect()
    assert len(got) == 105 and all(0 <= r.score <= 1 for r in got)
    scores = {r.doc_id: r.score for r in got}
    assert min(scores[i] for i in range(60)) > 0.5 > max(scores[100 + i] for i in range(40))
    none = rows.where("false")
    assert quality.predict(none, model).collect() == []
    assert {r.score for r in quality.predict(rows, quality.fit(none, none)).collect()} == {0.5}
    only = lambda model: {round(r.score, 9) for r in quality.predict(rows, model).collect()}
    assert only(quality.fit(rows, rows.where("quality = 1"))) == {round(62 / 63, 9)}
    n0 = len({r[1] for r in bad}) + 1
    assert only(quality.fit(rows, rows.where("quality = 0 OR doc_id = 501"), longest=8)) == {round(2 / (n0 + 3), 9)}  # all of label 1 is too long to learn from

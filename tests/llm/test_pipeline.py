"""The whole corpus pipeline against a plain version: sets, windows and DuckDB instead of Spark."""

import re

import duckdb
import numpy as np
import pandas as pd

import corpus_pipeline
from genomill.llm import langid
from genomill.llm.mixing import OP7_SQL
from genomill.llm.sharding import OP5_SQL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def fixture(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").orderBy("doc_id").limit(150).collect()]
    rng, top = np.random.default_rng(2), 10**6
    base = rows[20][1].split()
    for i in range(8):
        own = list(base)
        own[int(rng.integers(len(own)))] = f"edit{i}"
        rows.append((top + i, " ".join(own), "en", None, None))
    rows += [(top + 20, None, None, "s", None), (top + 21, "", "en", "s", None), (top + 22, "12 34 ..", "en", "s", None), (None, rows[3][1], "en", "s", None), rows[5], rows[5]]
    return rows


def brute_force(spark, rows, benchmark):
    rows = [r for r, p in zip(rows, predictions(spark, rows), strict=True) if not p]
    sets, known = [], {}
    for r in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (r[1] or "").encode().lower())
        sets.append({tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w and r[0] is not None else None)
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and group[i] != group[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    for i, g in enumerate(group):
        known.setdefault(g, []).append(i)
    kept = sorted(min(m, key=lambda i: (rows[i][0] is None, rows[i][0])) for m in known.values())
    rows, word = [rows[i] for i in kept], re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for text in benchmark:
        w = word.findall((text or "").encode().lower())
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}
    hit = lambda w: any(tuple(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1))
    rows = [r for r in rows if not hit(word.findall((r[1] or "").encode().lower()))]
    con = duckdb.connect()
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"doc_id": "Int64"})  # noqa: F841
    con.execute("CREATE TABLE raw AS SELECT * FROM documents")
    con.execute("CREATE VIEW documents AS SELECT * FROM raw")
    mixed = con.execute(f"SELECT doc_id, count(*) FROM ({OP7_SQL}) GROUP BY 1").fetchall()
    texts = {r[0]: r for r in rows}
    shown = pd.DataFrame([texts[d] for d, n in mixed for _ in range(n)], columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"doc_id": "Int64"})
    con.register("shown", shown)
    con.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM shown")
    return con.execute(f"SELECT doc_id, shard, shard_part, shard_bytes FROM ({OP5_SQL})").fetchall()


def predictions(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    model = langid.fit_on_folds(docs)
    near = langid.classified(__import__("pyarrow").array([r[1] for r in rows], "string"), model)[2]
    return [not x for x in near]


def test_pipeline(spark, sf, tmp_path):
    rows = fixture(spark, sf)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    items = [("b1", " ".join(rows[30][1].split()[:12])), ("b2", "no such words anywhere"), (None, "x"), ("b3", None)]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == [*SCHEMA.replace(" long", "").replace(" string", "").split(", "), "shard", "shard_part", "shard_depth", "shard_bytes"]
    found = [(r.doc_id, r.shard, r.shard_part, r.shard_bytes) for r in got.collect()]
    want = brute_force(spark, rows, [t for i, t in items if i])
    assert len(want) > 60 and rows[30][0] not in {w[0] for w in want}
    assert sorted(map(str, found)) == sorted(str(tuple(int(x) if isinstance(x, float) else x for x in w)) for w in want)


def test_pipeline_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []

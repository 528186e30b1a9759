"""Collocations against a plain count, with tries in parts and in one, and the trie itself against a set."""

import re
from collections import Counter

import numpy as np
import pytest

from genomill.llm import collocations as mining

SCHEMA = "lang string, text string"


def brute(rows, least, longest, top, percent):
    """Every n-gram by a plain loop."""
    out = []
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang, text = lang or "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = [x for x in re.split("[ \t]", piece) if x]
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    found = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    for lang in totals:
        ranked = []
        for (x, p), a in found.items():
            if x != lang or any(100 * b >= percent * a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) for (y, q), b in found.items() if y == lang):
                continue
            cuts = [(2_000_000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, i, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(2)
    words = ["The", "the", "of", "é", "naïve", "x", "-", "q\x0b", "日本", "end.", "so,", "A", "b!c"] + [f"w{i}" for i in range(30)]
    weight = 1 / np.arange(1, len(words) + 1)
    rows = [(("en", "fr", None)[int(rng.integers(3))], " ".join(rng.choice(words, int(rng.integers(1, 60)), p=weight / weight.sum()))) for _ in range(90)]
    rows += [("en", None), (None, None), ("en", ""), ("xx", " \t\n ., "), ("en", "one two three four five " * 40), ("fr", "same same same same same"), ("de", "alone")]
    return rows + [("en", "one two three four five\t\tsix")] * 9


@pytest.mark.parametrize("most,bits,positions", [(1_000_000, 10, 4_000_000), (40, 3, 50)])
def test_against_a_plain_count(spark, texts, monkeypatch, most, bits, positions):
    for name, value in (("MOST", most), ("BITS", bits), ("POSITIONS", positions), ("ROWS", 13)):
        monkeypatch.setattr(mining, name, value)
    docs = spark.createDataFrame([(*r, "a", 1, None) for r in texts], SCHEMA + ", word string, n long, ids string")
    assert sorted(map(tuple, mining.collocations(docs, 6, 4, 25, 80).collect())) == brute(texts, 6, 4, 25, 80)


def test_no_words_and_no_rows(spark):
    assert mining.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert mining.collocations(spark.createDataFrame([("en", None), (None, " . ")], SCHEMA)).collect() == []
    assert mining.collocations(spark.createDataFrame([("en", "too rare")], SCHEMA)).collect() == []
    long = spark.createDataFrame([("en", "a b " * 300_000)], SCHEMA)
    want = brute([("en", "a b " * 3000)], 30, 4, 9, 80)
    assert [r.phrase for r in mining.collocations(long).collect()] == [w[2] for w in want]


@pytest.mark.parametrize("bits", [2, 4, 10])
def test_double_array_finds_its_phrases_only(monkeypatch, bits):
    monkeypatch.setattr(mining, "BITS", bits)
    rng = np.random.default_rng(bits)
    for k in (2, 3, 4):
        phrases = np.unique(rng.zipf(1.3, (4000, k)).clip(1, 900).astype(np.int32), axis=0)
        trie = mining.DoubleArray(phrases, 900)
        ids = rng.zipf(1.3, 20_000).clip(0, 950).astype(np.int32)
        ids[rng.integers(0, len(ids), 2000)] = 0
        ids[ids > 900] = 0
        place, row = trie.rows_at(ids)
        known = {tuple(p): i for i, p in enumerate(phrases.tolist())}
        want = [(i, known[t]) for i in range(len(ids) - k + 1) if (t := tuple(ids[i : i + k].tolist())) in known]
        assert list(zip(place.tolist(), row.tolist(), strict=True)) == want and want

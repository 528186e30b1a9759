"""The prefix trie against brute force: deep sharing over several blocks, nulls, ties, turnless and repeated conversations."""

import hashlib
import math
import zlib
from collections import defaultdict

import numpy as np

from genomill.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string"


def ordered(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    return {c: [v[2:] for v in sorted(own[c])] for c in own}


def graft(own):
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + v[h:]  # as SQL takes remainders
    return out


def brute(convs):
    """A dict of nodes: path -> members; then each figure by its definition."""
    members = defaultdict(list)
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)

    def below(p):
        stack, leaves, saved = [p], 0, 0
        while stack:
            q = stack.pop()
            leaves += not children[q]
            saved += (len(members[q]) - 1) * len(q[-1][1].encode()) if q else 0
            stack += children[q]
        return leaves, saved

    for p in list(members):
        ends = sorted(c for c in members[p] if len(convs[c]) == len(p))
        leaves, saved = below(p)
        yield (min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), leaves, saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())


def conversations():
    rng = np.random.default_rng(11)
    rows, turn = [], lambda: f"t{rng.integers(3)} é" * int(rng.integers(1, 3))
    for c in range(60):
        rows += [(c, t, ("user", "assistant")[t % 2], turn()) for t in range(int(rng.integers(1, 12)))]
    long = [(t, "user", f"deep {t}") for t in range(60)]
    for c, n, at in ((100, 60, 99), (105, 60, 99), (110, 45, 99), (115, 60, 30), (120, 60, 57), (125, 9, 99), (130, 8, 99), (135, 24, 99), (140, 25, 99)):
        rows += [(c, t, r, x if t < at else f"{x} of {c}") for t, r, x in long[:n]]
    for c in (1001, 1002, 1006, 1007):  # short, so that none of their own turns may be left
        rows.append((c, 0, "user", "only"))
    rows += [(500, None, "user", "null turn"), (500, 2, None, "null role"), (500, 2, "user", None), (500, 2, "user", "tie"), (500, 2, "user", "tie"), (None, 0, "user", "nobody's")]
    rows += [(-7, 0, "user", "negative"), (-5, 0, "user", "negative"), (10**12, 0, "user", "large")]
    return rows


def same(spark, rows, built, monkeypatch=None):
    turns = trie.positioned(spark.createDataFrame(rows, SCHEMA))
    lengths = turns.groupBy("conv_id").agg(trie.F.max("pos").alias("n"))
    got = trie.prefix_trie(*trie.grafted(turns)) if built else trie.prefix_trie(turns, lengths)
    convs = graft(ordered(rows)) if built else ordered(rows)
    key = lambda r: (r[1], r[0])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(convs), key=key)


def test_trie_of_rebuilt_conversations(spark):
    same(spark, conversations(), built=True)


def test_trie_over_many_blocks_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "WIDTHS", (4, 24))
    monkeypatch.setattr(trie, "PIECE_BYTES", 8)
    rows = conversations() + [(2000 + c, t, "user", f"copy {t}") for c in range(40) for t in range(3)]
    same(spark, rows, built=False)


def test_columns_empty_tables_and_very_long_texts(spark):
    none = spark.createDataFrame([], SCHEMA)
    turns = trie.positioned(none)
    assert trie.prefix_trie(*trie.grafted(turns)).collect() == []
    rows = [(1, 0, "user", "x" * 2_000_000), (2, 0, "user", "x" * 2_000_000), (3, 0, "", None)]
    wide = spark.createDataFrame([(*r, "a", "b", 1) for r in rows], SCHEMA + ", pos string, prev string, n long")
    turns = trie.positioned(wide)
    nodes = trie.prefix_trie(turns, turns.groupBy("conv_id").agg(trie.F.max("pos").alias("n")))
    got = sorted(tuple(r)[:7] for r in nodes.collect() if r.depth)
    assert got == [(1, 1, 1, 2, 0, 1, 2_000_000), (3, 1, 1, 1, 0, 1, 0)]
    assert {(r.conv_id, len(r.text)) for r in trie.node_turns(nodes, turns).where("depth = 1").collect()} == {(1, 2_000_000), (3, 0)}
    assert trie.prefix_trie(turns.where("false"), spark.createDataFrame([(4, 0), (9, 0)], "conv_id long, n long")).first()[:7] == (4, 0, None, 2, 0, 1, 0)

"""Every query that SQL can express gives the rows that DuckDB gives."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from genomill.plans.registry import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    return format(v, ".9g") if isinstance(v, float) or type(v).__name__ == "Decimal" else str(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = QUERIES[name](spark, sf)
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(map(norm, r)) for r in got.select(*[f"`{c}`" for c in columns]).collect()) == sorted(tuple(map(norm, r)) for r in want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["rlocds_id_1", "rlocds_id_2", "score"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_hot_events_and_prefixes_give_the_same_pairs(spark, sf):
    """Blocks of hot events and prefixes change the work, never a pair; fewer pairs are formed the more events are left out."""
    from genomill.operators import coevolution as co
    from genomill.plans.views import view

    events, families = view(spark, sf, "gene_lineage_events"), view(spark, sf, "lineage_families")
    for scope, least in (("between_fams", 0.5), ("within_fams", 0.4), ("all", 0.6)):
        got = [sorted(co.coevolution_scores(events, 100, families, scope, least, block, share).collect()) for block, share in ((2000, 0.0), (7, 0.0), (2000, 0.25), (7, 0.5))]
        assert got[0] and all(g == got[0] for g in got)
    side = co._side(events, families)
    formed = []
    for share in (0.0, 0.25, 0.5):
        marked, sizes = co._marked(side, share * 5000)
        formed.append(co._met(marked.where("_heavy").drop("_heavy", "_bound"), sizes, "between_fams", 2000).count())
    assert formed[0] > formed[1] > formed[2] > 0


def test_ranks_of_ties_and_nulls(spark):
    """Order statistics of a column of few values, many of them equal, against a sorted list."""
    from genomill.operators.ranks import quantiles, values_at

    values = [3.0] * 500 + [None] * 7 + [x / 8 for x in range(-40, 60)] + [1e9, -1e9]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    known = sorted(v for v in values if v is not None)
    assert values_at(df, "v", [0, 1, 300, 600, len(known) - 1, len(known)]) == {r: known[r] for r in (0, 1, 300, 600, len(known) - 1)}
    assert quantiles(df, "v", [0.0, 0.5, 1.0]) == [known[0], known[(len(known) - 1) // 2] / 2 + known[len(known) // 2] / 2, known[-1]]
    assert quantiles(df.where("v IS NULL"), "v", [0.5]) == [None]


def test_hypergeometric_tail(spark):
    """Against exact fractions, on both sides of the mean and at the ends."""
    from fractions import Fraction
    from math import comb

    from genomill.operators.counting import hypergeometric_tail

    cases = [(k, n, m, t) for t in (1, 7, 60, 5000) for n in (0, 1, t // 3, t) for m in (0, 1, t // 2, t) for k in {max(0, n + m - t), min(n, m), (n * m) // t, min(n, m, (n * m) // t + 3)}]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, k long, n long, m long, t long")
    got = {r.i: r.p for r in df.select("i", hypergeometric_tail(*map(df.__getitem__, "knmt")).alias("p")).collect()}
    for i, (k, n, m, t) in enumerate(cases):
        want = float(Fraction(sum(comb(m, x) * comb(t - m, n - x) for x in range(k, min(n, m) + 1)), comb(t, n)))
        assert abs(got[i] - want) < 1e-9 * max(want, 1e-3), (k, n, m, t)


def test_tasks_of_scores_follow_the_table(spark, sf, monkeypatch):
    """What is put in order, listed or joined for the scores is dealt over as many tasks as the rows need; no score changes."""
    from genomill.operators import coevolution as co
    from genomill.plans import coevolution as plans
    from genomill.plans import views

    want = sorted(plans.d15_coevolution_scores(spark, sf).collect())
    monkeypatch.setattr(co, "ROWS_A_TASK", 500)
    monkeypatch.setattr(views, "ROWS_A_TASK", 500)
    dealt, real = [], co._dealt
    monkeypatch.setattr(co, "_dealt", lambda df, rows, *keys: dealt.append((keys, real(df, rows, *keys).rdd.getNumPartitions())) or real(df, rows, *keys))
    assert sorted(plans.d15_coevolution_scores(spark, sf).collect()) == want
    assert {k for k, _ in dealt} == {("rlocds_id",), ("event_id",)} and all(n > 8 for _, n in dealt)


def test_lookup_of_left_out_events_follows_the_table(spark, sf, monkeypatch):
    """Events left out are looked up in as many tasks as rows and look-ups need, on both sides of the join; no score changes."""
    from genomill.operators import coevolution as co
    from genomill.plans import coevolution as plans

    want = sorted(plans.d15_coevolution_scores(spark, sf).collect())
    monkeypatch.setattr(co, "ROWS_A_TASK", 500)
    got = plans.d15_coevolution_scores(spark, sf)
    plan = got._jdf.queryExecution().analyzed().toString()
    assert [int(n) > 8 for n in re.findall(r"RepartitionByExpression \[rlocds_id_[12]#\d+L?, event_id#\d+L?\], (\d+)", plan)] == [True] * 4
    assert sorted(got.collect()) == want

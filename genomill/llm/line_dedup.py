"""Line dedup with a log-template tree: fixed-depth parsing by token count and leading tokens, variable fields generalised."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genomill.llm import common
from genomill.llm.common import cut, discard, table

WILD = "<*>"


def _tokens(line: Column) -> Column:
    """How many tokens a trimmed line has: what single blanks part."""
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _masked(text: Column) -> Column:
    """Tokens that hold a digit become wildcards. Matches begin at tokens only and never step back: long tokens cost no more than short ones."""
    return F.regexp_replace(text, "(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", WILD)


def templates(forms: DataFrame, lead: int, alike: float, least: int) -> DataFrame:
    """leaf, f, template of those of `forms` (leaf, f, form, n) whose template keeps `alike` of their tokens; f tells forms of a leaf apart.

    A token after the first `lead` is variable in its leaf if fewer than `least` of the leaf's forms, each counted n times, have it at
    its place; a form's template is what is left of it. Fields are counted by place and token over the whole leaf, by one
    aggregation: the rule is the same for a leaf of any size, and no task reads all of a leaf.
    """
    tokens = forms.select("leaf", "f", "n", F.posexplode(F.split("form", " ")).alias("at", "token")).where(F.col("token") != WILD)
    later = F.col("at") >= lead
    often = cut(tokens.where(later).groupBy("leaf", "at", "token").agg(F.sum("n").alias("_n")).where(F.col("_n") >= least).select("leaf", "at", "token"))
    fixed = tokens.where(later).join(often.hint("merge"), ["leaf", "at", "token"]).groupBy("leaf", "f").agg(F.array_sort(F.collect_list(F.struct("at", "token"))).alias("_fixed"))
    named = F.filter(F.split("form", " "), lambda x: x != WILD)
    first = F.filter(F.slice(F.split("form", " "), 1, lead), lambda x: x != WILD)
    known = forms.select("leaf", "f", F.size(named).alias("_named"), F.size(first).alias("_first")).join(fixed, ["leaf", "f"], "left")
    kept = F.col("_first") + F.coalesce(F.size("_fixed"), F.lit(0))
    return known.where(kept >= F.lit(alike) * F.col("_named") - 1e-9).select("leaf", "f", F.xxhash64(F.coalesce("_fixed", F.array().cast("array<struct<at:int,token:string>>"))).alias("template"))


def recurring_lines(docs: DataFrame, lead: int = 3, alike: float = 0.6, min_docs: int = 5) -> DataFrame:
    """doc_id, n_lines, n_dropped, text: documents without the lines whose template recurs in `min_docs` different texts.

    A line (text between line feeds, trimmed; blank ones always stay) goes down the tree by its number of tokens and its first
    `lead` tokens, tokens with a digit being wildcards. In the leaf that it comes to, a later token is a field that varies unless
    `min_docs` lines of different texts or wording have it at its place; with its varying fields taken out a line is a template, if
    `alike` of its tokens (wildcards apart) are left. Copies of one text count as one document, so that copying alone makes no
    line a template. Leaves of one text only, or of too few lines to recur, are left out before any line is moved as a whole.

    Null text: no lines, null text. Null or repeated doc_ids: rows are held apart by doc_id and text; equal rows get one
    decision. Other columns are ignored. An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    lines = docs.where("text IS NOT NULL").select(F.xxhash64("text").alias("t"), F.posexplode(F.split("text", "\n")).alias("at", "line")).select("t", "at", F.trim("line").alias("line")).where("line <> ''")
    lines = lines.withColumn("leaf", F.xxhash64(_tokens(F.col("line")), _masked(F.substring_index("line", " ", lead))))
    shared = lines.groupBy("leaf").agg(F.min("t").alias("lo"), F.max("t").alias("hi"), F.count("*").alias("lines")).where((F.col("lo") != F.col("hi")) & (F.col("lines") >= min_docs)).select("leaf")
    kept = cut(lines.join(shared.hint("shuffle_hash"), "leaf", "left_semi").select("leaf", "t", "at", _masked(F.col("line")).alias("form")).withColumn("f", F.xxhash64("form")).distinct())
    forms = cut(kept.select("leaf", "f", "form", "t").distinct().groupBy("leaf", "f", "form").agg(F.count("*").alias("n")))
    parsed = cut(templates(forms, lead, alike, min_docs))
    discard(forms)
    placed = cut(kept.select("leaf", "f", "t", "at").join(parsed.hint("merge"), ["leaf", "f"]).select("leaf", "template", "t", "at"))
    discard(kept)
    recurs = cut(placed.select("leaf", "template", "t").distinct().groupBy("leaf", "template").count().where(F.col("count") >= min_docs).select("leaf", "template"))
    gone = cut(placed.join(recurs.hint("merge"), ["leaf", "template"], "left_semi").groupBy("t").agg(F.collect_set("at").alias("gone")))
    discard(placed)
    # few lines that go, by count: they are sent to the texts; many: texts and lines meet by a shuffle
    few = (gone.agg(F.sum(F.size("gone"))).first()[0] or 0) <= common.BROADCAST_IDS
    gone = F.broadcast(gone) if few else gone.hint("merge")
    rows = docs.withColumn("t", F.xxhash64("text")).join(gone, "t", "left")
    parts = F.split("text", "\n")
    left = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains("gone", i)), "\n")
    return rows.select("doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"), F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"), F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("text"))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurring_lines(table(spark, sf_dir, "documents"))


OP10_SQL = r"""WITH u AS (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL), s AS (SELECT text, string_split(text, chr(10)) AS ls FROM u),
l AS (SELECT text, pos, trim(ls[pos], ' ') AS line FROM (SELECT text, ls, unnest(generate_series(1, len(ls))) AS pos FROM s)),
k AS (SELECT text, pos, list_transform(string_split(line, ' '), lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN '<*>' ELSE w END) AS ws FROM l WHERE line <> ''),
y AS MATERIALIZED (SELECT text, pos, ws, array_to_string(ws, ' ') AS form, len(ws) || ' ' || array_to_string(ws[1:3], ' ') AS leaf FROM k),
f AS (SELECT leaf, form, any_value(ws) AS ws, count(DISTINCT text) AS n FROM y GROUP BY 1, 2),
w AS (SELECT leaf, form, n, i, ws[i] AS w FROM (SELECT *, unnest(generate_series(4, len(ws))) AS i FROM f) WHERE ws[i] <> '<*>'),
o AS (SELECT leaf, i, w FROM w GROUP BY 1, 2, 3 HAVING sum(n) >= 5),
x AS (SELECT leaf, form, string_agg(i || ' ' || w, chr(10) ORDER BY i) AS template, count(*) AS c FROM w JOIN o USING (leaf, i, w) GROUP BY 1, 2),
p AS (SELECT f.leaf, f.form, coalesce(template, '') AS template FROM f LEFT JOIN x USING (leaf, form) WHERE len(list_filter(ws[1:3], lambda z: z <> '<*>')) + coalesce(c, 0) >= 0.6 * len(list_filter(ws, lambda z: z <> '<*>')) - 1e-9),
c AS (SELECT leaf, template FROM y JOIN p USING (leaf, form) GROUP BY 1, 2 HAVING count(DISTINCT text) >= 5),
g AS (SELECT text, list(pos) AS gone FROM y JOIN p USING (leaf, form) JOIN c USING (leaf, template) GROUP BY 1)
SELECT doc_id, coalesce(len(string_split(d.text, chr(10))), 0) AS n_lines, coalesce(len(gone), 0) AS n_dropped, CASE WHEN gone IS NULL THEN d.text ELSE array_to_string(list_filter(string_split(d.text, chr(10)), lambda z, i: NOT list_contains(gone, i)), chr(10)) END AS text FROM documents d LEFT JOIN g ON g.text = d.text"""

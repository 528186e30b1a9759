"""The corpus operators against brute force, and with nulls, empty tables, repeated rows and clashing columns."""

import re
import zlib

import numpy as np
import pytest

from genomill.llm import common, decontaminate, html_text, langid, line_dedup, mixing, near_dedup, neighbours, passages, sharding, token_ids

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text, pattern):
    return re.findall(pattern, (text or "").encode().lower())


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(3)
    vocab = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 7))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(vocab, n))
    base, passage = text(120).split(), text(60)
    rows = [(i, text(int(rng.integers(1, 90))), "en", "s0") for i in range(30)]
    rows += [(100 + i, " ".join(base), "en", "s1") for i in range(4)]
    for i in range(12):
        own = list(base)
        own[int(rng.integers(120))] = f"edit{i}"
        rows.append((200 + i, " ".join(own), "en", None))
    rows += [(300 + i, f"{text(40)} {passage} {text(30)}", "fr", "s2") for i in range(5)]
    rows += [(400, None, None, None), (401, "", "en", "s0"), (402, " \n\t ", "en", "s0"), (403, "12 34", None, "s0"), (None, "null id " + text(20), "en", "s0"), (405, "x" * 3000, "en", "s0")]
    rows += [(7, rows[7][1], "en", "s0")]  # a repeated row
    return spark.createDataFrame([(*r, None) for r in rows], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def component(links, ids):
    best = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(best[a], best[b])
            if best[a] != m or best[b] != m:
                best[a] = best[b] = m
                changed = True
    return best


def test_near_duplicates(docs, none):
    rows = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    sets = {}
    for i, t in rows.items():
        w = words(t, rb"[^\x20\x09-\x0D]+")
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    links = [(a, b) for a in rows for b in rows if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = component(links, rows)
    got = near_dedup.near_duplicates(docs.withColumnsRenamed({"lang": "kept", "source": "component"})).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is None:
            assert r.kept and r.component_id is None
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)
    assert near_dedup.near_duplicates(none).collect() == []


def test_crossing_blocks_find_every_link(spark, monkeypatch):
    """Every link is kept by a path, whichever blocks its ends lie in, and no more rows come out than a forest a pair of blocks has."""
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    monkeypatch.setattr(near_dedup, "COLUMNS", 2)
    held = lambda i: np.arange(4 * (i // 3), 4 * (i // 3) + 4, dtype=np.uint64).tobytes()
    rows = [(1, 0, 12, 48, i, i, bytes([7, 7, 7, 7]), held(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "band long, number int, size long, weight long, node long, label long, sig binary, shingles binary")
    links = [(r.a, r.b) for r in near_dedup._crossing(df, 2, 1.0, 75).collect()]
    assert all(a // 3 == b // 3 for a, b in links)
    assert component(links, range(12)) == {i: i - i % 3 for i in range(12)}
    one_label = df.withColumn("label", near_dedup.F.lit(0).cast("long"))
    assert near_dedup._crossing(one_label, 2, 1.0, 75).collect() == []


def test_full_sets_go_only_to_the_bands_of_candidates(spark, monkeypatch):
    """Nodes that meet in many bands are candidates in the first: full sets are sent once for it, and every link is found."""
    rng = np.random.default_rng(5)
    sig = [bytes([g] * 38 + [i, 9]) for i in range(6) for g in (1, 2)]  # two groups; 19 bands of two bytes in common, the last apart
    sig += [bytes([1] * 2 + list(rng.integers(10, 250, 38))) for _ in range(4)]  # these meet the first group in one band, but are no candidates
    whole = rng.integers(1, 1 << 62, 40).astype(np.uint64)
    sets = [np.sort(np.append(whole, np.uint64(i))).tobytes() for i in range(16)]
    bands = {}
    for node, s in enumerate(sig):
        for number in range(19):
            bands.setdefault((number, s[2 * number : 2 * number + 2]), []).append(node)
    rows = [(hash(k), k[0], len(own), len(own) * 41, node, node, sig[node], sets[node]) for k, own in bands.items() if len(own) > 1 for node in own]
    df = spark.createDataFrame(rows, "band long, number int, size long, weight long, node long, label long, sig binary, shingles binary")
    sent, real = [], near_dedup.cut
    monkeypatch.setattr(near_dedup, "cut", lambda x: sent.append(real(x)) or sent[-1])
    links = [(r.a, r.b) for r in near_dedup._crossing(df, 2, 0.65, 75).collect()]
    root = list(range(16))
    for a, b in links:
        root = [root[a] if x == root[b] else x for x in root]
    assert len(set(root[:12:2])) == len(set(root[1:12:2])) == 1 and len(set(root)) == 6
    assert len(rows) > 200 and sent[0].count() == 12


def near_copies(rng, groups, size, n_words, edits, first=0):
    """Groups of texts of which each has some words changed: similarities lie about the threshold."""
    rows = []
    for g in range(groups):
        base = [f"w{x}" for x in rng.integers(0, 5000, n_words)]
        for i in range(size):
            own = list(base)
            for at in rng.integers(0, n_words, int(rng.integers(0, edits + 1))):
                own[at] = f"e{g}x{i}x{at}"
            rows.append((first + g * size + i, " ".join(own)))
    return rows


@pytest.mark.parametrize("broadcast", [0, 1_000_000])
def test_large_group_of_near_copies(spark, monkeypatch, broadcast):
    monkeypatch.setattr(common, "BROADCAST_IDS", broadcast)
    rows = near_copies(np.random.default_rng(5), 2, 150, 120, 5)
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert 300 < len(links) < 20_000
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == component(links, sets)


def test_near_duplicate_stage_keeps_one_row_of_each_group(spark, docs, none):
    extra = [(7, "a clean text of its own under a doc_id that repeats with ten words", "en", "s0", None), (2000, "nothing else is like this one", "en", None, None), (2000, "nothing else is like this one", "en", None, None)]
    both = docs.union(spark.createDataFrame(extra, DOCS)).withColumnRenamed("lang", "component_id")
    got = near_dedup.stage_minhash(spark, both, "")
    assert got.columns == both.columns
    want, seen = [], set()
    groups = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs.dropDuplicates()).collect()}
    for r in both.collect():
        key = (r.doc_id, r.text)
        blank = r.text is None or not r.text.split()
        if r.doc_id is None or blank or groups.get(r.doc_id, r.doc_id) == r.doc_id and key not in seen:
            want.append(key)
        seen.add(key)
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(str, want))
    assert near_dedup.stage_minhash(spark, none, "").collect() == []


def test_decontaminate(spark, docs, none):
    rows = docs.collect()
    passage = next(r.text for r in rows if r.doc_id == 300)
    items = [("a", " ".join(passage.split()[45:60]).upper()), ("b", "edit3"), ("c", None), (None, passage), ("d", "not there at all"), ("b", "edit3"), ("e", "12 34")]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    pattern = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    found = {(r.doc_id, r.text): r for r in decontaminate.find_benchmark(docs.withColumnRenamed("lang", "_hits"), benchmark).collect()}
    split = {(r.doc_id, r.text): r for r in decontaminate.find_benchmark(docs, benchmark, max_words_a_pass=20).collect()}
    for r in rows:
        w, hit, names = words(r.text, pattern), set(), set()
        for item, t in items:
            p = words(t, pattern)
            if item is None or not p:
                continue
            for window in [p[i : i + 10] for i in range(max(1, len(p) - 9))]:
                for i in range(len(w) - len(window) + 1):
                    if w[i : i + len(window)] == window:
                        hit |= set(range(i, i + len(window)))
                        names.add(item)
        for got in (found[r.doc_id, r.text], split[r.doc_id, r.text]):
            spans = {x for a, b in zip(got._hits[::2], got._hits[1::2], strict=True) for x in range(a, b)}
            assert (got._n_words, spans, got._items) == (len(w), hit, sorted(names))
    assert decontaminate.find_benchmark(none, benchmark).collect() == []
    assert all(not r._hits for r in decontaminate.find_benchmark(docs, benchmark.limit(0)).collect())


def test_langid(spark, sf, docs, none):
    got = langid.op6_langid(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) >= 0.95
    assert all(0 <= r.score <= 1 for r in got)
    model = langid.fit(docs)
    by_id = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert all(by_id[i].lang_pred == "und" and by_id[i].rejected for i in (400, 401, 402, 403))
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(none)).collect()} == {"und"}
    assert langid.predict(none, model).collect() == []


def test_langid_rejects_what_it_has_not_learned(spark, sf):
    labelled = spark.read.parquet(f"{sf.rpartition('/')[0]}/sf0.01/documents.parquet")
    model = langid.fit_on_folds(labelled)
    rng = np.random.default_rng(6)
    junk = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz     "), n)) for n in (200, 1000, 5000, 50_000)]
    finnish = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. "
    junk += [finnish * 4, finnish * 10, "Съешь ещё этих мягких французских булок, да выпей чаю. " * 3]
    odd = spark.createDataFrame(list(enumerate(junk)), "doc_id long, text string")
    assert [r.doc_id for r in langid.predict(odd, model).where("NOT rejected").collect()] == []
    kept = langid.predict(labelled, model).where("NOT rejected").count()
    assert kept == labelled.where("lang IS NOT NULL AND text RLIKE '[a-zA-Z]'").count()


def test_sharding(docs, none):
    limit = 900
    rows = sharding.shard(docs.withColumnRenamed("lang", "shard"), limit).collect()
    assert len(rows) == docs.count()
    sizes, depth = {}, {}
    for r in rows:
        sizes.setdefault((r.shard, r.shard_part), []).append(len((r.text or "").encode()))
        depth[r.shard] = r.shard_depth
    assert all(sum(s) <= limit or len(s) == 1 for s in sizes.values())
    names = sorted(depth)
    assert all(not (a != b and b.startswith(a)) for a in names for b in names)
    assert sharding.shard(none, limit).collect() == []
    repeated = docs.where("doc_id = 100").crossJoin(docs.sparkSession.range(9).select())
    parts = sharding.shard(repeated, 2000).groupBy("shard", "shard_part").count().collect()
    assert sum(p["count"] for p in parts) == 9 and all(p["count"] <= 3 for p in parts)


def test_mixing(docs, none):
    rows = mixing.mix(docs, max_epochs=2.0, block_tokens=100).collect()
    seen = {(r.doc_id, r.text) for r in rows}
    assert seen == {(r.doc_id, r.text) for r in docs.collect()}  # nothing is lost
    tokens, shown = {}, {}
    n = lambda t: len((t or "").split())
    for r in docs.collect():
        tokens[r.source] = tokens.get(r.source, 0) + n(r.text)
    for r in rows:
        shown[r.source] = shown.get(r.source, 0) + n(r.text)
    epochs = {s: shown[s] / tokens[s] for s in tokens}
    assert max(epochs.values()) <= 2.0 and 1.0 <= min(epochs.values()) <= 1.05
    assert mixing.mix(none).collect() == []
    alpha = mixing.temperature(docs.sparkSession.createDataFrame([("a", 900), ("b", 100)], "_s string, _tokens long"), entropy=0.5)
    p = np.array([0.9, 0.1]) ** alpha
    p /= p.sum()
    assert abs(-(p * np.log(p)).sum() - 0.5) < 1e-4


def test_token_ids(spark, docs, none, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_ids.vocabulary_path())
    odd = docs.union(spark.createDataFrame([(500, "It's <|endoftext|> NAÏVE, été… don't\x1cSTOP 12,5% (x)", None, None, None)], DOCS))
    path = str(tmp_path / "ids")
    token_ids.write_ids(odd, path, block_ids=300)
    got = sorted(token_ids.positions(token_ids.read_ids(spark, path)).collect(), key=lambda r: (r.start, r.n_tokens))
    want = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    start = 0
    for g, w in zip(got, want, strict=True):
        ids = tokenizer.encode(w.text or "", add_special_tokens=False).ids + [1]
        assert (g.doc_id, g.start, g.n_tokens, list(np.frombuffer(g.ids, "<u4"))) == (w.doc_id, start, len(ids), ids)
        start += len(ids)
    token_ids.write_ids(none, str(tmp_path / "none"))
    assert token_ids.read_ids(spark, str(tmp_path / "none")).collect() == []


def test_repair_random_access():
    rng = np.random.default_rng(1)
    ids = rng.choice(12, 20_000)  # 144 pairs, each of them frequent
    packed = token_ids.pack([1, 2], [12_000, 8_000], ids, 1 << 16)
    block = token_ids.Block({"part": 0, "block": 0, **packed}, 1 << 16)
    assert len(block.body) < 0.8 * len(ids) and packed["crc"] == zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
    assert (block.document(0) == ids[:12_000]).all() and (block.document(1) == ids[12_000:]).all() and (block.ids(777, 801) == ids[777:801]).all()


def test_repair_leaves_no_frequent_pair():
    rng = np.random.default_rng(4)
    passage = np.concatenate([np.tile(rng.integers(0, 40_000, 64), (2000, 1)), rng.integers(0, 40_000, (2000, 1))], axis=1).ravel()
    many = np.repeat(rng.permutation(9000 * 2).reshape(-1, 2), 24, axis=0)[rng.permutation(9000 * 24)].ravel()  # more frequent pairs than once fitted into a round
    for ids in (passage, many, np.full(5000, 7), rng.choice(12, 20_000), np.array([], int), np.array([3])):
        rules, body = token_ids.repair(ids, 1 << 16)
        assert (token_ids.expand(body, rules, 1 << 16) == ids).all()
        uses, last, end = {}, None, -1
        for i, pair in enumerate(zip(body.tolist(), body[1:].tolist())):
            if pair != last or i != end + 1:
                uses[pair] = uses.get(pair, 0) + 1
                last, end = pair, i
            else:
                last = None
        assert max(uses.values(), default=0) < 24
    assert len(token_ids.repair(passage, 1 << 16)[1]) < 5000 and len(token_ids.repair(many, 1 << 16)[1]) == 9000 * 24


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 8))
    x[100:130] = x[5]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(700, None), (720, [0.0] * 8), (740, [1.0] * 3), (760, [float("nan")] * 8), (780, [None] * 8), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(df, k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = 0
    for q in range(0, 600, 20):
        s = x @ x[q]
        want = [i for i in np.lexsort((np.arange(600), -np.round(s, 12))) if i != q][:5]
        hits += len(set(want) & {v for v, _ in got[q]})
        assert all(abs(score - s[v]) < 1e-12 for v, score in got[q]) and len(got[q]) == 5
    assert set(got) == set(range(0, 600, 20)) and hits >= 0.9 * 5 * len(got)
    assert neighbours.nearest(df.limit(0)).collect() == []
    assert neighbours.nearest(df.where("vec_id = 0")).collect() == []


def test_html():
    stop = frozenset(w for t in html_text.STOP_WORDS.values() for w in t.split())
    long = "The cat and the dog are in the house with all of their friends, and they have been there for a long time now."
    page = f"<html><head><title>T</title><script>var a='</p>';</script></head><body><nav><a href=x>Home</a></nav><div class='cookie-notice'>We use it.</div><article><h1>Head &amp; line</h1><p>{long}<br>Next   <b>bo</b>ld<p>Short.</p><aside>Related: {long}</aside><div id=comments><p>{long}</p></div></article><footer>&copy; 2020 {long}</footer>"
    assert html_text.main_text(page, stop) == f"Head & line\n{long} Next bold\nShort."
    assert html_text.main_text(f"<div><p>{long}</p><p>{long}</p><p><a href=y>{long}</a></p></div>", stop) == f"{long}\n{long}"
    assert html_text.main_text(None, stop) == html_text.main_text("", stop) == ""


LONG = "The cat and the dog are in the house with all of their friends, and they have been there for a long time now."


def test_html_marks_quotes_and_teasers():
    stop = frozenset(w for t in html_text.STOP_WORDS.values() for w in t.split())
    page = f"<article><div class='entry-header'><h1>Title</h1></div><div class='search-results-intro'><p>{LONG}</p></div><div class='cookie-box'>{LONG}</div></article><div class='site-header'>{LONG}</div>"
    assert html_text.main_text(page, stop) == f"Title\n{LONG}"
    assert html_text.main_text(f'<p class="x>{LONG}</p><p title="a > b" data-x=\'<i>\'>{LONG}</p>', stop) == f"{LONG}\n{LONG}"
    teasers = "".join(f"<article><h3>Card {i}</h3></article>" for i in range(4))
    assert LONG in html_text.main_text(f"<body>{teasers}<div><p>{LONG}</p><p>{LONG}</p></div></body>", stop)
    for odd in ("<a " * 20_000, "<div>" * 20_000 + "</b>" * 20_000, "<p class=\"" * 20_000, "<" * 50_000, "<!-- " * 20_000):
        html_text.main_text(odd + LONG, stop)  # time in proportion to length


def test_html_tables(spark):
    rows = [(1, "u", f"<article><p>{LONG}</p></article>", 5), (1, "u", f"<article><p>{LONG}</p></article>", 5), (None, None, None, None), (2, "v", "", 1), (3, "w", f"<article><p>{(LONG + ' ') * 3000}</p></article>", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    got = html_text.extract_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == 5
    found = {(r.page_id, r.text[:20], r.n_chars) for r in got.collect()}
    assert found == {(1, LONG[:20], len(LONG)), (None, "", 0), (2, "", 0), (3, LONG[:20], 3000 * (len(LONG) + 1) - 1)}
    assert html_text.extract_text(pages.limit(0)).collect() == []


def test_masked_tokens_cost_no_more_when_long(spark):
    rows = [("x" * 400_000 + " a1 2 b",), ("a1b c-3 d",), ("",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "line string").select(line_dedup._masked(line_dedup.F.col("line"))).collect()]
    assert got == ["x" * 400_000 + " <*> <*> b", "<*> <*> d", "", None]


def test_lines_against_brute_force(spark):
    """Forms that differ in fields with digits alone: a template is a masked line, and recurs if five different texts hold it."""
    rng = np.random.default_rng(4)
    stems = [" ".join(f"w{chr(97 + int(x))}" for x in rng.integers(0, 26, int(rng.integers(4, 9)))) for _ in range(40)]
    texts = []
    for i in range(50):
        lines = [f"{stems[int(rng.zipf(1.5)) % 40]} id{rng.integers(1000)}" if rng.random() < 0.8 else "  " for _ in range(int(rng.integers(0, 8)))]
        texts.append("\n".join(lines))
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(texts)] + [(3, texts[3], "x", 1, "y"), (None, texts[4], "x", 1, "y"), (99, None, "x", 1, "y")]
    mask = lambda line: " ".join("#" if any(c.isdigit() for c in w) else w for w in line.strip(" ").split(" "))
    seen = {}
    for t in set(texts):
        for line in t.split("\n"):
            if line.strip(" "):
                seen.setdefault(mask(line), set()).add(t)
    gone = {m for m, where in seen.items() if len(where) >= 5}
    assert 3 < len(gone) < len(seen)
    want = sorted((str(i), None if t is None else "\n".join(x for x in t.split("\n") if mask(x) not in gone)) for i, t, *_ in rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, leaf string, at int, gone string")
    got = line_dedup.recurring_lines(df, alike=1.0).collect()
    assert sorted(((str(r.doc_id), r.text) for r in got), key=str) == sorted(want, key=str)


def test_templates_with_varying_words_against_brute_force(spark, monkeypatch):
    """Words that vary make fields: leaves of few and of many forms, by a plain loop over all lines."""
    rng = np.random.default_rng(6)
    word = lambda n: "".join(rng.choice(list("abcdefghij"), n))
    rows = [(i, f"posted in the {word(4)} by {word(5)} on day {rng.integers(99)}\n{word(5)} {word(3)}") for i in range(40)]
    rows += [(100 + i, "one two three " + " ".join(word(2) if rng.random() < 0.9 else "often" for _ in range(7))) for i in range(600)]  # one leaf, hardly alike
    rows += [(800 + i, f"a b c {word(4)} {'same' if i % 2 else 'other'} end") for i in range(30)]
    lead, alike, least = 3, 0.6, 5
    mask = lambda line: tuple("<*>" if any(c.isdigit() for c in w) else w for w in line.split(" "))
    forms = {}
    for i, text in rows:
        for line in text.split("\n"):
            forms.setdefault(mask(line), set()).add(text)
    leaf = lambda f: (len(f), f[:lead])
    often = {}
    for f, where in forms.items():
        for at, w in enumerate(f):
            often[leaf(f), at, w] = often.get((leaf(f), at, w), 0) + len(where)
    where_of = {}
    template = {}
    for f, where in forms.items():
        fixed = tuple((at, w) for at, w in enumerate(f) if w != "<*>" and (at < lead or often[leaf(f), at, w] >= least))
        if len(fixed) >= alike * sum(w != "<*>" for w in f) - 1e-9:
            template[f] = (leaf(f), fixed)
            where_of.setdefault(template[f], set()).update(where)
    gone = {f for f in template if len(where_of[template[f]]) >= least}
    want = {i: "\n".join(x for x in t.split("\n") if mask(x) not in gone) for i, t in rows}
    for bound in (common.BROADCAST_IDS, 0):
        monkeypatch.setattr(common, "BROADCAST_IDS", bound)
        got = {r.doc_id: r.text for r in line_dedup.recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == want
    assert all("posted" not in want[i] and want[i] for i in range(40)) and sum(not t for t in want.values()) < 60


def test_clashing_columns_pass_through(spark):
    names = ["doc_id", "text", "source", "_h", "_n", "_s", "_b", "_bytes", "_part", "h"]
    rows = [(i, f"word {i} " * 30, None if i % 3 else "s", *[7 + i] * 7) for i in range(20)] + [(None, None, None, *[1] * 7), (None, "a b", "s", *[2] * 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} long" for n in names[3:]))
    for got in (sharding.shard(df, 500), mixing.mix(df, max_epochs=1.5, block_tokens=50)):
        assert got.columns[: len(names)] == names
        assert {tuple(r)[: len(names)] for r in got.collect()} == set(rows)
    benchmark = spark.createDataFrame([("b", "word 3 word 3")], "item_id string, text string")
    found = decontaminate.find_benchmark(df, benchmark, 3)
    assert {r.doc_id for r in found.where("size(_hits) > 0").collect()} == {3} and {r["_h"] for r in found.collect()} == {r[3] for r in rows}


def test_lines(docs, none):
    spark = docs.sparkSession
    rows = [(i, f"{chr(97 + i) * 5} only here some words\n\nError 40{i} at host{i} in module core now") for i in range(6)] + [(9, None), (10, "")]
    got = {r.doc_id: r for r in line_dedup.recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].n_dropped == 1 and got[i].text.endswith("words\n") and got[i].n_lines == 3 for i in range(6))
    assert got[9].text is None and got[10].text == "" and got[9].n_dropped == got[10].n_dropped == 0
    assert line_dedup.recurring_lines(none).collect() == []
    copies = spark.createDataFrame([(i, "the same text\nfor all of them") for i in range(20)], "doc_id long, text string")
    assert all(r.n_dropped == 0 for r in line_dedup.recurring_lines(copies).collect())


def test_passages(docs, none):
    found = passages.repeated_passages(docs).collect()
    assert {r.doc_id for r in found} >= {301, 302, 303, 304, 101, 102, 103}
    assert not {r.doc_id for r in found} & {*range(30), 100, 300}
    assert all(r.end_word - r.start_word >= 60 for r in found if r.doc_id in (301, 302))
    assert passages.repeated_passages(none).collect() == []


def test_passages_of_sentences_with_other_first_holders(spark):
    rng = np.random.default_rng(8)
    word = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 10**9, n))
    rows, pairs = [], {}
    for i in range(60):
        one, two = word(30), word(30)
        own = [word(20) for _ in range(4)]
        rows += [(4 * i, f"{own[0]} {one} {own[1]}"), (4 * i + 1, f"{own[2]} {two} {own[3]}")]
        rows += [(4 * i + 2 + j, f"{word(20)} {one} {two} {word(20)}") for j in range(2)]
        pairs[4 * i + 3] = 4 * i + 2
    rows += [(1000, f"{word(5)} {(long := word(700))}"), (1001, long)]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found if r.src_doc_id == pairs.get(r.doc_id) and r.end_word - r.start_word >= 60} == set(pairs)
    assert any(r.doc_id == 1001 and r.end_word - r.start_word == 700 for r in found)


def test_passages_parted_by_long_differences(spark):
    """Two documents share stretches that differences of 20 and more words part: each stretch is reported, whole."""
    rng = np.random.default_rng(18)
    word = lambda n: [f"w{i}" for i in rng.integers(0, 10**9, n)]
    shared = [word(60), word(50), word(75), word(46)]
    mine, theirs, want = word(7), word(3), []
    for i, x in enumerate(shared):
        want.append((len(mine), len(mine) + len(x), len(theirs), len(theirs) + len(x)))
        mine, theirs = mine + x + word(20 + 15 * i), theirs + x + word(20 + 40 * (i % 2))
    rows = [(5, " ".join(theirs), 1), (9, " ".join(mine), 2), (9, " ".join(mine), 3), (None, " ".join(mine), 4), (11, None, 5), (12, "", 6)]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string, first long")).collect()
    assert sorted((r.start_word, r.end_word, r.src_start, r.src_end) for r in found) == want
    assert all((r.doc_id, r.src_doc_id, r.identity) == (9, 5, 1.0) for r in found)


def test_passages_against_all_exact_runs(spark):
    """Brute force: each 45 words that an earlier document has too lie inside a reported passage, and no passage is made up."""
    rng = np.random.default_rng(28)
    word = lambda n: [f"w{i}" for i in rng.integers(0, 400, n)]
    stock = [word(int(rng.integers(20, 90))) for _ in range(12)]
    texts = []
    for _ in range(60):
        own = []
        for _ in range(int(rng.integers(1, 6))):
            own += word(int(rng.integers(5, 60))) + (stock[int(rng.integers(12))] if rng.random() < 0.7 else [])
        texts.append(own)
    texts += [list(texts[3]), texts[5] + word(4000) + texts[6]]
    found = passages.repeated_passages(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")).collect()
    spans = {}
    for r in found:
        spans.setdefault(r.doc_id, []).append((r.start_word, r.end_word))
        a, b = texts[r.doc_id][r.start_word : r.end_word], texts[r.src_doc_id][r.src_start : r.src_end]
        assert r.src_doc_id < r.doc_id and (a[0], a[-1]) == (b[0], b[-1]) and len(a) >= 45
    before, n = set(), 0
    for i, t in enumerate(texts):
        own = [tuple(t[j : j + 45]) for j in range(len(t) - 44)]
        for j, x in enumerate(own):
            if x in before:
                n += 1
                assert any(a <= j and j + 45 <= b for a, b in spans.get(i, [])), (i, j)
        before |= set(own)
    assert n > 1000


def test_passages_whose_seeds_have_other_first_holders(spark):
    """Brute force: the words of each passage that all shared seeds of any two documents lead to lie in a found passage."""
    rng = np.random.default_rng(38)
    word = lambda n: [f"w{i}" for i in rng.integers(0, 10**9, n)]
    texts = []
    for case in range(20):
        parts = [word(24) for _ in range(3)]
        whole = [w for p in parts for w in p]
        texts += [word(30) + p + word(30) for p in parts]
        texts += [word(20) + parts[0] + word(40) + parts[1] + word(40) + parts[2] + word(20)]
        texts.append(word(40) + whole + word(40))
        own = [w if i % 9 != 4 else f"x{case}.{i}" for i, w in enumerate(whole)]
        around = word(46), word(110)
        texts.append(word(10) + around[0] + own + around[1] + (around[0] + own + around[1] if case % 2 else []) + word(9))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    found, covered = passages.repeated_passages(docs).collect(), {}
    for r in found:
        assert r.src_doc_id < r.doc_id and r.identity >= 0.8 and r.end_word - r.start_word >= 45
        covered.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    places, both, n = {}, {}, 0
    for r in passages.seeds(docs, 6, 10, 16, 36, 45, 108).collect():
        places.setdefault(r.h, []).append((r.doc, r.at))
    for own in places.values():
        for d, x in own:
            for e, y in own:
                if e < d:
                    both.setdefault((d, e), []).append((x, y))
    for (d, e), at in both.items():
        x, y = np.array(at).T
        for c in passages.chain(x, y, 0.02):
            if x[c].max() + 6 - x[c].min() >= 19:
                for a, b, a2, b2, same, _ in passages._parts(texts[d], texts[e], list(zip(x[c].tolist(), y[c].tolist(), strict=True)), np.zeros(len(texts[d]), bool), 12, 3):
                    if b - a >= 45 and same >= 0.8 * max(b - a, b2 - a2):
                        n += 1
                        assert covered.get(d, set()) >= set(range(a, b)), (d, e, a, b)
    assert n >= 5


def test_chain_is_the_best_one():
    x, y = np.array([1, 2, 3, 4, 50]), np.array([10, 11, 5, 13, 60])
    assert [c.tolist() for c in passages.chain(x, y, 0.002)] == [[0, 1, 3, 4], [2]]
    assert [c.tolist() for c in passages.chain(x, y, 0.02)][0] == [0, 1, 3]  # the gap costs more than the last match gains


def test_encoder_gives_the_tokenizers_ids_whatever_its_tables_hold(spark, sf):
    encoder = token_ids.Encoder(token_ids.vocabulary_path())
    encoder.MOST = 3_000  # tables are cleared again and again
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    texts += [None, "", " ", "It's we'll O'Neil's", "ÉCOLE naïve é", "a1b2 (x) --y-- <|endoftext|>", "İstanbul ǅ ß", "one two three\x1ffour", "日本語 text"]
    for at in range(0, len(texts), 10):
        part = texts[at : at + 10]
        assert [x.tolist() for x in encoder.encode(part)] == [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in part]
    assert encoder.direct and len(encoder.index) < 20_000


def test_cut_tables_leave_no_shuffle_files(spark):
    """Shuffle files of what is written go when the write ends, so that an operator of many steps holds those of one."""
    import time
    from pathlib import Path

    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    held = lambda: {p.name for f in folders for p in Path(f).rglob("shuffle_*.data")}
    before = held()
    done = common.cut(spark.range(1000).repartition(7, "id"))
    for _ in range(50):  # executors are told, not waited for
        if held() <= before:
            break
        time.sleep(0.1)
    assert held() <= before
    assert done.count() == 1000
    common.discard(done)

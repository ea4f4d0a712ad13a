"""Repeated words and bytes, similar documents, quality, fingerprints, pages, toxicity and mixing on
small tables, against brute force."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest

pytest.importorskip("starmart.llm.queries")
from pyspark.sql import functions as F  # noqa: E402

from checks.compare import connect, difference  # noqa: E402
from starmart.llm import jaccard, merkle, mixing, pages, quality, queries, repeats, substrings, toxicity  # noqa: E402
from starmart.llm.common import SHUFFLE_CLEANUP  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def words(text) -> list[str]:
    return WORD.findall(text or "")


def corpus() -> list[tuple]:
    """Copies, near copies, a passage that many share, periodic and very long texts, nulls and ties."""
    made = random.Random(5)
    vocabulary = ["w%d" % i for i in range(400)] + ["é%d," % i for i in range(50)]
    text = lambda n: " ".join(made.choice(vocabulary) for _ in range(n))
    passage, base = text(60), text(150).split()
    rows = [(i, text(made.randint(1, 120))) for i in range(0, 60, 2)]
    rows += [(100 + i, f"{text(20)}\n{passage}  {text(20)}") for i in range(12)]
    for i in range(25):
        near = list(base)
        for _ in range(made.randint(0, 4)):
            near[made.randrange(len(near))] = made.choice(vocabulary)
        rows.append((200 + i, " ".join(near)))
    rows += [(300 + i, "Same short text here now and again " * 4) for i in range(8)]
    rows += [(400, "spam " * 300), (401, "abc" * 400), (402, ""), (403, None), (404, " \n\t"), (405, text(6000)), (406, "one two"), (407, "ONE two"), (408, "one")]
    rows += [(None, passage), (None, None), (300, "Same short text here now and again " * 4)]
    return [(k, t, "src", None) for k, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), "doc_id long, text string, key string, batch string").repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


def test_words_of_smaller_documents_go(docs, empty):
    rows = [(k, words(t)) for k, t, *_ in corpus()]
    place = lambda k: float("inf") if k is None else k
    first: dict = {}
    for k, w in rows:
        for j in range(len(w) - 12):
            window = tuple(w[j : j + 13])
            first[window] = min(first.get(window, float("inf")), place(k))
    expected = []
    for k, w in rows:
        gone = set()
        for j in range(len(w) - 12):
            if first[tuple(w[j : j + 13])] < place(k):
                gone.update(range(j, j + 13))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        expected.append((str(k), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = substrings.dedupe(docs, digests=True).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted(expected)
    carried = substrings.dedupe(docs, carry=["key", "batch"])
    assert carried.columns == ["doc_id", "n_words", "n_removed", "kept", "key", "batch"]
    untouched = {r.doc_id: r.kept for r in carried.filter("n_removed = 0").collect()}
    assert untouched[404] == " \n\t" and untouched[403] == ""
    assert substrings.dedupe(empty).count() == 0


def test_bytes_of_repeated_strings_go(docs, empty):
    rows = [(k, (t or "").encode()) for k, t, *_ in corpus()]
    counts = Counter(t[j : j + 200] for _, t in rows for j in range(len(t) - 199))
    expected = []
    for k, t in rows:
        gone = np.zeros(len(t), dtype=bool)
        for j in range(len(t) - 199):
            if counts[t[j : j + 200]] > 1:
                gone[j : j + 200] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        expected.append((str(k), len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    got = repeats.dedupe(docs, digests=True).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(expected)
    assert repeats.dedupe(empty).count() == 0


def test_small_suffix_ranks():
    made = random.Random(3)
    for _ in range(40):
        sequences = [[made.randint(1, 2) for _ in range(made.randint(1, 40))] for _ in range(made.randint(1, 8))]
        symbols = np.array([x for s in sequences for x in s])
        ends = np.repeat(np.cumsum([len(s) for s in sequences]), [len(s) for s in sequences])
        suffixes = [s[i:] for s in sequences for i in range(len(s))]
        assert repeats.suffix_ranks(symbols, ends).tolist() == [sum(o < s for o in suffixes) for s in suffixes]


def test_fm_index_counts_occurrences():
    made = random.Random(4)
    sequences = [[b"%d" % made.randint(0, 3) for _ in range(made.randint(5, 30))] for _ in range(20)]
    index = substrings.FMIndex(sequences)
    for _ in range(50):
        s = made.randrange(20)
        a = made.randrange(len(sequences[s]) - 2)
        low, high = index.intervals(np.array([index.begins[s] + a]), 3)
        pattern = sequences[s][a : a + 3]
        assert high[0] - low[0] == sum(x[i : i + 3] == pattern for x in sequences for i in range(len(x) - 2))


def components(rows: list[tuple]) -> dict:
    sets = defaultdict(set)
    for i, (k, t) in enumerate(rows):
        w = words((t or "").translate(LOWER))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if None in (rows[i][0], rows[j][0]):
                continue
            a, b = sets[i], sets[j]
            if rows[i][0] == rows[j][0] or (a & b and 100 * len(a & b) >= 75 * len(a | b)):
                parent[find(i)] = find(j)
    smallest: dict = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            smallest[find(i)] = min(smallest.get(find(i), k), k)
    return Counter((str(k), len(sets[i]), None if k is None else smallest[find(i)]) for i, (k, _) in enumerate(rows))


def test_components_equal_brute_force(docs, empty):
    expected = components([(k, t) for k, t, *_ in corpus()])
    assert Counter((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard.join(docs).collect()) == expected
    assert jaccard.join(empty).count() == 0


def test_rules_equal_brute_force(docs, empty):
    for k, t, *_ in corpus():
        w = words(t)
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        many = Counter(windows)
        covered = {p for i, x in enumerate(windows) if many[x] > 1 for p in range(i, i + 5)}
        seen: set = set()
        repeated = 0
        for line in (t or "").split("\n"):
            if words(line):
                repeated += line in seen
                seen.add(line)
        symbols = len(re.findall(r"[#*$%&|<>]", t or ""))
        assert quality.rules((t or "").encode()) == (len(w), sum(map(len, w)), symbols, repeated, len(covered)), k
    languages = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en"))
    rows = {r.doc_id: r for r in quality.assess(languages.filter("doc_id is not null")).collect()}
    assert rows[400].base_failed and not rows[400].kept and rows[402].base_failed
    assert rows[0].n_words < 10 or not rows[0].base_failed
    assert quality.assess(empty).count() == 0


def test_perplexity_tells_other_text(spark):
    made = random.Random(1)
    vocabulary = [a + b for a in ("ka", "lo", "mi", "ne") for b in ("ra", "su", "ti", "vo", "")]
    plain = [(i, " ".join(made.choice(vocabulary) for _ in range(80)), "xx") for i in range(200)]
    odd = [(1000, " ".join("#%d$$$Q" % made.randint(0, 99999) for _ in range(80)), "xx")]
    rows = {r.doc_id: r for r in quality.assess(spark.createDataFrame(plain + odd, "doc_id long, text string, lang string")).collect()}
    assert not rows[1000].base_failed and not rows[1000].kept
    assert sum(not rows[i].kept for i in range(200)) <= 2
    model = quality.fit(spark.createDataFrame(plain, "doc_id long, text string, lang string"))
    codes = [ord(c) for c in sorted({c for _, t, _ in plain for c in t})]
    context = 0
    for c in "kara"[-(quality.ORDER - 1) :]:
        context = context << quality.BITS | ord(c)
    grams = np.array([context << quality.BITS | c for c in codes], dtype=np.int64)
    assert 0.9 < np.exp(model.log_probability("xx", grams)).sum() <= 1.0001  # the rest is for unseen characters


def test_rare_ngrams_are_in_the_model(spark):
    """An n-gram below a millionth of all characters keeps its own probability."""
    made = random.Random(2)
    texts = ["".join(made.choice("cdefghijklmnop") for _ in range(n)) for n in (40, 20, 10, 8)]
    rows = [(0, "ab" * 1_500_000, "xx")] + [(10 * i + j, t, "xx") for i, t in enumerate(texts, 1) for j in range(i)]
    model = quality.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert np.exp(model.log_probability("xx", quality.grams([texts[1].encode()])[0][-1:]))[0] > 0.37  # it occurs twice


def test_edited_texts_and_their_likeness(spark, empty):
    rows = [(3, "One two three. Four five six.\nSeven eight.\n\nNine ten."), (2, "Alpha beta. Gamma delta.\nEpsilon."), (1, None), (None, "last"), (7, "é" * 9)]
    got = {r.doc_id: r for r in merkle.compare_with_edited(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    order = [7, 3, 2, 1, None]
    texts = {k: t or "" for k, t in rows}
    for k, n in zip(order, order[1:] + order[:1]):
        half = len(texts[k]) // 2
        edited = texts[k][: len(texts[k]) - half] + texts[n][:half]
        assert (got[k].n_chars, got[k].edited_sha256) == (len(texts[k]), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= got[k].near_next <= 1 and 0 <= got[k].near_edited <= 1
        assert (got[k].fingerprint == got[k].edited_fingerprint) == (edited == texts[k])
    assert [tuple(x) for x in got[3].edits][-1][1] >= 0 and 0 < got[3].near_edited < 1
    same = {r.fingerprint for r in merkle.compare_with_edited(spark.createDataFrame([(1, "a b."), (2, "a b.")], "doc_id long, text string")).collect()}
    assert len(same) == 1
    assert merkle.compare_with_edited(empty).count() == 0


def test_pages_keep_the_article_and_lose_the_frame(spark):
    frame = '<nav><a href="/">Home</a></nav><div class="cookie-notice">We use cookies</div>%s<footer>&copy; site</footer>'
    article = "<article><h1>Title &amp; more</h1><p>First <b>bold</b><br>line &#233;&nbsp;x<p>Second\n\n line<div class='ad'>Buy</div><section id='comments'><p>Nice!</p></section></article>"
    plain = "<div><p>Shared line</p><p>%s</p></div>"
    rows = [
        (1, "http://a.example/x/1", "<html><script>var a='<p>';</script>" + frame % article), (2, "http://b.example/x/1", frame % (plain % "Only here")),
        (3, "http://b.example/x/2", frame % (plain % "Only there")), (4, None, None), (5, "http://c.example/", "<p>Alone</p>"), (6, "odd", ""),
        (7, "http://a.example/x/2", "<html>" + frame % article),
    ]
    got = {r.page_id: r for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert got[1].text == got[7].text == "Title & more\n\nFirst bold line é x\n\nSecond line"
    assert (got[2].text, got[3].text) == ("Only here", "Only there")
    assert (got[4].text, got[4].n_chars, got[5].text, got[6].text) == ("", 0, "Alone", "")
    assert pages.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_common_lines_are_a_longest_subsequence():
    made = random.Random(9)
    for _ in range(200):
        a, b = ([made.choice("abcd") for _ in range(made.randint(0, 12))] for _ in "xy")
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert len(pages.shared(a, b)) == table[-1][-1]


def test_neighbours_equal_brute_force(spark):
    made = random.Random(2)
    vocabulary = {b"t%d" % i: i for i in range(30)}
    idf = np.array([1 + made.random() for _ in vocabulary])
    row = lambda i: type("R", (), {"id": i, "label": i % 2, "terms": sorted(made.sample(range(30), made.randint(1, 6))), "counts": [1] * 6})()
    sample = [row(i) for i in range(400)]
    model = toxicity.build(vocabulary, idf, 0.1, sample, {0: 1.0, 1: 2.0})
    by_id = {r.id: model.vector(dict(zip(r.terms, r.counts))) for r in sample}
    for _ in range(50):
        t, w = model.vector({i: made.randint(1, 3) for i in made.sample(range(30), 4)})
        query = dict(zip(t.tolist(), w.tolist()))
        cosines = sorted((sum(query.get(i, 0) * x for i, x in zip(*(v.tolist() for v in by_id[r.id]))) for r in sample), reverse=True)
        got = model.neighbours(t, w)[1]
        assert np.allclose(got, [c for c in cosines[: toxicity.NEIGHBOURS] if c > 0])


def test_toxic_texts_are_found_and_labels_are_no_input(spark):
    made = random.Random(3)
    bad, plain = ["vile", "rotten", "nasty"], ["w%d" % i for i in range(300)]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        text = [made.choice(plain) for _ in range(40)] + ([made.choice(bad) for _ in range(3)] if toxic else [])
        rows.append((i, " ".join(text), 99, None))
        labels.append((i, None if i == 7 else int(toxic)))
    rows += [(None, "vile nasty", 99, None), (9999, None, 99, None), (1, "repeated id", 99, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int, row string")
    found = spark.createDataFrame(labels, "doc_id long, toxic int")
    scored = toxicity.score(df, toxicity.fit(df, found)).withColumn("held_out", toxicity.held_out(F.col("doc_id")))
    got = scored.collect()
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert held and all(r.predicted == (r.doc_id % 5 == 0) for r in held if r.text != "repeated id")
    special = {r.doc_id: r for r in got if r.doc_id in (None, 9999)}
    assert special[None].predicted == 1 and special[9999].predicted == 0 and 0 <= special[9999].score <= 1
    assert all(not e.id % 5 == 0 or e.label == 1 for r in got for e in r.evidence)
    nothing = toxicity.score(df, toxicity.fit(df, found.limit(0)))
    assert {r.score for r in nothing.collect()} == {0.0}


def test_examples_are_a_sample_of_rows(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MOST_EXAMPLES", 100)
    made = random.Random(4)
    rows = [(i, " ".join(["vile" if i % 4 else "rotten"] + [made.choice("abcdefgh") for _ in range(20)]), 1) for i in range(1000)]
    rows += [(1000 + i, " ".join(made.choice("abcdefgh") for _ in range(20)), 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    shown = Counter(i % 4 == 0 for i, v in zip(model.ids, model.labels) if v == 1)
    assert sum(shown.values()) == 100 and 10 <= shown[True] <= 45  # a quarter of the rows


def filled(sizes: list[int], weights=(3, 1, 2), share=1.5, most=2.0) -> list[float]:
    """Targets by resharing again and again what is above a cap."""
    caps, goal = [most * s for s in sizes], share * sum(sizes)
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    target, free, left = [0.0] * len(sizes), set(range(len(sizes))), goal
    while free:
        each = left / sum(weight[i] for i in free)
        full = {i for i in free if each * weight[i] > caps[i]}
        if not full:
            for i in free:
                target[i] = each * weight[i]
            break
        for i in full:
            target[i] = caps[i]
            left -= caps[i]
        free -= full
    return target


def test_targets_equal_repeated_resharing(spark):
    made = random.Random(8)
    for _ in range(5):
        sizes = [made.choice([0, 3, 50, 1000]) for _ in range(made.randint(1, 9))]
        names = [f"s{i}" for i in range(len(sizes) - 1)] + [None]
        df = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(df, (3, 1, 2), 1.5, 2.0).collect()}
        assert np.allclose([got[n] for n in names], filled(sizes))


def test_mix_comes_near_its_targets_and_repeats(spark, empty):
    made = random.Random(6)
    rows = [(i, "w " * made.randint(0, 60), made.choice(["a", "a", "b", "c", None]), 1) for i in range(3000)] + [(None, None, "a", 1), (5, "w", "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, Size int")
    mixed = mixing.mix(df.repartition(3))
    assert "Size" not in mixed.columns
    got = mixed.collect()
    assert len(got) == len(rows) and all(0 <= r.taken <= 2 * r.size for r in got)
    for name in ("a", "b", "c", None):
        own = [r for r in got if r.source == name]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 120
    again = mixing.mix(df.repartition(11)).collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in again) == Counter((r.doc_id, r.size, r.taken) for r in got)
    assert mixing.emit(mixed, ["doc_id"]).count() == sum(r.copies for r in got)
    assert mixing.mix(empty).count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_agrees_with_sql(spark, sf_dir, name):
    rows, found = difference(connect(sf_dir), queries.QUERIES[name](spark, sf_dir), queries.SQL[name])
    assert found is None and rows > 0


def test_native_plans_run_no_python(spark, sf_dir):
    for name in ("op2_mixing", "op9_merkle"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
        assert not re.search("Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("html, expected", [
    ('<html class="no-js"><body class="has-sidebar page"><article><p>Text.</p></article></body>', "Text."),
    ('<body class="no-sidebar"><main class="nav-open"><p>Text.</p></main>', "Text."),
    ('<body class="sidebar"><article class="post has-related"><p>One</p><p>Two</p></article>', "One\n\nTwo"),
    ("<html><head><title>T</title><meta charset=utf-8><body><article><p>Text.</p></article>", "Text."),
    ("<head><title>T</title><link rel=x><p>Text.</p>", "Text."),
    ("<body><form><p>Menu</p><article><p>Text.</p></article></form></body>", "Text."),
    ("<body><form><p>One</p><p>Two</p></form></body>", "One\n\nTwo"),
    ("<body><p>Text.</p><form><p>Name</p></form></body>", "Text."),
    ("<article><p>One</p><form><p>Name</p></form></article>", "One"),
    ('<article><div class="social-science"><p>One</p></div><div class="social-share"><p>Share</p></div><p>Two</p></article>', "One\n\nTwo"),
    ("<main><p>Lead</p><article><p>Text.</p></article></main>", "Lead\n\nText."),
    ('<body><div class="site-footer"><p>F</p></div><div class="nav-links">N</div><div id="comments-area">C</div><p>Text.</p>', "Text."),
    ('<body><div class="cookie banner"><p>C</p></div><aside><article><p>A</p></article></aside><p>Text.</p>', "Text."),
    ("", ""), ("<p> \n ", ""), ("plain &amp; simple", "plain & simple"),
])
def test_pages_of_common_kinds(html, expected):
    assert pages.main_text(pages.lines_of(html), None) == expected


def test_unmarked_pages_lose_what_the_nearer_neighbour_has(spark):
    page = lambda *lines: "".join(f"<p>{x}</p>" for x in lines)
    rows = [
        (1, "http://h/a/x", page("Frame A", "one")), (2, "http://h/b/c/1", page("Frame B", "two", "Frame A")),
        (3, "http://h/b/c/2", page("Frame B", "three")), (4, "http://other/z", page("Frame B", "alone")), (5, None, page("five")), (6, None, None),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.extract(frame.withColumn("host", F.lit("x")).coalesce(1)).collect()}
    # The first has one neighbour only; the second is nearer to the third than to the first.
    assert got == {1: "one", 2: "two\n\nFrame A", 3: "three", 4: "Frame B\n\nalone", 5: "five", 6: ""}


def test_quality_of_rows_that_come_in_any_order(spark):
    """Input behind a shuffle, many languages, and a column that clashes."""
    made = random.Random(8)
    rows = [(i, " ".join(made.choice(["ab", "cd", "ef", "gh"]) for _ in range(30)), f"l{i % 700}") for i in range(1500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("chunk", F.lit("c"))
    shuffled = frame.groupBy("doc_id", "lang", "text", "chunk").count().repartition(7)
    a = {r.doc_id: (r.kept, round(r.log_perplexity, 9)) for r in quality.assess(shuffled).collect()}
    b = {r.doc_id: (r.kept, round(r.log_perplexity, 9)) for r in quality.assess(frame).collect()}
    assert a == b and len(a) == 1500


def test_marked_elements_that_the_neighbour_shares_are_frame(spark):
    teaser = "<article><h2>Our offer</h2><p>Buy this now.</p></article>"
    page = lambda *own: f"<html><body><p>Top</p>{teaser}<article>{''.join(f'<p>{x}</p>' for x in own)}</article></body></html>"
    texts = {1: page("One", "Quoted by both"), 2: page("Two", "Quoted by both"), 3: page("Two", "Quoted by both")}
    frame = spark.createDataFrame([(i, f"http://h/a/{i}", h) for i, h in texts.items()], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.extract(frame.coalesce(1)).collect()}
    whole = "Our offer\n\nBuy this now.\n\nTwo\n\nQuoted by both"
    assert got == {1: "One\n\nQuoted by both", 2: "Two\n\nQuoted by both", 3: whole}
    assert pages.main_text(pages.lines_of(texts[1]), None).startswith("Our offer")


def test_quality_writes_tables_without_leaving_shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> set[str]:
        found = files.getAllFiles()
        return {n for n in (found.apply(i).getName() for i in range(found.size())) if n.startswith("shuffle_")}

    before, setting = shuffled(), spark.conf.get(SHUFFLE_CLEANUP)
    counts = spark.range(200_000).groupBy((F.col("id") % 50_000).alias("k")).count()
    table = quality.written(counts, "test")
    for _ in range(40):  # files are removed in the background
        if not shuffled() - before:
            break
        time.sleep(0.25)
    assert not shuffled() - before
    assert table.agg(F.sum("count"), F.count("k")).first()[:] == (200_000, 50_000)
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting


def test_quality_judges_every_chunk_in_one_round(spark, monkeypatch):
    made = random.Random(5)
    rows = [(i, " ".join(made.choice(["ab", "cd", "ef"]) for _ in range(30)), "ab"[i % 2]) for i in range(60)]
    frame = spark.createDataFrame(spark.sparkContext.parallelize(rows, 7), "doc_id long, text string, lang string")
    results = []
    for rounds in (1, 5):
        monkeypatch.setattr(quality, "ROUNDS", rounds)
        results.append(sorted((r.doc_id, r.kept, round(r.log_perplexity, 9)) for r in quality.assess(frame).collect()))
    assert [r[0] for r in results[0]] == list(range(60)) and results[0] == results[1]


def test_quality_keeps_only_what_later_queries_read(spark, tmp_path, monkeypatch):
    """Disk: tables go after their last reader, and a query of its own makes each order's probabilities."""
    monkeypatch.setattr(quality.common, "shared_folder", lambda spark: str(tmp_path))
    made = []
    monkeypatch.setattr(quality, "written", lambda df, name, within=None, f=quality.written: made.append(name) or f(df, name, within))
    texts = [(i, f"a line of {i * 7} words that ends with number {i}, as others do", "x" if i % 2 else None) for i in range(40)]
    frame = spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(3)
    found = quality.assess(frame)
    assert {f.name.rsplit("-", 1)[0] for f in tmp_path.iterdir()} == {"quality"}
    assert made.count("quality-lower") == quality.ORDER - 1
    assert found.count() == len(texts) and not found.filter("log_perplexity is null").count()

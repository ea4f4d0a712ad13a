"""Fill-in-the-middle, license scans and filter audits on small tables, against brute force."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

pytest.importorskip("starmart.llm.queries")
from pyspark.sql import functions as F  # noqa: E402

from checks.compare import connect, difference  # noqa: E402
from starmart.llm import fill_in_middle, filter_audit, licenses, queries  # noqa: E402

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")
LOWER = str.maketrans(licenses.UPPER, licenses.LOWER)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, failed string, template string"
LABELS = "doc_id long, quality int, toxic int"


def corpus() -> list[tuple]:
    """Licenses whole, cut and spread out, marks, odd characters, long texts, copies, nulls."""
    made = random.Random(11)
    vocabulary = ["w%d" % i for i in range(300)] + ["Éa", "the", "license", "CC", "by", "nc", "A|B"]
    text = lambda n: " ".join(made.choice(vocabulary) for _ in range(n))
    notice = licenses.TEMPLATES[9][3]
    cut = notice.split()
    texts = [text(made.randint(0, 400)) for _ in range(60)]
    texts += [f"{text(30)}\nReleased UNDER the MIT-License.\n{text(20)} under the mit license", "cc by-nc cc by nc cc", "Apache License, Version 2.0"]
    texts += [f"{text(25)} {notice} {text(9)}", " ".join(cut[:9] + ["really"] + cut[9:20] + cut[21:]), " ".join(cut[:5])]
    texts += ["GNU General Public License, version 3", "gnu general public licenses version 3", "cc by nc " * 500, text(9000)]
    texts += ["", None, " \n\t", "x", "...", "a<P>b", "<S>", "end <M", "é中\U0001f600 b\r\n", "A" * 50, "a " * 300 + "#"]
    copy = text(250)
    texts += [copy] * 40
    rows = [(i, t, ("en", "de", None, "")[i % 4], "s", None, "x", "y") for i, t in enumerate(texts)]
    rows += [(None, copy, "en", None, None, "x", "y"), (None, None, None, None, None, None, None), (3, texts[3], "en", "s", 1, None, None), (70, copy, "zz", "s", 1, None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_forms_equal_a_loop_over_units(docs, empty):
    expected = []
    for k, t, *_ in corpus():
        t = t or ""
        digest = hashlib.sha256(f"1:{'' if k is None else k}".encode()).hexdigest()
        h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
        units = UNIT.findall(t)
        a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
        x, m, y = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        if not t or any(mark in t for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
            expected.append((str(k), len(units), "plain", None, None, t))
        elif h[3] % 100 < 20:
            expected.append((str(k), len(units), "spm", len(x), len(m), f"<S>{y}<P>{x}<M>{m}"))
        else:
            expected.append((str(k), len(units), "psm", len(x), len(m), f"<P>{x}<S>{y}<M>{m}"))
    rows = fill_in_middle.fill_in_middle(docs).collect()
    assert sorted(((str(r[0]), *r[1:]) for r in rows), key=str) == sorted(expected, key=str)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    digests = fill_in_middle.fill_in_middle(docs, digests=True).collect()
    assert Counter((str(r.doc_id), r.output_sha256) for r in digests) == Counter((e[0], sha(e[5])) for e in expected)
    assert Counter((str(r.doc_id), r.restored_sha256) for r in digests) == Counter((str(k), sha(t or "")) for k, t, *_ in corpus())
    assert fill_in_middle.fill_in_middle(empty, digests=True).count() == 0


def test_long_texts_are_matched_in_pieces(monkeypatch):
    made = random.Random(2)
    monkeypatch.setattr(fill_in_middle, "PIECE", 7)
    units = fill_in_middle.Units()
    for _ in range(300):
        t = "".join(made.choice(["a", "bc", "é", " ", "Zzzzzzzzzzz", "1"]) for _ in range(made.randint(0, 40)))
        assert units.ends(t) == np.cumsum([len(u) for u in UNIT.findall(t)]).tolist()


def test_texts_are_restored_from_any_cut():
    units = fill_in_middle.Units()
    for t in ("<P", "a<S<", "<<M>", "x<P>", "S>a<", "<" * 9):
        for k in range(200):
            _, form, _, _, output = fill_in_middle.transform(t, k, units)
            assert fill_in_middle.restore(output, form) == t
    with pytest.raises(ValueError):
        fill_in_middle.fill_in_middle(None, marks=("<P>", "<P><", "<M>"))


def scanned(text: str) -> tuple:
    """Base places and verified labels of one text, by looking at every place."""
    w = re.findall(licenses.WORD, text.translate(LOWER))
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    places, base, labels, best = [], set(), set(), 0.0
    for label, share, is_base, template in licenses.TEMPLATES:
        v = re.findall(licenses.WORD, template.translate(LOWER))
        of = [tuple(v[i : i + 3]) for i in range(len(v) - 2)]
        diagonals: dict = {}
        for i, g in enumerate(grams):
            for j, h in enumerate(of):
                if g == h:
                    diagonals.setdefault(i - j, set()).add(j)
        if is_base:
            found = [i for i in range(len(w)) if w[i : i + len(v)] == v]
            places += found
            if found:
                base.add(label)
                labels.add(label)
        run: list = []
        for d in [*sorted(diagonals), None]:
            if run and (d is None or d - run[-1] > licenses.DRIFT):
                seen = set().union(*(diagonals[x] for x in run))
                first, last = min(x + min(diagonals[x]) for x in run), max(x + max(diagonals[x]) for x in run) + 2
                best = max(best, len(seen) / len(of))
                if not is_base and len(seen) / len(of) >= share and last - first + 1 <= licenses.STRETCH * len(v):
                    labels.add(label)
                run = []
            run.append(d)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), best


def test_labels_equal_brute_force(docs, empty):
    expected = [(str(k), *scanned(t or "")) for k, t, *_ in corpus()]
    rows = licenses.scan(docs).collect()
    assert sorted(((str(r[0]), *r[1:8]) for r in rows), key=str) == sorted(expected, key=str)
    assert {"mit", "apache-2", "cc-by-nc", "gpl-3"} <= {label for r in rows for label in r.labels.split(",")}
    notices = [r for r in rows if r.labels == "mit" and not r.n_base]
    assert len(notices) == 2 and all(r.spans[0].label == "mit" for r in notices)
    assert licenses.scan(empty).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(docs, templates=[("short", 1.0, True, "two words")])


def test_scan_starts_no_python_worker(docs):
    plan = licenses.scan(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def audited(rows: list[tuple], labels: list[tuple]) -> Counter:
    texts = [(k, (t or ""), part or "") for k, t, part, *_ in rows]
    smallest: dict = {}
    for k, t, _ in texts:
        if k is not None:
            smallest[t] = min(smallest.get(t, k), k)
    good = {k for k, q, _ in labels if q == 1}
    toxic = {k for k, _, x in labels if x == 1}
    known = []
    for k, t, part in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        failed = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": k is not None and smallest[t] < k,
        }
        known.append((part, {f for f in failed if failed[f]}, k is not None and k in good, k is not None and k in toxic))
    found: Counter = Counter()
    for part in {p for p, *_ in known}:
        own = [r for r in known if r[0] == part]
        steps, shapley = [], Counter()
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                earlier = set(order[: step - 1])
                here = [r for r in own if f in r[1] and not earlier & r[1]]
                shapley[f] += len(here)
                steps.append((
                    f, part, order, step, sum(not (earlier | {f}) & r[1] for r in own), len(here), sum(f in r[1] and bool(earlier & r[1]) for r in own),
                    sum(r[1] == {f} for r in own), sum(r[2] for r in here), sum(r[3] for r in here),
                ))
        found.update((*s[1:], shapley[s[0]]) for s in steps)
    return found


def test_audit_equals_brute_force(spark, docs, empty, monkeypatch):
    made = random.Random(3)
    labels = [(k, made.choice([0, 1, None]), made.choice([0, 1])) for k in range(0, 120, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (999, 1, 1)]
    table = spark.createDataFrame(labels, LABELS)
    expected = audited(corpus(), labels)
    assert Counter(tuple(r) for r in filter_audit.audit(docs, table).collect()) == expected
    # Without broadcast texts, and with a task that holds two groups at most.
    monkeypatch.setattr(filter_audit, "HOT_SHARE", 1)
    monkeypatch.setattr(filter_audit, "OPEN_GROUPS", 2)
    assert Counter(tuple(r) for r in filter_audit.audit(docs, table.withColumn("failed", F.lit(1))).collect()) == expected
    assert filter_audit.audit(empty, table).count() == 0
    unlabelled = filter_audit.audit(docs, table.limit(0))
    assert unlabelled.agg(F.sum("good_lost"), F.sum("toxic_lost")).first() == (0, 0) and unlabelled.count() == sum(expected.values())


def test_positional_popcount():
    made = np.random.default_rng(7)
    counter, total = filter_audit.Counter(), np.zeros(32, dtype=np.int64)
    for n in (0, 1, 2, 3, 1000, 7, 4097):
        words = made.integers(0, 1 << 32, n, dtype=np.uint32)
        counter.add(words)
        total += ((words[:, None] >> np.arange(32, dtype=np.uint32)) & 1).astype(np.int64).sum(axis=0)
    assert counter.counts() == total.tolist()
    assert all(len(level) <= 2 for level in counter.levels)


@pytest.mark.parametrize("key", ["op11_fill_in_middle", "op12_licenses", "op13_filter_audit"])
def test_queries_agree_with_sql(spark, sf_dir, key):
    rows, found = difference(connect(sf_dir), queries.QUERIES[key](spark, sf_dir), queries.SQL[key])
    assert found is None and rows > 0

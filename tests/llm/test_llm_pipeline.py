"""The pipeline stage by stage, each against its operator's rule."""

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
import hashlib  # noqa: E402
import random  # noqa: E402
import re  # noqa: E402
from collections import Counter  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from starmart.llm.common import written  # noqa: E402


def test_stages_act_on_what_is_left(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, sf_dir), f"test-{name}")
        assert docs.columns == columns
        assert docs.filter(F.col("n_chars") != F.length("text")).count() == 0
        assert docs.join(before.select("doc_id"), "doc_id", "left_anti").count() == 0
        seen.append((name, before.count(), docs.count()))
    counts = {name: (a, b) for name, a, b in seen}
    assert counts["toxicity"][1] <= counts["toxicity"][0] and counts["jaccard"][1] < counts["jaccard"][0]
    assert counts["substrings"][0] == counts["substrings"][1]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == docs.count() and "ids_sha256" in last.columns


def test_rows_without_id_and_repeated_rows(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "en", "a", len(text)), (1, text, "en", "a", len(text)), (2, text + " more", "en", "a", 0), (None, text, None, None, None), (3, None, "en", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted((r.doc_id for r in corpus_pipeline.one_of_similar(spark, docs, "").collect()), key=str)
    assert kept == [1, 3, None]
    assert corpus_pipeline.one_of_similar(spark, docs.limit(0), "").count() == 0


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def small_corpus() -> list[tuple]:
    """Near copies, shared passages, an empty, a null and a very long text, a null source."""
    made = random.Random(21)
    vocabulary = ["v%d" % i for i in range(500)]
    text = lambda n: " ".join(made.choice(vocabulary) for _ in range(n))
    base, passage = text(120).split(), text(40)
    texts = [text(made.randint(1, 90)) for _ in range(60)]
    for _ in range(12):
        near = list(base)
        near[made.randrange(120)] = "changed"
        texts.append(" ".join(near))
    texts += [f"{text(15)}\n{passage} {text(15)}" for _ in range(8)]
    texts += [text(30) + " stupid idiot trash loser moron" for _ in range(6)] + ["", None, text(20_000), texts[0], texts[0].upper()]
    return [(i, t, "en", (None, "a", "b", "c")[i % 4], None if t is None else len(t)) for i, t in enumerate(texts)]


def similar_left(rows: dict[int, str]) -> set[int]:
    """The smallest id of each group of linked texts; texts without words are their own."""
    sets = {}
    for k, t in rows.items():
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        sets[k] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())
    group = {k: k for k in rows}
    find = lambda k: k if group[k] == k else find(group[k])
    for a in rows:
        for b in rows:
            if a < b and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                one, other = sorted((find(a), find(b)))
                group[other] = one
    return {find(k) for k in rows}


def without_repeats(rows: dict[int, str]) -> dict[int, str]:
    words = {k: WORD.findall(t) for k, t in rows.items()}
    first: dict = {}
    for k in sorted(rows):
        for j in range(len(words[k]) - 12):
            first.setdefault(tuple(words[k][j : j + 13]), k)
    out = {}
    for k, w in words.items():
        gone = {p for j in range(len(w) - 12) if first[tuple(w[j : j + 13])] < k for p in range(j, j + 13)}
        out[k] = " ".join(x for i, x in enumerate(w) if i not in gone) if gone else rows[k]
    return out


def test_run_equals_plain_python(spark, tmp_path):
    from tokenizers import Tokenizer

    from starmart.llm import mixing, toxicity
    from starmart.llm.queries import vocabulary

    rows = small_corpus()
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    documents = spark.createDataFrame(rows, columns)
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    marked = [(k, 1, int("stupid" in (t or ""))) for k, t, *_ in rows if k % 7]
    labels = spark.createDataFrame(marked, "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")

    scores = {r.doc_id: r.predicted for r in toxicity.score(documents, toxicity.fit(documents, labels)).collect()}
    left = {k: t or "" for k, t, *_ in rows if not scores[k]}
    assert all("stupid" not in t for t in left.values()) and len(left) >= len(rows) - 8
    stay = similar_left(left)
    texts = without_repeats({k: t for k, t in left.items() if k in stay})
    sources = {k: s for k, _, _, s, _ in rows}
    frame = spark.createDataFrame([(k, t, sources[k]) for k, t in texts.items()], "doc_id long, text string, source string")
    copies = {r.doc_id: r.copies for r in mixing.mix(frame).collect()}  # equal to SQL in its own test
    tokenizer = Tokenizer.from_file(vocabulary())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    expected: Counter = Counter()
    for k, t in texts.items():
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        expected[(k, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())] += copies[k]
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == +expected


def test_run_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

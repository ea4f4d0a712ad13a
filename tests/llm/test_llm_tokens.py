"""BPE and token files against the tokenizers library."""

import random
import zlib

import numpy as np
import pytest

pytest.importorskip("starmart.llm.bpe")
import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from starmart.llm import bpe, token_files  # noqa: E402
from starmart.llm.common import new_folder  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")


def rough(n: int, letters: str, seed: int) -> str:
    made = random.Random(seed)
    return "".join(made.choice(letters) for _ in range(n))


TEXTS = [
    "", " \n\t ", "The CAT's naïve über-café, it'll cost 12.50€!", "<|endoftext|> and <|startoftext|>x", "a\x00b \x01 \x85\xa0x \x1cq",
    "ΑΣ Σ ΟΔΟΣ İstanbul ŉ ǅ", "漢字かな交じり文 👩‍👩‍👧 é", rough(9000, "abcdeth", 1), "x " + rough(5000, "the", 2) + "'s " + rough(4096, "é!?ñ", 3) + " y",
    rough(20000, "ab", 4), "a" * 12000, "<|endoftext|>" + rough(5000, "aé1!", 5), "-" * 9000 + rough(5000, "inger", 6), "dup", "dup",
]


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(PATH)


def test_encoding_and_decoding_equal_the_library(spark, whole):
    rows = [(i, t, "x") for i, t in enumerate([*TEXTS, None])]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in bpe.encode_decode(df, PATH).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        ids = whole.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids, i
        assert (got[i].n_tokens, got[i].decoded) == (len(ids), whole.decode(ids, skip_special_tokens=False))


@pytest.mark.parametrize("letters", ["ab", "the", "inger", "aeiou"])
def test_joined_parts_equal_the_whole(letters):
    encoder = bpe.Encoder.of(PATH)
    for seed in range(30):
        text = rough(random.Random(seed).randint(2, 400), letters, seed)
        cuts = sorted({0, len(text), *(random.Random(seed + k).randint(0, len(text)) for k in range(5))})
        parts = [encoder.leaf(text[a:b], b == len(text)) for a, b in zip(cuts, cuts[1:])]
        assert encoder.tree(parts) == encoder.leaf(text, True)


def test_words_are_forgotten_as_a_task_ends(spark):
    """A worker goes on to other stages, which need the memory."""
    df = spark.range(0, 64, 1, 8).selectExpr("id as doc_id", "concat('word', id, ' of row', id) as text")
    assert bpe.encode_decode(df, PATH, digests=True).count() == 64

    def held(batches):
        import pyarrow as pa

        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(e.words) for e in bpe.Encoder._made.values()], pa.int64())})

    got = [r.n for r in spark.range(0, 64, 1, 8).mapInArrow(held, "n long").collect()]
    assert got and not any(got)


def test_elias_fano_finds_every_number():
    for values in ([0], [5], [1, 1, 1], list(range(0, 100_000, 7)), sorted(random.Random(1).choices(range(1 << 40), k=2000))):
        code = token_files.EliasFano.of(np.array(values, dtype=np.int64))
        assert code.all().tolist() == values
        assert [code.select(i) for i in range(0, len(values), max(1, len(values) // 300))] == values[:: max(1, len(values) // 300)]
    many = np.cumsum(random.Random(2).choices(range(1, 1000), k=100_000))
    code = token_files.EliasFano.of(many)
    assert 8 * (len(code.low) + len(code.high)) < 12 * len(many)


def test_token_files_read_back(spark, whole):
    rows = [(k, t, "y") for k, t in zip([7, 3, None, 9, 9, 1, 2, 5, 4, 6, 8, 10, 11, 12, 13], TEXTS)] + [(100, None, "y")]
    folder = new_folder(spark, "tokens")
    token_files.write_tokens(spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3), folder, PATH, 2)
    got = token_files.read_tokens(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((k for k, *_ in rows), key=lambda k: (k is not None, k or 0))
    place = 0
    texts = {}
    for k, t, _ in rows:
        texts.setdefault(k, []).append(whole.encode(t or "", add_special_tokens=False).ids + [2])
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == place and r.n_tokens == len(ids) and ids in texts[r.doc_id]
        place += len(ids)
    crc = token_files.read_tokens(spark, folder, crc=True).collect()
    assert sorted(r.ids_crc32 for r in crc) == sorted(zlib.crc32(r.ids) for r in got)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode_decode(empty, PATH, digests=True).count() == 0
    folder = new_folder(spark, "tokens")
    token_files.write_tokens(empty, folder, PATH, 2)
    assert token_files.read_tokens(spark, folder).count() == 0

"""BPE encoding and decoding by tree concatenation, with the ids of the tokenizers library.

White space always ends a word, so texts are cut there, and each different word is encoded once
per task (a bounded table remembers words; it goes as the task ends). A run without white space that is longer than
``LONG`` is not encoded in one piece: after normalising, each of its pieces is halved down to
leaves of at most ``LEAF`` bytes, the leaves become rows of their own and are encoded in parallel,
and pairs of neighbours are joined in a tree. At each join a window of ids on both sides is
re-encoded and grown until its first id is the left side's and its last id the right side's; a
sequence of BPE ids is the encoding of its text when each pair of neighbours is, so the joined
ids are then exact.

Words made of Latin letters, digits and printable ASCII are encoded by tiktoken with the same
merges (the end of a word is a byte of its own); everything else, special tokens included, goes
to the tokenizers library itself. Both give equal ids, which the tests compare.

Nulls are empty texts; an empty text has no ids and decodes to the empty text. Rows are handled
one by one, so ties and repeated rows give equal results.
"""

import hashlib
import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import as_bytes, bounded_batches, memory_returned, pieces, written

LONG = 4096  # code units of a run without white space from which it is cut
LEAF = 2048  # bytes of a leaf
WINDOW = 16  # ids on each side of a join that are re-encoded at first
REMEMBERED = 700_000  # words that an encoder remembers at most

# The end-of-word mark and the pieces that the vocabulary file cuts words into.
END = "</w>"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Encoder:
    """Encodes and decodes as the tokenizers library does, without special tokens added."""

    _made: dict[str, "Encoder"] = {}

    @classmethod
    def of(cls, path: str) -> "Encoder":
        """The worker's encoder for a vocabulary file; made once."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        with open(path, encoding="utf-8") as file:
            self.spec = json.load(file)
        self.names = [self.whole.id_to_token(i) or "" for i in range(self.whole.get_vocab_size())]
        self.special = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        self.pieces_and_ends = regex.compile(PIECES + r"|\n")
        self.plain = regex.compile(rb"(?:[\x21-\x7e]|\xc2[\xa1-\xac\xae-\xbf]|[\xc3-\xc8][\x80-\xbf])+")
        self.letters = {b: c for b, c in enumerate(byte_letters())}
        self.words: dict[bytes, bytes] = {}
        self.fast = self._fast() if self._known() else None

    def _known(self) -> bool:
        model, pre = self.spec["model"], self.spec.get("pre_tokenizer") or {}
        split = (pre.get("pretokenizers") or [{}])[0]
        kinds = [n["type"] for n in (self.spec.get("normalizer") or {}).get("normalizers", [])]
        return (
            model["type"] == "BPE" and model.get("end_of_word_suffix") == END and not model.get("ignore_merges")
            and kinds == ["NFC", "Replace", "Lowercase"] and split.get("pattern") == {"Regex": PIECES}
        )

    def _fast(self):
        """The same merges for tiktoken: byte 0 ends a word, and merges into its last byte first."""
        import tiktoken

        vocabulary, letters = self.spec["model"]["vocab"], self.letters
        back = {c: b for b, c in letters.items()}
        ranks = {bytes([b]): b for b in range(256)}
        ids = [vocabulary[letters[b]] for b in range(256)]
        for b in range(256):
            ranks[bytes([b, 0])] = len(ranks)
            ids.append(vocabulary[letters[b] + END])
        for merge in self.spec["model"]["merges"]:
            token = "".join(merge) if isinstance(merge, list) else merge.replace(" ", "", 1)
            core, end = (token[: -len(END)], b"\0") if token.endswith(END) else (token, b"")
            key = bytes(back[c] for c in core) + end
            if key in ranks:
                return None
            ranks[key] = len(ranks)
            ids.append(vocabulary[token])
        self.ids_of_ranks = np.array(ids, dtype="<u4")
        return tiktoken.Encoding("words", pat_str=r"[^\x00\x01]*\x00|\x01", mergeable_ranks=ranks, special_tokens={})

    def _learn(self, missing: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words, as little-endian unsigned 32-bit integers."""
        found, quick, slow = {}, [], []
        plain = self.plain.fullmatch
        for w in missing:
            (quick if self.fast and plain(w) and b"<|" not in w else slow).append(w)
        for i in range(0, len(quick), 20_000):
            part = quick[i : i + 20_000]
            found_pieces = self.pieces_and_ends.findall(b"\n".join(part).decode().lower())
            marked = ("\0".join(found_pieces) + "\0").replace("\n\0", "\x01") + "\x01"
            out = np.array(self.fast.encode_ordinary(marked), dtype=np.int64)
            ends = np.flatnonzero(out == 1)
            ids = self.ids_of_ranks[out]
            start = 0
            for w, end in zip(part, ends.tolist(), strict=True):
                found[w] = ids[start:end].tobytes()
                start = end + 1
        if slow:
            texts = [w.decode("utf-8", "replace") for w in slow]
            for w, e in zip(slow, self.whole.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                found[w] = np.array(e.ids, dtype="<u4").tobytes()
        return found

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of whole texts. A run without white space is encoded in one piece here."""
        out, words = [], self.words
        cut = [t.split() for t in texts]
        looked = [list(map(words.get, w)) for w in cut]
        missing = {w for ws, found in zip(cut, looked) if None in found for w, x in zip(ws, found) if x is None}
        if missing:
            learned = self._learn(list(missing))
            if len(words) + len(learned) > REMEMBERED:
                words.clear()
            words.update(learned)
            for ws, found in zip(cut, looked):
                if None in found:
                    found = [learned[w] if x is None else x for w, x in zip(ws, found)]
                out.append(b"".join(found))
            return out
        return [b"".join(found) for found in looked]

    def forget(self) -> None:
        """Give up the remembered words, and their memory to the system."""
        self.words.clear()
        memory_returned()

    def decode(self, ids: bytes) -> str:
        """What the library's decode(ids, skip_special_tokens=False) gives."""
        numbers = np.frombuffer(ids, dtype="<u4").tolist()
        if self.spec.get("decoder") is not None:
            return self.whole.decode(numbers, skip_special_tokens=False)
        return " ".join(map(self.names.__getitem__, numbers))

    # Long runs

    def _model(self, end: bool):
        from tokenizers import Tokenizer

        name = "_ending" if end else "_open"
        if not hasattr(self, name):
            model = self.spec["model"] | ({} if end else {"end_of_word_suffix": None})
            spec = self.spec | {"normalizer": None, "pre_tokenizer": None, "post_processor": None, "added_tokens": [], "truncation": None, "padding": None, "model": model}
            setattr(self, name, Tokenizer.from_str(json.dumps(spec)))
        return getattr(self, name)

    def leaf(self, letters: str, end: bool) -> list[int]:
        """Ids of a part of a piece; only the last part of a piece ends the word."""
        return self._model(end).encode(letters, add_special_tokens=False).ids if letters else []

    def _letters(self, ids: list[int]) -> str:
        return "".join(self.names[i] for i in ids)

    def join(self, left: list[int], right: list[int], last: bool) -> list[int]:
        """Ids of two neighbouring parts together; ``last`` says that the right one ends the word."""
        if not left or not right:
            return left + right
        size = WINDOW
        while True:
            a, b = left[-size:], right[:size]
            end = last and len(b) == len(right)
            text = self._letters(a) + self._letters(b)
            text = text[: -len(END)] if end else text
            window = self.leaf(text, end)
            all_left, all_right = len(a) == len(left), len(b) == len(right)
            if (all_left or window[0] == a[0]) and (all_right or window[-1] == b[-1]):
                return left[: len(left) - len(a)] + window + right[len(b) :]
            size *= 2

    def tree(self, parts: list[list[int]]) -> list[int]:
        """Join the parts of a piece pair by pair until one is left."""
        while len(parts) > 1:
            n = len(parts)
            parts = [self.join(parts[i], parts[i + 1], i + 2 >= n) if i + 1 < n else parts[i] for i in range(0, n, 2)]
        return parts[0] if parts else []

    def segments(self, text: bytes) -> list[bytes | str]:
        """A text with long runs, cut: bytes are ids, a str is a long piece that is not encoded yet."""
        import regex

        out: list[bytes | str] = []
        for run in regex.findall(rb"[^\x20\x09-\x0D]{%d,}|(?:[^\x20\x09-\x0D]{1,%d}(?:[\x20\x09-\x0D]+|$))+" % (LONG, LONG - 1), text):
            if len(run) < LONG or regex.search(rb"[\x20\x09-\x0D]", run):
                out.append(self.encode([run])[0])
                continue
            marks = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)"
            for part in regex.split(f"({marks})", run.decode("utf-8", "replace")):
                if part in self.special:
                    out.append(np.array([self.special[part]], dtype="<u4").tobytes())
                    continue
                normal = self.whole.normalizer.normalize_str(part) if part and self.whole.normalizer else part
                for letters, _ in self.whole.pre_tokenizer.pre_tokenize_str(normal) if normal else []:
                    if len(letters) > LEAF:
                        out.append(letters)
                    else:
                        out.append(np.array(self.leaf(letters, True), dtype="<u4").tobytes())
        return out


def halves(letters: str) -> list[str]:
    """The leaves of a long piece: halved until none is longer than ``LEAF``."""
    if len(letters) <= LEAF:
        return [letters]
    middle = len(letters) // 2
    return halves(letters[:middle]) + halves(letters[middle:])


def _result(encoder: Encoder, ids: bytes, digests: bool) -> tuple:
    decoded = encoder.decode(ids)
    if digests:
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
    return len(ids) // 4, ids, decoded


def encode_decode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", digests: bool = False) -> DataFrame:
    """Encode and decode every whole text.

    Returns ``key``, ``n_tokens`` and either ``ids`` (little-endian unsigned 32-bit integers) and
    ``decoded`` (text), or with ``digests`` their sha256 as ``ids_sha256`` and ``decoded_sha256``.
    Other columns of ``df`` are not read. ``path`` must be readable on every executor.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    kind = df.schema[key].dataType.simpleString()
    ids_name, decoded_name, ids_type = ("ids_sha256", "decoded_sha256", "string") if digests else ("ids", "decoded", "binary")
    results = f"n_tokens long, {ids_name} {ids_type}, {decoded_name} string"
    long_run = rb"[^\x20\x09-\x0D]{%d}" % LONG

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole results, and the cut parts of texts with long runs (segment not null)."""
        import regex
        from pyspark import TaskContext

        encoder, find, task, rows = Encoder.of(path), regex.compile(long_run).search, TaskContext.get().partitionId(), 0
        schema = None
        for batch in pieces(batches, "text"):
            all_texts = as_bytes(batch.column("text"))
            cut = [len(t) >= LONG and find(t) is not None for t in all_texts]
            encoded = iter(encoder.encode([t for t, c in zip(all_texts, cut) if not c]))
            out = []
            for k, t, c in zip(batch.column("key").to_pylist(), all_texts, cut):
                rows += 1
                if not c:
                    out.append((k, None, None, None, None, None, *_result(encoder, next(encoded), digests)))
                    continue
                for s, part in enumerate(encoder.segments(t)):
                    if isinstance(part, bytes):
                        out.append((k, (task << 33) + rows, s, 0, part, None, None, None, None))
                    else:
                        leaves = halves(part)
                        out += [(k, (task << 33) + rows, s, i, None, ("+" if i + 1 < len(leaves) else "$") + leaf, None, None, None) for i, leaf in enumerate(leaves)]
            kinds = [batch.schema.field("key").type, pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.int64(), pa.string() if digests else pa.binary(), pa.string()]
            names = ["key", "row", "segment", "leaf", "part_ids", "letters", "n_tokens", ids_name, decoded_name]
            schema = pa.schema(list(zip(names, kinds)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], schema=schema)
        encoder.forget()

    source = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    made = source.mapInArrow(texts, f"key {kind}, row long, segment int, leaf int, part_ids binary, letters string, {results}")
    made = written(made, "bpe")
    whole = made.filter(F.col("row").isNull()).select(F.col("key").alias(key), "n_tokens", ids_name, decoded_name)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        for batch in batches:
            part = [
                ids if letters is None else np.array(encoder.leaf(letters[1:], letters[0] == "$"), dtype="<u4").tobytes()
                for ids, letters in zip(batch.column("part_ids").to_pylist(), batch.column("letters").to_pylist())
            ]
            yield batch.drop_columns(["part_ids", "letters"]).append_column("part_ids", pa.array(part, pa.binary()))

    def joined(table: pa.Table) -> pa.Table:
        encoder = Encoder.of(path)
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("segment", "leaf", "part_ids"))))
        by_segment: dict[int, list[bytes]] = {}
        for s, _, ids in rows:
            by_segment.setdefault(s, []).append(ids)
        ids = b""
        for parts in by_segment.values():
            if len(parts) > 1:
                parts = [np.array(encoder.tree([np.frombuffer(p, dtype="<u4").tolist() for p in parts]), dtype="<u4").tobytes()]
            ids += parts[0]
        n, a, b = _result(encoder, ids, digests)
        return pa.table({key: table.column("key").slice(0, 1), "n_tokens": pa.array([n], pa.int64()), ids_name: pa.array([a], pa.string() if digests else pa.binary()), decoded_name: [b]})

    parts = made.filter(F.col("row").isNotNull()).select("key", "row", "segment", "leaf", "part_ids", "letters")
    parts = parts.repartition("row", "segment", "leaf")
    encoded = parts.mapInArrow(leaves, f"key {kind}, row long, segment int, leaf int, part_ids binary")
    long_ones = encoded.groupBy("row").applyInArrow(joined, f"{key} {kind}, {results}")
    return whole.unionByName(long_ones)

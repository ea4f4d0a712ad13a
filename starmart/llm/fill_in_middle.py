"""Fill-in-the-middle transformation of whole texts, by one repeated-capture match per text.

A text is read as units, by default runs of ASCII letters and single other characters. One
``fullmatch`` of ``(unit)*`` with the regex library keeps every repetition of its group, so the
ends of the group give the number of units and both cut offsets without a loop over units. The
quantifiers are possessive: a match keeps no way back, and its memory is that of its captures.

A text beyond ``PIECE`` code points is matched piece by piece, as captures are held in memory and
the library bounds their number; pieces start with a character that is a unit of its own, so that
no unit is cut, and the ends of all pieces are those of the text.

The cuts, whether a text is transformed and in which order its parts come follow from the sha256
of seed and key alone, so a task that runs again gives the same rows.

Nulls: a null text is empty; a null key is hashed as the empty key. Empty texts, texts that hold
one of the marks, and a stated share of the others stay plain. Equal rows have equal results. An
empty table gives no rows. Columns of the input other than key and text are not read.
"""

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import bounded_batches, pieces

MARKS = ("<P>", "<S>", "<M>")  # before the prefix, the suffix and the middle
PIECE = 1 << 18


class Units:
    """Ends of the units of a text: runs of one class of characters, and each other character."""

    def __init__(self, runs: str = "A-Za-z"):
        import regex

        self.all = regex.compile(f"([{runs}]++|[^{runs}])*+")
        self.single = regex.compile(f"[^{runs}]")

    def ends(self, text: str) -> list[int]:
        """Code point offset behind each unit."""
        if len(text) <= PIECE:
            return self.all.fullmatch(text).ends(1)
        found: list[int] = []
        start = 0
        while start < len(text):
            cut = self.single.search(text, start + PIECE)
            stop = cut.start() if cut else len(text)
            found += self.all.fullmatch(text, start, stop).ends(1)
            start = stop
        return found


def hashes(key: object, seed: int) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits from the sha256 of ``seed:key``."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def transform(
    text: str, key: object, units: Units, marks: Sequence[str] = MARKS, seed: int = 1, rate: int = 90, suffix_first: int = 20
) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and middle (None if plain) and output of one text.

    ``rate`` of 100 texts are transformed, ``suffix_first`` of 100 of these with the suffix first.
    """
    first, second, whether, order = hashes(key, seed)
    ends = units.ends(text)
    n = len(ends)
    if not text or whether % 100 >= rate or any(m in text for m in marks):
        return n, "plain", None, None, text
    low, high = sorted((first % (n + 1), second % (n + 1)))
    a, b = (ends[u - 1] if u else 0 for u in (low, high))
    before, behind, between = marks
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if order % 100 < suffix_first:
        return n, "spm", a, b - a, f"{behind}{suffix}{before}{prefix}{between}{middle}"
    return n, "psm", a, b - a, f"{before}{prefix}{behind}{suffix}{between}{middle}"


def restore(output: str, form: str, marks: Sequence[str] = MARKS) -> str:
    """The text that an output was made of, from output and form alone.

    No part holds a mark and no mark ends as another begins, so the first place of each is it.
    """
    if form == "plain":
        return output
    before, behind, between = marks
    one, two = (behind, before) if form == "spm" else (before, behind)
    first, rest = output[len(one) :].split(two, 1)
    second, middle = rest.split(between, 1)
    prefix, suffix = (second, first) if form == "spm" else (first, second)
    return prefix + middle + suffix


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fill_in_middle(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    runs: str = "A-Za-z",
    marks: Sequence[str] = MARKS,
    seed: int = 1,
    rate: int = 90,
    suffix_first: int = 20,
    digests: bool = False,
) -> DataFrame:
    """Transform every whole text.

    Returns ``key``, ``n`` (units), ``form`` (plain, psm or spm), ``prefix_chars`` and
    ``middle_chars`` (code points, null if plain) and the ``output``, or with ``digests`` the sha256
    of the output and of the text restored from output and form. Marks must differ, be none of
    another's parts and not overlap one another or themselves, which is checked.
    """
    marks = tuple(marks)
    if len(marks) != 3 or any(a in b or any(a.endswith(b[:i]) for i in range(1, len(b))) for a in marks for b in marks if a != b):
        raise ValueError("three marks that do not overlap are needed")
    if any(m.endswith(m[:i]) for m in marks for i in range(1, len(m))):
        raise ValueError("a mark must not overlap itself")
    bounded_batches(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    made = ["output_sha256", "restored_sha256"] if digests else ["output"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(runs)
        for batch in batches:
            for piece in pieces([batch], "text"):
                columns: list[list] = [[] for _ in range(4 + len(made))]
                for k, t in zip(piece.column("key").to_pylist(), piece.column("text").to_pylist()):
                    *found, output = transform(t or "", k, units, marks, seed, rate, suffix_first)
                    outputs = (_sha256(output), _sha256(restore(output, found[1], marks))) if digests else (output,)
                    for column, value in zip(columns, (*found, *outputs)):
                        column.append(value)
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * len(made)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("key"), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
                    names=[key, "n", "form", "prefix_chars", "middle_chars", *made],
                )

    source = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = f"`{key}` {kind}, n long, form string, prefix_chars long, middle_chars long, {', '.join(f'{c} string' for c in made)}"
    return source.mapInArrow(rows, schema)

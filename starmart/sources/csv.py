"""CSV source: everything is read as text, null tokens become NULL, casts come later."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from starmart.functions import null_if_token
from starmart.schemas import NULL_TOKENS

ROW_ORDER = "_row_order"
BAD_LINE = "_bad_line"
OPEN_QUOTE = "_open_quote"


def _reader(spark: SparkSession) -> DataFrameReader:
    return spark.read.option("header", True).option("encoding", "UTF-8").option("escape", '"')


def read_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    null_tokens: Sequence[str] = NULL_TOKENS,
    multi_line: bool = False,
    with_order: bool = False,
    bad_lines: bool = False,
) -> DataFrame:
    """Read UTF-8 CSV with a header as text columns.

    ``columns`` names a schema and saves reading the header first; without it, the header decides.
    Files are split over tasks unless ``multi_line`` (quoted line breaks) is set. ``with_order`` adds
    the position of each row in its source, for rules such as "keep the first". ``bad_lines`` adds
    the text of each line that has more or fewer fields than the header (else NULL).
    """
    reader = _reader(spark).option("multiLine", multi_line)
    if bad_lines and columns is None:
        columns = reader.csv(path).columns
    if columns is not None:
        named = [*columns, BAD_LINE] if bad_lines else columns
        reader = reader.schema(", ".join(f"`{c}` string" for c in named))
    if bad_lines:
        # All fields are parsed even where few are used; a line is only bad as a whole.
        reader = reader.option("columnNameOfCorruptRecord", BAD_LINE).option("columnPruning", False)
    raw = reader.csv(path)
    fields = [F.col(c) if c == BAD_LINE else null_if_token(c, null_tokens).alias(c) for c in raw.columns]
    return raw.select(*fields, *([source_order().alias(ROW_ORDER)] if with_order else []))


def header_of(spark: SparkSession, path: str) -> tuple[str, list[str]]:
    """The first line of a CSV source (empty without one) and its column names."""
    start = spark.read.text(path).filter(F.col("_metadata.file_block_start") == 0).filter(F.trim("value") != "")
    first = start.first()
    return first.value if first else "", _reader(spark).csv(path).columns


def read_csv_lines(spark: SparkSession, path: str, null_tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Read CSV line by line, in files split over tasks, with what tells whether that was right.

    Each line is parsed once. Besides the text columns there are ``ROW_ORDER``, ``BAD_LINE`` (the line,
    if it has more or fewer fields than the header) and ``OPEN_QUOTE``: its quotes do not pair, so a
    quoted field goes on in the next line. Without such a line no field holds a line break, and the
    rows are those that :func:`read_csv` finds with ``multi_line``.
    """
    header, columns = header_of(spark, path)
    lines = spark.read.text(path).filter((F.trim("value") != "") & (F.col("value") != F.lit(header)))
    kinds = ", ".join(f"`{c}` string" for c in (*columns, BAD_LINE))
    fields = F.from_csv("value", kinds, {"escape": '"', "columnNameOfCorruptRecord": BAD_LINE, "mode": "PERMISSIVE"})
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    parsed = lines.select(fields.alias("_fields"), (quotes % 2 == 1).alias(OPEN_QUOTE), source_order().alias(ROW_ORDER))
    named = [null_if_token(F.col(f"_fields.`{c}`"), null_tokens).alias(c) for c in columns]
    return parsed.select(*named, F.col(f"_fields.{BAD_LINE}").alias(BAD_LINE), OPEN_QUOTE, ROW_ORDER)


def count_bad_lines(spark: SparkSession, path: str, multi_line: bool = False) -> int:
    """Lines with more or fewer fields than the header."""
    rows = read_csv(spark, path, multi_line=multi_line, bad_lines=True)
    # Spark wants a field of the file read as well.
    return rows.agg(F.count_if(F.col(BAD_LINE).isNotNull()), F.count(rows.columns[0])).first()[0]


def source_order() -> Column:
    """Position of a row in its source files: file, block, then row within the block.

    No shuffle is needed, and a task that runs again gives its rows the same positions.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )

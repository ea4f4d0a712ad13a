"""Scalar column expressions; every one stays inside the JVM."""

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

ColumnOrName = Column | str


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


# -- lenient typing ----------------------------------------------------------------------------


def null_if_token(column: ColumnOrName, tokens: Sequence[str]) -> Column:
    """NULL where the whole text is one of ``tokens``."""
    column = as_column(column)
    return F.when(~column.isin(list(tokens)), column)


# A cast that meets bad text raises and catches an error per value, even as try_cast. These patterns
# keep such text out, which on dirty columns costs a tenth of the time.
WHOLE_PATTERN = r"^\s*[+-]?\d+\s*$"
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
FLAG_PATTERN = r"(?i)^\s*(t|true|y|yes|f|false|n|no)\s*$"
DATE_PATTERN = r"^\s*\d{4}(-\d{1,2}){0,2}([T ].*)?\s*$"
WHOLE_TYPES = ("tinyint", "smallint", "int", "integer", "bigint", "long")


def to_number(column: ColumnOrName, data_type: str | DataType) -> Column:
    """Number or flag from text, NULL when the text is none.

    Whole numbers and flags also accept text such as ``12.0``, which their own cast refuses.
    """
    column = as_column(column)
    numeric = F.when(column.rlike(NUMBER_PATTERN), column)
    name = data_type if isinstance(data_type, str) else data_type.simpleString()
    if name in WHOLE_TYPES or name == "boolean":
        own = F.when(column.rlike(FLAG_PATTERN if name == "boolean" else WHOLE_PATTERN), column)
        return F.coalesce(own.try_cast(data_type), numeric.try_cast("double").try_cast(data_type))
    return numeric.try_cast(data_type)


def to_date_lenient(column: ColumnOrName, formats: Sequence[str] = ()) -> Column:
    """Date from text, NULL when the text is no date.

    ISO dates are always understood; ``formats`` lists further ones, such as ``dd/MM/yyyy``, which
    are tried in turn.
    """
    column = as_column(column)
    iso = F.when(column.cast("string").rlike(DATE_PATTERN), column).try_cast("date")
    others = [F.try_to_timestamp(F.trim(column.cast("string")), F.lit(f)).cast("date") for f in formats]
    return F.coalesce(iso, *others) if others else iso


def date_pattern(date_format: str) -> str:
    """A regular expression for texts in a format of ``d``, ``M``, ``y`` and separators."""
    return "^\\s*" + "".join(r"\d" if c in "dMy" else f"[{c}]" for c in date_format) + "\\s*$"


def date_in(column: ColumnOrName, date_format: str) -> Column:
    """Date from text in one format, NULL otherwise; other text never reaches the parser."""
    text = F.when(as_column(column).rlike(date_pattern(date_format)), F.trim(as_column(column)))
    return F.try_to_timestamp(text, F.lit(date_format)).cast("date")


def date_id(column: ColumnOrName) -> Column:
    """Integer key YYYYMMDD of a date."""
    column = as_column(column)
    return F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)


def season_of(column: ColumnOrName, first_month: int = 7) -> Column:
    """Start year of the season a date falls in; seasons start in ``first_month``."""
    column = as_column(column)
    return F.year(column) - F.when(F.month(column) < first_month, 1).otherwise(0)


def season_start(column: ColumnOrName, pivot: int = 50) -> Column:
    """``23/24`` to 2023, ``99/00`` to 1999; anything else to -1."""
    digits = F.regexp_extract(as_column(column), r"^\s*(\d+)\s*/[^/]*$", 1)
    year = F.nullif(digits, F.lit("")).try_cast("int")
    full = F.when(year < pivot, year + 2000).otherwise(year + 1900)
    return F.coalesce(full, F.lit(-1))


# Fee texts that mean "no fee paid", and the multipliers of the unit letters.
FREE_FEES = ("free", "loan", "free transfer", "-", "?")
FEE_UNITS = {"m": 1_000_000, "k": 1_000}

# A decimal number that no further digit or point adjoins, and the unit letter that may follow it.
FEE_AMOUNT = rf"(?<![\d.])(\d+\.?\d*|\.\d+)(?![\d.])\s*([{''.join(FEE_UNITS)}]?)"


def money(column: ColumnOrName) -> Column:
    """Amount from text such as ``€50.00m``; 0 for free moves, NULL without a number."""
    text = F.lower(F.trim(as_column(column)))
    amount = F.nullif(F.regexp_extract(text, FEE_AMOUNT, 1), F.lit("")).try_cast("decimal(20,6)")
    unit = F.regexp_extract(text, FEE_AMOUNT, 2)
    factor = F.lit(1)
    for letter, size in FEE_UNITS.items():
        factor = F.when(unit == letter, F.lit(size)).otherwise(factor)
    return F.when(text.isin(*FREE_FEES), F.lit(0)).otherwise(amount * factor).try_cast("decimal(15,2)")


# -- text --------------------------------------------------------------------------------------


def clean_text(column: ColumnOrName) -> Column:
    """Drop leading commas and blanks, trim, and turn empty text into NULL."""
    stripped = F.trim(F.regexp_replace(as_column(column), "^[, ]+", ""))
    return F.nullif(stripped, F.lit(""))


def matches(column: ColumnOrName, pattern: str) -> Column:
    """Case-insensitive LIKE."""
    return as_column(column).ilike(pattern)


def concat_text(*columns: Column) -> Column:
    """Join texts end to end; NULL if any is NULL."""
    return F.concat(*[c.cast("string") for c in columns])


def period_label(year: ColumnOrName, month: ColumnOrName, month_name: ColumnOrName | None = None) -> Column:
    """``2023-01`` or, with a month name, ``2023-01 (January)``."""
    pieces = [as_column(year), F.lit("-"), F.lpad(as_column(month).cast("string"), 2, "0")]
    if month_name is not None:
        pieces += [F.lit(" ("), as_column(month_name), F.lit(")")]
    return concat_text(*pieces)


def date_text(column: ColumnOrName, pattern: str = "dd/MM/yyyy") -> Column:
    return F.date_format(as_column(column), pattern)


def word(column: ColumnOrName, position: int) -> Column:
    """The n-th word of a text, counted from the end when negative."""
    return F.try_element_at(F.split(F.trim(as_column(column)), r"\s+"), F.lit(position))


def leading_token(column: ColumnOrName) -> Column:
    """The text before the first blank."""
    return F.regexp_extract(as_column(column), r"^(\S+)", 1)


def label(column: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """The label of a code, or the code itself when it has none."""
    column = as_column(column)
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), column), column)


# -- conditions --------------------------------------------------------------------------------


def null_unless(column: ColumnOrName, condition: Column) -> Column:
    """Keep the value only where the condition holds."""
    return F.when(condition, as_column(column))


def is_type(column: ColumnOrName, value: str) -> Column:
    return as_column(column) == value


def between(low, high) -> Callable[[Column], Column]:
    """Inclusive range predicate for :func:`starmart.operators.dice`."""
    return lambda column: column.between(low, high)


# -- arithmetic --------------------------------------------------------------------------------


def ratio(numerator: Column, denominator: Column, digits: int | None = None, factor: int = 1) -> Column:
    """``factor * numerator / denominator``, NULL on a zero denominator.

    With ``digits`` the quotient is exact decimal arithmetic rounded half-up; without, a double.
    Inputs of the exact form must be whole numbers or decimals, with up to four decimals above and
    two below the line, and below 10^22 and 10^20.
    """
    denominator = F.nullif(denominator, F.lit(0))
    if digits is None:
        return numerator.cast("double") * factor / denominator.cast("double")
    exact = (numerator * F.lit(factor)).cast("decimal(26,4)") / denominator.cast("decimal(22,2)")
    return F.round(exact, digits)


def per_90(amount: Column, minutes: Column, digits: int | None = None) -> Column:
    """Amount per 90 minutes played."""
    return ratio(amount, minutes, digits, factor=90)


def scaled(amount: Column, unit: int, digits: int) -> Column:
    """Amount in millions, billions, ... rounded half-up."""
    return ratio(amount, F.lit(unit), digits)


def bucket(column: ColumnOrName, bands: Sequence[tuple[int, int | None, str]], otherwise: str) -> Column:
    """Label of the first inclusive band ``(low, high, label)`` that holds the value."""
    column = as_column(column)
    chosen = None
    for low, high, text in bands:
        inside = column >= low if high is None else column.between(low, high)
        chosen = F.when(inside, text) if chosen is None else chosen.when(inside, text)
    return chosen.otherwise(otherwise)

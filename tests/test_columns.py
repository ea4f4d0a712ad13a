"""Column expressions on small inputs."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.functions import (
    bucket,
    clean_text,
    date_id,
    label,
    money,
    null_if_token,
    per_90,
    ratio,
    season_of,
    season_start,
    to_date_lenient,
    to_number,
    word,
)
from starmart.schemas import NULL_TOKENS


def apply(spark, values, expression):
    """The expression over a column of texts, in input order."""
    rows = spark.createDataFrame(list(enumerate(values)), "i int, c string")
    return [r[0] for r in rows.orderBy("i").select(expression).collect()]


@pytest.mark.parametrize(
    "text, amount",
    [
        ("€50.00m", 50_000_000), ("€500k", 500_000), ("€1.5m", 1_500_000), (" €2.5M ", 2_500_000), ("12", 12),
        ("free transfer", 0), ("Free", 0), ("loan", 0), ("-", 0), ("?", 0), ("abc", None), ("", None), (None, None),
        ("1.2.3m", None),
    ],
)
def test_money(spark, text, amount):
    assert apply(spark, [text], money("c")) == [None if amount is None else Decimal(amount)]


def test_season_start(spark):
    texts = ["23/24", "99/00", "49/50", "50/51", "2023", "x/y", None, "1/2/3", " 07/08 "]
    assert apply(spark, texts, season_start("c")) == [2023, 1999, 2049, 1950, -1, -1, -1, -1, 2007]


def test_clean_text(spark):
    texts = [", Yellow card ", ", ", "", None, ",, Red, card", "plain"]
    assert apply(spark, texts, clean_text("c")) == ["Yellow card", None, None, None, "Red, card", "plain"]


def test_null_tokens_are_whole_texts(spark):
    texts = ["N/A", "None", "", "NA", "null", "nan", "Nantes", "a NA b", None]
    assert apply(spark, texts, null_if_token("c", NULL_TOKENS)) == [None] * 6 + ["Nantes", "a NA b", None]


def test_to_number(spark):
    texts = ["12", "12.0", " 7 ", "1e3", "x", "", None, "99999999999", "-5"]
    assert apply(spark, texts, to_number("c", "int")) == [12, 12, 7, 1000, None, None, None, None, -5]
    assert apply(spark, ["9007199254740993"], to_number("c", "bigint")) == [9007199254740993]
    assert apply(spark, ["1.255", "bad", "€3"], to_number("c", "decimal(5,2)")) == [Decimal("1.26"), None, None]
    assert apply(spark, ["True", "false", "1.0", "0.0", "maybe", None], to_number("c", "boolean")) == [
        True, False, True, False, None, None
    ]


def test_dates(spark):
    texts = ["2023-08-11", "2023-08-11 20:45:00", "2023-02-30", "soon", None]
    assert apply(spark, texts, to_date_lenient("c")) == [date(2023, 8, 11)] * 2 + [None] * 3
    assert apply(spark, texts, date_id(to_date_lenient("c"))) == [20230811, 20230811, None, None, None]
    assert apply(spark, ["2023-06-30", "2023-07-01"], season_of(to_date_lenient("c"))) == [2022, 2023]


def test_ratio_rounds_half_up_and_guards_zero(spark):
    cases = {("1", "8", 2): Decimal("0.13"), ("1", "3", 4): Decimal("0.3333"), ("5", "0", 2): None, ("-1", "8", 2): Decimal("-0.13")}
    for (top, bottom, digits), wanted in cases.items():
        expression = ratio(F.lit(int(top)), F.lit(int(bottom)), digits)
        assert apply(spark, ["x"], expression) == [wanted]
    assert apply(spark, ["x"], per_90(F.lit(3), F.lit(270), 2)) == [Decimal("1.00")]


def test_labels_words_and_bands(spark):
    assert apply(spark, ["a", "z", None], label("c", {"a": "first"})) == ["first", "z", None]
    assert apply(spark, ["Kylian Mbappé Lottin", "Pelé"], word("c", -1)) == ["Lottin", "Pelé"]
    bands = [(1, 15, "early"), (16, None, "late")]
    assert apply(spark, ["1", "15", "16", "200", "0"], bucket(F.col("c").cast("int"), bands, "none")) == [
        "early", "early", "late", "late", "none"
    ]


def test_ratio_of_very_large_groups(spark):
    row = spark.range(1).select(
        ratio(F.lit(str(10**20)).cast("decimal(38,0)"), F.lit(10**12).cast("long") * 1_000_000, 2).alias("mean"),
        ratio(F.lit(1).cast("long"), F.lit(2 * 10**16).cast("long"), 2).alias("tiny"),
    ).first()
    assert (float(row.mean), float(row.tiny)) == (100.0, 0.0)


def test_dates_in_further_formats(spark):
    df = spark.createDataFrame([("31/01/2024",), ("2024-01-31",), ("soon",), (None,)], "d string")
    rows = [r[0] for r in df.select(to_date_lenient("d", ["dd/MM/yyyy"])).collect()]
    assert [str(r) for r in rows] == ["2024-01-31", "2024-01-31", "None", "None"]
    assert df.select(to_date_lenient("d")).first()[0] is None


def test_season_with_many_digits_is_unknown(spark):
    df = spark.createDataFrame([("99999999999/00",), ("23/24",)], "s string")
    assert [r[0] for r in df.select(season_start("s")).collect()] == [-1, 2023]

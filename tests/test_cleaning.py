from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from abasto.functions import cleaning


def values(spark, texts, column):
    rows = [(i, text) for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, s string").select("i", column.alias("v"))
    return [row.v for row in sorted(df.collect(), key=lambda row: row.i)]


def test_text(spark):
    texts = ["  ", " a ", "\t", None, "b"]
    assert values(spark, texts, cleaning.filled("s")) == [None, "a", "\t", None, "b"]
    assert values(spark, texts, cleaning.trimmed("s")) == ["", "a", "\t", None, "b"]
    assert values(spark, texts, cleaning.is_blank("s")) == [True, False, False, True, False]
    assert values(spark, texts, cleaning.has_key("s")) == [False, True, True, None, True]


def test_decimal(spark):
    texts = [" 1,234.50 ", "S/ 5", "1.005", "-1.005", "abc", "", None, "1.234,50"]
    wanted = ["1234.50", "5.00", "1.01", "-1.01", None, None, None, "1.23"]
    wanted = [None if text is None else Decimal(text) for text in wanted]
    assert values(spark, texts, cleaning.decimal_number("s")) == wanted
    assert values(spark, texts, cleaning.decimal_number("s", "lenient")) == wanted


def test_integer(spark):
    texts = ["12.0", "N° 7", "-3", "", "x", None]
    assert values(spark, texts, cleaning.whole_number("s")) == [120, 7, -3, None, None, None]
    assert values(spark, ["9999999999"], cleaning.whole_number("s", target="bigint")) == [9999999999]


@pytest.mark.parametrize("text", ["1-2", "-", ".", "12345678901234567"])
def test_malformed_decimal(spark, text):
    assert values(spark, [text], cleaning.decimal_number("s", "lenient")) == [None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|NUMERIC_VALUE_OUT_OF_RANGE"):
        values(spark, [text], cleaning.decimal_number("s"))


@pytest.mark.parametrize("text", ["3-", "-", "9999999999"])
def test_malformed_integer(spark, text):
    assert values(spark, [text], cleaning.whole_number("s", "lenient")) == [None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CAST_OVERFLOW"):
        values(spark, [text], cleaning.whole_number("s"))


def test_day(spark):
    texts = ["230105", "690101", "700101", "2023-02-28", "230105\n", " 230105", "05/01/2023", "", None]
    wanted = [date(2023, 1, 5), date(2069, 1, 1), date(1970, 1, 1), date(2023, 2, 28)] + [None] * 5
    assert values(spark, texts, cleaning.calendar_day("s")) == wanted
    lenient = values(spark, texts, cleaning.calendar_day("s", "lenient"))
    assert lenient[:5] == wanted[:5] and lenient[5] == date(2023, 1, 5) and lenient[6:] == [None] * 3


@pytest.mark.parametrize("text", ["231301", "230230", "2023-02-30"])
def test_impossible_day(spark, text):
    assert values(spark, [text], cleaning.calendar_day("s", "lenient")) == [None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, [text], cleaning.calendar_day("s"))


def test_mode_is_checked():
    with pytest.raises(ValueError):
        cleaning.decimal_number(F.lit("1"), "loose")

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyworks.functions import parsing as P
from tallyworks.functions.money import with_measures


def column(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in df.select("i", make(F.col("v")).alias("out")).orderBy("i").collect()]


def test_trim_takes_every_kind_of_space(spark):
    raw = [" C007 ", "\tp012 ", "　x ", "a b", "   ", "\x1fz\x1c"]
    assert column(spark, raw, P.trimmed) == ["C007", "p012", "x", "a b", "", "z"]
    assert column(spark, [" p012 "], P.normal_key) == ["P012"]


def test_integers(spark):
    raw = ["12", "+5", "-2", "007", "1_000", "1__0", "three", "1e5", "½", "1.0", "", "9" * 30]
    want = [12, 5, -2, 7, 1000, None, None, None, None, None, None, None]
    assert column(spark, raw, P.to_integer) == want


def test_decimals(spark):
    raw = ["25", "25.", ".5", "1e3", "-0.10", "NaN", "Infinity", "abc", "1_0.5", "", "$4"]
    got = column(spark, raw, P.to_decimal)
    want = ["25", "25", "0.5", "1000", "-0.10", None, None, None, "10.5", None, None]
    assert got == [None if w is None else Decimal(w) for w in want]


def test_decimal_places_are_those_written(spark):
    raw = ["25.000", "2.5e1", "19.999", "25", "1e-3", "25.0"]
    assert column(spark, raw, P.decimal_places) == [3, 0, 3, 0, 3, 1]


def test_dates(spark):
    raw = ["2026-01-15", "2026-1-5", "2026-02-30", "15/01/2026", "2026-01-15 ", "0000-01-01", "26-1-1"]
    want = [dt.date(2026, 1, 15), dt.date(2026, 1, 5)] + [None] * 5
    assert column(spark, raw, P.to_iso_date) == want


def test_printed_numbers(spark):
    assert column(spark, ["+5", "-007", "0", "00", "-0"], P.integer_text) == ["5", "-7", "0", "0", "0"]
    assert column(spark, ["+5.0", "007.10", ".5", "-.5", "5.", "-0.00"], P.decimal_text) == [
        "5.0", "7.10", "0.5", "-0.5", "5", "-0.00"
    ]


@pytest.mark.parametrize("raw", ["abc", "it's", 'say "x"', "both ' and \"", "back\\slash", "tab\t"])
def test_quoting_matches_repr(spark, raw):
    assert column(spark, [raw], P.quoted) == [repr(raw)]


def test_periods(spark):
    names = ["sales_2026_01.csv", "sales_2026-12.csv", "sales.csv", "sales_2026_13.csv", "2026_00.csv"]
    assert column(spark, names, P.file_period) == ["2026-01", "2026-12", None, None, None]


@pytest.mark.parametrize(
    "quantity,price,rate,gross,discount,net",
    [
        (4, "25.00", "0.10", "100.00", "10.00", "90.00"),
        (1, "9.99", "0.00", "9.99", "0.00", "9.99"),
        (3, "19.99", "0.25", "59.97", "14.99", "44.98"),
        (5, "34.95", "0.10", "174.75", "17.48", "157.28"),
        (1, "12.50", "0.01", "12.50", "0.13", "12.38"),
    ],
)
def test_measures_round_once_half_up(spark, quantity, price, rate, gross, discount, net):
    df = spark.createDataFrame(
        [(quantity, Decimal(price), Decimal(rate))],
        "quantity int, unit_price decimal(12,2), discount_rate decimal(38,12)",
    )
    row = with_measures(df).first()
    assert (row.gross_sales, row.discount_amount, row.net_sales) == (
        Decimal(gross), Decimal(discount), Decimal(net)
    )


def test_measures_use_the_whole_rate(spark):
    df = spark.createDataFrame(
        [(1000, Decimal("99.99"), Decimal("0.12345"))],
        "quantity int, unit_price decimal(12,2), discount_rate decimal(38,12)",
    )
    assert with_measures(df).first().discount_amount == Decimal("12343.77")

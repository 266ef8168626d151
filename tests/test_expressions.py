from __future__ import annotations

import time
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelflake.functions import (
    business_day,
    business_time,
    category_of,
    cleaned_price,
    currency_of,
    day_key,
    file_key,
    file_name,
    lake_keys,
    short_title,
    to_double,
    to_long,
    without_extension,
)

few = settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def evaluate(spark, texts, *columns):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    rows = frame.select("i", *columns).orderBy("i").collect()
    return [tuple(row)[1:] for row in rows]


PRICES = [
    ("$1,299.99", "USD", "1299.99", "1299.99"),
    ("€1.299,99", "EUR", "1.29999", "1.30"),
    ("£5", "GBP", "5", "5.00"),
    ("CA$12.50", "USD", "12.50", "12.50"),
    ("$12.99 - $15.99", "USD", "129915.99", "129915.99"),
    ("€5 ($6)", "USD", "56", "56.00"),
    ("1.2.3.4", "Unknown", "123.4", "123.40"),
    ("...", "Unknown", ".", None),
    ("$.99", "USD", ".99", "0.99"),
    ("5.", "Unknown", "5.", "5.00"),
    ("1.005", "Unknown", "1.005", "1.01"),
    ("$1234567890.12", "USD", "1234567890.12", None),
    ("None", "Unknown", "", None),
    ("", "Unknown", "", None),
    (None, "Unknown", None, None),
    ("$٣.50", "USD", ".50", "0.50"),
    ("$1\n2.5", "USD", "12.5", "12.50"),
]


def test_prices(spark):
    v = F.col("v")
    got = evaluate(
        spark,
        [price for price, *_ in PRICES],
        currency_of(v),
        cleaned_price(v),
        cleaned_price(v).try_cast("decimal(10,2)"),
    )
    want = [
        (currency, cleaned, amount and Decimal(amount)) for _, currency, cleaned, amount in PRICES
    ]
    assert got == want


@few
@given(st.lists(st.text("0123456789.,$€£ x\n", max_size=25), min_size=1, max_size=80))
def test_cleaned_price_keeps_only_the_last_dot(spark, texts):
    def expected(text):
        kept = "".join(c for c in text if c in "0123456789.")
        *head, last = kept.split(".")
        return "".join(head) + "." + last if head else kept

    got = evaluate(spark, texts, cleaned_price(F.col("v")))
    assert [value for (value,) in got] == [expected(text) for text in texts]


TITLES = [
    ("Foo, Bar | Baz", "Foo"),
    ("Foo | Bar", "Foo "),
    ("Foo", "Foo"),
    ("a|b,c", "a|b"),
    (", x", ""),
    ("|x", ""),
    ("", ""),
    (None, None),
]


def test_short_titles(spark):
    got = evaluate(spark, [title for title, _ in TITLES], short_title(F.col("v")))
    assert [value for (value,) in got] == [short for _, short in TITLES]


@few
@given(st.lists(st.text("ab,| ", max_size=12), min_size=1, max_size=80))
def test_short_title_is_a_two_step_cut(spark, texts):
    def expected(text):
        cut = text.split(",")[0]
        return text.split("|")[0] if cut == text else cut

    got = evaluate(spark, texts, short_title(F.col("v")))
    assert [value for (value,) in got] == [expected(text) for text in texts]


NUMBERS = [
    " 12 ", "12", "1e3", "1E+03", "1.", "1.0", "+5", "-0", "\t7\n", "1,234", "n/a", "", "  ",
    "1d", "1.5f", "2F", "1.0d ", "0x10", "0x1p3", "inf", "-Infinity", "nan", "NaN", "1e400",
    "-1e400", "1e30", "1_000", "1 2", "True", "None", "1.5", ".5", "\x0012", "\x1f12", "٣",
]


def pandas_number(text):
    """What pandas makes of the text, with its missing value as None."""
    value = pd.to_numeric(pd.Series([text]), errors="coerce").iloc[0]
    return None if pd.isna(value) else float(value)


def test_numbers_agree_with_pandas(spark):
    got = evaluate(spark, NUMBERS, to_double(F.col("v")), to_long(F.col("v")))
    for text, (double, long) in zip(NUMBERS, got):
        want = pandas_number(text)
        assert double == want, text
        whole = want is not None and abs(want) < 2**63 and want == int(want)
        assert long == (int(want) if whole else None), text


@few
@given(st.lists(st.text("0123456789.eE+- dfx", max_size=7), min_size=1, max_size=80))
def test_any_numeric_text_agrees_with_pandas(spark, texts):
    got = evaluate(spark, texts, to_double(F.col("v")))
    for text, (value,) in zip(texts, got):
        want = pandas_number(text)
        if want is not None:
            want = pytest.approx(want, rel=1e-12)
        assert value == want, repr(text)


def test_long_keeps_all_digits(spark):
    texts = ["9007199254740993", "9223372036854775807", "9223372036854775808", None]
    got = evaluate(spark, texts, to_long(F.col("v")))
    assert [value for (value,) in got] == [9007199254740993, 9223372036854775807, None, None]


def test_business_day_moves_back_over_midnight():
    assert business_day(datetime(2024, 1, 1, 3, 0)) == date(2023, 12, 31)
    assert business_day(datetime(2024, 1, 1, 5, 0)) == date(2024, 1, 1)
    eastern = timezone(timedelta(hours=-5))
    assert business_day(datetime(2023, 12, 31, 23, 0, tzinfo=eastern)) == date(2023, 12, 31)
    assert business_day(datetime(2024, 1, 1, 3, 0), offset_hours=0) == date(2024, 1, 1)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_clock_does_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        stamp = business_time(datetime(2024, 3, 10, 7, 30, 0, 5))
        row = spark.range(1).select(
            stamp.alias("at"), day_key(stamp).alias("day_key"), *lake_keys(stamp).values()
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    # In New York that wall-clock time does not exist.
    assert tuple(row) == (datetime(2024, 3, 10, 2, 30, 0, 5), "20240310", "2024", "03", "10")


PATHS = [
    ("s3://b/amazonbestsellers_kitchen_20240101.parquet", "amazonbestsellers_kitchen_20240101", "kitchen"),
    ("s3://b/amazonbestsellers_toys-and-games_20240101.parquet",
     "amazonbestsellers_toys-and-games_20240101", "toys-and-games"),
    ("/x/amazonbestsellers_a_b_20240101.parquet", "amazonbestsellers_a_b_20240101", "a"),
    ("/x/amazonbestsellers.parquet", "amazonbestsellers", ""),
    ("/x/amazonbestsellers_kitchen.parquet", "amazonbestsellers_kitchen", ""),
    ("/x/amazonbestsellers_a_1.parquet.parquet", "amazonbestsellers_a_1.parquet", "a"),
    ("/x/snapshot_key=amazonbestsellers_kitchen_20240101/part-0.parquet",
     "amazonbestsellers_kitchen_20240101", "kitchen"),
    ("/x/snapshot_key=amazonbestsellers_a%3Ab_1/part-0.parquet", "amazonbestsellers_a:b_1", "a:b"),
    ("/x/amazonbestsellers_kit chen_20240101.parquet",
     "amazonbestsellers_kit chen_20240101", "kit chen"),
]


def test_paths(spark):
    key = file_key(F.col("v"))
    got = evaluate(spark, [path for path, *_ in PATHS], key, category_of(key))
    assert got == [(key, category) for _, key, category in PATHS]


def test_file_name_and_extension(spark):
    name = file_name(F.col("v"))
    got = evaluate(spark, ["s3://b/x/y.parquet", "y.parquet.bak"], name, without_extension(name))
    assert got == [("y.parquet", "y"), ("y.parquet.bak", "y.parquet.bak")]


ODD_PATHS = [
    ("", "", ""),
    ("x", "x", "x"),
    ("/x/", "", ""),
    ("/snapshot_key=k/", "", ""),
    ("snapshot_key=k/part", "part", "part"),
    ("/snapshot_key=/part", "part", "part"),
    ("/snapshot_key=k/a/part", "part", "part"),
    ("/a/snapshot_key=k.parquet/part", "part", "k.parquet"),
    ("a.parquet/part", "part", "part"),
    ("/.parquet/part", "part", "part"),
    ("//a.parquet.parquet/p.parquet", "p.parquet", "a.parquet"),
    ("/x/.parquet", ".parquet", ""),
    ("/x/a.parquet\n", "a.parquet\n", "a\n"),
    ("/x/a.parquet.b", "a.parquet.b", "a.parquet.b"),
    ("/é/snapshot_key=é%20😀/p", "p", "é 😀"),
    (None, None, None),
]

ODD_KEYS = [
    ("amazonbestsellers__a_b_", ""),
    ("amazonbestsellers__amazonbestsellers_c_1", "c"),
    ("my_amazonbestsellers_c_1", "c"),
    ("amazonbestsellers_c_", "c"),
    ("amazonbestsellers_", ""),
    (None, None),
]


def test_odd_paths(spark):
    got = evaluate(spark, [path for path, *_ in ODD_PATHS], file_name(F.col("v")), file_key(F.col("v")))
    assert got == [tuple(rest) for _, *rest in ODD_PATHS]


def test_odd_keys(spark):
    got = evaluate(spark, [key for key, _ in ODD_KEYS], category_of(F.col("v")))
    assert got == [(category,) for _, category in ODD_KEYS]


def test_long_paths_are_cut_and_not_searched(spark):
    # A pattern that is tried at every character of the name takes minutes here.
    path = F.concat(F.lit("/"), F.repeat(F.col("v"), 300_000), F.lit(".parquet/part-0.parquet"))
    began = time.monotonic()
    got = evaluate(spark, ["k"], file_name(path), F.length(file_key(path)))
    assert got == [("part-0.parquet", 300_000)]
    assert time.monotonic() - began < 15


def test_tiny_fractions_are_no_longs(spark):
    texts = ["1e-20", "1e-400", "0.0", "-0", "1e2", "120e-1", "12.50e1"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in frame.select(to_long(F.col("t"))).collect()] == [None, None, 0, 0, 100, 12, 125]

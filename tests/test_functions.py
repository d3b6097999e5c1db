import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalake.functions import dates, text, values


def one(spark, column, **cells):
    """Value of a column expression over a single row."""
    df = spark.createDataFrame([tuple(cells.values())], list(cells)) if cells else spark.range(1)
    return df.select(column.alias("out")).first().out


@pytest.mark.parametrize(
    "price,tier",
    [(49.99, "Budget"), (50.0, "Mid-range"), (199.99, "Mid-range"), (200.0, "Premium"), (499.99, "Premium"), (500.0, "Luxury")],
)
def test_price_tier(spark, price, tier):
    assert one(spark, values.price_tier(F.col("p")), p=price) == tier


@pytest.mark.parametrize("raw,shown", [("e-commerce", "E-Commerce"), ("IT services", "It Services"), ("a1b c", "A1b C"), ("", "")])
def test_title_case(spark, raw, shown):
    assert one(spark, text.title_case(F.col("c")), c=raw) == shown


def test_surrogate_key(spark):
    assert one(spark, values.surrogate_key(F.lit(42))) == "a1d0c6e83f027327d8461063f4ac58a6"


def test_empty_to_null_and_whitelist(spark):
    assert one(spark, text.empty_to_null(F.col("c")), c="  ") is None
    assert one(spark, text.whitelist(F.col("c"), ["B2B", "VIP"], "B2C"), c="vip") == "VIP"
    assert one(spark, text.whitelist(F.col("c"), ["B2B", "VIP"], "B2C"), c="other") == "B2C"


@pytest.mark.parametrize("size,shown", [(0, "0.00 B"), (1023, "1023.00 B"), (1024, "1.00 KiB"), (1536 * 1024, "1.50 MiB"), (1024**4, "1.00 TiB")])
def test_readable_size(spark, size, shown):
    assert one(spark, text.readable_size(F.lit(size))) == shown


def test_format_cells(spark):
    df = spark.createDataFrame(
        [(1234567, 1234.5, 0.12345, Decimal("9.5"), dt.date(2024, 1, 2), None)],
        "a bigint, b double, c double, d decimal(10,2), e date, f string",
    )
    assert tuple(text.format_cells(df).first()) == ("1,234,567", "1,234.50", "0.1235", "9.50", "2024-01-02", "—")


def test_parse_timestamp_gives_null_for_rubbish(spark):
    assert one(spark, text.parse_timestamp(F.col("c")), c="not a date") is None
    assert one(spark, text.parse_timestamp(F.col("c")).cast("string"), c="2024-01-02T03:04:05Z") == "2024-01-02 03:04:05"


def test_days_between_counts_midnights(spark):
    moments = {"a": dt.datetime(2024, 1, 1, 23, 59), "b": dt.datetime(2024, 1, 2, 0, 1)}
    assert one(spark, dates.days_between(F.col("a"), F.col("b")), **moments) == 1


def test_synthetic_bucket_and_rating(spark):
    df = spark.createDataFrame([(1,), (5,), (200,), (201,)], "post_id bigint")
    out = df.select(values.synthetic_bucket(F.col("post_id"), 200), F.col("post_id") % 5 + 1).collect()
    assert [tuple(r) for r in out] == [(1, 2), (5, 1), (200, 1), (1, 2)]


def test_growth_needs_a_positive_base(spark):
    df = spark.createDataFrame([(110, 100), (50, 0), (50, None)], "now int, before int")
    assert [r[0] for r in df.select(values.growth_pct(F.col("now"), F.col("before"))).collect()] == [10.0, None, None]


def test_unknown_units_are_refused():
    with pytest.raises(ValueError):
        dates.shift_date(F.lit("2024-01-01"), 1, "year")
    with pytest.raises(ValueError):
        dates.in_last(F.lit("2024-01-01"), 1, "year", "2024-01-01")


@settings(max_examples=25, deadline=None)
@given(st.lists(st.datetimes(dt.datetime(1995, 1, 1), dt.datetime(2030, 1, 1)), min_size=1, max_size=20))
def test_calendar_parts_never_lie_after_the_moment(spark, moments):
    df = dates.calendar_parts(spark.createDataFrame([(m,) for m in moments], "t timestamp"), "t")
    bad = df.filter((F.col("t_month") > F.col("t_day")) | (F.col("t_week") > F.col("t_day")) | (F.col("t_hour") > F.col("t")) | (F.dayofweek("t_week") != 2))
    assert bad.isEmpty()


def test_time_spine(spark):
    from stratalake.plans.semantic import densify, spine_of, time_spine

    spine = time_spine(spark.range(1), "2020-01-01", "2030-12-31")
    assert spine.count() == 4018
    series = spark.createDataFrame([(dt.date(2024, 1, 1), 3), (dt.date(2024, 1, 3), 4)], "day date, n bigint")
    dense = densify(series, spine_of(series, "day"), "day", zero=["n"]).orderBy("date_day")
    assert [r.n for r in dense.collect()] == [3, 0, 4]


def test_sessions_keep_their_own_settings(spark):
    from stratalake.session import RUNTIME_SETTINGS, prepare

    prepare(spark)
    assert all(spark.conf.get(k) == v for k, v in RUNTIME_SETTINGS.items())

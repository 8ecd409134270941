import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from reelrank.functions import calendar, scoring, text


def column(spark, value, expression, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(expression(F.col("v")).alias("o")).first().o


@pytest.mark.parametrize(
    "share, score, rating",
    [(0.0, 0.006693, 1), (0.25, 0.075858, 1), (0.5, 0.5, 3), (0.75, 0.71095, 4), (1.0, 0.858149, 5), (2.0, 0.995504, 5)],
)
def test_activation_and_rating(spark, share, score, rating):
    assert column(spark, share, scoring.activation, "double") == pytest.approx(score, abs=1e-6)
    assert column(spark, share, lambda c: scoring.implied_rating(scoring.activation(c)), "double") == rating


def test_activation_of_null(spark):
    assert column(spark, None, scoring.activation, "double") is None


def test_trend_weights():
    weights = scoring.hamming_trend_weights(7)
    assert sum(w * c for w, c in zip(weights, [3, 0, 2, 5, 1, 7, 4])) == pytest.approx(0.0512048193)
    for window in (3, 7, 10):
        assert sum(scoring.hamming_trend_weights(window)) == pytest.approx(0)
    assert scoring.hamming_trend_weights(10)[-1] == pytest.approx(0.289955555432)


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2023-04-05 06:07:08", dt.datetime(2023, 4, 5, 6, 7, 8)),
        ("2023-04-05 06:07:08.25", dt.datetime(2023, 4, 5, 6, 7, 8, 250000)),
        ("2023-04-05T06:07:08", dt.datetime(2023, 4, 5, 6, 7, 8)),
        ("2023-04-05T06:07:08+03:00", dt.datetime(2023, 4, 5, 3, 7, 8)),
        ("2023-04-05 06:07:08.5 -0130", dt.datetime(2023, 4, 5, 7, 37, 8, 500000)),
        ("2023-04-05T06:07:08Z", dt.datetime(2023, 4, 5, 6, 7, 8)),
        ("2023/04/05", dt.datetime(2023, 4, 5)),
        ("2023/04/05 06:07:08", dt.datetime(2023, 4, 5, 6, 7, 8)),
        ("05-04-2023 06:07:08", dt.datetime(2023, 5, 4, 6, 7, 8)),
        ("05-04-2023", dt.datetime(2023, 5, 4)),
        ("Apr 5, 2023 06:07", dt.datetime(2023, 4, 5, 6, 7)),
        ("Apr 5, 2023", dt.datetime(2023, 4, 5)),
        ("2023-04-05", dt.datetime(2023, 4, 5)),
        ("05.04.2023 06:07:08", dt.datetime(2023, 5, 4, 6, 7, 8)),
        ("04/05/2023", dt.datetime(2023, 4, 5)),
        ("unknown", None),
        (None, None),
    ],
)
def test_mixed_datetimes(spark, value, expected):
    assert column(spark, value, calendar.parse_datetime) == expected


def mixed_texts():
    """Dates in every layout, with and without a time."""
    dates = [dt.date(2024, 5, 1), dt.date(2024, 1, 13), dt.date(2023, 12, 25), dt.date(1999, 12, 12), dt.date(2024, 2, 29)]
    layouts = ["{m:02}-{d:02}-{y}", "{d:02}-{m:02}-{y}", "{m}.{d}.{y}", "{d:02}.{m:02}.{y}", "{m:02}/{d:02}/{y}", "{d}/{m}/{y}"]
    layouts += ["{y}-{m:02}-{d:02}", "{y}/{m}/{d}", "{y}.{m:02}.{d:02}", "{b} {d}, {y}", "{d} {b} {y}", "{B} {d} {y}"]
    times = ["", " 06:07:08", " 6:07", " 23:59:59.25", " 3:04:05 PM", " 11:30 am", " 06:07:08Z", " 06:07:08+03:00", " 06:07:08 -0130"]
    for day in dates:
        for layout in layouts:
            text = layout.format(y=day.year, m=day.month, d=day.day, b=day.strftime("%b"), B=day.strftime("%B"))
            yield from (text + t for t in times if not ("b" in layout.lower() and (":08" in t and t[-1:] != "8" or "." in t)))
    yield from ["20240113", " 2024-01-13 ", "05-01-2024 10:00:00", "05.01.2024", "13/01/2024"]
    yield from ["2023-13-04", "2023/13/04", "00/01/2023", "2023-04-31", "13/13/2023", "unknown", "no date 1"]


def test_mixed_datetimes_as_pandas_reads_them(spark):
    """Month first, day first only where a month cannot stand there; what one reader refuses the other refuses."""
    texts = list(mixed_texts())
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", calendar.parse_datetime(F.col("t")).alias("ts")).collect()
    for r in got:
        try:
            want = pd.to_datetime(pd.Series([r.t]), format="mixed", utc=True)[0].to_pydatetime().replace(tzinfo=None)
        except ValueError:
            want = None
        assert r.ts == want, r.t


@pytest.mark.parametrize(
    "value, layout",
    [
        ("05-01-2024", "either"), ("13/01/2024 10:00", "day first"), ("01/13/2024", "month first"), ("05.05.2024", "month first"),
        ("2024-05-01", "year first"), ("May 1, 2024", "other"), ("20240501", "other"), ("soon", "unread"), ("13/13/2024", "unread"),
        (" ", None), (None, None),
    ],
)
def test_date_layout(spark, value, layout):
    assert column(spark, value, calendar.date_layout) == layout


@pytest.mark.parametrize(
    "day, weekday, week", [(dt.datetime(2024, 1, 1), 0, 1), (dt.datetime(2021, 1, 1), 4, 53), (dt.datetime(2024, 1, 6), 5, 1)]
)
def test_calendar(spark, day, weekday, week):
    df = spark.createDataFrame([(day,)], "ts timestamp_ntz")
    row = df.select(*[c.alias(n) for n, c in calendar.calendar_columns(F.col("ts")).items()]).first()
    assert (row.day_of_week, row.week_number, row.is_weekend) == (weekday, week, int(weekday >= 5))


def test_day_parts(spark):
    hours = spark.range(24).select(F.expr("timestampadd(HOUR, int(id), timestamp_ntz'2024-01-01 00:30:00')").alias("ts"))
    parts = [r.p for r in hours.select(calendar.day_part(F.col("ts")).alias("p")).collect()]
    assert parts == ["night"] * 6 + ["morning"] * 6 + ["day"] * 6 + ["evening"] * 6


def test_week_index_does_not_wrap(spark):
    days = [dt.datetime(2023, 12, 31), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 7), dt.datetime(2024, 1, 8)]
    df = spark.createDataFrame([(d,) for d in days], "ts timestamp_ntz")
    a, b, c, d = [r.w for r in df.select(calendar.week_index(F.col("ts")).alias("w")).collect()]
    assert (b - a, c - b, d - c) == (1, 0, 1)


@pytest.mark.parametrize(
    "ts, days",
    [
        (dt.datetime(2023, 8, 21), 1),
        (dt.datetime(2023, 8, 21, 0, 0, 1), 0),
        (dt.datetime(2023, 8, 22), 0),
        (dt.datetime(2023, 8, 22, 12), 0),
        (dt.datetime(2023, 8, 23), -1),
        (dt.datetime(2023, 8, 23, 23), -1),
        (dt.datetime(1995, 1, 1, 5), 10459),
    ],
)
def test_age_truncates_toward_zero(spark, ts, days):
    assert column(spark, ts, calendar.age_in_days, "timestamp_ntz") == days


def test_clean_text(spark):
    assert column(spark, "Ёлка, Дом 12\tдва", text.clean_text) == "лка дом два"
    assert column(spark, None, text.clean_text) == ""
    assert column(spark, "A-b C", lambda c: text.clean_text(c, text.LATIN)) == "ab c"


def test_lists(spark):
    assert column(spark, "[3, 7]", text.int_list) == [3, 7]
    assert column(spark, "[]", text.int_list) == []
    assert column(spark, "[3, 7]", text.raw_list) == ["3", " 7"]
    assert column(spark, "[]", text.raw_list) is None


@pytest.mark.parametrize("value, fine", [(None, True), ("", True), (" ", True), ("not a date", False), ("2023-13-45", False)])
def test_a_time_that_cannot_be_read_raises(spark, value, fine):
    if fine:
        assert column(spark, value, calendar.read_datetime) is None
    else:
        with pytest.raises(Exception, match="not a time"):
            column(spark, value, calendar.read_datetime)

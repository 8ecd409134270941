"""Calendar columns of a watch and ages of items."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Last hour (inclusive) of each part of the day.
DAY_PARTS = [(5, "night"), (11, "morning"), (17, "day"), (23, "evening")]
# Fixed value: the day against which the age of an item is measured.
AGE_REFERENCE = dt.datetime(2023, 8, 22)
# A Monday; weeks counted from it agree with ISO weeks inside a year and never wrap.
WEEK_ORIGIN = dt.date(1970, 1, 5)

# Dates in figures: two short numbers and the year, or the year first; a time may follow.
SHORT_FIRST = r"^(\d{1,2})[-./](\d{1,2})[-./](\d{4})(?:(?:\s+|T)(\S.*))?$"
YEAR_FIRST = r"^(\d{4})[-./](\d{1,2})[-./](\d{1,2})(?:(?:\s+|T)(\S.*))?$"
# Layouts tried where a plain cast understands nothing; names of months are cut to three letters, commas left out.
DATETIME_FORMATS = [
    "yyyy-MM-dd h:mm[:ss] a",
    "MMM d yyyy[ H:mm[:ss]]",
    "MMM d yyyy h:mm[:ss] a",
    "d MMM yyyy[ H:mm[:ss]]",
    "d MMM yyyy h:mm[:ss] a",
    "yyyyMMdd",
]
# A time of day followed by an offset from UTC.
OFFSET = r":\d{2}(\.\d+)?\s*(Z|[+-]\d{2}(:?\d{2})?)$"


def _short(text: Column, group: int) -> Column:
    return F.regexp_extract(text, SHORT_FIRST, group)


def _day_first(text: Column) -> Column:
    """The month cannot stand first: the first number is no month."""
    return _short(text, 1).try_cast("int") > 12


def _iso(text: Column) -> Column:
    """Dates in figures as yyyy-MM-dd with their time; other text without commas, its words of at most three letters.

    Of two short numbers the first is the month, unless it cannot be.
    """

    def put(year: Column, month: Column, day: Column, rest: Column) -> Column:
        date = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
        return F.concat_ws(" ", date, F.when(rest != "", F.upper(rest)))

    first, second = _short(text, 1), _short(text, 2)
    turned = F.when(_day_first(text), put(_short(text, 3), second, first, _short(text, 4)))
    turned = turned.otherwise(put(_short(text, 3), first, second, _short(text, 4)))
    by_year = put(*[F.regexp_extract(text, YEAR_FIRST, g) for g in (1, 2, 3, 4)])
    words = F.regexp_replace(F.regexp_replace(text, ",", " "), r"([A-Za-z]{3})[a-z]+", "$1")
    named = F.regexp_replace(F.initcap(F.regexp_replace(words, r"\s+", " ")), "([AP])m$", "$1M")
    return F.when(text.rlike(SHORT_FIRST), turned).when(text.rlike(YEAR_FIRST), by_year).otherwise(named)


def parse_datetime(text: Column, formats: list[str] = DATETIME_FORMATS) -> Column:
    """Timestamp from text in one of several layouts, in UTC where it has an offset; null where none fits."""
    clean = F.trim(text)
    iso = _iso(clean)
    attempts = [F.try_to_timestamp(iso, F.lit(f)).cast("timestamp_ntz") for f in formats]
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.coalesce(iso.try_cast("timestamp"), clean.try_cast("timestamp")).cast("timestamp_ntz"))
    return F.when(clean.rlike(OFFSET), utc).otherwise(F.coalesce(iso.try_cast("timestamp_ntz"), *attempts))


# Layouts of a date as ``date_layout`` names them. ``either`` is read month first, and could be meant the other way round.
LAYOUTS = ["year first", "month first", "day first", "either", "other", "unread"]


def date_layout(text: Column) -> Column:
    """How a date is written, by name; null for null or blank text."""
    clean = F.trim(text)
    second = _short(clean, 2).try_cast("int")
    short = F.when(_day_first(clean), "day first").when(second > 12, "month first")
    short = short.when(_short(clean, 1).try_cast("int") == second, "month first").otherwise("either")
    read = F.when(clean.rlike(SHORT_FIRST), short).when(clean.rlike(YEAR_FIRST), "year first").otherwise("other")
    return F.when(clean.isNull() | (clean == ""), None).when(parse_datetime(text).isNull(), "unread").otherwise(read)


def read_datetime(text: Column) -> Column:
    """Timestamp from text; null or blank text gives null, text that no layout fits raises."""
    unread = F.raise_error(F.concat(F.lit("not a time: "), text)).cast("timestamp_ntz")
    return F.coalesce(parse_datetime(text), F.when(F.trim(text) != "", unread))


def day_part(ts: Column) -> Column:
    hour = F.hour(ts)
    out = None
    for last_hour, name in DAY_PARTS:
        hit = hour <= last_hour
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def calendar_columns(ts: Column) -> dict[str, Column]:
    """Calendar features of a watch time, by column name."""
    return {
        "day": F.dayofmonth(ts),
        "day_of_week": F.weekday(ts),
        "day_of_year": F.dayofyear(ts),
        "hour": F.hour(ts),
        "day_part": day_part(ts),
        "is_weekend": F.weekday(ts).isin(5, 6).cast("int"),
        "week_number": F.weekofyear(ts),
    }


def week_index(ts: Column) -> Column:
    """Running number of the Monday-based week."""
    return F.floor(F.datediff(ts.cast("date"), F.lit(WEEK_ORIGIN)) / 7).cast("int")


def seconds_of(ts: Column) -> Column:
    """Whole seconds since the epoch day, monotone in ``ts`` in every time zone."""
    days = F.datediff(ts.cast("date"), F.lit(dt.date(1970, 1, 1))).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def age_in_days(ts: Column, reference: dt.datetime = AGE_REFERENCE) -> Column:
    """Full days from ``ts`` to the reference, truncated toward zero."""
    seconds = F.lit(int((reference - dt.datetime(1970, 1, 1)).total_seconds())) - seconds_of(ts)
    micros = seconds * 1_000_000 - (F.date_format(ts, "SSSSSS").cast("bigint"))
    return F.when(micros >= 0, F.floor(micros / 86_400_000_000)).otherwise(F.ceil(micros / 86_400_000_000)).cast("bigint")

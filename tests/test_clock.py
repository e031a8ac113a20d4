"""Wall-clock and text functions, independent of the session time zone."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.functions import clock, text

TS = "timestamp_ntz"


def stamp(s):
    return dt.datetime.fromisoformat(s)


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def one(spark, column, **values):
    cells = [F.lit(v).cast(TS).alias(k) for k, v in values.items()]
    return spark.range(1).select(*cells).select(column).first()[0]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("2024-03-10 02:29:59", "2024-03-10 02:00:00"),
        ("2024-03-10 02:30:00", "2024-03-10 03:00:00"),
        ("2024-03-10 02:00:00", "2024-03-10 02:00:00"),
        ("2024-12-31 23:45:10.5", "2025-01-01 00:00:00"),
    ],
)
def test_nearest_hour(spark, zone, given, expected):
    assert one(spark, clock.nearest_hour(F.col("t")), t=given) == stamp(expected)


@pytest.mark.parametrize(
    "a, b, minutes",
    [
        ("2024-03-10 01:15:31", "2024-03-10 03:15:30", 119),
        ("2024-01-01 09:00:30", "2024-01-01 09:00:00", 0),
        ("2024-01-01 09:02:00", "2024-01-01 09:00:30", 1),
    ],
)
def test_stay_minutes(spark, zone, a, b, minutes):
    assert one(spark, clock.stay_minutes(F.col("a"), F.col("b")), a=a, b=b) == minutes


@pytest.mark.parametrize(
    "way, given, expected",
    [
        ("in", "2024-01-02 00:00:45", "2024-01-02 00:01:45"),
        ("out", "2024-01-02 00:00:45", "2024-01-01 23:59:45"),
        ("in", "2024-01-02 00:01:00", "2024-01-02 00:01:00"),
        ("foo", "2024-01-02 00:00:00", "2024-01-02 00:00:00"),
    ],
)
def test_off_midnight(spark, way, given, expected):
    assert one(spark, clock.off_midnight(F.col("t"), F.lit(way)), t=given) == stamp(expected)


def test_parse(spark, zone):
    given = ["2024-03-10 02:45:00", "2024-13-01 00:00:00", "2024-01-05", "x", None, "2024-1-5 3:04:05"]
    df = spark.createDataFrame([(g,) for g in given], "t string")
    got = [r[0] for r in df.select(clock.parse(F.col("t"), T.StringType())).collect()]
    assert got == [stamp("2024-03-10 02:45:00"), None, None, None, None, stamp("2024-01-05 03:04:05")]


def test_time_group(spark):
    for hour, label in ((7, "8PM-7AM"), (8, "8AM-7PM"), (19, "8AM-7PM"), (20, "8PM-7AM")):
        assert one(spark, clock.time_group(F.col("t")), t=f"2024-01-01 {hour:02d}:00:00") == label


def test_day_bounds_and_bins(spark, zone):
    t = "2024-03-10 15:20:00"
    assert one(spark, clock.at_minute(F.col("t"), clock.DAY_START), t=t) == stamp("2024-03-10 00:01:00")
    assert one(spark, clock.at_minute(F.col("t"), clock.DAY_END), t=t) == stamp("2024-03-10 23:59:00")
    bins = one(spark, clock.hour_bins(F.col("a"), F.col("b")), a="2024-03-10 01:00:00", b="2024-03-10 04:00:00")
    assert [b.hour for b in bins] == [1, 2, 3, 4]


def test_text(spark):
    df = spark.createDataFrame([("Us ER 1", " O UT", "Site 01 Floor 22")], "e string, d string, f string")
    row = df.select(
        text.person_id(F.col("e")), text.direction(F.col("d")), text.facility(F.col("f"))
    ).first()
    assert tuple(row) == ("user1", "out", "SITE01FLOOR")
    assert spark.range(1).select(text.split_list(F.lit(" a, b ,c"))).first()[0] == ["a", "b", "c"]

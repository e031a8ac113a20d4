"""Balanced groups, batches, enrichment and duplicates."""

import datetime as dt
import random

import brute
import pytest
from pyspark.sql import functions as F

from turnstile.operators import dedup, enrich, grouping

M1, M2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


@pytest.mark.parametrize("capacity", [1, 7, 30, 1_000])
def test_balanced_groups(spark, capacity):
    rng = random.Random(capacity)
    months = {
        m: [(f"u{i}", rng.choice([1, 1, 1, 2, 3, 9, 25])) for i in range(n)] + [(None, 1)]
        for m, n in ((M1, 150), (M2, 41))
    }
    rows = [(e, m, c) for m, people in months.items() for e, c in people]
    df = spark.createDataFrame(rows, "eid string, month date, count bigint")
    got = {}
    for r in grouping.balanced_groups(df, capacity).collect():
        got.setdefault(r.month, {})[r.eid] = (r.Group, r.Cumulative_Sum)
    assert got == {m: brute.groups(people, capacity) for m, people in months.items()}


def test_first_count_above_capacity_opens_group_two(spark):
    df = spark.createDataFrame([("a", M1, 9), ("b", M1, 9)], "eid string, month date, count bigint")
    got = {r.eid: (r.Group, r.Cumulative_Sum) for r in grouping.balanced_groups(df, 5).collect()}
    assert got == {"a": (2, 9), "b": (3, 9)}


@pytest.mark.parametrize(
    "n, bounds",
    [
        (3, [1, 2, 3, 4, 5]),
        (4, [1, 2, 3, 4, 5]),
        (5, [1, 2, 3, 4, 5]),
        (6, [1, 2, 3, 4, 6]),
        (8, [1, 2, 3, 4, 8]),
        (11, [2, 4, 6, 8, 11]),
        (19, [4, 8, 12, 16, 19]),
        (20, [4, 8, 12, 16, 20]),
    ],
)
def test_batch_bounds(spark, n, bounds):
    df = spark.createDataFrame([(M1, n)], "month date, n bigint")
    out = grouping.batch_bounds(df, "n")
    assert list(out.first())[:5] == bounds
    members = grouping.batch_members(grouping.batch_ranges(out)).collect()
    assert sorted(r.number for r in members) == list(range(1, bounds[-1] + 1))


BADGES = "eid string, localtimestamp timestamp_ntz, messagetype string, rank bigint, month date, index_value bigint"


@pytest.fixture(params=["10MB", "-1"])
def broadcast_limit(spark, request):
    """With and without broadcast of the door mapping."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, request.param)
    yield
    spark.conf.set(key, before)


def test_enrich(spark, broadcast_limit):
    ts = dt.datetime(2024, 1, 2)
    rows = [("a", ts, "x", 1, M1, i) for i in range(30)]
    rows += [("b", ts, "x", 9, M1, 1), (None, ts, "x", 1, M1, 2), ("a", ts, "x", 1, M2, 3)]
    badges = spark.createDataFrame(rows, BADGES)
    doors = spark.createDataFrame([(1, "Door 1")], "rank bigint, Door string")
    groups = grouping.balanced_groups(grouping.eid_month_counts(badges), 10)
    assert enrich.enrich_badges(badges, groups, doors, 10).count() == len(rows) - 1  # index value 0
    got = enrich.enrich_badges(badges, groups, doors, 10, first_index=None)
    assert "rank" not in got.columns and got.count() == len(rows)
    seen = {(r.eid, r.month): (r.Group, r.oversized, r.door) for r in got.collect()}
    assert seen == {
        ("a", M1): (2, True, "Door 1"),
        ("b", M1): (1, False, None),
        (None, M1): (None, False, "Door 1"),
        ("a", M2): (1, False, "Door 1"),
    }


def test_keep_unique_and_first(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 3, "b"), (2, 9, "c")], "k int, v int, t string")
    assert [tuple(r) for r in dedup.keep_unique(df, ["k"]).collect()] == [(2, 9, "c")]
    assert sorted(tuple(r) for r in dedup.keep_first(df, ["k"], ["v"]).collect()) == [
        (1, 3, "b"),
        (2, 9, "c"),
    ]


def test_split_by_is_complete_with_nulls(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    met, rest = dedup.split_by(df, F.col("v") > 2)
    assert (met.count(), rest.count()) == (1, 2)

"""Run removal, tags and pairing against plain loops."""

import datetime as dt
import random

import brute
import pytest
from pyspark.sql import functions as F

from turnstile.operators import occupancy, sequence, stays
from turnstile.schemas import PERSON

SCHEMA = "eid string, localtimestamp timestamp_ntz, direction string, Facility string, index_value bigint"


def badge_frame(spark, rows, oversized=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if oversized == "some":  # every third person, whatever their number of rows
        flag = F.substring("eid", 2, 9).cast("int") % 3 == 0
    else:
        flag = F.lit(oversized)
    return df.withColumns(
        {"month": F.lit(brute.MONTH), "Group": F.lit(1).cast("bigint"), "oversized": flag}
    )


def check_cleaned(spark, rows, oversized):
    got = sequence.clean_sequence(badge_frame(spark, rows, oversized)).collect()
    actual = {
        ((r.eid, r.localtimestamp, r.direction, r.Facility, r.index_value), r.First_Tag, r.Last_Tag)
        for r in got
    }
    expected = {
        (row, int(first), int(last)) for person in brute.clean(rows).values() for row, first, last in person
    }
    assert len(got) == len(actual)
    assert actual == expected


@pytest.mark.parametrize("oversized", [False, True, "some"])
@pytest.mark.parametrize("spacing", [3, 40, 5_000])
def test_clean_sequence(spark, oversized, spacing):
    check_cleaned(spark, brute.random_swipes(spacing, spacing=spacing), oversized)


@pytest.mark.parametrize("oversized", [False, True])
def test_missing_times_come_last_both_ways(spark, oversized):
    check_cleaned(spark, brute.random_swipes(7, people=150, spacing=60, null_share=0.2), oversized)


@pytest.mark.parametrize("oversized", [False, True])
def test_stays_and_orphans(spark, oversized):
    rows = brute.random_swipes(11, people=120, spacing=30, null_share=0.05)
    cleaned = sequence.clean_sequence(badge_frame(spark, rows, oversized))
    pairs, lone = brute.stays(rows)
    got = stays.pair_stays(cleaned)
    assert sorted(
        (r.eid, r.Facility, r.time_in, r.time_out, r.Tag_Anomalous) for r in got.collect()
    ) == sorted(pairs)
    assert sorted(
        ((r.eid, r.localtimestamp, r.direction, r.Facility, r.index_value)
         for r in stays.orphans(cleaned).collect()), key=str
    ) == sorted(lone, key=str)


@pytest.mark.parametrize("oversized", [False, True])
@pytest.mark.parametrize("spacing", [900, 40_000, 200_000])
def test_hourly_occupancy(spark, oversized, spacing):
    rows = brute.random_swipes(spacing, spacing=spacing)
    cleaned = sequence.clean_sequence(badge_frame(spark, rows, oversized))
    hours = occupancy.expand_hours(occupancy.round_hours(stays.day_spans(cleaned)))
    got = {
        (r.Facility, dt.datetime.combine(r.Date, dt.time.fromisoformat(r.Bin_time))): (
            r.eid,
            r.eid_ex or 0,
        )
        for r in occupancy.hourly_occupancy(hours).collect()
    }
    assert got == brute.hourly(rows)


def test_cleaned_rows_alternate(spark):
    rows = brute.random_swipes(5, people=80)
    got = sequence.clean_sequence(badge_frame(spark, rows)).orderBy("eid", "localtimestamp", "direction")
    last = {}
    for r in got.collect():
        assert last.get(r.eid) != r.direction
        last[r.eid] = r.direction


def test_pair_numbers(spark):
    rows = brute.random_swipes(3, people=40)
    cleaned = sequence.clean_sequence(badge_frame(spark, rows))
    seen = {}
    for r in stays.number_pairs(stays.pair_stays(cleaned)).orderBy("eid", "time_in").collect():
        seen.setdefault(r.eid, []).append(r.Pair)
    assert seen and all(v == list(range(1, 2 * len(v), 2)) for v in seen.values())


def test_marking_needs_both_limits(spark):
    rows = [("a", None, "in", "F", i) for i in range(10)] + [("b", None, "in", "F", 0)]
    df = badge_frame(spark, rows).drop("oversized")
    marked = sequence.mark_oversized(df, 5).groupBy("eid").agg(F.max("oversized").alias("o"))
    assert dict(marked.collect()) == {"a": True, "b": False}


def test_unknown_directions_stay_out_of_the_sequence(spark):
    day = dt.datetime(2024, 1, 2)
    rows = [
        ("a", day.replace(hour=8), "in", "F", 1),
        ("a", day.replace(hour=9), "foo", "F", 1),
        ("a", day.replace(hour=10), "out", "F", 1),
    ]
    df = badge_frame(spark, rows)
    assert sequence.unknown_directions(df).count() == 1
    assert stays.pair_stays(sequence.clean_sequence(df)).count() == 1


def test_pairs_without_a_time_are_reported(spark):
    rows = [
        ("a", dt.datetime(2024, 1, 2, 8), "in", "F", 1),
        ("a", None, "out", "F", 2),
    ]
    cleaned = sequence.clean_sequence(badge_frame(spark, rows))
    assert stays.pair_stays(cleaned).count() == 0
    assert stays.orphans(cleaned).count() == 0
    assert stays.unpaired(cleaned).count() == 2


def test_a_person_over_capacity_is_marked_at_any_total(spark):
    """A share of all rows must not decide: one busy person among very many rows is still split."""
    many = spark.range(200_000).select(
        F.lit(1).alias("Group"), F.concat(F.lit("p"), F.col("id")).alias("eid"), F.lit("2024-01-01").cast("date").alias("month")
    )
    busy = spark.range(3).select(F.lit(1).alias("Group"), F.lit("busy").alias("eid"), F.lit("2024-01-01").cast("date").alias("month"))
    marked = sequence.mark_oversized(many.union(busy), 2).where("oversized")
    assert [r.eid for r in marked.collect()] == ["busy"] * 3


def test_simultaneous_swipes_without_index(spark):
    """An ordinary person is cleaned in the sort, an oversized one through the fold: the same rows, also where index
    values, facilities or times are missing and swipes coincide."""
    rng = random.Random(17)
    start = dt.datetime(2024, 1, 2, 8)
    rows = []
    for p in range(400):
        for _ in range(rng.randrange(1, 14)):
            stamp = None if rng.random() < 0.2 else start + dt.timedelta(seconds=20 * rng.randrange(6))
            index = None if rng.random() < 0.4 else rng.randrange(4)
            site = None if rng.random() < 0.1 else f"F{rng.randrange(3)}"
            rows += [(f"p{p}", stamp, rng.choice(["in", "out"]), site, index)] * rng.choice([1, 1, 2])
    columns = ("eid", "localtimestamp", "direction", "Facility", "index_value", "First_Tag", "Last_Tag", "partner_ts", "partner_Facility")
    got = [sorted(sequence.clean_sequence(badge_frame(spark, rows, o)).select(*columns).collect(), key=str) for o in (False, True)]
    folded = sequence.drop_runs(sequence.fold_simultaneous(badge_frame(spark, rows)), *PERSON)
    moments = sequence.drop_runs(sequence.first_of_moment(badge_frame(spark, rows)), *PERSON, order=sequence.moment_order())
    assert got[0] == got[1]
    assert sorted(folded.collect(), key=str) == sorted(moments.select(*folded.columns).collect(), key=str)

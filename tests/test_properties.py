"""Relations that hold on the whole of the test data."""

import pytest
from pyspark.sql import functions as F

from turnstile import schemas
from turnstile.operators import grouping, normalise, quality, rollup, sequence, stays
from turnstile.plans import queries as Q
from turnstile.sources import badge_view

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def cleaned(spark):
    rows = normalise.normalise_rows(badge_view.grouped_badges(spark, SF))
    return sequence.clean_sequence(rows).cache()


def test_known_counts(cleaned):
    assert cleaned.count() == 511
    assert stays.orphans(cleaned).count() == 17
    pairs = stays.pair_stays(cleaned)
    assert pairs.count() == 247 and pairs.where("Tag_Anomalous = 1").count() == 83
    days = stays.flag_stays(pairs).groupBy(F.least("day_diff", F.lit(2)).alias("d")).count()
    assert dict(days.collect()) == {0: 70, 1: 98, 2: 79}


def test_no_stay_ends_before_it_starts(cleaned):
    assert stays.pair_stays(cleaned).where("time_out < time_in").isEmpty()


def test_every_pair_has_two_badges(cleaned):
    profile = quality.quality_profile(cleaned)
    assert profile.where(
        F.col(schemas.TOTAL_BADGES) != 2 * F.col(f"`{schemas.ALL_PAIRS}`")
    ).isEmpty()
    assert profile.agg(F.sum(f"`{schemas.ORPHAN_BADGES}`")).first()[0] == 17


def test_rollup_keeps_the_sum(spark, cleaned):
    hourly = Q._hourly(stays.day_spans(cleaned))
    listed = hourly.select(F.col("Month").alias("date"))
    sums = [F.sum("eid"), F.sum("eid_ex")]
    assert hourly.agg(*sums).first() == rollup.peak_rollup(hourly, listed).agg(*sums).first()


def test_groups_keep_their_capacity(spark):
    counts = grouping.eid_month_counts(badge_view.badges(spark, SF))
    groups = grouping.balanced_groups(counts, Q.BUSY)
    size = groups.groupBy("month", "Group").agg(F.sum("count").alias("n"), F.count("*").alias("people"))
    assert size.where((F.col("n") > Q.BUSY) & (F.col("people") > 1)).isEmpty()

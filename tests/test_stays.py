"""Splitting, stand-ins for orphans, daily and hourly results on small frames."""

import datetime as dt

import pytest
from test_sequence import badge_frame

from turnstile import schemas
from turnstile.operators import occupancy, quality, sequence, stays


def at(day, clock="00:00:00", month=1, year=2024):
    return dt.datetime.combine(dt.date(year, month, day), dt.time.fromisoformat(clock))


def pair(eid, a, b, site="F", site_out=None):
    return [(eid, a, "in", site, 1), (eid, b, "out", site_out or site, 1)]


def cleaned(spark, *rows):
    return sequence.clean_sequence(badge_frame(spark, list(rows)))


def hours(spark, *rows):
    spans = stays.day_spans(cleaned(spark, *rows))
    return occupancy.hourly_occupancy(occupancy.expand_hours(occupancy.round_hours(spans)))


def test_single_in_and_single_out_become_hours(spark):
    rows = [("a", at(2, "08:15:00"), "in", "F", 1), ("b", at(2, "08:15:00"), "out", "F", 1)]
    got = {r.eid: r for r in stays.day_spans(cleaned(spark, *rows)).collect()}
    assert (got["a"].time_in, got["a"].time_out) == (at(2, "08:15:00"), at(2, "09:15:00"))
    assert (got["b"].time_in, got["b"].time_out) == (at(2, "07:15:00"), at(2, "08:15:00"))
    assert all(
        (r.duration_mins, r.Tag_Final, r.Tag_Anomalous, r.Tag_OverlyLongStay) == (60, 1, 1, 0)
        for r in got.values()
    )


def test_orphans_count_without_any_long_stay(spark):
    rows = [("a", at(2, "08:00:00"), "in", "F", 1), *pair("b", at(2, "09:00:00"), at(2, "10:00:00"))]
    daily = {r.eid: r.duration_mins for r in occupancy.eid_daily(stays.day_spans(cleaned(spark, *rows))).collect()}
    assert daily == {"a": 60, "b": 60}


def test_stay_over_one_midnight(spark):
    rows = pair("a", at(2, "22:00:00"), at(3, "01:30:00"))
    got = {r.precedence: r for r in stays.day_spans(cleaned(spark, *rows)).collect()}
    assert set(got) == {stays.SECOND_DAY, stays.FIRST_DAY}
    assert got[stays.SECOND_DAY].time_in == at(3, "00:01:00") and got[stays.SECOND_DAY].duration_mins == 89
    assert got[stays.FIRST_DAY].time_out == at(2, "23:59:00") and got[stays.FIRST_DAY].duration_mins == 119


def test_stay_over_new_year(spark):
    rows = pair("a", at(31, "22:00:00", month=12, year=2023), at(1, "02:00:00"))
    assert stays.day_spans(cleaned(spark, *rows)).count() == 2


def test_long_stay_leaves_its_ends(spark):
    rows = pair("a", at(2, "22:00:00"), at(5, "06:00:00"))
    got = {r.precedence: (r.time_in, r.time_out) for r in stays.day_spans(cleaned(spark, *rows)).collect()}
    assert got == {
        stays.LONG_IN: (at(2, "22:00:00"), at(2, "23:00:00")),
        stays.LONG_OUT: (at(5, "05:00:00"), at(5, "06:00:00")),
    }


@pytest.mark.parametrize("minutes, long", [(719, 0), (720, 1)])
def test_overly_long(spark, minutes, long):
    rows = pair("a", at(2, "08:00:00"), at(2, "08:00:00") + dt.timedelta(minutes=minutes))
    got = stays.flag_stays(stays.pair_stays(cleaned(spark, *rows))).first()
    assert (got.Tag_OverlyLongStay, got.Tag_Final, got.duration_mins_v2) == (long, long, minutes)


def test_out_takes_the_facility_of_its_in(spark):
    rows = pair("a", at(2, "08:00:00"), at(2, "09:00:00"), "F", "G")
    out = stays.impute_facility(cleaned(spark, *rows)).where("direction = 'out'").first()
    assert (out.Facility, out["Original Facility"], out.Tag_Anomalous) == ("F", "G", 1)


def test_hour_without_a_sure_person(spark):
    rows = pair("a", at(2, "08:00:00"), at(2, "09:00:00"), "F", "G")
    assert {(r.eid, r.eid_ex) for r in hours(spark, *rows).collect()} == {(1, None)}


def test_earlier_stay_takes_precedence_in_a_shared_hour(spark):
    rows = pair("a", at(2, "08:00:00"), at(2, "09:10:00")) + pair("a", at(2, "09:20:00"), at(2, "10:00:00"), "F", "G")
    got = {r.Bin_time: r.eid_ex for r in hours(spark, *rows).collect()}
    assert got == {"08:00:00": 1, "09:00:00": 1, "10:00:00": None}


def test_short_stays_are_daily_but_not_hourly(spark):
    rows = pair("a", at(2, "08:00:00"), at(2, "08:29:59"))
    assert hours(spark, *rows).count() == 0
    daily = occupancy.eid_daily(stays.day_spans(cleaned(spark, *rows))).first()
    assert (daily.duration_mins, daily.badge, daily.duration_hrs) == (29, 1, 0.48)


def test_quality_buckets(spark):
    rows, expected = [], {}
    cases = {
        0: None, 30: "30minsPairsOfBadges_NotAnomalous", 31: None, 479: None,
        480: "8hrTo9hrPairsOfBadges_NotAnomalous", 539: "8hrTo9hrPairsOfBadges_NotAnomalous",
        540: "9hrTo10hrPairsOfBadges_NotAnomalous", 2939: "48hrTo49hrPairsOfBadges_NotAnomalous",
        2940: "MoreThan49HourPairsOfBadges_NotAnomalous",
    }
    for minutes, metric in cases.items():
        start = at(2, "08:00:00")
        rows += pair(f"p{minutes}", start, start + dt.timedelta(minutes=minutes, seconds=20))
        if metric:
            expected[metric] = expected.get(metric, 0) + 1
    rows += pair("q", at(2, "08:00:00"), at(2, "08:30:00"), "F", "G")
    rows += [("r", at(2), "in", "H", 1)]
    got = {r.Facility: r.asDict() for r in quality.quality_profile(cleaned(spark, *rows)).collect()}
    f = got["F"]
    assert f.pop(schemas.ALL_PAIRS) == len(cases) + 1
    assert f.pop(schemas.TOTAL_BADGES) == 2 * (len(cases) + 1)
    assert f.pop(schemas.ANOMALOUS_PAIRS) == 1
    expected["30minsPairsOfBadges_Anomalous"] = 1
    assert {k: v for k, v in f.items() if k in schemas.duration_metrics() and v} == expected
    h = got["H"]  # a facility with orphans only keeps its group
    assert (h[schemas.ORPHAN_BADGES], h["Group"], h[schemas.ALL_PAIRS]) == (1, 1, 0)
    assert len(schemas.quality_metrics()) == 90

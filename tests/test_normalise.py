"""Normalisation of enriched badges."""

import datetime as dt

from turnstile.operators import normalise, sequence

SCHEMA = (
    "eid string, localtimestamp string, direction string, messagetype string, month date, "
    "index_value bigint, Group bigint, door string"
)
MONTH = dt.date(2024, 1, 1)


def row(eid="A", ts="2024-01-02 08:00:00", way="In", kind="x", index=1, group=1, door="Site 01 Floor 1"):
    return (eid, ts, way, kind, MONTH, index, group, door)


def frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_copies_go_before_text_is_normalised(spark):
    # Rows that become equal only through normalisation both stay.
    got = normalise.normalise_badges(frame(spark, row(eid="A B"), row(eid="ab"), row(eid="ab")))
    assert [r.eid for r in got.collect()] == ["ab", "ab"]


def test_rows_without_key_go(spark):
    rows = [row(), row(eid=None), row(door=None), row(way=None), row(group=None), (None,) * 8]
    assert normalise.normalise_badges(frame(spark, *rows)).count() == 1


def test_bad_time_stays_as_null(spark):
    got = normalise.normalise_badges(frame(spark, row(ts="nonsense"))).first()
    assert got.localtimestamp is None and got.DateOnly is None


def test_one_row_group(spark):
    got = normalise.normalise_badges(frame(spark, row(way=" OUT ", ts="2024-01-02 00:00:10"))).first()
    assert (got.direction, got.Facility, got.Group) == ("out", "SITE01FLOOR", 1)
    assert got.localtimestamp == dt.datetime(2024, 1, 1, 23, 59, 10)
    assert got.DateOnly == dt.date(2024, 1, 2)


def test_folding_covers_removal_of_copies(spark):
    rows = [row(), row(), row(index=2), row(way="out", ts="2024-01-02 09:00:00")] * 3
    df = frame(spark, *rows)
    a = sequence.clean_sequence(normalise.normalise_rows(df))
    b = sequence.clean_sequence(normalise.normalise_badges(df))
    assert sorted(a.collect()) == sorted(b.collect()) and a.count() == 2


def test_spellings_in_other_groups_are_not_merged(spark):
    rows = [row(eid="A B"), row(eid="ab", group=2, way="out", ts="2024-01-02 10:00:00")]
    got = sequence.clean_sequence(normalise.normalise_rows(frame(spark, *rows))).collect()
    assert {(r.eid, r.Group, r.First_Tag, r.Last_Tag) for r in got} == {("ab", 1, 1, 1), ("ab", 2, 1, 1)}

"""Months to process and retention."""

import datetime as dt

import pytest

from turnstile.operators import months

D = dt.date


def badges(spark, *dates):
    return spark.createDataFrame([(d,) for d in dates], "month date")


def dates(df):
    return sorted(r.date for r in df.collect())


def test_listed_months_win(spark):
    got = months.processing_months(badges(spark), " 2024-01-01, 2024-03-01", "Weekly", D(2024, 5, 5))
    assert dates(got) == [D(2024, 1, 1), D(2024, 3, 1)]


@pytest.mark.parametrize(
    "today, present, expected",
    [
        (D(2024, 3, 5), [D(2024, 3, 1)], [D(2024, 2, 1), D(2024, 3, 1)]),
        (D(2024, 3, 5), [D(2024, 2, 1)], [D(2024, 2, 1)]),
        (D(2024, 3, 20), [D(2024, 3, 1)], [D(2024, 3, 1)]),
        (D(2024, 3, 20), [], []),
        (D(2024, 1, 3), [D(2024, 1, 1)], [D(2023, 12, 1), D(2024, 1, 1)]),
    ],
)
def test_weekly(spark, today, present, expected):
    assert dates(months.processing_months(badges(spark, *present), "", "Weekly", today)) == expected


def test_monthly_takes_the_previous_month(spark):
    got = months.processing_months(badges(spark), "", "Monthly", D(2024, 1, 31))
    assert dates(got) == [D(2023, 12, 1)]


@pytest.mark.parametrize(
    "frequency, kept",
    [
        ("Weekly", [D(2023, 2, 1), D(2023, 3, 1), D(2024, 1, 1), None]),
        ("Monthly", [D(2023, 3, 1), D(2024, 1, 1), D(2024, 2, 1), D(2024, 3, 1), None]),
        ("Daily", [D(2023, 1, 1), D(2023, 2, 1), D(2023, 3, 1), D(2024, 1, 1), D(2024, 2, 1), D(2024, 3, 1), None]),
    ],
)
def test_retention(spark, frequency, kept):
    present = [D(2023, 1, 1), D(2023, 2, 1), D(2023, 3, 1), D(2024, 1, 1), D(2024, 2, 1), D(2024, 3, 1), None]
    table = spark.createDataFrame([(d,) for d in present], "Month date")
    listed = spark.createDataFrame([(D(2024, 2, 1),), (D(2024, 3, 1),)], "date date")
    got = [r.Month for r in months.retain(table, listed, frequency).collect()]
    assert sorted(got, key=str) == sorted(kept, key=str)


def test_retention_with_an_empty_list(spark):
    table = spark.createDataFrame([(D(2020, 1, 1),)], "Month date")
    assert months.retain(table, spark.createDataFrame([], "date date"), "Weekly").count() == 1

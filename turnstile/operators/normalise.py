"""Normalisation of enriched badges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.functions import clock, text


def normalise_rows(badges: DataFrame) -> DataFrame:
    """Row-wise clean-up: parse, normalise text, drop rows without a key, move midnight swipes.

    Exact copies stay; `clean_sequence` folds them together with other
    simultaneous swipes, so the monthly jobs need no separate distinct shuffle.
    Empty rows need no rule of their own here: they have no group.
    """
    return _normalise_text(_parse(badges))


def normalise_badges(badges: DataFrame) -> DataFrame:
    """Like `normalise_rows`, with exact copies of raw rows removed first."""
    return _normalise_text(_parse(badges.na.drop(how="all")).dropDuplicates())


def _parse(badges: DataFrame) -> DataFrame:
    stamp = clock.parse(F.col("localtimestamp"), badges.schema["localtimestamp"].dataType)
    return badges.withColumn("localtimestamp", stamp)


def _normalise_text(parsed: DataFrame) -> DataFrame:
    ts = F.col("localtimestamp")
    return (
        parsed.where(F.col("Group").isNotNull())
        .withColumns(
            {
                "eid": text.person_id(F.col("eid")),
                "Facility": text.facility(F.col("door")),
                "direction": text.direction(F.col("direction")),
            }
        )
        .na.drop(subset=["eid", "door", "direction"])
        .drop("messagetype", "door")
        .withColumn("DateOnly", F.to_date(ts))
        .withColumn("localtimestamp", clock.off_midnight(ts, F.col("direction")))
    )

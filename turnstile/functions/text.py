"""Text clean-up of badge fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FACILITY_LENGTH = 11  # fixed value: leading characters of a door name that name its facility


def squeeze(c: Column) -> Column:
    """Remove every space, also inside the text."""
    return F.replace(c, F.lit(" "), F.lit(""))


def person_id(c: Column) -> Column:
    return squeeze(F.lower(c))


def direction(c: Column) -> Column:
    return squeeze(F.lower(c))


def facility(door: Column) -> Column:
    return F.upper(F.substring(squeeze(door), 1, FACILITY_LENGTH))


def split_list(c: Column) -> Column:
    """Split a comma list into trimmed items."""
    return F.transform(F.split(c, ","), lambda item: F.trim(item))

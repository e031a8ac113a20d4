"""URL allow and block rules by a sort-merge range join over reversed hosts."""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm.common import ascii_lower

ROWS_PER_RANGE = 20_000
MIN_RANGES = 32
MAX_SPLITTERS = 10_000  # bound of what the driver keeps of the keys


def host_of(url: Column) -> Column:
    """After the first ://, up to a slash, question mark, hash or the end; empty without ://."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """From the end of the host up to a question mark, hash or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each followed by a dot: subdomains follow their parent."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _splitters(keyed: DataFrame, ranges: int) -> list[tuple[str, int]]:
    """Borders between ranges of about as many rows, from the rows with the smallest hashes.

    They only decide which task reads which rows, never a verdict.
    """
    sample = keyed.select("key", "salt").orderBy("salt", "key").limit(min(MAX_SPLITTERS, ranges * 16))
    rows = sorted((r["key"], r["salt2"]) for r in sample.withColumn("salt2", F.xxhash64("salt")).collect())
    return sorted({rows[len(rows) * k // ranges] for k in range(1, ranges)}) if rows else []


class _Rules:
    """The stack of active rules: one entry for each host around the current key."""

    def __init__(self):
        self.entries: list[tuple[str, str, dict, set]] = []  # (first key, end of keys, path -> rule, path lengths)

    def close(self, key: str) -> None:
        """Drop what ends at or before the key."""
        while self.entries and self.entries[-1][1] <= key:
            self.entries.pop()

    def open(self, low: str, high: str, path: str, rule: tuple) -> None:
        if not self.entries or self.entries[-1][0] != low:
            self.entries.append((low, high, {}, set()))
        _, _, paths, lengths = self.entries[-1]
        paths[path] = min(paths.get(path, rule), rule)
        lengths.add(len(path))

    def longest(self, path: str) -> tuple | None:
        """The longest rule that fits; of equally long ones that of the longer host."""
        best = None
        for low, _, paths, lengths in self.entries:
            for n in lengths:
                rule = paths.get(path[:n]) if n <= len(path) else None
                if rule is not None and (best is None or (len(low) + n, len(low)) >= best[0]):
                    best = ((len(low) + n, len(low)), rule)
        return best[1] if best else None


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of pages.

    `rules` has host, path and verdict. A rule fits its host and all subdomains if the path of the url starts with
    its path; the longest (host and path together, then host) wins, and `default` holds where none fits. Equal
    rules with different verdicts: block wins. Rules with a null, or an empty host, fit nothing; A-Z in hosts is
    lower-cased. A null url, or one without ://, has empty host and path, which no rule fits. Repeated pages give
    repeated rows; ids may be null; empty tables give empty results or the default; other columns are ignored.

    A host becomes the key of its reversed labels, so a rule covers an interval of keys and intervals nest. Pages and
    rules are dealt into key ranges; a rule is copied to every range that its interval touches, which besides one copy
    a rule is as many as rules nest at the borders. Each range is swept in key order with a stack of active rules. A
    second sort column spreads a key that many pages share over several ranges.
    """
    spark = pages.sparkSession
    parts = pages.select(
        F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")
    )
    keyed = parts.withColumns({"key": host_key(F.col("host")), "salt": F.xxhash64("path", "page_id")})
    ranges = max(MIN_RANGES, -(-parts.count() // rows_per_range))
    splitters = spark.sparkContext.broadcast(_splitters(keyed, ranges))  # bounded by MAX_SPLITTERS

    @F.pandas_udf("int")
    def range_of(key: pd.Series, salt: pd.Series) -> pd.Series:
        borders = splitters.value
        return pd.Series([bisect.bisect_right(borders, k) for k in zip(key, salt, strict=True)], dtype="int32")

    host = ascii_lower(F.col("host"))
    bounded = rules.where("host <> '' and path is not null and verdict is not null").select(
        host.alias("host"),
        "path",
        F.col("verdict"),
        host_key(host).alias("key"),
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("/")).alias("high"),  # the sign after a dot
    )
    least = F.lit(np.iinfo(np.int64).min)
    spread = bounded.withColumns({"a": range_of("key", least), "b": range_of("high", least)}).select(
        F.explode(F.sequence("a", "b")).alias("range"), "key", "high", "host", "path", "verdict"
    )
    # Rules come before pages of the same key.
    page_rows = keyed.select(
        range_of("key", F.xxhash64("salt")).alias("range"), "key", F.lit(1).alias("kind"), F.lit("").alias("high"),
        F.col("page_id").cast("long").alias("page_id"), "host", "path", F.lit("").alias("verdict"),
    )
    rule_rows = spread.select(
        "range", "key", F.lit(0).alias("kind"), "high", F.lit(None).cast("long").alias("page_id"), "host", "path", "verdict"
    )

    def sweep(batches):
        current, stack = None, _Rules()
        for batch in batches:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                place, key, kind, high, page_id, host, path, verdict = row
                if place != current:
                    current, stack = place, _Rules()
                stack.close(key)
                if kind == 0:
                    stack.open(key, high, path, (verdict != "block", verdict, host + path))
                    continue
                rule = stack.longest(path)
                out.append((page_id, host, path, rule and rule[2], rule[1] if rule else default))
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            types = [pa.int64(), *[pa.string()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    return (
        page_rows.unionByName(rule_rows)
        .repartition(ranges, "range")
        .sortWithinPartitions("range", "key", "kind")
        .mapInArrow(sweep, "page_id long, host string, path string, rule string, verdict string")
    )


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (verdict, host, path)."""
    return spark.createDataFrame(rules, "verdict string, host string, path string")

"""The monthly run on tables, and the table sinks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from turnstile.operators import normalise, rollup, sequence, stays
from turnstile.plans import jobs
from turnstile.plans import queries as Q
from turnstile.plans.queries import QUERIES
from turnstile.sources import badge_view, tables

SF = "/root/testdata/sf0.001"
MONTH = dt.date(2024, 1, 1)


@pytest.fixture
def names(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS run")
    fields = jobs.Tables.__dataclass_fields__
    yield jobs.Tables(**{f: f"run.{f}" for f in fields})
    spark.sql("DROP DATABASE run CASCADE")


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_run_twice(spark, names):
    raw = badge_view.raw_badges(spark, SF)
    doors = badge_view.doors(spark)
    for _ in range(2):
        done = jobs.run(raw, doors, "2024-01-01", "Weekly", capacity=1_000, names=names)
        assert done == [MONTH]
        assert same(QUERIES["monthly_peak_util"](spark, SF), spark.table(names.peak_util))
        assert same(QUERIES["monthly_eid_daily"](spark, SF), spark.table(names.eid_daily))
        assert same(QUERIES["monthly_data_quality"](spark, SF), spark.table(names.data_quality))
        detail, summary = spark.table(names.peak_util), spark.table(names.peak_util_summary)
        assert detail.agg(F.sum("eid")).first() == summary.agg(F.sum("eid")).first()
    assert not any(spark.catalog.tableExists(t) for t in names.working())


def test_two_months_and_one_again(spark, names):
    swipes = badge_view.order_swipes(spark, SF)
    site = F.substring("door", 6, 2).cast("bigint")
    raw = swipes.withColumn("rank", site).drop("door", "Group")
    doors = swipes.select(site.alias("rank"), F.col("door").alias("Door")).distinct()
    months = [dt.date(2001, 6, 1), dt.date(2001, 7, 1)]
    jobs.run(raw, doors, "2001-06-01,2001-07-01", "Monthly", capacity=20, names=names)
    assert tables.table_months(spark, names.peak_util) == months
    before = spark.table(names.peak_util_summary).collect()
    done = jobs.run(raw, doors, "", "Weekly", dt.date(2001, 7, 20), capacity=20, names=names)
    assert done == months[1:]
    assert sorted(spark.table(names.peak_util_summary).collect(), key=str) == sorted(before, key=str)
    # Groups differ between months but not the totals: one group gives the same hours.
    kept = raw.where(F.col("month").isin(months)).withColumn("Group", F.lit(1).cast("bigint"))
    hours = Q._hourly(
        stays.day_spans(
            sequence.clean_sequence(normalise.normalise_rows(kept.join(doors.withColumnRenamed("Door", "door"), "rank")))
        )
    )
    listed = spark.createDataFrame([(m,) for m in months], "date date")
    assert same(rollup.peak_rollup(hours, listed), spark.table(names.peak_util_summary))


def test_old_months_expire(spark, names):
    old = [dt.date(2022, 12, 1), dt.date(2023, 1, 1), MONTH]
    df = spark.createDataFrame([(1, m) for m in old], "v int, Month date")
    tables.overwrite(df, names.peak_util, "Month")
    jobs.expire_months(spark, names.peak_util, [dt.date(2024, 1, 1)], "Monthly")
    assert tables.table_months(spark, names.peak_util) == [dt.date(2023, 1, 1), MONTH]
    jobs.expire_months(spark, names.peak_util, [dt.date(2024, 3, 1)], "Weekly")
    assert tables.table_months(spark, names.peak_util) == [MONTH]


def test_replace_months(spark, names):
    m1, m2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    first = spark.createDataFrame([(1, m1), (2, m2)], "v int, Month date")
    tables.replace_months(first, names.eid_daily, [m1, m2])
    tables.replace_months(spark.createDataFrame([(3, m2)], "v int, Month date"), names.eid_daily, [m2])
    assert sorted(r.v for r in spark.table(names.eid_daily).collect()) == [1, 3]
    # A listed month without new rows ends up empty.
    tables.replace_months(first.limit(0), names.eid_daily, [m2])
    assert [r.v for r in tables.read_table(spark, names.eid_daily).collect()] == [1]
    assert tables.has_month(spark.table(names.eid_daily).withColumnRenamed("Month", "month"), m1)


def test_append_and_drop(spark, names):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    tables.append(df, names.clean_swipes)
    tables.append(df.select("v", "k"), names.clean_swipes)
    tables.append_query(spark, f"SELECT 'b' AS k, sum(v) AS v FROM {names.clean_swipes}", names.clean_swipes)
    assert sorted(tuple(r) for r in tables.query(spark, f"SELECT * FROM {names.clean_swipes}").collect()) == [
        ("a", 1), ("a", 1), ("b", 2),
    ]
    tables.drop_tables(spark, names.clean_swipes, names.clean_swipes)
    assert not spark.catalog.tableExists(names.clean_swipes)


def test_failure_leaves_the_old_month(spark, names):
    rows = spark.createDataFrame([(1, MONTH)], "v int, Month date")
    tables.replace_months(rows, names.eid_daily, [MONTH])
    broken = rows.withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        tables.replace_months(broken, names.eid_daily, [MONTH])
    assert [tuple(r) for r in spark.table(names.eid_daily).collect()] == [(1, MONTH)]


def test_rejected_rows_are_kept(spark, names):
    raw = badge_view.raw_badges(spark, SF).withColumns(
        {
            "direction": F.when(F.second("localtimestamp") % 9 == 0, F.lit("foo")).otherwise(F.col("direction")),
            "localtimestamp": F.when(F.second("localtimestamp") % 10 != 3, F.col("localtimestamp")),
        }
    )
    jobs.run(raw, badge_view.doors(spark), "2024-01-01", "Weekly", capacity=1_000, names=names)
    assert {r.reason for r in spark.table(names.rejected).select("reason").distinct().collect()} == {"direction", "time"}


def _versions(spark, table):
    fs, path = tables._files(spark, f"{tables.table_location(spark, table)}/{tables.VERSIONS}")
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def test_months_switch_to_the_one_written_folder(spark, names):
    m1, m2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    tables.replace_months(spark.createDataFrame([(1, m1), (2, m2)], "v int, Month date"), names.eid_daily, [m1, m2])
    new = spark.createDataFrame([(10, m1), (11, m1), (20, m2), (30, dt.date(2024, 3, 1))], "v int, Month date")
    tables.replace_months(new, names.eid_daily, [m1, m2])
    [version] = _versions(spark, names.eid_daily)
    # every written month reads from the folder the rows were written to: no second copy
    for month in (m1, m2, dt.date(2024, 3, 1)):
        assert f"/{tables.VERSIONS}/{version}/Month={month.isoformat()}" in tables.month_location(spark, names.eid_daily, month)
    assert sorted(r.v for r in spark.table(names.eid_daily).collect()) == [10, 11, 20, 30]


def test_failure_between_stage_and_switch(spark, names, monkeypatch):
    m1, m2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    tables.replace_months(spark.createDataFrame([(1, m1), (2, m2)], "v int, Month date"), names.eid_daily, [m1, m2])
    new = spark.createDataFrame([(10, m1), (20, m2)], "v int, Month date")
    switch, calls = tables._switch, []

    def fails_at(n):
        def switch_or_fail(*args):
            calls.append(args[3])
            if len(calls) == n:
                raise RuntimeError("lost driver")
            switch(*args)

        return switch_or_fail

    monkeypatch.setattr(tables, "_switch", fails_at(1))
    with pytest.raises(RuntimeError, match="lost driver"):
        tables.replace_months(new, names.eid_daily, [m1, m2])
    assert sorted(tuple(r) for r in spark.table(names.eid_daily).collect()) == [(1, m1), (2, m2)]
    # stopped between two months: the first is wholly new, the second wholly old
    calls.clear()
    monkeypatch.setattr(tables, "_switch", fails_at(2))
    with pytest.raises(RuntimeError, match="lost driver"):
        tables.replace_months(new, names.eid_daily, [m1, m2])
    assert sorted(tuple(r) for r in spark.table(names.eid_daily).collect()) == [(2, m2), (10, m1)]
    # the run again finishes the job; versions no month uses are gone at the next replacement
    monkeypatch.setattr(tables, "_switch", switch)
    tables.replace_months(new, names.eid_daily, [m1, m2])
    tables.replace_months(new, names.eid_daily, [m1, m2])
    assert sorted(tuple(r) for r in spark.table(names.eid_daily).collect()) == [(10, m1), (20, m2)]
    assert len(_versions(spark, names.eid_daily)) == 2


def test_append_batches_once(spark, names):
    rows = spark.createDataFrame([("a", 1, "b1"), ("b", 2, "b1"), ("c", 3, None)], "k string, v int, batch_id string")
    tables.append_batches(rows, names.clean_swipes)
    tables.append_batches(rows, names.clean_swipes)
    broken = rows.withColumn("batch_id", F.lit("b2")).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        tables.append_batches(broken, names.clean_swipes)
    tables.append_batches(rows.withColumn("batch_id", F.lit("b2")).where("k = 'a'"), names.clean_swipes)
    got = sorted(tuple(r) for r in spark.table(names.clean_swipes).collect())
    assert got == [("a", 1, "b1"), ("a", 1, "b2"), ("b", 2, "b1"), ("c", 3, None), ("c", 3, None)]


def test_checked_rows_and_reasons(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("eid", T.StringType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("n", T.LongType())])
    raw = spark.createDataFrame(
        [("a", "2024-01-01 10:00:00", "3", "x"), (" ", "2024-01-01T10:00:00", "n/a", "y"), (None, "2024-13-01 10:00:00", None, "z"),
         ("b", "", "4", None)],
        "eid string, ts string, n string, extra string",
    )
    got = {r["eid"]: r for r in tables.checked(raw, schema, ("eid", "ts")).collect()}
    assert got["a"]["reason"] is None and got["a"]["n"] == 3 and got["a"]["ts"] == dt.datetime(2024, 1, 1, 10)
    assert got[" "]["reason"] == "missing eid,type n"
    assert got[None]["reason"] == "missing eid,type ts"
    assert got["b"]["reason"] == "missing ts"
    assert tables.checked(raw, schema).columns == ["eid", "ts", "n", "reason"]


def test_quarantine_counts(spark):
    from turnstile.plans.queries import QUERIES

    found = {r.reason: r.n for r in QUERIES["quarantine_counts"](spark, SF).collect()}
    assert {"ok", "missing eid", "missing localtimestamp", "type localtimestamp", "type rank"} <= set(found)

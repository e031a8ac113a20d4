"""What the physical plans must and must not contain."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from turnstile.operators import months, normalise, sequence, stays
from turnstile.plans.queries import MONTH, QUERIES
from turnstile.schemas import ENRICHED
from turnstile.sources import badge_view

SF = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def tree(df):
    """The operator tree of the main plan, without subqueries."""
    return plan(df).split("\n\n\n")[0].split("\n\n")[0]


@pytest.fixture(scope="module")
def enriched(spark, tmp_path_factory):
    """An enriched badge table, partitioned as the monthly job writes it."""
    path = str(tmp_path_factory.mktemp("tables") / "enriched")
    flag = F.coalesce(F.col("eid").endswith("1"), F.lit(False))
    badges = badge_view.grouped_badges(spark, SF).withColumn("oversized", flag)
    badges.select(*ENRICHED.fieldNames()).write.partitionBy("month", "oversized").parquet(path)
    return spark.read.schema(ENRICHED).parquet(path)


def test_shuffles_and_sorts_up_to_the_stays(enriched):
    """One shuffle and one sort for everyone; more only in the branches of oversized people."""
    text = tree(stays.pair_stays(sequence.clean_sequence(normalise.normalise_rows(enriched))))
    ordinary = tree(stays.pair_stays(sequence.clean_sequence(normalise.normalise_rows(enriched.drop("oversized")))))
    assert len(re.findall(r"\bExchange\b", ordinary)) == 1
    assert len(re.findall(r"\bSort\b", ordinary)) == 1
    assert len(re.findall(r"\bExchange\b", text)) == 1 + 5
    assert "Join" not in text


def test_cleaning_holds_no_table_of_a_tasks_rows(spark, enriched):
    """Ordinary people: no hash table beside the sort. Every deal of rows keeps the session's number of parts, so that
    adaptive execution does not merge them by their compressed size."""
    ordinary = tree(sequence.clean_sequence(normalise.normalise_rows(enriched.drop("oversized"))))
    assert "Aggregate" not in ordinary and plan_origins(enriched.drop("oversized")) == ["REPARTITION_BY_NUM"]
    assert plan_origins(enriched) == ["ENSURE_REQUIREMENTS", "REPARTITION_BY_NUM"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cleaned = sequence.clean_sequence(normalise.normalise_rows(enriched.drop("oversized")))
    assert cleaned.rdd.getNumPartitions() == parts


def plan_origins(badges):
    """Why the cleaning's exchanges are there."""
    return sorted(set(re.findall(r"REPARTITION_BY_\w+|ENSURE_REQUIREMENTS", plan(sequence.clean_sequence(normalise.normalise_rows(badges))))))


def test_oversized_people_are_pruned_to_their_folders(enriched):
    df = stays.pair_stays(sequence.clean_sequence(normalise.normalise_rows(enriched)))
    scans = re.findall(r"PartitionFilters: (.*)", plan(df))
    assert len(scans) == 3 and all("oversized" in s for s in scans)


def test_only_needed_columns_are_read(enriched):
    df = stays.pair_stays(sequence.clean_sequence(normalise.normalise_rows(enriched)))
    schemas = re.findall(r"ReadSchema: struct<(.*)>", plan(df))
    assert len(schemas) == 3 and not any("messagetype" in s for s in schemas)


def test_without_oversized_rows_there_is_one_branch(spark):
    df = sequence.clean_sequence(normalise.normalise_rows(badge_view.grouped_badges(spark, SF)))
    assert "Union" not in tree(df)


def test_month_filter_reaches_the_scan(enriched):
    text = plan(enriched.where(enriched.month == MONTH).where("Group = 2"))
    assert "PartitionFilters" in text and "PushedFilters" in text and "EqualTo(Group,2)" in text


def test_month_lists_are_broadcast(spark, enriched):
    listed = spark.createDataFrame([(MONTH,)], "date date")
    text = tree(months.in_months(enriched, listed, "month"))
    assert "BroadcastHashJoin LeftSemi" in text


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_row_python_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "NestedLoopJoin"):
        assert bad not in text, bad
    if "FlatMapGroupsInPandas" in text:
        assert "balanced_groups" in name or "enrich" in name or "monthly" in name


def scans(node):
    """File scans of an executed plan, through adaptive stages."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return scans(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return scans(node.plan())
    found = [node] if name == "FileSourceScanExec" else []
    children = node.children()
    for i in range(children.size()):
        found += scans(children.apply(i))
    return found


@pytest.fixture(scope="module")
def month_folders(spark, tmp_path_factory):
    """Hourly rows of 24 months in a table partitioned by month, as the job writes peak_util."""
    path = str(tmp_path_factory.mktemp("tables") / "hourly")
    days = spark.range(24 * 3).select(F.add_months(F.lit(MONTH), (F.col("id") % 24).cast("int")).alias("Month"), "id")
    rows = days.select(
        F.lit("F1").alias("Facility"), "Month", F.lit(9).alias("Bin_time"), F.lit("day").alias("Time_group"),
        F.col("Month").alias("Date"), F.lit(1).alias("eid_ex"), (F.col("id") % 5).alias("eid"),
    )
    rows.write.partitionBy("Month").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("listed", [1, 3])
def test_rollups_read_only_listed_months(spark, month_folders, listed):
    import datetime as dt

    from turnstile.operators import rollup

    wanted = [dt.date(MONTH.year + (MONTH.month - 1 + k) // 12, (MONTH.month - 1 + k) % 12 + 1, 1) for k in range(0, 2 * listed, 2)]
    as_table = spark.createDataFrame([(m,) for m in wanted], "date date")
    for months in (wanted, as_table):
        df = rollup.peak_rollup(month_folders, months)
        got = df.collect()
        assert sorted({r["Month"] for r in got}) == wanted
        found = scans(df._jdf.queryExecution().executedPlan())
        assert len(found) == 1
        assert found[0].metrics().get("numPartitions").get().value() == listed
        assert "Join" not in tree(df)


def exchanges(node):
    """Shuffle exchanges of an executed plan, through adaptive stages."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return exchanges(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return exchanges(node.plan())
    found = [node] if name == "ShuffleExchangeExec" else []
    children = node.children()
    for i in range(children.size()):
        found += exchanges(children.apply(i))
    return found


def test_hours_travel_as_day_masks(spark):
    from turnstile.operators import occupancy
    from turnstile.plans import queries as Q

    computed = stays.day_spans(Q._cleaned(spark, SF))
    spans = spark.createDataFrame(computed.collect(), computed.schema)  # a plain table: one exchange in the plan
    masks = occupancy.day_masks(occupancy.round_hours(spans))
    text = tree(masks)
    assert "make_dt_interval" not in text and "hour_bins" not in text
    person_days = len(masks.collect())
    [shuffle] = exchanges(masks._jdf.queryExecution().executedPlan())
    written = shuffle.metrics().get("shuffleRecordsWritten").get().value()
    rounded = occupancy.round_hours(spans).where("hour_in IS NOT NULL")
    span_days = rounded.select(F.explode(F.sequence(F.to_date("hour_in"), F.to_date("hour_out")))).count()
    hours = occupancy.mask_hours(masks).count()  # what an explode by the hour would have shuffled
    assert person_days <= written <= span_days < hours / 2


def test_bucketed_tables_spare_the_exchanges(spark):
    from turnstile.operators import occupancy
    from turnstile.plans import jobs
    from turnstile.sources import tables

    cleaned = sequence.clean_sequence(normalise.normalise_rows(badge_view.grouped_badges(spark, SF)))
    tables.overwrite(cleaned, "plans_clean", "month", bucket_by=jobs.PERSON_BUCKETS, shuffle=False)
    daily = occupancy.eid_daily(stays.day_spans(spark.table("plans_clean")))
    assert not re.findall(r"\bExchange\b", tree(daily))
    assert "Bucketed: true" in plan(daily)
    # the cleaning leaves its rows dealt by bucket: one file per bucket and month
    months = spark.table("plans_clean").select("month").distinct().count()
    files = spark.table("plans_clean").inputFiles()
    assert len(files) <= months * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the same rows as without buckets
    assert sorted(map(tuple, daily.collect())) == sorted(map(tuple, occupancy.eid_daily(stays.day_spans(cleaned)).collect()))
    tables.drop_tables(spark, "plans_clean")


def test_group_ranges_skip_files_and_row_groups(spark):
    from turnstile.operators import enrich
    from turnstile.sources import tables

    rows = badge_view.grouped_badges(spark, SF).withColumn("oversized", F.lit(False))
    # a month of many files, as at scale: the small fixture would otherwise be merged into one file
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        tables.overwrite(rows, "plans_ranges", "month", "oversized", cluster_by=("Group", "eid"))
    finally:
        spark.conf.set(key, "true")
    stored = spark.table("plans_ranges")
    month_rows = stored.where(F.col("month") == MONTH).count()
    df = enrich.month_range(stored, MONTH, "Group", 2, 3)
    got = len(df.collect())
    [scan] = scans(df._jdf.queryExecution().executedPlan())
    read = scan.metrics().get("numOutputRows").get().value()
    assert 0 < got <= read < month_rows
    tables.drop_tables(spark, "plans_ranges")

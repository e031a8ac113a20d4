"""Badge swipes derived from a plain event table, for checks and benchmarks.

Of the events, every 50th occurs twice, some lack an id or a direction, and every
fifth swipe is at another facility than the person's own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.functions import clock

DOORS = 36
VIEW_GROUPS = 4
ORDER_PEOPLE = 50


def badges(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    event, user = F.col("event_id"), F.col("user_id")
    copies = F.when(event % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    site = F.when(event % 5 == 0, event % 12).otherwise(user % 12)
    return events.withColumn("copy", F.explode(copies)).select(
        F.when(event % 97 != 0, F.concat(F.lit("USER "), user)).alias("eid"),
        clock.floor_second(F.col("ts")).alias("localtimestamp"),
        F.when(event % 101 == 0, F.lit(None))
        .when(event % 2 == 0, F.lit("In"))
        .otherwise(F.lit(" OUT "))
        .alias("direction"),
        F.col("event_type").alias("messagetype"),
        (site * 3 + event % 3).alias("rank"),
        F.to_date(F.trunc("ts", "MM")).alias("month"),
        F.expr("event_id div 100 + 1").alias("index_value"),
        (user % VIEW_GROUPS + 1).alias("view_group"),
    )


def raw_badges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without group, some rows with a null or zero index value."""
    index = F.col("index_value")
    return badges(spark, sf_dir).drop("view_group").withColumn(
        "index_value", F.when(index % 11 != 0, F.when(index % 13 == 0, F.lit(0)).otherwise(index))
    )


def flawed_badges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouped badges of which some lack a time, have a foreign direction, or are null throughout."""
    rows = grouped_badges(spark, sf_dir)
    second = F.second("localtimestamp")
    marked = rows.withColumns({"second": second, "empty": (F.col("index_value") % 17 == 0) & (second % 5 == 0)})
    changed = {
        "direction": F.when(F.col("second") % 9 == 0, F.lit("Fo o")).otherwise(F.col("direction")),
        "localtimestamp": F.when(F.col("second") % 10 != 3, F.col("localtimestamp")),
    }
    return marked.select(*(F.when(~F.col("empty"), changed.get(c, F.col(c))).alias(c) for c in rows.columns))


def badge_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Badges as they land in text files: every column text, some times in other forms, past the calendar or
    blank, some ranks not numbers."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    event, user, ts = F.col("event_id"), F.col("user_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return events.select(
        F.when(event % 97 != 0, F.concat(F.lit("USER "), user.cast("string"))).alias("eid"),
        F.when(event % 7 == 0, F.replace(ts, F.lit(" "), F.lit("T")))
        .when(event % 13 == 0, F.lit("2024-13-01 10:00:00"))
        .when(event % 17 == 0, F.lit(" "))
        .when(event % 19 != 0, ts)
        .alias("localtimestamp"),
        F.when(event % 101 != 0, F.when(event % 2 == 0, F.lit("In")).otherwise(F.lit(" OUT "))).alias("direction"),
        F.col("event_type").alias("messagetype"),
        F.when(event % 23 == 0, F.lit("n/a")).otherwise((event % 36).cast("string")).alias("rank"),
        F.date_format(F.trunc("ts", "MM"), "yyyy-MM-dd").alias("month"),
        event.cast("string").alias("index_value"),
    )


def timestamp_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as text, in several forms that do not read as a timestamp."""
    event, ts = F.col("event_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        F.when(event % 7 == 0, F.replace(ts, F.lit(" "), F.lit("T")))
        .when(event % 11 == 0, F.concat(ts, F.lit(".5")))
        .when(event % 13 == 0, F.lit("2024-13-01 10:00:00"))
        .when(event % 17 == 0, F.lit(""))
        .when(event % 19 != 0, ts)
        .alias("text"),
    )


def doors(spark: SparkSession) -> DataFrame:
    rank = F.col("id")
    site = F.lpad(F.expr("id div 3").cast("string"), 2, "0")
    name = F.concat(F.lit("Site "), site, F.lit(" Floor "), rank % 3)
    return spark.range(DOORS).select(rank.alias("rank"), name.alias("Door"))


def grouped_badges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Badges with door names and a plain group number per person."""
    named = doors(spark).withColumnRenamed("Door", "door")
    return (
        badges(spark, sf_dir)
        .join(named, "rank", "left")
        .drop("rank")
        .withColumnRenamed("view_group", "Group")
    )


def order_badges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as badge rows of many months, one person per customer."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select(
        F.concat(F.lit("USER "), "o_custkey").alias("eid"),
        F.to_date(F.trunc("o_orderdate", "MM")).alias("month"),
        F.col("o_orderkey").alias("index_value"),
    )


def order_swipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as grouped badges of many months, with a few busy people per month."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    order, user = F.col("o_orderkey"), F.col("o_custkey") % ORDER_PEOPLE
    second = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), order * 7919 % 86_400)
    site = F.when(order % 5 == 0, order % 12).otherwise(user % 12)
    return orders.select(
        F.concat(F.lit("USER "), user).alias("eid"),
        (F.col("o_orderdate").cast("timestamp_ntz") + second).alias("localtimestamp"),
        F.when(order % 2 == 0, F.lit("In")).otherwise(F.lit(" OUT ")).alias("direction"),
        F.col("o_orderpriority").alias("messagetype"),
        F.to_date(F.trunc("o_orderdate", "MM")).alias("month"),
        order.alias("index_value"),
        (user % VIEW_GROUPS + 1).alias("Group"),
        F.concat(F.lit("Site "), F.lpad(site.cast("string"), 2, "0"), F.lit(" Floor")).alias("door"),
    )

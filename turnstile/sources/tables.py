"""Table sources and sinks.

Detail and summary tables are partitioned by month, so a month is pruned on read
and replaced as a whole on write.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.table(table)


def checked(raw: DataFrame, schema: T.StructType, required: Sequence[str] = ()) -> DataFrame:
    """Rows of a text source typed by `schema`, each with the reasons it fails, or a null `reason`.

    A required column that is null or blank: `missing <column>`; a value that is not blank but does not cast to
    its type: `type <column>`. Reasons of a row follow the schema's order, comma-joined. Nothing is dropped: the
    caller keeps `reason IS NULL` and sends the rest to quarantine, from the same single read.
    """
    reasons, typed = [], []
    for field in schema.fields:
        text = F.col(field.name).cast("string")
        blank = text.isNull() | (F.trim(text) == "")
        value = text.try_cast(field.dataType) if field.dataType != T.StringType() else text
        if field.name in required:
            reasons.append(F.when(blank, F.lit(f"missing {field.name}")))
        reasons.append(F.when(~blank & value.isNull(), F.lit(f"type {field.name}")))
        typed.append(value.alias(field.name))
    reason = F.nullif(F.concat_ws(",", *reasons), F.lit(""))
    return raw.select(*typed, reason.alias("reason"))


def query(spark: SparkSession, sql: str) -> DataFrame:
    return spark.sql(sql)


def has_month(df: DataFrame, month: dt.date) -> bool:
    """Whether there is a row of the month; reads one row."""
    return not df.where(F.col("month") == F.lit(month)).isEmpty()


def overwrite(
    df: DataFrame,
    table: str,
    *partitions: str,
    compact: bool = False,
    bucket_by: Sequence[str] = (),
    shuffle: bool = True,
    cluster_by: Sequence[str] = (),
) -> None:
    """Write a table anew; `compact` evens out files at the price of a shuffle.

    `cluster_by`: deal the rows by range of the folder columns and these, and sort each file by them; every file
    then covers a narrow range, and a filter on them skips whole files and row groups by their statistics.

    `bucket_by`: store the rows hashed by these columns into as many buckets as the session has shuffle partitions,
    so that later reads grouped or windowed by them (or by more columns) need no exchange. `shuffle` deals the rows
    by bucket first (one file per bucket and folder); without it, rows that are already dealt that way are written
    as they are.
    """
    writer = df
    if bucket_by:
        buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        writer = df.repartition(buckets, *bucket_by) if shuffle else df
        out = writer.write.mode("overwrite").format("parquet").partitionBy(*partitions).bucketBy(buckets, *bucket_by)
        out.saveAsTable(table)
        return
    if cluster_by:
        writer = df.repartitionByRange(*partitions, *cluster_by).sortWithinPartitions(*cluster_by)
    elif compact:
        writer = balanced(df, *partitions)
    writer.write.mode("overwrite").format("parquet").partitionBy(*partitions).saveAsTable(table)


def append(df: DataFrame, table: str) -> None:
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        df.select(*spark.table(table).columns).write.insertInto(table)
    else:
        df.write.format("parquet").saveAsTable(table)


BATCH_LEDGER_LIMIT = 10_000  # batch ids of one append that are broadcast to the anti join; more are joined


def append_batches(df: DataFrame, table: str, column: str = "batch_id") -> None:
    """Append rows whose batch is not yet in the table; repeating an append changes nothing.

    The batch id travels with the rows, so the ledger is the table itself and is written in the same commit as
    the rows: a failed append leaves no batch marked as done, a repeated one finds it and adds nothing. Only the
    batch column of the table is read, for the ids this append brings. Rows without a batch id are always
    appended. One writer a table at a time.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        incoming = df.select(column).where(F.col(column).isNotNull()).distinct()
        known = [r[0] for r in incoming.limit(BATCH_LEDGER_LIMIT + 1).collect()]
        done = spark.table(table).select(column)
        if len(known) <= BATCH_LEDGER_LIMIT:
            done = F.broadcast(done.where(F.col(column).isin(known)).distinct())
        else:
            done = done.join(incoming, column, "left_semi").distinct()
        df = df.join(done, column, "left_anti")
    append(df, table)


def append_query(spark: SparkSession, sql: str, table: str) -> None:
    append(spark.sql(sql), table)


def balanced(df: DataFrame, *partitions: str) -> DataFrame:
    """Even files per partition value; adaptive execution splits the large ones."""
    return df.hint("rebalance", *partitions)


VERSIONS = "_versions"  # folder under a table's own folder; Spark's file listing skips names that start with _


def replace_months(
    df: DataFrame,
    table: str,
    months: Iterable[dt.date],
    column: str = "Month",
    compact: bool = True,
) -> None:
    """Replace the listed months of a month-partitioned table; running it twice changes nothing.

    The new rows are written once, partitioned by month, into a version folder of their own under the table's
    folder; the table does not change while they are computed, so a failure leaves every old month. Each written
    month then switches to its new folder by one catalog change (SET LOCATION, or ADD PARTITION for a new
    month); a listed month without new rows is dropped. A reader therefore sees each month whole, old or new,
    never half written. Version folders that no month uses any more are deleted at the next replacement, so a
    reader that listed the old files still finds them. The month column must not be null.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        overwrite(df, table, column, compact=compact)
        return
    base = table_location(spark, table)
    _remove_unused_versions(spark, table, base, column)
    version = f"{base}/{VERSIONS}/{uuid.uuid4().hex}"
    rows = df.select(*spark.table(table).columns)
    (balanced(rows, column) if compact else rows).write.partitionBy(column).parquet(version)
    written = _folder_months(spark, version, column)
    present = set(table_months(spark, table, column))
    for month in sorted(written):
        _switch(spark, table, column, month, f"{version}/{column}={month.isoformat()}", month in present)
    drop_months(spark, table, [m for m in months if m not in written], column)


def _spec(column: str, month: dt.date) -> str:
    return f"(`{column}` = DATE'{month.isoformat()}')"


def _switch(spark: SparkSession, table: str, column: str, month: dt.date, folder: str, present: bool) -> None:
    """Point one month at its new folder: a single change of the catalog."""
    if present:
        spark.sql(f"ALTER TABLE {table} PARTITION {_spec(column, month)} SET LOCATION '{folder}'")
    else:
        spark.sql(f"ALTER TABLE {table} ADD PARTITION {_spec(column, month)} LOCATION '{folder}'")


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def month_location(spark: SparkSession, table: str, month: dt.date, column: str = "Month") -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table} PARTITION {_spec(column, month)}").where("col_name = 'Location'")
    return rows.collect()[0]["data_type"].rstrip("/")


def _files(spark: SparkSession, folder: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _folder_months(spark: SparkSession, folder: str, column: str) -> set[dt.date]:
    """Months written under a folder, from its sub-folder names."""
    fs, path = _files(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()] if fs.exists(path) else []
    values = [n.split("=", 1)[1] for n in names if n.startswith(f"{column}=")]
    if "__HIVE_DEFAULT_PARTITION__" in values:
        raise ValueError(f"rows without {column} cannot replace a month")
    return {dt.date.fromisoformat(v) for v in values}


def _remove_unused_versions(spark: SparkSession, table: str, base: str, column: str) -> None:
    fs, path = _files(spark, f"{base}/{VERSIONS}")
    if not fs.exists(path):
        return
    used = {month_location(spark, table, m, column).split(f"/{VERSIONS}/")[-1].split("/")[0] for m in table_months(spark, table, column)}
    for status in fs.listStatus(path):
        if status.getPath().getName() not in used:
            fs.delete(status.getPath(), True)


def drop_months(
    spark: SparkSession, table: str, months: Iterable[dt.date], column: str = "Month"
) -> None:
    """Drop month partitions; no data is read or rewritten."""
    for month in months:
        spark.sql(
            f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{column}` = DATE'{month.isoformat()}')"
        )


def table_months(spark: SparkSession, table: str, column: str = "Month") -> list[dt.date]:
    """Months of a table, from its partition list."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return sorted(dt.date.fromisoformat(r[0].split("=", 1)[1]) for r in rows)


def drop_tables(spark: SparkSession, *tables: str) -> None:
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")

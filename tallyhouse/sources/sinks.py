"""Table sinks: every write goes to a path of its own, never over a path being read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import fresh_path


def create_table_as(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a new Parquet table in the shared folder and return a scan of it."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def append_rows(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Add ``rows`` to the table at ``path``; only the new rows are written."""
    rows.write.mode("append").parquet(path)


def create_month_partitions(df: DataFrame, time_column: str, label: str, month_column: str = "pay_month") -> DataFrame:
    """Write one directory per calendar month so that date filters prune whole directories.

    Rows are rebalanced by month: at run time small months share a task, and a month that holds
    a third of all rows is split over as many tasks as its size asks for.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    (
        df.withColumn(month_column, F.date_format(F.col(time_column), "yyyy-MM"))
        .hint("rebalance", F.col(month_column))
        .write.partitionBy(month_column)
        .parquet(path)
    )
    # The declared schema keeps the month a string; inference would make it a number or a date.
    fields = df.schema.add(month_column, "string")
    return spark.read.schema(fields).parquet(path)


def create_bucketed(df: DataFrame, label: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` hashed into ``buckets`` by ``key``; tables alike in both are grouped and joined by it without an exchange.

    The files go to the shared folder, the layout is kept in the session's catalog under a name of its own. Meant
    for keys whose rows are spread evenly: a bucket is read by one task, and a key that holds a third of all rows
    would hold up its bucket, so leave such a table as it is and let AQE split the exchange.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)

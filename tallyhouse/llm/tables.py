"""Reading tables, column names that don't clash, and intermediate results in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.session import shared_folder

#: Prefix of helper columns. A column of a caller's table that begins so is not supported.
OWN = "_llm_"
#: Bytes of rows that Spark hands to a Python worker at once, unless the session names a limit.
ARROW_BYTES = "4m"
_ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table by Spark's own reader, so that any store Spark can open will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Long texts make large batches, in the JVM and in the worker: limit them by bytes, not by rows alone."""
    if spark.conf.get(_ARROW_LIMIT, None) is None:
        spark.conf.set(_ARROW_LIMIT, ARROW_BYTES)


def settle(df: DataFrame) -> DataFrame:
    """The rows as a checkpoint in the shared folder: computed once, safe from lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def without(df: DataFrame, names) -> DataFrame:
    """``df`` without the columns that a result is going to add; matches names as Spark does."""
    taken = {n.lower() for n in names}
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in taken))


def widened(df: DataFrame, fields: str) -> T.StructType:
    """Schema of ``df`` with the fields of a DDL string behind it."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(fields).fields])


def buckets(spark: SparkSession) -> int:
    """Buckets for a hash exchange: a few for each shuffle partition, which the cluster sizes."""
    return max(64, 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))

"""A bounded sample of labelled documents, the same for every run and partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sample(labels: DataFrame, label: str, per_class: int, where: Column | None = None, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, label int, weight): at most ``per_class`` documents of label 0 and of label 1, the first by hash.

    The weight is how many documents of its label a row stands for: all of them over those in the sample.
    Null ids and labels other than 0 and 1 are left out; a document with two labels counts as 1. At most
    2 * per_class rows, so it may be broadcast. The rank filter works in the map tasks first.
    """
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1))
    if where is not None:
        known = known.where(where)
    one = known.groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id"))
    totals = one.groupBy("label").agg(F.count(F.lit(1)).alias("total"))  # two rows
    picked = one.withColumn("place", place).where(F.col("place") <= per_class).drop("place")
    weight = F.greatest(F.lit(1.0), F.col("total") / per_class)
    return picked.join(F.broadcast(totals), "label").select("doc_id", "label", weight.alias("weight"))

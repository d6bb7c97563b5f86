"""Mixing sources to target weights by weighted fair queueing.

Every document enters the queue up to ``repeats`` times. Within its source the documents are shuffled by
a seeded hash; the virtual finish time of a copy is the words of its source up to and including it, over
the target of the source. All copies are then ordered by finish time over all sources and taken from the
front while their words stay within the total budget. A source with twice the target moves twice as fast,
so each ends within about a document of its target.

Targets: ``share`` of all words, divided by weight; a source never gets more than ``repeats`` times its
words, and what it leaves goes to the others by weight. Sources sorted by words per weight fill up in that
order, so one running sum over the sources gives the result of all rounds of sharing anew.

Both orders are running sums without a one-task window: rows are range-sorted, and only the sum of each
partition is gathered. A source with a third of all rows spreads over many partitions.

Defined results: null or empty text has size 0 and is taken as 0 words. A null source is a source, the last
one. Equal rows get equal places in some order, the result as a whole is the same. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.tables import OWN, read, settle
from tallyhouse.llm.wordspans import WORD

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
REPEATS = 2
SEED = "mix-1"


def running_sum(rows: DataFrame, value: str, order: Sequence[Column | str], name: str, within: str | None = None) -> DataFrame:
    """Add the sum of ``value`` over this and all earlier rows, within ``within`` or over everything.

    ``order`` begins with ``within``. The driver sees nothing; a sum for each partition is broadcast, so
    its size follows the number of partitions, and of keys of ``within`` that meet in one partition.
    """
    part, key, before = f"{OWN}part", f"{OWN}key", f"{OWN}before"
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = F.col(within) if within else F.lit(0)
    placed = settle(
        rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumns({part: F.spark_partition_id(), key: group})
    )
    earlier = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(part, key).agg(F.sum(value).alias("s")).select(part, key, F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias(before))
    here = Window.partitionBy(part, key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = placed.withColumn(name, F.sum(value).over(here))
    # Null keys are equal here: the null source is a source.
    both = inside.alias("l").join(sums.alias("r"), (F.col(f"l.{part}") == F.col(f"r.{part}")) & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}")))
    return both.select(*(F.col(f"l.`{c}`") for c in rows.columns), (F.col(f"l.{name}") + F.col(before)).alias(name))


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = SHARE_PERCENT, repeats: int = REPEATS) -> DataFrame:
    """``sources`` (source, source_size: one row each) with w, target and the budget of all sources."""
    n = len(weights)
    listed = sources.withColumn("at", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("at") - 1, F.lit(n)) + 1).cast("int")).cast("long")
    whole = Window.partitionBy()
    fill = Window.orderBy(F.col("source_size") / F.col("w"), "at").rowsBetween(Window.unboundedPreceding, -1)
    known = listed.withColumn("w", w).withColumns(
        {
            "budget": F.sum("source_size").over(whole) * F.lit(percent) / F.lit(100.0),
            "full_before": F.coalesce(F.sum("source_size").over(fill), F.lit(0)) * F.lit(repeats),
            "w_left": F.sum("w").over(whole) - F.coalesce(F.sum("w").over(fill), F.lit(0)),
        }
    )
    # A source is full if its share of what the ones before it leave is no less than its limit.
    full = F.col("source_size") * repeats * F.col("w_left") <= (F.col("budget") - F.col("full_before")) * F.col("w")
    first_open = known.withColumn("open", ~full)
    level = F.min(F.when(F.col("open"), F.struct(F.col("source_size") / F.col("w"), F.col("at"), (F.col("budget") - F.col("full_before")).alias("left"), "w_left"))).over(whole)
    return first_open.withColumn("level", level).select(
        "source",
        "source_size",
        "w",
        F.when(F.col("open"), F.col("level.left") * F.col("w") / F.col("level.w_left"))
        .otherwise((F.col("source_size") * repeats).cast("double"))
        .alias("target"),
        "budget",
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    percent: int = SHARE_PERCENT,
    repeats: int = REPEATS,
    seed: str = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, source, size, source_size, target, taken."""
    sizes = settle(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            # Rows alike in all else stay apart.
            F.monotonically_increasing_id().alias("row"),
        )
    )
    per_source = targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, percent, repeats)
    shuffled = sizes.withColumn("spot", F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")))
    placed = running_sum(shuffled, "size", ["source", "spot", "doc_id", "size"], "reach", within="source")
    known = per_source.withColumnsRenamed({"source": "s"})
    # One row per source, so the build side is as small as the list of sources.
    placed = settle(placed.join(known, placed["source"].eqNullSafe(known["s"])).drop("s", "w"))
    copies = placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("turn")).withColumn(
        "finish", F.when(F.col("target") > 0, (F.col("reach") + F.col("turn") * F.col("source_size")) / F.col("target")).otherwise(0.0)
    )
    order = ["finish", "source", "turn", "spot", "doc_id", "size"]
    queue = running_sum(copies, "size", order, "total")
    row = ["row", "doc_id", "source", "size", "source_size", "target"]
    return (
        queue.groupBy(*row)
        .agg(F.sum(F.when(F.col("total") <= F.col("budget"), F.col("size")).otherwise(0)).alias("taken"))
        .select("doc_id", "source", "size", "source_size", "target", "taken")
    )


def op9_fair_queue_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def oracle(docs: str = "documents") -> str:
    """DuckDB SQL for the same rows."""
    return rf"""
WITH sizes AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
         md5('{SEED}' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS spot
  FROM {docs}
), per AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size, ROW_NUMBER() OVER (ORDER BY source NULLS LAST) AS place
  FROM sizes GROUP BY source
), weighed AS (
  SELECT *, CAST(list_extract([{", ".join(map(str, WEIGHTS))}], CAST((place - 1) % {len(WEIGHTS)} + 1 AS BIGINT)) AS BIGINT) AS w FROM per
), summed AS (
  SELECT *, SUM(source_size) OVER () * {SHARE_PERCENT} / 100.0::DOUBLE AS budget,
         COALESCE(SUM(source_size) OVER ahead, 0) * {REPEATS} AS full_before,
         SUM(w) OVER () - COALESCE(SUM(w) OVER ahead, 0) AS w_left
  FROM weighed
  WINDOW ahead AS (ORDER BY source_size / w::DOUBLE, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), judged AS (
  SELECT *, source_size * {REPEATS} * w_left > (budget - full_before) * w AS open FROM summed
), level AS (
  SELECT budget - full_before AS level_left, w_left AS level_w FROM judged WHERE open
  ORDER BY source_size / w::DOUBLE, place LIMIT 1
), aimed AS (
  SELECT source, source_size,
         CASE WHEN open THEN (SELECT level_left FROM level) * w / (SELECT level_w FROM level)
              ELSE CAST(source_size * {REPEATS} AS DOUBLE) END AS target
  FROM judged
), reached AS (
  SELECT s.*, a.source_size, a.target,
         SUM(s.size) OVER (PARTITION BY s.source ORDER BY s.spot, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS reach,
         ROW_NUMBER() OVER () AS row_id
  FROM sizes s JOIN aimed a ON s.source IS NOT DISTINCT FROM a.source
), queued AS (
  SELECT *, CASE WHEN target > 0 THEN CAST(reach + turn * source_size AS DOUBLE) / target ELSE 0 END AS finish
  FROM reached CROSS JOIN range({REPEATS}) AS t(turn)
), totalled AS (
  SELECT *, SUM(size) OVER (ORDER BY finish, source NULLS FIRST, turn, spot, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS total FROM queued
)
SELECT doc_id, size, source_size, target,
       CAST(SUM(CASE WHEN total <= (SELECT SUM(size) FROM sizes) * {SHARE_PERCENT} / 100.0::DOUBLE THEN size ELSE 0 END) AS BIGINT) AS taken
FROM totalled GROUP BY row_id, doc_id, size, source_size, target
"""

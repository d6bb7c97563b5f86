"""Exact top-k by inner product with vector-approximation files.

Every vector is approximated by one cell number (a byte) for each dimension; cells of a dimension are equally
wide, so the inner product of a query with a cell's middle is off by at most a slack that depends on the query
alone. Search, for blocks of queries:

1. every task scans the cells of its rows and keeps for a query those whose upper bound reaches its k-th best
   lower bound so far: candidates with bounds,
2. over all tasks, candidates below the k-th best lower bound go,
3. exact vectors are read in the order of the bound: first the k most promising, then those whose upper bound
   still reaches the k-th exact score. After that the result is certain.

Equal vectors would all tie, so they are one class, approximated once; a class keeps its ``k + 1`` smallest
ids, which is all that any query can need of it. Queries are taken in blocks of at most ``BLOCK``; a block is
broadcast (its size is fixed by that number and the dimension), and every block scans all rows.

Components are floor(scale * x) and must fit 21 bits and a sum 53. Vectors that are null or have null or
non-finite components take no part (``usable``), nor do those shorter than the longest.
Defined results: a repeated vec_id is one vector id; a query never returns its own id. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.tables import read, settle

K = 10
SCALE = 1024
EVERY = 100
#: Queries searched in one scan.
BLOCK = 2048
_CELLS = 256
_ROWS = 2048


def usable(vector: str) -> Column:
    """Neither null nor with a null or non-finite component."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _cells(low: np.ndarray, width: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = np.clip((_matrix(batch.column("v")) - low) // width, 0, _CELLS - 1).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([batch.column("c"), pa.array([r.tobytes() for r in cell], pa.binary())], names=["c", "cells"])

    return run


def _scan(queries: np.ndarray, names: np.ndarray, low: np.ndarray, width: np.ndarray, keep: int):
    """Candidates of one task: (q, c, lower, upper)."""
    half = (width - 1) / 2  # a cell holds ``width`` whole numbers
    slack = np.abs(queries) @ half
    turned = queries.T * width[:, None]
    offset = queries @ (low + half)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((len(queries), keep), -np.inf)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def settled():
            q, c, m = (np.concatenate(x) for x in zip(*held, strict=True))
            ok = m + slack[q] >= best[q, 0]
            return [(q[ok], c[ok], m[ok])]

        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                cell = np.frombuffer(b"".join(part.column("cells").to_pylist()), np.uint8).reshape(part.num_rows, -1)
                middle = (cell.astype(np.float64) @ turned + offset).T
                lower = middle - slack[:, None]
                top = lower if lower.shape[1] <= keep else -np.partition(-lower, keep - 1, axis=1)[:, :keep]
                best = np.sort(np.concatenate((best, top), axis=1), axis=1)[:, -keep:]
                q, j = np.nonzero(middle + slack[:, None] >= best[:, :1])
                held.append((q, part.column("c").to_numpy()[j], middle[q, j]))
                size += len(q)
                if size > 500_000:
                    held = settled()
                    size = len(held[0][0])
        if held:
            q, c, m = settled()[0]
            for at in range(0, len(q), 100_000):
                s = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[q[s]]), pa.array(c[s]), pa.array(m[s] - slack[q[s]]), pa.array(m[s] + slack[q[s]])], names=["q", "c", "lower", "upper"]
                )

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, vec_id: str = "vec_id", vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of each query by inner product of whole numbers."""
    spark = vectors.sparkSession
    whole = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    base = settle(
        vectors.withColumn("query", F.coalesce(is_query, F.lit(False)))
        .where(usable(vector) & F.col(vec_id).isNotNull() & (F.size(vector) > 0))
        .select(F.col(vec_id).cast("long").alias("id"), "query", whole.alias("v"))
    )
    # The cells' limits and the common length are counted over all rows.
    shape = base.agg(F.max(F.size("v")).alias("d")).first().d
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not shape:
        return empty
    base = base.where(F.size("v") == shape)
    # k + 1 ids of each vector; the rank filter works in the map tasks, so a hot vector stays small.
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    ids = settle(base.select("v", "id").distinct().withColumn("place", place).where(F.col("place") <= k + 1))
    classes = settle(ids.where("place = 1").select(F.col("id").alias("c"), "v"))
    ends = classes.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("at").collect()
    low = np.array([r.lo for r in ends], dtype=np.float64)
    width = np.maximum(1.0, np.ceil((np.array([r.hi for r in ends]) - low + 1) / _CELLS))
    cells = settle(classes.mapInArrow(_cells(low, width), "c long, cells binary"))
    members = settle(ids.join(classes.withColumnsRenamed({"c": "class"}), "v").select("class", "id"))
    # Ids of queries that ask for the same vector share one search; each leaves out its own id.
    asked = settle(base.where("query").select("id", "v").distinct().join(classes.withColumnsRenamed({"c": "q"}), "v").select("id", "q"))
    searches = asked.select("q").distinct().join(classes.withColumnsRenamed({"c": "q"}), "q")
    count = searches.count()
    blocks = -(-count // block)
    searches = settle(searches.withColumn("block", F.pmod(F.xxhash64("q"), F.lit(max(1, 2 * blocks)))))
    found = empty
    keep = k + 1
    for b in range(2 * blocks):  # about block / 2 queries each
        rows = searches.where(F.col("block") == b).select("q", "v").collect()
        if rows:
            queries, names = np.array([r.v for r in rows], dtype=np.float64), np.array([r.q for r in rows], dtype=np.int64)
            part = cells.mapInArrow(_scan(queries, names, low, width, keep), "q long, c long, lower double, upper double")
            found = found.union(_refined(settle(part), classes, members, asked, k))
    return found


def _refined(bounds: DataFrame, classes: DataFrame, members: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Steps 2 and 3 for one block of queries. ``keep`` counts classes: one more than k, for the query's own."""
    best = lambda by: F.row_number().over(Window.partitionBy("q").orderBy(F.desc(by), "c"))
    limit = bounds.withColumn("n", best("lower")).where(F.col("n") <= k + 1).groupBy("q").agg(F.min("lower").alias("limit"), F.count("*").alias("have"))
    left = settle(
        bounds.join(limit, "q")
        .where((F.col("upper") >= F.col("limit")) | (F.col("have") <= k))
        .withColumn("n", best("upper"))
        .select("q", "c", "upper", "n")
    )
    exact = lambda some: (
        some.join(classes.withColumnsRenamed({"v": "vc"}), "c")
        .join(classes.withColumnsRenamed({"c": "q", "v": "vq"}), "q")
        .select("q", "c", F.aggregate(F.zip_with("vc", "vq", lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x).alias("score"))
    )
    first = settle(exact(left.where(F.col("n") <= k + 1)))
    sure = first.groupBy("q").agg(F.min("score").alias("reached"), F.count("*").alias("have"))
    rest = left.where(F.col("n") > k + 1).join(sure, "q").where((F.col("upper") >= F.col("reached")) | (F.col("have") <= k)).select("q", "c")
    scored = first.union(exact(rest))
    # Of each search the k + 1 best classes, ties of the last one included; then ids, smallest first.
    cut = F.rank().over(Window.partitionBy("q").orderBy(F.desc("score")))
    ids = scored.withColumn("r", cut).where(F.col("r") <= k + 1).join(members.withColumnsRenamed({"class": "c", "id": "vec_id"}), "c")
    row = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    ids = ids.withColumn("r", row).where(F.col("r") <= k + 1)
    final = asked.withColumnsRenamed({"id": "query_id"}).join(ids, "q").where(F.col("vec_id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return final.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_va_file_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return nearest(vectors, F.col("vec_id") % EVERY == 0)


def oracle(table: str = "embeddings") -> str:
    """DuckDB SQL for the same rows."""
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM {table}
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % {EVERY} = 0
), r AS (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm.op10_topk import nearest, op10_va_file_topk, oracle

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every, k):
    v = {}
    for i, e, _ in rows:
        if i is not None and e and all(x is not None and math.isfinite(x) for x in e):
            v[i] = [math.floor(1024 * float(np.float32(x))) for x in e]
    out = []
    for q in v:
        if q % every == 0:
            s = sorted((-sum(a * b for a, b in zip(v[q], v[c], strict=True)), c) for c in v if c != q)
            out += [(q, n + 1, c, -x) for n, (x, c) in enumerate(s[:k])]
    return sorted(out)


def made(seed, n, d=8):
    r = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in r.normal(size=d) * 0.3], 0) for i in range(n)]
    rows += [(n + i, rows[3][1], 0) for i in range(n // 3)]  # one hot vector
    rows += [(2 * n + i, [0.0] * d, 0) for i in range(30)]
    bad = [None, [1.0, None] + [0.0] * (d - 2), [float("nan")] + [0.0] * (d - 1), [float("inf")] * d, []]
    return rows + [(3 * n + i, e, 0) for i, e in enumerate(bad)] + [(None, [0.1] * d, 0), rows[5], rows[0]]


@pytest.mark.parametrize(("n", "every", "k", "block"), [(300, 10, 10, 7), (40, 3, 25, 2048), (5, 1, 10, 2048)])
def test_equals_brute_force(spark, n, every, k, block):
    rows = made(n, n)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = nearest(df, F.col("vec_id") % every == 0, k=k, block=block)
    assert sorted(map(tuple, got.collect())) == brute(rows, every, k)


def test_no_rows(spark):
    assert nearest(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0
    assert nearest(spark.createDataFrame([(1, None, 0)], SCHEMA), F.lit(True)).count() == 0


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    assert sorted(map(tuple, op10_va_file_topk(spark, folder).collect())) == sorted(con.execute(oracle()).fetchall())

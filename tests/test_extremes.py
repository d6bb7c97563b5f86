"""Largest difference of a pair that excludes one's own row."""

import random

from tallyhouse.operators.extremes import widest_pairs


def brute(rows):
    out = {}
    for k, x, a in rows:
        for j, y, b in rows:
            if j == k and None not in (x, y, a, b) and a != b:
                out[k] = max(out.get(k, 0), abs(x - y))
    return out


def test_equals_all_pairs(spark):
    r = random.Random(4)
    rows = [(r.choice([1, 2, 3, None]), r.choice([None, *range(-20, 20)]), r.choice(["p", "q", "r", None])) for _ in range(150)]
    rows += [(10, 5, "p"), (10, 90, "p"), (11, 5, "p"), (11, 5, "q"), (12, 1, "p"), (12, 100, "p"), (12, 60, "q"), (13, None, "p"), (13, 1, "q")]
    got = widest_pairs(spark.createDataFrame(rows, "k int, x int, a string").repartition(5), ["k"], "x", "a")
    assert {row.k: row.widest for row in got.collect()} == brute(rows)
    assert widest_pairs(spark.createDataFrame([], "k int, x int, a string"), ["k"], "x", "a").count() == 0


def test_rows_are_ranked_before_they_meet(spark):
    frame = spark.range(1000).selectExpr("id % 3 AS k", "id AS x", "id % 7 AS a")
    text = widest_pairs(frame, ["k"], "x", "a")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "NestedLoop" not in text

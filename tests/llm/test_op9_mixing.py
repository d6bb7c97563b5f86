import math
import random

import duckdb

from tallyhouse.llm.op9_mixing import mix_sources, op9_fair_queue_mix, oracle, running_sum, targets


def shares(sizes, weights=(3, 1, 2), percent=150, repeats=2):
    """Share, cap the sources above their limit, share again, until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, full = sum(sizes.values()) * percent / 100, set()
    while True:
        room = left - sum(repeats * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        out = {s: room * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if out[s] > repeats * sizes[s]}
        if not over:
            return out | {s: repeats * sizes[s] for s in full}
        full |= over


def test_targets_equal_rounds_of_sharing(spark):
    for seed in range(4):
        r = random.Random(seed)
        sizes = {f"s{i}": r.choice([0, 1, 5, 40, 1000]) for i in range(r.randrange(1, 12))}
        if seed % 2:
            sizes[None] = 30
        got = targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
        want = shares(sizes)
        assert len(got) == len(want)
        assert all(math.isclose(x.target, want[x.source], abs_tol=1e-9) for x in got)


def made(seed):
    r = random.Random(seed)
    rows = [(i, r.choice(["big"] * 6 + ["b", "c", "d", None]), " ".join(["w"] * r.randrange(30))) for i in range(400)]
    return rows + [(900, "c", None), (None, "c", "a b"), (901, "b", ""), (5, "d", "x"), (5, "d", "x"), (902, "e", None)]


def test_equals_sql_and_comes_near_the_targets(spark):
    rows = made(1)
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    got = sorted((tuple(r) for r in mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken").collect()), key=str)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, source VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    assert got == sorted(con.execute(oracle()).fetchall(), key=str)
    taken, target = {}, {}
    for r in mix_sources(docs).collect():
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert r.taken in (0, r.size, 2 * r.size)
    assert all(abs(taken[s] - target[s]) <= 30 for s in taken)
    assert sum(taken.values()) <= 1.5 * sum(len((t or "").split()) for _, _, t in rows)


def test_reruns_agree_for_any_partitions(spark):
    rows = made(2)
    out = [
        sorted(map(str, mix_sources(spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(n)).collect()))
        for n in (1, 7)
    ]
    assert out[0] == out[1]


def test_no_rows(spark):
    assert mix_sources(spark.createDataFrame([], "doc_id long, source string, text string")).count() == 0
    assert mix_sources(spark.createDataFrame([(1, "a", None)], "doc_id long, source string, text string")).first().taken == 0


def test_every_row_stays(spark):
    """Rows without words, without an id, and wholly alike rows."""
    rows = [(1, "a", None), (1, "a", ""), (None, "a", " "), (None, "a", None), (2, "a", "x y"), (2, "a", "x y"), (3, None, ""), (3, None, "")]
    got = mix_sources(spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)).collect()
    assert sorted((r.doc_id or 0, r.source or "", r.size) for r in got) == sorted((i or 0, s or "", len((t or "").split())) for i, s, t in rows)


def test_no_nested_loop(spark):
    docs = spark.createDataFrame([(1, "a", "x y"), (2, "b", "z")], "doc_id long, source string, text string")
    plan = mix_sources(docs)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_running_sum_over_everything(spark):
    rows = spark.range(1000).selectExpr("id", "id % 7 AS v").repartition(6)
    got = {r.id: r.s for r in running_sum(rows, "v", ["id"], "s").collect()}
    total = 0
    for i in range(1000):
        total += i % 7
        assert got[i] == total


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    assert sorted(map(tuple, op9_fair_queue_mix(spark, folder).collect())) == sorted(con.execute(oracle()).fetchall())

"""Several unique keys: rows taken in order, whatever the shape of their conflicts."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import writes
from tallyhouse.operators.conflicts import take_in_order
from tallyhouse.operators.groups import connected_groups


def brute(rows):
    """Ids taken of (id, a, b, c) rows with the unique keys (a) and (b, c)."""
    seen, taken = set(), []
    for i, a, b, c in sorted(rows):
        keys = [key for key in (("a", a), ("bc", b, c)) if None not in key]
        if not seen & set(keys):
            taken.append(i)
            seen |= set(keys)
    return taken


def made(seed, n, values):
    r = random.Random(seed)
    pick = lambda m: None if r.random() < 0.08 else r.randrange(m)
    rows = [(i, pick(values), pick(values // 3 + 1), str(r.randrange(4))) for i in range(n)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    ("n", "values", "batch", "rounds"),
    [(400, 300, 50_000, 3), (400, 300, 20, 2), (300, 200, 10, 0), (300, 40, 25, 0), (200, 5000, 5, 1)],
    ids=["one task", "rounds and groups", "groups", "a giant group in batches", "few conflicts"],
)
def test_equals_a_walk(spark, n, values, batch, rounds):
    rows = made(n + batch, n, values)
    frame = spark.createDataFrame(rows, "id int, a int, b int, c string").repartition(5)
    got = take_in_order(frame, [("a",), ("b", "c")], ["id"], batch=batch, rounds=rounds)
    assert got.columns == ["id", "a", "b", "c"]
    assert sorted(r.id for r in got.collect()) == brute(rows)


def chain(spark, n):
    return spark.range(n).select("id", F.floor(F.col("id") / 2).alias("a"), F.floor((F.col("id") + 1) / 2).alias("b"))


def jobs_of(spark, action):
    context = spark.sparkContext
    name = f"counted-{uuid.uuid4()}"
    context.setJobGroup(name, "")
    try:
        result = action()
        return result, len(context.statusTracker().getJobIdsForGroup(name))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_a_chain_of_ten_thousand(spark):
    """One chain of conflicts: jobs don't follow its length. Adaptive execution counts each exchange as a job, so it is off."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        target = spark.createDataFrame([], "id bigint, a bigint, b bigint")
        run = lambda n: writes.insert_unless_conflict(target, chain(spark, n), [("a",), ("b",)], ["id"]).table
        got, jobs = jobs_of(spark, lambda: sorted(r.id for r in run(10_000).collect()))
        assert got == list(range(0, 10_000, 2)) and jobs < 15
        assert jobs_of(spark, lambda: run(100).collect())[1] == jobs
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_a_chain_longer_than_a_batch(spark):
    got = take_in_order(chain(spark, 900), [("a",), ("b",)], ["id"], batch=300, rounds=1)
    assert sorted(r.id for r in got.collect()) == list(range(0, 900, 2))


def test_ties_missing_keys_and_what_is_there(spark):
    target = spark.createDataFrame([(1, "x", "p")], "i int, a string, b string")
    rows = [(2, "x", "q"), (3, "y", "p"), (4, "z", None), (5, "z", "r"), (6, None, None), (7, None, None), (8, "w", "s"), (9, "w", "t"), (10, "v", "t")]
    offered = spark.createDataFrame(rows, "i int, a string, b string")
    change = writes.insert_unless_conflict(target, offered, [("a",), ("b",)], ["i"])
    assert sorted(r.i for r in change.affected.collect()) == [4, 6, 7, 8, 10]
    # Rows alike in the order: one of the rivals is taken, whichever it is.
    tied = spark.createDataFrame([(1, "x", str(k)) for k in range(30)], "i int, a string, b string").repartition(4)
    assert writes.insert_unless_conflict(target.limit(0), tied, [("a",), ("b",)], ["i"]).affected.count() == 1


def test_connected_groups(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 100), (300, 300), (60, 50), (70, 60), (70, 80), (80, 90), (500, 7)]
    frame = spark.createDataFrame(links, "a long, b long").repartition(3)
    got = {r.node: r.group for r in connected_groups(frame).collect()}
    assert got == {**{i: 0 for i in range(41)}, 500: 0, 100: 100, 200: 100, **{i: 50 for i in (50, 60, 70, 80, 90)}}
    assert connected_groups(frame.limit(0)).count() == 0


def test_a_long_chain_of_neighbours_needs_no_turns(spark, monkeypatch):
    """Each turn is several jobs and about halves a chain; a task joins neighbours at once."""
    monkeypatch.setattr("tallyhouse.operators.groups.CHUNK", 700, raising=False)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    links = spark.range(1, 20_000).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    try:
        got, jobs = jobs_of(spark, lambda: connected_groups(links).agg(F.count("node"), F.max("group")).first())
        assert tuple(got) == (20_000, 0) and jobs < 25
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)

"""Many patterns against many texts."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.patterns import match_patterns


def expected(texts, patterns):
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i INT, body VARCHAR)")
    con.execute("CREATE TABLE p(j INT, pat VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", texts)
    con.executemany("INSERT INTO p VALUES (?, ?)", patterns)
    return sorted(con.execute("SELECT i, j FROM t JOIN p ON body ILIKE pat ESCAPE '\\'").fetchall())


def test_equals_ilike(spark):
    r = random.Random(8)
    word = lambda n: "".join(r.choice("abcABÉé%_ 1") for _ in range(n))
    texts = [(i, word(r.randrange(0, 14))) for i in range(150)] + [(900, None), (901, ""), (902, "100% sure_thing")]
    patterns = [(j, "".join(r.choice(["%", "_", "a", "bc", "AB", "1", "É", "cab"]) for _ in range(r.randrange(0, 6)))) for j in range(120)]
    patterns += [(800, None), (801, "%"), (802, ""), (803, "100\\% %"), (804, "%sure\\_thing"), (805, "%zzzz%"), (806, "%a%"), (807, "%a%")]
    got = match_patterns(
        spark.createDataFrame(texts, "i int, body string").repartition(3), "body", spark.createDataFrame(patterns, "j int, pat string"), "pat"
    )
    assert got.columns == ["i", "body", "j", "pat"]
    assert sorted((row.i, row.j) for row in got.collect()) == expected(texts, patterns)


def test_a_thousand_patterns_join_by_equality(spark):
    texts = spark.range(2000).select("id", F.concat(F.lit("Item no. "), F.col("id").cast("string")).alias("body"))
    patterns = spark.range(1000).select(F.col("id").alias("n"), F.concat(F.lit("%NO. "), (F.col("id") * 2).cast("string")).alias("pat"))
    got = match_patterns(texts, "body", patterns, "pat")
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert got.count() == 1000 and got.where("id <> 2 * n").count() == 0


def test_a_pattern_of_many_rows_and_texts_is_dealt_to_tiles(spark, monkeypatch):
    monkeypatch.setattr("tallyhouse.operators.patterns.TILE", 10, raising=False)
    texts = spark.range(300).select("id", F.concat(F.lit("a"), F.col("id").cast("string")).alias("body"))
    patterns = spark.range(200).select(F.col("id").alias("n"), F.lit("A%").alias("pat"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = match_patterns(texts, "body", patterns, "pat")
        # Neither the texts nor the rows of the one pattern are sent whole to a task.
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [_pattern" in plan and "_across" in plan and "_down" in plan
        spread = got.groupBy(F.spark_partition_id()).count().collect()
        assert len(spread) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert got.count() == got.distinct().count() == 300 * 200


def test_few_bytes_that_make_many_pairs_are_dealt_to_all_tasks(spark, monkeypatch):
    monkeypatch.setattr("tallyhouse.operators.patterns.TILE", 50)
    texts = spark.range(2000, numPartitions=1).select("id", F.concat(F.lit("Item no. "), F.col("id").cast("string")).alias("body"))
    patterns = spark.range(100).select(F.col("id").alias("n"), F.concat(F.lit("%item%"), (F.col("id") % 10).cast("string")).alias("pat"))
    kind, plans, kept = type(texts), [], []
    checkpoint = kind.checkpoint

    def recorded(df, *args):
        plans.append((df.columns, df._jdf.queryExecution().executedPlan().toString()))
        kept.append(checkpoint(df, *args))
        return kept[-1]

    monkeypatch.setattr(kind, "checkpoint", recorded)
    got = match_patterns(texts, "body", patterns, "pat")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    # Texts against patterns, and texts of a pattern against its rows.
    matched = next(df for df in kept if df.columns == ["id", "body", "_pattern", "_text"])
    assert matched.select(F.spark_partition_id()).distinct().count() == tasks
    assert got.select(F.spark_partition_id()).distinct().count() == tasks
    # A regular expression of a column is kept from row to row, that of LIKE is compiled for each.
    assert "regexp_instr" in next(plan for columns, plan in plans if columns == ["id", "body", "_pattern", "_text"])
    assert got.count() == got.distinct().count() == 2000 * 10


def test_letters_that_mean_something_to_regular_expressions(spark, monkeypatch):
    monkeypatch.setattr("tallyhouse.operators.patterns.PIECE", 4, raising=False)
    monkeypatch.setattr("tallyhouse.operators.patterns.TILE", 7)
    r = random.Random(4)
    letters = ["\\", ".", "^", "$", "[", "]", "(", ")", "{", "}", "|", "*", "+", "?", "Q", "E", "d", "\n", "#", "😀", "é", "0", "-", "%", "_"]
    texts = [(i, "".join(r.choice(letters) for _ in range(r.randrange(0, 30)))) for i in range(150)]
    patterns = []
    for j in range(150):
        # A stretch of a text with some of it behind wildcards.
        body = r.choice(texts)[1]
        at = r.randrange(0, len(body) + 1)
        part = [r.choice(["%", "_"]) if r.random() < 0.15 else "\\" + c if c in "\\%_" else c for c in body[at : at + r.randrange(0, 20)]]
        patterns.append((j, r.choice(["", "%"]) * (at > 0) + "".join(part) + r.choice(["", "%"])))
    got = match_patterns(spark.createDataFrame(texts, "i int, body string"), "body", spark.createDataFrame(patterns, "j int, pat string"), "pat")
    want = expected(texts, patterns)
    assert len(want) > 150 and sorted((row.i, row.j) for row in got.collect()) == want


@pytest.mark.parametrize("pattern", ["%ab\\c", "%ab\\"])
def test_an_escape_that_like_refuses(spark, pattern):
    patterns = spark.createDataFrame([(1, pattern)], "n int, pat string")
    none = spark.createDataFrame([(1, "xyz")], "i int, body string")
    assert match_patterns(none, "body", patterns, "pat").count() == 0
    with pytest.raises(Exception, match="ESC_"):
        match_patterns(spark.createDataFrame([(1, "xabc")], "i int, body string"), "body", patterns, "pat").count()


def test_a_long_part_far_into_a_pattern(spark):
    texts = spark.createDataFrame([(1, "a-b-c-efghi"), (2, "a-b-c-efgh")], "i int, body string")
    patterns = spark.createDataFrame([(1, "%a%b%c%EFGHI%")], "j int, pat string")
    assert [row.i for row in match_patterns(texts, "body", patterns, "pat").collect()] == [1]


@pytest.mark.parametrize("sent", [0, 100_000])
def test_substrings_of_texts_are_looked_up_before_they_are_shuffled(spark, monkeypatch, sent):
    monkeypatch.setattr("tallyhouse.operators.patterns.SENT", sent, raising=False)
    texts = spark.range(500).select("id", F.concat(F.lit("Item no. "), F.col("id").cast("string")).alias("body"))
    patterns = spark.range(50).select(F.col("id").alias("n"), F.concat(F.lit("%no. "), F.col("id").cast("string")).alias("pat"))
    kind, plans = type(texts), {}
    checkpoint = kind.checkpoint

    def recorded(df, *args):
        plans[tuple(df.columns)] = df._jdf.queryExecution().executedPlan().toString()
        return checkpoint(df, *args)

    monkeypatch.setattr(kind, "checkpoint", recorded)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = match_patterns(texts, "body", patterns, "pat")
        assert ("BroadcastHashJoin [_gram" in plans["id", "body", "_pattern", "_text"]) == (sent > 0)
        assert got.count() == 50 and got.where("id <> n").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

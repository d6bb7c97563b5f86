import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tallyhouse.llm.op4_quality_rules import COUNTS, FEATURES, judge, learn, learn_rules, op4_decision_list, statistics
from tallyhouse.llm.tables import read

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    w = WORD.findall(text or "")
    three = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(three)
    covered = {i + k for i, t in enumerate(three) if often[t] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
        len(lines), len(set(w)),
    )


def test_counts_equal_brute_force(spark, odd_texts):
    r = random.Random(3)
    texts = [*odd_texts, *("\n".join(" ".join(r.choice("ab#é|") for _ in range(r.randrange(6))) for _ in range(r.randrange(9))) for _ in range(300)), None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = statistics(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_lines, r.n_distinct) == brute(texts[r.doc_id]), texts[r.doc_id]


def test_covering_finds_a_known_list():
    r = np.random.default_rng(1)
    x = {n: r.random(3000) for n in list(FEATURES)[:4]}
    a, b, c, _ = x.values()
    bad = (a > 0.9) | ((b < 0.2) & (c > 0.5))
    rules = learn(x, bad)
    found = np.zeros(3000, dtype=bool)
    for rule in rules:
        held = np.ones(3000, dtype=bool)
        for one in rule:
            held &= one.holds(x)
        found |= held
    assert (found == bad).mean() > 0.97


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    counts = statistics(docs).cache()
    rules = learn_rules(counts, labels.where("doc_id % 4 != 0"))
    from tallyhouse.llm.op4_quality_rules import verdict

    test = counts.join(labels.where("doc_id % 4 = 0"), "doc_id").withColumn("kept", verdict(rules)).select("kept", "quality").collect()
    right = sum(r.kept == (r.quality == 1) for r in test)
    kept_good = sum(r.kept for r in test if r.quality == 1) / max(1, sum(r.quality == 1 for r in test))
    assert right / len(test) > 0.9, (right, len(test), rules)
    assert kept_good > 0.97, rules


def test_no_labels_nulls_and_no_rows(spark):
    docs = spark.createDataFrame([(1, None), (None, "a " * 60), (2, " ".join(map(str, range(60))))], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = {r.doc_id: (r.n_words, r.base_failed, r.kept) for r in judge(docs, none).collect()}
    assert got == {1: (0, True, False), None: (60, True, False), 2: (60, False, True)}
    assert judge(docs.limit(0), none).count() == 0


def test_query(spark):
    rows = op4_decision_list(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200
    assert all(not (r.kept and r.base_failed) for r in rows)


def test_a_rule_is_as_precise_on_all_labels_as_on_the_sample(spark):
    """Half of the documents with many digits are good: no rule, even where the sample has 19 bad ones to each good."""
    many = spark.range(6300).selectExpr("id AS doc_id", "id < 600 AS digits", "int(id >= 300) AS quality")
    counts = many.select("doc_id", *(F.when(F.col("digits"), 50).otherwise(0).alias(c) if c == "n_digits" else F.lit(100).alias(c) for c in COUNTS))
    labels = many.select("doc_id", "quality")
    assert learn_rules(counts, labels) == []
    assert learn_rules(counts, labels, per_class=300) == []
    assert learn_rules(counts, labels.where("quality = 0 OR doc_id >= 600"), per_class=300)

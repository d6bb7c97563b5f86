import random
import re

import pytest

from tallyhouse.llm.components import components
from tallyhouse.llm.op6_near_dups import near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size=2):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, percent=80, size=2):
    sets = [(i, shingles(t, size)) for i, t in rows]
    up = {i: i for i, _ in rows if i is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    real = [(i, s) for i, s in sets if i is not None and s]
    for k, (i, s) in enumerate(real):
        for j, t in real[k + 1 :]:
            common = len(s & t)
            if common and 100 * common >= percent * (len(s) + len(t) - common):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    out = [(i, len(s), None if i is None else root(i)) for i, s in sets]
    return sorted(((i, n, c, i is None or i == c) for i, n, c in out), key=str)


def made(seed):
    r = random.Random(seed)
    rows = []
    for i in range(0, 150, 5):
        base = [f"w{r.randrange(400)}" for _ in range(r.choice([1, 2, 3, 15, 60, 200]))]
        rows.append((i, " ".join(base)))
        for j in range(1, 5):
            copy = base[:]
            for _ in range(r.randrange(1 + len(base) // 12)):
                copy[r.randrange(len(copy))] = f"x{r.randrange(9999)}"
            rows.append((i + j, "\n".join(copy).upper() if r.random() < 0.3 else " ".join(copy)))
    chain = [f"c{k}" for k in range(100)]  # each near the next, the ends far apart
    rows += [(1000 + k, " ".join(chain[2 * k : 2 * k + 60])) for k in range(20)]
    rows += [(2000, None), (2001, ""), (2002, " \n"), (None, "c1 c2"), (None, None), (2003, "É é"), (2004, "é é"), (3, rows[3][1])]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = made(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, near_duplicates(docs).collect()), key=str) == brute(rows)


def test_five_word_shingles(spark):
    rows = made(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, near_duplicates(docs, shingle=5).collect()), key=str) == brute(rows, size=5)


def test_no_rows_and_other_columns(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame([(1, "a b", 3, True)], "doc_id int, text string, n int, kept boolean")
    assert [tuple(r) for r in near_duplicates(docs).collect()] == [(1, 1, 1, True)]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200), (200, 100), (300, 300)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 300: 300}


def test_many_blocks_of_one_cluster(spark, monkeypatch):
    """A cluster whose documents are near a common text but mostly not near each other."""
    from tallyhouse.llm import op6_near_dups

    monkeypatch.setattr(op6_near_dups, "BLOCK", 7)
    r = random.Random(9)
    base = [f"b{k}" for k in range(100)]
    rows = []
    for i in range(90):
        w = base[:]
        for k in r.sample(range(100), r.choice([2, 7, 8, 9])):
            w[k] = f"e{i}_{k}" if r.random() < 0.7 else "same"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, near_duplicates(docs).collect()), key=str) == brute(rows)

import hashlib
import random
import re

import numpy as np
import pytest

from tallyhouse.llm import op2_repeats
from tallyhouse.llm.op2_repeats import cut_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, k):
    """First document of every window, then the words that a later document's windows cover."""
    first = {}
    for i, text in rows:
        if i is not None:
            w = WORD.findall(text or "")
            for a in range(len(w) - k + 1):
                key = tuple(w[a : a + k])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, text in rows:
        w = WORD.findall(text or "")
        drop = set()
        for a in range(len(w) - k + 1 if i is not None else 0):
            if first[tuple(w[a : a + k])] < i:
                drop.update(range(a, a + k))
        out.append((i, len(w), len(drop), " ".join(x for n, x in enumerate(w) if n not in drop)))
    return sorted(out, key=str)


def made(seed, docs=120):
    r = random.Random(seed)
    shared = [[r.choice("abcdefghij") for _ in range(40)] for _ in range(5)]
    rows = []
    for i in range(docs):
        words = [r.choice(["alpha", "bé", "c", "d", "wörd"]) + str(r.randrange(50)) for _ in range(r.randrange(60))]
        for _ in range(r.randrange(3)):
            at, s = r.randrange(len(words) + 1), r.choice(shared)
            a = r.randrange(20)
            words[at:at] = s[a : a + r.randrange(8, 20)]
        rows.append((i * 3 - 50, r.choice([" ", "\n", " \t ", "\x0b"]).join(words)))
    rows += [(500, None), (501, ""), (None, " ".join(shared[0])), (None, None), (7, " ".join(shared[0])), (7, " ".join(shared[0])), (7, "other text")]
    rows += [(600 + j, " ".join(shared[1]) + f" {j}") for j in range(60)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("window", [13, 3, 2])
def test_equals_brute_force(spark, window):
    rows = made(window)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = cut_repeats(docs, window).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, window)


def test_no_rows_and_clashing_columns(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert cut_repeats(none).count() == 0
    docs = spark.createDataFrame([(1, "a b", 9, "x")], "doc_id int, text string, n_words int, kept_text string")
    out = cut_repeats(docs)
    assert sorted(out.columns) == ["doc_id", "kept_text", "n_removed", "n_words", "text"]
    assert out.first().n_words == 2


def test_one_very_long_text(spark):
    text = "x y " * 800_000
    docs = spark.createDataFrame([(1, text), (2, "y " + "x y " * 20)], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in cut_repeats(docs).collect()}
    assert got == {1: (1_600_000, 0), 2: (41, 41)}


def test_query_digest_is_that_of_the_kept_words(spark):
    from tallyhouse.llm.op2_repeats import op2_super_kmer_dedup
    from tallyhouse.llm.tables import read

    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in read(spark, folder, "documents").select("doc_id", "text").collect()]
    want = sorted((i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in brute(rows, 13))
    assert sorted(map(tuple, op2_super_kmer_dedup(spark, folder).collect())) == want


@pytest.mark.parametrize("hot", [0, 40])
def test_hot_pairs_and_many_buckets_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(op2_repeats, "HOT", hot)
    monkeypatch.setattr(op2_repeats, "SEEN", 1)
    monkeypatch.setattr(op2_repeats, "BUCKET_BYTES", 100)
    rows = made(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = cut_repeats(docs, 4).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 4)


def test_a_frequent_pair_draws_no_windows():
    """Every fourth word pair is one pair of the least hash: it would be the minimiser of all windows."""
    r = np.random.default_rng(1)
    words = r.integers(1, 1 << 62, 40_000).astype(np.uint64)
    words[::4], words[1::4] = words[0], words[1]
    pairs = op2_repeats._pairs(words, 13)
    hot = pairs[:1]
    monopoly = np.unique(op2_repeats._minimiser(words, 13, hot), return_counts=True)[1].max()
    assert monopoly <= 13 * 4
    words[2::4], words[3::4] = words[2], words[3]
    alone = op2_repeats._minimiser(words, 13, op2_repeats._pairs(words, 13))
    assert len(np.unique(alone)) == 1

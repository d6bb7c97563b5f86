import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm.op11_filter_audit import audit, failure_masks

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def masks_of(rows):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = []
    for i, t, s in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search(r"[#$%&*|]", t))]
        fails.append(i is not None and i > first[t])
        out.append((i, s or "", sum(f << k for k, f in enumerate(fails))))
    return out


def audited(masks, labels):
    """Every document walked through every order."""
    good, toxic = ({d for d, q, x in labels if d is not None and (q, x)[k] == 1} for k in (0, 1))
    figures, share = defaultdict(Counter), Counter()
    for i, part, mask in masks:
        for order in permutations("ABCDE"):
            gone = False
            for step, letter in enumerate(order, 1):
                fails = mask >> "ABCDE".index(letter) & 1
                f = figures[part, "".join(order), step]
                f["removed"] += fails and not gone
                f["redundant"] += fails and gone
                f["unique"] += mask == 1 << "ABCDE".index(letter)
                f["good"] += fails and not gone and i in good
                f["toxic"] += fails and not gone and i in toxic
                share[part, letter] += fails and not gone
                gone = gone or bool(fails)
                f["kept"] += not gone
    names = ("kept", "removed", "redundant", "unique", "good", "toxic")
    return sorted((*key, *(f[n] for n in names), share[key[0], key[1][key[2] - 1]]) for key, f in figures.items())


def made(seed):
    r = random.Random(seed)
    texts = [None, "", " ", "A" * 30, "a | b", "é " * 300, "x y z " * 100]
    for _ in range(60):
        words = [r.choice(["the", "Cat", "DOG", "#", "ß", f"w{r.randrange(900)}", f"v{r.randrange(900)}"]) for _ in range(r.choice([3, 150, 260]))]
        texts.append(r.choice([" ", "\n", "  "]).join(words))
    rows = [(i, r.choice(texts), r.choice(["a", "b", None, ""])) for i in range(250)]
    rows += [(None, texts[0], "a"), (None, texts[9], "b"), (None, "only without id", None), (7, texts[9], "a"), rows[11], rows[11]]
    r.shuffle(rows)
    return rows


def framed(spark, rows):
    return spark.createDataFrame([(*row, 1, True) for row in rows], "doc_id int, text string, source string, mask int, word boolean").repartition(5)


@pytest.mark.parametrize("mark", [F.xxhash64, lambda t: F.length(t)], ids=["hash", "hash shared by different texts"])
@pytest.mark.parametrize("words", [1, 1 << 20])
def test_masks_equal_brute_force(spark, mark, words):
    rows = made(words)
    got = failure_masks(framed(spark, rows), max_words=words, mark=mark)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(masks_of(rows), key=str)


def test_audit_equals_a_walk_through_all_orders(spark):
    rows = made(3)
    labels = [(i, i % 3 - 1, i % 2) for i in range(0, 200, 2)] + [(4, 1, 0), (6, None, None), (None, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit(failure_masks(framed(spark, rows)), table)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == audited(masks_of(rows), labels)


def test_no_rows_and_no_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit(failure_masks(framed(spark, [])), none).count() == 0
    assert audit(failure_masks(framed(spark, [(1, None, None)])), none).count() == 600


def test_a_very_long_text(spark):
    long = " ".join(f"w{k % 70000}" for k in range(400_000))
    rows = [(1, long, "s"), (2, long, "s"), (3, long + "!", "s")]
    assert sorted(map(tuple, failure_masks(framed(spark, rows)).collect())) == sorted(masks_of(rows))


def test_texts_that_occur_once_are_not_shuffled(spark):
    """The sketch clears nearly all of them: few texts reach the exact step."""
    from tallyhouse.llm import op11_filter_audit as op

    docs = spark.range(4000).select(F.col("id"), F.xxhash64("id").alias("mark"))
    words = 1024
    sketch = op._sketch(docs, words)
    assert op._probed(docs, sketch, words).where("suspect").count() < 120
    assert op._probed(docs.union(docs), op._sketch(docs.union(docs), words), words).where("NOT suspect").count() == 0

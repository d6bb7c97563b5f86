import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tallyhouse.llm import op12_jaccard_join as op
from tallyhouse.llm.op12_jaccard_join import jaccard_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text, size):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, percent=80, size=5):
    sets = [(i, grams(t, size)) for i, t in rows]
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
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=str)


def made(seed):
    r = random.Random(seed)
    passage = " ".join(f"p{k}" for k in range(30))
    rows = []
    for i in range(0, 150, 5):
        base = [f"w{r.randrange(4000)}" for _ in range(r.choice([1, 4, 5, 6, 30, 120, 300]))]
        rows.append((i, " ".join(base)))
        for j in range(1, 5):
            copy = base[:]
            for _ in range(r.randrange(1 + len(base) // 40)):
                copy[r.randrange(len(copy))] = f"x{r.randrange(9999)}"
            rows.append((i + j, "\n".join(copy).upper() if r.random() < 0.3 else " ".join(copy)))
    # A passage of many documents that are otherwise apart, short ones among them.
    rows += [(400 + k, passage + " " + " ".join(f"u{k}_{m}" for m in range(r.choice([1, 4, 7, 9, 40])))) for k in range(50)]
    chain = [f"c{k}" for k in range(140)]  # each near the next, the ends far apart
    rows += [(1000 + k, " ".join(chain[2 * k : 2 * k + 90])) for k in range(20)]
    rows += [(2000, None), (2001, ""), (2002, " \n"), (None, "c1 c2"), (None, None), (2003, "É é"), (2004, "é é"), (3, rows[3][1]), (8, rows[40][1]), (8, rows[60][1])]
    r.shuffle(rows)
    return rows


def got(spark, rows, **more):
    docs = spark.createDataFrame([(*row, 1, True) for row in rows], "doc_id int, text string, n int, c boolean").repartition(4)
    return sorted(map(tuple, jaccard_components(docs, **more).collect()), key=str)


@pytest.mark.parametrize(("seed", "more"), [(1, {}), (2, {"block": 7})], ids=["plain", "many blocks"])
def test_equals_brute_force(spark, seed, more):
    rows = made(seed)
    assert got(spark, rows, **more) == brute(rows)


def test_links_that_no_tile_leader_shows(spark):
    """Many documents near a common text, most of them not near each other."""
    r = random.Random(9)
    rows = []
    for i in range(120):
        w = [f"b{k}" for k in range(200)]
        for k in r.sample(range(200), r.choice([1, 3, 5, 8])):
            w[k] = f"e{i}_{k}"
        rows.append((i, " ".join(w)))
    expected = brute(rows)
    assert 1 < len({c for _, _, c in expected}) < 120
    assert got(spark, rows, block=16) == expected


def test_no_rows_and_a_very_long_text(spark):
    assert got(spark, []) == []
    long = [f"w{k % 70_001}" for k in range(300_000)]
    rows = [(5, " ".join(long)), (2, " ".join(long[:290_000]) + " end"), (9, " ".join(long[:40_000]))]
    assert got(spark, rows) == [(2, 70_002, 2), (5, 70_001, 2), (9, 39_996, 9)]


def test_an_order_that_tells_nothing_changes_no_result(spark, monkeypatch):
    monkeypatch.setattr(op, "member_levels", lambda plain, size: np.zeros(op.COUNTERS, np.uint8))
    rows = made(4)
    assert got(spark, rows, block=20) == brute(rows)


def test_counters_tell_frequent_members(spark):
    passage = " ".join(f"p{k}" for k in range(30))
    docs = spark.createDataFrame([(f"{passage} only{i} x y z {i} t u v",) for i in range(300)], "text string").repartition(5)
    levels = op.member_levels(docs, 5)
    often, _ = op.members_of(pa.array([passage]), 5)
    rare, _ = op.members_of(pa.array(["only7 x y z 7"]), 5)
    assert (levels[op._counter(often)] >= int(8 * np.log2(301))).all() and levels[op._counter(rare)][0] < 30


def test_signatures_bound_the_overlap():
    """Also where the two have signatures of different lengths: the longer one is folded."""
    r = np.random.default_rng(1)
    lengths = set()
    for n, changed, more in ((40, 3, 2), (300, 40, 2), (3000, 300, 2), (5, 5, 2), (500, 20, 60), (1000, 30, 100), (120, 0, 20)):
        x = r.integers(-(1 << 62), 1 << 62, n)
        y = np.concatenate((x[changed:], r.integers(-(1 << 62), 1 << 62, changed + more)))
        bits = op._signatures(np.concatenate((x, y)), np.array([n, len(y)]))
        lengths.add(tuple(bits.value_lengths().to_pylist()))
        differ = int(op._bits_apart(bits, np.array([0]), np.array([1]))[0])
        assert len(np.intersect1d(x, y)) <= (n + len(y) - differ) / 2
        assert 0 < differ <= 2 * changed + more
    assert any(a != b for a, b in lengths)


def test_members_are_distinct_and_sorted():
    values, n = op.members_of(pa.array(["a b c d e a b c d e a", None, "x y", "A B C D E"]), 5)
    assert n.tolist() == [5, 0, 1, 1]
    assert (np.diff(values[:5]) > 0).all() and values[6] in values[:5]


def test_blocks_travel_as_rows(spark, monkeypatch):
    """Of a tile of 64 near copies in blocks of 8, no table has a row for each copy and block pair."""
    import numpy as np
    import pyarrow as pa
    import zstandard

    from tallyhouse.llm import op12_jaccard_join as module

    texts = [" ".join(f"x{c}y{k}" if (c * 7 + k * k) % 23 == 0 else f"w{k}" for k in range(60)) for c in range(64)]
    values, n = module.members_of(pa.array(texts, pa.large_string()), 2)
    sets = [set(x.tolist()) for x in np.split(values, np.cumsum(n)[:-1])]
    bits = module._signatures(values, n).to_pylist()
    packed = [zstandard.ZstdCompressor().compress(t.encode()) for t in texts]
    rows = [(c, int(n[c]), bits[c], bytearray(packed[c])) for c in range(64)]
    of_sets = spark.createDataFrame(rows, "c long, n long, bits array<long>, packed binary")
    members = of_sets.selectExpr("5L AS key", "c", "n")
    labels = spark.createDataFrame([(c, 0) for c in range(3)], "node long, component long")
    counts, settle = [], module.settle

    def noted(df):
        out = settle(df)
        counts.append(out.count())
        return out

    monkeypatch.setattr(module, "settle", noted)
    links = {(r.a, r.b) for r in module._banded(members, of_sets, labels, 2, 80, 8).collect()}
    assert max(counts[:-1]) <= 2 * 64  # once in its own band and once for the band above

    def parts(pairs):
        up = list(range(64))
        for a, b in [(0, 1), (0, 2), *pairs]:
            up = [up[a] if x == up[b] else x for x in up]
        return {frozenset(c for c in range(64) if up[c] == x) for x in up}

    similar = {(a, b) for a in range(64) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert similar and {tuple(sorted(x, reverse=True)) for x in links} <= similar
    assert parts(links) == parts(similar)

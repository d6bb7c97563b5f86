"""Near-duplicate documents: MinHash with tensored banding, links confirmed on full shingle sets.

Two small collections of ``m`` hashes are computed, each hash being ``rows`` minhashes. The m * m table
keys are all pairs of one hash from each collection, so 2 * m * rows minhashes serve m * m tables. Two
documents of similarity s share a table with probability (1 - (1 - s ** rows) ** m) ** 2; at s = 0.8
with the defaults it misses 1 pair in 800, at 0.85 1 in 15,000; a document of a larger group has many.

Equal sets (one class of copies) count once. In each table the smallest document of a bucket is its
leader, and every other one is a candidate partner of the leader; a chunk of documents first finds
leaders of its own, so a bucket with a third of all documents sends one row per chunk. Rounds:

1. every document against the smallest of its leaders,
2. every document against its other leaders, if still in another component,
3. all documents that buckets hold together and that are still in different components, in blocks.

After round 3 every pair that shares a table is linked, or in one component, or checked: none is left
out, and no table of pairs is made.

Defined results: null, empty and blank texts have an empty set and link with nothing. A null doc_id takes
no part: null component, kept. Rows that share a doc_id are one document for the components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.components import components
from tallyhouse.llm.tables import bounded_batches, read, settle
from tallyhouse.llm.wordspans import CHUNK_BYTES, CHUNK_ROWS, KEY_BITS, chunks, find_words, let_go, mix

TABLES_ROOT = 14
ROWS = 4
SHINGLE = 2
PERCENT = 80
#: Documents of a cluster that are compared as one block.
BLOCK = 256
#: Shingles of a block: one of long documents holds fewer.
BLOCK_SHINGLES = 1 << 20
_SHIFT = np.uint64(64) - KEY_BITS


def shingle_keys(texts: pa.Array, size: int) -> np.ndarray:
    """Sorted distinct (row << 52 | shingle hash) of at most 4,096 texts; lower case, ``size`` words each."""
    words = find_words(texts, lower=True)
    if not len(words.row):
        return np.zeros(0, dtype=np.uint64)
    hashes = words.hashes()
    counts = words.counts()
    # A text with fewer words is one shingle: missing words count as 0.
    padded = np.concatenate((hashes, np.zeros(size - 1, dtype=np.uint64)))
    row = np.concatenate((words.row, np.full(size - 1, -1)))
    total = hashes
    for k in range(1, size):
        same = row[k : len(hashes) + k] == words.row
        total = mix(total * np.uint64(3) + np.where(same, padded[k : len(hashes) + k], np.uint64(0)))
    place = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
    whole = place <= np.maximum(counts - size, 0)[words.row]
    keys = (words.row[whole].astype(np.uint64) << KEY_BITS) | (total[whole] >> _SHIFT)
    keys.sort()
    return keys[np.concatenate(([True], keys[1:] != keys[:-1]))]


def _sketch(size: int, root: int, rows: int):
    odd = mix(np.arange(1, 2 * root * rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    low = (np.uint64(1) << KEY_BITS) - np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "text"):
            keys = shingle_keys(chunk.column("text"), size)
            row = (keys >> KEY_BITS).astype(np.int64)
            n = np.bincount(row, minlength=chunk.num_rows)
            some = np.flatnonzero(n)
            first = (np.cumsum(n) - n)[some]
            value = mix((keys & low) + np.uint64(1))
            marks = np.zeros((2, chunk.num_rows), dtype=np.uint64)
            hands = np.zeros((chunk.num_rows, 2 * root), dtype=np.uint64)
            if len(some):
                marks[0, some] = np.add.reduceat(value, first)
                marks[1, some] = np.add.reduceat(mix(value), first)
                for k, factor in enumerate(odd):
                    least = np.minimum.reduceat(value * factor, first)
                    hands[some, k // rows] = mix(hands[some, k // rows] * np.uint64(5) + least)
            yield pa.RecordBatch.from_arrays(
                [chunk.column("id"), pa.array(n, pa.int64()), pa.array(marks[0].view(np.int64)), pa.array(marks[1].view(np.int64))]
                + [pa.FixedSizeListArray.from_arrays(hands.view(np.int64).ravel(), 2 * root).cast(pa.list_(pa.int64()))],
                names=["id", "n", "mark1", "mark2", "hands"],
            )

    return run


def _tables(root: int):
    """Bucket rows (key, id), one for each table; within a chunk, all but the smallest id name it as leader."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS).sort_by("id")
                ids = part.column("id").to_numpy()
                hands = part.column("hands").flatten().to_numpy().view(np.uint64).reshape(len(ids), 2 * root)
                key = mix(hands[:, :root, None] * np.uint64(7) + hands[:, None, root:])
                key = mix(key + np.arange(root * root, dtype=np.uint64).reshape(root, root)).reshape(-1)
                owner = np.repeat(np.arange(len(ids)), root * root)
                order = np.argsort(key, kind="stable")  # owners ascend within a key
                key, owner = key[order], owner[order]
                fresh = np.concatenate(([True], key[1:] != key[:-1]))
                leader = ids[owner[np.flatnonzero(fresh)]][np.cumsum(fresh) - 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(ids[owner]), pa.array(leader, mask=fresh)],
                    names=["key", "id", "leader"],
                )
        let_go()

    return run


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        texts = [pack(t.as_buffer()) for t in batch.column("text").cast(pa.large_string())]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n"), pa.array(texts, pa.binary())], names=["id", "n", "packed"])


def _unpacked_bound(batch: pa.RecordBatch, *columns: str) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of bounded bytes once unpacked; one longer pair still goes whole."""
    size = zstandard.frame_content_size
    ends = np.cumsum([sum(size(batch.column(c)[i].as_buffer()) for c in columns) for i in range(batch.num_rows)])
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = min(first + 256, max(first + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, side="right"))))
        yield batch.slice(first, last - first)
        first = last


def _confirm(size: int, percent: int):
    """Pairs whose full sets are similar enough; both texts of a pair come with it, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for part in _unpacked_bound(batch, "packed_a", "packed_b"):
                sets = []
                for name in ("packed_a", "packed_b"):
                    texts = pa.array([unpack(x.as_buffer()) for x in part.column(name)], pa.large_binary())
                    sets.append(shingle_keys(texts.cast(pa.large_string()), size))
                sizes = sum(np.bincount((k >> KEY_BITS).astype(np.int64), minlength=part.num_rows) for k in sets)
                both = np.concatenate(sets)
                both.sort()
                twice = both[1:][both[1:] == both[:-1]]
                common = np.bincount((twice >> KEY_BITS).astype(np.int64), minlength=part.num_rows)
                linked = (common > 0) & (100 * common >= percent * (sizes - common))
                yield part.select(["a", "b"]).filter(pa.array(linked))
        let_go()

    return run


def _between(size: int, percent: int):
    """Links between components in one pair of blocks; a spanning set of them is enough."""

    def run(block: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        block = block.combine_chunks().sort_by("id")
        ids, group = (block.column(c).to_numpy() for c in ("id", "component"))
        side = block.column("side").to_numpy()
        texts = pa.array([unpack(x.as_buffer()) for x in block.column("packed")], pa.large_binary()).cast(pa.large_string())
        parts = [(at, shingle_keys(texts.slice(at, CHUNK_ROWS), size)) for at in range(0, len(ids), CHUNK_ROWS)]
        row = np.concatenate([(k >> KEY_BITS).astype(np.int64) + at for at, k in parts])
        mark = np.concatenate([k & ((np.uint64(1) << KEY_BITS) - np.uint64(1)) for _, k in parts])
        n = np.bincount(row, minlength=len(ids))
        _, name, often = np.unique(mark, return_inverse=True, return_counts=True)
        column = np.cumsum(often > 1) - 1
        shared = often[name] > 1
        row, name = row[shared], column[name[shared]]
        order = np.argsort(name, kind="stable")
        row, name = row[order], name[order]
        common = np.zeros((len(ids), len(ids)), dtype=np.float32)
        width = 2048
        for lo in range(0, int(name[-1]) + 1 if len(name) else 0, width):
            i, j = np.searchsorted(name, [lo, lo + width])
            has = np.zeros((len(ids), width), dtype=np.float32)
            has[row[i:j], name[i:j] - lo] = 1
            common += has @ has.T
        linked = (100 * common >= percent * (n[:, None] + n[None, :] - common)) & (common > 0)
        linked &= (group[:, None] != group[None, :]) & ((side[:, None] != side[None, :]) | (side[:, None] == 2))
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while x in up:
                x = up[x]
            return x

        out = []
        for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(linked))), strict=True):
            x, y = root(int(group[i])), root(int(group[j]))
            if x != y:
                up[max(x, y)] = min(x, y)
                out.append((int(ids[i]), int(ids[j])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return run


def _rest(members: DataFrame, texts: DataFrame, labels: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between documents that share a bucket and are still in different components.

    Documents that buckets with several components hold together form a cluster. It is dealt into blocks of
    about ``BLOCK`` documents by set size; all pairs of blocks whose sizes allow a link are compared as
    matrices within a task, so no table of pairs is made and no task holds a cluster.
    """
    named = labels.withColumnsRenamed({"node": "id"})
    seats = members.select("key", "id").union(members.select("key", "leader")).distinct().join(named, "id", "left")
    seats = seats.withColumn("component", F.coalesce("component", "id"))
    mixed = seats.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi").select("key")
    held = members.join(mixed, "key", "left_semi").select(F.col("id").alias("a"), F.col("leader").alias("b")).distinct()
    cluster = components(held).select(F.col("node").alias("id"), F.col("component").alias("cluster"))
    # Sizes of linked sets differ by a factor of 100 / percent at most, so by one band at most.
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(101 / percent))).cast("int")
    dealt = settle(
        cluster.join(texts.select("id", "n"), "id")
        .join(named, "id", "left")
        .select("cluster", "id", F.coalesce("component", "id").alias("component"), "n", band.alias("band"))
    )
    many = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES))
    blocks = dealt.groupBy("cluster", "band").agg(many.cast("int").alias("blocks"))
    near = blocks
    for name, step in (("below", -1), ("above", 1)):
        near = near.join(blocks.select("cluster", (F.col("band") - step).alias("band"), F.col("blocks").alias(name)), ["cluster", "band"], "left")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    pair = lambda b1, s1, b2, s2, side: F.struct(b1.alias("b1"), s1.alias("s1"), b2.alias("b2"), s2.alias("s2"), side.alias("side"))
    b, mine = F.col("band"), F.col("mine")
    places = F.concat(
        F.transform(
            upto(F.col("blocks")),
            lambda s: pair(b, F.least(s, mine), b, F.greatest(s, mine), F.when(s == mine, 2).otherwise((s < mine).cast("int"))),
        ),
        F.transform(upto(F.coalesce("above", F.lit(0))), lambda s: pair(b, mine, b + 1, s, F.lit(0))),
        F.transform(upto(F.coalesce("below", F.lit(0))), lambda s: pair(b - 1, s, b, mine, F.lit(1))),
    )
    seated = dealt.join(near, ["cluster", "band"]).withColumn("mine", own).select("cluster", "id", "component", F.explode(places).alias("at"))
    return settle(
        seated.join(texts.select("id", "packed"), "id")
        .select("cluster", "at.b1", "at.s1", "at.b2", "at.s2", "at.side", "id", "component", "packed")
        .groupBy("cluster", "b1", "s1", "b2", "s2")
        .applyInArrow(_between(size, percent), "a long, b long")
    )


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    root: int = TABLES_ROOT,
    rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, n_shingles, component_id, kept (first of its component)."""
    bounded_batches(docs.sparkSession)
    plain = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    sketches = settle(plain.mapInArrow(_sketch(shingle, root, rows), "id long, n long, mark1 long, mark2 long, hands array<long>"))
    marks = ["n", "mark1", "mark2"]
    classes = settle(
        sketches.where((F.col("n") > 0) & F.col("id").isNotNull())
        .groupBy(*marks)
        .agg(F.min("id").alias("id"), F.first("hands").alias("hands"))
    )
    # Leaders of chunks have no leader yet and meet by key; their followers stay in groups of a chunk each.
    bucket = Window.partitionBy("key", "leader").orderBy("id")
    members = settle(
        classes.select("id", "hands")
        .mapInArrow(_tables(root), "key long, id long, leader long")
        .select("key", "id", F.coalesce("leader", F.first("id").over(bucket)).alias("leader"))
        .where(F.col("leader") != F.col("id"))
    )
    suspects = members.select("id").union(members.select("leader")).distinct()
    sized = classes.groupBy("id").agg(F.max("n").alias("n")).join(suspects, "id")
    # Rows that repeat a doc_id with other texts: the text of the largest stands for it.
    texts = settle(
        plain.join(sized, "id").groupBy("id").agg(F.first("n").alias("n"), F.max("text").alias("text")).mapInArrow(_squeeze, "id long, n long, packed binary")
    )

    def linked(pairs: DataFrame) -> DataFrame:
        side = lambda x: texts.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("packed").alias(f"packed_{x}"))
        met = pairs.join(side("b"), "b").join(side("a"), "a").where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        return settle(met.select("a", "b", "packed_a", "packed_b").mapInArrow(_confirm(shingle, percent), "a long, b long"))

    def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """The pairs that are still in different components."""
        for side in ("a", "b"):
            label = labels.select(F.col("node").alias(side), F.col("component").alias(f"c{side}"))
            pairs = pairs.join(label, side, "left")
        return pairs.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")

    first = members.groupBy(F.col("id").alias("a")).agg(F.min("leader").alias("b"))
    links = linked(first)
    labels = components(links)
    others = members.select(F.col("id").alias("a"), F.col("leader").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    links = links.union(linked(apart(others, labels)))
    labels = components(links)

    rest = _rest(members, texts, labels, shingle, percent)
    labels = components(links.union(rest))

    ids = classes.select(*marks, F.col("id").alias("class"))
    return (
        sketches.select("id", *marks)
        .join(ids, marks, "left")
        .join(labels.withColumnsRenamed({"node": "class"}), "class", "left")
        .select(
            F.col("id").alias(doc_id),
            F.col("n").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), F.coalesce("component", "class", "id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col(doc_id) == F.col("component_id"), F.lit(True)))
    )


def op6_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    return near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))

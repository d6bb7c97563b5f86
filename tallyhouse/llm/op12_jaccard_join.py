"""Documents joined by Jaccard similarity of their word n-grams, and the components of the links. Exact.

Equal sets (one class of copies) count once. Two sets of similarity ``percent`` or more share one of the first
``n - ceil(n * percent / 100) + 1`` members of each, in any order of members that holds for all sets. So a class
sends only that head, and classes that share a member of their heads form a tile. The order puts rare members
first, so that a passage that a third of all documents hold comes into few heads: members are counted, over all
documents, in ``COUNTERS`` shared counters (map tasks add up their own, segments of counters are merged by
tasks), and the order is by counter and then by hash. Members that share a counter only make the order less
sharp, never the result wrong. What travels to the tasks is one byte a counter, whatever the input.

Tiles become links in three rounds; the first two make large groups of near copies one component each:

1. every class against the smallest class of all its tiles,
2. against the smallest class of each tile, if still in another component,
3. size-banded tiles: a tile is cut by set size, each band meeting itself and the next one (sets whose sizes
   sizes differ by more cannot link), and bands of many classes into blocks, compared two by two. A block travels as
   one row that holds its classes, so a class is joined once a band, and only block rows are repeated. Only tiles with
   several components are left. Classes of different components are compared by bitmap signatures: bit b is
   the parity of the members that hash to b, so the bits that differ number at most the members that one set
   has and the other hasn't. That bounds the overlap from above; pairs that pass are candidates. Signatures
   have two to four bits a member, so that they tell long texts apart as well as short ones.

A candidate is a link only by intersecting both whole sorted arrays. Nothing is capped: a block pair is compared
within one task, by numpy, first by signatures; classes that are in a candidate come again with their texts,
and the task intersects until its classes are in one component or no candidate is left. So no pair is ever a
row unless it is a link that joins two components.

Members are 64-bit hashes; two of a document's n-grams fall together with odds n ** 2 / 2 ** 65 (1 in 10 ** 11 for
20,000 words). Equal sets are recognised by their size and two 64-bit sums.

Defined results: null, empty and blank texts have an empty set and link with nothing. A null doc_id takes no part:
null component. Rows that share a doc_id are one document for the components, with the links of all its texts.
Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.components import components
from tallyhouse.llm.tables import bounded_batches, read, settle
from tallyhouse.llm.wordspans import CHUNK_BYTES, CHUNK_ROWS, chunks, find_words, let_go, mix
from tallyhouse.sources.sinks import create_table_as

SHINGLE = 5
PERCENT = 80
#: Counters that order the members, and the segments they are merged by.
COUNTERS = 1 << 22
SEGMENTS = 64
#: Classes or pairs that may be broadcast: up to 48 bytes each. More of them are joined by exchange.
FEW = 500_000
#: Classes of a block.
BLOCK = 256
#: Members of all classes of a block: one of large sets holds fewer classes.
BLOCK_MEMBERS = 1 << 19
#: Partners of a class that one task intersects with it.
PARTNERS = 1000
#: Bits of a signature: twice the members, within these limits.
MIN_BITS = 256
MAX_BITS = 32768


def members_of(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of all texts, one text after the other, and how many each has."""
    words = find_words(texts, lower=True)
    if not len(words.row):
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    hashes, counts = words.hashes(), words.counts()
    # A text with fewer words is one n-gram: missing words count as 0.
    padded = np.concatenate((hashes, np.zeros(size - 1, np.uint64)))
    row = np.concatenate((words.row, np.full(size - 1, -1)))
    total = hashes
    for k in range(1, size):
        same = row[k : len(hashes) + k] == words.row
        total = mix(total * np.uint64(3) + np.where(same, padded[k : len(hashes) + k], np.uint64(0)))
    place = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
    whole = place <= np.maximum(counts - size, 0)[words.row]
    value, owner = total[whole].view(np.int64), words.row[whole]
    ends = np.cumsum(np.bincount(owner, minlength=len(texts)))
    for start, end in zip(ends - np.diff(ends, prepend=0), ends, strict=True):
        value[start:end].sort()
    fresh = np.concatenate(([True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])))
    return value[fresh], np.bincount(owner[fresh], minlength=len(texts))


def head_size(n, percent: int):
    return n - -(-percent * n // 100) + 1


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(values))


def _marks(values: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Two sums that tell sets apart."""
    some = np.flatnonzero(counts)
    first = (np.cumsum(counts) - counts)[some]
    mixed = mix(values.view(np.uint64) + np.uint64(1))
    out = [np.zeros(len(counts), np.uint64) for _ in range(2)]
    if len(some):
        out[0][some] = np.add.reduceat(mixed, first)
        out[1][some] = np.add.reduceat(mix(mixed), first)
    return [m.view(np.int64) for m in out]


def _counter(values: np.ndarray) -> np.ndarray:
    return (mix(values.view(np.uint64) ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(COUNTERS)).astype(np.int64)


def _counted(size: int):
    """One task's counters, in compressed segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.uint32)
        for chunk in chunks(batches, "text"):
            np.add.at(counts, _counter(members_of(chunk.column("text"), size)[0]), 1)
        pack = zstandard.ZstdCompressor(level=1).compress
        parts = [pack(part.tobytes()) if part.any() else None for part in counts.reshape(SEGMENTS, -1)]
        some = [k for k, part in enumerate(parts) if part]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([parts[k] for k in some], pa.binary())], names=["segment", "counts"])

    return run


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments added up; of each counter an eighth of an octave is kept, in one byte."""
    unpack = zstandard.ZstdDecompressor().decompress
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, part in zip(batch.column("segment").to_pylist(), batch.column("counts"), strict=True):
            total.setdefault(k, np.zeros(COUNTERS // SEGMENTS, np.int64))
            total[k] += np.frombuffer(unpack(part.as_buffer()), np.uint32)
    level = [np.minimum(8 * np.log2(x + 1.0), 255).astype(np.uint8).tobytes() for x in total.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(level, pa.binary())], names=["segment", "levels"])


def member_levels(plain: DataFrame, size: int) -> np.ndarray:
    """How often the members of each counter occur, as a level; ``COUNTERS`` bytes."""
    parts = plain.select("text").mapInArrow(_counted(size), "segment int, counts binary").repartition(SEGMENTS, "segment")
    levels = np.zeros((SEGMENTS, COUNTERS // SEGMENTS), np.uint8)
    for segment, level in parts.mapInArrow(_levels, "segment int, levels binary").collect():
        levels[segment] = np.frombuffer(level, np.uint8)
    return levels.reshape(-1)


def _heads(size: int, percent: int, levels):
    """(id, n, mark1, mark2, head) of each document; ``levels`` is a broadcast value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "text"):
            values, n = members_of(chunk.column("text"), size)
            marks = _marks(values, n)
            owner = np.repeat(np.arange(len(n)), n)
            # Values ascend within their text already; a stable sort by level keeps that.
            order = np.argsort(levels.value[_counter(values)], kind="stable")
            values = values[order[np.argsort(owner[order].astype(np.uint16), kind="stable")]]
            kept = np.where(n > 0, head_size(n, percent), 0)
            place = np.arange(len(values)) - np.repeat(np.cumsum(n) - n, n)
            head = _lists(values[place < np.repeat(kept, n)], kept)
            yield pa.RecordBatch.from_arrays([chunk.column("id"), pa.array(n, pa.int64()), *map(pa.array, marks), head], names=["id", "n", "mark1", "mark2", "head"])

    return run


def _signatures(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Parity bits of each set, in words of 64: two to four bits a member, a power of two."""
    words = 1 << np.ceil(np.log2(np.clip(2 * counts, MIN_BITS, MAX_BITS) / 64)).astype(np.int64)
    first = np.cumsum(words) - words
    owner = np.repeat(np.arange(len(counts)), counts)
    spread = mix(values.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
    bit = (spread & (64 * words[owner] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.zeros(64 * int(words.sum()), np.uint8)
    np.bitwise_xor.at(odd, 64 * first[owner] + bit, 1)
    # Little-endian words, so that bit b of a signature is bit b % 64 of word b // 64.
    return _lists(np.packbits(odd, bitorder="little").view(np.int64), words)


def _bits_apart(bits: pa.ListArray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bits that differ between the signatures of rows x and y; the longer of two is folded to the shorter."""
    flat, size = bits.flatten().to_numpy().view(np.uint64), bits.value_lengths().to_numpy().astype(np.int64)
    first = np.cumsum(size) - size
    out = np.zeros(len(x), np.int64)
    shorter = np.minimum(size[x], size[y])
    for width in np.unique(shorter):
        pairs = np.flatnonzero(shorter == width)
        used = np.unique(np.concatenate((x[pairs], y[pairs])))
        at = np.full(len(size), -1)
        table = []
        for folds in np.unique(size[used] // width):
            rows = used[size[used] == folds * width]
            at[rows] = np.arange(len(rows)) + sum(map(len, table))
            parts = flat[first[rows][:, None] + np.arange(folds * width)].reshape(len(rows), folds, width)
            table.append(np.bitwise_xor.reduce(parts, axis=1))
        table = np.concatenate(table)
        room = max(1, (1 << 19) // int(width))
        for lo in range(0, len(pairs), room):
            p = pairs[lo : lo + room]
            out[p] = np.bitwise_count(table[at[x[p]]] ^ table[at[y[p]]]).sum(axis=1)
    return out


def _whole_sets(size: int):
    """(c, n, bits, packed) of the texts whose set is the class ``c`` they come with; ``packed`` is the text, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for chunk in chunks(batches, "text", rows=1024):
            values, n = members_of(chunk.column("text"), size)
            marks = _marks(values, n)
            own = np.logical_and.reduce([chunk.column(name).to_numpy() == m for name, m in (("n", n), ("mark1", marks[0]), ("mark2", marks[1]))])
            packed = pa.array([pack(t.as_buffer()) for t in chunk.column("text").cast(pa.large_string())], pa.binary())
            out = pa.RecordBatch.from_arrays([chunk.column("c"), chunk.column("n"), _signatures(values, n), packed], names=["c", "n", "bits", "packed"])
            yield out.filter(pa.array(own))
        let_go()

    return run


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of bounded bytes once unpacked, with their texts; one longer text still goes whole."""
    unpack = zstandard.ZstdDecompressor().decompress
    packed = batch.column("packed")
    ends = np.cumsum([zstandard.frame_content_size(x.as_buffer()) for x in packed])
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = min(first + CHUNK_ROWS, max(first + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, side="right"))))
        texts = pa.array([unpack(x.as_buffer()) for x in packed.slice(first, last - first)], pa.large_binary())
        yield batch.slice(first, last - first), texts.cast(pa.large_string())
        first = last


def _exact(size: int, percent: int):
    """The pairs whose whole sets are similar enough; the row of ``b`` itself comes before those of its partners."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        against, lead = None, np.zeros(0, np.int64)
        for batch in batches:
            for part, texts in _unpacked(batch):
                values, n = members_of(texts, size)
                ends = np.cumsum(n)
                a, b = part.column("a").to_numpy(), part.column("b").to_numpy()
                linked = np.zeros(len(a), dtype=bool)
                for row in range(len(a)):
                    mine = values[ends[row] - n[row] : ends[row]]
                    if a[row] == b[row]:
                        against, lead = b[row], mine
                    elif against == b[row]:
                        common = len(np.intersect1d(lead, mine, assume_unique=True))
                        linked[row] = 100 * common >= percent * (len(lead) + len(mine) - common)
                yield part.select(["a", "b"]).filter(pa.array(linked))
        let_go()

    return run


def _candidates(rows: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of row numbers within a tile whose sizes and signatures allow a link, and how many bits differ."""
    n, group, block = (rows.column(x).to_numpy() for x in ("n", "component", "block"))
    upper = rows.column("upper").to_numpy()
    alone = rows.column("i").to_numpy() == rows.column("j").to_numpy()
    bits = rows.column("bits").combine_chunks()
    tile = _tiles(rows)
    out = [(np.zeros(0, np.int64),) * 3]
    for step in range(1, int(np.bincount(tile).max(initial=1))):
        x = np.flatnonzero(tile[step:] == tile[:-step])
        y = x + step
        ok = (group[x] != group[y]) & (upper[x] | upper[y]) & (alone[x] | (block[x] != block[y]))
        x, y = x[ok], y[ok]
        ok = 100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])
        x, y = x[ok], y[ok]
        apart = _bits_apart(bits, x, y)
        # Overlap is at most (n[x] + n[y] - apart) / 2.
        ok = apart * (100 + percent) <= (100 - percent) * (n[x] + n[y])
        out.append((x[ok], y[ok], apart[ok]))
    return tuple(np.concatenate(z) for z in zip(*out, strict=True))


def _suspects(percent: int):
    """One row for each block pair that holds a candidate, with the classes ``cs`` of its candidates."""

    def run(rows: pa.Table) -> pa.Table:
        x, y, _ = _candidates(rows, percent)
        found = np.unique(np.concatenate((x, y)))
        _, first, counts = np.unique(_tiles(rows)[found], return_index=True, return_counts=True)
        out = rows.select(["key", "band", "i", "j"]).take(pa.array(found[first]))
        return out.append_column("cs", _lists(rows.column("c").to_numpy()[found], counts))

    return run


def _links_within(size: int, percent: int):
    """Links between components in block pairs, confirmed on whole sets; a spanning set of them is enough."""

    def run(rows: pa.Table) -> pa.Table:
        x, y, apart = _candidates(rows, percent)
        c, group = rows.column("c").to_numpy(), rows.column("component").to_numpy()
        packed = rows.column("packed")
        unpack = zstandard.ZstdDecompressor().decompress
        sets: dict[int, np.ndarray] = {}
        up: dict[int, int] = {}
        links = []

        def members(row: int) -> np.ndarray:
            if row not in sets:
                text = pa.array([unpack(packed[row].as_buffer())], pa.large_binary()).cast(pa.large_string())
                sets[row] = members_of(text, size)[0]
            return sets[row]

        def root(node: int) -> int:
            while node in up:
                node = up[node]
            return node

        for i in np.lexsort((apart, _tiles(rows)[x])):
            a, b = int(x[i]), int(y[i])
            one, other = root(int(group[a])), root(int(group[b]))
            if one == other:
                continue
            common = len(np.intersect1d(members(a), members(b), assume_unique=True))
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                up[max(one, other)] = min(one, other)
                links.append((int(c[a]), int(c[b])))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return run


def _unrolled(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A row for each class of the blocks that the rows of ``batch`` hold."""
    lists = batch.column("classes")
    classes = lists.flatten()
    place = pa.array(np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy()))
    of_block = batch.drop_columns(["classes"]).take(place)
    return pa.RecordBatch.from_arrays([*of_block.columns, *classes.flatten()], names=[*of_block.schema.names, *(x.name for x in classes.type)])


def _tile_by_tile(work):
    """``work`` on whole tiles; blocks come sorted by tile, so a tile is a stretch of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(_unrolled(batch))
            rows = pa.Table.from_batches(held).combine_chunks()
            tile = _tiles(rows)
            whole = int(np.searchsorted(tile, tile[-1])) if len(tile) else 0  # the last tile may go on
            if whole:
                yield from work(rows.slice(0, whole).combine_chunks()).to_batches()
            held = rows.slice(whole).combine_chunks().to_batches()
        if held:
            yield from work(pa.Table.from_batches(held).combine_chunks()).to_batches()
        let_go()

    return run


def _tiles(rows: pa.Table) -> np.ndarray:
    """Number of each row's tile."""
    fresh = np.zeros(len(rows), dtype=bool)
    for name in ("key", "band", "i", "j"):
        x = rows.column(name).to_numpy()
        fresh[1:] |= x[1:] != x[:-1]
    return np.cumsum(fresh)


def _tiles_of(members: DataFrame) -> DataFrame:
    """``members`` with the size and the smallest class of their tile; of tiles with the same classes one is left."""
    tiles = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"),
        F.min("c").alias("lead"),
        F.bit_xor(F.xxhash64("c")).alias("who1"),
        F.bit_xor(F.xxhash64("c", F.lit(1))).alias("who2"),
    )
    one_each = tiles.groupBy("size", "lead", "who1", "who2").agg(F.min("key").alias("key")).select("key", "lead")
    return members.join(one_each, "key")


def _small(df: DataFrame) -> DataFrame:
    """``df``, broadcast if it has few rows."""
    return F.broadcast(df) if df.limit(FEW + 1).count() <= FEW else df


def _banded(members: DataFrame, sets: DataFrame, labels: DataFrame, size: int, percent: int, block: int) -> DataFrame:
    """Links of round 3. Signatures go to the block pairs first, texts only to those that hold a candidate."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(100.5 / percent))).cast("int")
    named = (
        members.select("key", "c", "n")
        .join(labels.select(F.col("node").alias("c"), "component"), "c", "left")
        .withColumn("component", F.coalesce("component", "c"))
        # The tile of a band also holds the band below: its classes meet only those of the band itself.
        .withColumn("at", F.explode(F.array(F.struct(band.alias("band"), F.lit(True).alias("upper")), F.struct((band + 1).alias("band"), F.lit(False).alias("upper")))))
        .select("key", "at.band", "at.upper", "c", "n", "component")
    )
    mixed = (
        named.groupBy("key", "band")
        .agg(F.count(F.lit(1)).alias("many"), F.sum("n").alias("all"), F.max("upper").alias("any"), F.min("component").alias("lo"), F.max("component").alias("hi"))
        .where("any AND lo != hi")
        .select("key", "band", F.greatest(F.ceil(F.col("many") / block), F.ceil(F.col("all") / BLOCK_MEMBERS)).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("c", "key"), F.col("blocks")).cast("int")
    seated = settle(named.join(mixed, ["key", "band"]).withColumn("block", own))
    tile = ["key", "band", "i", "j"]

    def in_blocks(seats: DataFrame, *of_sets: str) -> DataFrame:
        """One row a block, with all of its classes."""
        rows = seats.join(sets.select("c", *of_sets), "c")
        classes = F.collect_list(F.struct("upper", "c", "component", "n", *of_sets)).alias("classes")
        return rows.groupBy("key", "band", "blocks", "block").agg(classes)

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.select(*tile, "block", "classes").repartition(*tile).sortWithinPartitions(*tile)

    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    met = (
        in_blocks(seated, "bits")
        .select("key", "band", "block", "classes", other)
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    )
    suspects = settle(dealt(met).mapInArrow(_tile_by_tile(_suspects(percent)), "key long, band int, i int, j int, cs array<long>"))
    again = suspects.select("key", "band", F.explode("cs").alias("c")).distinct()
    # Block pairs by each of their blocks.
    sides = suspects.select(*tile, F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    held = in_blocks(seated.join(again, ["key", "band", "c"]), "bits", "packed").join(sides, ["key", "band", "block"])
    return settle(dealt(held).mapInArrow(_tile_by_tile(_links_within(size, percent)), "a long, b long"))


def jaccard_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, n_shingles, component_id (null for a null doc_id)."""
    bounded_batches(docs.sparkSession)
    plain = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    marks = ["n", "mark1", "mark2"]
    levels = docs.sparkSession.sparkContext.broadcast(member_levels(plain, shingle))
    headed = settle(plain.mapInArrow(_heads(shingle, percent, levels), "id long, n long, mark1 long, mark2 long, head array<long>"))
    real = headed.where((F.col("n") > 0) & F.col("id").isNotNull())
    classes = settle(
        real.groupBy(*marks).agg(F.min("id").alias("id"), F.first("head").alias("head")).withColumn("c", F.monotonically_increasing_id())
    )
    entries = classes.select(F.explode("head").alias("key"), "c", "n")
    shared = settle(entries.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key"))
    members = create_table_as(_tiles_of(create_table_as(entries.join(shared, "key"), "shared-members")), "tile-members")
    met = settle(classes.select("c", "id", *marks).join(members.select("c").distinct(), "c", "left_semi"))
    texts = plain.join(_small(met), "id")
    if not headed.where("id IS NOT NULL").groupBy("id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").isEmpty():
        texts = texts.distinct()  # rows that repeat a doc_id and its text
    sets = settle(texts.mapInArrow(_whole_sets(shingle), "c long, n long, bits array<long>, packed binary"))

    def linked(pairs: DataFrame) -> DataFrame:
        """The pairs that are links. Each text goes once to its partner ``b``; one with many partners has several seats."""
        pairs = settle(pairs)
        seats = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("int").alias("seats"))
        seated = pairs.join(_small(seats), "b").withColumn("seat", F.pmod(F.xxhash64("a"), F.col("seats")).cast("int"))
        leads = seated.select("b", "seat").distinct().withColumn("a", F.col("b"))
        texts = sets.select(F.col("c").alias("a"), "packed")
        met = [texts.join(_small(settle(x.select("a", "b", "seat"))), "a").select("a", "b", "seat", "packed") for x in (seated, leads)]
        sides = met[0].union(met[1]).repartition("b", "seat").sortWithinPartitions("b", "seat", F.col("a") != F.col("b"))
        return settle(sides.select("a", "b", "packed").mapInArrow(_exact(shingle, percent), "a long, b long"))

    def possible(pairs: DataFrame) -> DataFrame:
        """The pairs whose sizes and signatures allow a link."""
        for x in ("a", "b"):
            pairs = pairs.join(sets.select(F.col("c").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}")), x)
        width = F.least(F.size("bits_a"), F.size("bits_b"))

        def folded(bits: str, k) -> Column:
            parts = F.sequence(F.lit(0), (F.size(bits) / width).cast("int") - 1)
            return F.aggregate(parts, F.lit(0).cast("long"), lambda word, j: word.bitwiseXOR(F.get(bits, k + j * width)))

        differ = F.aggregate(
            F.sequence(F.lit(0), width - 1), F.lit(0), lambda total, k: total + F.bit_count(folded("bits_a", k).bitwiseXOR(folded("bits_b", k)))
        )
        sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
        return pairs.where(sizes & (differ * (100 + percent) <= (100 - percent) * (F.col("n_a") + F.col("n_b")))).select("a", "b")

    def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """The pairs that are still in different components."""
        for side in ("a", "b"):
            label = labels.select(F.col("node").alias(side), F.col("component").alias(f"c{side}"))
            pairs = pairs.join(label, side, "left")
        return pairs.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")

    followers = members.where("c != lead")
    first = settle(followers.groupBy(F.col("c").alias("a")).agg(F.min("lead").alias("b")))
    links = linked(possible(first))
    labels = components(links)
    others = followers.select(F.col("c").alias("a"), F.col("lead").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    links = links.union(linked(possible(apart(others, labels))))
    labels = components(links)
    links = links.union(_banded(members, sets, labels, shingle, percent, block))

    # A doc_id with several texts ties their classes together.
    rows = headed.select("id", *marks).join(classes.select("c", *marks), marks, "left")
    ties = rows.where("c IS NOT NULL AND id IS NOT NULL").groupBy("id").agg(F.min("c").alias("a"), F.max("c").alias("b")).where("a != b")
    if not ties.isEmpty():
        ties = rows.where("c IS NOT NULL").join(ties.select("id", "a"), "id").select("a", F.col("c").alias("b")).where("a != b")
        links = links.union(ties)
    labels = components(links).withColumnsRenamed({"node": "c"})
    lowest = labels.join(classes.select("c", "id"), "c").groupBy("component").agg(F.min("id").alias("low"))
    low = labels.join(lowest, "component").select("c", "low")
    alone = classes.select("c", F.col("id").alias("own"))
    return (
        rows.join(alone.join(low, "c", "left"), "c", "left")
        .select(
            F.col("id").alias(doc_id),
            F.col("n").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), F.coalesce("low", "own", "id")).alias("component_id"),
        )
    )


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    return jaccard_components(read(spark, sf_dir, "documents").select("doc_id", "text"))


def oracle(shingle: int = SHINGLE, percent: int = PERCENT) -> str:
    """DuckDB SQL for the same rows, for unique ids: every pair that shares an n-gram is counted."""
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(words) - {shingle - 1}, 1) + 1),
         lambda i: array_to_string(words[i:i + {shingle - 1}], ' '))) END AS grams
  FROM w
), g AS MATERIALIZED (
  SELECT doc_id, unnest(grams) AS gram FROM s
), l AS MATERIALIZED (
  SELECT p.a, p.b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM g x JOIN g y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN s m ON m.doc_id = p.a JOIN s n ON n.doc_id = p.b
  WHERE 100 * common >= {percent} * (len(m.grams) + len(n.grams) - common)
), reach AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION
  SELECT l.b, r.root FROM reach r JOIN l ON l.a = r.node
)
SELECT s.doc_id, len(s.grams)::BIGINT AS n_shingles, (SELECT min(root) FROM reach WHERE node = s.doc_id) AS component_id
FROM s
"""

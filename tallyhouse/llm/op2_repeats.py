"""Repeated passages: windows of words that already start in an earlier document are removed.

Super-k-mer partitioning. Each window of ``window`` words has a minimiser, the least hash of its word
pairs. Consecutive windows that share it travel as one packed string to the bucket of that minimiser;
equal windows have equal minimisers, so they meet there, and sorting brings them side by side. Bytes
are compared, not only hashes.

A first pass counts the text and the word pairs. Pairs found more than ``HOT`` times are no minimisers, so that
none draws a share of all windows to one bucket; a window of such pairs only goes by its least and greatest pair.
Buckets are as many as the counted bytes need.

Before anything travels, each chunk of documents settles what it can alone: of equal windows only those
of its smallest document go on, since the others are known to repeat. So a passage that a third of all
documents share sends one copy per chunk. Travelling strings are packed by bucket and compressed.

Defined results: null or empty text has no words. A null doc_id is kept whole and is compared with
nothing. Rows that repeat a doc_id are not earlier than each other. New columns replace columns of the
same name; all others are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.tables import OWN, bounded_batches, buckets, read, widened, without
from tallyhouse.llm.wordspans import Words, buffer_of, chunks, find_words, mix, rolling

WINDOW = 13
#: Word pairs found more often than this are no minimisers; ones found less than ``SEEN`` times in a chunk are not counted.
HOT, SEEN = 100_000, 16
#: Bytes of text for each bucket.
BUCKET_BYTES = 16 << 20
_ID, _SIG, _SPANS = f"{OWN}id", f"{OWN}sig", f"{OWN}spans"
_PACKED = "bucket int, settled boolean, ids binary, sigs binary, firsts binary, counts binary, words binary"
_FOUND = "id long, sig int, first int, n int"
_RESULT = "n_words long, n_removed long, kept_text string"


def _pairs(words: np.ndarray, window: int) -> np.ndarray:
    """Hashes of the word pairs; of the words if windows have no pair."""
    return words if window == 1 else mix(words[:-1] * np.uint64(3) + words[1:])


def _over_window(values: np.ndarray, window: int, pick: np.ufunc) -> np.ndarray:
    """For each place, the least (or greatest) of the pairs in the window that starts there."""
    span, want = 1, max(1, window - 1)
    while span * 2 <= want:
        values = pick(values[:-span], values[span:])
        span *= 2
    if want > span:
        values = pick(values[: len(values) - (want - span)], values[want - span :])
    return values


def _minimiser(words: np.ndarray, window: int, hot: np.ndarray) -> np.ndarray:
    """For each place, the least hash of a pair that is not hot; if all are, a hash of the least and the greatest."""
    pairs = _pairs(words, window)
    least = _over_window(pairs, window, np.minimum)
    if not len(hot):
        return least
    none = np.uint64((1 << 64) - 1)
    cool = _over_window(np.where(np.isin(pairs, hot), none, pairs), window, np.minimum)
    return np.where(cool == none, mix(least * np.uint64(3) + _over_window(pairs, window, np.maximum)), cool)


def _count_pairs(window: int, seen: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "text"):
            _, at = buffer_of(chunk.column("text"))
            hashes = find_words(chunk.column("text")).hashes()
            pair, n = np.unique(_pairs(hashes, window), return_counts=True) if len(hashes) > 1 else (hashes[:0], np.zeros(0, np.int64))
            pair, n = pair[n >= seen].view(np.int64), n[n >= seen]
            # The row without a pair has the bytes of the chunk.
            yield pa.RecordBatch.from_arrays([pa.array([None, *pair.tolist()], pa.int64()), pa.array([int(at[-1] - at[0]), *n.tolist()], pa.int64())], names=["pair", "n"])

    return run


def _repeats(order: np.ndarray, key: np.ndarray, owner: np.ndarray, text: bytes, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which windows repeat one of a smaller owner. ``order`` sorts by key, then by owner."""
    found = np.zeros(len(key), dtype=bool)
    k, o = key[order], owner[order]
    fresh = np.concatenate(([True], k[1:] != k[:-1]))
    group = np.cumsum(fresh) - 1
    first = np.flatnonzero(fresh)
    last = np.concatenate((first[1:], [len(k)])) - 1
    several = (o[first] != o[last])[group]  # some window of another owner has this key
    at = order[several]
    seen: dict[bytes, int] = {}
    now = -1
    for i, g, own, a, b in zip(at.tolist(), group[several].tolist(), owner[at].tolist(), lo[at].tolist(), hi[at].tolist(), strict=True):
        if g != now:
            seen, now = {}, g
        if seen.setdefault(text[a:b], own) < own:
            found[i] = True
    return found


def _pack(window: int, parts: int, hot: np.ndarray):
    """Map side: settle windows that repeat within the chunk, pack the rest by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for chunk in chunks(batches, "text"):
            chunk = chunk.sort_by("id")
            ids = chunk.column("id").to_numpy()
            sigs = chunk.column("sig").to_numpy()
            words = find_words(chunk.column("text"))
            count = len(words.row) - window + 1
            if count < 1:
                continue
            hashes = words.hashes()
            text, place = words.packed()
            ok = np.flatnonzero(words.row[:count] == words.row[window - 1 :])
            if not len(ok):
                continue
            key = rolling(hashes, ok, ok + window)
            owner = ids[words.row[ok]]
            known = _repeats(np.argsort(key, kind="stable"), key, owner, text, place[ok], place[ok + window] - 1)
            start_of_row = np.searchsorted(words.row, np.arange(words.rows))
            rows = {name: [] for name in ("bucket", "settled", "ids", "sigs", "firsts", "counts", "words")}

            def emit(bucket, settled, first, n, packed):
                row = words.row[first]
                rows["bucket"].append(bucket)
                rows["settled"].append(settled)
                rows["ids"].append(squeeze(np.diff(ids[row], prepend=0).tobytes()))
                rows["sigs"].append(sigs[row].astype(np.int16).tobytes())
                rows["firsts"].append(squeeze((first - start_of_row[row]).astype(np.int32).tobytes()))
                rows["counts"].append(squeeze(n.astype(np.int32).tobytes()))
                rows["words"].append(packed)

            def stretches(of: np.ndarray, label: np.ndarray):
                """First and last + 1 of the runs of neighbouring windows of one row with one label."""
                cut = np.ones(len(of), dtype=bool)
                cut[1:] = (of[1:] != of[:-1] + 1) | (words.row[of[1:]] != words.row[of[:-1]]) | (label[1:] != label[:-1])
                begin = np.flatnonzero(cut)
                return begin, np.concatenate((begin[1:], [len(of)]))

            if known.any():
                of = ok[known]
                begin, end = stretches(of, np.zeros(len(of), dtype=np.uint64))
                emit(int(ids[0]) % parts, True, of[begin], end - begin, b"")
            of = ok[~known]
            if len(of):
                least = _minimiser(hashes, window, hot)[of]
                begin, end = stretches(of, least)
                bucket = (least[begin] % np.uint64(parts)).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                bucket, begin, end = bucket[by], begin[by], end[by]
                first, n = of[begin], end - begin
                lo, hi = place[first].tolist(), (place[first + n + window - 1] - 1).tolist()
                edges = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
                for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    emit(int(bucket[i]), False, first[i:j], n[i:j], squeeze(b" ".join([text[a:b] for a, b in zip(lo[i:j], hi[i:j], strict=True)])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["bucket"], pa.int32()), pa.array(rows["settled"], pa.bool_())]
                + [pa.array(rows[c], pa.binary()) for c in ("ids", "sigs", "firsts", "counts", "words")],
                names=list(rows),
            )

    return run


def _found(ids, sigs, firsts, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(sigs, pa.int32()), pa.array(firsts, pa.int32()), pa.array(counts, pa.int32())],
        names=["id", "sig", "first", "n"],
    )


def _resolve(window: int):
    """Bucket side: the rows come sorted by bucket; each bucket is unpacked, sorted and let go."""

    def settle_bucket(packs: list[dict]) -> pa.RecordBatch | None:
        open_ = zstandard.ZstdDecompressor().decompress
        ids = np.concatenate([np.cumsum(np.frombuffer(open_(p["ids"]), np.int64)) for p in packs])
        sigs = np.concatenate([np.frombuffer(p["sigs"], np.int16) for p in packs])
        firsts = np.concatenate([np.frombuffer(open_(p["firsts"]), np.int32) for p in packs])
        counts = np.concatenate([np.frombuffer(open_(p["counts"]), np.int32) for p in packs]).astype(np.int64)
        text = b" ".join([open_(p["words"]) for p in packs])
        packs.clear()
        data = np.frombuffer(text, np.uint8)
        gap = np.flatnonzero(data == 0x20)
        words = Words(1, data, gap[:0], np.concatenate(([0], gap + 1)), np.concatenate((gap, [len(data)])))
        # Word number of each string's first window, then of all its windows.
        base = np.cumsum(counts + window - 1) - (counts + window - 1)
        string = np.repeat(np.arange(len(counts)), counts)
        inner = np.arange(len(string)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = base[string] + inner
        key = rolling(words.hashes(), at, at + window)
        owner = ids[string]
        repeats = _repeats(np.lexsort((owner, key)), key, owner, text, words.start[at], words.end[at + window - 1])
        if not repeats.any():
            return None
        cut = repeats.copy()
        cut[1:] &= ~(repeats[:-1] & (string[1:] == string[:-1]))
        begin = np.flatnonzero(cut)
        stop = repeats.copy()
        stop[:-1] &= ~(repeats[1:] & (string[1:] == string[:-1]))
        end = np.flatnonzero(stop) + 1
        of = string[begin]
        return _found(ids[of], sigs[of].astype(np.int32), firsts[of] + inner[begin].astype(np.int32), (end - begin).astype(np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor().decompress
        packs: list[dict] = []
        now = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
                if row["settled"]:
                    yield _found(
                        np.cumsum(np.frombuffer(open_(row["ids"]), np.int64)),
                        np.frombuffer(row["sigs"], np.int16).astype(np.int32),
                        np.frombuffer(open_(row["firsts"]), np.int32),
                        np.frombuffer(open_(row["counts"]), np.int32),
                    )
                    continue
                if row["bucket"] != now and packs and (out := settle_bucket(packs)):
                    yield out
                now = row["bucket"]
                packs.append(row)
        if packs and (out := settle_bucket(packs)):
            yield out

    return run


def _cut(window: int, text: str, names: list[str]):
    """Count words, drop those that the found windows cover, join the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, text):
            words = find_words(chunk.column(chunk.schema.get_field_index(text)))
            counts = words.counts()
            base = np.cumsum(counts) - counts
            step = np.zeros(len(words.row) + 1, dtype=np.int64)
            spans = chunk.column(chunk.schema.get_field_index(_SPANS))
            flat = spans.flatten()
            if len(flat):
                size = np.diff(spans.offsets.to_numpy().astype(np.int64)) if spans.null_count == 0 else np.array([len(s) if s is not None else 0 for s in spans.to_pylist()])
                first = flat.field("first").to_numpy() + np.repeat(base, size)
                np.add.at(step, first, 1)
                np.add.at(step, first + flat.field("n").to_numpy() + window - 1, -1)
            keep = np.cumsum(step[:-1]) == 0
            packed, place = words.packed()
            kept = np.frombuffer(packed, np.uint8)[np.repeat(keep, np.diff(place))]
            left = np.bincount(words.row[keep], minlength=words.rows)
            size = np.bincount(words.row[keep], weights=np.diff(place)[keep], minlength=words.rows).astype(np.int64)
            end = np.cumsum(size)
            raw = kept.tobytes()
            texts = [raw[a : max(a, b - 1)] for a, b in zip((end - size).tolist(), end.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [chunk.column(chunk.schema.get_field_index(c)) for c in names]
                + [pa.array(counts, pa.int64()), pa.array(counts - left, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
                names=[*names, "n_words", "n_removed", "kept_text"],
            )

    return run


def cut_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_removed and kept_text (kept words joined by one space)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = without(docs, ["n_words", "n_removed", "kept_text"])
    # Two rows of one doc_id with different texts are told apart by 15 bits of the text's hash.
    sig = F.pmod(F.xxhash64(F.col(text)), F.lit(1 << 15)).cast("int")
    compared = docs.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull())
    counted = compared.select(F.col(text).alias("text")).mapInArrow(_count_pairs(window, SEEN), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    # At most one pair for each ``HOT`` words, and the bytes.
    often = counted.where(F.col("pair").isNull() | (F.col("n") > HOT)).collect()
    hot = np.array([r.pair for r in often if r.pair is not None], np.int64).view(np.uint64)
    parts = max(buckets(spark), sum(r.n for r in often if r.pair is None) // BUCKET_BYTES)
    packed = compared.select(F.col(doc_id).cast("long").alias("id"), sig.alias("sig"), F.col(text).alias("text")).mapInArrow(_pack(window, parts, hot), _PACKED)
    found = packed.repartition("bucket").sortWithinPartitions("settled", "bucket").mapInArrow(_resolve(window), _FOUND)
    spans = found.groupBy("id", "sig").agg(F.collect_list(F.struct("first", "n")).alias(_SPANS))
    names = docs.columns
    joined = docs.withColumns({_ID: F.col(doc_id).cast("long"), _SIG: sig}).join(
        spans.withColumnsRenamed({"id": _ID, "sig": _SIG}), [_ID, _SIG], "left"
    )
    return joined.select(*(F.col(f"`{c}`") for c in names), _SPANS).mapInArrow(_cut(window, text, names), widened(docs, _RESULT))


def op2_super_kmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words, for every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return cut_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))

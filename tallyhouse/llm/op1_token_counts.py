"""Token counts of whole texts by byte-pair merging, without making the tokens.

A pretoken's bytes are a linked list of symbols; a heap holds the rank of every adjacent pair. The lowest
rank is popped, its two symbols become one, and the pairs on either side are pushed. The count is the
initial symbols minus the merges. Pretokens repeat, so their counts are kept in a bounded table of each
Python worker. Any length works: n bytes cost n log n.

Defined results: null and empty texts have 0 tokens and 0 bytes. A special string inside a text is one
token, as the library counts by default.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.tables import read, without

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: Counts that a worker keeps, and the longest pretoken whose count is kept.
KEPT, KEPT_LENGTH = 300_000, 64
_BITS = 20
_LOW = (1 << _BITS) - 1


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: itself if printable, else from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Counts(dict):
    """Pretoken -> number of tokens; missing ones are merged and, if not too long, kept."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        pair_of = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        #: left << 20 | right -> rank << 20 | merged
        self.merges = {ids[a] << _BITS | ids[b]: rank << _BITS | ids[a + b] for rank, (a, b) in enumerate(pair_of)}
        letters = _byte_letters()
        self.symbols = [ids[letters[b]] for b in range(256)]
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.pieces = regex.compile(public_tokenizers.PATTERN)

    def __missing__(self, pretoken: str) -> int:
        n = self.merged(pretoken.encode("utf-8"))
        if len(pretoken) <= KEPT_LENGTH:
            if len(self) >= KEPT:
                self.clear()
            self[pretoken] = n
        return n

    def merged(self, raw: bytes) -> int:
        n = len(raw)
        if n < 2:
            return n
        table, symbol = self.merges, [self.symbols[b] for b in raw]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = table.get(symbol[i] << _BITS | symbol[i + 1])
            if found is not None:
                heap.append(((found >> _BITS) << 40) | i)
        heapq.heapify(heap)
        merges = 0
        while heap:
            top = heapq.heappop(heap)
            i, rank = top & ((1 << 40) - 1), top >> 40
            j = after[i]
            if symbol[i] < 0 or j >= n:
                continue
            found = table.get(symbol[i] << _BITS | symbol[j])
            if found is None or found >> _BITS != rank:
                continue  # one of the two has been merged with another since
            symbol[i], symbol[j] = found & _LOW, -1
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = table.get(symbol[i] << _BITS | symbol[k])
                if found is not None:
                    heapq.heappush(heap, ((found >> _BITS) << 40) | i)
            h = before[i]
            if h >= 0:
                found = table.get(symbol[h] << _BITS | symbol[i])
                if found is not None:
                    heapq.heappush(heap, ((found >> _BITS) << 40) | h)
        return n - merges

    def of(self, text: str | None) -> int:
        if not text:
            return 0
        parts = self.special.split(text) if self.special else [text]
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.pieces.findall(p))) for p in parts)


_COUNTS: dict[str, Counts] = {}


def counts_for(vocabulary: str) -> Counts:
    """The table of this process; a worker that serves many tasks reads the vocabulary once."""
    if vocabulary not in _COUNTS:
        _COUNTS[vocabulary] = Counts(public_tokenizers.path(vocabulary))
    return _COUNTS[vocabulary]


def token_counts(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit; they replace columns of the same name."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counts = counts_for(vocabulary)
        for texts in batches:
            yield texts.map(counts.of, na_action=None).astype("int64")

    docs = without(docs, ["n_bytes", "n_tokens", "over_limit"])
    n_bytes = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")
    counted = docs.withColumns({"n_bytes": n_bytes, "n_tokens": count(F.col(text))})
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")

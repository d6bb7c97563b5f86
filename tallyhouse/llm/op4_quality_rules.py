"""Quality rules: a decision list learned from labelled text statistics, run as Spark conditions.

Sequential covering: a rule is a conjunction of thresholds on statistics, grown by the gain of each further
condition on two thirds of the labelled sample, pruned from its end on the other third, and accepted while
it is precise there; the documents it covers go, and the next rule is grown. The list becomes one ordered
CASE expression, so that scoring is native. Statistics are of whole texts; hashes of word windows are
compared with 64 bits.

The sample is bounded: at most ``SAMPLE`` documents of each label (see labelled.sample). Its good documents
are weighed against its bad ones so that the mix is that of all labels, and precise means the same at every
size. Without labels of
both kinds there are no rules.

Defined results: null text has no words. A null doc_id gets its statistics and a verdict as any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.labelled import sample
from tallyhouse.llm.tables import read, settle
from tallyhouse.llm.wordspans import buffer_of, chunks, find_words, mix, rolling

SAMPLE = 10_000
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, REPEAT_PERCENT, REPEAT_WINDOW = 50, 50, 3
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct"]
#: Statistics that rules may test, as expressions over the counts.
FEATURES = {
    "words": "double(n_words)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_rate": "n_symbols / greatest(n_words, 1)",
    "dup_line_rate": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_rate": "n_repeat_words / greatest(n_words, 1)",
    "upper_rate": "n_upper / greatest(word_chars, 1)",
    "digit_rate": "n_digits / greatest(word_chars, 1)",
    "mark_rate": "n_marks / greatest(n_words, 1)",
    "distinct_rate": "n_distinct / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}

_KIND = np.zeros((4, 256), dtype=np.int64)
_KIND[0, list(SYMBOLS)] = 1
_KIND[1, 65:91] = 1
_KIND[2, 48:58] = 1
_KIND[3, list(b"!?.,;:'\"()")] = 1


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[at[1:]] - total[at[:-1]]


def _statistics(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "text"):
            texts = chunk.column("text")
            data, at = buffer_of(texts)
            words = find_words(texts)
            counts = words.counts()
            bounds = np.concatenate(([0], np.cumsum(counts)))
            points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            hashes = words.hashes()
            own = mix(words.row.astype(np.uint64) + np.uint64(1))
            repeated = np.zeros(len(hashes) + 1, dtype=np.int64)
            ok = np.flatnonzero(words.row[: max(0, len(hashes) - window + 1)] == words.row[window - 1 :])
            if len(ok):
                key = rolling(hashes, ok, ok + window) ^ own[ok]
                order = np.argsort(key)
                same = np.concatenate(([False], key[order][1:] == key[order][:-1], [False]))
                again = ok[order[same[1:] | same[:-1]]]
                np.add.at(repeated, again, 1)
                np.subtract.at(repeated, again + window, 1)
            key = (hashes >> np.uint64(12)) | (words.row.astype(np.uint64) << np.uint64(52))
            key.sort()
            fresh = key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key
            lines, dup = [], []
            for text in texts.to_pylist():
                full = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
                lines.append(len(full))
                dup.append(len(full) - len(set(full)))
            kinds = [_sums(k[data], at) for k in _KIND]
            columns = [
                counts,
                _sums(points[words.end] - points[words.start], bounds),
                kinds[0],
                np.array(dup),
                _sums(np.cumsum(repeated[:-1]) > 0, bounds),
                np.array(lines),
                *kinds[1:],
                np.bincount((fresh >> np.uint64(52)).astype(np.int64), minlength=chunk.num_rows),
            ]
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", *COUNTS])

    return run


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and the counts of its text."""
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return plain.mapInArrow(_statistics(REPEAT_WINDOW), "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    bound: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.bound if self.above else x[self.feature] <= self.bound

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > self.bound if self.above else value <= self.bound


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    held = np.ones(n, dtype=bool)
    for c in rule:
        held &= c.holds(x)
    return held


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, longest: int, cuts: int, good_weight: float) -> Rule:
    rule: Rule = ()
    held = np.ones(len(bad), dtype=bool)
    while len(rule) < longest and (held & ~bad).any():
        p, n = int((held & bad).sum()), good_weight * int((held & ~bad).sum())
        best, gain = None, 1e-9
        for name, values in x.items():
            levels = np.unique(np.quantile(values[held & bad], np.linspace(0, 1, cuts)))
            for bound in np.unique(np.concatenate((levels, levels - 1e-6))).tolist():
                for above in (True, False):
                    c = Condition(name, above, bound)
                    now = held & c.holds(x)
                    q, m = int((now & bad).sum()), good_weight * int((now & ~bad).sum())
                    if q and (g := q * (np.log2(q / (q + m)) - np.log2(p / (p + n)))) > gain:
                        best, gain = c, g
        if best is None:
            break
        rule = (*rule, best)
        held &= best.holds(x)
    return rule


def learn(x: dict[str, np.ndarray], bad: np.ndarray, longest: int = 4, most: int = 24, precise: float = 0.9, cuts: int = 24, good_weight: float = 1.0) -> list[Rule]:
    """Ordered rules for ``bad``. Rows alternate between growing (two of three) and pruning.

    A row that is not bad counts ``good_weight`` times one that is.
    """
    rules: list[Rule] = []
    grow = np.arange(len(bad)) % 3 != 0
    left = np.ones(len(bad), dtype=bool)
    while len(rules) < most and (left & grow & bad).any():
        of = left & grow
        rule = _grow({k: v[of] for k, v in x.items()}, bad[of], longest, cuts, good_weight)

        def worth(r: Rule, of=left & ~grow) -> float:
            held = covers(r, x, len(bad)) & of
            p, n = int((held & bad).sum()), good_weight * int((held & ~bad).sum())
            return (p - n) / (p + n) if p + n else -1.0

        options = [rule[:k] for k in range(1, len(rule) + 1)]
        rule = max(options, key=lambda r: (worth(r), -len(r)), default=())
        held = covers(rule, x, len(bad)) & left
        p, n = int((held & bad).sum()), good_weight * int((held & ~bad).sum())
        if not rule or worth(rule) < 2 * precise - 1 or p < precise * (p + n):
            break
        rules.append(rule)
        left &= ~held
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The list as one ordered condition: the first rule that holds drops the document."""
    out = None
    for rule in rules:
        held = F.lit(True)
        for c in rule:
            held = held & c.column()
        out = F.when(held, False) if out is None else out.when(held, False)
    return F.lit(True) if out is None else out.otherwise(True)


def learn_rules(counts: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = SAMPLE) -> list[Rule]:
    """Rules that drop documents like those of label 0, from a bounded sample of labelled counts."""
    picked = F.broadcast(sample(labels, label, per_class))
    known = counts.join(picked, "doc_id").select("doc_id", "label", "weight", *(F.expr(e).cast("double").alias(n) for n, e in FEATURES.items()))
    one = known.dropDuplicates(["doc_id"]).toPandas()  # at most 2 * per_class rows
    one = one.assign(at=(one["doc_id"] * 2654435761) % (1 << 32)).sort_values(["at", "doc_id"])
    weights = dict(zip(one["label"], one["weight"], strict=True))
    return learn({n: one[n].to_numpy() for n in FEATURES}, (one["label"] == 0).to_numpy(), good_weight=weights.get(1, 1.0) / weights.get(0, 1.0))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, base_failed and kept."""
    counts = settle(statistics(docs))
    rules = learn_rules(counts, labels)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return counts.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def op4_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    judged = judge(docs, read(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")

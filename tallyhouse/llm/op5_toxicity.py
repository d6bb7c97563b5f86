"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression.

The lexicon is learned too: words and word beginnings that mark toxic training documents, by the log-odds
of document frequencies, from a bounded sample of labelled documents. Features of a text: densities of
lexicon words and beginnings, hits near a second-person word, second-person words, capitals, exclamation and
other punctuation, and obfuscation (letters mixed with digits or signs; such words are looked up spelled
out). One pass over whole texts makes them; trees and calibration are Spark ML over the sample's features.
A part of the sample, chosen by hash, calibrates and grows no tree.

The sample has at most ``SAMPLE`` documents of each label. Trees and calibration weigh each by the documents
of its label that it stands for, so a score is a share of all labelled documents at every size. The lexicon
compares shares within each label, which the mix of labels does not change; its counts stay those of
documents seen, since the smoothing of rare words rests on them. Labels come only from rows that ``learn_from``
keeps. With one label only, every score is that label's share; without labels 0. With too few rows to
calibrate, the trees' own probability is the score.

Defined results: null and empty texts have all features 0 and get a score. Null ids are scored too.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.labelled import sample
from tallyhouse.llm.tables import bounded_batches, read, settle
from tallyhouse.llm.wordspans import buffer_of, chunks

SAMPLE = 4_000
LEXICON, LEAST_DOCS, LEAST_ODDS = 500, 4, 3.0
BEGINNINGS = (4, 5, 6)
NEAR = 5
FEATURES = [
    "words", "lexicon_rate", "lexicon_hits", "beginning_rate", "near_second_person", "second_person_rate",
    "upper_rate", "exclamation_rate", "mark_rate", "digit_rate", "obfuscated_rate", "obfuscated_hits",
]
#: Second-person words of the languages of the corpus.
SECOND_PERSON = frozenset("you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer sie ti tus usted ustedes vosotros".split())
#: Signs that stand for letters in disguised words.
DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
EDGE = "\"'.,;:!?()[]{}<>|*#%&-_~`"
_INNER = re.compile(r"[^\W\d_](?:[\d@$!*.\-_]+)[^\W\d_]")
_NOT_LETTER = re.compile(r"[\W\d_]+")
_KEPT = 150_000
_BYTES = np.zeros((4, 256), dtype=np.int64)
_BYTES[0, 65:91] = 1
_BYTES[1, ord("!")] = 1
_BYTES[2, list(b".,;:?'\"()-*#$%&|")] = 1
_BYTES[3, 48:58] = 1


def plain(word: str) -> tuple[str, bool]:
    """The lower-case word without edge punctuation, spelled out if it is disguised; whether it was."""
    bare = word.strip(EDGE)
    if bare.isalpha() or not bare:
        return bare, False
    if _INNER.search(bare):
        return _NOT_LETTER.sub("", bare.translate(DISGUISE)), True
    return bare, False


def keys(word: str) -> list[str]:
    return [word, *(word[:k] + "~" for k in BEGINNINGS if len(word) > k)]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = (Counter(), Counter())
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            words = {plain(w)[0] for w in set((text or "").lower().split())} - {""}
            seen[label].update({k for w in words for k in keys(w)})
    terms = sorted(seen[0].keys() | seen[1].keys())
    for at in range(0, len(terms), 50_000):
        part = terms[at : at + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), *(pa.array([c[t] for t in part], pa.int64()) for c in seen)], names=["term", "n0", "n1"]
        )


def learn_lexicon(known: DataFrame) -> dict[str, float]:
    """Term -> log-odds, at most ``LEXICON`` of them, from (text, label) rows."""
    n = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    if len(n) < 2:
        return {}
    terms = known.mapInArrow(_frequencies, "term string, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    odds = F.log((F.col("n1") + 0.5) * (n[0] + 1) / ((F.col("n0") + 0.5) * (n[1] + 1)))
    best = terms.where(F.col("n1") >= min(LEAST_DOCS, max(1, n[1] // 8))).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    return {r.term: r.odds for r in best.orderBy(F.desc("odds"), F.desc("n1"), "term").limit(LEXICON).collect()}


class _Marks(dict):
    """Lower-case word -> 1 lexicon word, 2 lexicon beginning, 4 second person, 8 disguised, summed."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon

    def __missing__(self, word: str) -> int:
        bare, disguised = plain(word)
        known = self.lexicon
        out = (bare in known) | 2 * any(bare[:k] + "~" in known for k in BEGINNINGS if len(bare) > k) | 4 * (bare in SECOND_PERSON) | 8 * disguised
        if len(self) >= _KEPT:
            self.clear()
        self[word] = out
        return out


def _featured(lexicon: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = _Marks(lexicon)
        for chunk in chunks(batches, "text"):
            texts = chunk.column("text")
            data, at = buffer_of(texts)
            kinds = []
            for k in _BYTES:
                total = np.concatenate(([0], np.cumsum(k[data])))
                kinds.append(total[at[1:]] - total[at[:-1]])
            out = np.zeros((chunk.num_rows, len(FEATURES)))
            for i, text in enumerate(texts.to_pylist()):
                if not text:
                    continue
                words = text.lower().split()
                of = np.fromiter(map(marks.__getitem__, words), np.int8, len(words))
                hits, second, hidden = (of & 3) > 0, (of & 4) > 0, (of & 8) > 0
                near = 0
                if hits.any() and second.any():
                    places = np.flatnonzero(second)
                    h = np.flatnonzero(hits)
                    k = np.searchsorted(places, h)
                    after = places[np.minimum(k, len(places) - 1)]
                    before = places[np.maximum(k - 1, 0)]
                    near = int((np.minimum(abs(after - h), abs(before - h)) <= NEAR).sum())
                n, size = max(1, len(words)), max(1, len(text))
                out[i] = (
                    np.log1p(len(words)), (of & 1).sum() / n, np.log1p(hits.sum()), ((of & 2) > 0).sum() / n, near / n, second.sum() / n,
                    kinds[0][i] / size, kinds[1][i] / n, kinds[2][i] / n, kinds[3][i] / size, hidden.sum() / n, np.log1p((hidden & hits).sum()),
                )
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), *(pa.array(out[:, k]) for k in range(len(FEATURES)))], names=["doc_id", *FEATURES])

    return run


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, label: str = "toxic", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, score (0 to 1) and predicted (0 or 1)."""
    bounded_batches(docs.sparkSession)
    plain_docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    picked = settle(sample(labels, label, SAMPLE, learn_from))
    known = settle(plain_docs.join(F.broadcast(picked), "doc_id").select("text", "label"))
    lexicon = learn_lexicon(known)
    made = plain_docs.mapInArrow(_featured(lexicon), "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES))
    features = settle(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(made).select("doc_id", "features"))
    rows = settle(features.join(F.broadcast(picked), "doc_id").withColumn("calibrates", F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(4)) == 0))
    n = {(r.calibrates, r.label): r["count"] for r in rows.groupBy("calibrates", "label").count().collect()}
    total = {k: n.get((False, k), 0) + n.get((True, k), 0) for k in (0, 1)}
    done = features.select("doc_id")
    if not total[0] or not total[1]:
        return done.withColumn("score", F.lit(float(total[1] > 0))).withColumn("predicted", F.col("score").cast("int"))
    calibrated = min(n.get((c, k), 0) for c in (False, True) for k in (0, 1)) >= 5
    trees = GBTClassifier(labelCol="label", weightCol="weight", maxIter=15, maxDepth=3, maxBins=64, stepSize=0.3, seed=7)
    model = trees.fit(rows.where(~F.col("calibrates")) if calibrated else rows)

    def raw(df: DataFrame) -> DataFrame:
        return model.transform(df).withColumn("p", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")

    scored = raw(features)
    if calibrated:
        steps = IsotonicRegression(featuresCol="p", labelCol="label", weightCol="weight").fit(raw(rows.where("calibrates")).withColumn("label", F.col("label").cast("double")))
        # A share of the trees' own probability orders the rows within one step.
        scored = steps.transform(scored).withColumn("p", 0.95 * F.col("prediction") + 0.05 * F.col("p"))
    scored = scored.select("doc_id", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("p"))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, read(spark, sf_dir, "labels"), learn_from=~held_out(F.col("doc_id")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def crc_fold(doc_id: int) -> int:
    """The fold that ``held_out`` tests, in plain Python."""
    return zlib.crc32(str(doc_id).encode()) % 5

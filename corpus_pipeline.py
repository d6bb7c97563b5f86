"""A training corpus from ``documents`` in five stages, each written as Parquet and read again.

1. toxicity: documents that the calibrated trees predict to be toxic go.
2. near-duplicates (five-word shingles, similarity 0.8): the first document of each group stays.
3. substring dedup: passages of 13 words that an earlier document has are cut from the text.
4. mixing: documents are taken 0, 1 or 2 times so that the sources come near their targets.
5. SentencePiece: the texts are encoded; decoding them again is checked.

SQL cannot express the learned first stage nor the encoding, so there is no check SQL; the stages are tested
against plain versions. Rows with a null doc_id pass stages 1 and 2; a text that becomes empty has size 0 and
is not taken by stage 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.op2_repeats import cut_repeats
from tallyhouse.llm.op5_toxicity import held_out, score
from tallyhouse.llm.op6_near_dups import near_duplicates
from tallyhouse.llm.op8_sentencepiece import encode_and_decode
from tallyhouse.llm.op9_mixing import mix_sources
from tallyhouse.llm.tables import read
from tallyhouse.session import fresh_path

ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = score(docs, read(spark, sf_dir, "labels"), learn_from=~held_out(F.col("doc_id")))
    rejected = scored.where("predicted = 1").select("doc_id").distinct()
    return docs.join(rejected, "doc_id", "left_anti").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    dropped = near_duplicates(docs, shingle=5).where("NOT kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = cut_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return cut.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Rows that share a doc_id are taken equally often.
    times = mix_sources(docs).where("taken > 0").groupBy(F.col("doc_id").alias("mixed_id")).agg(F.max((F.col("taken") / F.col("size")).cast("int")).alias("times"))
    met = docs.join(times, docs["doc_id"].eqNullSafe(times["mixed_id"]))
    return met.select(*(docs[c] for c in docs.columns), F.explode(F.sequence(F.lit(1), F.col("times")))).select(docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    both = encode_and_decode(docs)
    return both.withColumn("lossless", F.coalesce("decoded", F.lit("")) == F.coalesce("text", F.lit(""))).drop("decoded")


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mixing", mixing),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

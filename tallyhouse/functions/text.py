"""Text to (document, term, position) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.stemming import stems
from tallyhouse.sources.sinks import create_table_as

# The public English stop-word list of PostgreSQL's text search.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did doing "
    "a an the and but if or because as until while of at by for with about against between into "
    "through during before after above below to from up down in out on off over under again further "
    "then once here there when where why how all any both each few more most other some such no nor "
    "not only own same so than too very s t can will just don should now"
).split()

#: Words that are broadcast with their stems; a few MB.
COMMON = 50_000

WORD_PATTERN = r"[\p{L}\p{N}]+"


def words(text: str | Column) -> Column:
    """Lower-case runs of letters and digits, in text order."""
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(column), F.lit(WORD_PATTERN), F.lit(0))


def term_positions(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    stop_words: list[str] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """One row per kept word of each whole text. Positions count every word from 1,
    stop words included; stop words are then left out. A map-only job: no shuffle."""
    return (
        documents.select(F.col(key), F.posexplode(words(text)).alias("at", "term"))
        .where(~F.col("term").isin(list(stop_words)))
        .select(key, "term", (F.col("at") + 1).alias("position"))
    )


def lexeme_positions(
    documents: DataFrame, key: str = "doc_id", text: str = "text", stop_words: list[str] = ENGLISH_STOP_WORDS
) -> DataFrame:
    """(key, lexeme, positions): the stems of each text with their sorted positions, as a search vector lists them.

    Stems are worked out once for each distinct word of all texts. That list grows with the vocabulary, so only
    its ``COMMON`` most frequent words, which make up most of the texts, are broadcast; positions of other words
    meet their stems by an exchange. Then each position is shuffled once, with the others of its stem and text.
    """
    terms = term_positions(documents, key, text, stop_words)
    counted = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    vocabulary = create_table_as(stems(counted, "term", "lexeme"), "vocabulary")
    common = create_table_as(vocabulary.orderBy(F.desc("n"), "term").limit(COMMON).select("term", "lexeme"), "common-words")
    near = terms.join(F.broadcast(common), "term")
    others = terms.join(F.broadcast(common.select("term")), "term", "left_anti").join(vocabulary.select("term", "lexeme"), "term")
    return (
        near.unionByName(others)
        .groupBy(key, "lexeme")
        .agg(F.array_sort(F.collect_list("position")).alias("positions"))
    )

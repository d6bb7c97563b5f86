"""English stems by suffix rules, as column expressions.

The rules are those of the public Snowball "English" (Porter2) stemmer, which text search commonly uses.
They are applied to a table of distinct words, one projection a step, so that a word is stemmed once however
often it occurs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the public rules: words with a stem of their own, and words that stay as they are.
SPECIAL = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
    "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe",
    "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
KEPT_AFTER_PLURAL = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
# Beginnings after which the first region starts, whatever follows.
REGION_BEGINNINGS = ("gener", "commun", "arsen")
# What each suffix becomes if it stands in the first region.
DERIVED = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize",
    "ational": "ate", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful",
    "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "fulli": "ful",
    "lessli": "less",
}
FURTHER = {"tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
# Suffixes that go if they stand in the second region.
LAST = "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize".split()

REGION = "^(.*?[aeiouy][^aeiouy])"
#: A short syllable at the end: a lone vowel at the start, or one between consonants.
SHORT = "(^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])$"


def suffix_pattern(suffixes) -> str:
    """The longest of the suffixes that ends a word (a match is leftmost, so it is the longest)."""
    return f"({'|'.join(suffixes)})$"


def _ends(word: Column, suffixes) -> Column:
    return F.regexp_extract(word, suffix_pattern(suffixes), 1)


def _cut(word: Column, letters) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - letters)


def _replaced(word: Column, found: Column, by: Mapping[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in by.items() for x in pair])
    return F.concat(_cut(word, F.length(found)), F.element_at(table, found))


def stems(words: DataFrame, word: str = "word", into: str = "stem") -> DataFrame:
    """``words`` with the stem of each lower-case word. Words of one or two letters are their own stem."""
    w, start, second, found = F.col("_w"), F.col("_start"), F.col("_second"), F.col("_found")
    rest = F.substring(w, start + 1, F.length(w))
    in_first = F.length(w) - F.length(found) >= start
    in_second = F.length(w) - F.length(found) >= second
    before = lambda n: F.substring(w, F.length(w) - F.length(found) - (n - 1), F.lit(n))

    def region(text: Column) -> Column:
        reached = F.length(F.regexp_extract(text, REGION, 1))
        return F.when(reached > 0, reached).otherwise(F.length(text))

    # A y that begins the word or follows a vowel is a consonant, written Y.
    consonant_y = F.regexp_replace(F.regexp_replace(F.col(word), "^y", "Y"), "([aeiouy])y", "$1Y")
    beginning = F.length(F.regexp_extract(w, f"^({'|'.join(REGION_BEGINNINGS)})", 1))
    df = words.withColumn("_w", consonant_y)
    df = df.withColumn("_start", F.when(beginning > 0, beginning).otherwise(region(w)))
    df = df.withColumn("_second", start + region(rest))

    # Plurals.
    df = df.withColumn("_found", _ends(w, ("sses", "ied", "ies", "us", "ss", "s")))
    df = df.withColumn(
        "_w",
        F.when(found == "sses", _cut(w, 2))
        .when(found.isin("ied", "ies"), F.when(F.length(w) > 4, _cut(w, 2)).otherwise(_cut(w, 1)))
        .when((found == "s") & w.rlike("[aeiouy].+s$"), _cut(w, 1))
        .otherwise(w),
    )
    df = df.withColumn("_plural", F.lower(w)).withColumn("_kept", F.col("_plural").isin(list(KEPT_AFTER_PLURAL)))

    # Past tense and -ing, and what they leave.
    df = df.withColumn("_found", _ends(w, ("eedly", "eed", "ingly", "edly", "ing", "ed")))
    stripped = F.expr("_found IN ('ingly', 'edly', 'ing', 'ed')") & _cut(w, F.length(found)).rlike("[aeiouy]")
    df = df.withColumn("_stripped", stripped)
    df = df.withColumn(
        "_w",
        F.when(found.isin("eed", "eedly"), F.when(in_first, F.concat(_cut(w, F.length(found)), F.lit("ee"))).otherwise(w))
        .when(F.col("_stripped"), _cut(w, F.length(found)))
        .otherwise(w),
    )
    short_word = (F.length(w) <= start) & w.rlike(SHORT)
    df = df.withColumn(
        "_w",
        F.when(~F.col("_stripped"), w)
        .when(w.rlike("(at|bl|iz)$"), F.concat(w, F.lit("e")))
        .when(w.rlike("(bb|dd|ff|gg|mm|nn|pp|rr|tt)$"), _cut(w, 1))
        .when(short_word, F.concat(w, F.lit("e")))
        .otherwise(w),
    )
    df = df.withColumn("_w", F.regexp_replace(w, "(.[^aeiouy])[yY]$", "$1i"))

    df = df.withColumn("_found", _ends(w, (*DERIVED, "ogi", "li")))
    df = df.withColumn(
        "_w",
        F.when((found == "") | ~in_first, w)
        .when(found == "ogi", F.when(before(1) == "l", _cut(w, 1)).otherwise(w))
        .when(found == "li", F.when(before(1).rlike("[cdeghkmnrt]"), _cut(w, 2)).otherwise(w))
        .otherwise(_replaced(w, found, DERIVED)),
    )
    df = df.withColumn("_found", _ends(w, (*FURTHER, "ative")))
    df = df.withColumn(
        "_w",
        F.when((found == "") | ~in_first, w)
        .when(found == "ative", F.when(in_second, _cut(w, 5)).otherwise(w))
        .otherwise(_replaced(w, found, FURTHER)),
    )
    df = df.withColumn("_found", _ends(w, (*LAST, "ion")))
    df = df.withColumn(
        "_w",
        F.when((found == "") | ~in_second, w)
        .when((found == "ion") & ~before(1).isin("s", "t"), w)
        .otherwise(_cut(w, F.length(found))),
    )
    df = df.withColumn("_found", F.substring(w, -1, 1))
    short_before = _cut(w, 1).rlike(SHORT)
    df = df.withColumn(
        "_w",
        F.when((found == "e") & (in_second | (in_first & ~short_before)), _cut(w, 1))
        .when((found == "l") & in_second & (before(1) == "l"), _cut(w, 1))
        .otherwise(w),
    )
    ruled = F.when(F.col("_kept"), F.col("_plural")).otherwise(F.lower(w))
    special = F.element_at(F.create_map(*[F.lit(x) for pair in SPECIAL.items() for x in pair]), F.col(word))
    stem = F.coalesce(special, F.when(F.length(word) <= 2, F.col(word)).otherwise(ruled))
    return df.select(*words.columns, stem.alias(into))

"""Check SQL for stems: the same public rules as a chain of DuckDB CTEs over distinct words."""

from __future__ import annotations

from tallyhouse.functions.stemming import (
    DERIVED, FURTHER, KEPT_AFTER_PLURAL, LAST, REGION, REGION_BEGINNINGS, SHORT, SPECIAL, suffix_pattern,
)


def _texts(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _choice(column: str, by: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{x}' THEN '{y}'" for x, y in by.items()) + " END"


def _region(text: str) -> str:
    return f"CASE WHEN length(regexp_extract({text}, '{REGION}', 1)) > 0 THEN length(regexp_extract({text}, '{REGION}', 1)) ELSE length({text}) END"


def stem_ctes(words: str) -> str:
    """CTEs that end in stems(word, stem) for the distinct words of the relation ``words`` (word)."""
    begins = f"^({'|'.join(REGION_BEGINNINGS)})"
    steps = [f"""
        SELECT DISTINCT word, regexp_replace(regexp_replace(word, '^y', 'Y'), '([aeiouy])y', '\\1Y', 'g') AS w FROM {words}""", f"""
        SELECT *, CASE WHEN regexp_matches(w, '{begins}') THEN length(regexp_extract(w, '{begins}', 1)) ELSE {_region('w')} END AS r1 FROM s0""", f"""
        SELECT *, r1 + {_region('substr(w, r1 + 1)')} AS r2, regexp_extract(w, '{suffix_pattern(('sses', 'ied', 'ies', 'us', 'ss', 's'))}', 1) AS f FROM s1""", """
        SELECT word, r1, r2, CASE WHEN f = 'sses' THEN w[:-3] WHEN f IN ('ied', 'ies') AND length(w) > 4 THEN w[:-3]
               WHEN f IN ('ied', 'ies') THEN w[:-2] WHEN f = 's' AND regexp_matches(w, '[aeiouy].+s$') THEN w[:-2] ELSE w END AS w FROM s2""", f"""
        SELECT *, lower(w) AS plural, regexp_extract(w, '{suffix_pattern(('eedly', 'eed', 'ingly', 'edly', 'ing', 'ed'))}', 1) AS f FROM s3""", """
        SELECT *, f IN ('ingly', 'edly', 'ing', 'ed') AND regexp_matches(left(w, length(w) - length(f)), '[aeiouy]') AS cut FROM s4""", """
        SELECT word, r1, r2, plural, cut, CASE WHEN f IN ('eed', 'eedly') AND length(w) - length(f) >= r1 THEN left(w, length(w) - length(f)) || 'ee'
               WHEN cut THEN left(w, length(w) - length(f)) ELSE w END AS w FROM s5""", f"""
        SELECT word, r1, r2, plural, CASE WHEN NOT cut THEN w WHEN regexp_matches(w, '(at|bl|iz)$') THEN w || 'e'
               WHEN regexp_matches(w, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$') THEN left(w, length(w) - 1)
               WHEN length(w) <= r1 AND regexp_matches(w, '{SHORT}') THEN w || 'e' ELSE w END AS w FROM s6""", """
        SELECT word, r1, r2, plural, regexp_replace(w, '(.[^aeiouy])[yY]$', '\\1i') AS w FROM s7""", f"""
        SELECT *, regexp_extract(w, '{suffix_pattern((*DERIVED, 'ogi', 'li'))}', 1) AS f FROM s8""", f"""
        SELECT word, r1, r2, plural, CASE WHEN f = '' OR length(w) - length(f) < r1 THEN w
               WHEN f = 'ogi' THEN CASE WHEN regexp_matches(w, 'logi$') THEN left(w, length(w) - 1) ELSE w END
               WHEN f = 'li' THEN CASE WHEN regexp_matches(w, '[cdeghkmnrt]li$') THEN left(w, length(w) - 2) ELSE w END
               ELSE left(w, length(w) - length(f)) || {_choice('f', DERIVED)} END AS w FROM s9""", f"""
        SELECT *, regexp_extract(w, '{suffix_pattern((*FURTHER, 'ative'))}', 1) AS f FROM s10""", f"""
        SELECT word, r1, r2, plural, CASE WHEN f = '' OR length(w) - length(f) < r1 THEN w
               WHEN f = 'ative' THEN CASE WHEN length(w) - 5 >= r2 THEN left(w, length(w) - 5) ELSE w END
               ELSE left(w, length(w) - length(f)) || {_choice('f', FURTHER)} END AS w FROM s11""", f"""
        SELECT *, regexp_extract(w, '{suffix_pattern((*LAST, 'ion'))}', 1) AS f FROM s12""", """
        SELECT word, r1, r2, plural, CASE WHEN f = '' OR length(w) - length(f) < r2 THEN w
               WHEN f = 'ion' AND NOT regexp_matches(w, '[st]ion$') THEN w ELSE left(w, length(w) - length(f)) END AS w FROM s13""", f"""
        SELECT word, plural, CASE WHEN w LIKE '%e' AND (length(w) - 1 >= r2 OR (length(w) - 1 >= r1 AND NOT regexp_matches(left(w, length(w) - 1), '{SHORT}')))
               THEN left(w, length(w) - 1) WHEN w LIKE '%ll' AND length(w) - 1 >= r2 THEN left(w, length(w) - 1) ELSE w END AS w FROM s14"""]
    chain = ",\n".join(f"s{k} AS ({text})" for k, text in enumerate(steps))
    return f"""{chain},
    stems AS (
        SELECT word, CASE WHEN word IN ({_texts(SPECIAL)}) THEN {_choice('word', SPECIAL)} WHEN length(word) <= 2 THEN word
               WHEN plural IN ({_texts(KEPT_AFTER_PLURAL)}) THEN plural ELSE lower(w) END AS stem FROM s{len(steps) - 1})"""

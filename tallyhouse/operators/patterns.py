"""Many ILIKE patterns at once, by the short substrings that texts and patterns share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.session import shared_folder

#: Letters of the longest substring that is looked up.
GRAM = 6
#: Texts of one substring, and texts and rows of one pattern, that a tile pairs.
TILE = 1000
#: Letters that a text is cut into, so that any place in it is near the start of a piece.
PIECE = 64
#: Substrings, of ``GRAM`` letters at most, that are sent to every task; of more of them Spark decides.
SENT = 100_000


def _grams(text: Column, size: int) -> Column:
    """Distinct substrings of that many letters."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))."), F.lit(1)))


def _spread(told: DataFrame, text: str, sizes: list[int]) -> DataFrame:
    """Each row once for each of its substrings of these sizes, with the place of the substring; a copy stands at each place."""
    whole = told.withColumn("_body", F.lower(F.col(text)))
    # Pieces reach into the next one as far as a substring does.
    pieces = F.regexp_extract_all("_body", F.lit(f"(?s)(?=(.{{1,{PIECE + GRAM - 1}}})).{{1,{PIECE}}}"), F.lit(1))
    length, start = F.length("_piece"), F.col("_start")
    cut = [F.when(start + (n - 1) <= length, F.substring(F.col("_piece"), start, F.lit(n))) for n in sizes if n]
    found = (
        whole.select("*", F.posexplode(pieces).alias("_k", "_piece"))
        .select("*", F.explode(F.sequence(F.lit(1), F.least(length, F.lit(PIECE)))).alias("_start"))
        .select(*whole.columns, (F.col("_k") * PIECE + start).alias("_place"), F.explode(F.array(*cut).cast("array<string>")).alias("_gram"))
        .where("_gram IS NOT NULL")
    )
    return found.unionAll(whole.select("*", F.lit(1).alias("_place"), F.lit("").alias("_gram"))) if 0 in sizes else found


def _regex(pattern: Column) -> Column:
    """The regular expression that LIKE makes of a pattern, NULL if it has an escape that LIKE refuses."""
    tokens = F.regexp_extract_all(pattern, F.lit(r"(?s)\\.|."), F.lit(0))
    refused = F.exists(tokens, lambda token: token.startswith("\\") & ~token.isin(r"\%", r"\_", r"\\"))
    literal = lambda token: F.concat(F.lit(r"\Q"), F.substring(token, -1, 1), F.lit(r"\E"))
    said = F.transform(tokens, lambda token: F.when(token == "%", ".*").when(token == "_", ".").otherwise(literal(token)))
    return F.when(~refused, F.concat(F.lit(r"(?s)\A"), F.array_join(said, ""), F.lit(r"\z")))


def match_patterns(texts: DataFrame, text: str, patterns: DataFrame, pattern: str) -> DataFrame:
    """Each row of ``texts`` next to each row of ``patterns`` that it matches, as ``text ILIKE pattern`` says.

    Whatever stands between the wildcards of a pattern must stand in a text, so each pattern is looked up by
    one such part, or by ``GRAM`` letters of a longer one: of all of them the one that occurs least. Texts give
    rows only for substrings that some pattern is looked up by, and the join is one of equal substrings. A text
    must hold the whole part between wildcards that the substring is from, and what ILIKE says has the last word. A
    pattern of wildcards alone is looked up by the empty substring, which every text has. A backslash escapes, as
    in SQL. NULLs match nothing.

    Equal patterns are matched once. The texts of a substring are dealt to tiles of about ``TILE``, and in a tile a
    pattern meets all its texts in turn, so its regular expression is compiled once a tile: LIKE with a column
    of patterns would compile it for every pair. The texts of a pattern then meet its rows in tiles of at most
    about ``TILE`` by ``TILE``, so a pattern that many rows have and many texts match is spread over tasks. Few
    bytes can make many pairs, so the tiles are dealt to a fixed number of tasks, not to as few as their bytes fill.
    """
    spark = texts.sparkSession
    shared_folder(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # What a backslash escapes counts as a gap, so that the rest is surely literal.
    parts = F.filter(F.split(F.col("_pattern"), r"[%_]|\\.?"), lambda part: part != "")
    by_part = F.transform(parts, lambda part: F.when(F.length(part) > GRAM, _grams(part, GRAM)).otherwise(F.array(part)))
    grams = F.when(F.size(parts) > 0, F.array_distinct(F.flatten(by_part))).otherwise(F.array(F.lit("")))
    named = patterns.withColumn("_pattern", F.lower(F.col(pattern))).where("_pattern IS NOT NULL")
    wanted = named.select("_pattern").distinct().select("_pattern", F.explode(grams).alias("_gram")).checkpoint()

    # A small file is one scan task, but its substrings and pairs are work for many.
    told = texts.where(F.col(text).isNotNull()).repartition(tasks).withColumn("_text", F.monotonically_increasing_id()).checkpoint()
    body = F.lower(F.col(text))
    asked = wanted.select("_gram").distinct()
    # At most GRAM + 1 rows.
    sizes = {row["n"]: row["count"] for row in asked.groupBy(F.length("_gram").alias("n")).count().collect()}
    spread = _spread(told, text, sorted(sizes))
    # Else Spark may shuffle every substring of every text before it learns how few are asked for.
    sent = F.broadcast if sum(sizes.values()) <= SENT else lambda df: df
    often = spread.select("_gram").join(sent(asked), "_gram", "left_semi").groupBy("_gram").agg(F.count(F.lit(1)).alias("_often"))
    holding = F.filter(parts, lambda part: F.contains(part, F.col("_gram")))
    # A substring that no text has decides at once: its pattern matches nothing.
    looked_up = (
        wanted.join(often, "_gram", "left")
        .groupBy("_pattern")
        .agg(F.min(F.struct(F.coalesce("_often", F.lit(0)).alias("n"), F.col("_gram").alias("gram"))).alias("_best"))
        .where("_best.n > 0")
        .select("_pattern", F.col("_best.gram").alias("_gram"), F.ceil(F.col("_best.n") / TILE).alias("_tiles"))
        .select("*", F.array_max(F.transform(holding, lambda part: F.struct(F.length(part), part.alias("part")))).alias("_long"))
        .select("_pattern", "_gram", "_tiles", F.coalesce("_long.part", F.lit("")).alias("_part"), _regex(F.col("_pattern")).alias("_regex"))
        .checkpoint()
    )
    near = (
        spread.join(sent(looked_up.select("_gram", "_tiles").distinct()), "_gram")
        .where("instr(_body, _gram) = _place")
        .select(*told.columns, "_gram", F.pmod(F.xxhash64("_text"), F.col("_tiles")).alias("_tile"))
        .repartition(tasks, "_gram", "_tile")
    )
    tiled = looked_up.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_tiles") - 1)).alias("_tile")).drop("_tiles")
    # The patterns stand on the left, so that one after the other meets the texts of a tile.
    like = F.coalesce(F.regexp_instr(body, F.col("_regex")) > 0, F.expr(f"lower(`{text}`) LIKE _pattern"))
    matched = (
        tiled.repartition(tasks, "_gram", "_tile")
        .join(near.hint("merge"), ["_gram", "_tile"])
        .where(F.contains(body, F.col("_part")) & like)
        .select(*texts.columns, "_pattern", "_text")
        .checkpoint()
    )
    rows = named.withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    return _tiled(matched, rows, tasks).select(*texts.columns, *patterns.columns)


def _tiled(matched: DataFrame, rows: DataFrame, tasks: int) -> DataFrame:
    """``matched`` joined with ``rows`` by _pattern, a tile at a time; both are checkpoints, so ids stay."""

    def side(df: DataFrame, own: str, id_: str, other: str) -> DataFrame:
        place = F.pmod(F.xxhash64(id_), F.col(f"{own}_n")).alias(own)
        copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}_n") - 1)).alias(other)
        # The rows of one pattern are copied by as many tasks as their bytes fill.
        dealt = df.join(tiles, "_pattern").repartition(id_)
        return dealt.select(*df.columns, place, copies).repartition(tasks, "_pattern", "_across", "_down")

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("_pattern").agg(F.ceil(F.count(F.lit(1)) / TILE).alias(name))

    tiles = counted(matched, "_across_n").join(counted(rows, "_down_n"), "_pattern")
    across = side(matched, "_across", "_text", "_down")
    down = side(rows, "_down", "_row", "_across")
    return across.join(down.hint("merge"), ["_pattern", "_across", "_down"])

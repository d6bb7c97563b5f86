"""How five document filters interact: what each removes in every order, with exact repeats found table-wide.

Four filters look at one text alone. The fifth, "same text as a smaller doc_id", needs the whole table, and
texts are wide, so a counting Bloom sketch goes first:

1. One scan turns each document into a narrow row: id, part, text hash and the bits of the filters it fails.
2. Each text counts up three counters of one 64-counter word. Map tasks add up their own counters and the
   exchange merges them. A text one of whose counters stands at 1 occurs once and is cleared. What is kept of
   a word is one bit a counter ("2 or more"), 16 bytes, and at most ``max_words`` words.
3. Only texts that were not cleared are shuffled, grouped by the whole text with its smallest id. Map tasks
   combine first, so a text with a third of all rows travels once a task.
4. A document that is not cleared and isn't the smallest of its text fails the fifth filter. The join runs on
   (hash, id), which no group of copies can skew. Hashes that two different texts share are joined again by
   whole text.
5. Documents become counts per part and failure mask, at most 32 a part. All figures are sums over masks.

Beyond ``16 * max_words`` documents the sketch clears fewer texts and more of them are shuffled; results stay
the same.

Defined results: null texts are empty texts (equal to each other); a null doc_id is never smaller or larger
than another, so it never fails the fifth filter; rows that repeat a doc_id are documents of their own, and
equal texts of one doc_id don't make each other fail; a document with several label rows is good or toxic if
one of them says so; a null source is the part ''. Other columns are not read. No rows: no parts, no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.tables import read, settle

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
ALL = (1 << len(FILTERS)) - 1
REPEAT = 1 << FILTERS.index("E")
#: Words of the sketch: 4,194,304 of 16 bytes are 64 MB where they are broadcast.
MAX_WORDS = 1 << 22
#: Documents for each word: about one text in a hundred is not cleared though it occurs once.
PER_WORD = 4
SPACE = r"[\x20\x09-\x0D]+"


def _failed(text: Column) -> Column:
    """Bits 0 to 3: the filters A to D that a text fails."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n, capitals = F.size(words), F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    tests = (
        n < 200,
        100 * F.size(F.array_distinct(words)) < 50 * n,
        100 * capitals.cast("long") > 2 * F.length(text),
        text.rlike(r"[#$%&*|]"),
    )
    return sum((test.cast("int") * (1 << i) for i, test in enumerate(tests)), F.lit(0))


def _cells(mark: str, words: int) -> tuple[Column, list[Column]]:
    """Word of a text hash and its three counters there, one in each third of the word."""
    spread = F.xxhash64(F.col(mark), F.lit(11))
    lanes = ((0, 21), (21, 21), (42, 22))
    return F.pmod(F.col(mark), F.lit(words)), [
        (F.pmod(F.shiftrightunsigned(spread, 20 * i), F.lit(size)) + first).cast("int") for i, (first, size) in enumerate(lanes)
    ]


def _bits(counters: list[Column]) -> Column:
    out = F.lit(0).cast("long")
    for counter in counters:
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), counter))
    return out


def _sketch(narrow: DataFrame, words: int) -> DataFrame:
    """(word, twice): the counters that reached 2, as bits; words without one are left out."""
    word, counters = _cells("mark", words)
    counted = (
        narrow.select(word.alias("word"), F.explode(F.array(*counters)).alias("counter"))
        .groupBy("word", "counter")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.where("n > 1").groupBy("word").agg(F.bit_or(_bits([F.col("counter")])).alias("twice"))


def _probed(rows: DataFrame, sketch: DataFrame, words: int) -> DataFrame:
    """``rows`` with ``suspect``: all counters of the text stand at 2 or more."""
    word, counters = _cells("mark", words)
    asked = _bits(counters)
    met = rows.withColumn("word", word).join(F.broadcast(sketch), "word", "left")
    return met.select(*rows.columns, F.coalesce(F.col("twice").bitwiseAND(asked) == asked, F.lit(False)).alias("suspect"))


def failure_masks(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    max_words: int = MAX_WORDS,
    mark: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """(id, part, mask) of every row of ``docs``; bit i of mask is set if the row fails filter i of ABCDE."""
    plain = docs.select(
        F.col(doc_id).cast("long").alias("id"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("mark", mark(F.col("text")).cast("long"))
    narrow = settle(plain.select("id", "part", "mark", _failed(F.col("text")).alias("mask")))
    words = 1
    while words < min(max_words, narrow.count() // PER_WORD):
        words *= 2
    sketch = settle(_sketch(narrow, words))

    suspects = _probed(plain.select("id", "text", "mark"), sketch, words).where("suspect")
    firsts = suspects.groupBy("mark", "text").agg(F.min("id").alias("first"))
    by_mark = settle(firsts.groupBy("mark").agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("texts")))

    smallest = by_mark.select("mark", F.col("first").alias("id"), F.lit(True).alias("smallest"))
    judged = _probed(narrow, sketch, words).join(smallest, ["mark", "id"], "left")
    fails = F.col("suspect") & F.col("id").isNotNull() & F.col("smallest").isNull()
    masks = judged.select("mark", "id", "part", F.when(fails, F.col("mask") + REPEAT).otherwise(F.col("mask")).alias("mask"))
    shared = by_mark.where("texts > 1").select("mark")
    if not shared.isEmpty():
        again = plain.join(shared, "mark", "left_semi")
        ranked = again.join(again.groupBy("mark", "text").agg(F.min("id").alias("first")), ["mark", "text"])
        repeat = F.when(F.col("id") > F.col("first"), REPEAT).otherwise(0)
        exact = ranked.select("mark", "id", "part", (_failed(F.col("text")) + repeat).alias("mask"))
        masks = masks.join(shared, "mark", "left_anti").unionByName(exact)
    return masks.drop("mark")


def audit(masks: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per part, order of the five filters and step, from (id, part, mask) and the label rows."""
    said = lambda name: F.coalesce(F.max(F.when(F.col(name) == 1, 1)), F.lit(0)).alias(name)
    known = (
        labels.where(F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).cast("long").alias("id"))
        .agg(said("quality"), said("toxic"))
    )
    counts = (
        masks.join(known, "id", "left")
        .groupBy("part", "mask")
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("quality"), F.lit(0)).alias("quality"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
        .groupBy("part")
        .agg(F.collect_list(F.struct("mask", "n", "quality", "toxic")).alias("counts"))
    )

    def passing(name: str) -> Column:
        """Entry s: documents that fail none of the filters in the set s."""
        return F.transform(
            F.sequence(F.lit(0), F.lit(ALL)),
            lambda s: F.aggregate(
                F.filter("counts", lambda c: c["mask"].bitwiseAND(s) == 0), F.lit(0).cast("long"), lambda total, c: total + c[name]
            ),
        )

    sums = counts.select("part", *(passing(name).alias(name) for name in ("n", "quality", "toxic")))
    at = lambda name, place: F.element_at(name, place + 1)

    def shapley(bit: int) -> Column:
        """Removals of one filter over all orders: those that put the set s before it, for every s."""
        free = [s for s in range(ALL + 1) if not s & bit]
        orders = lambda s: factorial(s.bit_count()) * factorial(len(FILTERS) - 1 - s.bit_count())
        return sum(((at("n", F.lit(s)) - at("n", F.lit(s | bit))) * orders(s) for s in free), F.lit(0).cast("long"))

    sums = sums.withColumn("shares", F.array(*(shapley(1 << i) for i in range(len(FILTERS)))))
    bit_of = lambda letter: F.call_function("shiftleft", F.lit(1), F.ascii(letter) - ord("A"))
    steps = (
        sums.withColumn("filter_order", F.explode(F.array(*map(F.lit, ORDERS))))
        .select("*", F.posexplode(F.split("filter_order", "")).alias("place", "letter"))
        .withColumn("bit", bit_of(F.col("letter")))
        .withColumn("before", F.aggregate(F.slice(F.split("filter_order", ""), F.lit(1), F.col("place")), F.lit(0), lambda s, x: s.bitwiseOR(bit_of(x))))
        .withColumn("after", F.col("before").bitwiseOR(F.col("bit")))
    )
    lost = lambda name: at(name, F.col("before")) - at(name, F.col("after"))
    return steps.select(
        "part",
        "filter_order",
        (F.col("place") + 1).alias("step"),
        at("n", F.col("after")).alias("kept"),
        lost("n").alias("removed"),
        (at("n", F.lit(0)) - at("n", F.col("bit")) - lost("n")).alias("redundant"),
        (at("n", F.lit(ALL) - F.col("bit")) - at("n", F.lit(ALL))).alias("unique_fails"),
        lost("quality").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.element_at("shares", F.ascii("letter") - ord("A") + 1).alias("shapley"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all documents, by source."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return audit(failure_masks(docs), labels)


def oracle() -> str:
    """DuckDB SQL for the same rows: every document is walked through every order."""
    return r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), f AS (
  SELECT d.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
         len(words) < 200 AS a,
         100 * len(list_distinct(words)) < 50 * len(words) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false) AS e
  FROM d LEFT JOIN l ON l.doc_id = d.doc_id
), m AS (
  SELECT part, a, b, c, d, e, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL
), x AS (
  SELECT * FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(k)
), o AS (
  SELECT p.k || q.k || r.k || s.k || t.k AS filter_order
  FROM x p JOIN x q ON q.k <> p.k JOIN x r ON r.k NOT IN (p.k, q.k) JOIN x s ON s.k NOT IN (p.k, q.k, r.k) JOIN x t ON t.k NOT IN (p.k, q.k, r.k, s.k)
), fails AS (
  SELECT m.*, x.k, CASE x.k WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS failed,
         a::INT + b::INT + c::INT + d::INT + e::INT AS how_many
  FROM m CROSS JOIN x
), steps AS (
  SELECT fails.part, o.filter_order, CAST(instr(o.filter_order, fails.k) AS INTEGER) AS step, fails.k, n, good, toxic, failed, how_many,
         (a AND instr(o.filter_order, 'A') < instr(o.filter_order, fails.k)) OR (b AND instr(o.filter_order, 'B') < instr(o.filter_order, fails.k))
         OR (c AND instr(o.filter_order, 'C') < instr(o.filter_order, fails.k)) OR (d AND instr(o.filter_order, 'D') < instr(o.filter_order, fails.k))
         OR (e AND instr(o.filter_order, 'E') < instr(o.filter_order, fails.k)) AS gone
  FROM fails CROSS JOIN o
), sums AS (
  SELECT part, filter_order, step, k,
         coalesce(sum(n) FILTER (NOT gone AND NOT failed), 0) AS kept,
         coalesce(sum(n) FILTER (failed AND NOT gone), 0) AS removed,
         coalesce(sum(n) FILTER (failed AND gone), 0) AS redundant,
         coalesce(sum(n) FILTER (failed AND how_many = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (failed AND NOT gone), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (failed AND NOT gone), 0) AS toxic_lost
  FROM steps GROUP BY ALL
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, k))::BIGINT AS shapley
FROM sums
"""

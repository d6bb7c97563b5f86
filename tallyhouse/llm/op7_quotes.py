"""Chat formatting by quotation linking, in DataFrame functions only.

Lines that begin with one or more ">" are quotes; the number of signs is their level. Consecutive quoted
lines of one level are a passage. Passages and single quoted lines are normalised (lower case, one space for
white space) and hashed; so are the own paragraphs, own lines and the own text of every message. A quote
links to the first message of its conversation, of an earlier turn, that says it itself. A message replies
to what its lowest-level linked quote quotes, the latest such message if several. Replies form threads;
root and depth come from doubling steps, so their number is the logarithm of the longest chain.

The result has a row per message, in reply order: conversation, thread by its root's turn, turn. ``text`` is
the own text without quotes and the "... wrote:" line before one; ``chat`` puts the role before it. Nothing
gathers a conversation into one row or task: what is said first is a minimum per hash, taken in the map tasks
before the exchange.

Defined results: null text is empty. Without conversation or turn a message links with nothing. Messages
that share a turn are told apart by role and text; equal rows get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.tables import OWN, read, settle

MARK = r"^((?:[ \t]{0,3}>)+)[ \t]?"
WROTE = r"(?i)^.{0,200}\b(wrote|writes|schrieb|a écrit|escribió)\s*:\s*$"
_KEY = ["conv_id", "turn", "mid"]


def _normal(c: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARK, 1), "[^>]", ""))


def parsed(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, mid, lines (level, said) and own: the text without quotes."""
    base = messages.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("whole")
    ).withColumn("mid", F.xxhash64("role", "whole"))
    split = F.split(F.regexp_replace("whole", "\r\n?", "\n"), "\n", -1)
    lines = F.transform(split, lambda x: F.struct(_level(x).alias("level"), F.regexp_replace(x, MARK, "").alias("said")))
    with_lines = base.withColumn("lines", lines).withColumn("quotes", F.exists("lines", lambda x: x.level > 0))
    plain = lambda x, i: (x.level == 0) & ~(
        x.said.rlike(WROTE) & F.coalesce(F.try_element_at("lines", (i + 2).cast("int")).level > 0, F.lit(False))
    )
    own = F.array_join(F.transform(F.filter("lines", plain), lambda x: x.said), "\n")
    return with_lines.withColumn("own", F.when(F.col("quotes"), F.trim(F.regexp_replace(own, r"\n{3,}", "\n\n"))).otherwise(F.col("whole")))


def _said(rows: DataFrame) -> DataFrame:
    """First message of each conversation that says a unit: conv_id, unit, first (turn, mid)."""
    units = F.concat(F.array("own"), F.split("own", r"\n[ \t]*\n"), F.split("own", "\n"))
    hashes = F.array_distinct(F.transform(F.filter(F.transform(units, _normal), lambda u: u != ""), lambda u: F.sha2(u, 256)))
    return rows.select("conv_id", "turn", "mid", F.explode(hashes).alias("unit")).groupBy("conv_id", "unit").agg(F.min(F.struct("turn", "mid")).alias("first"))


def _quoted(rows: DataFrame) -> DataFrame:
    """Quoted passages and lines of every message: key, level, unit."""
    lines = rows.where("quotes").select(*_KEY, F.posexplode("lines").alias("at", "line"))
    quoted = lines.select(*_KEY, "at", "line.level", "line.said").where("level > 0")
    blank = F.trim("said") == ""
    single = quoted.where(~blank).select(*_KEY, "level", F.sha2(_normal(F.col("said")), 256).alias("unit"))
    within = Window.partitionBy(*_KEY, "level").orderBy("at")  # the lines of one message
    full = quoted.where(~blank).withColumn("run", F.col("at") - F.row_number().over(within))
    passage = full.groupBy(*_KEY, "level", "run").agg(
        F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("at", "said"))), lambda x: x.said), " ").alias("said")
    )
    return single.union(passage.select(*_KEY, "level", F.sha2(_normal(F.col("said")), 256).alias("unit"))).distinct()


def links(rows: DataFrame) -> DataFrame:
    """Quotes that an earlier message says: key, level, unit, first (turn, mid)."""
    quotes = settle(_quoted(rows))
    # Only conversations and units that are quoted meet; every (conv_id, unit) is one row on the said side.
    said = _said(rows.join(quotes.select("conv_id").distinct(), "conv_id", "left_semi"))
    return quotes.join(said, ["conv_id", "unit"]).where(F.col("first.turn") < F.col("turn"))


def _threads(parents: DataFrame) -> DataFrame:
    """Key, root (turn, mid) and depth of every message that replies to one."""
    up = settle(parents.select(*_KEY, F.col("parent").alias("root"), F.lit(1).alias("depth")))
    while True:
        higher = up.select("conv_id", F.struct("turn", "mid").alias("root"), F.col("root").alias("top"), F.col("depth").alias("more"))
        met = up.join(higher, ["conv_id", "root"], "left")
        step = settle(met.select(*_KEY, F.coalesce("top", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("top").isNotNull().alias("moved")))
        up = step.drop("moved")
        if step.where("moved").isEmpty():
            return up


def linked_conversations(messages: DataFrame, **names: str) -> DataFrame:
    """One row per message: conv_id, turn, role, text, reply_to, thread, depth, n_quoted, n_linked, chat."""
    rows = parsed(messages, **names)
    found = settle(links(rows))
    linked = found.groupBy(*_KEY).agg(
        F.countDistinct("unit").alias("n_linked"),
        F.max(F.struct(-F.col("level"), F.col("first"))).getField("first").alias("parent"),
    )
    linked = settle(linked)
    roots = _threads(linked.select(*_KEY, "parent"))
    n_quoted = F.size(F.filter("lines", lambda x: x.level > 0)).cast("long")
    slim = rows.select("conv_id", "turn", "role", "mid", F.col("own").alias("text"), n_quoted.alias("n_quoted"))
    full = slim.join(linked, _KEY, "left").join(roots, _KEY, "left")
    thread = F.coalesce("root", F.struct("turn", "mid"))
    ordered = full.withColumn(f"{OWN}thread", thread).orderBy("conv_id", f"{OWN}thread", "turn", "mid")
    return ordered.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.col("parent.turn").alias("reply_to"),
        F.col(f"{OWN}thread").getField("turn").alias("thread"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        "n_quoted",
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.col("text")).alias("chat"),
    )


def op7_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message of ``conversations`` with its reply link, thread and own text, in reply order."""
    return linked_conversations(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))

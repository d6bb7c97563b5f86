import re

from tallyhouse.llm.op7_quotes import linked_conversations, op7_quote_linking

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Links and threads by a plain walk over each conversation."""

    def norm(s):
        return re.sub(r"\s+", " ", s).strip(" ").lower()

    info = []
    for conv, turn, role, text in rows:
        lines = [(m[1].count(">"), line[m.end() :]) if (m := re.match(r"((?:[ \t]{0,3}>)+)[ \t]?", line)) else (0, line) for line in (text or "").split("\n")]
        own = [s for i, (lv, s) in enumerate(lines) if lv == 0 and not (re.search(r"wrote\s*:\s*$", s) and i + 1 < len(lines) and lines[i + 1][0] > 0)]
        own_text = re.sub(r"\n{3,}", "\n\n", "\n".join(own)).strip(" ") if any(lv for lv, _ in lines) else text or ""
        units = {norm(u) for u in [own_text, *re.split(r"\n[ \t]*\n", own_text), *own_text.split("\n")]} - {""}
        quotes, run = set(), None
        for i, (lv, s) in enumerate([*lines, (0, "")]):
            if lv and s.strip(" "):
                quotes.add((lv, norm(s)))
                if run and run[0] == lv and run[2] == i - 1:
                    run = (lv, run[1] + " " + s, i)
                else:
                    if run:
                        quotes.add((run[0], norm(run[1])))
                    run = (lv, s, i)
        if run:
            quotes.add((run[0], norm(run[1])))
        info.append((conv, turn, role, own_text, units, quotes))
    out, parent = {}, {}
    for conv, turn, _, own, _, quotes in info:
        best = []
        for lv, q in quotes:
            first = [t for c, t, _, _, u, _ in info if c == conv and q in u and t < turn]
            if first:
                best.append((-lv, min(first)))
        parent[conv, turn] = max(best)[1] if best else None
        out[conv, turn] = own
    res = []
    for conv, turn in out:
        root, depth = turn, 0
        while parent[conv, root] is not None:
            root, depth = parent[conv, root], depth + 1
        res.append((conv, turn, out[conv, turn], parent[conv, turn], root, depth))
    return sorted(res, key=lambda r: (r[0], r[4], r[1]))


ROWS = [
    (1, 0, "user", "How do I sort a list?\nIt is long."),
    (1, 1, "assistant", "On Monday user wrote:\n> How do I sort a list?\n> It is LONG.\n\nUse sorted().\n\nIt returns a new list."),
    (1, 2, "user", "> It returns  a new list.\nAnd in place?"),
    (1, 3, "user", "Another thing entirely."),
    (1, 4, "assistant", ">> It returns a new list.\n> And in place?\n\nUse list.sort()."),
    (1, 5, "user", ">Another thing entirely.\nSay more\n> nobody said this"),
    (1, 6, "assistant", "> > And in place?\n>  Say more\nMore."),
    (2, 0, "user", "And in place?"),
    (2, 1, "user", "> More.\nnot of this conversation"),
]


def test_equals_a_plain_walk(spark):
    got = linked_conversations(spark.createDataFrame(ROWS, SCHEMA).repartition(3)).collect()
    assert [(r.conv_id, r.turn, r.text, r.reply_to, r.thread, r.depth) for r in got] == brute(ROWS)
    assert {r.turn: r.reply_to for r in got if r.conv_id == 1} == {0: None, 1: 0, 2: 1, 3: None, 4: 2, 5: 3, 6: 5}
    assert all(">" not in r.text for r in got)
    assert got[0].chat == "<|user|>\nHow do I sort a list?\nIt is long."


def test_a_long_chain(spark):
    rows = [(7, i, "user", (f"> line {i - 1}\n" if i else "") + f"line {i}") for i in range(40)]
    got = linked_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.turn, r.thread, r.depth) for r in got] == [(i, 0, i) for i in range(40)]


def test_nulls_repeats_and_no_rows(spark):
    rows = [(1, 0, None, None), (None, 1, "user", "> a"), (1, None, "user", "> a"), (1, 1, "user", "a"), (1, 1, "user", "a"), (1, 2, "user", "> a\nb"), (1, 2, "user", "> a\nb")]
    got = linked_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 7
    assert sorted((r.turn or 0, r.reply_to or 0) for r in got if r.reply_to) == [(2, 1), (2, 1)]
    assert linked_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_keeps_every_message_and_uses_no_python(spark):
    out = op7_quote_linking(spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert out.count() == spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").count()

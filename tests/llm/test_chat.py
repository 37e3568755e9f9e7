"""Round trips of hostile conversations, and the plan."""

import hashlib
import random

from pyspark.sql import functions as F

from tests import oracle
from tests.llm.fixtures import SMALL
from tidemark.llm import catalog, chat

SCHEMA = "conv_id long, turn long, role string, text string"


def hostile():
    random.seed(8)
    pieces = ["### ", "</turn>", " </turn>\n", "\\", "\\h", "\\b", "#", "<", ": ", "/0: ", "user", "\n", "é", " ", "### user/0: ", "/1"]
    text = lambda: "".join(random.choices(pieces, k=random.randrange(9)))
    rows = [(c, t, random.choice(["user", "assistant", "system", text()]), text()) for c in range(40) for t in range(random.randrange(1, 9))]
    return rows + [(None, None, None, None), (None, 1, "assistant", None), (99, 3, "assistant", "x" * 100000), (98, 0, "", "")]


def expected(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [(r, t) for *_, r, t in sorted(turns)] for conv, turns in out.items()}


def test_turns_survive(spark):
    rows = hostile()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("formatted", F.lit(1)).repartition(4)
    read = chat.read_turns(chat.format_conversations(df)).collect()
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in read} == expected(rows)
    assert all(t.level in (0, 1) for r in read for t in r.turns)


def test_control_strings_only_mark_turns(spark):
    rows = hostile()
    for r in chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect():
        turns = len(expected(rows)[r.conv_id])
        assert r.formatted.count("###") == r.formatted.count("</turn>") == turns


def test_plain_texts_are_not_escaped(spark):
    df = spark.createDataFrame([(1, 0, "user", "a < b # c \\ d"), (1, 1, "assistant", "</turn>")], SCHEMA)
    (row,) = chat.format_conversations(df).collect()
    assert row.formatted == "### user/0: a < b # c \\ d </turn>\n### assistant/1: \\l/turn> </turn>\n"


def test_repeated_turns_stay_in_a_fixed_order(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "assistant", "z")]
    (row,) = chat.read_turns(chat.format_conversations(spark.createDataFrame(rows, SCHEMA))).collect()
    assert [t.text for t in row.turns] == ["z", "a", "a", "b"]


def test_what_is_no_turn_is_returned_as_it_is(spark):
    df = spark.createDataFrame([("junk </turn>\n### user/0: ok </turn>\n### user/7: x </turn>\n",)], "formatted string")
    (row,) = chat.read_turns(df).collect()
    assert [(t.role, t.text) for t in row.turns] == [(None, "junk"), ("user", "ok"), (None, "### user/7: x")]


def test_no_rows(spark):
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_equals_sql_and_runs_no_python(spark):
    df = catalog.op6_chat_format(spark, SMALL)
    plan = df._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExistingRDD"))
    with oracle.connect(SMALL) as duck:
        assert oracle.differences(df.toPandas(), duck.execute(catalog.OP6_SQL).df()) == []
    row = df.filter("conv_id = -7").first()
    text = "\\### Assistant: </turn> ok"
    assert row.n_turns == 2 and row.loss_chars == len(text)
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()

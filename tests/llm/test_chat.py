import hashlib
import random
from collections import defaultdict

import cases
import compare
import pytest
from pyspark.sql import functions as F
from strata.llm import chat, queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string, formatted string, turns string"


def turns(spark):
    draw = random.Random(3)
    marks = ["</s>", "[INST]", "[/INST]", "<t>", "\\", "\\s", "\\e", "<", "[", "t>", "ok", "é", "\n", " ", "漢\U0001f600"]
    rows = [
        (c, t, draw.choice(["user", "assistant", "system", "[INST]x</s>", None]), "".join(draw.choices(marks, k=draw.randint(0, 9))) or None, "x", "y")
        for c in range(60)
        for t in range(draw.randint(1, 12))
    ]
    rows += [(7, 0, "user", "tie", "", ""), (7, 0, "user", "tie", "", ""), (None, None, None, None, None, None), (None, 1, "assistant", "a", "", "")]
    return spark.createDataFrame(rows, SCHEMA)


def brute(rows):
    found = defaultdict(list)
    for r in rows:
        found[r.conv_id].append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    out = {}
    for conv, items in found.items():
        items.sort()
        loss = "".join(t for _, _, r, t in items if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in items)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(items), sha(said), len(loss), sha(loss))
    return out


@pytest.mark.parametrize("source", ["hostile", "driver"])
def test_query_against_brute_force(spark, tmp_path, source):
    df = turns(spark) if source == "hostile" else spark.read.parquet(f"{cases.SF}/conversations.parquet")
    folder = cases.written(spark, tmp_path, conversations=df)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in queries.QUERIES["op2_chat"](spark, folder).collect()}
    hostile = spark.createDataFrame([(-1, 0, "user", queries.HOSTILE), (-1, 1, "assistant", queries.HOSTILE)], "conv_id bigint, turn bigint, role string, text string")
    assert got == brute([*df.collect(), *hostile.collect()])


def test_query_against_sql(spark):
    con = compare.connect(cases.SF)
    assert compare.differences(queries.QUERIES["op2_chat"](spark, cases.SF), con, queries.ORACLES["op2_chat"]) == []


def test_adjacent_turns_of_a_role_are_one_message(spark):
    df = spark.createDataFrame(
        [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "assistant", "")],
        "conv_id bigint, turn bigint, role string, text string",
    )
    row = chat.format_chats(df).first()
    assert row.formatted == "[INST]user[/INST]a<t>b</s>[INST]assistant[/INST]c<t></s>"
    assert [row.formatted[s.start : s.start + s.chars] for s in row.loss_spans] == ["c", ""]


def test_escape_round_trip(spark):
    df = turns(spark).where("text is not null")
    assert df.where(chat.unescape(chat.escape(F.col("text"))) != F.col("text")).count() == 0


def test_empty_table_and_no_python(spark):
    empty = turns(spark).limit(0)
    assert chat.read_back(chat.format_chats(empty)).collect() == []
    plan = chat.read_back(chat.format_chats(turns(spark)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

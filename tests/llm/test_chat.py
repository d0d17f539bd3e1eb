"""Chat formatting: the turns come back from the text, whatever they hold."""

import pytest
from pyspark.sql import functions as F

from salesflow.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, segments string, Turns int"


def rows(spark, data):
    return spark.createDataFrame([(*r, "clash", 1) for r in data], SCHEMA)


def back(df):
    made = chat.format_conversations(df).withColumn("turns", chat.turns_back(F.col("formatted")))
    return {r["conv_id"]: r for r in made.withColumn("loss", chat.loss_text(F.col("segments"))).collect()}


def test_round_trip_of_control_strings(spark):
    nasty = ["\\", "\\\\", "###", "### ", "</turn>", "</turn>\n", "a</turn>\n### assistant: b\n",
             "<\\/turn>", "\\### Assistant: </turn> ok", "", "\n", ": ", "é" * 5, "x" * 200_000]
    data = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(nasty)]
    data += [(2, 0, "odd: role </turn>\n### ", "t"), (2, 1, "\\: ", "u")]
    got = back(rows(spark, data))
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [(r, t) for c, _, r, t in data if c == 1]
    assert got[1]["loss"] == "".join(nasty[1::2])
    assert [(t["role"], t["text"]) for t in got[2]["turns"]] == [("odd: role </turn>\n### ", "t"), ("\\: ", "u")]


def test_nulls_ties_repeats(spark):
    data = [(None, 1, "user", "q"), (None, 2, "assistant", None), (3, None, None, "a"), (3, 0, "user", "b"),
            (3, 0, "user", "a"), (3, 0, "user", "a")]
    got = back(rows(spark, data))
    assert [tuple(t) for t in got[None]["turns"]] == [("user", "q"), ("assistant", "")]
    assert [tuple(t) for t in got[3]["turns"]] == [("", "a"), ("user", "a"), ("user", "a"), ("user", "b")]
    assert got[None]["valid"] and not got[3]["valid"] and got[3]["first_bad_turn"] == 0


def test_machine(spark):
    orders = {1: ["system", "user", "assistant"], 2: ["user", "user"], 3: ["user"], 4: ["assistant"],
              5: ["user", "assistant", "system", "user", "assistant"]}
    got = back(rows(spark, [(c, i, r, "x") for c, rs in orders.items() for i, r in enumerate(rs)]))
    assert {c: (r["valid"], r["first_bad_turn"]) for c, r in got.items()} == {
        1: (True, None), 2: (False, 1), 3: (False, None), 4: (False, 0), 5: (False, 2)}


def test_empty_table(spark):
    assert back(rows(spark, [])) == {}


def test_templates_that_cannot_be_read_back():
    for bad in ({"open": "#"}, {"close": "aba"}, {"mid": "a\\b"}, {"open": "<x>", "close": "y<x>z"}):
        with pytest.raises(ValueError):
            chat.Template(**bad)

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cinerank.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, turns string, plain string"
PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "<\\s>", "</\\\\s>", "[\\INST]", "<", "/", "\\", "s>", "INST]", "[", "é😀", "\n", " ok ", "$1"]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a[/INST]b", "</s>"]),
                          st.lists(st.sampled_from(PIECES), max_size=8).map("".join)), min_size=1, max_size=12))
def test_round_trip(spark, turns):
    out = chat.format_conversations(table(spark, [(1, i, r, t) for i, (r, t) in enumerate(turns)]))
    (row,) = out.withColumn("loss", chat.masked_text(F.col("formatted"), F.col("loss_spans"))).collect()
    assert row.identical and [(t.role, t.text) for t in row.parsed] == turns
    assert row.loss == "".join(t for r, t in turns if r == "assistant")
    assert row.formatted.count("</s>") == len(turns)


def test_only_conflicting_conversations_are_escaped(spark):
    rows = [(1, 0, "user", "plain"), (2, 0, "user", "</s>[INST] ok [/INST]"), (2, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in chat.format_conversations(table(spark, rows)).collect()}
    assert not got[1].escaped and got[1].formatted == "<s>[INST]user[/INST]plain</s>"
    assert got[2].escaped and got[2].identical


def test_lone_control_strings_are_escaped(spark):
    texts = {1: "a [INST] b [/INST] c", 2: "a [INST] b", 3: "a [/INST] b", 4: "a <s> b", 5: "a < s> [ INST] b"}
    rows = [(i, 0, "user", t) for i, t in texts.items()] + [(6, 0, "a<s>", "x"), (6, 1, "assistant", "[INST]y")]
    out = chat.format_conversations(table(spark, rows)).withColumn("loss", chat.masked_text(F.col("formatted"), F.col("loss_spans")))
    got = {r.conv_id: r for r in out.collect()}
    assert all(r.identical for r in got.values())
    assert {i: r.escaped for i, r in got.items()} == {1: True, 2: True, 3: True, 4: True, 5: False, 6: True}
    assert got[1].formatted == "<s>[INST]user[/INST]a [\\INST] b [/\\INST] c</s>"
    assert got[5].formatted == "<s>[INST]user[/INST]a < s> [ INST] b</s>"
    assert got[6].formatted == "<s>[INST]a<\\s>[/INST]x</s>[INST]assistant[/INST][\\INST]y</s>" and got[6].loss == "[INST]y"
    for r in got.values():
        assert r.formatted.count("<s>") == 1 and r.formatted.count("[INST]") == r.formatted.count("[/INST]") == len(r.parsed)


def test_edge_rows(spark):
    long = "</s>x" * 40_000
    rows = [(1, 1, "assistant", "b"), (1, 0, None, None), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (None, None, "user", ""),
            (3, 0, "assistant", long)]
    got = {r.conv_id: r for r in chat.format_conversations(table(spark, rows)).collect()}
    assert [(t.role, t.text) for t in got[1].parsed] == [("", ""), ("assistant", "a"), ("assistant", "b"), ("assistant", "b")]
    assert [(t.role, t.text) for t in got[None].parsed] == [("user", "")]
    assert got[3].identical and hashlib.sha256(got[3].parsed[0].text.encode()).digest() == hashlib.sha256(long.encode()).digest()
    assert chat.format_conversations(table(spark, [])).count() == 0

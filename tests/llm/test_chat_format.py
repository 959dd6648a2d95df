"""Chat formatting: every text comes back, and the mask holds the assistants' texts."""

import hashlib
import random
import time

import pytest

from tidegate.llm.chat_format import CONTROL, chat_digests, format_chats, parse

SCHEMA = "conv_id long, turn long, role string, text string"
BITS = [
    "[INST]", "[/INST]", "<s>", "</s>", "\\", "\\\\", " ", "\n", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[AS]",
    "[/AS]", "é", "word", "$1", "<", "[", "]", ">", "\U0001f600",
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip_of_random_marks(spark):
    pick = random.Random(11)
    rows = [
        (c, t, pick.choice(["user", "assistant", "system", "tool", None, "[ROLE]", "a\nb", "\\"]),
         None if pick.random() < 0.1 else "".join(pick.choice(BITS) for _ in range(pick.randint(0, 12))))
        for c in range(150) for t in range(pick.randint(1, 6))
    ]
    formatted = format_chats(spark.createDataFrame(rows, SCHEMA))
    out = {r.conv_id: r for r in formatted.collect()}
    digests = {r.conv_id: r for r in chat_digests(formatted).collect()}
    said = {}
    for c, _, role, text in rows:
        said.setdefault(c, []).append((role or "", text or ""))
    assert set(out) == set(digests) == set(said)
    for c, turns in said.items():
        learned = "".join(text for role, text in turns if role == "assistant")
        got, whole = digests[c], out[c].formatted
        assert got.turns_sha256 == sha("".join(f"{r}\n{t}\n" for r, t in turns))
        assert (got.n_turns, got.loss_chars, got.loss_sha256) == (len(turns), len(learned), sha(learned))
        assert got.formatted_chars == len(whole)
        at, masked = 0, []
        for chars, loss in out[c].mask:
            masked += [whole[at:at + chars]] if loss else []
            at += chars
        assert at == len(whole)
        assert len(masked) == sum(role == "assistant" for role, _ in turns)


def test_only_conflicts_are_escaped(spark):
    rows = [(1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "a \\ b < c [INS T]"), (1, 2, "user", "\\<s>")]
    out = format_chats(spark.createDataFrame(rows, SCHEMA)).first()
    assert out.n_escaped == 2
    assert out.formatted == (
        "[INST] \\</s>\\[INST] ok \\[/INST] [/INST]\n<s> a \\ b < c [INS T] </s>\n[INST] \\\\<s> [/INST]\n")


@pytest.mark.parametrize("text", [
    "[INST] a", "[INST] a </s>\n", "[INST]a [/INST]\n", "x[INST] a [/INST]\n", "[INST] a [/INST]", "[INST] a [/INST]\nx",
    "[AS] a [/AS]\n", "[ROLE] a [/ROLE]\n", "[ROLE] a [/ROLE]\n[AS] b [/AS]\n", "[INST] [/INST]\n", "[INST] a [INST] b [/INST]\n",
])
def test_what_the_grammar_refuses(spark, text):
    assert parse(spark.createDataFrame([(text,)], "f string"), "f").first().turns is None


def test_edges(spark):
    empty = format_chats(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and parse(spark.createDataFrame([("",)], "f string"), "f").first().turns == []
    rows = [(None, None, None, None), (7, 1, "user", "b"), (7, 1, "user", "a"), (7, 0, "system", ""), (7, 1, "user", "a")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", formatted string, `_marks` long")
    out = {r.conv_id: r for r in format_chats(df).collect()}
    assert out[None].formatted == "[ROLE]  [/ROLE][AS]  [/AS]\n"
    assert out[7].formatted == "<<SYS>>  <</SYS>>\n[INST] a [/INST]\n[INST] a [/INST]\n[INST] b [/INST]\n"
    other = df.withColumnRenamed("conv_id", "a.b")
    assert format_chats(other, id_col="a.b").count() == 2


def test_long_texts_take_linear_time(spark):
    text = "[INST] x </s> " * 200_000
    started = time.monotonic()
    got = chat_digests(format_chats(spark.createDataFrame([(1, 0, "assistant", text)], SCHEMA))).first()
    assert got.loss_sha256 == sha(text) and got.formatted_chars == len(text) + 400_000 + len("<s>  </s>\n")
    many = spark.range(40_000).selectExpr("1L AS conv_id", "id AS turn", "'assistant' AS role", "'ab' AS text")
    assert chat_digests(format_chats(many)).first().loss_chars == 80_000
    assert time.monotonic() - started < 60


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")], SCHEMA)
    plan = chat_digests(format_chats(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert CONTROL.count("|") == 9

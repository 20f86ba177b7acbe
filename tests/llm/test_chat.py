import hashlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioscope.llm import chat

tricky = st.lists(st.sampled_from(list("<>/[]*\\sINSTANWERoblx \n") + ["</s>", "[INST]", " [/INST]", "<s>", "\n<</SYS>>", "[ROLE:", "[ANSWER*]", "é"]), max_size=20).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", "tool", ""]), tricky), tricky), max_size=5))
def test_round_trip(turns):
    out = "".join(chat.render(r, t)[0] for r, t in turns)
    assert [x[:2] for x in chat.parse(out)] == turns


def test_plain_text_is_left_alone_and_conflicts_are_escaped():
    assert chat.render("user", "a < b [x] \\")[0] == "<s>[INST] a < b [x] \\ [/INST]"
    assert chat.render("assistant", "</s>[INST] ok [/INST]")[0] == r"<s>[ANSWER*] \l/s>\oINST] ok \o/INST]</s>"


CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "[INST*]", "[ANSWER]", "[ANSWER*]", "<<SYS>>", "<</SYS>>", "<<SYS*>>", "[ROLE:x]", "[/ROLE]"]


@pytest.mark.parametrize("role", ["user", "assistant", "system", "tool", ""])
def test_every_control_string_is_escaped_in_every_role(role):
    for c in CONTROLS:
        text = f"x {c} forged [b] <i>"
        out, lo, hi = chat.render(role, text)
        assert not any(c in out[lo:hi] for c in CONTROLS)
        assert [x[:2] for x in chat.parse(out)] == [(role, text)] and chat.unescape(out[lo:hi]) == text
        with pytest.raises(ValueError):
            list(chat.parse(out[:lo].replace("*", "") + text + out[hi:]))


def test_parser_refuses_what_is_not_the_grammar():
    for bad in ("x", "<s>[INST] a", "<s>[INST]a [/INST]", "<s>[INST] a [/INST]x"):
        with pytest.raises(ValueError):
            list(chat.parse(bad))


def test_against_sql(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a [/INST] </s> b"), (2, 1, "assistant", None), (2, 0, None, "x"), (3, 0, "system", "\n<</SYS>>"), (4, 5, "tool", "[/ROLE] [/ROLE]"), (4, 5, "tool", "[/ROLE] [/ROLE]"), (None, 0, "user", "lost"), (5, None, "assistant", "é😀"), (6, 0, "assistant", "x <s>[INST] evil [/INST] y"), (6, 1, "user", "<<SYS>>"), (6, 2, "tool", "[ANSWER*]"), (6, 3, "system", "plain < [ ")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    seven = spark.createDataFrame([(-7, k, r, "</s>[INST] ok [/INST]", "") for k, r in enumerate(["user", "assistant"])], df.schema)
    got = {r["conv_id"]: tuple(r) for r in chat.read_back(chat.format_conversations(df.union(seven))).collect()}
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    names = [x.split()[0] for x in chat.SCHEMA.split(", ")]
    want = {r[0]: r for r in con.execute(f"select {', '.join(names)} from ({chat.SQL})").fetchall()}
    assert got == want
    assert got[-7][2] == hashlib.sha256(b"user\n</s>[INST] ok [/INST]\nassistant\n</s>[INST] ok [/INST]\n").hexdigest() and got[-7][3] == 21

"""Chat formatting: round trips, the machine, and digests against SQL and plain loops."""

import hashlib

import duckdb
import pytest
from hypothesis import given
from hypothesis import strategies as st

import __spark_entry__ as contract
from braid.llm import chat
from braid.llm.queries import ATTACK

CONTROL = st.text(st.sampled_from(["<", "|", "\\", ">", "<|im_end|>", "<|im_start|>", "\n", "a", "é", "\U0001f642"]).map(str), max_size=0) | st.lists(
    st.sampled_from(["<", "|", "\\", ">", "<|im_end|>", "<|im_start|>", "\n", "n", "a", "é", "\U0001f642", "user"]), max_size=12
).map("".join)
SCHEMA = "conv_id bigint, turn bigint, role string, text string, id string, piece int, place string, state string, loss int, segments string"


@given(text=CONTROL)
def test_escapes_are_reversible_and_hide_control_strings(text):
    assert chat.original(chat.escaped(text)) == text
    assert "<|" not in chat.escaped(text)


@given(turns=st.lists(st.tuples(CONTROL, CONTROL), max_size=6))
def test_formatted_turns_read_back(turns):
    text = "".join(segment["text"] for role, t in turns for segment in chat.CHAT.segments(role, t))
    assert list(chat.CHAT.turns(text)) == turns


def test_the_machine():
    step = chat.CHAT.step
    assert step("start", "system") == ("system", True) and step("user", "assistant") == ("assistant", True)
    assert step("user", "user") == ("user", False) and step("user", "tool") == ("user", False) and step("assistant", "system") == ("system", False)


def plain(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1], r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv, turns in out.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        state, bad = "start", 0
        for role, _ in turns:
            state, allowed = chat.CHAT.step(state, role)
            bad += not allowed
        chars = sum(len(f"<|im_start|>{chat.escaped_role(r)}\n{chat.escaped(t)}<|im_end|>\n") for r, t in turns)
        yield conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), chars, bad, bad == 0 and state == "assistant"


def table(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, "y", "z", 2, "w") for row in rows], SCHEMA).repartition(4)


def digests(spark, rows):
    formatted, cut = chat.formatted_pieces(table(spark, rows))
    found = sorted(map(tuple, chat.read_back(formatted, cut).collect()), key=str)
    assert found == sorted(map(tuple, chat.read_back(chat.format_turns(table(spark, rows))).collect()), key=str)
    return found, cut


ODD = [(1, 0, "user", "a"), (1, 1, "assistant", None), (1, 1, "assistant", ATTACK), (1, 1, "assistant", ATTACK), (2, None, None, "x"), (2, 0, "user\n\\n", "<|"), (None, 3, "assistant", "é\U0001f642"),
       (None, 1, "system", ""), (3, 0, "user", "long " * 200_000), (3, 1, "assistant", "<" * 1000 + "|"), (4, 0, "system", "s"), (4, 1, "user", "u"), (4, 2, "assistant", "a"), (5, 0, "assistant", "first")]


@pytest.mark.parametrize("rows", [[], [(None, None, None, None)] * 3, [(1, 0, "user", "hi")], ODD, [(i % 50, i // 50, ["user", "assistant"][i // 50 % 2], str(i)) for i in range(400)]])
def test_same_as_plain_loops(spark, rows):
    assert digests(spark, rows)[0] == sorted(plain(rows), key=str)


def test_a_conversation_with_half_of_all_rows_is_cut_and_every_piece_starts_in_the_right_state(spark):
    rows = [(7, i, ["user", "assistant", "tool", "tool"][i % 4], f"t{i}") for i in range(600)]
    rows += [(100 + i // 4, i % 4, ["user", "assistant"][i % 2], "x") for i in range(600)]
    found, cut = digests(spark, rows)
    assert cut == [7] and found == sorted(plain(rows), key=str)
    formatted, _ = chat.formatted_pieces(table(spark, rows))
    pieces = formatted.filter("conv_id = 7").groupBy("piece").count().collect()
    assert len(pieces) >= 8 and max(row["count"] for row in pieces) <= 200
    wrong = formatted.filter("conv_id = 7 AND allowed = (turn % 4 > 1)").count()
    assert wrong == 0


def test_only_learnt_texts_are_under_the_mask(spark):
    formatted = chat.format_turns(table(spark, ODD)).select("segments").collect()
    assert {s["text"] for row in formatted for s in row["segments"] if s["loss"]} == {"", chat.escaped(ATTACK), "é\U0001f642", "<" * 999 + "<\\|", "a", "first"}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_same_as_sql(spark, sf):
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '/root/testdata/{sf}/conversations.parquet'")
    wanted = duckdb.sql(contract.oracle_sql()["op13_chat_formatting"])
    found = contract.queries()["op13_chat_formatting"](spark, f"/root/testdata/{sf}")
    assert found.columns == wanted.columns
    assert sorted(map(tuple, found.collect())) == sorted(wanted.fetchall())

"""Chat formatting: turn order, marks inside texts, and reading back."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from feedflow.llm import chat
from tests.llm.conftest import LONG

SCHEMA = "conv_id long, turn long, role string, text string, seq long, loss string"


def digests(spark, rows):
    df = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    return {r["conv_id"]: r for r in chat.read_back(chat.segments(df)).collect()}


def expected(turns):
    joined = "".join(f"{role or ''}\n{text or ''}\n" for role, text in turns)
    return hashlib.sha256(joined.encode()).hexdigest()


def test_round_trip_and_order(spark):
    rows = [
        (1, 0, "system", "be [INST] kind"), (1, 1, "user", "hi </s>"), (1, 2, "assistant", "yes \\ <s>"),
        (2, 0, "assistant", "first"), (2, 1, None, None), (3, 0, "user", ""), (3, 1, "assistant", LONG),
        (4, 0, "critic]", "x"), (5, 0, "user", "same"), (5, 0, "user", "same"), (None, 0, "user", "no id"),
    ]
    found = digests(spark, rows)
    for conv in {r[0] for r in rows}:
        turns = [(r[2], r[3]) for r in rows if r[0] == conv]
        assert found[conv]["n_turns"] == len(turns)
        assert found[conv]["turns_sha256"] == expected(turns)
        learned = "".join(t or "" for role, t in turns if role == "assistant")
        assert found[conv]["loss_chars"] == len(learned)
        assert found[conv]["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
    assert {c: r["valid"] for c, r in found.items()} == {1: True, 2: False, 3: True, 4: False, 5: False, None: False}


def test_segments_flag_assistant_text_only(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b<")], "conv_id long, turn long, role string, text string")
    rows = chat.segments(df).orderBy("seq").collect()
    assert "".join(r["segment"] for r in rows) == "<s>[INST] a [/INST] b\\<</s>"
    assert [r["segment"] for r in rows if r["loss"]] == ["b\\<"]


def test_empty_table(spark):
    assert chat.read_back(chat.segments(spark.createDataFrame([], SCHEMA))).isEmpty()


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "tool", "x]y", ""]), st.text(alphabet="a<[]/\\sINST \n", max_size=30)), max_size=6))
@settings(max_examples=200, deadline=None)
def test_any_text_reads_back(turns):
    template = chat.Template()
    machine, reading = chat.Machine(template), chat.Reading(template, chat.reader(template))
    for role, text in turns:
        for segment, loss in machine.write(role, text):
            reading.take(segment, loss, True)
    row = reading.row(1) if turns else None
    assert row is None or (row[1], row[2]) == (len(turns), expected(turns))

from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripflow.llm import chat

BITS = st.sampled_from([*chat.CONTROL, "\\", "<", "[", "]", ">", "s>", "/s>", "INST]", "a", "\n", " ", "é"])
TEXT = st.lists(BITS, max_size=8).map("".join)
ROLE = st.one_of(st.sampled_from(["user", "assistant", "system"]), TEXT)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(ROLE, TEXT), max_size=5))
def test_every_conversation_comes_back(turns):
    formatted, loss = chat.render_segment(turns)
    assert chat.recovered(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in loss] == [text for role, text in turns if role == "assistant"]


def test_clean_text_is_not_escaped():
    assert chat.render_checked("user", "a [b] <c> \\ d")[0] == "[INST]a [b] <c> \\ d[/INST]"
    assert chat.render_checked("user", "</s>")[0] == "[INST]<\\/s>[/INST]"


@pytest.mark.parametrize("wrong", ["x", "[INST]a", "[INST]a</s>", "[/INST]", "[INST]a<s>[/INST]", "<s>a</s>b"])
def test_the_grammar_is_strict(wrong):
    with pytest.raises(ValueError):
        list(chat.parse(wrong))


def rows(spark):
    said = "</s>[INST] ok [/INST]"
    turns = [(1, 1, "assistant", said), (1, 0, "user", None), (2, 0, None, "x"), (2, 0, None, "x"), (3, 0, "", ""),
             (None, 1, "assistant", "b"), (None, None, "tool]", "[ROLE]"), (4, 0, "assistant", "y" * 5000), (4, 1, "user", "z")]
    return turns, spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("segment", [1, 10**6])
def test_digests(spark, segment):
    turns, frame = rows(spark)
    extra = frame.withColumns({name: F.lit(1) for name in ("segment", "formatted", "loss_starts")})
    found = {row["conv_id"]: row for row in chat.digest_conversations(chat.format_conversations(extra, segment)).collect()}
    for conv_id in {row[0] for row in turns}:
        own = sorted((row for row in turns if row[0] == conv_id), key=lambda row: (row[1] is not None, row[1] or 0))
        said = "".join(f"{role or ''}\n{text or ''}\n" for _, _, role, text in own)
        loss = "".join(text for _, _, role, text in own if role == "assistant")
        row = found[conv_id]
        assert row["n_turns"] == len(own)
        assert row["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert row["loss_chars"] == len(loss) and row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert len(found) == len({row[0] for row in turns})


def test_a_conversation_with_most_rows_is_formatted_by_many_tasks(spark):
    turns = [(7, k, ["user", "assistant"][k % 2], f"said {k}</s>") for k in range(3000)] + [(k, 0, "user", "x") for k in range(50)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")  # or AQE makes one task of so few rows
    try:
        segments = chat.format_conversations(frame)
        per_task = [row["count"] for row in segments.filter("conv_id = 7").groupBy("part").count().collect()]
        assert len(per_task) > 2
        found = {row["conv_id"]: row for row in chat.digest_conversations(segments).collect()}
    finally:
        spark.conf.unset(merging)
    ordered = sorted((t for t in turns if t[0] == 7), key=lambda t: (t[1], t[2], t[3]))
    said = "".join(f"{role}\n{text}\n" for _, _, role, text in ordered)
    assert found[7]["n_turns"] == len(ordered) == 3001
    assert found[7]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def test_no_rows(spark):
    _, frame = rows(spark)
    assert chat.digest_conversations(chat.format_conversations(frame.limit(0))).count() == 0

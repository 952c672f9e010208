from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from siftledger.llm import chat

PARTS = st.lists(
    st.sampled_from(
        [chat.OPEN, chat.CLOSE, "<", "|", "\\", "\n", "<\\|", "%3C", "%", "a", "im_end|>", "é", "<|"]
    ),
    max_size=8,
).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(PARTS, PARTS), max_size=4))
def test_round_trip(turns):
    assert [x[:2] for x in chat.parse(chat.render(turns))] == turns


def test_plain_content_is_not_escaped():
    turns = [("user", "1 < 2 | <b> <|other|>"), ("assistant", "fine")]
    assert chat.render(turns) == (
        "<|im_start|>user\n1 < 2 | <b> <|other|><|im_end|>\n<|im_start|>assistant\nfine<|im_end|>\n"
    )


def test_broken_grammar_is_refused():
    for text in ("x", "<|im_start|>user\nhi", "<|im_start|>user\nhi<|im_end|>", "<|im_start|>u\na<|im_start|>b<|im_end|>\n"):
        assert chat.parse(text) is None


def test_awkward_rows(spark):
    rows = [
        (1, 1, "assistant", "b", 7), (1, 0, "user", None, 7), (1, 1, "assistant", "b", 7),
        (1, None, None, "first", 7), (None, 0, "assistant", chat.CONTROL, 7), (2, 0, "a\nb", "", 7),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns int")
    found = {r["conv_id"]: r for r in chat.read_back(chat.formatted(df)).collect()}
    turns = "\nfirst\n" + "user\n\n" + "assistant\nb\n" * 2
    assert found[1]["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
    assert (found[1]["n_turns"], found[1]["loss_chars"]) == (4, 2)
    assert found[None]["loss_sha256"] == hashlib.sha256(chat.CONTROL.encode()).hexdigest()
    assert found[2]["turns_sha256"] == hashlib.sha256(b"a\nb\n\n").hexdigest()
    assert chat.formatted(df.limit(0)).count() == 0

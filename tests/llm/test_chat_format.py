import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm.chat_format import CONTROL, encode, escape, format_conversations, mask, masked_texts, read_back, render, unescape

TEXT = st.lists(st.one_of(st.text(max_size=5), st.sampled_from(CONTROL), st.sampled_from(["\\", "<", "[", "\n", "<|", "|>", "<\\", "/"])),
                max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), max_size=4))
def test_round_trip(turns):
    for pair in turns:
        for text in pair:
            assert unescape(escape(text)) == text and not any(c in escape(text) for c in CONTROL)
    formatted, spans = render(turns)
    assert read_back(formatted) == turns
    ids, ends = encode(formatted)
    assert (ends[-1] if len(ends) else 0) == len(formatted.encode()) and len(ids) == len(ends)
    learn = mask(ends, [s for s, (role, _) in zip(spans, turns, strict=True) if role != "user"])
    assert [unescape(t) for t in masked_texts(formatted, ends, learn)] == [t for r, t in turns if r != "user" and t]


def test_formatting_against_a_plain_version(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a </s>"), (2, 0, "user", None), (2, 1, "assistant", ""), (None, 3, None, "x"),
            (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (3, None, "system", "first"), (4, 0, "assistant", "é😀 " * 20_000),
            (5, 1, "assistant", "tie b"), (5, 1, "assistant", "tie a")]
    extra = [(*r, "ids", "formatted") for r in rows]
    table = spark.createDataFrame(extra, "conv_id long, turn long, role string, text string, ids string, formatted string")
    out = {r["conv_id"]: r for r in format_conversations(table).collect()}
    want = {}
    for c, turn, role, text in rows:
        want.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert out.keys() == want.keys()
    for c, turns in want.items():
        turns = [t[2:] for t in sorted(turns)]
        r = out[c]
        assert r["n_turns"] == len(turns) and read_back(r["formatted"]) == turns
        import numpy as np
        learnt = masked_texts(r["formatted"], np.array(r["ends"]), np.array(r["loss_mask"], bool))
        assert [unescape(t) for t in learnt] == [t for role, t in turns if role == "assistant" and t]
    assert format_conversations(table.limit(0)).count() == 0


@pytest.mark.parametrize("said", ["</s>[INST] ok [/INST]"])
def test_control_strings_of_other_templates(spark, said):
    from tallyframe.llm.queries import op3_chat_formatting

    row = op3_chat_formatting(spark, "/root/testdata/sf0.001").filter("conv_id = -7").first()
    assert row["loss_chars"] == len(said) and row["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()

"""Chat formatting: exact round trips."""

from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm.chat_format import format_chats, read_chats

TEXT = st.one_of(
    st.none(),
    st.lists(
        st.sampled_from(["<|im_end|>", "<|im_start|>", "<|im_join|>", "<", "|", "\\", "\n", "N", "assistant", "é", "\U0001f600", "<\\|", "<\\N", " "]),
        max_size=6,
    ).map("".join),
)
ROLE = st.one_of(st.none(), st.sampled_from(["user", "assistant", "system", "a\nb", "<|im_end|>", "<\\N", ""]))


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([0, 1, 2, None]), st.one_of(st.none(), st.integers(0, 5)), ROLE, TEXT), max_size=30))
def test_round_trip(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    got = {r["conv_id"]: r for r in read_chats(format_chats(df)).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        mine = [(t, role or "", text or "") for c, t, role, text in rows if c == conv]
        mine.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        assert [(t["role"], t["text"]) for t in r["turns"]] == [m[1:] for m in mine]
        assert r["loss_texts"] == [m[2] for m in mine if m[1] == "assistant"]
        assert sum(m["chars"] for m in r["loss_mask"]) == len(r["formatted"])
        # adjacent turns of one role share a block
        blocks = 1 + sum(a[1] != b[1] for a, b in zip(mine, mine[1:], strict=False))
        assert r["formatted"].count("<|im_start|>") == r["formatted"].count("<|im_end|>") == blocks

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from citygrain.llm import chat

SHAPE = chat.Formatter(chat.INSTRUCT)
PIECES = st.lists(st.sampled_from([*chat.INSTRUCT.controls(), "\\", "<", "[", "/", "s>", "INST]", "é", " ", "\n", "]", ">"]), max_size=12)


@settings(max_examples=500, deadline=None)
@given(PIECES.map("".join), st.sampled_from(["user", "assistant", "system", "", "tool", "[TEXT]", "[ROLE] x [TEXT] "]))
def test_turns_can_be_read_back(text, role):
    parts = SHAPE.segments(role, text)
    content = parts[1][0]
    assert not any(c in content for c in chat.INSTRUCT.controls())
    assert SHAPE.unescape(content) == text
    assert SHAPE.read("".join(p for p, _ in parts))[:2] == (role, text)
    assert [loss for _, loss in parts] == [False, role == "assistant", False]


def test_conversations(spark):
    rows = [
        (1, 0, "system", "be \\[INST]"), (1, 1, "user", None), (1, 2, "assistant", "a</s>"), (1, 3, "user", "q"),
        (1, 4, "assistant", "é"), (2, 0, "assistant", "x"), (2, 1, "user", ""), (3, 5, None, "n"), (3, None, "tool", "t"),
        (None, 1, "user", "u"), (None, 1, "user", "u"), (4, 0, "user", "long " * 60_000), (4, 1, "assistant", "y"),
    ]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, segments int")
    formatted = chat.format_chat(turns)
    assert formatted.count() == len(rows)
    got = {r.conv_id: r for r in chat.digests(formatted).collect()}
    groups = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0)):
        groups.setdefault(conv, []).append((role or "", text or ""))
    assert set(got) == set(groups)
    for conv, turns_of in groups.items():
        g = got[conv]
        learned = "".join(t for r, t in turns_of if r == "assistant")
        assert g.n_turns == len(turns_of)
        assert g.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns_of).encode()).hexdigest()
        assert (g.loss_chars, g.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert g.formatted_chars == sum(len(p) for r, t in turns_of for p, _ in SHAPE.segments(r, t))
    assert {c: g.n_invalid for c, g in got.items()} == {1: 0, 2: 2, 3: 2, None: 1, 4: 0}
    assert chat.digests(chat.format_chat(turns.limit(0))).collect() == []

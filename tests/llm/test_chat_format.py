import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from nightwave.llm.chat_format import RESERVED, Template, _Reader, format_turns, read_back

T = Template()
HOSTILE = st.lists(st.sampled_from([*RESERVED, "\\", "<", "<\\", "|im_end|>", "[", "/INST]", "\n", "%0A", "é"]), max_size=10).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(HOSTILE, HOSTILE), max_size=4))
def test_what_is_formatted_can_be_read(turns):
    formatted = "".join(t for role, text in turns for t, _ in T.segments(role, text))
    assert T.read(formatted) == (turns, len(formatted))
    assert T.read(formatted + T.opening + 'user') == (turns, len(formatted))  # an open turn is kept back
    for _, text in turns:
        assert not any(c in T.escape(text) for c in RESERVED) and T.unescape(T.escape(text)) == text


def test_frames(spark):
    rows = [(1, 1, "assistant", "yes [INST]", "x"), (1, 0, "user", "hi", "x"), (2, 0, "system", None, None), (2, 1, "user", "q", None), (2, 2, None, "?", None), (None, None, None, None, None), (3, 0, "user", "same", ""), (3, 0, "user", "same", ""),
            (4, 0, "user", "u" * 200_000, ""), (4, 1, "assistant", "\n" * 100_000, "")]
    rows += [(5, k, "user" if k % 2 == 0 else "assistant", f"turn {k}", "") for k in range(30_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, state string")
    got = {r.conv_id: r for r in read_back(format_turns(df)).collect()}
    want = {}
    for c, t, role, text, _ in sorted(rows, key=lambda r: (r[0] or 0, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert got.keys() == want.keys()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
        assert got[c].formatted_chars == sum(len(s) for turn in turns for s, _ in T.segments(*turn))
    assert {c: got[c].valid for c in got} == {1: True, 2: False, None: False, 3: False, 4: True, 5: True}
    assert read_back(format_turns(df.limit(0))).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), HOSTILE), max_size=4), st.randoms())
def test_boundaries_of_segments_do_not_tell(turns, rng):
    """Segments cut at other places, under the same mask, give the same digests."""
    whole, pieces = _Reader(T), _Reader(T)
    for role, text in turns:
        own = [{"text": t, "loss": on} for t, on in T.segments(role, text)]
        whole.take(own, True, role)
        for s in own:
            at = rng.randint(0, len(s["text"]))
            for part in (s["text"][:at], s["text"][at:]):
                pieces.take([{"text": part, "loss": s["loss"]}], True, role)
    assert whole.row() == pieces.row()
    assert whole.loss.hexdigest() == hashlib.sha256("".join(t for r, t in turns if r == "assistant").encode()).hexdigest()


def test_a_fault_at_a_boundary_shows():
    reader = _Reader(T)
    reader.take([{"text": t, "loss": on} for t, on in T.segments("user", "hi")][:2], True, "user")
    with pytest.raises(ValueError):
        reader.row()

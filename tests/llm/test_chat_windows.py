import hashlib
import random

import brute
from finspark.llm import chat_windows as C
from hypothesis import given
from hypothesis import strategies as st

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
PIECES = st.lists(st.one_of(st.sampled_from([*C.CONTROLS, "\\", "<", "|", ">", "[", "\n", "n", "end"]), st.text(max_size=4)), max_size=8)


@given(st.lists(st.tuples(PIECES.map("".join), PIECES.map("".join)), max_size=4))
def test_written_turns_read_back(turns):
    written = "".join(C.format_turn(role, text)[0] for role, text in turns)
    assert C.read_turns(written) == turns
    for role, text in turns:
        one, begin, end = C.format_turn(role, text)
        assert C.unescape(one[begin:end]) == text
        assert not any(c in one[begin:end] for c in C.CONTROLS)


def talk():
    rng, rows = random.Random(7), []
    for conv in range(12):
        roles = (["system"] if conv % 3 == 0 else []) + ["user", "assistant"] * rng.randrange(1, 9)
        rows += [(conv, i, role, brute.prose(rng, rng.randrange(0, 60)) + rng.choice(("", "</s>[INST]", "<|end|>\\"))) for i, role in enumerate(roles)]
    return rows + [(50, 0, "user", None), (50, None, None, "late"), (50, 1, "assistant", "x" * 5000), (50, 1, "assistant", "x" * 5000),
                   (None, 0, "assistant", "é"), (51, 3, "system", "not first"), (51, 2, "user", "q")]


def test_digests_equal_the_conversations(spark):
    rows = talk()
    windows = C.chat_windows(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", window int").repartition(3), budget=700, history=200)
    got = {r.conv_id: r for r in C.window_digests(windows).collect()}
    convs = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is None, r[1] or 0, r[2] or "", r[3] or "")):
        convs.setdefault(conv, []).append((role or "", text or ""))
    assert set(got) == set(convs)
    for conv, turns in convs.items():
        said = "".join(t for r, t in turns if r == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert tuple(got[conv])[:5] == (conv, len(turns), digest, len(said), hashlib.sha256(said.encode()).hexdigest())
    assert sum(r.formatted_chars for r in got.values()) == sum(len(w.text) for w in windows.collect())


def test_windows_keep_to_the_budget(spark):
    rows = talk()
    windows = C.chat_windows(spark.createDataFrame(rows, SCHEMA), budget=700, history=200).collect()
    repeats = 0
    for w in windows:
        turns = C.read_turns(w.text)
        size = [len(C.format_turn(*t)[0].encode()) for t in turns]
        lead = 1 if w.window and w.repeated and turns[0][0] == "system" else 0
        assert len(turns) == w.turns and w.turns > w.repeated
        assert sum(size) <= 700 or w.turns == lead + 1
        assert sum(size[lead:w.repeated]) <= 200
        assert len(w.target_begin) == sum(r == "assistant" for r, _ in turns[w.repeated:])
        repeats += w.repeated > lead
    assert repeats > 5
    later = [w for w in windows if w.window and w.conv_id == 0]
    assert all(C.read_turns(w.text)[0][0] == "system" for w in later)


def test_empty_table(spark):
    assert C.window_digests(C.chat_windows(spark.createDataFrame([], SCHEMA))).collect() == []

import hashlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from claimloom.llm.chat import CONTROL, SYSTEM_ROLE, TARGET_ROLE, chat_windows, count_tokens, escape, escape_role, read_back, unescape, window_digests

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
pieces = st.lists(st.sampled_from([*CONTROL, "\\", ".", "n", "<", "|", ">", "[", "/", "s", "\n", "<|", "end|>", "x"]), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(pieces)
def test_escapes_are_reversible_and_leave_no_control(text):
    for write in (escape, escape_role):
        assert unescape(write(text)) == text
        assert not any(c in write(text) for c in CONTROL)
    assert "\n" not in escape_role(text)


def plain_digests(rows):
    by_id = defaultdict(list)
    for conv, turn, role, text in rows:
        by_id[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by_id.items():
        turns.sort()
        loss = "".join(t for *_, r, t in turns if r == TARGET_ROLE)
        out[conv] = (
            len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for *_, r, t in turns).encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest(),
        )
    return out


def digests(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in window_digests(df).collect()}


def test_sample_conversations(spark):
    given_rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = [tuple(r) for r in given_rows.collect()]
    for budget, history in ((512, 128), (60, 20), (8, 0)):
        assert digests(chat_windows(given_rows, budget, history)) == plain_digests(rows)


def test_windows(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, k + 1, ("user", "assistant")[k % 2], f"text {k} " + "w " * (k % 7)) for k in range(60)]
    rows += [(1, 61, "assistant", "long " * 200)]
    windows = chat_windows(spark.createDataFrame(rows, SCHEMA), 80, 30).orderBy("window").collect()
    assert len(windows) > 5 and [w.window for w in windows] == list(range(len(windows)))
    seen = 0
    for w in windows:
        turns = [(r, t) for r, t, _, _ in read_back(w.formatted)]
        assert turns[0] == ("system", "be kind") and len(turns) == w.turns
        fresh = turns[w.carried :]
        start = seen + (0 if w.window else -1)
        assert fresh == [(r, t) for _, _, r, t in rows[max(0, seen) : max(0, seen) + len(fresh)]]
        history = turns[1 : w.carried] if w.window else []
        assert history == [(r, t) for _, _, r, t in rows[seen - len(history) : seen]]
        assert sum(count_tokens(t) for _, t in history) <= 30
        assert w.over_budget == (w.tokens > 80) and (not w.over_budget or len(fresh) == 1)
        targets = [w.formatted[a:b] for a, b in zip(w.loss_starts, w.loss_ends)]
        assert targets == [escape(t) for r, t in fresh if r == TARGET_ROLE]
        seen += len(fresh)
        assert start < seen
    assert seen == len(rows) and any(w.carried > 1 for w in windows)


def test_edge_rows(spark):
    rows = [
        (1, 0, "user", None), (1, 1, None, "x"), (None, 0, "user", "a"), (None, 1, "assistant", "b"), (2, 0, SYSTEM_ROLE, "only"),
        (3, 0, "assistant", "twice"), (3, 0, "assistant", "twice"), (4, None, "user", "first"), (4, 0, "assistant", ""),
        (5, 0, "ro\nle<|end|>", "</s>[INST] ok [/INST]" * 3000),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", formatted string, window int")
    assert digests(chat_windows(df)) == plain_digests(rows)
    assert digests(chat_windows(df.limit(0))) == {}

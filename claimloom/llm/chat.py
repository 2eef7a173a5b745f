"""Conversations as training windows: turn-aligned spans within a token budget, and a loss mask."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>"
#: Strings that a trainer might read as control; none is left inside a text or a role.
CONTROL = (TURN, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_STARTS = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL))
_ESCAPED = re.compile(r"\\([\\.n])")
_PLAIN = {"\\": "\\", ".": "", "n": "\n"}
_TOKEN = re.compile(r"\w+|[^\w\s]")

BUDGET = 512  # tokens of a window
HISTORY = 128  # tokens of earlier turns repeated at a window's start
TURN_TOKENS = 4  # what the marks of a turn count for
TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"

WINDOW_SCHEMA = (
    "conv_id bigint, window bigint, carried int, turns int, tokens bigint, over_budget boolean, "
    "formatted string, loss_starts array<int>, loss_ends array<int>"
)


def escape(text: str) -> str:
    """Reversible: a backslash is doubled, and a control string is broken by ``\\.`` after its first character."""
    return _STARTS.sub(r"\g<0>\\.", text.replace("\\", "\\\\"))


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN[m[1]], text)


def count_tokens(text: str) -> int:
    """Words and single marks; a stand-in for a tokenizer's count that needs no file."""
    return TURN_TOKENS + sum(1 for _ in _TOKEN.finditer(text))


def read_back(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of every turn; the offsets frame the escaped text."""
    turns, at = [], 0
    while at < len(formatted):
        line = formatted.index("\n", at)
        stop = formatted.index(END, line)
        turns.append((unescape(formatted[at + len(TURN) : line]), unescape(formatted[line + 1 : stop]), line + 1, stop))
        at = stop + len(END)
    return turns


class _Windows:
    """Windows of one conversation, from its turns in order; holds one window and the history before it."""

    def __init__(self, conv_id, budget: int, history: int) -> None:
        self.conv_id, self.budget, self.history = conv_id, budget, history
        self.system: tuple[str, str, int] | None = None
        self.turns: list[tuple[str, str, int]] = []
        self.sums = [0]  # prefix sums of the tokens in self.turns
        self.carried = 0  # of self.turns, repeated from earlier windows
        self.number = self.seen = 0

    def add(self, role: str, text: str) -> dict | None:
        """Take the next turn; returns the window that it closes."""
        turn, done = (role, text, count_tokens(text)), None
        self.seen += 1
        if self.seen == 1 and role == SYSTEM_ROLE:
            self.system = turn
            return None
        room = self.budget - (self.system[2] if self.system else 0)
        if len(self.turns) > self.carried and self.sums[-1] + turn[2] > room:
            done = self.close()
            # the longest suffix that the history allows and that leaves room for the new turn
            least = self.sums[-1] - max(0, min(self.history, room - turn[2]))
            first = bisect_left(self.sums, least)
            self.turns = self.turns[first:]
            self.sums = [s - self.sums[first] for s in self.sums[first:]]
            self.carried = len(self.turns)
        self.turns.append(turn)
        self.sums.append(self.sums[-1] + turn[2])
        return done

    def close(self) -> dict | None:
        """The window as a row; the system turn is a target-free repeat in all windows but the first."""
        if len(self.turns) == self.carried and not (self.system and self.number == 0):
            return None
        head = [self.system] if self.system else []
        carried = self.carried + (1 if self.system and self.number else 0)
        parts, starts, ends, at = [], [], [], 0
        for i, (role, text, _) in enumerate([*head, *self.turns]):
            opening, inner = f"{TURN}{escape_role(role)}\n", escape(text)
            if role == TARGET_ROLE and i >= len(head) + self.carried:
                starts.append(at + len(opening))
                ends.append(at + len(opening) + len(inner))
            parts += [opening, inner, END]
            at += len(opening) + len(inner) + len(END)
        tokens = self.sums[-1] + sum(t[2] for t in head)
        row = {
            "conv_id": self.conv_id, "window": self.number, "carried": carried, "turns": len(head) + len(self.turns),
            "tokens": tokens, "over_budget": tokens > self.budget, "formatted": "".join(parts), "loss_starts": starts, "loss_ends": ends,
        }
        self.number += 1
        return row


def chat_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Training windows of all conversations, columns as in ``WINDOW_SCHEMA``.

    Turns are put in order by turn, then role and text. A window starts with the
    conversation's opening system turn, repeats the last earlier turns (up to
    ``history`` tokens; their assistant texts are not targets again) and goes on
    with new turns while the budget lasts. Turns are never cut: one that is
    longer than the budget has a window with as little else as can be
    (over_budget). The repeated system turn comes before the history in
    ``turns``; ``carried`` counts both. loss_starts and loss_ends are code point
    offsets of the target texts in ``formatted``.

    Null text and null role are empty; a null conv_id is a conversation of its
    own; a null turn comes first; repeated rows are repeated turns. Other
    columns are ignored; an empty table gives no windows. A task streams its
    conversations in order and holds one window at a time, so a conversation may
    be of any length.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, rows = None, []
        for batch in batches:
            ids = [None if x is pd.NA else x for x in batch["conv_id"].astype("Int64")]
            for conv_id, role, text in zip(ids, batch["role"], batch["text"]):
                if current is None or current.conv_id != conv_id:
                    rows.append(current and current.close())
                    current = _Windows(conv_id, budget, history)
                rows.append(current.add(role or "", text or ""))
            found = [r for r in rows if r]
            rows = []
            if found:
                yield _frame(found)
        last = current and current.close()
        if last:
            yield _frame([last])

    ordered = conversations.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    ordered = ordered.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInPandas(run, WINDOW_SCHEMA)


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(rows).astype({"conv_id": "Int64"})


def window_digests(windows: DataFrame) -> DataFrame:
    """What the windows of each conversation say, read back from them: turns and loss texts as digests."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, done = None, []

        def row() -> dict:
            return {
                "conv_id": state["conv_id"], "n_turns": state["n"], "turns_sha256": state["turns"].hexdigest(),
                "loss_chars": state["chars"], "loss_sha256": state["loss"].hexdigest(),
                "formatted_chars": state["formatted"], "n_windows": state["windows"],
            }

        for batch in batches:
            ids = [None if x is pd.NA else x for x in batch["conv_id"].astype("Int64")]
            for conv_id, carried, text, starts, ends in zip(
                ids, batch["carried"], batch["formatted"], batch["loss_starts"], batch["loss_ends"]
            ):
                if state is None or state["conv_id"] != conv_id:
                    if state:
                        done.append(row())
                    state = {
                        "conv_id": conv_id, "n": 0, "chars": 0, "formatted": 0, "windows": 0,
                        "turns": hashlib.sha256(), "loss": hashlib.sha256(),
                    }
                for role, said, _, _ in read_back(text)[carried:]:
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{said}\n".encode())
                for a, b in zip(starts, ends):
                    target = unescape(text[a:b])
                    state["chars"] += len(target)
                    state["loss"].update(target.encode())
                state["formatted"] += len(text)
                state["windows"] += 1
            if done:
                yield _frame(done)
                done = []
        if state:
            yield _frame([row()])

    ordered = windows.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return ordered.select("conv_id", "carried", "formatted", "loss_starts", "loss_ends").mapInPandas(
        run,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_windows bigint",
    )

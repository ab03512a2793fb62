"""Chat formatting: budgeted windows over the turns of a conversation.

A turn is written as ``<|turn|>`` role, newline, text, ``<|end|>`` newline.  In roles and
texts a backslash is doubled and a control string (of this template or of other common
ones) gets a backslash after its first character, so no text can open or close a turn;
newlines in roles become ``\\n``.  ``unescape`` restores the input exactly.

Prefix sums of the turns' tokens choose the windows: a window repeats the leading system
turn, then as many of the latest turns as fit in ``history`` tokens, and goes on with new
turns while the whole stays within ``budget``; it holds at least one new turn, alone with
the system turn if that is already too long.  Turns are never cut.  New assistant turns
are targets (spans in code points of the window's text); repeated ones are masked.

Rows are sorted by conversation and turn by Spark and streamed; of a conversation only
the turns of the current window are held, so a conversation may be of any length.

Defined cases: null texts and roles are empty; null turns come last; equal turns are
ordered by role and text and all kept; null ids are one conversation; a conversation
without assistant turns has no targets; an empty table has no windows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finspark.llm.token_scan import encoding

OPEN, CLOSE = "<|turn|>", "<|end|>\n"
# Control strings of this and other common templates.
CONTROLS = (OPEN, "<|end|>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_CONTROL = re.compile("|".join(re.escape(c) for c in sorted(CONTROLS, key=len, reverse=True)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(re.escape(OPEN) + r"([^\n]*)\n(.*?)" + re.escape(CLOSE), re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The written turn, and where its text begins and ends in it."""
    head = f"{OPEN}{escape(role).replace(chr(10), chr(92) + 'n')}\n"
    body = escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def read_turns(window: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a window."""
    role = lambda x: _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], x)
    return [(role(m[1]), unescape(m[2])) for m in _TURN.finditer(window)]


class _Windows:
    """Windows of one conversation, fed turn by turn."""

    def __init__(self, budget: int, history: int, count: Callable[[str], int]):
        self.budget, self.history, self.count = budget, history, count
        self.system: tuple | None = None
        self.turns: list[tuple] = []  # repeated, then new: (text, begin, end, role, prefix sum of tokens)
        self.repeated, self.total, self.number, self.fed = 0, 0, 0, 0

    def _tokens(self, first: int) -> int:
        """Tokens of the held turns from ``first`` on, by prefix sums."""
        if first >= len(self.turns):
            return 0
        return self.turns[-1][4] - (self.turns[first - 1][4] if first else self.before)

    def feed(self, role: str, text: str) -> Iterator[tuple]:
        written, begin, end = format_turn(role, text)
        size = self.count(written)
        if self.fed and len(self.turns) > self.repeated:
            top = self.system[5] if self.system and self.number else 0
            if top + self._tokens(0) + size > self.budget:
                yield self._close()
                self._repeat(size)
        if not self.turns:
            self.before = self.total
        self.total += size
        self.turns.append((written, begin, end, role, self.total))
        if not self.fed and role == "system":
            self.system = (written, begin, end, role, self.total, size)
        self.fed += 1

    def _repeat(self, size: int) -> None:
        """Keep the latest turns that fit in the history and leave room for the next one."""
        top = self.system[5] if self.system else 0
        room = min(self.history, self.budget - top - size)
        own = 1 if self.number == 1 and self.system else 0  # the system turn itself is repeated apart
        first = len(self.turns)
        while first > own and self._tokens(first - 1) <= room:
            first -= 1
        if first:
            self.before = self.turns[first - 1][4]
        self.turns = self.turns[first:]
        self.repeated = len(self.turns)

    def _close(self) -> tuple:
        """(number, text, repeated turns, turns, target begins, target ends) of the current window."""
        lead = [self.system] if self.system and self.number else []
        begins, ends, at = [], [], 0
        for i, turn in enumerate([*lead, *self.turns]):
            if turn[3] == "assistant" and i >= len(lead) + self.repeated:
                begins.append(at + turn[1])
                ends.append(at + turn[2])
            at += len(turn[0])
        self.number += 1
        return (self.number - 1, "".join(t[0] for t in [*lead, *self.turns]), len(lead) + self.repeated,
                len(lead) + len(self.turns), begins, ends)

    def finish(self) -> Iterator[tuple]:
        if len(self.turns) > self.repeated:
            yield self._close()


_WINDOW = ["conv_id", "window", "text", "repeated", "turns", "target_begin", "target_end"]
_WINDOW_SCHEMA = ("conv_id bigint, window bigint, text string, repeated bigint, turns bigint, "
                  "target_begin array<bigint>, target_end array<bigint>")
_WINDOW_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]


def _window_rows(budget: int, history: int, ranks: bytes | None, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoding(ranks, pattern) if ranks else None
        count = (lambda t: len(made.encode_ordinary(t))) if made else (lambda t: len(t.encode()))
        conv, open_, out, size = None, None, [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), _WINDOW_TYPES)], _WINDOW)

        for rows in batches:
            for one, role, text in zip(*(rows.column(c) for c in ("conv_id", "role", "text"))):
                one = one.as_py()
                if open_ is None or one != conv:
                    out += [(conv, *w) for w in open_.finish()] if open_ else []
                    conv, open_ = one, _Windows(budget, history, count)
                for w in open_.feed(role.as_py() or "", text.as_py() or ""):
                    out.append((conv, *w))
                    size += len(w[1])
                if size > 4 << 20 or len(out) > 2000:
                    yield batch()
                    out, size = [], 0
        out += [(conv, *w) for w in open_.finish()] if open_ else []
        if out:
            yield batch()
    return run


def chat_windows(turns: DataFrame, budget: int = 2048, history: int = 512, ranks: bytes | None = None,
                 pattern: str = "") -> DataFrame:
    """Windows of all conversations of ``(conv_id, turn, role, text)``: text, number of repeated and
    of all turns, and the target spans.  Tokens are those of the vocabulary, or bytes without one."""
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text")
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_last("turn"), "role", "text")
            .select("conv_id", "role", "text").mapInArrow(_window_rows(budget, history, ranks, pattern), _WINDOW_SCHEMA))


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation, from its windows in order."""
    conv, state, out = None, None, []

    def close() -> None:
        if state:
            out.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

    for rows in batches:
        for one, text, repeated, begins, ends in zip(*(rows.column(c).to_pylist() for c in (
                "conv_id", "text", "repeated", "target_begin", "target_end"))):
            if state is None or one != conv:
                close()
                conv, state = one, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, said in read_turns(text)[repeated:]:
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
            for begin, end in zip(begins, ends):
                target = unescape(text[begin:end])
                state[2] += len(target)
                state[3].update(target.encode())
            state[4] += len(text)
    close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], _DIGEST)


_DIGEST = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def window_digests(windows: DataFrame) -> DataFrame:
    """What the windows say, read back: digests of new turns and of targets per conversation."""
    return (windows.select("conv_id", "window", "text", "repeated", "target_begin", "target_end").repartition("conv_id")
            .sortWithinPartitions("conv_id", "window").mapInArrow(
                _digest_rows, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                              "loss_sha256 string, formatted_chars bigint"))

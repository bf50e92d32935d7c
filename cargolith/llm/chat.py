"""Conversations as training windows of a token budget (operator 7).

Template of a turn: ``### role: text</turn>`` and a line feed. Inside role and text a backslash precedes each
backslash, each ``###`` and each ``</turn>`` (in the role each colon as well), so that the marks of the
template are the only bare ones and every text can be read back.

Prefix sums of the turns' tokens choose windows that begin and end with a turn: as many new turns as the
budget holds beside the conversation's first system turn and up to ``history`` tokens of the turns before.
Repeated turns stand in front and are outside the loss mask, hence each assistant turn is a target once. A turn
larger than the budget stands in a window of its own; turns are never cut.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolith.llm.common import like, stash

BUDGET, HISTORY = 512, 96
TARGET, SYSTEM = "assistant", "system"
_MARKS = re.compile(r"\\|###|</turn>")
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.DOTALL)
_WORD = re.compile(r"\w+|[^\w\s]")


def escape(text: str) -> str:
    return _MARKS.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def count_tokens(text: str) -> int:
    """Words and marks; another measure can be passed in its place."""
    return len(_WORD.findall(text))


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where its (escaped) text starts and ends in it."""
    head = f"### {escape(role).replace(':', chr(92) + ':')}: "
    body = escape(text)
    return f"{head}{body}</turn>\n", len(head), len(head) + len(body)


def parse(window: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a window; raises if anything else stands in it."""
    out, at = [], 0
    for m in _TURN.finditer(window):
        if m.start() != at:
            raise ValueError("text between turns")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(window):
        raise ValueError("text after the last turn")
    return out


class _Conversation:
    """Turns of one conversation as they stream in; holds no more than a window and its history."""

    def __init__(self, conv_id, budget: int, history: int, count: Callable[[str], int]):
        self.id, self.budget, self.history, self.count = conv_id, budget, history, count
        self.system: tuple | None = None
        self.past: list[tuple] = []
        self.turns: list[tuple] = []
        self.tokens: list[int] = []
        self.window = 0

    def add(self, role: str, text: str):
        turn = (role, *render(role, text))
        self.turns.append(turn)
        self.tokens.append(self.count(turn[1]))
        if sum(self.tokens) > self.budget:
            yield from self.flush(False)

    def flush(self, last: bool):
        """Windows that are full; with ``last`` the rest too."""
        while self.turns:
            repeat = [] if self.system is None else [self.system]
            back = np.cumsum([t for *_, t in reversed(self.past)]) if self.past else np.zeros(0)
            kept = int(np.searchsorted(back, self.history, "right"))
            repeat += self.past[len(self.past) - kept :]
            room = self.budget - sum(t for *_, t in repeat)
            sums = np.cumsum(self.tokens)
            n = max(1, int(np.searchsorted(sums, room, "right")))
            if n >= len(self.turns) and not last and sums[-1] <= room:
                return
            n = min(n, len(self.turns))
            text, loss, size = [], [], 0
            for role, shown, start, end, *_ in [*repeat, *self.turns[:n]]:
                if len(text) >= len(repeat) and role == TARGET:
                    loss.append({"start": size + start, "end": size + end})
                text.append(shown)
                size += len(shown)
            yield self.id, self.window, len(repeat), n, "".join(text), loss
            for turn, t in zip(self.turns[:n], self.tokens[:n], strict=True):
                if turn[0] == SYSTEM and self.system is None:
                    self.system = (*turn, t)
                else:
                    self.past.append((*turn, t))
            while len(self.past) > 1 and sum(t for *_, t in self.past[1:]) > self.history:
                self.past.pop(0)
            self.turns, self.tokens = self.turns[n:], self.tokens[n:]
            self.window += 1


_WINDOW = "conv_id long, window long, n_repeated int, n_new int, text string, loss array<struct<start long, end long>>"
_ARROW = pa.schema([("conv_id", pa.int64()), ("window", pa.int64()), ("n_repeated", pa.int32()), ("n_new", pa.int32()), ("text", pa.string()),
                    ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, count: Callable[[str], int] = count_tokens) -> DataFrame:
    """conv_id, window, n_repeated, n_new (turns), text and loss (spans of ``text``) of all conversations.

    Turns go in order of turn, then role, then text, NULLs first; repeated rows are turns of their own. NULL
    text and role count as empty, rows with NULL conv_id are one conversation. A conversation streams through
    one task in bounded memory, however long it is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []

        def out(force: bool):
            if rows and (force or len(rows) >= 500):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)], schema=_ARROW)
                rows.clear()

        for batch in batches:
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if now is None or now.id != conv:
                    if now is not None:
                        rows.extend(now.flush(True))
                    now = _Conversation(conv, budget, history, count)
                rows.extend(now.add(role or "", text or ""))
                yield from out(False)
        if now is not None:
            rows.extend(now.flush(True))
        yield from out(True)

    narrow = like(conversations, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    ordered = narrow.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, _WINDOW)


def read_back(rows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars from windows, by parsing their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, now, turns, loss, n, chars, shown, rows = False, None, None, None, 0, 0, 0, []

        def result():
            rows.append((now, n, turns.hexdigest(), chars, loss.hexdigest(), shown))

        def out(force: bool):
            if rows and (force or len(rows) >= 2000):
                types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                rows.clear()

        for batch in batches:
            for conv, skip, text, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "n_repeated", "text", "loss")), strict=True):
                if not begun or conv != now:
                    if begun:
                        result()
                        yield from out(False)
                    begun, now, turns, loss, n, chars, shown = True, conv, hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                for role, said in parse(text)[skip:]:
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                for s in spans:
                    said = unescape(text[s["start"] : s["end"]])
                    loss.update(said.encode())
                    chars += len(said)
                shown += len(text)
        if begun:
            result()
        yield from out(True)

    ordered = like(rows, "conv_id", "window", "n_repeated", "text", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def formatted(conversations: DataFrame) -> DataFrame:
    """Windows written to the shared folder, and read back from there."""
    return read_back(stash(windows(conversations), "windows"))

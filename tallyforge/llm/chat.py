"""Chat formatting in budgeted windows.

A conversation's rows, in order of turn, become training texts (windows) of at most ``budget``
tokens. A turn's tokens are those of a byte-level vocabulary, the template's included. Prefix sums of
turn tokens choose the spans: a window opens with the conversation's system turn, repeats the last
turns before it as history while they fit a share of the budget, and goes on with new turns up to
the budget; spans begin and end at turns. A turn larger than the budget stands alone, whole, with the
system turn: only such windows go over it. Where the system turn is so large that it and a new turn
don't fit together, but the turn alone does, the window goes without the system turn. Repeated
turns bear no loss, so each assistant turn is a target exactly once.

Template of a turn: ``### <role>: <text></turn>`` and a newline. Inside roles and texts a backslash
goes before each backslash and each control string; reading drops it.

Rows are dealt out by conversation and sorted; each task then streams through its rows and holds
one window and its history only, whatever the length of a conversation.

Edge cases: null text or role counts as empty; null conv_ids form one conversation; rows with the
same turn are ordered by role and text, and all stay. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from . import attribution, common

BUDGET = 1024
#: The most that history may take of the budget.
HISTORY = 0.25
TARGET, SYSTEM = "assistant", "system"
OPEN, ROLE_END, CLOSE = "### ", ": ", "</turn>"
_TEXT_CONTROL = re.compile(r"\\|### |</turn>")
_ROLE_CONTROL = re.compile(r"\\|: |### |</turn>")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:[^\\:]|\\.|:(?! ))*): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)

WINDOWS = "window long, text string, new_from int, loss array<struct<start:int,end:int>>, tokens long"


def escape(text: str, control: re.Pattern = _TEXT_CONTROL) -> str:
    return control.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn by the template, and where its text begins and ends in it."""
    head = f"{OPEN}{escape(role, _ROLE_CONTROL)}{ROLE_END}"
    body = escape(text)
    return f"{head}{body}{CLOSE}\n", len(head), len(head) + len(body)


def turns(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of the turns of a window; start and end are of the escaped text."""
    at = 0
    while at < len(text):
        if not (m := _TURN.match(text, at)):
            raise ValueError("not a formatted text")
        yield unescape(m[1]), unescape(m[2]), m.start(2), m.end(2)
        at = m.end()


def counted(parts: list[str], vocabulary: str) -> np.ndarray:
    """Tokens of each formatted turn."""
    return np.diff(attribution.lengths(vocabulary).spans(parts)[1])


class _Conversation:
    """Windows of one conversation, some turns at a time."""

    def __init__(self, budget: int, history: int) -> None:
        self.budget, self.most = budget, history
        self.system: tuple[str, str, int] | None = None
        self.past: list[tuple[str, str, int]] = []  # the turns that may be repeated next
        self.number = 0
        self._open()

    def _open(self) -> None:
        self.parts: list[str] = []
        self.length = self.tokens = self.fresh = 0
        self.loss: list[dict[str, int]] = []

    def _put(self, role: str, text: str, tokens: int, target: bool) -> None:
        part, start, end = format_turn(role, text)
        if target:
            self.loss.append({"start": self.length + start, "end": self.length + end})
        self.parts.append(part)
        self.length += len(part)
        self.tokens += tokens

    def close(self) -> Iterator[dict]:
        if self.fresh:
            yield {"window": self.number, "text": "".join(self.parts), "new_from": len(self.parts) - self.fresh, "loss": self.loss, "tokens": self.tokens}
            self.number += 1
            self._open()

    def _begin(self, tokens: int) -> None:
        """Opens a window whose first new turn has so many tokens: the system turn and history."""
        room = self.budget - tokens
        if self.system and (self.system[2] <= room or room < 0):
            self._put(*self.system, False)
            room -= self.system[2]
        held = np.cumsum([n for _, _, n in reversed(self.past)])
        for turn in self.past[len(self.past) - int(np.searchsorted(held, min(self.most, room), "right")) :]:
            self._put(*turn, False)

    def take(self, turns: list[tuple[str, str]], tokens: np.ndarray) -> Iterator[dict]:
        """Takes the next turns; gives the windows that they end."""
        upto = np.concatenate(([0], np.cumsum(tokens)))
        i = 0
        while i < len(turns):
            end = int(np.searchsorted(upto, upto[i] + self.budget - self.tokens, "right")) - 1
            if self.fresh and end <= i:
                yield from self.close()
            if not self.fresh:
                self._begin(int(tokens[i]))
                end = max(i + 1, int(np.searchsorted(upto, upto[i] + self.budget - self.tokens, "right")) - 1)
            new = [(*turns[k], int(tokens[k])) for k in range(i, end)]
            for turn in new:
                self._put(*turn, turn[0] == TARGET)
            self.fresh += len(new)
            i = end
            if self.system is None and (first := next((k for k, turn in enumerate(new) if turn[0] == SYSTEM), None)) is not None:
                self.system = new.pop(first)
            self.past += new
            held = np.cumsum([n for _, _, n in reversed(self.past)])
            self.past = self.past[len(self.past) - int(np.searchsorted(held, self.most, "right")) :]


def windows(rows: DataFrame, budget: int = BUDGET, history: float = HISTORY, vocabulary: str | None = None) -> DataFrame:
    """(conv_id, window, text, new_from, loss, tokens), ordered within partitions.

    rows: (conv_id, turn, role, text). new_from: how many of the window's turns are repeated; loss:
    spans of code points of the text that bear loss.
    """
    path = vocabulary or attribution.default_path()
    rows = common.pick(rows, "conv_id", "turn", "role", "text")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, key = None, None
        for f in frames:
            keys = f["conv_id"].tolist()
            turns = [(r or "", t or "") for r, t in zip(f["role"], f["text"], strict=True)]
            tokens = counted([format_turn(*turn)[0] for turn in turns], path)
            out: list[dict] = []
            i = 0
            while i < len(keys):
                end = next((k for k in range(i, len(keys)) if keys[k] != keys[i]), len(keys))
                if now is None or keys[i] != key:
                    out += [{"conv_id": key} | w for w in now.close()] if now else []
                    now, key = _Conversation(budget, int(budget * history)), keys[i]
                for w in now.take(turns[i:end], tokens[i:end]):
                    out.append({"conv_id": key} | w)
                    if len(out) >= 1000:
                        yield _frame(out)
                        out = []
                i = end
            yield _frame(out)
        if now is not None:
            yield _frame([{"conv_id": key} | w for w in now.close()])

    return common.mapped(rows, run, WINDOWS)


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["conv_id", "window", "text", "new_from", "loss", "tokens"])


def read_back(formatted: DataFrame) -> DataFrame:
    """What the output of ``windows`` holds, one row for each conversation.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows), read from
    the formatted texts and loss masks alone, in the order that ``windows`` leaves them.
    """
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, seen = None, None

        def row() -> tuple:
            n, all_, chars, loss, formatted_chars, n_windows = seen
            return key, n, all_.hexdigest(), chars, loss.hexdigest(), formatted_chars, n_windows

        for f in frames:
            out = []
            for conv, text, new_from, mask in zip(f["conv_id"].tolist(), f["text"], f["new_from"], f["loss"], strict=True):
                if seen is None or conv != key:
                    if seen is not None:
                        out.append(row())
                    key, seen = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for i, (role, said, _, _) in enumerate(turns(text)):
                    if i >= new_from:
                        seen[0] += 1
                        seen[1].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for span in mask:
                    said = unescape(text[span["start"] : span["end"]])
                    seen[2] += len(said)
                    seen[3].update(said.encode("utf-8", "surrogatepass"))
                seen[4] += len(text)
                seen[5] += 1
            yield pd.DataFrame(out, columns=columns)
        if seen is not None:
            yield pd.DataFrame([row()], columns=columns)

    return common.mapped(formatted, run, "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long")

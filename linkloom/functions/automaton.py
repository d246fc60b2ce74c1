"""The automaton of dump lines, as functions from states to states that can be composed.

Text comes in pieces that end with a closing parenthesis, which is not part of them. What a piece does depends on the state at
its beginning, so a piece is a function, and a range of pieces is the composition of theirs: ranges of one line can be gone through
apart and be put together later. Neither an escape nor the head of an insert is ever cut, as they hold no closing
parenthesis but at their end.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# States between pieces: no list yet in this line, between tuples, in a tuple, in quotes in a tuple, after the list,
# and after something that does not belong into a list. A line feed leads from any to the first.
PLAIN, BETWEEN, OPEN, QUOTED, DONE, BROKEN = range(6)
STATES = 6

_SPACE = rb"[ \t\x0b\f\r]*"
_HEAD = re.compile(rb"INSERT INTO `([^)]*?)` VALUES \(")
_NEXT = re.compile(_SPACE + rb"," + _SPACE + rb"\(")
_END = re.compile(_SPACE + rb";")
_ESCAPED = re.compile(rb"(?s)\\.")


def within_tuple(piece: bytes, quoted: bool) -> int:
    """The state after a piece that begins inside a tuple."""
    clean = _ESCAPED.sub(b"", piece)
    parts = clean.split(b"'")
    plain = parts[1::2] if quoted else parts[0::2]
    if any(b"(" in part for part in plain):
        return BROKEN
    if (len(parts) % 2 == 0) != quoted:
        return QUOTED
    return OPEN if clean.endswith(b"\\") else BETWEEN


def head_of(line: bytes) -> tuple[bytes, int] | None:
    """Table of the first insert in a line, and where its first tuple begins."""
    found = _HEAD.search(line)
    return (found[1], found.end() - 1) if found else None


def ends_badly(state: int, rest: bytes) -> bool:
    """Whether a line is malformed that goes on with ``rest`` in this state and then ends."""
    if state == PLAIN:
        return head_of(rest) is not None
    return state != DONE and not (state == BETWEEN and _END.match(rest))


class Pieces:
    """A batch of pieces: their texts, the function of each, and in which states each begins a tuple and where."""

    def __init__(self, values: pa.Array):
        self.texts: list[bytes] = values.to_pylist()
        n = len(self.texts)

        def array(x) -> np.ndarray:
            return x.to_numpy(zero_copy_only=False)

        escapes = array(pc.match_substring(values, "\\")) if n else np.zeros(0, dtype=bool)
        clean = pc.replace_substring_regex(values, r"(?s)\\.", "") if escapes.any() else values
        odd = array(pc.count_substring(clean, "'")) % 2 == 1
        escaped = array(pc.ends_with(clean, "\\"))
        opening = array(pc.count_substring(clean, "("))
        self.follows = array(pc.starts_with(values, ",("))
        ended = array(pc.starts_with(values, ";"))
        self.feeds = array(pc.match_substring(values, "\n"))
        closes = np.where(escaped, OPEN, BETWEEN)
        f = np.empty((n, STATES), dtype=np.int8)
        f[:, PLAIN], f[:, DONE], f[:, BROKEN] = PLAIN, DONE, BROKEN
        f[:, OPEN] = np.where(odd, QUOTED, closes)
        f[:, QUOTED] = np.where(odd, closes, QUOTED)
        # A parenthesis that may lie outside quotes, or blanks before a comma, are looked at one by one.
        for i in np.flatnonzero(~self.follows & ~ended & ~self.feeds):
            self.follows[i] = _NEXT.match(self.texts[i]) is not None
            ended[i] = _END.match(self.texts[i]) is not None
        f[:, BETWEEN] = np.where(self.follows, f[:, OPEN], np.where(ended, DONE, BROKEN))
        for i in np.flatnonzero((opening > self.follows) & ~self.feeds):
            text = self.texts[i]
            f[i, OPEN], f[i, QUOTED] = within_tuple(text, False), within_tuple(text, True)
            if self.follows[i]:
                f[i, BETWEEN] = within_tuple(text[text.index(b"(") + 1 :], False)
        # A tuple after a comma, seen from inside a tuple, holds a parenthesis outside quotes.
        alone = self.follows & (opening == 1) & ~self.feeds
        f[alone, OPEN] = BROKEN
        for i in np.flatnonzero(alone):
            f[i, QUOTED] = within_tuple(self.texts[i], True)
        self.heads: dict[int, tuple[bytes, int]] = {}
        for i in np.flatnonzero(array(pc.match_substring(values, "INSERT INTO `"))):
            text = self.texts[i]
            low = text.rfind(b"\n") + 1
            head = head_of(text[low:])
            if head:
                self.heads[int(i)] = (head[0], low + head[1])
                f[i, PLAIN] = within_tuple(text[low + head[1] + 1 :], False)
        f[self.feeds] = f[self.feeds, PLAIN][:, None]
        self.f = f

    def before(self) -> np.ndarray:
        """The states before each piece and after the last one, a column for each state before the first."""
        run = self.f.copy()
        step = 1
        while step < len(run):  # compositions of ever longer runs of pieces
            run[step:] = np.take_along_axis(run[step:], run[:-step].astype(np.intp), axis=1)
            step *= 2
        return np.vstack([np.arange(STATES, dtype=np.int8)[None, :], run])

    def begins(self, states: np.ndarray) -> np.ndarray:
        """Whether each piece begins a tuple that is not ended by a line feed, if it meets these states."""
        out = (states == BETWEEN) & self.follows & ~self.feeds
        for i in self.heads:
            out[i] = self.feeds[i] or states[i] == PLAIN
        return out


class Range:
    """What a range of pieces does from each state: the state it leads to, the tuples begun and the table named since the last line feed."""

    def __init__(self) -> None:
        self.state = list(range(STATES))
        self.tuples = [0] * STATES
        self.table: list[bytes | None] = [None] * STATES
        self.feeds = 0

    def add(self, pieces: Pieces) -> None:
        if not pieces.texts:
            return
        before = pieces.before()
        last = np.flatnonzero(pieces.feeds)
        first = int(last[-1]) if len(last) else 0
        state, tuples, table = [], [], []
        for s in range(STATES):
            at = self.state[s]
            begins = pieces.begins(before[:-1, at])
            named = [i for i in pieces.heads if i >= first and begins[i]]
            state.append(int(before[-1, at]))
            tuples.append(int(begins[first:].sum()) + (0 if len(last) else self.tuples[s]))
            table.append(pieces.heads[named[-1]][0] if named else None if len(last) else self.table[s])
        self.state, self.tuples, self.table = state, tuples, table
        self.feeds += sum(pieces.texts[i].count(b"\n") for i in last)


def scan(ranges: list[dict]) -> list[dict]:
    """State, line, tuples and table at the beginning of each range of a file, and at its end; ranges in order.

    A range is a row ``state, tuples, table`` (lists by state) and ``feeds``.
    """
    at = {"state": PLAIN, "line": 0, "pos": 0, "table": None}
    out = [at]
    for r in ranges:
        s = at["state"]
        at = {
            "state": r["state"][s],
            "line": at["line"] + r["feeds"],
            "pos": r["tuples"][s] + (0 if r["feeds"] else at["pos"]),
            "table": r["table"][s] if r["feeds"] or r["table"][s] is not None else at["table"],
        }
        out.append(at)
    return out

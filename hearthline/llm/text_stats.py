"""Counts over the words and lines of a slice of texts, by numpy on the UTF-8 bytes."""

from __future__ import annotations

from functools import cached_property

import numpy as np

from hearthline.llm.common import SPACE, text_bytes, words


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


SYMBOL = _flags(b"#*$%&|<>")
UPPER = _flags(bytes(range(65, 91)))
LOWER = _flags(bytes(range(97, 123)))
DIGIT = _flags(b"0123456789")
BANG = _flags(b"!")
STOP = _flags(b".!?")
COMMA = _flags(b",;:")
#: Bytes that begin a code point.
LEAD = (np.arange(256) & 0xC0) != 0x80


class TextStats:
    """raw: the bytes of all texts, at: where each begins, and the end."""

    def __init__(self, raw: np.ndarray, at: np.ndarray):
        self.raw, self.at, self.n = raw, at, len(at) - 1
        blank = SPACE[raw]
        begin = ~blank
        begin[1:] &= blank[:-1]
        first = at[:-1][at[:-1] < at[1:]]
        begin[first] = ~blank[first]
        self.word_at = np.flatnonzero(begin)
        self.word_doc = np.searchsorted(at, self.word_at, "right") - 1
        self.n_words = np.bincount(self.word_doc, minlength=self.n)
        newline = np.flatnonzero(raw == 10) + 1
        self.line_at = np.union1d(newline[newline < len(raw)], first)
        line = np.searchsorted(self.line_at, self.word_at, "right") - 1
        #: Lines with a word, numbered through; blank lines are skipped everywhere.
        self.line_id, self.word_line = np.unique(line, return_inverse=True)
        self.line_begin = self.line_at[self.line_id] if len(self.line_id) else np.empty(0, np.int64)
        self.line_doc = np.searchsorted(at, self.line_begin, "right") - 1
        self.n_lines = np.bincount(self.line_doc, minlength=self.n)
        self.blank = blank

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        return self._sums(flags[self.raw])

    def _sums(self, marks: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        return total[self.at[1:]] - total[self.at[:-1]]

    def per_line(self, flags: np.ndarray) -> np.ndarray:
        if not len(self.line_id):
            return np.zeros(0)
        return np.add.reduceat(flags[self.raw].astype(np.int32), self.line_at)[self.line_id].astype(float)

    @cached_property
    def word_chars(self) -> np.ndarray:
        return self._sums(LEAD[self.raw] & ~self.blank)

    @cached_property
    def ids(self) -> np.ndarray:
        """Numbers of the words; equal words of the slice have equal numbers."""
        known: dict[bytes, int] = {}
        number = known.setdefault
        out = np.empty(len(self.word_at), np.int64)
        i = 0
        for text in text_bytes(self.raw, self.at):
            found = words(text)
            out[i : i + len(found)] = [number(w, len(known)) for w in found]
            i += len(found)
        return out

    @cached_property
    def repeated(self) -> np.ndarray:
        """Flags of words that lie in a window of three words found twice or more in their text."""
        ids, doc = self.ids, self.word_doc
        out = np.zeros(len(ids), bool)
        if len(ids) < 3:
            return out
        v = int(ids.max()) + 1
        key = ids[:-2] * v + ids[1:-1]
        if v >= 1 << 21:
            key = np.unique(key, return_inverse=True)[1]
        key = key * v + ids[2:]
        inside = np.flatnonzero(doc[:-2] == doc[2:])
        order = inside[np.lexsort((key[inside], doc[inside]))]
        same = (key[order[1:]] == key[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
        hit = np.zeros(len(order), bool)
        hit[1:] |= same
        hit[:-1] |= same
        for shift in range(3):
            out[order[hit] + shift] = True
        return out

    @cached_property
    def line_is_copy(self) -> np.ndarray:
        """Flags of lines (with a word) that equal an earlier line of their text."""
        flags = []
        for text in text_bytes(self.raw, self.at):
            seen: set[bytes] = set()
            for line in text.split(b"\n"):
                if line.strip():
                    flags.append(line in seen)
                    seen.add(line)
        return np.array(flags, bool)

    def sum_words(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.word_doc, weights=values, minlength=self.n).astype(np.int64)

    def sum_lines(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.line_doc, weights=values, minlength=self.n).astype(np.int64)

    def line_features(self) -> np.ndarray:
        """Per line with a word: shares between 0 and 1 that tell prose from menus, shouting, repeats and signs."""
        n = len(self.line_id)
        if not n:
            return np.zeros((0, N_LINE_FEATURES))
        count = np.bincount(self.word_line, minlength=n).astype(float)
        same = np.zeros(len(self.ids))
        same[1:] = (self.ids[1:] == self.ids[:-1]) & (self.word_line[1:] == self.word_line[:-1])
        upper, lower = self.per_line(UPPER), self.per_line(LOWER)
        size = self.per_line(LEAD)
        last = np.append(self.line_at[1:], len(self.raw))[self.line_id]
        ends = self.word_ends()
        final = np.flatnonzero(np.append(self.word_line[1:] != self.word_line[:-1], True))
        stop = STOP[self.raw[np.minimum(ends[final], last) - 1]]
        columns = [
            np.ones(n),
            np.minimum(1, self.per_line(SYMBOL) / count),
            upper / np.maximum(1, upper + lower),
            np.bincount(self.word_line, weights=self.repeated, minlength=n) / count,
            np.bincount(self.word_line, weights=same, minlength=n) / count,
            self.line_is_copy.astype(float),
            np.minimum(1, self.per_line(BANG) / count),
            np.minimum(1, self.per_line(DIGIT) / np.maximum(1, size)),
            stop.astype(float),
            (count < 3).astype(float),
            np.minimum(1, count / 20),
            np.minimum(1, size / count / 20),
        ]
        return np.stack(columns, axis=1)

    def word_ends(self) -> np.ndarray:
        """Where each word ends."""
        end = self.blank.copy()
        end[1:] &= ~self.blank[:-1]
        stops = np.flatnonzero(end)
        limits = np.union1d(stops, self.at)
        return limits[np.searchsorted(limits, self.word_at, "right")]


N_LINE_FEATURES = 12

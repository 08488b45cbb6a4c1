"""BPE encoding and decoding by speculation: greedy longest match proposes, adjacent pairs are verified.

For a vocabulary with word ends (`</w>`), lower-casing, and a pattern that never spans white space. Each
distinct word is cut into pieces by the pattern; greedy longest match proposes tokens for a piece; one numpy
pass over all adjacent pairs of the batch tests whether exact merging could have joined something across
their border; pieces with a failing pair, and only those, are merged exactly.

Two neighbours a, b are compatible if no merge joins a token x of the right edge of a with a token y of the
left edge of b before x or y is consumed by the merge that built its parent: merge (x, y) must not have a
lower rank than the parents of x and y (at equal rank the merge further left goes first). Tokens that exact
merging of their own characters doesn't produce are never proposed.

Defined cases: null and empty texts have no tokens and decode to the empty text; the control strings of the
file's added tokens are single tokens wherever they occur; repeated rows are encoded each; an empty table
gives no rows; other columns are ignored. Words of any length are encoded whole (exact merging uses a heap).
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import buffers, sha, slices, text_bytes, words

WORD_END = "</w>"
# The white space of the tokenizer file's pattern language.
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{BLANK}\p{{L}}\p{{N}}]+")


# What Unicode 16 added to letters and numbers, which the tokenizers library knows and Python's tables may not.
LETTERS_16 = (
    "\u1c89-\u1c8a\ua7cb-\ua7cd\ua7da-\ua7dc\U000105c0-\U000105f3\U00010d40-\U00010d65\U00010d6f-\U00010d85"
    "\U00010ec2-\U00010ec4\U00011380-\U00011389\U0001138b\U0001138e\U00011390-\U000113b5\U000113b7\U000113d1\U000113d3"
    "\U000116d0-\U000116e3\U00011bc0-\U00011be0\U00011bf0-\U00011bf9\U00013460-\U000143fa\U00016100-\U0001611d"
    "\U00016130-\U00016139\U00016d40-\U00016d6c\U00016d70-\U00016d79\U00018cff\U0001ccf0-\U0001ccf9\U0001e5d0-\U0001e5ed"
    "\U0001e5f0-\U0001e5fa"
)
# Capitals up to Unicode 17, all of which the library lower-cases: first, last, step, distance to the small letter.
CAPITALS_17 = [
    (0x1C89, 0x1C89, 1, 1), (0xA7CB, 0xA7CB, 1, 0x264 - 0xA7CB), (0xA7CC, 0xA7CE, 2, 1), (0xA7D2, 0xA7D4, 2, 1), (0xA7DA, 0xA7DA, 1, 1),
    (0xA7DC, 0xA7DC, 1, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 1, 0x20), (0x16EA0, 0x16EB8, 1, 0x1B),
]
NEWER_SMALL = {c: c + by for first, last, step, by in CAPITALS_17 for c in range(first, last + 1, step)}


@lru_cache(1)
def newer_letters() -> set[str]:
    """Letters and numbers that the regex module knows and the tokenizers library, with the tables of Unicode 16, doesn't."""
    unknown = "".join(c for c in map(chr, range(0x80, 0x110000)) if unicodedata.category(c) == "Cn")
    return set(regex.findall(rf"[\p{{L}}\p{{N}}--[{LETTERS_16}]]", unknown, regex.V1))


def cut(text: str) -> list[str]:
    """The pieces of a text in lower case."""
    if text.isascii() or newer_letters().isdisjoint(text):
        return PIECES.findall(text)
    # For the pattern they are like any sign: cut with a sign in their place.
    found = PIECES.finditer("".join("\u2020" if c in newer_letters() else c for c in text))
    return [text[m.start() : m.end()] for m in found]


NEVER = np.int64(2**62)
#: Stands for the word end in the automaton; the number of an end that no token takes in.
CLOSE, LOOSE = "\0", -1
#: Words whose result a worker remembers, and the longest that it does.
REMEMBERED, LONGEST = 500_000, 100
#: Symbols up to which exact merging looks at all pairs, without a heap.
SHORT = 40


def byte_letters() -> list[str]:
    """The printable character that stands for each byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}
    return [rest.get(b, chr(b)) for b in range(256)]


class Vocabulary:
    """Tables of a tokenizer file (its JSON text)."""

    def __init__(self, text: str):
        file = json.loads(text)
        self.id_of: dict[str, int] = file["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.text_of = {i: t for t, i in (self.id_of | self.specials).items()}
        self.letter_of = dict(enumerate(byte_letters()))
        n = max(self.id_of.values()) + 1
        self.n = n
        merges = np.array([[self.id_of[a], self.id_of[b], self.id_of[a + b]] for a, b in (m if isinstance(m, list) else m.split(" ") for m in file["model"]["merges"])])
        self.rank = {(a, b): (r, c) for r, (a, b, c) in enumerate(merges.tolist())}
        made = np.full(n, NEVER)
        split = np.full((n, 2), -1)
        made[merges[:, 2]] = np.arange(len(merges))
        split[merges[:, 2]] = merges[:, :2]
        key = merges[:, 0] * n + merges[:, 1]
        order = np.argsort(key)
        self.keys, self.key_rank = key[order], order
        self.right, self.left = self._edges(split, made, 1), self._edges(split, made, 0)
        whole = [t for t, i in self.id_of.items() if self.merged(self._symbols(t)) == [i]]
        self.tokens = ahocorasick.Automaton()
        for t in whole:
            self.tokens.add_word(t.replace(WORD_END, CLOSE), self.id_of[t])
        # A piece whose last match leaves its end alone is merged exactly.
        self.tokens.add_word(CLOSE, LOOSE)
        self.tokens.make_automaton()

    def _edges(self, split: np.ndarray, made: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each token the tokens along one edge, from itself inwards, and the rank at which each is consumed."""
        tokens, consumed = [np.arange(self.n)], [np.full(self.n, NEVER)]
        while True:
            now = tokens[-1]
            inner = np.where(now >= 0, split[now, side], -1)
            if (inner < 0).all():
                return np.stack(tokens), np.stack(consumed)
            consumed.append(np.where(inner >= 0, made[now], -1))
            tokens.append(inner)

    def _symbols(self, token: str) -> list[int]:
        body = token.removesuffix(WORD_END)
        chars = list(body)
        if token != body and chars:
            chars[-1] += WORD_END
        return [self.id_of[c] for c in chars or [token]]

    def symbols(self, piece: str) -> list[int]:
        return self._symbols(self.in_letters(piece) + WORD_END)

    def merged(self, ids: list[int]) -> list[int]:
        """Exact merging: the lowest rank first, at equal rank the leftmost."""
        if len(ids) > SHORT:
            return self._merged_by_heap(ids)
        rank, last = self.rank.get, (NEVER, 0)
        ids = list(ids)
        waiting = [rank(p, last) for p in zip(ids, ids[1:])]
        while waiting:
            best = min(waiting)
            if best is last:
                break
            i = waiting.index(best)
            ids[i : i + 2] = [best[1]]
            del waiting[i]
            if i:
                waiting[i - 1] = rank((ids[i - 1], ids[i]), last)
            if i < len(waiting):
                waiting[i] = rank((ids[i], ids[i + 1]), last)
        return ids

    def _merged_by_heap(self, ids: list[int]) -> list[int]:
        n, rank = len(ids), self.rank
        ids, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank[p][0], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in rank]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = rank[pair][1], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (p := (ids[i], ids[k])) in rank:
                    heapq.heappush(heap, (rank[p][0], i, p))
            if (h := before[i]) >= 0 and (p := (ids[h], ids[i])) in rank:
                heapq.heappush(heap, (rank[p][0], h, p))
        return [t for t in ids if t >= 0]

    def in_letters(self, piece: str) -> str:
        """The piece with a letter per byte."""
        return piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self.letter_of)

    def greedy(self, piece: str) -> list[int]:
        """Longest match, from the left; LOOSE at the end if nothing takes the end in."""
        return [t for _, t in self.tokens.iter_long(self.in_letters(piece) + CLOSE)]

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether exact merging leaves the border between each a and b."""
        good = np.ones(len(a), bool)
        (right, spent_x), (left, spent_y) = self.right, self.left
        for i in range(len(right)):
            rows = np.flatnonzero(good & (right[i, a] >= 0))
            if not len(rows):
                break
            x, px = right[i, a[rows]], spent_x[i, a[rows]]
            for j in range(len(left)):
                y = left[j, b[rows]]
                some = y >= 0
                if not some.any():
                    break
                key = x * self.n + y
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                m = np.where(some & (self.keys[at] == key), self.key_rank[at], NEVER)
                good[rows[(m < px) & (m <= spent_y[j, b[rows]])]] = False
        return good

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        guess = [self.greedy(p) for p in pieces]
        flat = np.array([t for g in guess for t in g], np.int64)
        owner = np.repeat(np.arange(len(guess)), [len(g) for g in guess])
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        loose = np.flatnonzero(flat == LOOSE)
        inside = inside[flat[inside + 1] != LOOSE]
        wrong = np.concatenate([loose, inside[~self.compatible(flat[inside], flat[inside + 1])]])
        for k in np.unique(owner[wrong]).tolist():
            guess[k] = self.merged(self.symbols(pieces[k]))
        return guess

    def parts(self, word: str) -> list[str | int]:
        """The pieces of a word without white space; ids where it holds control strings."""
        if "<" in word and any(special in word for special in self.specials):
            at, special = min((word.find(s), s) for s in self.specials if s in word)
            return [*self.parts(word[:at]), self.specials[special], *self.parts(word[at + len(special) :])]
        plain = word if word.isascii() else unicodedata.normalize("NFC", word).replace("Σ", "σ")
        low = plain.lower()
        return cut(low if low.isascii() else low.translate(NEWER_SMALL))

    def decode(self, ids: list[int]) -> str:
        """The file names no decoder, so tokens are joined by a space."""
        return " ".join(map(self.text_of.__getitem__, ids))


class Encoder:
    """Encodes words, remembering the tokens of a bounded number of pieces, and what is written of as many words."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known: dict[str, list[int]] = {}
        self.written: dict[bytes, tuple] = {}

    def encode(self, found: list[bytes]) -> list[list[int]]:
        """Tokens of each word."""
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        split = [self.vocabulary.parts(w.decode()) for w in found]
        new = list({p for parts in split for p in parts if p not in known and isinstance(p, str)})
        fresh = dict(zip(new, self.vocabulary.encode_pieces(new)))
        out = []
        for parts in split:
            ids: list[int] = []
            for p in parts:
                if isinstance(p, int):
                    ids.append(p)
                else:
                    ids += known.get(p) or fresh[p]
            out.append(ids)
        known.update((p, ids) for p, ids in fresh.items() if len(p) <= LONGEST)
        return out


_ENCODERS: dict[int, Encoder] = {}


def bpe_encode(docs: DataFrame, tokenizer_file: str, ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if wanted, ids (array of int) of every document.

    ids_sha256 is of the decimal ids joined by a space, decoded_sha256 of the decoded text. The file (a few
    megabytes) is read on the driver and broadcast.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        shipped = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(shipped.value)
        if key not in _ENCODERS:
            _ENCODERS[key] = Encoder(Vocabulary(shipped.value))
        encoder = _ENCODERS[key]
        text_of = encoder.vocabulary.text_of.__getitem__
        memo = encoder.written
        for batch, text in slices(batches):
            split = [words(t) for t in text_bytes(*buffers(text))]
            if len(memo) > REMEMBERED:
                memo.clear()
            missing = list({w for ws in split for w in ws if w not in memo})
            for w, t in zip(missing, encoder.encode(missing)):
                memo[w] = len(t), " ".join(map(str, t)), " ".join(map(text_of, t)), t
            n, coded, plain, flat = [], [], [], []
            for ws in split:
                rows = [r for r in map(memo.__getitem__, ws) if r[0]]
                n.append(sum([r[0] for r in rows]))
                coded.append(sha(" ".join([r[1] for r in rows])))
                plain.append(sha(" ".join([r[2] for r in rows])))
                if ids:
                    flat.append([t for r in rows for t in r[3]])
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(plain, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                columns.append(pa.array(flat, pa.list_(pa.int32())))
                names.append("ids")
            for w in missing:
                if len(w) > LONGEST:
                    del memo[w]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)

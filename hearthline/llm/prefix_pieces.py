"""SentencePiece encoding and decoding by a table of last tokens.

For BPE models (any two neighbours whose joined text is a piece may merge, best score first, at equal score
the leftmost) with an identity normaliser, a space put in front, and byte fallback. The encoding of every
prefix of a text ends in one token only; an automaton lists the pieces that end at a position, longest first,
and the one is stored that is compatible with the last token of the prefix before it. The ids are then read
off backwards. The time is linear in the text, however long a stretch without spaces is.

Neighbours a, b are compatible if no merge joins a token x of the right edge of a with a token y of the left
edge of b before x or y is consumed by the merge that built its parent: the score of xy must not beat that of
x's parent, and neither beat nor equal that of y's parent. The test is by scores alone, so on loading every
piece must come out of merging its own characters, from parts that don't score worse than itself.

No piece holds a space after another character, so a text is encoded word by word (with the spaces before
it), and the result of a word is remembered up to a bounded number of words. Characters outside the
vocabulary never merge; they become the bytes of their UTF-8 form.

Decoding joins the pieces, spaces restored; runs of byte pieces are read as UTF-8, a byte that doesn't fit
becoming U+FFFD; control ids vanish, and the space that the first piece begins with is dropped.

Defined cases: null and empty texts have the end id only and decode to the empty text; U+2581 in a text is a
space; repeated rows are encoded each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from hearthline.llm.common import sha, slices

SPACE_MARK = "▁"
#: Consumed by no merge; the token before the first.
NEVER, FIRST = 2**62, -1
#: Words whose tokens a worker remembers, the longest that it does, and pairs whose test it remembers.
REMEMBERED, LONGEST, PAIRS = 500_000, 100, 1_000_000
# Piece types of the model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
_WORD = re.compile(r" *[^ \n\t]+|[\n\t]| +")


class Pieces:
    """Tables of a model file (its bytes)."""

    def __init__(self, model: bytes):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        trainer, normal = proto.trainer_spec, proto.normalizer_spec
        plain = not normal.precompiled_charsmap and normal.add_dummy_prefix and not normal.remove_extra_whitespaces and normal.escape_whitespaces
        kinds = [p.type for p in proto.pieces]
        if trainer.model_type != trainer.BPE or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix or not plain:
            raise ValueError("a BPE model with byte fallback, identity normaliser and a space in front is needed")
        if not set(kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("user-defined and unused pieces aren't supported")
        self.end = trainer.eos_id
        self.text_of = [p.piece for p in proto.pieces]
        self.kinds = kinds
        self.unknown_text = trainer.unk_surface
        self.id_of = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.byte_id = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        worse_first, place = np.unique([-p.score for p in proto.pieces], return_inverse=True)
        self.rank = place.tolist()
        self.characters = {t for t in self.id_of if len(t) == 1}
        if any(SPACE_MARK in t.lstrip(SPACE_MARK) for t in self.id_of) or any(not self.characters.issuperset(t) for t in self.id_of):
            raise ValueError("a piece spans words, or has a character that is no piece")
        self.split: dict[int, tuple[int, int]] = {}
        for t, i in self.id_of.items():
            if len(t) > 1:
                ids, parts = self._merged([self.id_of[c] for c in t])
                if ids != [i] or any(p in self.split and self.rank[p] > self.rank[i] for p in parts):
                    raise ValueError(f"merging doesn't build the piece {t!r} in the order of scores")
                self.split[i] = parts
        # (x, rank of the merge that consumes x) from a token inwards along its right and its left edge.
        self.right = [self._edge(i, 1) for i in range(len(kinds))]
        self.left = [self._edge(i, 0) for i in range(len(kinds))]
        self.ending = ahocorasick.Automaton()
        for t, i in self.id_of.items():
            self.ending.add_word(t, (i, len(t)))
        self.ending.make_automaton()
        self.known_pairs: dict[int, bool] = {}
        self.n = len(kinds)

    def joined(self, x: int, y: int) -> int:
        """The rank of the merge of x and y, NEVER if there is none."""
        i = self.id_of.get(self.text_of[x] + self.text_of[y])
        return NEVER if i is None else self.rank[i]

    def _merged(self, ids: list[int]) -> tuple[list[int], tuple[int, int]]:
        """Exact merging of a few tokens, and the two that the last merge joined."""
        parts = (-1, -1)
        waiting = [self.joined(x, y) for x, y in zip(ids, ids[1:])]
        while waiting and (best := min(waiting)) < NEVER:
            i = waiting.index(best)
            parts = ids[i], ids[i + 1]
            ids[i : i + 2] = [self.id_of[self.text_of[parts[0]] + self.text_of[parts[1]]]]
            del waiting[i]
            if i:
                waiting[i - 1] = self.joined(ids[i - 1], ids[i])
            if i < len(waiting):
                waiting[i] = self.joined(ids[i], ids[i + 1])
        return ids, parts

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        out = [(token, NEVER)]
        while token in self.split:
            consumed, token = self.rank[token], self.split[token][side]
            out.append((token, consumed))
        return out

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging leaves the border between a and b."""
        for x, spent_x in self.right[a]:
            for y, spent_y in self.left[b]:
                m = self.joined(x, y)
                if m < spent_x and m <= spent_y and m < NEVER:
                    return False
        return True

    def _last_tokens(self, word: str) -> list[int | None]:
        """Of every prefix the last token of its encoding."""
        known, n, compatible = self.known_pairs, self.n, self.compatible
        last: list[int | None] = [None] * (len(word) + 1)
        last[0] = FIRST
        for at, (token, size) in self.ending.iter(word):
            if last[at + 1] is not None:
                continue
            before = last[at + 1 - size]
            if before != FIRST:
                pair = before * n + token
                good = known.get(pair)
                if good is None:
                    good = known[pair] = compatible(before, token)
                if not good:
                    continue
            last[at + 1] = token
        return last

    def _encode_known(self, word: str) -> list[int]:
        last = self._last_tokens(word)
        ids, at = [], len(word)
        while at:
            ids.append(last[at])
            at -= len(self.text_of[last[at]])
        return ids[::-1]

    def encode_word(self, word: str) -> list[int]:
        """Ids of a word with the spaces before it."""
        if len(self.known_pairs) > PAIRS:
            self.known_pairs.clear()
        word = word.replace(" ", SPACE_MARK)
        if self.characters.issuperset(word):
            return self._encode_known(word)
        ids, begin = [], 0
        for at, c in enumerate(word):
            if c not in self.characters:
                ids += self._encode_known(word[begin:at]) if at > begin else []
                ids += [self.byte_id[b] for b in c.encode()]
                begin = at + 1
        return ids + (self._encode_known(word[begin:]) if begin < len(word) else [])

    @staticmethod
    def words(text: str) -> list[str]:
        """What is encoded on its own: words with the spaces before them, line ends, tabs."""
        return _WORD.findall(" " + text.replace(SPACE_MARK, " ")) if text else []

    def joined_text(self, ids: list[int]) -> str:
        """The pieces' text, the space at the front left in."""
        out, raw = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(_utf8(raw))
                raw = bytearray()
            if self.kinds[i] == NORMAL:
                out.append(self.text_of[i].replace(SPACE_MARK, " "))
            elif self.kinds[i] == UNKNOWN:
                out.append(self.unknown_text)
        if raw:
            out.append(_utf8(raw))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text, without the space that the first piece may begin with."""
        text = self.joined_text(ids)
        first = next((self.kinds[i] for i in ids if self.kinds[i] != CONTROL), None)
        return text.removeprefix(" ") if first == NORMAL else text


def _utf8(raw: bytearray) -> str:
    """Bytes as text, every byte that isn't part of a character as U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + size].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            size = 1
        at += size
    return "".join(out)


class Encoder:
    """Encodes texts; remembers of a bounded number of words the tokens, as ids, as written, and as text."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.known: dict[str, tuple[int, str, str, list[int]]] = {}

    def encode(self, text: str) -> list[tuple[int, str, str, list[int]]]:
        known, out = self.known, []
        for word in self.pieces.words(text):
            row = known.get(word)
            if row is None:
                ids = self.pieces.encode_word(word)
                row = len(ids), " ".join(map(str, ids)), self.pieces.joined_text(ids), ids
                if len(word) <= LONGEST:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[word] = row
            out.append(row)
        return out


_ENCODERS: dict[int, Encoder] = {}


def piece_encode(docs: DataFrame, model_file: str, ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if wanted, ids (array of int) of every document.

    The end id closes every document. ids_sha256 is of the decimal ids joined by a space, decoded_sha256 of
    the decoded text. The file (half a megabyte) is read on the driver and broadcast.
    """
    with open(model_file, "rb") as file:
        shipped = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(shipped.value)
        if key not in _ENCODERS:
            _ENCODERS[key] = Encoder(Pieces(shipped.value))
        encoder = _ENCODERS[key]
        end = encoder.pieces.end
        for batch, text in slices(batches):
            n, coded, plain, flat = [], [], [], []
            for t in text.to_pylist():
                rows = encoder.encode(t)
                n.append(sum([r[0] for r in rows]) + 1)
                coded.append(sha(" ".join([r[1] for r in rows] + [str(end)])))
                plain.append(sha("".join([r[2] for r in rows]).removeprefix(" ")))
                if ids:
                    flat.append([i for r in rows for i in r[3]] + [end])
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(plain, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                columns.append(pa.array(flat, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)

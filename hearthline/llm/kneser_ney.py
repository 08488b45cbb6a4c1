"""Language-model scoring: an interpolated modified Kneser-Ney bigram model, counted in Spark, memory-mapped by workers.

Counting takes two passes. The first counts words by 64-bit hash; the sorted hashes are the vocabulary, and a
word's number is its rank. The second counts pairs (previous word, word) as one 64-bit key. Map tasks add up
what they have read and send sorted arrays, cut into buckets, so that a frequent word or pair costs one entry
per task; a pair's bucket follows from its first word, or, if that word has more than a quarter of a bucket's
share of all tokens, from the whole pair. Each bucket is written as sorted arrays (.npy) below `model_dir`, a
folder that the whole cluster shares and mounts; scoring workers map these files and look the distinct keys of
a batch up by binary search, so no worker loads the model.

    p(w | v) = max(c(v w) - D(c), 0) / c(v .) + g(v) * p1(w)
    p1(w) = max(n(. w) - D'(n), 0) / n(. .) + g' / (V + 1)

n(. w) is the number of different words before w; D and D' are the modified discounts for counts of 1, 2 and
3 or more from the counts of counts; g and g' are what the discounts set free; the last term is uniform over
the V words and one unknown. After an unknown word p(w | v) = p1(w).

Words are runs other than space and 0x09-0x0D of the text with A-Z in lower case; every document ends in one
end token, which is predicted and counted; the beginning is a context only.

Defined cases: null and empty texts are the end token alone; without training documents N and V are 0 and all
scores are 0; repeated rows count and are scored each; a null id counts as the empty text in the fold; an
empty table gives no rows; other columns are ignored. Words whose 64-bit hashes agree would count as one.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.llm.common import WordHashes, buffers, doc_bucket, mix64, slices, text_bytes, words
from hearthline.session import shared_dir

#: A word may not hold a newline, so this can't be one.
END = b"\n"
#: Characters of text per bucket of the model, entries that a map task gathers before it sends, bytes per batch.
BUCKET_CHARS, GATHERED, BATCH_BYTES = 24_000_000, 3_000_000, 4_000_000


def mounted(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below spark.checkpoint.dir as a plain path; it has to be on a file system that all workers mount."""
    path = shared_dir(spark, purpose)
    scheme, colon, rest = path.partition(":")
    if colon and scheme != "file":
        raise ValueError(f"memory-mapped files need a mounted folder, not {path}; name one in model_dir")
    return "/" + rest.lstrip("/") if colon else path


def _save(folder: str, name: str, array: np.ndarray) -> None:
    """Written under a name of its own first: a repeated task replaces the file by the same bytes."""
    os.makedirs(folder, exist_ok=True)
    own = f"{folder}/.{name}-{uuid.uuid4().hex}.npy"
    np.save(own, array)
    os.replace(own, f"{folder}/{name}.npy")


def _add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


def _counts_of_counts(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:5].tolist()


def discounts(n: list[int]) -> np.ndarray:
    """What counts of 0, 1, 2 and 3 or more lose; n: how many counts are 1, 2, 3 and 4."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    out = [0.0]
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.0
        out.append(min(max(d, 0.05), k - 0.05))
    return np.array(out)


@dataclass
class Model:
    """Where the files are, and the totals. offsets: the first word number of each vocabulary bucket, and V."""

    folder: str
    buckets: int
    offsets: np.ndarray
    tokens: int
    hot: np.ndarray
    pair_discount: np.ndarray
    word_discount: np.ndarray
    types: int
    word_classes: list[int]

    @property
    def words(self) -> int:
        return int(self.offsets[-1])

    def array(self, kind: str, bucket: int) -> np.ndarray | None:
        return _mapped(f"{self.folder}/{kind}-{bucket}.npy")

    # --- vocabulary

    def number(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers (-1: unknown) and counts of sorted hashes."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for b, rows in _runs(vocabulary_bucket(hashes, self.buckets)):
            known = self.array("hash", b)
            if known is None:
                continue
            at = np.minimum(np.searchsorted(known, hashes[rows]), len(known) - 1)
            hit = known[at] == hashes[rows]
            ids[rows] = np.where(hit, at + self.offsets[b], -1)
            counts[rows] = np.where(hit, self.array("count", b)[at], 0)
        return ids, counts

    def by_word(self, kind: str, ids: np.ndarray) -> np.ndarray:
        """Values of an array that has an entry (or a row) per word; ids sorted."""
        bucket = np.minimum(np.searchsorted(self.offsets, ids, "right") - 1, self.buckets - 1)
        out = None
        for b, rows in _runs(bucket):
            values = self.array(kind, b)[ids[rows] - self.offsets[b]]
            if out is None:
                out = np.zeros((len(ids), *values.shape[1:]), values.dtype)
            out[rows] = values
        return out if out is not None else np.zeros(0)

    # --- pairs

    def pair_bucket(self, keys: np.ndarray) -> np.ndarray:
        first = keys >> np.uint64(32)
        of_pair = np.isin(first, self.hot)
        return (mix64(np.where(of_pair, keys, first)) % np.uint64(self.buckets)).astype(np.int64)

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted keys."""
        bucket = self.pair_bucket(keys)
        order = np.argsort(bucket, kind="stable")
        out = np.zeros(len(keys), np.int64)
        for b, rows in _runs(bucket[order]):
            known = self.array("pair", b)
            if known is None:
                continue
            at = order[rows]
            place = np.minimum(np.searchsorted(known, keys[at]), len(known) - 1)
            out[at] = np.where(known[place] == keys[at], self.array("paircount", b)[place], 0)
        return out

    def log10(self, previous: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 p(word | previous); numbers of words, -1 unknown; previous may be V, the beginning."""
        uniform = 1 / (self.words + 1)
        if not self.types:
            return np.full(len(word), np.log10(uniform))
        free1 = float(self.word_discount[1:] @ self.word_classes) / self.types
        ids, inverse = np.unique(word, return_inverse=True)
        known = ids >= 0
        p1 = np.full(len(ids), free1 * uniform)
        n = self.by_word("before", ids[known]).astype(float)
        p1[known] += np.maximum(0, n - self.word_discount[np.minimum(n, 3).astype(int)]) / self.types
        p1 = p1[inverse]
        ids, inverse = np.unique(previous, return_inverse=True)
        known = ids >= 0
        follow, free = np.zeros(len(ids)), np.ones(len(ids))
        stats = self.by_word("context", ids[known]).astype(float)
        if len(stats):
            follow[known] = stats[:, 0]
            free[known] = (stats[:, 1:] @ self.pair_discount[1:]) / stats[:, 0]
        follow, free = follow[inverse], free[inverse]
        both = (previous >= 0) & (word >= 0)
        keys, inverse = np.unique(pair_key(previous[both], word[both]), return_inverse=True)
        count = self.pair_counts(keys)[inverse].astype(float)
        p = free * p1
        p[both] += np.maximum(0, count - self.pair_discount[np.minimum(count, 3).astype(int)]) / follow[both]
        return np.log10(p)


@lru_cache(50_000)
def _mapped(path: str) -> np.ndarray | None:
    return np.load(path, mmap_mode="r") if os.path.exists(path) else None


def _runs(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(value, slice) of each run of equal values in a sorted array."""
    if len(bucket):
        first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(bucket)]):
            yield int(bucket[a]), slice(a, b)


def vocabulary_bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of hashes, so that the buckets one after another are in order."""
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def pair_key(previous: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (previous.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64)


class Tokens:
    """Hashes of the tokens of all texts of a batch, each text with its end, and where each begins."""

    def __init__(self, hashes: WordHashes, column: pa.Array):
        split = [words(t.lower()) for t in text_bytes(*buffers(column))]
        self.length = np.array([len(s) + 1 for s in split], np.int64)
        flat = [w for s in split for w in (*s, END)]
        self.hash = hashes(flat)
        self.begin = np.cumsum(self.length) - self.length

    def previous(self, ids: np.ndarray, beginning: int) -> np.ndarray:
        out = np.empty_like(ids)
        out[1:] = ids[:-1]
        out[self.begin] = beginning
        return out


BLOBS = "bucket int, once binary, keys binary, counts binary"
FIGURES = "bucket int, n long, total long, n1 long, n2 long, n3 long, n4 long"


def _blobs(keys: np.ndarray, counts: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch:
    """A row per bucket; what was counted once is sent without the count."""
    order = np.argsort(bucket, kind="stable")
    rows = []
    for b, run in _runs(bucket[order]):
        k, c = keys[order[run]], counts[order[run]]
        rows.append((b, k[c == 1].tobytes(), k[c > 1].tobytes(), c[c > 1].astype(np.uint32).tobytes()))
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["bucket", "once", "keys", "counts"])


def _gathered(table: pa.Table, kind: type) -> tuple[int, np.ndarray, np.ndarray]:
    def join(name: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

    once, keys, counts = join("once", kind), join("keys", kind), join("counts", np.uint32)
    keys, counts = _add_up(np.concatenate([once, keys]), np.concatenate([np.ones(len(once), np.int64), counts.astype(np.int64)]))
    return table.column("bucket")[0].as_py(), keys, counts


def _figures(bucket: int, keys: np.ndarray, counts: np.ndarray) -> pa.Table:
    row = [bucket, len(keys), int(counts.sum()), *_counts_of_counts(counts)]
    names = ["bucket", "n", "total", "n1", "n2", "n3", "n4"]
    return pa.table({n: pa.array([v], pa.int32() if n == "bucket" else pa.int64()) for n, v in zip(names, row)})


def _counted(docs: DataFrame, keys_of, bucket_of) -> DataFrame:
    """Blobs of the keys that `keys_of` finds in batches of texts, added up over what a task gathers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, n = WordHashes(), [], 0

        def send() -> pa.RecordBatch:
            keys, counts = _add_up(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
            held.clear()
            return _blobs(keys, counts, bucket_of(keys))

        for _, column in slices(batches, most=BATCH_BYTES):
            keys = keys_of(Tokens(hashes, column))
            held.append(np.unique(keys, return_counts=True))
            n += len(held[-1][0])
            if n > GATHERED:
                yield send()
                n = 0
        if held:
            yield send()

    return docs.select("text").mapInArrow(run, BLOBS)


def count_model(train: DataFrame, model_dir: str | None = None, bucket_chars: int = BUCKET_CHARS) -> Model:
    """Counts the model over the texts of `train` and writes its files."""
    folder = model_dir or mounted(train.sparkSession, "kneser-ney")
    chars = train.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(4, -(-chars // bucket_chars))

    def words_of(table: pa.Table) -> pa.Table:
        b, keys, counts = _gathered(table, np.uint64)
        _save(folder, f"hash-{b}", keys)
        _save(folder, f"count-{b}", counts)
        return _figures(b, keys, counts)

    found = _counted(train, lambda t: t.hash, lambda k: vocabulary_bucket(k, buckets)).groupBy("bucket").applyInArrow(words_of, FIGURES).collect()
    sizes = np.zeros(buckets, np.int64)
    for r in found:
        sizes[r.bucket] = r.n
    offsets = np.append(0, np.cumsum(sizes))
    tokens = sum(r.total for r in found)
    model = Model(folder, buckets, offsets, tokens, np.empty(0, np.uint64), np.zeros(4), np.zeros(4), 0, [0, 0, 0])
    if not tokens:
        return model
    if model.words >= 2**32 - 1:
        raise ValueError("word numbers have 32 bits")

    # Words that begin more than a quarter of a bucket's share of all pairs; there are at most 4 * buckets.
    limit = tokens / (4 * buckets)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.column("id").to_pylist():
                counts = model.array("count", b)
                if counts is not None:
                    hit = np.flatnonzero(counts > limit) + offsets[b]
                    yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64())], ["id"])

    spark = train.sparkSession
    ids = spark.range(buckets, numPartitions=min(buckets, 64)).mapInArrow(frequent, "id long").collect()
    model.hot = np.array(sorted([r.id for r in ids] + [model.words]), np.uint64)  # the beginning is one of them

    def pairs_of(t: Tokens) -> np.ndarray:
        distinct, inverse = np.unique(t.hash, return_inverse=True)
        word = model.number(distinct)[0][inverse]
        return pair_key(t.previous(word, model.words), word)

    def write_pairs(table: pa.Table) -> pa.Table:
        """Also sends on what this bucket knows of contexts (4 counts) and of words (how many words stand before)."""
        b, keys, counts = _gathered(table, np.uint64)
        _save(folder, f"pair-{b}", keys)
        _save(folder, f"paircount-{b}", counts.astype(np.uint32) if counts.max() < 2**32 else counts)
        first = (keys >> np.uint64(32)).astype(np.int64)
        at = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
        per = [np.add.reduceat(v, at) for v in (counts, counts == 1, counts == 2, counts >= 3)]
        context = np.stack([first[at], *(p.astype(np.int64) for p in per)], axis=1)
        word, before = np.unique((keys & np.uint64(2**32 - 1)).astype(np.int64), return_counts=True)
        out = []
        for kind, table_ in (("context", context), ("before", np.stack([word, before], axis=1))):
            home = np.minimum(np.searchsorted(offsets, table_[:, 0], "right") - 1, buckets - 1)
            out += [(kind, h, b, _packed(table_[run])) for h, run in _runs(home)]
        out.append(("figures", -1, b, np.array(_counts_of_counts(counts), np.int64).tobytes()))
        return pa.table({"kind": [r[0] for r in out], "home": pa.array([r[1] for r in out], pa.int32()), "bucket": pa.array([r[2] for r in out], pa.int32()), "data": pa.array([r[3] for r in out], pa.binary())})

    def write_words(table: pa.Table) -> pa.Table:
        kind, home = table.column("kind")[0].as_py(), table.column("home")[0].as_py()
        width = 5 if kind == "context" else 2
        data = table.column("data").to_pylist()
        if kind == "figures":
            sums = sum(np.frombuffer(d, np.int64) for d in data).tolist()
            return pa.table({"kind": [kind], "total": pa.array([0], pa.int64()), "n": pa.array([[*sums]], pa.list_(pa.int64()))})
        size = int(offsets[home + 1] - offsets[home]) + (home == buckets - 1)
        values = np.zeros((size, width - 1), np.int64)
        for d in data:
            part = _unpacked(d, width)
            values[part[:, 0] - offsets[home]] += part[:, 1:]
        _save(folder, f"{kind}-{home}", values if kind == "context" else values[:, 0])
        low = values[:, 0]
        classes = [*_counts_of_counts(low[low > 0]), int((low >= 3).sum())]
        return pa.table({"kind": [kind], "total": pa.array([int(low.sum())], pa.int64()), "n": pa.array([classes], pa.list_(pa.int64()))})

    pairs = _counted(train, pairs_of, model.pair_bucket).groupBy("bucket").applyInArrow(write_pairs, "kind string, home int, bucket int, data binary")
    parts = pairs.groupBy("kind", "home").applyInArrow(write_words, "kind string, total long, n array<long>").collect()
    model.pair_discount = discounts(next(r.n for r in parts if r.kind == "figures"))
    before = [r for r in parts if r.kind == "before"]
    n = np.sum([r.n for r in before], axis=0).tolist()
    model.types = sum(r.total for r in before)
    model.word_discount = discounts(n[:4])
    model.word_classes = [n[0], n[1], n[4]]
    return model


def _packed(table: np.ndarray) -> bytes:
    """Rows of numbers; four bytes each where all are small."""
    small = table.max() < 2**32
    return bytes([int(small)]) + table.astype(np.uint32 if small else np.int64).tobytes()


def _unpacked(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, np.uint32 if data[0] else np.int64, offset=1).reshape(-1, width).astype(np.int64)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(docs: DataFrame, model: Model, held_out: F.Column) -> DataFrame:
    """Counts and log10 probabilities of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch, column in slices(batches, most=BATCH_BYTES):
            t = Tokens(hashes, column)
            distinct, inverse = np.unique(t.hash, return_inverse=True)
            ids, counts = model.number(distinct)
            word, count = ids[inverse], counts[inverse]
            base = np.log10((count + 1) / (model.tokens + model.words + 1))
            log = model.log10(t.previous(word, model.words), word)
            columns = [
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array(t.length),
                pa.array(np.add.reduceat((count > 0).astype(np.int64), t.begin)),
                pa.array(np.full(len(t.length), model.tokens, np.int64)),
                pa.array(np.add.reduceat(base, t.begin)),
                pa.array(np.add.reduceat(log, t.begin)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    return picked.mapInArrow(run, SCORES)


def kneser_ney_scores(docs: DataFrame, folds: int = 7, fold: int = 2, model_dir: str | None = None, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """Scores of all documents by the model of those whose crc32 mod `folds` isn't `fold`."""
    held_out = doc_bucket("doc_id", folds) == fold
    model = count_model(docs.where(~held_out), model_dir, bucket_chars)
    return score_documents(docs, model, held_out)

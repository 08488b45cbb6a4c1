"""Helpers the operators share: tables, Arrow text buffers, bounded slices of a batch."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy step works on; a longer text is a slice of its own.
SLICE_BYTES = 2_000_000

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: 256 flags: the bytes 0x20 and 0x09-0x0D, which end words.
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def words(text: bytes) -> list[bytes]:
    """Runs of bytes other than space and 0x09-0x0D."""
    return text.split()


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode("utf-8") if isinstance(data, str) else data).hexdigest()


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The column as strings without nulls (a null is an empty text)."""
    column = batch.column(batch.schema.get_field_index(name))
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    return pc.fill_null(column, "")


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a large_string column and the offsets of its texts, counted from 0."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, at - at[0]


def slices(batches: Iterator[pa.RecordBatch], name: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Consecutive rows with at most `most` bytes of text (one row, if its text alone is longer)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = text_column(batch, name)
        _, at = buffers(column)
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(at, at[begin] + most, "right")) - 1)
            yield batch.slice(begin, end - begin), column.slice(begin, end - begin)
            begin = end


def text_bytes(raw: np.ndarray, at: np.ndarray) -> list[bytes]:
    whole = raw.tobytes()
    return [whole[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


class WordHashes:
    """64-bit hashes of words, remembered up to a bounded number of words."""

    def __init__(self, most: int = 400_000):
        self.most, self.known = most, {}

    def __call__(self, tokens: list[bytes]) -> np.ndarray:
        known, blake = self.known, hashlib.blake2b
        if len(known) > self.most:
            known.clear()
        for w in set(tokens).difference(known):
            known[w] = int.from_bytes(blake(w, digest_size=8).digest(), "little")
        return np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))


def doc_bucket(column: str, n: int) -> F.Column:
    """crc32 of the id as text, modulo n (null ids: remainder of the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % n


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, where: F.Column | None = None) -> DataFrame:
    """(doc_id, text, label) of at most `per_class` labelled documents of either class, the same ones each time.

    The ids are chosen from the label table alone, by a hash; so the join may broadcast them: there are
    at most 2 * per_class. Of an id that is labelled twice the smaller label counts. Of the rows that repeat
    an id one text counts, that with the smallest hash; so the result has at most 2 * per_class rows too.
    """
    known = labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    if where is not None:
        known = known.where(where)
    rows = []
    for value in (0, 1):
        rows += known.where(F.col("label") == value).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect()
    picked = {}
    for r in rows:
        picked[r.doc_id] = min(r.label, picked.get(r.doc_id, r.label))
    ids = docs.sparkSession.createDataFrame(sorted(picked.items()), "doc_id long, label int")
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("doc_id", "text", "label")

"""Mixing sources to target weights by fixed-length blocks of words.

The words of a source, document after document, are packed into blocks of `block_words`. The mix has a
slot per block that it takes. Every output shard draws how many of its slots go to which source from a
multinomial over what the sources still have to give; slot j of a source maps to block p(j mod n) of its n
blocks, where p is a pseudorandom permutation of the indices, another one for each epoch j div n; and the
blocks are joined to the slots by (source, index). Slots are counted in words: the last block of a source can be
short, so the epochs that the target holds whole have all n slots, and the epoch after them has slots until the
words that remain are taken. The last slot of a source may take only the first words of its block, so that the
source comes to its target, rounded to whole words.

Targets: sources in code point order, null last, weigh 3, 1, 2, 3, 1, 2, ... and share `epochs_total` times
all words; no source gets more than `most` times its own words, and what is cut off there goes to the others
by weight. A block is used at most `most` times (an integer), hence no document exceeds `most` times its size.

Only one row per source, and the draws of shards x sources, reach the driver; neither grows with the rows.
The order of packing is (hash bucket, doc_id, hash of the text), so reruns agree whatever the partitioning.

Defined cases: a null or empty text has size 0 and takes nothing; a null source is a source of its own, other
than the empty name; rows with equal doc_id are separate documents; an empty table gives an empty mix; null
ids are kept; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.common import buffers, mix64, slices, text_bytes
from hearthline.llm.text_stats import TextStats
from hearthline.session import staged

WEIGHTS = [3, 1, 2]
#: Documents whose places in the packing one task works out together.
ROWS_PER_BUCKET = 2_000
#: Slots that one row of the work list stands for.
SLOTS_PER_ROW = 50_000
#: Tasks that number slots, at most.
MOST_TASKS = 10_000


def target_sizes(sizes: list[int], epochs_total: float = 1.5, most: int = 2) -> list[float]:
    """Targets of the sources, in their order; see the module text."""
    target, rest = [0.0] * len(sizes), epochs_total * sum(sizes)
    open_ = {i for i, s in enumerate(sizes) if s > 0}
    while open_:
        share = rest / sum(WEIGHTS[i % 3] for i in open_)
        above = {i for i in open_ if share * WEIGHTS[i % 3] > most * sizes[i]}
        if not above:
            for i in open_:
                target[i] = share * WEIGHTS[i % 3]
            break
        for i in above:
            target[i] = float(most * sizes[i])
            rest -= target[i]
        open_ -= above
    return target


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1, chosen by key: four Feistel rounds, walked until the value is below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(todo):
            x = out[todo]
            left, right = x >> np.uint64(half), x & mask
            for r in range(4):
                salt = np.uint64((key * 4 + r + 1) * 0x9E3779B97F4A7C15 % 2**64)
                left, right = right, left ^ (mix64(right + salt) & mask)
            out[todo] = (left << np.uint64(half)) | right
            todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def place_of(value: int, n: int, key: int) -> int:
    """The index that `permuted` maps to the value: its rounds backwards."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        for r in reversed(range(4)):
            salt = (key * 4 + r + 1) * 0x9E3779B97F4A7C15
            left, right = right ^ (int(mix64(np.array([(left + salt) % 2**64], np.uint64))[0]) & mask), left
        value = (left << half) | right
        if value < n:
            return value


def last_epoch(take: int, size: int, block_words: int, key: int) -> tuple[int, int, int]:
    """(slots, words, place) of the epoch after the whole ones: it takes `words` words by `slots` slots, of which
    slot `place` has the source's last block. `key` is that of the epoch's permutation."""
    if not size or not take % size:
        return 0, 0, 0
    words, blocks = take % size, -(-size // block_words)
    place = place_of(blocks - 1, blocks, key)
    short = blocks * block_words - size
    slots = -(-words // block_words)
    return (slots if slots <= place else max(place + 1, -(-(words + short) // block_words))), words, place


def draw_counts(quotas: np.ndarray, n_shards: int, seed: int) -> np.ndarray:
    """Slots of each shard from each source [shards, sources]; the columns add up to the quotas."""
    rest, out = quotas.astype(np.int64).copy(), np.zeros((n_shards, len(quotas)), np.int64)
    total = int(rest.sum())
    for shard in range(n_shards):
        rng = np.random.default_rng([seed, shard])
        need = (shard + 1) * total // n_shards - shard * total // n_shards
        while need > 0:
            got = np.minimum(rng.multinomial(need, rest / rest.sum()), rest)
            out[shard] += got
            rest -= got
            need -= int(got.sum())
    return out


def order_key(seed: int, source: int, epoch: int) -> int:
    return seed + 1_000_003 * source + epoch


@dataclass
class Mix:
    """documents: a row each with key, size and place; slots: a row for each block taken; pieces: their join."""

    documents: DataFrame
    slots: DataFrame
    pieces: DataFrame


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, text_hash) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, text in slices(batches):
            n = TextStats(*buffers(text)).n_words
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), pa.array(n, pa.int64()), batch.column("text_hash")], ["doc_id", "source", "size", "text_hash"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text", F.xxhash64("text").alias("text_hash"))
    return picked.mapInArrow(run, "doc_id long, source string, size long, text_hash long")


def plan_mix(docs: DataFrame, block_words: int = 128, n_shards: int = 64, epochs_total: float = 1.5, most: int = 2, seed: int = 20240501) -> Mix:
    """documents (doc_id, source, text_hash, size, s, source_size, target, start), slots (shard, slot, s, block,
    epoch, words) and pieces (document columns, shard, slot, epoch, lo, hi): words lo..hi of a document that a slot takes."""
    spark = docs.sparkSession
    rows = staged(sized(docs), "mix-sizes")
    totals = {r.source: (r.size, r.n) for r in rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()}
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    sizes = [int(totals[s][0]) for s in names]
    targets = target_sizes(sizes, epochs_total, most)
    n_buckets = max(1, -(-sum(n for _, n in totals.values()) // ROWS_PER_BUCKET))

    sources = spark.createDataFrame([(i, s, sizes[i], targets[i]) for i, s in enumerate(names)], "s int, name string, source_size long, target double")
    bucket = F.pmod(F.xxhash64("text_hash", F.coalesce("doc_id", F.lit(-1))), F.lit(n_buckets))
    rows = rows.join(sources, F.col("source").eqNullSafe(F.col("name"))).drop("name").withColumn("bucket", bucket)
    before = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    heads = rows.groupBy("s", "bucket").agg(F.sum("size").alias("n")).select("s", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("head"))
    within = Window.partitionBy("s", "bucket").orderBy(F.col("doc_id").asc_nulls_last(), "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(heads, ["s", "bucket"]).withColumn("start", F.col("head") + F.coalesce(F.sum("size").over(within), F.lit(0))).drop("head", "bucket")
    placed = staged(placed, "mix-placed")

    takes = [int(round(t)) for t in targets]
    blocks = [-(-s // block_words) for s in sizes]
    ends = [last_epoch(t, n, block_words, order_key(seed, s, t // n if n else 0)) for s, (t, n) in enumerate(zip(takes, sizes))]
    quotas = np.array([t // max(1, n) * b + e[0] for t, n, b, e in zip(takes, sizes, blocks, ends)], np.int64)
    counts = draw_counts(quotas, n_shards, seed)
    firsts = np.cumsum(counts, axis=0) - counts
    work = [(k, int(s), int(firsts[k, s]), int(counts[k, s]), blocks[s], sizes[s], takes[s] // sizes[s], *ends[s][1:]) for k in range(n_shards) for s in np.flatnonzero(counts[k])]
    work = spark.createDataFrame(work, "shard int, s int, first long, n long, blocks long, size long, whole long, rest long, place long")
    step = F.lit(SLOTS_PER_ROW).cast("long")
    work = work.withColumn("skip", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, step)))

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                slot = np.arange(r.skip, min(r.n, r.skip + SLOTS_PER_ROW))
                j = r.first + slot
                epoch, block = j // r.blocks, np.empty(len(j), np.int64)
                for e in np.unique(epoch):
                    at = epoch == e
                    block[at] = permuted(j[at] % r.blocks, r.blocks, order_key(seed, r.s, int(e)))
                # Words of the slot's block, and of the last epoch's slots before it.
                own = np.minimum(block_words, r.size - block * block_words)
                i = j - r.whole * r.blocks
                before = i * block_words - (r.blocks * block_words - r.size) * (i > r.place)
                words = np.where(epoch < r.whole, own, np.minimum(own, r.rest - before))
                yield pd.DataFrame({"shard": r.shard, "slot": slot, "s": r.s, "block": block, "epoch": epoch, "words": words})

    # As many tasks as there is work, and a table whose size the planner knows: slots grow with the corpus.
    n_tasks = max(1, min(MOST_TASKS, int((-(-counts // SLOTS_PER_ROW)).sum())))
    numbered = work.repartition(n_tasks, "shard", "s", "skip").mapInPandas(number, "shard int, slot long, s int, block long, epoch long, words long")
    slots = staged(numbered, "mix-slots")
    full = placed.where("size > 0")
    cut = full.withColumn("block", F.explode(F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))))
    head = F.col("block") * block_words - F.col("start")
    pieces = (
        cut.join(slots, ["s", "block"])
        .withColumn("lo", F.greatest(head, F.lit(0)))
        .withColumn("hi", F.least(head + F.col("words"), F.col("size")))
        .where("hi > lo")
        .drop("words")
    )
    return Mix(placed, slots, pieces)


def taken_words(mix: Mix) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of the documents."""
    key = ["s", "start", "doc_id", "text_hash", "size", "source_size", "target"]
    used = mix.pieces.groupBy("s", "start").agg(F.sum(F.col("hi") - F.col("lo")).alias("taken"))
    got = mix.documents.where("size > 0").join(used, ["s", "start"], "left").select(*key, F.coalesce("taken", F.lit(0)).alias("taken"))
    none = mix.documents.where("size = 0").select(*key, F.lit(0).cast("long").alias("taken"))
    return got.unionByName(none).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, **options: int) -> DataFrame:
    """The mix as documents: for each epoch that takes words of a document a row with those words, in order.

    Returns doc_id, text, lang, source, n_chars. White space between words taken is kept; where words between
    two pieces are not taken, a newline stands. Documents that the mix leaves out are not returned.
    """
    key = ["doc_id", "text_hash", "source"]
    mix = plan_mix(docs, **options)
    parts = mix.pieces.groupBy(*key, "s", "start", "epoch").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("parts"))
    parts = parts.withColumnRenamed("source", "part_source").select(F.col("doc_id").alias("part_id"), F.col("text_hash").alias("part_hash"), "part_source", "parts")
    texts = docs.select("doc_id", "text", "lang", "source").withColumn("text_hash", F.xxhash64("text")).dropDuplicates(["doc_id", "text_hash", "source"])
    both = texts.join(parts, F.col("doc_id").eqNullSafe(F.col("part_id")) & (F.col("text_hash") == F.col("part_hash")) & F.col("source").eqNullSafe(F.col("part_source")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, text in slices(batches):
            raw, at = buffers(text)
            stats = TextStats(raw, at)
            ends, begin = stats.word_ends(), np.cumsum(stats.n_words) - stats.n_words
            out = []
            for i, (doc, parts) in enumerate(zip(text_bytes(raw, at), batch.column("parts").to_pylist())):
                joined: list[list[int]] = []
                for p in parts:
                    if joined and joined[-1][1] == p["lo"]:
                        joined[-1][1] = p["hi"]
                    else:
                        joined.append([p["lo"], p["hi"]])
                first, shift = begin[i], at[i]
                out.append(b"\n".join(doc[stats.word_at[first + lo] - shift : ends[first + hi - 1] - shift] for lo, hi in joined).decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string()), batch.column("lang"), batch.column("source"), pa.array([len(t) for t in out], pa.int64())], ["doc_id", "text", "lang", "source", "n_chars"])

    narrow = both.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source", "parts")
    return narrow.mapInArrow(cut, "doc_id long, text string, lang string, source string, n_chars long")

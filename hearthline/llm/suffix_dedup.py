"""Removal of repeated substrings by suffix arrays.

A byte goes if it lies in a string of LENGTH bytes that also starts anywhere else in the corpus, the same
document included. Documents are cut into shards of bounded size, close ones into the same shard (by the
smallest hash of a K-byte string in them, which near copies share). Each shard sorts the suffixes of what can
be repeated by Larsson-Sadakane refinement up to LENGTH bytes, and finds repeats by the common prefixes of
neighbours (Kasai's, along chains of suffixes whose neighbours follow one another).

What can be repeated is found first: every window of LENGTH bytes has an anchor, the K-byte string in it with
the smallest hash. Equal windows have equal anchors, so a window whose anchor occurs once is unique, and a
window whose anchor occurs in one shard only is settled there. The other windows, those at anchors that
several shards have, are merged across shards: each shard sends the sorted hashes of its distinct windows,
cut into buckets, and binary search in the merged bucket tells which of them other shards have.

Of documents with equal texts one goes into a shard; all of them are removed whole, if they have LENGTH bytes.

Defined cases: null and empty texts, and texts under LENGTH bytes, keep all they have; rows with equal ids are
documents of their own (a repeated row is a copy); an empty table gives no rows; other columns are ignored.
Windows of different shards, and whole texts of equal length, are equal if their 64-bit hashes are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import buffers, mix64, sha, slices
from hearthline.session import staged

LENGTH, K = 200, 64
SPAN = LENGTH - K + 1
SHARD_BYTES = 2_500_000
#: Anchors, and window hashes, per bucket.
BUCKET = 1_000_000
NONE = np.uint64(2**64 - 1)
#: No byte of UTF-8; ends the pieces of text that a suffix array is of.
END = 0xFF


# --- hashes and anchors ----------------------------------------------------------------------------------


def string_hashes(raw: np.ndarray) -> np.ndarray:
    """Of each place the hash of the K bytes from there; NONE where fewer follow."""
    out = np.full(len(raw), NONE)
    if len(raw) < K:
        return out
    x = raw.astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] | (x[step:] << np.uint64(8 * step))
    with np.errstate(over="ignore"):
        x = mix64(x)
        step = 8
        while step < K:
            x = x[:-step] * np.uint64(0x9E3779B97F4A7C15) + x[step:]
            x ^= x >> np.uint64(32)
            x *= np.uint64(0xD6E8FEB86659FD93)
            x ^= x >> np.uint64(29)
            step *= 2
    out[: len(x)] = np.minimum(x, NONE - np.uint64(1))
    return out


def sliding(x: np.ndarray, size: int, pick: np.ufunc) -> np.ndarray:
    """pick over x[i : i + size], for every i that has as many."""
    if len(x) < size:
        return x[:0]
    step = 1
    while 2 * step <= size:
        x = pick(x[:-step], x[step:])
        step *= 2
    rest = size - step
    return pick(x[:-rest], x[rest:]) if rest else x


class Windows:
    """The windows of texts that lie one after another in raw, the first of each at at[i]."""

    def __init__(self, raw: np.ndarray, at: np.ndarray):
        n = len(raw)
        self.hash = string_hashes(raw)
        self.room = np.repeat(at[1:], np.diff(at)) - np.arange(n)
        self.valid = self.room >= LENGTH
        self.hash[self.room < K] = NONE
        least = np.zeros(n, np.uint64)
        found = sliding(self.hash, SPAN, np.minimum)
        least[: len(found)] = found
        #: Hash of the anchor of the window from each place; 0 where there is no window.
        self.anchor = np.where(self.valid, least, np.uint64(0))
        most = sliding(np.concatenate([np.zeros(SPAN - 1, np.uint64), self.anchor]), SPAN, np.maximum)
        #: Places whose string is the anchor of a window.
        self.anchors = np.flatnonzero((most == self.hash) & (self.hash != NONE))

    def at_anchors(self, wanted: np.ndarray) -> np.ndarray:
        """Flags of the windows whose anchor is one of the sorted hashes."""
        own = self.hash[self.anchors]
        some = np.full(len(self.hash), NONE)
        if len(wanted) and len(own):
            hit = self.anchors[wanted[np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)] == own]
            some[hit] = self.hash[hit]
        least = np.full(len(some), NONE)
        found = sliding(some, SPAN, np.minimum)
        least[: len(found)] = found
        return self.valid & (least == self.anchor)

    def whole(self, places: np.ndarray) -> np.ndarray:
        """Hashes of the windows from these places."""
        with np.errstate(over="ignore"):
            out = np.full(len(places), LENGTH, np.uint64)
            for k in [*range(0, LENGTH - K, K), LENGTH - K]:
                out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + self.hash[places + k])
        return out


# --- suffix arrays ---------------------------------------------------------------------------------------


def suffix_order(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Places ordered by their first `depth` bytes (equal ones by place): Larsson-Sadakane refinement.

    Starts from the order by eight bytes; each round orders the groups that are still equal, and only those,
    by the group of the place so many bytes further on.
    """
    n = len(text)
    x = np.concatenate([text, np.zeros(7, np.uint8)]).astype(np.uint64)
    for step in (1, 2, 4):
        x = (x[:-step] << np.uint64(8 * step)) | x[step:]
    order = np.argsort(x, kind="stable")
    x = x[order]
    opens = np.append(True, x[1:] != x[:-1])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(opens, np.arange(n), 0))
    done = 8
    while done < depth:
        step = min(done, depth - done)
        alone = opens & np.append(opens[1:], True)
        rows = np.flatnonzero(~alone)
        if not len(rows):
            break
        place = order[rows]
        key = rank[place] * (n + 1) + rank[np.minimum(place + step, n)] + 1
        by = np.argsort(key, kind="stable")
        key = key[by]
        order[rows] = place[by]
        opens[rows] = np.append(True, key[1:] != key[:-1])
        rank[order[rows]] = np.maximum.accumulate(np.where(opens[rows], rows, 0))
        done += step
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """For each place in order the length, up to `most`, of the prefix that it has in common with the one before.

    Kasai's argument along chains: where the neighbours of consecutive places are consecutive, each common
    prefix is that of the place after it and one byte more, or ends at the first byte that differs. So one
    comparison per place and one long comparison per chain do.
    """
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    chained = np.append((before[1:] == before[:-1] + 1) & (before[:-1] >= 0), False)
    ends = np.flatnonzero(~chained & (before >= 0))
    padded = np.concatenate([text, np.full(most, END, np.uint8)])
    length, live = np.zeros(len(ends), np.int64), np.arange(len(ends))
    for k in range(0, most, 8):
        a, b = ends[live] + k, before[ends[live]] + k
        same = np.ones(len(live), bool)
        for byte in range(min(8, most - k)):
            same &= padded[a + byte] == padded[b + byte]
            length[live[same]] += 1
        live = live[same]
        if not len(live):
            break
    has = before >= 0
    equal = np.zeros(n, bool)
    equal[has] = text[np.flatnonzero(has)] == text[before[has]]
    # A chain agrees up to its first unequal byte, or beyond its last place as far as compared there.
    places = np.arange(n)
    unequal = np.minimum.accumulate(np.where(equal, n, places)[::-1])[::-1]
    beyond = np.zeros(n, np.int64)
    beyond[ends] = length
    is_end = np.zeros(n, bool)
    is_end[ends] = True
    last = np.minimum(np.minimum.accumulate(np.where(is_end, places, n)[::-1])[::-1], n - 1)
    stop = np.where(unequal <= last, unequal, last + beyond[last])
    out = np.where(has, np.minimum(stop - places, most), 0)
    return out[order]


def repeated_starts(text: np.ndarray) -> np.ndarray:
    """Flags of places whose first LENGTH bytes also start at another place."""
    order = suffix_order(text)
    long = common_prefixes(text, order) >= LENGTH
    out = np.zeros(len(text), bool)
    out[order] = long | np.append(long[1:], False)
    return out


def pieces(candidate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of bytes that the windows from flagged places cover; ranges that overlap are one."""
    places = np.flatnonzero(candidate)
    if not len(places):
        return places, places
    new = np.append(True, np.diff(places) > LENGTH)
    return places[new], places[np.append(new[1:], True)] + LENGTH


def covered(starts: np.ndarray, n: int) -> np.ndarray:
    """Flags of the bytes in windows from the flagged places."""
    change = np.zeros(n + 1, np.int64)
    places = np.flatnonzero(starts)
    np.add.at(change, places, 1)
    np.add.at(change, np.minimum(places + LENGTH, n), -1)
    return np.cumsum(change[:n]) > 0


# --- Spark -----------------------------------------------------------------------------------------------


def _anchored(docs: DataFrame, shards: int, buckets: int) -> DataFrame:
    """Rows (doc_id, h, n, sha, shard) of documents, and blobs (bucket, anchors, homes, once) of anchor hashes by shard."""
    names = ["doc_id", "h", "n", "sha", "shard", "bucket", "keys", "homes", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, n = set(), [], 0

        def send() -> pa.RecordBatch:
            key, home = np.concatenate([k for k, _ in held]), np.concatenate([h for _, h in held])
            held.clear()
            order = np.lexsort((home, key))
            key, home = key[order], home[order]
            first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (home[1:] != home[:-1])))
            times = np.minimum(np.diff(np.append(first, len(key))), 2).astype(np.uint8)
            key, home = key[first], home[first].astype(np.int32)
            bucket = (mix64(key) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cut = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0))
            rows = [(int(bucket[order[a]]), *(v[order[a:b]].tobytes() for v in (key, home, times))) for a, b in zip(cut, [*cut[1:], len(order)])]
            none = [pa.nulls(len(rows), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32())]
            return pa.RecordBatch.from_arrays([*none, pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2, 3))], names)

        for batch, column in slices(batches):
            raw, at = buffers(column)
            found = Windows(raw, at)
            doc = np.searchsorted(at, found.anchors, "right") - 1
            least = np.full(len(at) - 1, NONE)
            np.minimum.at(least, doc, found.hash[found.anchors])
            shard = (mix64(least) % np.uint64(shards)).astype(np.int32)
            none = [pa.nulls(batch.num_rows, t) for t in (pa.int32(), pa.binary(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "h", "n", "sha")), pa.array(shard), *none], names)
            new = np.array([h not in seen and not seen.add(h) for h in zip(batch.column("h").to_pylist(), batch.column("n").to_pylist())])
            use = new[doc]
            held.append((found.hash[found.anchors[use]], shard[doc[use]].astype(np.int64)))
            n += int(use.sum())
            if n > BUCKET:
                yield send()
                n = 0
        if n:
            yield send()

    return docs.mapInArrow(run, "doc_id long, h long, n long, sha string, shard int, bucket int, keys binary, homes binary, times binary")


def _joined(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _by_home(home: np.ndarray, *values: np.ndarray) -> list[tuple]:
    order = np.argsort(home, kind="stable")
    cut = np.flatnonzero(np.append(True, np.diff(home[order]) != 0)) if len(home) else []
    return [(int(home[order[a]]), *(v[order[a:b]].tobytes() for v in values)) for a, b in zip(cut, [*cut[1:], len(order)])]


def _repeated_anchors(table: pa.Table) -> pa.Table:
    """(shard, keys, several): of each shard the anchors that occur twice or more, and whether in another shard too."""
    key, home, times = _joined(table, "keys", np.uint64), _joined(table, "homes", np.int32), _joined(table, "times", np.uint8)
    order = np.lexsort((home, key))
    key, home, times = key[order], home[order], times[order].astype(np.int64)
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(key))))
    total = np.add.reduceat(times, first) if len(first) else times
    apart = home != home[first][group]
    several = (np.bincount(group, apart, len(first)) > 0)[group]
    keep = total[group] > 1
    keep &= np.append(True, (key[1:] != key[:-1]) | (home[1:] != home[:-1]))
    rows = _by_home(home[keep], key[keep], several[keep].astype(np.uint8))
    return pa.table({"shard": pa.array([r[0] for r in rows], pa.int32()), "keys": pa.array([r[1] for r in rows], pa.binary()), "several": pa.array([r[2] for r in rows], pa.binary())})


RESULT = "kind string, h long, n long, shard int, sub int, bucket int, n_removed long, n_spans long, kept_sha256 string, data binary, text string"
_KINDS = {"kind": pa.string(), "h": pa.int64(), "n": pa.int64(), "shard": pa.int32(), "sub": pa.int32(), "bucket": pa.int32(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "data": pa.binary(), "text": pa.string()}


def _result(rows: list[dict]) -> pa.Table:
    return pa.table({c: pa.array([r.get(c) for r in rows], t) for c, t in _KINDS.items()})


def _figures(raw: np.ndarray, gone: np.ndarray) -> dict:
    spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(len(gone) > 0 and bool(gone[0]))
    return {"n_removed": int(gone.sum()), "n_spans": spans, "kept_sha256": sha(raw[~gone].tobytes())}


def _distinct_rows(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """The rows of a shard, one for each text, and their bytes."""
    table = table.combine_chunks()
    h, n = table.column("h").to_numpy(), table.column("n").to_numpy()
    order = np.lexsort((n, h))
    first = order[np.append(True, (np.diff(h[order]) != 0) | (np.diff(n[order]) != 0))] if len(h) else order
    table = table.take(pa.array(first))
    column = table.column("text").combine_chunks()
    raw, at = buffers((column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)).cast(pa.large_string()))
    return table, raw, at


def _shard(buckets: int):
    def run(texts: pa.Table, anchors: pa.Table) -> pa.Table:
        if not texts.num_rows or not anchors.num_rows:
            return _result([])
        table, raw, at = _distinct_rows(texts)
        key, several = _joined(anchors, "keys", np.uint64), _joined(anchors, "several", np.uint8) > 0
        order = np.argsort(key)
        key, several = key[order], several[order]
        split = table.column("subs")[0].as_py() > 1
        found = Windows(raw, at)
        begin, end = pieces(found.at_anchors(key))
        starts = np.zeros(len(raw), bool)
        if len(begin):
            # The pieces one after another, each with an end.
            size = end - begin + 1
            shift = np.cumsum(size) - size
            place = np.arange(size.sum()) - np.repeat(shift - begin, size)
            text = raw[np.minimum(place, len(raw) - 1)]
            last = shift + size - 1
            text[last] = END
            twice = repeated_starts(text)
            twice[last] = False
            starts[place[twice]] = True
            starts &= found.valid
        open_ = found.at_anchors(key if split else key[several])
        cross = open_ & ~starts
        hashes = np.unique(found.whole(np.flatnonzero(open_)))
        shard, sub = table.column("shard")[0].as_py(), table.column("sub")[0].as_py()
        rows = [
            {"kind": "windows", "shard": shard, "sub": sub, "bucket": b, "data": data}
            for b, data in _by_home((mix64(hashes) % np.uint64(buckets)).astype(np.int64), hashes)
        ]
        for i, (h, n, copies) in enumerate(zip(*(table.column(c).to_pylist() for c in ("h", "n", "copies")))):
            part = slice(at[i], at[i + 1])
            if copies > 1:
                continue
            if cross[part].any():
                rows.append({"kind": "open", "h": h, "n": n, "shard": shard, "sub": sub, "data": np.packbits(starts[part]).tobytes(), "text": raw[part].tobytes().decode()})
            elif starts[part].any():
                rows.append({"kind": "done", "h": h, "n": n, **_figures(raw[part], covered(starts[part], n))})
        return _result(rows)

    return run


def _merged(table: pa.Table) -> pa.Table:
    """Of a bucket the windows that several shards have, for each of these shards."""
    names = list(zip(table.column("shard").to_pylist(), table.column("sub").to_pylist()))
    arrays = [np.frombuffer(d, np.uint64) for d in table.column("data").to_pylist()]
    merged = np.sort(np.concatenate(arrays))
    rows = []
    for (shard, sub), own in zip(names, arrays):
        held = np.searchsorted(merged, own, "right") - np.searchsorted(merged, own, "left")
        if (held > 1).any():
            rows.append((shard, sub, own[held > 1].tobytes()))
    return pa.table({"shard": pa.array([r[0] for r in rows], pa.int32()), "sub": pa.array([r[1] for r in rows], pa.int32()), "data": pa.array([r[2] for r in rows], pa.binary())})


def _settled(texts: pa.Table, windows: pa.Table) -> pa.Table:
    """The figures of a shard's open documents."""
    if not texts.num_rows:
        return _result([])
    hashes = np.sort(_joined(windows, "data", np.uint64)) if windows.num_rows else np.empty(0, np.uint64)
    table, raw, at = _distinct_rows(texts)
    found = Windows(raw, at)
    rows = []
    places = np.flatnonzero(found.valid)
    own = found.whole(places)
    hit = np.zeros(len(raw), bool)
    if len(hashes):
        hit[places[hashes[np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)] == own]] = True
    for i, (h, n, data) in enumerate(zip(*(table.column(c).to_pylist() for c in ("h", "n", "data")))):
        part = slice(at[i], at[i + 1])
        starts = np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool) | hit[part]
        if starts.any():
            rows.append({"kind": "done", "h": h, "n": n, **_figures(raw[part], covered(starts, n))})
    return _result(rows)


def remove_repeats(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    text = F.coalesce("text", F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"), F.octet_length(text).cast("long").alias("n"))
    total = docs.agg(F.sum("n")).first()[0] or 0
    shards, buckets = 1 + total // shard_bytes, 1 + total * 2 // SPAN // BUCKET
    found = staged(_anchored(docs.withColumn("sha", F.sha2("text", 256)), shards, buckets), "suffix-anchors")
    rows = found.where("h is not null").select("doc_id", "h", "n", "sha", "shard")
    anchors = found.where("keys is not null").groupBy("bucket").applyInArrow(_repeated_anchors, "shard int, keys binary, several binary")
    classes = rows.where(F.col("n") >= LENGTH).groupBy("h", "n").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.min("shard").alias("shard"))
    subs = classes.groupBy("shard").agg(F.ceil(F.sum("n") / (1.5 * shard_bytes)).cast("int").alias("subs"))
    classes = classes.join(subs, "shard").withColumn("sub", F.pmod(F.xxhash64("h"), "subs").cast("int"))
    one = classes.withColumnsRenamed({"doc_id": "id", "h": "own_h", "n": "own_n"})
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("own_h")) & (F.col("n") == F.col("own_n"))
    texts = docs.join(one, same).select("h", "n", "copies", "shard", "sub", "subs", "text")
    every = anchors.join(subs, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)).alias("sub"), "keys", "several")
    sharded = staged(texts.groupBy("shard", "sub").cogroup(every.groupBy("shard", "sub")).applyInArrow(_shard(buckets), RESULT), "suffix-shards")
    merged = sharded.where("kind = 'windows'").groupBy("bucket").applyInArrow(_merged, "shard int, sub int, data binary")
    pending = sharded.where("kind = 'open'").select("h", "n", "shard", "sub", "data", "text")
    settled = pending.groupBy("shard", "sub").cogroup(merged.groupBy("shard", "sub")).applyInArrow(_settled, RESULT)
    figures = ["h", "n", "n_removed", "n_spans", "kept_sha256"]
    done = sharded.where("kind = 'done'").select(*figures).unionByName(settled.select(*figures))
    copied = classes.where("copies > 1").select("h", "n", F.col("n").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.sha2(F.lit(""), 256).alias("kept_sha256"))
    none = F.lit(0).cast("long")
    return rows.join(done.unionByName(copied), ["h", "n"], "left").select(
        "doc_id",
        F.col("n").alias("n_bytes"),
        F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )

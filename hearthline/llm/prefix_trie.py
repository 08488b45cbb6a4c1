"""The trie of conversation prefixes, screened by a count-min sketch.

Turns become narrow rows (a 128-bit hash of role and text, the text's length); texts are never shuffled. The
rows are sorted by conversation over ranges, so that even one conversation may lie in many tasks, and every
prefix gets a digest: a polynomial hash over the turns modulo 2^127 - 1, whose runs compose, so a task only
needs what the tasks before it add up to. A count-min sketch of all prefix digests is filled in as many tasks
as there are cores and merged; its size is bounded by a parameter. An estimate of one proves that a prefix
belongs to one conversation only: such nodes, and those right below them, are written out where they are.
Only rows whose estimate is above one are grouped exactly. If the sketch is too small for the table, more
rows are grouped; the result stays exact.

Sums over subtrees need no walk through the tree. Every node belongs to its smallest member; a conversation
owns the nodes from some depth down. With K the length of what it doesn't own, the saved tokens below a node
are the sum of K over its members, less the owner's and less what lies above the node, and the leaves below
it are the members that own a leaf. Both are sums over the rows of a node, combined before the shuffle.
Joins to parents are salted by the sketch's estimate, which both sides know.

Defined cases: a null role or text is empty; turns are ordered by turn (null first), ties by the hash of role
and text, and repeated rows are repeated turns; rows without conv_id take no part; an empty table has no
nodes, not even the root; other columns are ignored. The members that end at a node are hashed as one sorted
stream of ids in one task with bounded memory, since a SHA-256 of their list can't be split.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, groupby, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.common import mix64
from hearthline.llm.ranges import RANGE, range_sorted
from hearthline.session import staged

#: The modulus of the digests and the base of the polynomial.
PRIME = 2**127 - 1
BASE = int.from_bytes(hashlib.sha256(b"conversation prefixes").digest(), "big") % PRIME

#: Rows of the sketch, counters that travel as one record, and the sketch's widths as powers of two.
LINES, CHUNK, LEAST_BITS, MOST_BITS = 4, 1 << 14, 14, 22
#: Children of a node that one task of the join to parents takes.
PER_SALT = 1 << 16
#: Turns of a conversation that one task of the join to its constants takes.
PER_BLOCK = 1 << 12

#: Nodes that leave a Python worker at a time.
BATCH = 10_000
NODE_ROWS = "conv_id long, depth long, a long, b long, up_a long, up_b long, before long, chars long, last boolean"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_rows(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, chars) of every turn of a known conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )


def plain(turns: DataFrame) -> DataFrame:
    """Rows for `trie` of conversations as they are."""
    rows = turn_rows(turns)
    begin = rows.select("conv_id").distinct().selectExpr("conv_id", "0 as part", "cast(null as long) as turn", "cast(null as binary) as digest", "0L as chars", "0 as skip")
    return begin.unionByName(rows.withColumns({"part": F.lit(1), "skip": F.lit(0)}))


def with_shared_starts(turns: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Rows for `trie` where conversation c begins with the first h turns of c - c % group instead of its own.

    h is crc32(c) modulo `most`. At most most - 1 narrow rows of a group's first conversation are copied.
    """
    rows = turn_rows(turns)
    skip = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    first = rows.where(F.col("conv_id") % group == 0).withColumn("at", F.row_number().over(order)).where(F.col("at") < most)
    heads = first.groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(F.struct("at", "digest", "chars"))).alias("head"))
    convs = rows.select("conv_id").distinct().withColumns({"base": F.col("conv_id") - F.col("conv_id") % group, "skip": skip})
    begin = convs.join(heads, "base", "left").select("conv_id", "skip", F.explode_outer(F.slice("head", F.lit(1), F.col("skip"))).alias("t"))
    begin = begin.select("conv_id", F.lit(0).alias("part"), F.col("t.at").cast("long").alias("turn"), "t.digest", F.coalesce("t.chars", F.lit(0).cast("long")).alias("chars"), "skip")
    return begin.unionByName(rows.withColumns({"part": F.lit(1), "skip": skip}))


@dataclass
class State:
    """Where a conversation stands: own turns seen, turns in effect, their digest and length."""

    conv_id: int
    seen: int = 0
    turns: int = 0
    digest: int = 0
    chars: int = 0

    def add(self, turn: int, chars: int) -> None:
        self.turns += 1
        self.digest = (self.digest * BASE + turn) % PRIME
        self.chars += chars


@dataclass
class Run:
    """The consecutive rows that a task holds of one conversation, own turns and copied ones apart."""

    conv_id: int
    skip: int
    copied: State
    own: State
    first: list[tuple[int, int]] = field(default_factory=list)

    def after(self, before: State | None) -> State:
        """The state behind these rows, if `before` is the one ahead of them."""
        s = before or State(self.conv_id)
        left_out = self.first[: max(0, self.skip - s.seen)]
        turns, digest, chars = self.own.turns, self.own.digest, self.own.chars
        for turn, n in left_out:
            turns -= 1
            digest = (digest - turn * pow(BASE, turns, PRIME)) % PRIME
            chars -= n
        out = State(self.conv_id, s.seen + self.own.turns, s.turns + self.copied.turns + turns)
        out.digest = ((s.digest * pow(BASE, self.copied.turns, PRIME) + self.copied.digest) * pow(BASE, turns, PRIME) + digest) % PRIME
        out.chars = s.chars + self.copied.chars + chars
        return out


def _number(digest: bytes) -> int:
    return int.from_bytes(digest, "big") % (PRIME - 1) + 1


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple]]]:
    """The sorted rows of a task, range by range."""
    names = (RANGE, "conv_id", "part", "digest", "chars", "skip")
    return groupby(chain.from_iterable(zip(*(batch.column(c).to_pylist() for c in names)) for batch in batches), key=itemgetter(0))


def _edge_runs(ordered: DataFrame) -> dict[int, list[Run]]:
    """First and last run of every range (one, if it is the same): all that the driver gets to see."""

    def edges(records: Iterator[tuple]) -> list[Run]:
        first: Run | None = None
        now: Run | None = None
        for _, conv_id, part, digest, chars, skip in records:
            if now is None or now.conv_id != conv_id:
                first = first or now
                now = Run(conv_id, skip, State(conv_id), State(conv_id))
            if digest is None:
                continue
            turn = _number(digest)
            (now.own if part else now.copied).add(turn, chars)
            if part and len(now.first) < skip:
                now.first.append((turn, chars))
        return [r for r in (first, now) if r is not None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(n, i, pickle.dumps(r)) for n, records in _by_range(batches) for i, r in enumerate(edges(records))]
        kinds = [pa.int32(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in found], kind) for j, kind in enumerate(kinds)], ["range_no", "i", "run"])

    out: dict[int, list[Run]] = {}
    for r in sorted(ordered.mapInArrow(run, "range_no int, i int, run binary").collect()):
        out.setdefault(r.range_no, []).append(pickle.loads(r.run))
    return out


def _carried(edges: dict[int, list[Run]]) -> tuple[dict[int, State], set[int]]:
    """Of every range the state that its first conversation comes with; and the ranges whose last one gets more turns later."""
    carry: dict[int, State] = {}
    ends: list[tuple[int, State]] = []
    now: State | None = None
    for n in sorted(edges):
        first, last = edges[n][0], edges[n][-1]
        if now is not None and now.conv_id == first.conv_id:
            carry[n] = now
        else:
            now = None
        now = first.after(now) if first is last else last.after(None)
        ends.append((n, now))
    longest: dict[int, int] = {}
    for _, state in ends:
        longest[state.conv_id] = max(state.turns, longest.get(state.conv_id, 0))
    # A conversation that ends as the first of several in a range isn't the last of any.
    for n, state in carry.items():
        longest[state.conv_id] = max(longest.get(state.conv_id, 0), edges[n][0].after(state).turns)
    return carry, {n for n, state in ends if state.turns < longest[state.conv_id]}


def prefixes(ordered: DataFrame) -> DataFrame:
    """A row per conversation and prefix, the empty one included, from rows sorted by `range_sorted`.

    (a, b) is the digest of the prefix, (up_a, up_b) that of the one before, `before` its length without its
    last turn, `chars` that of the last turn; `last` marks whole conversations.
    """
    carry, unfinished = _carried(_edge_runs(ordered))

    def nodes(records: Iterator[tuple], state: State | None, goes_on: bool) -> Iterator[list]:
        pending: list | None = None
        for _, conv_id, part, digest, chars, skip in records:
            if state is None or state.conv_id != conv_id:
                if pending is not None:
                    pending[-1] = True
                    yield pending
                state = State(conv_id)
                pending = [conv_id, 0, 0, None, 0, 0, False]
            if digest is None:
                continue
            if part:
                state.seen += 1
                if state.seen <= skip:
                    continue
            if pending is not None:
                yield pending
            before, up = state.chars, state.digest
            state.add(_number(digest), chars)
            pending = [conv_id, state.turns, state.digest, up, before, chars, False]
        if pending is not None:
            pending[-1] = not goes_on
            yield pending

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, records in _by_range(batches):
            state = State(**vars(carry[n])) if n in carry else None
            rows = nodes(records, state, n in unfinished)
            while some := list(islice(rows, BATCH)):
                yield _node_rows(some)

    return ordered.mapInArrow(run, NODE_ROWS)


def _halves(digests: list[int | None]) -> tuple[pa.Array, pa.Array]:
    raw = np.frombuffer(b"".join((d or 0).to_bytes(16, "big") for d in digests), ">i8").astype(np.int64).reshape(-1, 2)
    missing = np.array([d is None for d in digests], bool)
    return pa.array(raw[:, 0], mask=missing), pa.array(raw[:, 1], mask=missing)


def _node_rows(rows: list[list]) -> pa.RecordBatch:
    conv_id, depth, digest, up, before, chars, last = zip(*rows)
    columns = [pa.array(conv_id, pa.int64()), pa.array(depth, pa.int64()), *_halves(digest), *_halves(up), pa.array(before, pa.int64()), pa.array(chars, pa.int64()), pa.array(last, pa.bool_())]
    return pa.RecordBatch.from_arrays(columns, ["conv_id", "depth", "a", "b", "up_a", "up_b", "before", "chars", "last"])


def _cells(a: np.ndarray, b: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The cell of each digest in every line of the sketch."""
    x, y = mix64(a.view(np.uint64)), mix64(b.view(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15))
    with np.errstate(over="ignore"):
        for line in range(LINES):
            yield ((x + np.uint64(line) * (y | np.uint64(1))) >> np.uint64(64 - bits)).astype(np.int64)


def sketch(rows: DataFrame, bits: int) -> np.ndarray:
    """Count-min sketch of the digests (a, b): LINES x 2^bits counters, the only thing that is collected.

    As many tasks as cores fill one each, so what is shuffled is bounded by cores times size.
    """
    width = 1 << bits

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((LINES, width), np.int64)
        for batch in batches:
            a, b = (batch.column(c).to_numpy() for c in ("a", "b"))
            for line, at in enumerate(_cells(a, b, bits)):
                np.add.at(counts[line], at, 1)
        chunks = counts.reshape(-1, CHUNK)
        used = np.flatnonzero(chunks.any(1))
        packed = [np.minimum(chunks[i], 2**32 - 1).astype(np.uint32).tobytes() for i in used]
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(packed, pa.binary())], ["chunk", "counts"])

    def merge(key: tuple, groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CHUNK, np.int64)
        for batch in groups:
            for counts in batch.column("counts").to_pylist():
                total += np.frombuffer(counts, np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()], pa.binary())], ["chunk", "counts"])

    tasks = rows.sparkSession.sparkContext.defaultParallelism
    filled = rows.select("a", "b").coalesce(tasks).mapInArrow(fill, "chunk int, counts binary")
    out = np.zeros((LINES * width // CHUNK, CHUNK), np.uint32)
    for chunk, counts in filled.groupBy("chunk").applyInArrow(merge, "chunk int, counts binary").collect():
        out[chunk] = np.frombuffer(counts, np.uint32)
    return out.reshape(LINES, width)


def screened(rows: DataFrame, counts: np.ndarray) -> DataFrame:
    """The rows with the estimates `heat` and `up_heat` of prefix and parent (null above the root)."""
    bits = counts.shape[1].bit_length() - 1
    shipped = rows.sparkSession.sparkContext.broadcast(counts)

    def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.min([shipped.value[line][at] for line, at in enumerate(_cells(a, b, bits))], axis=0).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, up_a, up_b = (batch.column(c).fill_null(0).to_numpy() for c in ("a", "b", "up_a", "up_b"))
            rootless = batch.column("up_a").is_null().to_numpy(zero_copy_only=False)
            columns = [*batch.columns, pa.array(estimate(a, b)), pa.array(estimate(up_a, up_b), mask=rootless)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "heat", "up_heat"])

    return rows.mapInArrow(run, NODE_ROWS + ", heat long, up_heat long")


def _ends(rows: DataFrame) -> DataFrame:
    """(a, b, ends_sha256): the conversations that end at a node, as a sorted stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done = []
            for a, b, conv_id in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "conv_id"))):
                if (a, b) == now:
                    digest.update(b",%d" % conv_id)
                    continue
                if now is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest = (a, b), hashlib.sha256(b"%d" % conv_id)
            yield pack(done)
        if now is not None:
            yield pack([(*now, digest.hexdigest())])

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        kinds = pa.int64(), pa.int64(), pa.string()
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["a", "b", "ends_sha256"])

    ordered = rows.select("a", "b", "conv_id").repartition("a", "b").sortWithinPartitions("a", "b", "conv_id")
    return ordered.mapInArrow(run, "a long, b long, ends_sha256 string")


def _salts(heat: str) -> Column:
    return 1 + F.floor(F.col(heat) / PER_SALT)


def trie(rows: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """One row per node, named by its smallest member and its depth.

    `rows` come from `plain` or `with_shared_starts`. The sketch is twice as wide as there are rows, at
    least 2^14 and at most 2^most_bits counters in each of four lines (4 bytes each).
    """
    ordered = range_sorted(rows, F.col("conv_id"), F.col("part"), F.col("turn").asc_nulls_first(), F.col("digest"))
    found = staged(prefixes(ordered), "prefixes")
    bits = min(most_bits, max(LEAST_BITS, (2 * ordered.count()).bit_length()))
    every = staged(screened(found, sketch(found, bits)), "screened")
    # Proven singletons: by their own estimate, or by that of the prefix they go on from.
    alone = (F.col("heat") <= 1) | F.coalesce(F.col("up_heat") <= 1, F.lit(False))
    local, shared = every.where(alone), every.where(~alone)

    counted = [F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")]
    counted += [F.max(c).alias(c) for c in ("depth", "up_a", "up_b", "before", "heat", "up_heat")]
    nodes = staged(shared.groupBy("a", "b").agg(*counted), "nodes")
    upper = nodes.where("depth > 0").select("up_a", "up_b").unionAll(local.where("up_heat > 1").select("up_a", "up_b"))
    children = upper.groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count("*").alias("n_children"))
    nodes = staged(nodes.join(children, ["a", "b"], "left").fillna(0, ["n_children"]), "nodes")

    # Per conversation: the length of what it doesn't own, and whether it owns a leaf.
    own = every.groupBy("conv_id").agg(
        F.min(F.when(alone, F.col("before"))).alias("local_before"),
        F.max(F.col("before") + F.col("chars")).alias("whole"),
        F.max((alone & F.col("last")).cast("long")).alias("local_leaf"),
        F.max("depth").alias("deepest"),
    )
    owned = nodes.groupBy("conv_id").agg(F.min("before").alias("node_before"), F.max((F.col("n_children") == 0).cast("long")).alias("node_leaf"))
    constants = own.join(owned, "conv_id", "left").select(
        "conv_id",
        F.least("local_before", "node_before", "whole").alias("foreign"),
        F.greatest("local_leaf", F.coalesce("node_leaf", F.lit(0).cast("long"))).alias("leaf"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("deepest") / PER_BLOCK))).alias("block"),
    )
    members = shared.select("conv_id", "a", "b", F.floor(F.col("depth") / PER_BLOCK).alias("block")).join(constants, ["conv_id", "block"])
    sums = members.groupBy("a", "b").agg(F.sum("foreign").alias("foreign"), F.min_by("foreign", "conv_id").alias("owner_foreign"), F.sum("leaf").alias("n_leaves"))

    # The parents' owners, for shared nodes and for those local ones whose parent may be shared.
    columns = ["conv_id", "depth", "up_a", "up_b", "up_heat"]
    below = nodes.select(*columns, "a", "b").where("depth > 0").unionByName(local.where("up_heat > 1").select(*columns, "a", "b"))
    below = below.withColumn("salt", F.pmod("a", _salts("up_heat")))
    parents = nodes.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("owner"), F.explode(F.sequence(F.lit(0).cast("long"), _salts("heat") - 1)).alias("salt"))
    linked = below.join(parents, ["up_a", "up_b", "salt"], "left").select("conv_id", "depth", F.coalesce("owner", "conv_id").alias("parent_conv_id"))

    known = (
        nodes.join(sums, ["a", "b"])
        .join(_ends(shared.where("last")), ["a", "b"], "left")
        .select(
            "conv_id",
            "depth",
            "n_convs",
            "n_children",
            "n_leaves",
            (F.col("foreign") - F.col("owner_foreign") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"),
        )
    )
    one, zero = (F.lit(n).cast("long") for n in (1, 0))
    single = local.select(
        "conv_id",
        "depth",
        one.alias("n_convs"),
        F.when(F.col("last"), zero).otherwise(one).alias("n_children"),
        one.alias("n_leaves"),
        zero.alias("saved_tokens"),
        F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(EMPTY_SHA)).alias("ends_sha256"),
        ((F.col("depth") > 0) & (F.col("up_heat") > 1)).alias("below_shared"),
    )
    result = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = single.where("not below_shared").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id")))
    outer = known.unionByName(single.where("below_shared").drop("below_shared")).join(linked, ["conv_id", "depth"], "left")
    return inner.select(result).unionByName(outer.select(result))

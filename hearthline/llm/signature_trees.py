"""N-gram Jaccard join by signature trees.

A document's set holds the 64-bit hashes of its distinct five-word shingles. Documents with equal sets form a
class, and only classes are compared. Two sets that are similar enough share a token among the first
n - ceil(0.8 n) + 1 of each in any common order (the prefix filter); the order used here puts tokens that are
frequent within a map task last, so that common lines and passages seldom lead anyone together. The frequent
tokens are a bounded list (`MOST_FREQUENT`), and whatever is on it, the result is the same. Prefixes longer by
k - 1 tokens have k tokens in common, or all that similar sets must have; so a class with fewer tokens there that
any other class has is similar to none, and its text never moves.

Classes that share a prefix token meet in a signature tree: a leaf holds a class's bitmap of tokens and its
size, a node the OR of its children's bitmaps and the range of their sizes. Trees are traversed in pairs from
the root down; a pair of nodes is dropped when no two members can overlap enough, by the bits both have and
the sizes, or when all their members are connected already. Three steps:

1. Each class is in the tree of its first shared token only, with its text; leaf pairs that remain are
   compared exactly unless they are connected already. Trees of more than TREE_SIZE classes are cut into
   several by a hash, all of which get the smallest class as well.
2. A class that shares tokens with a larger component than its own is compared with one member of it, the one
   with which it shares most prefix tokens: one comparison per class, at most BRIDGES times. This joins what
   the first step left of groups of near copies.
3. Where prefix tokens still lead together classes of different components, a tree of their bitmaps (one for all
   tokens with the same smallest class; cut into blocks, and trees for all pairs of blocks, above MARKED_SIZE)
   tells which classes can still have a link there. Only these come again, with their texts, into such a tree,
   which compares exactly and gives at most one link per pair of components.

So no link is lost, whatever the group sizes; a group of n near copies costs about n comparisons, and every step
gives at most a row per class and token.

Defined cases: null and empty texts have empty sets and are linked with nothing; fewer words than five are one
shingle; rows with the same id are separate documents; a null id is never the smallest but in a component
without others, but links its text like any other; an empty table gives no rows; other columns are ignored. Sets
are compared by 64-bit hashes. The text of a class is fetched by a hash of id and text, which is never null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import SPACE, buffers, mix64, slices
from hearthline.llm.components import components
from hearthline.session import staged, staged_in_buckets

SHINGLE = 5
TREE_SIZE, TREE_TOKENS = 256, 4_000_000
#: Classes in a tree of bitmaps alone, and how often classes are compared with a larger component.
MARKED_SIZE, BRIDGES = 2048, 3
#: A token counts as frequent from so many sets within CHUNK tokens of a task; so many tokens are listed.
FREQUENT, CHUNK, MOST_FREQUENT = 4, 2_000_000, 100_000
#: So many tokens similar sets share in their prefixes; each costs a token more per prefix.
LEAST_SHARED = 4
#: Bits of the bitmap that tells which texts may be wanted, a multiple of those of a part.
WANTED_BITS = 1 << 25
#: Prefix tokens per bucket of the search for shared ones.
BUCKET = 1_000_000


# --- sets ------------------------------------------------------------------------------------------------


#: 256 bytes: A-Z in lower case.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: Longer words are hashed one by one.
LONG_WORD = 256


def word_hashes(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of texts that lie one after another, and the offsets of each text's words."""
    raw = LOWER[raw]
    inside = ~SPACE[raw]
    new = np.zeros(len(raw) + 1, bool)
    new[at] = True
    begin = np.flatnonzero(inside & (new[:-1] | np.append(True, ~inside[:-1])[: len(raw)]))
    end = np.flatnonzero(inside & (new[1:] | np.append(~inside[1:], True)[: len(raw)])) + 1
    doc = np.searchsorted(at, begin, "right") - 1
    first = np.append(0, np.cumsum(np.bincount(doc, minlength=len(at) - 1)))
    x = np.concatenate([raw, np.zeros(7, np.uint8)]).astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] | (x[step:] << np.uint64(8 * step))
    size = end - begin
    out = size.astype(np.uint64)
    live = np.flatnonzero(size <= LONG_WORD)
    k = 0
    with np.errstate(over="ignore"):
        while len(live):
            rest = size[live] - k
            chunk = x[begin[live] + k]
            short = rest < 8
            chunk[short] &= (np.uint64(1) << (8 * rest[short]).astype(np.uint64)) - np.uint64(1)
            out[live] = mix64(out[live] * np.uint64(0x9E3779B97F4A7C15) + chunk)
            k += 8
            live = live[size[live] > k]
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = int.from_bytes(hashlib.blake2b(raw[begin[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return out, first


class Sets:
    """The sets of texts, one after another: sorted distinct hashes of the windows of `size` words (of all words, if
    there are fewer), those of text i from at[i] to at[i + 1]."""

    def __init__(self, column: pa.Array, size: int = SHINGLE):
        word, first = word_hashes(*buffers(column))
        count = np.diff(first)
        tokens, docs = [], []
        for n in range(1, size + 1):
            some = count == n if n < size else count >= n
            if n < size:
                place, doc = first[:-1][some], np.flatnonzero(some)
            else:
                doc = np.repeat(np.arange(len(count)), np.where(some, count - n + 1, 0))
                each = np.where(some, count - n + 1, 0)
                place = np.arange(len(doc)) + np.repeat(first[:-1] - (np.cumsum(each) - each), each)
            token = np.full(len(place), n, np.uint64)
            with np.errstate(over="ignore"):
                for k in range(n):
                    token = token * np.uint64(0x9E3779B97F4A7C15) + word[place + k]
            tokens.append(mix64(token))
            docs.append(doc)
        token, doc = np.concatenate(tokens), np.concatenate(docs)
        order = np.lexsort((token, doc))
        token, doc = token[order], doc[order]
        keep = np.append(True, (token[1:] != token[:-1]) | (doc[1:] != doc[:-1]))[: len(token)]
        self.tokens, self.doc = token[keep], doc[keep]
        self.sizes = np.bincount(self.doc, minlength=len(count))
        self.at = np.append(0, np.cumsum(self.sizes))

    def __len__(self) -> int:
        return len(self.sizes)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.tokens[self.at[i] : self.at[i + 1]]

    def __iter__(self) -> Iterator[np.ndarray]:
        return (self[i] for i in range(len(self)))

    def numbers(self) -> np.ndarray:
        """A signed 64-bit number of each set."""
        with np.errstate(over="ignore"):
            total = np.append(np.uint64(0), np.cumsum(mix64(self.tokens ^ np.uint64(0xD1B54A32D192ED03)), dtype=np.uint64))
            return mix64(total[self.at[1:]] - total[self.at[:-1]] + self.sizes.astype(np.uint64)).astype(np.int64)


def enough(common: int, one: int, two: int) -> bool:
    return 100 * common >= 80 * (one + two - common)


def overlap(one: np.ndarray, two: np.ndarray) -> int:
    """Common tokens of two sorted sets."""
    if len(one) > len(two):
        one, two = two, one
    at = np.minimum(np.searchsorted(two, one), len(two) - 1)
    return int((two[at] == one).sum())


def prefix(tokens: np.ndarray, frequent: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of which every similar set has `least` (or all it must have) among its own, and which of them are
    frequent."""
    n = len(tokens)
    some = np.zeros(n, bool)
    if len(frequent) and n:
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        some = frequent[at] == tokens
    order = np.concatenate([np.flatnonzero(~some), np.flatnonzero(some)])[: n - -(-4 * n // 5) + least if n else 0]
    return tokens[order], some[order]


def prefixes(sets: Sets, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The `prefix` of every set, for LEAST_SHARED: tokens, which of them are frequent, and their sets."""
    some = np.zeros(len(sets.tokens), bool)
    if len(frequent) and len(some):
        some = frequent[np.minimum(np.searchsorted(frequent, sets.tokens), len(frequent) - 1)] == sets.tokens
    order = np.argsort(2 * sets.doc + some, kind="stable")
    rank = np.arange(len(order)) - sets.at[sets.doc]
    order = order[rank < (sets.sizes - -(-4 * sets.sizes // 5) + LEAST_SHARED)[sets.doc]]
    return sets.tokens[order], some[order], sets.doc[order]


# --- trees -----------------------------------------------------------------------------------------------


def bitmaps(tokens: list[np.ndarray], bits: int) -> np.ndarray:
    """[sets, bits / 64]"""
    out = np.zeros((len(tokens), bits), bool)
    for row, t in zip(out, tokens):
        row[(t & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(out, axis=1, bitorder="little").view("<u8").astype(np.uint64, copy=False)


def width(n: int, per_token: int, most: int = 1 << 19) -> int:
    """Bits of a bitmap for n tokens, a power of two."""
    return min(most, max(64, 1 << (per_token * n - 1).bit_length())) if n else 64


def leaf_pairs(tokens: list[np.ndarray], sizes: np.ndarray, bits: int = 0, labels: np.ndarray | None = None) -> np.ndarray:
    """Pairs (i < j) of sets that can be similar, by dual traversal of a signature tree.

    tokens: numbers whose low bits place a set's tokens in its bitmap (several tokens may share a number).
    labels: of sets that are connected already; no pairs of one label are given.
    """
    n = len(tokens)
    if n < 2:
        return np.empty((0, 2), np.int64)
    bits = bits or width(int(sizes.max()), 8)
    label = np.arange(n) if labels is None else labels
    order = np.lexsort(([int(t[0]) if len(t) else 0 for t in tokens], sizes, np.zeros(n) if labels is None else label))
    maps = bitmaps([tokens[i] for i in order], bits)
    least = most = label[order]
    low = high = sizes[order].astype(np.int64)
    # Tokens of a set beyond its bits: they can lie on any common bit.
    hidden = high - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
    levels = [(maps, low, high, hidden, least, most)]
    while len(low) > 1:
        maps, low, high, hidden, least, most = levels[-1]
        first = np.arange(0, len(low), 2)
        levels.append((np.bitwise_or.reduceat(maps, first, axis=0), np.minimum.reduceat(low, first), np.maximum.reduceat(high, first), np.maximum.reduceat(hidden, first), np.minimum.reduceat(least, first), np.maximum.reduceat(most, first)))
        low = levels[-1][1]
    pairs = np.zeros((1, 2), np.int64)
    for maps, low, high, hidden, least, most in levels[-2::-1]:
        children = np.stack([2 * pairs[:, :1] + [0, 0, 1, 1], 2 * pairs[:, 1:] + [0, 1, 0, 1]], axis=2).reshape(-1, 2)
        children = children[(children[:, 0] <= children[:, 1]) & (children < len(low)).all(axis=1)]
        if labels is not None:
            x, y = children.T
            children = children[(np.minimum(least[x], least[y]) < np.maximum(most[x], most[y]))]
        kept = []
        for a in range(0, len(children), 4096):
            x, y = children[a : a + 4096].T
            common = np.bitwise_count(maps[x] & maps[y]).sum(axis=1, dtype=np.int64) + np.minimum(hidden[x], hidden[y])
            shared = np.minimum(common, np.minimum(high[x], high[y]))
            fits = (9 * shared >= 4 * (low[x] + low[y])) & (5 * high[x] >= 4 * low[y]) & (5 * high[y] >= 4 * low[x])
            kept.append(np.stack([x[fits], y[fits]], axis=1))
        pairs = np.concatenate(kept) if kept else children
    pairs = order[pairs[pairs[:, 0] != pairs[:, 1]]]
    return np.sort(pairs, axis=1)


def packed_marks(tokens: np.ndarray) -> bytes:
    """The set's bitmap at four to eight bits a token."""
    bits = width(len(tokens), 4)
    return bitmaps([tokens], bits).tobytes()


def may_link(one: bytes, two: bytes, n: int, m: int) -> bool:
    """Whether sets of n and m tokens with these bitmaps can be similar."""
    a, b = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
    if len(a) > len(b):
        a, b, n, m = b, a, m, n
    b = np.bitwise_or.reduce(b.reshape(-1, len(a)), axis=0)
    bits = [int(np.bitwise_count(x).sum(dtype=np.int64)) for x in (a, b, a & b)]
    return enough(min(bits[2] + min(n - bits[0], m - bits[1]), n, m), n, m)


def marked_pairs(marks: list[bytes], sizes: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
    """Pairs (i < j) of sets that can be similar, by their packed bitmaps.

    Sets that are similar have bitmaps of one width or of neighbouring ones; so there is a tree for each width
    and the next, whose bitmaps are folded, and a pair belongs to the tree of its narrower bitmap.
    """
    places = [np.flatnonzero(np.unpackbits(np.frombuffer(m, np.uint8), bitorder="little")).astype(np.uint64) for m in marks]
    wide = np.array([8 * len(m) for m in marks])
    out = []
    for bits in np.unique(wide):
        rows = np.flatnonzero((wide == bits) | (wide == 2 * bits))
        pairs = rows[leaf_pairs([places[i] for i in rows], sizes[rows], int(bits), None if labels is None else labels[rows])]
        out.append(pairs[(wide[pairs] == bits).any(axis=1)])
    return np.concatenate(out) if out else np.empty((0, 2), np.int64)


def linked(numbers: np.ndarray, sets: list[np.ndarray], labels: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect the sets as all links between them would; pairs already connected aren't compared. Sets of
    one label are connected from the start."""
    root = list(range(len(sets)))
    if labels is not None:
        _, first, group = np.unique(labels, return_index=True, return_inverse=True)
        root = first[group].tolist()

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    sizes = np.array([len(s) for s in sets])
    pairs = leaf_pairs(sets, sizes, 0, labels)
    for i, j in pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))].tolist():
        a, b = find(i), find(j)
        if a != b and enough(overlap(sets[i], sets[j]), len(sets[i]), len(sets[j])):
            root[max(a, b)] = min(a, b)
            out.append((int(numbers[i]), int(numbers[j])))
    return out


# --- Spark -----------------------------------------------------------------------------------------------


def _measured(docs: DataFrame) -> DataFrame:
    """A row (doc_id, key, n, cls) per document, and rows (token, times) of what is frequent within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, n = set(), [], 0
        names = ["doc_id", "key", "n", "cls", "token", "times"]

        def frequent() -> pa.RecordBatch:
            token, times = np.unique(np.concatenate(held), return_counts=True)
            token, times = token[times >= FREQUENT].astype(np.int64), times[times >= FREQUENT]
            held.clear()
            none = pa.nulls(len(token), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, none, none, pa.array(token), pa.array(times, pa.int64())], names)

        for batch, column in slices(batches):
            sets = Sets(column)
            cls = sets.numbers()
            none = pa.nulls(len(sets), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(sets.sizes, pa.int64()), pa.array(cls, pa.int64()), none, none], names)
            new = np.array([c not in seen and not seen.add(c) for c in cls.tolist()], bool)
            held.append(sets.tokens[new[sets.doc]])
            n += len(held[-1])
            if n > CHUNK:
                yield frequent()
                n = 0
        if n:
            yield frequent()

    return docs.mapInArrow(run, "doc_id long, key long, n long, cls long, token long, times long")


def _entries(docs: DataFrame, frequent: Broadcast, buckets: int) -> DataFrame:
    """Prefix tokens with their class and its size, as arrays by bucket: of the token, or, if it is frequent
    (`often`), of token and class, so that no bucket gets all classes of a frequent token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, n = set(), [], 0
        names = ["bucket", "often", "tokens", "owners", "sizes"]

        def send() -> pa.RecordBatch:
            token, often, owner, size = (np.concatenate([h[i] for h in held]) for i in range(4))
            held.clear()
            key = np.where(often, token ^ owner.astype(np.uint64), token)
            group = (mix64(key) % np.uint64(buckets)).astype(np.int64) * 2 + often
            order = np.argsort(group, kind="stable")
            first = np.flatnonzero(np.append(True, np.diff(group[order]) != 0))
            rows = [(int(group[order[a]]), *(v[order[a:b]].tobytes() for v in (token, owner, size))) for a, b in zip(first, [*first[1:], len(order)])]
            columns = [pa.array([r[0] // 2 for r in rows], pa.int32()), pa.array([r[0] % 2 == 1 for r in rows], pa.bool_())]
            return pa.RecordBatch.from_arrays(columns + [pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2, 3)], names)

        for _, column in slices(batches):
            sets = Sets(column)
            cls = sets.numbers()
            new = np.array([c not in seen and not seen.add(c) for c in cls.tolist()], bool)
            token, often, doc = prefixes(sets, frequent.value)
            use = new[doc]
            doc = doc[use]
            held.append((token[use], often[use], cls[doc], sets.sizes[doc].astype(np.int32)))
            n += len(doc)
            if n > BUCKET:
                yield send()
                n = 0
        if n:
            yield send()

    return docs.select("text").mapInArrow(run, "bucket int, often boolean, tokens binary, owners binary, sizes binary")


def _shared(table: pa.Table) -> pa.Table:
    """Of a bucket the (token, cls, n, often, times) whose token has another class of a size near enough. Tokens that the
    same classes have are one, a hash of these classes stands for all `times` of them (but for frequent tokens, as a
    bucket has a part of their classes)."""
    out = []
    for often in (False, True):
        part = table.filter(pc.equal(table.column("often"), often))
        token, owner, n = (np.frombuffer(b"".join(part.column(c).to_pylist()), k) for c, k in (("tokens", np.int64), ("owners", np.int64), ("sizes", np.int32)))
        order = np.lexsort((owner, n, token))
        token, owner, n = token[order], owner[order], n[order].astype(np.int64)
        if len(token):
            new = np.append(True, (token[1:] != token[:-1]) | (owner[1:] != owner[:-1]))
            token, owner, n = token[new], owner[new], n[new]
            near = (token[1:] == token[:-1]) & (5 * n[:-1] >= 4 * n[1:])
            keep = np.append(False, near) | np.append(near, False) | often
            token, owner, n = token[keep], owner[keep], n[keep]
            times = np.ones(len(token), np.int64)
            if not often and len(token):
                first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
                with np.errstate(over="ignore"):
                    group = mix64(np.add.reduceat(mix64(owner.astype(np.uint64)), first)).astype(np.int64)
                token = np.repeat(group, np.diff(np.append(first, len(token))))
                order = np.lexsort((owner, token))
                token, owner, n = token[order], owner[order], n[order]
                new = np.append(True, (token[1:] != token[:-1]) | (owner[1:] != owner[:-1]))
                token, owner, n, times = token[new], owner[new], n[new], np.diff(np.append(np.flatnonzero(new), len(new)))
            out.append((token, owner, n, times, np.full(len(token), often)))
    columns = [np.concatenate([o[i] for o in out]) for i in range(5)] if out else [np.empty(0, np.int64)] * 4 + [np.empty(0, bool)]
    return pa.table(dict(zip(["token", "cls", "n", "times", "often"], columns)))


def _able(found: DataFrame) -> DataFrame:
    """The rows of `_shared` whose token has two classes, of classes that share as many tokens as a similar one would."""
    common = found.where("often").groupBy("token").agg(F.count("*").alias("count")).where("count > 1").select("token")
    # No more tokens than MOST_FREQUENT.
    rows = found.where("not often").unionByName(found.where("often").join(F.broadcast(common), "token", "left_semi"))
    must = F.least(F.lit(LEAST_SHARED), F.ceil(4 * F.col("n") / 5))
    able = rows.groupBy("cls").agg(F.sum("times").alias("times"), F.max("n").alias("n")).where(F.col("times") >= must)
    return rows.join(able.select("cls"), "cls", "left_semi")


def _maybe_wanted(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, text) of the documents whose key is wanted, and of a few others: by a bitmap of WANTED_BITS, so that a join
    that moves texts by key doesn't move them all."""
    place = F.pmod("key", F.lit(WANTED_BITS)) + 1
    parts = wanted.select(F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("bit"))
    parts = parts.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    bits = np.zeros(WANTED_BITS // 8, np.uint8)
    for r in parts:
        bits[(r.part - 1) * len(r.bits) : r.part * len(r.bits)] = np.frombuffer(r.bits, np.uint8)
    shipped = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("key").to_numpy() % WANTED_BITS
            yield batch.filter(pa.array((shipped.value[at >> 3] >> (at & 7)) & 1 == 1))

    return docs.select("key", "text").mapInArrow(run, "key long, text string")


def _texts(docs: DataFrame, wanted: DataFrame, buckets: int) -> DataFrame:
    """(cls, marks, text) of the wanted (key, cls, repeated), partitioned by cls; marks: the bitmap of the set. Rows that
    repeat a key are thinned to one a task before they move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = set()
        for batch, column in slices(batches):
            sets = Sets(column)
            own = np.flatnonzero(sets.numbers() == batch.column("cls").to_numpy())
            cls, repeated = (batch.column(c).to_pylist() for c in ("cls", "repeated"))
            own = [i for i in own.tolist() if not repeated[i] or (cls[i] not in sent and not sent.add(cls[i]))]
            marks = [packed_marks(sets[i]) for i in own]
            at = pa.array(own, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("cls").take(at), pa.array(marks, pa.binary()), column.take(at).cast(pa.string())], ["cls", "marks", "text"])

    found = _maybe_wanted(docs, wanted).join(wanted, "key").select("cls", "text", "repeated").mapInArrow(run, "cls long, marks binary, text string")
    return found.repartition(buckets, "cls").dropDuplicates(["cls"])


def _blocks(size: int) -> F.Column:
    return F.greatest(F.ceil(F.col("count") / size), F.ceil(F.col("tokens") / TREE_TOKENS)).cast("int").alias("blocks")


def _tree_sets(table: pa.Table, first: np.ndarray) -> list[np.ndarray]:
    return list(Sets(pa.concat_arrays([c.cast(pa.large_string()) for c in table.column("text").chunks]).take(pa.array(first))))


def _first_links(shared: DataFrame, texts: DataFrame) -> DataFrame:
    """Links of the first round."""
    home = staged(shared.groupBy("cls").agg(F.min("token").alias("token"), F.max("n").alias("n")), "tree-homes")
    groups = home.groupBy("token").agg(F.count("*").alias("count"), F.sum("n").alias("tokens"), F.min("cls").alias("pivot")).where("count > 1")
    groups = groups.select("token", "pivot", _blocks(TREE_SIZE))
    own = home.join(groups, "token").select("cls", "token", F.pmod(F.xxhash64("cls"), "blocks").cast("int").alias("block"))
    pivots = groups.where("blocks > 1").select(F.col("pivot").alias("cls"), "token", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    members = own.unionByName(pivots).join(texts.select("cls", "text"), "cls").select("token", "block", "cls", "text")

    def tree(table: pa.Table) -> pa.Table:
        cls, first = np.unique(table.column("cls").to_numpy(), return_index=True)
        return _links(linked(cls, _tree_sets(table, first)))

    return members.groupBy("token", "block").applyInArrow(tree, "a long, b long")


def _links(found: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})


def _named(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """(token, cls, n, label, weight): the component of each class and the number of its classes."""
    named = labels.join(labels.groupBy("label").agg(F.count("*").alias("weight")), "label").withColumnRenamed("node", "cls")
    return shared.join(named, "cls", "left").select("token", "cls", "n", F.coalesce("label", "cls").alias("label"), F.coalesce("weight", F.lit(1)).alias("weight"))


def _bridges(shared: DataFrame, texts: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """Links of classes to one member each of larger components that they share tokens with."""
    rows = _named(shared, labels)
    largest = F.max(F.struct("weight", "label", F.xxhash64("cls", F.lit(turn)).alias("any"), "cls", "n")).alias("pivot")
    pivots = rows.groupBy("token").agg(largest, F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most")
    pivots = pivots.select("token", *(F.col(f"pivot.{c}").alias(f"pivot_{c}") for c in ("cls", "label", "n")))
    near = (5 * F.col("n") >= 4 * F.col("pivot_n")) & (5 * F.col("pivot_n") >= 4 * F.col("n"))
    pairs = rows.join(pivots, "token").where((F.col("label") != F.col("pivot_label")) & near)
    pairs = pairs.groupBy("cls", "pivot_cls", "n", "pivot_n").agg(F.count("*").alias("times"))
    best = F.max(F.struct("times", F.xxhash64("pivot_cls", F.lit(turn)).alias("any"), "pivot_cls", "n", "pivot_n")).alias("best")
    pairs = pairs.groupBy("cls").agg(best).select(F.col("cls").alias("a"), F.col("best.pivot_cls").alias("b"), "best.n", F.col("best.pivot_n").alias("m"))
    # Written, the planner knows how few these are.
    possible = staged(_possible(staged(pairs, "tree-pairs"), texts), "tree-pairs")
    return _confirmed(possible, texts)


def _both(pairs: DataFrame, texts: DataFrame, value: str) -> DataFrame:
    """The pairs (a, b) with the value of a as `one` and of b as `two`. Many pairs may have one b: so a is joined where
    its bucket lies, and the values of all b are a table of their own, which is broadcast if small and else may be
    split where a b is frequent."""
    ends = pairs.select(F.col("b").alias("cls")).distinct()
    two = staged(texts.join(ends, "cls", "left_semi").select(F.col("cls").alias("b"), F.col(value).alias("two")), "tree-pivots")
    one = texts.select(F.col("cls").alias("a"), F.col(value).alias("one"))
    return pairs.join(one, "a").join(two, "b")


def _possible(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of (a, b, n, m) whose bitmaps allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("one", "two", "n", "m"))
            good = pa.array([may_link(*row) for row in zip(*columns)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(good), batch.column("b").filter(good)], ["a", "b"])

    return _both(pairs, texts, "marks").select("a", "b", "n", "m", "one", "two").mapInArrow(run, "a long, b long")


def _cut(rows: DataFrame, size: int) -> DataFrame:
    """(token, i, j, cls, n, label): the trees of tokens that several components have. Tokens with the same smallest class
    are one tree, as groups of near copies share many tokens in slightly different parts: each class comes once, whatever
    the number of these tokens. Above `size` classes there is a tree for each pair of blocks."""
    tokens = rows.groupBy("token").agg(F.min("cls").alias("tree"), F.min("label").alias("least"), F.max("label").alias("most"))
    tokens = tokens.where("least <> most").select("token", "tree")
    own = rows.join(tokens, "token").groupBy(F.col("tree").alias("token"), "cls").agg(F.max("n").alias("n"), F.max("label").alias("label"))
    groups = own.groupBy("token").agg(F.count("*").alias("count"), F.sum("n").alias("tokens")).select("token", _blocks(size))
    own = own.join(groups, "token").select("token", "cls", "n", "label", "blocks", F.pmod(F.xxhash64("cls"), "blocks").cast("int").alias("block"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    own = own.select("token", "cls", "n", "label", "block", other)
    return own.select("token", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "cls", "n", "label")


def _open(shared: DataFrame, texts: DataFrame, labels: DataFrame) -> DataFrame:
    """(token, cls, n, label) of classes that can have a link to another component's class with the token."""
    members = _cut(_named(shared, labels), MARKED_SIZE).join(texts.select("cls", "marks"), "cls").select("token", "i", "j", "cls", "label", "n", "marks")

    def tree(table: pa.Table) -> pa.Table:
        _, first = np.unique(table.column("cls").to_numpy(), return_index=True)
        table = table.take(pa.array(first))
        pairs = marked_pairs(table.column("marks").to_pylist(), table.column("n").to_numpy(), table.column("label").to_numpy())
        return table.select(["token", "cls", "n", "label"]).take(pa.array(np.unique(pairs)))

    return members.groupBy("token", "i", "j").applyInArrow(tree, "token long, cls long, n long, label long").distinct()


def _last_links(opened: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between components, by exact comparison of the open classes of every token."""
    members = staged(_cut(opened, TREE_SIZE // 2), "tree-open").join(texts.select("cls", "text"), "cls").select("token", "i", "j", "cls", "label", "text")

    def tree(table: pa.Table) -> pa.Table:
        cls, first = np.unique(table.column("cls").to_numpy(), return_index=True)
        return _links(linked(cls, _tree_sets(table, first), table.column("label").to_numpy()[first]))

    return members.groupBy("token", "i", "j").applyInArrow(tree, "a long, b long").distinct()


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that are links, by their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, column in slices(batches, "one"):
            one, two = Sets(column), Sets(batch.column("two").cast(pa.large_string()))
            good = pa.array([enough(overlap(a, b), len(a), len(b)) for a, b in zip(one, two)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(good), batch.column("b").filter(good)], ["a", "b"])

    return _both(pairs, texts, "text").select("a", "b", "one", "two").mapInArrow(run, "a long, b long")


def _labels(shared: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, label): the component of every class that has a link, by the three steps."""
    links = staged(_first_links(shared, texts), "tree-links")
    labels = components(links)
    for turn in range(BRIDGES):
        more = staged(_bridges(shared, texts, labels, turn), "tree-links")
        if more.isEmpty():
            break
        links = links.unionByName(more)
        labels = components(links)
    opened = staged(_open(shared, texts, labels), "tree-open")
    more = staged(_last_links(opened, texts), "tree-links")
    return labels if more.isEmpty() else components(links.unionByName(more))


def document_key() -> F.Column:
    """A hash of text and id; rows that repeat both have the same."""
    return F.xxhash64("text", F.col("doc_id").cast("long"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    return near_groups(docs).select("doc_id", "n_shingles", "component_id")


def near_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n_shingles, component_id, component) of every document: component is the number of its
    component whatever the ids are, null for empty sets; key is its `document_key`."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("key", document_key())
    measured = staged(_measured(docs), "tree-sets")
    frequent = measured.where("token is not null").groupBy("token").agg(F.sum("times").alias("times"))
    frequent = frequent.orderBy(F.col("times").desc(), "token").limit(MOST_FREQUENT).select("token").collect()
    frequent = np.sort(np.array([r.token for r in frequent], np.int64).astype(np.uint64))
    rows = measured.where("cls is not null").select("doc_id", "key", "n", "cls")
    total = rows.agg(F.sum("n")).first()[0] or 0
    buckets = 1 + total // 5 // BUCKET

    shipped = spark.sparkContext.broadcast(frequent)
    found = staged(_entries(docs, shipped, buckets).groupBy("bucket").applyInArrow(_shared, "token long, cls long, n long, times long, often boolean"), "tree-shared")
    # Several buckets can have tokens of the same classes, and several tasks the classes of a frequent token.
    shared = staged(_able(found).groupBy("token", "cls").agg(F.max("n").alias("n")), "tree-shared")
    wanted = rows.join(shared.select("cls").distinct(), "cls", "left_semi").groupBy("cls", "key").agg(F.count("*").alias("times"))
    # The key that fewest rows have; only rows that repeat text and id (or have none) share one.
    wanted = wanted.groupBy("cls").agg(F.min(F.struct("times", "key")).alias("row")).select("cls", "row.key", (F.col("row.times") > 1).alias("repeated"))
    wanted = staged(wanted, "tree-wanted")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with staged_in_buckets(_texts(docs, wanted, buckets), "tree-texts", "cls", buckets) as texts:
        labels = _labels(shared, texts)

    least = rows.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("least"))
    least = least.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    smallest = least.groupBy("label").agg(F.min("least").alias("component_id"))
    named = least.join(smallest, "label").select("cls", "component_id", F.col("label").alias("component"))
    full = rows.where("n > 0").join(named, "cls").select("doc_id", "key", F.col("n").alias("n_shingles"), "component_id", "component")
    empty = rows.where("n = 0").select("doc_id", "key", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("component"))
    return full.unionByName(empty)

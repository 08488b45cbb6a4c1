"""Approximate nearest neighbours by learned partitions, for the largest inner product.

On a bounded sample (`sample` vectors, by a hash of the id) the exact neighbour graph is cut into `partitions`
parts of equal size: recursive bisection at the median of the graph's second eigenvector, then swaps across
the cut while they save edges. A small network learns from the sample which parts hold a vector's neighbours.
Every vector of the table is indexed under its most probable part; a query is routed to its most probable
parts, as many as give `recall` on the sample (where neighbours are further apart than in the whole table),
or more until they hold enough candidates; there all vectors are compared exactly, in double precision.

Parts and their queries are cut into blocks of bounded size by a hash, and each block pair keeps its best k
per query, so neither a hot part nor copies of one vector meet in one task or make more rows.

For a larger table raise `partitions` with its square root and `sample` with them.

Defined cases: rows without an id, and vectors that are null, empty, zero, or hold a null or a non-finite
component take no part, nor do those of another dimension than the most frequent one of the sample; a query's
own row is every row with its id; rows that repeat an id are candidates each, of repeated query ids the smallest
vector asks; equal scores rank by the smaller vec_id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthline.session import staged

BLOCK = 4_096
NEAR = 1e-9


def neighbours(x: np.ndarray, of: np.ndarray, k: int) -> np.ndarray:
    """For rows `of` the k other rows of x with the largest inner product, nearest first."""
    out = np.empty((len(of), k), np.int64)
    for a in range(0, len(of), 512):
        rows = of[a : a + 512]
        s = x[rows] @ x.T
        s[np.arange(len(rows)), rows] = -np.inf
        out[a : a + 512] = np.argsort(-s, axis=1, kind="stable")[:, :k]
    return out


def bisect(members: np.ndarray, edges: np.ndarray, left: int, rng: np.random.Generator) -> np.ndarray:
    """Flags of the members on the second side of a cut of the graph; the first side gets `left` of them."""
    place = np.full(max(int(members.max()), int(edges.max(initial=0))) + 1, -1)
    place[members] = np.arange(len(members))
    inner = edges[(place[edges[:, 0]] >= 0) & (place[edges[:, 1]] >= 0)]
    a, b = place[inner[:, 0]], place[inner[:, 1]]
    n = len(members)
    degree = np.bincount(a, minlength=n) + 1.0
    root = np.sqrt(degree)
    v = rng.standard_normal(n)
    for _ in range(60):
        v -= root * (root @ v) / (root @ root)
        u = v / root
        v = 0.5 * v + 0.5 * (np.bincount(a, u[b], n) + u) / root
        v /= np.linalg.norm(v) + 1e-12
    side = np.zeros(n, bool)
    side[np.argsort(v / root, kind="stable")[left:]] = True
    for _ in range(20):
        apart = np.bincount(a, side[a] != side[b], n)
        gain = 2 * apart - np.bincount(a, minlength=n)
        one, two = np.flatnonzero(~side), np.flatnonzero(side)
        one, two = one[np.argsort(-gain[one], kind="stable")], two[np.argsort(-gain[two], kind="stable")]
        m = min(len(one), len(two))
        swap = np.flatnonzero(gain[one[:m]] + gain[two[:m]] > 0)
        if not len(swap):
            break
        swap = swap[: max(1, len(swap) // 4)]
        side[one[swap]], side[two[swap]] = True, False
    return side


def balanced_parts(edges: np.ndarray, n: int, parts: int, rng: np.random.Generator) -> np.ndarray:
    out, todo = np.zeros(n, np.int64), [(np.arange(n), 0, parts)]
    while todo:
        members, first, count = todo.pop()
        if count == 1 or len(members) < 2:
            out[members] = first
            continue
        half = count // 2
        side = bisect(members, edges, len(members) * half // count, rng)
        todo += [(members[~side], first, half), (members[side], first + half, count - half)]
    return out


@dataclass
class Router:
    """A network with one hidden layer; `scale` is the sample's mean norm."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    scale: float
    probes: int = 1

    def inputs(self, x: np.ndarray) -> np.ndarray:
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        return np.hstack([x / norm, np.minimum(norm / self.scale, 4)])

    def order(self, x: np.ndarray) -> np.ndarray:
        """Parts by falling probability."""
        hidden = np.maximum(0, self.inputs(x) @ self.w1 + self.b1)
        return np.argsort(-(hidden @ self.w2 + self.b2), axis=1, kind="stable")


def train_router(x: np.ndarray, goal: np.ndarray, rng: np.random.Generator, hidden: int = 96, epochs: int = 60) -> Router:
    """Cross-entropy against the shares of a vector's neighbours in each part, by Adam in small batches."""
    d, parts = x.shape[1] + 1, goal.shape[1]
    net = Router(rng.standard_normal((d, hidden)) * np.sqrt(2 / d), np.zeros(hidden), rng.standard_normal((hidden, parts)) * np.sqrt(1 / hidden), np.zeros(parts), float(np.linalg.norm(x, axis=1).mean()))
    data = net.inputs(x)
    params = [net.w1, net.b1, net.w2, net.b2]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), 256):
            rows = order[a : a + 256]
            z = data[rows] @ net.w1 + net.b1
            h = np.maximum(0, z)
            logits = h @ net.w2 + net.b2
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            g = (p - goal[rows]) / len(rows)
            gz = (g @ net.w2.T) * (z > 0)
            step += 1
            for k, (param, grad) in enumerate(zip(params, [data[rows].T @ gz, gz.sum(axis=0), h.T @ g, g.sum(axis=0)])):
                first[k] = 0.9 * first[k] + 0.1 * (grad + 1e-4 * param)
                second[k] = 0.999 * second[k] + 0.001 * grad**2
                param -= 3e-3 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return net


def fit_router(x: np.ndarray, partitions: int = 16, k: int = 20, recall: float = 0.96, seed: int = 5) -> Router:
    rng = np.random.default_rng(seed)
    n = len(x)
    parts = max(1, min(partitions, n // 16))
    degree = min(10, n - 1)
    if parts == 1:
        d = x.shape[1] + 1
        return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), float(np.linalg.norm(x, axis=1).mean()))
    near = neighbours(x, np.arange(n), degree)
    edges = np.stack([np.repeat(np.arange(n), degree), near.ravel()], axis=1)
    edges = np.unique(np.vstack([edges, edges[:, ::-1]]), axis=0)
    label = balanced_parts(edges, n, parts, rng)
    goal = np.zeros((n, parts))
    np.add.at(goal, (np.repeat(np.arange(n), degree), label[near.ravel()]), 0.7 / degree)
    goal[np.arange(n), label] += 0.3
    net = train_router(x, goal, rng)
    home = net.order(x)[:, 0]
    asked = rng.permutation(n)[: min(n, 1_000)]
    truth = neighbours(x, asked, min(k, n - 1))
    rank = np.argsort(net.order(x[asked]), axis=1)
    found = rank[np.arange(len(asked))[:, None], home[truth]]
    share = [(found < m).mean() for m in range(1, parts + 1)]
    net.probes = 1 + int(np.argmax(np.array(share) >= recall)) if max(share) >= recall else parts
    return net


def vectors(column: pa.Array) -> np.ndarray:
    """All vectors of an array<double> column without nulls and of one length, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id long, v array<double>) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0)
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(fine)


def nearest(embeddings: DataFrame, every: int = 20, k: int = 20, partitions: int = 16, sample: int = 4_000, recall: float = 0.96) -> DataFrame:
    """(query_id, rank, vec_id, score): for every vec_id divisible by `every` the k nearest other vectors found."""
    spark = embeddings.sparkSession
    rows = usable(embeddings)
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample).collect()
    if not picked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    (dim, _), = Counter(len(r.v) for r in picked).most_common(1)
    net = fit_router(np.array([r.v for r in picked if len(r.v) == dim]), partitions, k, recall)
    rows = rows.where(F.size("v") == dim)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = vectors(batch.column("v"))
            part = net.order(x)[:, 0] if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int32())], ["vec_id", "v", "part"])

    index = staged(rows.mapInArrow(place, "vec_id long, v array<double>, part int"), "ann-index")
    held = {r.part: r["count"] for r in index.groupBy("part").count().collect()}
    size = np.array([held.get(p, 0) for p in range(len(net.b2))])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = vectors(batch.column("v"))
            if not len(x):
                continue
            order = net.order(x)
            before = np.cumsum(size[order], axis=1) - size[order]
            ask = (np.arange(order.shape[1]) < net.probes) | (before <= k)
            i, j = np.nonzero(ask & (size[order] > 0))
            yield pa.RecordBatch.from_arrays([batch.column("query_id").take(pa.array(i)), batch.column("q").take(pa.array(i)), pa.array(order[i, j], pa.int32())], ["query_id", "q", "part"])

    queries = index.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q"))
    routed = staged(queries.select("query_id", F.col("q").alias("v"), "q").mapInArrow(route, "query_id long, q array<double>, part int"), "ann-queries")
    asked = {r.part: r["count"] for r in routed.groupBy("part").count().collect()}
    cuts = [(p, -(-n // BLOCK), -(-asked[p] // BLOCK)) for p, n in held.items() if p in asked]
    if not cuts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    cuts = F.broadcast(spark.createDataFrame(cuts, "part int, data_blocks int, query_blocks int"))
    data = index.join(cuts, "part").select("part", F.pmod(F.xxhash64("vec_id"), "data_blocks").cast("int").alias("d"), F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("b"), "vec_id", "v")
    wanted = routed.join(cuts, "part").select("part", F.explode(F.sequence(F.lit(0), F.col("data_blocks") - 1)).alias("d"), F.pmod(F.xxhash64("query_id"), "query_blocks").cast("int").alias("b"), "query_id", "q")

    def compare(one: pa.Table, two: pa.Table) -> pa.Table:
        if not one.num_rows or not two.num_rows:
            return _found([])
        ids, x = one.column("vec_id").to_numpy(), vectors(one.column("v").combine_chunks())
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        asking, q = two.column("query_id").to_numpy(), vectors(two.column("q").combine_chunks())
        return _found([(query, ids[at], score) for a in range(0, len(q), 256) for query, at, score in _best(asking[a : a + 256], q[a : a + 256], ids, x, k)])

    found = data.groupBy("part", "d", "b").cogroup(wanted.groupBy("part", "d", "b")).applyInArrow(compare, "query_id long, vec_id long, score double")
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _best(asking: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the places and exact scores of its best k rows; ids sorted.

    The matrix product finds all rows that can be among them; their scores are then summed row by row, so
    that copies of a vector score alike and rank by id.
    """
    rough = q @ x.T
    longest = np.linalg.norm(x, axis=1).max()
    rough[asking[:, None] == ids[None]] = -np.inf
    for i, query in enumerate(asking):
        r = rough[i]
        least = np.partition(r, len(r) - k)[len(r) - k] if len(r) > k else -np.inf
        slack = NEAR * (np.linalg.norm(q[i]) * longest + 1e-300)
        at = np.flatnonzero((r >= least - slack) & (r > -np.inf))
        score = (x[at] * q[i]).sum(axis=1)
        top = np.lexsort((at, -score))[:k]
        yield int(query), at[top], score[top]


def _found(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.Table:
    query = np.repeat(np.array([p[0] for p in parts], np.int64), [len(p[1]) for p in parts]) if parts else np.zeros(0, np.int64)
    vec = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
    score = np.concatenate([p[2] for p in parts]) if parts else np.zeros(0)
    return pa.table({"query_id": query, "vec_id": vec, "score": score})

"""Operator 4, approximate nearest neighbours by learned partitions (after Neural LSH, Dong et al., 2020).

On a bounded sample: the graph of nearest neighbours is cut into balanced parts (halves of halves, split along the
main axis and refined by swaps that cut fewer edges), and a small network learns which parts hold a vector's
neighbours. The network then files every vector of the table in its most probable part, and sends a query to its most
probable parts, as many as held-out sample vectors need to find ``recall`` of their neighbours. Candidates are ranked
by exact cosine in double precision, in blocks of bounded size of candidates and of queries, so a part that holds a
third of all rows, or copies of one vector, is split.

Definite results: vectors that are null, zero, hold null or non-finite components, or have another length than most
take no part; rows that repeat an id count once; ties go to the smaller id. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.tables import written

SAMPLE = 8192  # vectors that the partitioning is learned from, whatever the table's size
PARTS = 32
NEAREST = 10  # edges of a vector in the neighbour graph
HIDDEN = 128
BLOCK = 4096  # candidates, or queries, in a block at most (about)


def neighbour_graph(x: np.ndarray, k: int, of: np.ndarray | None = None) -> np.ndarray:
    """The k nearest rows of x by dot product for each row of x (itself excluded), or for each row of ``of``."""
    out = []
    rows = x if of is None else of
    for a in range(0, len(rows), 1024):
        s = rows[a : a + 1024] @ x.T
        if of is None:
            s[np.arange(len(s)), a + np.arange(len(s))] = -np.inf
        out.append(np.argpartition(-s, k - 1, axis=1)[:, :k])
    return np.concatenate(out)


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """A part for each row, of equal sizes (parts: a power of two) and with few graph edges between them."""
    ends = np.concatenate([np.stack([np.repeat(np.arange(len(x)), graph.shape[1]), graph.ravel()]),
                           np.stack([graph.ravel(), np.repeat(np.arange(len(x)), graph.shape[1])])], axis=1)
    label = np.zeros(len(x), dtype=np.int64)
    size = 1
    while size < parts:
        half = np.zeros(len(x), dtype=np.int64)
        for p in range(size):
            rows = np.flatnonzero(label == p)
            centred = x[rows] - x[rows].mean(axis=0)
            axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
            half[rows[np.argsort(centred @ axis, kind="stable")[len(rows) // 2 :]]] = 1
        inside = ends[:, label[ends[0]] == label[ends[1]]]
        for _ in range(30):
            across = half[inside[0]] != half[inside[1]]
            gain = np.bincount(inside[0], weights=np.where(across, 1.0, -1.0), minlength=len(x))
            moved = 0
            for p in range(size):
                zero, one = (np.flatnonzero((label == p) & (half == h)) for h in (0, 1))
                zero, one = zero[np.argsort(-gain[zero], kind="stable")], one[np.argsort(-gain[one], kind="stable")]
                n = min(len(zero), len(one))
                better = int(np.count_nonzero(gain[zero[:n]] + gain[one[:n]] > 0))
                better = -(-better // 4)  # a few at a time: gains change with the neighbours
                half[zero[:better]], half[one[:better]] = 1, 0
                moved += better
            if not moved:
                break
        label, size = 2 * label + half, 2 * size
    return label


@dataclass
class Router:
    """A network with one hidden layer: the probability of each part to hold a vector's neighbours."""

    weights: list[np.ndarray]
    probes: int

    def __call__(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        z = np.maximum(x @ w1 + b1, 0) @ w2 + b2
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def trained(x: np.ndarray, target: np.ndarray, epochs: int = 40, rate: float = 2e-3) -> Router:
    """Cross-entropy against ``target`` (a distribution over the parts for each row), by Adam."""
    rng = np.random.default_rng(7)
    w = [rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
         rng.normal(0, (1 / HIDDEN) ** 0.5, (HIDDEN, target.shape[1])), np.zeros(target.shape[1])]
    m, v, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    router = Router(w, 1)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            rows = order[at : at + 256]
            hidden = np.maximum(x[rows] @ w[0] + w[1], 0)
            d = (router(x[rows]) - target[rows]) / len(rows)
            back = (d @ w[2].T) * (hidden > 0)
            t += 1
            for i, g in enumerate((x[rows].T @ back, back.sum(axis=0), hidden.T @ d, d.sum(axis=0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] -= rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return router


def learn(x: np.ndarray, parts: int = PARTS, recall: float = 0.97, k: int = 5) -> Router:
    """The router for unit vectors like the rows of x (a bounded sample). A fifth of them is held out to find how many
    parts a query must visit."""
    test, x = x[::5], x[np.arange(len(x)) % 5 != 0]
    while parts > 1 and len(x) < 32 * parts:
        parts //= 2
    if parts == 1 or not len(test):
        return Router([np.zeros((x.shape[1] if x.ndim > 1 else 0, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)], 1)
    graph = neighbour_graph(x, min(NEAREST, len(x) - 1))
    label = balanced_parts(x, graph, parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), label[graph].ravel()), 1.0)
    target[np.arange(len(x)), label] += 1.0
    router = trained(x, target / target.sum(axis=1, keepdims=True))
    near = router(x).argmax(axis=1)[neighbour_graph(x, min(k, len(x)), test)]
    rank = np.argsort(np.argsort(-router(test), axis=1, kind="stable"), axis=1)
    found = np.sort(np.take_along_axis(rank, near, axis=1).ravel())
    router.probes = int(found[min(len(found) - 1, int(np.ceil(recall * len(found))))]) + 1
    return router


def valid(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id, v (array of double): vectors that can be compared, of the commonest length."""
    v = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    good = F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & good)
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (length["n"] if length else 0))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def routed(rows: DataFrame, router: Router, probes: int) -> DataFrame:
    """Each row with ``parts``: its most probable parts, best first."""
    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("v"))
            if router.weights[2].shape[1] == 1:
                best = np.zeros((len(x), 1), dtype=np.int32)
            else:
                best = np.argsort(-router(unit(x)), axis=1, kind="stable")[:, :probes].astype(np.int32)
            width = best.shape[1]
            parts = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * width), pa.array(best.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, parts], ["vec_id", "v", "parts"])

    return rows.mapInArrow(route, "vec_id long, v array<double>, parts array<int>")


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row; the same for the same two vectors, wherever they lie. Scaled first, so that squares don't overflow."""
    a, b = (x / np.abs(x).max(axis=1, keepdims=True) for x in (a, b))
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


TIE = 1e-9  # scores from unit vectors are that close to the exact ones


def best_in_block(k: int):
    """For cogrouped blocks: the k nearest candidates of each query, and any that could tie with them."""
    def rank(asked: pa.Table, filed: pa.Table) -> pa.Table:
        query, key = asked.column("vec_id").to_numpy(), filed.column("vec_id").to_numpy()
        out = [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        if len(query) and len(key):
            x, y = matrix(asked.column("v").combine_chunks()), matrix(filed.column("v").combine_chunks())
            order = np.lexsort((key, *y.T))
            y, key = y[order], key[order]
            new = np.ones(len(y), dtype=bool)
            new[1:] = (y[1:] != y[:-1]).any(axis=1)
            fresh = new.copy()
            fresh[1:] |= key[1:] != key[:-1]  # a repeated row counts once
            y, key, new = y[fresh], key[fresh], new[fresh]
            head = np.flatnonzero(new)  # copies of one vector lie together, smaller ids first
            copies = np.append(head[1:], len(y)) - head
            s = unit(x) @ unit(y[head]).T
            # the k nearest besides the query's own vector, and all that could tie with the last of them
            least = -np.partition(-s, min(k, s.shape[1] - 1), axis=1)[:, min(k, s.shape[1] - 1)]
            q, top = np.nonzero(s >= least[:, None] - TIE)
            # of equal vectors no more than k ids, besides the query's own, can be wanted
            take = np.minimum(copies[top], k + 1)
            q = np.repeat(q, take)
            c = np.repeat(head[top], take) + np.arange(len(q)) - np.repeat(np.cumsum(take) - take, take)
            other = key[c] != query[q]
            q, c = q[other], c[other]
            score = cosines(x[q], y[c])
            order = np.lexsort((key[c], -score, q))
            q, c, score = q[order], c[order], score[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            q, c, score = (z[place < k] for z in (q, c, score))
            out = [query[q], key[c], score]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, out))))

    return rank


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, sample: int = SAMPLE, parts: int = PARTS,
            recall: float = 0.97, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k nearest rows of every row whose id is divisible by ``every``: query_id, rank, vec_id, score."""
    rows = valid(vectors, key, vector)
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()  # bounded by `sample`
    x = unit(np.array([r["v"] for r in picked])) if picked else np.zeros((0, 1))
    router = learn(x, parts, recall, k)
    index = written(routed(rows, router, 1).select("vec_id", "v", F.col("parts")[0].alias("part")), "filed")
    asked = written(routed(rows.where(F.col("vec_id") % every == 0), router, router.probes)
                    .select("vec_id", "v", F.explode("parts").alias("part")), "asked")
    found = written(_compared(asked, index, k), "found")
    # a query whose parts hold fewer than k others goes on to all parts: no such query on tables with many rows a part
    counts = found.groupBy("query_id").agg(F.count("*").alias("n"))
    queries = rows.where(F.col("vec_id") % every == 0)
    short = written(queries.join(counts, F.col("vec_id") == F.col("query_id"), "left")
                    .where(F.coalesce("n", F.lit(0)) < k).select("vec_id", "v"), "short")
    if router.probes < router.weights[2].shape[1] and not short.isEmpty():
        everywhere = short.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(router.weights[2].shape[1] - 1))))
        found = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(_compared(everywhere, index, k))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _compared(asked: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score: for every query of ``asked`` (vec_id, v, part) the nearest rows of its parts, by blocks."""
    # as many rows as parts
    here, there = ({r["part"]: -(-r["count"] // BLOCK) for r in t.groupBy("part").count().collect()} for t in (index, asked))

    def blocked(df: DataFrame, own: dict, other: dict, mine: str, theirs: str) -> DataFrame:
        count = F.create_map(*[F.lit(v) for p in own for v in (p, own[p])]) if own else F.create_map(F.lit(0), F.lit(1))
        copies = F.create_map(*[F.lit(v) for p in other for v in (p, other[p])]) if other else F.create_map(F.lit(-1), F.lit(1))
        return (df.where(copies[F.col("part")].isNotNull())
                .select("vec_id", "v", "part", F.pmod(F.xxhash64("vec_id"), count[F.col("part")]).cast("int").alias(mine),
                        F.explode(F.sequence(F.lit(0), copies[F.col("part")] - 1)).alias(theirs)))

    left = blocked(asked, there, here, "q", "c").groupBy("part", "q", "c")
    right = blocked(index, here, there, "c", "q").groupBy("part", "q", "c")
    found = left.cogroup(right).applyInArrow(best_in_block(k), "query_id long, vec_id long, score double")
    return found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))

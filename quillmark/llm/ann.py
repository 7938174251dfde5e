"""Approximate nearest neighbours with learned partitions.

A neighbour graph of a bounded sample is cut into balanced parts, and a small network learns
to tell a vector's part and those of its neighbours. It places every row in its most probable
part. A query is routed to its most probable parts and reranked there by exact inner products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.llm.common import hash_share, written

#: Rows that the fit reads: those with the smallest hashes of their ids.
SAMPLE = 8192
PARTS = 32
PROBES = 24
NEIGHBOURS = 10
HIDDEN = 128
#: Rows and queries of a part that meet in one step.
ROW_BLOCK = 4096
QUERY_BLOCK = 1024
#: Products whose difference is below this share of the norms are compared exactly.
SLACK = 1e-9


def usable(vector: Column, size: int | None = None) -> Column:
    """Not null, not zero, without null or non-finite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    ok = vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)
    return ok if size is None else ok & (F.size(vector) == size)


def neighbour_graph(x: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """The k rows with the largest inner products with each row."""
    k = min(k, len(x) - 1)
    out = np.zeros((len(x), k), dtype=np.int64)
    for at in range(0, len(x), 1024):
        s = x[at : at + 1024] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out[at : at + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k] if k else out[at : at + 1024]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.1) -> np.ndarray:
    """Parts of nearly equal size that cut few edges: median splits along main directions,
    then moves to the part of most neighbours, the largest gains first, while it has room."""
    label = np.zeros(len(x), dtype=np.int64)
    for level in range(parts.bit_length() - 1):
        new = label * 2
        for p in range(1 << level):
            own = np.flatnonzero(label == p)
            if len(own) < 2:
                continue
            centred = x[own] - x[own].mean(0)
            main = np.linalg.eigh(centred.T @ centred)[1][:, -1]
            order = np.argsort(centred @ main, kind="stable")
            new[own[order[len(own) // 2 :]]] += 1
        label = new
    room = int(np.ceil(len(x) / parts * slack))
    a = np.repeat(np.arange(len(x)), graph.shape[1])
    b = graph.ravel()
    for _ in range(rounds):
        votes = np.zeros((len(x), parts))
        np.add.at(votes, (a, label[b]), 1)
        np.add.at(votes, (b, label[a]), 1)
        best = votes.argmax(1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), label]
        sizes, moved = np.bincount(label, minlength=parts), 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[best[i]] < room:
                sizes[label[i]] -= 1
                sizes[best[i]] += 1
                label[i] = best[i]
                moved += 1
        if not moved:
            break
    return label


@dataclass
class Router:
    """A network with one hidden layer; probable() gives the most probable parts first."""

    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x * self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def probable(self, x: np.ndarray, n: int) -> np.ndarray:
        return np.argsort(-np.round(self.logits(x), 6), axis=1, kind="stable")[:, :n]


def fitted(x: np.ndarray, parts: int = PARTS, epochs: int = 20, seed: int = 5) -> Router:
    """Fits the parts and the router to sample rows. Targets: the parts of a row and its neighbours."""
    rng = np.random.default_rng(seed)
    d = x.shape[1] if x.ndim == 2 else 1
    w = [rng.normal(0, (2 / d) ** 0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.05, (HIDDEN, parts)), np.zeros(parts)]
    if len(x) < 2:
        return Router(1.0, *w)
    graph = neighbour_graph(x)
    label = balanced_parts(x, graph, parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), label[graph.ravel()]), 1)
    target[np.arange(len(x)), label] += max(1, graph.shape[1] // 3)
    target /= target.sum(1, keepdims=True)
    scale = float(d**0.5 / max(1e-12, np.sqrt((x * x).sum(1).mean())))
    z = x * scale
    m, v, t = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    for _ in range(epochs):
        order = rng.permutation(len(z))
        for at in range(0, len(z), 256):
            xb, yb = z[order[at : at + 256]], target[order[at : at + 256]]
            h = np.maximum(xb @ w[0] + w[1], 0)
            o = h @ w[2] + w[3]
            o = np.exp(o - o.max(1, keepdims=True))
            g = (o / o.sum(1, keepdims=True) - yb) / len(xb)
            gh = (g @ w[2].T) * (h > 0)
            t += 1
            for i, grad in enumerate((xb.T @ gh, gh.sum(0), h.T @ g, g.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * grad
                v[i] = 0.999 * v[i] + 0.001 * grad * grad
                w[i] = w[i] - 3e-3 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return Router(scale, *w)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, size)


def best_of(queries: np.ndarray, qids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) of the k nearest rows of each query in a block, ties to smaller ids.

    A matrix product picks the candidates with some slack; their scores are then summed in
    one fixed order each, so equal vectors have equal scores wherever they stand.
    """
    out: list[list[np.ndarray]] = [[], [], []]
    norms = np.sqrt((rows * rows).sum(1).max()) if len(rows) else 0.0
    for q, qid in zip(queries, qids, strict=True):
        near = rows @ q
        near[ids == qid] = -np.inf
        if len(near) > k:
            least = np.partition(near, len(near) - k)[len(near) - k]
            pick = np.flatnonzero(near >= least - SLACK * norms * np.sqrt(q @ q))
        else:
            pick = np.arange(len(near))
        pick = pick[near[pick] > -np.inf]
        score = (rows[pick] * q).sum(1)
        order = np.lexsort((ids[pick], -score))[:k]
        for col, x in zip(out, (np.full(len(order), qid), ids[pick][order], score[order]), strict=True):
            col.append(x)
    return tuple(np.concatenate(c) if c else np.zeros(0) for c in out)


def search(vectors: DataFrame, queries: Column, k: int = 20, parts: int = PARTS, probes: int = PROBES, sample: int = SAMPLE) -> DataFrame:
    """vectors: (vec_id long, embedding array); other columns are not read. Rows where `queries`
    holds are searched for among all other ids. Returns (query_id, rank, vec_id, score).

    Vectors that are null or zero, hold null or non-finite components, or differ in size from
    most take no part, and so do rows without an id. Rows that share an id share their rows of
    the result: the best of each id counts. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), queries.alias("q"))
    rows = rows.where(usable(F.col("v")))
    common = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    size = common["size"] if common else 1
    rows = rows.where(F.size("v") == size)
    few = rows.where(hash_share(F.col("vec_id"), sample, common["count"])) if common else rows
    some = written(few.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(sample).select("v"), "ann-sample").toPandas()
    x = np.array(some["v"].tolist(), dtype=np.float64).reshape(-1, size)
    router = spark.sparkContext.broadcast(fitted(x, parts))
    kind = "vec_id long, v array<double>, q boolean, ps array<int>"

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = router.value
        for b in batches:
            ps = r.probable(_matrix(b.column(1), size), probes).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(ps), pa.list_(pa.int32()))], ["vec_id", "v", "q", "ps"])

    routed = written(rows.mapInArrow(route, kind), "ann-rows")
    counts = routed.groupBy(F.col("ps")[0].alias("p")).agg(F.count(F.lit(1)).alias("n"))
    h = F.xxhash64("vec_id", F.lit(1))

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            kinds, ids, v = (np.concatenate([x[i] for x in held]) for i in range(3))
            q = kinds == 1
            a, b, c = best_of(v[q], ids[q], v[~q], ids[~q], k)
            return pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)), pa.array(c.astype(np.float64))], ["query_id", "vec_id", "score"])

        at, held = None, []
        for b in batches:
            if not b.num_rows:
                continue
            key = np.stack([b.column(i).to_numpy() for i in range(3)], axis=1)
            edges = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), len(key)]
            v = _matrix(b.column(5), size)
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                if tuple(key[i]) != at:
                    if held:
                        yield found(held)
                    at, held = tuple(key[i]), []
                held.append((b.column(3).to_numpy()[i:j], b.column(4).to_numpy()[i:j], v[i:j]))
        if held:
            yield found(held)

    def found_in(asking: DataFrame) -> DataFrame:
        """asking: (vec_id, v, p). Returns (query_id, vec_id, score), the k best of each block."""
        asked = asking.groupBy("p").agg(F.count(F.lit(1)).alias("m"))
        # One row a part: a table of fixed size.
        blocks = counts.join(asked, "p").select("p", F.ceil(F.col("n") / ROW_BLOCK).cast("int").alias("rb"), F.ceil(F.col("m") / QUERY_BLOCK).cast("int").alias("qb"))
        blocks = F.broadcast(written(blocks, "ann-blocks"))
        base = routed.select("vec_id", "v", F.col("ps")[0].alias("p")).join(blocks, "p")
        base = base.select("p", F.pmod(h, F.col("rb")).cast("int").alias("r"), F.explode(F.sequence(F.lit(0), F.col("qb") - 1)).alias("s"), F.lit(0).alias("kind"), "vec_id", "v")
        asks = asking.join(blocks, "p")
        asks = asks.select("p", F.explode(F.sequence(F.lit(0), F.col("rb") - 1)).alias("r"), F.pmod(h, F.col("qb")).cast("int").alias("s"), F.lit(1).alias("kind"), "vec_id", "v")
        met = base.union(asks).repartition("p", "r", "s").sortWithinPartitions("p", "r", "s", "kind", "vec_id")
        return met.mapInArrow(rerank, "query_id long, vec_id long, score double")

    got = written(found_in(routed.where("q").select("vec_id", "v", F.explode("ps").alias("p"))), "ann-found")
    # Queries that have found fewer than k ids go on to the parts they have not been to.
    enough = got.groupBy("query_id").agg(F.countDistinct("vec_id").alias("n")).where(F.col("n") >= k)
    rest = F.array_except(F.sequence(F.lit(0), F.lit(parts - 1)), "ps")
    short = routed.where("q").join(enough, F.col("vec_id") == F.col("query_id"), "left_anti")
    short = written(short.select("vec_id", "v", F.explode(rest).alias("p")), "ann-short")
    if not short.isEmpty():
        got = got.union(found_in(short))
    got = got.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return got.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

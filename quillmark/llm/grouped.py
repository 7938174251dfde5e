"""Links between the members of groups that share a key, whatever the sizes of the groups.

A link counts if the operator's check says so; what is wanted is links enough to connect what all
links would connect. In a group of FEW members or fewer all pairs are checked, in a larger one
all members against one head. Then groups whose members are all connected are done. In each of
the others the largest connected part stays, and the rest is compared with all members, in
blocks of bounded size. So no pair is lost, and a group of near copies costs as many checks as it
has members. A block gives fewer links than it has members: those that connect what all of its links do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import hot_lookup, written
from quillmark.llm.components import components, smallest

FEW = 8
#: Members that meet in one step.
MEMBERS = 1024

#: (payload columns, places of those that ask, places of the members) -> (places, places) of links.
Compare = Callable[[list[pa.Array], np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def linked(nodes: DataFrame, check: Callable[[DataFrame], DataFrame], load: Callable[[DataFrame], DataFrame], compare: Compare, name: str) -> DataFrame:
    """nodes: (node, keys), written; keys is an array of longs. Returns (a, b), nodes that are linked.

    check: (a, b), distinct pairs, written -> those that are linked. load: rows with a node -> the
    same rows with the columns that compare needs behind them.
    """
    keyed = nodes.select("node", F.explode(F.array_distinct("keys")).alias("key"))
    groups = written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("head")).where("n > 1"), f"{name}-groups")
    hot = _hot(groups, "n")
    met = hot_lookup(keyed, groups, ["key"], ["node"], hot=hot).where("n is not null")
    few = met.where(F.col("n") <= FEW).groupBy("key").agg(F.array_sort(F.collect_list("node")).alias("all"))
    few = few.select(F.explode(F.expr("flatten(transform(all, (x, i) -> transform(slice(all, i + 2, size(all)), y -> struct(x as a, y as b))))")).alias("p")).select("p.a", "p.b")
    many = met.where((F.col("n") > FEW) & (F.col("node") != F.col("head"))).select(F.col("head").alias("a"), F.col("node").alias("b"))
    near = written(check(written(few.union(many).distinct(), f"{name}-pairs")), f"{name}-near")

    roots = components(near)
    rooted = written(nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "keys"), f"{name}-rooted")
    rooted = rooted.select("node", "root", F.explode(F.array_distinct("keys")).alias("key"))
    parts = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    sums = parts.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.sum("c").alias("m"), F.max(F.struct("c", "root")).alias("most"))
    # In small groups all pairs are known.
    sums = sums.where((F.col("parts") > 1) & (F.col("m") > FEW)).select("key", F.col("most.root").alias("main"), "m", (F.col("m") - F.col("most.c")).alias("o"))
    blocks = written(sums.select("key", "main", "m", F.ceil(F.col("m") / MEMBERS).cast("int").alias("mb"), F.ceil(F.col("o") / MEMBERS).cast("int").alias("ob")), f"{name}-blocks")
    dealt = hot_lookup(rooted, blocks, ["key"], ["node"], hot=hot).where("ob is not null")
    dealt = written(dealt.select("key", "node", "root", "mb", "ob", (F.col("root") != F.col("main")).alias("other")), f"{name}-dealt")

    h = F.xxhash64("node", F.lit(9))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = dealt.select("key", every("ob").alias("x"), F.pmod(h, "mb").cast("int").alias("y"), F.lit(0).alias("kind"), "node", "root")
    asking = dealt.where("other").select("key", F.pmod(h, "ob").cast("int").alias("x"), every("mb").alias("y"), F.lit(1).alias("kind"), "node", "root")
    rows = load(members.union(asking)).repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "kind", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in tables(batches, 3):
            kind, root = t.column(3).to_numpy(), t.column(5).to_numpy()
            edges = key_edges(t, 3)
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                asks = np.flatnonzero(kind[i:j] == 1)
                if len(asks):
                    a, b = compare([c.combine_chunks() for c in t.slice(i, j - i).columns[6:]], asks, np.flatnonzero(kind[i:j] == 0))
                    # Parts that hang together need no link, and others one to the smallest that they hang on.
                    parts, at = np.unique(np.concatenate([root[i:j][a], root[i:j][b]]), return_inverse=True)
                    mark = smallest(len(parts), at[: len(a)], at[len(a) :])
                    found = np.flatnonzero(mark != np.arange(len(parts)))
                    yield pa.RecordBatch.from_arrays([pa.array(parts[found]), pa.array(parts[mark[found]])], ["a", "b"])

    return near.select("a", "b").union(rows.mapInArrow(run, "a long, b long"))


def _hot(counts: DataFrame, n: str, share: int = 1024) -> DataFrame:
    """The keys of counts with more than one in `share` of all: fewer than `share` keys."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    return counts.where(F.col(n) * share > total).select("key", F.lit(True).alias("_hot"))


def tables(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Rows sorted by their first columns, all of a key's rows in one table, many keys in a table."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        last = [b.column(i)[-1].as_py() for i in range(keys)]
        same = np.ones(b.num_rows, dtype=bool)
        for i, v in enumerate(last):
            same &= b.column(i).to_numpy() == v
        cut = int(np.argmax(same))
        if cut:
            yield pa.Table.from_batches([*held, b.slice(0, cut)])
            held = [b.slice(cut)]
        elif held and [held[-1].column(i)[-1].as_py() for i in range(keys)] != last:
            yield pa.Table.from_batches(held)
            held = [b]
        else:
            held.append(b)
    if held:
        yield pa.Table.from_batches(held)


def key_edges(t: pa.Table, keys: int) -> np.ndarray:
    cols = np.stack([t.column(i).to_numpy() for i in range(keys)], axis=1)
    return np.array([0, *(np.flatnonzero((cols[1:] != cols[:-1]).any(1)) + 1), len(cols)])

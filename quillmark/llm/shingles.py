"""Near copies by SimHash and the exact Jaccard similarity of word shingle sets.

Sets get SimHash fingerprints, whose index of segments and their deletion variants connects what may be
near (simhash.set_links). Inside what it connects, pairs whose whole fingerprints differ in LIMIT bits
or fewer are compared as whole sets, and only exact pairs count; only links that connect are
sought, see grouped.

Few shingles make coarse bits, so sets of TINY or fewer also meet under deletion variants of their own, the
set without one of its shingles: among them no pair at 0.8 is lost. Of larger ones a pair at 0.8 has an equal
key in none of the segments with a probability of about 2e-4, less above: see the README. Sets are of
64-bit hashes of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import hot_keys, hot_lookup, small_batches, written
from quillmark.llm.components import components
from quillmark.llm.grouped import linked
from quillmark.llm.simhash import LANES, set_fingerprint, set_links, shingle_hashes

#: Bits of a fingerprint that a pair may differ in: eight deviations above sets of 4 and 5 shingles, the worst at 0.8.
LIMIT = 20 * LANES
TINY = 9


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted."""
    found = list(shingle_hashes(text, words))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.uint64)


def tiny_keys(found: np.ndarray) -> np.ndarray:
    """Marks of a tiny set and of the sets without one of its shingles."""
    if not 0 < len(found) <= TINY:
        return np.zeros(0, dtype=np.int64)
    return np.append(found.sum(), found.sum() - found).view(np.int64)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """docs: (doc_id, text). Returns (doc_id, text_hash, s0, s1, size, lanes, tiny), a row per row; s0 and s1 tell sets apart."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t.as_py(), words) for t in b.column(1)]
            ids = np.array([[*np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8")] for s in sets], dtype=np.int64).reshape(-1, 2)
            more = [pa.array([f(s) for s in sets], pa.list_(pa.int64())) for f in (set_fingerprint, tiny_keys)]
            cols = [b.column(0), b.column(2), pa.array(ids[:, 0]), pa.array(ids[:, 1]), pa.array([len(s) for s in sets], pa.int64()), *more]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "text_hash", "s0", "s1", "size", "lanes", "tiny"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, s0 long, s1 long, size long, lanes array<long>, tiny array<long>")


def _lanes(found: pa.Array) -> np.ndarray:
    return found.flatten().to_numpy().reshape(len(found), LANES).view(np.uint64)


def _hopeful(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(-1, dtype=np.int32) <= LIMIT


def _sets(found: pa.Array) -> list[np.ndarray]:
    """Hashes are sorted as unsigned numbers, so they are read as such."""
    values = found.flatten().to_numpy().view(np.uint64)
    ends = np.cumsum(pa.compute.list_value_length(found).to_numpy())
    return np.split(values, ends[:-1])


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether the Jaccard similarity of two sets is `percent` or more."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def links(docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """classes: (node, size, lanes, tiny, first), distinct sets, written. Returns (a, b): nodes linked so
    that the candidate pairs whose similarity is `percent` or more are connected."""
    words_in = classes.where("size > 0")
    met = components(set_links(words_in))
    keys = F.concat(F.when(F.col("root").isNull(), F.array().cast("array<long>")).otherwise(F.array(F.xxhash64(F.lit(0), "root"))), F.transform("tiny", lambda v: F.xxhash64(F.lit(1), v)))
    nodes = written(words_in.join(met, "node", "left").select("node", keys.alias("keys")).where("size(keys) > 0"), "shingle-nodes")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("_t", F.xxhash64("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t.as_py(), words).view(np.int64) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "found"])

    def sets_of(nodes: DataFrame) -> DataFrame:
        """(node, found): the sets of some nodes, from the text of each one's first row."""
        first = classes.join(nodes, "node", "left_semi").select("node", F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash"))
        own = texts.join(first, texts["doc_id"].eqNullSafe(first["_id"]) & (texts["_t"] == first["_hash"])).select("node", "text").dropDuplicates(["node"])
        return written(own.mapInArrow(cut, "node long, found array<long>"), "shingle-sets")

    def with_both(pairs: DataFrame, things: DataFrame, column: str) -> DataFrame:
        out = pairs
        for side in "ab":
            of = things.select(F.col("node").alias(side), F.col(column).alias(f"_{side}"))
            out = hot_lookup(out, of, [side], ["a", "b"], hot=hot_keys(pairs, [side]))
        return out.select("a", "b", "_a", "_b")

    def estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield b.select([0, 1]).filter(pa.array(_hopeful(_lanes(b.column(2)), _lanes(b.column(3)))))

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                near = [similar(x, y, percent) for x, y in zip(_sets(b.column(2)), _sets(b.column(3)), strict=True)]
                yield b.select([0, 1]).filter(pa.array(near, pa.bool_()))

    def check(pairs: DataFrame) -> DataFrame:
        hopeful = written(with_both(pairs, classes, "lanes").mapInArrow(estimated, "a long, b long"), "shingle-hopeful")
        nodes = hopeful.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        return with_both(hopeful, sets_of(nodes), "found").mapInArrow(verified, "a long, b long")

    def load(rows: DataFrame) -> DataFrame:
        sets = sets_of(rows.select("node").distinct()).join(classes.select("node", "lanes"), "node")
        return rows.join(sets, "node").select(*rows.columns, "lanes", "found")

    def compare(payload: list[pa.Array], asks: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lanes, sets = _lanes(payload[0]), _sets(payload[1])
        # Which members are known to be connected: they need no second check.
        mark = np.arange(len(sets))
        a, b = [], []
        for i in asks:
            for j in there[_hopeful(lanes[there], lanes[i])]:
                if mark[i] != mark[j] and similar(sets[i], sets[j], percent):
                    mark[mark == mark[j]] = mark[i]
                    a.append(i)
                    b.append(j)
        return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)

    return linked(nodes, check, load, compare, "shingle")


def with_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """docs: (doc_id, text). Returns (doc_id, text_hash, s0, s1, component_id, first_hash), a row per
    row: the smallest doc_id of the row's component, and the smallest text_hash of the rows with it.

    Equal sets are one class; texts without words have the empty set. Null ids are larger than all others.
    """
    rows = written(sketches(docs, words), "shingle-rows")
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    classes = rows.groupBy("s0", "s1").agg(smallest.alias("first"), F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("size", "lanes", "tiny")])
    classes = written(classes.withColumn("node", F.xxhash64("s0", "s1")), "shingle-classes")
    roots = components(links(docs, classes, words, percent))
    marked = classes.drop("lanes", "tiny").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    marked = written(marked, "shingle-marked")
    firsts = marked.groupBy("root").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("classes"))
    firsts = written(firsts.where("classes > 1"), "shingle-firsts")
    several = marked.join(firsts, "root", "left").where("n > 1 or classes > 1").select("s0", "s1", F.coalesce("least", "first").alias("least"))
    out = hot_lookup(rows.select("doc_id", "text_hash", "s0", "s1"), several, ["s0", "s1"], ["doc_id", "text_hash"])
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    least = F.coalesce("least", own)
    return out.withColumn("component_id", least["doc_id"]).withColumn("first_hash", least["text_hash"]).drop("least")

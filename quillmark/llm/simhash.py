"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has one or more lanes of 64 bits; a lane is cut into three segments, too few
for exact matching: of fingerprints of one lane at four bits or fewer, one segment differs by
at most one bit. Each distinct fingerprint is indexed under its segments (its homes) and
under every variant of a segment with one set bit wiped out. Segments at most one bit apart
meet under an equal key: an equality join, whose candidates are verified on whole
fingerprints. Inside a key only the links that connect its members are kept, never all pairs.

Sets of shingles at a Jaccard similarity of 0.8 differ in 0.15 of their bits, so they get LANES lanes,
and segments meet under any equal key, also if a bit is wiped out of both (set_links). An exact check
of the sets follows (see shingles).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.llm.common import salted_lookup, small_batches, written
from quillmark.llm.components import components
from quillmark.llm.components import smallest as _smallest
from quillmark.llm.grouped import key_edges, tables

SEED = 42
#: (first bit, bits) of the segments of a lane.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
#: Shingles whose bits are counted at once.
PIECE = 1 << 16
#: Candidate pairs that are verified at once.
PAIRS = 1 << 18
#: A key with more members than this is searched around a pivot.
LARGE = 256
#: Lanes of a set's fingerprint.
LANES = 10
#: Bits of two lanes that a pair of sets may differ in: three and a half deviations above a similarity of 0.8.
TWO_LANES = 30
#: Fingerprints that meet in one step, about.
MET = 1 << 15


def shingle_hashes(text: str | None, words: int) -> Iterator[np.ndarray]:
    """XXH64 of the word shingles of a text, repeats included, in pieces."""
    found = (text or "").encode("utf-8", "replace").lower().split()
    if not found:
        return
    joined = b" ".join(found)
    length = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(length + 1) - 1
    starts = ends - length
    k = min(words, len(found))
    first, last = starts[: len(starts) - k + 1].tolist(), ends[k - 1 :].tolist()
    hashed = xxhash.xxh64_intdigest
    for at in range(0, len(first), PIECE):
        part = zip(first[at : at + PIECE], last[at : at + PIECE], strict=True)
        yield np.array([hashed(joined[i:j], SEED) for i, j in part], dtype=np.uint64)


def _mixed(h: np.ndarray, lane: int) -> np.ndarray:
    """Hashes of hashes for the further lanes (the finaliser of splitmix64)."""
    if not lane:
        return h
    z = h + np.uint64(lane * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def fingerprint(text: str | None, words: int = 4, lanes: int = 1) -> list[int]:
    """Signed 64-bit lanes; all zero for a text without words."""
    counts, n = np.zeros((lanes, 64), dtype=np.int64), 0
    for h in shingle_hashes(text, words):
        n += len(h)
        for lane in range(lanes):
            counts[lane] += np.unpackbits(_mixed(h, lane).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(2 * counts > n, axis=1, bitorder="little").view("<i8")[:, 0].tolist()


def set_fingerprint(found: np.ndarray, lanes: int = LANES) -> np.ndarray:
    """Signed 64-bit lanes of a set of hashes. Half of the hashes set a bit at odd places only: sets of
    even and of odd sizes would differ in one direction otherwise."""
    counts = np.zeros(lanes * 64, dtype=np.int64)
    # Counts of a piece fit one byte.
    for at in range(0, len(found), 255):
        h = found[at : at + 255]
        mixed = np.stack([_mixed(h, lane) for lane in range(lanes)], axis=1).astype("<u8")
        counts += np.unpackbits(mixed.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.uint8)
    return np.packbits(2 * counts + np.arange(lanes * 64) % 2 > len(found), bitorder="little").view("<i8")


def lane_names(lanes: int) -> list[str]:
    return [f"fp{i}" for i in range(lanes)]


def fingerprints(docs: DataFrame, words: int = 4, lanes: int = 1) -> DataFrame:
    """docs: (doc_id, text). Returns (doc_id, text_hash, fp0, ...), a row per row."""
    small_batches(docs.sparkSession)
    names = lane_names(lanes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [fingerprint(t.as_py(), words, lanes) for t in b.column(1)]
            cols = [pa.array([g[i] for g in got], pa.int64()) for i in range(lanes)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *cols], ["doc_id", "text_hash", *names])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, " + ", ".join(f"{n} long" for n in names))


def index_entries(lanes: int) -> Column:
    """The keys of a fingerprint, times two, plus one where the key is a segment itself."""
    out = []
    for i, name in enumerate(lane_names(lanes)):
        for s, (shift, bits) in enumerate(SEGMENTS):
            value = f"(shiftrightunsigned({name}, {shift}) & {(1 << bits) - 1}L)"
            base = (i * len(SEGMENTS) + s) << 22
            out.append(f"(({base}L + {value}) * 2 + 1)")
            out += [f"if(({name} & {1 << (shift + b) if shift + b < 63 else -(1 << 63) + 1}L{' - 1L' if shift + b == 63 else ''}) <> 0L, ({base}L + ({value} & {~(1 << b)}L)) * 2, null)" for b in range(bits)]
    return F.expr(f"filter(array({', '.join(out)}), x -> x is not null)")


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count((x ^ y).view(np.uint64)).sum(-1, dtype=np.int32)


def _around_pivot(fps: np.ndarray, homes: np.ndarray, limit: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what the links between homes and members connect, in one large key.

    Members linked to the pivot need no test against each other; only the others are tested
    against all homes, or all members if they are homes.
    """
    n = len(fps)
    pivot = int(homes[0])
    near = _distance(fps, fps[pivot]) <= limit
    links = [(np.flatnonzero(near), np.full(int(near.sum()), pivot))]
    is_home = np.zeros(n, dtype=bool)
    is_home[homes] = True
    for at in np.flatnonzero(~near):
        others = np.arange(n) if is_home[at] else homes
        hit = others[_distance(fps[others], fps[at]) <= limit]
        links.append((hit, np.full(len(hit), at)))
    return links


def _linked(entry: np.ndarray, fps: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by entry, whole keys only: rows and the rows that they are linked to."""
    key, home = entry >> 1, np.flatnonzero(entry & 1)
    start = np.searchsorted(key, key[home], "left")
    end = np.searchsorted(key, key[home], "right")
    links: list[tuple[np.ndarray, np.ndarray]] = []
    large = (end - start) > LARGE
    for s in np.unique(start[large]):
        e = int(end[np.searchsorted(start, s)])
        own = home[(home >= s) & (home < e)] - s
        links += [(a + s, b + s) for a, b in _around_pivot(fps[s:e], own, limit)]
    home, start = home[~large], start[~large]
    each = home - start
    upto = np.cumsum(each)
    at = 0
    while at < len(home):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, "right")))
        n = each[at:to]
        a = np.repeat(home[at:to], n)
        b = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[at:to], n)
        hit = _distance(fps[a], fps[b]) <= limit
        links.append((a[hit], b[hit]))
        at = to
    if not links:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    u, v = (np.concatenate([x[i] for x in links]) for i in (0, 1))
    # A fingerprint is in many keys; rows of different keys stay apart here.
    mark = _smallest(len(entry), u, v)
    found = np.flatnonzero(mark != np.arange(len(mark)))
    return found, mark[found]


def links(classes: DataFrame, lanes: int = 1, limit: int = 4) -> DataFrame:
    """classes: distinct fingerprints. Returns (a, b): pairs of nodes whose edges connect what
    the pairs at `limit` or fewer bits that the index brings together connect. See node()."""
    names = lane_names(lanes)
    rows = classes.select(F.explode(index_entries(lanes)).alias("entry"), *names)
    rows = rows.repartition(F.shiftright("entry", 1)).sortWithinPartitions("entry")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(entry: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            a, b = _linked(entry, fps, limit)
            cols = [pa.array(fps[x, i], pa.int64()) for x in (a, b) for i in range(lanes)]
            return pa.RecordBatch.from_arrays(cols, [f"{p}{i}" for p in "ab" for i in range(lanes)])

        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for b in batches:
            entry = b.column(0).to_numpy()
            fps = np.stack([b.column(1 + i).to_numpy() for i in range(lanes)], axis=1)
            if not len(entry):
                continue
            cut = int(np.searchsorted(entry >> 1, entry[-1] >> 1, "left"))
            if cut and size + cut >= 1 << 15:
                yield out(np.concatenate([*(x for x, _ in held), entry[:cut]]), np.concatenate([*(y for _, y in held), fps[:cut]]))
                held, size = [(entry[cut:], fps[cut:])], len(entry) - cut
            else:
                held.append((entry, fps))
                size += len(entry)
        if held:
            yield out(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))

    found = rows.mapInArrow(run, ", ".join(f"{p}{i} long" for p in "ab" for i in range(lanes)))
    return found.select(*[node([f"{p}{i}" for i in range(lanes)]).alias(p) for p in "ab"])


def set_links(sets: DataFrame, lanes: int = LANES, limit: int = TWO_LANES) -> DataFrame:
    """sets: (node, lanes), distinct nodes, written; lanes is an array of longs. Returns (a, b): nodes
    whose edges connect those that have an equal key in a segment and differ in `limit` or fewer bits
    of its lane and the next one.

    Keys are segments and segments with one set bit wiped out. Rows are dealt by the first bits of a
    key, so many that about MET of a segment's rows meet; keys whose other bits are wiped out are made
    where they meet. In the end a few bits of each key are dealt, not each key.
    """
    low = max(8, min(b for _, b in SEGMENTS) - max(0, (sets.count() // MET).bit_length()))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column(1).flatten().to_numpy().reshape(b.num_rows, lanes)
            entries, rows, lane_of = [], [], []
            for lane in range(lanes):
                for s, (shift, bits) in enumerate(SEGMENTS):
                    home = ((lane * len(SEGMENTS) + s) << 22) + (fps[:, lane] >> shift & ((1 << bits) - 1))
                    for bit in [None, *range(low, bits)]:
                        at = np.arange(len(home)) if bit is None else np.flatnonzero(home >> bit & 1)
                        entries.append(home * 2 + 1 if bit is None else (home[at] & ~(1 << bit)) * 2)
                        rows.append(at)
                        lane_of.append(np.full(len(at), lane))
            row, lane = np.concatenate(rows), np.concatenate(lane_of)
            cols = [np.concatenate(entries), fps[row, lane], fps[row, (lane + 1) % lanes], b.column(0).to_numpy()[row]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["entry", "own", "following", "node"])

    def meet(entry: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of one part, and the rows that they are linked to."""
        homes = np.flatnonzero(entry & 1)
        keys, rows = [entry >> 1], [np.arange(len(entry))]
        for bit in range(low):
            at = homes[entry[homes] >> (bit + 1) & 1 == 1]
            keys.append(entry[at] >> 1 & ~(1 << bit))
            rows.append(at)
        key, row = np.concatenate(keys), np.concatenate(rows)
        order = np.argsort(key, kind="stable")
        key, row = key[order], row[order]
        same = key[1:] == key[:-1]
        several = np.append(same, False) | np.append(False, same)
        key, row = key[several], row[several]
        a, b = _linked(key * 2 + 1, fps[row], limit)
        mark = _smallest(len(entry), row[a], row[b])
        found = np.flatnonzero(mark != np.arange(len(mark)))
        return found, mark[found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in tables(batches, 1):
            entry, own, following, names = (c.to_numpy() for c in t.columns[1:])
            edges = key_edges(t, 1)
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                a, b = meet(entry[i:j], np.stack([own[i:j], following[i:j]], axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(names[i:j][a]), pa.array(names[i:j][b])], ["a", "b"])

    part = F.shiftright("entry", low + 1)
    dealt = sets.select("node", "lanes").mapInArrow(deal, "entry long, own long, following long, node long")
    rows = dealt.repartition(part).select(part.alias("part"), "entry", "own", "following", "node").sortWithinPartitions("part")
    return rows.mapInArrow(run, "a long, b long").where("a <> b")


def node(names: list[str]) -> Column:
    """A number for a fingerprint: itself, or a hash of its lanes."""
    return F.col(names[0]) if len(names) == 1 else F.xxhash64(*names)


def with_components(rows: DataFrame, lanes: int = 1, limit: int = 4) -> DataFrame:
    """rows: (doc_id, text_hash, fp0, ...), written. Adds component_id, the smallest doc_id of the
    component, and first_hash, the smallest text_hash of the rows that have it.

    Rows with equal fingerprints are one class and linked. Null ids are larger than all others.
    """
    names = lane_names(lanes)
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    classes = written(rows.groupBy(*names).agg(smallest.alias("first"), F.count(F.lit(1)).alias("n")), "simhash-classes")
    roots = components(links(classes, lanes, limit))
    marked = classes.withColumn("node", node(names)).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    marked = written(marked, "simhash-marked")
    firsts = marked.groupBy("root").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("classes"))
    firsts = written(firsts.where("classes > 1"), "simhash-firsts")
    several = marked.join(firsts, "root", "left").where("n > 1 or classes > 1").select(*names, F.coalesce("least", "first").alias("least"))
    out = salted_lookup(rows, several, names, ["doc_id", "text_hash"])
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    least = F.coalesce("least", own)
    return out.withColumn("component_id", least["doc_id"]).withColumn("first_hash", least["text_hash"]).drop("least")


def near_duplicates(docs: DataFrame, words: int = 4, lanes: int = 1, limit: int = 4) -> DataFrame:
    """docs: (doc_id, text); other columns are not read. Returns (doc_id, text_hash, fp0, ...,
    component_id, first_hash), a row per row.

    Null and empty texts have the fingerprint zero and are linked like any other. Repeated
    rows come out as often. An empty table gives an empty result.
    """
    return with_components(written(fingerprints(docs, words, lanes), "simhash-rows"), lanes, limit)


def hex_digits(name: str) -> Column:
    return F.lower(F.lpad(F.hex(name), 16, "0"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, all columns, one for each group: that with the smallest doc_id.

    Candidates are what the fingerprints' index connects; an exact check follows: groups are what pairs
    connect whose shingle sets have a Jaccard similarity of `percent` or more. See shingles. Texts without words (null,
    empty) are one group. Null ids are larger than all others; of rows that share the smallest id
    of a group one stays, by the hashes of texts and then of whole rows. Of rows that are alike in
    all columns one stays. An empty table gives an empty result; no name of a column is reserved.
    """
    from quillmark.llm import shingles

    key = lambda i, h: [F.coalesce(i, F.lit(0)).alias("id"), i.isNull().alias("none"), F.coalesce(h, F.lit(0)).alias("hash")]
    found = shingles.with_components(docs.select("doc_id", "text"), words, percent)
    kept = found.where("doc_id <=> component_id and text_hash <=> first_hash").select(*key(F.col("doc_id"), F.col("text_hash"))).distinct()
    hashable = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in hashable])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), tie.alias("tie"), *key(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string"))))
    # The join and the window deal rows by the same columns: texts move once.
    alike = rows.join(kept, ["id", "none", "hash"], "left_semi")
    numbered = alike.withColumn("n", F.row_number().over(Window.partitionBy("id", "none", "hash").orderBy("tie")))
    return numbered.where("n = 1").select("row.*")

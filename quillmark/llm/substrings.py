"""Substring dedup: suffix automata of reference shards, and documents' matching statistics.

The reference is the corpus itself: a window of words is removed where it also starts in a
document with a smaller id. Automata of the whole corpus can't be sent to every task, so they
are built of what later documents repeat, once, and sent where it is repeated:

1. Of equal texts the one with the smallest id stands for all; the others go as a whole.
2. Anchors: in every window the word 8-gram with the smallest hash. Equal windows have equal
   anchors, so only anchors of two documents or more can lie in a repeated window.
3. Windows around such anchors are hashed; each repeated one belongs to the smallest document
   that has it. A document's own windows, in maximal spans, are its part of the reference.
4. Reference spans are dealt to shards of bounded size, long documents to several. For each shard a generalised suffix
   automaton is built, and the spans of later documents that repeat it stream through: their
   matching statistics give the maximal matches above the threshold, which are removed. The
   automaton goes to as many tasks as the shard's spans need, so a passage that very many
   documents share is no task's burden.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import salted_lookup, small_batches, written

WINDOW = 50
ANCHOR = 8
#: Reference words of a shard, and words that stream through a copy of it.
SHARD_WORDS = 20_000
STREAM_WORDS = 200_000
_P = 0x9E3779B97F4A7C15
_INVERSE = pow(_P, -1, 1 << 64)
_LAST = (1 << 63) - 1


def split(text: str | None) -> list[bytes]:
    """Words between ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").split()


class Hashes:
    """Hashes of the runs of n words of a text, from prefix sums modulo 2^64."""

    def __init__(self, found: list[bytes]):
        n = len(found)
        h = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, n)
        powers = np.full(n + 1, _P, dtype=np.uint64)
        powers[0] = 1
        self.inverse = np.full(n + 1, _INVERSE, dtype=np.uint64)
        self.inverse[0] = 1
        with np.errstate(over="ignore"):
            powers = np.multiply.accumulate(powers)
            self.inverse = np.multiply.accumulate(self.inverse)
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(h * powers[:-1])])

    def runs(self, n: int, starts: np.ndarray | None = None) -> np.ndarray:
        if starts is None:
            starts = np.arange(max(0, len(self.sums) - n))
        with np.errstate(over="ignore"):
            z = (self.sums[starts + n] - self.sums[starts]) * self.inverse[starts]
            z = (z ^ (z >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
            return z ^ (z >> np.uint64(29))


def anchors(hashes: Hashes, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) of the smallest run of anchor words of every window."""
    g = hashes.runs(anchor)
    wide = window - anchor + 1
    if len(g) < wide:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    found = []
    for at in range(0, len(g) - wide + 1, 1 << 16):
        part = np.lib.stride_tricks.sliding_window_view(g[at : at + (1 << 16) + wide - 1], wide)
        found.append(np.unique(part.argmin(axis=1) + np.arange(at, at + len(part))))
    places = np.unique(np.concatenate(found))
    return g[places], places


class Automaton:
    """Generalised suffix automaton of word sequences, as flat lists."""

    def __init__(self):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _split(self, p: int, word: bytes) -> int:
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = len(self.link)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, sequence: list[bytes]) -> None:
        last = 0
        for word in sequence:
            if word in self.next[last]:
                last = self._split(last, word)
                continue
            new = len(self.link)
            self.next.append({})
            self.link.append(0)
            self.length.append(self.length[last] + 1)
            p = last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, word)
            last = new

    def spans(self, sequence: list[bytes], least: int) -> list[tuple[int, int]]:
        """Maximal stretches covered by matches of `least` words or more, as [start, end)."""
        nexts, link, lengths = self.next, self.link, self.length
        state = length = 0
        out: list[list[int]] = []
        for end, word in enumerate(sequence, 1):
            while state and word not in nexts[state]:
                state = link[state]
                length = lengths[state]
            if word in nexts[state]:
                state = nexts[state][word]
                length += 1
            else:
                length = 0
            if length >= least:
                start = end - length
                if out and out[-1][1] >= start:
                    out[-1][1] = end
                else:
                    out.append([start, end])
        return [(a, b) for a, b in out]


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def deduplicated(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, shard_words: int = SHARD_WORDS, stream_words: int = STREAM_WORDS, keep_untouched: bool = False) -> DataFrame:
    """docs: (doc_id, text, ...). Returns (row, text, words, removed, sha), a row per row: row is a
    struct of all columns of docs but text, whatever their names, sha the SHA-256 of the kept words,
    joined by one space.

    text is the kept words of rows that lost some; of the others it is null, or unchanged
    with keep_untouched. A null text has no words. Null ids count as larger than all others.
    Rows that share an id do not remove each other's words, also not if they are equal.
    Empty tables give empty results.
    """
    small_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    # 128 bits tell rows apart, but for those that are alike in id and text.
    key = F.unhex(F.md5(F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.when(text.isNull(), "n").otherwise("t"), text)))
    rows = docs.select(F.struct(*rest).alias("row"), text.alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("_w_id"), key.alias("_w_key"))
    own, place = ["row", "text"], 1

    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], []]
            for t in b.column(2):
                found = split(t.as_py())
                x = xxhash.xxh3_128_intdigest(b" ".join(found))
                g, p = anchors(Hashes(found), window, anchor) if len(found) >= window else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                for col, v in zip(out, (x >> 65, x & _LAST, _signed(g), p.astype(np.int32)), strict=True):
                    col.append(v)
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], ["id", "key", "x", "y", "gs", "ps"])

    first = written(rows.select("_w_id", "_w_key", "text").mapInArrow(anchored, "id long, key binary, x long, y long, gs array<long>, ps array<int>"), "sub-anchors")
    least = first.where("size(gs) > 0").groupBy("x", "y").agg(F.min(F.struct("id", "key")).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").select("x", "y", "least")
    # Rows of the least id with other keys only differ in their white space; they are kept apart.
    marked = salted_lookup(first.where("size(gs) > 0"), least, ["x", "y"], ["id", "key"]).withColumn("copy", F.coalesce(F.col("id") > F.col("least.id"), F.lit(False)))
    marked = written(marked.select("id", "key", "copy", F.when(~F.col("copy"), F.col("gs")).alias("gs"), "ps"), "sub-marked")
    each = marked.where("not copy").select("id", "key", F.explode(F.arrays_zip("gs", "ps")).alias("a")).select("id", "key", F.col("a.gs").alias("g"), F.col("a.ps").alias("p"))
    repeated = written(each.groupBy("g").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("g"), "sub-repeated")
    hits = each.join(repeated, "g").groupBy("key").agg(F.collect_set("p").alias("ps")).select("key", F.lit(False).alias("copy"), "ps")
    copies = marked.where("copy").select("key", "copy").distinct().select("key", "copy", F.lit(None).cast("array<int>").alias("ps"))
    touched = written(hits.unionByName(copies), "sub-touched")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_columns
            out: list[list] = [[] for _ in range(6)]
            for t, copy, ps in zip(b.column(place), b.column(n - 2).to_pylist(), b.column(n - 1), strict=True):
                text = t.as_py()
                found = split(text)
                if copy:
                    row = (text, len(found), len(found), hashlib.sha256(b"").hexdigest(), None, None)
                elif copy is None:
                    row = (text if keep_untouched else None, len(found), 0, hashlib.sha256(b" ".join(found)).hexdigest(), None, None)
                else:
                    p = ps.values.to_numpy().astype(np.int64)
                    near = np.zeros(len(found) + 1, dtype=np.int64)
                    np.add.at(near, np.maximum(0, p - (window - anchor)), 1)
                    np.add.at(near, np.minimum(p, len(found) - window) + 1, -1)
                    starts = np.flatnonzero(np.cumsum(near)[: len(found) - window + 1] > 0)
                    row = (text, len(found), None, None, starts.astype(np.int32), _signed(Hashes(found).runs(window, starts)))
                for col, v in zip(out, row, strict=True):
                    col.append(v)
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            cols = list(b.columns[: n - 2])
            made = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
            cols[place] = made[0]
            yield pa.RecordBatch.from_arrays([*cols, *made[1:]], [*b.schema.names[: n - 2], *WINDOWED])

    schema = rows.schema
    both = rows.join(touched.withColumnsRenamed({"key": "_w_key", "copy": "_w_copy", "ps": "_w_ps"}), "_w_key", "left").select(*rows.columns, "_w_copy", "_w_ps")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    seen = written(both.mapInArrow(windows, types + ", _w_words long, _w_removed long, _w_sha string, _w_starts array<int>, _w_hashes array<long>"), "sub-windows")
    done = seen.where("_w_sha is not null").select(*own, "_w_words", "_w_removed", "_w_sha")
    done = done.withColumn("text", F.when(F.col("_w_removed") > 0, F.lit("")).otherwise(F.col("text")))
    open_ = seen.where("_w_sha is null")
    each = open_.select("_w_id", "_w_key", F.explode(F.arrays_zip("_w_starts", "_w_hashes")).alias("a")).select(F.col("_w_id").alias("id"), F.col("_w_key").alias("key"), F.col("a._w_starts").alias("p"), F.col("a._w_hashes").alias("w"))
    first_of = each.groupBy("w").agg(F.min(F.struct("id", "p")).alias("o"), F.max("id").alias("hi")).where("o.id < hi")
    # A long owner's windows are dealt to several shards, by where they start in it.
    owners = written(first_of.select("w", F.col("o.id").alias("owner"), F.floor(F.col("o.p") / shard_words).cast("long").alias("chunk")), "sub-owners")
    shards = max(1, math.ceil(owners.count() / shard_words))
    owned = each.join(owners, "w").groupBy("key").agg(F.collect_list(F.struct("p", "owner", "chunk")).alias("ws"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for own_id, key, text, ws in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3), strict=True):
                found = split(text.as_py())
                p = ws.values.field(0).to_numpy()
                o = np.stack([ws.values.field(i).to_numpy() for i in (1, 2)], axis=1)
                p, fresh = np.unique(p, return_index=True)
                o = o[fresh]
                edge = np.flatnonzero(np.concatenate([[True], (np.diff(p) != 1) | (o[1:] != o[:-1]).any(1), [True]]))
                for i, j in zip(edge[:-1], edge[1:], strict=True):
                    start, end = int(p[i]), int(p[j - 1]) + window
                    owner, chunk = o[i].tolist()
                    words = found[start:end]
                    for col, v in zip(out, (owner, chunk, int(owner != own_id), key, start, len(words), b" ".join(words)), strict=True):
                        col.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["owner", "chunk", "kind", "key", "start", "n", "words"])

    texts = open_.select(F.col("_w_id").alias("id"), F.col("_w_key").alias("key"), "text").join(owned, "key").select("id", "key", "text", "ws")
    spans = texts.mapInArrow(cut, "owner long, chunk long, kind int, key binary, start long, n long, words binary")
    spans = written(spans.withColumn("shard", F.pmod(F.xxhash64("owner", "chunk"), F.lit(shards))), "sub-spans")
    copies_of = spans.where("kind = 1").groupBy("shard").agg(F.sum("n").alias("all")).select("shard", F.ceil(F.col("all") / stream_words).cast("int").alias("parts"))
    copies_of = written(copies_of, "sub-shards")
    sized = spans.join(copies_of, "shard")
    part = F.when(F.col("kind") == 1, F.array(F.pmod(F.xxhash64("key", "start"), F.col("parts")).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = sized.select("shard", F.explode(part).alias("part"), "kind", "key", "start", "words").repartition("shard", "part").sortWithinPartitions("shard", "part", "kind", "key", "start")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, automaton = None, Automaton()
        for b in batches:
            out: list[list] = [[], [], []]
            for shard, part, kind, key, start, words in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (shard, part) != at:
                    at, automaton = (shard, part), Automaton()
                if not kind:
                    automaton.add(words.split(b" "))
                    continue
                for x, y in automaton.spans(words.split(b" "), window):
                    for col, v in zip(out, (key, start + x, start + y), strict=True):
                        col.append(v)
            kinds = [pa.binary(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["key", "x", "y"])

    found = dealt.mapInArrow(stream, "key binary, x long, y long").groupBy(F.col("key").alias("_w_key")).agg(F.collect_list(F.struct("x", "y")).alias("_w_spans"))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_columns
            out: list[list] = [[], [], [], []]
            for t, spans in zip(b.column(place), b.column(n - 1).to_pylist(), strict=True):
                text = t.as_py()
                words, left, at = split(text), [], 0
                for x, y in _merged([(s["x"], s["y"]) for s in spans or []]):
                    left += words[at:x]
                    at = y
                left += words[at:]
                whole = b" ".join(left)
                gone = len(words) - len(left)
                shown = whole.decode("utf-8", "surrogatepass") if gone else text if keep_untouched else None
                for col, v in zip(out, (shown, len(words), gone, hashlib.sha256(whole).hexdigest()), strict=True):
                    col.append(v)
            made = [pa.array(c, k) for c, k in zip(out, [pa.string(), pa.int64(), pa.int64(), pa.string()], strict=True)]
            cols = list(b.columns[: n - 1])
            cols[place] = made[0]
            yield pa.RecordBatch.from_arrays([*cols, *made[1:]], [*b.schema.names[: n - 1], "_w_words", "_w_removed", "_w_sha"])

    own_types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name in own)
    last = open_.select(*own, "_w_key").join(found, "_w_key", "left").select(*own, "_w_spans")
    last = last.mapInArrow(kept, own_types + ", _w_words long, _w_removed long, _w_sha string")
    return done.select(*last.columns).unionByName(last).select("row", "text", F.col("_w_words").alias("words"), F.col("_w_removed").alias("removed"), F.col("_w_sha").alias("sha"))


WINDOWED = ["_w_words", "_w_removed", "_w_sha", "_w_starts", "_w_hashes"]


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """docs without repeated spans, with its columns; documents that lose all their words go.

    A row that keeps words keeps its place, and its n_chars, where there is such a column, follows
    its text. Null ids, ties, repeated rows and empty tables: see deduplicated. Documents without
    words (null, empty) lose none and stay.
    """
    got = deduplicated(docs, keep_untouched=True, **options).where("removed = 0 or removed < words")
    lost = F.col("removed") > 0
    cols = []
    for f in docs.schema.fields:
        if f.name == "text":
            cols.append(F.col("text").cast(f.dataType).alias("text"))
        elif f.name == "n_chars":
            cols.append(F.when(lost, F.length("text").cast(f.dataType)).otherwise(F.col("row.n_chars")).alias("n_chars"))
        else:
            cols.append(F.col(f"row.`{f.name}`").alias(f.name))
    return got.select(*cols)

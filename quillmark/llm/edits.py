"""Document fingerprints by a randomised edit embedding.

A walk reads a text with coins that all texts share: at each step it notes the character it
stands on, and the step's coin for that character says whether it moves on. After an edit two
walks soon fall in step again, so texts at a small edit distance have embeddings at a small
Hamming distance. A fingerprint is the embedding at sampled steps, SAMPLES in each octave of
steps and all steps of the first octaves. Likeness weighs the samples by the steps they stand for.

Near classes come from bands of sampled symbols: fingerprints that share a band are candidates,
which are verified by their likeness; no link between members of a band is lost (see grouped).
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmark.llm.common import hot_keys, hot_lookup, small_batches, written
from quillmark.llm.components import components
from quillmark.llm.grouped import linked

SAMPLES = 40
CLASSES = 16
#: Coins repeat after so many steps; a character is read for MOST steps at most.
PERIOD = 1 << 16
MOST = 8
BLOCK = PERIOD // MOST
PAD = "-"
#: Symbols of a band (of octaves with fewer than SAMPLES symbols, SHORT), cut from the last BANDED octaves.
BAND, SHORT = 8, 4
BANDED = 3
NEAR = 0.8

_made: dict[str, list] = {}


def _coins() -> list[list[int]]:
    """For each class and step, the step at which a character read from there is left."""
    if "coins" not in _made:
        rng = np.random.default_rng(20)
        rows = []
        for _ in range(CLASSES):
            moves = np.tile(rng.integers(0, 2, PERIOD), 3).astype(bool)
            n = 2 * PERIOD
            leave = np.full(n, MOST, dtype=np.int64)
            for wait in range(MOST - 1, 0, -1):
                leave[moves[wait - 1 : wait - 1 + n]] = wait
            # A smaller wait found later in the loop overrides a larger one.
            rows.append((leave + np.arange(n)).tolist())
        _made["coins"] = rows
    return _made["coins"]


def octave_size(octave: int) -> int:
    return min(SAMPLES, 1 << octave)


def _samples(octave: int) -> np.ndarray:
    """Sampled steps of an octave, sorted. Octave k holds the steps from 2^k - 1 to 2^(k+1) - 2."""
    key = f"samples{octave}"
    if key not in _made:
        rng = random.Random(octave)
        every = octave_size(octave) == 1 << octave
        _made[key] = np.array(sorted(range(1 << octave) if every else (rng.randrange(1 << octave) for _ in range(SAMPLES))), dtype=np.int64) + (1 << octave) - 1
    return _made[key]


def _plan(top: int) -> tuple[np.ndarray, np.ndarray]:
    """Sampled steps and weights of the octaves from top down to the first."""
    key = f"plan{top}"
    if key not in _made:
        octaves = range(top, -1, -1)
        _made[key] = [np.concatenate([_samples(k) for k in octaves]), np.concatenate([np.full(octave_size(k), 2.0**k / octave_size(k)) for k in octaves])]
    return tuple(_made[key])


def classes(text: str) -> np.ndarray:
    """The class of each code point, as the embedding notes it."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return ((points * np.uint32(0x9E3779B1)) >> np.uint32(28)).astype(np.uint8)


def walk(symbols: np.ndarray, start: int = 0) -> np.ndarray:
    """The step at which each character is first read, and at the end the step after the last."""
    coins, found, base = _coins(), [], start - start % PERIOD
    step = start % PERIOD
    for at in range(0, len(symbols), BLOCK):
        steps: list[int] = []
        note = steps.append
        for row in map(coins.__getitem__, symbols[at : at + BLOCK].tolist()):
            note(step)
            step = row[step]
        found.append(np.array(steps, dtype=np.int64) + base)
        base += step - step % PERIOD
        step %= PERIOD
    return np.concatenate([*found, np.array([base + step], dtype=np.int64)])


_DIGITS = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)


def fingerprint(symbols: np.ndarray, steps: np.ndarray) -> str:
    """The last octave as two hex digits, then the samples of all octaves, the last first.

    A text without characters has the one octave of a single step that it doesn't take.
    """
    end = int(steps[-1])
    top = max(1, end).bit_length() - 1
    at, _ = _plan(top)
    out = np.full(len(at), ord(PAD), dtype=np.uint8)
    taken = at < end
    out[taken] = _DIGITS[symbols[np.searchsorted(steps, at[taken], "right") - 1]]
    return f"{top:02x}" + out.tobytes().decode()


def _rows_of(prints: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints as rows of one matrix, octaves in line, and the columns' weights."""
    top = max(int(x[:2], 16) for x in prints)
    _, weights = _plan(top)
    out = np.full((len(prints), len(weights)), ord(PAD), dtype=np.uint8)
    for row, x in zip(out, prints, strict=True):
        row[len(weights) - len(x) + 2 :] = np.frombuffer(x[2:].encode(), dtype=np.uint8)
    return out, weights


def likenesses(one: np.ndarray, others: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Share of the steps, of those that either walk takes, at which the embeddings agree."""
    there = (others != ord(PAD)) | (one != ord(PAD))
    seen = there @ weights
    same = ((others == one) & there) @ weights
    return np.where(seen > 0, same / np.maximum(seen, 1e-300), 1.0)


def likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    m, weights = _rows_of([a, b])
    return float(likenesses(m[0], m[1:], weights)[0])


class Printed:
    """A text with its walk and fingerprint."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.symbols = classes(self.text)
        self.steps = walk(self.symbols)
        self.print = fingerprint(self.symbols, self.steps)

    def edited(self, following: Printed) -> tuple[str, str]:
        """The text with its last half replaced by the start of the following one, and its fingerprint."""
        half = len(self.text) // 2
        keep = len(self.text) - half
        symbols = np.concatenate([self.symbols[:keep], following.symbols[:half]])
        steps = np.concatenate([self.steps[:keep], walk(following.symbols[:half], int(self.steps[keep]))])
        return self.text[:keep] + following.text[:half], fingerprint(symbols, steps)


NAMES = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _result(own: Printed, following: Printed) -> tuple:
    text, edited = own.edited(following)
    digest = hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()
    return len(own.text), digest, own.print, edited, likeness(own.print, edited), likeness(own.print, following.print)


def _shrunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts travel compressed."""
    pack = zstandard.ZstdCompressor(level=1, write_content_size=True).compress
    for b in batches:
        texts = pa.array([pack(t.as_py().encode("utf-8", "surrogatepass")) for t in b.column(2)], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), texts], ["doc_id", "h", "text"])


def with_edits(docs: DataFrame) -> DataFrame:
    """docs: (doc_id, text); other columns are not read. A row per row, see RESULT.

    The next document is the next one in descending doc_id, null ids last, rows that share an
    id by a hash of their texts; the first one follows the last, and a single row follows
    itself. A null text is an empty one. Rows are dealt by ranges of ids; a task's last row
    waits for the next task's first one, and only those meet in a second, small step.
    """
    spark = docs.sparkSession
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.desc_nulls_last("doc_id"), F.asc("h")]
    small = rows.withColumn("h", F.xxhash64("text")).select("doc_id", "h", "text").mapInArrow(_shrunk, "doc_id long, h long, text binary")
    dealt = small.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()

        def out(kind: str, found: list[tuple], text: list[str | None]) -> pa.RecordBatch:
            cols = list(zip(*found, strict=True))
            head = [pa.array([kind] * len(found)), pa.array([part] * len(found), pa.int32()), pa.array(text, pa.string())]
            return pa.RecordBatch.from_arrays([*head, *(pa.array(c, k) for c, k in zip(cols, KINDS, strict=True))], ["kind", "part", "text", "doc_id", *NAMES])

        before: tuple[int | None, Printed] | None = None
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            found = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                now = Printed(unpack(text.as_py()).decode("utf-8", "surrogatepass"))
                if before is None:
                    yield out("first", [(doc_id, *[None] * 6)], [now.text])
                else:
                    found.append((before[0], *_result(before[1], now)))
                before = (doc_id, now)
            if found:
                yield out("row", found, [None] * len(found))
        if before is not None:
            yield out("last", [(before[0], *[None] * 6)], [before[1].text])

    done = written(dealt.select("doc_id", "text").mapInArrow(run, "kind string, part int, text string, " + RESULT), "edit-rows")
    first = done.where("kind = 'first'").select("part", F.col("text").alias("following"))
    last = done.where("kind = 'last'").select("part", "doc_id", "text")
    # One row a task: which task comes next.
    turn = Window.orderBy("part")
    all_parts = turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follows = first.select(F.col("part").alias("own"), F.coalesce(F.lead("part").over(turn), F.first("part").over(all_parts)).alias("part"))
    ends = last.join(follows, last["part"] == follows["own"]).select("doc_id", "text", follows["part"].alias("part")).join(first, "part")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(i, *_result(Printed(x.as_py()), Printed(y.as_py()))) for i, x, y in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True)]
            cols = list(zip(*found, strict=True)) if found else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, KINDS, strict=True)], ["doc_id", *NAMES])

    ended = ends.select("doc_id", "text", "following").mapInArrow(finish, RESULT)
    return done.where("kind = 'row'").select("doc_id", *NAMES).unionByName(ended)


def bands(fingerprint: str) -> list[int]:
    """Keys of a fingerprint: stretches of the samples of its last octaves, without those that
    hold steps that it doesn't take."""
    top, at, out = int(fingerprint[:2], 16), 2, []
    for octave in range(top, max(-1, top - BANDED), -1):
        size = octave_size(octave)
        wide = min(size, BAND if size == SAMPLES else SHORT)
        for n in range(size // wide):
            part = fingerprint[at + n * wide : at + (n + 1) * wide]
            if PAD not in part:
                out.append(xxhash.xxh64_intdigest(f"{octave}/{n}/{part}") - (1 << 63))
        at += size
    return out


def near_classes(prints: DataFrame, least: float = NEAR) -> DataFrame:
    """prints: (fingerprint, ...), written. Returns (node, fingerprint, root) of the fingerprints that
    are linked to another: root is the mark of their class.

    Equal fingerprints are one node. Nodes that share a band and have a likeness of `least` or
    more are linked; a class is what links connect.
    """

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = pa.array([bands(x) for x in b.column(0).to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*b.columns, keys], ["fingerprint", "node", "keys"])

    nodes = prints.select("fingerprint").distinct().withColumn("node", F.xxhash64("fingerprint"))
    nodes = written(nodes.mapInArrow(banded, "fingerprint string, node long, keys array<long>"), "edit-nodes")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = [likeness(x, y) >= least for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield b.select([0, 1]).filter(pa.array(near, pa.bool_()))

    def check(pairs: DataFrame) -> DataFrame:
        with_prints = pairs
        for side in "ab":
            of = nodes.select(F.col("node").alias(side), F.col("fingerprint").alias(f"{side}_print"))
            with_prints = hot_lookup(with_prints, of, [side], ["a", "b"], hot=hot_keys(pairs, [side]))
        return with_prints.select("a", "b", "a_print", "b_print").mapInArrow(verify, "a long, b long")

    def load(rows: DataFrame) -> DataFrame:
        return rows.join(nodes.select("node", "fingerprint"), "node").select(*rows.columns, "fingerprint")

    def compare(payload: list[pa.Array], asks: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m, weights = _rows_of(payload[0].to_pylist())
        hits = [there[likenesses(m[i], m[there], weights) >= least] for i in asks]
        return np.repeat(asks, [len(x) for x in hits]), np.concatenate(hits)

    return nodes.join(components(linked(nodes.select("node", "keys"), check, load, compare, "edit")), "node").select("node", "fingerprint", "root")


def with_classes(rows: DataFrame, least: float = NEAR) -> DataFrame:
    """rows: (doc_id, fingerprint, ...), written. Adds class_id, the smallest doc_id of the near class, and
    class_rows, its number of rows. Null ids are larger than all others."""
    roots = written(near_classes(rows.select("fingerprint"), least).select("fingerprint", "root"), "edit-roots")
    each = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    each = written(each.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", F.xxhash64("fingerprint"))).select("fingerprint", "root", "first", "n"), "edit-each")
    of = each.groupBy("root").agg(F.min("first").alias("class_id"), F.sum("n").alias("class_rows"))
    several = written(each.join(of.where("class_rows > 1"), "root").select(F.xxhash64("fingerprint").alias("_node"), "class_id", "class_rows"), "edit-several")
    keyed = rows.withColumn("_node", F.xxhash64("fingerprint"))
    out = hot_lookup(keyed, several, ["_node"], ["doc_id"]).drop("_node")
    alone = F.col("class_rows").isNull()
    return out.withColumn("class_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id"))).withColumn("class_rows", F.coalesce("class_rows", F.lit(1)))

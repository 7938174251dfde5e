"""Packing documents into sequences: first-fit decreasing with a tournament tree of capacities.

Documents go to randomised groups of about GROUP_DOCS; every group is packed by itself, in turns of
about TURN_TOKENS, so a task holds the ids of one turn and of one document. In a turn, whole sequences are cut from long documents, the
rests are placed first-fit decreasing, then the emptiest sequences fill the gaps of the
others, and what is left over is cut into sequences whose lengths are powers of two.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import small_batches

SEQUENCE = 2048
END = 1
GROUP_DOCS = 1024
#: Tokens after which a group's documents are packed and the group goes on with the next ones.
TURN_TOKENS = 4 << 20
#: Groups of a task.
TASK_GROUPS = 16
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

_encoders: dict[str, object] = {}


def encoder(path: str):
    """text -> ids. path: a tokenizers .json file or the same vocabulary as .tiktoken ranks.

    Ids of a .tiktoken file are those of the .json file of the same name; it takes a third of
    the time. The .json file's added tokens are single ids where a text holds them, in either.
    """
    if path not in _encoders:
        if path.endswith(".tiktoken"):
            import base64
            import json

            import public_tokenizers
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            with open(path.removesuffix(".tiktoken") + ".json", encoding="utf-8") as f:
                added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
            ranks = {t: i for t, i in ranks.items() if i not in added.values()}
            enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
            _encoders[path] = lambda text: enc.encode(text, allowed_special="all")
        else:
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(path)
            _encoders[path] = lambda text: tok.encode(text, add_special_tokens=False).ids
    return _encoders[path]


class Tournament:
    """Capacities of n sequences; first(need) is the first that still has need, or n."""

    def __init__(self, n: int, capacity: int):
        self.leaves = 1 << max(0, n - 1).bit_length()
        self.tree = [capacity] * (2 * self.leaves)

    def first(self, need: int) -> int:
        node, tree = 1, self.tree
        while node < self.leaves:
            node *= 2
            if tree[node] < need:
                node += 1
        return node - self.leaves

    def take(self, leaf: int, need: int) -> None:
        node, tree = leaf + self.leaves, self.tree
        tree[node] -= need
        node >>= 1
        while node:
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
            node >>= 1


def pack(lengths: list[int], sequence: int = SEQUENCE) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, start, length); every token is in exactly one piece."""
    full: list[list[tuple[int, int, int]]] = []
    rests: list[tuple[int, int, int]] = []
    for d, n in enumerate(lengths):
        whole = n // sequence * sequence
        full += [[(d, s, sequence)] for s in range(0, whole, sequence)]
        if n > whole:
            rests.append((d, whole, n - whole))
    rests.sort(key=lambda x: (-x[2], x[0]))
    tree, bins = Tournament(len(rests), sequence), [[] for _ in rests]
    for piece in rests:
        at = tree.first(piece[2])
        tree.take(at, piece[2])
        bins[at].append(piece)
    open_bins = []
    for b in filter(None, bins):
        (full if sum(p[2] for p in b) == sequence else open_bins).append(b)
    open_bins.sort(key=lambda b: -sum(p[2] for p in b))
    i, j = 0, len(open_bins) - 1
    while i < j:
        gap = sequence - sum(p[2] for p in open_bins[i])
        while gap and i < j:
            d, s, n = open_bins[j].pop()
            part = min(n, gap)
            open_bins[i].append((d, s, part))
            if part < n:
                open_bins[j].append((d, s + part, n - part))
            gap -= part
            if not open_bins[j]:
                j -= 1
        if not gap:
            full.append(open_bins[i])
            i += 1
    if open_bins and i == j:
        last, left = open_bins[i], sum(p[2] for p in open_bins[i])
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            out = []
            while size:
                d, s, n = last.pop()
                part = min(n, size)
                out.append((d, s, part))
                if part < n:
                    last.append((d, s + part, n - part))
                size -= part
            full.append(out)
    return full


def _rows(group: int, first: int, ids: list[object], docs: list[np.ndarray], sequence: int) -> tuple[pa.RecordBatch, int]:
    """The pieces of a turn whose sequences are numbered from `first`, and the next number."""
    cols: list[list] = [[] for _ in range(7)]
    bins = pack([len(x) for x in docs], sequence)
    for k, pieces in enumerate(bins, first):
        at = 0
        for d, s, n in pieces:
            crc = zlib.crc32(docs[d][s : s + n].tobytes())
            for col, v in zip(cols, (ids[d], s, n, crc, len(docs[d]), (group << 32) + k, at), strict=True):
                col.append(v)
            at += n
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names), first + len(bins)


def packed(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end: int = END, group_docs: int = GROUP_DOCS) -> DataFrame:
    """docs: (doc_id, text); other columns are not read. A row per piece, see PIECES.

    A null text is an empty one, whose only id is `end`. A null doc_id is kept. Rows that
    share a doc_id are packed one by one; equal rows are in one group, in turns. Sequence ids are
    2^32 times the group plus the place in the group. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    groups = max(1, math.ceil(docs.count() / group_docs))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(groups / TASK_GROUPS))
    dealt = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("h", F.xxhash64("doc_id", "text"))
        .withColumn("g", F.pmod(F.xxhash64("h", F.lit(7)), F.lit(groups)))
        .repartition(parts, "g")
        .sortWithinPartitions("g", "h", "doc_id")
        .select("g", "doc_id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        group, number, tokens, ids, held = None, 0, 0, [], []
        for b in batches:
            for g, doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                if held and (g != group or tokens >= TURN_TOKENS):
                    rows, number = _rows(group, number, ids, held, sequence)
                    yield rows
                    tokens, ids, held = 0, [], []
                if g != group:
                    group, number = g, 0
                ids.append(doc_id)
                held.append(np.array([*encode(text.as_py()), end], dtype="<u4"))
                tokens += len(held[-1])
        if held:
            yield _rows(group, number, ids, held, sequence)[0]

    return dealt.mapInArrow(run, PIECES)

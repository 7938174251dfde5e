"""A registry as an index that every task holds: the best records of a text without its pairs.

The sum over a text's keys splits into keys that few records have and keys that many have. A record
that has none of the former scores what the latter give, so the best by the latter alone, found once
for all texts that have the same ones, and the records of the former, one by one, hold the best.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A key of more records than this is frequent; more records than FEW are scored all at once.
RARE, FEW = 64, 64
KINDS = "tahy"
Best = list[tuple[float, float, bool, int]]


def ends(rest: str) -> bool:
    """As columns.doi_ends."""
    if rest[:1] == ".":
        return len(rest) < 2 or unicodedata.category(rest[1])[0] not in "LN"
    return rest == "" or rest[0] not in "0123456789abcdefghijklmnopqrstuvwxyz/_-"


class Index:
    """records: (id, ord, nt, na, doi, keys) in registry order, keys (key, kind, n) as in matching."""

    def __init__(self, records: pa.Table, weights: tuple[float, float, float, float]):
        records = records.combine_chunks()
        self.weights = weights
        self.ids = records.select(["id", "ord"])
        self.size = len(records)
        self.words, self.names = (records[c].to_numpy().astype(np.int64) for c in ("nt", "na"))
        self.dois: dict[str, list[int]] = {}
        for i, doi in enumerate(records["doi"].to_pylist()):
            if doi:
                self.dois.setdefault(doi, []).append(i)
        self.lengths: dict[str, set[int]] = {}
        for doi in self.dois:
            self.lengths.setdefault(doi[: doi.find("/") + 1], set()).add(len(doi))

        lists = pa.concat_arrays(records["keys"].chunks) if records["keys"].chunks else pa.array([], records.schema.field("keys").type)
        flat = pc.list_flatten(lists)
        key = pc.struct_field(flat, "key").dictionary_encode()
        self.keys = key.dictionary
        of, rec = key.indices.to_numpy(zero_copy_only=False).astype(np.int64), pc.list_parent_indices(lists).to_numpy().astype(np.int64)
        kind, n = pc.struct_field(flat, "kind").to_numpy(zero_copy_only=False), pc.struct_field(flat, "n").to_numpy(zero_copy_only=False).astype(np.int64)
        self.most = np.bincount(of, minlength=len(self.keys))
        self.stride = int(n.max(initial=0)) + 1
        #: By kind, the records of each key, and for parts of surnames which surname.
        self.lists = {}
        for k in KINDS:
            at = np.flatnonzero(kind == k)
            at = at[np.argsort(of[at], kind="stable")]
            self.lists[k] = (np.searchsorted(of[at], np.arange(len(self.keys) + 1)), rec[at], n[at])
        self.own = np.searchsorted(rec, np.arange(self.size + 1))
        self.own_of, self.own_kind, self.own_n = of, kind, n

    def printed(self, found: list[str]) -> list[int]:
        """The records whose DOI begins one of these texts and ends there."""
        out = set()
        for text in found:
            for n in self.lengths.get(text[: text.find("/") + 1], ()):
                if len(text) >= n and ends(text[n : n + 2]) and text[:n] in self.dois:
                    out.update(self.dois[text[:n]])
        return sorted(out)

    def _met(self, kind: str, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start, rec, n = self.lists[kind]
        lens = start[keys + 1] - start[keys]
        at = np.repeat(start[keys] - np.cumsum(lens) + lens, lens) + np.arange(lens.sum())
        return rec[at], n[at]

    def all(self, keys: np.ndarray, dois: list[int], n: int) -> Best:
        """The n best of all records, by (score, order); what scores nothing is none."""
        count = lambda rec: np.bincount(rec, minlength=self.size)
        share = lambda c, of: np.divide(c, of, out=np.zeros(self.size), where=of > 0)
        parts = np.unique(self._met("h", keys)[0] * self.stride + self._met("h", keys)[1]) // self.stride
        doi = count(np.array(dois, np.int64)) > 0
        title = share(count(self._met("t", keys)[0]), self.words)
        authors = share(count(self._met("a", keys)[0]) + count(parts), self.names)
        w = self.weights
        score = w[0] * doi + w[1] * title + w[2] * authors + w[3] * (count(self._met("y", keys)[0]) > 0)
        least = np.partition(score, self.size - n)[self.size - n] if self.size > n else 0.0
        at = np.flatnonzero((score >= least) & (score > 0))
        at = at[np.argsort(-score[at], kind="stable")[:n]]
        return [(float(score[i]), float(title[i]), bool(doi[i]), int(i)) for i in at]

    def one(self, i: int, keys: set[int], doi: bool) -> tuple[float, float, bool, int]:
        """The score of one record."""
        title, authors, parts, year = 0, 0, set(), False
        for at in range(self.own[i], self.own[i + 1]):
            if int(self.own_of[at]) not in keys:
                continue
            kind = self.own_kind[at]
            title += kind == "t"
            authors += kind == "a"
            year |= kind == "y"
            if kind == "h":
                parts.add(self.own_n[at])
        share = title / self.words[i] if self.words[i] else 0.0
        named = (authors + len(parts)) / self.names[i] if self.names[i] else 0.0
        w = self.weights
        return float(w[0] * doi + w[1] * share + w[2] * named + w[3] * year), float(share), doi, i

    def best(self, texts: Iterator[tuple[np.ndarray, list[int]]], n: int) -> Iterator[Best]:
        """The n best records for each (keys, records whose DOI is printed)."""
        common = lru_cache(4096)(lambda keys: self.all(np.array(keys, np.int64), [], n))
        for keys, dois in texts:
            many = self.most[keys] > RARE
            few = keys[~many]
            if self.most[few].sum() + len(dois) > FEW or self.size <= FEW * n:
                yield self.all(keys, dois, n)
                continue
            near = set(dois).union(*(self._met(k, few)[0].tolist() for k in KINDS)) if len(few) else set(dois)
            found = {x[3]: x for x in common(tuple(np.sort(keys[many]).tolist()))}
            has = set(keys.tolist())
            found |= {i: self.one(i, has, i in dois) for i in near}
            yield sorted(found.values(), key=lambda x: (-x[0], x[3]))[:n]

    def ranked(self, batch: pa.RecordBatch, n: int) -> pa.RecordBatch:
        """(doc_id, id, ord, doi_hit, title_overlap, score, place, runner_up) of the texts of a batch
        (doc_id, own keys, texts that begin with a registrant)."""
        own = batch.column("own")
        of = pc.fill_null(pc.index_in(own.flatten(), value_set=self.keys), -1).to_numpy().astype(np.int64)
        edge = np.concatenate([[0], np.cumsum(pc.list_value_length(own).to_numpy())])
        texts = ((of[a:b][of[a:b] >= 0], self.printed(d) if d else []) for a, b, d in zip(edge[:-1], edge[1:], batch.column("dois").to_pylist(), strict=True))
        rows = []
        for doc, found in enumerate(self.best(texts, n + 1)):
            found = found or ([(0.0, 0.0, False, 0)] if self.size else [])
            rows += [(doc, i, doi, title, score, place + 1, found[place + 1][0] if place + 1 < len(found) else 0.0) for place, (score, title, doi, i) in enumerate(found[:n])]
        doc, rec, *rest = ([r[k] for r in rows] for k in range(7))
        ids = self.ids.take(pa.array(rec, pa.int64())).combine_chunks()
        whole = [batch.column("doc_id").take(pa.array(doc, pa.int64())), *(pa.concat_arrays(ids[c].chunks) if ids[c].chunks else pa.array([], ids[c].type) for c in ("id", "ord"))]
        kinds = [pa.bool_(), pa.float64(), pa.float64(), pa.int64(), pa.float64()]
        names = ["doc_id", "id", "ord", "doi_hit", "title_overlap", "score", "place", "runner_up"]
        return pa.RecordBatch.from_arrays(whole + [pa.array(v, k) for v, k in zip(rest, kinds, strict=True)], names)

"""Validation of paper bundles over a whole corpus.

All rules of a bundle need that bundle only, so rows are dealt by bundle once and each bundle is
judged in one pass, its contents dropped as soon as they are. Declarations become facts: what is
wrong with their own shape, and what they declare. A check that would read an untrusted value is
gated: its facts are only there where the file they come from is sound enough.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import ExitStack
from tempfile import TemporaryFile
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmark.functions import columns as C
from quillmark.functions.strict_json import parsed, repeated_keys, type_name
from quillmark.operators.markup import findings

# Fixed values.
SCHEMA_VERSION = 5
BUNDLE_ENTRIES = ["manifest.json", "text.md", "figures", "tables", "supplements.json", "supplements"]
SUPPLEMENT_ENTRIES = ["text.md", "figures", "tables"]
MANIFEST = {"schema_version": True, "id": True, "title": True, "exhibits": True, "doi": False, "summary": False}
EXHIBIT, EXHIBIT_EXTRA = ("label", "caption"), ("notes",)
SUPPLEMENTS, SUPPLEMENT = ("id", "supplements"), ("name", "title", "exhibits")

#: Rows of a task that are held at once, and the files to which more are dealt.
HELD_BYTES, BINS = 64 << 20, 64

#: Phases in the order in which problems are listed.
PHASES = ["root", "case", "manifest", "text", "figures", "tables", "supplements", "binding", "table_binding", "contents", "uniqueness"]
VIOLATIONS = "bundle_id string, phase string, scope string, ord long, rule string, detail string"
DECLARATIONS = {"manifest.json": "manifest", "supplements.json": "supplements"}


def name_fault(value: object) -> str | None:
    """As columns.name_rule, for values inside JSON."""
    if not isinstance(value, str):
        return "type"
    if re.fullmatch(r"[A-Za-z0-9._-]+", value) is None:
        return "pattern"
    if not re.search("[A-Za-z0-9]", value):
        return "punctuation"
    return "dot" if value[0] == "." else None


class Facts:
    """Facts of one file, in the order in which they are found: (kind, scope, pos, name, rule, detail)."""

    def __init__(self, file: str):
        self.file = file
        self.rows: list[tuple] = []

    def wrong(self, rule: str, detail: str = "") -> None:
        self.rows.append(("violation", "", len(self.rows), "", rule, detail))

    def fact(self, kind: str, name: str = "", scope: str = "", pos: int = 0) -> None:
        self.rows.append((kind, scope, pos, name, "", ""))

    def text(self, record: dict, key: str, where: str, required: bool = True, blank: bool = False) -> bool:
        """Whether a string field is as it must be."""
        if key not in record:
            if required:
                self.wrong("missing_key", f"{where}{key}")
            return not required
        value = record[key]
        if not isinstance(value, str):
            self.wrong("key_type", f"{where}{key}: {type_name(value)}")
            return False
        if not blank and not value.strip():
            self.wrong("key_empty", f"{where}{key}")
            return False
        return True

    def record(self, raw: str) -> dict | None:
        value, fault = parsed(raw)
        if fault:
            self.wrong(fault.partition(":")[0], fault.partition(": ")[2])
            return None
        if not isinstance(value, dict):
            self.wrong("not_object", type_name(value))
            return None
        twice = repeated_keys(value)
        for at, key in twice:
            self.wrong("duplicate_key", f"{at} {key}".strip())
        return None if twice else value

    def exhibits(self, value: object, where: str) -> list[str] | None:
        """The labels of an exhibits list, or None if the list is not sound."""
        if not isinstance(value, list):
            self.wrong("exhibits_type", f"{where}{type_name(value)}")
            return None
        before, labels = len(self.rows), []
        for i, entry in enumerate(value):
            at = f"{where}exhibits[{i}] "
            if not isinstance(entry, dict):
                self.wrong("exhibit_type", f"{at}{type_name(entry)}")
                continue
            for key in sorted(set(entry) - {*EXHIBIT, *EXHIBIT_EXTRA}):
                self.wrong("unknown_key", f"{at}{key}")
            self.text(entry, "notes", at, required=False)
            sound = [self.text(entry, key, at) for key in EXHIBIT]
            if not sound[0]:
                continue
            label = entry["label"]
            if fault := name_fault(label):
                self.wrong(f"name_{fault}", f"{at}label {label!r}")
            elif label in labels:
                self.wrong("label_twice", f"{at}{label!r}")
            else:
                labels.append(label)
        return labels if len(self.rows) == before else None


def manifest_facts(raw: str) -> list[tuple]:
    f = Facts("manifest.json")
    record = f.record(raw)
    if record is None:
        return f.rows
    for key in record:
        if key not in MANIFEST:
            f.wrong("unknown_key", key)
    labels = None
    for key, required in MANIFEST.items():
        if key == "schema_version" and key in record:
            v = record[key]
            if not isinstance(v, int) or isinstance(v, bool):
                f.wrong("key_type", f"{key}: {type_name(v)}")
            elif v != SCHEMA_VERSION:
                f.wrong("schema_version", str(v))
        elif key == "exhibits" and key in record:
            labels = f.exhibits(record[key], "")
        else:
            sound = f.text(record, key, "", required, blank=key == "doi")
            if key == "id" and sound and (fault := name_fault(record[key])):
                f.wrong(f"name_{fault}", f"id {record[key]!r}")
    if isinstance(record.get("id"), str):
        f.fact("id", record["id"])
    if labels is not None:
        f.fact("exhibits_sound")
        for i, label in enumerate(labels):
            f.fact("label", label, "", i)
    return f.rows


def supplements_facts(raw: str) -> list[tuple]:
    f = Facts("supplements.json")
    record = f.record(raw)
    if record is None:
        return f.rows
    for key in record:
        if key not in SUPPLEMENTS:
            f.wrong("unknown_key", key)
    for key in SUPPLEMENTS:
        if key not in record:
            f.wrong("missing_key", key)
    if "id" in record:
        if isinstance(record["id"], str):
            f.fact("id", record["id"])
        else:
            f.wrong("key_type", f"id: {type_name(record['id'])}")
    if "supplements" in record:
        declared = _supplements(f, record["supplements"])
        if declared is not None:
            f.fact("supplements_sound")
            for i, (name, labels) in enumerate(declared.items()):
                f.fact("supplement", name, f"supplements/{name}/", i)
                for j, label in enumerate(labels):
                    f.fact("label", label, f"supplements/{name}/", j)
    return f.rows


def _supplements(f: Facts, value: object) -> dict[str, list[str]] | None:
    if not isinstance(value, list):
        f.wrong("supplements_type", type_name(value))
        return None
    if not value:
        f.wrong("supplements_empty")
        return None
    declared: dict[str, list[str]] = {}
    sound = True
    for i, entry in enumerate(value):
        at = f"supplements[{i}] "
        if not isinstance(entry, dict):
            f.wrong("supplement_type", f"{at}{type_name(entry)}")
            sound = False
            continue
        # An unknown key is said, but what the entry declares can still be known.
        for key in sorted(set(entry) - set(SUPPLEMENT)):
            f.wrong("unknown_key", f"{at}{key}")
        fields = {key: f.text(entry, key, at) for key in ("name", "title")}
        labels = f.exhibits(entry["exhibits"], at) if "exhibits" in entry else None
        if "exhibits" not in entry:
            f.wrong("missing_key", f"{at}exhibits")
        sound &= all(fields.values()) and labels is not None
        if "exhibits" not in entry or not fields["name"]:
            continue
        name = entry["name"]
        fault = name_fault(name)
        if fault:
            f.wrong(f"name_{fault}", f"{at}name {name!r}")
        elif name in declared:
            f.wrong("supplement_twice", f"{at}{name!r}")
        sound &= not fault and name not in declared
        declared.setdefault(name, labels or [])
    return declared if sound else None


class Entry(NamedTuple):
    """A row of a bundle's listing, see sources.bundles."""

    scope: str
    dir: str
    name: str
    kind: str
    hidden: bool
    head: bytes | None
    content: str | None
    read_error: str | None

    @property
    def unread(self) -> bool:
        return self.kind != "file" or self.read_error is not None

    @property
    def broken(self) -> bool:
        """As a directory."""
        return self.kind != "dir" or self.read_error is not None

    @property
    def why(self) -> str:
        return self.read_error or self.kind

    def asset(self, folder: str, suffix: str) -> str | None:
        """The label, if the entry is a file of that folder with that suffix."""
        own = self.dir == folder and not self.hidden and self.kind != "dir" and self.name.endswith(suffix) and len(self.name) > len(suffix)
        return self.name[: -len(suffix)] if own else None


ASSETS = {"figures": ".png", "tables": ".html"}
Violation = tuple[str, str, int, str, str]


def picture_state(e: Entry) -> str | None:
    """What keeps a crop from being a picture."""
    if e.kind != "file":
        return "special"
    if e.read_error is not None:
        return "unreadable"
    return "empty" if not e.head else None if e.head == C.PNG_HEAD else "not_png"


def entry_rules(e: Entry, bad: set[str]) -> Iterator[Violation]:
    """(phase, scope, ord, rule, detail) that one entry of a checked scope shows. bad: folders of the
    scope that can't be listed."""
    article, top = e.scope == "", e.dir == ""
    lower = e.name.lower()
    if top and e.name != lower and lower in (BUNDLE_ENTRIES if article else SUPPLEMENT_ENTRIES):
        yield "case", e.scope, 0, "miscased", e.name
    if top and article and e.name in DECLARATIONS and e.unread:
        yield DECLARATIONS[e.name], e.scope, 0, "unreadable", e.why
    if top and e.name == "text.md":
        if e.unread:
            yield "text", e.scope, 0, "unreadable", e.why
        elif not (e.content or "").strip():
            yield "text", e.scope, 0, "empty", e.name
    if top and e.name in ASSETS and e.broken:
        yield e.name, e.scope, 0, "not_directory" if e.kind != "dir" else "unreadable", e.name if e.kind != "dir" else e.why
    if article and e.name == "supplements" and top and e.kind != "dir":
        yield "supplements", e.scope, 0, "not_directory", e.name
    if e.dir == "supplements" and e.kind != "dir" and not e.hidden:
        yield "supplements", e.scope, 0, "loose_file", e.name
    if e.dir not in ASSETS or e.hidden or e.dir in bad:
        return
    label = e.asset(e.dir, ASSETS[e.dir])
    if label is None:
        yield e.dir, e.scope, 0, "subdirectory" if e.kind == "dir" else "suffix", e.name
    elif e.dir == "figures":
        fault = name_fault(label)
        rule = f"name_{fault}" if fault else picture_state(e)
        if rule:
            yield "figures", e.scope, 0, rule, e.name
    elif e.unread:
        yield "tables", e.scope, 0, "unreadable", e.name
    else:
        for i, (rule, detail) in enumerate(findings(e.content)):
            yield "tables", e.scope, i, rule, f"{label}: {detail}"


def binding_rules(scope: str, bad: set[str], declared: set[str], crops: set[str], tables: set[str]) -> Iterator[Violation]:
    """Labels declared, cropped and transcribed, where both sides can be known."""
    if "figures" not in bad:
        yield from (("binding", scope, 0, "no_crop", x) for x in declared - crops)
        yield from (("binding", scope, 0, "undeclared", x) for x in crops - declared)
    if "tables" not in bad:
        yield from (("table_binding", scope, 0, "undeclared", x) for x in tables - declared)


def judged(entries: list[Entry]) -> list[Violation]:
    """The violations of one bundle."""
    tops = {(e.scope, e.name): e for e in entries if e.dir == ""}
    root = tops.get(("", ""))
    out: list[Violation] = [("root", "", 0, root.read_error, "")] if root and root.read_error else []
    facts = [(d, f) for d, make in (("manifest.json", manifest_facts), ("supplements.json", supplements_facts)) for e in [tops.get(("", d))] if e and e.content is not None for f in make(e.content)]
    out += [(DECLARATIONS[d], "", pos, rule, detail) for d, (kind, _, pos, _, rule, detail) in facts if kind == "violation"]
    told = lambda kind: [(d, scope, pos, name) for d, (k, scope, pos, name, _, _) in facts if k == kind]
    declared = {scope for _, scope, _, _ in told("supplement")}
    present = {f"supplements/{e.name}/" for e in entries if e.dir == "supplements" and e.kind == "dir" and not e.hidden}
    bad = lambda scope: {n for n in (*ASSETS, "supplements") if (e := tops.get((scope, n))) and e.broken}
    article = bool(root) and not root.read_error
    checked = ({""} if article else set()) | (declared & present)
    unlisted = {scope: bad(scope) for scope in checked}
    for e in entries:
        if e.name and e.scope in checked:
            out += entry_rules(e, unlisted[e.scope])

    if article:
        out += [(phase, "", 0, "missing_file", n) for n, phase in (("manifest.json", "manifest"), ("text.md", "text")) if ("", n) not in tops]
        ids = {d: name for d, _, _, name in told("id")}
        if len(ids) == 2 and len(set(ids.values())) == 2:
            out.append(("supplements", "", 0, "id_differs", f"{ids['supplements.json']} {ids['manifest.json']}"))
        if "supplements" not in unlisted[""]:
            sound, stated = bool(told("supplements_sound")), ("", "supplements.json") in tops
            name = lambda scope: scope.removeprefix("supplements/").removesuffix("/")
            out += [("supplements", "", 0, "no_declaration", name(x)) for x in present if not stated]
            out += [("supplements", "", 0, "missing_directory", name(x)) for x in declared - present if sound]
            out += [("supplements", "", 0, "undeclared", name(x)) for x in present - declared if sound]

    labels = sorted((scope, pos, name) for _, scope, pos, name in told("label"))
    for scope in checked & ({""} if told("exhibits_sound") else set()) | (checked & declared):
        of = lambda folder, scope=scope: {x for e in entries if e.scope == scope and folder not in unlisted[scope] and (x := e.asset(folder, ASSETS[folder]))}
        crops = {x for x in of("figures") if name_fault(x) is None}
        out += binding_rules(scope, unlisted[scope], {name for s, _, name in labels if s == scope}, crops, of("tables"))
    # One label, one exhibit: the article's first, where any supplement is declared.
    first: dict[str, str] = {}
    for scope, _, name in labels:
        if name in first:
            out.append(("uniqueness", scope, 0, "label_twice", f"{name} {first[name]}"))
        first.setdefault(name, scope)
    # What belongs to a supplement is listed with its contents.
    return [("contents" if scope and phase != "uniqueness" else phase, scope, *rest) for phase, scope, *rest in out]


def together(batches: Iterator[pa.RecordBatch], held_bytes: int = HELD_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows (bin, bundle_id, ...) of a task without bin, in small batches, each bundle's in one run.

    Few rows are sorted as they are. More are dealt by bin to files of the task's own, which are
    sorted one by one and gone when they are closed, so memory holds a bin and not the task.
    """
    held: list[pa.RecordBatch] = []
    size, schema = 0, None

    def runs(table: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from table.drop_columns(["bin"]).sort_by("bundle_id").to_batches(max_chunksize=4096)

    with ExitStack() as stack:
        bins: dict[int, tuple] = {}

        def deal() -> None:
            table = pa.Table.from_batches(held)
            table = table.take(pa.array(np.argsort(table["bin"].to_numpy(), kind="stable")))
            found, first = np.unique(table["bin"].to_numpy(), return_index=True)
            for k, at, to in zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(table)], strict=True):
                if k not in bins:
                    file = stack.enter_context(TemporaryFile())
                    bins[k] = file, pa.ipc.new_stream(file, schema, options=pa.ipc.IpcWriteOptions(compression="lz4"))
                bins[k][1].write_table(table.slice(at, to - at).combine_chunks())

        for b in batches:
            schema = b.schema
            held.append(b)
            size += b.nbytes
            if size > held_bytes:
                deal()
                held, size = [], 0
        if held and not bins:
            yield from runs(pa.Table.from_batches(held))
            return
        if held:
            deal()
            held = []
        for file, writer in bins.values():
            writer.close()
            file.seek(0)
            yield from runs(pa.ipc.open_stream(file).read_all())
            file.close()


def violations(files: DataFrame) -> DataFrame:
    """VIOLATIONS of all bundles of a files DataFrame (see sources.bundles); sound ones have none.

    Rows are dealt by bundle, and a task holds one bundle at a time. They are not sorted by Spark:
    parts are joined by their compressed size, and listings compress fifty-fold. Tables in which a
    whole bundle is one partition already are still dealt, since a DataFrame does not say so.
    """
    names = ["bundle_id", "phase", "scope", "ord", "rule", "detail"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
    return _by_bundle(files, lambda bundle, own: [(bundle, *v) for v in judged(own)], names, kinds, VIOLATIONS)


def _by_bundle(files: DataFrame, rows_of: Callable[[str, list[Entry]], list[tuple]], names: list[str], kinds: list[pa.DataType], schema: str) -> DataFrame:
    """What rows_of makes of each bundle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        at, own = None, []
        for b in together(batches):
            for bundle, *rest in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if bundle != at:
                    held += rows_of(at, own) if own else []
                    at, own = bundle, []
                own.append(Entry(*rest))
            if len(held) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], k) for i, k in enumerate(kinds)], names)
                held = []
        held += rows_of(at, own) if own else []
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], k) for i, k in enumerate(kinds)], names)

    bin_ = F.pmod(F.xxhash64("bundle_id"), F.lit(BINS)).cast("int").alias("bin")
    rows = files.select("bundle_id", *Entry._fields).repartition("bundle_id").select(bin_, "bundle_id", *Entry._fields)
    return rows.mapInArrow(run, schema)


def judgements(files: DataFrame) -> DataFrame:
    """(bundle_id, problems, valid) as verdicts gives them, in the pass that finds the problems."""

    def rows_of(bundle: str | None, own: list[Entry]) -> list[tuple]:
        n = len(judged(own)) if bundle is not None else 0
        return [(bundle, n, n == 0)] * sum((e.scope, e.dir, e.name) == ("", "", "") for e in own)

    return _by_bundle(files, rows_of, ["bundle_id", "problems", "valid"], [pa.string(), pa.int64(), pa.bool_()], "bundle_id string, problems long, valid boolean")


def listed(found: DataFrame) -> DataFrame:
    """(bundle_id, problems): the violations of each bundle in order, as short texts."""
    rank = F.array_position(F.array(*[F.lit(p) for p in PHASES]), F.col("phase"))
    text = F.concat_ws(" ", F.concat(F.col("scope"), F.col("phase")), "rule", "detail")
    own = F.array_sort(F.collect_list(F.struct(rank.alias("p"), "scope", "ord", text.alias("t"))))
    return found.groupBy("bundle_id").agg(F.transform(own, lambda x: x["t"]).alias("problems"))


def verdicts(files: DataFrame, found: DataFrame) -> DataFrame:
    """(bundle_id, valid, problems): the number of problems of every bundle."""
    n = found.groupBy("bundle_id").agg(F.count(F.lit(1)).alias("problems"))
    every = files.where("scope = '' and dir = '' and name = ''").select("bundle_id")
    out = every.join(n, "bundle_id", "left").withColumn("problems", F.coalesce("problems", F.lit(0)))
    return out.withColumn("valid", F.col("problems") == 0)


def first_problem(found: DataFrame) -> DataFrame:
    """The first violation of each bundle."""
    rank = F.array_position(F.array(*[F.lit(p) for p in PHASES]), F.col("phase"))
    w = Window.partitionBy("bundle_id").orderBy(rank, "scope", "ord", "rule", "detail")
    return found.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")

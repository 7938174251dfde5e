"""Bundle directories as rows: a Python data source with a partition a bundle.

Spark's own file sources leave out names that begin with an underscore, dot files and empty
directories, all of which matter to a check. Entries are told by lstat before anything is
opened, so a pipe is a row and not a wait. Option `paths`: the directories, a line each.
"""

from __future__ import annotations

import os
import stat
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "bundle_id string, scope string, dir string, name string, kind string, hidden boolean, size long, head binary, content string, read_error string"
HEAD = 8


class Bundle(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


def _kind(path: Path) -> str:
    try:
        mode = path.stat().st_mode
    except OSError:
        return "special"
    return "dir" if stat.S_ISDIR(mode) else "file" if stat.S_ISREG(mode) else "special"


def _entry(bundle: str, scope: str, folder: str, path: Path) -> tuple:
    kind, hidden = _kind(path), path.name.startswith(".")
    size = head = content = error = None
    if kind == "file" and not hidden:
        try:
            size = path.stat().st_size
            if path.suffix in (".json", ".md", ".html"):
                raw = path.read_bytes()
                head = raw[:HEAD]
                try:
                    content = raw.decode("utf-8").replace("\r\n", "\n").replace("\r", "\n")
                except UnicodeDecodeError:
                    error = "not UTF-8"
            else:
                with path.open("rb") as f:
                    head = f.read(HEAD)
        except OSError as e:
            error = e.strerror or "unreadable"
    return bundle, scope, folder, path.name, kind, hidden, size, head, content, error


def listing(path: str) -> Iterator[tuple]:
    """The rows of a bundle: its entries, those of its figures, tables and supplements. The
    bundle itself is a row with an empty name, whose read_error says what is wrong with it."""
    root = Path(path)
    bundle = root.name
    state = None if os.path.isdir(path) else "not_dir" if os.path.lexists(path) else "missing"

    def children(at: Path) -> list[Path] | None:
        try:
            return sorted(at.iterdir())
        except OSError:
            return None

    top = None if state else children(root)
    yield bundle, "", "", "", "dir" if state is None else "special", False, None, None, None, state or ("unreadable" if top is None else None)
    scopes = [("", root, top or [])]
    for scope, at, entries in scopes:
        for p in entries:
            yield _entry(bundle, scope, "", p)
            if p.name in ("figures", "tables") and _kind(p) == "dir":
                yield from (_entry(bundle, scope, p.name, c) for c in children(p) or [])
            if not scope and p.name == "supplements" and _kind(p) == "dir":
                for c in children(p) or []:
                    yield _entry(bundle, "", "supplements", c)
                    if _kind(c) == "dir" and not c.name.startswith("."):
                        scopes.append((f"supplements/{c.name}/", c, children(c) or []))


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[Bundle]:
        return [Bundle(p) for p in self.paths]

    def read(self, partition: Bundle) -> Iterator[tuple]:
        return listing(partition.path)


class BundleFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bundle_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader([p for p in self.options.get("paths", "").split("\n") if p])


def figure_files(files):
    """Crops: (bundle_id, scope, label, ...) of a files DataFrame, in order of their labels."""
    return _assets(files, "figures", ".png")


def table_files(files):
    return _assets(files, "tables", ".html")


def _assets(files, folder: str, suffix: str):
    from pyspark.sql import functions as F

    own = files.where((F.col("dir") == folder) & ~F.col("hidden") & (F.col("kind") != "dir") & F.col("name").endswith(suffix) & (F.length("name") > len(suffix)))
    return own.withColumn("label", F.expr(f"left(name, length(name) - {len(suffix)})")).orderBy("bundle_id", "scope", "label")


def supplement_dirs(files):
    from pyspark.sql import functions as F

    return files.where((F.col("dir") == "supplements") & (F.col("kind") == "dir") & ~F.col("hidden")).select("bundle_id", "name").orderBy("bundle_id", "name")

"""Table grids: positions that cells claim, and whether they tile a rectangle.

cells: (file, cell_seq, row, col, rowspan, colspan), 0-based; rows_written: (file, rows, empty)
with the number of rows and the array of rows without a cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmark.operators.integrity import capped

# Fixed values.
SPAN_LIMIT = 1000
GRID_LIMIT = 100_000


class Claimed:
    """The positions that a file's cells claim, each once: as rectangles apart from each other, and
    as a set once there are many of those."""

    MANY = 32

    def __init__(self) -> None:
        self.parts: list[tuple[int, int, int, int]] = []
        self.each: set[tuple[int, int]] | None = None
        self.size = 0

    def add(self, row: int, col: int, high: int, wide: int) -> None:
        if high < 1 or wide < 1:
            return
        if self.each is None and len(self.parts) > self.MANY:
            self.each = {(r, c) for top, below, left, right in self.parts for r in range(top, below) for c in range(left, right)}
        if self.each is not None:
            self.each.update((r, c) for r in range(row, row + high) for c in range(col, col + wide))
            self.size = len(self.each)
            return
        fresh = [(row, row + high, col, col + wide)]
        for part in self.parts:
            fresh = [x for f in fresh for x in _without(f, part)]
        self.parts += fresh
        self.size += sum((below - top) * (right - left) for top, below, left, right in fresh)


def _without(a: tuple[int, int, int, int], b: tuple[int, int, int, int]) -> list[tuple[int, int, int, int]]:
    """What b leaves of a, as rectangles (top, below, left, right) apart from each other."""
    top, below, left, right = max(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), min(a[3], b[3])
    if top >= below or left >= right:
        return [a]
    cut = [(a[0], top, a[2], a[3]), (below, a[1], a[2], a[3]), (top, below, a[2], left), (top, below, right, a[3])]
    return [x for x in cut if x[0] < x[1] and x[2] < x[3]]


def over_limit(cells: DataFrame) -> DataFrame:
    """(file, cell_seq) of the first cell that has no room: the positions taken before it, each once,
    and its own are more than the limit.

    What is taken lies between the largest cell before and the sum of all before. Where both bounds
    say the same the cell is found natively; only the files for which they differ are counted out.
    """
    order = ["cell_seq", "row", "col", "rowspan", "colspan"]
    own = F.col("rowspan").cast("double") * F.col("colspan")
    taken = F.when((F.col("rowspan") > 0) & (F.col("colspan") > 0), own).otherwise(0.0)
    kinds = [cells.schema[c].dataType.simpleString() for c in ("file", "cell_seq")]
    file = Window.partitionBy("file")
    so_far = file.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # _most: without room if no positions were shared; _n is 1 from the first such cell to the next.
    rows = cells.select("file", *order).withColumn("_most", F.sum(taken).over(so_far) - taken + own > GRID_LIMIT)
    before = file.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_least", F.coalesce(F.max(taken).over(before), F.lit(0.0)) + own > GRID_LIMIT)
    rows = rows.withColumn("_n", F.count_if("_most").over(so_far))
    rows = rows.withColumn("_apart", F.max(F.col("_most") & ~F.col("_least") & (F.col("_n") == 1)).over(file.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    held = rows.where(F.col("_apart") | (F.col("_most") & (F.col("_n") == 1))).select("file", *order, "_apart")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, claimed = None, None
        for b in batches:
            full = []
            for i, (file, _, row, col, high, wide, apart) in enumerate(zip(*(c.to_pylist() for c in b.columns), strict=True)):
                if not apart:
                    full.append(i)
                    continue
                if at is None or file != at[0]:
                    at, claimed = (file,), Claimed()
                if claimed is None or high is None or wide is None:
                    continue
                if claimed.size + high * wide > GRID_LIMIT:
                    full.append(i)
                    claimed = None
                    continue
                claimed.add(row, col, high, wide)
            yield b.select([0, 1]).take(pa.array(full, pa.int64()))

    return held.mapInArrow(run, f"`file` {kinds[0]}, cell_seq {kinds[1]}")


def positions(cells: DataFrame) -> DataFrame:
    """(file, cell_seq, r, c): the positions of cells. Files over the limit are left out before
    any span is unrolled, so a hostile span makes no rows."""
    sound = cells.where(F.col("rowspan").between(1, SPAN_LIMIT) & F.col("colspan").between(1, SPAN_LIMIT))
    sound = sound.join(over_limit(cells).select("file"), "file", "left_anti")
    down = sound.withColumn("r", F.explode(F.expr("sequence(row, row + rowspan - 1)")))
    return down.select("file", "cell_seq", "r", F.explode(F.expr("sequence(col, col + colspan - 1)")).alias("c"))


def overlaps(cells: DataFrame) -> DataFrame:
    """(file, cell_seq, r, c): for each cell that claims a taken position the first such one."""
    w = Window.partitionBy("file", "r", "c").orderBy("cell_seq")
    later = positions(cells).withColumn("n", F.row_number().over(w)).where("n > 1")
    return later.groupBy("file", "cell_seq").agg(F.min(F.struct("r", "c")).alias("at")).select("file", "cell_seq", "at.r", "at.c")


def overhangs(cells: DataFrame, rows_written: DataFrame) -> DataFrame:
    """(file, r, rows): the first claimed row that the table never writes."""
    last = cells.groupBy("file").agg(F.max(F.col("row") + F.col("rowspan") - 1).alias("last"))
    at = rows_written.join(last, "file").where(F.col("last") >= F.col("rows")).select("file", "rows")
    claimed = cells.join(at, "file").where(F.col("row") + F.col("rowspan") > F.col("rows"))
    return claimed.groupBy("file", "rows").agg(F.min(F.greatest("row", "rows")).alias("r")).select("file", "r", "rows")


def holes(cells: DataFrame, rows_written: DataFrame) -> DataFrame:
    """(file, r, c): positions of the rectangle that no cell covers, but those of empty rows."""
    taken = positions(cells).join(rows_written.select("file", "rows"), "file").where("r < rows").select("file", "r", "c").distinct()
    width = taken.groupBy("file").agg((F.max("c") + 1).alias("cols"))
    sized = rows_written.join(width, "file").where(F.col("rows") * F.col("cols") <= GRID_LIMIT)
    rows = sized.select("file", "cols", "empty", F.explode(F.expr("sequence(0, rows - 1)")).alias("r")).where(~F.array_contains("empty", F.col("r")))
    return rows.select("file", "r", F.explode(F.expr("sequence(0, cols - 1)")).alias("c")).join(taken, ["file", "r", "c"], "left_anti")


def reported_holes(cells: DataFrame, rows_written: DataFrame, most: int = 5) -> DataFrame:
    return capped(holes(cells, rows_written), ["file"], ["r", "c"], most)


def empty_rows(rows_written: DataFrame) -> DataFrame:
    return rows_written.select("file", F.explode("empty").alias("r"))

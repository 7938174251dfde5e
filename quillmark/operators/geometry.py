"""Exhibit regions: unions of boxes, scaling between spaces, clamping, margins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
TRIM_PAD, TRIM_TOLERANCE = 6, 8


def sound(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return (x0 < x1) & (y0 < y1)


def unions(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, x0, y0, x1, y1): the smallest box around the sound boxes of each key."""
    own = boxes.where(sound(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]))
    return own.groupBy(*keys).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def regions(boxes: DataFrame, keys: list[str], space: tuple[str, str], picture: tuple[str, str]) -> DataFrame:
    """Unions in pixels: scaled from the space's size to the picture's, rounded outwards, clamped.
    Regions that are empty after that go."""
    sw, sh, pw, ph = (F.first(c).alias(c) for c in (*space, *picture))
    u = unions(boxes, keys).join(boxes.groupBy(*keys).agg(sw, sh, pw, ph), keys).where((F.col(space[0]) > 0) & (F.col(space[1]) > 0))
    fx, fy = F.col(picture[0]) / F.col(space[0]), F.col(picture[1]) / F.col(space[1])
    down = lambda c, f: F.greatest(F.floor(F.col(c) * f), F.lit(0))
    up = lambda c, f, most: F.least(F.ceil(F.col(c) * f), F.col(most))
    out = u.select(*keys, down("x0", fx).alias("x0"), down("y0", fy).alias("y0"), up("x1", fx, picture[0]).alias("x1"), up("y1", fy, picture[1]).alias("y1"))
    return out.where(sound(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]))


def contained(outer: DataFrame, inner: DataFrame, key: str) -> DataFrame:
    """Pairs (key, outer_id, inner_id, relation): inside, disjoint or crossing. Equal keys meet."""
    o = outer.select(key, F.col("id").alias("outer_id"), *[F.col(c).alias(f"o{c}") for c in ("x0", "y0", "x1", "y1")])
    i = inner.select(key, F.col("id").alias("inner_id"), *[F.col(c).alias(f"i{c}") for c in ("x0", "y0", "x1", "y1")])
    inside = "ix0 >= ox0 and iy0 >= oy0 and ix1 <= ox1 and iy1 <= oy1"
    apart = "ix1 <= ox0 or ix0 >= ox1 or iy1 <= oy0 or iy0 >= oy1"
    return o.join(i, key).select(key, "outer_id", "inner_id", F.expr(f"case when {inside} then 'inside' when {apart} then 'disjoint' else 'crossing' end").alias("relation"))


def trimmed(pixels: np.ndarray, pad: int = TRIM_PAD, tolerance: int = TRIM_TOLERANCE) -> tuple[int, int, int, int] | None:
    """(x0, y0, x1, y1) of the content of an image (rows, columns, channels) inside a uniform margin.

    Where the corners differ there is no margin and the whole image comes back; a uniform
    image has no content and gives None.
    """
    p = pixels.astype(np.int16)
    high, wide = p.shape[:2]
    corners = p[[0, 0, -1, -1], [0, -1, 0, -1]]
    if (np.abs(corners - corners[0]) > tolerance).any():
        return 0, 0, wide, high
    ink = (np.abs(p - corners[0]) > tolerance).any(axis=2)
    ys, xs = np.flatnonzero(ink.any(axis=1)), np.flatnonzero(ink.any(axis=0))
    if not len(ys):
        return None
    return max(0, int(xs[0]) - pad), max(0, int(ys[0]) - pad), min(wide, int(xs[-1]) + 1 + pad), min(high, int(ys[-1]) + 1 + pad)


def trimmed_boxes(images: DataFrame, key: str) -> DataFrame:
    """(key, x0, y0, x1, y1) of images (key, width, height, pixels): one byte a pixel or several, row
    by row. Nulls where there is no content, or no picture of that size."""
    kind = images.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for wide, high, raw in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                whole = raw is not None and wide and high and len(raw) and len(raw) % (wide * high) == 0
                box = trimmed(np.frombuffer(raw, dtype=np.uint8).reshape(high, wide, -1)) if whole else None
                found.append(box or (None,) * 4)
            cols = [pa.array([f[i] for f in found], pa.int32()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], [key, "x0", "y0", "x1", "y1"])

    return images.select(key, "width", "height", "pixels").mapInArrow(run, f"`{key}` {kind}, x0 int, y0 int, x1 int, y1 int")

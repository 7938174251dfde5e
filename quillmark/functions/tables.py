"""Table functions for SQL: documents that only a parser can take apart, as rows.

register(spark) makes them known by their names; each takes one text and keeps no state, so a
lateral join runs them where the rows are. Null texts have no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf


@udtf(returnType="seq int, position string, name string")
class StrictJson:
    """strict_json(raw): the repeated keys of a JSON text, breadth first, and a fault as `! rule`."""

    def eval(self, raw: str) -> Iterator[tuple]:
        from quillmark.functions.strict_json import parsed, repeated_keys

        if raw is None:
            return
        value, fault = parsed(raw)
        found = [("!", fault)] if fault else repeated_keys(value)
        for i, (position, name) in enumerate(found):
            yield i, position, name


@udtf(returnType="seq int, kind string, name string, parent string, cells int")
class HtmlEvents:
    """html_events(html): the tokens of table markup, with what is open around each."""

    def eval(self, html: str) -> Iterator[tuple]:
        from quillmark.operators.markup import nested, tokens

        if html is None:
            return
        found, _ = tokens(html)
        for i, (t, f) in enumerate(zip(found, nested(found)[0], strict=True)):
            yield i, t.kind, t.name, f.parent, f.cells


@udtf(returnType="seq int, row int, col int, rowspan int, colspan int, tag string")
class GridCells:
    """grid_cells(html): the cells of table markup and their places."""

    def eval(self, html: str) -> Iterator[tuple]:
        from quillmark.operators.markup import placed_cells

        if html is None:
            return
        for i, cell in enumerate(placed_cells(html)):
            yield i, *cell


@udtf(returnType="seq int, line string, error string")
class JatsLines:
    """jats_lines(xml): the markdown lines of an article, or one row with the error."""

    def eval(self, xml: str) -> Iterator[tuple]:
        import xml.etree.ElementTree as ET

        from quillmark.operators.jats import article_lines

        if xml is None:
            return
        try:
            lines = article_lines(xml)
        except (ET.ParseError, ValueError, LookupError) as e:
            yield 0, None, str(e)
            return
        for i, line in enumerate(lines):
            yield i, line, None


FUNCTIONS = {"strict_json": StrictJson, "html_events": HtmlEvents, "grid_cells": GridCells, "jats_lines": JatsLines}


def register(spark: SparkSession) -> None:
    for name, function in FUNCTIONS.items():
        spark.udtf.register(name, function)

"""Acceptance rules of converted documents, as queries over skeletons and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def coverage_gaps(units: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """(key, start, previous_end) of units that begin neither where the one before ended nor right after."""
    w = Window.partitionBy(key).orderBy("start", "end")
    out = units.select(key, F.col(start).alias("start"), F.col(end).alias("end")).withColumn("previous_end", F.lag("end").over(w))
    return out.where("previous_end is not null and start <> previous_end and start <> previous_end + 1").select(key, "start", "previous_end")


def uncovered_pages(units: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """(key, page) of pages 1 to n that no unit spans."""
    spanned = units.select(key, F.explode(F.sequence("page_start", "page_end")).alias("page")).distinct()
    every = docs.select(key, F.explode(F.expr("sequence(1, pages)")).alias("page"))
    return every.join(spanned, [key, "page"], "left_anti")


def not_in_text(parts: DataFrame, texts: DataFrame, key: str, part: str) -> DataFrame:
    """Parts that the document's text does not hold."""
    return parts.join(texts.select(key, "text"), key).where(~F.contains("text", part)).drop("text")


def in_text(parts: DataFrame, texts: DataFrame, key: str, part: str) -> DataFrame:
    """Parts (furniture, table content) that the text holds though it must not."""
    return parts.join(texts.select(key, "text"), key).where(F.contains("text", part)).drop("text")


def suspect_characters(texts: DataFrame, key: str) -> DataFrame:
    """(key, soft_hyphens, zero_width, broken_words): broken words are only flagged."""
    n = lambda p: F.size(F.regexp_extract_all("text", F.lit(p), F.lit(0)))
    return texts.select(key, n("\u00ad").alias("soft_hyphens"), n("\u200b").alias("zero_width"), n(r"\p{L}-\n\p{Ll}").alias("broken_words"))


def reference_counts(texts: DataFrame, key: str) -> DataFrame:
    """(key, references): lines that begin a list entry."""
    rows = texts.select(key, F.explode(F.split("text", "\n")).alias("line"))
    return rows.groupBy(key).agg(F.count_if(F.col("line").startswith("- ")).alias("references"))


def sweep_findings(rows: DataFrame, key: str) -> DataFrame:
    """(key, kind, page, finding) of report lines `[kind] page NN: text`."""
    line = r"^\[(omission|invention|distortion|source)\] page (\d+): (.*)\z"
    part = lambda i: F.regexp_extract("line", line, i)
    return rows.where(F.col("line").rlike(line)).select(key, part(1).alias("kind"), part(2).cast("int").alias("page"), part(3).alias("finding"))


def unequal_flags(exhibits: DataFrame, key: str) -> DataFrame:
    """Exhibits whose notes are there without a footnote, or the reverse."""
    return exhibits.where(F.col("footnote") != F.col("notes").isNotNull()).select(key, "label")

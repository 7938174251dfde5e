"""Documents and reports that a run hands on: blocks as JSON and text, answers, findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions import columns as C


def _ordered(order: Column, value: Column, by: str) -> Column:
    """The values of a group in an order, joined."""
    each = F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v"))))
    return F.array_join(F.transform(each, lambda x: x["v"]), by)


def blocks_text(blocks: DataFrame) -> DataFrame:
    """(doc_id, text) of blocks (doc_id, page, index, text): each page's marker and its blocks, a blank line between."""
    page = blocks.groupBy("doc_id", "page").agg(_ordered(F.col("index"), F.col("text"), "\n\n").alias("own"))
    marked = F.concat(F.format_string(C.PAGE_MARKER, "page"), F.lit("\n\n"), "own")
    return page.groupBy("doc_id").agg(_ordered(F.col("page"), marked, "\n\n").alias("text"))


def blocks_json(blocks: DataFrame) -> DataFrame:
    """(doc_id, json) of blocks (doc_id, page, index, text, emphasis): absent emphasis is left out."""
    own = F.array_sort(F.collect_list(F.struct("page", "index", "text", "emphasis")))
    by = blocks.groupBy("doc_id").agg(F.count_distinct("page").alias("page_count"), own.alias("blocks"))
    return by.select("doc_id", F.to_json(F.struct("page_count", "blocks")).alias("json"))


def local_answer(blocks: DataFrame) -> DataFrame:
    """(doc_id, pages): what an OCR service would answer, built of the text layer."""
    page = blocks.groupBy("doc_id", "page").agg(_ordered(F.col("index"), F.col("text"), "\n\n").alias("markdown"))
    each = F.array_sort(F.collect_list(F.struct((F.col("page") - 1).alias("index"), "markdown")))
    return page.groupBy("doc_id").agg(each.alias("pages"))


def reference_report(found: DataFrame) -> DataFrame:
    """(doc_id, report) of found (doc_id, pos, doi, status, record, entry): a line a DOI, then the count."""
    said = F.when(F.col("status") == "resolved", F.concat(F.lit("registrar: "), F.coalesce("record", F.lit("")))).otherwise(F.col("status"))
    line = F.format_string("- %s\n  text: %s\n  %s", F.col("doi"), F.coalesce("entry", F.lit("")), said)
    n = lambda s: F.count_if(F.col("status") == s)
    count = F.format_string("%d resolved, %d unresolved, %d unanswered", n("resolved"), n("unresolved"), n("unanswered"))
    return found.groupBy("doc_id").agg(F.concat(_ordered(F.col("pos"), line, "\n"), F.lit("\n"), count).alias("report"))


def stage_report(actions: DataFrame) -> DataFrame:
    """(line): id, path and action, tab-separated."""
    return actions.select(F.concat_ws("\t", "id", "path", "action").alias("line"))

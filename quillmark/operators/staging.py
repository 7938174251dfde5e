"""Staging, OCR answers, supplement declarations and run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
USD_PER_1000_PAGES = 1.0
IMAGE_FIELDS = ("id", "top_left_x", "top_left_y", "bottom_right_x", "bottom_right_y")


def actions(incoming: DataFrame, staged: DataFrame, keys: list[str]) -> DataFrame:
    """incoming (keys, content hash `digest`) against staged: new, already or conflict."""
    there = staged.select(*keys, F.col("digest").alias("_there"))
    action = F.when(F.col("_there").isNull(), "staged").when(F.col("_there") == F.col("digest"), "already").otherwise("conflict")
    return incoming.join(there, keys, "left").withColumn("action", action).drop("_there")


def digest(content: Column) -> Column:
    return F.sha2(content, 256)


def page_coverage(pages: DataFrame, key: str, index: str) -> DataFrame:
    """(key, pages, complete): whether the indexes are exactly 0 to n-1, each once."""
    seen = F.array_sort(F.collect_list(F.col(index).cast("long")))
    out = pages.groupBy(key).agg(seen.alias("_seen"))
    return out.select(key, F.size("_seen").cast("long").alias("pages"), (F.col("_seen") == F.sequence(F.lit(0).cast("long"), F.size("_seen").cast("long") - 1)).alias("complete"))


def costs(pages: DataFrame, key: str) -> DataFrame:
    """(key, pages, usd) of pages processed."""
    out = pages.groupBy(key).agg(F.count(F.lit(1)).alias("pages"))
    return out.withColumn("usd", F.round(F.col("pages") / 1000.0 * USD_PER_1000_PAGES, 6))


def image_boxes(images: Column) -> Column:
    """The fields of image boxes that are kept."""
    return F.transform(images, lambda i: F.struct(*[i[f].alias(f) for f in IMAGE_FIELDS]))


def assembled(declarations: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, supplements_json): a paper's supplements in order of their names, with its id.
    Papers without a declaration have no row."""
    each = F.array_sort(F.collect_list(F.struct("name", "title", "exhibits")))
    by = declarations.groupBy("doc_id").agg(each.alias("supplements"))
    return ids.select("doc_id", "id").join(by, "doc_id").select("doc_id", F.to_json(F.struct("id", "supplements")).alias("supplements_json"))


def exit_code(status: Column) -> Column:
    """Of a run: 1 if anything failed, else 3 if anything stayed ambiguous, else 0."""
    return F.when(F.bool_or(status == "failed"), 1).when(F.bool_or(status == "ambiguous"), 3).otherwise(0)


def lookups(dois: DataFrame, ids: DataFrame, articles: DataFrame) -> DataFrame:
    """DOI to PMCID to article: (doi, pmcid, status) with no_id, no_article, no_body or found.
    Each miss is a definitive no and not a failure."""
    chain = dois.join(ids.select("doi", "pmcid"), "doi", "left").join(articles.select("pmcid", "has_body"), "pmcid", "left")
    status = F.when(F.col("pmcid").isNull(), "no_id").when(F.col("has_body").isNull(), "no_article").when(~F.col("has_body"), "no_body").otherwise("found")
    return chain.select("doi", "pmcid", status.alias("status"))

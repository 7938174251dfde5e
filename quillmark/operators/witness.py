"""Text witnesses: page slices, emphasis runs, references and what a registrar says of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.functions import columns as C


def lines(texts: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, pos, line) of texts (key, text)."""
    return texts.select(key, F.posexplode(F.split("text", "\n")).alias("pos", "line"))


def paged(rows: DataFrame, key: str = "doc_id", marker: str = r"^<!-- page (\d+) -->\z") -> DataFrame:
    """Lines (key, pos, line) with the number of the page whose marker came last; markers go."""
    number = F.when(F.col("line").rlike(marker), F.regexp_extract("line", marker, 1).cast("int"))
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("_m", number).withColumn("page", F.last("_m", True).over(w)).where("_m is null").drop("_m")


def emphasis_runs(spans: DataFrame, line: list[str], order: str, style: Column, text: str = "text") -> DataFrame:
    """(line..., style, first, text): adjacent spans of one style in a line, as one run.

    Plain spans break a run; blank runs go. A gap-and-island number takes the place of a fold.
    """
    w = Window.partitionBy(*line).orderBy(order)
    s = spans.withColumn("_s", style)
    changed = F.when(F.col("_s").eqNullSafe(F.lag("_s").over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    s = s.withColumn("_c", changed).withColumn("_run", F.sum("_c").over(w)).where("_s is not null")
    own = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce(F.col(text), F.lit("")).alias("t"))))
    runs = s.groupBy(*line, "_run", F.col("_s").alias("style")).agg(F.min(order).alias("first"), F.array_join(F.transform(own, lambda x: x["t"]), "").alias("text"))
    return runs.where(~C.is_blank(F.col("text"))).drop("_run")


def with_emphasis(blocks: DataFrame, styled: DataFrame) -> DataFrame:
    """Text blocks (doc_id, page, index, image) paired by place with styled blocks (doc_id, page,
    place, emphasis), whose places count blocks that are not images."""
    w = Window.partitionBy("doc_id", "page").orderBy("index")
    kept = blocks.where("not image").withColumn("place", F.row_number().over(w) - 1)
    return kept.join(styled, ["doc_id", "page", "place"], "left").drop("place")


def normalised_box(box: Column, digits: int = 2) -> Column:
    """A box with its corners in order, rounded."""
    lo = lambda i: F.least(box[i], box[i + 2])
    hi = lambda i: F.greatest(box[i], box[i + 2])
    return F.array(*[F.round(x, digits) for x in (lo(0), lo(1), hi(0), hi(1))])


def reference_dois(texts: DataFrame) -> DataFrame:
    """(doc_id, pos, doi) of the DOIs in the references sections of texts, repeats included."""
    section = texts.select("doc_id", C.references_section(F.col("text")).alias("section")).where("section is not null")
    return section.select("doc_id", F.posexplode(C.dois(F.col("section"))).alias("pos", "doi"))


def distinct_dois(found: DataFrame) -> DataFrame:
    """The first of each DOI of a document, whatever its case."""
    w = Window.partitionBy("doc_id", F.lower("doi")).orderBy("pos")
    return found.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def entries(texts: DataFrame, found: DataFrame) -> DataFrame:
    """found with the first line of the references section that holds the DOI."""
    section = texts.select("doc_id", C.references_section(F.col("text")).alias("text")).where("text is not null")
    rows = lines(section).withColumnRenamed("pos", "line_no")
    met = found.join(rows, "doc_id").where(F.contains("line", "doi"))
    return met.groupBy("doc_id", "pos", "doi").agg(F.min_by(C.strip(F.col("line")), "line_no").alias("entry"))


def with_status(found: DataFrame, answers: DataFrame) -> DataFrame:
    """found (doi) with status resolved, unresolved or unanswered from answers (doi, status)."""
    said = answers.select("doi", F.col("status").alias("_status"))
    status = F.when(F.col("_status").between(200, 299), "resolved").when(F.col("_status").isin(404, 410), "unresolved").otherwise("unanswered")
    return found.join(said, "doi", "left").withColumn("status", status).drop("_status")


def status_report(found: DataFrame) -> DataFrame:
    """(doc_id, resolved, unresolved, unanswered, exit_code): unanswered ones fail a run."""
    each = [F.count_if(F.col("status") == s).alias(s) for s in ("resolved", "unresolved", "unanswered")]
    return found.groupBy("doc_id").agg(*each).withColumn("exit_code", (F.col("unanswered") > 0).cast("int"))


def on_every_page(blocks: DataFrame, keys: list[str], page: str, text: str) -> DataFrame:
    """Furniture: (keys, text) that all pages of a key show, where it has more than one."""
    pages = blocks.groupBy(*keys).agg(F.count_distinct(page).alias("pages"))
    shown = blocks.groupBy(*keys, text).agg(F.count_distinct(page).alias("shown"))
    return shown.join(pages, keys).where("shown = pages and pages > 1").select(*keys, text, "pages")


def block_counts(docs: DataFrame, blocks: DataFrame) -> DataFrame:
    """(doc_id, blocks, likely_scanned): a document without a text block was likely scanned."""
    n = blocks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("blocks"))
    out = docs.select("doc_id").join(n, "doc_id", "left").withColumn("blocks", F.coalesce("blocks", F.lit(0)))
    return out.withColumn("likely_scanned", F.col("blocks") == 0)

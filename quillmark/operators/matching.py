"""Matching documents to a registry: scores, margins, and ids that two documents claim."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.functions import columns as C
from quillmark.operators.index import Index

# Fixed values.
DOI_WEIGHT, TITLE_WEIGHT, AUTHOR_WEIGHT, YEAR_WEIGHT = 100.0, 50.0, 10.0, 5.0
TITLE_CONFIDENT, MARGIN_CONFIDENT = 0.7, 15.0
WEIGHTS = (DOI_WEIGHT, TITLE_WEIGHT, AUTHOR_WEIGHT, YEAR_WEIGHT)
REGISTRANT = r"(10\.\d{4,9}/)"
#: Keys of a registry that every task can hold.
INDEXED = 2_000_000


def matchable(registry: DataFrame) -> DataFrame:
    """Records that say anything a page could confirm."""
    return registry.where(~C.is_blank(F.concat_ws("", "title", "doi", "authors", "year")))


def identity_text(pages: DataFrame, first: int = 3) -> DataFrame:
    """(doc_id, text) of the first pages of pages (doc_id, page, text), lower-cased."""
    ordered = F.array_sort(F.collect_list(F.struct("page", "text")))
    text = F.array_join(F.transform(ordered, lambda x: F.coalesce(x["text"], F.lit(""))), "\n")
    return pages.where(F.col("page") <= first).groupBy("doc_id").agg(F.lower(text).alias("text"))


def _registry_keys() -> Column:
    """Structs (key, kind, n): what a text may share with a record. Kinds: t title word, a surname without a
    hyphen, h part of the n-th hyphenated surname, y year. A DOI is looked up as a whole."""
    part = lambda key, kind, n=F.lit(0): F.struct(key.alias("key"), F.lit(kind).alias("kind"), n.cast("int").alias("n"))
    plain, joined = F.filter("names", lambda x: ~F.contains(x, F.lit("-"))), F.filter("names", lambda x: F.contains(x, F.lit("-")))
    parts = F.flatten(F.transform(joined, lambda x, i: F.transform(F.array_distinct(F.filter(F.split(x, "-"), lambda w: w != "")), lambda w: part(w, "h", i))))
    none = F.array().cast("array<struct<key:string,kind:string,n:int>>")
    year = F.when(F.col("year").rlike(r"^\d{4}\z"), F.array(part(F.concat(F.lit("y:"), "year"), "y"))).otherwise(none)
    return F.concat(F.transform("tw", lambda w: part(w, "t")), F.transform(plain, lambda w: part(w, "a")), parts, year)


def _records(registry: DataFrame) -> DataFrame:
    """(id, ord, tw, names, doi, year) of the records to be matched."""
    return matchable(registry).select(
        "id",
        "ord",
        C.content_words(F.col("title")).alias("tw"),
        C.surnames(F.col("authors")).alias("names"),
        C.normalised_doi(F.col("doi")).alias("doi"),
        C.strip(F.coalesce(F.col("year").cast("string"), F.lit(""))).alias("year"),
    )


def _own_keys(text: Column) -> Column:
    return F.concat(C.content_words(text), F.transform(C.years(text), lambda x: F.concat(F.lit("y:"), x)))


def _registered(text: Column, longest: int) -> Column:
    """What follows each registrant in a text, from it on, as far as a DOI and its end may reach."""
    begun = F.regexp_extract_all(C.without_spaces(text), F.lit(rf"(?s)(?=(10\.\d{{4,9}}/.{{0,{longest + 2}}}))"), F.lit(1))
    return F.when(F.contains(text, F.lit("10")), begun)


def candidates(docs: DataFrame, registry: DataFrame) -> DataFrame:
    """(doc_id, id, ord, doi_hit, title_overlap, score) of every pair that shares anything.

    docs (doc_id, text), registry (id, ord, title, doi, authors, year). A record is a candidate
    where it shares a title word, part of a surname, the year or the whole DOI with the text: one
    equality join of a text's keys with the registry's, whose hits are added up where they arise,
    and one of what follows its registrants, cut to the lengths that DOIs have.
    """
    text = docs.select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    reg = _records(registry)
    keys = reg.select("id", F.explode(_registry_keys()).alias("k")).select("id", "k.*")
    flat = C.without_spaces(F.col("text"))
    met = text.select("doc_id", F.explode(_own_keys(F.col("text"))).alias("key")).join(keys, "key")
    # A surname counts once, however many of its parts are there: a bit each.
    masks = -(-(keys.where("kind = 'h'").agg(F.max("n")).first()[0] or 0) // 62) + 1
    kind = lambda k: F.col("kind") == k
    bits = [F.bit_or(F.when(kind("h") & (F.floor(F.col("n") / 62) == i), F.expr("shiftleft(1L, n % 62)")).otherwise(F.lit(0).cast("long"))).alias(f"b{i}") for i in range(masks)]
    pairs = met.groupBy("doc_id", "id").agg(F.count(F.when(kind("t"), 1)).alias("t"), F.count(F.when(kind("a"), 1)).alias("a"), F.bool_or(kind("y")).alias("y"), *bits)
    pairs = pairs.withColumn("a", F.col("a") + sum(F.bit_count(f"b{i}") for i in range(masks))).drop(*[f"b{i}" for i in range(masks)])

    owned = reg.where(F.col("doi").rlike("^" + REGISTRANT)).select("id", "doi", F.regexp_extract("doi", REGISTRANT, 1).alias("r"))
    odd = reg.where((F.col("doi") != "") & ~F.col("doi").rlike("^" + REGISTRANT)).select("id", "doi")
    longest = owned.agg(F.max(F.length("doi"))).first()[0] or 0
    begun = text.select("doc_id", F.explode(_registered(F.col("text"), longest)).alias("s")).withColumn("r", F.regexp_extract("s", REGISTRANT, 1))
    cut = begun.join(owned.select("r", F.length("doi").alias("n")).distinct(), "r").where(F.length("s") >= F.col("n"))
    cut = cut.select("doc_id", F.expr("substring(s, 1, n)").alias("doi"), F.expr("substring(s, n + 1, 2)").alias("rest")).where(C.doi_ends(F.col("rest"))).select("doc_id", "doi").distinct()
    printed = cut.join(owned.select("id", "doi"), "doi").select("doc_id", "id")
    other = text.select("doc_id", flat.alias("flat")).join(odd, F.contains("flat", "doi")).where(C.doi_printed(F.col("doi"), F.col("flat"))).select("doc_id", "id")
    hits = (printed.unionByName(other) if not odd.isEmpty() else printed).distinct().withColumn("d", F.lit(True))

    pairs = pairs.join(hits, ["doc_id", "id"], "full") if not reg.where("doi <> ''").isEmpty() else pairs.withColumn("d", F.lit(False))
    sized = reg.select("id", "ord", F.size("tw").alias("nt"), F.size("names").alias("na"))
    share = lambda n, of: F.when(F.col(of) > 0, F.coalesce(F.col(n), F.lit(0)) / F.col(of)).otherwise(0.0)
    hit = F.coalesce("d", F.lit(False))
    year = F.coalesce("y", F.lit(False))
    score = DOI_WEIGHT * hit.cast("int") + TITLE_WEIGHT * share("t", "nt") + AUTHOR_WEIGHT * share("a", "na") + YEAR_WEIGHT * year.cast("int")
    return pairs.join(sized, "id").select("doc_id", "id", "ord", hit.alias("doi_hit"), share("t", "nt").alias("title_overlap"), score.alias("score"))


def ranked(docs: DataFrame, registry: DataFrame, n: int) -> DataFrame:
    """The n best candidates by rank, best first, ties in registry order. A document without a
    candidate gets the first record with score 0, and runner_up is 0.0 where there is no other.

    A registry that fits into every task is an index there and makes no pairs. Pairs are joined for
    larger ones, for DOIs that have no registrant, and where an id has several texts.
    """
    reg = _records(registry)
    odd = (F.col("doi") != "") & ~F.col("doi").rlike("^" + REGISTRANT)
    told = reg.agg(F.sum(F.size(_registry_keys())).alias("keys"), F.bool_or(odd).alias("odd"), F.max(F.length("doi")).alias("longest")).first()
    twice = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null")
    if told.odd or (told.keys or 0) > INDEXED or not twice.isEmpty():
        return _joined(docs, registry).where(F.col("place") <= n)
    rows = reg.orderBy("ord", "id").select("id", "ord", F.size("tw").alias("nt"), F.size("names").alias("na"), "doi", _registry_keys().alias("keys"))
    index = docs.sparkSession.sparkContext.broadcast(Index(rows.toArrow(), WEIGHTS))
    kinds = [docs.schema["doc_id"].dataType.simpleString(), *(registry.schema[c].dataType.simpleString() for c in ("id", "ord"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield index.value.ranked(b, n)

    text = F.lower(F.coalesce("text", F.lit("")))
    begun = _registered(text, told.longest) if told.longest else F.lit(None).cast("array<string>")
    # Files of short texts are few tasks, so texts are dealt once; nothing is sorted or aggregated.
    texts = docs.select("doc_id", "text").repartition("doc_id").select("doc_id", _own_keys(text).alias("own"), begun.alias("dois"))
    return texts.mapInArrow(run, f"doc_id {kinds[0]}, id {kinds[1]}, ord {kinds[2]}, doi_hit boolean, title_overlap double, score double, place long, runner_up double")


def _joined(docs: DataFrame, registry: DataFrame) -> DataFrame:
    """All candidates by rank, as in ranked, from their pairs."""
    first = matchable(registry).select("id", "ord").orderBy("ord").limit(1)
    found = candidates(docs, registry)
    none = docs.select("doc_id").join(found.select("doc_id").distinct(), "doc_id", "left_anti").crossJoin(first)
    none = none.select("doc_id", "id", "ord", F.lit(False).alias("doi_hit"), F.lit(0.0).alias("title_overlap"), F.lit(0.0).alias("score"))
    w = Window.partitionBy("doc_id").orderBy(F.desc("score"), "ord")
    return found.unionByName(none).withColumn("place", F.row_number().over(w).cast("long")).withColumn("runner_up", F.lead("score", 1, 0.0).over(w))


def matched(docs: DataFrame, registry: DataFrame) -> DataFrame:
    """(doc_id, best_id, score, margin, confident, contested): one row a document."""
    best = ranked(docs, registry, 1).withColumn("margin", F.col("score") - F.col("runner_up"))
    sure = (F.col("margin") > 0) & (F.col("doi_hit") | ((F.col("title_overlap") >= TITLE_CONFIDENT) & (F.col("margin") >= MARGIN_CONFIDENT)))
    best = best.withColumn("confident", sure)
    claims = best.where("confident").groupBy("id").agg(F.count(F.lit(1)).alias("claims"))
    contested = F.col("confident") & (F.coalesce("claims", F.lit(0)) > 1)
    return best.join(claims, "id", "left").select("doc_id", F.col("id").alias("best_id"), "score", "margin", "confident", contested.alias("contested"))


def top(docs: DataFrame, registry: DataFrame, n: int = 3) -> DataFrame:
    """The best match and the runners-up that have a score."""
    return ranked(docs, registry, n).select("doc_id", "place", "id", "score")

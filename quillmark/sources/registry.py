"""Registries and maps of ids, as they are exported: JSON in one of a few shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions import columns as C

FIELDS = ("title", "doi", "authors", "year")


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """(raw) of the files of a path, a row a file."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "raw")


def records(raw: DataFrame, records_key: str | None = None) -> DataFrame:
    """(id, ord, title, doi, authors, year, rule) of JSON texts (raw).

    An object is keyed by id; the entries of a list carry an `id`. With records_key the
    records are the value of that key. rule is why a record is skipped: no_id, not_object or
    nothing_to_match, else null.
    """
    whole = F.expr("try_parse_json(raw)")
    inner = whole if records_key is None else F.try_variant_get(whole, f"$.{records_key}", "variant")
    each = raw.select(inner.alias("v")).where("v is not null")
    each = each.lateralJoin(each.sparkSession.tvf.variant_explode(F.col("v").outer())).select("pos", "key", "value")
    field = lambda name: F.try_variant_get("value", f"$.{name}", "string")
    out = each.select(F.coalesce("key", C.strip(field("id"))).alias("id"), F.col("pos").alias("ord"), *[field(f).alias(f) for f in FIELDS], F.schema_of_variant("value").startswith("OBJECT").alias("_object"))
    blank = C.is_blank(F.concat_ws("", *FIELDS))
    rule = F.when(~F.coalesce("_object", F.lit(False)), "not_object").when(C.is_blank(F.col("id")), "no_id").when(blank, "nothing_to_match")
    return out.withColumn("rule", rule).drop("_object")


def registry(raw: DataFrame, records_key: str | None = None) -> DataFrame:
    """The usable records, as operators.matching takes them."""
    return records(raw, records_key).where("rule is null").drop("rule")


def skipped(found: DataFrame) -> DataFrame:
    """(rule, records) of the records that are not used."""
    return found.where("rule is not null").groupBy("rule").agg(F.count(F.lit(1)).alias("records"))


def id_map(raw: DataFrame) -> DataFrame:
    """(id, path) of a JSON object of paths; entries that are not strings have a null path."""
    parsed = raw.select(F.expr("try_parse_json(raw)").alias("v")).where("v is not null")
    each = parsed.lateralJoin(parsed.sparkSession.tvf.variant_explode(F.col("v").outer()))
    text = F.when(F.schema_of_variant("value") == "STRING", F.try_variant_get("value", "$", "string"))
    return each.select(F.col("key").alias("id"), text.alias("path"))

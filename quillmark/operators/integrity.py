"""Referential integrity and uniqueness of declarations and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def missing(declared: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Declared, but not there."""
    return declared.select(*keys).distinct().join(present.select(*keys), keys, "left_anti")


def undeclared(declared: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """There, but not declared."""
    return missing(present, declared, keys)


def bound(sides: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Keys that not all sides have, with a flag for each side."""
    tagged = None
    for name, df in sides.items():
        part = df.select(*keys).withColumn("side", F.lit(name))
        tagged = part if tagged is None else tagged.unionByName(part)
    flags = [F.bool_or(F.col("side") == name).alias(f"in_{name}") for name in sides]
    return tagged.groupBy(*keys).agg(*flags).where(~F.expr(" and ".join(f"in_{n}" for n in sides)))


def later_declarations(rows: DataFrame, keys: list[str], order: list[str | Column], declarer: str) -> DataFrame:
    """Rows whose key an earlier row declares, with that row's declarer."""
    w = Window.partitionBy(*keys).orderBy(*order)
    first = F.first(declarer).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("first_declarer", first).withColumn("_n", F.row_number().over(w)).where("_n > 1").drop("_n")


def unequal(left: DataFrame, right: DataFrame, key: str, column: str) -> DataFrame:
    """(key, left_value, right_value) where both sides state a value and they differ."""
    a = left.select(key, F.col(column).alias("left_value"))
    b = right.select(key, F.col(column).alias("right_value"))
    return a.join(b, key).where("left_value <> right_value")


def capped(rows: DataFrame, keys: list[str], order: list[str], most: int = 5) -> DataFrame:
    """The first rows of each key and, where there are more, one row that counts them.

    Adds place (1 to most, null for the count) and further (the count, else null).
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    placed = rows.withColumn("place", F.row_number().over(w).cast("long"))
    first = placed.where(F.col("place") <= most).withColumn("further", F.lit(None).cast("long"))
    rest = rows.groupBy(*keys).agg((F.count(F.lit(1)) - most).alias("further")).where("further > 0")
    return first.unionByName(rest, allowMissingColumns=True)


def miscased(entries: DataFrame, contract: list[str]) -> DataFrame:
    """Entries (bundle_id, name) that spell an entry of the layout in another case."""
    lower = F.lower("name")
    return entries.where(lower.isin(*contract) & (F.col("name") != lower)).select("bundle_id", "name", lower.alias("expected"))


def contract_fields(rows: DataFrame, key: str, raw: str, fields: dict[str, tuple[str, bool]]) -> DataFrame:
    """(key, field, rule) of JSON objects against fields {name: (VARIANT type, required)}.

    Rules: json (not an object), duplicate, unknown, missing, type. A record with a duplicate
    key is only told that, since its values can't be known.
    """
    v = rows.select(key, F.col(raw).alias("_raw"), F.json_object_keys(raw).alias("_keys"), F.expr(f"try_parse_json({raw})").alias("_v"))
    v = v.withColumn("_object", F.col("_keys").isNotNull())
    v = v.withColumn("_twice", F.col("_object") & (F.size("_keys") > F.size(F.array_distinct("_keys"))))
    out = v.where("not _object").select(key, F.lit(None).cast("string").alias("field"), F.lit("json").alias("rule"))
    again = v.where("_twice").select(key, F.explode(F.array_distinct(F.filter("_keys", lambda k: F.size(F.filter(F.col("_keys"), lambda j: j == k)) > 1))).alias("field"))
    out = out.unionByName(again.select(key, "field", F.lit("duplicate").alias("rule")))
    known = v.where("_object and not _twice")
    names = F.array(*[F.lit(n) for n in fields])
    extra = known.select(key, F.explode(F.array_except("_keys", names)).alias("field"), F.lit("unknown").alias("rule"))
    out = out.unionByName(extra)
    for name, (kind, required) in fields.items():
        has = F.array_contains("_keys", name)
        if required:
            out = out.unionByName(known.where(~has).select(key, F.lit(name).alias("field"), F.lit("missing").alias("rule")))
        own = F.schema_of_variant(F.expr(f"try_variant_get(_v, '$.{name}', 'variant')"))
        out = out.unionByName(known.where(has & ~own.eqNullSafe(F.lit(kind))).select(key, F.lit(name).alias("field"), F.lit("type").alias("rule")))
    return out

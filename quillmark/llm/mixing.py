"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected target / source size times. The expected copies are
prefix-summed along an order of the source's documents, one random offset is added, and a
document is emitted once for each integer boundary its stretch of the sum crosses. All
expectations of a source are equal, so a prefix sum is a rank times a rate, and the rank is
a bucket's offset plus a row number in the bucket: no source passes through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.llm.common import WORD, written

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: A target is at most so many times its source's size.
MAX_REPEAT = 3
#: Parts of a bucket of documents of one source and like size: a task ranks the rows of some parts.
SLICES = 1024


def word_count(text: Column) -> Column:
    """Number of words; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Never null, and orders as the sources do, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """sizes: (skey, size) rows. Returns (skey, source_size, target, rate).

    A row per source: the windows without a partition hold sources, not documents. The level
    that the uncapped sources share per weight is the largest one found along the sources in
    order of the level at which each is capped.
    """
    by = sizes.groupBy("skey").agg(F.sum("size").alias("source_size"))
    n = len(weights)
    place = (F.row_number().over(Window.orderBy("skey")) - 1) % n
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place + 1).cast("int")).cast("double")
    all_rows = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by = by.withColumn("weight", weight).withColumn("cap", F.lit(float(max_repeat)) * F.col("source_size"))
    before = Window.orderBy(F.col("cap") / F.col("weight"), "skey").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    heavy = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    by = by.withColumn("level", left / heavy).withColumn("level", F.max("level").over(all_rows))
    target = F.least(F.col("cap"), F.col("level") * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return by.withColumn("target", target).select("skey", "source_size", "target", rate.alias("rate"))


def offset(skey: Column, seed: int) -> Column:
    """The random offset of a source, in [0, 1)."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}/"), skey).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("long") / F.lit(4294967296.0)


def with_copies(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeat: int = MAX_REPEAT,
    seed: int = 17,
    tie: Column | None = None,
    size: Column | None = None,
) -> DataFrame:
    """docs: (doc_id, text, source, ...), all columns kept. Adds size, source_size, target and copies.

    Null texts have size 0; null is a source of its own, the last one. Of rows with the same
    source, size and doc_id, `tie` orders the one before the other (default: they are alike).
    Null ids come last. size: a column that has the words of a row already counted. Empty tables
    give empty results. Columns of the input whose names begin with `_m_` are not kept.
    """
    bucket = F.expr("length(bin(_m_size)) * 8L + (shiftright(_m_size, greatest(length(bin(_m_size)) - 4, 0)) & 7L)")
    cut = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 3), 16, 10)
    rows = (
        docs.withColumn("_m_size", word_count(F.col("text")) if size is None else size)
        .withColumn("_m_skey", source_key(F.col("source")))
        .withColumn("_m_bucket", bucket)
        .withColumn("_m_slice", cut.cast("long") % SLICES)
        .withColumn("_m_tie", F.lit(0) if tie is None else tie)
    )
    keys = ["_m_skey", "_m_bucket", "_m_slice"]
    # Read twice, for the targets and for the ranks; at most a row a part.
    counts = written(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("_m_size").alias("size")), "mixing-counts")
    rates = targets(counts.select(F.col("_m_skey").alias("skey"), "size"), weights, max_repeat)
    earlier = Window.partitionBy("_m_skey").orderBy("_m_bucket", "_m_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        counts.withColumn("_m_start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .drop("n", "size")
        .join(rates.select(F.col("skey").alias("_m_skey"), F.col("source_size").alias("_m_ss"), F.col("target").alias("_m_target"), F.col("rate").alias("_m_rate")), "_m_skey")
    )
    inside = Window.partitionBy(*keys).orderBy("_m_size", F.asc_nulls_last("doc_id"), "_m_tie")
    rank = F.col("_m_start") + F.row_number().over(inside) - 1
    u = offset(F.col("_m_skey"), seed)
    up = F.floor((F.col("_m_rank") + 1).cast("double") * F.col("_m_rate") + u)
    down = F.floor(F.col("_m_rank").cast("double") * F.col("_m_rate") + u)
    drop = [c for c in docs.columns if c in ("size", "source_size", "target", "copies")]
    return (
        rows.join(starts, keys)
        .withColumn("_m_rank", rank)
        .withColumn("_m_copies", F.least(up - down, F.lit(max_repeat)).cast("long"))
        .drop(*drop)
        .select(
            *[c for c in docs.columns if c not in drop],
            F.col("_m_size").alias("size"),
            F.col("_m_ss").alias("source_size"),
            F.col("_m_target").alias("target"),
            F.col("_m_copies").alias("copies"),
        )
    )


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, words) of docs, written: texts are read once, whatever follows."""
    return written(docs.select("doc_id", "source", word_count(F.col("text")).alias("words")), "mixing-sizes")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of docs as often as it was drawn, with the columns of docs.

    Rows that share an id count one by one, ordered by hashes of their texts. Texts without words
    (null, empty) have size 0 and are drawn at their source's rate like all others. An empty table
    gives an empty result; no name of a column is reserved.
    """
    drawn = with_copies(docs.select("*", F.struct("*").alias("_row")).select("doc_id", "text", "source", "_row"), tie=F.xxhash64("text"), **options)
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return drawn.where("copies > 0").select("_row", times.alias("_copy")).select("_row.*")

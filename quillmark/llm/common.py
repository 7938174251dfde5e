"""What the operators of this subpackage share: written tables, batch sizes, salting."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the contracts: anything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts in an Arrow batch. A batch holds whole texts, so this bounds a Python worker's memory.
BATCH_ROWS = 512
BATCH_BYTES = 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir.

    Where it is unset, a local session gets a temporary folder, which goes when Python ends; a
    cluster is an error.
    """
    got = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if got:
        return got.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is unset; a cluster needs a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="quillmark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    made = f"file://{folder}"
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/quillmark/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: it cuts the lineage and outlives executors."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of whole texts stay small enough for a Python worker: so many rows or bytes,
    whichever comes first. A setting of the caller's own stays."""
    for name, value in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        if spark.conf.get(key) == _defaults.setdefault(key, _default(spark, key)):
            spark.conf.set(key, str(value))


_defaults: dict[str, str] = {}


def _default(spark: SparkSession, key: str) -> str:
    """What the setting is where nobody has set it."""
    fresh = spark.newSession()
    fresh.conf.unset(key)
    return fresh.conf.get(key)


def ascii_lower(c: Column) -> Column:
    """A-Z only, unlike lower()."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def row_key(*cols: str) -> Column:
    """Tells rows apart that share an id; equal rows have equal keys."""
    return F.xxhash64(*cols)


def salted_lookup(left: DataFrame, right: DataFrame, keys: list[str], spread: list[str], salts: int = 32) -> DataFrame:
    """left joined with right, whose keys are unique, where a key may hold any share of left.

    The rows of a key are dealt to `salts` parts by the hash of the columns `spread`, and right
    is repeated for each part, so right should hold only what left can't do without.
    """
    parts = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = left.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    return dealt.join(parts, [*keys, "_salt"], "left").drop("_salt")


def hot_keys(rows: DataFrame, keys: list[str], share: int = 1024) -> DataFrame:
    """The keys that hold more than one in `share` of the rows: fewer than `share` of them, so they may be broadcast."""
    counts = written(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "key-counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    return counts.where(F.col("_n") * share > total).select(*keys, F.lit(True).alias("_hot"))


def hot_lookup(left: DataFrame, right: DataFrame, keys: list[str], spread: list[str], salts: int = 64, hot: DataFrame | None = None) -> DataFrame:
    """left joined with right, whose keys are unique. left is a written table, or hot, the keys that
    hold a large share of it, is given.

    Keys that hold a large share of left are dealt to `salts` parts by the hash of the columns
    `spread`, and only their rows of right are repeated. Keys are not null.
    """
    hot = F.broadcast(hot_keys(left, keys) if hot is None else hot)
    salt = lambda value: F.when(F.col("_hot"), value)
    dealt = left.join(hot, keys, "left").withColumn("_salt", F.coalesce(salt(F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")), F.lit(0))).drop("_hot")
    every = F.coalesce(salt(F.sequence(F.lit(0), F.lit(salts - 1))), F.array(F.lit(0)))
    parts = right.join(hot, keys, "left").withColumn("_salt", F.explode(every)).drop("_hot")
    return dealt.join(parts, [*keys, "_salt"], "left").drop("_salt")


def hash_share(key: Column, part: int, whole: int) -> Column:
    """Holds for about `part` of `whole` rows, or a tenth more, by the hash of their keys."""
    return F.pmod(F.xxhash64(key, F.lit(3)), F.lit(1 << 30)) <= F.lit(int(min(1.0, 1.1 * part / max(1, whole)) * (1 << 30)))

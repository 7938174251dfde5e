"""The corpus pipeline: toxic documents go, one document of each near-duplicate group stays,
repeated passages go, sources are mixed to their target weights, and the mix is packed.

Each stage gets what its predecessor kept; each but the last returns the columns of documents, extra
columns included. In all stages a null text is an empty one, rows are told apart by id and text, null
ids count as larger than all others, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillmark.llm import mixing, packing, simhash, substrings, toxicity
from quillmark.llm.common import written


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for toxic go. Repeated rows go or stay together; empty texts
    score as a text of one space. Without labels of both classes the smoothed share decides for all."""
    model = toxicity.trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: that with the smallest id, of rows that share it
    one. Texts without words are one group."""
    return simhash.one_of_each(docs)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that a document with a smaller id has go. Rows that share an id keep
    what they share; documents that lose all their words go, those that have none stay."""
    return substrings.without_repeats(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are drawn to their target weights; a document may come out several times. Null is a source,
    the last one; rows that share an id are drawn one by one."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as pieces of training sequences; each row of the mix is packed, repeated ones too."""
    import public_tokenizers

    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("toxicity", clean),
    ("simhash", distinct),
    ("substrings", unrepeated),
    ("mixing", mixed),
    ("packing", packed),
]

#: SimHash and the trained classifier have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and reread as the next one's docs."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

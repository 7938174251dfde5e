"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm import ann, edits, licences, mixing, packing, simhash, substrings, toxicity, urls, warc
from quillmark.llm.common import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = warc.round_trip(spark, _table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return got.select("doc_id", simhash.hex_digits("fp0").alias("fingerprint"), "component_id")


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.trained(docs, _table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.scored(docs, model).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scanned(_table(spark, sf_dir, "documents")).drop("spans")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.packed(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op7_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edits.with_classes(written(edits.with_edits(_table(spark, sf_dir, "documents")), "edits"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = substrings.deduplicated(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("row.doc_id", F.col("words").alias("n_words"), F.col("removed").alias("n_removed"), F.col("sha").alias("kept_sha256"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = mixing.with_copies(mixing.sized(_table(spark, sf_dir, "documents")), size=F.col("words"))
    return got.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_simhash": op2_simhash,
    "op3_ann": op3_ann,
    "op4_toxicity": op4_toxicity,
    "op5_licences": op5_licences,
    "op6_packing": op6_packing,
    "op7_edits": op7_edits,
    "op8_urls": op8_urls,
    "op9_substrings": op9_substrings,
    "op10_mixing": op10_mixing,
}

ORACLE_SQL: dict[str, str] = {
    "op1_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS hex FROM p),
b AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(strpos('0123456789abcdef', substr(hex, i, 1)) - 1), 4, '0')), '') AS bits FROM h),
d AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + list_sum(list_transform(range(0, 5), lambda j: substr(bits, (5 * i + j + 1)::BIGINT, 1)::INT * [16, 8, 4, 2, 1][j + 1]))::INT, 1)), '') AS payload_digest FROM b),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to FROM f""",
    "op9_substrings": """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS first FROM w) WHERE first < doc_id),
x AS (SELECT doc_id, generate_subscripts(ws, 1) AS p, unnest(ws) AS word FROM d),
c AS (SELECT x.doc_id, p, word, max(r.i) OVER (PARTITION BY x.doc_id ORDER BY p) AS last FROM x LEFT JOIN r ON x.doc_id = r.doc_id AND x.p = r.i),
k AS (SELECT doc_id, count(*) FILTER (last >= p - 49) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (last IS NULL OR last < p - 49) AS kept FROM c GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)""",
    "op10_mixing": """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey FROM documents),
s AS (SELECT skey, sum(size)::BIGINT AS source_size FROM d GROUP BY skey),
w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + (row_number() OVER (ORDER BY skey) - 1) % 3] AS weight, 3.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0.0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0)) AS level
    FROM w WINDOW b AS (ORDER BY cap / weight, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT skey, source_size, least(cap, max(level) OVER () * weight) AS target FROM l),
o AS (SELECT *, row_number() OVER (PARTITION BY skey ORDER BY length(bin(size)) * 8 + ((size >> greatest(length(bin(size)) - 4, 0)) & 7),
    ('0x' || substr(md5(doc_id::VARCHAR), 1, 3))::INT % 1024, size, doc_id) - 1 AS place, ('0x' || substr(md5('17/' || skey), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM d),
j AS (SELECT o.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM o JOIN t USING (skey))
SELECT doc_id, size, source_size, target, (least(floor((place + 1)::DOUBLE * rate + u) - floor(place::DOUBLE * rate + u), 3) * size)::BIGINT AS taken FROM j""",
}

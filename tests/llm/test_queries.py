"""Every opN_ query on the smallest tables: its columns, its rows, its oracle where it has one."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest

from quillmark.llm import queries as Q
from tests.compare import oracle_rows, spark_rows

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op2_simhash": "doc_id fingerprint component_id",
    "op3_ann": "query_id rank vec_id score",
    "op4_toxicity": "doc_id held_out score predicted",
    "op5_licences": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op6_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op7_edits": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next class_id class_rows",
    "op8_urls": "page_id host path rule verdict score",
    "op9_substrings": "doc_id n_words n_removed kept_sha256",
    "op10_mixing": "doc_id size source_size target taken",
}

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.mark.parametrize("name", COLUMNS)
def test_query(spark, name):
    df = Q.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(COLUMNS[name].split())
    got = spark_rows(df)
    if name in Q.ORACLE_SQL:
        assert got == oracle_rows(Q.ORACLE_SQL[name], SF)
    table, key = {"op1_warc": ("pages", "page_id"), "op8_urls": ("pages", "page_id")}.get(name, ("documents", "doc_id"))
    if name not in ("op3_ann", "op6_packing"):
        ids = pq.read_table(f"{SF}/{table}.parquet", columns=[key]).column(0).to_pylist()
        assert sorted(r[got[0].index(key)] for r in got[1]) == sorted(ids)


def test_all_are_here():
    assert set(COLUMNS) == set(Q.QUERIES) and set(Q.ORACLE_SQL) <= set(Q.QUERIES)

from quillmark.sources.bundles import SCHEMA
from quillmark.streaming.intake import validate_stream

MANIFEST = '{"schema_version": 5, "id": "p", "title": "t", "exhibits": []}'


def rows(bundle, text):
    none = None
    return [(bundle, "", "", "", "dir", False, none, none, none, none), (bundle, "", "", "manifest.json", "file", False, 9, none, MANIFEST, none), (bundle, "", "", "text.md", "file", False, 9, none, text, none)]


def test_batches_are_judged_as_they_come(spark, tmp_path):
    source, seen = str(tmp_path / "in"), []
    stream = lambda: spark.readStream.schema(SCHEMA).parquet(source)
    spark.createDataFrame(rows("a", "x") + rows("b", " "), SCHEMA).coalesce(1).write.parquet(source)
    query = validate_stream(stream(), lambda v, f, n: seen.append((n, {r.bundle_id: r.valid for r in v.collect()})), str(tmp_path / "at"))
    try:
        query.processAllAvailable()
        spark.createDataFrame(rows("b", "y"), SCHEMA).coalesce(1).write.mode("append").parquet(source)
        query.processAllAvailable()
    finally:
        query.stop()
    assert seen == [(0, {"a": True, "b": False}), (1, {"b": True})]

"""Column functions against plain Python."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmark.functions import columns as C

ODD = ["", " ", "a", "fig_01", "fig_01\n", "_z9", ".hidden01", "7", "..", "-_-", "a b", "a/b", "été", " x ", " y\u0085", "\x1cz\x1f"]


def column(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.r for r in df.select("i", make(F.col("v")).alias("r")).orderBy("i").collect()]


def test_strip(spark):
    assert column(spark, ODD, C.strip) == [v.strip() for v in ODD]


def rule(v):
    if not re.match(r"^[A-Za-z0-9._-]+\Z", v):
        return "pattern"
    if not re.search("[A-Za-z0-9]", v):
        return "punctuation"
    return "dot" if v.startswith(".") else None


def test_name_rule(spark):
    assert column(spark, ODD, C.name_rule) == [rule(v) for v in ODD]
    assert column(spark, [None], C.name_rule) == ["type"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=12), min_size=20, max_size=60))
def test_strip_and_names_of_any_text(spark, values):
    values = [v for v in values if not re.search(r"[\ud800-\udfff\x00]", v)]
    assert column(spark, values, C.strip) == [v.strip() for v in values]
    assert column(spark, values, C.name_rule) == [rule(v) for v in values]


def test_dois(spark):
    raw = [" https://doi.org/10.1/AB c", "DOI: 10.2/x", "doi:10.3/Y", "http://dx.doi.org/10.4/z\n", "10.5/q", None]
    assert column(spark, raw, C.normalised_doi) == ["10.1/abc", "10.2/x", "10.3/y", "10.4/z", "10.5/q", ""]
    text = 'see 10.1234/a.b), "10.55555/c" 10.12/no 10.1234/d[x] 10.1234/e.;'
    assert column(spark, [text], C.dois) == [["10.1234/a.b", "10.55555/c", "10.1234/d", "10.1234/e"]]


@pytest.mark.parametrize(
    ("doi", "flat", "printed"),
    [("10.1/a", "x10.1/a", True), ("10.1/a", "10.1/a.pub2", False), ("10.1/a", "10.1/a.", True), ("10.1/a", "10.1/ab10.1/a;", True), ("10.1/a", "10.1/a9", False), ("", "x", False), ("10.1/a(b)*", "see10.1/a(b)*)", True), ("10.1/a", "10.1/a.é", False)],
)
def test_doi_printed(spark, doi, flat, printed):
    df = spark.createDataFrame([(doi, flat)], "d string, f string")
    assert df.select(C.doi_printed(F.col("d"), F.col("f"))).first()[0] is printed


def test_words_and_surnames(spark):
    assert sorted(column(spark, ["The Effects of Zinc-rich zinc on 12 OLD hens"], C.content_words)[0]) == ["hens", "old", "rich", "zinc"]
    got = column(spark, ["Smith, A. B.; Jones, C. and Brown-Lee D", "O'Brien AB, Li C & Ng", None], C.surnames)
    assert [sorted(g) for g in got] == [["brown-lee", "jones", "smith"], ["o'brien"], []]
    assert column(spark, ["in 20191 x2020"], C.years) == [["2019", "0191", "2020"]]


def test_references_and_records(spark):
    text = "# A\n10.1/x\n## References (all)\n- one\n# References\n- two"
    assert column(spark, [text, "no heading", "####### references"], C.references_section) == [" (all)\n- one\n# References\n- two", None, None]
    df = spark.createDataFrame([(["A", "B", "C", "D"], 2001, "T ", None, "", "1-2"), ([], None, None, None, None, None)], "a array<string>, y int, t string, c string, v string, p string")
    got = [r[0] for r in df.select(C.registrar_record(*[F.col(c) for c in "aytcvp"])).collect()]
    assert got == ["A, B, C et al. (2001). T. 1-2", "(registrar returned no fields)"]


def test_small_rules(spark):
    assert column(spark, ["", "..", "a\\b", ".x", " ok "], C.id_rule) == ["empty", "reserved", "separator", "dot", None]
    df = spark.createDataFrame([(None, None), (429, "-3"), (404, "99"), (503, "7")], "s int, a string")
    got = df.select(C.retryable(F.col("s")).alias("r"), C.retry_after(F.col("a")).alias("w")).collect()
    assert [tuple(r) for r in got] == [(True, 5.0), (True, 0.0), (False, 60.0), (True, 7.0)]
    dpi = spark.createDataFrame([("150",), ("0",), ("1201",), ("true",), ("1.5",)], "d string").select(C.dpi_rule(F.parse_json("d"))).collect()
    assert [r[0] for r in dpi] == [None, "range", "range", "type", "type"]
    assert column(spark, ["x" * 41, "x" * 40], C.shown) == ["x" * 40 + "...", "x" * 40]
    flags = spark.createDataFrame([(0,), (2,), (16,), (18,), (4,)], "f int").select(C.span_style(F.col("f"))).collect()
    assert [r[0] for r in flags] == [None, "italic", "bold", "bold-italic", None]

import json
import os

import pytest

from quillmark.functions.columns import PNG_HEAD
from quillmark.functions.strict_json import parsed, repeated_keys
from quillmark.operators import bundles as B
from quillmark.sources.bundles import BundleFiles, figure_files, supplement_dirs

MANIFEST = {"schema_version": 5, "id": "paper", "title": "T", "exhibits": [{"label": "fig_01", "caption": "c"}, {"label": "_z9", "caption": "d", "notes": "n"}]}
TABLE = "<table><tr><td>a</td></tr></table>"


def make(root, name, manifest=MANIFEST, supplements=None, drop=(), extra=None):
    at = root / name
    files = {"manifest.json": manifest if isinstance(manifest, str) else json.dumps(manifest), "text.md": "# T\r\ntext", "figures/fig_01.png": PNG_HEAD + b"x", "figures/_z9.png": PNG_HEAD, "tables/fig_01.html": TABLE}
    if supplements is not None:
        files["supplements.json"] = supplements if isinstance(supplements, str) else json.dumps(supplements)
        files |= {"supplements/s1/figures/s1_f.png": PNG_HEAD, "supplements/s1/text.md": "s"}
    for path, content in {**files, **(extra or {})}.items():
        if path in drop:
            continue
        (at / path).parent.mkdir(parents=True, exist_ok=True)
        (at / path).write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(at)


SUPP = {"id": "paper", "supplements": [{"name": "s1", "title": "S", "exhibits": [{"label": "s1_f", "caption": "c"}]}]}


@pytest.fixture(scope="module")
def found(spark, tmp_path_factory):
    r = tmp_path_factory.mktemp("bundles")
    exhibits = lambda *labels: MANIFEST | {"exhibits": [{"label": x, "caption": "c"} for x in labels]}
    paths = [
        make(r, "sound"),
        make(r, "with_supplement", supplements=SUPP),
        str(r / "absent"),
        make(r, "no_text", drop=["text.md"]),
        make(r, "blank_text", extra={"text.md": " \n "}),
        make(r, "not_utf8", extra={"text.md": b"\xff\xfe"}),
        make(r, "bom", manifest="\ufeff{}"),
        make(r, "list", manifest="[]"),
        make(r, "twice", manifest='{"schema_version": 5, "schema_version": 99, "exhibits": [{"label": "a", "label": "b"}]}'),
        make(r, "malformed_exhibits", manifest=MANIFEST | {"exhibits": [{"label": "a b", "caption": ""}]}),
        make(r, "unknown_key", manifest=MANIFEST | {"x": 1, "schema_version": 4}),
        make(r, "bool_version", manifest=MANIFEST | {"schema_version": True, "doi": 5, "summary": ""}),
        make(r, "undeclared", manifest=exhibits("fig_01", "gone")),
        make(r, "twice_label", manifest=exhibits("fig_01", "fig_01", "_z9")),
        make(r, "stray", extra={"figures/a.PNG": b"x", "figures/.DS_Store": b"x", "tables/readme.txt": b"x", "figures/sub/x.png": b"x"}),
        make(r, "gif", extra={"figures/fig_01.png": b"GIF89a", "figures/_z9.png": b""}),
        make(r, "bad_table", extra={"tables/fig_01.html": "<table><tr><td>a</td></tr><tr></tr></table>"}),
        make(r, "loose_table", extra={"tables/other.html": TABLE}),
        make(r, "case", extra={"Text.md": "x"}),
        make(r, "other_id", supplements=SUPP | {"id": "another"}),
        make(r, "no_declaration", supplements=SUPP, drop=["supplements.json"]),
        make(r, "two_supplements", supplements=SUPP | {"supplements": [*SUPP["supplements"], {"name": "s2", "title": "S", "exhibits": []}]}),
        make(r, "climbing", supplements=SUPP | {"supplements": [{"name": "..", "title": "S", "exhibits": []}]}),
        make(r, "null_supplements", supplements={"id": "paper", "supplements": None}),
        make(r, "clash", manifest=exhibits("fig_01", "_z9", "s1_f"), supplements=SUPP, extra={"figures/s1_f.png": PNG_HEAD}),
        make(r, "clash_malformed", manifest="[]", supplements=SUPP | {"supplements": [*SUPP["supplements"], {"name": "s2", "title": "S", "exhibits": [{"label": "s1_f", "caption": "c"}]}]}, extra={"supplements/s2/figures/s1_f.png": PNG_HEAD}),
        make(r, "empty_supplement_text", supplements=SUPP, extra={"supplements/s1/text.md": ""}),
        make(r, "figures_file", drop=["figures/fig_01.png", "figures/_z9.png"], extra={"figures": "x"}),
    ]
    pipe = r / "sound_pipe"
    make(r, "sound_pipe")
    os.remove(pipe / "figures/_z9.png")
    os.mkfifo(pipe / "figures/_z9.png")
    os.symlink("/nowhere/at/all", pipe / "figures/dangling.png")
    spark.dataSource.register(BundleFiles)
    files = spark.read.format("bundle_files").option("paths", "\n".join([*paths, str(pipe)])).load()
    got = {}
    for v in B.violations(files).collect():
        got.setdefault(v.bundle_id, []).append((v.phase, v.scope, v.rule, v.detail))
    return {k: sorted(v) for k, v in got.items()}, files


CASES = {
    "sound": [],
    "with_supplement": [],
    "absent": [("root", "", "missing", "")],
    "no_text": [("text", "", "missing_file", "text.md")],
    "blank_text": [("text", "", "empty", "text.md")],
    "not_utf8": [("text", "", "unreadable", "not UTF-8")],
    "bom": [("manifest", "", "bom", "")],
    "list": [("manifest", "", "not_object", "list")],
    "twice": [("manifest", "", "duplicate_key", "exhibits[0] label"), ("manifest", "", "duplicate_key", "schema_version")],
    "malformed_exhibits": [("manifest", "", "key_empty", "exhibits[0] caption"), ("manifest", "", "name_pattern", "exhibits[0] label 'a b'")],
    "unknown_key": [("manifest", "", "schema_version", "4"), ("manifest", "", "unknown_key", "x")],
    "bool_version": [("manifest", "", "key_empty", "summary"), ("manifest", "", "key_type", "doi: int"), ("manifest", "", "key_type", "schema_version: bool")],
    "undeclared": [("binding", "", "no_crop", "gone"), ("binding", "", "undeclared", "_z9")],
    "twice_label": [("manifest", "", "label_twice", "exhibits[1] 'fig_01'")],
    "stray": [("figures", "", "subdirectory", "sub"), ("figures", "", "suffix", "a.PNG"), ("tables", "", "suffix", "readme.txt")],
    "gif": [("figures", "", "empty", "_z9.png"), ("figures", "", "not_png", "fig_01.png")],
    "bad_table": [("tables", "", "empty_row", "fig_01: row 2")],
    "loose_table": [("table_binding", "", "undeclared", "other")],
    "case": [("case", "", "miscased", "Text.md")],
    "other_id": [("supplements", "", "id_differs", "another paper")],
    "no_declaration": [("supplements", "", "no_declaration", "s1")],
    "two_supplements": [("supplements", "", "missing_directory", "s2")],
    "climbing": [("supplements", "", "name_punctuation", "supplements[0] name '..'")],
    "null_supplements": [("supplements", "", "supplements_type", "NoneType")],
    "clash": [("uniqueness", "supplements/s1/", "label_twice", "s1_f ")],
    "clash_malformed": [("manifest", "", "not_object", "list"), ("uniqueness", "supplements/s2/", "label_twice", "s1_f supplements/s1/")],
    "empty_supplement_text": [("contents", "supplements/s1/", "empty", "text.md")],
    "figures_file": [("figures", "", "not_directory", "figures")],
    "sound_pipe": [("binding", "", "undeclared", "dangling"), ("figures", "", "special", "_z9.png"), ("figures", "", "special", "dangling.png")],
}


@pytest.mark.parametrize("name", CASES)
def test_violations(found, name):
    assert found[0].get(name, []) == sorted(CASES[name])


def test_listings_keep_legal_underscores(found):
    crops = [(r.bundle_id, r.label) for r in figure_files(found[1]).collect() if r.bundle_id == "sound"]
    assert crops == [("sound", "_z9"), ("sound", "fig_01")]
    assert ("with_supplement", "s1") in [tuple(r) for r in supplement_dirs(found[1]).collect()]


def test_verdicts_and_lists(spark, found):
    files = found[1].where("bundle_id in ('sound', 'gif', 'no_text')")
    problems = B.violations(files)
    got = {r.bundle_id: (r.valid, r.problems) for r in B.verdicts(files, problems).collect()}
    assert got == {"sound": (True, 0), "gif": (False, 2), "no_text": (False, 1)}
    lists = {r.bundle_id: r.problems for r in B.listed(problems).collect()}
    assert lists["no_text"] == ["text missing_file text.md"]


def test_strict_json():
    assert parsed('{"a": 1} x')[1] == "syntax: line 1 column 10"
    assert parsed("[" * 100_000)[1] in ("depth", "syntax: line 1 column 100001")
    assert parsed("1" * 5000)[1] == "number"
    value, fault = parsed('{"a": {"b": 1, "b": 2}, "a": [{"c": 1, "c": 2}], "d": 0}')
    assert fault is None and repeated_keys(value) == [("", "a"), ("a[0]", "c"), ("replaced", "b")]


def test_rows_of_a_bundle_come_together_in_any_memory():
    import numpy as np
    import pyarrow as pa

    of = np.random.default_rng(1).integers(0, 300, 20_000)
    rows = pa.table({"bin": pa.array(of % 64, pa.int32()), "bundle_id": [None if b == 7 else f"b{b}" for b in of], "n": range(20_000), "content": ["x" * 20] * 20_000})
    for held in (1, 100_000, 1 << 30):
        got = pa.Table.from_batches(B.together(iter(rows.to_batches(1000)), held))
        ids = got["bundle_id"].to_pylist()
        assert sum(a != b for a, b in zip(ids, ids[1:], strict=False)) == len(set(ids)) - 1
        assert sorted(got["n"].to_pylist()) == list(range(20_000)) and got.column_names == ["bundle_id", "n", "content"]
        assert all(ids[i] == (None if of[n] == 7 else f"b{of[n]}") for i, n in enumerate(got["n"].to_pylist()))
    assert list(B.together(iter([]))) == []


def test_bundles_are_not_sorted_by_spark(spark):
    rows = spark.createDataFrame([("a", "", "", "", "dir", False, 0, None, None, None)], "bundle_id string, scope string, dir string, name string, kind string, hidden boolean, size long, head binary, content string, read_error string")
    plan = B.violations(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan


def test_judgements_are_the_verdicts_without_a_join(spark):
    from quillmark.plans import catalogue, coverage

    sf = "/root/testdata/sf0.001"
    files = coverage._listed(catalogue.derived(spark, sf, coverage._BUNDLES)).where("bundle_id <= 300")
    rows = lambda df: sorted(tuple(r) for r in df.select("bundle_id", "valid", "problems").collect())
    assert rows(B.judgements(files)) == rows(B.verdicts(files, B.violations(files)))
    plan = catalogue.QUERIES["bundle_verdicts"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan and "Sort" not in plan


def test_supplements_are_validated_without_a_sort(spark):
    from quillmark.plans import catalogue, coverage  # noqa: F401  coverage adds to the catalogue

    plan = catalogue.QUERIES["validate_supplements"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Sort" not in plan

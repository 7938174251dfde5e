"""Matching, markup, witnesses, geometry and article XML on small cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmark.operators import acceptance, geometry, grid, integrity, jats, markup, matching, staging, witness
from quillmark.plans.catalogue import TABLE_CASES

REGISTRY = "id string, ord int, title string, doi string, authors string, year string"


def match(spark, records, texts):
    reg = spark.createDataFrame([(r["id"], i, r.get("title"), r.get("doi"), r.get("authors"), r.get("year")) for i, r in enumerate(records)], REGISTRY)
    docs = spark.createDataFrame(texts, "doc_id string, text string")
    return {r.doc_id: r for r in matching.matched(docs, reg).collect()}


HERON = {"id": "heron", "title": "Winter feeding of grey herons on tidal flats", "authors": "Marsh, A.; Reed-Bank, T.", "doi": "10.1234/herons.2019", "year": "2019"}
OTTER = {"id": "otter", "title": "Otter holts along upland rivers", "authors": "Brook, C.", "doi": "https://doi.org/10.1234/otters", "year": "2020"}
PAGE = "Winter feeding of grey herons\non tidal flats\nA. Marsh, T. Reed\ndoi:10.1234/herons.2019 .\n2019 "


def test_doi_title_authors_and_year(spark):
    got = match(spark, [HERON, OTTER], [("a", PAGE), ("b", "nothing of the kind"), ("c", None)])
    assert got["a"].best_id == "heron" and got["a"].confident
    assert got["a"].score == pytest.approx(50 + 10 + 5)  # the DOI runs into ".2019" of the next line
    assert (got["b"].best_id, got["b"].score, got["b"].confident) == ("heron", 0.0, False)
    assert got["c"].best_id == "heron"


def test_ties_nested_dois_and_contention(spark):
    twin = OTTER | {"id": "twin"}
    update = OTTER | {"id": "update", "doi": "10.1234/otters.pub2", "title": "Otter holts again"}
    got = match(spark, [OTTER, twin], [("a", "see 10.1234/otters; otter holts along upland rivers")])
    assert got["a"].best_id == "otter" and got["a"].margin == 0 and not got["a"].confident
    got = match(spark, [OTTER, update], [("a", "otter 10.1234/otters.pub2, brook"), ("b", "10.1234/otters, x"), ("c", "10.1234/otters )")])
    assert got["a"].best_id == "update" and got["a"].confident
    assert got["b"].contested and got["c"].contested and not got["a"].contested


def test_odd_dois_and_blank_records(spark):
    odd = {"id": "odd", "doi": "hdl/7-x"}
    got = match(spark, [{"id": "blank"}, odd], [("a", "under HDL/7-X;")])
    assert got["a"].best_id == "odd" and got["a"].score == 100 and got["a"].confident


def test_index_and_joined_pairs_agree(spark):
    rng = np.random.default_rng(3)
    pick = lambda words, n: " ".join(rng.choice(words, n))
    common, scarce = [f"often{i}" for i in range(4)], [f"rare{i}" for i in range(150)]
    surnames = ["Marsh", "Reed-Bank", "Bank-Holt", "O'Neil", "Brook-Reed-Marsh"]
    reg = [(f"r{i}", i, pick(common, 2) + " " + pick(scarce, 3), f"10.{1234 + i % 3}/x{i % 90}" + (".é" if i % 7 == 0 else "") if i % 2 else None, "; ".join(f"{n}, X." for n in rng.choice(surnames, 2)), str(1990 + i % 5)) for i in range(300)]
    reg += [("same", 300, reg[0][2], reg[1][3], None, None), ("only-doi", 301, None, "10.1234/x1.pub2", None, None)]
    tails = ["", ".", ". Next", ";10.1235/x2", ".pub2", "/a", "é", ".é", ".-"]
    docs = [(i, pick(common + surnames, 4) + " " + pick(scarce, int(rng.integers(0, 5))) + f" {1988 + i % 9} 10.10.1234/X{i % 95}{tails[i % len(tails)]}") for i in range(300)]
    docs += [(300, None), (301, "nothing"), (302, "10.1234/none"), (303, pick(scarce, 100))]
    registry, texts = spark.createDataFrame(reg, REGISTRY), spark.createDataFrame(docs, "doc_id int, text string")
    rows = lambda df: sorted(tuple(r) for r in df.select("doc_id", "place", "id", "doi_hit", "title_overlap", "score", "runner_up").collect())
    for n in (1, 3):
        assert rows(matching.ranked(texts, registry, n)) == rows(matching._joined(texts, registry).where(F.col("place") <= n))


def test_a_shared_registrant_makes_no_pair(spark):
    got = match(spark, [HERON, OTTER | {"doi": "10.7777/otters"}], [("a", "see 10.7777/others")])
    assert (got["a"].best_id, got["a"].score) == ("heron", 0.0)


def test_what_all_records_share_takes_no_time_each(spark):
    import time

    reg = spark.range(5_000).selectExpr("concat('r', id) as id", "cast(id as int) as ord", "concat('Common word', id) as title", "concat('10.5555/rec-', id) as doi", "cast(null as string) as authors", "'1999' as year")
    docs = spark.range(20_000).selectExpr("id as doc_id", "concat('common word', id % 5000, ' 1999 doi 10.5555/rec-', id % 5000, '; 1') as text")
    began = time.monotonic()
    got = matching.matched(docs, reg).where("confident and contested and best_id = concat('r', doc_id % 5000) and score = 155 and margin = 125")
    assert got.count() == 20_000
    assert time.monotonic() - began < 40


def test_texts_meet_an_indexed_registry_without_pairs(spark):
    reg = spark.createDataFrame([("a", 0, "Heron tides", None, None, None)], REGISTRY)
    top = matching.top(spark.createDataFrame([(1, "heron"), (2, "")], "doc_id int, text string"), reg)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan and "Sort" not in plan
    assert sorted(tuple(r) for r in top.collect()) == [(1, 1, "a", 25.0), (2, 1, "a", 0.0)]


@pytest.mark.parametrize("case", range(len(TABLE_CASES)))
def test_table_cases(case):
    html, rules = TABLE_CASES[case]
    assert " ".join(r for r, _ in markup.findings(html)) == rules


def test_hostile_tables_are_refused_at_once():
    import time

    began = time.process_time()
    many = "<table><tr>" + "<td colspan=1000 rowspan=1000>x</td>" * 10 + "</tr></table>"
    assert markup.findings(many) == [("grid_limit", "")]
    wide = "<table>" + ("<tr>" + "<td colspan=1000>x</td>" * 20 + "</tr>") * 30 + "</table>"
    assert markup.findings(wide)[0][0] == "grid_limit"
    assert markup.findings("<table><tr><td colspan=" + "9" * 10_000 + ">x</td></tr></table>")[0][0] == "span_limit"
    assert markup.findings("<table>" + "<tr><td>a</td><td>b</td></tr>" * 500 + "</table>") == []
    assert time.process_time() - began < 10


def test_capped_findings_and_recovery():
    rows = "<tr><td>a</td><td>b</td></tr>" + "<tr><td>a</td></tr>" * 8
    got = markup.findings(f"<table>{rows}</table>")
    assert [r for r, _ in got] == ["hole"] * 5 + ["holes_further"] and got[-1][1] == "3"
    got = markup.findings("<table><tr><td><b>x</td><td>y</td></tr></table>")
    assert [r for r, _ in got] == ["refused", "nesting"]
    assert markup.findings("<table><![CDATA[x]]><tr><td>a</td></tr></table>")[0][0] in ("section", "comment")


def test_cells_and_grid_agree(spark):
    html = [(i, h) for i, (h, _) in enumerate(TABLE_CASES)] + [(100, "<table><tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c</td></tr></table>")]
    cells = markup.table_cells(spark.createDataFrame(html, "file int, html string"))
    got = [tuple(r) for r in cells.where("file = 100").select("row", "col", "rowspan", "colspan").collect()]
    assert sorted(got) == [(0, 0, 2, 1), (0, 1, 1, 1), (1, 1, 1, 1)]
    written = spark.createDataFrame([(100, 2, [])], "file int, rows int, empty array<int>")
    assert grid.holes(cells.where("file = 100"), written).count() == 0
    assert grid.overlaps(cells.where("file = 100")).count() == 0


def test_spans_beyond_the_limit_make_no_rows(spark):
    cells = spark.createDataFrame([("a", 0, 0, 0, 1000, 1000), ("b", 0, 0, 0, 10**9, 1), ("c", 0, 0, 0, 2, 2)], "file string, cell_seq int, row int, col int, rowspan int, colspan int")
    assert {r.file for r in grid.positions(cells).collect()} == {"c"}
    assert {r.file for r in grid.over_limit(cells).collect()} == {"a", "b"}


def test_only_files_whose_limit_is_in_doubt_are_counted_out(spark):
    rng = np.random.default_rng(5)
    made = [(f, k, int(r), int(c), int(h), int(w)) for f in range(60) for k, (r, c, h, w) in enumerate(zip(*rng.integers(0, 300, (2, 8)), *rng.integers(1, 250, (2, 8)), strict=True))]
    # Sharing all positions, or in many cells; a null span is passed over.
    made += [(100, k, 0, 0, 300, 300) for k in range(3)] + [(101, k, k, 0, 1, 1000) for k in range(102)]
    made += [(102, 0, 0, 0, 400, 200), (102, 1, None, None, None, None), (102, 2, 10, 10, 100, 150), (102, 3, 0, 0, 400, 201)]

    def first_full(own):
        taken = set()
        for _, k, r, c, h, w in own:
            if h is None:
                continue
            if len(taken) + h * w > grid.GRID_LIMIT:
                return k
            taken |= {(y, x) for y in range(r, r + h) for x in range(c, c + w)}
        return None

    want = {f: k for f in {m[0] for m in made} if (k := first_full([m for m in made if m[0] == f])) is not None}
    found = grid.over_limit(spark.createDataFrame(made, "file int, cell_seq int, row int, col int, rowspan int, colspan int"))
    assert {r.file: r.cell_seq for r in found.collect()} == want and {100, 101, 102} <= set(want)


def test_files_over_the_limit_take_no_time_each(spark):
    import time

    made = spark.range(400_000).selectExpr("id div 4 as file", "id % 4 as cell_seq", "cast(id % 4 as int) as row", "0 as col", "cast(pmod(hash(id), 300) + 200 as int) as rowspan", "cast(pmod(hash(id, 1), 300) + 200 as int) as colspan")
    began = time.monotonic()
    assert grid.over_limit(made).count() > 90_000
    assert time.monotonic() - began < 25


def test_emphasis_and_pages(spark):
    spans = [(1, 0, 2, "a "), (1, 1, 2, "b"), (1, 2, 0, "c"), (1, 3, 2, " "), (1, 4, 16, "d"), (2, 0, 16, "e"), (2, 1, 18, "f")]
    df = spark.createDataFrame(spans, "line int, span int, flags int, text string")
    from quillmark.functions.columns import span_style

    got = sorted(tuple(r) for r in witness.emphasis_runs(df, ["line"], "span", span_style(F.col("flags"))).select("line", "first", "style", "text").collect())
    assert got == [(1, 0, "italic", "a b"), (1, 4, "bold", "d"), (2, 0, "bold", "e"), (2, 1, "bold-italic", "f")]
    text = spark.createDataFrame([(1, "x\n<!-- page 1 -->\na\nb\n<!-- page 12 -->\nc\n<!-- page 3 --> no")], "doc_id int, text string")
    got = [(r.page, r.line) for r in witness.paged(witness.lines(text)).orderBy("pos").collect()]
    assert got == [(None, "x"), (1, "a"), (1, "b"), (12, "c"), (12, "<!-- page 3 --> no")]


def test_geometry(spark):
    boxes = spark.createDataFrame([("f", 10.0, 10.0, 20.5, 30.0, 100.0, 100.0, 200, 400), ("f", 5.2, 50.0, 99.9, 120.0, 100.0, 100.0, 200, 400), ("g", 3.0, 3.0, 3.0, 9.0, 100.0, 100.0, 200, 400)], "label string, x0 double, y0 double, x1 double, y1 double, w double, h double, pw int, ph int")
    got = [tuple(r) for r in geometry.regions(boxes, ["label"], ("w", "h"), ("pw", "ph")).collect()]
    assert got == [("f", 10, 40, 200, 400)]
    image = np.full((60, 80, 3), 250, dtype=np.uint8)
    image[20:30, 40:50] = 0
    assert geometry.trimmed(image) == (34, 14, 56, 36)
    assert geometry.trimmed(np.full((5, 5, 3), 9, dtype=np.uint8)) is None
    image[0, 0] = 0
    assert geometry.trimmed(image) == (0, 0, 80, 60)


def test_articles(spark):
    body = "<body><p>" + "x" * 1000 + "</p></body>"
    df = spark.createDataFrame([("a", f"<article>{body}</article>"), ("b", "<article><body>short</body></article>"), ("c", "<broken")], "pmcid string, xml string")
    got = {r.pmcid: r for r in jats.markdown(df).collect()}
    assert got["a"].markdown == "x" * 1000 + "\n" and got["c"].markdown is None and got["c"].error
    assert {r.pmcid: r.has_body for r in jats.with_body(df.where("pmcid <> 'c'")).collect()} == {"a": True, "b": False}
    lines = jats.article_lines("<a><body><sec><title>T</title><fig><label>Fig 1</label><caption><p>What?</p></caption></fig><p>See<fig/>.</p></sec></body><floats-group><table-wrap/></floats-group></a>")
    assert lines == ["## T", "[FIGURE: Fig 1. What?]", "See [FIGURE].", "[TABLE]"]


def test_staging_and_acceptance(spark):
    pages = spark.createDataFrame([("a", 0), ("a", 1), ("b", 1), ("c", 0), ("c", 0)], "doc string, i int")
    assert {r.doc: r.complete for r in staging.page_coverage(pages, "doc", "i").collect()} == {"a": True, "b": False, "c": False}
    runs = spark.createDataFrame([("x", "ok"), ("x", "ambiguous"), ("y", "failed"), ("y", "ambiguous"), ("z", "ok")], "run string, status string")
    assert {r.run: r.code for r in runs.groupBy("run").agg(staging.exit_code(F.col("status")).alias("code")).collect()} == {"x": 3, "y": 1, "z": 0}
    text = spark.createDataFrame([(1, "so­ft zero​width bro-\nken")], "doc_id int, text string")
    assert tuple(acceptance.suspect_characters(text, "doc_id").first()) == (1, 1, 1, 1)
    rows = spark.createDataFrame([(1, "[omission] page 03: lost"), (1, "[other] page 1: x")], "doc_id int, line string")
    assert [tuple(r) for r in acceptance.sweep_findings(rows, "doc_id").collect()] == [(1, "omission", 3, "lost")]
    units = spark.createDataFrame([(1, 1, 2), (1, 4, 4)], "doc_id int, page_start int, page_end int")
    docs = spark.createDataFrame([(1, 5)], "doc_id int, pages int")
    assert sorted(r.page for r in acceptance.uncovered_pages(units, docs, "doc_id").collect()) == [3, 5]
    many = spark.createDataFrame([("k", i) for i in range(7)], "k string, v int")
    assert [(r.v, r.further) for r in integrity.capped(many, ["k"], ["v"]).orderBy(F.col("v").asc_nulls_last()).collect()] == [(0, None), (1, None), (2, None), (3, None), (4, None), (None, 2)]

"""More of the query catalogue: predicates, scalar functions, declarations, rules and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.functions import columns as C
from quillmark.functions import tables
from quillmark.operators import acceptance, bundles, geometry, integrity, jats, matching, reports, rules, staging, witness
from quillmark.plans.catalogue import query
from quillmark.sources import bundles as files_of
from quillmark.sources import registry as registries

# --- predicates and scalar functions -----------------------------------------------------------


@query(
    "matchable",
    "SELECT id FROM reg WHERE trim(coalesce(title, '') || coalesce(doi, '') || coalesce(authors, '') || coalesce(year, '')) <> ''",
    reg="""select p_partkey as id, case when p_partkey % 3 = 0 then p_name when p_partkey % 3 = 1 then '  ' end as title, case when p_partkey % 5 = 0 then '10.1/x' end as doi,
      case when p_partkey % 7 = 0 then 'A' else '' end as authors, case when p_partkey % 11 = 0 then '1999' end as year from {part}""",
)
def matchable(reg: DataFrame) -> DataFrame:
    return matching.matchable(reg).select("id")


_ODD_NAMES = """select c_custkey as key, case c_custkey % 8 when 0 then c_name when 1 then ' ' when 2 then '..' when 3 then concat('a/', c_custkey) when 4 then concat('.', c_custkey)
      when 5 then concat(' s', c_custkey, ' ') when 6 then concat('s ', c_custkey) else concat('x_', c_custkey) end as name from {customer}"""


@query(
    "id_rules",
    """SELECT key, CASE WHEN trim(name) = '' THEN 'empty' WHEN trim(name) IN ('.', '..') THEN 'reserved' WHEN contains(name, '/') OR contains(name, chr(92)) THEN 'separator' WHEN starts_with(trim(name), '.') THEN 'dot' END AS id_rule,
    CASE WHEN trim(name) = '' THEN 'empty' WHEN trim(name) IN ('.', '..') THEN 'reserved' WHEN contains(name, '/') THEN 'separator' WHEN starts_with(trim(name), '.') THEN 'dot'
      WHEN NOT regexp_full_match(trim(name), '[A-Za-z0-9._-]+') THEN 'pattern' END AS supplement_rule FROM names""",
    names=_ODD_NAMES,
)
def id_rules(names: DataFrame) -> DataFrame:
    return names.select("key", C.id_rule(F.col("name")).alias("id_rule"), C.supplement_name_rule(F.col("name")).alias("supplement_rule"))


@query(
    "normalised_dois",
    "SELECT key, '10.' || (1000 + key % 9000) || '/x' || key AS doi FROM raw WHERE key % 6 <> 5 UNION ALL SELECT key, '' FROM raw WHERE key % 6 = 5",
    raw="""select p_partkey as key, case p_partkey % 6 when 0 then concat('https://doi.org/10.', 1000 + p_partkey % 9000, '/X', p_partkey) when 1 then concat('DOI: 10.', 1000 + p_partkey % 9000, '/x', p_partkey)
      when 2 then concat(' 10.', 1000 + p_partkey % 9000, '/x', p_partkey, ' ') when 3 then concat('http://dx.doi.org/10.', 1000 + p_partkey % 9000, '/x ', p_partkey)
      when 4 then concat('doi 10.', 1000 + p_partkey % 9000, '/X', p_partkey) end as doi from {part}""",
)
def normalised_dois(raw: DataFrame) -> DataFrame:
    return raw.select("key", C.normalised_doi(F.col("doi")).alias("doi"))


@query(
    "span_styles",
    "SELECT key, flags, CASE WHEN (flags & 2) <> 0 AND (flags & 16) <> 0 THEN 'bold-italic' WHEN (flags & 2) <> 0 THEN 'italic' WHEN (flags & 16) <> 0 THEN 'bold' END AS style FROM spans",
    spans="select l_orderkey * 10 + l_linenumber as key, cast(l_partkey % 32 as int) as flags from {lineitem}",
)
def span_styles(spans: DataFrame) -> DataFrame:
    return spans.select("key", "flags", C.span_style(F.col("flags")).alias("style"))


@query(
    "registrar_records",
    """SELECT key, CASE WHEN key % 4 = 3 THEN '(registrar returned no fields)' ELSE CASE WHEN key % 4 = 0 THEN 'Ann A, Bo B. ' WHEN key % 4 = 1 THEN 'Ann A, Bo B, Cy C et al. ' ELSE '' END || '(' || y || '). ' || title || CASE WHEN key % 3 = 0 THEN '. J ' || y ELSE '' END END AS record FROM raw""",
    raw="""select s_suppkey as key, s_name as title, cast(1950 + s_suppkey % 70 as string) as y from {supplier}""",
)
def registrar_records(raw: DataFrame) -> DataFrame:
    lit = lambda *x: F.array(*[F.lit(v) for v in x]).cast("array<string>")
    none, k = F.lit(None).cast("string"), F.col("key") % 4
    authors = F.when(k == 0, lit("Ann A", "Bo B")).when(k == 1, lit("Ann A", "Bo B", "Cy C", "Di D")).otherwise(lit())
    has = lambda c: F.when(k != 3, c)
    record = C.registrar_record(authors, has(F.col("y")), has(F.col("title")), has(F.when(F.col("key") % 3 == 0, F.concat(F.lit("J "), "y"))), F.lit(" "), none)
    return raw.select("key", record.alias("record"))


@query(
    "labels_and_sentinels",
    """SELECT key, CASE WHEN length(name) > 40 THEN left(name, 40) || '...' ELSE name END AS shown, '[' || upper(printed) || '. ' || name || ']' AS sentinel, label || '_p' || page AS continuation, replace(replace(trim(name), '*', ''), '  ', ' ') AS plain FROM raw""",
    raw="""select p_partkey as key, concat('*', p_name, '*  ', p_type, ' ') as name, concat('Table ', p_size) as printed, concat('tab_', p_size) as label, cast(p_partkey % 90 + 1 as int) as page from {part}""",
)
def labels_and_sentinels(raw: DataFrame) -> DataFrame:
    return raw.select("key", C.shown(F.col("name")).alias("shown"), C.sentinel(F.col("printed"), F.col("name")).alias("sentinel"), C.continuation_label(F.col("label"), F.col("page")).alias("continuation"), rules.normalised(F.col("name")).alias("plain"))


@query(
    "retries",
    """SELECT doc_id, CASE WHEN doc_id % 4 IN (0, 1) THEN 1 ELSE 2 END::INT AS tries, CASE doc_id % 4 WHEN 2 THEN least(greatest((doc_id % 200 - 50)::DOUBLE, 0.0), 60.0) WHEN 3 THEN 5.0 ELSE 0.0 END AS waited,
      CASE WHEN doc_id % 4 IN (0, 2) THEN 'answered' ELSE 'failed' END AS outcome FROM (SELECT DISTINCT doc_id FROM answers)""",
    answers="""select o_orderkey as doc_id, 1 as try, case o_orderkey % 4 when 0 then 200 when 1 then 403 when 2 then 429 end as status, case when o_orderkey % 4 = 2 then o_orderkey % 200 - 50 end as retry_after from {orders}
      union all select o_orderkey, 2, case when o_orderkey % 4 = 2 then 200 else 503 end, null from {orders}
      union all select o_orderkey, 3, 200, null from {orders}""",
)
def retries(answers: DataFrame) -> DataFrame:
    return rules.attempts(answers)


@query(
    "call_modes",
    """SELECT key, CASE key % 8 WHEN 0 THEN NULL WHEN 1 THEN 'one_mode' WHEN 2 THEN 'one_mode' WHEN 3 THEN 'supplement_alone' WHEN 4 THEN 'folder_and_registry' WHEN 5 THEN 'id_and_pdf' WHEN 6 THEN NULL ELSE NULL END AS rule,
      CASE WHEN key % 5 = 0 THEN 'positive' WHEN key % 5 = 1 THEN 'width' WHEN key % 5 = 2 THEN 'pixels' END AS render FROM calls""",
    calls="""select c_custkey as key, case when c_custkey % 8 in (0, 1, 5) then 'i' end as id, case when c_custkey % 8 in (0, 1) then 'p' end as pdf, case when c_custkey % 8 in (1, 3, 7) then 'm' end as map_file,
      case when c_custkey % 8 in (4, 6) then 'f' end as folder, case when c_custkey % 8 = 6 then 'r' end as registry, case when c_custkey % 8 in (0, 3) then 's' end as supplement,
      case c_custkey % 5 when 0 then 0.0 when 1 then 20001.0 when 2 then 10000.0 else 500.0 end as width, case c_custkey % 5 when 2 then 300.0 else 150.0 end as dpi, 700.0 as high from {customer}""",
)
def call_modes(calls: DataFrame) -> DataFrame:
    given = {k: F.col(k) for k in ("id", "pdf", "map_file", "folder", "registry", "supplement")}
    return calls.select("key", rules.mode_rule(given).alias("rule"), rules.render_rule(*[F.col(c).cast("double") for c in ("width", "dpi", "high")]).alias("render"))


@query(
    "dpi_rules",
    "SELECT key, CASE key % 5 WHEN 0 THEN NULL WHEN 1 THEN 'range' WHEN 2 THEN 'type' WHEN 3 THEN 'type' ELSE 'range' END AS rule FROM raw",
    raw="select s_suppkey as key, case s_suppkey % 5 when 0 then cast(1 + s_suppkey % 1200 as string) when 1 then '0' when 2 then 'true' when 3 then '\"72\"' else '1201' end as dpi from {supplier}",
)
def dpi_rules(raw: DataFrame) -> DataFrame:
    return raw.select("key", C.dpi_rule(F.expr("parse_json(dpi)")).alias("rule"))


@query(
    "settings_value",
    "SELECT 'Customer#' || lpad(min(c_custkey)::VARCHAR, 9, '0') AS value FROM src WHERE c_custkey % 10 = 3",
    src="select c_custkey, c_name from {customer}",
)
def settings_value(src: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    line = F.when(key % 10 == 3, F.concat(F.lit(' API_KEY = "'), "c_name", F.lit('" '))).when(key % 10 == 1, F.concat(F.lit("# API_KEY="), "c_name")).otherwise(F.concat(F.lit("OTHER="), "c_name"))
    return rules.read_var(src.select(key.alias("pos"), line.alias("line")), "API_KEY", "")


@query(
    "rotated_boxes",
    """SELECT key, CASE turn WHEN 0 THEN x0 WHEN 1 THEN 800.0 - y1 WHEN 2 THEN 600.0 - x1 ELSE y0 END AS left_edge, CASE turn WHEN 0 THEN y0 WHEN 1 THEN x0 WHEN 2 THEN 800.0 - y1 ELSE 600.0 - x1 END AS top_edge,
      CASE turn WHEN 0 THEN x1 WHEN 1 THEN 800.0 - y0 WHEN 2 THEN 600.0 - x0 ELSE y1 END AS right_edge, CASE turn WHEN 0 THEN y1 WHEN 1 THEN x1 WHEN 2 THEN 800.0 - y0 ELSE 600.0 - x0 END AS bottom_edge
      FROM (SELECT key, turn, least(a, c)::DOUBLE AS x0, least(b, d)::DOUBLE AS y0, greatest(a, c)::DOUBLE AS x1, greatest(b, d)::DOUBLE AS y1 FROM boxes)""",
    boxes="""select l_orderkey * 10 + l_linenumber as key, l_linenumber % 4 as turn, cast(l_partkey % 500 as double) + 0.25 as a, cast(l_suppkey % 700 as double) + 0.5 as b, cast(l_quantity as double) + 0.75 as c, cast(l_orderkey % 300 as double) as d from {lineitem}""",
)
def rotated_boxes(boxes: DataFrame) -> DataFrame:
    box = rules.rotated_box(F.array("a", "b", "c", "d"), F.col("turn") * 90, F.lit(600.0), F.lit(800.0))
    return boxes.select("key", *[box[i].alias(n) for i, n in enumerate(("left_edge", "top_edge", "right_edge", "bottom_edge"))])


# --- sources -----------------------------------------------------------------------------------

_ENTRIES = """select cast(o_orderkey as string) as bundle_id, '' as scope, dir, name, kind, false as hidden from (
  select o_orderkey, 'figures' as dir, concat('f', o_orderkey % 3, '.png') as name, 'file' as kind from {orders}
  union all select o_orderkey, 'figures', 'notes.txt', 'file' from {orders}
  union all select o_orderkey, 'figures', 'deep.png', 'dir' from {orders}
  union all select o_orderkey, 'tables', concat('t', o_orderkey % 2, '.html'), 'file' from {orders}
  union all select o_orderkey, 'tables', '.html', 'file' from {orders}
  union all select o_orderkey, 'supplements', concat('s', o_orderkey % 4), 'dir' from {orders}
  union all select o_orderkey, 'supplements', 'stray.pdf', 'file' from {orders}
  union all select o_orderkey, '', case when o_orderkey % 3 = 0 then 'Manifest.JSON' when o_orderkey % 3 = 1 then 'TEXT.md' else 'text.md' end, 'file' from {orders}) t"""


@query(
    "bundle_assets",
    """SELECT bundle_id, 'figure' AS asset, left(name, length(name) - 4) AS label FROM entries WHERE dir = 'figures' AND kind = 'file' AND ends_with(name, '.png')
      UNION ALL SELECT bundle_id, 'table', left(name, length(name) - 5) FROM entries WHERE dir = 'tables' AND name <> '.html'
      UNION ALL SELECT bundle_id, 'supplement', name FROM entries WHERE dir = 'supplements' AND kind = 'dir'""",
    entries=_ENTRIES,
)
def bundle_assets(entries: DataFrame) -> DataFrame:
    part = lambda df, kind, name="label": df.select("bundle_id", F.lit(kind).alias("asset"), F.col(name).alias("label"))
    return part(files_of.figure_files(entries), "figure").union(part(files_of.table_files(entries), "table")).union(part(files_of.supplement_dirs(entries), "supplement", "name"))


@query("miscased_entries", "SELECT bundle_id, name, lower(name) AS expected FROM entries WHERE dir = '' AND name <> lower(name)", entries=_ENTRIES)
def miscased_entries(entries: DataFrame) -> DataFrame:
    return integrity.miscased(entries.where("dir = ''"), ["manifest.json", "text.md", "figures", "tables", "supplements"])


@query(
    "page_files",
    "SELECT doc_id, name FROM files WHERE doc_id % 3 = 0",
    files="select o_orderkey as doc_id, case o_orderkey % 3 when 0 then concat('page_', o_orderkey, '.png') when 1 then concat('page_', o_orderkey, '.md') else concat('x_page_', o_orderkey, '.png') end as name from {orders}",
)
def page_files(files: DataFrame) -> DataFrame:
    return rules.page_files(files, ".png").select("doc_id", "name")


@query(
    "source_states",
    "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'no_directory' WHEN 1 THEN 'missing' WHEN 2 THEN 'unreadable' WHEN 3 THEN 'no_pages' ELSE 'ready' END AS state FROM works",
    works="select o_orderkey as doc_id, o_orderkey % 5 > 0 as is_dir, o_orderkey % 5 > 1 as is_file, o_orderkey % 5 > 2 as opened, case when o_orderkey % 5 = 4 then 9 else 0 end as pages from {orders}",
)
def source_states(works: DataFrame) -> DataFrame:
    return rules.source_states(works)


@query(
    "id_maps",
    "SELECT 'k' || o_orderkey AS id, CASE WHEN o_orderkey % 4 <> 0 THEN '/p/' || o_orderkey END AS path FROM src",
    src="select o_orderkey, concat('{{\"k', o_orderkey, '\": ', case when o_orderkey % 4 = 0 then '7' else concat('\"/p/', o_orderkey, '\"') end, '}}') as raw from {orders}",
)
def id_maps(src: DataFrame) -> DataFrame:
    return registries.id_map(src.select("raw"))


@query(
    "skipped_records",
    """SELECT CASE o_orderkey % 4 WHEN 1 THEN 'no_id' WHEN 2 THEN 'not_object' ELSE 'nothing_to_match' END AS rule, count(*) AS records FROM src WHERE o_orderkey % 4 <> 0 GROUP BY 1""",
    src="""select o_orderkey, concat('[', case o_orderkey % 4 when 0 then concat('{{"id": "k', o_orderkey, '", "title": "t"}}') when 1 then '{{"title": "t"}}' when 2 then '7' else '{{"id": "x", "title": " "}}' end, ']') as raw from {orders}""",
)
def skipped_records(src: DataFrame) -> DataFrame:
    return registries.skipped(registries.records(src.select("raw")))


@query(
    "identity_texts",
    "SELECT doc_id, lower(string_agg(coalesce(text, ''), chr(10) ORDER BY page)) AS text FROM pages WHERE page <= 3 GROUP BY doc_id",
    pages="select o_orderkey as doc_id, n as page, case when (o_orderkey + n) % 9 = 0 then null else concat('Page ', n, ' OF ', o_orderkey) end as text from {orders} cross join (select 1 as n union all select 2 union all select 3 union all select 4) t",
)
def identity_texts(pages: DataFrame) -> DataFrame:
    return matching.identity_text(pages)


# --- matching with all four weights ------------------------------------------------------------


@query(
    "registry_weights",
    """, w AS (SELECT r.id, d.doc_id, r.k AS rk, d.k AS dk FROM docs d CROSS JOIN registry r),
    s AS (SELECT doc_id, id, rk,
      CASE WHEN rk = dk AND dk % 2 = 0 THEN 100.0 ELSE 0.0 END
      + 50.0 * (CASE WHEN rk = dk THEN 2.0 WHEN rk % 7 = dk % 7 THEN 1.0 ELSE 0.0 END) / 2
      + 10.0 * (CASE WHEN dk % 3 = 0 AND rk = dk THEN 1.0 ELSE 0.0 END)
      + CASE WHEN rk % 50 = dk % 50 THEN 5.0 ELSE 0.0 END AS score, rk = dk AND dk % 2 = 0 AS doi_hit,
      (CASE WHEN rk = dk THEN 2.0 WHEN rk % 7 = dk % 7 THEN 1.0 ELSE 0.0 END) / 2 AS overlap FROM w),
    o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, rk) AS n, lead(score, 1, 0.0) OVER (PARTITION BY doc_id ORDER BY score DESC, rk) AS next FROM s)
    SELECT doc_id, id AS best_id, score, score - next AS margin, (score - next) > 0 AND (doi_hit OR (overlap >= 0.7 AND score - next >= 15)) AS confident FROM o WHERE n = 1""",
    docs="""select c_custkey as doc_id, c_custkey as k, concat('topicone', c_custkey % 7, 'q wordtwo', c_custkey, 'z ', case when c_custkey % 3 = 0 then concat('by surname', translate(cast(c_custkey as string), '0123456789', 'abcdefghij'), ' ') else '' end,
      case when c_custkey % 2 = 0 then concat('doi 10.5555/rec-', c_custkey, '; ') else '' end, 'year ', 1950 + c_custkey % 50, '.') as text from {customer}""",
    registry="""select concat('r', s_suppkey) as id, s_suppkey as k, cast(s_suppkey as int) as ord, concat('Topicone', s_suppkey % 7, 'q Wordtwo', s_suppkey, 'z') as title, concat('https://doi.org/10.5555/REC-', s_suppkey) as doi,
      concat('Surname', translate(cast(s_suppkey as string), '0123456789', 'abcdefghij'), ', X.') as authors, cast(1950 + s_suppkey % 50 as string) as year from {supplier}""",
)
def registry_weights(docs: DataFrame, registry: DataFrame) -> DataFrame:
    return matching.matched(docs.select("doc_id", "text"), registry.drop("k")).drop("contested")


# --- bundles -----------------------------------------------------------------------------------

_SUPPLEMENTS = """case o_orderkey % 8
  when 1 then concat('{{"id": "q', o_orderkey, '", "supplements": [{{"name": "s1", "title": "t", "exhibits": []}}]}}')
  when 2 then concat('{{"id": "p', o_orderkey, '", "supplements": []}}')
  when 3 then concat('{{"id": "p', o_orderkey, '", "supplements": [{{"name": "s1", "title": "t", "exhibits": []}}, {{"name": "s2", "title": "t", "exhibits": []}}]}}')
  when 4 then concat('{{"id": "p', o_orderkey, '", "supplements": [{{"name": "s1", "title": " ", "exhibits": []}}]}}')
  when 5 then concat('{{"id": "p', o_orderkey, '", "supplements": [{{"name": "s1", "title": "t", "exhibits": [{{"label": "f1", "caption": "c"}}]}}]}}')
  else concat('{{"id": "p', o_orderkey, '", "supplements": [{{"name": "s1", "title": "t", "exhibits": []}}]}}') end"""
_BUNDLES = f"""select cast(o_orderkey as string) as bundle_id, scope, dir, name, kind, content from (
select o_orderkey, '' as scope, '' as dir, '' as name, 'dir' as kind, null as content from {{orders}}
union all select o_orderkey, '', '', 'manifest.json', 'file', concat('{{{{"schema_version": 5, "id": "p', o_orderkey, '", "title": "t", "exhibits": []}}}}') from {{orders}}
union all select o_orderkey, '', '', 'text.md', 'file', 'text' from {{orders}}
union all select o_orderkey, '', '', 'supplements.json', 'file', {_SUPPLEMENTS} from {{orders}} where o_orderkey % 8 <> 6
union all select o_orderkey, '', '', 'supplements', 'dir', null from {{orders}}
union all select o_orderkey, '', 'supplements', 's1', 'dir', null from {{orders}}
union all select o_orderkey, '', 'supplements', 'loose.pdf', 'file', null from {{orders}} where o_orderkey % 5 = 0
union all select o_orderkey, 'supplements/s1/', '', 'text.md', 'file', case when o_orderkey % 9 = 0 then ' ' else 'text' end from {{orders}}
union all select o_orderkey, 'supplements/s1/', '', 'Figures', 'dir', null from {{orders}} where o_orderkey % 7 = 0) t"""


def _listed(files: DataFrame) -> DataFrame:
    none = F.lit(None)
    return files.select("bundle_id", "scope", "dir", "name", "kind", F.lit(False).alias("hidden"), F.lit(8).cast("long").alias("size"), none.cast("binary").alias("head"), "content", none.cast("string").alias("read_error"))


_SUPPLEMENT_SQL = """, b AS (SELECT DISTINCT bundle_id, bundle_id::BIGINT AS k FROM files), p AS (
    SELECT bundle_id, 'supplements' AS phase, '' AS scope, 'id_differs' AS rule, 'q' || k || ' p' || k AS detail FROM b WHERE k % 8 = 1
    UNION ALL SELECT bundle_id, 'supplements', '', 'supplements_empty', '' FROM b WHERE k % 8 = 2
    UNION ALL SELECT bundle_id, 'supplements', '', 'missing_directory', 's2' FROM b WHERE k % 8 = 3
    UNION ALL SELECT bundle_id, 'supplements', '', 'key_empty', 'supplements[0] title' FROM b WHERE k % 8 = 4
    UNION ALL SELECT bundle_id, 'supplements', '', 'no_declaration', 's1' FROM b WHERE k % 8 = 6
    UNION ALL SELECT bundle_id, 'supplements', '', 'loose_file', 'loose.pdf' FROM b WHERE k % 5 = 0
    UNION ALL SELECT bundle_id, 'contents', 'supplements/s1/', 'no_crop', 'f1' FROM b WHERE k % 8 = 5
    UNION ALL SELECT bundle_id, 'contents', 'supplements/s1/', 'empty', 'text.md' FROM b WHERE k % 9 = 0 AND k % 8 NOT IN (2, 4, 6)
    UNION ALL SELECT bundle_id, 'contents', 'supplements/s1/', 'miscased', 'Figures' FROM b WHERE k % 7 = 0 AND k % 8 NOT IN (2, 4, 6))"""


@query("validate_supplements", f"{_SUPPLEMENT_SQL} SELECT bundle_id, phase, scope, rule, detail FROM p", files=_BUNDLES)
def validate_supplements(files: DataFrame) -> DataFrame:
    return bundles.violations(_listed(files)).select("bundle_id", "phase", "scope", "rule", "detail")


@query(
    "bundle_verdicts",
    f"{_SUPPLEMENT_SQL} SELECT b.bundle_id, count(p.rule) = 0 AS valid, count(p.rule) AS problems FROM b LEFT JOIN p ON b.bundle_id = p.bundle_id GROUP BY b.bundle_id",
    files=_BUNDLES,
)
def bundle_verdicts(files: DataFrame) -> DataFrame:
    return bundles.judgements(_listed(files)).select("bundle_id", "valid", "problems")


_PROBLEMS = """select cast(l_orderkey as string) as bundle_id, case l_linenumber % 3 when 0 then 'binding' when 1 then 'manifest' else 'figures' end as phase, '' as scope, cast(l_linenumber as bigint) as ord,
      concat('rule', l_suppkey % 5) as rule, cast(l_partkey as string) as detail from {lineitem}"""
_RANKED = """SELECT *, CASE phase WHEN 'manifest' THEN 1 WHEN 'figures' THEN 2 ELSE 3 END AS pr FROM found"""


@query(
    "problem_lists",
    f", r AS ({_RANKED}) SELECT bundle_id, string_agg(phase || ' ' || rule || ' ' || detail, '|' ORDER BY pr, ord, phase || ' ' || rule || ' ' || detail) AS problems FROM r GROUP BY bundle_id",
    found=_PROBLEMS,
)
def problem_lists(found: DataFrame) -> DataFrame:
    return bundles.listed(found).select("bundle_id", F.array_join("problems", "|").alias("problems"))


@query(
    "first_problems",
    f", r AS ({_RANKED}), n AS (SELECT *, row_number() OVER (PARTITION BY bundle_id ORDER BY pr, ord, rule, detail) AS n FROM r) SELECT bundle_id, phase, rule, detail FROM n WHERE n = 1",
    found=_PROBLEMS,
)
def first_problems(found: DataFrame) -> DataFrame:
    return bundles.first_problem(found).select("bundle_id", "phase", "rule", "detail")


@query(
    "supplement_declarations",
    """SELECT doc_id, dir, CASE doc_id % 9 WHEN 1 THEN 'missing_file' WHEN 2 THEN 'json' WHEN 3 THEN 'duplicate_key' WHEN 4 THEN 'not_object' WHEN 5 THEN 'missing_key' WHEN 6 THEN 'unknown_key' WHEN 7 THEN 'name_differs' ELSE 'exhibits_type' END AS rule,
      CASE doc_id % 9 WHEN 3 THEN 'title' WHEN 5 THEN 'title' WHEN 6 THEN 'more' WHEN 7 THEN 'other' ELSE '' END AS detail FROM rows WHERE doc_id % 9 <> 0""",
    rows="""select o_orderkey as doc_id, 's1' as dir, case o_orderkey % 9 when 1 then null when 2 then '{{"name": ' when 3 then '{{"name": "s1", "title": "a", "title": "b", "exhibits": []}}' when 4 then '[1]'
      when 5 then '{{"name": "s1", "exhibits": []}}' when 6 then '{{"name": "s1", "title": "a", "exhibits": [], "more": 1}}' when 7 then '{{"name": "other", "title": "a", "exhibits": []}}'
      when 8 then '{{"name": "s1", "title": "a", "exhibits": 3}}' else '{{"name": "s1", "title": "a", "exhibits": []}}' end as raw from {orders}""",
)
def supplement_declarations(rows: DataFrame) -> DataFrame:
    return rules.declarations(rows)


@query(
    "supplement_collection",
    """SELECT doc_id, CASE WHEN doc_id % 3 <> 1 THEN 2 END::INT AS supplements, CASE WHEN doc_id % 3 = 1 THEN 's2 missing_file' ELSE '' END AS stop FROM (SELECT DISTINCT doc_id FROM rows)""",
    rows="""select o_orderkey as doc_id, 's2' as dir, case when o_orderkey % 3 = 1 then null else '{{"name": "s2", "title": "a", "exhibits": []}}' end as raw from {orders}
      union all select o_orderkey, 's1', '{{"name": "s1", "title": "a", "exhibits": []}}' from {orders}""",
)
def supplement_collection(rows: DataFrame) -> DataFrame:
    got = rules.collected(rows)
    return got.select("doc_id", F.when(F.col("supplements").isNotNull(), F.size("supplements")).alias("supplements"), "stop")


# --- witnesses and reports ---------------------------------------------------------------------


@query(
    "blocks_json",
    """, o AS (SELECT doc_id, count(DISTINCT page) AS n, string_agg('{"page":' || page || ',"index":' || index || ',"text":"' || text || '"' || CASE WHEN emphasis IS NULL THEN '' ELSE ',"emphasis":"' || emphasis || '"' END || '}', ',' ORDER BY page, index, text) AS own FROM blocks GROUP BY doc_id)
    SELECT doc_id, '{"page_count":' || n || ',"blocks":[' || own || ']}' AS json FROM o""",
    blocks="select l_orderkey as doc_id, cast(l_linenumber / 3 as int) + 1 as page, l_linenumber as index, concat('b', l_partkey) as text, case when l_partkey % 2 = 0 then 'bold' end as emphasis from {lineitem} where l_linenumber % 3 <> 2",
)
def blocks_json(blocks: DataFrame) -> DataFrame:
    return reports.blocks_json(blocks)


@query(
    "local_answers",
    "SELECT doc_id, page - 1 AS index, string_agg(text, chr(10) || chr(10) ORDER BY index, text) AS markdown FROM blocks GROUP BY doc_id, page",
    blocks="select l_orderkey as doc_id, cast(l_linenumber % 2 as int) + 1 as page, l_linenumber as index, concat('b', l_partkey) as text from {lineitem}",
)
def local_answers(blocks: DataFrame) -> DataFrame:
    return reports.local_answer(blocks).select("doc_id", F.inline("pages"))


@query(
    "ocr_outputs",
    ", g AS (SELECT doc_id FROM pages GROUP BY doc_id HAVING list_sort(list(index)) = range(0, count(*))) SELECT doc_id, index, markdown FROM pages WHERE doc_id IN (SELECT doc_id FROM g)",
    pages="select l_orderkey as doc_id, cast(case when l_orderkey % 3 = 0 then l_linenumber when l_orderkey % 5 = 0 and l_linenumber = 2 then 0 else l_linenumber - 1 end as bigint) as index, concat('m', l_partkey) as markdown from {lineitem}",
)
def ocr_outputs(pages: DataFrame) -> DataFrame:
    return rules.ocr_outputs(pages)


@query(
    "emphasis_pairs",
    ", n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY index) - 1 AS place FROM blocks WHERE NOT image) SELECT n.doc_id, n.page, n.index, s.emphasis FROM n LEFT JOIN styled s ON n.doc_id = s.doc_id AND n.page = s.page AND n.place = s.place",
    blocks="select l_orderkey as doc_id, 1 as page, l_linenumber as index, l_partkey % 4 = 0 as image from {lineitem}",
    styled="select l_orderkey as doc_id, 1 as page, l_linenumber - 1 as place, concat('e', l_suppkey) as emphasis from {lineitem} where l_linenumber % 2 = 1",
)
def emphasis_pairs(blocks: DataFrame, styled: DataFrame) -> DataFrame:
    return witness.with_emphasis(blocks, styled).select("doc_id", "page", "index", "emphasis")


@query(
    "block_counts",
    "SELECT d.doc_id, count(b.doc_id) AS blocks, count(b.doc_id) = 0 AS likely_scanned FROM docs d LEFT JOIN blocks b ON d.doc_id = b.doc_id GROUP BY d.doc_id",
    docs="select o_orderkey as doc_id from {orders}",
    blocks="select l_orderkey as doc_id from {lineitem} where l_orderkey % 7 <> 0",
)
def block_counts(docs: DataFrame, blocks: DataFrame) -> DataFrame:
    return witness.block_counts(docs, blocks)


@query(
    "has_body",
    "SELECT key, key % 2 = 0 AS has_body FROM articles",
    articles="select s_suppkey as key, concat('<article><body><p>', repeat('x', cast(case when s_suppkey % 2 = 0 then 1000 else 999 end as int)), '</p> </body></article>') as xml from {supplier}",
)
def has_body(articles: DataFrame) -> DataFrame:
    return jats.with_body(articles).select("key", "has_body")


@query("web_texts", "SELECT doc_id, 'm' || doc_id AS text FROM found WHERE doc_id % 4 = 3", found="select o_orderkey as doc_id, case o_orderkey % 4 when 0 then 'no_id' when 1 then 'no_article' when 2 then 'no_body' else 'found' end as status, concat('m', o_orderkey) as markdown from {orders}")
def web_texts(found: DataFrame) -> DataFrame:
    return rules.web_texts(found)


@query(
    "full_reference_report",
    """SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'nothing to check: no references heading found' WHEN 1 THEN 'nothing to check: no DOIs in the references section'
      ELSE '- 10.1/' || doc_id || chr(10) || '  text: e' || chr(10) || '  unresolved' || chr(10) || '0 resolved, 1 unresolved, 0 unanswered' END AS report FROM docs""",
    docs="select o_orderkey as doc_id, o_orderkey % 3 > 0 as has_section from {orders}",
)
def full_reference_report(docs: DataFrame) -> DataFrame:
    found = docs.where("doc_id % 3 = 2").select("doc_id", F.lit(0).alias("pos"), F.concat(F.lit("10.1/"), "doc_id").alias("doi"), F.lit("unresolved").alias("status"), F.lit(None).cast("string").alias("record"), F.lit("e").alias("entry"))
    return rules.full_reference_report(docs, found)


@query(
    "run_summaries",
    """SELECT run, count(*) FILTER (k % 5 IN (0, 4)) AS staged, count(*) FILTER (k % 5 IN (1, 2)) AS unresolved, count(*) FILTER (k % 5 = 3) AS failed,
      CASE WHEN count(*) FILTER (k % 5 = 3) > 0 THEN 1 WHEN count(*) FILTER (k % 5 IN (1, 2)) > 0 THEN 3 ELSE 0 END AS code FROM matches GROUP BY run""",
    matches="""select o_custkey as run, o_orderkey as k, not (o_orderkey % 5 = 3 and o_orderkey % 2 = 0) as readable, o_orderkey % 5 <> 1 as confident, o_orderkey % 5 = 2 as contested, o_orderkey % 5 <> 3 as staged from {orders}""",
)
def run_summaries(matches: DataFrame) -> DataFrame:
    return rules.run_summary(matches)


@query(
    "stage_lines",
    "SELECT id || chr(9) || path || chr(9) || action AS line FROM done",
    done="select concat('p', o_orderkey) as id, concat('/in/', o_orderkey) as path, case when o_orderkey % 2 = 0 then 'staged' else 'already' end as action from {orders}",
)
def stage_lines(done: DataFrame) -> DataFrame:
    return reports.stage_report(done)


@query("stamps", "SELECT key, strftime(make_timestamp(s * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') AS stamp FROM raw", raw="select o_orderkey as key, cast(1000000000 + o_orderkey * 7919 as bigint) as s from {orders}")
def stamps(raw: DataFrame) -> DataFrame:
    return raw.select("key", rules.stamp(F.col("s")).alias("stamp"))


# --- geometry ----------------------------------------------------------------------------------


@query(
    "crop_regions",
    """, u AS (SELECT label, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM boxes WHERE x0 < x1 AND y0 < y1 GROUP BY label),
    p AS (SELECT label, greatest(floor(x0 * 2), 0) AS x0, greatest(floor(y0 * 2), 0) AS y0, least(ceil(x1 * 2), 1200) AS x1, least(ceil(y1 * 2), 1600) AS y1 FROM u)
    SELECT label, x0::BIGINT AS x0, y0::BIGINT AS y0, x1::BIGINT AS x1, y1::BIGINT AS y1 FROM p WHERE x0 < x1 AND y0 < y1""",
    boxes="""select l_orderkey as label, cast(l_partkey % 700 as double) - 20.25 as x0, cast(l_suppkey % 90 as double) + 0.5 as y0, cast(l_partkey % 700 as double) - 20.25 + cast(l_quantity as double) - 10 as x1, cast(l_suppkey % 90 as double) + cast(l_linenumber as double) * 3 as y1,
      600.0 as w, 800.0 as h, 1200 as pw, 1600 as ph from {lineitem}""",
)
def crop_regions(boxes: DataFrame) -> DataFrame:
    got = geometry.regions(boxes, ["label"], ("w", "h"), ("pw", "ph"))
    return got.select("label", *[F.col(c).cast("long").alias(c) for c in ("x0", "y0", "x1", "y1")])


@query(
    "trimmed_images",
    """SELECT key, CASE WHEN key % 4 = 0 THEN NULL WHEN key % 4 = 1 THEN 0 ELSE greatest(x - 6, 0) END::INT AS x0, CASE WHEN key % 4 = 0 THEN NULL WHEN key % 4 = 1 THEN 0 ELSE greatest(y - 6, 0) END::INT AS y0,
      CASE WHEN key % 4 = 0 THEN NULL WHEN key % 4 = 1 THEN 40 ELSE least(x + 3 + 6, 40) END::INT AS x1, CASE WHEN key % 4 = 0 THEN NULL WHEN key % 4 = 1 THEN 30 ELSE least(y + 2 + 6, 30) END::INT AS y1 FROM images""",
    images="select s_suppkey as key, cast(1 + s_suppkey % 35 as int) as x, cast(1 + s_suppkey % 26 as int) as y from {supplier}",
)
def trimmed_images(images: DataFrame) -> DataFrame:
    # Grey pages of 40 by 30 with a dark block of 3 by 2; one corner differs where key % 4 = 1.
    places = F.sequence(F.lit(0), F.lit(1199))
    dark = lambda i: (F.col("key") % 4 > 0) & (i % 40 >= F.col("x")) & (i % 40 < F.col("x") + 3) & (F.floor(i / 40) >= F.col("y")) & (F.floor(i / 40) < F.col("y") + 2)
    value = F.transform(places, lambda i: F.when((i == 0) & (F.col("key") % 4 == 1), "10").when(dark(i), "00").otherwise("F0"))
    made = images.select("key", F.lit(40).alias("width"), F.lit(30).alias("height"), F.unhex(F.array_join(value, "")).alias("pixels"))
    return geometry.trimmed_boxes(made, "key")


@query(
    "page_spaces",
    "SELECT doc_id, page, label FROM crops WHERE doc_id % 4 = 1",
    crops="select o_orderkey as doc_id, 1 as page, concat('f', o_orderkey) as label, case when o_orderkey % 4 = 1 then 601.0 else 600.0 end as width, 800.0 as height from {orders}",
    pages="select o_orderkey as doc_id, 1 as page, 600.0 as width, 800.0 as height from {orders}",
)
def page_spaces(crops: DataFrame, pages: DataFrame) -> DataFrame:
    return rules.page_space(crops, pages)


# --- acceptance rules --------------------------------------------------------------------------

_UNITS = """select o_orderkey as doc_id, n as index, case when o_orderkey % 6 = 1 and n = 2 then 4 when o_orderkey % 6 = 2 and n = 1 then 2 else n end as page_start, case when o_orderkey % 6 = 1 and n = 2 then 4 when o_orderkey % 6 = 2 and n = 1 then 2 else n end as page_end,
      case when n = 1 and o_orderkey % 6 <> 3 then 1 else 2 end as depth, case when o_orderkey % 6 = 4 and n = 3 then 'odd' else 'section' end as kind, 'a' as opening, case when o_orderkey % 6 = 5 and n = 2 then ' ' else 'b' end as closing
      from {orders} cross join (select 1 as n union all select 2 union all select 3) t"""


@query(
    "unit_rules",
    """SELECT doc_id, unnest(CASE doc_id % 6 WHEN 1 THEN ['gap'] WHEN 2 THEN ['first_page'] WHEN 3 THEN ['title_depth'] WHEN 4 THEN ['kind'] WHEN 5 THEN ['edge_words'] ELSE [] END) AS rule FROM docs
      UNION ALL SELECT doc_id, 'last_page' FROM docs WHERE doc_id % 10 = 0""",
    units=_UNITS,
    docs="select o_orderkey as doc_id, case when o_orderkey % 10 = 0 then 9 else 3 end as pages from {orders}",
)
def unit_rules(units: DataFrame, docs: DataFrame) -> DataFrame:
    return rules.unit_rules(units, docs)


_TEXTS = "select o_orderkey as doc_id, concat('# Title', chr(10), chr(10), 'Some *prose* of ', o_orderkey, '.', chr(10), chr(10), '## Methods', chr(10), chr(10), '[TABLE 1. Counts]', chr(10), chr(10), 'Running head', chr(10), chr(10), '- one', chr(10), '- two') as text from {orders}"


@query(
    "missing_headings",
    "SELECT doc_id, index, heading FROM units WHERE (index = 2 AND doc_id % 2 = 0) OR index = 3",
    units="select o_orderkey as doc_id, 1 as index, 1 as depth, 'Title' as heading from {orders} union all select o_orderkey, 2, case when o_orderkey % 2 = 0 then 3 else 2 end, 'Methods' from {orders} union all select o_orderkey, 3, 2, 'Absent' from {orders}",
    texts=_TEXTS,
)
def missing_headings(units: DataFrame, texts: DataFrame) -> DataFrame:
    return rules.missing_headings(units, texts)


@query(
    "edge_words",
    "SELECT doc_id, index, CASE WHEN doc_id % 3 = 1 THEN 'opening' ELSE 'closing' END AS rule FROM units WHERE doc_id % 3 <> 0",
    units="""select o_orderkey as doc_id, 1 as index, concat('The inter-', chr(10), 'action of *cells* ended', chr(10), 'here.') as slice, case when o_orderkey % 3 = 1 then 'A interaction' else 'The interaction of' end as opening, case when o_orderkey % 3 = 2 then 'there.' else 'cells ended here.' end as closing from {orders}""",
)
def edge_words(units: DataFrame) -> DataFrame:
    return rules.edge_words(units)


@query(
    "sentinel_rules",
    "SELECT doc_id, 't1' AS label, CASE doc_id % 4 WHEN 1 THEN 'missing' WHEN 2 THEN 'section' ELSE 'paragraph' END AS rule FROM docs WHERE doc_id % 4 <> 0",
    docs="select o_orderkey as doc_id from {orders}",
    exhibits="select o_orderkey as doc_id, 1 as pos, 't1' as label, 'Table 1' as printed, case when o_orderkey % 4 = 1 then 'Other' else 'Counts' end as caption, case when o_orderkey % 4 = 2 then 'Results' else 'Methods' end as section from {orders}",
    texts="select o_orderkey as doc_id, concat('# Title', chr(10), chr(10), '## Methods', chr(10), chr(10), case when o_orderkey % 4 = 3 then 'See ' else '' end, '[TABLE 1. Counts]', chr(10), chr(10), 'end') as text from {orders}",
)
def sentinel_rules(docs: DataFrame, exhibits: DataFrame, texts: DataFrame) -> DataFrame:
    return rules.sentinel_rules(exhibits, texts)


@query(
    "prose_rules",
    """SELECT doc_id, 'missing' AS rule, part FROM parts WHERE doc_id % 3 = 1 UNION ALL SELECT doc_id, 'furniture', 'Running head' FROM parts WHERE doc_id % 3 <> 1 OR true""",
    parts="select o_orderkey as doc_id, case when o_orderkey % 3 = 1 then 'No such line' else 'Title' end as part from {orders}",
    texts=_TEXTS,
)
def prose_rules(parts: DataFrame, texts: DataFrame) -> DataFrame:
    lost = acceptance.not_in_text(parts, texts, "doc_id", "part").select("doc_id", F.lit("missing").alias("rule"), "part")
    heads = parts.select("doc_id", F.lit("Running head").alias("part"))
    return lost.union(acceptance.in_text(heads, texts, "doc_id", "part").select("doc_id", F.lit("furniture").alias("rule"), "part"))


@query("reference_counts", "SELECT doc_id, 2::BIGINT AS n_references FROM texts", texts=_TEXTS)
def reference_counts(texts: DataFrame) -> DataFrame:
    return acceptance.reference_counts(texts, "doc_id").withColumnRenamed("references", "n_references")


@query(
    "suspect_characters",
    "SELECT doc_id, (doc_id % 3)::BIGINT AS soft_hyphens, (doc_id % 2)::BIGINT AS zero_width, (doc_id % 4)::BIGINT AS broken_words FROM texts",
    texts="select o_orderkey as doc_id, concat(repeat(concat('so', chr(173), 'ft '), cast(o_orderkey % 3 as int)), repeat(concat('a', '​', 'b '), cast(o_orderkey % 2 as int)), repeat(concat('bro-', chr(10), 'ken '), cast(o_orderkey % 4 as int)), 'well-known') as text from {orders}",
)
def suspect_characters(texts: DataFrame) -> DataFrame:
    return acceptance.suspect_characters(texts, "doc_id").select("doc_id", *[F.col(c).cast("long").alias(c) for c in ("soft_hyphens", "zero_width", "broken_words")])


@query(
    "uncovered_pages",
    "SELECT doc_id, p AS page FROM (SELECT doc_id, unnest(range(1, pages + 1)) AS p FROM docs) t WHERE NOT EXISTS (SELECT 1 FROM units u WHERE u.doc_id = t.doc_id AND t.p BETWEEN u.page_start AND u.page_end)",
    units="select l_orderkey as doc_id, l_linenumber as page_start, l_linenumber + l_partkey % 2 as page_end from {lineitem} where l_linenumber % 3 <> 0",
    docs="select o_orderkey as doc_id, 8 as pages from {orders}",
)
def uncovered_pages(units: DataFrame, docs: DataFrame) -> DataFrame:
    return acceptance.uncovered_pages(units, docs, "doc_id")


@query(
    "supplement_separation",
    "SELECT doc_id, CASE WHEN part = 'Some prose of' THEN 'prose' ELSE 'label' END AS rule, part AS detail FROM (SELECT doc_id, part FROM parts WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, label FROM labels WHERE doc_id % 3 = 0)",
    parts="select o_orderkey as doc_id, case when o_orderkey % 2 = 0 then 'Some prose of' else 'Prose apart' end as part from {orders}",
    labels="select o_orderkey as doc_id, 's1' as supplement, case when o_orderkey % 3 = 0 then 'f1' else 's1_f1' end as label from {orders}",
    texts=_TEXTS,
)
def supplement_separation(parts: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    return rules.supplement_separation(parts, texts, labels)


@query(
    "transcribed_figures",
    "SELECT e.doc_id, e.label FROM exhibits e WHERE e.kind = 'figure' AND EXISTS (SELECT 1 FROM transcriptions t WHERE e.doc_id = t.doc_id AND e.label = t.label)",
    exhibits="select l_orderkey as doc_id, concat('x', l_linenumber) as label, case when l_partkey % 2 = 0 then 'figure' else 'table' end as kind from {lineitem}",
    transcriptions="select l_orderkey as doc_id, concat('x', l_linenumber) as label from {lineitem} where l_suppkey % 3 <> 0",
)
def transcribed_figures(exhibits: DataFrame, transcriptions: DataFrame) -> DataFrame:
    return rules.transcribed_figures(exhibits, transcriptions)


@query(
    "note_flags",
    "SELECT doc_id, label FROM exhibits WHERE footnote <> (notes IS NOT NULL)",
    exhibits="select l_orderkey as doc_id, concat('x', l_linenumber) as label, l_partkey % 2 = 0 as footnote, case when l_partkey % 3 = 0 then 'n' end as notes from {lineitem}",
)
def note_flags(exhibits: DataFrame) -> DataFrame:
    return acceptance.unequal_flags(exhibits, "doc_id")


@query(
    "triage_rules",
    """SELECT doc_id, CASE doc_id % 5 WHEN 1 THEN 'classification' WHEN 2 THEN 'character_source' ELSE 'page_count' END AS rule FROM triage WHERE doc_id % 5 IN (1, 2, 3)""",
    triage="""select o_orderkey as doc_id, case o_orderkey % 5 when 1 then 'typed' when 4 then 'scanned' else 'born_digital' end as classification, case when o_orderkey % 5 in (2, 4) then 'ocr' else 'text_layer' end as character_source, case when o_orderkey % 5 = 3 then 0 else 7 end as page_count from {orders}""",
)
def triage_rules(triage: DataFrame) -> DataFrame:
    return rules.triage_rules(triage)


@query(
    "sweep_findings",
    "SELECT doc_id, 'omission' AS kind, page, 'lost ' || page AS finding FROM raw WHERE doc_id % 2 = 0",
    raw="select o_orderkey as doc_id, cast(o_orderkey % 40 + 1 as int) as page, case when o_orderkey % 2 = 0 then concat('[omission] page ', o_orderkey % 40 + 1, ': lost ', o_orderkey % 40 + 1) else '[other] page 1: x' end as line from {orders}",
)
def sweep_findings(raw: DataFrame) -> DataFrame:
    return acceptance.sweep_findings(raw, "doc_id")


@query(
    "disagreements",
    "SELECT doc_id, page, pos, array_to_string(list_sort(list(DISTINCT witness || ': ' || reading)), '; ') AS readings FROM witnesses GROUP BY doc_id, page, pos HAVING count(DISTINCT reading) > 1",
    witnesses="""select l_orderkey as doc_id, 1 as page, l_linenumber as pos, 'layer' as witness, concat('w', l_partkey) as reading from {lineitem}
      union all select l_orderkey, 1, l_linenumber, 'ocr', case when l_suppkey % 4 = 0 then concat('w', l_suppkey) else concat('w', l_partkey) end from {lineitem}""",
)
def disagreements(witnesses: DataFrame) -> DataFrame:
    return rules.disagreements(witnesses).select("doc_id", "page", "pos", F.array_join("readings", "; ").alias("readings"))


@query(
    "file_digests",
    "SELECT key, sha256(body) AS digest FROM raw",
    raw="select c_custkey as key, concat(c_name, c_mktsegment) as body from {customer}",
)
def file_digests(raw: DataFrame) -> DataFrame:
    return raw.select("key", staging.digest(F.col("body").cast("binary")).alias("digest"))


# --- table functions ---------------------------------------------------------------------------


@query(
    "nested_duplicates",
    """SELECT key, 0 AS seq, '' AS position, 'a' AS name FROM src WHERE key % 4 = 1 UNION ALL SELECT key, 0, 'b', 'c' FROM src WHERE key % 4 = 2
      UNION ALL SELECT key, 0, '', 'b' FROM src WHERE key % 4 = 3 UNION ALL SELECT key, 1, 'l[1]', 'x' FROM src WHERE key % 4 = 3 UNION ALL SELECT key, 2, 'replaced', 'd' FROM src WHERE key % 4 = 3""",
    src="""select s_suppkey as key, case s_suppkey % 4 when 0 then '{{"a": 1}}' when 1 then '{{"a": 1, "a": 2}}' when 2 then '{{"b": {{"c": 1, "c": 1}}}}'
      else '{{"b": {{"d": 1, "d": 2}}, "b": 1, "l": [1, {{"x": 1, "x": 2}}]}}' end as raw from {supplier}""",
)
def nested_duplicates(src: DataFrame) -> DataFrame:
    tables.register(src.sparkSession)
    return src.sparkSession.sql("select key, t.* from {src}, lateral strict_json(raw) t", src=src)


@query(
    "table_functions",
    """SELECT key, 'event' AS made, count_ AS n FROM (SELECT key, 7 + 3 * (key % 3) AS count_ FROM src) UNION ALL SELECT key, 'cell', 1 + key % 3 FROM src UNION ALL SELECT key, 'line', 1 FROM src""",
    src="select s_suppkey as key, concat('<table><tr><td>a</td>', repeat('<td>b</td>', cast(s_suppkey % 3 as int)), '</tr></table>') as html, concat('<a><body><p>t', s_suppkey, '</p></body></a>') as xml from {supplier}",
)
def table_functions(src: DataFrame) -> DataFrame:
    tables.register(src.sparkSession)
    made = [("event", "html_events(html)"), ("cell", "grid_cells(html)"), ("line", "jats_lines(xml)")]
    parts = [f"select key, '{name}' as made, count(*) as n from {{src}}, lateral {call} t group by key" for name, call in made]
    return src.sparkSession.sql(" union all ".join(parts), src=src)

"""The query catalogue: each query as a Spark plan over our operators, and as DuckDB SQL.

Inputs that the driver tables lack are derived from them, with planted faults. A derivation is
one text that both engines run; the operator under test and its oracle are separate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions import columns as C
from quillmark.operators import acceptance, bundles, geometry, grid, integrity, jats, markup, matching, reports, staging, witness
from quillmark.sources import registry as registries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """The rows of a derivation: SQL in which {name} stands for a driver table."""
    names = {n: table(spark, sf_dir, n) for n in TABLES if "{" + n + "}" in text}
    return spark.sql(text, **names)


def _in_duckdb(text: str) -> str:
    for n in TABLES:
        text = text.replace("{" + n + "}", n)
    return text.replace("{{", "{").replace("}}", "}")


def query(name: str, oracle: str | None = None, **inputs: str):
    """Registers fn(inputs as DataFrames) under a name; the oracle reads the inputs as CTEs."""

    def register(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(**{k: derived(spark, sf_dir, v) for k, v in inputs.items()})
        if oracle is not None:
            with_ = ", ".join(f"{k} AS ({_in_duckdb(v)})" for k, v in inputs.items())
            ORACLE_SQL[name] = f"WITH {with_} {oracle}"
        return fn

    return register


# --- names -------------------------------------------------------------------------------------

NAMES = """
select 'part' as src, p_partkey as key, case p_partkey % 6
  when 0 then p_name when 1 then replace(p_name, ' ', '_') when 2 then concat('.', replace(p_name, ' ', '_'))
  when 3 then concat(replace(p_name, ' ', '_'), chr(10)) when 4 then '..' else '_-_' end as name from {part}
union all select 'customer', c_custkey, c_name from {customer}
union all select 'supplier', s_suppkey, concat(s_name, '/', s_nationkey) from {supplier}
"""


@query(
    "name_rule",
    """SELECT src, key, CASE WHEN NOT regexp_full_match(name, '[A-Za-z0-9._-]+') THEN 'pattern'
    WHEN NOT regexp_matches(name, '[A-Za-z0-9]') THEN 'punctuation' WHEN starts_with(name, '.') THEN 'dot' END AS rule FROM names""",
    names=NAMES,
)
def name_rule(names: DataFrame) -> DataFrame:
    return names.select("src", "key", C.name_rule(F.col("name")).alias("rule"))


# --- bindings ----------------------------------------------------------------------------------

DECLARED = "select doc_id % 50 as bundle_id, doc_id as label from {documents}"
PRESENT = "select doc_id % 50 as bundle_id, case when doc_id % 7 = 0 then -doc_id else doc_id end as label from {labels}"
SKELETON = "select doc_id % 50 as bundle_id, case when doc_id % 11 = 0 then doc_id + 1000000 else doc_id end as label from {documents}"
TRANSCRIBED = "select doc_id % 50 as bundle_id, case when quality = 0 then doc_id + 5000000 else doc_id end as label from {labels}"
KEYS = ["bundle_id", "label"]


@query("binding_missing", "SELECT * FROM declared EXCEPT SELECT * FROM present", declared=DECLARED, present=PRESENT)
def binding_missing(declared: DataFrame, present: DataFrame) -> DataFrame:
    return integrity.missing(declared, present, KEYS)


@query("binding_undeclared", "SELECT * FROM present EXCEPT SELECT * FROM declared", declared=DECLARED, present=PRESENT)
def binding_undeclared(declared: DataFrame, present: DataFrame) -> DataFrame:
    return integrity.undeclared(declared, present, KEYS)


@query("table_binding", "SELECT * FROM transcribed EXCEPT SELECT * FROM declared", declared=DECLARED, transcribed=TRANSCRIBED)
def table_binding(declared: DataFrame, transcribed: DataFrame) -> DataFrame:
    return integrity.undeclared(declared, transcribed, KEYS)


@query(
    "binding_full",
    """SELECT bundle_id, label, bool_or(s = 1) AS in_manifest, bool_or(s = 2) AS in_crops, bool_or(s = 3) AS in_skeleton FROM
    (SELECT *, 1 AS s FROM declared UNION ALL SELECT *, 2 FROM present UNION ALL SELECT *, 3 FROM skeleton) GROUP BY ALL HAVING count(DISTINCT s) < 3""",
    declared=DECLARED,
    present=PRESENT,
    skeleton=SKELETON,
)
def binding_full(declared: DataFrame, present: DataFrame, skeleton: DataFrame) -> DataFrame:
    return integrity.bound({"manifest": declared, "crops": present, "skeleton": skeleton}, KEYS)


LABELS = """
select l_orderkey as bundle_id, case when l_linenumber <= 2 then 0 else l_linenumber end as turn, l_linenumber as pos,
  case when l_linenumber <= 2 then 'manifest' else concat('supplement ', l_linenumber) end as declarer, concat('p', l_partkey % 5) as label from {lineitem}
"""


@query(
    "label_uniqueness",
    """SELECT bundle_id, pos, label, first_declarer FROM (SELECT *, first_value(declarer) OVER w AS first_declarer, row_number() OVER w AS n
    FROM labels WINDOW w AS (PARTITION BY bundle_id, label ORDER BY turn, pos)) WHERE n > 1""".replace("FROM labels", "FROM used"),
    used=LABELS,
)
def label_uniqueness(used: DataFrame) -> DataFrame:
    return integrity.later_declarations(used, ["bundle_id", "label"], ["turn", "pos"], "declarer").select("bundle_id", "pos", "label", "first_declarer")


@query(
    "duplicate_in_list",
    "SELECT bundle_id, pos, label, first_pos FROM (SELECT *, min(pos) OVER w AS first_pos, row_number() OVER w AS n FROM used WINDOW w AS (PARTITION BY bundle_id, label ORDER BY pos)) WHERE n > 1",
    used="select l_orderkey as bundle_id, l_linenumber as pos, l_suppkey % 9 as label from {lineitem}",
)
def duplicate_in_list(used: DataFrame) -> DataFrame:
    out = integrity.later_declarations(used, ["bundle_id", "label"], ["pos"], "pos")
    return out.select("bundle_id", "pos", "label", F.col("first_declarer").alias("first_pos"))


@query(
    "identity_equality",
    "SELECT bundle_id, m.id AS left_value, s.id AS right_value FROM manifests m JOIN supplements s USING (bundle_id) WHERE m.id <> s.id",
    manifests="select o_orderkey as bundle_id, concat('paper-', o_custkey) as id from {orders}",
    supplements="select o_orderkey as bundle_id, case when o_orderkey % 13 = 0 then null when o_orderkey % 7 = 0 then concat('paper_', o_custkey) else concat('paper-', o_custkey) end as id from {orders}",
)
def identity_equality(manifests: DataFrame, supplements: DataFrame) -> DataFrame:
    return integrity.unequal(manifests, supplements, "bundle_id", "id")


RAW = """
select event_id, case event_id % 7 when 0 then props when 1 then concat('{{"k": 1, "extra": ', event_id, '}}')
  when 2 then '{{"x": 1}}' when 3 then '{{"k": "s"}}' when 4 then '{{"k": 1, "k": 2, "y": 0}}' when 5 then '[1]' else '{{"k": true}}' end as raw from {events}
"""


@query(
    "contract_fields",
    """, v AS (SELECT event_id, raw, json_type(raw) = 'OBJECT' AS obj, json_keys(raw) AS ks FROM raws),
    d AS (SELECT *, len(ks) > len(list_distinct(ks)) AS twice FROM v)
    SELECT event_id, NULL::VARCHAR AS field, 'json' AS rule FROM d WHERE NOT obj
    UNION ALL SELECT DISTINCT event_id, k, 'duplicate' FROM (SELECT event_id, ks, unnest(ks) AS k FROM d WHERE obj AND twice) WHERE len(list_filter(ks, lambda x: x = k)) > 1
    UNION ALL SELECT event_id, k, 'unknown' FROM (SELECT event_id, unnest(ks) AS k FROM d WHERE obj AND NOT twice) WHERE k <> 'k'
    UNION ALL SELECT event_id, 'k', 'missing' FROM d WHERE obj AND NOT twice AND NOT list_contains(ks, 'k')
    UNION ALL SELECT event_id, 'k', 'type' FROM d WHERE obj AND NOT twice AND list_contains(ks, 'k') AND json_type(raw, '$.k') NOT IN ('BIGINT', 'UBIGINT')""",
    raws=RAW,
)
def contract_fields(raws: DataFrame) -> DataFrame:
    return integrity.contract_fields(raws, "event_id", "raw", {"k": ("BIGINT", True)})


@query(
    "dup_json_keys",
    "SELECT o_orderkey, k AS field FROM (SELECT o_orderkey, unnest(json_keys(raw)) AS k FROM raws) GROUP BY ALL HAVING count(*) > 1",
    raws="""select o_orderkey, case o_orderkey % 3 when 0 then concat('{{"id": ', o_orderkey, ', "id": 0, "t": 1}}')
      when 1 then concat('{{"id": ', o_orderkey, ', "t": {{"id": 1}}}}') else '{{"a": 1, "b": 2, "a": 3, "b": 4}}' end as raw from {orders}""",
)
def dup_json_keys(raws: DataFrame) -> DataFrame:
    out = integrity.contract_fields(raws, "o_orderkey", "raw", {"id": ("BIGINT", False)})
    return out.where("rule = 'duplicate'").select("o_orderkey", "field")


# --- registry ----------------------------------------------------------------------------------

_STOP = ", ".join(f"'{w}'" for w in C.STOP_WORDS)
_WORDS = f"list_distinct(list_filter(regexp_extract_all(lower(%s), '[a-z0-9]+'), lambda w: len(w) > 2 AND NOT list_contains([{_STOP}], w)))"
_SCORED = f""", reg AS (SELECT item_id AS id, {_WORDS % "text"} AS ws FROM items),
doc AS (SELECT doc_id, {_WORDS % "text"} AS ws FROM docs),
rw AS (SELECT id, len(ws) AS n, unnest(ws) AS w FROM reg), dw AS (SELECT doc_id, unnest(ws) AS w FROM doc),
hit AS (SELECT doc_id, id, count(*) / n AS overlap, 50 * (count(*) / n) AS score FROM dw JOIN rw USING (w) GROUP BY doc_id, id, n),
full_ AS (SELECT * FROM hit UNION ALL SELECT doc_id, (SELECT min(id) FROM reg WHERE len(ws) > 0 OR true), 0.0, 0.0 FROM docs WHERE doc_id NOT IN (SELECT doc_id FROM hit)),
ranked AS (SELECT *, row_number() OVER w AS place, lead(score, 1, 0.0) OVER w AS runner_up FROM full_ WINDOW w AS (PARTITION BY doc_id ORDER BY score DESC, id)),
best AS (SELECT *, score - runner_up AS margin, score - runner_up > 0 AND overlap >= 0.7 AND score - runner_up >= 15 AS confident FROM ranked WHERE place = 1)"""


def _registry(items: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    return items.select(F.col("item_id").alias("id"), F.col("item_id").alias("ord"), F.col("text").alias("title"), none.alias("doi"), none.alias("authors"), none.alias("year"))


ITEMS, DOCS = "select item_id, text from {benchmark}", "select doc_id, text from {documents}"


@query(
    "registry_match",
    _SCORED + """ SELECT doc_id, id AS best_id, round(score, 6) AS score, round(margin, 6) AS margin, confident,
    confident AND count(*) FILTER (confident) OVER (PARTITION BY id) > 1 AS contested FROM best""",
    docs=DOCS,
    items=ITEMS,
)
def registry_match(docs: DataFrame, items: DataFrame) -> DataFrame:
    out = matching.matched(docs, _registry(items))
    return out.withColumn("score", F.round("score", 6)).withColumn("margin", F.round("margin", 6))


@query("registry_top3", _SCORED + " SELECT doc_id, place, id, round(score, 6) AS score FROM ranked WHERE place <= 3", docs=DOCS, items=ITEMS)
def registry_top3(docs: DataFrame, items: DataFrame) -> DataFrame:
    return matching.top(docs, _registry(items)).withColumn("score", F.round("score", 6))


# --- references --------------------------------------------------------------------------------

REFERENCES = """
select doc_id, concat('# Title 10.9999/not', chr(10), case when doc_id % 5 = 0 then '## Other' else '## References' end, chr(10),
  '- First. 10.1234/ab', doc_id, '.', chr(10), '- Second (https://doi.org/10.1234/AB', doc_id % 97, ');', chr(10),
  '- Third 10.1234/ab', doc_id % 97, ', and 10.55555/x[', doc_id, ']', chr(10), 'tail') as text from {documents}
"""
_DOIS = """, s AS (SELECT doc_id, regexp_extract(text, '(?ims)^#{1,6}\\s+references\\b(.*)', 1) AS section FROM refs),
f AS (SELECT doc_id, regexp_extract_all(section, '10\\.\\d{4,9}/[^\\s"''<>\\[\\]]+') AS found, section FROM s),
e AS (SELECT doc_id, section, generate_subscripts(found, 1) - 1 AS pos, rtrim(unnest(found), '.,;:!?)]}>"''') AS doi FROM f)"""


@query("doi_extract", _DOIS + " SELECT doc_id, pos::INT AS pos, doi FROM e", refs=REFERENCES)
def doi_extract(refs: DataFrame) -> DataFrame:
    return witness.reference_dois(refs)


@query("doi_distinct", _DOIS + " SELECT doc_id, pos::INT AS pos, doi FROM e QUALIFY row_number() OVER (PARTITION BY doc_id, lower(doi) ORDER BY pos) = 1", refs=REFERENCES)
def doi_distinct(refs: DataFrame) -> DataFrame:
    return witness.distinct_dois(witness.reference_dois(refs))


@query(
    "doi_entry",
    _DOIS + """, l AS (SELECT doc_id, generate_subscripts(string_split(section, chr(10)), 1) AS n, unnest(string_split(section, chr(10))) AS line FROM s)
    SELECT doc_id, pos::INT AS pos, doi, arg_min(trim(line), n) AS entry FROM e JOIN l USING (doc_id) WHERE contains(line, doi) GROUP BY ALL""",
    refs=REFERENCES,
)
def doi_entry(refs: DataFrame) -> DataFrame:
    return witness.entries(refs, witness.reference_dois(refs))


@query(
    "doi_boundary",
    "SELECT doc_id, regexp_matches(flat, replace(doi, '.', '\\.') || '($|[^0-9a-z/_.-]|\\.($|[^\\p{L}\\p{N}]))') AS printed FROM texts",
    texts="""select doc_id, concat('10.1234/x', doc_id % 10) as doi, concat('see10.1234/x', doc_id % 10,
      case doc_id % 5 when 0 then '.pub2' when 1 then '.' when 2 then 'a' when 3 then ');next' else '.é' end) as flat from {documents}""",
)
def doi_boundary(texts: DataFrame) -> DataFrame:
    return texts.select("doc_id", C.doi_printed(F.col("doi"), F.col("flat")).alias("printed"))


@query(
    "doi_status",
    """, j AS (SELECT doc_id, CASE WHEN status BETWEEN 200 AND 299 THEN 1 WHEN status IN (404, 410) THEN 2 ELSE 3 END AS s FROM found LEFT JOIN answers USING (doi))
    SELECT doc_id, count(*) FILTER (s = 1) AS resolved, count(*) FILTER (s = 2) AS unresolved, count(*) FILTER (s = 3) AS unanswered,
    (count(*) FILTER (s = 3) > 0)::INT AS exit_code FROM j GROUP BY doc_id""",
    found="select l_orderkey as doc_id, concat('10.1/', l_partkey) as doi from {lineitem}",
    answers="select concat('10.1/', p_partkey) as doi, case p_partkey % 5 when 0 then 404 when 1 then 503 when 2 then 410 when 3 then null else 200 end as status from {part}",
)
def doi_status(found: DataFrame, answers: DataFrame) -> DataFrame:
    return witness.status_report(witness.with_status(found, answers))


# --- pages' markup -----------------------------------------------------------------------------

PAGES = "select page_id, url, html from {pages}"
_HOST = "regexp_extract(url, '://([^/?#]*)', 1)"


@query(
    "furniture",
    f""", b AS (SELECT {_HOST} AS host, page_id, unnest(regexp_extract_all(html, '(<[a-z0-9]+)', 1)) AS block FROM web),
    p AS (SELECT host, count(DISTINCT page_id) AS pages FROM b GROUP BY host), s AS (SELECT host, block, count(DISTINCT page_id) AS shown FROM b GROUP BY ALL)
    SELECT host, block, pages FROM s JOIN p USING (host) WHERE shown = pages AND pages > 1""",
    web=PAGES,
)
def furniture(web: DataFrame) -> DataFrame:
    host = F.regexp_extract("url", "://([^/?#]*)", 1)
    blocks = web.select(host.alias("host"), "page_id", F.explode(F.regexp_extract_all("html", F.lit("(<[a-z0-9]+)"), F.lit(1))).alias("block"))
    return witness.on_every_page(blocks, ["host"], "page_id", "block")


_TAGS = ", t AS (SELECT page_id, unnest(regexp_extract_all(html, '(</?[a-zA-Z][a-zA-Z0-9]*)', 1)) AS x FROM web), n AS (SELECT page_id, lower(replace(substr(x, 2), '/', '')) AS tag, x[2] = '/' AS closing FROM t)"


def _tags(web: DataFrame) -> DataFrame:
    found = web.select("page_id", F.explode(F.regexp_extract_all("html", F.lit("(</?[a-zA-Z][a-zA-Z0-9]*)"), F.lit(1))).alias("x"))
    return found.select("page_id", F.lower(F.regexp_replace("x", "[</]", "")).alias("tag"), F.col("x").startswith("</").alias("closing"))


@query("tag_balance", _TAGS + " SELECT page_id, tag, count(*) FILTER (NOT closing) AS opened, count(*) FILTER (closing) AS closed FROM n GROUP BY ALL HAVING opened <> closed", web=PAGES)
def tag_balance(web: DataFrame) -> DataFrame:
    by = _tags(web).groupBy("page_id", "tag")
    return by.agg(F.count_if(~F.col("closing")).alias("opened"), F.count_if("closing").alias("closed")).where("opened <> closed")


@query(
    "refused_elements",
    _TAGS + " SELECT tag, count(DISTINCT page_id) AS pages, count(*) AS uses FROM n WHERE NOT closing AND tag NOT IN ('table','thead','tbody','tr','th','td','sup','sub','br','em','strong') GROUP BY tag",
    web=PAGES,
)
def refused_elements(web: DataFrame) -> DataFrame:
    refused = _tags(web).where(~F.col("closing") & ~F.col("tag").isin(*markup.ALLOWED))
    return refused.groupBy("tag").agg(F.count_distinct("page_id").alias("pages"), F.count(F.lit(1)).alias("uses"))


@query(
    "markup_decls",
    "SELECT page_id, len(regexp_extract_all(html, '<!--'))::INT AS comments, len(regexp_extract_all(html, '(?i)<!doctype'))::INT AS declarations, len(regexp_extract_all(html, '(?i)<script'))::INT AS scripts FROM web",
    web=PAGES,
)
def markup_decls(web: DataFrame) -> DataFrame:
    n = lambda p: F.size(F.regexp_extract_all("html", F.lit(p), F.lit(0)))
    return web.select("page_id", n("<!--").alias("comments"), n("(?i)<!doctype").alias("declarations"), n("(?i)<script").alias("scripts"))


# --- grids -------------------------------------------------------------------------------------

CELLS_SQL = """
select l_orderkey as file, l_linenumber as cell_seq, cast(floor((l_linenumber - 1) / 3) as int) as `row`, cast((l_linenumber - 1) % 3 + (case when l_partkey % 11 = 0 then 1 else 0 end) as int) as col,
  cast(1 + (case when l_partkey % 7 = 0 then 2 else 0 end) as int) as rowspan, cast(1 + (case when l_suppkey % 5 = 0 then 1 else 0 end) as int) as colspan from {lineitem}
"""
WRITTEN_SQL = """
select l_orderkey as file, cast(max(floor((l_linenumber - 1) / 3)) + 1 + (case when l_orderkey % 10 = 0 then 1 else 0 end) as int) as rows_ from {lineitem} group by l_orderkey
"""


def _written(written: DataFrame) -> DataFrame:
    """The row that some files add stays without a cell."""
    empty = F.when(F.col("file") % 10 == 0, F.array(F.col("rows_") - 1)).otherwise(F.array().cast("array<int>"))
    return written.select("file", F.col("rows_").alias("rows"), empty.alias("empty"))


_POS = """, pos AS (SELECT file, cell_seq, r::INT AS r, c::INT AS c FROM (SELECT *, unnest(range("row", "row" + rowspan)) AS r FROM cells) AS a, unnest(range(a.col, a.col + a.colspan)) AS t(c))"""
_HOLES = _POS + """, ins AS (SELECT DISTINCT file, r, c FROM pos JOIN wr USING (file) WHERE r < rows_), wd AS (SELECT file, max(c) + 1 AS cols FROM ins GROUP BY file),
every AS (SELECT file, r::INT AS r, c::INT AS c FROM (SELECT file, rows_, cols, unnest(range(rows_)) AS r FROM wr JOIN wd USING (file)) AS a, unnest(range(a.cols)) AS t(c) WHERE NOT (file % 10 = 0 AND r = rows_ - 1)),
holes AS (SELECT * FROM every EXCEPT SELECT * FROM ins)"""


def _duck_cells(text: str) -> str:
    return text.replace("`row`", '"row"')


def grid_query(name: str, oracle: str):
    def register(fn: Callable[[DataFrame, DataFrame], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(derived(spark, sf_dir, CELLS_SQL), _written(derived(spark, sf_dir, WRITTEN_SQL)))
        ORACLE_SQL[name] = f"WITH cells AS ({_duck_cells(_in_duckdb(CELLS_SQL))}), wr AS ({_in_duckdb(WRITTEN_SQL)}){oracle}"
        return fn

    return register


grid_query("grid_holes", _HOLES + " SELECT * FROM holes")(grid.holes)
grid_query(
    "capped_report",
    _HOLES + """, p AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY r, c) AS place FROM holes)
    SELECT file, r, c, place, NULL::BIGINT AS further FROM p WHERE place <= 2 UNION ALL SELECT file, NULL, NULL, NULL, count(*) - 2 FROM holes GROUP BY file HAVING count(*) > 2""",
)(lambda cells, written: grid.reported_holes(cells, written, 2))
grid_query(
    "grid_overlap",
    _POS + """, later AS (SELECT *, row_number() OVER (PARTITION BY file, r, c ORDER BY cell_seq) AS n FROM pos)
    SELECT file, cell_seq, r, c FROM later WHERE n > 1 QUALIFY row_number() OVER (PARTITION BY file, cell_seq ORDER BY r, c) = 1""",
)(lambda cells, written: grid.overlaps(cells))
grid_query("grid_overhang", _POS + " SELECT file, min(r) AS r, rows_ AS rows FROM pos JOIN wr USING (file) WHERE r >= rows_ GROUP BY file, rows_")(grid.overhangs)
grid_query("grid_empty_rows", " SELECT file, (rows_ - 1)::INT AS r FROM wr WHERE file % 10 = 0")(lambda cells, written: grid.empty_rows(written))


@query(
    "grid_limit",
    """, s AS (SELECT *, rowspan * colspan AS area, row_number() OVER (PARTITION BY file ORDER BY cell_seq, row_, rowspan, colspan) AS k, sum(rowspan * colspan) OVER (PARTITION BY file) AS total FROM cells),
    b AS (SELECT * FROM s WHERE total > 100000), u AS (SELECT file, k, colspan AS w, unnest(range(row_, row_ + rowspan)) AS r FROM b),
    i AS (SELECT file, k, greatest(0, w - coalesce(max(w) OVER (PARTITION BY file, r ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS inc FROM u),
    g AS (SELECT file, k, sum(inc) AS inc FROM i GROUP BY file, k),
    c AS (SELECT b.file, cell_seq, area, coalesce(sum(inc) OVER (PARTITION BY b.file ORDER BY b.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM b JOIN g ON b.file = g.file AND b.k = g.k)
    SELECT file, min(cell_seq) AS cell_seq FROM c WHERE before + area > 100000 GROUP BY file""",
    cells="select l_orderkey as file, l_linenumber as cell_seq, l_linenumber as `row`, 0 as col, cast(l_partkey % 1000 + 1 as bigint) as rowspan, cast(l_suppkey % 1000 + 1 as bigint) as colspan from {lineitem}".replace("`row`", "row_"),
)
def grid_limit(cells: DataFrame) -> DataFrame:
    return grid.over_limit(cells.withColumnRenamed("row_", "row"))


# --- witnesses ---------------------------------------------------------------------------------


@query(
    "emphasis_runs",
    """, m AS (SELECT *, CASE WHEN style IS NOT DISTINCT FROM lag(style) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS ch FROM spans WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
    g AS (SELECT *, sum(ch) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM m WHERE true),
    r AS (SELECT conv_id, style, min(turn) AS first, sum(length(text))::BIGINT AS chars, string_agg(text, '' ORDER BY turn) AS t FROM g WHERE style IS NOT NULL GROUP BY conv_id, run, style)
    SELECT conv_id, style, first, chars FROM r WHERE trim(t) <> ''""",
    spans="select conv_id, turn, case when role = 'user' then null else role end as style, text from {conversations}",
)
def emphasis_runs(spans: DataFrame) -> DataFrame:
    runs = witness.emphasis_runs(spans, ["conv_id"], "turn", F.col("style"))
    return runs.select("conv_id", "style", "first", F.length("text").cast("long").alias("chars"))


@query(
    "page_slice",
    """, l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS n, unnest(string_split(text, chr(10))) AS line FROM marked),
    m AS (SELECT *, CASE WHEN regexp_full_match(line, '<!-- page \\d+ -->') THEN regexp_extract(line, '(\\d+)', 1)::INT END AS k FROM l),
    f AS (SELECT *, last_value(k IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n) AS page FROM m)
    SELECT doc_id, page, count(*) AS lines, sum(length(line))::BIGINT AS chars FROM f WHERE k IS NULL GROUP BY ALL""",
    marked="select doc_id, concat('front', chr(10), '<!-- page 1 -->', chr(10), replace(text, '. ', concat('.', chr(10), '<!-- page ', 2 + doc_id % 3, ' -->', chr(10)))) as text from {documents}",
)
def page_slice(marked: DataFrame) -> DataFrame:
    rows = witness.paged(witness.lines(marked))
    return rows.groupBy("doc_id", "page").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("line")).alias("chars"))


@query(
    "coverage_gap",
    """SELECT conv_id, s AS start, p AS previous_end FROM (SELECT conv_id, page_start AS s, lag(page_end) OVER (PARTITION BY conv_id ORDER BY page_start, page_end) AS p FROM units)
    WHERE p IS NOT NULL AND s <> p AND s <> p + 1""",
    units="select conv_id, turn * 2 + (case when (conv_id + turn) % 4 = 0 then 1 else 0 end) as page_start, turn * 2 + 1 as page_end from {conversations}",
)
def coverage_gap(units: DataFrame) -> DataFrame:
    return acceptance.coverage_gaps(units, "conv_id", "page_start", "page_end")


BOXES = "select l_orderkey as doc_id, l_linenumber as id, l_quantity as x0, l_discount as y0, l_quantity + l_linenumber - 2 as x1, l_discount + l_tax as y1 from {lineitem}"
_UNION = "SELECT doc_id, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM boxes WHERE x0 < x1 AND y0 < y1 GROUP BY doc_id"


@query("box_union", _UNION, boxes=BOXES)
def box_union(boxes: DataFrame) -> DataFrame:
    return geometry.unions(boxes, ["doc_id"])


@query(
    "box_contains",
    """, j AS (SELECT a.doc_id, a.id AS outer_id, b.id AS inner_id, CASE WHEN b.x0 >= a.x0 AND b.y0 >= a.y0 AND b.x1 <= a.x1 AND b.y1 <= a.y1 THEN 'inside'
    WHEN b.x1 <= a.x0 OR b.x0 >= a.x1 OR b.y1 <= a.y0 OR b.y0 >= a.y1 THEN 'disjoint' ELSE 'crossing' END AS relation FROM boxes a JOIN boxes b USING (doc_id)) SELECT relation, count(*) AS n FROM j GROUP BY relation""",
    boxes=BOXES,
)
def box_contains(boxes: DataFrame) -> DataFrame:
    return geometry.contained(boxes, boxes, "doc_id").groupBy("relation").agg(F.count(F.lit(1)).alias("n"))


# --- staging -----------------------------------------------------------------------------------


@query(
    "ocr_coverage",
    "SELECT conv_id, count(*) AS pages, list_sort(list(index::BIGINT)) = range(count(*)) AS complete FROM answers GROUP BY conv_id",
    answers="select conv_id, case when conv_id % 6 = 0 then turn + 1 when conv_id % 6 = 1 then 0 else turn end as index from {conversations}",
)
def ocr_coverage(answers: DataFrame) -> DataFrame:
    return staging.page_coverage(answers, "conv_id", "index")


@query("ocr_cost", "SELECT source, count(*) AS pages, round(count(*) / 1000.0::DOUBLE * 1.0::DOUBLE, 6) AS usd FROM docs GROUP BY source", docs="select source, doc_id from {documents}")
def ocr_cost(docs: DataFrame) -> DataFrame:
    return staging.costs(docs, "source")


@query(
    "stage_action",
    """SELECT i.doc_id, CASE WHEN s.doc_id IS NULL THEN 'staged' WHEN sha256(i.text) = sha256(s.text) THEN 'already' ELSE 'conflict' END AS action FROM incoming i LEFT JOIN there s USING (doc_id)""",
    incoming=DOCS,
    there="select case when doc_id % 3 = 0 then doc_id when doc_id % 3 = 1 then -doc_id - 1 else doc_id end as doc_id, case when doc_id % 3 = 2 then concat(text, '!') else text end as text from {documents}",
)
def stage_action(incoming: DataFrame, there: DataFrame) -> DataFrame:
    hashed = lambda df: df.select("doc_id", staging.digest(F.col("text")).alias("digest"))
    return staging.actions(hashed(incoming), hashed(there), ["doc_id"]).select("doc_id", "action")


@query(
    "supplement_assemble",
    """SELECT doc_id, '{"id":"' || id || '","supplements":[' || string_agg('{"name":"' || name || '","title":"' || title || '","exhibits":["' || label || '"]}', ',' ORDER BY name, title, label) || ']}' AS supplements_json
    FROM declared JOIN ids USING (doc_id) GROUP BY doc_id, id""",
    declared="select l_orderkey as doc_id, concat('s', l_linenumber) as name, concat(l_returnflag, l_linestatus) as title, concat('t', l_partkey) as label from {lineitem}",
    ids="select o_orderkey as doc_id, concat('paper-', o_custkey) as id from {orders}",
)
def supplement_assemble(declared: DataFrame, ids: DataFrame) -> DataFrame:
    return staging.assembled(declared.withColumn("exhibits", F.array("label")), ids)


@query(
    "lookup_chain",
    """SELECT doi, pmcid, CASE WHEN pmcid IS NULL THEN 'no_id' WHEN has_body IS NULL THEN 'no_article' WHEN NOT has_body THEN 'no_body' ELSE 'found' END AS status
    FROM dois LEFT JOIN ids USING (doi) LEFT JOIN articles USING (pmcid)""",
    dois="select concat('10.1/', o_orderkey) as doi from {orders}",
    ids="select concat('10.1/', o_orderkey) as doi, case when o_orderkey % 3 = 0 then null else concat('PMC', o_orderkey) end as pmcid from {orders}",
    articles="select concat('PMC', l_orderkey) as pmcid, bool_or(l_linenumber > 3) as has_body from {lineitem} group by l_orderkey",
)
def lookup_chain(dois: DataFrame, ids: DataFrame, articles: DataFrame) -> DataFrame:
    return staging.lookups(dois, ids, articles)


@query(
    "surname_words",
    """SELECT key, list_sort(list_distinct(list_filter(list_transform(string_split(names, ';'), lambda c: lower(regexp_extract(c, '[A-Za-z][A-Za-z''\\-]{2,}'))), lambda s: s <> ''))) AS surnames FROM raw""",
    raw="select c_custkey as key, concat(c_name, ' A. B.; O''Brien-', c_mktsegment, ' X; Li; ', c_mktsegment) as names from {customer}",
)
def surname_words(raw: DataFrame) -> DataFrame:
    return raw.select("key", F.array_sort(C.surnames(F.col("names"))).alias("surnames"))


# --- whole bundles -----------------------------------------------------------------------------

_MANIFEST = """case o_orderkey % 10
  when 1 then concat('{{"schema_version": 4, "id": "p', o_orderkey, '", "title": "t", "exhibits": [{{"label": "f1", "caption": "c"}}, {{"label": "f2", "caption": "d"}}]}}')
  when 2 then concat('{{"schema_version": 5, "id": "p', o_orderkey, '", "title": "t", "title": "u", "exhibits": []}}')
  when 3 then concat('{{"schema_version": 5, "id": "p', o_orderkey, '", "title": "t", "exhibits": [{{"label": "f1", "caption": "c"}}, {{"label": "a b", "caption": "d"}}]}}')
  when 4 then concat('{{"schema_version": 5, "id": "p', o_orderkey, '", "exhibits": [{{"label": "f1", "caption": "c"}}, {{"label": "f2", "caption": "d"}}]}}')
  when 5 then concat('{{"schema_version": 5, "id": "p', o_orderkey, '", "title": "t", "x": 1, "exhibits": [{{"label": "f1", "caption": "c"}}, {{"label": "f2", "caption": "d"}}]}}')
  when 6 then concat('{{"schema_version": 5, "id": "p', o_orderkey, '", "title": "t", "exhibits": []}}')
  when 7 then '\ufeff{{}}'
  when 8 then concat('{{"schema_version": true, "id": "p', o_orderkey, '", "title": "t", "exhibits": [{{"label": "f1", "caption": "c"}}, {{"label": "f2", "caption": "d"}}]}}')
  else concat('{{"schema_version": 5, "id": "p', o_orderkey, '", "title": "t", "exhibits": [{{"label": "f1", "caption": "c"}}, {{"label": "f2", "caption": "d"}}]}}') end"""
_TABLE = "<table><tbody><tr><td>x</td></tr></tbody></table>"
_HOLED = '<table><tr><td colspan="2">x</td></tr><tr><td>y</td></tr></table>'
FILES = f"""
select cast(o_orderkey as string) as bundle_id, dir, name, kind, content, png from (
select o_orderkey, '' as dir, '' as name, 'dir' as kind, null as content, 0 as png from {{orders}}
union all select o_orderkey, '', 'manifest.json', 'file', {_MANIFEST}, 0 from {{orders}} where o_orderkey % 10 <> 9
union all select o_orderkey, '', 'text.md', 'file', case when o_orderkey % 3 = 0 then ' ' else 'text' end, 0 from {{orders}}
union all select o_orderkey, '', 'figures', 'dir', null, 0 from {{orders}}
union all select o_orderkey, 'figures', 'f1.png', 'file', null, case when o_orderkey % 5 = 2 then 0 else 1 end from {{orders}}
union all select o_orderkey, 'figures', case when o_orderkey % 4 = 1 then '.f2.png' else 'f2.png' end, 'file', null, 1 from {{orders}}
union all select o_orderkey, '', 'tables', 'dir', null, 0 from {{orders}}
union all select o_orderkey, 'tables', 'f1.html', 'file', case when o_orderkey % 6 = 3 then '{_HOLED}' else '{_TABLE}' end, 0 from {{orders}}) t
"""


@query(
    "validate_corpus",
    """, b AS (SELECT DISTINCT bundle_id, bundle_id::BIGINT AS k FROM files),
    m AS (SELECT * FROM (VALUES (1, 'schema_version', '4'), (2, 'duplicate_key', 'title'), (3, 'name_pattern', 'exhibits[1] label ''a b'''), (4, 'missing_key', 'title'),
    (5, 'unknown_key', 'x'), (7, 'bom', ''), (8, 'key_type', 'schema_version: bool'), (9, 'missing_file', 'manifest.json')) AS t(n, rule, detail))
    SELECT bundle_id, 'manifest' AS phase, rule, detail FROM b JOIN m ON k % 10 = n
    UNION ALL SELECT bundle_id, 'text', 'empty', 'text.md' FROM b WHERE k % 3 = 0
    UNION ALL SELECT bundle_id, 'figures', 'not_png', 'f1.png' FROM b WHERE k % 5 = 2
    UNION ALL SELECT bundle_id, 'tables', 'hole', 'f1: row 2 column 2' FROM b WHERE k % 6 = 3
    UNION ALL SELECT bundle_id, 'binding', 'no_crop', 'f2' FROM b WHERE k % 4 = 1 AND k % 10 IN (0, 1, 4, 5, 8)
    UNION ALL SELECT bundle_id, 'binding', 'undeclared', 'f1' FROM b WHERE k % 10 = 6
    UNION ALL SELECT bundle_id, 'binding', 'undeclared', 'f2' FROM b WHERE k % 10 = 6 AND k % 4 <> 1
    UNION ALL SELECT bundle_id, 'table_binding', 'undeclared', 'f1' FROM b WHERE k % 10 = 6""",
    files=FILES,
)
def validate_corpus(files: DataFrame) -> DataFrame:
    head = F.when(F.col("png") == 1, F.lit(C.PNG_HEAD)).when(F.col("dir") == "figures", F.lit(b"GIF89a.."))
    none = F.lit(None).cast("string")
    whole = files.select("bundle_id", F.lit("").alias("scope"), "dir", "name", "kind", F.col("name").startswith(".").alias("hidden"), F.lit(8).cast("long").alias("size"), head.alias("head"), "content", none.alias("read_error"))
    return bundles.violations(whole).select("bundle_id", "phase", "rule", "detail")


#: (html, rules in their order) of small tables, each with one thing to say.
TABLE_CASES = (
    ("<table><tr><td>a</td></tr></table>", ""),
    ("<table><thead><tr><th scope=col>a</th></tr></thead><tbody><tr><td>b<br>c</td></tr></tbody></table>", ""),
    ("<table><tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c</td></tr></table>", ""),
    ("<table><tr><td colspan=002>a</td></tr><tr><td>b</td><td><sup>c</sup></td></tr></table>", ""),
    ("  ", "empty"),
    ("<table></table>", "no_cells"),
    ("<p>x</p>", "refused loose_text no_table"),
    ("<table><tr><td>a</td></tr></table><table></table>", "second_table"),
    ("<table><tr><td>a</td></tr>", "never_closed"),
    ("<table><caption>x</caption><tr><td>a</td></tr></table>", "refused loose_text"),
    ("<table><tr><td>a</td></tr><tr></tr></table>", "empty_row"),
    ("<table><tr><td rowspan=3>a</td></tr></table>", "overhang"),
    ("<table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table>", "hole"),
    ("<table><tr><td rowspan=2>a</td><td>b</td></tr><tr><td colspan=0>c</td></tr></table>", "span_least"),
    ("<table><tr><td>a</td><td rowspan=2>b</td></tr><tr><td colspan=2>c</td></tr></table>", "overlap"),
    ("<table><tr><td colspan=1001>a</td></tr></table>", "span_limit"),
    ("<table><tr><td colspan=+1>a</td></tr></table>", "span_number"),
    ("<table><tr><td style=x>a</td></tr></table>", "attribute_refused"),
    ("<table><tr><td colspan>a</td></tr></table>", "attribute_bare"),
    ("<table><tr><th scope=x>a</th></tr></table>", "scope"),
    ("<table><tr><td colspan=1 colspan=1>a</td></tr></table>", "attribute_repeated"),
    ("<table><!-- x --><tr><td>a</td></tr></table>", "comment"),
    ("<!DOCTYPE html><table><tr><td>a</td></tr></table>", "declaration"),
    ("<table><tr><td>a</tr></table>", "nesting"),
    ("<table><tr><td>a</td></tr></table></b>", "nothing_open"),
    ("<table><tr><td>a</br></td></tr></table>", "void_closed"),
    ("<table><tr><td/></tr></table>", "self_closing nesting"),
    ("<table><tr><td>a</td></tr>x</table>", "loose_text"),
    ("<table><td>a</td></table>", "position"),
    ("<table><em>a</em><tr><td>a</td></tr></table>", "position loose_text"),
)


def _cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(TABLE_CASES)], "case_id int, html string")
    found = markup.table_findings(rows, "case_id").groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("ord", "rule"))).alias("r"))
    rules = F.coalesce(F.array_join(F.transform("r", lambda x: x["rule"]), " "), F.lit(""))
    return rows.join(found, "case_id", "left").select("case_id", rules.alias("rules"))


QUERIES["table_fixture_verdicts"] = _cases
ORACLE_SQL["table_fixture_verdicts"] = "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{r}')" for i, (_, r) in enumerate(TABLE_CASES)) + ") AS t(case_id, rules)"


@query(
    "jats_markdown",
    """SELECT page_id, '# Paper ' || page_id || chr(10) || chr(10) || 'Ann Lee-' || page_id || ', Bo' || chr(10) || chr(10) || '## Abstract' || chr(10) || chr(10) || 'Short.' || chr(10) || chr(10)
    || '## Methods' || chr(10) || chr(10) || 'We saw [TABLE: Table 1. Counts. Footnote: n = ' || page_id || '] here.' || chr(10) || chr(10) || '### Deep' || chr(10) || chr(10) || '- one' || chr(10) || chr(10) || '- two' || chr(10) || chr(10)
    || '## References' || chr(10) || chr(10) || '- 1 Lee A. Title.' || chr(10) || chr(10) || '- Quist E 1998' || chr(10) AS markdown FROM articles""",
    articles="""select page_id, concat('<article><front><article-meta><title-group><article-title>Paper ', page_id, '</article-title></title-group><contrib-group>',
      '<contrib contrib-type="author"><name><surname>Lee-', page_id, '</surname><given-names>Ann</given-names></name></contrib><contrib contrib-type="author"><surname>Bo</surname></contrib></contrib-group>',
      '<abstract><p>Short.</p></abstract></article-meta></front><body><sec><title>Methods</title><p>We  saw<table-wrap><label>Table 1</label><caption><p>Counts</p></caption><table><tr><td>9</td></tr></table>',
      '<table-wrap-foot><p>n = ', page_id, '</p></table-wrap-foot></table-wrap> here.</p><sec><title>Deep</title><list><list-item><p>one</p></list-item><list-item><p>two</p></list-item></list></sec></sec></body>',
      '<back><ref-list><ref><label>1</label><mixed-citation>Lee A. <i>Title</i>.</mixed-citation></ref><ref><element-citation><name>Quist</name><given>E</given><year>1998</year></element-citation></ref></ref-list></back></article>') as xml from {pages}""",
)
def jats_markdown(articles: DataFrame) -> DataFrame:
    return jats.markdown(articles, "page_id").select("page_id", "markdown")


# --- registries and reports --------------------------------------------------------------------


@query(
    "registry_load",
    """SELECT id, ord::INT AS ord, title, doi, CASE WHEN title IS NULL AND doi IS NULL THEN 'nothing_to_match' END AS rule FROM (
    SELECT 'k' || o_orderkey AS id, 0 AS ord, o_orderpriority AS title, NULL AS doi FROM src
    UNION ALL SELECT 'm' || o_orderkey, 1, NULL, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE '10.1/' || o_custkey END FROM src)""",
    src="""select o_orderkey, o_custkey, o_orderpriority, concat('{{"data": {{"k', o_orderkey, '": {{"title": "', o_orderpriority, '"}}, "m', o_orderkey, '": {{',
      case when o_orderkey % 5 = 0 then '"note": 1' else concat('"doi": "10.1/', o_custkey, '"') end, '}}}}}}') as raw from {orders}""",
)
def registry_load(src: DataFrame) -> DataFrame:
    return registries.records(src.select("raw"), "data").select("id", "ord", "title", "doi", "rule")


BLOCKS = "select conv_id as doc_id, cast(floor(turn / 2) as int) + 1 as page, turn as index, text from {conversations}"


@query(
    "blocks_text",
    """, p AS (SELECT doc_id, page, '<!-- page ' || page || ' -->' || chr(10) || chr(10) || string_agg(text, chr(10) || chr(10) ORDER BY index, text) AS own FROM blocks GROUP BY doc_id, page)
    SELECT doc_id, string_agg(own, chr(10) || chr(10) ORDER BY page) AS text FROM p GROUP BY doc_id""",
    blocks=BLOCKS,
)
def blocks_text(blocks: DataFrame) -> DataFrame:
    return reports.blocks_text(blocks)


@query(
    "reference_report",
    """SELECT doc_id, string_agg('- ' || doi || chr(10) || '  text: ' || entry || chr(10) || '  ' || CASE status WHEN 'resolved' THEN 'registrar: R' || pos ELSE status END, chr(10) ORDER BY pos, doi, status)
    || chr(10) || count(*) FILTER (status = 'resolved') || ' resolved, ' || count(*) FILTER (status = 'unresolved') || ' unresolved, ' || count(*) FILTER (status = 'unanswered') || ' unanswered' AS report FROM found GROUP BY doc_id""",
    found="""select l_orderkey as doc_id, l_linenumber * 1000000 + l_partkey * 100 + l_suppkey % 100 as pos, concat('10.1/', l_partkey) as doi, concat('entry ', l_suppkey) as entry,
      case l_partkey % 3 when 0 then 'resolved' when 1 then 'unresolved' else 'unanswered' end as status from {lineitem}""",
)
def reference_report(found: DataFrame) -> DataFrame:
    return reports.reference_report(found.withColumn("record", F.concat(F.lit("R"), "pos")))

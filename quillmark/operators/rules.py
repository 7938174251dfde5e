"""Rules of conversion runs: settings, modes, declarations, skeletons, sentinels, summaries.

All of them are native. A rule's rows are (key..., rule, detail); what is sound has no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.functions import columns as C
from quillmark.operators.reports import reference_report

# Fixed values.
DECLARATION_KEYS = ("name", "title", "exhibits")
UNIT_KINDS = ("front_matter", "section", "references", "back_matter")
CLASSIFICATIONS = {"born_digital": "text_layer", "scanned": "ocr", "misencoded": "ocr"}
MAX_WIDTH, MAX_PIXELS = 20_000, 40_000_000
OCR_ATTEMPTS = 2


def read_var(lines: DataFrame, name: str, own: str | None) -> DataFrame:
    """(value): the environment's own value, else that of the first line (pos, line) of a settings
    file that sets the name; empty values are none."""
    line = C.strip(F.col("line"))
    at = F.instr(line, "=")
    value = F.regexp_replace(F.regexp_replace(C.strip(F.expr("substring(l, at + 1)")), '^"+|"+\\z', ""), "^'+|'+\\z", "")
    set_ = lines.select("pos", line.alias("l"), at.alias("at")).where((F.col("at") > 0) & ~F.col("l").startswith("#") & (C.strip(F.expr("substring(l, 1, at - 1)")) == name))
    first = set_.agg(F.min_by(value, "pos").alias("v"))
    return first.select(F.nullif(F.coalesce(F.nullif(F.lit(own).cast("string"), F.lit("")), "v"), F.lit("")).alias("value"))


def page_files(files: DataFrame, suffix: str, prefix: str = "page_") -> DataFrame:
    """Files (doc_id, name) of pages, in order of their names."""
    named = F.col("name").startswith(prefix) & F.col("name").endswith(suffix) & (F.length("name") >= len(prefix) + len(suffix))
    return files.where(named).orderBy("doc_id", "name")


def source_states(works: DataFrame) -> DataFrame:
    """(doc_id, state) of works (doc_id, is_dir, is_file, opened, pages): why a source can't be used, or ready."""
    state = F.when(~F.col("is_dir"), "no_directory").when(~F.col("is_file"), "missing").when(~F.col("opened"), "unreadable").when(F.col("pages") < 1, "no_pages").otherwise("ready")
    return works.select("doc_id", state.alias("state"))


def mode_rule(given: dict[str, Column]) -> Column:
    """Which rule a call's arguments break, else null: one mode of id and pdf, map_file, folder and registry."""
    there = {k: v.isNotNull() for k, v in given.items()}
    one, many = there["id"] | there["pdf"], there["folder"] | there["registry"]
    modes = one.cast("int") + there["map_file"].cast("int") + many.cast("int")
    return (
        F.when(modes != 1, "one_mode")
        .when(there["supplement"] & (there["map_file"] | many), "supplement_alone")
        .when(many & ~(there["folder"] & there["registry"]), "folder_and_registry")
        .when(one & ~(there["id"] & there["pdf"]), "id_and_pdf")
    )


def render_rule(width: Column, dpi: Column, high: Column) -> Column:
    """Which guard a table's render breaks, else null; width and height in points."""
    scale = dpi / 72.0
    return F.when((width <= 0) | (dpi <= 0), "positive").when(width > MAX_WIDTH, "width").when((width * scale) * (high * scale) > MAX_PIXELS, "pixels")


def attempts(answers: DataFrame) -> DataFrame:
    """(doc_id, tries, waited, outcome) of answers (doc_id, try, status, retry_after), tries counted from 1:
    the first that is final, or the last allowed one. A wait follows each failed try but the last."""
    final = ~C.retryable(F.col("status")) | (F.col("try") >= OCR_ATTEMPTS)
    ends = F.min(F.when(final, F.col("try"))).over(Window.partitionBy("doc_id"))
    used = answers.withColumn("_end", ends).where(F.col("_end").isNull() | (F.col("try") <= F.col("_end")))
    wait = F.when(F.col("try") < F.col("_end"), C.retry_after(F.col("retry_after"))).otherwise(0.0)
    outcome = F.max_by(F.when(F.col("status").between(200, 299), "answered").otherwise("failed"), "try")
    return used.groupBy("doc_id").agg(F.max("try").alias("tries"), F.sum(wait).alias("waited"), outcome.alias("outcome"))


def declarations(rows: DataFrame) -> DataFrame:
    """(doc_id, dir, rule, detail) of declarations (doc_id, dir, raw): what stops each. A null raw is a
    missing file. Of several faults the first in this order counts: missing, json, a repeated key at
    the top, type, a missing key, an unknown key, a name that is not the directory's, exhibits."""
    v = rows.select("doc_id", "dir", "raw", F.json_object_keys("raw").alias("keys"), F.expr("try_parse_json(raw)").alias("v"))
    kind = F.schema_of_variant("v")
    twice = F.filter("keys", lambda k: F.size(F.filter(F.col("keys"), lambda j: j == k)) > 1)
    known = F.array(*[F.lit(k) for k in DECLARATION_KEYS])
    lacking, extra = F.array_except(known, "keys"), F.array_sort(F.array_except("keys", known))
    name, exhibits = F.expr("try_variant_get(v, '$.name', 'string')"), F.schema_of_variant(F.expr("try_variant_get(v, '$.exhibits', 'variant')"))
    is_text = F.schema_of_variant(F.expr("try_variant_get(v, '$.name', 'variant')")) == "STRING"
    faults = [
        (F.col("raw").isNull(), "missing_file", F.lit("")),
        # Repeated keys leave no variant, but their object has keys.
        (F.col("v").isNull() & F.col("keys").isNull(), "json", F.lit("")),
        (F.size(twice) > 0, "duplicate_key", twice[0]),
        (F.col("v").isNull(), "json", F.lit("")),
        (~kind.startswith("OBJECT"), "not_object", F.lit("")),
        (F.size(lacking) > 0, "missing_key", lacking[0]),
        (F.size(extra) > 0, "unknown_key", extra[0]),
        (~F.coalesce(is_text & (name == F.col("dir")), F.lit(False)), "name_differs", F.coalesce(name, F.lit(""))),
        (~F.coalesce(exhibits.startswith("ARRAY"), F.lit(False)), "exhibits_type", F.lit("")),
    ]
    found = F.lit(None).cast("struct<rule:string,detail:string>")
    for cond, rule, detail in reversed(faults):
        found = F.when(cond, F.struct(F.lit(rule).alias("rule"), detail.alias("detail"))).otherwise(found)
    return v.select("doc_id", "dir", found.alias("f")).where("f is not null").select("doc_id", "dir", "f.rule", "f.detail")


def collected(rows: DataFrame) -> DataFrame:
    """(doc_id, supplements, stop) of declarations (doc_id, dir, raw): their texts in order of their
    directories, or the first fault, which stops the paper."""
    faults = declarations(rows).groupBy("doc_id").agg(F.min(F.struct("dir", "rule")).alias("f"))
    each = rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("dir", "raw"))).alias("all"))
    out = each.join(faults, "doc_id", "left")
    return out.select("doc_id", F.when(F.col("f").isNull(), F.transform("all", lambda x: x["raw"])).alias("supplements"), F.concat_ws(" ", "f.dir", "f.rule").alias("stop"))


def unit_rules(units: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, rule) that a skeleton's units (doc_id, index, page_start, page_end, depth, kind, opening,
    closing) break, against docs (doc_id, pages)."""
    w = Window.partitionBy("doc_id").orderBy("index")
    u = units.withColumn("_n", F.row_number().over(w)).withColumn("_before", F.lag("page_end").over(w))
    edge = F.col("_n") == 1
    by = u.groupBy("doc_id").agg(
        F.bool_or(F.col("page_start") > F.col("page_end")).alias("reversed"),
        F.bool_or(~edge & ~F.col("page_start").isin(F.col("_before"), F.col("_before") + 1)).alias("gap"),
        F.bool_or(F.col("index") != F.col("_n")).alias("index"),
        F.bool_or(edge & (F.col("page_start") != 1)).alias("first_page"),
        F.max_by("page_end", "_n").alias("_last"),
        (~F.bool_or(edge & (F.col("depth") == 1)) | (F.count_if(F.col("depth") == 1) != 1)).alias("title_depth"),
        F.bool_or(~F.col("depth").between(1, 3)).alias("depth"),
        F.bool_or(~F.col("kind").isin(*UNIT_KINDS)).alias("kind"),
        F.bool_or(C.is_blank(F.col("opening")) | C.is_blank(F.col("closing"))).alias("edge_words"),
    )
    by = docs.select("doc_id", "pages").join(by, "doc_id", "left").withColumn("last_page", F.col("_last") != F.col("pages")).withColumn("no_units", F.col("_last").isNull())
    rules = ["no_units", "reversed", "gap", "index", "first_page", "last_page", "title_depth", "depth", "kind", "edge_words"]
    found = F.array(*[F.when(F.col(r), F.lit(r)) for r in rules])
    return by.select("doc_id", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("rule"))


def normalised(markdown: Column) -> Column:
    """Markdown as one line of plain characters, for looking words up in it."""
    return C.strip(F.regexp_replace(F.replace(F.coalesce(markdown, F.lit("")), F.lit("*"), F.lit("")), r"(?U)[\s\x1C-\x1F]+", " "))


def missing_headings(units: DataFrame, texts: DataFrame) -> DataFrame:
    """Units (doc_id, index, depth, heading) whose heading line the text does not hold at their depth."""
    line = F.concat(F.repeat(F.lit("#"), F.col("depth")), F.lit(" "), F.col("heading"))
    held = F.array_contains(F.split("text", "\n"), line)
    return units.join(texts.select("doc_id", "text"), "doc_id").where(~held).select("doc_id", "index", "heading")


def edge_words(units: DataFrame) -> DataFrame:
    """Units (doc_id, index, slice, opening, closing) whose slice of the text does not begin and end
    with their words, whatever the hyphens at line breaks: (doc_id, index, rule)."""
    plain = lambda c: F.regexp_replace(normalised(F.col(c)), r"[\x{AD}-]\s?", "")
    rule = F.array(F.when(~F.startswith(plain("slice"), plain("opening")), "opening"), F.when(~F.endswith(plain("slice"), plain("closing")), "closing"))
    return units.select("doc_id", "index", F.explode(F.filter(rule, lambda x: x.isNotNull())).alias("rule"))


def sentinel_rules(exhibits: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc_id, label, rule) of exhibits (doc_id, pos, label, printed, caption, section): their sentinel
    is missing, not a paragraph of its own, before an earlier one's, or outside its section."""
    mark = C.sentinel(F.col("printed"), F.col("caption"))
    at = exhibits.join(texts.select("doc_id", "text"), "doc_id").withColumn("_s", mark).withColumn("_at", F.instr("text", F.col("_s")))
    w = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    at = at.withColumn("_before", F.max(F.when(F.col("_at") > 0, F.col("_at"))).over(w))
    own = F.array_contains(F.split("text", "\n\n"), F.col("_s"))
    headings = F.regexp_extract_all(F.expr("substring(text, 1, _at)"), F.lit(r"(?m)^#{1,6} (.*)$"), F.lit(1))
    section = F.when(F.size(headings) > 0, F.element_at(headings, -1))
    rules = [F.when(F.col("_at") == 0, "missing"), F.when((F.col("_at") > 0) & ~own, "paragraph"), F.when((F.col("_at") > 0) & (F.col("_at") < F.col("_before")), "order"), F.when((F.col("_at") > 0) & ~section.eqNullSafe(F.col("section")), "section")]
    return at.select("doc_id", "label", F.explode(F.filter(F.array(*rules), lambda x: x.isNotNull())).alias("rule"))


def supplement_separation(parts: DataFrame, texts: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, rule, detail): prose of supplements (doc_id, part) in the article's text, and labels
    (doc_id, supplement, label) that do not begin with their supplement's name."""
    prose = parts.join(texts.select("doc_id", normalised(F.col("text")).alias("_t")), "doc_id").where(F.contains("_t", normalised(F.col("part"))))
    named = labels.where(~F.startswith("label", F.concat("supplement", F.lit("_"))))
    return prose.select("doc_id", F.lit("prose").alias("rule"), F.col("part").alias("detail")).unionByName(named.select("doc_id", F.lit("label").alias("rule"), F.col("label").alias("detail")))


def transcribed_figures(exhibits: DataFrame, transcriptions: DataFrame) -> DataFrame:
    """(doc_id, label) of figures that have a transcription."""
    return exhibits.where("kind = 'figure'").select("doc_id", "label").join(transcriptions.select("doc_id", "label"), ["doc_id", "label"], "left_semi")


def triage_rules(triage: DataFrame) -> DataFrame:
    """(doc_id, rule) of triage (doc_id, classification, character_source, page_count)."""
    wanted = F.create_map(*[F.lit(x) for pair in CLASSIFICATIONS.items() for x in pair])[F.col("classification")]
    known = F.coalesce(F.col("classification").isin(*CLASSIFICATIONS), F.lit(False))
    rules = [F.when(~known, "classification"), F.when(known & ~F.col("character_source").eqNullSafe(wanted), "character_source"), F.when(F.coalesce(F.col("page_count"), F.lit(0)) < 1, "page_count")]
    return triage.select("doc_id", F.explode(F.filter(F.array(*rules), lambda x: x.isNotNull())).alias("rule"))


def page_space(crops: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, page, label) of crops whose space (width, height) is not their page's size."""
    p = pages.select("doc_id", "page", F.col("width").alias("_w"), F.col("height").alias("_h"))
    return crops.join(p, ["doc_id", "page"]).where("width <> _w or height <> _h").select("doc_id", "page", "label")


def disagreements(witnesses: DataFrame) -> DataFrame:
    """(doc_id, page, pos, readings) of places that witnesses (doc_id, page, pos, witness, reading) read
    differently; the render decides, so no reading is chosen here."""
    own = F.array_sort(F.collect_set(F.concat_ws(": ", "witness", "reading")))
    by = witnesses.groupBy("doc_id", "page", "pos").agg(F.count_distinct("reading").alias("n"), own.alias("readings"))
    return by.where("n > 1").drop("n")


def run_summary(matches: DataFrame) -> DataFrame:
    """(run, staged, unresolved, failed, code) of matches (run, readable, confident, contested, staged).

    Contested and unsure ones need a decision; unreadable ones and those that could not be staged fail.
    """
    sure = F.col("readable") & F.col("confident") & ~F.col("contested")
    n = lambda c: F.count_if(c)
    by = matches.groupBy("run").agg(n(sure & F.col("staged")).alias("staged"), n(F.col("readable") & ~(F.col("confident") & ~F.col("contested"))).alias("unresolved"), n(~F.col("readable") | (sure & ~F.col("staged"))).alias("failed"))
    return by.withColumn("code", F.when(F.col("failed") > 0, 1).when(F.col("unresolved") > 0, 3).otherwise(0))


def stamp(seconds: Column) -> Column:
    """Epoch seconds as an ISO stamp of whole seconds, UTC."""
    return F.date_format(F.to_utc_timestamp(F.timestamp_seconds(seconds), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def web_texts(found: DataFrame) -> DataFrame:
    """(doc_id, text) of the articles that were found with a body: only these are written."""
    return found.where("status = 'found'").select("doc_id", F.col("markdown").alias("text"))


def ocr_outputs(pages: DataFrame) -> DataFrame:
    """(doc_id, index, markdown) of the pages (doc_id, index, markdown) of answers whose indexes are
    exactly 0 to n - 1, each once; others are refused as a whole."""
    by = pages.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("index").alias("k"), F.min("index").alias("lo"), F.max("index").alias("hi"))
    return pages.join(by.where("n = k and lo = 0 and hi = n - 1").select("doc_id"), "doc_id", "left_semi").select("doc_id", "index", "markdown")


def full_reference_report(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, report) of all docs (doc_id, has_section): those without a DOI say why nothing was checked."""
    reason = F.when(F.col("has_section"), "no DOIs in the references section").otherwise("no references heading found")
    out = docs.select("doc_id", "has_section").join(reference_report(found), "doc_id", "left")
    return out.select("doc_id", F.coalesce("report", F.concat(F.lit("nothing to check: "), reason)).alias("report"))


def rotated_box(box: Column, rotation: Column, width: Column, height: Column) -> Column:
    """A box of an unrotated page of a size, as it stands after turning by 0, 90, 180 or 270 degrees
    clockwise, corners in order and rounded to hundredths as binary numbers are."""
    x0, y0, x1, y1 = (box[i] for i in range(4))
    turned = (
        F.when(rotation == 90, F.array(height - y1, x0, height - y0, x1))
        .when(rotation == 180, F.array(width - x1, height - y1, width - x0, height - y0))
        .when(rotation == 270, F.array(y0, width - x1, y1, width - x0))
        .otherwise(F.array(x0, y0, x1, y1))
    )
    lo, hi = (lambda i: F.least(turned[i], turned[i + 2])), (lambda i: F.greatest(turned[i], turned[i + 2]))
    return F.array(*[rounded(c) for c in (lo(0), lo(1), hi(0), hi(1))])


def rounded(x: Column) -> Column:
    """Hundredths of the binary value itself: the nearest, ties to even. The value's distance from
    the next tie is exact in doubles, unlike that of its shortest decimal."""
    low = F.floor(x * 100)
    # x against (low + 1/2) / 100: of both, the exact values as decimals of the 52 bits.
    exact = lambda c: F.format_string("%.30f", c).cast("decimal(38,30)")
    gap = exact(x - F.floor(x)) * 100 - (low - F.floor(x) * 100).cast("decimal(10,0)")
    up = (gap > F.lit(0.5).cast("decimal(2,1)")) | ((gap == F.lit(0.5).cast("decimal(2,1)")) & (low % 2 != 0))
    return (low + up.cast("long")) / 100.0

"""Scalar functions over columns; all of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
STOP_WORDS = (
    "a an and are as at be by for from in into is it its of on or that the to with without between among "
    "during effect effects study trial randomised randomized controlled review analysis patients people health care"
).split()
DOI_PREFIX = r"^(https://dx\.doi\.org/|https://doi\.org/|http://dx\.doi\.org/|http://doi\.org/|doi:|doi )"
DOI = r"""10\.\d{4,9}/[^\s"'<>\[\]]+"""
DOI_TAIL = ".,;:!?)]}>\"'"
REFERENCES_HEADING = r"(?im)^#{1,6}\s+references\b"
NAME = r"^[A-Za-z0-9._-]+\z"
PNG_HEAD = bytes([0x89]) + b"PNG\r\n\x1a\n"
PAGE_MARKER = "<!-- page %d -->"
IMAGE_ITALIC, IMAGE_BOLD = 2, 16

_BLANK = r"[\s\x1C-\x1F]"


def strip(c: Column) -> Column:
    """White space off both ends, all that Unicode and Python know."""
    return F.regexp_replace(c, rf"(?U)^{_BLANK}+|{_BLANK}+\z", "")


def is_blank(c: Column) -> Column:
    return strip(F.coalesce(c, F.lit(""))) == ""


def folded_newlines(c: Column) -> Column:
    return F.regexp_replace(c, "\r\n?", "\n")


def name_rule(c: Column) -> Column:
    """The first rule that a name which becomes a path breaks, else null."""
    return (
        F.when(c.isNull(), "type")
        .when(~c.rlike(NAME), "pattern")
        .when(~c.rlike("[A-Za-z0-9]"), "punctuation")
        .when(c.startswith("."), "dot")
    )


def id_rule(c: Column) -> Column:
    """The looser rule of ids that callers hand over: a path component."""
    v = strip(F.coalesce(c, F.lit("")))
    return F.when(v == "", "empty").when(v.isin(".", ".."), "reserved").when(v.rlike(r"[/\\]"), "separator").when(v.startswith("."), "dot")


def supplement_name_rule(c: Column) -> Column:
    return F.coalesce(id_rule(c), name_rule(strip(c)))


def normalised_doi(c: Column) -> Column:
    v = F.regexp_replace(F.lower(strip(F.coalesce(c, F.lit("")))), DOI_PREFIX, "")
    return F.regexp_replace(v, r"(?U)\s+", "")


def without_spaces(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", "")


def doi_printed(doi: Column, flat: Column) -> Column:
    """Whether flat prints this DOI and not a longer one that begins with it."""
    quoted = F.concat(F.lit(r"\Q"), F.replace(doi, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?![0-9a-z/_-]|\.[\p{L}\p{N}])"))
    return (doi != "") & F.regexp_like(flat, quoted)


def doi_ends(rest: Column) -> Column:
    """Whether a DOI may end before these two characters, as in doi_printed."""
    return ~rest.rlike(r"^([0-9a-z/_-]|\.[\p{L}\p{N}])")


def content_words(c: Column) -> Column:
    found = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("([a-z0-9]+)"), F.lit(1))
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    return F.array_distinct(F.filter(found, lambda w: (F.length(w) > 2) & ~F.array_contains(stop, w)))


def surnames(c: Column) -> Column:
    chunks = F.split(F.coalesce(c, F.lit("")), r"(?U)[;,&]|\band\b")
    first = F.transform(chunks, lambda x: F.lower(F.regexp_extract(x, r"[A-Za-z][A-Za-z'\-]{2,}", 0)))
    return F.array_distinct(F.filter(first, lambda s: s != ""))


def years(c: Column) -> Column:
    """All runs of four digits, also those inside longer ones."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?=(\d{4}))"), F.lit(1)))


def references_section(c: Column) -> Column:
    """The text after the first references heading, or null."""
    return F.when(c.rlike(REFERENCES_HEADING), F.regexp_extract(c, r"(?s)" + REFERENCES_HEADING + r"(.*)", 1))


def dois(c: Column) -> Column:
    """The DOIs of a text in their order, without trailing punctuation."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"({DOI})"), F.lit(1))
    return F.transform(found, lambda d: F.rtrim(d, F.lit(DOI_TAIL)))


def span_style(flags: Column) -> Column:
    italic, bold = flags.bitwiseAND(IMAGE_ITALIC) != 0, flags.bitwiseAND(IMAGE_BOLD) != 0
    return F.when(italic & bold, "bold-italic").when(italic, "italic").when(bold, "bold")


def shown(c: Column, most: int = 40) -> Column:
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most), F.lit("..."))).otherwise(c)


def place(row: Column, column: Column | None = None) -> Column:
    """A grid position as people count."""
    return F.format_string("row %d", row + 1) if column is None else F.format_string("row %d column %d", row + 1, column + 1)


def sentinel(printed: Column, caption: Column) -> Column:
    return F.format_string("[%s. %s]", F.upper(printed), caption)


def continuation_label(label: Column, page: Column) -> Column:
    return F.format_string("%s_p%d", label, page)


def retryable(status: Column) -> Column:
    return status.isNull() | (status == 429) | status.between(500, 599)


def retry_after(seconds: Column, default: float = 5.0, most: float = 60.0) -> Column:
    return F.least(F.greatest(F.coalesce(seconds.cast("double"), F.lit(default)), F.lit(0.0)), F.lit(most))


def dpi_rule(dpi: Column) -> Column:
    """dpi: a VARIANT. Whole numbers from 1 to 1200 pass."""
    whole = F.schema_of_variant(dpi) == "BIGINT"
    return F.when(~whole, "type").when(~F.try_variant_get(dpi, "$", "bigint").between(1, 1200), "range")


def registrar_record(authors: Column, year: Column, title: Column, container: Column, volume: Column, page: Column) -> Column:
    """The fields of a registrar's answer, three authors at most, joined for reading."""
    first = F.array_join(F.slice(authors, 1, 3), ", ")
    named = F.when(F.size(authors) > 3, F.concat(first, F.lit(" et al"))).otherwise(first)
    empty_out = lambda c: F.nullif(strip(c), F.lit(""))
    whole = F.concat_ws(". ", empty_out(named), F.when(year.isNotNull(), F.format_string("(%s)", year.cast("string"))), *[empty_out(c) for c in (title, container, volume, page)])
    return F.when(whole == "", "(registrar returned no fields)").otherwise(whole)

"""URL filters: rules first, then naive Bayes over the words of hosts and paths.

Concatenated host names are split into words by a Viterbi search under a unigram model, whose
counts come from the visible words of all pages. A multinomial naive Bayes model, trained on the
urls that a rule decides, scores the segmented host and the path tokens of the others.

Both models are tables of any size and nothing of them is left out. A host name gets the counts
of the words that it can hold by an equality join on its substrings, and is split with these
alone; tokens get their log ratios by an equality join, and each url sums them up.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import ascii_lower, hot_lookup, small_batches, written

# The rules, as (verdict, rule).
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
#: Characters of a name in a host, by the domain name system. Longer runs are no names; they are
#: split in stretches of so many characters.
NAME = 63
#: What an unknown stretch costs a character, beyond the cost of a word that occurs once.
UNKNOWN = 4.0
#: Log ratios are summed as whole numbers of this part, so sums don't depend on their order.
UNIT = 1e-9


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null or where :// is missing."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def viterbi(name: str, cost: dict[str, float], unseen: float) -> list[str]:
    """The cheapest split of a name into known words and unknown stretches.

    A stretch costs `unseen` and UNKNOWN a character. Of equal costs, a known word wins over a
    stretch, and a longer word over a shorter one.
    """
    lengths = sorted({len(w) for w in cost}, reverse=True)
    best, start, stretch = [0.0], [0], [(math.inf, 0)]
    for end in range(1, len(name) + 1):
        fresh, longer = best[end - 1] + unseen + UNKNOWN, stretch[end - 1][0] + UNKNOWN
        stretch.append((fresh, end - 1) if fresh < longer else (longer, stretch[end - 1][1]))
        found = [(best[end - n] + cost[name[end - n : end]], end - n) for n in lengths if n <= end and name[end - n : end] in cost]
        least, at = min([*found, stretch[end]], key=lambda x: x[0])
        best.append(least)
        start.append(at)
    out, end = [], len(name)
    while end:
        out.append(name[start[end] : end])
        end = start[end]
    return out[::-1]


def _runs(text: Column, most: int | None = None) -> Column:
    """Runs of ASCII letters and digits and of what lies beyond ASCII."""
    times = f"{{1,{most}}}" if most else "+"
    return F.regexp_extract_all(text, F.lit(r"([0-9a-z\x{80}-\x{10ffff}]" + times + ")"), F.lit(1))


def page_words(pages: DataFrame) -> tuple[DataFrame, int]:
    """(w, n): counts of the words of all pages' visible text that fit in a name, and the number of all words."""
    visible = F.regexp_replace(F.coalesce(F.col("html"), F.lit("")), r"(?is)<script.*?</script>|<style.*?</style>|<[^>]*>", " ")
    found = pages.select(F.explode(F.regexp_extract_all(F.lower(visible), F.lit(r"(\p{L}+)"), F.lit(1))).alias("w"))
    counts = written(found.groupBy(F.when(F.length("w") <= NAME, F.col("w")).alias("w")).agg(F.count(F.lit(1)).alias("n")), "url-words")
    return counts.where("w is not null"), counts.agg(F.sum("n")).first()[0] or 0


def segmented(names: DataFrame, words: DataFrame, total: int) -> DataFrame:
    """(name, words): distinct names of NAME characters at most, each split into words."""
    small_batches(names.sparkSession)
    parts = F.expr(f"explode(array_distinct(flatten(transform(sequence(1, length(name)), i -> transform(sequence(1, least({NAME}, length(name) - i + 1)), k -> substring(name, i, k))))))")
    subs = names.where("name <> ''").select("name", parts.alias("w"))
    # Which substrings are words at all, before any name is sent about: both sides are unique.
    known = written(subs.select("w").distinct().join(words, "w").select("w", "n"), "url-known")
    met = hot_lookup(written(subs, "url-substrings"), known, ["w"], ["name"]).where("n is not null")
    by = met.groupBy("name").agg(F.collect_list(F.struct("w", "n")).alias("known"))
    own = names.join(by, "name", "left").select("name", "known.w", "known.n")
    unseen = math.log(total + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for name, w, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                out.append(viterbi(name, {x: unseen - math.log(k) for x, k in zip(w or [], n or [], strict=True)}, unseen))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.string()))], ["name", "words"])

    return own.mapInArrow(run, "name string, words array<string>")


def tokens(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """rows: (row, host, path, said), written. Returns (row, said, token) of all rows, each token as
    often as it occurs: h: words of the host, p: parts of the path. Numbers are all one token."""
    names = written(rows.select("row", "said", F.explode(_runs(F.col("host"), NAME)).alias("name")), "url-names")
    number = lambda c: F.when(c.rlike(r"^[0-9]+\z"), F.lit("#"))
    split = segmented(written(names.select("name").distinct().where(number(F.col("name")).isNull()), "url-distinct"), *page_words(pages))
    split = written(split, "url-segments")
    of_host = hot_lookup(names, split, ["name"], ["row"])
    of_host = of_host.select("row", "said", F.explode(F.coalesce("words", F.array(number(F.col("name"))))).alias("token"), F.lit("h:").alias("kind"))
    part = F.col("token")
    of_path = rows.select("row", "said", F.explode(_runs(F.lower("path"))).alias("token"), F.lit("p:").alias("kind"))
    return of_host.unionByName(of_path).select("row", "said", F.concat("kind", F.coalesce(number(part), part)).alias("token"))


def ratios(found: DataFrame, urls: dict[str, int]) -> tuple[DataFrame, float, float]:
    """(token, ratio) of the tokens of urls that a rule decides, the ratio of other tokens, and the
    prior: log odds of block, by add-one smoothing over all tokens."""
    by = found.where("said is not null").groupBy("token").agg(*[F.count(F.when(F.col("said") == v, 1)).alias(v) for v in ("allow", "block")])
    by = written(by, "url-tokens")
    size, allow, block = by.agg(F.count(F.lit(1)), F.sum("allow"), F.sum("block")).first()
    least = [float((n or 0) + size + 1) for n in (allow, block)]
    ratio = F.log((F.col("block") + 1) / least[1]) - F.log((F.col("allow") + 1) / least[0])
    return by.select("token", ratio.alias("ratio")), math.log(least[0] / least[1]), math.log((urls.get("block", 0) + 1) / (urls.get("allow", 0) + 1))


def judged(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """pages: (page_id, url, html). Returns (page_id, host, path, rule, verdict, score).

    The rule's verdict stands; else the method blocks at a probability of one half or more. Null
    urls have an empty host and path and are judged as such, by the prior. Without any url that a
    rule decides the prior is even and the verdict block. Repeated rows come out as often; an empty
    table gives an empty result. Other columns of pages are not read.
    """
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    # Numbers of rows are read back, not made anew, so they stay as they are.
    rows = written(rows.withColumn("rule", rule).withColumn("said", verdict).withColumn("row", F.monotonically_increasing_id()), "url-rows")
    found = written(tokens(rows.select("row", "host", "path", "said"), pages.select("html")), "url-found")
    urls = {r["said"]: r["n"] for r in rows.where("said is not null").groupBy("said").agg(F.count(F.lit(1)).alias("n")).collect()}
    model, unseen, prior = ratios(found, urls)
    scaled = F.round(F.coalesce("ratio", F.lit(unseen)) / UNIT).cast("long")
    sums = hot_lookup(found.select("row", "token"), model, ["token"], ["row"]).groupBy("row").agg(F.sum(scaled).alias("sum"))
    z = F.coalesce(F.col("sum") * UNIT, F.lit(0.0)) + prior
    out = rows.join(sums, "row", "left").withColumn("score", 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(700.0)), F.lit(-700.0)))))
    return out.select("page_id", "host", "path", "rule", F.coalesce("said", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")

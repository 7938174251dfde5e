import math
import random
import re

from quillmark.llm import urls as U


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:n], rest[n:]
    m = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[:m]


def plain_rule(host, path):
    fits = [(len(r), r, v) for v, r in U.RULES for name, _, p in [r.partition("/")] if (host == name or host.endswith("." + name)) and path.startswith("/" + p)]
    return max(fits)[1:] if fits else (None, None)


def plain_split(name, counts, total):
    """The cheapest split by all splits' costs, over every stretch as a word or as unknown."""
    unseen = math.log(total + 1)
    best = [(0.0, ())]
    for end in range(1, len(name) + 1):
        ways = []
        for start in range(end):
            w = name[start:end]
            ways.append((best[start][0] + unseen + U.UNKNOWN * len(w), 1, best[start][1] + (w,)))
            if w in counts:
                ways.append((best[start][0] + unseen - math.log(counts[w]), 0, best[start][1] + (w,)))
        least = min(ways, key=lambda x: x[0])
        best.append((least[0], least[2]))
    return best[-1]


def plain_scores(pages):
    """Scores of all pages, by dictionaries over everything."""
    counts = {}
    for _, _, html in pages:
        text = re.sub(r"(?is)<script.*?</script>|<style.*?</style>|<[^>]*>", " ", html or "")
        for w in re.findall(r"[^\W\d_]+", text.lower()):
            counts[w] = counts.get(w, 0) + 1
    total = sum(counts.values())
    rows = []
    for _, u, _ in pages:
        host, path = plain(u)
        found = []
        for kind, text, most in (("h", host, U.NAME), ("p", path.lower(), 10**9)):
            for run in re.findall(r"[0-9a-z\x80-\U0010ffff]+", text):
                for part in (run[i : i + most] for i in range(0, len(run), most)):
                    words = plain_split(part, counts, total)[1] if kind == "h" and not re.fullmatch("[0-9]+", part) else (part,)
                    found += [f"{kind}:#" if re.fullmatch("[0-9]+", w) else f"{kind}:{w}" for w in words]
        rows.append((plain_rule(host, path)[1], found))
    sides = {v: {} for v in ("allow", "block")}
    for said, found in rows:
        for t in found if said else []:
            sides[said][t] = sides[said].get(t, 0) + 1
    size = len(set().union(*sides.values()))
    least = {v: sum(c.values()) + size + 1 for v, c in sides.items()}
    prior = math.log((sum(s == "block" for s, _ in rows) + 1) / (sum(s == "allow" for s, _ in rows) + 1))
    out = []
    for _, found in rows:
        z = prior + sum(math.log((sides["block"].get(t, 0) + 1) / least["block"]) - math.log((sides["allow"].get(t, 0) + 1) / least["allow"]) for t in found)
        out.append(1 / (1 + math.exp(-max(-700.0, min(700.0, z)))))
    return out


URLS = [
    "http://a.example.net/fr/1", "https://WWW.Example.NET/en/2?x=1", "http://example.net/en", "http://net/x", "http://net", "http://fishnet/x",
    "https://b.org/fr/9#t", "https://b.org/de/9", "http://example.com/de/", "http://xexample.com/de/1", "http://c.example.com/de/q?y=://z/", None, "", "no scheme",
    "://h/p", "a://b://c/d", "http://É.org/fr/é", "http://h\n.net/\n", "http:///p", "http://h?x/y", "x" * 5000, "http://" + "ab" * 400 + ".org/en/", "http://adstrack.example.org/en/1",
]


def test_hosts_paths_rules_and_verdicts(spark):
    pages = [(i, u, "<p>ads track the fish net " + "shop " * 3 + "</p><script>var hidden</script>") for i, u in enumerate(URLS)]
    pages += [(i, f"http://spam{i}.example.net/fr/{i}", None) for i in range(100, 120)] + [(i, f"http://good{i}.org/fr/{i}", "") for i in range(200, 220)]
    pages += [(None, "http://a.net/", "x"), (3, URLS[3], "y")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'h' as host", "'s' as said", "5 as `row`")
    got = U.judged(df).collect()
    assert len(got) == len(pages)
    by = {r.page_id: r for r in got}
    for i, u, _ in pages:
        host, path = plain(u)
        rule, verdict = plain_rule(host, path)
        assert (by[i].host, by[i].path, by[i].rule) == (host, path, rule)
        assert by[i].verdict == (verdict or ("block" if by[i].score >= 0.5 else "allow"))
    assert U.judged(df.limit(0)).count() == 0
    assert U.judged(df.where("url like '%b.org/de%'")).collect()[0].rule is None


def test_scores_match_brute_force(spark):
    rng = random.Random(1)
    words = ["fish", "net", "shop", "ads", "track", "the", "blue", "é", "a"]
    pages = []
    for i in range(80):
        name = "".join(rng.choice([*words, "zq"]) for _ in range(rng.randint(1, 4)))
        url = f"http://{name}{rng.choice(['', '7'])}.{rng.choice(['example.net', 'example.com', 'org', 'shop42'])}/{rng.choice(['en', 'fr', 'de'])}/{rng.choice(words)}-{i % 5}"
        pages.append((i, url, f"<p>{' '.join(rng.choice(words) for _ in range(8))}</p>" if i % 6 else None))
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.score for r in U.judged(df).collect()}
    for (i, _, _), want in zip(pages, plain_scores(pages), strict=True):
        assert abs(got[i] - want) < 1e-6


def test_viterbi_finds_the_cheapest_split():
    counts = {"ads": 50, "track": 40, "ad": 30, "strack": 1, "the": 100}
    total = sum(counts.values())
    cost = {w: math.log(total + 1) - math.log(n) for w, n in counts.items()}
    split = lambda name: U.viterbi(name, cost, math.log(total + 1))
    assert split("adstrack") == ["ads", "track"] and split("") == []
    assert split("thezzads") == ["the", "zz", "ads"]
    assert split("q" * 3000) == ["q" * 3000]
    rng = random.Random(2)
    price = lambda words: sum(cost.get(w, math.log(total + 1) + U.UNKNOWN * len(w)) for w in words)
    for _ in range(200):
        name = "".join(rng.choice(["ads", "tr", "ack", "the", "x", "ad"]) for _ in range(rng.randint(1, 6)))
        got = split(name)
        assert "".join(got) == name and price(got) <= plain_split(name, counts, total)[0] + 1e-9

import hashlib
import random

import numpy as np

from quillmark.llm import edits as X
from quillmark.llm import grouped
from quillmark.llm.common import written


def test_walk_continues_where_it_was_cut():
    rng = np.random.default_rng(1)
    s = rng.integers(0, 16, 40_000).astype(np.uint8)
    whole = X.walk(s)
    cut = X.walk(s[:12_345])
    rest = X.walk(s[12_345:], int(cut[-1]))
    assert (np.concatenate([cut[:-1], rest]) == whole).all()
    waits = np.diff(whole)
    assert waits.min() >= 1 and waits.max() <= X.MOST and 1.9 < waits.mean() < 2.1


def test_likeness_follows_edits():
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh nopqrst") for _ in range(4000))
    other = "".join(rng.choice("abcdefgh nopqrst") for _ in range(4000))
    small = text[:1000] + "xyz" + text[1003:2500] + text[2504:]
    p = X.Printed(text).print
    assert X.likeness(p, X.Printed(text).print) == 1
    assert X.likeness(p, X.Printed(small).print) > 0.85
    assert X.likeness(p, X.Printed(other).print) < 0.3
    assert X.likeness(X.Printed("").print, X.Printed(None).print) == 1
    assert X.likeness(X.Printed("").print, p) == 0


def brute(docs):
    order = sorted(docs, key=lambda d: -d[0])
    out = {}
    for i, (d, t) in enumerate(order):
        following = order[(i + 1) % len(order)][1] or ""
        t = t or ""
        half = len(t) // 2
        out[d] = (len(t), hashlib.sha256((t[: len(t) - half] + following[:half]).encode()).hexdigest())
    return out


def test_query_matches_brute_force(spark):
    rng = random.Random(3)
    docs = [(i, "".join(rng.choice("abç d\U0001f600") for _ in range(rng.choice((0, 1, 2, 7, 300))))) for i in range(60)] + [(60, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumnRenamed("x", "x").selectExpr("*", "1 as n_chars", "'k' as part")
    got = {r.doc_id: r for r in X.with_edits(df).collect()}
    want = brute(docs)
    assert {d: (r.n_chars, r.edited_sha256) for d, r in got.items()} == want
    texts = {d: t or "" for d, t in docs}
    for d, r in got.items():
        assert r.fingerprint == X.Printed(texts[d]).print
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert X.with_edits(df.limit(0)).count() == 0
    assert X.with_edits(df.limit(1)).count() == 1


def classes_of(pairs, n):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        root[find(a)] = find(b)
    return [find(i) for i in range(n)]


def family(seed, n, length, edits):
    rng = random.Random(seed)
    base = [rng.choice("abcdefgh nopqrst") for _ in range(length)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(rng.randint(0, edits)):
            at = rng.randrange(len(t))
            t[at : at + rng.randint(0, 2)] = rng.choice("xyzuvw") * rng.randint(0, 2)
        out.append("".join(t))
    return out


def test_near_classes_against_all_pairs(spark, monkeypatch):
    """Families of edits whose likenesses lie on both sides of the threshold, and their recall."""
    texts = [t for k in range(12) for t in family(k, 14, 1500, 40)] + [t for k in range(12, 20) for t in family(k, 8, 60, 3)] + ["", "a", "ab", "b"]
    prints = [X.Printed(t).print for t in texts]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if X.likeness(prints[i], prints[j]) >= X.NEAR]
    far = [(i, j) for i in range(len(texts)) for j in range(i) if 0.5 < X.likeness(prints[i], prints[j]) < X.NEAR]
    assert len(near) > 200 and len(far) > 200
    for few, members, n in ((8, 1024, len(texts)), (2, 4, 60)):
        monkeypatch.setattr(grouped, "FEW", few)
        monkeypatch.setattr(grouped, "MEMBERS", members)
        near = [(i, j) for i, j in near if i < n]
        rows = spark.createDataFrame(list(enumerate(prints[:n])), "doc_id long, fingerprint string")
        got = {r.doc_id: r.class_id for r in X.with_classes(rows).collect()}
        want = classes_of(near, n)
        # No class joins what links do not connect, and at least 95 % of the links are kept.
        assert all(want[i] == want[got[i]] for i in range(n))
        assert sum(got[i] == got[j] for i, j in near) >= 0.95 * len(near)


def test_classes_of_copies_and_nulls(spark):
    p, q = X.Printed("one text " * 9).print, X.Printed("quite another " * 9).print
    rows = [(3, p), (2, p), (None, p), (None, q), (7, X.Printed("").print)]
    df = spark.createDataFrame(rows, "doc_id long, fingerprint string").selectExpr("*", "5 as node")
    got = sorted(((r.doc_id, r.class_id, r.class_rows, r.node) for r in X.with_classes(df).collect()), key=str)
    assert got == sorted([(3, 2, 3, 5), (2, 2, 3, 5), (None, 2, 3, 5), (None, None, 1, 5), (7, 7, 1, 5)], key=str)
    assert X.with_classes(df.limit(0)).count() == 0


def test_openings_count(spark):
    """A change of the first characters shows in the fingerprint."""
    text = "".join(random.Random(5).choice("abcdefgh nopqrst") for _ in range(5000))
    a, b = X.Printed(text).print, X.Printed("QQQQQQQQ" + text[8:]).print
    assert a != b and 0.9 < X.likeness(a, b) < 1


def test_null_and_repeated_ids_ties_and_long_texts(spark):
    long = "ab c" * 60_000
    docs = [(None, "last one here"), (5, "x y z"), (5, "x y z"), (5, long), (9, ""), (None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = X.with_edits(df.repartition(3)).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in got) == sorted((str(d), len(t or "")) for d, t in docs)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, X.with_edits(df).collect()), key=str)
    same = [r.fingerprint for r in got if r.n_chars == 5]
    assert len(same) == 2 and len(set(same)) == 1


def test_blocks_give_fewer_links_than_members(spark):
    """A head unlike all others, which are near to each other in two families: no links in squares."""
    n = 120
    nodes = written(spark.range(n).selectExpr("id as node", "array(7L) as keys"), "test-nodes")

    def compare(payload, asks, there):
        ids = payload[0].to_numpy()
        hits = [there[(ids[there] > 0) & (ids[there] % 2 == ids[i] % 2) & (ids[i] > 0)] for i in asks]
        return np.repeat(asks, [len(x) for x in hits]), np.concatenate(hits)

    got = [(r.a, r.b) for r in grouped.linked(nodes, lambda pairs: pairs.where("false"), lambda rows: rows.withColumn("id", rows["node"]), compare, "test").collect()]
    assert len(got) < n
    want = classes_of([(i, j) for i in range(1, n) for j in range(1, i) if (i - j) % 2 == 0], n)
    found = classes_of(got, n)
    assert all((found[i] == found[j]) == (want[i] == want[j]) for i in range(n) for j in range(n))

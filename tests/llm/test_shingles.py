import random

import numpy as np

import corpus_pipeline
from quillmark.llm import grouped, shingles, simhash
from quillmark.llm.common import written


def brute(docs):
    """Ids kept: the smallest of each component of pairs at a Jaccard similarity of 0.8 or more."""
    sets = []
    for _, t in docs:
        w = (t or "").lower().split()
        k = min(5, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 10 * len(a & b) >= 8 * len(a | b):
                root[find(i)] = find(j)
    groups = {}
    for i, d in enumerate(docs):
        groups.setdefault(find(i), []).append(d[0])
    return sorted(min(g) for g in groups.values())


def edited(rng, base, n):
    w = list(base)
    for at in rng.sample(range(5, len(w) - 5), n):
        w[at] = f"x{rng.random()}"
    return w


def documents():
    """Pairs on both sides of 0.8, and a family whose members differ in up to a third of their shingles."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(3))
    docs = []
    for i in range(250):
        base = [word() for _ in range(rng.choice((60, 150, 300)))]
        # Each replaced word takes five shingles: from well above 0.8 to well below.
        docs += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(edited(rng, base, rng.randint(1, max(2, len(base) // 28)))))]
    base = [word() for _ in range(200)]
    docs += [(1000 + i, " ".join(edited(rng, base, rng.randint(0, 9)))) for i in range(60)]
    return [*docs, (2000, None), (2001, ""), (2002, "a b"), (2003, "A  b"), (2004, "a b c")]


def test_stage_is_exact(spark):
    docs = documents()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.distinct(spark, df, "").collect()) == brute(docs)


def test_blocks_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(grouped, "MEMBERS", 8)
    monkeypatch.setattr(grouped, "FEW", 2)
    docs = documents()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.one_of_each(df).collect()) == brute(docs)
    assert simhash.one_of_each(df.limit(0)).count() == 0


def test_names_of_columns_nulls_and_repeated_rows(spark):
    rows = [(1, "a b c d e f", 5, "x"), (1, "a b c d e f", 5, "x"), (1, "a b c d e f", 6, "y"), (None, "a b c d e f", 1, "z"), (None, "lone words that stay", 2, "z"), (None, None, 3, None), (4, "", 4, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _s_hash long, `n.x` string").selectExpr("*", "1 as id", "2 as tie", "3 as row")
    got = simhash.one_of_each(df)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == [(1, "a b c d e f"), (4, ""), (None, "lone words that stay")]
    again = [r for r in simhash.one_of_each(df.repartition(5)).collect() if r.doc_id == 1]
    assert again == [r for r in got.collect() if r.doc_id == 1]


def test_fingerprints_of_sets():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 255, 256, 1500):
        found = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        got = [int(x) & (1 << 64) - 1 for x in simhash.set_fingerprint(found, 3)]
        for lane in range(3):
            bits = [[int(h) >> b & 1 for b in range(64)] for h in simhash._mixed(found, lane)]
            assert got[lane] == sum(1 << b for b in range(64) if 2 * sum(x[b] for x in bits) + b % 2 > n)


def test_index_connects_sets_at_the_threshold(spark, monkeypatch):
    """Pairs at a similarity of exactly 0.8, whatever the number of parts that the rows are dealt to."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        n = (8, 40, 320)[i % 3]
        common, own = (rng.integers(0, 1 << 63, k, dtype=np.uint64) for k in (n, n // 4))
        for side, s in enumerate((np.append(common, own[: n // 8]), np.append(common, own[n // 8 :]))):
            rows.append((2 * i + side, simhash.set_fingerprint(s).tolist()))
    sets = written(spark.createDataFrame(rows, "node long, lanes array<long>"), "test-sets")
    found = []
    for met in (1 << 15, 16):
        monkeypatch.setattr(simhash, "MET", met)
        found.append({(min(r.a, r.b), max(r.a, r.b)) for r in simhash.set_links(sets).collect()})
    assert found[0] == found[1]
    assert all(a // 2 == b // 2 for a, b in found[0]) and len(found[0]) >= 0.99 * 400
    assert simhash.set_links(sets.limit(0)).count() == 0


def test_stage_takes_its_candidates_from_fingerprints(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    docs = [(1, " ".join(base)), (2, " ".join(edited(rng, base, 2))), (3, " ".join(base).upper())]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert [r.doc_id for r in simhash.one_of_each(df).collect()] == [1]
    monkeypatch.setattr(shingles, "set_links", lambda sets: spark.createDataFrame([], "a long, b long"))
    assert sorted(r.doc_id for r in simhash.one_of_each(df).collect()) == [1, 2]


def test_tiny_texts_are_exact(spark):
    """Whatever the fingerprints of few shingles say."""
    rng = random.Random(10)
    docs = []
    for i in range(150):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(6, 13))]
        docs += [(3 * i, " ".join(base)), (3 * i + 1, " ".join(base[:-1])), (3 * i + 2, " ".join(["new", *base[1:]]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.one_of_each(df).collect()) == brute(docs)

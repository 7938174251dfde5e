import random

from pyspark.sql import functions as F

from quillmark.llm import mixing as M


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, free, target = sum(sizes.values()), set(names), {}
    while True:
        left = total - sum(target.values())
        level = left / max(1e-300, sum(w[s] for s in free)) if free else 0
        over = [s for s in free if level * w[s] > cap * sizes[s]]
        if not over:
            return target | {s: level * w[s] for s in free}
        for s in over:
            target[s] = float(cap * sizes[s])
            free.discard(s)


def docs_of(seed, n, sources):
    rng = random.Random(seed)
    return [(i, " ".join("w" for _ in range(int(rng.lognormvariate(3, 1)))), rng.choice(sources)) for i in range(n)]


def test_targets_and_copies(spark):
    for seed, sources in ((1, ["a", "b", "c", None, "é", "Z"]), (2, ["s"] * 20 + ["t", "u", "v"]), (3, [None])):
        docs = docs_of(seed, 900, sources) + [(5000, None, "a"), (5001, "", "empty"), (5001, " \n ", "empty"), (7, "w w", "t")]
        df = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("*", "1 as size", "2 as copies")
        got = M.with_copies(df).select("doc_id", "source", "size", "source_size", "target", "copies").collect()
        assert len(got) == len(docs)
        sizes = {}
        for _, t, s in docs:
            sizes[s] = sizes.get(s, 0) + len((t or "").split())
        want = brute_targets(sizes)
        taken, largest = {}, {}
        for r in got:
            assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
            assert 0 <= r.copies <= 3
            taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
            largest[r.source] = max(largest.get(r.source, 0), r.size)
        for s, t in taken.items():
            assert abs(t - want[s]) <= 3 * largest[s], (s, t, want[s])
        again = M.with_copies(df.repartition(7)).select("doc_id", "source", "size", "source_size", "target", "copies").collect()
        assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)


def test_mix_repeats_rows_and_keeps_columns(spark):
    docs = docs_of(5, 200, ["a", "b"])
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("doc_id", "text", "'x' as lang", "source")
    copies = {r.doc_id: r.copies for r in M.with_copies(df, ).collect()}
    got = M.mixed(df)
    assert got.columns == df.columns
    n = {}
    for r in got.collect():
        n[r.doc_id] = n.get(r.doc_id, 0) + 1
    assert n == {d: c for d, c in copies.items() if c}
    assert M.mixed(df.limit(0)).count() == 0


def test_null_ids_ties_and_very_long_texts(spark):
    docs = [(None, "a b", "s"), (None, "a b", "s"), (1, "w " * 300_000, "s"), (2, "w", None), (2, "w", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("*", "7 as `_m_size`", "8 as `row`")
    got = M.mixed(df)
    assert got.columns == df.columns
    n = sum(len((r.text or "").split()) for r in got.collect())
    assert n <= 3 * sum(len(t.split()) for _, t, _ in docs)
    sizes = M.with_copies(M.sized(df), size=F.col("words")).collect()
    assert sorted(r.size for r in sizes) == [1, 1, 2, 2, 300_000]

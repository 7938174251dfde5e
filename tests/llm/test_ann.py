import numpy as np
from pyspark.sql import functions as F

from quillmark.llm import ann as A


def exact(rows, query, k):
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(v) and len(v) == 8 and i is not None]
    out = {}
    for i, v in good:
        if query(i):
            near = sorted(((-float((w * v).sum()), j) for j, w in good if j != i))[:k]
            out[i] = [(j, -s) for s, j in near]
    return out


def test_recall_scores_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 8))
    rows = [(i, [float(x) for x in centres[i % 12] + 0.3 * rng.normal(size=8)]) for i in range(1500)]
    rows += [(2000 + i, [10 * x for x in rows[40][1]]) for i in range(60)]
    rows += [(3000, None), (3020, [0.0] * 8), (3040, [1.0] * 7 + [None]), (3060, [1.0] * 7 + [float("nan")]), (3080, [float("inf")] * 8), (3100, [1.0] * 3), (None, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as label", "2 as q")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = {}
    for r in A.search(df, F.col("vec_id") % 20 == 0, probes=10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = exact(rows, lambda i: i % 20 == 0, 20)
    assert set(got) == set(want)
    hits = 0
    for q, w in want.items():
        g = sorted(got[q])
        assert [r for r, _, _ in g] == list(range(1, 21))
        assert sorted(g, key=lambda x: (-x[2], x[1])) == g and q not in [i for _, i, _ in g]
        hits += len({i for i, _ in w} & {i for _, i, _ in g})
    assert hits / sum(map(len, want.values())) >= 0.9
    # Of sixty equal vectors the smallest ids come first.
    assert [i for _, i, _ in sorted(got[2000])] == list(range(2001, 2021))


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = A.search(df, F.col("vec_id") % 20 == 0, probes=32).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(0, 1, 1, 0.5), (0, 2, 2, 0.0)]
    assert A.search(df.limit(1), F.col("vec_id") % 20 == 0).count() == 0
    assert A.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(8, 16))[rng.integers(0, 8, 1000)] + 0.1 * rng.normal(size=(1000, 16))
    graph = A.neighbour_graph(x)
    label = A.balanced_parts(x, graph, 8)
    assert np.bincount(label, minlength=8).max() <= 1.15 * 1000 / 8
    cut = (label[np.repeat(np.arange(1000), 10)] != label[graph.ravel()]).mean()
    assert cut < 0.3


def test_blocks_agree_with_one_block(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    take = lambda: sorted(map(tuple, A.search(df, F.col("vec_id") % 20 == 0, parts=4, probes=4).collect()))
    whole = take()
    monkeypatch.setattr(A, "ROW_BLOCK", 20)
    monkeypatch.setattr(A, "QUERY_BLOCK", 4)
    assert take() == whole


def test_few_rows_come_out_whole_with_the_default_probes(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(45)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for n in (15, 45):
        want = exact(rows[:n], lambda i: i % 20 == 0, 20)
        got = {}
        for r in A.search(df.where(F.col("vec_id") < n), F.col("vec_id") % 20 == 0).collect():
            got.setdefault(r.query_id, []).append(r.vec_id)
        assert {q: len(x) for q, x in got.items()} == {q: len(w) for q, w in want.items()}
        if n == 15:
            assert {q: set(x) for q, x in got.items()} == {q: {i for i, _ in w} for q, w in want.items()}


def test_queries_that_find_too_few_rows_go_on(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=8)]) for i in range(15)], "vec_id long, embedding array<double>")
    assert A.search(df, F.col("vec_id") % 20 == 0, probes=1).count() == 14


def test_recall_at_the_default_parameters_without_clusters(spark):
    """Vectors that scatter their neighbours: the hardest case for learned parts."""
    rng = np.random.default_rng(7)
    v = rng.normal(size=(3000, 32))
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "vec_id long, embedding array<double>")
    got = {}
    for r in A.search(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 3000, 20):
        s = v @ v[q]
        s[q] = -np.inf
        hits += len(set(np.argsort(-s)[:20].tolist()) & got[q])
    assert hits / (150 * 20) >= 0.9


def test_rows_that_share_an_id(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.1, 0.5]), (1, [0.9, 0.0]), (2, [0.5, 0.0]), (0, [0.0, 1.0])], "vec_id long, embedding array<double>")
    got = A.search(df, F.col("vec_id") % 20 == 0).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in got) == [(1, 1, 0.9), (2, 2, 0.5)]

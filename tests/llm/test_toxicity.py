import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from quillmark.llm import toxicity as T


def corpus(n=400):
    rng = random.Random(1)
    syllables = "an in er on th re ti es or".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    docs, labels = [], []
    for i in range(n):
        w = [word() for _ in range(rng.randint(20, 200))]
        bad = i % 4 == 0
        for _ in range(rng.randint(2, 5) if bad else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["scum", "Moron", "vexju" + word()]))
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return docs, labels


def test_held_out_accuracy_and_folds(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "0 as score")
    model = T.trained(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r for r in T.scored(d, model).withColumn("held", T.held_out(F.col("doc_id"))).collect()}
    for i, _ in docs:
        assert got[i].held == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= got[i].score <= 1 and got[i].predicted == (got[i].score >= 0.5)
    held = [i for i, _ in docs if got[i].held]
    assert np.mean([got[i].predicted == labels[i][1] for i in held]) > 0.93


def test_labels_of_held_out_rows_are_never_read(spark):
    docs, labels = corpus(200)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    a, b = (T.trained(d, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, flipped))
    assert (a.weights == b.weights).all() and a.bias == b.bias


def test_odd_rows(spark):
    docs, labels = corpus(120)
    d = spark.createDataFrame(docs + [(None, "x"), (900, None), (901, ""), (902, "é" * 3_000_000), (3, docs[3][1])], "doc_id long, text string").selectExpr("*", "'c' as f", "1 as toxic")
    l = spark.createDataFrame(labels + [(None, 1), (5, None), (901, 0)], "doc_id long, toxic int")
    model = T.trained(d, l)
    rows = T.scored(d, model).collect()
    assert len(rows) == 125 and all(0 <= r.score <= 1 for r in rows)
    one = T.trained(d, l.where("toxic = 0"))
    assert T.scored(d, one).where("predicted = 1").count() == 0
    none = T.trained(d.limit(0), l.limit(0))
    assert T.scored(d.limit(0), none).count() == 0 and none.score("x") == 0.5
    kept = T.without_toxic(d, model)
    assert kept.columns == d.columns and kept.count() == 125 - T.scored(d, model).where("predicted = 1").count()


def test_features_of_pieces_are_those_of_the_whole(monkeypatch):
    text = "".join(chr(97 + i * i % 26) for i in range(5000))
    whole = T.features(text)
    monkeypatch.setattr(T, "PIECE", 100)
    assert sorted(T.features(text)) == sorted(whole)


def plain_features(text):
    """Hashed n-grams by slicing, one by one."""
    low = "".join(" " if c in "\t\n\v\f\r" else chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in f" {text or ' '} ")
    out = set()
    for n in T.GRAMS:
        for i in range(len(low) - n + 1):
            h = 0
            for c in low[i : i + n]:
                h = (h * 0x01000193 + ord(c)) % 2**32
            out.add(((h ^ (n - 1)) * 0x9E3779B1 % 2**32) >> (32 - T.BITS))
    return out


def test_scores_match_brute_force(spark):
    docs, labels = corpus(160)
    docs = [(i, t + (" é\U0001f600 " if i % 7 == 0 else "")) for i, t in docs] + [(500, None), (501, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    model = T.trained(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    y = dict(labels)
    train = [(plain_features(t), y[i]) for i, t in docs if i in y and zlib.crc32(str(i).encode()) % 5]
    toxic, clean = (sum(v == k for _, v in train) for k in (1, 0))
    for f in list(train[0][0])[:200]:
        a, b = (sum(f in x for x, v in train if v == k) for k in (1, 0))
        want = np.log(a / toxic + T.SMOOTH) - np.log(b / clean + T.SMOOTH)
        got = T.ratios([np.array(sorted(x)) for x, _ in train], np.array([v for _, v in train]))[f]
        assert abs(want - got) < 1e-9
    # The loss that the fit minimises, by plain sums: no worse than what plain gradient steps reach.
    r = T.ratios([np.array(sorted(x)) for x, _ in train], np.array([v for _, v in train]))
    used = sorted(set().union(*(x for x, _ in train)))
    x = np.array([[r[f] if f in s else 0.0 for f in used] for s, _ in train])
    t = np.array([v for _, v in train], dtype=float)

    def loss(w, b):
        z = x @ w + b
        return np.mean(np.logaddexp(0, z) - t * z) + 0.5e-4 * w @ w

    w, b, rate = np.zeros(len(used)), 0.0, 2.0 / ((x * x).sum(1).mean() + 1)
    for _ in range(300):
        g = (1 / (1 + np.exp(-(x @ w + b))) - t) / len(t)
        w, b = w - rate * (x.T @ g + 1e-4 * w), b - rate * g.sum()
    scale = np.array([1 / r[f] if r[f] else 0.0 for f in used])
    assert loss(model.weights[used] * scale, model.bias) <= loss(w, b) + 0.02
    for row in T.scored(d, model).collect():
        text = dict(docs)[row.doc_id]
        z = model.bias + sum(float(model.weights[f]) for f in plain_features(text))
        assert abs(row.score - 1 / (1 + np.exp(-z))) < 1e-5

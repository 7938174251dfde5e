import random
import re

import numpy as np
import xxhash

from quillmark.llm import components as G
from quillmark.llm import simhash as S


def plain_fingerprint(text, k=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not w:
        return 0
    sh = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(docs, limit=4):
    f = [plain_fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if bin(f[i] ^ f[j]).count("1") <= limit:
                a, b = find(i), find(j)
                root[a] = b
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return sorted(((d, format(f[i], "016x"), least.get(find(i))) for i, (d, _) in enumerate(docs)), key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"Word{i}é" for i in range(300)]
    docs = []
    for i in range(n):
        if docs and rng.random() < 0.5:
            w = (rng.choice(docs)[1] or "").split(" ")
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
        else:
            w = [rng.choice(vocabulary) for _ in range(rng.choice((1, 2, 3, 4, 5, 40, 200)))]
        docs.append((rng.randrange(10**6), " ".join(w)))
    return docs + [(7, None), (8, ""), (6, " \t\n"), (None, docs[0][1]), (None, "no id here"), (9, docs[1][1].upper()), (docs[2][0], docs[2][1])]


def test_matches_brute_force(spark):
    docs = corpus(1, 250)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as fp0", "2 as node")
    got = S.near_duplicates(df).select("doc_id", S.hex_digits("fp0").alias("f"), "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(docs)
    assert S.near_duplicates(df.limit(0)).count() == 0


def test_links_lose_no_component():
    """Random and clustered fingerprints, small and large keys: as union over all pairs."""
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = [int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)) for c in centre for _ in range(400)]
    fps = np.array(sorted(set(fps)), dtype=np.uint64)

    def entries(x):
        out = []
        for s, (shift, bits) in enumerate(S.SEGMENTS):
            v = x >> shift & ((1 << bits) - 1)
            out.append(((s << 22) + v) * 2 + 1)
            out += [((s << 22) + (v & ~(1 << k))) * 2 for k in range(bits) if v >> k & 1]
        return out

    pairs = sorted((e, i) for i, x in enumerate(fps.tolist()) for e in entries(x))
    entry, who = np.array([e for e, _ in pairs]), np.array([i for _, i in pairs])
    a, b = S._linked(entry, fps[who].view(np.int64).reshape(-1, 1), 4)
    got = S._smallest(len(fps), who[a], who[b])
    u, v = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)
    assert (got == S._smallest(len(fps), u, v)).all()
    assert len(a) < len(entry)


def test_index_entries_in_spark(spark):
    values = [0, 1, -1, 1 << 62, -(1 << 63), 0x799105063924CC8B]
    df = spark.createDataFrame([(v, w) for v in values for w in values], "fp0 long, fp1 long")
    for r in df.select("*", S.index_entries(2).alias("e")).collect():
        want = []
        for lane, x in enumerate((r.fp0, r.fp1)):
            for s, (shift, bits) in enumerate(S.SEGMENTS):
                v = (x & (1 << 64) - 1) >> shift & ((1 << bits) - 1)
                base = (lane * 3 + s) << 22
                want += [(base + v) * 2 + 1] + [(base + (v & ~(1 << k))) * 2 for k in range(bits) if v >> k & 1]
        assert sorted(r.e) == sorted(want)


def test_components_on_paths_stars_and_loops(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5), (-3, 7), (7, -3), (7, -3)]
    ids = list(range(100, 161))
    rng.shuffle(ids)
    edges += [(ids[i] * 1000, ids[i + 1] * 1000) for i in range(60)]
    got = {r.node: r.root for r in G.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(1000, 1100)} == {1000}
    assert got[-3] == got[7] == -3 and 5 not in got
    assert {got[i * 1000] for i in ids} == {100_000}
    assert G.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_group_stays(spark):
    rng = random.Random(4)
    text = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    base = [text(400) for _ in range(6)]
    near = [b.replace(b.split(" ")[200], "changed", 1) for b in base]
    docs = [(i, b, "s") for i, b in enumerate(base)] + [(10 + i, b, "s") for i, b in enumerate(near)] + [(20, base[0], "t"), (0, base[0], "s"), (30, text(300), None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = S.one_of_each(df)
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == [0, 1, 2, 3, 4, 5, 30]


def test_long_texts_count_in_pieces(monkeypatch):
    rng = random.Random(6)
    text = " ".join(f"w{rng.randrange(300)}" for _ in range(2500))
    want = plain_fingerprint(text)
    monkeypatch.setattr(S, "PIECE", 64)
    assert S.fingerprint(text)[0] & (1 << 64) - 1 == want

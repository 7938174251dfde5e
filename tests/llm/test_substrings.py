import hashlib
import random
import re

from quillmark.llm import substrings as S


def brute(docs, n):
    first = {}
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, (_, t) in enumerate(docs)}
    ids = [d if d is not None else S._LAST for d, _ in docs]
    for i, w in words.items():
        for j in range(len(w) - n + 1):
            k = tuple(w[j : j + n])
            first[k] = min(first.get(k, S._LAST), ids[i])
    out = []
    for i, w in words.items():
        gone = [False] * len(w)
        for j in range(len(w) - n + 1):
            if first[tuple(w[j : j + n])] < ids[i]:
                gone[j : j + n] = [True] * n
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((docs[i][0], len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n, words=40):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    text = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    shared = [text(rng.randint(8, 40)) for _ in range(6)]
    docs = []
    for i in range(n):
        parts = [text(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared), text(rng.randint(0, 20))]
        docs.append((i * 7 % 101, "\n".join(parts)))
    docs += [(200, docs[0][1]), (201, docs[0][1]), (200, docs[0][1]), (3, docs[1][1] + " tail"), (202, None), (203, ""), (None, docs[2][1]), (None, shared[0]), (204, "a " * 60), (205, "a " * 80)]
    return docs


def test_matches_brute_force(spark):
    for seed in (1, 2):
        docs = corpus(seed, 60)
        df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' as key", "1 as p", "2 as `_w_x`", "3 as `row`")
        for options in ({"window": 10, "anchor": 4}, {"window": 10, "anchor": 4, "shard_words": 30, "stream_words": 50}):
            got = S.deduplicated(df, **options).select("row.doc_id", "words", "removed", "sha").collect()
            assert sorted(map(tuple, got), key=str) == brute(docs, 10)


def test_stage_keeps_columns_and_untouched_texts(spark):
    docs = [(1, " ".join(map(str, range(30))) + "\n", 70), (2, "new  words " + " ".join(map(str, range(5, 25))), 5), (3, " ".join(map(str, range(30))), 6), (4, None, None), (5, " as it  is", 9)]
    df = spark.createDataFrame(docs, "doc_id long, text string, n_chars long").selectExpr("*", "'k' as `_w_x`", "text as words")
    assert S.without_repeats(df, window=10, anchor=4).columns == df.columns
    got = {r.doc_id: r for r in S.without_repeats(df, window=10, anchor=4).collect()}
    assert set(got) == {1, 2, 4, 5}
    assert got[1].text == docs[0][1] and got[5].text == " as it  is" and got[4].text is None
    assert got[2].text == "new words" and got[2].n_chars == 9
    assert S.deduplicated(df.limit(0)).count() == 0


def test_automaton_spans():
    rng = random.Random(5)
    for _ in range(100):
        refs = [[rng.choice(b"abc")for _ in range(rng.randint(1, 30))] for _ in range(3)]
        refs = [[bytes([x]) for x in r] for r in refs]
        query = [bytes([rng.choice(b"abc")]) for _ in range(40)]
        a = S.Automaton()
        for r in refs:
            a.add(r)
        grams = {tuple(r[i : i + 4]) for r in refs for i in range(len(r) - 3)}
        want = [False] * 40
        for i in range(37):
            if tuple(query[i : i + 4]) in grams:
                want[i : i + 4] = [True] * 4
        got = [False] * 40
        for x, y in a.spans(query, 4):
            got[x:y] = [True] * (y - x)
        assert got == want


def test_very_long_texts_and_long_owners(spark):
    """A document far longer than a shard, which later ones repeat here and there and as a whole."""
    rng = random.Random(9)
    words = [f"w{rng.randrange(400)}" for _ in range(6000)]
    docs = [(1, " ".join(words)), (2, " ".join(words[100:400] + ["x"] + words[3000:3700])), (3, " ".join(words[:5999])), (4, " ".join(f"y{i}" for i in range(200)))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = S.deduplicated(df, window=10, anchor=4, shard_words=500, stream_words=2000).select("row.doc_id", "words", "removed", "sha").collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, 10)

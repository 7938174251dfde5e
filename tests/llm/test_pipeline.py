"""Each stage of the pipeline, on what the stage before it kept, against brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from quillmark.llm import mixing, packing, substrings, toxicity
from quillmark.llm.common import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("an in er on th re ti es or al".split()) for _ in range(rng.randint(1, 4)))
    text = lambda n: [word() for _ in range(n)]
    passage = text(70)
    docs, labels = [], []
    for i in range(260):
        w = text(rng.choice((3, 30, 80, 150, 400)))
        bad = i % 5 == 0
        for _ in range(4 if bad else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["scum", "moron", "idiot"]))
        if i % 9 == 1:
            at = rng.randrange(len(w))
            w[at:at] = passage
        docs.append((i, "\n".join(w) if i % 7 == 0 else " ".join(w), "en", rng.choice(["a", "a", "b", "c", None])))
        labels.append((i, 1, int(bad)))
    docs += [(300 + i, docs[i * 3 + 1][1], "en", "a") for i in range(20)]
    docs += [(330 + i, docs[i * 3 + 1][1].replace(" ", " new ", 1), "fr", "b") for i in range(20)]
    docs += [(400, None, None, None), (401, "", "en", "a"), (2, docs[2][1], "en", docs[2][3]), (None, "no id", "en", "z")]
    path = str(tmp_path_factory.mktemp("pipeline"))
    rows = [(*d, None if d[1] is None else len(d[1])) for d in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, tables), f"test-{name}")
        out.append(docs)
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_all_but_the_last_keep_the_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "substrings", "mixing", "packing"]
    for df in stages[:-1]:
        assert df.columns == COLUMNS


def test_toxic_documents_go(spark, tables, stages):
    model = toxicity.trained(stages[0], spark.read.parquet(f"{tables}/labels.parquet"))
    assert rows(stages[1]) == sorted((r for r in map(tuple, stages[0].collect()) if model.score(r[1]) < 0.5), key=str)
    ids = {r.doc_id for r in stages[1].collect()}
    assert len(ids & {i for i in range(260) if i % 5 == 0}) <= 3 and len(ids & {i for i in range(260) if i % 5}) >= 200


def test_one_document_of_each_group_stays(stages):
    """By the Jaccard similarity of five-word shingle sets, over all pairs."""
    docs = [tuple(r) for r in stages[1].collect()]
    sets = []
    for d in docs:
        w = (d[1] or "").lower().split()
        k = min(5, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x == y or 10 * len(x & y) >= 8 * len(x | y):
                root[find(i)] = find(j)
    groups = {}
    for i, d in enumerate(docs):
        groups.setdefault(find(i), []).append(d)
    kept = stages[2].collect()
    assert len(kept) == len(groups)
    assert {r.doc_id for r in kept} == {min((d[0] for d in g if d[0] is not None), default=None) for g in groups.values()}
    assert set(map(tuple, kept)) <= set(docs)
    assert not {r.doc_id for r in kept} & set(range(300, 320))


def test_repeated_passages_go(stages):
    docs = [tuple(r) for r in stages[2].collect()]
    first = {}
    for d, t, *_ in docs:
        w = (t or "").split()
        for i in range(len(w) - 49):
            k = tuple(w[i : i + 50])
            first[k] = min(first.get(k, substrings._LAST), substrings._LAST if d is None else d)
    want = []
    for d, t, lang, source, n in docs:
        w = (t or "").split()
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < (substrings._LAST if d is None else d):
                gone[i : i + 50] = [True] * 50
        if any(gone):
            left = " ".join(x for x, g in zip(w, gone) if not g)
            if not all(gone):
                want.append((d, left, lang, source, len(left)))
        else:
            want.append((d, t, lang, source, n))
    assert rows(stages[3]) == sorted(want, key=str)
    assert len(want) == len(docs) and sum(a != b for a, b in zip(rows(stages[2]), rows(stages[3]))) >= 10


def test_mix_draws_whole_documents(stages):
    drawn = {}
    for r in mixing.with_copies(stages[3]).collect():
        drawn[r.doc_id, r.text] = r.copies
    got = {}
    for r in stages[4].collect():
        got[r.doc_id, r.text] = got.get((r.doc_id, r.text), 0) + 1
    assert got == {k: n for k, n in drawn.items() if n}


def test_pieces_hold_each_token_of_the_mix(stages):
    encode = packing.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {}
    total = 0
    for r in stages[4].collect():
        ids = np.array([*encode(r.text or ""), 1], dtype="<u4")
        texts.setdefault(r.doc_id, []).append(ids)
        total += len(ids)
    pieces = stages[5].collect()
    assert sum(p.length for p in pieces) == total
    for p in pieces:
        assert any(zlib.crc32(x[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for x in texts[p.doc_id])


def test_run_applies_the_stages(spark, tables, stages):
    assert corpus_pipeline.run(spark, tables).count() == stages[5].count()


def test_empty_tables_and_clashing_columns(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").selectExpr("*", "1 as `_w_x`", "'k' as `row`", "2 as `_m_size`", "3 as words", "array(doc_id) as node")
    for df in (docs.limit(0), docs.where("doc_id < 40 or doc_id is null")):
        for name, stage in corpus_pipeline.STAGES:
            got = written(stage(spark, df, tables), f"odd-{name}")
            if name != "packing":
                assert got.columns == df.columns
            assert (got.count() == 0) == df.isEmpty()

import random
import zlib

import numpy as np
import public_tokenizers

from quillmark.llm import packing as P


def padding(pieces, sequence):
    total = sum(n for _, _, n in pieces)
    return 0 if total & (total - 1) == 0 else sequence - total


def test_tournament_finds_the_first_that_fits():
    rng = random.Random(1)
    for n in (1, 2, 7, 64, 100):
        tree, plain = P.Tournament(n, 100), [100] * n
        for _ in range(2 * n):
            need = rng.randint(1, 100)
            want = next((i for i, c in enumerate(plain) if c >= need), None)
            if want is None:
                continue
            assert tree.first(need) == want
            tree.take(want, need)
            plain[want] -= need


def test_each_token_once_and_no_padding():
    rng = random.Random(2)
    for lengths in ([], [1], [64], [65], [63, 2], [1] * 700, [rng.randint(1, 300) for _ in range(500)], [64 * 5] * 3, [33] * 40):
        got = P.pack(lengths, 64)
        seen = {}
        for pieces in got:
            assert sum(n for _, _, n in pieces) <= 64 and all(n > 0 for _, _, n in pieces)
            assert padding(pieces, 64) == 0
            for d, s, n in pieces:
                for t in range(s, s + n):
                    assert (d, t) not in seen
                    seen[d, t] = 1
        assert len(seen) == sum(lengths)


def test_ranks_and_json_give_equal_ids():
    rng = random.Random(3)
    fast, slow = (P.encoder(public_tokenizers.path(f"byte_bpe_50k.{x}")) for x in ("tiktoken", "json"))
    words = ["the", "The", " ", "  ", "\n", "\t", "été", "naïve", "don't", "123", "4,5", "😀", "<|endoftext|>", "ß", "。", "--", "\x00", " "]
    for _ in range(400):
        text = "".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(rng.randint(0, 30)))
        assert fast(text) == slow(text)


def test_query_matches_plain_tokens(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice(["alpha", "beta", "gamma,", "été"]) for _ in range(rng.choice((0, 3, 50, 3000))))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "x"), (102, "y z"), (None, "no id"), (103, docs[0][1]), (103, docs[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "7 as start", "'g' as g")
    got = P.packed(df, public_tokenizers.path("byte_bpe_50k.tiktoken"), sequence=256, group_docs=20).collect()
    slow = P.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for d, t in docs:
        want.setdefault(d, []).append(np.array([*slow(t or ""), 1], dtype="<u4"))
    assert sum(r.length for r in got) == sum(len(x) for v in want.values() for x in v)
    for r in got:
        assert any(len(x) == r.doc_tokens and zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for x in want[r.doc_id])
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in by.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= 256 and padding([(0, 0, at)], 256) == 0
    assert P.packed(df.limit(0), public_tokenizers.path("byte_bpe_50k.tiktoken")).count() == 0


def test_turns_and_very_long_texts(spark, monkeypatch):
    monkeypatch.setattr(P, "TURN_TOKENS", 3000)
    docs = [(i, "word " * (i % 40)) for i in range(300)] + [(400, "long text here " * 60_000)] + [(401, "same row")] * 200
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = P.packed(df, public_tokenizers.path("byte_bpe_50k.tiktoken"), sequence=256, group_docs=1000).collect()
    fast = P.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert sum(r.length for r in got) == sum(len(fast(t)) + 1 for _, t in docs)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in by.values():
        v.sort()
        assert [o for o, _ in v] == [sum(n for _, n in v[:i]) for i in range(len(v))]
        assert padding([(0, 0, sum(n for _, n in v))], 256) == 0


def test_added_tokens_as_in_an_unmodified_tokenizer():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("<|endoftext|>", "a<|endoftext|>b", "a <|endoftext|> b\n", "<|endoftext|><|endoftext|>", "<|endoftext", "no such token"):
        want = plain.encode(text, add_special_tokens=False).ids
        for kind in ("tiktoken", "json"):
            assert P.encoder(public_tokenizers.path(f"byte_bpe_50k.{kind}"))(text) == want
    assert 50256 in P.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))("a<|endoftext|>b")

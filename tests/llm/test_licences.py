import random

from quillmark.llm import licences as L


def brute(text):
    found = L.words(text)
    at = [(i, lab) for p, lab in L.PHRASES.items() for i in range(len(found)) if found[i : i + len(p.split())] == [w.encode() for w in p.split()]]
    return len(found), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))


def test_places_of_phrases_match_brute_force():
    rng = random.Random(1)
    vocabulary = "gnu general public license apache cc by mit the under version 3 of licensed work is this".split()
    scanner = L.Scanner()
    for _ in range(300):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))
        assert scanner.scan(text)[:5] == brute(text)


def test_phrase_inside_a_longer_match():
    text = "x This work is licensed under the GNU General Public License, version 3. CC-BY mit-License"
    got = L.Scanner().scan(text)
    assert got[:5] == brute(text) and got[4] == "cc-by,gpl,mit" and got[6] == 1.0


def test_template_spans_and_own_labels():
    text = "foo " + " ".join(t for lab, t in L.TEMPLATES if lab == "bsd").upper() + " bar"
    got = L.Scanner().scan(text)
    assert got[4] == "" and got[5] == "bsd"
    assert got[7][0][:3] == ("bsd", 1, len(L.words(text)) - 2)


def test_null_empty_and_foreign_words():
    scanner = L.Scanner()
    assert scanner.scan(None) == scanner.scan("") == (0, 0, None, None, "", "", 0.0, [])
    assert L.words("Été-Mit") == ["Été".encode(), b"mit"]


def test_table_rows_match_brute_force(spark):
    rng = random.Random(3)
    vocabulary = "gnu general public license apache cc by mit the under version of licensed work".split()
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 80))) for _ in range(120)]
    texts += [None, "", " \t", "Apache\nLicense!", texts[3], "x " * 400_000 + "MIT License", "cc by " * 30_000, "gnu-general/public_license"]
    docs = [(i if i != 5 else None, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'c' as labels", "1 as score", "2 as n_words")
    got = L.scanned(df).collect()
    want = sorted(((d, *brute(t)) for d, t in docs), key=str)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str) == want
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted(set(r.labels.split(","))))
    assert L.scanned(df.limit(0)).count() == 0


def test_spans_and_scores_match_brute_force():
    """Whole templates in noise: each is found where it stands, and its share is the score."""
    rng = random.Random(4)
    scanner = L.Scanner()
    noise = lambda n: [f"zz{rng.randrange(50)}" for _ in range(n)]
    for label, template in L.TEMPLATES:
        words = [w.decode() for w in L.words(template)]
        cut = words[: max(L.LONG, int(len(words) * rng.uniform(0.5, 1)))]
        before = rng.randint(0, 20)
        text = " ".join([*noise(before), *cut, *noise(10)])
        _, _, _, _, base, labels, score, spans = scanner.scan(text)
        at = [s for s in spans if s[0] == label and s[1] == before and s[2] == before + len(cut) - 1]
        assert at and abs(max(s[3] for s in at) - len(cut) / len(words)) < 1e-9 or len(words) < L.LONG
        assert score >= len(cut) / len(words) - 1e-9
        if len(cut) / len(words) >= L.COVERED:
            assert label in labels.split(",")

import base64
import gzip
import hashlib
import zlib

from quillmark.llm import warc as W


def digest(x):
    return base64.b32encode(hashlib.sha1(x.encode()).digest()).decode()


def brute(pages, least=0):
    first = {}
    for i, _, h in pages:
        h = h or ""
        if len(h.encode()) >= least and i is not None:
            first[h] = min(first.get(h, i), i)
    out = []
    for i, _, h in pages:
        h = h or ""
        f = first.get(h) if len(h.encode()) >= least else None
        revisit = f is not None and f != i
        out.append((i, len(h.encode()), digest(h), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=str)


PAGES = [
    (5, "http://a/1", "<p>é</p>"),
    (2, None, "<p>é</p>"),
    (9, "http://a/\r\nx", None),
    (3, "http://b", ""),
    (4, "u", "x" * 300_000),
    (8, "u", "x" * 300_000),
    (8, "u", "x" * 300_000),
    (None, "n", "only null"),
    (None, "n", "<p>é</p>"),
    (-7, "neg", "y"),
]


def test_round_trip_matches_brute_force(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'c' as digest", "1 as salt")
    for least in (0, 10):
        got = W.round_trip(spark, df, least).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok").collect()
        assert sorted((tuple(r)[:5] for r in got), key=str) == brute(PAGES, least)
        assert all(r.digest_ok in (True, None) for r in got)
    assert W.round_trip(spark, df.limit(0)).count() == 0


def test_every_range_owns_what_starts_in_it(tmp_path):
    parts = [W.member(i, f"u{i}", bytes(f"page {i} " * (i * 37 % 91), "ascii"), None, False) for i in range(40)]
    path = tmp_path / "x.warc.gz"
    path.write_bytes(b"".join(parts))
    size = path.stat().st_size
    for step in (1, 97, 1000, size, 10 * size):
        if step == 1 and size > 20_000:
            continue
        got = [W._row(r)[0] for at in range(0, size, step) for r in W.records_of(f"file://{path}", at, at + step)]
        assert got == list(range(40))


def test_false_magic_and_damage_are_skipped(tmp_path):
    inner = W.member(99, "inner", b"hidden", None, False)
    z = zlib.compressobj(0, zlib.DEFLATED, 31)  # stored: the inner member's bytes stand in the outer one
    block = W.HTTP.format(len(inner)).encode() + inner
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: {len(block)}\r\n\r\n".encode()
    outer = z.compress(head + block + b"\r\n\r\n") + z.flush()
    good = W.member(2, "good", b"x", None, False)
    path = tmp_path / "y.warc.gz"
    path.write_bytes(outer + b"junk" + good + gzip.compress(b"not a record") + good)
    size = path.stat().st_size
    for step in (50, size):
        got = [W._row(r)[0] for at in range(0, size, step) for r in W.records_of(f"file://{path}", at, at + step)]
        assert got == [1, 2, 2]


def test_records_before_damage_padding_and_truncation(tmp_path):
    whole = [W.member(i, f"u{i}", b"body %d" % i, None, False) for i in range(6)]
    path = tmp_path / "d.warc.gz"
    path.write_bytes(whole[0] + b"\0\1\2\3" + whole[1] + whole[2][:40] + whole[3] + b"\x1f\x8b" + whole[4] + whole[5] + b"\0" * 512)
    size = path.stat().st_size
    for step in (13, 64, 300, size):
        got = [W._row(r)[0] for at in range(0, size, step) for r in W.records_of(f"file://{path}", at, at + step)]
        assert got == [0, 1, 3, 4, 5]
    path.write_bytes(whole[0] + whole[1][:-3])
    assert [W._row(r)[0] for r in W.records_of(f"file://{path}", 0, 10_000)] == [0]


def test_lengths_that_headers_state_must_hold(tmp_path):
    head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 900\r\n\r\nshort"
    path = tmp_path / "s.warc.gz"
    path.write_bytes(gzip.compress(head) + W.member(2, "u", b"x", None, False))
    assert [W._row(r)[0] for r in W.records_of(f"file://{path}", 0, 10_000)] == [2]


def test_each_byte_is_read_about_once(tmp_path):
    path = tmp_path / "r.warc.gz"
    path.write_bytes(b"".join(W.member(i, f"u{i}", b"page %d" % i * 30, None, False) for i in range(3000)))
    size = path.stat().st_size
    for step in (size, size // 3 + 1):
        sources = [W._Bytes(f"file://{path}", at + step) for at in range(0, size, step)]
        got = [r for s, at in zip(sources, range(0, size, step), strict=True) for r in W._members(s, at, min(at + step, size))]
        assert len(got) == 3000
        assert all(s.taken <= step + 2 * W.FIRST_BYTES for s in sources)


def test_long_members_end_beyond_the_range(tmp_path):
    import os

    parts = [W.member(i, "u", base64.b64encode(os.urandom(2_000_000)), None, False) for i in range(3)]
    path = tmp_path / "z.warc.gz"
    path.write_bytes(b"".join(parts))
    size = path.stat().st_size
    got = [W._row(r)[:2] for at in range(0, size, 500_000) for r in W.records_of(f"file://{path}", at, at + 500_000)]
    assert [g[0] for g in got] == [0, 1, 2]

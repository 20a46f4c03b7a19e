"""Archives: round trips, segments, framing and damage."""

import gzip

import pytest
from hypothesis import given
from hypothesis import strategies as st

from wireloom.llm import warc_segments as w

PAGES = "page_id long, url string, html string, payload string, sha string"


@given(st.binary(max_size=300), st.integers(1, 50))
def test_framing(payload, size):
    assert w.unchunked(w.chunked(payload, size)) == payload


@pytest.mark.parametrize("body", [b"", b"5\r\nabc", b"3\r\nabc\r\n", b"3\r\nabcd\r\n0\r\n\r\n", b"0\r\n", b"zz\r\n"])
def test_damaged_framing(body):
    with pytest.raises(ValueError):
        w.unchunked(body)


def test_framing_with_extension_and_trailer():
    assert w.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: z\r\n\r\n") == b"abc"


def test_segments():
    assert w.joined([(2, 5, b"de"), (1, None, b"abc")]) == b"abcde"
    for wrong in ([(1, None, b"abc")], [(2, 2, b"de")], [(1, None, b"a"), (1, None, b"a"), (2, 3, b"b")], [(1, None, b"abc"), (2, 6, b"de")]):
        with pytest.raises(ValueError):
            w.joined(wrong)


def test_records_are_plain_warc():
    data = b"".join(w.page_records("r", 7, "http://x/é", b"payload" * 20, None, segment=64))
    text = gzip.decompress(data)
    assert text.count(b"WARC/1.1\r\n") == text.count(b"WARC-Record-ID") > 2
    assert text.count(b"WARC-Type: continuation") == text.count(b"WARC-Segment-Origin-ID: <urn:wireloom:r>") == text.count(b"WARC/1.1") - 1
    assert text.count(b"WARC-Segment-Total-Length") == 1


def expected(rows):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        ids = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = min(ids) if ids else None
        again = first is not None and first != page_id
        out.append((page_id, len(payload), w.digest(payload), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


ROWS = [
    (5, "http://a/", "same"),
    (3, "http://b/\r\nX: y", "same"),
    (9, None, "same"),
    (1, "u", None),
    (2, "u", ""),
    (4, "long", "ä<p>" * 40_000),
    (6, "long copy", "ä<p>" * 40_000),
    (None, "no id", "same"),
    (None, "no id", "only here"),
    (7, "twice", "t"),
    (7, "twice", "t"),
    (8, "edge", "x" * (w.SEGMENT - 20)),
]


def test_round_trip(spark):
    frame = spark.createDataFrame([(*r, "p", "s") for r in ROWS], PAGES).repartition(3)
    got = w.archive_round_trip(frame).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == expected(ROWS)
    assert all(r["error"] is None for r in got)
    assert {r["page_id"] for r in got if r["segments"] > 1} == {4, 8}
    assert w.archive_round_trip(frame.limit(0)).collect() == []


def test_tables_as_given(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in pages.collect()]
    assert sorted((tuple(r)[:5] for r in w.archive_round_trip(pages).collect()), key=repr) == expected(rows)


def test_damage_is_told(spark, tmp_path):
    folder = str(tmp_path / "warc")
    frame = spark.createDataFrame([(i, "u", "text %d " % i * 30, "", "") for i in range(6)], PAGES).coalesce(1)
    manifest = w.write_archives(frame, folder, segment=100, archive=1500)
    assert manifest.count() > 1
    records = w.read_records(manifest, folder)
    lost = records.filter("not (segment = 2 and origin like '%page:3:%')")
    again = lost.unionByName(records.filter("segment = 3 and origin like '%page:5:%'"))
    got = {r["page_id"]: r["error"] for r in w.reassemble(again).collect()}
    assert {i for i, error in got.items() if error} == {3, 5} and len(got) == 6


def test_references_name_records_of_the_archive(spark, tmp_path):
    folder = str(tmp_path / "warc")
    frame = spark.createDataFrame([(*r, "p", "s") for r in ROWS], PAGES).repartition(2)
    rows = w.read_records(w.write_archives(frame, folder), folder).collect()
    ids = [r["record"] for r in rows]
    assert len(set(ids)) == len(ids)
    assert {r["refers_to"] for r in rows if r["type"] == "revisit"} <= {r["record"] for r in rows if r["type"] == "response"}


def http(payload):
    return b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload


def test_archives_of_others(spark, tmp_path):
    """Other record types are passed over, references of any form resolved, and damage costs one record only."""
    named = lambda kind, name, *more: [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{name}>"), *more]
    told = ("WARC-Payload-Digest", "sha1:" + w.digest(b"one"))
    whole = [
        w.record(named("warcinfo", "i"), b"software: x"),
        w.record(named("response", "a", ("WARC-Page-ID", "41"), told), http(b"one")),
        w.record(named("request", "q"), b"GET / HTTP/1.1\r\n\r\n"),
        w.record(named("response", "b", ("WARC-Target-URI", "http://b/")), http(b"two")),
        w.record(named("revisit", "c", ("WARC-Page-ID", "43"), ("WARC-Refers-To", "<urn:uuid:a>")), http(b"")),
        w.record(named("revisit", "d", ("WARC-Page-ID", "44"), ("WARC-Refers-To", "<urn:uuid:elsewhere>"), told), http(b"")),
        w.record(named("revisit", "e", ("WARC-Page-ID", "45"), ("WARC-Refers-To", "<urn:uuid:elsewhere>")), http(b"")),
        w.record(named("response", "f", ("WARC-Segment-Number", "many")), http(b"three")),
        w.record([("WARC-Type", "response")], http(b"no id")),
    ]
    damaged = bytearray(w.record(named("response", "g"), http(b"lost " * 50)))
    damaged[12:40] = b"\xff" * 28
    last = w.record(named("response", "h", ("WARC-Page-ID", "48"), ("WARC-Payload-Digest", "md5:00")), http(b"four"))
    (tmp_path / "x.warc.gz").write_bytes(b"".join(whole) + bytes(damaged) + last + whole[1][:-9])
    manifest = spark.createDataFrame([("x.warc.gz", 0, 0)], w.MANIFEST)
    got = w.reassemble(w.read_records(manifest, str(tmp_path))).collect()
    good = {r["page_id"]: (r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got if not r["error"]}
    assert good == {41: ("response", None, 3), None: ("response", None, 3), 43: ("revisit", 41, 0), 44: ("revisit", 41, 0), 45: ("revisit", None, 0), 48: ("response", None, 4)}
    assert len([r for r in got if r["error"]]) == 4 and any("ends inside" in (r["error"] or "") for r in got)

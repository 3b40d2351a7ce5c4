"""Archives of pages: round trips through files, the index, damaged archives."""

import gzip
import hashlib
import random
import uuid

import pyarrow as pa
import pytest

from spanfold.llm import warc

PAGES = "page_id long, url string, html string, size string, archive string, offset string"
LONG = "<p>é</p>" * 300_000
ROWS = [
    (1, "http://a/ü b\r\nX: y", "<html>" + "a" * 200),
    (2, "http://a/2", "<html>" + "a" * 200),
    (3, None, "<html>" + "a" * 200),
    (3, None, "<html>" + "a" * 200),
    (4, "http://a/4", None),
    (5, "http://a/5", ""),
    (6, "http://a/6", "x" * 99),
    (7, "http://a/7", "x" * 99),
    (8, "http://a/8", "x" * 100),
    (9, "http://a/9", "x" * 100),
    (10, "http://a/10", "é" * 50),
    (11, "http://a/11", "é" * 50),
    (12, "http://a/12", LONG),
    (13, "http://a/13", "\r\n\r\nWARC/1.1\r\n\r\n" * 20),
    (14, "http://a/14", "body\u0000 with \r\n\r\n in it" * 9),
    (None, "http://a/none", "<html>" + "a" * 200),
    (None, None, None),
    (8, "http://a/8", "another text under one id" * 9),
]


def expected(rows):
    found = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if p is not None and (h or "").encode() == payload]
        again = len(payload) >= 100 and page_id is not None and min(same) < page_id
        found.append(
            (page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", min(same) if again else None)
        )
    return sorted(found, key=str)


def shown(records):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r) for r in records.select(*names).collect()), key=str)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "old", "old", "old") for r in ROWS], PAGES)


@pytest.mark.parametrize("archive_bytes", [1, 5_000, warc.ARCHIVE_BYTES])
def test_round_trip(spark, pages, tmp_path, archive_bytes):
    written = warc.write(pages, str(tmp_path), archive_bytes)
    streams = sorted(tmp_path.glob("streams/*.gz"))
    assert len(streams) == written[0].count() > 0
    plain = warc.normalise(written)
    assert not list(tmp_path.glob("streams/*"))
    assert shown(warc.read(plain)) == expected(ROWS)
    with_payloads = warc.read(plain, payloads=True).where("record_type = 'response'").collect()
    for r in with_payloads:
        assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest
    assert plain[0].agg({"n_records": "sum"}).first()[0] == len(ROWS) + plain[0].count()


def test_streams_and_members(spark, pages, tmp_path):
    """A stream is one member; afterwards every indexed range is a whole member."""
    written = warc.write(pages.coalesce(1), str(tmp_path))
    (stream,) = tmp_path.glob("streams/*.gz")
    whole = gzip.decompress(stream.read_bytes())
    stream_copy = stream.read_bytes()
    plain = warc.normalise(written)
    (archive,) = tmp_path.glob("records/*.gz")
    data = archive.read_bytes()
    entries = sorted(warc.index(plain).collect(), key=lambda e: e.offset)
    assert entries[0].record_type == "warcinfo" and entries[0].offset == 0
    members = [data[e.offset : e.offset + e.length] for e in entries]
    assert b"".join(members) == data and gzip.decompress(data) == whole
    for e, member in zip(entries, members, strict=True):
        record = gzip.decompress(member)
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert f"WARC-Record-ID: {e.record_id}\r\n".encode() in record
        assert uuid.UUID(e.record_id.strip("<>").removeprefix("urn:uuid:"))
    assert stream_copy.count(b"\x1f\x8b\x08") < len(members)


@pytest.mark.parametrize("cut", [1, 7, 1000, 10**9])
def test_inflating_in_pieces(cut, monkeypatch):
    """Members and reads may end anywhere."""
    monkeypatch.setattr(warc, "PIECE", cut)
    chance = random.Random(cut)
    payloads = [bytes(chance.choices(b"ab\r\n", k=chance.randrange(0, 400))) for _ in range(30)]
    records = [warc.page_record(n, "http://x/", p, hashlib.sha256(p).hexdigest(), None) for n, p in enumerate(payloads)]
    stream = gzip.compress(b"".join(records[:7])) + gzip.compress(b"".join(records[7:]))
    out = pa.BufferOutputStream()
    entries = list(warc.rewritten(pa.BufferReader(stream), out))
    data = out.getvalue().to_pybytes()
    assert [gzip.decompress(data[o : o + n]) for o, n, *_ in entries] == records
    assert [warc.parsed(data[o : o + n])[-1] for o, n, *_ in entries] == payloads


@pytest.mark.parametrize("damage", ["cut", "swap"])
def test_damage_is_noticed(damage):
    payload = b"p" * 500
    record = warc.page_record(1, "http://x/", payload, hashlib.sha256(payload).hexdigest(), None)
    if damage == "cut":
        stream = gzip.compress(record)[:-20]
        with pytest.raises(ValueError):
            list(warc.rewritten(pa.BufferReader(stream), pa.BufferOutputStream()))
    else:
        with pytest.raises(ValueError):
            warc.parsed(gzip.compress(record.replace(b"ppp", b"ppq")))


def test_no_pages(spark, pages, tmp_path):
    plain = warc.normalise(warc.write(pages.limit(0), str(tmp_path)))
    assert warc.read(plain).count() == 0 == plain[0].count()


def test_many_copies(spark, tmp_path):
    pages = spark.range(3000).selectExpr("id AS page_id", "'u' AS url", "if(id % 3 = 0, repeat('copy', 50), repeat(cast(id AS string), 60)) AS html")
    found = warc.read(warc.normalise(warc.write(pages, str(tmp_path))))
    assert found.where("record_type = 'revisit' and refers_to = 0").count() == 999
    assert found.where("record_type = 'response'").count() == 2001

import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import types as T

from lamella.llm import warc
from lamella.llm.common import Scratch

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("digest", T.StringType())])


def test_round_trip(spark):
    big = "é<p>" * 60
    rows = [(5, "http://a/\r\nWARC-Type: x", big, "d"), (3, "u", big, "d"), (3, "u", big, "d"), (9, None, "small", "d"), (10, "u", "small", "d"), (11, "u", None, None), (None, "u", big, "d"), (12, "u", "x" * 3_000_000, "d"), (13, "u", "WARC/1.1\r\n\r\n" * 20, "d")]
    scratch = Scratch(spark, "t")
    folder = scratch.path("w")
    names = scratch.keep(warc.write_warc(warc.archive_rows(spark.createDataFrame(rows, SCHEMA), scratch), folder), "names")
    records, gaps = warc.read_warc(spark, folder, names)
    got = sorted((str(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records.collect())
    want = []
    for i, _, html, _ in rows:
        raw = (html or "").encode()
        again = html == big and i != 3
        want.append((str(i), len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", "3" if again else None))
    assert got == sorted(want)
    assert gaps.count() == 0
    assert {r.payload.decode() for r in records.collect() if r.record_type == "response"} == {r[2] or "" for r in rows}


def record(k, body):
    return warc.record_bytes(str(k), "u", body, hashlib.sha256(body).hexdigest(), None)


def test_salvage_skips_damage_and_reports_gaps(spark, tmp_path):
    rnd = random.Random(3)
    parts = [gzip.compress(record(k, rnd.randbytes(300)), mtime=0) for k in range(6)]
    parts[1] = parts[1][:40] + b"\0\0\0\0" + parts[1][44:]  # breaks a member
    parts[3] = parts[3][:60]  # cuts one short
    plain = [record(10, b"plain"), record(11, b"wrong").replace(b"wrong", b"grown", 1), record(12, b"last WARC/1.1 inside")]
    data = b"junk" + b"".join(parts) + b"\n\n" + b"".join(plain) + b"WARC/1.1\r\nWARC-Type: response\r\n"
    found = list(warc.salvage(data))
    assert [f["record_id"] for f in found if "record_id" in f] == ["0", "2", "4", "5", "10", "12"]
    at = 0
    for f in found:  # records and gaps cover every byte in order
        assert f["start"] == at and f["end"] > at
        at = f["end"]
    assert at == len(data)
    problems = [f["problem"] for f in found if "problem" in f]
    assert len(problems) == 6 and problems[0] == "no version line" and problems[-2:] == ["wrong digest", "unfinished header"]
    (tmp_path / "a.warc").write_bytes(data)
    (tmp_path / "empty.warc").write_bytes(b"")
    records, gaps = warc.read_warc(spark, str(tmp_path))
    assert records.count() == 6 and gaps.count() == sum("problem" in f for f in found)


def test_damage_in_a_member_of_many_records():
    rnd = random.Random(4)
    parts = [record(k, bytes(rnd.choices(b"abcdefgh <>", k=40_000))) for k in range(8)]
    ids = lambda found: [f["record_id"] for f in found if "record_id" in f]
    problems = lambda found: [f["problem"] for f in found if "problem" in f]
    # One record fails its check in a member that is whole.
    bad = parts[3][:5000] + b"!!" + parts[3][5002:]
    data = gzip.compress(b"".join([*parts[:3], bad, *parts[4:]]), mtime=0)
    found = list(warc.salvage(data))
    at = sum(map(len, parts[:3]))
    assert ids(found) == ["0", "1", "2", "4", "5", "6", "7"]
    assert problems(found) == [f"wrong digest, bytes {at} to {at + len(bad)} of the content"]
    assert all((f["start"], f["end"]) == (0, len(data)) for f in found)
    # A member that is cut short, or has a damaged byte, keeps what came before; the next member follows.
    whole, one = gzip.compress(b"".join(parts), mtime=0), gzip.compress(record(9, b"next"), mtime=0)
    half = len(whole) // 2
    assert ids(warc.salvage(whole[:half])) == ["0", "1", "2"] or ids(warc.salvage(whole[:half])) == ["0", "1", "2", "3"]
    for data in (whole[:half] + one, whole[:-8] + b"\0" * 8 + one):
        found = list(warc.salvage(data))
        assert ids(found)[-1] == "9" and ids(found)[:3] == ["0", "1", "2"] and len(set(ids(found))) == len(ids(found))
        assert any("member" in p for p in problems(found))
    assert len(ids(warc.salvage(whole[:-8] + b"\0" * 8))) == 8  # only the checksum is wrong
    # Stored blocks show the records in the raw bytes as well: each comes once.
    stored = gzip.compress(b"".join(parts), 0, mtime=0)
    found = list(warc.salvage(stored[:-8] + b"\0" * 8 + one))
    assert ids(found) == [*map(str, range(8)), "9"]


def test_long_urls_are_read_back(spark):
    url = "http://a/" + "é?q=" * 100_000
    big = "p" * 200
    rows = [(1, url, big, "d"), (2, "u", big, "d"), (3, url, big, "d"), (4, "v", "x", "d")]
    scratch = Scratch(spark, "t")
    folder = scratch.path("w")
    names = scratch.keep(warc.write_warc(warc.archive_rows(spark.createDataFrame(rows, SCHEMA), scratch), folder), "names")
    records, gaps = warc.read_warc(spark, folder, names)
    assert gaps.count() == 0
    assert sorted((r.record_id, r.uri, r.refers_to) for r in records.collect()) == [("1", url, None), ("2", "u", "1"), ("3", url, "1"), ("4", "v", None)]


def test_empty_table(spark):
    scratch = Scratch(spark, "t")
    rows = warc.archive_rows(spark.createDataFrame([], SCHEMA), scratch)
    assert warc.write_warc(rows, scratch.path("w")).count() == 0


def test_every_written_record_must_come_back(spark, tmp_path):
    scratch = warc.Scratch(spark, "test")
    long_url = "http://a/" + "x" * 1_000_000
    pages = spark.createDataFrame([(1, long_url, "p" * 200, "d"), (2, "http://b/", "p" * 200, None), (3, None, None, "d")], "page_id long, url string, html string, digest string")
    folder = scratch.path("archives")
    written = scratch.keep(warc.write_warc(warc.archive_rows(pages, scratch), folder), "names")
    got = {r.record_id: (r.uri, r.record_type) for r in warc.read_all(spark, folder, written, scratch).collect()}
    assert got == {"1": (long_url, "response"), "2": ("http://b/", "revisit"), "3": (None, "response")}
    short = scratch.keep(written.withColumn("records", written["records"] + 1), "short")
    with pytest.raises(warc.BadRecord):
        warc.read_all(spark, folder, short, scratch)


def labelled(body, *lines):
    return b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:record:7>\r\n" + b"".join(line + b"\r\n" for line in lines) + b"Content-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n"


def test_digests_are_checked_by_their_kind():
    body = b"<p>some page</p>"
    sha1, sha256 = hashlib.sha1(body).digest(), hashlib.sha256(body).digest()
    base32 = base64.b32encode(sha1)
    wrong = base64.b32encode(hashlib.sha1(b"other").digest())
    for line, want in (
        (b"WARC-Payload-Digest: sha1:" + base32, "verified"),
        (b"WARC-Payload-Digest: SHA-1:" + base32.lower(), "verified"),
        (b"WARC-Payload-Digest: sha1:" + sha1.hex().encode(), "verified"),
        (b"WARC-Block-Digest: sha256:" + base64.b32encode(sha256).rstrip(b"="), "verified"),
        (b"WARC-Payload-Digest: " + sha256.hex().upper().encode(), "verified"),
        (b"WARC-Payload-Digest: blake3:abc", "unverified"),
        (b"X: y", "absent"),
        (b"WARC-Payload-Digest: sha1:" + wrong, None),
        (b"WARC-Block-Digest: sha1:" + wrong, None),
        (b"WARC-Payload-Digest: sha1:no digest", None),
    ):
        found = list(warc.salvage(labelled(body, line)))
        assert [f.get("digest_check") for f in found] == [want], line
        assert [f.get("problem") for f in found] == [None if want else "wrong digest"]
        assert want is None or found[0]["payload_digest"] == sha256.hex()


def test_payload_digests_of_http_records_are_those_of_the_body():
    body = b"<p>page</p>"
    line = b"WARC-Payload-Digest: sha1:" + base64.b32encode(hashlib.sha1(body).digest())
    kind = b"Content-Type: application/http; msgtype=response"
    head = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n"
    check = lambda data: [f.get("digest_check") or f["problem"] for f in warc.salvage(data)]
    assert check(labelled(head + body, line, kind)) == ["verified"]
    assert check(labelled(head + b"other", line, kind)) == ["wrong digest"]
    assert check(labelled(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\nb\r\n" + body + b"\r\n0\r\n\r\n", line, kind)) == ["unverified"]
    assert check(labelled(head + body, line)) == ["wrong digest"]


def test_continued_header_lines():
    body = b"x"
    found = list(warc.salvage(labelled(body, b"WARC-Target-URI: http://a/", b"\tand more ", b"Other: 1")))
    assert [f["uri"] for f in found] == ["http://a/ and more"]
    assert [f["problem"] for f in warc.salvage(b"WARC/1.1\r\n first: 1\r\nContent-Length: 0\r\n\r\n\r\n\r\n")] == ["bad header line"]


@pytest.mark.parametrize(
    "first,again,last",
    [
        (b"", b"WARC/1.1 " + b"x" * 91, b""),
        (b"", b"WARC/1.1\r\na: WARC/1.1\r\n" + b"x: y\r\n" * 10, b""),
        (b"WARC/1.1\r\n", b"a: WARC/1.1\r\n", b""),
        (b"WARC/1.1\r\na: b\r\n", b" WARC/1.1\r\n", b"\r\n"),
        (b"WARC/1.1\r\nContent-Length: 9\r\n", b"a: WARC/1.1\r\n", b"\r\n"),
        (b"", b"\x1f\x8b\x08" + b"z" * 97, b""),
    ],
)
def test_salvage_passes_over_false_marks_once(monkeypatch, first, again, last):
    """Bytes that searches pass over, and lines that headers read, follow the length of the data."""
    data = first + again * (400_000 // len(again)) + last + record(1, b"after")
    passed = []

    class Counted(warc.Marks):
        def find(self, mark, start):
            before = self.next.get(mark)
            place = super().find(mark, start)
            if self.next.get(mark) is not before:
                passed.append(place - start)
            return place

    monkeypatch.setattr(warc, "Marks", Counted)
    found = list(warc.salvage(data))
    assert [f["record_id"] for f in found if "record_id" in f] == ["1"]
    assert sum(passed) < 8 * len(data)

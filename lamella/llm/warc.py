"""WARC archives: a writer with revisit records, and a salvage reader.

The writer runs in the tasks that hold the rows. Each task writes archives of one
gzip member a record below a folder that all executors share, under names of its own
attempt, and returns their names; only the names that Spark kept from successful
attempts are read back, so a lost executor leaves no record twice.

The reader checks every record: the gzip member's own checksum, the version line, the
header fields, continued lines among them, the declared length, the closing blank lines, and
the digests of block and payload. A digest is taken by its own kind (SHA-1, SHA-256, SHA-512 or
MD5, in hexadecimal or base 32); one of another kind, or of an HTTP body that was sent in
pieces, can't be checked, and ``digest_check`` says so. The payload of HTTP records is their body for this.
After a failed check it searches for the next valid gzip member or version line, inside
a member's content for the next version line, goes on there, and reports the bytes in
between as a quarantined gap with the reason. The next place of each mark is remembered, and so
are headers that failed, so a search passes over the bytes once, whatever stands in them. Only
records that fail by their digest, and lie inside each other, are read more than once.

Defined results: a null payload is empty; a null id, address or reference is left out
of the record and read back as null; rows with equal payloads and the same smallest id
are all responses; where all ids of equal payloads are null, all are responses; an
empty table gives no archives and no records; a record that comes twice in an archive
is read twice; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.llm.common import Scratch, table

#: Payloads of fewer bytes are always written in full.
LEAST_BYTES = 100
#: An archive is closed once it has so many bytes.
ARCHIVE_BYTES = 16 << 20
#: References are broadcast up to so many rows of 100 bytes, else joined by shuffle.
BROADCAST_ROWS = 50_000

VERSION = b"WARC/1.1"
_MAGIC = b"\x1f\x8b\x08"
_CHUNK = 1 << 16

_FIELDS = ["path", "start", "end", "problem", "record_id", "record_type", "uri", "refers_to", "payload_bytes", "payload_digest", "digest_check", "payload"]
_SCHEMA = "path string, start long, end long, problem string, record_id string, record_type string, uri string, refers_to string, payload_bytes long, payload_digest string, digest_check string, payload binary"
_ARROW = pa.schema([(n, pa.int64() if n in ("start", "end", "payload_bytes") else pa.binary() if n == "payload" else pa.string()) for n in _FIELDS])


def _clean(value: str) -> str:
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record_bytes(record_id: str | None, uri: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One record; with ``refers_to`` a revisit, whose block is empty."""
    fields = {
        "WARC-Type": "revisit" if refers_to is not None else "response",
        "WARC-Record-ID": f"<urn:record:{_clean(record_id)}>" if record_id is not None else None,
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": _clean(uri) if uri is not None else None,
        "WARC-Refers-To": f"<urn:record:{_clean(refers_to)}>" if refers_to is not None else None,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Payload-Length": str(len(payload)),
        "Content-Type": "text/html",
    }
    block = b"" if refers_to is not None else payload
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return VERSION + b"\r\n" + head.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


class BadRecord(ValueError):
    """A check on a record failed."""


_VERSION_LINE = re.compile(rb"WARC/1\.[0-9]+\r\n")
_MARK, _LINE_END = b"WARC/1.", b"\r\n"
_KINDS = ("sha1", "sha256", "sha512", "md5")


class Marks:
    """Where marks come next in some bytes, and headers that failed; asking forward costs one pass over the bytes."""

    def __init__(self, data: bytes):
        self.data = data
        self.next: dict[bytes, tuple[int, int]] = {}
        self.failed: tuple[int, int, str] | None = None

    def find(self, mark: bytes, start: int) -> int:
        """The first place of a mark from ``start`` on, or the end of the bytes."""
        asked, place = self.next.get(mark, (0, -1))
        if not asked <= start <= place:
            place = self.data.find(mark, start)
            place = len(self.data) if place < 0 else place
            self.next[mark] = (start, place)
        return place

    def fail(self, start: int, stop: int, why: str) -> BadRecord:
        """Every header that begins inside these lines ends as they do."""
        self.failed = (start, stop, why)
        return BadRecord(why)


def _header(data: bytes, at: int, marks: Marks) -> tuple[dict[bytes, str], int]:
    """Fields from a line's start on, and where the block begins; a line that begins with a blank goes on with the one before."""
    if marks.failed and marks.failed[0] <= at < marks.failed[1]:
        raise BadRecord(marks.failed[2])
    fields: dict[bytes, list[bytes]] = {}
    last, stop = None, at
    while True:  # line by line, so that a false version line ends at its first line that is no field
        start, stop = stop, marks.find(_LINE_END, stop)
        if stop == len(data):
            raise marks.fail(at, len(data), "unfinished header")
        line, stop = data[start:stop], stop + 2
        if not line:
            return {k: b" ".join(v).decode("utf-8", "replace") for k, v in fields.items()}, stop
        if line[:1] in b" \t" and last is not None:
            fields[last].append(line.strip())
            continue
        name, colon, value = line.partition(b":")
        if not colon or line[:1] in b" \t":
            raise marks.fail(at, stop, "bad header line")
        last = name.strip().lower()
        fields[last] = [value.strip()]


def _same(label: str, content: bytes) -> bool | None:
    """Whether a labelled digest is that of the content; None for a kind that isn't known here."""
    kind, _, value = label.rpartition(":")
    kind = kind.strip().lower().replace("-", "")
    if not kind and re.fullmatch("[0-9A-Fa-f]{64}", value):
        kind = "sha256"
    if kind not in _KINDS:
        return None
    own, value = hashlib.new(kind, content).digest(), value.strip()
    if len(value) == 2 * len(own):
        return value.lower() == own.hex()
    try:
        return base64.b32decode(value.rstrip("=") + "=" * (-len(value.rstrip("=")) % 8), casefold=True) == own
    except binascii.Error:
        return False


def _checked(fields: dict[bytes, str], block: bytes) -> str:
    """"verified", "unverified" or "absent", over both digests; a wrong one raises."""
    found = []
    if label := fields.get(b"warc-block-digest"):
        found.append(_same(label, block))
    if label := fields.get(b"warc-payload-digest"):
        same = _same(label, block)
        if same is False and fields.get(b"content-type", "").lower().startswith("application/http"):
            head, blank, body = block.partition(b"\r\n\r\n")
            same = _same(label, body) if blank else None
            if same is False and re.search(rb"(?i)\r\n(transfer|content)-encoding:", head):
                same = None  # kept as sent, or decoded: archives differ
        found.append(same)
    if False in found:
        raise BadRecord("wrong digest")
    return "absent" if not found else "unverified" if None in found else "verified"


def parse_record(data: bytes, at: int = 0, marks: Marks | None = None) -> tuple[dict, int]:
    """The record at an offset, and where it ends."""
    marks = Marks(data) if marks is None else marks
    version = _VERSION_LINE.match(data, at)
    if not version:
        # What is cut off, or has no line end, is told from what is no version line.
        raise BadRecord("unfinished header" if data.startswith(_MARK, at) and marks.find(_LINE_END, at) == len(data) else "no version line")
    fields, stop = _header(data, version.end(), marks)
    try:
        length = int(fields[b"content-length"])
    except (KeyError, ValueError):
        raise marks.fail(version.end(), stop, "no length") from None
    end = stop + length
    if length < 0 or data[end : end + 4] != b"\r\n\r\n":
        raise marks.fail(version.end(), stop, "wrong length")
    try:
        size = int(fields.get(b"warc-payload-length", length))
    except ValueError:
        raise BadRecord("no length") from None
    payload = data[stop:end]
    digest = fields.get(b"warc-payload-digest", "").removeprefix("sha256:")
    kind, check = fields.get(b"warc-type", ""), "unverified" if b"warc-payload-digest" in fields else "absent"
    if kind != "revisit":  # a revisit's digest is that of a payload that stands elsewhere
        check = _checked(fields, payload)
        digest, size = hashlib.sha256(payload).hexdigest(), length
    bare = lambda key: fields[key].removeprefix("<urn:record:").removesuffix(">") if key in fields else None
    found = {"record_id": bare(b"warc-record-id"), "record_type": kind, "uri": fields.get(b"warc-target-uri"), "refers_to": bare(b"warc-refers-to")}
    return found | {"payload_bytes": size, "payload_digest": digest, "digest_check": check, "payload": None if kind == "revisit" else payload}, end + 4


def inflate(data: memoryview, at: int) -> tuple[bytes, int, str]:
    """The content of the gzip member at an offset, where it or its readable part ends, and what is wrong with it."""
    inflater, out, n = zlib.decompressobj(31), [], at
    while not inflater.eof:
        if n >= len(data):
            return b"".join(out), n, "unfinished member"
        chunk, before = data[n : n + _CHUNK], inflater.copy()
        try:
            out.append(inflater.decompress(chunk))
        except zlib.error:
            for k in range(len(chunk)):  # what comes before the byte that shows the damage
                try:
                    out.append(before.decompress(chunk[k : k + 1]))
                except zlib.error:
                    break
            return b"".join(out), n + k + 1, "broken member"
        n += len(chunk)
    return b"".join(out), n - len(inflater.unused_data), ""


def _inner(content: bytes) -> tuple[list[tuple[dict, int, int]], list[tuple[int, int, str]]]:
    """(record, start, end) and gaps (start, end, problem) of a member's content; after a failed check at the next version line."""
    records, gaps, at, gap, problem = [], [], 0, None, ""
    marks = Marks(content)
    while at < len(content):
        try:
            record, end = parse_record(content, at, marks)
        except BadRecord as e:
            if gap is None:
                gap, problem = at, str(e)
            at = marks.find(_MARK, at + 1)
            continue
        if gap is not None:
            gaps.append((gap, at, problem))
            gap = None
        records.append((record, at, end))
        at = end
    if gap is not None:
        gaps.append((gap, len(content), problem))
    return records, gaps


def salvage(data: bytes) -> Iterator[dict]:
    """Records in order, and gaps: dicts whose ``problem`` says which check failed first.

    Records of one gzip member, and the gaps between them, have the member's offsets; such a
    gap's problem also gives its bytes in the member's content. From a broken or unfinished
    member come the records that were whole before the damage showed; as its checksum says
    nothing, they stand on their own checks like those of a plain archive.
    """
    view, at, gap, problem = memoryview(data), 0, None, ""
    known: set[bytes] = set()  # read from a broken member, whose stored blocks show them again
    known_to = 0
    marks = Marks(data)

    def after(at: int) -> int:
        return min(marks.find(_MAGIC, at + 1), marks.find(_MARK, at + 1))

    while at < len(data):
        found: list[dict] = []
        gaps: list[tuple[int, int, str]] = []
        failed = ""
        if data.startswith(_MAGIC, at):
            content, end, failed = inflate(view, at)
            inner, gaps = _inner(content)
            found = [record for record, _, _ in inner]
            if failed:
                if found:
                    known |= {hashlib.sha256(content[i:j]).digest() for _, i, j in inner}
                    known_to = max(known_to, end)
                    last = inner[-1][2]
                    gaps = [g for g in gaps if g[0] < last] + [(last, len(content), failed)]
                end = after(at)
            elif not found and gaps:
                failed = gaps[0][2]
        else:
            try:
                record, end = parse_record(data, at, marks)
                if at >= known_to or hashlib.sha256(data[at:end]).digest() not in known:
                    found = [record]
                else:
                    failed = "part of a broken member"
            except BadRecord as e:
                failed, end = str(e), after(at)
        if failed and not found:
            if gap is None:
                gap, problem = at, failed
            at = end
            continue
        if gap is not None:
            yield {"start": gap, "end": at, "problem": problem}
            gap = None
        for record in found:
            yield record | {"start": at, "end": end}
        for first, last, why in gaps:
            yield {"start": at, "end": end, "problem": f"{why}, bytes {first} to {last} of the content"}
        at = end
    if gap is not None:
        yield {"start": gap, "end": len(data), "problem": problem}


def _uri(path: str) -> str:
    return path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path


def write_warc(rows: DataFrame, folder: str) -> DataFrame:
    """Write (record_id, uri, payload, digest, refers_to) rows; gives (name, records) of each archive, once run."""
    folder = _uri(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = pyarrow.fs.FileSystem.from_uri(folder)
        out, size, count, name, done = None, 0, 0, "", []

        def close() -> None:
            nonlocal out
            if out is not None:
                out.close()
                done.append((name, count))
                out = None

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    fs.create_dir(top, recursive=True)
                    name, size, count = f"part-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{top}/{name}", compression=None)
                member = gzip.compress(record_bytes(row["record_id"], row["uri"], row["payload"] or b"", row["digest"], row["refers_to"]), 6, mtime=0)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= ARCHIVE_BYTES:
                    close()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.string()), pa.array([c for _, c in done], pa.int64())], ["name", "records"])

    return rows.select("record_id", "uri", "payload", "digest", "refers_to").mapInArrow(run, "name string, records long")


def _read(files: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows, size = [], 0
                for found in salvage(content.as_py()):
                    rows.append({"path": path} | found)
                    size += len(found.get("payload") or b"")
                    if size > 4 << 20 or len(rows) >= 2000:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)

    return files.select("path", "content").mapInArrow(run, _SCHEMA)


def read_warc(spark: SparkSession, folder: str, names: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, gaps) of the archives in a folder, plain or gzipped; ``names`` keeps to those archives."""
    found = _found(spark, folder, names)
    return found.where("problem is null").drop("problem"), found.where("problem is not null").select("path", "start", "end", "problem")


def _found(spark: SparkSession, folder: str, names: DataFrame | None) -> DataFrame:
    files = spark.read.format("binaryFile").load(folder)
    if names is not None:
        files = files.withColumn("name", F.element_at(F.split("path", "/"), -1)).join(F.broadcast(names.select("name")) if names.count() <= BROADCAST_ROWS else names.select("name"), "name", "left_semi")
    return _read(files)


def read_all(spark: SparkSession, folder: str, written: DataFrame, scratch: Scratch) -> DataFrame:
    """The records, without payloads, of archives that ``write_warc`` has just written, as a written table.

    Raises ``BadRecord`` if any part of them can't be read, or if not as many records come back as were written.
    """
    if written.isEmpty():
        return spark.createDataFrame([], _SCHEMA).drop("payload", "problem")
    found = scratch.keep(_found(spark, folder, written).drop("payload"), "records")
    n, gaps = found.agg(F.count_if(F.col("problem").isNull()), F.count("problem")).first()
    wanted = written.agg(F.sum("records")).first()[0]
    if gaps or n != wanted:
        raise BadRecord(f"{n} of {wanted} records came back, with {gaps} gaps")
    return found.drop("problem")


def archive_rows(pages: DataFrame, scratch: Scratch, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html") -> DataFrame:
    """What ``write_warc`` takes: repeated payloads refer to the record with the smallest id."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    df = pages.select(F.col(id_col).alias("id"), F.col(uri_col).cast("string").alias("uri"), payload.alias("payload"))
    df = df.withColumn("digest", F.sha2("payload", 256))
    large = df.where(F.octet_length("payload") >= LEAST_BYTES)
    firsts = large.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    firsts = scratch.keep(firsts, "firsts")
    known = F.broadcast(firsts) if firsts.count() <= BROADCAST_ROWS else firsts
    joined = df.join(known, "digest", "left")
    revisits = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return joined.select(F.col("id").cast("string").alias("record_id"), "uri", "payload", "digest", F.when(revisits, F.col("first").cast("string")).alias("refers_to"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "warc")
    folder = scratch.path("archives")
    written = scratch.keep(write_warc(archive_rows(table(spark, sf_dir, "pages"), scratch), folder), "names")
    records = read_all(spark, folder, written, scratch)
    return records.select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


_SQL = f"""
with p as (select page_id, coalesce(html, '') h, strlen(coalesce(html, '')) n, sha256(coalesce(html, '')) d from pages),
f as (select d, min(page_id) a from p where n >= {LEAST_BYTES} group by d)
select page_id, cast(n as bigint) payload_bytes, d payload_digest,
  case when a is not null and page_id is distinct from a then 'revisit' else 'response' end record_type,
  case when page_id is distinct from a then a end refers_to
from p left join f using (d)
"""

QUERIES = {"op2_warc": op2_warc}
SQL = {"op2_warc": _SQL}

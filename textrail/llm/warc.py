"""WARC archives: written by tasks, read back by a salvage reader.

Every record is a gzip member of its own, so archives can be cut and joined
at record borders.  Spark's text writer puts the members into files, with its
own commit, on any store that it can write to.  That writer ends each row with
a separator; it is an empty gzip member here, which adds nothing to what
the file unpacks to.

Payloads of equal content are stored once: the other rows become revisit
records, which hold the HTTP head and refer to the response record.

The reader takes whole files and trusts none of their bytes.  A record counts
when its member's checksum, its header, its length, its end and its digests
agree.  After a failed check it searches for the next gzip member or version
line that begins a valid record, goes on there, and logs the bytes between as
a quarantined gap with the check that failed.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

#: Payloads from this many bytes on are stored once.
LEAST = 100
#: Records in one archive file, which the reader holds whole.
FILE_RECORDS = 4000
#: A header that is longer than this is damaged.
HEADER = 1 << 16
#: Bytes of payload in one batch of read records.
BATCH_BYTES = 1 << 23
#: A payload with more rows than this, and than a 10,000th of all, is joined in parts: at most 10,000 are.
HOT = 10_000
# fixed value: an empty gzip member
EMPTY = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
# fixed value: the profile of revisits with equal payloads
SAME = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- records ---

def _line(name: str, value: str | None) -> bytes:
    """A header field; bytes that would break the line are percent-encoded."""
    if value is None:
        return b""
    return f"{name}: {re.sub(r'[\x00-\x20\x7f]', lambda m: f'%{ord(m[0]):02X}', value)}\r\n".encode()


def record_bytes(kind: str, record_id: str, url: str | None, date: str, digest: str, size: int, payload: bytes | None,
                 refers_to: str | None = None, refers_uri: str | None = None) -> bytes:
    """One record, uncompressed: a response with its payload, or a revisit with the HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head + payload if payload is not None else head
    fields = [b"WARC/1.1\r\n", _line("WARC-Type", kind), _line("WARC-Record-ID", record_id), _line("WARC-Date", date), _line("WARC-Target-URI", url),
              b"Content-Type: application/http; msgtype=response\r\n", _line("WARC-Payload-Digest", f"sha256:{digest}"),
              _line("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}")]
    if payload is None:
        fields += [_line("WARC-Profile", SAME), _line("WARC-Refers-To", refers_to), _line("WARC-Refers-To-Target-URI", refers_uri)]
    return b"".join([*fields, f"Content-Length: {len(block)}\r\n\r\n".encode(), block, b"\r\n\r\n"])


def member(record: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


class Damage(ValueError):
    """A check that failed."""


class Found(NamedTuple):
    offset: int            # in the archive file: of the record, of its member, or of the gap
    length: int
    fields: dict[str, str] | None  # None: a gap
    payload: bytes | None
    size: int | None       # of the whole payload, as the HTTP head tells it
    reason: str | None     # of a gap


VERSION = re.compile(rb"WARC/\d+\.\d+\r\n")
START = re.compile(rb"\x1f\x8b\x08|WARC/\d+\.\d+\r\n")
_NAMED = {"sha1": hashlib.sha1, "sha256": hashlib.sha256, "md5": hashlib.md5}


def _fields(raw: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    last = None
    for line in raw.split(b"\r\n"):
        if line[:1] in (b" ", b"\t") and last:
            out[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damage("header line without a name")
        last = name.strip().decode("utf-8", "replace").lower()
        out[last] = value.strip().decode("utf-8", "replace")
    return out


def _agree(named: str | None, content: bytes, what: str) -> None:
    """Digests in hexadecimal are checked; of other spellings nothing is said."""
    label, _, value = (named or "").partition(":")
    made = _NAMED.get(label.lower().replace("-", ""))
    if made and len(value) == 2 * made().digest_size and made(content).hexdigest() != value.lower():
        raise Damage(f"{what} digest differs")


def record_at(data: bytes, at: int) -> tuple[int, Found]:
    """The uncompressed record that begins at ``at``, and where it ends."""
    version = VERSION.match(data, at)
    if not version:
        raise Damage("no version line")
    head = data.find(b"\r\n\r\n", version.end() - 2, version.end() + HEADER)
    if head < 0:
        raise Damage("header without an end")
    fields = _fields(data[version.end():head])
    for name in ("warc-type", "warc-record-id", "warc-date"):
        if not fields.get(name):
            raise Damage(f"no {name}")
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Damage("no content length")
    begin, end = head + 4, head + 4 + int(length)
    if end + 4 > len(data):
        raise Damage("record cut short")
    if data[end:end + 4] != b"\r\n\r\n":
        raise Damage("no record end where the length puts it")
    block = data[begin:end]
    _agree(fields.get("warc-block-digest"), block, "block")
    payload, size = block, len(block)
    if fields.get("content-type", "").startswith("application/http"):
        http, parted, payload = block.partition(b"\r\n\r\n")
        told = re.search(rb"(?im)^content-length:[ \t]*(\d+)", http)
        size = int(told[1]) if told else len(payload)
    if fields.get("warc-type") == "revisit":
        payload = None
    else:
        _agree(fields.get("warc-payload-digest"), payload, "payload")
    return end + 4, Found(at, end + 4 - at, fields, payload, size, None)


def member_at(data: bytes, at: int) -> tuple[int, bytes]:
    """The content of the gzip member that begins at ``at``, and where it ends."""
    z, out, to = zlib.decompressobj(31), [], at
    try:
        while not z.eof:
            chunk = data[to:to + (1 << 16)]
            if not chunk:
                raise Damage("member cut short")
            out.append(z.decompress(chunk))
            to += len(chunk)
            if len(out) == 1 and out[0] and not out[0].startswith(b"WARC/"[:len(out[0])]):
                raise Damage("member without a version line")
    except zlib.error as e:
        raise Damage(f"member: {e}") from e
    return to - len(z.unused_data), b"".join(out)


def salvage(data: bytes) -> Iterator[Found]:
    """Every valid record of an archive, in order, and the gaps between them."""
    at, lost, why = 0, None, ""
    while at < len(data):
        try:
            if data.startswith(b"\x1f\x8b", at):
                end, content = member_at(data, at)
                # what fails inside a sound member is a gap at that member
                here = [f._replace(offset=at, length=end - at) for f in salvage(content)]
            else:
                end, record = record_at(data, at)
                here = [record]
        except Damage as e:
            if lost is None:
                lost, why = at, str(e)
            again = START.search(data, at + 1)
            at = again.start() if again else len(data)
            continue
        if lost is not None:
            yield Found(lost, at - lost, None, None, None, why)
            lost = None
        yield from here
        at = end
    if lost is not None:
        yield Found(lost, len(data) - lost, None, None, None, why)


# --- writing and reading with Spark ---

def _planned(df: DataFrame, id_col: str, url_col: str, payload_col: str, least: int) -> DataFrame:
    """One row per record: (id, url, digest, bytes, copy, payload, to_id, to_url, revisit)."""
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b""))
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload").cast("bigint"))
    first = F.min(F.struct(F.col("id").isNull().alias("no"), "id", F.col("url").isNull().alias("none"), "url"))
    none = [F.lit(None).cast("bigint").alias("to_id"), F.lit(None).cast("string").alias("to_url"), F.lit(False).alias("revisit")]
    small = rows.where(F.col("bytes") < least).select("id", "url", "digest", "bytes", F.monotonically_increasing_id().alias("copy"), "payload", *none)
    large = rows.where(F.col("bytes") >= least)
    # map-side, equal payloads shrink to one row: the payload crosses the shuffle once a task at most
    kept = large.groupBy("digest", "bytes").agg(first.alias("f"), F.first("payload").alias("payload"))
    kept = kept.select("f.id", "f.url", "digest", "bytes", F.lit(0).cast("bigint").alias("copy"), "payload", *none)
    # without their payloads: how often each row occurs, and the response that the others refer to
    keys = stored(large.groupBy("digest", "bytes", "id", "url").agg(F.count(F.lit(1)).alias("n")))
    total = keys.agg(F.sum("n").alias("n")).first()["n"] or 0
    limit = max(HOT, total // 10_000)
    heads = keys.groupBy("digest").agg(first.alias("f"), F.sum("n").alias("g")).where("g > 1")
    heads = heads.select("digest", F.col("f.id").alias("to_id"), F.col("f.url").alias("to_url"), F.ceil(F.col("g") / limit).alias("parts"))
    hot = F.broadcast(heads.where("parts > 1").select("digest", "parts"))  # bounded: at most total / limit rows
    dealt = keys.join(hot, "digest", "left").withColumn("part", F.pmod(F.xxhash64("id", "url"), F.coalesce("parts", F.lit(1)))).drop("parts")
    heads = heads.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))).drop("parts")
    met = dealt.join(heads, ["digest", "part"])
    taken = (F.col("id").eqNullSafe(F.col("to_id")) & F.col("url").eqNullSafe(F.col("to_url"))).cast("bigint")
    copies = met.where(F.col("n") > taken).withColumn("copy", F.explode(F.sequence(taken, F.col("n") - 1)))
    again = copies.select("id", "url", "digest", "bytes", "copy", F.lit(None).cast("binary").alias("payload"), "to_id", "to_url", F.lit(True).alias("revisit"))
    return kept.unionByName(small).unionByName(again)


def record_id(page: int | None, copy: int, digest: str, url: str | None) -> str:
    """The URN of a page's record: unlike for rows that differ, and for the copies of equal rows."""
    mark = hashlib.sha256(f"{digest} {url}".encode()).hexdigest()[:16]
    return f"<urn:page:{'' if page is None else page}:{copy}:{mark}>"


def write_archives(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   least: int = LEAST, date: str = "1970-01-01T00:00:00Z", file_records: int = FILE_RECORDS) -> None:
    """Write one record per row into archives in the new folder ``path``.

    The payload is the column's bytes (a string's in UTF-8; null: empty).  Of
    rows with equal payloads of at least ``least`` bytes, the one with the
    smallest id (null ids last, then by url) is a response and the others
    revisit it; rows with smaller payloads are responses all.  Rows repeating
    an id, or in every column, have records of their own.  A null url gives no
    target field.  An empty table gives an empty folder.  Other columns are not
    read.  The table has no capture time: ``date`` stands in every record.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for r in range(batch.num_rows):
                page, url, digest, n, copy, payload, to_id, to_url, revisit = (batch.column(c)[r].as_py() for c in range(9))
                refers = record_id(to_id, 0, digest, to_url) if revisit else None
                made = record_bytes("revisit" if revisit else "response", record_id(page, copy, digest, url), url, date, digest, n, payload, refers, to_url if revisit else None)
                out.append(member(made))
                size += len(out[-1])
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    planned = _planned(df, id_col, url_col, payload_col, least).select("id", "url", "digest", "bytes", "copy", "payload", "to_id", "to_url", "revisit")
    records = planned.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
    records.write.option("lineSep", EMPTY.decode("latin-1")).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", file_records).text(path)


_READ = ("archive string, offset bigint, length bigint, kind string, record_id string, target_uri string, date string, "
         "refers_to string, payload_digest string, payload_bytes bigint, payload binary, reason string")
_KINDS = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string()]


def read_archives(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Every valid record of the archives in ``path``, plain or gzipped, and
    the quarantined gaps: ``archive, offset, length, kind, record_id,
    target_uri, date, refers_to, payload_digest, payload_bytes, payload, reason``.

    ``kind`` is the record's type or ``gap``; a gap has its place in the file,
    its length and the ``reason``, the first check that failed there.  A
    revisit has a null payload and its whole payload's size.  A failure inside
    a sound member is a gap at that member.  Empty files give no rows.  A file
    is read by one task, as a whole; files above 2 GB are beyond Spark's
    reader of binary files.  A whole record that lies inside the damaged
    bytes of another (an archive kept as a payload) is recovered as one of its own.
    """
    names = [c.split()[0] for c in _READ.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], names=names)

        for batch in batches:
            for r in range(batch.num_rows):
                archive, out, size = batch.column("path")[r].as_py(), [], 0
                for f in salvage(batch.column("content")[r].as_py()):
                    get = (f.fields or {}).get
                    out.append((archive, f.offset, f.length, get("warc-type", "unknown") if f.fields is not None else "gap", get("warc-record-id"), get("warc-target-uri"),
                                get("warc-date"), get("warc-refers-to"), get("warc-payload-digest"), f.size, f.payload, f.reason))
                    size += len(f.payload or b"") + 500
                    if size > BATCH_BYTES:
                        yield made(out)
                        out, size = [], 0
                if out:
                    yield made(out)

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    return files.mapInArrow(run, _READ)


def pages_of(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of the
    page records among those that ``read_archives`` gives; a response's size and
    digest are those of the payload read, a revisit's those that it names."""
    def page(column: str):
        return F.nullif(F.regexp_extract(column, "^<urn:page:(-?[0-9]*):", 1), F.lit("")).cast("bigint")

    whole = F.col("kind") == "response"
    return records.where(F.col("kind").isin("response", "revisit")).select(
        page("record_id").alias("page_id"), F.when(whole, F.octet_length("payload").cast("bigint")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(whole, F.sha2("payload", 256)).otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        F.col("kind").alias("record_type"), page("refers_to").alias("refers_to"))

"""Legacy web archives (ARC) to WARC files, with copies of a payload as revisit records.

An ARC file opens with a version block: a ``filedesc://`` line whose last field
is the declared length, then ``<version> <reserved> <origin>`` and the names of
the fields of a header line. Every document is a header line with these fields
(version 1: address, IP, date, type, length; version 2 adds result code,
checksum, location, offset and file name) and as many bytes as the line
declares. Nothing in a document is searched for: lengths alone lead from record
to record.

A WARC record is made of each: an identifier from the archive's name and the
document's offset, the ISO form of the 14-digit date, a type (``warcinfo`` for
version blocks, ``response`` for archived HTTP answers, ``resource`` for the
rest), digests of payload and block. Of equal payloads of at least
``REVISIT_BYTES`` one keeps its payload, the others become ``revisit`` records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordwise.llm.common import arrow_schema, cut, spread_lookup, text_of, tidy

#: Payloads below this are always stored.
REVISIT_BYTES = 1000
#: Bytes of WARC records that are written as one piece, and pieces in a file.
PIECE_BYTES = 4 << 20
PIECES_PER_FILE = 8
#: Revisit decisions are broadcast up to this many rows (about 100 bytes each), shuffled beyond.
BROADCAST_ROWS = 100_000

# fixed values: names of the formats
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARC_FIELDS = {
    "1": ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    "2": ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location",
          "Offset", "Filename", "Archive-length"],
}
#: HTTP header of an archived answer that holds the document's number.
ID_HEADER = "X-Page-Id"


class ArchiveError(ValueError):
    """A damaged archive: a header or length that does not fit the bytes."""


# --- ARC ---------------------------------------------------------------------------

def _line(data: bytes, at: int, where: str) -> tuple[bytes, int]:
    end = data.find(b"\n", at)
    if end < 0:
        raise ArchiveError(f"{where}: header line at {at} has no end")
    return data[at:end].rstrip(b"\r"), end + 1


def _fields(line: bytes, names: list[str], where: str, at: int) -> dict[str, str]:
    """A header line by its field names. The address may hold spaces, so fields count from the right."""
    parts = line.decode("utf-8", "replace").rsplit(" ", len(names) - 1)
    if len(parts) != len(names) or not parts[-1].isdigit():
        raise ArchiveError(f"{where}: no header line of {len(names)} fields at {at}")
    return dict(zip(names, parts))


def parse_arc(data: bytes, name: str = "archive"):
    """(offset, header fields, content) of every record of an ARC file, the version block first.

    ``data`` may be gzip, in one member or one per record. A declared length
    that reaches past the end, or a line that is no header, is an ``ArchiveError``.
    """
    data = unzipped(data)
    if not data:
        return
    head, at = _line(data, 0, name)
    if not head.startswith(b"filedesc://"):
        raise ArchiveError(f"{name}: no version block")
    tail = head.rsplit(b" ", 1)[-1]
    if not tail.isdigit() or at + int(tail) > len(data):
        raise ArchiveError(f"{name}: version block without its declared length")
    block = data[at:at + int(tail)]
    lines = block.decode("utf-8", "replace").splitlines()
    version = lines[0].split(" ")[0] if lines else ""
    if version not in ARC_FIELDS:
        raise ArchiveError(f"{name}: unknown version {version!r}")
    names = lines[1].split() if len(lines) > 1 and lines[1].strip() else ARC_FIELDS[version]
    if names[0] != "URL" or names[-1] != "Archive-length":
        raise ArchiveError(f"{name}: unknown field line {lines[1]!r}")
    # the version block's own line has the fields of its version
    yield 0, _fields(head, ARC_FIELDS[version], name, 0), block
    at += len(block)
    while True:
        while data[at:at + 1] in (b"\n", b"\r"):       # the line break that ends a document
            at += 1
        if at >= len(data):
            return
        line, start = _line(data, at, name)
        fields = _fields(line, names, name, at)
        end = start + int(fields["Archive-length"])
        if end > len(data):
            raise ArchiveError(f"{name}: the record at {at} declares {end - start} bytes, "
                               f"{len(data) - start} are left")
        yield at, fields, data[start:end]
        at = end


def unzipped(data: bytes) -> bytes:
    """Bytes of a gzip file of any number of members; other bytes as they are."""
    import zlib
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data[:2] == b"\x1f\x8b":
        d = zlib.decompressobj(31)
        out.append(d.decompress(data))
        if not d.eof:
            raise ArchiveError("gzip member without its end")
        data = d.unused_data
    return b"".join(out)


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """(header block with its blank line, payload) of an archived HTTP answer; no header: all payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    ends = [(i, i + len(m)) for m in (b"\r\n\r\n", b"\n\n") if (i := content.find(m)) >= 0]
    end = min(ends)[1] if ends else len(content)
    return content[:end], content[end:]


def http_field(head: bytes, name: str) -> str | None:
    want = name.lower().encode() + b":"
    for line in head.splitlines():
        if line.lower().startswith(want):
            return line[len(want):].strip().decode("utf-8", "replace")
    return None


def iso_date(date: str) -> str:
    """``YYYYMMDDhhmmss``, or a leading part of it, as the date of a WARC record."""
    full = date + "00000101000000"[len(date):]
    if not full.isdigit() or len(full) != 14:
        raise ArchiveError(f"no archive date: {date!r}")
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:]}Z"


def record_id(archive: str, offset: int) -> bytes:
    """16 bytes of a name-based UUID of the archive's name and the offset in it."""
    import uuid
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{archive}:{offset}").bytes


_RECORD = ("rid binary, kind string, target string, date string, ip string, mime string, page_id long, "
           "payload_bytes long, digest binary")


def _int_or_none(text: str | None) -> int | None:
    if text is None or not text.lstrip("-").isdigit():
        return None
    n = int(text)
    return n if -(1 << 63) <= n < 1 << 63 else None


def read_arc(files: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record of the ARC files in ``files`` (columns ``path`` and ``content``, as
    Spark's ``binaryFile`` source gives them): rid, kind, target, date, ip, mime, page_id (from
    the archived ``X-Page-Id``, else null), payload_bytes, digest (SHA-1 of the payload) and,
    ``with_payload``, the archived HTTP header block and the payload.

    A file with null or empty content has no records; a damaged one fails the job.
    """
    schema = _RECORD + (", head binary, payload binary" if with_payload else "")
    out_schema = arrow_schema(schema)
    names = out_schema.names

    def kernel(batches):
        import hashlib

        import pyarrow as pa
        for b in batches:
            for path, content in zip(b.column("path"), b.column("content")):
                archive = (path.as_py() or "").rsplit("/", 1)[-1]
                rows, size = [], 0
                for offset, f, block in parse_arc(content.as_py() or b"", archive):
                    head, payload = split_http(block)
                    url = f["URL"]
                    kind = "warcinfo" if offset == 0 else "response" if head else "resource"
                    row = [record_id(archive, offset), kind, url, iso_date(f["Archive-date"]), f["IP-address"],
                           f["Content-type"], _int_or_none(http_field(head, ID_HEADER)), len(payload),
                           hashlib.sha1(payload).digest()]
                    rows.append(row + [head, payload] if with_payload else row)
                    size += len(block) + 200
                    if size > PIECE_BYTES:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=out_schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=out_schema)

    return files.select("path", "content").mapInArrow(tidy(kernel), schema)


# --- revisits ----------------------------------------------------------------------

def revisits(records: DataFrame, min_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(rid, refers_to) of the records that repeat another's payload.

    Of the responses with one digest and length of at least ``min_bytes`` the one
    with the largest page_id (null lowest; ties: the largest rid) keeps its
    payload. Copies are combined by digest and a salt first, so a payload that
    fills a third of all records is never one task.
    """
    salts = max(2, int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = (records.filter((F.col("kind") == "response") & (F.col("payload_bytes") >= min_bytes))
            .select("rid", "page_id", F.struct("digest", "payload_bytes").alias("of"),
                    F.pmod(F.xxhash64("rid"), F.lit(salts)).alias("salt")))
    best = F.max(F.struct("page_id", "rid"))
    part = rows.groupBy("of", "salt").agg(best.alias("top"), F.count(F.lit(1)).alias("n"))
    whole = (part.groupBy("of").agg(F.max("top").alias("top"), F.sum("n").alias("n")).filter("n > 1")
             .select("of", F.col("top.rid").alias("refers_to")))
    near = part.select("of", "salt").join(whole, "of")
    return rows.join(near, ["of", "salt"]).filter("rid <> refers_to").select("rid", "refers_to")


def with_revisits(records: DataFrame, decided: DataFrame) -> DataFrame:
    """``records`` with refers_to; broadcast up to a checked number of decisions, else a join
    by the unique rid."""
    few = decided.count() <= BROADCAST_ROWS
    return records.join(F.broadcast(decided) if few else decided, "rid", "left")


# --- WARC --------------------------------------------------------------------------

def _urn(rid: bytes) -> str:
    import uuid
    return f"<{uuid.UUID(bytes=rid).urn}>"


def _label(sha1: bytes) -> str:
    import base64
    return "sha1:" + base64.b32encode(sha1).decode()


def warc_record(r: dict) -> bytes:
    """One record without its two closing line breaks."""
    import hashlib
    again = r["refers_to"] is not None
    block = r["head"] if again else r["head"] + r["payload"]
    kind = "revisit" if again else r["kind"]
    lines = [WARC_VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(r['rid'])}", f"WARC-Date: {r['date']}"]
    if kind == "warcinfo":
        lines.append(f"WARC-Filename: {r['target'].rsplit('/', 1)[-1]}")
    else:
        lines.append(f"WARC-Target-URI: {r['target']}")
    if r["ip"] not in ("", "-", "0.0.0.0"):
        lines.append(f"WARC-IP-Address: {r['ip']}")
    if again:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_urn(r['refers_to'])}"]
    lines += [f"WARC-Payload-Digest: {_label(r['digest'])}",
              f"WARC-Block-Digest: {_label(hashlib.sha1(block).digest())}",
              "Content-Type: " + ("application/http;msgtype=response" if r["head"] else r["mime"]),
              f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def write_warc(records: DataFrame, path: str, compression: str | None = "gzip") -> None:
    """Write ``records`` (``read_arc`` with payload, and refers_to) as WARC files under ``path``.

    Spark's own text sink writes them, so commit, retries and file systems are
    Spark's: a row is a piece of whole records, and the two line breaks that end a
    WARC record are the sink's line separator. A file holds at most
    ``PIECES_PER_FILE`` pieces of about ``PIECE_BYTES``.
    """
    def kernel(batches):
        import pyarrow as pa
        schema = pa.schema([("piece", pa.binary())])
        held, size = [], 0
        for b in batches:
            for i in range(b.num_rows):
                rec = warc_record({n: b.column(n)[i].as_py() for n in b.schema.names})
                if held and size + len(rec) > PIECE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"\r\n\r\n".join(held)], pa.binary())], schema=schema)
                    held, size = [], 0
                held.append(rec)
                size += len(rec) + 4
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"\r\n\r\n".join(held)], pa.binary())], schema=schema)

    names = ["rid", "kind", "target", "date", "ip", "mime", "digest", "head", "payload", "refers_to"]
    pieces = records.select(*names).mapInArrow(tidy(kernel), "piece binary")
    w = (pieces.select(F.col("piece").cast("string").alias("value")).write
         .option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", PIECES_PER_FILE))
    (w.option("compression", compression) if compression else w).text(path)


def parse_warc(data: bytes, name: str = "archive"):
    """(named fields in lower case, block) of every record, by declared lengths."""
    at, size = 0, len(data)
    while True:
        while data[at:at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= size:
            return
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n") if end >= 0 else [""]
        if not lines[0].startswith("WARC/"):
            raise ArchiveError(f"{name}: no record at {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        length = fields.get("content-length", "")
        start = end + 4
        if not length.isdigit() or start + int(length) > size:
            raise ArchiveError(f"{name}: the record at {at} lacks its declared bytes")
        at = start + int(length)
        yield fields, data[start:at]


def _rid(urn: str | None) -> bytes | None:
    import uuid
    return uuid.UUID(urn.strip("<>")).bytes if urn else None


def _sha1(label: str) -> bytes:
    import base64
    return base64.b32decode(label.removeprefix("sha1:"))


def read_warc(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record of the WARC files under ``path``: rid, kind, target, date, page_id,
    payload_bytes (null in a revisit, whose payload is elsewhere), digest, refers_to and,
    ``with_payload``, the payload. A block or payload unlike its digest fails the job.
    """
    schema = ("rid binary, kind string, target string, date string, page_id long, payload_bytes long, "
              "digest binary, refers_to binary") + (", payload binary" if with_payload else "")
    out_schema = arrow_schema(schema)
    names = out_schema.names

    def kernel(batches):
        import hashlib

        import pyarrow as pa
        for b in batches:
            for name, content in zip(b.column("path"), b.column("content")):
                rows, size = [], 0
                for f, block in parse_warc(unzipped(content.as_py()), name.as_py()):
                    if hashlib.sha1(block).digest() != _sha1(f["warc-block-digest"]):
                        raise ArchiveError(f"{name}: block of {f['warc-record-id']} is not what its digest says")
                    head, payload = split_http(block)
                    kind, digest = f["warc-type"], _sha1(f["warc-payload-digest"])
                    whole = kind != "revisit"
                    if whole and hashlib.sha1(payload).digest() != digest:
                        raise ArchiveError(f"{name}: payload of {f['warc-record-id']} is not what its digest says")
                    row = [_rid(f["warc-record-id"]), kind, f.get("warc-target-uri"), f["warc-date"],
                           _int_or_none(http_field(head, ID_HEADER)), len(payload) if whole else None, digest,
                           _rid(f.get("warc-refers-to"))]
                    rows.append(row + [payload if whole else None] if with_payload else row)
                    size += 300 + (len(payload) if with_payload else 0)
                    if size > PIECE_BYTES:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=out_schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=out_schema)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(tidy(kernel), schema)


def resolved(records: DataFrame) -> DataFrame:
    """``records`` of ``read_warc`` with the payload_bytes of revisits, and the page they refer
    to as refers_page, both from the record they name. Many revisits of one record are spread."""
    target = (records.filter("kind = 'response'")
              .select(F.col("rid").alias("refers_to"), F.col("page_id").alias("refers_page"),
                      F.col("payload_bytes").alias("__bytes")))
    found = spread_lookup(records, "refers_to", target, F.xxhash64("rid"))
    return (found.withColumn("payload_bytes", F.coalesce("payload_bytes", "__bytes")).drop("__bytes"))


def convert(files: DataFrame, path: str, min_bytes: int = REVISIT_BYTES, compression: str | None = "gzip") -> None:
    """ARC files (``path``, ``content``) to WARC files under ``path``.

    The archives are parsed twice: once for identifiers and digests, which settle
    the revisits, once for the payloads, which go straight from parser to writer.
    Records of zero files give an empty folder; repeated documents are records of
    their own and revisit each other; other columns of ``files`` are ignored.
    """
    known = cut(read_arc(files, with_payload=False).select("rid", "kind", "page_id", "payload_bytes", "digest"))
    decided = cut(revisits(known, min_bytes))
    write_warc(with_revisits(read_arc(files), decided), path, compression)


# --- archives of the pages table -----------------------------------------------------

def arc_of_pages(pages: DataFrame, arc_bytes: int = 8 << 20) -> DataFrame:
    """The pages table as legacy archives: rows ``path, content`` as ``binaryFile`` gives them.

    Only the layout of the input is made here: versions 1 and 2 in turn, a new
    archive after ``arc_bytes``, html as the body of an archived HTTP answer (null:
    empty) with the page_id in a header. Blanks and control characters of an
    address are percent-encoded; a null address is ``http://unknown/``.
    """
    def arc(version: str, name: str, docs: list) -> bytes:
        origin = f"{version} 0 pages\n{' '.join(ARC_FIELDS[version])}\n\n".encode()
        more = f"200 - - 0 {name} " if version == "2" else ""
        date = "20010203040506"
        out = [f"filedesc://{name} 0.0.0.0 {date} text/plain {more}{len(origin)}\n".encode(), origin]
        at = sum(map(len, out))
        for url, body in docs:
            extra = f"200 - - {at + 1} {name} " if version == "2" else ""
            head = f"\n{url} 192.0.2.1 {date} text/html {extra}{len(body)}\n".encode()
            out += [head, body]
            at += len(head) + len(body)
        return b"".join(out + [b"\n"])

    def kernel(batches):
        from urllib.parse import quote

        import pyarrow as pa
        from pyspark import TaskContext
        keep = "".join(map(chr, range(0x21, 0x7f)))
        pid, n, docs, size = TaskContext.get().partitionId(), 0, [], 0

        def done():
            name = f"pages-{pid:08d}-{n:08d}.arc"
            return pa.RecordBatch.from_pylist([{"path": name, "content": arc("12"[n % 2], name, docs)}],
                                              schema=pa.schema([("path", pa.string()), ("content", pa.binary())]))

        for b in batches:
            for page, url, html in zip(b.column("page_id"), b.column("url"), b.column("__html")):
                number = f"{ID_HEADER}: {page.as_py()}\r\n" if page.is_valid else ""
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{number}\r\n".encode()
                docs.append((quote(url.as_py() or "http://unknown/", safe=keep), head + html.as_py()))
                size += len(docs[-1][1])
                if size >= arc_bytes:
                    yield done()
                    docs, size, n = [], 0, n + 1
        if docs:
            yield done()

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        text_of("html").cast("binary").alias("__html"))
    return rows.mapInArrow(tidy(kernel), "path string, content binary")

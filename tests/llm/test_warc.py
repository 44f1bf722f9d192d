"""Archive conversion: parsing by declared lengths, synthesised records, revisits, reading back."""
import hashlib

import pytest
from pyspark.sql import functions as F

from ordwise.llm import warc
from ordwise.session import scratch_path

SCHEMA = "page_id long, url string, html string"


def _arc(version, docs, names=None):
    names = names or warc.ARC_FIELDS[version]
    body = f"{version} 0 test\n{' '.join(names)}\n\n".encode()
    more = "200 - - 0 t.arc " if version == "2" else ""
    out = f"filedesc://t.arc 0.0.0.0 19990102030405 text/plain {more}{len(body)}\n".encode() + body
    for url, date, mime, content in docs:
        out += f"\n{url} 10.0.0.1 {date} {mime} {more}{len(content)}\n".encode() + content
    return out + b"\n"


DOCS = [("http://a.org/x y", "19990102030405", "text/html", b"HTTP/1.0 200 OK\r\nX-Page-Id: 7\r\n\r\nbody\nhttp://b 1 2 3 4\n"),
        ("dns:a.org", "199901", "text/dns", b"\n\nno header"),
        ("http://a.org/empty", "19990102030405", "text/html", b""),
        ("http://a.org/head", "19990102030405", "text/html", b"HTTP/1.0 204 Nothing\r\nA: b")]


@pytest.mark.parametrize("version", ["1", "2"])
@pytest.mark.parametrize("packed", [False, True, "each"])
def test_parse_by_declared_lengths(version, packed):
    import gzip
    data = _arc(version, DOCS)
    if packed == "each":
        data = gzip.compress(data[:50]) + gzip.compress(data[50:])
    elif packed:
        data = gzip.compress(data)
    found = list(warc.parse_arc(data))
    assert [(f["URL"], f["Archive-date"], f["Content-type"], block) for _, f, block in found[1:]] == DOCS
    assert found[0][0] == 0 and found[0][1]["URL"] == "filedesc://t.arc"
    assert len({offset for offset, _, _ in found}) == 5


def test_field_line_decides_the_layout():
    names = ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Archive-length"]
    body = f"1 0 other\n{' '.join(names)}\n\n".encode()
    data = f"filedesc://t 0.0.0.0 19990102030405 text/plain {len(body)}\n".encode() + body + \
        b"\nhttp://q 1.2.3.4 19990102030405 text/plain 404 3\nabc\n"
    assert [b for _, _, b in warc.parse_arc(data)][1:] == [b"abc"]


@pytest.mark.parametrize("bad", [
    b"no archive", b"filedesc://x 0.0.0.0 19990102030405 text/plain 999\n1 0 t\n", _arc("1", DOCS)[:-30],
    _arc("1", DOCS).replace(b"1 0 test", b"7 0 test"), _arc("1", DOCS) + b"some line without fields\n",
    _arc("1", DOCS) + b"no line end"])
def test_damaged_archives_are_refused(bad):
    with pytest.raises(warc.ArchiveError):
        list(warc.parse_arc(bad))


def test_synthesised_fields():
    assert warc.iso_date("19990102030405") == "1999-01-02T03:04:05Z"
    assert warc.iso_date("1999") == "1999-01-01T00:00:00Z"
    with pytest.raises(warc.ArchiveError):
        warc.iso_date("19xx0102030405")
    assert warc.record_id("a.arc", 5) == warc.record_id("a.arc", 5) != warc.record_id("a.arc", 6)
    assert warc.split_http(b"HTTP/1.1 200 OK\nA: b\n\nx\r\n\r\ny") == (b"HTTP/1.1 200 OK\nA: b\n\n", b"x\r\n\r\ny")
    assert warc.split_http(b"plain\r\n\r\ny") == (b"", b"plain\r\n\r\ny")


def test_types_and_round_trip(spark, tmp_path):
    import gzip
    files = spark.createDataFrame([("s3://bucket/one.arc.gz", bytearray(gzip.compress(_arc("1", DOCS)))),
                                   ("two.arc", bytearray(_arc("2", DOCS))), ("none.arc", bytearray(b"")),
                                   ("null.arc", None)], "path string, content binary")
    out = f"{tmp_path}/warc"
    warc.convert(files, out, compression=None)
    back = {(r.target, bytes(r.rid)): r for r in warc.read_warc(spark, out, with_payload=True).collect()}
    assert len(back) == 10
    kinds = sorted((r.kind, r.target or "") for r in back.values())
    assert kinds.count(("warcinfo", "")) == 2 and kinds.count(("resource", "dns:a.org")) == 2
    one = next(r for r in back.values() if r.target == "http://a.org/x y")
    assert (one.page_id, one.date, bytes(one.payload)) == (7, "1999-01-02T03:04:05Z", b"body\nhttp://b 1 2 3 4\n")
    text = b"".join(p.read_bytes() for p in (tmp_path / "warc").glob("part-*"))
    assert text.count(b"WARC/1.1\r\n") == 10 and text.endswith(b"\r\n\r\n")
    assert b"WARC-IP-Address: 10.0.0.1\r\n" in text and b"WARC-Filename: t.arc\r\n" in text


def test_damage_in_a_warc_file_is_found(spark, tmp_path):
    files = spark.createDataFrame([("t.arc", bytearray(_arc("1", DOCS)))], "path string, content binary")
    out = tmp_path / "warc"
    warc.convert(files, str(out), compression=None)
    part = next(p for p in out.glob("part-*") if p.stat().st_size)
    data = part.read_bytes().replace(b"body", b"bodi")
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0").write_bytes(data)
    with pytest.raises(Exception, match="not what its digest says"):
        warc.read_warc(spark, str(bad)).collect()


def _expected(rows):
    """(payload_bytes, sha1, type, refers_to) in order of the rows, by plain grouping."""
    groups = {}
    for i, (page, _, html) in enumerate(rows):
        groups.setdefault((html or "").encode(), []).append((page is not None, page or 0, i))
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        top = max(groups[body])
        out.append((page, len(body), hashlib.sha1(body).hexdigest(), top[1] if len(body) >= 1000 and top[0] else None))
    return out


def _convert(spark, pages):
    out = scratch_path(spark, "warc-test")
    warc.convert(warc.arc_of_pages(pages, arc_bytes=5000), out)
    return warc.resolved(warc.read_warc(spark, out)).filter("kind <> 'warcinfo'")


def test_revisits_of_pages(spark, monkeypatch):
    big, odd = "long " * 300, "é日本\r\n\r\nWARC/1.1\r\n" * 100
    rows = [(i, f"http://h/{i}", big) for i in range(40)] + [
        (100, None, odd), (101, "http://x y\n/é", odd), (102, "u", "short"), (103, "u", "short"), (104, "u", None),
        (105, "u", ""), (-3, "u", "n" * 1000), (-9, "u", "n" * 1000), (106, "u", "m" * 999), (107, "u", "m" * 999),
        (None, "u", big), (200, "u", "y" * 200_000)]
    pages = spark.createDataFrame(rows, SCHEMA).withColumns({"kind": F.lit("k"), "path": F.lit("p"), "n": F.lit(1)})
    for limit in (0, 100_000):      # decisions shuffled, then broadcast
        monkeypatch.setattr(warc, "BROADCAST_ROWS", limit)
        got = _convert(spark, pages).collect()
        want = _expected(rows)
        assert sorted((r.page_id is None, r.page_id or 0, r.payload_bytes, bytes(r.digest).hex()) for r in got) == sorted(
            (w[0] is None, w[0] or 0, w[1], w[2]) for w in want)
        refers = {r.page_id: r.refers_page for r in got}
        for page, size, _, top in want:
            assert refers[page] == (top if top is not None and top != page else None), page
        assert all((r.kind == "revisit") == (r.refers_page is not None) for r in got)


def test_repeated_rows_and_empty_table(spark):
    pages = spark.createDataFrame([(5, "u", "z" * 2000)] * 3, SCHEMA)
    got = _convert(spark, pages).collect()
    assert sorted((r.kind, r.refers_page, r.payload_bytes) for r in got if r.kind == "revisit") == [("revisit", 5, 2000)] * 2
    assert [r.kind for r in got].count("response") == 1
    assert _convert(spark, pages.limit(0)).collect() == []

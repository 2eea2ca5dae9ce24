"""Archives in both versions: parsed, converted, read back; damage and odd lines; the query against plain Python and SQL."""

import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from nephos.llm import queries, warc
from nephos.session import shared_path
from tests.llm.helpers import with_clashing_columns
from tests.oracle import assert_same, connect

SCHEMA = "page_id long, url string, html string"
LONG = "x" * 1200


def pages():
    rows = [(i, f"http://a.example/{i}", f"<p>{i}</p>" * 200) for i in range(20)]
    rows += [(i, f"http://b.example/{i}", LONG) for i in range(20, 60)] + [(200, "http://b.example/z", LONG), (200, "http://b.example/z", LONG)]
    rows += [(i, None, "short") for i in range(60, 64)] + [(64, "", None), (65, "http://c.example/a b\n", ""), (None, "http://n", LONG), (None, "http://n", "y" * 999)]
    rows += [(-7, "dns:x", "é漢😀" * 200), (-8, "ftp://y", "é漢😀" * 200), (70, "http://d", "HTTP/1.1 200 OK\r\n\r\n" + "z" * 100_000), (71, "http://e", "z" * 3_000_000)]
    return rows


def brute(rows):
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    most, out = {}, []
    for i, p in payloads:
        if len(p) >= 1000:
            most[p] = max(most.get(p, -(2**70)), -(2**69) if i is None else i)
    seen = set()
    for i, p in payloads:
        response = len(p) < 1000 or ((-(2**69) if i is None else i) == most[p] and p not in seen)
        if response and len(p) >= 1000:
            seen.add(p)
        refers = None if response or most[p] == -(2**69) else most[p]
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "response" if response else "revisit", refers))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in df.collect()), key=str)


def test_hard_rows_match_brute_force(spark):
    df = spark.createDataFrame(pages(), SCHEMA)
    clashing = with_clashing_columns(df).withColumns({"file": F.lit("x"), "number": F.lit(1), "date": F.lit("y"), "n": F.lit(2)})
    assert got(warc.page_archives(clashing.repartition(5))) == brute(pages())
    assert got(warc.page_archives(df.coalesce(1))) == brute(pages())
    assert got(warc.page_archives(spark.createDataFrame([], SCHEMA))) == []


def test_files_hold_synthesised_fields(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    old, new = shared_path(spark, "test-arc"), shared_path(spark, "test-warc")
    files = warc.write_arc(spark.createDataFrame(pages(), SCHEMA).repartition(2), old)
    names = sorted(r["file"] for r in files.collect())
    with warc.reading(names[0]) as one, warc.reading(names[-1]) as two:
        assert [warc.arc_version(s, "")[0] for s in (one, two)] == [1, 2]
    made = sorted(r["file"] for r in warc.convert(files, new).collect())
    assert [warc.base_name(f).removesuffix(".warc.gz") for f in made] == [warc.base_name(f).removesuffix(".arc.gz") for f in names]
    by_id, revisits = {}, []
    for f in made:
        with warc.reading(f) as stream:
            records = list(warc.warc_records(stream, f))
        assert records[0].kind == "warcinfo" and all(r.headers["WARC-Warcinfo-ID"] == records[0].headers["WARC-Record-ID"] for r in records[1:])
        by_id |= {r.headers["WARC-Record-ID"]: r for r in records}
        revisits += [r for r in records if r.kind == "revisit"]
    assert len(by_id) == len(pages()) + len(made) and len(revisits) == 42 + 1
    for r in revisits:
        first = by_id[r.headers["WARC-Refers-To"]]
        assert first.kind == "response" and first.headers["WARC-Payload-Digest"] == r.headers["WARC-Payload-Digest"]
        assert (r.headers["WARC-Refers-To-Target-URI"], r.headers["WARC-Refers-To-Date"]) == (first.headers["WARC-Target-URI"], first.headers["WARC-Date"])
        assert warc.http_parts(r.block) == (r.block, b"") and r.headers["WARC-Profile"] == warc.PROFILE
    again = warc.convert(files, shared_path(spark, "test-warc-2"))
    for a, b in zip(made, sorted(r["file"] for r in again.collect()), strict=True):
        with warc.reading(a) as x, warc.reading(b) as y:
            assert x.read() == y.read()


V1 = b"filedesc://old.arc 0.0.0.0 19961022103200 text/plain 77\n1 0 Crawler\nURL IP-address Archive-date Content-type Archive-length\n\n\n"
V2 = b"filedesc://new.arc 0.0.0.0 1997 text/plain 200 - - 0 new.arc 123\n2 0 Crawler\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n\n\n"


def block(head: bytes) -> bytes:
    """The declared length of a version block put right."""
    line, _, body = head.partition(b"\n")
    return line.rsplit(b" ", 1)[0] + b" %d\n" % (len(body) - 1) + body


def parsed(data):
    return list(warc.arc_records(io.BufferedReader(io.BytesIO(data)), "t.arc"))


def test_header_lines_of_both_versions():
    one = parsed(block(V1) + b"http://a/b c 10.0.0.1 19970101123456 text/html; charset=x 5\nab\ncd\n\nhttp://d 1.2.3.4 199702 text/plain 0\n\n")
    assert [(r.number, r.url, r.ip, r.date, r.mime, r.block, r.truncated) for r in one] == [
        (0, "http://a/b c", "10.0.0.1", "1997-01-01T12:34:56Z", "text/html; charset=x", b"ab\ncd", False),
        (1, "http://d", "1.2.3.4", "1997-02-01T00:00:00Z", "text/plain", b"", False),
    ]
    two = parsed(block(V2) + b"http://a 10.0.0.1 19979999000000 text/html 404 abc - 17 new.arc 3\nxyz\nhttp://b - 19980203 a/b - - - - f 9\nshort")
    assert [(r.url, r.date, r.block, r.truncated) for r in two] == [("http://a", "1997-01-01T00:00:00Z", b"xyz", False), ("http://b", "1998-02-03T00:00:00Z", b"short", True)]


@pytest.mark.parametrize("data", [b"", b"http://x 1.1.1.1 1997 a/b 3\nabc\n", block(V1).replace(b"1 0 C", b"3 0 C"), block(V1) + b"no line of any version\n", block(V1) + b"http://a 10.0.0.1 1997 text/html 404 abc - 17 new.arc x\n"])
def test_what_is_no_archive_raises(data):
    with pytest.raises(ValueError):
        parsed(data)


def test_plain_files_resources_and_damage(spark, tmp_path):
    body = b"HTTP/1.0 200 OK\nServer: x\n\nhi there"
    (tmp_path / "a.arc").write_bytes(block(V1) + b"http://a 1.1.1.1 19970101 text/html %d\n" % len(body) + body + b"\ndns:b 1.1.1.1 19970101 text/dns 4\nb IN\nhttp://c 1.1.1.1 19970101 text/html 50\nHTTP/1.0 200 OK\n\ncut")
    new = shared_path(spark, "test-plain")
    (made,) = warc.convert(warc.archive_files(spark, f"file://{tmp_path}", "*.arc"), new).collect()
    with warc.reading(made["file"]) as stream:
        info, page, dns, cut = warc.warc_records(stream, "")
    assert (info.kind, page.kind, dns.kind, cut.kind) == ("warcinfo", "response", "resource", "response")
    assert page.block == body and page.headers["WARC-Payload-Digest"] == warc.sha1(b"hi there")
    assert (dns.block, dns.headers["Content-Type"], cut.headers["WARC-Truncated"]) == (b"b IN", "text/dns", "unspecified")
    raw = gzip.decompress((tmp_path / "x").read_bytes()) if (tmp_path / "x").exists() else warc.warc_record([("WARC-Type", "response"), ("WARC-Record-ID", "<u>")], b"abc")
    with pytest.raises(ValueError):
        list(warc.warc_records(io.BufferedReader(io.BytesIO(raw.replace(b"abc", b"abd"))), ""))


def test_query_matches_its_oracle(spark, sf_dir):
    assert_same(queries.op11_warc(spark, sf_dir), connect(sf_dir), queries.WARC_SQL)

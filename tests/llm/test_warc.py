"""Records through files and back, bodies of all kinds, and all pages against
another HTML parser."""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import time
import zlib
from html.parser import HTMLParser

from pyspark.sql import functions as F

from shelfcast.llm import warc


class Plain(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.run, self.silent = [], [], None

    def cut(self):
        line = " ".join("".join(self.run).split())
        self.run = []
        if line:
            self.lines.append(line)

    def handle_starttag(self, tag, attrs):
        if tag in warc.SILENT:
            self.silent = tag
        if tag in warc.BREAKS:
            self.cut()

    def handle_endtag(self, tag):
        if tag == self.silent:
            self.silent = None
        if tag in warc.BREAKS:
            self.cut()

    def handle_data(self, data):
        if not self.silent:
            self.run.append(data)


def test_all_pages_against_another_parser(spark):
    pages = {r.page_id: r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    got = warc.op1_warc_derivatives(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == 2 * len(pages) and len({r.record_id for r in got}) == len(got)
    for r in got:
        page = pages[r.page_id]
        want = warc.response_of(page.url, page.html.encode(), str(r.page_id))
        assert r.refers_to == want[0] and r.target_uri == page.url and r.http_status == "HTTP/1.1 200 OK"
        assert r.source_digest == warc.digest(page.html.encode())
        named = warc.fields_of(r.headers)
        assert named["WARC-Refers-To"] == r.refers_to and named["WARC-Type"] == r.type
        assert int(named["Content-Length"]) == r.content_length
        if r.type == "conversion":
            other = Plain()
            other.feed(page.html)
            other.close()
            other.cut()
            text = "\n".join(other.lines).encode()
            assert r.block_sha256 == hashlib.sha256(text).hexdigest(), r.page_id


def test_metadata():
    page = b"<html><head><title>A &amp; B</title></head><body><a href='/x?a=1&amp;b=2'>x</a><img src=y.png></body></html>"
    rid, _, uri, date, headers, block = warc.response_of("http://e.org/d/", page, "1")
    meta, text = warc.derivatives(rid, uri, date, headers, block)
    about = json.loads(meta[5])
    assert about["title"] == "A & B" and about["links"] == ["http://e.org/x?a=1&b=2", "http://e.org/d/y.png"]
    assert about["refers_to"] == rid and about["warc_headers"]["WARC-Record-ID"] == rid
    assert about["http_headers"]["Content-Length"] == str(len(page)) and about["payload_digest"] == warc.digest(page)
    assert text[5] == b"A & B\nx"
    assert warc.derivatives(rid, uri, date, headers, block)[0] == meta


def test_bodies():
    body = "<p>caf\xe9</p>"
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=%s\r\n%s\r\n"
    packed = gzip.compress(body.encode("latin-1"))
    chunked = b"5\r\n" + packed[:5] + b"\r\n" + b"%x;x=y\r\n" % len(packed[5:]) + packed[5:] + b"\r\n0\r\n\r\n"
    text = lambda block: warc.derivatives("<r>", "u", "d", "", block)[1][5].decode()
    assert text(head % (b"latin-1", b"") + body.encode("latin-1")) == "café"
    assert text(head % (b"iso-8859-1", b"Content-Encoding: gzip\r\nTransfer-Encoding: chunked\r\n") + chunked) == "café"
    assert text(head % (b"latin-1", b"Content-Encoding: deflate\r\n") + zlib.compress(body.encode("latin-1"))) == "café"
    assert text(head % (b"nonsense", b"") + body.encode()) == "café"
    assert text(b"<meta charset='latin-1'>caf\xe9") == "café"
    assert text(b"") == "" and text(b"HTTP/1.1 200 OK") == ""
    assert text(head % (b"latin-1", b"Content-Encoding: gzip\r\n") + packed[:-6]) == "café"


def test_files(spark, tmp_path):
    rows = [(1, "http://a/", "<p>one\r\n\r\nWARC/1.1\r\n two", 0), (2, None, None, 0), (3, "http://b/", "é" * 200_000, 0),
            (3, "http://b/", "é" * 200_000, 0), (None, "http://c/", "", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, block int")
    made = warc.responses(pages)
    every = made.drop("page_id").unionByName(warc.derive(made).select(*warc.NAMES))
    want = sorted((r.record_id, r.type, r.uri, r.date, r.headers, bytes(r.block)) for r in every.collect())
    assert len(want) == 15
    for kind in ("none", "gzip"):
        warc.write(every, f"{tmp_path}/{kind}", kind)
        back = warc.read(spark, f"{tmp_path}/{kind}/")
        assert sorted((r.record_id, r.type, r.uri, r.date, r.headers, bytes(r.block)) for r in back.collect()) == want
    again = warc.derive(warc.read(spark, f"{tmp_path}/none/"))
    assert again.count() == 10 and again.where(F.col("refers_to").isNull()).count() == 0
    members = b"".join(gzip.compress(bytes(r.value, "utf-8", "surrogateescape") + b"\n") for r in warc.wire(made.limit(1)).collect())
    assert [r[1] for r in warc.parsed(members * 2)] == ["response", "response"]
    assert warc.derive(warc.responses(pages.limit(0))).count() == 0


def test_scripts_are_no_markup():
    page = ("<title>a <b c &amp; d</title><p>one<script>for(i=0;i<n;i++){f()}</script>two <a href=x>link</a><style>p::after{content:'<b'}</STYLE >"
            "<script>a<b; var s='</p>'; <!-- </script><p>three <template><script>if(i<n)'</template>'</script><p>no</template><noscript><p>no</noscript>"
            "<textarea>x <y </textarea><p>four</p><script>if (a<b) '</scripted>' </script\n><p>five<script>i<n")
    text, title, links = warc.page_parts(page, "http://e.org/")
    assert text == "a <b c & d\nonetwo link\nthree x <y\nfour\nfive"
    assert title == "a <b c & d" and links == ["http://e.org/x"]


def test_repeated_fields():
    head = "HTTP/1.1 200 OK\r\nSet-Cookie: a=1\r\nLink: </x>\r\nset-cookie: b=2\r\nLink: </y>\r\nContent-Encoding: identity\r\nContent-Type: text/html\r\n\r\n<p>x"
    own = "WARC-Type: response\nWARC-Concurrent-To: <urn:1>\nWARC-Concurrent-To: <urn:2>"
    about = json.loads(warc.derivatives("<r>", "u", "d", own, head.encode())[0][5])
    assert about["warc_headers"] == {"WARC-Type": "response", "WARC-Concurrent-To": ["<urn:1>", "<urn:2>"]}
    assert about["http_headers"]["Set-Cookie"] == ["a=1", "b=2"] and about["http_headers"]["Link"] == ["</x>", "</y>"]
    assert warc.field(about["http_headers"], "set-cookie") == "a=1" and about["http_headers"]["Content-Type"] == "text/html"


def response(body, encoding):
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Encoding: " + encoding.encode() + b"\r\n\r\n" + body


def test_bodies_of_several_members_and_other_encodings():
    one, two = gzip.compress(b"<p>one</p>"), gzip.compress(b"<p>two</p>")
    texts = lambda block: [r[5].decode() for r in warc.derivatives("<a>", "u", "d", "", block)]
    assert texts(response(one + two, "gzip"))[1] == "one\ntwo"
    assert texts(response(one + two[:-9], "x-gzip"))[1].startswith("one")
    assert texts(response(gzip.compress(zlib.compress(b"<p>both</p>")), "deflate, gzip"))[1] == "both"
    assert texts(response(b"<p>plain</p>", "identity"))[1] == "plain"
    about, text = texts(response(b"\x0b\x02\x80raw", "br"))
    assert text == "" and json.loads(about)["undecoded"] == "br"
    assert "undecoded" not in json.loads(texts(response(one, "gzip"))[0])


def test_many_members_are_read_in_linear_time():
    record = lambda i: (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <{i}>\r\nContent-Length: 20000\r\n\r\n".encode()
                        + os.urandom(10000).hex().encode() + b"\r\n\r\n")
    data = b"".join(gzip.compress(record(i), 1) for i in range(2000))
    began = time.monotonic()
    got = [(r[0], len(r[5])) for r in warc.parsed(data)]
    assert got == [(f"<{i}>", 20000) for i in range(2000)]
    assert time.monotonic() - began < 8                      # 13.7 s when the rest was copied for each member
    assert [r[0] for r in warc.parsed(data[:-40])][:1999] == [f"<{i}>" for i in range(1999)]

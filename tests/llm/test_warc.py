"""WARC derivatives against plain regular expressions, exact round trips, other writers' files, edge cases."""

import glob
import gzip
import html
import os
import re
import time
import zlib

import pytest
from pyspark.sql import functions as F

from trailhead.llm import common, queries, warc

SF = "/root/testdata/sf0.001"
PAGE = "<html lang='fr'><head><title>T &amp; U</title></head><body><p>a<br>b<script>x</script> c</p><a href='/z'>l</a><a class=x href=\"q>r\">m</a></body></html>"


def plain(page):
    """The text rule as single expressions over the whole page."""
    seen = re.sub(r"(?is)<!--.*?-->|<(script|style|noscript|template|svg|head)\b.*?</\1\s*>", " ", page)
    text = warc.TAGS.sub("", warc.BLOCKS.sub("\n", seen))
    lines = (warc.MIXED_SPACE.sub(" ", x).strip() for x in html.unescape(text).split("\n"))
    return "\n".join(x for x in lines if x)


def written(spark, records):
    path = common.new_path(spark, "w")
    warc.write(records, path)
    return path


def test_text_is_that_of_the_plain_rule(spark):
    pages = [r.html or "" for r in spark.read.parquet(f"{SF}/pages.parquet").select("html").collect()]
    nasty = ["", "<", "a<b", "<p", "x <script>y", "<!-- a --> b <!-- c", "<STYLE>x</style >y", "<head>a</head>b</head>", "<p>a<p b", "&lt;p&gt; &amp;amp; &#x41", "<script><style></script>v</style>w", PAGE]
    for page in pages + nasty + [p[: len(p) * 2 // 3] for p in pages[:40]]:
        assert warc.plain_text(page) == plain(page), page[:80]
    assert len(pages) > 20


def test_scan_is_linear():
    for part in ("<script>", "<!--", "<p ", "<a ", "<title ", "<html ", "<a href='", "</script "):
        began = time.process_time()
        warc.derivatives(None, "r", "u", "d", "", (part * 60_000).encode())
        assert time.process_time() - began < 5, part


def test_round_trip_and_edges(spark):
    pages = spark.createDataFrame([(1, "http://e/\r\nx", PAGE, "clash", True), (None, None, None, None, None), (1, "http://e/\r\nx", PAGE, "clash", True), (3, "u", "long " * 400_000, "c", None)], "page_id long, url string, html string, block string, intact boolean")
    path = written(spark, warc.derive(warc.responses(pages)))
    got = {}
    for r in warc.read(spark, path).collect():
        got.setdefault((r["source_id"], r["warc_type"]), []).append(r)
        assert r["intact"] and r["block_digest"] == warc.digest(bytes(r["block"]))
    text = lambda *k: bytes(got[k][0]["block"]).decode()
    assert {k: len(v) for k, v in got.items()} == {(i, t): 2 if i == "1" else 1 for i in ("1", None, "3") for t in ("metadata", "conversion")}
    assert text("1", "conversion") == plain(PAGE)
    assert text(None, "conversion") == "" and text("3", "conversion") == ("long " * 400_000).strip()
    meta = text("1", "metadata")
    assert "title: T & U\r\n" in meta and "outlink: /z\r\n" in meta and "outlink: q>r\r\n" in meta and "language: fr\r\n" in meta and "http-header: HTTP/1.1 200 OK\r\n" in meta
    m, c = got["1", "metadata"][0], got["1", "conversion"][0]
    assert m["refers_to"] == c["refers_to"] and m["record_id"] != c["record_id"] and c["source_digest"] == warc.digest(PAGE.encode()) and c["target_uri"] == "http://e/ x"
    assert got["1", "conversion"][0]["record_id"] == got["1", "conversion"][1]["record_id"]
    assert warc.read(spark, written(spark, warc.derive(warc.responses(pages.where("false"))))).count() == 0


def test_files_are_members_of_one_record(spark):
    big = "x" * (17 << 20)
    pages = spark.createDataFrame([(1, "u", big), (2, "v", "<p>y</p>")], "page_id long, url string, html string").coalesce(1)
    path = written(spark, warc.response_records(warc.responses(pages)))
    files = glob.glob(path.removeprefix("file://") + "/*.warc.gz")
    members = 0
    for f in files:
        data = open(f, "rb").read()
        while data:
            z = zlib.decompressobj(31)
            one = z.decompress(data)
            assert z.eof
            members += one.startswith(b"WARC/1.1\r\n")
            data = z.unused_data
    assert len(files) >= 1 and members == 2
    back = {r["target_uri"]: bytes(r["payload"]) for r in warc.responses_of(warc.read(spark, path)).collect()}
    assert back == {"u": big.encode(), "v": b"<p>y</p>"}


def test_response_files_derive_like_the_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = warc.responses(pages)
    path = written(spark, warc.response_records(found))
    key = lambda rows: sorted((r["warc_type"], r["refers_to"], r["block_digest"], r["source_digest"]) for r in rows.collect())
    assert key(warc.derive(warc.responses_of(warc.read(spark, path)))) == key(warc.derive(found))


def other(fields, block, version="WARC/1.0"):
    return f"{version}\r\n{fields}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def test_files_of_other_writers(spark, tmp_path):
    body = gzip.compress("<html><title>é".encode("latin-1") + b"</title><p>ok</p></html>")
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\nContent-Encoding: gzip\r\nContent-Type: text/html; charset=latin-1\r\n\r\n" + b"%x\r\n" % 10 + body[:10] + b"\r\n" + b"%x;a=b\r\n" % (len(body) - 10) + body[10:] + b"\r\n0\r\n\r\n"
    one = other("warc-type: warcinfo\r\n", b"software: x\r\n") + b"garbage\r\n\r\n" + other("WARC-Type:response\r\nWARC-Target-URI: http://a/\r\n b\r\nno colon\r\n", chunked)
    two = other("WARC-Type: resource\r\nWARC-Block-Digest: sha1:nonsense\r\n", b"\xff\xfe") + other("WARC-Type: resource\r\nWARC-Block-Digest: md5:" + "0" * 32 + "\r\n", b"") + b"WARC/1.1\r\nContent-Length: x\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(one)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(two))
    (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(other("WARC-Type: metadata\r\n", b"m") + other("WARC-Type: metadata\r\n", os.urandom(100_000)))[:-60])
    (tmp_path / "junk.warc.gz").write_bytes(b"\x1f\x8bnothing")
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    rows = warc.read(spark, f"file://{tmp_path}").collect()
    assert sorted((r["warc_type"], r["intact"]) for r in rows if r["warc_type"] == "resource") == [("resource", False), ("resource", False)]
    assert sorted(r["warc_type"] for r in rows) == ["metadata", "resource", "resource", "response", "warcinfo"]
    assert {r["intact"] for r in rows if r["warc_type"] != "resource"} == {None}
    got = warc.derive(warc.responses_of(warc.read(spark, f"file://{tmp_path}"))).collect()
    assert [bytes(r["block"]).decode() for r in got if r["warc_type"] == "conversion"] == ["é\nok"] and got[0]["target_uri"] == "http://a/ b"


@pytest.mark.parametrize("said, want", [(None, None), ("sha512:x", None), ("sha1:", None), (warc.digest(b"x"), True), (warc.digest(b"y"), False), ("sha256:2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881", True)])
def test_digests(said, want):
    assert warc.agrees(b"x", said) is want


def test_query_takes_null_ids(spark, tmp_path):
    spark.createDataFrame([(None, "u", "<p>a</p>"), (5, None, None)], "page_id long, url string, html string").write.parquet(f"file://{tmp_path}/pages.parquet")
    rows = queries.op7_warc(spark, f"file://{tmp_path}").collect()
    assert sorted((r["page_id"] or 0, r["warc_type"], r["intact"]) for r in rows) == [(0, "conversion", True), (0, "metadata", True), (5, "conversion", True), (5, "metadata", True)]
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = queries.op7_warc(spark, SF)
    assert found.count() == 2 * pages.count() and found.where(~F.col("intact")).count() == 0

from __future__ import annotations

import base64
import hashlib
import uuid

from pyspark.sql import functions as F

from tallyloom.llm import warc

ROWS = "record_id string, target_uri string, warc_date string, http_headers string, payload string"


def _sha(text):
    return "sha1:" + base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def _responses(spark):
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nX-Odd: a: b\r\n"
    rows = [("<urn:uuid:1>", "http://a/1", "2024-01-01T00:00:00Z", head, "<html><head><title>T &amp;\n U</title></head><body><p>Ünï <b>c</b>ode</p><a href='/x'>y</a><p>z\r\n\r\nw</p></body></html>"),
            ("<urn:uuid:2>", None, None, None, None), ("<urn:uuid:3>", "http://a/3", "2024-01-01T00:00:00Z", head, ""),
            ("<urn:uuid:1>", "http://a/1", "2024-01-01T00:00:00Z", head, "again"), (None, "http://a/4\r\nWARC-Type: evil", "d", head, "<p>" + "long " * 50_000)]
    return spark.createDataFrame(rows, ROWS).selectExpr("*", "'x' AS block", "'x' AS warc_type", "'x' AS page", "'x' AS headers"), rows


def test_records(spark):
    df, rows = _responses(spark)
    found = warc.derivatives(df).collect()
    assert len(found) == 2 * len(rows)
    for source in rows[:3]:
        own = {r.warc_type: r for r in found if r.refers_to == source[0] and not (source[4] and r.warc_type == "conversion" and r.block == "again")}
        m, c = own["metadata"], own["conversion"]
        assert (m.concurrent_to, c.concurrent_to) == (c.record_id, m.record_id) and m.record_id != c.record_id
        uuid.UUID(m.record_id[len("<urn:uuid:"):-1])
        assert m.target_uri == c.target_uri == source[1] and m.warc_date == source[2]
        for r in (m, c):
            assert r.block_digest == _sha(r.block) and r.content_length == len(r.block.encode())
            assert r.record.endswith("\r\n\r\n" + r.block) and f"WARC-Refers-To: {source[0]}\r\n" in r.record
            assert ("WARC-Target-URI" in r.record) == (source[1] is not None)
    first = [r for r in found if r.refers_to == "<urn:uuid:1>"]
    assert any(r.block == "Ünï code\ny\nz w" for r in first)
    meta = next(r.block for r in first if r.warc_type == "metadata" and "T & U" in r.block)
    assert meta.split("\r\n")[:3] == ["http-status: HTTP/1.1 200 OK", "http-header: Content-Type: text/html", "http-header: X-Odd: a: b"]
    assert f"source-payload-digest: {_sha(rows[0][4])}" in meta and f"source-block-digest: {_sha(rows[0][3] + chr(13) + chr(10) + rows[0][4])}" in meta
    assert "outlinks: 1" in meta
    assert warc.derivatives(df.limit(0)).collect() == []


def test_ids_do_not_change(spark):
    df, _ = _responses(spark)
    a, b = ({(r.record_id, r.block_digest) for r in warc.derivatives(df.repartition(n)).collect()} for n in (1, 4))
    assert a == b


def test_written_and_read(spark, tmp_path):
    df, _ = _responses(spark)
    records = warc.derivatives(df)
    warc.write_warc(records, str(tmp_path / "out"))
    back = warc.read_warc(spark, str(tmp_path / "out"))
    got = sorted((r.warc_type, r.record_id, r.refers_to, bytes(r.block).decode()) for r in back.collect())
    assert got == sorted((r.warc_type, r.record_id, r.refers_to, r.block) for r in records.collect())
    assert "evil" not in {r.warc_type for r in back.collect()}


def test_pages_as_responses(spark):
    pages = spark.createDataFrame([(1, "http://a", "<p>x"), (2, None, None), (None, "u", "")], "page_id long, url string, html string")
    found = warc.derivatives(warc.responses(pages, "2024-01-01T00:00:00Z"), "page_id").collect()
    assert len(found) == 6 and {r.page_id for r in found} == {1, 2, None}
    assert next(r.block for r in found if r.page_id == 1 and r.warc_type == "conversion") == "x"


def test_titles_and_links_are_those_of_the_plain_patterns():
    import random
    import re
    title = re.compile(r"<title[^>]*>(.*?)</title", re.S | re.I)
    link = re.compile(r"""<a\s[^>]*?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
    pieces = ["<title>", "<title", "</title>", "<TITLE a='b'>", "<a ", "<A\n", "href", "href=", "HREF = ", '"', "'", ">", " ", "x", "/y", "<a href='q'>", '<a href="r>s">', "é"]
    rng = random.Random(5)
    for _ in range(20_000):
        page = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        found = title.search(page)
        assert warc.title_of(page) == (found[1] if found else ""), page
        assert {x or None for x in warc.link_targets(page)} == {a or b or c or None for a, b, c in link.findall(page)}, page


def test_long_pages_are_read_in_linear_time():
    import time
    for piece in ("<a ", "<title>", "<title", "<a href", "<a href=", "<a href='", '<a href="', "<a href = >", "href="):
        start = time.time()
        page = piece * (1_000_000 // len(piece))
        warc.title_of(page), warc.link_targets(page)
        assert time.time() - start < 2, piece


def test_digests_need_no_lambda(spark):
    found = warc.derivatives(spark.createDataFrame([("a", "b", "c", "d", "e")], ROWS))
    assert "lambda" not in found._jdf.queryExecution().executedPlan().toString()
    odd = spark.createDataFrame([("",), ("é\n",), ("0" * 1000,)], "t string")
    assert all(r.d == _sha(r.t) for r in odd.select("t", warc.digest(F.col("t")).alias("d")).collect())

"""WARC derivatives: a metadata record and a plain-text conversion record for each response.

Both name the response in WARC-Refers-To and each other in WARC-Concurrent-To, keep its
target and date, and carry a SHA-1 digest of their block. The metadata block keeps
the status line and headers of the response and its block and payload digests, as `warc-fields`. Record ids
are made from the id of the response, so a repeated run gives the same records.

A written file is records one after the other; Spark's text writer puts the blank lines that end a record
between them, on any file system. The reader takes whole files, each in one task,
as the format has no index; keep files at the usual 1 GB or less.

Defined cases: a response without headers or body has empty ones; without target or date
the field is left out; without an id one is made from its content; repeated responses give repeated
records; extra columns are ignored.
"""

from __future__ import annotations

import gzip
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.llm.markup import plain_text

# The format's version, line end, base 32 alphabet, and the digits that `conv` writes to base 32.
VERSION = "WARC/1.0"
END = "\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_TITLE = re.compile(r"<title", re.I)
_TITLE_END = re.compile(r"</title", re.I)
_LINK = re.compile(r"<a\s", re.I)
_HREF = re.compile(r"href\s*=\s*", re.I)
_TARGET = re.compile(r"""(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")


def digest(block: Column) -> Column:
    """`sha1:` and the SHA-1 in base 32: eight letters from each ten hexadecimal digits."""
    code = F.sha1(block.cast("binary"))
    eights = [F.lpad(F.conv(F.substring(code, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.concat(F.lit("sha1:"), F.translate(F.concat(*eights), DIGITS, BASE32))


def record_id(*parts: Column) -> Column:
    """A urn:uuid made from the parts."""
    h = F.md5(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    cut = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cut]), F.lit(">"))


def responses(pages: DataFrame, date: str) -> DataFrame:
    """Responses as a crawler would store them: record_id, target_uri, warc_date, http_headers, payload, and page_id."""
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    size = F.octet_length(body).cast("string")
    headers = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), size, F.lit(END))
    return pages.select("page_id", record_id(F.lit("response"), F.col("page_id"), F.col("url")).alias("record_id"),
                        F.col("url").alias("target_uri"), F.lit(date).alias("warc_date"), headers.alias("http_headers"), body.alias("payload"))


def title_of(page: str) -> str:
    """Between the end of the first title tag and the next closing one; where the first has none, no later one has."""
    found = _TITLE.search(page)
    start = page.find(">", found.end()) + 1 if found else 0
    end = _TITLE_END.search(page, start) if start else None
    return page[start:end.start()] if end else ""


def link_targets(page: str) -> set[str]:
    """The first target of each link, read once from left to right: a tag without one is left as a whole."""
    out, at = set(), 0
    while found := _LINK.search(page, at):
        close = page.find(">", found.end())
        at = len(page) if close < 0 else close
        for href in _HREF.finditer(page, found.end(), at):
            target = _TARGET.match(page, href.end())
            if target:
                out.add(target[1] or target[2] or target[3])
                at = target.end()
                break
    return out


def _read_pages(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kind = pa.struct([("text", pa.string()), ("title", pa.string()), ("links", pa.int64())])
    for part in texts:
        out = []
        for x in part:
            page = x.as_py() or ""
            out.append({"text": plain_text(page), "title": " ".join(html.unescape(title_of(page)).split()), "links": len(link_targets(page))})
        yield pa.array(out, kind)


def _field(name: str, value: Column) -> Column:
    """One header line; none if the value is null. Line ends in a value become spaces."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\r\n]+", " "), F.lit(END)), F.lit(""))


def derivatives(found: DataFrame, *keep: str) -> DataFrame:
    """Two rows for each response: warc_type, record_id, refers_to, concurrent_to, target_uri, warc_date, content_type,
    content_length, block_digest, source_block_digest, source_payload_digest, block, record; `keep` columns go first."""
    empty = F.lit("")
    own = found.select(*keep, "record_id", F.col("target_uri").cast("string").alias("target_uri"), F.col("warc_date").cast("string").alias("warc_date"),
                       F.coalesce("http_headers", empty).alias("headers"), F.coalesce("payload", empty).alias("payload"))
    own = own.withColumn("record_id", F.coalesce("record_id", record_id(F.lit("response"), F.col("target_uri"), F.col("warc_date"), F.md5(F.col("payload").cast("binary")))))
    own = own.withColumn("page", F.arrow_udf(_read_pages, "text string, title string, links long")(F.col("payload")))
    own = own.withColumn("source_payload_digest", digest(F.col("payload"))).withColumn(
        "source_block_digest", digest(F.concat("headers", F.lit(END), "payload")))
    headers = F.regexp_replace(F.regexp_replace("headers", r"(?:\r?\n)+$", ""), r"\r?\n", f"{END}http-header: ")
    meta = F.concat(
        F.when(F.col("headers") != "", F.concat(F.lit("http-status: "), headers, F.lit(END))).otherwise(""),
        _field("source-block-digest", F.col("source_block_digest")), _field("source-payload-digest", F.col("source_payload_digest")),
        _field("title", F.col("page.title")), _field("outlinks", F.col("page.links")), _field("text-characters", F.length("page.text")))
    ids = {t: record_id(F.lit(t), F.col("record_id")) for t in ("metadata", "conversion")}
    rows = F.array(*[F.struct(F.lit(t).alias("warc_type"), ids[t].alias("own_id"), ids[other].alias("concurrent_to"), F.lit(kind).alias("content_type"), block.alias("block"))
                     for t, other, kind, block in (("metadata", "conversion", "application/warc-fields", meta),
                                                   ("conversion", "metadata", "text/plain; charset=utf-8", F.col("page.text")))])
    out = own.select(*keep, F.col("record_id").alias("refers_to"), "target_uri", "warc_date", "source_block_digest", "source_payload_digest", F.explode(rows).alias("r"))
    out = out.select(*keep, F.col("r.warc_type").alias("warc_type"), F.col("r.own_id").alias("record_id"), "refers_to", F.col("r.concurrent_to").alias("concurrent_to"),
                     "target_uri", "warc_date", F.col("r.content_type").alias("content_type"), F.octet_length("r.block").cast("long").alias("content_length"),
                     digest(F.col("r.block")).alias("block_digest"), "source_block_digest", "source_payload_digest", F.col("r.block").alias("block"))
    return out.withColumn("record", F.concat(
        F.lit(VERSION + END), _field("WARC-Type", F.col("warc_type")), _field("WARC-Record-ID", F.col("record_id")),
        _field("WARC-Refers-To", F.col("refers_to")), _field("WARC-Concurrent-To", F.col("concurrent_to")),
        _field("WARC-Target-URI", F.col("target_uri")), _field("WARC-Date", F.col("warc_date")), _field("WARC-Block-Digest", F.col("block_digest")),
        _field("Content-Type", F.col("content_type")), _field("Content-Length", F.col("content_length")), F.lit(END), "block"))


def write_warc(records: DataFrame, path: str) -> None:
    """Files of the `record` column, compressed as a whole."""
    records.select("record").write.option("lineSep", END * 2).option("compression", "gzip").text(path)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("warc_type", "record_id", "refers_to", "target_uri", "headers", "block")
    for batch in batches:
        for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
            data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
            rows, at = [], 0
            while at < len(data):
                stop = data.find(b"\r\n\r\n", at)
                if stop < 0:
                    raise ValueError(f"{name}: a record header does not end")
                head = data[at:stop].decode()
                fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.split(END)[1:])}
                size = int(fields["content-length"])
                block = data[stop + 4:stop + 4 + size]
                if len(block) < size:
                    raise ValueError(f"{name}: a record is cut short")
                at = stop + 4 + size + 4
                rows.append((fields.get("warc-type"), fields.get("warc-record-id"), fields.get("warc-refers-to"), fields.get("warc-target-uri"), head, block))
            for start in range(0, len(rows), 500):
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[start:start + 500]], pa.binary() if n == "block" else pa.string())
                                                  for k, n in enumerate(names)], list(names))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """warc_type, record_id, refers_to, target_uri, headers, block of every record; gzip by file or by record."""
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(
        _parse, "warc_type string, record_id string, refers_to string, target_uri string, headers string, block binary")

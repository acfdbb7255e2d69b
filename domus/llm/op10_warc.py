"""Web archives: write WARC 1.1 files, read them back, and put the records of each capture together.

A capture is written as three records (request, response or revisit, metadata) that name each other in
``WARC-Concurrent-To``. ``write_archives`` writes plain files through Spark's text writer (the record
separator is the line separator), ``read_records`` parses any WARC files by ``Content-Length`` (plain or
gzip, one or many members), and ``assemble`` joins the records into one nested row per capture.

Cases: null html is an empty payload; null url leaves ``WARC-Target-URI`` out; a null page_id is kept as
null; rows repeated with one page_id give one capture each; equal payloads with an equal largest page_id
are all responses; an empty table gives no files and no captures; further columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.llm.common import table, written
from domus.session import scratch_path

#: Payloads shorter than this are stored again rather than referred to.
MIN_REVISIT_BYTES = 1000
#: Target size of an archive file; readers hold one file at a time. Partitions follow the advisory size of the session,
#: and files are cut by the number of records that have this size on average.
FILE_BYTES = 32 << 20
WARC_DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = ("record_id string, warc_type string, target_uri string, concurrent_to array<string>, refers_to string, "
           "payload_bytes long, payload_digest string, digest_ok boolean, fields map<string,string>, payload binary")


def captures_to_write(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Decide for each page whether it is a response or a revisit of an equal payload."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce(F.col("html"), F.lit("")).alias("html"))
    p = p.withColumn("n", F.octet_length("html")).withColumn("sha", F.sha1(F.encode("html", "utf-8")))
    same = (p.filter(F.col("n") >= min_bytes).groupBy(F.col("sha").alias("same_sha"))
            .agg(F.max("page_id").alias("first_id"), F.count("*").alias("copies")).filter("copies > 1"))
    same = written(same, "warc-same")  # so that the join can split a payload that very many pages share
    p = p.join(same, (p.sha == same.same_sha) & (p.n >= min_bytes), "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return p.select("page_id", "url", "html", "n", "sha",
                    F.when(revisit, F.col("first_id")).alias("first_id"))


def _header(kind: str, *lines) -> F.Column:
    parts = [F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\n")]
    for name, value in lines:
        value = value if not isinstance(value, str) else F.lit(value)
        parts.append(F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise(""))
    return F.concat(*parts)


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write request, response or revisit, and metadata records of every page as WARC files under ``path``.

    Digests are in hexadecimal (``_hex`` reads base32 too). Header values lose CR and LF (percent-encoded).
    """
    mean = pages.select(F.avg(F.octet_length("html"))).first()[0] or 0
    c = captures_to_write(pages, min_bytes)
    c = c.withColumn("u", F.expr("uuid()"))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    urn = lambda s: F.concat(F.lit(f"<urn:domus:{s}:"), F.col("u"), F.lit(">"))
    digest = F.concat(F.lit("sha1:"), F.col("sha"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n").cast("string"), F.lit("\r\n\r\n"))
    get = F.concat(F.lit("GET "), F.coalesce(F.col("path"), F.lit("/")), F.lit(" HTTP/1.1\r\n\r\n"))
    meta = F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("\r\n"),
                    F.when(F.col("first_id").isNotNull(),
                           F.concat(F.lit("refers-to-page: "), F.col("first_id").cast("string"), F.lit("\r\n")))
                    .otherwise(""))
    c = c.withColumn("path", F.nullif(F.regexp_extract(F.coalesce(uri, F.lit("")),
                                                                 r"^[a-zA-Z]+://[^/]*(/[^#\s]*)", 1), F.lit("")))

    def record(kind, ident, block, content, *more):
        size = F.octet_length(block).cast("string")
        head = _header(kind, ("WARC-Record-ID", ident), ("WARC-Date", WARC_DATE), ("WARC-Target-URI", uri), *more,
                       ("Content-Type", content), ("Content-Length", size))
        return F.concat(head, F.lit("\r\n"), block)

    link = ("WARC-Concurrent-To", urn("capture"))
    payload = ("WARC-Payload-Digest", digest)
    is_revisit = F.col("first_id").isNotNull()
    main = F.when(is_revisit, record("revisit", urn("capture"), http, "application/http; msgtype=response", payload,
                                     ("WARC-Profile", REVISIT_PROFILE))
                  ).otherwise(record("response", urn("capture"), F.concat(http, F.col("html")),
                                     "application/http; msgtype=response", payload))
    request = record("request", urn("request"), get, "application/http; msgtype=request", link)
    metadata = record("metadata", urn("metadata"), meta, "application/warc-fields", link)
    rows = c.select(F.explode(F.array(request, main, metadata)).alias("value"))
    rows.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option(
        "maxRecordsPerFile", 3 * max(1, int(FILE_BYTES // max(mean, 1)))).text(path)


def _hex(digest: str | None) -> str | None:
    """Bare lower-case hex of a ``sha1:`` digest given in base32 or in hex."""
    if not digest:
        return None
    value = digest.partition(":")[2] or digest
    if len(value) == 32:
        return base64.b32decode(value.upper()).hex()
    return value.lower()


def _parse(stream):
    """Records of one file: (headers, block). Anything but a record at a record's place is an error."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:60]!r}")
        headers: dict[str, list[str]] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        size = int(headers["content-length"][0])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError(f"record {headers.get('warc-record-id')} is cut off")
        yield headers, block


def _fields(block: bytes) -> dict[str, str]:
    pairs = (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n") if ":" in x)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def read_records(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record of the WARC files under ``path``. A response's payload is measured and hashed from
    the bytes read and held against its header; a revisit's size and digest come from its headers.
    ``payload=False`` leaves the payload column null."""
    schema = RECORDS
    files = spark.read.format("binaryFile").load(path).select("content")

    def row(headers, block):
        one = lambda k: headers.get(k, [None])[0]
        kind = one("warc-type")
        digest, size, ok, body, fields = _hex(one("warc-payload-digest")), None, None, None, {}
        if kind in ("response", "revisit", "request"):
            head, _, body = block.partition(b"\r\n\r\n")
            fields = _fields(head)
        if kind == "response":
            size, found = len(body), hashlib.sha1(body, usedforsecurity=False).hexdigest()
            ok, digest = digest in (None, found), found
        elif kind == "revisit":
            size, body = int(fields.get("content-length", -1)), None
        elif kind == "metadata":
            fields = _fields(block)
        return (one("warc-record-id"), kind, one("warc-target-uri"), headers.get("warc-concurrent-to", []),
                one("warc-refers-to"), size, digest, ok, list(fields.items()), body if payload else None)

    def run(batches):
        arrow = pa.schema([("record_id", pa.string()), ("warc_type", pa.string()), ("target_uri", pa.string()),
                           ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()),
                           ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("digest_ok", pa.bool_()),
                           ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
        for batch in batches:
            for content in batch.column(0):
                data = io.BytesIO(content.as_py())
                stream = gzip.GzipFile(fileobj=data) if data.getvalue()[:2] == b"\x1f\x8b" else data
                rows, held = [], 0
                for headers, block in _parse(stream):
                    rows.append(row(headers, block))
                    held += len(block)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), arrow.types, strict=True)],
                            schema=arrow)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), arrow.types, strict=True)],
                        schema=arrow)

    return files.mapInArrow(run, schema)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id``, ``response`` (or revisit), ``requests``, ``metadata``.

    Records are joined by concurrent-to identifiers, in whichever direction they were written; a record that
    names a request belongs to that request's capture. Records linked to no response are left out.
    """
    main = records.filter(F.col("warc_type").isin("response", "revisit"))
    other = records.filter(F.col("warc_type").isin("request", "metadata"))
    link = records.select("record_id", F.explode("concurrent_to").alias("to"))
    link = link.union(link.select("to", "record_id"))
    ids = main.select(F.col("record_id").alias("capture_id"))
    direct = link.join(ids, link["to"] == ids.capture_id).select("record_id", "capture_id")
    request_of = direct.join(other.filter("warc_type = 'request'").select("record_id"), "record_id", "left_semi")
    hop = (link.join(request_of.select(F.col("record_id").alias("to"), "capture_id"), "to")
           .select("record_id", "capture_id"))
    member = direct.union(hop).distinct()
    keep = [c for c in records.columns if c != "concurrent_to"]
    linked = other.join(member, "record_id").groupBy("capture_id").agg(
        *(F.sort_array(F.collect_list(F.when(F.col("warc_type") == kind, F.struct(
            "record_id", "target_uri", F.map_entries("fields").alias("fields"))))).alias(name)
          for kind, name in (("request", "requests"), ("metadata", "metadata"))))
    whole = main.select(F.col("record_id").alias("capture_id"), F.struct(*keep).alias("response"))
    return whole.join(linked, "capture_id", "left")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as WARC captures, read the archives back and list what each capture holds."""
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    captures = assemble(written(read_records(spark, path, payload=False).drop("payload"), "warc-records"))
    fields = F.map_from_entries(F.flatten(F.transform("metadata", lambda m: m["fields"])))
    return captures.select(
        fields["page-id"].cast("long").alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.warc_type").alias("record_type"),
        F.when(F.col("response.warc_type") == "revisit", fields["refers-to-page"].cast("long")).alias("refers_to"))


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest
           FROM p),
     m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND last_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND last_id <> page_id THEN last_id END AS refers_to
FROM m
"""

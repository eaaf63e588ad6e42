"""WARC archives with revisit resolution.

Headers (payload digest, page id) are shuffled by digest, and the smallest id of each
digest with enough payload bytes becomes the response; all other records of that digest
revisit it. Records then carry fresh headers, and are written as gzipped WARC/1.1 by
Spark's text sink with the record separator as its line separator: one commit protocol,
any file system, and no file is opened outside Spark. Only the headers are grouped, and
the smallest id is taken before the shuffle; payloads meet their digest's row in a join
that adaptive execution can split, so a payload of a third of all pages makes no task
that holds it all.
"""

from __future__ import annotations

import base64
import hashlib
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ID = "urn:curatrix:page:"
#: What ends a record; what stands between two (with all of the version but its end), and what before the first.
SEPARATOR, JOINT, MAGIC = "\r\n\r\n", b"\r\n\r\nWARC/1.", b"WARC/1."
#: Bytes of html in an archive, in the mean.
ARCHIVE_BYTES = 128 << 20

READ_SCHEMA = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload string"


def base32_sha1(text: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a text's UTF-8 bytes: ten hex digits at a time are eight of base 32."""
    digest = F.sha1(text)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), HEX32, BASE32)


def resolve(pages: DataFrame, min_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to, refers_to_url.

    A null html is an empty payload; empty payloads are equal, too, and revisit their
    first unless ``min_bytes`` says otherwise. Rows that tie for the smallest page_id of
    a payload (repeated rows) are all responses. Rows with a null page_id revisit the
    payload's smallest id, and are responses where none has an id. Other columns are not
    read, whatever their names.
    """
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").alias("url"),
        F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("payload"),
    )
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"))
    first = rows.filter((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull()).groupBy("payload_digest").agg(F.min(F.struct("page_id", "url")).alias("f")).select("payload_digest", F.col("f.page_id").alias("first"), F.col("f.url").alias("first_url"))
    joined = rows.join(first, "payload_digest", "left")
    revisits = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("first")).alias("refers_to"), F.when(revisits, F.col("first_url")).alias("refers_to_url"),
    )


def now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def records(resolved: DataFrame, date: str | None = None) -> DataFrame:
    """One column, the record's text without the separator. Blanks and control characters in urls become %20.

    ``date`` (None: now) is that of all records, responses and revisits, as they are made at
    once; a record's id names its page and its payload.
    """
    date = date or now()
    eol = F.lit("\r\n")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    body = F.when(F.col("record_type") == "response", F.concat(head, F.col("payload"))).otherwise(head)
    clean = lambda c: F.regexp_replace(c, r"[\x00-\x20\x7F]", "%20")
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, eol), F.lit(""))
    ident = lambda c: F.concat(F.lit(f"<{ID}"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(":"), F.col("payload_digest"), F.lit(">"))
    revisit = F.col("record_type") == "revisit"
    whole = resolved.withColumn("block", body)
    return whole.select(
        F.concat(
            F.lit(f"{VERSION}\r\n"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", ident("page_id")),
            line("WARC-Date", F.lit(date)), line("WARC-Target-URI", clean("url")),
            line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
            line("WARC-Profile", F.when(revisit, F.lit(PROFILE))), line("WARC-Refers-To", F.when(revisit, ident("refers_to"))),
            line("WARC-Refers-To-Target-URI", F.when(revisit, clean("refers_to_url"))), line("WARC-Refers-To-Date", F.when(revisit, F.lit(date))),
            F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "), F.octet_length("block").cast("string"), F.lit("\r\n\r\n"),
            F.col("block"),
        ).alias("value")
    )


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write deduplicated ``.gz`` archives into the folder ``path``; so many records go to one as have ``archive_bytes`` of html in the mean.

    An archive is one gzip stream. Record ids are made of page ids and payload digests, so
    equal rows repeat their record id.
    """
    n, size = pages.agg(F.count("*"), F.sum(F.octet_length("html"))).first()
    most = max(1, int(archive_bytes * n / size)) if size else 0
    records(resolve(pages, min_bytes), date).write.option("lineSep", SEPARATOR).option("compression", "gzip").option("maxRecordsPerFile", most).text(path)


def parse_record(whole: bytes) -> "tuple[dict, int] | None":
    """The headers of a record without its version, and how many bytes the record has; None if its headers aren't complete."""
    head, sep, _ = whole.partition(b"\r\n\r\n")
    if not sep:
        return None
    headers = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        headers[name.strip().lower().decode()] = value.strip().decode()
    return headers, len(head) + 4 + int(headers["content-length"])


def rejoined(chunks):
    """Records (headers, block) from what lies between separators in each file: a block that holds the separator itself is put together again.

    ``chunks`` are (file, bytes) pairs in the files' order.
    """
    file, held, need, size = None, [], None, 0
    for name, chunk in chunks:
        if name != file:
            if held:
                raise ValueError("an archive ends within a record")
            file, first = name, True
        if first:
            if not chunk.startswith(MAGIC):
                raise ValueError(f"not a WARC record: {chunk[:40]!r}")
            chunk, first = chunk[len(MAGIC) :], False
        size += len(chunk) + len(JOINT) * bool(held)
        held.append(chunk)
        if need is None or size >= need:
            whole = JOINT.join(held)
            found = parse_record(whole)
            need = found and found[1]
            if found and len(whole) >= need:
                yield found[0], whole[whole.index(b"\r\n\r\n") + 4 : need]
                held, need, size = [], None, 0
    if held:
        raise ValueError("an archive ends within a record")


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives under ``path``: ``READ_SCHEMA``.

    Archives are streamed by Spark's text source, a record at a time, so their size does
    not matter. A response's bytes and digest are computed from its payload, a revisit's
    are those its headers name. ``payloads=False`` leaves payloads out of the rows.
    """

    def number(urn: str | None) -> int | None:
        digits = (urn or "").strip("<>").removeprefix(ID).partition(":")[0]
        return int(digits) if digits else None

    def read(batches):
        names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=names)

        chunks = ((name, chunk.as_py()) for b in batches for name, chunk in zip(b.column(0).to_pylist(), b.column(1), strict=True))
        held, size = [], 0
        for r, block in rejoined(chunks):
            head, _, whole = block.partition(b"\r\n\r\n")
            kind = r["warc-type"]
            if kind == "response":
                digest, n = base64.b32encode(hashlib.sha1(whole).digest()).decode(), len(whole)
            else:
                http = dict(x.lower().split(b": ", 1) for x in head.split(b"\r\n")[1:] if b": " in x)
                digest, n = r["warc-payload-digest"].removeprefix("sha1:"), int(http.get(b"content-length", b"0"))
            text = whole.decode() if payloads and kind == "response" else None
            held.append((number(r["warc-record-id"]), r.get("warc-target-uri"), kind, n, digest, number(r.get("warc-refers-to")), text))
            size += len(text or "")
            if len(held) >= 1000 or size > 4_000_000:
                yield batch(held)
                held, size = [], 0
        if held:
            yield batch(held)

    files = spark.read.option("lineSep", JOINT.decode()).option("pathGlobFilter", "*.gz").text(path)
    return files.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("chunk")).mapInArrow(read, READ_SCHEMA)

"""WARC archives without repeated payloads: revisit resolution.

Headers (id, address, payload's length and SHA-256) are shuffled by payload digest,
never the payloads. Of the records with equal payloads of ``LEAST`` bytes at least, the one
with the smallest page_id is the response, the others become revisit records
that refer to it; smaller payloads are always stored. Archives are written anew with fresh
headers as gzip-compressed WARC/1.1 files through Spark's writer, so that a task
that is run again leaves no half archive, ``RECORDS`` records a file at most. Reading
takes a file a row and walks it by the records' content lengths, whatever the payloads hold.
Revisits are joined to the responses they refer to by record id.

A null payload is an empty one. Rows with equal page_id and payload are all responses; a null
page_id ranks last, and when all of a payload's ids are null, all its records are
responses. Line ends in an address become spaces, a null one is left out. Further columns are
not read; an empty table gives an empty archive and result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from probscope.llm.common import written

LEAST = 100
RECORDS = 4_000
#: Repeated payloads whose digests are sent to every task; more are joined.
SENT = 200_000
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

READ = ("record_id string, record_type string, page_id long, url string, payload_digest string, refers_to_id string, "
        "payload_bytes long, payload string")


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(page_id, url, payload, payload_digest, payload_bytes) of every row."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.regexp_replace(F.col(url_col).cast("string"), r"[\r\n]+", " ").alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    return rows.withColumns({"payload_digest": F.sha2("payload", 256),
                             "payload_bytes": F.octet_length("payload").cast("long")})


def resolved(rows: DataFrame) -> DataFrame:
    """``rows`` of records() with refers_to and refers_to_url, null for responses."""
    heads = rows.select("page_id", "url", "payload_digest", "payload_bytes").where(F.col("payload_bytes") >= LEAST)
    firsts = heads.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    firsts = firsts.where("n > 1 and first is not null").drop("n")
    urls = heads.select(F.col("page_id").alias("first"), "payload_digest", "url")
    firsts = written(firsts.join(urls, ["payload_digest", "first"]).groupBy("payload_digest", "first")
                     .agg(F.min("url").alias("first_url")), "first-payloads")
    firsts = F.broadcast(firsts) if firsts.count() <= SENT else firsts
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    joined = rows.join(firsts, "payload_digest", "left")
    return joined.select(*rows.columns, F.when(again, F.col("first")).alias("refers_to"),
                         F.when(again, F.col("first_url")).alias("refers_to_url"))


def record_id(page_id: Column, digest: Column) -> Column:
    """A name for a record that depends on its page and payload only."""
    h = F.sha2(F.concat_ws("/", page_id.cast("string"), digest), 256)
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws(
        "-", part(1, 8), part(9, 4), F.concat(F.lit("8"), part(14, 3)), F.concat(F.lit("8"), part(18, 3)),
        part(21, 12)), F.lit(">"))


def write(rows: DataFrame, path: str, date: str | None = None) -> None:
    """Archives of ``rows`` of resolved() in the new folder ``path``; ``date`` is the records' WARC-Date."""
    revisit = F.col("refers_to").isNotNull()
    when = F.lit(date) if date else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    http = F.concat(F.lit(CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "])),
                    F.col("payload_bytes").cast("string"), F.lit(CRLF * 2))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value)  # null, and so left out, where the value is

    head = F.concat_ws(
        CRLF, F.lit("WARC/1.1"), field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", record_id(F.col("page_id"), F.col("payload_digest"))), field("WARC-Date", when),
        field("WARC-Target-URI", F.col("url")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        field("WARC-Refers-To", F.when(revisit, record_id(F.col("refers_to"), F.col("payload_digest")))),
        field("WARC-Refers-To-Target-URI", F.when(revisit, F.col("refers_to_url"))),
        field("X-Page-ID", F.col("page_id").cast("string")),
        F.lit("Content-Type: application/http;msgtype=response"),
        field("Content-Length", F.octet_length(block).cast("string")))
    (rows.select(F.concat(head, F.lit(CRLF * 2), block).alias("value")).write.option("lineSep", CRLF * 2)
     .option("compression", "gzip").option("maxRecordsPerFile", RECORDS).text(path))


def parsed(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, payload) of every record of one archive."""
    left, out, at = content, bytearray(), 0

    def more(n: int) -> bool:
        """Whether n bytes from ``at`` on are there, or can be had."""
        nonlocal left, out, at
        while len(out) - at < n and left:
            part = zlib.decompressobj(31)
            out = out[at:] + part.decompress(left)
            at, left = 0, part.unused_data  # archives may be one member or one for each record
        return len(out) - at >= n

    while more(1):
        end = out.find(b"\r\n\r\n", at)
        fields = dict(x.split(": ", 1) for x in out[at:end].decode().split(CRLF)[1:])
        n = int(fields["Content-Length"])
        at = end + 4
        more(n)
        block = bytes(out[at:at + n])
        at += n + 4
        yield fields, block.partition(b"\r\n\r\n")[2]


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of the archives in a folder; the digest is that of the stored payload, a revisit's that of its header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256
        names = [x.split()[0] for x in READ.split(", ")]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for fields, payload in parsed(content.as_py()):
                    response = fields["WARC-Type"] == "response"
                    rows.append((
                        fields["WARC-Record-ID"], fields["WARC-Type"],
                        int(fields["X-Page-ID"]) if "X-Page-ID" in fields else None, fields.get("WARC-Target-URI"),
                        sha256(payload).hexdigest() if response else fields["WARC-Payload-Digest"].partition(":")[2],
                        fields.get("WARC-Refers-To"), len(payload) if response else None,
                        payload.decode() if response and payloads else None))
                    size += len(payload)
                    if size >= 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, READ)


def joined(rows: DataFrame) -> DataFrame:
    """Revisits joined to the responses they refer to: ``rows`` of read() with refers_to, the response's
    page_id, and for revisits the length and payload of the response."""
    responses = rows.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long"))
    originals = responses.groupBy(F.col("record_id").alias("refers_to_id")).agg(
        F.min("page_id").alias("refers_to"), F.first("payload_bytes").alias("payload_bytes"),
        F.first("payload").alias("payload"))
    revisits = rows.where("record_type = 'revisit'").drop("payload_bytes", "payload").join(originals, "refers_to_id", "left")
    return responses.unionByName(revisits)


def rewrite(spark: SparkSession, source: str, target: str, date: str | None = None) -> None:
    """The archives of one folder resolved anew into another: revisits take the payload of their response, then all
    records are resolved by payload digest and written with fresh headers."""
    rows = joined(read(spark, source)).select("page_id", "url", "payload")
    write(resolved(written(records(rows, payload_col="payload"), "records")), target, date)

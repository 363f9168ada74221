"""Web pages to WARC archives and back, by way of a chunked record table.

A payload is a row for each chunk of bounded size: record, chunk number, bytes; it is cut before anything is
shuffled, and which page's record is a response is decided on ids and digests alone. The writer turns
each chunk into a WARC record: the first into a `response`, later ones into `continuation`
records with their segment numbers, so neither side ever needs a whole payload. The reader
streams the lines of an archive, feeds every piece to the record's running SHA-1, and gives a
row for each chunk with the digest so far; the last one has the payload's. Of records with
equal payloads one is a response and the others are `revisit` records without a payload.

Archives are gzip-compressed and written and read by Spark's own text source with CRLF line
ends, so they can be in any store that Spark reaches.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.common import out_batches, shared_folder, small_batches

CHUNK_BYTES = 1 << 20
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
ROWS = pa.schema([
    ("page_id", pa.int64()), ("chunk", pa.int64()), ("chunk_bytes", pa.int64()), ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("last", pa.bool_())])
ROWS_SPARK = "page_id long, chunk long, chunk_bytes long, bytes_so_far long, digest_so_far string, record_type string, refers_to long, last boolean"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _uri(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(uri: str):
    digits = re.fullmatch(r"<urn:page:(-?\d*)(?:#\d+)?>", uri)[1]
    return int(digits) if digits else None


def chunk_table(rows: DataFrame, payload: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """rows' other columns with chunk (0, 1, ...), chunks (their number), total (bytes) and bytes.

    An empty payload is one empty chunk. The chunks of a record are adjacent and in order in
    their partition, as long as nothing shuffles them.
    """
    others = [c for c in rows.columns if c != payload]
    sized = rows.withColumn("total", F.length(payload).cast("long")).withColumn("chunks", F.greatest(F.lit(1), F.ceil(F.col("total") / chunk_bytes)).cast("long"))
    split = sized.select(*others, payload, "total", "chunks", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    return split.select(*others, "chunk", "chunks", "total", F.expr(f"substring(`{payload}`, cast(chunk * {chunk_bytes} + 1 as int), {chunk_bytes})").alias("bytes"))


def pages_with_digest(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (UTF-8; null as empty), sha1 (hex)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    return rows.withColumn("sha1", F.sha1("payload"))


def marked_revisits(rows: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, sha1, first_id for each page_id and sha1 of pages_with_digest: the page whose record a revisit refers to, null for
    responses. Decided on ids and digests alone, not on payloads. Of equal payloads of at least least_bytes, the smallest page_id is the response (each of
    its rows, if it is repeated); null ids are revisits if another page has the payload."""
    narrow = rows.select("page_id", "sha1", F.length("payload").alias("length")).distinct()
    firsts = narrow.filter(F.col("length") >= least_bytes).groupBy("sha1").agg(F.min("page_id").alias("first_id"))
    return narrow.join(firsts, "sha1", "left").select("page_id", "sha1", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("first_id"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES, date: str = DATE) -> None:
    """A WARC record (or several segments) for each row of pages (page_id, url, html), as files in folder.

    Payloads are cut into chunks where they are read, so no row that is shuffled holds more than a chunk. They are dealt by
    page_id and digest, so a payload that many pages have is not one task's, and sorted by a number of their row, which keeps
    repeated rows apart. An archive holds what a partition does. Columns other than the three are not read.
    """
    small_batches(pages.sparkSession)
    own = pages_with_digest(pages)
    chunks = chunk_table(own.withColumns({"length": F.length("payload").cast("long"), "row": F.monotonically_increasing_id()}), "payload", chunk_bytes)
    marks = marked_revisits(own, least_bytes).withColumnsRenamed({"page_id": "_page", "sha1": "_sha1"})
    joined = chunks.join(marks, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("sha1") == F.col("_sha1")))
    # of a revisit the first chunk stays, without its bytes
    revisit = F.col("first_id").isNotNull()
    kept = joined.filter(~revisit | (F.col("chunk") == 0)).sortWithinPartitions("row", "chunk")
    records_of = kept.select("page_id", "url", "sha1", "first_id", "length", "chunk", F.when(revisit, 1).otherwise(F.col("chunks")).alias("chunks"), F.when(revisit, F.lit(b"")).otherwise(F.col("bytes")).alias("bytes"))

    def run(batches):
        running = hashlib.sha1()
        for batch in batches:
            out = []
            for page_id, url, sha1, first_id, length, chunk, chunks, body in zip(*(c.to_pylist() for c in batch.columns)):
                digest = base32(bytes.fromhex(sha1))
                head = b""
                if chunk == 0:
                    running = hashlib.sha1()
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
                running.update(body)
                block = head + body
                kind = "continuation" if chunk else "response" if first_id is None else "revisit"
                lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {_uri(page_id) if not chunk else f'{_uri(page_id)[:-1]}#{chunk}>'}", f"WARC-Date: {date}"]
                if url:
                    lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
                if chunks > 1:
                    lines.append(f"WARC-Segment-Number: {chunk + 1}")
                if chunk:
                    lines.append(f"WARC-Segment-Origin-ID: {_uri(page_id)}")
                    if chunk == chunks - 1:
                        lines.append(f"WARC-Segment-Total-Length: {length}")
                else:
                    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
                if kind == "revisit":
                    lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_uri(first_id)}"]
                elif chunk == chunks - 1 and running.hexdigest() != sha1:
                    raise ValueError(f"page {page_id}: its chunks don't add up to its payload")
                lines += [f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).digest())}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
                out.append(b"\r\n".join([VERSION, *(x.encode() for x in lines), b"", block]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    records = records_of.mapInArrow(run, "value binary")
    records.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(folder)


class Reader:
    """Lines of archives to rows of the chunked record table; holds one piece of a payload at a time."""

    def __init__(self):
        self.state, self.fields, self.open = "between", {}, None

    def line(self, line: bytes):
        """Takes a line without its CRLF; gives the row of a record that it ends, else nothing."""
        if self.state == "between":
            if line == VERSION:
                self.state, self.fields = "fields", {}
            elif line:
                raise ValueError(f"no record begins here: {line[:60]!r}")
        elif self.state == "fields":
            if line:
                name, _, value = line.partition(b":")
                self.fields[name.decode().lower()] = value.strip().decode("utf-8", "replace")
            else:
                self.begin()
        else:
            return self.piece(line)
        return None

    def begin(self):
        fields = self.fields
        self.left, self.fresh, self.block = int(fields["content-length"]), True, hashlib.sha1()
        self.chunk_bytes, self.kind = 0, fields["warc-type"]
        if self.kind == "continuation":
            if self.open is None or self.open["uri"] != fields["warc-segment-origin-id"] or self.open["chunk"] + 2 != int(fields["warc-segment-number"]):
                raise ValueError(f"a segment out of place: {fields['warc-record-id']}")
            self.open["chunk"] += 1
            self.state = "payload"
        else:
            self.open = {"uri": fields["warc-record-id"], "type": self.kind, "chunk": 0, "bytes": 0, "sha1": hashlib.sha1(), "digest": fields.get("warc-payload-digest", ""), "refers": fields.get("warc-refers-to"), "http": 0}
            self.state = "http"

    def piece(self, line: bytes):
        if not self.fresh:
            self.left -= 2
            self.block.update(b"\r\n")
            if self.state == "payload" and not self.opening:
                self.take(b"\r\n")
        self.fresh = self.opening = False
        self.left -= len(line)
        if self.left < 0:
            raise ValueError(f"a block longer than it says: {self.open['uri']}")
        self.block.update(line)
        if self.state == "payload":
            self.take(line)
        elif not line:
            self.state, self.opening = "payload", True
        elif line.lower().startswith(b"content-length:"):
            self.open["http"] = int(line.split(b":")[1])
        return self.end() if self.left == 0 else None

    def take(self, data: bytes):
        self.open["sha1"].update(data)
        self.open["bytes"] += len(data)
        self.chunk_bytes += len(data)

    def end(self):
        self.state, now, fields = "between", self.open, self.fields
        if fields.get("warc-block-digest", "").partition(":")[2] not in ("", base32(self.block.digest())):
            raise ValueError(f"a block that differs from its digest: {now['uri']}")
        revisit = now["type"] == "revisit"
        last = revisit or now["bytes"] == now["http"]
        digest = now["digest"].partition(":")[2] if revisit else base32(now["sha1"].digest())
        if last and digest != now["digest"].partition(":")[2]:
            raise ValueError(f"a payload that differs from its digest: {now['uri']}")
        return (_page(now["uri"]), now["chunk"], self.chunk_bytes, now["http"] if revisit else now["bytes"], digest, now["type"], _page(now["refers"]) if now["refers"] else None, last)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The chunked record table of the archives in folder: page_id, chunk, chunk_bytes, bytes_so_far,
    digest_so_far, record_type, refers_to, last. An archive is one task, whose memory is a line's."""
    small_batches(spark)

    def run(batches):
        reader = Reader()
        rows = (row for batch in batches for line in batch.column(0) if (row := reader.line(line.as_py())) is not None)
        yield from out_batches(rows, ROWS)

    lines = spark.read.schema("value string").option("lineSep", "\r\n").text(folder)
    return lines.select(F.col("value").cast("binary").alias("value")).mapInArrow(run, ROWS_SPARK)


def round_trip(pages: DataFrame, least_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Writes pages to archives in the shared folder and reads them back: page_id, payload_bytes,
    payload_digest, record_type, refers_to for every row of pages. No row gives no archive row."""
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, folder, least_bytes, chunk_bytes)
    return read_archives(spark, folder).filter("last").select(
        "page_id", F.col("bytes_so_far").alias("payload_bytes"), F.col("digest_so_far").alias("payload_digest"), "record_type", "refers_to")


# SQL without base32: the 40 hex digits of a SHA-1 are four numbers of 40 bits, eight digits of five bits each.
_B32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, {10 * k + 1}, 10) AS BIGINT) >> {35 - 5 * i}) & 31 AS INTEGER), 1)" for k in range(4) for i in range(8))
ORACLE = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h)
SELECT page_id, payload_bytes, {_B32} AS payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN f USING (h)
"""

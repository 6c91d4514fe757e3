"""WARC archives: a writer, and a reader that splits compressed archives by byte ranges.

The writer makes one archive per task, every record a gzip member of its own.  Of records with equal payloads
of ``REVISIT_BYTES`` or more, that with the smallest id is a response and others revisit it.

The reader lists archives with their lengths, cuts them into byte ranges and deals the ranges out.  A task
looks for the gzip magic in its range, takes a candidate for a member if its header decodes to a WARC record
and members follow it without a gap to the end of the range, and for ``LOOK_BYTES`` at least (or to the end of
the file).  It owns the records that start inside the range, and reads on past the end to finish the last one.
(A payload that is a gzip archive itself may show the magic, but the chain breaks where that payload ends.)

Defined results: a null html is an empty payload; rows that repeat id and html are records each, all responses
if the id is the smallest; a null id is written without a number, read back as null, and never the smallest if
another is there; an empty table writes no archive and reads back empty; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix.llm import common

REVISIT_BYTES = 100
#: Bytes of an archive that one task of the reader owns.
RANGE_BYTES = 32 << 20
#: How far members must follow a candidate without a gap.
LOOK_BYTES = 4 << 20
MAGIC = b"\x1f\x8b\x08"
_PIECE = 1 << 16
#: What a WARC header may take before it must end.
_HEADER_BYTES = 1 << 16

RECORDS = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
           "payload_digest string, payload binary")


def record(page_id, url: str, payload: bytes, digest: str, refers_to, number: str) -> bytes:
    """A response or, with ``refers_to``, a revisit record, uncompressed."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http + payload if refers_to is None else http
    uri = url.replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, number)}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {uri}",
            f"WARC-Payload-Digest: sha256:{digest}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"X-Refers-To-Page: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def _store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return pyarrow.fs.FileSystem.from_uri(path)


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """An archive named by the partition.  Attempts write apart and rename, so a repeated task leaves one."""
    task = TaskContext.get()
    fs, at = _store(folder)
    name = f"{at}/part-{task.partitionId():05d}.warc.gz"
    draft, n, size, out = f"{at}/_draft-{task.partitionId()}-{task.taskAttemptId()}", 0, 0, None
    for batch in batches:
        for row in batch.to_pylist():
            out = out or fs.open_output_stream(draft)
            data = (row["html"] or "").encode("utf-8")
            packed = member(record(row["page_id"], row["url"] or "", data, row["digest"], row["refers_to"],
                                   f"{task.partitionId()}/{n}"))
            out.write(packed)
            n, size = n + 1, size + len(packed)
    if out is not None:
        out.close()
        fs.move(draft, name)
        yield pa.RecordBatch.from_pydict({"path": [name], "records": [n], "bytes": [size]})


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write every page as a record; (path, records, bytes) of the archives."""
    html = F.coalesce(F.col("html"), F.lit(""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
                         F.sha2(html, 256).alias("digest"))
    first = (pages.filter(F.octet_length("html") >= REVISIT_BYTES).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1"))
    # one row for each record that revisits, whatever the number of copies
    revisits = common.materialize(
        pages.filter(F.octet_length("html") >= REVISIT_BYTES).select("page_id", "digest")
        .join(first, "digest").filter("first is not null and not page_id <=> first")
        .select("page_id", "digest", F.col("first").alias("refers_to")).distinct(), "revisits")
    same = [pages["page_id"].eqNullSafe(revisits["page_id"]), pages["digest"] == revisits["digest"]]
    typed = pages.join(revisits, same[0] & same[1], "left").select(
        pages["page_id"], "url", "html", pages["digest"], "refers_to")
    fs, at = _store(folder)
    fs.create_dir(at, recursive=True)
    written = typed.mapInArrow(lambda b: _write(b, folder), "path string, records long, bytes long")
    return common.materialize(written, "archives")


class _Range:
    """Members of a gzip file that start in a range of its bytes."""

    def __init__(self, file, start: int, end: int, length: int):
        self.file, self.start, self.end, self.length = file, start, end, length

    def read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(min(n, self.length - at)) if at < self.length else b""

    def magics(self) -> Iterator[int]:
        at = self.start
        while at < self.end:
            piece = self.read(at, min(_PIECE, self.end - at) + len(MAGIC) - 1)
            found = piece.find(MAGIC)
            while found >= 0:
                yield at + found
                found = piece.find(MAGIC, found + 1)
            at += _PIECE

    def pieces(self, at: int, most: int | None = None) -> Iterator[tuple[bytes, int]]:
        """Decoded pieces of the member at ``at``, each with the member's end (0 before the last).

        Raises zlib.error where the bytes are no gzip member, EOFError where they end inside it.
        """
        d, done = zlib.decompressobj(31), 0
        while not d.eof:
            data = self.read(at, _PIECE)
            if not data:
                raise EOFError
            at += len(data)
            out = d.decompress(data)
            done += len(out)
            yield out, at - len(d.unused_data) if d.eof else 0
            if most is not None and done >= most:
                return

    def follows(self, at: int) -> int:
        """The end of the member at ``at`` if it is a whole WARC record, else -1."""
        try:
            end = 0
            for n, (piece, end) in enumerate(self.pieces(at)):
                if n == 0 and not piece.startswith(b"WARC/"):
                    return -1
            return end
        except (zlib.error, EOFError):
            return -1

    def chained(self, at: int) -> bool:
        """Members lead from ``at`` to the range's end, and for LOOK_BYTES, without a gap."""
        until = min(max(self.end, at + LOOK_BYTES), self.length)
        while at < until:
            if (at := self.follows(at)) < 0:
                return False
        return True

    def records(self) -> Iterator[bytes]:
        at = next((m for m in self.magics() if self.chained(m)), self.end)
        while at < self.end:
            parts, end = [], 0
            for piece, end in self.pieces(at):
                parts.append(piece)
            yield b"".join(parts)
            at = end


def parse(data: bytes) -> dict:
    """The columns of ``RECORDS`` from a record's bytes."""
    head, _, block = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = block[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    inner = {k.lower(): v for k, _, v in (x.partition(": ") for x in http.decode("latin-1").split("\r\n")[1:])}
    kind, size = fields["warc-type"], int(inner["content-length"])
    stated = fields["warc-payload-digest"].partition(":")[2]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != stated):
        raise ValueError(f"{fields['warc-record-id']}: payload doesn't fit its digest")
    page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page")
    return {"page_id": page and int(page), "url": fields["warc-target-uri"], "record_type": kind,
            "refers_to": refers and int(refers), "payload_bytes": size, "payload_digest": stated,
            "payload": payload if kind == "response" else None}


_RECORD_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                           ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                           ("payload_digest", pa.string()), ("payload", pa.binary())])
#: Bytes of payloads that leave the reader at once.
_YIELD_BYTES = 4 << 20


def _read(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            fs, at = _store(r["path"])
            with fs.open_input_file(at) as file:
                rows, held = [], 0
                for data in _Range(file, r["start"], r["end"], r["length"]).records():
                    row = parse(data)
                    if not payloads:
                        row["payload"] = None
                    rows.append(row)
                    held += 500 + len(row["payload"] or b"")
                    if held >= _YIELD_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, _RECORD_ARROW)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _RECORD_ARROW)


def ranges(spark: SparkSession, folder: str, size: int = RANGE_BYTES) -> DataFrame:
    """(path, start, end, length): byte ranges of all archives in a folder.  Spark lists them; nothing is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", "length")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(size).cast("long"))
    return (files.select("path", "length", F.explode(starts).alias("start"))
            .withColumn("end", F.least(F.col("start") + size, F.col("length")))
            .select("path", "start", "end", "length"))


def read_archives(spark: SparkSession, folder: str, size: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """The records of all archives in a folder (``RECORDS``); payload is null for revisits."""
    dealt = ranges(spark, folder, size).repartition(common.partitions(spark))
    return dealt.mapInArrow(lambda b: _read(b, payloads), RECORDS)


def round_trip(pages: DataFrame, folder: str, size: int = RANGE_BYTES) -> DataFrame:
    spark = pages.sparkSession
    if not write_archives(pages, folder).limit(1).count():
        return spark.createDataFrame([], RECORDS)
    return read_archives(spark, folder, size, payloads=False)


def digest(records: DataFrame) -> DataFrame:
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
with payloads as (
    select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest
    from pages),
firsts as (select *, min(page_id) over (partition by payload_digest) as first from payloads)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
       case when payload_bytes >= {REVISIT_BYTES} and page_id is distinct from first then 'revisit' else 'response' end
           as record_type,
       case when payload_bytes >= {REVISIT_BYTES} and page_id is distinct from first then first end as refers_to
from firsts
"""

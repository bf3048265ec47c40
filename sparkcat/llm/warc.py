"""WARC archives: write, read, and resolve revisits by payload digest into deduplicated archives with fresh headers.

An archive is a folder of gzip files of WARC/1.1 records. read() takes any such files, of one gzip member or of one for
each record, written here or elsewhere (WARC/1.0 too; plain files if asked): Spark's text source streams a file in pieces between blank lines,
and records are put together again by Content-Length alone, so payloads may hold anything, also what looks like a record.
A file that ends inside a record, a length that cuts a record elsewhere than at its end, or a payload that its digest
does not fit, is an error.

deduplicated() resolves revisits in four steps. Headers of all records are read and stored; they shuffle by payload
digest, where a maximum per digest (partial aggregation: a hot digest costs one row per task) picks the response that
stays; headers join it, and records that it makes revisits, or that came as revisits, refer to it; the archive is read
again, each record meets its decision by record id, and a new archive is written: fresh record ids, lengths, digests and
references, capture dates kept. Revisits whose response is in no archive read stay as they came.

Which response stays is decided by an order `by`: a record is a revisit if a response with its digest has a greater `by`.
For pages that is the page_id. Payloads smaller than a bound are all responses.

Null payloads are empty. Rows with a null id have no order: they stay responses. Rows that repeat an id and a payload are
both responses, each a record of its own; those that repeat an id with another payload are judged by their own digest.
Very long payloads pass whole, a record in memory at a time. Extra columns are ignored, whatever their names. An empty
table gives an archive without records and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import delete_path, forget, stored, table_path

END = b"\r\n\r\n"
#: Records are written in pieces of about CHUNK bytes (or one longer record), PER_FILE of them to a file.
CHUNK, PER_FILE, ROWS = 4_000_000, 16, 500
#: gzip's third level: half the time of the usual sixth, for a twentieth more room.
LEVEL = "THREE"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fields that a rewritten record gets afresh; all others are carried over.
FRESH = {"warc-type", "warc-record-id", "warc-target-uri", "warc-date", "warc-payload-digest", "warc-block-digest", "content-type", "content-length", "x-page-id",
         "warc-refers-to", "warc-refers-to-target-uri", "warc-refers-to-date", "warc-profile", "warc-warcinfo-id", "warc-truncated", "warc-segment-number"}
HEADERS = "record_id string, record_type string, uri string, date string, payload_digest string, payload_bytes long, page_id long, refers_to_id string"
RECORDS = HEADERS + ", content_type string, fields string, http binary, payload binary"
_TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _arrow(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    cols = list(zip(*rows, strict=True)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(cols, fields, strict=True)], names=[n for n, _ in fields])


def _pieces(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[tuple[str, bytes]]:
    """What lies between blank lines, of rows that are such pieces or whole files."""
    for batch in batches:
        for file, value in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist(), strict=True):
            if whole:
                pieces = value.split(END)
                yield from ((file, x) for x in (pieces[:-1] if value.endswith(END) else pieces))
            else:
                yield file, value


def records_of(pieces: Iterator[tuple[str, bytes]]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and block of each record, from what lies between the blank lines of files, in order."""
    file, fields, parts, have, need = None, None, [], 0, 0
    for name, piece in pieces:
        if name != file:
            if fields is not None:
                raise ValueError(f"{file} ends inside a WARC record")
            file = name
        if fields is not None:
            parts.append(piece)
            have += len(piece)
            if have < need:
                have += len(END)
                continue
            data = parts[0] if len(parts) == 1 else END.join(parts)
            yield fields, data[:need]
            fields = None
            # A block that ends in a line break makes the reader split two bytes before the record's end.
            piece = data[need:]
            if piece and not piece.startswith(END):
                raise ValueError(f"a WARC record in {file} is longer than its Content-Length")
        if not (piece := piece.lstrip(b"\r\n")):
            continue
        first, _, rest = piece.partition(b"\r\n")
        if not first.startswith(b"WARC/1."):
            raise ValueError(f"no WARC record starts at {piece[:40]!r} in {file}")
        rest = re.sub(r"\r\n[ \t]+", " ", rest.decode("utf-8", "replace"))  # folded lines
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in rest.split("\r\n"))}
        parts, have, need = [], 0, int(fields["content-length"])
    if fields is not None:
        raise ValueError(f"{file} ends inside a WARC record")


def _parsed(payloads: bool, verify: bool, whole: bool = False):
    schema = RECORDS if payloads else HEADERS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for f, block in records_of(_pieces(batches, whole)):
            kind, content = f.get("warc-type", ""), f.get("content-type", "")
            if kind == "warcinfo":
                continue
            http, payload = None, block
            if kind in ("response", "revisit") and content.startswith("application/http") and (END in block or kind == "revisit"):
                http, _, payload = block.partition(END)
            digest = f.get("warc-payload-digest", "").removeprefix("sha1:").upper() or None
            n = len(payload)
            if kind == "revisit":
                found = re.search(rb"(?im)^content-length:\s*(\d+)", http or b"")
                payload, n = None, int(found.group(1)) if found else None
            elif verify or digest is None:
                computed = base32_sha1(payload)
                if digest and len(digest) == 32 and digest != computed and "warc-truncated" not in f and kind in ("response", "resource"):
                    raise ValueError(f"the payload of {f['warc-record-id']} does not fit its digest")
                digest = computed
            row = (f["warc-record-id"], kind, f.get("warc-target-uri", ""), f.get("warc-date", ""), digest, n, int(f["x-page-id"]) if "x-page-id" in f else None, f.get("warc-refers-to"))
            if payloads:
                row += (content, "".join(f"\r\n{k}: {v}" for k, v in f.items() if k not in FRESH), http, payload)
                size += len(block)
            rows.append(row)
            if len(rows) >= ROWS or size > CHUNK:
                yield _arrow(rows, schema)
                rows, size = [], 0
        yield _arrow(rows, schema)

    return run


def read(spark: SparkSession, path: str, payloads: bool = True, verify: bool = True, compressed: bool = True) -> DataFrame:
    """The records of archives (RECORDS, or HEADERS without payloads); payload is null for revisits.

    gzip files (*.gz) are never split, so a task has whole files and sees their pieces in order. Plain ones (*.warc), which
    Spark would split, are read as whole files, of up to 2 GB.
    """
    if compressed:
        lines = spark.read.option("lineSep", "\r\n\r\n").option("pathGlobFilter", "*.gz").text(path)
        lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))
    else:
        lines = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc").load(path).select(F.col("path").alias("file"), F.col("content").alias("value"))
    return lines.mapInArrow(_parsed(payloads, verify, not compressed), RECORDS if payloads else HEADERS)


def _record(kind: str, rid: str, uri: str, date: str, digest: str | None, page: int | None, content: str, http: bytes | None, payload: bytes, more: str = "") -> bytes:
    """A record without the blank lines after it."""
    size = len(payload) + (len(http) + len(END) if http is not None else 0)
    lines = [f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {rid}"]
    if uri:
        lines.append(f"WARC-Target-URI: {uri}")
    lines.append(f"WARC-Date: {date}")
    if digest:
        lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if page is not None:
        lines.append(f"X-Page-ID: {page}")
    head = "\r\n".join(lines) + more + (f"\r\nContent-Type: {content}" if content else "") + f"\r\nContent-Length: {size}"
    return END.join([head.encode("utf-8", "surrogatepass"), *([http] if http is not None else []), payload])


def _chunks(found: Iterator[bytes], mark: str) -> Iterator[pa.RecordBatch]:
    """Records joined to pieces of bounded size, each after a warcinfo record of its own."""
    info = b"software: sparkcat\r\nformat: WARC File Format 1.1"

    def batch(held: list[bytes], k: int) -> pa.RecordBatch:
        rid = f"<urn:uuid:{uuid.uuid5(uuid.UUID(mark), f'{TaskContext.get().partitionId()}/info/{k}')}>"
        data = END.join([_record("warcinfo", rid, "", _now(), None, None, "application/warc-fields", None, info), *held])
        # Bytes as they are: payloads need not be text.
        return pa.RecordBatch.from_arrays([pa.StringArray.from_buffers(1, pa.py_buffer(len(data).to_bytes(4, "little").rjust(8, b"\0")), pa.py_buffer(data))], names=["value"])

    held, size, k = [], 0, 0
    for r in found:
        held.append(r)
        size += len(r)
        if size >= CHUNK:
            yield batch(held, k)
            held, size, k = [], 0, k + 1
    if held:
        yield batch(held, k)


def _now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def _saved(chunks: DataFrame, path: str) -> None:
    chunks.write.option("lineSep", END.decode()).option("compression", "gzip").option("zlib.compress.level", LEVEL).option("maxRecordsPerFile", PER_FILE).text(path)


def write_pages(pages: DataFrame, path: str, key: str = "page_id", uri: str = "url", payload: str = "html") -> None:
    """An archive with a response record for each row."""
    mark = str(uuid.uuid4())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[bytes]:
            part, k, now = TaskContext.get().partitionId(), 0, _now()
            for b in batches:
                for page, url, data in zip(b.column("id").to_pylist(), b.column("uri").to_pylist(), b.column("data").to_pylist(), strict=True):
                    rid = f"<urn:uuid:{uuid.uuid5(uuid.UUID(mark), f'{part}/{k}')}>"
                    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(data)}".encode()
                    yield _record("response", rid, re.sub(r"\s+", " ", url), now, base32_sha1(data), page, "application/http;msgtype=response", http, data)
                    k += 1

        return _chunks(found(), mark)

    rows = pages.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(uri), F.lit("")).alias("uri"), F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("data"))
    _saved(rows.mapInArrow(run, "value string"), path)


def by_page() -> Column:
    return F.col("page_id")


def by_date() -> Column:
    """The earliest capture stays; of equal dates the smallest record id."""
    return F.struct((-F.unix_micros(F.try_to_timestamp("date"))).alias("at"), F.col("record_id"))


def resolve(headers: DataFrame, by: Column, least_bytes: int = 0) -> DataFrame:
    """record_id of each record that is a revisit, with its original's record_id, uri and date as to_id, to_uri, to_date."""
    h = headers.withColumn("_by", by)
    big = F.coalesce(F.col("payload_bytes"), F.lit(0)) >= least_bytes
    whole = h.where(F.col("record_type").isin("response", "resource") & F.col("_by").isNotNull() & big)
    best = whole.groupBy("payload_digest").agg(F.max(F.struct("_by", "record_id", "uri", "date")).alias("to"))
    again = F.when(F.col("record_type") == "revisit", F.lit(True)).otherwise(F.col("record_type").isin("response", "resource") & big & (F.col("_by") < F.col("to._by")))
    return h.join(best, "payload_digest").where(again).select("record_id", *[F.col(f"to.{a}").alias(b) for a, b in (("record_id", "to_id"), ("uri", "to_uri"), ("date", "to_date"))])


def deduplicated(spark: SparkSession, source: str, path: str, by: Column | None = None, least_bytes: int = 0, compressed: bool = True) -> None:
    """Read archives and write them anew: one response for each payload digest, the others as revisits of it."""
    headers = stored(read(spark, source, payloads=False, compressed=compressed), "warc-source")
    found = stored(resolve(headers, by_date() if by is None else by, least_bytes), "warc-revisits")
    mark = uuid.uuid4()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh = lambda old: f"<urn:uuid:{uuid.uuid5(mark, old)}>"

        def rewritten() -> Iterator[bytes]:
            for b in batches:
                for r in b.to_pylist():
                    kind, more = r["record_type"], re.sub(r"(?m)^(warc-concurrent-to: )(\S+)", lambda m: m[1] + fresh(m[2]), r["fields"])
                    content, http, payload = r["content_type"], r["http"], r["payload"] or b""
                    if r["to_id"] is not None:
                        more += f"\r\nWARC-Refers-To: {fresh(r['to_id'])}\r\nWARC-Refers-To-Target-URI: {r['to_uri']}\r\nWARC-Refers-To-Date: {r['to_date']}\r\nWARC-Profile: {PROFILE}"
                        if http is None and r["payload_bytes"] is not None:  # the length of what is left out must not be lost
                            http, content = f"HTTP/1.1 200 OK\r\nContent-Type: {content}\r\nContent-Length: {r['payload_bytes']}".encode(), "application/http;msgtype=response"
                        kind, payload = "revisit", b""
                    elif kind == "revisit":
                        more += f"\r\nWARC-Refers-To: {r['refers_to_id']}\r\nWARC-Profile: {PROFILE}" if r["refers_to_id"] else f"\r\nWARC-Profile: {PROFILE}"
                    yield _record(kind, fresh(r["record_id"]), r["uri"], r["date"], r["payload_digest"], r["page_id"], content, http, payload, more)

        return _chunks(rewritten(), str(mark))

    typed = read(spark, source, verify=False, compressed=compressed).join(found, "record_id", "left")
    _saved(typed.mapInArrow(run, "value string"), path)
    forget(spark, headers, found)


def report(spark: SparkSession, path: str) -> DataFrame:
    """The responses and revisits of a deduplicated archive of pages, revisits joined to the responses they name; digests
    are those of payloads read. A revisit without such a response, or with another digest, is an error."""
    seen = stored(read(spark, path, payloads=False).where("record_type in ('response', 'revisit')"), "warc-headers")
    original = seen.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("payload_digest").alias("_digest"), F.col("page_id").alias("refers_to"))
    joined = seen.join(original, "refers_to_id", "left")
    wrong = (F.col("record_type") == "revisit") & ~F.coalesce(F.col("_digest") == F.col("payload_digest"), F.lit(False))
    kind = F.when(wrong, F.raise_error(F.lit("a revisit names no response with its digest"))).otherwise(F.col("record_type"))
    return joined.select("page_id", "payload_bytes", "payload_digest", kind.alias("record_type"), "refers_to")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write an archive of pages to the shared folder, resolve it into a deduplicated one, and report on what that holds."""
    spark = pages.sparkSession
    source, path = table_path(spark, "warc-pages"), table_path(spark, "warc-deduplicated")
    write_pages(pages, source)
    deduplicated(spark, source, path, by_page())
    delete_path(spark, source)
    out = report(spark, path)
    delete_path(spark, path)  # report() has stored the headers
    return out

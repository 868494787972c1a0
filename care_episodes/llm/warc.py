"""WARC archives as chunked record tables: written from pages, deduplicated by payload, read back.

A payload is never handled as one value on its way: it is a run of rows (record, chunk number, bytes), each with the digest and the
size of the payload up to there.  Only the last chunk's digest decides what is a copy.

**Writing.**  `chunk_table` cuts payloads into chunks of at most `CHUNK_BYTES` (at character borders), sharing the input's
buffers.  `record_roles` finds copies from the last chunks alone: of equal payloads the record of largest page_id is the response, others
revisit it.  `write_archives` deals chunks out by record, sorts them, and lets Spark's text writer write them line by line into gzip files
(any file system Spark reaches).  A payload travels as an HTTP body in chunked transfer coding, so that a chunk is a row there too
and a row ends in the CR LF that the coding wants.  Revisits hold the HTTP header only and are thus slim.

**Reading.**  `read_archives` reads lines up to CR LF (gzip files aren't split, so a file's lines come in order), and a small
state machine follows records, headers and chunks.  It holds a line at a time, whose length the chunk size bounds for archives
written here; digests are kept up as chunks pass.  Chunked and plain HTTP bodies are understood.  A payload whose digest or size is not the
one its header names raises an error, as does a file that doesn't start with a record.

Skew: copies are found by a grouped maximum that combines on the map side, and meet their group's row again in a join that adaptive
execution may split.  A record's chunks stay in one task, one after the other, in bounded memory.

Defined results: null html is an empty payload; empty payloads are copies of each other.  A null page_id counts as the smallest; a revisit
of such a record has refers_to null.  Rows of one page_id are records of their own; of equal largest page_ids one is the response.  Control
characters and spaces of a url are percent-encoded in the header; a null url has no header.  Extra columns are not read.  An empty table gives no
rows and no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import unquote_plus

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from care_episodes.llm.buffers import utf8
from care_episodes.session import shared_folder

#: Most bytes of a payload in one row.
CHUNK_BYTES = 1 << 16
#: Most bytes and rows of an output batch.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 4096

#: Capture time written to every record.
DATE = "2000-01-01T00:00:00Z"
#: Fixed value: the profile of revisits found by payload digest.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_CHUNKED = _HTTP + "Transfer-Encoding: chunked\r\n\r\n"
_BARE = _HTTP + "\r\n"
_CRLF = "\r\n"


def bare_digest(sha1) -> str:
    return base64.b32encode(sha1.digest()).decode()


# ---- writing --------------------------------------------------------------------------------
def chunk_ends(data: np.ndarray, start: int, end: int) -> list[int]:
    """Ends of the chunks of data[start:end]: as long as allowed, not inside a character; an empty payload has one empty chunk."""
    ends = []
    while end - start > CHUNK_BYTES:
        cut = start + CHUNK_BYTES
        while cut > start + 1 and data[cut] & 0xC0 == 0x80:
            cut -= 1
        ends.append(cut)
        start = cut
    return [*ends, end]


def framed(size: int) -> int:
    """Bytes of a chunk in chunked transfer coding."""
    return size + len(f"{size:X}") + 4 if size else 0


def chunk_table(pages: DataFrame) -> DataFrame:
    """(record, page_id, url, chunk, last, data, n_bytes, n_framed, digest); sums and digest are of the payload so far."""
    page_id = pages.schema["page_id"].dataType.simpleString()
    ddl = f"record long, page_id {page_id}, url string, chunk int, last boolean, data string, n_bytes long, n_framed long, digest string"
    schema = to_arrow_schema(StructType.fromDDL(ddl), prefers_large_types=False)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record = TaskContext.get().partitionId() << 40
        for batch in batches:
            data, offsets = utf8(batch.column("html"))
            view = memoryview(data)
            rows, starts = [], []

            def out(end: int, data=data, batch=batch):
                of = pa.array([r[0] for r in rows], pa.int64())
                first = pa.array([r[0] if r[2] == 0 else None for r in rows], pa.int64())
                at = np.array([*starts, end], np.int64)
                text = pa.StringArray.from_buffers(len(rows), pa.py_buffer((at - at[0]).astype(np.int32)), pa.py_buffer(data[at[0] : end]))
                columns = dict(zip(("record", "chunk", "last", "n_bytes", "n_framed", "digest"), list(zip(*rows, strict=True))[1:], strict=True))
                columns |= {"page_id": batch.column("page_id").take(of), "url": batch.column("url").take(first), "data": text}
                return pa.RecordBatch.from_arrays([c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in schema], schema=schema)

            for i in range(batch.num_rows):
                at, end = int(offsets[i]), int(offsets[i + 1])
                sha1, total, length = hashlib.sha1(), 0, 0
                for number, cut in enumerate(chunk_ends(data, at, end)):
                    if rows and (len(rows) == BATCH_ROWS or cut - starts[0] > BATCH_BYTES):
                        yield out(at)
                        rows.clear()
                        starts.clear()
                    sha1.update(view[at:cut])
                    total, length = total + cut - at, length + framed(cut - at)
                    rows.append((i, record, number, cut == end, total, length, bare_digest(sha1)))
                    starts.append(at)
                    at = cut
                record += 1
            if rows:
                yield out(at)

    return pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(chunks, ddl)


def record_roles(chunks: DataFrame, least_bytes: int = 0) -> DataFrame:
    """One row per record: its sums and digest, and for revisits the page_id and record of the response."""
    last = chunks.where("last").select("record", "page_id", "n_bytes", "n_framed", "digest")
    top = F.max(F.struct(F.col("page_id"), (-F.col("record")).alias("negative"))).alias("top")
    copies = last.where(F.col("n_bytes") >= least_bytes).groupBy("digest", "n_bytes").agg(top, F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = last.join(copies.drop("n"), ["digest", "n_bytes"], "left")
    revisit = F.coalesce(F.col("top.negative") != -F.col("record"), F.lit(False))
    return joined.select(
        "record", "n_bytes", "n_framed", "digest", revisit.alias("revisit"),
        F.when(revisit, F.col("top.page_id")).alias("response_page_id"), F.when(revisit, -F.col("top.negative")).alias("response"),
    )


def _urn(page_id: Column, record: Column) -> Column:
    """Name of a record; the id is percent-encoded, which leaves ~ for a null one."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.url_encode(page_id.cast("string")), F.lit("~")), F.lit(":"), record.cast("string"), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF)), F.lit(""))


def _safe_url(url: Column) -> Column:
    """The url with control characters and spaces percent-encoded, so that it stays on its line."""
    for code in (*range(0x21), 0x7F):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return url


def archive_lines(chunks: DataFrame, roles: DataFrame, date: str = DATE) -> DataFrame:
    """The archives' rows in order, as (record, chunk, value); each is followed by CR LF."""
    both = chunks.select("record", "page_id", "url", "chunk", "last", "data").repartition("record").join(roles, "record")
    both = both.where(~F.col("revisit") | (F.col("chunk") == 0))
    revisit = F.col("revisit")
    block = F.when(revisit, F.lit(len(_BARE))).otherwise(F.lit(len(_CHUNKED) + len("0\r\n\r\n")) + F.col("n_framed"))
    opening = F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _header("WARC-Record-ID", _urn(F.col("page_id"), F.col("record"))),
        _header("WARC-Date", F.lit(date)),
        F.when(F.col("url").isNull(), F.lit("")).otherwise(_header("WARC-Target-URI", _safe_url(F.col("url")))),
        F.when(revisit, _header("WARC-Refers-To", _urn(F.col("response_page_id"), F.col("response")))).otherwise(F.lit("")),
        F.when(revisit, _header("WARC-Profile", F.lit(PROFILE))).otherwise(F.lit("")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("X-Payload-Length", F.col("n_bytes").cast("string")),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", block.cast("string")),
        F.lit(_CRLF),
        F.when(revisit, F.lit(_BARE)).otherwise(F.lit(_CHUNKED)),
    )
    size = F.octet_length("data")
    body = F.when(revisit | (size == 0), F.lit("")).otherwise(F.concat(F.hex(size), F.lit(_CRLF), F.col("data")))
    middle = F.concat(F.when(F.col("chunk") == 0, opening).otherwise(F.lit("")), body)
    # The writer ends each row with CR LF: after a chunk that is the coding's, after the last row the record's second one.
    ending = (
        F.when(revisit, F.lit(_CRLF))
        .when(F.col("last"), F.concat(F.when(size == 0, F.lit("")).otherwise(F.lit(_CRLF)), F.lit("0\r\n\r\n\r\n")))
        .otherwise(F.lit(""))
    )
    return both.select("record", "chunk", F.concat(middle, ending).alias("value"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, date: str = DATE) -> None:
    """Writes a record per page into gzip archives in the folder `path`; payloads below `least_bytes` are never revisited."""
    spark = pages.sparkSession
    table = f"{shared_folder(spark)}/chunks-{uuid.uuid4().hex}"
    chunk_table(pages).write.option("compression", "zstd").parquet(table)
    chunks = spark.read.parquet(table)
    lines = archive_lines(chunks, record_roles(chunks, least_bytes), date)
    lines.sortWithinPartitions("record", "chunk").select("value").write.option("lineSep", _CRLF).option("compression", "gzip").text(path)


# ---- reading --------------------------------------------------------------------------------
class RecordParser:
    """Follows the lines of one archive; each line is what stands before a CR LF.

    `feed` returns what a line completes: nothing, or (number, data, last) of a chunk of the record in `self.headers`.
    """

    def __init__(self, keep_data: bool):
        self.state, self.keep_data, self.need = "between", keep_data, None

    def feed(self, line: memoryview) -> tuple[int, bytes, bool] | None:
        return getattr(self, "_" + self.state)(line)

    def _between(self, line):
        if not len(line):
            return None
        if bytes(line[:5]) != b"WARC/":
            raise ValueError(f"not the start of a record: {bytes(line[:40])!r}")
        self.headers: dict[str, str] = {}
        self.state = "fields"
        return None

    def _fields(self, line):
        if len(line):
            name, _, value = bytes(line).decode().partition(":")
            self.headers[name.lower()] = value.strip(" \t")
            return None
        self.sha1, self.total, self.number, self.pieces, self.chunked, self.need = hashlib.sha1(), 0, 0, [], False, None
        self.left = int(self.headers.get("content-length", 0))
        http = self.headers.get("content-type", "").startswith("application/http")
        if not self.left:
            self.state = "between"
            return self._done()
        self.state = "http" if http else "body"
        return None

    def _http(self, line):
        self.left -= len(line) + 2
        if len(line):
            self.chunked |= bytes(line).lower().replace(b" ", b"") == b"transfer-encoding:chunked"
            return None
        if self.left == 0:
            self.state = "between"
            return self._done()
        self.state = "size" if self.chunked else "body"
        return None

    def _size(self, line):
        self.need = int(bytes(line).split(b";")[0], 16)
        self.state = "data" if self.need else "trailer"
        return None

    def _trailer(self, line):
        if len(line):
            return None
        self.state = "between"
        return self._done()

    def _data(self, line):
        if self._take(line):
            self.state = "size"
            return self._chunk()
        return None

    def _body(self, line):
        self.need = self.left if self.need is None else self.need
        if self._take(line):
            self.need, self.state = None, "between"
            return self._done(self._joined())
        return None

    def _take(self, line) -> bool:
        """Takes a line into the payload; a CR LF inside the payload belongs to it too.  True at the payload piece's end."""
        if len(line) > self.need or self.need - len(line) == 1:
            raise ValueError("a chunk ends elsewhere than its size says")
        self._add(line)
        if self.need == 0:
            return True
        self._add(b"\r\n")
        return False

    def _add(self, data) -> None:
        self.sha1.update(data)
        self.total += len(data)
        self.need -= len(data)
        if self.keep_data:
            self.pieces.append(bytes(data))

    def _joined(self) -> bytes:
        data, self.pieces = b"".join(self.pieces), []
        return data

    def _chunk(self):
        self.number += 1
        return self.number - 1, self._joined(), False

    def _done(self, data: bytes = b""):
        return self.number, data, True


_ID = re.compile(r"<urn:page:([^:>]*):([0-9]+)>")


def page_of(urn: str | None) -> str | None:
    """page_id, as text, of a record named by `write_archives`; None for other names and null ids."""
    found = _ID.fullmatch(urn or "")
    return unquote_plus(found[1]) if found and found[1] != "~" else None


def read_archives(spark: SparkSession, path: str, keep_data: bool = True) -> DataFrame:
    """(record_id, page_id, url, record_type, refers_to, chunk, last, data, n_bytes, digest) of the archives in `path`.

    With `keep_data` a row per chunk and one without data that ends the record; without it the latter only.  Sizes and digests are
    of the payload so far; those of a revisit are the ones its header names.
    """
    ddl = "record_id string, page_id string, url string, record_type string, refers_to string, chunk int, last boolean, data binary, n_bytes long, digest string"
    schema = to_arrow_schema(StructType.fromDDL(ddl), prefers_large_types=False)

    def row(parser: RecordParser, number: int, data: bytes, last: bool) -> tuple:
        head = parser.headers
        digest, size, kind = bare_digest(parser.sha1), parser.total, head.get("warc-type", "")
        named = head.get("warc-payload-digest", "").removeprefix("sha1:")
        if kind == "revisit":
            digest, size = named, int(head.get("x-payload-length", 0))
        elif last and named and (named != digest or int(head.get("x-payload-length", size)) != size):
            raise ValueError(f"payload of {head.get('warc-record-id')} is not the one its header names")
        return (
            head.get("warc-record-id"), page_of(head.get("warc-record-id")), head.get("warc-target-uri"), kind, page_of(head.get("warc-refers-to")),
            number, last, data, size, digest,
        )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, file, rows, size = None, None, [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            data, offsets = utf8(batch.column("value"))
            view, files = memoryview(data), batch.column("file").dictionary_encode()
            names, offsets = files.dictionary.to_pylist(), offsets.tolist()
            for i, which in enumerate(files.indices.to_pylist()):
                if names[which] != file:
                    if parser is not None and parser.state != "between":
                        raise ValueError(f"{file} ends inside a record")
                    parser, file = RecordParser(keep_data), names[which]
                found = parser.feed(view[offsets[i] : offsets[i + 1]])
                if found and (keep_data or found[2]):
                    rows.append(row(parser, *found))
                    size += len(found[1])
                    if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield out()
                        rows, size = [], 0
        if parser is not None and parser.state != "between":
            raise ValueError(f"{file} ends inside a record")
        if rows:
            yield out()

    lines = spark.read.option("lineSep", _CRLF).text(path).select("value", F.col("_metadata.file_path").alias("file"))
    return lines.mapInArrow(records, ddl)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes the pages into archives in the shared folder and reads them back: a row per record."""
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/archives-{uuid.uuid4().hex}"
    write_archives(pages, path, least_bytes)
    kind = pages.schema["page_id"].dataType
    return read_archives(spark, path, keep_data=False).select(
        F.col("page_id").cast(kind).alias("page_id"), F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


#: Base32 of a SHA-1 in hex: 40 bits at a time, 5 bits a letter.
ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
hashed AS (SELECT page_id, html, sha1(html) AS hex FROM p),
digested AS (
  SELECT page_id, html, list_reduce(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 1 + 10 * (k // 8)::INT, 10))::BIGINT >> (35 - 5 * (k % 8))::INT) & 31)::INT, 1)), lambda a, b: a || b) AS digest
  FROM hashed),
copies AS (SELECT html AS of_html, max(page_id) AS top FROM digested GROUP BY html)
SELECT page_id, octet_length(encode(html)) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM digested JOIN copies ON html = of_html
"""

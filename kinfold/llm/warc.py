"""WARC archives: one gzip member per record, written and read by the partition (operator 9)."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fsio import Published, chunks
from .shared import scratch, written

VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The archives hold no clock time, so that equal pages make equal files.
DATE = "2000-01-01T00:00:00Z"
HEAD_LIMIT = 1 << 20


class BadRecord(ValueError):
    pass


def digest_of(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_urn(key) -> str:
    return f"<urn:x-page:{'null' if key is None else key}>"


def _safe(value: str) -> str:
    """A header value without line ends and other control characters."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _gzipped(data: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def page_record(key, url, payload: bytes, refers_to=None, level: int = 6) -> bytes:
    """One gzip member: a response, or a revisit of the record of ``refers_to``.

    The block is an HTTP message. A revisit keeps the message's header, whose
    Content-Length is that of the payload it leaves out, and the payload's digest.
    """
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    again = refers_to is not None
    block = http if again else http + payload
    lines = [("WARC-Type", "revisit" if again else "response"), ("WARC-Record-ID", record_urn(key)), ("WARC-Date", DATE)]
    if url is not None:
        lines.append(("WARC-Target-URI", _safe(url)))
    if again:
        lines += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_urn(refers_to))]
    lines += [("WARC-Payload-Digest", "sha1:" + digest_of(payload)), ("WARC-Block-Digest", "sha1:" + digest_of(block)), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n"
    return _gzipped(head + block + b"\r\n\r\n", level)


@dataclass
class Record:
    headers: dict[str, str]
    http_length: int | None
    payload_bytes: int
    payload_digest: str
    block_ok: bool
    payload_ok: bool
    payload: bytes | None


class _Member:
    """Frames one record from decompressed pieces; holds its header and no more of it than is asked for."""

    def __init__(self, keep: bool):
        self.head, self.headers, self.left, self.keep = b"", None, 0, keep
        self.block, self.body, self.http, self.in_body = hashlib.sha1(), hashlib.sha1(), b"", False
        self.n_body, self.kept, self.tail = 0, [], b""

    def feed(self, data: bytes) -> None:
        if self.headers is None:
            self.head += data
            end = self.head.find(b"\r\n\r\n")
            if end < 0:
                if len(self.head) > HEAD_LIMIT:
                    raise BadRecord("a header without an end")
                return
            lines = self.head[:end].split(b"\r\n")
            if not lines[0].startswith(b"WARC/"):
                raise BadRecord(f"a record starts with {lines[0][:20]!r}")
            self.headers = {k.strip().lower(): v.strip() for k, _, v in (x.decode("utf-8", "replace").partition(":") for x in lines[1:])}
            if not self.headers.get("content-length", "").isdigit():
                raise BadRecord("a record without a length")
            self.left = int(self.headers["content-length"])
            data, self.head = self.head[end + 4 :], b""
        take, rest = data[: self.left], data[self.left :]
        self.left -= len(take)
        self.tail += rest
        if len(self.tail) > 4:
            raise BadRecord("bytes after a record's end")
        self.block.update(take)
        if not self.in_body:
            self.http += take
            if "application/http" not in self.headers.get("content-type", ""):
                take, self.http, self.in_body = self.http, b"", True
            elif (end := self.http.find(b"\r\n\r\n")) >= 0:
                take, self.http, self.in_body = self.http[end + 4 :], self.http[: end + 2], True
            elif len(self.http) > HEAD_LIMIT:
                raise BadRecord("a message header without an end")
            else:
                return
        self.body.update(take)
        self.n_body += len(take)
        if self.keep:
            self.kept.append(take)

    def done(self) -> Record:
        if self.headers is None or self.left or self.tail != b"\r\n\r\n":
            raise BadRecord("a record is cut")
        name = lambda h: base64.b32encode(h.digest()).decode()
        said = self.headers.get("warc-payload-digest", "").rpartition(":")[2]
        block = self.headers.get("warc-block-digest", "").rpartition(":")[2]
        length = re.search(rb"(?im)^content-length:\s*(\d+)", self.http)
        again = self.headers.get("warc-type") == "revisit"
        return Record(
            self.headers,
            int(length[1]) if length else None,
            int(length[1]) if again and length else self.n_body,
            said if again else name(self.body),
            not block or block == name(self.block),
            again or not said or said == name(self.body),
            b"".join(self.kept) if self.keep and not again else None,
        )


def records(pieces: Iterable[bytes], keep_payload: bool = False) -> Iterator[Record]:
    """The records of an archive, in one pass over its bytes.

    Each gzip member is inflated step by step and has to hold one whole record:
    the header, as many bytes as it says, and the two line ends. BadRecord is
    raised for a cut or overlong member; wrong digests are told in the record.
    """
    z = member = None
    for piece in pieces:
        while piece:
            if z is None:
                z, member = zlib.decompressobj(31), _Member(keep_payload)
            try:
                member.feed(z.decompress(piece, 1 << 20))
                while z.unconsumed_tail and not z.eof:
                    member.feed(z.decompress(z.unconsumed_tail, 1 << 20))
            except zlib.error as e:
                raise BadRecord(str(e)) from e
            piece = b""
            if z.eof:
                yield member.done()
                piece, z = z.unused_data, None
    if z is not None:
        raise BadRecord("the last member is cut")


def revisited(pages: DataFrame, least: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, payload, refers_to: which pages repeat the payload of the largest page_id that has it.

    Only payloads of at least ``least`` bytes that two rows share enter the join;
    counts are pre-aggregated by digest, and a hot digest's rows can be split.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    keyed = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.length("payload"))
    shared = keyed.filter(F.col("size") >= least).groupBy("digest", "size").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    joined = keyed.join(written(shared, "warc-shared"), ["digest", "size"], "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "payload", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, least: int = 0, level: int = 6, **columns: str) -> DataFrame:
    """Write a record per page, an archive per partition. Returns path, n_records, n_bytes.

    Defined results: null html is an empty payload; equal payloads of at least
    ``least`` bytes are stored once, with the largest page_id, and the others
    revisit it (if that id repeats, each of its rows is a response); a null
    page_id takes part as the smallest; a null url leaves the header out; an
    empty table writes no archive.
    """

    def run(batches):
        out, n = None, 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out = out or Published(f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz")
                out.write(page_record(*row, level=level))
                n += 1
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz"], "n_records": [n], "n_bytes": [out.at]})

    return written(revisited(pages, least, **columns).mapInArrow(run, "path string, n_records long, n_bytes long"), "warc-list")


READ = "path string, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, block_ok boolean, payload_ok boolean"


def read_archives(listed: DataFrame, tasks: int, strict: bool = False) -> DataFrame:
    """The records of the archives in column ``path``, a task per share of them, verified on the way.

    ``block_ok`` and ``payload_ok`` say whether the digests in a record's header
    are those of its bytes; with ``strict`` a record where one isn't raises
    BadRecord, as cut and malformed ones always do.

    Defined results: ids that aren't numbers are null; a record without digests
    is taken as it is; repeated records are kept; no archives give no rows.
    """
    schema = pa.schema([("path", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("block_ok", pa.bool_()), ("payload_ok", pa.bool_())])

    def number(urn: str | None):
        digits = (urn or "").strip("<>").rpartition(":")[2]
        return int(digits) if re.fullmatch(r"-?\d+", digits) else None

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                held = []
                for r in records(chunks(path)):
                    h = r.headers
                    if strict and not (r.block_ok and r.payload_ok):
                        raise BadRecord(f"{h.get('warc-record-id')} in {path} doesn't match its digests")
                    held.append((path, number(h.get("warc-record-id")), h.get("warc-target-uri"), h.get("warc-type"), number(h.get("warc-refers-to")), r.payload_bytes, r.payload_digest, r.block_ok, r.payload_ok))
                    if len(held) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    return listed.select("path").repartition(tasks).mapInArrow(run, READ)


def archive_folder(spark) -> str:
    return scratch(spark, "warc")

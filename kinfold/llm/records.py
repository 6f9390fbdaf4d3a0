"""Token ids as length-delimited binary records with an offset index (operator 6).

A shard is a file of records. A record is the payload's length (8 bytes), the
masked checksum of those 8 bytes (4), the payload, the masked checksum of the
payload (4); all little-endian. A payload is the document id (8 bytes, signed),
a byte of flags (1: the id is null), a byte with the width of an id in bytes (2
or 4), 6 bytes 0, then the ids. A checksum is CRC-32 rotated right by 15 bits
plus MASK, so that data that holds checksums can be checked again.

The index beside a shard has 32 bytes a record: offset, length, document id,
number of ids. It lets a reader fetch records in any order: shuffled() takes
blocks of about BLOCK bytes in random order, and the records of each.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .fsio import Published, chunks, read_range
from .pretoken import character_classes, encoder_of, text_groups
from .shared import scratch, temporary, written

#: Fixed value: what masked checksums add after the rotation.
MASK = 0xA282EAD8
HEAD = "<qBB6x"
INDEX = "<QQqQ"
LENGTH_LIMIT = 1 << 40
ROWS = 256
#: Bytes of text that a shard takes, and those from which it is worth a task of its own; bytes that a shuffled read takes at once.
SHARD, LEAST_SHARD, BLOCK = 32 << 20, 1 << 20, 1 << 20


class BadRecord(ValueError):
    pass


def masked(data) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + MASK) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def serialized(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    return struct.pack(HEAD, doc_id or 0, doc_id is None, width) + ids.astype(f"<u{width}").tobytes()


def parsed(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, null, width = struct.unpack_from(HEAD, payload)
    if width not in (2, 4) or (len(payload) - struct.calcsize(HEAD)) % width:
        raise BadRecord("the payload isn't whole ids")
    return None if null else doc_id, np.frombuffer(payload, f"<u{width}", offset=struct.calcsize(HEAD))


def records(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """The payloads of a shard, checked, in one pass; BadRecord at the first byte that isn't right."""
    held = bytearray()
    it = iter(pieces)

    def fill(n: int) -> bool:
        while len(held) < n:
            piece = next(it, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while fill(1):
        if not fill(12):
            raise BadRecord("a record's length is cut")
        n, crc = struct.unpack_from("<QI", held)
        if masked(held[:8]) != crc or n > LENGTH_LIMIT:
            raise BadRecord("a record's length doesn't match its checksum")
        if not fill(16 + n):
            raise BadRecord("a record is cut")
        payload = bytes(held[12 : 12 + n])
        if masked(payload) != struct.unpack_from("<I", held, 12 + n)[0]:
            raise BadRecord("a record doesn't match its checksum")
        del held[: 16 + n]
        yield payload


def index_of(path: str) -> list[tuple[int, int, int, int]]:
    """(offset, length, document id, number of ids) of each record."""
    return list(struct.iter_unpack(INDEX, b"".join(chunks(f"{path}.index"))))


def record_at(path: str, offset: int, length: int) -> tuple[int | None, np.ndarray]:
    """One record, fetched by its place in the index."""
    return parsed(next(records([read_range(path, offset, length)])))


def shuffled(path: str, seed: int, block: int = BLOCK) -> Iterator[tuple[int, int | None, np.ndarray]]:
    """(place in the shard, document id, ids) of every record, in an order of the seed's, checked against the index."""
    index = np.frombuffer(b"".join(chunks(f"{path}.index")), np.dtype([("offset", "<u8"), ("length", "<u8"), ("doc_id", "<i8"), ("ids", "<u8")]))
    rng = np.random.default_rng(seed)
    of = index["offset"] // np.uint64(block)
    edges = np.append(np.flatnonzero(np.append(True, of[1:] != of[:-1])), len(index)) if len(index) else np.zeros(1, np.int64)
    for b in rng.permutation(len(edges) - 1):
        some = index[edges[b] : edges[b + 1]]
        first = int(some["offset"][0])
        raw = read_range(path, first, int(some["offset"][-1] + some["length"][-1]) - first)
        for i in rng.permutation(len(some)):
            at, length = int(some["offset"][i]) - first, int(some["length"][i])
            payload = list(records([raw[at : at + length]]))
            key, ids = parsed(payload[0]) if len(payload) == 1 else (None, None)
            if ids is None or (key or 0) != some["doc_id"][i] or len(ids) != some["ids"][i]:
                raise BadRecord("a record isn't what the index says")
            yield int(edges[b] + i), key, ids


def shard_count(docs: DataFrame, text: str = "text", shard: int = SHARD) -> int:
    """Shards of about ``shard`` bytes of text; smaller ones while there are idle cores and LEAST_SHARD bytes for each."""
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    return max(1, -(-size // shard), min(docs.sparkSession.sparkContext.defaultParallelism, size // LEAST_SHARD))


def write_shards(docs: DataFrame, tokenizer: str, folder: str, shards: int, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every text, append ``end_id`` and write the ids in ascending document id.

    Rows are dealt by ranges of (id, hash of the text) and sorted within a
    range, so shard k holds what comes before shard k + 1. Only text moves.
    Returns a written table: shard, path, n_docs, n_ids, start (ids of all
    shards before), a row per shard that has documents.

    Defined results: null text encodes as empty and has only the end id; null
    document ids come first; rows that share an id are all kept, in the order of
    their texts' hashes; an empty table has no shards.
    """
    classes = character_classes(tokenizer)
    width = 2 if _vocabulary(tokenizer) <= 1 << 16 and end_id < 1 << 16 else 4
    end = np.array([end_id], np.uint32)

    def run(batches):
        data = index = None
        n_docs = n_ids = 0
        for batch in batches:
            if data is None:
                shard = TaskContext.get().partitionId()
                path = f"{folder}/shard-{shard:06d}.rec"
                data, index, encoder = Published(path), Published(f"{path}.index"), encoder_of(tokenizer, classes, ids=True)
            for row in range(0, batch.num_rows, ROWS):
                keys, texts = batch.column(0).slice(row, ROWS).to_pylist(), [x or "" for x in batch.column(1).slice(row, ROWS).to_pylist()]
                for a, b in text_groups(texts):
                    counts, ids = encoder.encode(texts[a:b])
                    at = 0
                    for key, n in zip(keys[a:b], counts.tolist(), strict=True):
                        record = framed(serialized(key, np.append(ids[at : at + n], end), width))
                        index.write(struct.pack(INDEX, data.write(record), len(record), key or 0, n + 1))
                        at, n_docs, n_ids = at + n, n_docs + 1, n_ids + n + 1
        if data is not None:
            data.close()
            index.close()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [path], "n_docs": [n_docs], "n_ids": [n_ids]})

    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    order = ["doc_id", "tie"]
    dealt = picked.withColumn("tie", F.xxhash64("text")).repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "text")
    with temporary():
        listed = written(dealt.mapInArrow(run, "shard long, path string, n_docs long, n_ids long"), "shards-written")
        before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
        return written(listed.withColumn("start", F.coalesce(before, F.lit(0)).cast("long")), "shards", keep=True)


def _vocabulary(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def read_shards(listed: DataFrame, tasks: int, seed: int = 0) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every record of the listed shards, read through their indexes in shuffled order.

    Defined results: a record, an index or a shard that isn't whole raises
    BadRecord; no shards give no rows; the rows are the same for any seed.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for batch in batches:
            for path, start, n_docs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = np.array([n for _, _, _, n in index_of(path)], np.int64)
                if len(counts) != n_docs:
                    raise BadRecord("an index lacks records")
                starts, held = start + np.cumsum(counts) - counts, []
                for place, key, ids in shuffled(path, seed):
                    held.append((key, int(starts[place]), len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(held) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    return listed.select("path", "start", "n_docs").repartition(tasks).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_records(docs: DataFrame, tokenizer: str, **columns: str) -> DataFrame:
    """Write the shards to the shared folder and read them back: doc_id, start, n_tokens, ids_crc32.

    Defined results: those of write_shards() and read_shards(); texts of any
    length are encoded whole, about a million characters of others at a time;
    other columns of any name are left out.
    """
    n = shard_count(docs, columns.get("text", "text"))
    return read_shards(write_shards(docs, tokenizer, scratch(docs.sparkSession, "records"), n, **columns), n)

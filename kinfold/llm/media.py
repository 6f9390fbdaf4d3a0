"""Media columns: ISO base media files in a binary column (operator 1).

`probe` walks a file's nested boxes and decodes its sample tables, so codec,
duration and the byte ranges of keyframes become columns while the payload is
never decoded. `mux_raw` writes a file whose one track holds raw 8-bit frames.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Box types that hold boxes, and how many bytes precede the first of them.
CONTAINERS = {b"moov": 0, b"trak": 0, b"mdia": 0, b"minf": 0, b"stbl": 0, b"edts": 0, b"dinf": 0, b"mvex": 0, b"moof": 0, b"traf": 0}
#: Levels of nested boxes; the format itself needs seven.
DEPTH = 32
SIDE = 8
FRAME = SIDE * SIDE
GROUP = 32
RATE = 25
YIELD_BYTES = 16 << 20


class Malformed(ValueError):
    pass


def walk(data, start: int = 0, end: int | None = None) -> Iterator[tuple[tuple, int, int]]:
    """(path of types, body start, body end) of every box, parents before children; Malformed beyond DEPTH levels."""
    left = [(start, len(data) if end is None else end, ())]
    while left:
        start, end, path = left.pop()
        if start >= end:
            continue
        if end - start < 8:
            raise Malformed(f"{end - start} bytes are left at {start}")
        size, kind = struct.unpack_from(">I4s", data, start)
        head = 8
        if size == 1:
            if end - start < 16:
                raise Malformed(f"no room for a long size at {start}")
            size, head = struct.unpack_from(">Q", data, start + 8)[0], 16
        elif size == 0:
            size = end - start
        head += 16 * (kind == b"uuid")
        if size < head or start + size > end:
            raise Malformed(f"box {kind!r} at {start} has size {size}")
        here = (*path, kind)
        left.append((start + size, end, path))
        if kind in CONTAINERS:
            if len(here) > DEPTH:
                raise Malformed(f"boxes lie more than {DEPTH} deep at {start}")
            left.append((start + head + CONTAINERS[kind], start + size, here))
        yield here, start + head, start + size


def _table(data, start: int, end: int, columns: int, skip: int = 0, kind: str = ">u4") -> np.ndarray:
    """The rows of a full box whose body is version, flags, [skip], count, entries."""
    if end - start < 8 + skip:
        raise Malformed("a table without a count")
    n = struct.unpack_from(">I", data, start + 4 + skip)[0]
    width = np.dtype(kind).itemsize * columns
    if start + 8 + skip + n * width > end:
        raise Malformed(f"a table of {n} rows is cut")
    return np.frombuffer(data, kind, n * columns, start + 8 + skip).reshape(n, columns).astype(np.int64)


def _sizes(data, start: int, end: int, kind: bytes) -> np.ndarray:
    if end - start < 12:
        raise Malformed("a table without a count")
    word, n = struct.unpack_from(">II", data, start + 4)
    if kind == b"stsz":
        if word:
            if n * word > len(data):
                raise Malformed(f"{n} samples of {word} bytes are more than the file holds")
            return np.full(n, word, np.int64)
        return _table(data, start, end, 1, 4)[:, 0]
    bits = word & 255
    if bits not in (4, 8, 16) or start + 12 + (n * bits + 7) // 8 > end:
        raise Malformed(f"a table of {n} sizes of {bits} bits")
    raw = np.frombuffer(data, np.uint8, (n * bits + 7) // 8, start + 12)
    if bits == 4:
        return np.stack([raw >> 4, raw & 15], 1).reshape(-1)[:n].astype(np.int64)
    return raw.view(">u2" if bits == 16 else np.uint8).astype(np.int64)


def _offsets(track: dict) -> tuple[np.ndarray, np.ndarray]:
    """Byte offset and size of each sample, from the chunk tables."""
    chunk, runs, sizes = track["chunks"], track["stsc"], track["sizes"]
    if not len(sizes):
        return np.zeros(0, np.int64), sizes
    if not len(runs) or not len(chunk) or runs[0, 0] != 1:
        raise Malformed("samples without chunks")
    many = np.diff(np.append(runs[:, 0], len(chunk) + 1))
    if many.min() < 0:
        raise Malformed("the chunk tables aren't in order")
    upto = np.minimum(np.cumsum(np.repeat(runs[:, 1], many)), len(sizes))
    if len(upto) != len(chunk) or upto[-1] < len(sizes):
        raise Malformed("the chunk tables don't cover the samples")
    of = np.repeat(np.arange(len(chunk)), np.diff(upto, prepend=0))
    before = np.cumsum(sizes) - sizes
    first = np.zeros(len(chunk), np.int64)
    first[of[::-1]] = before[::-1]
    return chunk[of] + before - first[of], sizes


def ranges(offset: np.ndarray, size: np.ndarray) -> list[tuple[int, int]]:
    """(offset, length) runs, neighbours joined."""
    if not len(offset):
        return []
    first = np.append(True, offset[1:] != offset[:-1] + size[:-1])
    at = np.flatnonzero(first)
    return list(zip(offset[at].tolist(), np.add.reduceat(size, at).tolist(), strict=True))


def _fragments(data, boxes: list, tracks: dict[int, dict]) -> None:
    """Add the runs of movie fragments to their tracks."""
    defaults: dict[int, tuple] = {}
    moof = current = None
    base = at = samples = 0
    own: tuple = (0, 0, 0)
    for path, a, b in boxes:
        if path[-1] == b"trex":
            track, _, duration, size, flags = struct.unpack_from(">5I", data, a + 4)
            defaults[track] = (duration, size, flags)
        elif path == (b"moof",):
            moof = a - 8
        elif path[-1] == b"tfhd":
            flags, track = struct.unpack_from(">II", data, a)
            flags &= 0xFFFFFF
            p, base = a + 8, moof
            if flags & 1:
                base, p = struct.unpack_from(">Q", data, p)[0], p + 8
            p += 4 * bool(flags & 2)
            own = list(defaults.get(track, (0, 0, 0)))
            for i, bit in enumerate((8, 16, 32)):
                if flags & bit:
                    own[i], p = struct.unpack_from(">I", data, p)[0], p + 4
            current, at = tracks.get(track), base
        elif path[-1] == b"trun" and current is not None:
            flags, n = struct.unpack_from(">II", data, a)
            flags &= 0xFFFFFF
            p = a + 8
            if flags & 1:
                at, p = base + struct.unpack_from(">i", data, p)[0], p + 4
            first = None
            if flags & 4:
                first, p = struct.unpack_from(">I", data, p)[0], p + 4
            fields = [bit for bit in (256, 512, 1024, 2048) if flags & bit]
            samples += n
            if p + 4 * n * len(fields) > b or samples > len(data):
                raise Malformed("a run of samples is cut")
            got = np.frombuffer(data, ">u4", n * len(fields), p).reshape(n, len(fields)).astype(np.int64)
            column = lambda bit, other: got[:, fields.index(bit)] if bit in fields else np.full(n, other, np.int64)  # noqa: B023, E731
            size, how = column(512, own[1]), column(1024, own[2]).copy()
            if first is not None and n:
                how[0] = first
            current["extra"].append((at + np.cumsum(size) - size, size, (how & 0x10000) == 0))
            current["duration"] += int(column(256, own[0]).sum())
            at += int(size.sum())


def probe(data) -> list[dict]:
    """The tracks of an ISO media file, without touching its payload.

    Raises Malformed for bytes that aren't one: a box that overruns its parent,
    nesting beyond DEPTH, a cut table, samples that lie outside the file or take
    more bytes than it has, no moov box. No table is made that is larger than
    the file allows, whatever it claims.
    """
    try:
        return _probe(memoryview(data))
    except (struct.error, IndexError, ValueError, OverflowError) as e:
        raise e if isinstance(e, Malformed) else Malformed(str(e)) from e


def _probe(data) -> list[dict]:
    boxes = list(walk(data))
    if not any(path == (b"moov",) for path, _, _ in boxes):
        raise Malformed("no moov box")
    tracks: list[dict] = []
    for path, a, b in boxes:
        kind = path[-1]
        if path == (b"moov", b"trak"):
            none = np.zeros(0, np.int64)
            tracks.append({"id": 0, "handler": "", "codec": "", "width": 0, "height": 0, "timescale": 1, "duration": 0, "sizes": none, "chunks": none, "stsc": none.reshape(0, 3), "sync": None, "extra": []})
        elif path[:2] == (b"moov", b"trak"):
            t = tracks[-1]
            long = len(data) > a and data[a] == 1
            if kind == b"tkhd":
                t["id"] = struct.unpack_from(">I", data, a + (20 if long else 12))[0]
            elif kind == b"mdhd":
                t["timescale"], t["duration"] = struct.unpack_from(">IQ" if long else ">II", data, a + (20 if long else 12))
            elif kind == b"hdlr":
                t["handler"] = bytes(data[a + 8 : a + 12]).decode("latin-1")
            elif kind == b"stsd" and b - a >= 16:
                t["codec"] = bytes(data[a + 12 : a + 16]).decode("latin-1")
                if t["handler"] == "vide" and b - a >= 44:
                    t["width"], t["height"] = struct.unpack_from(">HH", data, a + 40)
            elif kind in (b"stsz", b"stz2"):
                t["sizes"] = _sizes(data, a, b, kind)
            elif kind == b"stsc":
                t["stsc"] = _table(data, a, b, 3)
            elif kind in (b"stco", b"co64"):
                t["chunks"] = _table(data, a, b, 1, 0, ">u4" if kind == b"stco" else ">u8")[:, 0]
            elif kind == b"stss":
                t["sync"] = _table(data, a, b, 1)[:, 0] - 1
                if (t["sync"] < 0).any():
                    raise Malformed("samples count from 1")
            elif kind == b"stts":
                t["stts"] = _table(data, a, b, 2)
    _fragments(data, boxes, {t["id"]: t for t in tracks})
    for t in tracks:
        offset, size = _offsets(t)
        sync = np.ones(len(size), bool)
        if t["sync"] is not None:
            sync[:] = False
            sync[t["sync"]] = True
        for o, s, k in t.pop("extra"):
            offset, size, sync = np.append(offset, o), np.append(size, s), np.append(sync, k)
        if len(size) and (int(offset.min()) < 0 or int(size.max()) > len(data) or (offset > len(data) - size).any() or int(size.sum()) > len(data)):
            raise Malformed("samples lie beyond the end")
        table = t.pop("stts", np.zeros((0, 2), np.int64))
        t["duration"] = t["duration"] or sum(x * y for x, y in table.tolist())
        if t["duration"] >= 1 << 63:
            raise Malformed("no such duration")
        t |= {"samples": len(size), "offset": offset, "size": size, "keyframes": ranges(offset[sync], size[sync]) if sync.any() else []}
        for k in ("sizes", "chunks", "stsc", "sync"):
            t.pop(k)
    return tracks


def payload(data, track: dict) -> bytes:
    """The track's sample bytes in order."""
    return b"".join(bytes(data[o : o + n]) for o, n in ranges(track["offset"], track["size"]))


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 >= 1 << 32:
        return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body
    return struct.pack(">I4s", len(body) + 8, kind) + body


def full(kind: bytes, *parts: bytes, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", flags), *parts)


def mux_raw(data: bytes) -> bytes:
    """An ISO media file with one video track: 8 x 8 frames of 8-bit gray, 64 bytes each.

    Frames are stored as they are, 25 a second, in groups of 32; each group is a
    chunk and starts with a sync sample. The file holds no clock time, so equal
    data make equal files. len(data) has to be a multiple of 64.
    """
    frames, rest = divmod(len(data), FRAME)
    if rest:
        raise ValueError("the data isn't whole frames")
    groups = -(-frames // GROUP)
    matrix = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    entry = box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HHIIIH", SIDE, SIDE, 72 << 16, 72 << 16, 0, 1), bytes(32), struct.pack(">Hh", 40, -1))
    runs = [(1, min(GROUP, frames), 1)] if groups else []
    if groups > 1 and frames % GROUP:
        runs.append((groups, frames % GROUP, 1))
    head = box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2mp41")
    wide = len(data) > (1 << 32) - (1 << 24)

    def moov(first: int) -> bytes:
        at = first + FRAME * GROUP * np.arange(groups, dtype=np.int64)
        stbl = box(
            b"stbl",
            full(b"stsd", struct.pack(">I", 1), entry),
            full(b"stts", struct.pack(">III", 1, frames, 1)),
            full(b"stss", struct.pack(">I", groups), (1 + GROUP * np.arange(groups)).astype(">u4").tobytes()),
            full(b"stsc", struct.pack(">I", len(runs)), b"".join(struct.pack(">III", *r) for r in runs)),
            full(b"stsz", struct.pack(">II", FRAME, frames)),
            full(b"co64" if wide else b"stco", struct.pack(">I", groups), at.astype(">u8" if wide else ">u4").tobytes()),
        )
        minf = box(b"minf", full(b"vmhd", bytes(8), flags=1), box(b"dinf", full(b"dref", struct.pack(">I", 1), full(b"url ", flags=1))), stbl)
        mdia = box(b"mdia", full(b"mdhd", struct.pack(">IIIIHH", 0, 0, RATE, frames, 0x55C4, 0)), full(b"hdlr", bytes(4), b"vide", bytes(12), b"raw\0"), minf)
        tkhd = full(b"tkhd", struct.pack(">IIIII", 0, 0, 1, 0, frames), bytes(8), struct.pack(">HHHH", 0, 0, 0, 0), matrix, struct.pack(">II", SIDE << 16, SIDE << 16), flags=3)
        mvhd = full(b"mvhd", struct.pack(">IIIIIH", 0, 0, RATE, frames, 0x10000, 0x100), bytes(10), matrix, bytes(24), struct.pack(">I", 2))
        return box(b"moov", mvhd, box(b"trak", tkhd, mdia))

    lead = len(head) + len(moov(0)) + (16 if wide else 8)
    return head + moov(lead) + box(b"mdat", data)


def padded(data: bytes) -> bytes:
    """Data with bytes 0 up to a positive multiple of 64."""
    return data + bytes(max(FRAME, -(-len(data) // FRAME) * FRAME) - len(data))


def _pieces(rows: Iterator[tuple], schema: pa.Schema, heavy: int) -> Iterator[pa.RecordBatch]:
    """Record batches of at most some megabytes of the heavy column."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[heavy] or b"")
        if size >= YIELD_BYTES or len(held) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def texts_to_media(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: every text (null: empty) in UTF-8, zero-padded and stored by mux_raw.

    Defined results: a null or empty text is one frame of zeros; null ids and
    repeated rows are kept; equal texts make equal media; an empty table gives no
    rows; other columns of any name are left out. A text is stored whole, so a
    task's memory follows its longest one.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])

    def run(batches):
        def rows():
            for batch in batches:
                for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    data = value.as_buffer().to_pybytes() if value.is_valid else b""
                    yield key, len(data), mux_raw(padded(data))

        yield from _pieces(rows(), schema, 2)

    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return picked.mapInArrow(run, "doc_id long, n_bytes long, media binary")


PROBED = """media_bytes long, media_sha256 string, error string, tracks array<struct<track_id: long, handler: string, codec: string,
width: long, height: long, timescale: long, duration: long, samples: long, keyframes: array<struct<offset: long, length: long>>>>,
payload_bytes long, payload_sha256 string, tail_crc32 long"""


def _described(data) -> dict:
    out = {"media_bytes": None if data is None else len(data), "media_sha256": None if data is None else hashlib.sha256(data).hexdigest(), "error": None, "tracks": None, "payload_bytes": None, "payload_sha256": None, "tail_crc32": None}
    try:
        if data is None:
            raise Malformed("null")
        tracks = probe(data)
    except Malformed as e:
        return out | {"error": str(e)}
    keep = ("handler", "codec", "width", "height", "timescale", "duration", "samples")
    out["tracks"] = [{"track_id": t["id"], **{k: t[k] for k in keep}, "keyframes": [{"offset": o, "length": n} for o, n in t["keyframes"]]} for t in tracks]
    body = b"".join(payload(data, t) for t in tracks)
    return out | {"payload_bytes": len(body), "payload_sha256": hashlib.sha256(body).hexdigest(), "tail_crc32": zlib.crc32(body[-64:])}


def probe_column(df: DataFrame, media: str = "media", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The key columns and what the media column's files say of themselves.

    Adds media_bytes, media_sha256, error, tracks (handler, codec, duration and
    timescale, sample count, byte ranges of keyframes, neighbours joined) and
    size and digests of the stored sample bytes. Each file is read by its tables;
    its samples are hashed as they are and never decoded.

    Defined results: null or malformed bytes give the error's words and null
    tracks; a file without tracks an empty list; repeated rows are kept; an empty
    table gives no rows; other columns of any name are left out.
    """
    picked = df.select(*[F.col(k) for k in keys], F.col(media).alias("media__bytes"))
    fields = picked.drop("media__bytes").schema
    added = StructType.fromDDL(PROBED)
    kept, new = to_arrow_schema(fields), to_arrow_schema(added)
    schema = pa.schema([*kept, *new])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                rows = [_described(v.as_buffer() if v.is_valid else None) for v in part.column(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *[pa.array([r[f.name] for r in rows], f.type) for f in new]], schema=schema)

    return picked.mapInArrow(run, StructType([*fields, *added]))

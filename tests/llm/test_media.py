import hashlib
import os
import random
import struct
import zlib

import pytest

from kinfold.llm import media


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 2048, 2049, 100_000])
def test_round_trip(n):
    data = media.padded(os.urandom(n))
    assert len(data) >= 64 and len(data) % 64 == 0
    (track,) = media.probe(media.mux_raw(data))
    assert media.payload(media.mux_raw(data), track) == data
    assert (track["codec"], track["handler"], track["width"], track["duration"], track["timescale"]) == ("raw ", "vide", 8, len(data) // 64, 25)
    assert len(track["keyframes"]) == -(-len(data) // 2048)


def test_keyframes_point_at_frames():
    data = media.padded(os.urandom(5000))
    whole = media.mux_raw(data)
    (track,) = media.probe(whole)
    for i, (offset, length) in enumerate(track["keyframes"]):
        assert whole[offset : offset + length] == data[i * 2048 : i * 2048 + 64]


def test_malformed():
    good = media.mux_raw(media.padded(b"abc"))
    for bad in (b"", b"abc", good[:50], good[:-10], struct.pack(">I4s", 8, b"free"), struct.pack(">I4s", 4, b"moov")):
        with pytest.raises(media.Malformed):
            media.probe(bad)


def test_claims_beyond_the_file():
    good = media.mux_raw(media.padded(b"abc" * 900))
    deep = b""
    for _ in range(1500):
        deep = media.box(b"moov", deep)
    bad = [deep]
    for kind, at, raw in ((b"stsz", 12, b"\xff" * 4), (b"stsz", 8, b"\xff" * 4), (b"stsc", 16, b"\xff" * 4), (b"stco", 12, b"\xff" * 4), (b"stss", 12, bytes(4)), (b"mdhd", 4, b"\x01"), (b"stts", 12, b"\xff" * 8)):
        i = good.index(kind) + at
        bad.append(good[:i] + raw + good[i + len(raw) :])
    trun = media.full(b"trun", struct.pack(">I", (1 << 32) - 1))
    trak = media.box(b"trak", media.full(b"tkhd", struct.pack(">5I", 0, 0, 1, 0, 0), bytes(60)))
    bad.append(media.box(b"moov", trak) + media.box(b"moof", media.box(b"traf", media.full(b"tfhd", struct.pack(">I", 1)), trun)))
    far = media.full(b"tfhd", struct.pack(">IQ", 1, (1 << 64) - 1), flags=1)
    bad.append(media.box(b"moov", trak) + media.box(b"moof", media.box(b"traf", far, media.full(b"trun", struct.pack(">II", 1, 8), flags=0x200))))
    failed = 0
    for x in bad:
        try:
            media.probe(x)
        except media.Malformed:
            failed += 1
    assert failed >= len(bad) - 3


def test_no_edit_raises_anything_else():
    rng = random.Random(6)
    good = media.mux_raw(media.padded(b"text" * 300))
    for _ in range(3000):
        raw = bytearray(good[: rng.choice((len(good), rng.randrange(len(good))))])
        for _ in range(rng.randrange(1, 6)):
            if raw:
                raw[rng.randrange(min(len(raw), 700))] = rng.choice((0, 1, 255, rng.randrange(256)))
        told = media._described(bytes(raw))
        assert told["error"] is not None or all(0 <= t["duration"] < 1 << 63 for t in told["tracks"])


def test_sizes_of_boxes():
    body = media.mux_raw(media.padded(b"x" * 70))
    assert len(media.probe(struct.pack(">I4sQ", 1, b"free", 16) + b"" + body[:0] + _shifted(body, 16))) == 1
    open_end = bytearray(body)
    at = body.rindex(b"mdat") - 4
    open_end[at : at + 4] = bytes(4)
    assert media.payload(bytes(open_end), media.probe(bytes(open_end))[0])[:70] == b"x" * 70


def _shifted(body, by):
    """The file with its chunk offsets moved."""
    at = body.index(b"stco") + 12
    n = struct.unpack_from(">I", body, at - 4)[0]
    out = bytearray(body)
    for i in range(n):
        struct.pack_into(">I", out, at + 4 * i, struct.unpack_from(">I", body, at + 4 * i)[0] + by)
    return bytes(out)


def test_fragments():
    trex = media.full(b"trex", struct.pack(">5I", 1, 1, 10, 4, 0))
    moov = media.box(b"moov", media.box(b"trak", media.full(b"tkhd", struct.pack(">5I", 0, 0, 1, 0, 0), bytes(60)), media.box(b"mdia", media.full(b"mdhd", struct.pack(">IIIIHH", 0, 0, 100, 0, 0, 0)), media.full(b"hdlr", bytes(4), b"soun", bytes(13)))), media.box(b"mvex", trex))
    trun = lambda at: media.full(b"trun", struct.pack(">Ii", 3, at), struct.pack(">3I", 4, 5, 6), flags=0x201)
    moof = lambda at: media.box(b"moof", media.box(b"traf", media.full(b"tfhd", struct.pack(">I", 1), flags=0x20000), trun(at)))
    whole = moov + moof(len(moof(0)) + 8) + media.box(b"mdat", b"aaaabbbbbcccccc")
    (track,) = media.probe(whole)
    assert track["samples"] == 3 and track["duration"] == 30 and media.payload(whole, track) == b"aaaabbbbbcccccc"


def test_column(spark, docs, rows, no_docs):
    stored = media.texts_to_media(docs)
    got = sorted(media.probe_column(stored, keys=("doc_id", "n_bytes")).collect(), key=str)
    want = []
    for i, t, _ in rows:
        data = (t or "").encode()
        body = media.padded(data)
        whole = media.mux_raw(body)
        want.append((i, len(data), len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-64:]), len(whole), hashlib.sha256(whole).hexdigest()))
    fields = ("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256")
    assert sorted((tuple(r[f] for f in fields) for r in got), key=str) == sorted(want, key=str)
    assert all(r.error is None and r.tracks[0].codec == "raw " for r in got)
    assert media.probe_column(media.texts_to_media(no_docs)).count() == 0


def test_column_errors(spark):
    deep = b""
    for _ in range(1500):
        deep = media.box(b"moov", deep)
    df = spark.createDataFrame([(1, None), (2, bytearray(b"junk")), (4, bytearray(deep)), (4, bytearray(deep)), (3, bytearray(media.mux_raw(media.padded(b"ok"))))], "doc_id long, media binary")
    got = {r.doc_id: r for r in media.probe_column(df).collect()}
    assert "deep" in got[4].error and got[1].error == "null" and got[2].error and got[2].tracks is None and got[3].error is None

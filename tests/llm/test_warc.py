import base64
import gzip
import hashlib
import os

import pytest

from kinfold.llm import warc


def digest(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


PAGES = [(1, "http://a/x", "<p>hi</p>"), (2, "http://b\r\ny", "<p>hi</p>"), (5, None, "<p>hi</p>"), (3, "u", None), (4, "u", ""), (6, "u", "ü" * 5000), (7, "u", "\r\n\r\nWARC/1.1\r\n\r\n"), (8, "u", "x" * 3_000_000), (9, "u", "twice"), (9, "u", "twice"), (11, "u", None), (11, None, None), (11, "u", "other"), (-3, "u", "neg"), (None, "u", "neg")]


def test_round_trip(spark):
    df = spark.createDataFrame([(*p, "clash", 1) for p in PAGES], "page_id long, url string, html string, payload string, size int").repartition(3)
    listed = warc.write_archives(df, warc.archive_folder(spark))
    got = warc.read_archives(listed, 2).collect()
    assert all(r.block_ok and r.payload_ok for r in got) and len(got) == len(PAGES)
    by = {}
    for i, _, h in PAGES:
        by.setdefault((h or ""), []).append(-10 if i is None else i)
    want = []
    for i, _, h in PAGES:
        body = (h or "").encode()
        first = max(by[h or ""])
        again = (-10 if i is None else i) != first
        want.append((i, len(body), digest(body), "revisit" if again else "response", first if again else None))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == sorted(want, key=str)
    assert {r.page_id: r.url for r in got}[2] == "http://b%0D%0Ay" and {r.page_id: r.url for r in got}[5] is None


def test_least_and_empty(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    got = warc.read_archives(warc.write_archives(df, warc.archive_folder(spark), least=3), 2).collect()
    assert sorted((r.page_id, r.record_type) for r in got) == [(1, "response"), (2, "response"), (3, "revisit"), (4, "response")]
    assert warc.read_archives(warc.write_archives(df.limit(0), warc.archive_folder(spark)), 2).count() == 0


def test_reader():
    one, two = warc.page_record(1, "u", os.urandom(300_000)), warc.page_record(2, "u", b"", refers_to=1)
    whole = one + two
    for step in (1 << 20, 1000, 7):
        got = list(warc.records((whole[i : i + step] for i in range(0, len(whole), step)), keep_payload=True))
        assert [r.headers["warc-type"] for r in got] == ["response", "revisit"] and len(got[0].payload) == 300_000
    raw = gzip.decompress(warc.page_record(1, "u", b"payload"))
    again = lambda b: list(warc.records([gzip.compress(b)]))
    assert not again(raw.replace(b"payload\r\n", b"pAyload\r\n"))[0].payload_ok
    for bad in (raw[:-2], raw + b"more", raw.replace(b"WARC/1.1", b"nothing!"), raw.replace(b"Content-Length", b"Other-Length")):
        with pytest.raises(warc.BadRecord):
            again(bad)
    with pytest.raises(warc.BadRecord):
        list(warc.records([whole[:-3]]))
    with pytest.raises(warc.BadRecord):
        list(warc.records([b"plain text, no archive"]))


def test_forged_records(spark, tmp_path):
    def archive(name, raw):
        at = tmp_path / name
        at.write_bytes(raw)
        return spark.createDataFrame([(str(at),)], "path string")

    good, forged = warc.page_record(1, "u", b"payload"), gzip.decompress(warc.page_record(2, "u", b"payload")).replace(b"payload\r\n", b"pAyload\r\n")
    again = gzip.decompress(warc.page_record(3, "u", b"payload", refers_to=1)).replace(b"200 OK", b"200 KO")
    listed = archive("forged.warc.gz", good + gzip.compress(forged) + gzip.compress(again))
    got = {r.page_id: (r.block_ok, r.payload_ok) for r in warc.read_archives(listed, 1).collect()}
    assert got == {1: (True, True), 2: (False, False), 3: (False, True)}
    assert warc.read_archives(archive("good.warc.gz", good), 1, strict=True).count() == 1
    with pytest.raises(Exception, match="doesn't match its digests"):
        warc.read_archives(listed, 1, strict=True).collect()

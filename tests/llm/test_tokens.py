import random
import struct
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from kinfold.llm import pretoken, records, token_count
from kinfold.llm.shared import scratch


@pytest.fixture(scope="module")
def library(tokenizer):
    return Tokenizer.from_file(tokenizer)


def test_against_the_library(tokenizer, library):
    rng = random.Random(2)
    alphabet = ["'", "s", "t", "re", "ve", "ll", "d", "m", " ", "\n", "\t", "a", "é", "1", "²", "!", "<|endoftext|>", " ", "漢", "😀", "́", "  ", "''", "\\", "\r"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(14))) for _ in range(4000)] + ["", "a" * 5000, " " * 3000, "ab" * 2000, "\n" * 99]
    want = [x.ids for x in library.encode_batch_fast(texts, add_special_tokens=False)]
    classes = pretoken.character_classes(tokenizer)
    for ids in (False, True):
        encoder = pretoken.Encoder(tokenizer, classes, ids)
        encoder.memo.most = 3000
        counts, flat = [], []
        for a, b in pretoken.text_groups(texts, 5000):
            n, i = encoder.encode(texts[a:b])
            counts += n.tolist()
            flat += i.tolist()
        assert counts == [len(x) for x in want]
        assert not ids or flat == [i for x in want for i in x]


def thue_morse(n, a="a", b="b"):
    return "".join((a, b)[i.bit_count() % 2] for i in range(n))


@pytest.mark.parametrize("n", [8, 9, 1024, 1025, 2048])
def test_words_of_complementary_letters(tokenizer, library, n):
    texts = [thue_morse(n), thue_morse(n, "b", "a")]
    want = [x.ids for x in library.encode_batch_fast(texts, add_special_tokens=False)]
    classes = pretoken.character_classes(tokenizer)
    for ids in (False, True):
        counts, flat = pretoken.Encoder(tokenizer, classes, ids).encode(texts)
        assert counts.tolist() == [len(x) for x in want]
        assert not ids or flat.tolist() == want[0] + want[1]


def test_colliding_hashes_do_not_matter(tokenizer, library, monkeypatch):
    monkeypatch.setattr(pretoken, "span_hashes", lambda data, start, end: (data[start] & 1).astype(np.uint64))
    encoder = pretoken.Encoder(tokenizer, pretoken.character_classes(tokenizer), True)
    for text in ("one two three one é two", "four one five", "x" * 1500 + " " + "x" * 1499 + "y"):
        assert encoder.encode([text])[1].tolist() == library.encode(text, add_special_tokens=False).ids


def test_several_special_tokens(tokenizer, library, tmp_path):
    library = Tokenizer.from_file(tokenizer)
    library.add_special_tokens(["<|one|>", "<|two|>"])
    library.save(path := str(tmp_path / "several.json"))
    texts = ["a <|one|> b<|two|><|endoftext|>c", "plain", ""]
    counts, flat = pretoken.Encoder(path, pretoken.character_classes(path), True).encode(texts)
    want = [x.ids for x in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(x) for x in want] and flat.tolist() == [i for x in want for i in x]


def test_counts(spark, docs, rows, no_docs, tokenizer, library):
    got = sorted(map(tuple, token_count.token_counts(docs, tokenizer).collect()), key=str)
    want = []
    for i, t, _ in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 512))
    assert got == sorted(want, key=str)
    assert token_count.token_counts(no_docs, tokenizer).count() == 0


def test_records(spark, docs, rows, no_docs, tokenizer, library):
    listed = records.write_shards(docs, tokenizer, scratch(spark, "test"), 3)
    got = records.read_shards(listed, 2).collect()
    ids = {}
    for i, t, _ in rows:
        ids.setdefault(i, []).append([*library.encode(t or "", add_special_tokens=False).ids, 0])
    told = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in got)
    assert [r[1] for r in told] == sorted((i for i, _, _ in rows), key=lambda i: -1 if i is None else i)
    at = 0
    for start, i, n, crc in told:
        assert start == at
        at += n
        assert (n, crc) in [(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in ids[i]]
    path = listed.first().path
    index = records.index_of(path)
    for offset, length, key, n in reversed(index):
        doc, found = records.record_at(path, offset, length)
        assert (doc or 0) == key and len(found) == n
    assert sorted(records.read_shards(listed, 2, seed=9).collect(), key=str) == sorted(got, key=str)
    one, two = ([place for place, _, _ in records.shuffled(path, seed, 500)] for seed in (1, 2))
    assert one != two and sorted(one) == sorted(two) == list(range(len(index)))
    assert records.token_records(no_docs, tokenizer).count() == 0
    assert records.shard_count(docs) >= 1 == records.shard_count(no_docs)


def test_index_that_lies(tmp_path):
    shard = tmp_path / "shard"
    rows = [records.framed(records.serialized(i, np.arange(i), 2)) for i in range(4)]
    shard.write_bytes(b"".join(rows))
    entries = [(sum(map(len, rows[:i])), len(rows[i]), i, i) for i in range(4)]
    for change in ({}, {2: (entries[2][0], len(rows[2]), 9, 2)}, {2: (entries[2][0], len(rows[2]), 2, 7)}, {2: (entries[2][0] + 1, len(rows[2]), 2, 2)}, {2: (entries[2][0], 0, 2, 2)}):
        (tmp_path / "shard.index").write_bytes(b"".join(struct.pack(records.INDEX, *change.get(i, e)) for i, e in enumerate(entries)))
        if change:
            with pytest.raises(records.BadRecord):
                list(records.shuffled(str(shard), 1))
        else:
            assert sorted(k for _, k, _ in records.shuffled(str(shard), 1)) == [0, 1, 2, 3]


def test_broken_records():
    good = records.framed(records.serialized(5, np.arange(9), 2)) + records.framed(records.serialized(None, np.arange(3), 4))
    assert [records.parsed(p)[0] for p in records.records([good[:7], good[7:30], good[30:]])] == [5, None]
    for bad in (good[:-1], good[:5], good[:3] + b"\xff" + good[4:], good[:20] + b"\xff" + good[21:]):
        with pytest.raises(records.BadRecord):
            list(records.records([bad]))

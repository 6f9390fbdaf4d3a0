"""Every registered query of the training-data operators against a plain version, on whole small tables, and the pipeline."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from kinfold.llm import media, quality
from tests.conftest import SMALL
from tests.llm import test_decontaminate, test_line_dedup, test_mixing, test_ngram_join, test_quality


def table(folder, name, *columns):
    return [tuple(r.values()) for r in pq.read_table(f"{folder}/{name}.parquet", columns=list(columns)).to_pylist()]


@pytest.fixture(scope="module", params=["small", "awkward"])
def folder(request, tmp_path_factory, rows):
    """The smallest tables, or others of every awkward kind."""
    if request.param == "small":
        return SMALL
    at = tmp_path_factory.mktemp("tables")
    some = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows if len(t or "") < 100_000]
    put = lambda name, kinds, values: pq.write_table(pa.table({c: pa.array([v[i] for v in values], k) for i, (c, k) in enumerate(kinds.items())}), f"{at}/{name}.parquet")
    long, text, small = pa.int64(), pa.string(), pa.int32()
    put("documents", {"doc_id": long, "text": text, "lang": text, "source": text, "n_chars": long}, some)
    put("benchmark", {"item_id": long, "text": text}, [(1, "keep me please once more for the record"), (2, None), (3, ""), (4, some[0][1][:300]), (4, some[0][1][:300])])
    put("labels", {"doc_id": long, "quality": small, "toxic": small}, [(i, i % 2, int(i % 7 == 0)) for i in range(60)] + [(None, 1, 0), (3, None, 1), (999, 0, 0)])
    put("pages", {"page_id": long, "url": text, "html": text}, [(1, "u", "x"), (2, None, "x"), (2, "u", "x"), (3, "u", None), (4, "u", ""), (None, "u", "ü"), (5, "u\n", "ü")])
    put("conversations", {"conv_id": long, "turn": long, "role": text, "text": text}, [(1, 0, "user", "hi </turn> \\s"), (1, 1, "assistant", "### x"), (2, 3, "assistant", None), (2, 1, None, "?"), (3, 0, "assistant", "")])
    return str(at)


def rows_of(spark, name, folder, *columns):
    got = __spark_entry__.queries()[name](spark, folder).select(*columns).collect()
    return sorted(map(tuple, got), key=str)


def test_op1(spark, folder):
    want = []
    for i, t in table(folder, "documents", "doc_id", "text"):
        data = (t or "").encode()
        body = data + bytes(-len(data) % 64 or (0 if data else 64))
        whole = media.mux_raw(body)
        want.append((i, len(data), len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-64:]), len(whole), hashlib.sha256(whole).hexdigest()))
    columns = ("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256")
    assert rows_of(spark, "op1_media_columns", folder, *columns) == sorted(want, key=str)
    feature = __spark_entry__.queries()["op1_media_columns"](spark, folder).select("payload_sha256", "feature", "error").distinct().collect()
    assert len(feature) == len({r.payload_sha256 for r in feature}) and all('"codec":"raw "' in r.feature and r.error is None for r in feature)


def test_op2(spark, folder):
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in __spark_entry__.queries()["op2_decontamination"](spark, folder).collect()}
    docs, items = table(folder, "documents", "doc_id", "text"), table(folder, "benchmark", "item_id", "text")
    grams = lambda t: {tuple(w[i : i + 5]) for w in [test_decontaminate.tokens(t)] for i in range(len(w) - 4)}
    held = {i: grams(t) for i, t in items}
    want = {}
    for i, t in docs:
        mine = grams(t)
        near = [x for x in items if mine & held[x[0]] or 0 < len(test_decontaminate.tokens(x[1])) < 5]
        if near:
            for pair, s in test_decontaminate.brute([(i, t)], near).items():
                want[pair] = max(s, want.get(pair, 0))
    assert got == want


def test_op3_and_op6(spark, folder, tokenizer):
    library = Tokenizer.from_file(tokenizer)
    docs = table(folder, "documents", "doc_id", "text")
    ids = [library.encode(t or "", add_special_tokens=False).ids for _, t in docs]
    want = [(i, len((t or "").encode()), len(x), len(x) > 512) for (i, t), x in zip(docs, ids, strict=True)]
    assert rows_of(spark, "op3_token_counts", folder, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=str)
    got = sorted(rows_of(spark, "op6_token_records", folder, "start", "doc_id", "n_tokens", "ids_crc32"))
    assert [r[1] for r in got] == sorted((i for i, _ in docs), key=lambda i: (i is not None, i))
    assert [r[0] for r in got] == np.append(0, np.cumsum([r[2] for r in got]))[:-1].tolist()
    assert Counter(r[1:] for r in got) == Counter((i, len(x) + 1, zlib.crc32(np.array([*x, 0], "<u4").tobytes())) for (i, _), x in zip(docs, ids, strict=True))


def test_op4(spark, folder):
    got = rows_of(spark, "op4_quality_classifier", folder, "doc_id", "p_quality", "p_toxic", "accepted")
    assert len(got) == len(table(folder, "documents", "doc_id"))
    assert all(a == ((q is None or q >= 0.5) and (t is None or t < 0.5)) for _, q, t, a in got)


def test_op5(spark, folder):
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in test_line_dedup.brute(table(folder, "documents", "doc_id", "text"))]
    assert rows_of(spark, "op5_line_dedup", folder, "doc_id", "n_lines", "n_dropped", "kept_sha256") == sorted(want, key=str)


def test_op7(spark, folder):
    said = "\\### Assistant: </turn> ok"
    turns = defaultdict(list)
    for c, n, r, t in [*table(folder, "conversations", "conv_id", "turn", "role", "text"), (-7, 0, "user", said), (-7, 1, "assistant", said)]:
        turns[c].append((n, r or "", t or ""))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for c, rows in turns.items():
        loss = "".join(t for _, r, t in sorted(rows) if r == "assistant")
        want.append((c, len(rows), digest("".join(f"{r}\n{t}\n" for _, r, t in sorted(rows))), len(loss), digest(loss)))
    assert rows_of(spark, "op7_chat_formatting", folder, "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256") == sorted(want, key=str)


def test_op8(spark, folder):
    assert rows_of(spark, "op8_ngram_join", folder, "doc_id", "n_shingles", "component_id") == test_ngram_join.brute(table(folder, "documents", "doc_id", "text"))


def test_op9(spark, folder):
    pages = table(folder, "pages", "page_id", "html")
    first = {}
    for i, h in pages:
        first[h or ""] = max(first.get(h or "", -(1 << 70)), -(1 << 70) if i is None else i)
    want = []
    for i, h in pages:
        data, to = (h or "").encode(), first[h or ""]
        again = to > -(1 << 70) and i != to
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", to if again else None, True, True))
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "block_ok", "payload_ok")
    assert rows_of(spark, "op9_warc", folder, *columns) == sorted(want, key=str)


def test_op10(spark, folder):
    got = [(i, n, m, round(t, 6), k) for i, n, m, t, k in rows_of(spark, "op10_mixing", folder, "doc_id", "size", "source_size", "target", "taken")]
    assert sorted(got, key=str) == test_mixing.brute(table(folder, "documents", "doc_id", "text", "source"))


@pytest.mark.parametrize("name", ["op5_line_dedup", "op7_chat_formatting", "op10_mixing"])
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.execute(__spark_entry__.oracle_sql()[name]).fetchall()
    columns = [c[0] for c in con.description]
    close = lambda rows: sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=str)
    assert close(rows_of(spark, name, SMALL, *columns)) == close(want)


@pytest.fixture(scope="module")
def corpus(tmp_path_factory, rows):
    """Documents of a learnable quality, with near copies, benchmark passages and the awkward rows."""
    at = tmp_path_factory.mktemp("corpus")
    some, labels = test_quality.corpus(160, 11)
    docs = [(i, t, lang, s, n) for i, t, lang, s, n, *_ in some]
    docs += [(1000 + i, docs[i][1] + " more", "en", docs[i][3], 9) for i in range(0, 60, 3)]
    item = " ".join(f"bench{j} item" for j in range(20))
    docs += [(2000 + i, f"{docs[i][1]} {item} {docs[i + 1][1]}", "en", "s1", 9) for i in range(0, 30, 5)]
    docs += [(3000 + (0 if i is None else i), t, "en", s, None) for i, t, s in rows if len(t or "") < 100_000 and i != 21] + [(None, "no id here at all or so", "en", None, 3)]
    columns = list(zip(*docs, strict=True))
    kinds = {"doc_id": pa.int64(), "text": pa.string(), "lang": pa.string(), "source": pa.string(), "n_chars": pa.int64()}
    pq.write_table(pa.table({c: pa.array(v, k) for (c, k), v in zip(kinds.items(), columns, strict=True)}), f"{at}/documents.parquet")
    pq.write_table(pa.table({"item_id": [1, 2], "text": [item, None]}), f"{at}/benchmark.parquet")
    pq.write_table(pa.table({c: [x[k] for x in labels] for k, c in enumerate(("doc_id", "quality", "toxic"))}), f"{at}/labels.parquet")
    return str(at), docs


def plain_run(spark, folder, docs, tokenizer):
    """The pipeline stage by stage, by plain versions; only the classifier's verdicts are its own, whose tests are elsewhere."""
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    model = quality.train(frame, spark.read.parquet(f"{folder}/labels.parquet"))
    accepted = Counter((r.doc_id, r.text) for r in quality.scored(frame, model).filter("accepted").collect())
    kept = [d for d in docs if accepted[d[0], d[1]]]
    steps = [kept]
    group = {i: c for i, _, c in test_ngram_join.brute([(d[0], d[1]) for d in kept])}
    steps.append([d for d in steps[-1] if d[0] is None or group[d[0]] == d[0]])
    bad = {d for d, _ in test_decontaminate.brute([(d[0], d[1]) for d in steps[-1]], table(folder, "benchmark", "item_id", "text"))}
    steps.append([d for d in steps[-1] if d[0] not in bad])
    sized = [(d[0], d[1], d[3]) for d in steps[-1]]
    copies = {(i, n): round(taken / n) for i, n, _, _, taken in test_mixing.brute(sized) if n}
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    steps.append([d for d in steps[-1] for _ in range(copies.get((d[0], words(d[1])), 0))])
    library = Tokenizer.from_file(tokenizer)
    ids = [(d[0], np.array([*library.encode(d[1] or "", add_special_tokens=False).ids, 0], "<u4")) for d in steps[-1]]
    return steps, Counter((i, len(x), zlib.crc32(x.tobytes())) for i, x in ids)


def test_pipeline(spark, corpus, tokenizer):
    folder, docs = corpus
    steps, want = plain_run(spark, folder, docs, tokenizer)
    assert all(len(a) > len(b) for a, b in zip([docs, *steps], steps[:3], strict=False)) and len(steps[3]) > len(steps[2])
    told = __spark_entry__.queries()["pipeline"](spark, folder).collect()
    # Documents without words are taken as often as their source is taken whole, and add no words.
    blank = lambda r: r.n_tokens == 1
    got = Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in told)
    empty = {k for k in got if k[1] == 1} | {(d[0], len(x) + 1, zlib.crc32(np.array([*x, 0], "<u4").tobytes())) for d in steps[2] if not (d[1] or "").strip() for x in [Tokenizer.from_file(tokenizer).encode(d[1] or "", add_special_tokens=False).ids]}
    assert {k: n for k, n in got.items() if k not in empty} == {k: n for k, n in want.items() if k not in empty}
    assert any(blank(r) for r in told)
    told.sort(key=lambda r: r.start)
    assert [r.start for r in told] == np.append(0, np.cumsum([r.n_tokens for r in told]))[:-1].tolist()


def test_pipeline_stages_keep_the_columns(spark, corpus):
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns


def test_pipeline_of_empty_tables(spark, tmp_path):
    for name, kinds in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("benchmark", "item_id long, text string"), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], kinds).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

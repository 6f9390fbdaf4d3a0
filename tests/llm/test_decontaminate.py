import random
import re
from collections import Counter

from kinfold.llm import decontaminate as d


def tokens(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def brute(docs, items, k=5, least=0.8):
    found = {}
    for item, text in items:
        w = tokens(text)
        if not w:
            continue
        n = min(k, len(w))
        grams = lambda x, n=n: [tuple(x[i : i + n]) for i in range(len(x) - n + 1)]
        want = Counter(grams(w))
        m = sum(want.values())
        for doc, t in docs:
            mine = grams(tokens(t))
            for p in range(len(mine)):
                here = Counter(mine[p : p + m])
                both = sum((here & want).values())
                s = both / (sum(here.values()) + m - both)
                if s >= least and s > found.get((doc, item), (0, 0))[0]:
                    found[doc, item] = (s, p)
    return {k: round(v[0], 9) for k, v in found.items()}


def test_brute_force(spark):
    rng = random.Random(3)
    word = lambda: f"{rng.choice('bcdfg')}{rng.randrange(60)}"
    items = [(i, " ".join(word() for _ in range(rng.choice((3, 6, 15, 40))))) for i in range(12)] + [(100, None), (101, ""), (102, "repeat " * 20), (None, "an item without any id at all here")]
    docs = []
    for i in range(60):
        body = [word() for _ in range(rng.randrange(0, 150))]
        if i % 2:
            w = tokens(items[i % 12][1])
            for _ in range(rng.choice((0, 0, 1, 2, 8))):
                at = rng.randrange(len(w))
                w = rng.choice((w[:at] + w[at + 1 :], w[:at] + ["edit"] + w[at + 1 :], w[:at] + ["more"] + w[at:])) or w
            at = rng.randrange(len(body) + 1)
            body = body[:at] + w + body[at:]
        docs.append((i, " ".join(body).title() if i % 3 else ", ".join(body)))
    docs += [(900, None), (901, ""), (902, "Repeat, " * 30), (None, items[3][1]), (5, items[4][1])]
    df = spark.createDataFrame([(a, b, 1, "x") for a, b in docs], "doc_id long, text string, pos int, item_id string")
    bench = spark.createDataFrame([(a, b, "y") for a, b in items], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in d.contaminated(df, bench).collect()}
    want = brute(docs, items)
    assert got == want and len(want) > 10
    kept = d.decontaminated(df, bench)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == sorted(i for i, _ in docs if i is not None and i not in {k[0] for k in want})


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    text = "one two three four five six seven eight nine ten eleven"
    df = spark.createDataFrame([(1, f"before {text} after"), (2, "nothing of it")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, text)], "item_id long, text string")
    monkeypatch.setattr(d, "BROADCAST_ROWS", 0)
    assert [(r.doc_id, r.item_id, r.word, r.similarity) for r in d.contaminated(df, bench).collect()] == [(1, 7, 1, 1.0)]


def test_blocks_find_all_within_the_radius(spark):
    rng = random.Random(1)
    a = rng.getrandbits(64)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = []
    for _ in range(300):
        b = a
        for bit in rng.sample(range(64), 20):
            b ^= 1 << bit
        rows.append((signed(a), signed(b)))
    df = spark.createDataFrame(rows, "a long, b long")
    from pyspark.sql import functions as F

    shared = df.select(F.size(F.array_intersect(d.blocks(F.col("a"), 20), d.blocks(F.col("b"), 20))).alias("n"))
    assert shared.filter("n = 0").count() == 0


def test_blocks_alone_find_the_items(spark):
    """near_shapes gets nothing but fingerprints and sizes, and finds every item within the radius."""
    from pyspark.sql import functions as F

    rng = random.Random(8)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    items = [(i, 9 + i % 2, signed(rng.getrandbits(64))) for i in range(60)]
    prints = []
    for _ in range(200):
        _, m, at = rng.choice(items)
        for bit in rng.sample(range(64), rng.randrange(30)):
            at = signed((at ^ (1 << bit)) & (1 << 64) - 1)
        prints.append((m, at))
    got = d.near_shapes(spark.createDataFrame(prints, "m int, fingerprint long"), spark.createDataFrame(items, "item_id int, m int, of_item long"), 20)
    want = {(m, p, i, n) for m, p in prints for i, k, f in items if k == m and (n := ((p ^ f) & (1 << 64) - 1).bit_count()) <= 20}
    assert sorted((r.m, r.fingerprint, r.item_id, r.hamming) for r in got.collect()) == sorted(want)
    assert d.near_shapes(spark.createDataFrame(prints, "m int, fingerprint long"), spark.createDataFrame(items, "item_id int, m int, of_item long").filter(F.lit(False)), 20).count() == 0


def test_empty_tables(spark, no_docs, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert d.contaminated(docs, none).count() == 0
    assert d.contaminated(no_docs, some).count() == 0

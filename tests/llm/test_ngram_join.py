import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from kinfold.llm import ngram_join
from kinfold.llm.components import components, roots


def sets_of(rows, k=5):
    out = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append((i, frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])))
    return out


def brute(rows, percent=80):
    sets = sets_of(rows)
    up = {i: i for i, _ in sets if i is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    where = defaultdict(list)
    for a, (i, s) in enumerate(sets):
        if i is None:
            continue
        for b, n in Counter(b for g in s for b in where[g]).items():
            j, t = sets[b]
            if 100 * n >= percent * (len(s) + len(t) - n):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
        for g in s:
            where[g].append(a)
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=str)


def test_brute_force(spark, docs, rows, no_docs):
    got = sorted(map(tuple, ngram_join.ngram_join(docs).collect()), key=str)
    assert got == brute([(i, t) for i, t, _ in rows])
    assert ngram_join.ngram_join(no_docs).count() == 0


def edited_copies(percent):
    rng = random.Random(percent)
    rows, passage = [], [f"p{i}" for i in range(30)]
    for g in range(6):
        base = [f"w{rng.randrange(80)}" for _ in range(rng.choice((12, 40, 90)))]
        for _ in range(14):
            w = list(base)
            for _ in range(rng.randrange(0, 5)):
                at = rng.randrange(len(w))
                w[at : at + rng.randrange(2)] = [f"e{rng.randrange(999)}"]
            if rng.random() < 0.3:
                w += passage[: rng.randrange(30)]
            rows.append((len(rows) * 7 % 997, " ".join(w)))
    return rows


@pytest.mark.parametrize("percent, most", [(80, ngram_join.MOST), (60, ngram_join.MOST), (80, 600), (60, 900)])
def test_groups_of_near_copies(spark, percent, most):
    rows = edited_copies(percent)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, percent)
    assert sorted(map(tuple, ngram_join.ngram_join(df, percent=percent, most=most).collect()), key=str) == want
    assert len({r[2] for r in want}) < len(want)


def test_small_chunks_and_tiles(spark, monkeypatch):
    rows = edited_copies(80) + [(5000 + i, "one passage that nearly all of this document consists of here and " + f"tail{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for name, value in (("CHUNK_KEYS", 50), ("RANGE_KEYS", 100), ("TILE", 3)):
        monkeypatch.setattr(ngram_join, name, value)
    assert sorted(map(tuple, ngram_join.ngram_join(df).collect()), key=str) == brute(rows)
    monkeypatch.setattr(ngram_join, "DEALT_ROWS", 0)
    assert sorted(map(tuple, ngram_join.ngram_join(df, most=2000).collect()), key=str) == brute(rows)


def test_chance_shingles_make_no_family(spark):
    """Each two documents share one passage of one shingle, in any order of frequency; only the copy with another word is near any."""
    texts = [" ".join(" ".join([f"s{min(i, j)}x{max(i, j)}"] * 5) for j in range(47) if i != j) for i in range(47)]
    rows = [*enumerate(texts), (100, texts[0] + " more")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    packed = ngram_join._packed(df, 5, 80, np.zeros(ngram_join.COUNTERS, np.uint16), 4)
    met = ngram_join._ties(packed, 4, 80).groupBy("a", "b").agg({"n": "sum"}).filter("`sum(n)` >= 2").collect()
    assert len(met) == 1
    assert sorted(map(tuple, ngram_join.ngram_join(df).collect())) == sorted(brute(rows))


def test_many_holders_and_sizes_at_the_limit(spark):
    """More holders of a shingle than pairs are counted for, in sizes around the least that show two, some of a chunk alike."""
    rng, rows = random.Random(5), []
    for g in range(30):
        base = [f"g{g}w{i}" for i in range(rng.randrange(14, 60))]
        for _ in range(rng.choice((2, 3, 9, 20, 40))):
            w = base[: len(base) - rng.randrange(5)] + [f"t{rng.randrange(9)}" for _ in range(rng.randrange(4))]
            rows.append((len(rows), " ".join(w)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for percent in (80, 90, 55):
        assert sorted(map(tuple, ngram_join.ngram_join(df, percent=percent).collect()), key=str) == brute(rows, percent)


def test_words_of_complementary_letters(spark):
    def word(n, a, b):
        return "".join((a, b)[i.bit_count() % 2] for i in range(n))

    rows = [(1, word(1024, "a", "b")), (2, word(1024, "b", "a")), (3, word(2048, "a", "b")), (4, word(2048, "b", "a"))]
    got = ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == [(i, 1, i) for i in range(1, 5)]


def test_in_memory():
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(200):
        common = rng.integers(0, 1 << 63, rng.integers(0, 60), dtype=np.uint64) * np.uint64(2)
        x, y = (np.unique(np.append(common, rng.integers(0, 1 << 63, rng.integers(1, 90), dtype=np.uint64))) for _ in range(2))
        both = len(np.intersect1d(x, y))
        assert ngram_join._overlaps(x, [y, x]).tolist() == [both, len(x)]
        for bits in (64, 1024):
            assert both <= ngram_join._overlap_bounds(ngram_join._bitmaps([x], bits)[0], len(x), ngram_join._bitmaps([y], bits), np.array([len(y)]))[0] <= min(len(x), len(y))
        sets += [x, np.unique(np.append(x[1:], y[0]))]
    for p in (50, 80, 95):
        for n in range(1, 300):
            assert 1 <= ngram_join.index_length(n, p) <= ngram_join.probe_length(n, p) <= n
            larger = n * 100 // p
            assert ngram_join._band(np.array([larger]))[0] - ngram_join._band(np.array([n]))[0] <= ngram_join.reach(p)
    for side in (None, [i % 3 for i in range(400)]):
        links = ngram_join.linked(list(range(400)), sets, 80, side)
        want = [(i, j) for i in range(400) for j in range(i) if (side is None or side[i] != side[j]) and 100 * (n := len(np.intersect1d(sets[i], sets[j]))) >= 80 * (len(sets[i]) + len(sets[j]) - n)]
        ends = lambda pairs: roots(400, *np.array(pairs, np.int64).reshape(-1, 2).T).tolist()
        assert ends(links) == ends(want) and len(links) == 400 - len(set(ends(links)))


def test_one_per_group(spark, docs, rows):
    kept = ngram_join.one_per_group(docs)
    assert kept.columns == docs.columns
    group = {i: c for i, _, c in brute([(i, t) for i, t, _ in rows])}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((i for i, _, _ in rows if i is None or group[i] == i), key=str)


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(7, 7), (None, 3)]
    up = {x: x for p in links for x in p if x is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in up if any(x in p and p[0] != p[1] and None not in p for p in links)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

import hashlib
import re
from collections import Counter, defaultdict

import pytest

from kinfold.llm import mixing


def brute(rows, weights=(5, 2, 1), budget=1.5, most=2.0):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    total = Counter()
    for _, t, s in rows:
        total[s] += size(t)
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    left = budget * sum(total.values())
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if share * weight[s] > most * total[s]]
        if not over:
            target |= {s: share * weight[s] for s in open_}
            break
        for s in over:
            target[s] = most * total[s]
            left -= target[s]
            open_.discard(s)
    by = defaultdict(list)
    for i, t, s in rows:
        h = int(hashlib.md5(("mix" + ("null" if i is None else str(i))).encode()).hexdigest()[:15], 16)
        by[s].append((h, i, size(t)))
    out = []
    for s, docs in by.items():
        whole = int(target[s] // total[s]) if total[s] else 0
        need, spent = target[s] - whole * total[s], Counter()
        for h, _, n in docs:
            spent[h] += n
        upto, run = {}, 0
        for h in sorted(spent):
            run += spent[h]
            upto[h] = run
        out += [(i, n, total[s], round(target[s], 6), n * (whole + (upto[h] <= need))) for h, i, n in docs]
    return sorted(out, key=str)


def test_brute_force(spark, docs, rows, no_docs):
    got = sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in mixing.mix(docs).collect()), key=str)
    assert got == brute(rows)
    assert mixing.mix(no_docs).count() == 0


@pytest.mark.parametrize("budget", [0.1, 0.7, 1.5, 2.5])
def test_budgets(spark, budget):
    rows = [(i, "w " * (i % 17), "abcdefg"[min(i % 20, 6)]) for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, budget=budget).collect()
    assert sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in got), key=str) == brute(rows, budget=budget)
    for s in "abcdefg":
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 17


def test_budgets_nest(spark):
    df = spark.createDataFrame([(i, "w " * (i % 9 + 1), "ab"[i % 2]) for i in range(400)], "doc_id long, text string, source string")
    taken = [{r.doc_id for r in mixing.mix(df, weights=(1,), budget=b, most=1.0).filter("copies > 0").collect()} for b in (0.2, 0.5, 0.9)]
    assert taken[0] < taken[1] < taken[2]


def test_documents(spark, docs, rows):
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in out.collect()) == +want

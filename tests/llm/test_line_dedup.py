import re
from collections import defaultdict

import pytest

from kinfold.llm import line_dedup
from kinfold.llm.line_dedup import drop_repeated_lines


def key(line):
    return re.sub(r"[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def brute(rows, least=2, chars=10):
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= chars:
                held[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        gone = [i is not None and len(key(x)) >= chars and len(held[key(x)]) >= least and min(held[key(x)]) != i for x in lines]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)))
    return sorted(out, key=str)


def test_brute_force(spark, docs, rows, no_docs):
    got = sorted(map(tuple, drop_repeated_lines(docs).collect()), key=str)
    assert got == brute([(i, t) for i, t, _ in rows])
    assert drop_repeated_lines(no_docs).count() == 0


@pytest.mark.parametrize("hot", [1, 2, 4096, 10**9])
def test_hot_line_and_rows_of_one_id(spark, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT", hot)
    rows = [(i % 40, f"the very common line\nown line number {i}\n\tTHE VERY COMMON LINE\r\nünïcode lïne" + "\nx" * (i % 3)) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, drop_repeated_lines(df).collect()), key=str) == brute(rows)
    assert sorted(map(tuple, drop_repeated_lines(df, min_docs=3, min_chars=1).collect()), key=str) == brute(rows, 3, 1)

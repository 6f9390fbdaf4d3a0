import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, h1 string, key string, size string, hash string, copies string, node string, row string, pos int, chunk string"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def cases():
    """Documents of every awkward kind: (doc_id, text, source)."""
    rng = random.Random(5)
    base, other = words(rng, 120), words(rng, 60)
    near = base.split()
    near[7] = "CHANGED"
    passage = words(rng, 55)
    rows = [
        (1, base, "a"), (2, base, "a"), (3, " ".join(near), "b"), (4, base.upper(), "a"), (5, other, "b"), (6, None, "a"), (7, "", "c"), (8, " \t\n ", "c"), (9, "one two", "c"), (10, "One  two", None),
        (11, "one two three four five", None), (12, "naïve café ünïcode 漢字 text with ' quote's and 12 3.5 !!", "c"), (13, passage + " " + words(rng, 80), "a"), (14, words(rng, 30) + " " + passage, "b"),
        (15, "line that repeats here\nkeep me please\nline that repeats here\n\nshort", "a"), (16, "Line that repeats here  \nanother line of its own\n", "b"), (17, words(rng, 30000, 50000), "a"),
        (18, "x " * 40, "a"), (19, "<|endoftext|>mid<|endoftext|>", "b"), (20, "a" * 3000, "a"), (20, "a" * 3000, "a"), (21, "same id, first text of it here", "a"), (21, "same id, second text of it there", "b"), (None, base, "a"), (None, None, None),
    ]
    for i in range(30, 60):
        rows.append((i, words(rng, rng.randrange(3, 90)), rng.choice("abc")))
    return rows


def frame(spark, rows):
    clash = (7, "h", "k", "s", "x", "c", "nd", "r", 3, "ch")
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), *clash) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="session")
def rows():
    return cases()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")

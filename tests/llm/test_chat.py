from pyspark.sql import functions as F

from kinfold.llm import chat

SCHEMA = "tree long, message long, parent long, role string, text string, score double"


def test_escapes(spark):
    texts = ["\\### Assistant: </turn> ok", "\\s\\e\\h", "</turn", "</turn></turn>", "#### ", "\\", "", "a: b", "</turn>\n### user: x", "\\\\e"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for pairs in (chat.ESCAPES, chat.ROLE_ESCAPES):
        got = df.select("t", chat.escaped(F.col("t"), pairs).alias("e"), chat.unescaped(chat.escaped(F.col("t"), pairs), pairs).alias("u")).collect()
        assert all(r.t == r.u and "</turn>" not in r.e and "### " not in r.e for r in got)


def told(df):
    rows = df.withColumn("turns", chat.parsed_turns(F.col("formatted"))).withColumn("masked", chat.masked_text(F.col("formatted"), F.col("loss"))).collect()
    return {(r.tree, r.leaf): ([(t.role, t.text) for t in r.turns], r.masked) for r in rows}


def test_conversations(spark):
    long = [(9, i, "assistant" if i % 2 else "user", f"turn {i}\n\\x </turn> ### y") for i in range(70)]
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo: \\"), (1, 2, "user", None), (2, 5, "assistant", "b"), (2, 5, "assistant", "a"), (2, 5, "assistant", "a"), (3, 0, "ro:le", ""), (None, 0, "user", "n"), *long]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, message string")
    got = {k[0]: v for k, v in told(chat.format_trees(chat.from_turns(df))).items()}
    assert set(got) == {1, 2, 3, 9, None}
    for conv in got:
        mine = sorted(((t if t is not None else -1), r or "", x or "") for c, t, r, x in rows if c == conv)
        assert got[conv] == ([(r, x) for _, r, x in mine], "".join(x for _, r, x in mine if r == "assistant"))


def test_trees(spark):
    rows = [
        (1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "good", 5.0), (1, 3, 1, "assistant", "bad", -1.0), (1, 4, 2, "user", "more", 0.5), (1, 5, 3, "user", "deep", 0.0), (1, 6, 5, "assistant", "deeper", 0.0),
        (2, 1, 99, "user", "orphan", None), (3, 1, 2, "user", "circle", 0.0), (3, 2, 1, "user", "circle", 0.0), (3, 3, 2, "user", "under a circle", 0.0), (4, 1, None, None, None, None), (4, 1, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    best = told(chat.format_trees(df))
    assert best == {(1, 4): ([("user", "q"), ("assistant", "good"), ("user", "more")], "good"), (2, 1): ([("user", "orphan")], ""), (4, 1): ([("", "")], "")}
    both = told(chat.format_trees(df, branches=5))
    assert both[1, 6] == ([("user", "q"), ("assistant", "bad"), ("user", "deep"), ("assistant", "deeper")], "baddeeper") and set(both) == {(1, 4), (1, 6), (2, 1), (4, 1)}


def test_empty(spark):
    assert chat.format_trees(spark.createDataFrame([], SCHEMA)).count() == 0

"""Dropping lines that repeat across documents (operator 5). DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import temporary, written

#: A line that makes up more than one in so many of all lines is hot.
HOT = 4096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\u000b\f\r"


def line_key(line: Column) -> Column:
    """The line without [\\x20\\x09-\\x0D] at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _hashes(key: Column) -> Column:
    """128 bits of the key: two 64-bit hashes of different seeds."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(11), key).alias("b"))


def repeated_lines(keyed: DataFrame, min_docs: int) -> DataFrame:
    """a, b, keeper, n: the hashes found in ``min_docs`` documents or more, their smallest document and number of lines.

    A task adds up its own lines first, so a line found everywhere shuffles a row
    for each task.
    """
    if min_docs <= 2:
        told = keyed.groupBy("a", "b").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
        return (told.filter("keeper <> last") if min_docs == 2 else told).drop("last")
    by_doc = keyed.groupBy("a", "b", "doc_id").agg(F.count("*").alias("n"))
    told = by_doc.groupBy("a", "b").agg(F.min("doc_id").alias("keeper"), F.count("*").alias("n_docs"), F.sum("n").alias("n"))
    return told.filter(F.col("n_docs") >= min_docs).drop("n_docs")


def _kept_by(keyed: DataFrame, repeated: DataFrame) -> DataFrame:
    """doc_id, pos, a, b, keeper: the lines whose hash is a repeated one.

    Those that make up more than 1 / HOT of all lines, so fewer than HOT, are
    sent to all lines; the others join them by shuffles in which no group is
    larger than that share.
    """
    most = keyed.count() // HOT
    hot, cold = repeated.filter(F.col("n") > most).drop("n"), repeated.filter(F.col("n") <= most).drop("n")
    met = keyed.join(F.broadcast(hot), ["a", "b"], "left")
    rest = met.filter("keeper is null").drop("keeper").join(cold, ["a", "b"])
    return met.filter("keeper is not null").unionByName(rest)


def drop_repeated_lines(docs: DataFrame, min_docs: int = 2, min_chars: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Drop lines found in ``min_docs`` documents or more, but for the smallest id that holds them.

    Lines are split at \\n, keyed by line_key() and hashed; keys of fewer than
    ``min_chars`` code points always stay. Returns doc_id, n_lines, n_dropped,
    kept_text: one row for each input row.

    The lines' hashes are written once; counts and positions come from them. Text
    moves once, to meet its dropped positions.

    Defined results: null or empty text is one empty line and stays; within its
    keeper a line stays however often it repeats; rows that share an id are
    separate rows but one document, so neither counts twice nor drops the
    other's lines; repeated rows are alike; rows of null id keep all lines and
    count as no document; an empty table gives no rows; other columns of any
    name are left out. A text's lines are one array, so memory follows the
    longest text.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1).alias("lines"))
    with temporary():
        lines = rows.filter(F.col("doc_id").isNotNull()).select("doc_id", F.posexplode("lines").alias("pos", "line"))
        keyed = lines.withColumn("key", line_key(F.col("line"))).filter(F.length("key") >= min_chars)
        keyed = written(keyed.select("doc_id", "pos", _hashes(F.col("key")).alias("h")).select("doc_id", "pos", "h.a", "h.b"), "line-hashes")
        repeated = written(repeated_lines(keyed, min_docs), "repeated-lines")
        gone = _kept_by(keyed, repeated).filter(F.col("doc_id") != F.col("keeper"))
        gone = written(gone.groupBy("doc_id").agg(F.collect_set(F.struct("pos", "a", "b")).alias("gone")), "dropped-lines", keep=True)
    joined = rows.join(gone, "doc_id", "left")
    # Rows that share an id share `gone`; a position counts only where the row's own line has that hash.
    at = F.array_distinct(F.transform(F.filter("gone", _own_line), lambda g: g["pos"]))
    dropped = F.when(F.col("gone").isNull(), F.array().cast("array<int>")).otherwise(at)
    cut = joined.select("doc_id", "lines", dropped.alias("dropped"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    kept = F.when(F.size("dropped") == 0, F.array_join("lines", "\n")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    return cut.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("dropped").cast("long").alias("n_dropped"), kept.alias("kept_text"))


def _own_line(g: Column) -> Column:
    h = _hashes(line_key(F.get("lines", g["pos"])))
    return (h["a"] == g["a"]) & (h["b"] == g["b"])

"""Mixing sources to target weights by hash-threshold histograms (operator 10).

Every document has a 60-bit hash of its id. For each source a budget of words
is met by the documents whose hash lies at or below a threshold. The threshold
is found from histograms of words by (source, leading hash bits): the bucket in
which the running sum crosses the budget is the boundary; only its documents
are binned again by the following bits, until one hash is left. No sort of
documents and no collect happens; a histogram has at most 4096 rows a source.

Budgets of one seed nest: a smaller budget's threshold is never higher.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

HASH_HEX = 15
LEVEL_HEX = 3


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters outside [\\x20\\x09-\\x0D]; null counts 0."""
    clean = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\u000b\f\r"))
    return F.when(clean == "", F.lit(0)).otherwise(F.size(F.split(clean, "[ \\t-\\r]+", -1))).cast("long")


def doc_hash(doc_id: Column, seed: str) -> Column:
    """60 bits of md5 as a long; a null id hashes as the word null."""
    hexed = F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(hexed, 1, HASH_HEX), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], budget: float, most: float) -> DataFrame:
    """Target words by source, from (source, source_size).

    Sources in code-point order, null last, take the weights in turn. All share
    ``budget`` times all words by weight; a target stops at ``most`` times its
    source's words and the excess goes to the others by weight, until none is
    above: target = min(cap, level * weight) for the one level that spends the
    budget (or all caps if they are less than it). One row a source, so the
    one-partition window here holds a row for each source and no documents.
    """
    everywhere = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(everywhere) - 1) % len(weights)
    ranked = sizes.select(
        "source",
        "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1).alias("weight"),
        (F.col("source_size") * F.lit(float(most))).alias("cap"),
        F.sum("source_size").over(Window.partitionBy(F.lit(1))).alias("all_words"),
    )
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(filled.rowsBetween(0, Window.unboundedFollowing))
    stepped = ranked.withColumn("level", (F.col("all_words") * F.lit(float(budget)) - before) / left)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    level = F.first(fits, ignorenulls=True).over(filled.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return stepped.withColumn("level", level).select(
        "source",
        "source_size",
        F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight"))).alias("target"),
    )


def _thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, threshold): documents of hash <= threshold hold at most the source's budget of words.

    ``sized``: source, size, hash; ``budgets``: source, need (words).
    """
    levels = HASH_HEX // LEVEL_HEX
    width = 1 << (4 * LEVEL_HEX)
    state = budgets.select("source", "need", F.lit(0).cast("long").alias("prefix"), F.lit(-1).cast("long").alias("threshold"), F.lit(True).alias("open"))
    for level in range(levels):
        unit = 1 << (4 * LEVEL_HEX * (levels - 1 - level))
        live = state.filter("open")
        inside = (
            sized.alias("d")
            .join(live.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")) & (F.expr(f"d.hash DIV {unit * width}") == F.col("s.prefix")))
            .select(F.col("s.source").alias("source"), F.expr(f"d.hash DIV {unit}").alias("bucket"), F.col("d.size").alias("size"), F.col("d.hash").alias("hash"))
        )
        bins = inside.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.min("hash").alias("low"), F.max("hash").alias("high"))
        running = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        cut = (
            bins.withColumn("upto", running)
            .alias("b")
            .join(live.select("source", "need").alias("s"), F.col("b.source").eqNullSafe(F.col("s.source")))
            .groupBy(F.col("s.source").alias("source"))
            .agg(
                F.max(F.when(F.col("upto") <= F.col("need"), F.col("bucket"))).alias("full"),
                F.max(F.when(F.col("upto") <= F.col("need"), F.col("upto"))).alias("spent"),
                F.min(F.when(F.col("upto") > F.col("need"), F.struct("bucket", "low", "high"))).alias("edge"),
            )
        )
        state = (
            state.alias("s")
            .join(cut.alias("c"), F.col("s.source").eqNullSafe(F.col("c.source")), "left")
            .select(
                F.col("s.source").alias("source"),
                F.when(F.col("open"), F.col("need") - F.coalesce(F.col("spent"), F.lit(0))).otherwise(F.col("need")).alias("need"),
                F.when(F.col("open") & F.col("edge").isNotNull(), F.col("edge.bucket")).otherwise(F.col("prefix")).alias("prefix"),
                F.when(F.col("open") & F.col("edge").isNotNull(), F.col("edge.bucket") * unit - 1)
                .when(F.col("open") & F.col("full").isNotNull(), (F.col("full") + 1) * unit - 1)
                .otherwise(F.col("threshold"))
                .alias("threshold"),
                (F.col("open") & F.coalesce(F.col("edge.low") < F.col("edge.high"), F.lit(False))).alias("open"),
            )
        )
        state = written(state, "mix-level")
        if not state.filter("open").limit(1).count():
            break
    return state.select("source", "threshold")


def _plan(sized: DataFrame, weights: tuple[int, ...], budget: float, most: float) -> DataFrame:
    """source, source_size, target, whole, threshold: a row per source of (source, size, hash)."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(totals, weights, budget, most), "mix-targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = targets.select("source", (F.col("target") - whole * F.col("source_size")).alias("need"))
    edges = _thresholds(sized, rest)
    plan = targets.withColumn("whole", whole).alias("t").join(edges.alias("e"), F.col("t.source").eqNullSafe(F.col("e.source")))
    return written(plan.select(F.col("t.source").alias("source"), "source_size", "target", "whole", "threshold"), "mix-plan")


def _sized(docs: DataFrame, seed: str, doc_id: str, text: str, source: str) -> DataFrame:
    return written(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), doc_hash(F.col(doc_id), seed).alias("hash")),
        "mix-sizes",
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    budget: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """How often the mix takes each document.

    Returns doc_id, source, size, source_size, target, copies, taken: one row
    for each input row, of which ``copies`` whole repeats are taken. A source
    whose target is k whole times its words plus a rest gives every document k
    times, and once more those under the source's hash threshold for the rest;
    since a target is at most ``most`` times its source, copies never exceed
    ceil(most). Words taken miss the target by less than one document.

    Defined results: null text has size 0; null sources form one source, ranked
    last; rows that share an id share a hash and are taken alike; an empty table
    gives no rows; a document without words is taken k times and adds nothing.
    """
    sized = _sized(docs, seed, doc_id, text, source)
    plan = _plan(sized, weights, budget, most)
    copies = (F.col("whole") + (F.col("hash") <= F.col("threshold")).cast("long")).alias("copies")
    return (
        sized.alias("d")
        .join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
        .select("d.doc_id", "d.source", "size", "source_size", "target", copies)
        .withColumn("taken", F.col("size") * F.col("copies"))
    )


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), budget: float = 1.5, most: float = 2.0, seed: str = "mix", doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents, with all their columns, each as many times as mix() takes it.

    Text doesn't move: a row's source and hash decide its copies.

    Defined results: as mix() has them; so documents without words are taken as
    often as their source is taken whole, repeated rows are taken alike, equal
    hashes together or not at all; no documents give none; other columns of any
    name stay.
    """
    plan = _plan(_sized(docs, seed, doc_id, text, source), weights, budget, most)
    plan = plan.select(F.col("source").alias("mix__source"), "whole", "threshold").withColumnsRenamed({"whole": "mix__whole", "threshold": "mix__threshold"})
    copies = (F.col("mix__whole") + (doc_hash(F.col(doc_id), seed) <= F.col("mix__threshold")).cast("long")).cast("int")
    rows = docs.join(plan, F.col(source).eqNullSafe(F.col("mix__source")))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.array_repeat(F.lit(0), copies)).alias("mix__copy")).select([F.col(f"`{c}`") for c in docs.columns])

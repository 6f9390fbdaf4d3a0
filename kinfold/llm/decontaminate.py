"""Benchmark decontamination by item-sized windows (operator 2). DataFrame functions only.

A window of an item's size is contaminated by it if the weighted Jaccard
similarity of their word shingles, weight being how often a shingle occurs, is
at least ``similarity``. Such a window holds shingles of the item, and the one
that starts at its first such shingle is at least as similar. So for each size m
that items have, windows of m shingles are taken that start at a shingle of some
item of that size and hold as many of such items' shingles as a match needs.
Equal windows are one shape, which gets a 64-bit SimHash.

Fingerprints within ``radius`` bits of an item's agree with it in at least one
of radius + 1 blocks, so an equality join on (size, block, bits) finds the items
that a shape may match; those within the radius are held against it exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import possibly_in, temporary, written

WORD_GAP = r"[^\p{L}\p{N}]+"
#: Item shingles up to which their table is sent to every executor: 32 MB, as a row is two longs and their head.
BROADCAST_ROWS = 1 << 20
BITS = 64


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_GAP, -1), "")


def shingle_hashes(word_hashes: Column, k: int) -> Column:
    """Hashes of all runs of k words, in order; none if there are fewer words."""
    run = lambda i: F.xxhash64(*[F.get(word_hashes, i + j) for j in range(k)])
    return F.when(F.size(word_hashes) >= k, F.transform(F.sequence(F.lit(0), F.size(word_hashes) - k), run)).otherwise(F.array().cast("array<bigint>"))


def simhash(hashes: Column) -> Column:
    """Bit b is 1 if more than half of the shingles, with their repeats, have it."""
    ones = lambda b: F.aggregate(hashes, F.lit(0), lambda n, h: n + F.call_function("shiftright", h, b).bitwiseAND(F.lit(1).cast("bigint")).cast("int"))
    bit = lambda b: F.when(ones(b) * 2 > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint"))
    return F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), bit), F.lit(0).cast("bigint"), lambda a, x: a.bitwiseOR(x))


def blocks(fingerprint: Column, radius: int) -> Column:
    """radius + 1 blocks of the fingerprint: pairs (number, bits)."""
    n = min(radius + 1, BITS)
    edges = [BITS * i // n for i in range(n + 1)]
    cut = [F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("bigint")) if b - a < BITS else fingerprint for a, b in zip(edges, edges[1:], strict=False)]
    return F.array(*[F.struct(F.lit(i).alias("block"), x.alias("bits")) for i, x in enumerate(cut)])


def _shapes_hash(window: Column) -> Column:
    """128 bits of a window's shingles in order."""
    return F.struct(F.xxhash64(window).alias("x"), F.xxhash64(F.lit(7), window).alias("y"))


def _fewest(size: Column, m: Column, similarity: float) -> Column:
    """How many shingles a window has to share with an item of m."""
    return F.ceil(F.lit(similarity) * (size + m) / F.lit(1 + similarity) - 1e-9)


def _starts(shingled: DataFrame, grams: DataFrame, similarity: float) -> DataFrame:
    """row, m, pos: the windows of ``shingled`` (row, s) that hold enough shingles of items of size m, the first of them being one."""
    every = shingled.select("row", F.size("s").alias("n"), F.posexplode_outer("s").alias("pos", "h"))
    hits = every.join(F.broadcast(grams) if grams.count() <= BROADCAST_ROWS else grams, "h")
    placed = hits.groupBy("row", "m").agg(F.max("n").alias("n"), F.array_sort(F.collect_set("pos")).alias("at"))

    def enough(p: Column, i: Column) -> Column:
        fewest = _fewest(F.least(F.col("m"), F.col("n") - p), F.col("m"), similarity).cast("int")
        return F.coalesce(F.get("at", i + fewest - 1) < p + F.col("m"), F.lit(False))

    return placed.select("row", "m", F.explode(F.filter("at", enough)).alias("pos"))


def near_shapes(shapes: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """fingerprint, m, item_id, hamming: which items of a shape's size have fingerprints within the radius. Blocks find them."""
    prints = shapes.select("m", "fingerprint").distinct()
    ours = prints.select("m", "fingerprint", F.explode(blocks(F.col("fingerprint"), radius)).alias("b")).select("m", "fingerprint", "b.*")
    theirs = items.select("m", "item_id", "of_item", F.explode(blocks(F.col("of_item"), radius)).alias("b")).select("m", "item_id", "of_item", "b.*")
    distance = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("of_item"))).cast("int")
    met = ours.join(theirs, ["m", "block", "bits"]).withColumn("hamming", distance).filter(F.col("hamming") <= radius)
    return met.select("m", "fingerprint", "item_id", "hamming").distinct()


def _matches(docs: DataFrame, items: DataFrame, k: int, similarity: float, radius: int) -> DataFrame:
    """Matches of items whose shingles have k words. items: item_id, hashes, m; docs: row, doc_id, text."""
    grams = items.select("m", F.explode("hashes").alias("h")).distinct()

    def shingled(rows: DataFrame) -> DataFrame:
        hashed = rows.select("row", "doc_id", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("w"))
        return hashed.select("row", "doc_id", shingle_hashes(F.col("w"), k).alias("s"))

    # posexplode_outer: for posexplode the optimizer would infer a filter on s, push it below and work out s twice.
    starts = written(_starts(shingled(docs), written(grams, "grams"), similarity), "starts")
    some = shingled(possibly_in(docs, F.col("row"), starts, "row")).join(starts, "row")
    windows = some.select("row", "doc_id", "m", "pos", F.slice("s", F.col("pos") + 1, F.col("m")).alias("window"))
    windows = written(windows.withColumn("shape", _shapes_hash(F.col("window"))), "windows")
    shapes = windows.groupBy("m", "shape").agg(F.first("window").alias("window"))
    shapes = written(shapes.withColumn("fingerprint", simhash(F.col("window"))), "shapes")
    near = near_shapes(shapes, items.withColumn("of_item", simhash(F.col("hashes"))), radius)
    candidates = shapes.join(near, ["m", "fingerprint"])
    counts = candidates.select("m", "shape", "item_id", "hamming", F.size("window").alias("size"), F.explode("window").alias("h"))
    counts = counts.groupBy("m", "shape", "item_id", "hamming", "size", "h").agg(F.count("*").alias("here"))
    there = items.select("item_id", F.explode("hashes").alias("h")).groupBy("item_id", "h").agg(F.count("*").alias("there"))
    both = counts.join(there, ["item_id", "h"]).groupBy("m", "shape", "item_id", "hamming", "size").agg(F.sum(F.least("here", "there")).alias("both"))
    like = both.withColumn("similarity", F.col("both") / (F.col("size") + F.col("m") - F.col("both"))).filter(F.col("similarity") >= similarity)
    scored = windows.select("row", "doc_id", "m", "pos", "shape").join(like.select("m", "shape", "item_id", "similarity", "hamming"), ["m", "shape"])
    best = scored.groupBy("row", "doc_id", "item_id").agg(F.min(F.struct((-F.col("similarity")).alias("minus"), "pos", "hamming")).alias("best"))
    return best.select("row", "doc_id", "item_id", F.col("best.pos").cast("long").alias("word"), (-F.col("best.minus")).alias("similarity"), F.col("best.hamming").alias("hamming"))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    words_per_shingle: int = 5,
    similarity: float = 0.8,
    radius: int = 20,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """doc_id, item_id, word, similarity, hamming: the best window of each document and item that match.

    ``word`` is the index of the window's first word. Words are lower-cased runs
    of letters and digits; an item of fewer words than a shingle is one shingle.
    A window at the end of a text may be shorter than the item.

    The items' shingles go to every executor only while there are at most
    BROADCAST_ROWS of them, else hits are found by a shuffled join; windows with
    enough hits are then cut from the documents that have any. At this similarity
    a window's fingerprint lies some ten bits off, so the radius has to be wide
    and its blocks are three bits: they rule out 6 % of unrelated items of a
    window's size, the distance nearly all others. At the default radius a
    SimHash misses, of 10,000 windows at the very
    edge of the similarity (by the binomial model, exact for even and independent
    bits): 1.0 with 16 of 18 shingles shared and 2.3 with 40 of 45; at the end of
    a text, where windows are shorter than the item, 7.6 for 12 of 15 shingles,
    the worst for items of 11 or more, and 51.8 for 4 of 5, the worst of all.

    Defined results: null and empty texts and items without words match nothing;
    whole texts of any length are searched; rows that share a document id are
    judged each and reported once, at their best window; of windows that match an
    item equally well the first is reported; repeated rows are reported once; of
    items that share an id each text counts; null ids are kept and reported as
    null; empty tables give no rows; other columns of any name don't matter.
    """
    with temporary():
        docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("row", F.xxhash64("doc_id", "text"))
        listed = benchmark.select(F.col(item_id).alias("public"), words(F.col(item_text)).alias("words")).filter(F.size("words") > 0).distinct()
        listed = written(listed.withColumn("item_id", F.xxhash64("public", "words")), "items")
        k = F.least(F.size("words"), F.lit(words_per_shingle))
        found = None
        for (n,) in sorted(listed.select(k.alias("k")).distinct().collect()):
            some = listed.filter(k == n).select("item_id", shingle_hashes(F.transform("words", lambda w: F.xxhash64(w)), n).alias("hashes"))
            some = written(some.withColumn("m", F.size("hashes")), "item-shingles")
            one = _matches(docs, some, n, similarity, radius)
            found = one if found is None else found.unionByName(one)
        if found is None:
            none = docs.filter(F.lit(False)).select("doc_id", F.lit(None).cast(listed.schema["public"].dataType).alias("item_id"))
            return none.select("doc_id", "item_id", F.lit(0).cast("long").alias("word"), F.lit(0.0).alias("similarity"), F.lit(0).alias("hamming"))
        named = found.join(listed.select("item_id", "public"), "item_id")
        best = named.groupBy("doc_id", "public").agg(F.min(F.struct((-F.col("similarity")).alias("minus"), "word", "hamming")).alias("best"))
        out = best.select("doc_id", F.col("public").alias("item_id"), F.col("best.word").alias("word"), (-F.col("best.minus")).alias("similarity"), F.col("best.hamming").alias("hamming"))
        return written(out, "contaminated", keep=True)


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns, of which no window matches an item.

    Defined results: as contaminated() has them; so null and empty texts stay,
    rows that share an id with a contaminated one go, and no documents give none.
    """
    key = options.get("doc_id", "doc_id")
    bad = contaminated(docs, benchmark, **options).select(F.col("doc_id").alias("contaminated__id")).distinct()
    return docs.join(bad, F.col(key).eqNullSafe(F.col("contaminated__id")), "left_anti")

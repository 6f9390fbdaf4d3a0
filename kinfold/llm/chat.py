"""Reply trees as training conversations (operator 7). DataFrame functions only.

A message names its parent. Ancestor tables at distances 1, 2, 4, ... come from
joining the table with itself until no message has an ancestor that far, so a
tree of depth d takes about log2(d) rounds, each of the messages that still have
one. They give each leaf its score, and
in falling order of distance they enumerate the chosen leaves' paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

#: The template. A turn is OPEN, role, MIDDLE, text, CLOSE.
OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
#: What texts and roles show in place of control strings, applied in this order and undone in the reverse.
ESCAPES = (("\\", "\\s"), ("</turn>", "\\e"), ("### ", "\\h"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))


def _replaced(c: Column, pairs) -> Column:
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def escaped(c: Column, pairs=ESCAPES) -> Column:
    return _replaced(c, pairs)


def unescaped(c: Column, pairs=ESCAPES) -> Column:
    return _replaced(c, [(b, a) for a, b in reversed(pairs)])


def from_turns(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Messages of plain conversations: each row answers the one before it, by turn, then role and text.

    Defined results: null roles and texts are empty; null turns come first; rows
    of null conversation are one conversation; repeated rows are turns of their
    own; an empty table gives no messages; other columns are left out.
    """
    picked = rows.select(F.col(conv_id).alias("tree"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    place = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text")).cast("long")
    numbered = picked.withColumn("message", place)
    parent = F.when(F.col("message") > 1, F.col("message") - 1)
    return numbered.select("tree", "message", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _keyed(tree: Column) -> Column:
    return F.coalesce(tree.cast("string"), F.lit("null"))


def best_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """tree, leaf, rank, depth, message: the messages on each tree's best root-to-leaf paths.

    A path's score is the sum of its messages' scores; ties go to the longer
    path, then to the smaller leaf. depth counts from the root, 0.

    Defined results: as format_trees() has them; no messages give no paths.
    """
    nodes = written(messages.select(_keyed(F.col("tree")).alias("k"), "message", "parent", F.coalesce("score", F.lit(0.0)).alias("score")).distinct(), "messages")
    known = nodes.select("k", F.col("message").alias("parent")).distinct()
    linked = written(nodes.join(known.withColumn("found", F.lit(True)), ["k", "parent"], "left"), "linked")
    level = linked.select("k", "message", F.when(F.col("found"), F.col("parent")).alias("up"), F.lit(1).cast("long").alias("length"), "score")
    levels = []
    most = max(nodes.groupBy("k").count().agg(F.max("count")).first()[0] or 0, 1)
    done = None
    while True:
        level = written(level, "ancestors")
        live, ended = level.filter("up is not null"), level.filter("up is null")
        done = ended if done is None else done.unionByName(ended)
        if not live.limit(1).count() or 1 << len(levels) > most:
            break
        levels.append(live.select("k", F.col("message").alias("at"), "up"))
        far = live.unionByName(done).select("k", F.col("message").alias("up"), F.col("up").alias("up2"), F.col("length").alias("l2"), F.col("score").alias("s2"))
        joined = live.join(far, ["k", "up"], "left")
        level = joined.select("k", "message", F.col("up2").alias("up"), (F.col("length") + F.coalesce("l2", F.lit(0))).alias("length"), (F.col("score") + F.coalesce("s2", F.lit(0.0))).alias("score"))
    parents = linked.filter("found").select("k", F.col("parent").alias("message")).distinct()
    leaves = done.join(parents, ["k", "message"], "left_anti")
    order = Window.partitionBy("k").orderBy(F.desc("score"), F.desc("length"), "message")
    chosen = leaves.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= branches)
    path = written(chosen.select("k", F.col("message").alias("leaf"), "rank", F.col("message").alias("at"), (F.col("length") - 1).alias("depth")), "paths")
    for i in reversed(range(len(levels))):
        higher = path.join(levels[i], ["k", "at"]).select("k", "leaf", "rank", F.col("up").alias("at"), (F.col("depth") - (1 << i)).alias("depth"))
        path = written(path.unionByName(higher), "paths")
    return path.select("k", "leaf", "rank", "depth", F.col("at").alias("message"))


def format_trees(messages: DataFrame, branches: int = 1, trained: str = "assistant") -> DataFrame:
    """tree, leaf, rank, formatted, loss: each chosen path as one conversation.

    ``loss`` lists (start, length) in code points of the formatted text: the
    escaped texts of the ``trained`` role, without markers.

    Defined results: a message whose parent isn't there is a root; messages on or
    under a circle of parents are left out; repeated rows of a message count
    once if equal, else each is shown at its place; null roles, texts and scores
    are empty and 0; null trees are one tree; an empty table gives no rows.
    """
    paths = best_paths(messages, branches)
    texts = messages.select("tree", _keyed(F.col("tree")).alias("k"), "message", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    head = F.concat(F.lit(OPEN), escaped(F.col("role"), ROLE_ESCAPES), F.lit(MIDDLE))
    turns = paths.join(texts, ["k", "message"]).select("k", "tree", "leaf", "rank", "depth", head.alias("head"), escaped(F.col("text")).alias("body"), (F.col("role") == trained).alias("trained"))
    turns = turns.withColumn("turn", F.concat("head", "body", F.lit(CLOSE)))
    before = Window.partitionBy("k", "leaf").orderBy("depth", "turn").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("start", F.coalesce(F.sum(F.length("turn")).over(before), F.lit(0)).cast("long"))
    each = F.struct("start", "turn", F.length("head").alias("lead"), F.length("body").alias("size"), "trained")
    rows = turns.groupBy("k", "leaf", "rank").agg(F.first("tree").alias("tree"), F.sort_array(F.collect_list(each)).alias("turns"))
    spans = F.transform(F.filter("turns", lambda t: t["trained"]), lambda t: F.struct((t["start"] + t["lead"]).alias("start"), t["size"].cast("long").alias("length")))
    return rows.select("tree", "leaf", "rank", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"), spans.alias("loss"))


def parsed_turns(formatted: Column) -> Column:
    """The (role, text) pairs of a formatted conversation."""
    pieces = F.filter(F.split(formatted, CLOSE, -1), lambda p: p != "")
    role = lambda p: F.substring_index(F.substring(p, F.lit(len(OPEN) + 1), F.length(p)), MIDDLE.strip(), 1)
    text = lambda p: F.substring(p, F.length(role(p)) + len(OPEN) + len(MIDDLE) + 1, F.length(p))
    return F.transform(pieces, lambda p: F.struct(unescaped(role(p), ROLE_ESCAPES).alias("role"), unescaped(text(p)).alias("text")))


def masked_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")

"""Connected components and what is built on them: merges of duplicates, repairs of clusters."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import euclidean
from ..sources.scratch import cut


IN_TASK = 1 << 18  # distinct links that one task may hold


def _labels(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The components of all links in the batches, each named by its smallest node."""
    held = list(batches)
    if not held:
        return
    links = pd.concat(held)
    names, places = np.unique(np.concatenate([links["u"].to_numpy(), links["v"].to_numpy()]), return_inverse=True)
    u, v = np.split(places.reshape(-1), 2)
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[u], label[v])
        told = label.copy()
        np.minimum.at(told, label[u], low)
        np.minimum.at(told, label[v], low)
        while not np.array_equal(told, told[told]):
            told = told[told]
        told = told[label]
        if np.array_equal(told, label):
            break
        label = told
    yield pd.DataFrame({"node": names, "component": names[label]})


def connected_components(links: DataFrame, nodes: DataFrame | None = None, a: str = "a", b: str = "b", in_task: int = IN_TASK) -> DataFrame:
    """node, component (its smallest node), for all nodes of links and of ``nodes``.

    At most ``in_task`` links, counted when they are written, are labelled in one
    task. For more, labels travel along links and jump to their label's label,
    until none changes; each round is a partial minimum by node and two joins.
    """
    both = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    once = cut(both.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    if once.count() <= in_task:
        kind = once.schema["u"].dataType.simpleString()
        labels = once.coalesce(1).mapInPandas(_labels, f"node {kind}, component {kind}")
        if nodes is not None:
            labels = nodes.select("node").distinct().join(labels, "node", "full").select("node", F.coalesce("component", "node").alias("component"))
        return cut(labels)
    edges = cut(once.unionByName(once.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    every = edges.select(F.col("u").alias("node"))
    if nodes is not None:
        every = every.unionByName(nodes.select("node"))
    labels = cut(every.distinct().withColumn("component", F.col("node")))
    while True:
        told = edges.join(labels, edges["v"] == labels["node"]).groupBy("u").agg(F.min("component").alias("told"))
        nearer = labels.join(told, labels["node"] == told["u"], "left").select("node", F.col("component").alias("was"), F.least("component", F.coalesce("told", "component")).alias("component"))
        nearer = cut(nearer)
        jump = nearer.select(F.col("node").alias("to"), F.col("component").alias("further"))
        moved = cut(nearer.join(jump, nearer["component"] == jump["to"], "left").select("node", "was", F.least("component", F.coalesce("further", "component")).alias("component")))
        labels = moved.select("node", "component")
        if not moved.filter("was <> component").limit(1).count():
            return labels


def merge_duplicates(cleaned: DataFrame, decisions: DataFrame, confidence: float = 0.7) -> DataFrame:
    """Records with is_merged, merged_from and canonical_company, the merged ones removed.

    ``decisions``: id_1, id_2, same_organization, confidence, primary_record_id,
    canonical_name, error. Those that say so surely and without error link their
    records (and the primary). Within a component they are replayed in the order
    of their ids: the primary of each becomes the root of the two groups it
    joins and names them. A component is as large as the duplicates of one
    organisation; it is the unit of work and is held in memory, one at a time.
    """
    sure = decisions.filter(F.col("same_organization") & (F.col("confidence") >= confidence) & ~F.coalesce("error", F.lit(False)))
    sure = cut(sure.select("id_1", "id_2", F.coalesce("primary_record_id", "id_1").alias("primary"), F.coalesce("canonical_name", F.lit("")).alias("name")))
    links = sure.select(F.col("id_1").alias("a"), F.col("id_2").alias("b")).unionByName(sure.select(F.col("id_1").alias("a"), F.col("primary").alias("b")))
    groups = connected_components(links, sure.select(F.col("id_1").alias("node")))
    placed = sure.join(groups, sure["id_1"] == groups["node"]).select("component", "id_1", "id_2", "primary", "name")

    def replay(rows: list[tuple[str, str, str, str]]) -> Iterator[tuple[str, str, str | None]]:
        above: dict[str, str] = {}
        names: dict[str, str] = {}

        def root(x: str) -> str:
            above.setdefault(x, x)
            while above[x] != x:
                above[x] = above[above[x]]
                x = above[x]
            return x

        for one, other, primary, name in rows:
            x, y = root(one), root(other)
            if x == y:
                names[x] = name
                continue
            top = x if primary == one else y if primary == other else primary
            above[x] = above[y] = above[top] = top
            names[top] = name
        for member in sorted(above):
            yield member, root(member), names.get(root(member))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        each = (row for frame in frames for row in frame.itertuples(index=False, name=None))
        done: list[tuple] = []
        for _, rows in groupby(each, key=lambda row: row[0]):
            done.extend(replay([row[1:] for row in rows]))
            if len(done) > 10000:
                yield pd.DataFrame(done, columns=["member", "root", "canonical"])
                done = []
        yield pd.DataFrame(done, columns=["member", "root", "canonical"])

    ordered = placed.repartition("component").sortWithinPartitions("component", "id_1", "id_2")
    members = cut(ordered.mapInPandas(run, "member string, root string, canonical string"))
    sets = members.groupBy("root").agg(F.array_sort(F.collect_list("member")).alias("merged_from"), F.first("canonical").alias("canonical")).filter(F.size("merged_from") > 1)
    present = cleaned.select(F.col("record_id").alias("root"))
    sets = sets.join(present, "root", "left_semi")
    gone = members.filter("member <> root").join(sets.select("root"), "root", "left_semi").select(F.col("member").alias("record_id"))
    kept = cleaned.join(gone, "record_id", "left_anti").join(sets.withColumnRenamed("root", "record_id"), "record_id", "left")
    return (
        kept.withColumn("is_merged", F.col("merged_from").isNotNull())
        .withColumn("merged_from", F.coalesce("merged_from", F.array().cast("array<string>")))
        .withColumn("canonical_company", F.coalesce("canonical", "company_clean"))
        .drop("canonical")
    )


def near_pairs(points: DataFrame, eps: float, key: str = "node", vector: str = "x", dims: int = 3) -> DataFrame:
    """a, b, distance: pairs of points at most eps apart, each once with a < b.

    Points meet in cells of side eps on the first ``dims`` dimensions: one side
    goes to its cell, the other to the cells around it, and an equality join on
    the cell replaces a join by distance.
    """
    cell = lambda i: F.floor(F.get(F.col(vector), F.lit(i)) / F.lit(float(eps)))
    cells = [F.coalesce(cell(i), F.lit(0)).alias(f"c{i}") for i in range(dims)]
    own = points.select(F.col(key).alias("a"), F.col(vector).alias("x"), *cells)
    around = points.select(F.col(key).alias("b"), F.col(vector).alias("y"), *cells)
    for i in range(dims):
        around = around.withColumn(f"c{i}", F.explode(F.sequence(F.col(f"c{i}") - 1, F.col(f"c{i}") + 1)))
    met = own.join(around, [f"c{i}" for i in range(dims)]).filter("a < b").withColumn("distance", euclidean(F.col("x"), F.col("y")))
    return met.filter(F.col("distance") <= eps).select("a", "b", "distance")


def violations(points: DataFrame, threshold: float, label: str = "cluster_id", dims: int = 3) -> DataFrame:
    """Pairs of points of different clusters (noise aside) at most ``threshold`` apart."""
    real = points.filter(F.col(label) != -1)
    pairs = near_pairs(real, threshold, dims=dims)
    a = real.select(F.col("node").alias("a"), F.col(label).alias("cluster_a"))
    b = real.select(F.col("node").alias("b"), F.col(label).alias("cluster_b"))
    return pairs.join(a, "a").join(b, "b").filter("cluster_a <> cluster_b")


def merged_clusters(points: DataFrame, threshold: float, label: str = "cluster_id", dims: int = 3) -> DataFrame:
    """node, cluster_id: clusters with points at most ``threshold`` apart become one, named as the largest (smallest id on ties)."""
    pairs = violations(points, threshold, label, dims).select(F.col("cluster_a").alias("a"), F.col("cluster_b").alias("b")).distinct()
    sizes = points.filter(F.col(label) != -1).groupBy(F.col(label).alias("node")).count()
    groups = connected_components(pairs, sizes.select("node"))
    ranked = groups.join(sizes, "node")
    name = F.first("node").over(Window.partitionBy("component").orderBy(F.desc("count"), "node").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    names = ranked.select("node", name.alias("name")).withColumnRenamed("node", "old")
    return points.join(names, points[label] == names["old"], "left").select("node", F.coalesce("name", F.col(label)).alias("cluster_id"))

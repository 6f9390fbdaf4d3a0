"""Connected components of a link table, by alternating stars; nothing is gathered on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import temporary, written


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the smallest node reachable, for every node of a link to another one.

    Each round hangs every node's larger neighbours, then its smaller ones, on
    its smallest neighbour; it ends when the edges no longer change, after about
    log2 of the longest path rounds. Groups are reduced by partial minima and
    joined back, never collected. Rounds are written to the shared folder.

    Links of a node to itself and repeated links don't matter; null ends are
    ignored; no links give no rows.
    """
    with temporary():
        edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct()
        edges = written(edges, "links", keep=True)
        mark = _mark(edges)
        while mark[0]:
            edges = written(_small(_large(edges)), "links", keep=True)
            if mark == (mark := _mark(edges)):
                break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node reachable from each of the nodes 0 to n - 1 by links (a, b), in memory."""
    label = np.arange(n)
    while len(a):
        x, y = label[a], label[b]
        least = np.minimum(x, y)
        np.minimum.at(label, x, least)
        np.minimum.at(label, y, least)
        while (label != (label := label[label])).any():
            pass
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label

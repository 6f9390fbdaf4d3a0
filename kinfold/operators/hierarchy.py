"""Splitting large clusters until none is over a size, level by level.

A level sends the rows of large clusters only, grouped by cluster, to functions
over arrays; a cluster to be split is the unit of work. Policies depend on sizes
and depths, never on the clock.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import cut
from .dbscan import dbscan, dbscan_in_memory, partitions
from .graph import merged_clusters, near_pairs
from .linalg import adaptive_eps, neighbour_percentile
from .ranks import global_rank

SEED = 42
BOOSTED, CLOSE = 5000.0, 0.85
#: Rows of a cluster up to which one task compares all its pairs; larger ones are joined by cells.
IN_TASK = 20000
#: What rounding may change of a square of distances, as a share, and more; distances to centres that are held at once.
SLACK, MEET = 1e-6, 1 << 18


@dataclass
class SplitConfig:
    """What governs a hierarchy. strategies: names in order of preference, or None for the order by size."""

    max_size: int = 50
    max_depth: int = 20
    eps: float = 0.1
    min_samples: int = 2
    domain_first: bool = True
    strategies: tuple[str, ...] | None = None
    domain_column: int | None = None
    compat_depth0: bool = False


@dataclass
class SplitResult:
    labels: DataFrame
    levels: list[dict] = field(default_factory=list)


def scaled(x: np.ndarray) -> np.ndarray:
    """Columns less their means by their population deviations, constant ones 0."""
    dev = x.std(0)
    return np.where(dev > 0, (x - x.mean(0)) / np.where(dev > 0, dev, 1), 0.0)


def principal(x: np.ndarray, k: int) -> np.ndarray:
    k = max(1, min(k, x.shape[1], len(x) - 1))
    centred = x - x.mean(0)
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    return centred @ axes[:k].T


def _spread_seeds(x: np.ndarray, k: int, first: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """k rows, each the farthest from those before it (the first such row), and the rows nearest to each.

    A seed takes rows only from seeds nearer to it than twice the distance of their farthest row.
    """
    centres, members = x[[first] * k], [np.arange(len(x))]
    nearest = ((x - x[first]) ** 2).sum(1)
    far, radius = np.full(k, len(x)), np.full(k, -1.0)
    far[0] = np.argmax(nearest)
    radius[0] = nearest[far[0]]
    for i in range(1, k):
        centres[i] = x[far[radius == radius.max()].min()]
        taken = []
        for j in np.flatnonzero(((centres[:i] - centres[i]) ** 2).sum(1) <= 4 * radius[:i] * (1 + SLACK)):
            rows = members[j]
            square = ((x[rows] - centres[i]) ** 2).sum(1)
            nearer = square < nearest[rows]
            if nearer.any():
                nearest[rows[nearer]] = square[nearer]
                taken.append(rows[nearer])
                members[j] = rows[~nearer]
                far[j], radius[j] = len(x), -1.0
                if len(members[j]):
                    far[j] = members[j][np.argmax(nearest[members[j]])]
                    radius[j] = nearest[far[j]]
        members.append(np.sort(np.concatenate(taken)))
        far[i] = members[i][np.argmax(nearest[members[i]])]
        radius[i] = nearest[far[i]]
    return centres, members


def _nearest_centres(x: np.ndarray, centres: np.ndarray, members: list[np.ndarray]) -> np.ndarray:
    """The first of the nearest centres of each row. members: rows that lie near each centre.

    Rows of a centre meet the centres within twice the distance of the farthest
    of them, which no nearer one can be beyond, in slices of bounded size.
    """
    squares, sizes = (x * x).sum(1), (centres * centres).sum(1)
    if len(x) * len(centres) <= MEET:
        return np.argmin(squares[:, None] - 2 * x @ centres.T + sizes, axis=1)
    found = np.zeros(len(x), int)
    axis = int(np.argmax(np.ptp(centres, axis=0)))
    order = np.argsort(centres[:, axis])
    line = centres[order, axis]
    for j, rows in enumerate(members):
        if not len(rows):
            continue
        reach = 4 * ((x[rows] - centres[j]) ** 2).sum(1).max() * (1 + SLACK) + SLACK**2
        at = centres[j, axis]
        near = np.sort(order[np.searchsorted(line, at - reach**0.5) : np.searchsorted(line, at + reach**0.5, "right")])
        near = near[((centres[near] - centres[j]) ** 2).sum(1) <= reach]
        step = max(1, MEET // len(near))
        for i in range(0, len(rows), step):
            some = rows[i : i + step]
            found[some] = near[np.argmin(squares[some, None] - 2 * x[some] @ centres[near].T + sizes[near], axis=1)]
    return found


def kmeans(x: np.ndarray, k: int, steps: int = 50) -> np.ndarray:
    """Lloyd's method from spread-out seeds, the same on every run; distances of all rows to all centres are neither held nor all taken."""
    rng = np.random.default_rng(SEED)
    k = min(k, len(np.unique(x, axis=0)))
    centres, members = _spread_seeds(x, k, int(rng.integers(len(x))))
    labels = np.zeros(len(x), int)
    for _ in range(steps):
        new = _nearest_centres(x, centres, members)
        if (new == labels).all() and _:
            break
        labels = new
        members = np.split(np.argsort(labels, kind="stable"), np.cumsum(np.bincount(labels, minlength=k))[:-1])
        centres = np.vstack([x[rows].mean(0) if len(rows) else centres[j] for j, rows in enumerate(members)])
    return labels


def kth_distances(x: np.ndarray, k: int) -> np.ndarray:
    """All rows' distances to the k-th nearest row, the row itself being the first; in slices of bounded size."""
    squares = (x * x).sum(1)
    step = max(1, (8 << 20) // (8 * len(x)))
    kth = [np.partition(squares[i : i + step, None] - 2 * x[i : i + step] @ x.T + squares, k - 1, axis=1)[:, k - 1] for i in range(0, len(x), step)]
    return np.sqrt(np.maximum(np.concatenate(kth), 0))


def neighbour_statistic(x: np.ndarray, ratio: float = 0.1, percentile: float = 60.0) -> float:
    """The percentile of all rows' distances to the k-th nearest row."""
    n = len(x)
    k = int(np.clip(int(ratio * n), 2, 10))
    return 0.1 if n < k else float(np.percentile(kth_distances(x, k), percentile))


def domain_groups(x: np.ndarray, column: int) -> np.ndarray | None:
    """A group for each distinct high value of the domain column, in their order; the rest is the last group."""
    value = x[:, column]
    high = value.max()
    if high >= BOOSTED or (value >= CLOSE * high).sum() < 2 or high <= 0:
        return None
    near = value >= CLOSE * high
    names, of = np.unique(value[near], return_inverse=True)
    labels = np.full(len(x), len(names))
    labels[near] = of
    return labels


def split_by_domain(x: np.ndarray, column: int, depth: int) -> np.ndarray | None:
    """domain_groups() with the rest as several groups by K-means if it is large."""
    labels = domain_groups(x, column)
    if labels is None:
        return None
    first = labels[x[:, column] >= CLOSE * x[:, column].max()].max() + 1
    rest = np.flatnonzero(labels == first)
    target = max(50, 200 // (depth + 1))
    if len(rest) > target:
        labels[rest] = first + kmeans(principal(scaled(x[rest]), 3), max(2, len(rest) // target))
    return labels


def _fast_kmeans(x, depth, c):
    return kmeans(principal(scaled(x), 5), int(np.clip(len(x) // 150, 2, 50))), 0.0


def _smart_dbscan(x, depth, c):
    y = scaled(x)
    eps = adaptive_eps(c.eps, len(x), depth, neighbour_statistic(y), float(y.var())) * 0.8**depth
    for factor in (1.0, 0.7, 0.5, 0.3):
        labels = dbscan_in_memory(y, eps * factor, max(2, c.min_samples - min(depth, 2)))
        if labels.max() >= 1:
            return labels, eps * factor
    return None


def _aggressive_pca(x, depth, c):
    y = principal(scaled(x), 2)
    for factor in (0.1, 0.05, 0.03, 0.01):
        labels = dbscan_in_memory(y, c.eps * 0.5**depth * factor, 2)
        if labels.max() >= 1:
            return labels, c.eps * 0.5**depth * factor
    return None


def _forced_pca(x, depth, c):
    y = principal(scaled(x), 3)
    for factor in (0.05, 0.03, 0.01):
        labels = dbscan_in_memory(y, c.eps * factor, 2)
        if labels.max() >= 1:
            return labels, c.eps * factor
    return None


def _adaptive_dbscan(x, depth, c):
    y = scaled(x)
    eps = adaptive_eps(c.eps, len(x), depth, neighbour_statistic(y), float(y.var()))
    for radius in (eps, 0.8 * eps, 0.6 * eps, 0.3 * c.eps):
        labels = dbscan_in_memory(y, radius, max(2, c.min_samples - 1))
        if labels.max() >= 1:
            return labels, radius
    return None


def jittered(x: np.ndarray, scale: float = 1e-8) -> np.ndarray:
    """Rows without any variance, moved apart by noise of the scale, the same on every run; others as they are."""
    return x if (x.var(0) > 1e-12).any() else x + np.random.default_rng(SEED).normal(0, scale, x.shape)


def explaining(x: np.ndarray, share: float) -> np.ndarray:
    """The fewest principal components that explain the share of the variance."""
    centred = x - x.mean(0)
    _, sizes, axes = np.linalg.svd(centred, full_matrices=False)
    told = np.cumsum(sizes**2) / max(float((sizes**2).sum()), 1e-300)
    return centred @ axes[: int(np.searchsorted(told, share - 1e-12)) + 1].T


def _recursive_pca_dbscan(x, depth, c):
    y = scaled(jittered(x))
    if min(len(y) - 1, y.shape[1]) > 1:
        y = explaining(y, 0.95)
    eps = float(np.median(kth_distances(y, 4))) * max(0.3, 0.7 - 0.1 * depth) if len(y) > 4 else 0.1
    labels = dbscan_in_memory(y, max(eps, 1e-9), max(2, min(c.min_samples, len(x) // 10)))
    return (labels, max(eps, 1e-9)) if labels.max() >= 1 else None


def _varied_dbscan(x, depth, c):
    """Rows as they are, by a radius of their own; larger clusters and deeper levels ask for fewer neighbours."""
    varied = bool((x.var(0) > 1e-12).any())
    y = explaining(scaled(x), 0.9) if varied and x.shape[1] > 2 else x
    eps = adaptive_eps(c.eps, len(x), depth, neighbour_statistic(y) if varied else None, float(varied))
    fewer = 2 if len(x) > 1000 else 1 if len(x) > 100 else 0
    labels = dbscan_in_memory(x, eps, max(2, max(2, c.min_samples - fewer) - depth))
    return (labels, eps) if labels.max() >= 1 else None


def _force(x, depth, c):
    target = max(50, 200 // (depth + 1)) if c.max_size >= 50 else c.max_size
    return kmeans(principal(scaled(x), 3), max(2, len(x) // target)), 0.0


def _tiered_kmeans(x, depth, c):
    return kmeans(principal(scaled(x), 5), int(np.clip(len(x) // (100 if len(x) < 1000 else 150 if len(x) < 5000 else 200), 2, 50))), 0.0


#: Functions give labels and the radius they were made with, 0 if by none; or None.
#: name: (least size, least depth, function, most size)
STRATEGIES = {
    "fast_kmeans": (1000, 0, _fast_kmeans, None),
    "smart_dbscan": (50, 0, _smart_dbscan, 5000),
    "aggressive_pca": (500, 3, _aggressive_pca, None),
    "force": (2, 0, _force, None),
    "adaptive_dbscan": (50, 0, _adaptive_dbscan, None),
    "forced_pca": (500, 0, _forced_pca, None),
    "tiered_kmeans": (200, 0, _tiered_kmeans, None),
    "pca_dbscan": (10, 0, _recursive_pca_dbscan, None),
    "varied_dbscan": (10, 0, _varied_dbscan, None),
}
ADAPTIVE = ("fast_kmeans", "smart_dbscan", "aggressive_pca", "force")
FIXED_DEPTH = ("adaptive_dbscan", "forced_pca", "tiered_kmeans", "force")
RECURSIVE = ("pca_dbscan", "force")
#: The recursion without a last resort: a cluster that density can't split stays whole.
VARIED = ("varied_dbscan",)


def hint(size: int, depth: int) -> str | None:
    """The strategy to try first for a size at a depth."""
    if size > 10000:
        return "force"
    if size > 5000:
        return "fast_kmeans"
    if size > 2000 and depth > 3:
        return "aggressive_pca"
    return "fast_kmeans" if size > 1000 and depth > 5 else None


def split_with_radius(x: np.ndarray, depth: int, config: SplitConfig) -> tuple[np.ndarray, str, float]:
    """Labels of a cluster's rows, the strategy that made them and its radius: domains, then the hint (if no order is given), then the order."""
    depth = 0 if config.compat_depth0 else depth
    if config.domain_first and config.domain_column is not None:
        labels = split_by_domain(x, config.domain_column, depth)
        if labels is not None and len(np.unique(labels)) > 1:
            return labels, "domain_first", 0.0
    names = list(config.strategies or ADAPTIVE)
    if not config.strategies and (first := hint(len(x), depth)) in names:
        names.insert(0, names.pop(names.index(first)))
    for name in names:
        least, deep, run, most = STRATEGIES[name]
        if len(x) >= least and depth >= deep and (most is None or len(x) <= most):
            made = run(x, depth, config)
            if made is not None and len(np.unique(made[0])) > 1:
                return made[0], name, made[1]
    return np.zeros(len(x), int), "none", 0.0


def split(x: np.ndarray, depth: int, config: SplitConfig) -> tuple[np.ndarray, str]:
    """Labels of a cluster's rows and the strategy that made them."""
    return split_with_radius(x, depth, config)[:2]


def _splits(rows: DataFrame, depth: int, config: SplitConfig) -> DataFrame:
    """node, parent, part, strategy of the rows (node, x, cluster_id): a cluster is split in one task, as one array, a cluster at a time."""
    dealt = rows.select("cluster_id", "node", "x").repartition(partitions(rows), "cluster_id").sortWithinPartitions("cluster_id", "node")

    def run(batches):
        pieces = (batch.slice(i, j - i) for batch in batches if len(batch) for i, j in _runs(batch.column("cluster_id").to_numpy()))
        made, n = [], 0
        for parent, own in groupby(pieces, key=lambda piece: piece.column("cluster_id")[0].as_py()):
            table = pa.Table.from_batches(own)
            x = np.concatenate([c.flatten().to_numpy(zero_copy_only=False).astype(float) for c in table.column("x").chunks]).reshape(len(table), -1)
            parts, name = split(x, depth, config)
            made.append((table.column("node"), parent, parts, name))
            n += len(table)
            if n >= 10000:
                yield _batch(made)
                made, n = [], 0
        if made:
            yield _batch(made)

    return dealt.mapInArrow(run, f"node {dict(rows.dtypes)['node']}, parent long, part long, strategy string")


def _runs(ids: np.ndarray) -> list[tuple[int, int]]:
    """(first, end) of the runs of equal ids."""
    starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    return list(zip(starts.tolist(), [*starts[1:].tolist(), len(ids)], strict=True))


def _batch(made: list[tuple]) -> pa.RecordBatch:
    """The rows of several clusters: (nodes, parent, parts, strategy) of each."""
    sizes = [len(parts) for _, _, parts, _ in made]
    repeated = lambda values: values.take(pa.array(np.repeat(np.arange(len(made)), sizes)))
    nodes = pa.concat_arrays([c for column, *_ in made for c in column.chunks])
    parts = pa.array(np.concatenate([parts for _, _, parts, _ in made]).astype("int64"))
    return pa.RecordBatch.from_arrays([nodes, repeated(pa.array([m[1] for m in made], pa.int64())), parts, repeated(pa.array([m[3] for m in made], pa.string()))], names=["node", "parent", "part", "strategy"])


def subdivide(points: DataFrame, labels: DataFrame, config: SplitConfig, key: str = "node", vector: str = "x") -> SplitResult:
    """Split clusters over max_size, level by level, until none is, none can be, or max_depth.

    New ids come after the largest id in the order of parents and parts; noise
    of a split keeps its parent's id, whose rest is tried again. A cluster that
    can't be split is final.
    """
    current = cut(points.select(F.col(key).alias("node"), F.col(vector).alias("x")).join(labels.select("node", "cluster_id"), "node").withColumn("final", F.lit(False)))
    levels: list[dict] = []
    for depth in range(config.max_depth):
        sizes = current.filter("cluster_id <> -1 and not final").groupBy("cluster_id").count().filter(F.col("count") > config.max_size)
        sizes = cut(sizes)
        large = sizes.count()
        if not large:
            break

        todo = current.join(F.broadcast(sizes.select("cluster_id")), "cluster_id")
        made = cut(_splits(todo, depth, config))
        top = current.agg(F.max("cluster_id")).first()[0]
        names = global_rank(made.filter("part >= 0 and strategy <> 'none'").select("parent", "part").distinct(), ["parent", "part"], "nth")
        fresh = made.join(names, ["parent", "part"], "left").select("node", F.when(F.col("nth").isNotNull(), F.col("nth") + top + 1).alias("new"), (F.col("strategy") == "none").alias("stuck"))
        current = cut(current.join(fresh, "node", "left").select("node", "x", F.coalesce("new", "cluster_id").alias("cluster_id"), (F.col("final") | F.coalesce("stuck", F.lit(False))).alias("final")))
        used = {r[0]: r[1] for r in made.groupBy("strategy").agg(F.countDistinct("parent")).collect()}
        levels.append({"depth": depth, "large": large, "strategies": used})
        if set(used) == {"none"}:
            break
    return SplitResult(current.select("node", "cluster_id"), levels)


def adaptive_threshold(depth: int, base: float = 2.0, high: float = 1.0) -> float:
    """Distance under which clusters are held together: from ``high`` to ``base`` with depth, never under ``high``."""
    share = 0.3 if depth <= 2 else 0.6 if depth <= 4 else 1.0
    return max(high, high + (base - high) * share)


def _near_slices(x: np.ndarray, threshold: float):
    """(first row, which rows are at most threshold from it and those after it), in slices of bounded size."""
    squares = (x * x).sum(1)
    step = max(1, (8 << 20) // (8 * max(1, len(x))))
    for i in range(0, len(x), step):
        yield i, squares[i : i + step, None] + squares - 2 * x[i : i + step] @ x.T <= threshold * threshold + 1e-12


def broken_pairs(x: np.ndarray, labels: np.ndarray, threshold: float) -> int:
    """Pairs of rows of different labels (noise aside) at most threshold apart."""
    x, labels = x[labels != -1], labels[labels != -1]
    return sum(int((near & (labels[i : i + len(near), None] != labels)).sum()) for i, near in _near_slices(x, threshold)) // 2


def joined(x: np.ndarray, labels: np.ndarray, threshold: float) -> np.ndarray:
    """Labels with rows at most threshold apart become one, named as the largest (smallest label on ties); noise stays."""
    rows = np.flatnonzero(labels != -1)
    names, at, sizes = np.unique(labels[rows], return_inverse=True, return_counts=True)
    meets = np.eye(len(names), dtype=bool)
    for i, near in _near_slices(x[rows], threshold):
        for j, row in enumerate(near):
            meets[at[i + j], at[row]] = True
    meets |= meets.T
    group = np.full(len(names), -1)
    for first in np.lexsort((names, -sizes)):
        front = [first] if group[first] < 0 else []
        while front:
            group[front] = first
            front = np.flatnonzero(meets[front].any(0) & (group < 0))
            front = list(front)
    out = labels.copy()
    out[rows] = names[group[at]]
    return out


def repaired(x: np.ndarray, labels: np.ndarray, eps: float, threshold: float, high: float, min_samples: int) -> tuple[np.ndarray, int, str]:
    """Labels of a split, the pairs that it broke and the repair: clusters of a radius half as large again, kept if fewer pairs are broken, else what ``high`` connects is joined."""
    broken = broken_pairs(x, labels, threshold)
    if not broken:
        return labels, 0, "none"
    if (wider := min(1.5 * eps, threshold)) > eps:
        again = dbscan_in_memory(x, wider, min_samples)
        if broken_pairs(x, again, threshold) < broken:
            return np.where(again >= 0, again + 1, -1), broken, "wider"
    return joined(x, labels, high), broken, "joined"


def _apart(placed: DataFrame, threshold: float, dims: int) -> int:
    """broken_pairs of a table of node, x, part; equal vectors of a part count at once."""
    one = cut(placed.filter("part <> -1").groupBy("x", "part").agg(F.min("node").alias("node"), F.count("*").alias("n")))
    side = lambda c: one.select(F.col("node").alias(c), F.col("part").alias(f"part_{c}"), F.col("n").alias(f"n_{c}"))
    met = near_pairs(one, threshold, dims=dims).join(side("a"), "a").join(side("b"), "b").filter("part_a <> part_b")
    return met.agg(F.coalesce(F.sum(F.col("n_a") * F.col("n_b")), F.lit(0))).first()[0]


def _table_scaled(rows: DataFrame, width: int) -> DataFrame:
    """scaled() of a table of node, x."""
    at = [F.get("x", F.lit(i)) for i in range(width)]
    stats = rows.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(at) for n, f in (("m", F.avg), ("d", F.stddev_pop))]).first()
    return cut(rows.select("node", F.array(*[(c - F.lit(stats[f"m{i}"])) / F.lit(stats[f"d{i}"]) if stats[f"d{i}"] > 0 else F.lit(0.0) for i, c in enumerate(at)]).alias("x")))


def _table_adaptive_dbscan(y: DataFrame, n: int, width: int, c: SplitConfig, dims: int):
    """The points (node, x), radii and least neighbours of _adaptive_dbscan for a table of scaled rows."""
    k = int(np.clip(int(0.1 * n), 2, 10))
    at = [F.get("x", F.lit(i)) for i in range(width)]
    variance = sum(y.agg(*[F.var_pop(a) for a in at]).first()) / width
    most = 2 * c.eps / (0.9 * min(1.5, 1 + np.log10(n / 1000)))  # beyond it adaptive_eps gives its largest radius
    eps = adaptive_eps(c.eps, n, 0, neighbour_percentile(y, k, 60.0, 0.05 * c.eps, float(most), dims), variance)
    return y, (eps, 0.8 * eps, 0.6 * eps, 0.3 * c.eps), max(2, c.min_samples - 1)


def _table_forced_pca(y: DataFrame, n: int, width: int, c: SplitConfig, dims: int):
    """The same of _forced_pca: axes of the covariances, which are all that is sent to the driver."""
    pairs = [(i, j) for i in range(width) for j in range(i + 1)]
    row = y.agg(*[F.avg(F.get("x", F.lit(i)) * F.get("x", F.lit(j))) for i, j in pairs]).first()
    shared = np.zeros((width, width))
    for (i, j), v in zip(pairs, row, strict=True):
        shared[i, j] = shared[j, i] = v
    axes = np.linalg.eigh(shared)[1][:, ::-1][:, : min(3, width)]
    turned = [sum((F.get("x", F.lit(i)) * F.lit(float(axes[i, j])) for i in range(width)), F.lit(0.0)) for j in range(axes.shape[1])]
    return cut(y.select("node", F.array(*turned).alias("x"))), tuple(c.eps * f for f in (0.05, 0.03, 0.01)), 2


#: Strategies by density as plans over a table, for clusters of more than IN_TASK rows.
BY_TABLE = {"adaptive_dbscan": _table_adaptive_dbscan, "forced_pca": _table_forced_pca}


def _split_table(rows: DataFrame, n: int, threshold: float, high: float, config: SplitConfig, dims: int) -> DataFrame:
    """What _level gives, for one cluster of n rows (node, x, cluster_id): radii and comparisons of pairs as joins by cells.

    Strategies that aren't in BY_TABLE still take the cluster in one task.
    """
    width, parent = len(rows.first()["x"]), rows.first()["cluster_id"]
    y, parts, name, eps = _table_scaled(rows, width), None, "none", 0.0
    for name in config.strategies:
        least, deep, _, most = STRATEGIES[name]
        if deep > 0 or n < least or (most is not None and n > most):
            continue
        if name in BY_TABLE:
            points, radii, fewest = BY_TABLE[name](y, n, width, config, dims)
            for eps in radii:
                found = cut(dbscan(points, eps, fewest, dims=dims))
                if found.agg(F.coalesce(F.max("cluster_id"), F.lit(-1))).first()[0] >= 1:
                    parts = found
                    break
        else:
            one, eps = SplitConfig(**{**config.__dict__, "strategies": (name,), "domain_first": False}), 0.0
            got = cut(_splits(rows, 0, one))
            if got.filter("strategy <> 'none'").limit(1).count():
                parts = got.select("node", F.col("part").alias("cluster_id"))
        if parts is not None:
            break
    else:
        name = "none"
    broken, repair = 0, "none"
    if parts is None:
        placed = rows.select("node", F.lit(0).cast("long").alias("part"))
    else:
        placed = cut(rows.select("node", "x").join(parts.select("node", (F.col("cluster_id") + 1).alias("part")), "node"))
        broken = _apart(placed, threshold, dims)
        if broken:
            if (wider := min(1.5 * eps, threshold)) > eps:
                again = dbscan(rows, wider, config.min_samples, dims=dims)
                again = cut(rows.select("node", "x").join(again.select("node", F.when(F.col("cluster_id") >= 0, F.col("cluster_id") + 1).otherwise(F.lit(-1)).alias("part")), "node"))
                if _apart(again, threshold, dims) < broken:
                    placed, repair = again, "wider"
            if repair == "none":
                named = merged_clusters(placed.withColumnRenamed("part", "cluster_id"), high, dims=dims)
                placed, repair = cut(named.withColumnRenamed("cluster_id", "part")), "joined"
    kinds = [r[0] for r in placed.select("part").distinct().limit(2).collect()]
    whole = len(kinds) == 1 and kinds[0] != -1
    part = F.lit(0).cast("long") if whole else F.col("part").cast("long")
    return placed.select("node", F.lit(parent).cast("long").alias("parent"), part.alias("part"), F.lit(name).alias("strategy"), F.lit(broken).cast("long").alias("broken"), F.lit(repair).alias("repair"), F.lit(whole).alias("whole"))


def _level(threshold: float, high: float, config: SplitConfig):
    """Splits a cluster and repairs the split. Part 0 keeps the parent's id, -1 is noise."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        x = np.vstack(rows["x"].to_numpy()).astype(float)
        parts, name, eps = split_with_radius(x, 0, config)
        parts, broken, repair = repaired(x, parts + 1, eps, threshold, high, config.min_samples) if name != "none" else (parts, 0, "none")
        if whole := parts[0] != -1 and (parts == parts[0]).all():
            parts = np.zeros(len(x), int)
        return pd.DataFrame({"node": rows["node"], "parent": rows["cluster_id"], "part": parts.astype("int64"), "strategy": name, "broken": broken, "repair": repair, "whole": bool(whole)})

    return run


def connectivity_aware(points: DataFrame, labels: DataFrame, config: SplitConfig, base: float = 2.0, high: float = 1.0, dims: int = 3) -> SplitResult:
    """Split clusters over max_size level by level, each split repaired by itself, until max_depth, no large cluster or no split.

    Within a split cluster, pairs that the level's threshold connects but the
    split parts are counted (all of them). Clusters of a larger radius are taken
    if that leaves fewer, with their noise as noise; else parts that ``high``
    connects are joined. Noise of the split itself keeps its parent's id.
    Strategies are FIXED_DEPTH unless given and see depth 0 on every level. A cluster that comes back whole is
    tried again only under a larger threshold, as the same would come of it.
    Clusters of more than IN_TASK rows are split and repaired by joins.
    """
    config = SplitConfig(**{**config.__dict__, "strategies": config.strategies or FIXED_DEPTH})
    current = cut(points.select("node", "x").join(labels.select("node", "cluster_id"), "node").withColumn("whole", F.lit(None).cast("double")))
    kind = dict(current.dtypes)["node"]
    made_as = f"node {kind}, parent long, part long, strategy string, broken long, repair string, whole boolean"
    levels: list[dict] = []
    for depth in range(config.max_depth):
        threshold = adaptive_threshold(depth + 1, base, high)
        sizes = current.filter((F.col("cluster_id") != -1) & (F.col("whole").isNull() | (F.col("whole") < threshold))).groupBy("cluster_id").count()
        sizes = cut(sizes.filter(F.col("count") > config.max_size))
        large = sizes.count()
        if not large:
            if threshold < adaptive_threshold(config.max_depth, base, high):
                continue
            break
        todo = current.join(F.broadcast(sizes.select("cluster_id")), "cluster_id").select("node", "x", "cluster_id")
        huge = sizes.filter(F.col("count") > IN_TASK).collect()
        ids = [r["cluster_id"] for r in huge]
        made = (todo.filter(~F.col("cluster_id").isin(ids)) if ids else todo).groupBy("cluster_id").applyInPandas(_level(threshold, high, config), made_as)
        for r in huge:
            made = made.unionByName(_split_table(todo.filter(F.col("cluster_id") == r["cluster_id"]), r["count"], threshold, high, config, dims))
        made = cut(made)
        top = current.agg(F.max("cluster_id")).first()[0]
        names = global_rank(made.filter("part > 0").select("parent", "part").distinct(), ["parent", "part"], "nth")
        named = F.when(F.col("part") == 0, F.col("parent")).when(F.col("part") == -1, F.lit(-1)).otherwise(F.col("nth") + top + 1)
        until = F.when(F.col("strategy") == "none", F.lit(float("inf"))).when(F.col("whole"), F.lit(threshold))
        fresh = made.join(names, ["parent", "part"], "left").select("node", named.alias("new"), until.alias("until"))
        current = cut(current.join(fresh, "node", "left").select("node", "x", F.coalesce("new", "cluster_id").alias("cluster_id"), F.when(F.col("new").isNull(), F.col("whole")).otherwise(F.col("until")).alias("whole")))
        each = made.groupBy("parent").agg(F.first("strategy").alias("strategy"), F.first("broken").alias("broken"), F.first("repair").alias("repair"))
        told = each.groupBy("strategy", "repair").agg(F.count("*").alias("n"), F.sum("broken").alias("broken")).collect()
        total = lambda column: {v: sum(r.n for r in told if r[column] == v) for v in {r[column] for r in told}}
        levels.append({"depth": depth, "large": large, "violations": sum(r.broken for r in told), "strategies": total("strategy"), "repairs": total("repair")})
    return SplitResult(current.select("node", "cluster_id"), levels)

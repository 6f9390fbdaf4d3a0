import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.operators import dbscan, hierarchy, linalg


def frame(spark, x, labels):
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node long, x array<double>")
    return points, spark.createDataFrame([(i, int(c)) for i, c in enumerate(labels)], "node long, cluster_id long")


def test_repairs_stay_within_a_cluster(spark):
    """A violation in one cluster ends neither the splitting of others nor the levels."""
    rng = np.random.default_rng(2)
    x = np.vstack([np.linspace(0, 1, 40)[:, None] * [1, 1], rng.uniform(0, 90, (300, 2)) + 1000])
    points, labels = frame(spark, x, np.repeat([0, 1], [40, 300]))
    config = hierarchy.SplitConfig(max_size=15, max_depth=6, strategies=("force",), domain_first=False)
    result = hierarchy.connectivity_aware(points, labels, config, base=0.2, high=0.1, dims=2)
    got = {r.node: r.cluster_id for r in result.labels.collect()}
    assert {got[i] for i in range(40)} == {0}
    assert max(np.unique([got[i] for i in range(40, 340)], return_counts=True)[1]) <= 15
    assert len(result.levels) > 1 and result.levels[0]["violations"] > 0


def test_repair_is_kept_only_if_it_breaks_fewer():
    x = np.array([[0.0], [1.0], [2.2], [3.2], [9.0], [10.0]])
    labels = np.array([1, 1, 2, 2, 3, 3])
    wide, broken, how = hierarchy.repaired(x, labels, 1.1, 1.5, 0.5, 2)
    assert (wide.tolist(), broken, how) == ([1, 1, 1, 1, 2, 2], 1, "wider")
    assert hierarchy.repaired(x, labels, 0.0, 1.5, 0.5, 2)[2] == "joined"
    assert hierarchy.repaired(x, labels, 0.0, 1.5, 1.3, 2)[0].tolist() == [1, 1, 1, 1, 3, 3]
    assert hierarchy.repaired(x, labels, 1.0, 1.1, 1.0, 2) == (pytest.approx(labels), 0, "none")


def test_broken_pairs_and_joins_against_brute_force():
    rng = np.random.default_rng(4)
    x, labels = rng.random((200, 3)), rng.integers(-1, 6, 200)
    near = [(i, j) for i in range(200) for j in range(i) if np.linalg.norm(x[i] - x[j]) <= 0.1 and labels[i] != labels[j] and -1 not in (labels[i], labels[j])]
    assert hierarchy.broken_pairs(x, labels, 0.1) == len(near) > 0
    got = hierarchy.joined(x, labels, 0.1)
    assert all(got[i] == got[j] for i, j in near) and ((got == -1) == (labels == -1)).all()


def test_neighbour_statistic_is_of_all_rows():
    """Rows whose ids follow the data: the first 2000 are a dense region."""
    rng = np.random.default_rng(6)
    x = np.vstack([rng.normal(0, 0.01, (2000, 2)), rng.uniform(-5, 5, (2500, 2))])
    got = hierarchy.neighbour_statistic(x)
    want = np.percentile([np.sort(np.linalg.norm(x - row, axis=1))[9] for row in x], 60)
    assert got == pytest.approx(want) and hierarchy.neighbour_statistic(x[::-1]) == pytest.approx(got)


def test_size_does_not_change_the_kind_of_split(spark):
    """adaptive_dbscan has no upper limit and no hint goes before a given order."""
    assert hierarchy.STRATEGIES["adaptive_dbscan"][3] is None
    rng = np.random.default_rng(8)
    x = np.vstack([np.repeat(rng.uniform(0, 1, (40, 2)), 290, axis=0)])
    config = hierarchy.SplitConfig(strategies=hierarchy.FIXED_DEPTH, domain_first=False)
    assert len(x) > 10000 and hierarchy.split(x, 0, config)[1] == "adaptive_dbscan"


def test_clusters_beyond_a_task_are_split_alike(spark, monkeypatch):
    rng = np.random.default_rng(9)
    x = np.round(np.vstack([rng.normal(c, 0.05, (60, 2)) for c in ((0, 0), (3, 1), (0.3, 4))] + [rng.uniform(-1, 5, (40, 2)), np.zeros((5, 2))]), 6)
    points, labels = frame(spark, x, np.zeros(len(x)))
    config = hierarchy.SplitConfig(max_size=100, max_depth=1, strategies=("adaptive_dbscan",), domain_first=False)
    runs = []
    for most in (20000, 100):
        monkeypatch.setattr(hierarchy, "IN_TASK", most)
        result = hierarchy.connectivity_aware(points, labels, config, base=2.0, high=0.3, dims=2)
        runs.append(({r.node: r.cluster_id for r in result.labels.collect()}, result.levels))
    (a, told_a), (b, told_b) = runs
    assert told_a == told_b and told_a[0]["strategies"] == {"adaptive_dbscan": 1}
    assert len({(a[i], b[i]) for i in a}) == len(set(a.values())) == len(set(b.values())) > 1


def test_neighbour_percentile(spark):
    rng = np.random.default_rng(6)
    x = np.round(np.vstack([rng.normal(0, 0.01, (60, 2)), rng.uniform(-5, 5, (90, 2)), np.zeros((7, 2))]), 6)
    points, _ = frame(spark, x, np.zeros(len(x)))
    assert linalg.neighbour_percentile(points, 10, 60.0, 0.01, 20.0, 2) == pytest.approx(hierarchy.neighbour_statistic(x))
    assert linalg.neighbour_percentile(points, 10, 60.0, 0.01, 0.02, 2) == 0.02


def test_fixed_depth_splits_by_pca_what_dbscan_cannot(spark, monkeypatch):
    """500 pairs on a line, nearer to each other than DBSCAN's least radius."""
    x = np.column_stack([np.repeat(np.arange(500.0), 2), np.zeros(1000)])
    config = hierarchy.SplitConfig(max_depth=1, strategies=hierarchy.FIXED_DEPTH, domain_first=False)
    labels, name = hierarchy.split(x, 0, config)
    assert name == "forced_pca" and len(np.unique(labels)) == 500
    points, one = frame(spark, x, np.zeros(1000))
    y = hierarchy._table_scaled(points, 2)
    turned, radii, fewest = hierarchy._table_forced_pca(y, 1000, 2, config, 2)
    got = {r.node: r.x for r in turned.collect()}
    want = hierarchy.principal(hierarchy.scaled(x), 3)
    assert np.allclose(np.abs([got[i] for i in range(1000)]), np.abs(want)) and radii == pytest.approx((0.005, 0.003, 0.001)) and fewest == 2
    result = hierarchy.connectivity_aware(points, one, hierarchy.SplitConfig(max_depth=1), base=0.5, high=0.4, dims=2)
    assert result.levels[0]["strategies"] == {"forced_pca": 1}


def test_auto_eps_samples_the_curve_and_not_the_neighbours(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(0, 1, (1500, 2)), 6)
    points, _ = frame(spark, x, np.zeros(len(x)))
    asked = [r.node for r in points.orderBy(F.xxhash64("node"), "node").limit(100).collect()]
    want = linalg.knee([np.sort(np.linalg.norm(x - x[i], axis=1))[3] for i in asked])
    assert dbscan.auto_eps(points, sample=100) == pytest.approx(want)
    few = points.filter("node < 3")
    assert dbscan.auto_eps(few) == 0.0 and dbscan.auto_eps(points.filter("node < 0")) == 0.0


def plain_kmeans(x, k, steps=50):
    """Lloyd's method by all distances of all rows to all centres."""
    k = min(k, len(np.unique(x, axis=0)))
    centres = x[[int(np.random.default_rng(hierarchy.SEED).integers(len(x)))]]
    while len(centres) < k:
        centres = np.vstack([centres, x[np.argmax(((x[:, None] - centres) ** 2).sum(2).min(1))]])
    labels = np.zeros(len(x), int)
    for step in range(steps):
        new = np.argmin((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), axis=1)
        if step and (new == labels).all():
            break
        labels = new
        centres = np.vstack([x[labels == j].mean(0) if (labels == j).any() else centres[j] for j in range(k)])
    return labels


@pytest.mark.parametrize("meet", [1, 1 << 18])
def test_kmeans_against_all_distances(monkeypatch, meet):
    """With meet 1, rows meet near centres only, one by one; rows with ties, which rounding decides, as in one table."""
    monkeypatch.setattr(hierarchy, "MEET", meet, raising=False)
    rng = np.random.default_rng(3)
    line = np.column_stack([np.arange(400) * 0.001, np.zeros(400)])
    tied = [np.round(rng.normal(size=(400, 2)), 1), rng.integers(0, 4, (300, 2)) / 3, line]
    for x in (rng.normal(size=(400, 3)), np.zeros((40, 2)), np.vstack([rng.normal(size=(200, 2)), [[900.0, 900.0]]]), *(tied if meet > 1 else [])):
        for k in (1, 2, 30, 120):
            assert (hierarchy.kmeans(x, k) == plain_kmeans(x, k)).all()


def test_kmeans_of_many_rows_and_centres_holds_no_table_of_both():
    """20,000 rows and 1300 centres: a table of their distances is 208 MB, the old way held several."""
    x = np.random.default_rng(7).random((20000, 3))
    tracemalloc.start()
    labels = hierarchy.kmeans(x, 1300, steps=2)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 50e6 and len(np.unique(labels)) == 1300


def test_clusters_reach_the_split_in_order_and_whole(spark):
    """Clusters of few and of many rows, over several batches, with rows of a cluster dealt apart; text keys go by code point."""
    rng = np.random.default_rng(12)
    sizes = [25000, 40, 16, 300, 1]
    of = rng.permutation(np.repeat(np.arange(len(sizes)), sizes))
    x = np.round(rng.normal(size=(len(of), 2)) * 10, 6)
    rows = [(f"{'é' if i % 3 else 'Z'}{i}", v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, of, strict=True))]
    df = spark.createDataFrame(rows, "node string, x array<double>, cluster_id long").repartition(5)
    config = hierarchy.SplitConfig(strategies=("force",), domain_first=False)
    made = hierarchy._splits(df, 0, config)
    got = {r.node: (r.parent, r.part, r.strategy) for r in made.collect()}
    assert len(got) == len(rows)
    for c in range(len(sizes)):
        own = sorted((r[0], i) for i, r in enumerate(rows) if r[2] == c)
        parts, name = hierarchy.split(x[[i for _, i in own]], 0, config)
        assert [got[n] for n, _ in own] == [(c, int(p), name) for p in parts]
    assert hierarchy._splits(df.limit(0), 0, config).count() == 0

"""Operators that no SQL twin covers, against plain versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.functions import normalize
from kinfold.operators import blocking, decide, hierarchy, linalg, model, preprocess, quality, ranks, report
from kinfold.plans import pipeline
from kinfold.sources import tables


def test_domains_and_white_space(spark):
    values = ["\tacme.com\n", "acme.com\n", " https://www.Acme.com/x ", " acme.com　", "acme.com\n/x", "me@acme.com\r\n", "acme", "\x1facme.com\x85", None, ""]
    got = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", normalize.domain(F.col("v")).alias("d")).orderBy("i").collect()
    assert [r.d for r in got] == ["acme.com"] * 4 + ["", "acme.com", "", "acme.com", "", ""]


def test_rows_in_the_order_of_their_files(spark, tmp_path):
    n = 0
    for name, size in (("a", 2), ("b", 50), ("c", 5)):
        lines = [f"{n + i},firm {n + i}" for i in range(size)]
        (tmp_path / f"{name}.csv").write_text("\n".join(["nr,company", *lines]) + "\n")
        n += size
    df = spark.read.option("header", True).csv(str(tmp_path))
    got = preprocess.clean(df).orderBy("row_idx").collect()
    assert [int(r.nr) for r in got] == list(range(57)) and [r.row_idx for r in got] == list(range(57))
    made = preprocess.in_file_order(spark.createDataFrame([(i,) for i in range(9)], "x int"), "n").orderBy("n").collect()
    assert [r.x for r in made] == list(range(9))


def test_global_rank(spark):
    df = spark.createDataFrame([(i * 37 % 101, None if i % 7 == 0 else i) for i in range(101)], "a int, b int").repartition(5)
    got = ranks.global_rank(df, ["b", "a"]).collect()
    want = sorted(((r.a, r.b) for r in got), key=lambda t: (t[1] is not None, t[1] or 0, t[0]))
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.rank)] == want and {r.rank for r in got} == set(range(101))
    assert ranks.global_rank(df.limit(0), ["a"]).count() == 0


@pytest.mark.parametrize("share", [1, 7, 1000])
def test_hot_keys_lose_no_pair(spark, monkeypatch, share):
    monkeypatch.setattr(blocking, "SHARE", share)
    rows = [(str(i), i, "hot" if i % 3 else f"k{i % 4}", None if i % 5 == 0 else "", f"name {i % 6}") for i in range(60)]
    df = spark.createDataFrame(rows, "record_id string, row_idx long, phone_clean string, domain_clean string, company_clean string")
    got = [(r.row_idx_1, r.row_idx_2) for r in blocking.block(df, "phone_clean").collect()]
    want = [(i, j) for j in range(60) for i in range(j) if rows[i][2] == rows[j][2]]
    assert sorted(got) == sorted(want)
    near = {(i, j) for j in range(60) for i in range(j) if rows[i][2] == rows[j][2] or abs(i % 6 - j % 6) <= 2}
    assert sorted((r.row_idx_1, r.row_idx_2) for r in blocking.candidate_pairs(df).collect()) == sorted(near)
    assert blocking.block(df, "domain_clean").count() == 0
    with pytest.raises(ValueError):
        blocking.candidate_pairs(df, blocking.BlockingConfig(False, False, False, False))


def test_first_rows_of_blank_keys(spark):
    rows = [(i, str(i), "" if i % 2 else f"c{i % 6}", None if i % 3 else f"d{i % 4}", "") for i in range(40)]
    df = spark.createDataFrame(rows, "row_idx long, record_id string, company_clean string, domain_clean string, phone_clean string")
    kept, removed = preprocess.keep_first(df)
    first = {}
    for r in rows:
        first.setdefault((r[2], r[3] or ""), r[0])
    assert sorted(r.row_idx for r in kept.collect()) == sorted(first.values()) and removed.count() == 40 - len(first)
    kept, removed = preprocess.keep_first_either(df)
    companies, domains, stay = set(), set(), []
    for i, _, c, d, _ in rows:
        if not (c and c in companies) and not (d and d in domains):
            stay.append(i)
        companies.add(c)
        domains.add(d)
    got = kept.collect()
    assert sorted(r.row_idx for r in got) == stay and removed.count() == 40 - len(stay)
    up = {i: i for i in range(40)}

    def root(x):
        return x if up[x] == x else root(up[x])

    for j, b in enumerate(rows):
        for i, a in enumerate(rows[:j]):
            if (a[2] and a[2] == b[2]) or (a[3] and a[3] == b[3]):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    assert all(r.merged_ids == ";".join(str(i) for i in range(40) if root(i) == root(r.row_idx)) for r in got)


def plain_power(x):
    def bent(p):
        up = np.log1p(x) if abs(p) < 1e-9 else ((x + 1) ** p - 1) / p
        down = -np.log1p(-x) if abs(p - 2) < 1e-9 else -((1 - x) ** (2 - p) - 1) / (2 - p)
        return np.where(x >= 0, up, down)

    def likelihood(p):
        with np.errstate(all="ignore"):
            return -len(x) / 2 * math.log(bent(p).var()) + (p - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum()

    low, high, g = -20.0, 20.0, (math.sqrt(5) - 1) / 2
    grid = np.linspace(low, high, 801)
    k = int(np.argmax([likelihood(p) for p in grid]))
    low, high = grid[max(k - 1, 0)], grid[min(k + 1, 800)]
    while high - low > 1e-9:
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if likelihood(a) > likelihood(b) else (a, high)
    return (low + high) / 2


def test_yeo_johnson_powers_are_the_best(spark):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.lognormal(0, 1, 400), rng.normal(0, 2, 400), -rng.lognormal(0, 0.7, 400), 1 - 0.1 * rng.lognormal(0, 1, 400), np.full(400, 4.0)])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double, d double, e double")
    got = linalg.yeo_johnson_powers(df, ["a", "b", "c", "d", "e"])
    assert got["e"] == 1.0
    for i, c in enumerate("abcd"):
        assert got[c] == pytest.approx(plain_power(x[:, i]), abs=2e-5), c


def test_recursive_splits():
    rng = np.random.default_rng(5)
    same = np.ones((60, 3))
    apart = hierarchy.jittered(same)
    assert len(np.unique(apart, axis=0)) == 60 and np.abs(apart - same).max() < 1e-6 and (hierarchy.jittered(same) == apart).all()
    x = rng.normal(0, [5, 1, 0.01], (300, 3))
    told = hierarchy.explaining(x, 0.95)
    assert told.shape[1] == 1 and hierarchy.explaining(x, 0.999).shape[1] == 2 and hierarchy.explaining(x, 1.0).shape[1] == 3
    brute = np.sort(np.linalg.norm(x[:, None] - x[None], axis=2), axis=1)[:, 3]
    assert hierarchy.kth_distances(x, 4) == pytest.approx(brute)
    assert hierarchy.STRATEGIES["pca_dbscan"][3] is None
    two = np.vstack([rng.normal(0, 0.1, (200, 2)), rng.normal(9, 0.1, (200, 2))])
    labels, how = hierarchy.split(two, 0, hierarchy.SplitConfig(strategies=hierarchy.RECURSIVE, domain_first=False))
    assert how == "pca_dbscan" and not set(labels[:200][labels[:200] >= 0]) & set(labels[200:][labels[200:] >= 0])


def test_varied_recursion():
    rng = np.random.default_rng(6)
    config = hierarchy.SplitConfig(strategies=hierarchy.VARIED, domain_first=False, eps=0.5, min_samples=4)
    two = np.vstack([rng.normal(0, 0.1, (80, 2)), rng.normal(9, 0.1, (80, 2))])
    for depth in (0, 1, 3):
        labels, how, eps = hierarchy.split_with_radius(two, depth, config)
        want = hierarchy.adaptive_eps(0.5, 160, depth, hierarchy.neighbour_statistic(two))
        assert how == "varied_dbscan" and eps == want and (labels == hierarchy.dbscan_in_memory(two, want, max(2, 3 - depth))).all()
        assert not set(labels[:80][labels[:80] >= 0]) & set(labels[80:][labels[80:] >= 0])
    assert hierarchy.split(two[:9], 0, config)[1] == "none"
    assert hierarchy.split(np.ones((60, 3)), 0, config)[1] == "none"


def test_kmeans_is_linear_in_centres():
    rng = np.random.default_rng(1)
    x = rng.uniform(0, 1, (20000, 3))
    labels = hierarchy.kmeans(x, 100, steps=2)
    assert len(np.unique(labels)) == 100


def test_prompts_are_those_of_a_judge(spark):
    rows = [(str(i), str(i + 1), f"name {i}", "other", "d.com", None, "", "", 0.6 + i / 100) for i in range(23)]
    scored = spark.createDataFrame(rows, "record_id_1 string, record_id_2 string, company_clean_1 string, company_clean_2 string, domain_clean_1 string, domain_clean_2 string, phone_clean_1 string, phone_clean_2 string, company_sim double")
    records = sorted((r.asDict() for r in decide.asked(scored).collect()), key=lambda r: (r["id_1"], r["id_2"]))
    got = [r.prompt for r in decide.pair_prompts(scored, batch=5).orderBy("batch").collect()]
    assert got == [decide.pair_prompt(records[i : i + 5]) for i in range(0, 23, 5)]
    empty = "cluster_id long, record_ids array<string>, canonical_groups array<struct<primary_organization: string, canonical_domains: array<string>, record_ids: array<string>, confidence: double>>"
    told = scored.withColumn("prob", F.col("company_sim"))
    assert report.summary(told).first().review_groups == 0 and report.summary(told, spark.createDataFrame([], empty)).first().review_available


def test_model_is_saved_and_told(spark, tmp_path):
    rows = [(str(i), str(i + 100), min(1.0, i / 40), float(i > 25), float(i > 30)) for i in range(50)]
    scored = spark.createDataFrame(rows, "record_id_1 string, record_id_2 string, company_sim double, domain_sim double, phone_exact double")
    told = model.train_and_score(scored, path=str(tmp_path / "model"))
    again = model.score(scored, model.load_model(str(tmp_path / "model")))
    key = lambda df: sorted((r.record_id_1, round(r.prob, 12)) for r in df.collect())
    assert key(again) == key(told["scored"])
    weights = {r.feature: r.weight for r in told["coefficients"].collect()}
    assert set(weights) == {"company_sim", "domain_sim", "phone_exact", "intercept"}
    row = scored.filter("record_id_1 = '33'").first()
    z = weights["intercept"] + sum(weights[c] * row[c] for c in ("company_sim", "domain_sim", "phone_exact"))
    assert told["scored"].filter("record_id_1 = '33'").first().prob == pytest.approx(1 / (1 + math.exp(-z)))
    stats = told["label_statistics"].first()
    assert stats.positive == stats.negative == stats.labels / 2 and stats.label_ratio == 0.5


def test_steps_from_stored_tables(spark, tmp_path):
    lines = ["record_id,company,domain,phone"] + [f"{i},Firm {i // 2} Inc,f{i // 2}.com,555-010-{i // 2:04d}" for i in range(40)]
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    config = lambda *steps: pipeline.PipelineConfig(str(tmp_path / "in.csv"), str(tmp_path / "out"), None, steps, log=str(tmp_path / "out/run.log"))
    assert pipeline.run_pipeline(spark, config("preprocess", "blocking")).error is None
    later = pipeline.run_pipeline(spark, config("similarity", "clustering"))
    assert later.error is None and set(later.seconds) == {"similarity", "clustering"}
    stored = spark.read.parquet(str(tmp_path / "out/agg_features.parquet"))
    assert stored.count() == 40 and "cluster_id" in stored.columns
    assert len((tmp_path / "out/run.log").read_text().splitlines()) == 4
    alone = pipeline.run_pipeline(spark, pipeline.PipelineConfig("x", str(tmp_path / "none"), steps=("similarity",)))
    assert alone.error.startswith("similarity")


def test_log_beside_tables_of_a_uri(tmp_path):
    at = f"file://{tmp_path}/deep/iteration.json"
    assert tables.current_iteration(at) == 1 and tables.next_iteration(at) == 2 == tables.current_iteration(str(tmp_path / "deep/iteration.json"))


def test_flat_statistics_with_a_silhouette(spark):
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, -1), (4, 5)], "node long, cluster_id long")
    row = quality.flat_statistics(labels, spark.createDataFrame([(0.25,)], "silhouette double"), eps=0.5).first()
    assert row.asDict() == {"eps": 0.5, "n_clusters": 2, "n_noise": 1, "silhouette_score": 0.25}

import json
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.operators import blocking, dbscan, decide, features, graph, model, pairs, preprocess, report
from kinfold.plans.pipeline import PipelineConfig, run_pipeline
from kinfold.sources import tables
from kinfold.streaming.records import write_cleaned

SAMPLE = [("1", "Acme Inc", "acme.com", "1234567890", "Street 1"), ("2", "Acme Inc", "acme.com", "1234567890", "Street 2"), ("3", "Widgets LLC", "widgets.com", "5551234", "Street 3"), ("4", "Widgets LLC", "widgets.com", "5551234", "Street 4")]
RAW = "record_id string, company string, domain string, phone string, address string"


@pytest.fixture(scope="module")
def sample(spark):
    return preprocess.clean(spark.createDataFrame(SAMPLE, RAW), F.col("record_id").cast("long")).cache()


def test_sample_goldens(spark, sample):
    counts = {k: v.count() for k, v in blocking.blocks(sample).items()}
    assert counts == {"phone": 1, "domain": 2, "company": 2, "fuzzy": 6}
    scored = pairs.features(sample, blocking.candidate_pairs(sample))
    by = {r.measure: r for r in pairs.metrics(scored).collect()}
    assert by["company_sim"].mean == pytest.approx(0.6428571428571429) and by["company_sim"].std == pytest.approx(0.2766416675862441)
    assert by["domain_sim"].std == pytest.approx(0.5163977794943223) and by["phone_exact"].mean == pytest.approx(1 / 6)
    assert by["address_sim"].mean == pytest.approx(0.875) and by["address_sim"].std == pytest.approx(0.0)
    kept, removed = preprocess.keep_first(sample)
    assert kept.count() == 2 and removed.count() == 2
    kept, _ = preprocess.keep_first_either(sample)
    assert sorted((r.combined_id, r.merged_ids) for r in kept.collect()) == [("acme;acme.com;(123) 456-7890", "1;2"), ("widgets;widgets.com;", "3;4")]


def test_boost(spark):
    scored = spark.createDataFrame([(f"a{i}", f"b{i}", 0.5, 1.0) for i in range(5)], "record_id_1 string, record_id_2 string, company_sim double, domain_sim double")
    records = spark.createDataFrame([(f"{x}{i}",) for x in "ab" for i in range(5)], "record_id string")
    got = {r.record_id: round(r.domain_sim, 3) for r in features.aggregate_v3(scored, records).collect()}
    assert [got[f"a{i}"] for i in range(5)] == [4999.0, 4999.001, 4999.002, 4999.003, 4999.004] and got["b4"] == 4999.009


def test_dbscan_against_memory(spark):
    rng = np.random.default_rng(1)
    x = np.round(np.vstack([rng.normal(c, 0.3, (40, 2)) for c in (0, 2, 5)] + [rng.uniform(-3, 8, (30, 2)), np.zeros((9, 2))]), 6)
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node long, x array<double>")
    for eps, least in ((0.3, 2), (0.4, 5)):
        got = {r.node: r.cluster_id for r in dbscan.dbscan(points, eps, least, dims=2).collect()}
        assert [got[i] for i in range(len(x))] == dbscan.dbscan_in_memory(x, eps, least).tolist()


def test_merge(spark, sample):
    told = spark.createDataFrame([("1", "2", True, 0.9, "2", "Acme", False), ("3", "4", True, 0.5, "3", "W", False), ("1", "3", True, 0.9, "1", "X", True)], decide.DECISIONS)
    got = {r.record_id: (r.is_merged, r.merged_from, r.canonical_company) for r in graph.merge_duplicates(sample, told).collect()}
    assert got == {"2": (True, ["1", "2"], "Acme"), "3": (False, [], "widgets"), "4": (False, [], "widgets")}


def test_logistic_regression_against_newton(spark):
    rng = np.random.default_rng(3)
    x = rng.random((200, 3))
    y = (x @ [2, -1, 1] + rng.normal(0, 0.3, 200) > 1).astype(int)
    df = spark.createDataFrame([(str(i), str(i), *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y, strict=True))], "record_id_1 string, record_id_2 string, company_sim double, domain_sim double, address_sim double, label int")
    w = np.zeros(4)
    z = np.column_stack([x, np.ones(200)])
    pull = np.diag([1.0, 1, 1, 0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + pull, z.T @ (p - y) + pull @ w)
    fitted = model.fit(df, ["company_sim", "domain_sim", "address_sim"])
    assert np.allclose([*fitted.coefficients, fitted.intercept], w, atol=1e-5)


def test_single_pair_is_both_labels(spark):
    scored = spark.createDataFrame([("1", "2", 0.5, 0.0)], "record_id_1 string, record_id_2 string, company_sim double, domain_sim double")
    told = model.train_and_score(scored)
    assert told["label_source"] == "heuristic" and told["scored"].first().prob == pytest.approx(0.5)


def test_answers():
    assert decide.parsed('```json\n[{"pair": 1}]\n```') == [{"pair": 1}] and decide.parsed("{}") == [] and decide.parsed("no") == []
    judge = decide.TextJudge(lambda prompt: '[{"pair": 1, "same_organization": true, "confidence": 0.9}]')
    pair = {f"{c}_{i}": "x" for c in ("id", "company", "domain", "phone") for i in (1, 2)} | {"similarity": 0.7}
    assert [a["same_organization"] for a in judge.decide([pair, pair])] == [True, False]
    assert decide.cost(1_000_000, 1_000_000) == pytest.approx(0.75)


def test_rollup(spark, tmp_path):
    reviews = [{"cluster_id": 1, "record_ids": ["a", "b"], "canonical_groups": [{"primary_organization": "A", "canonical_domains": ["a.com"], "record_ids": ["a", "b"], "confidence": 0.8}, {"primary_organization": "", "canonical_domains": [], "record_ids": ["c"], "confidence": 0.1}]}, {"cluster_id": 2, "record_ids": ["x"], "canonical_groups": []}]
    tables.write_json(reviews, str(tmp_path / "reviews.json"))
    row = report.review_rollup(tables.read_reviews(spark, str(tmp_path / "reviews.json"))).first()
    assert (row.clusters, row.processed, row.groups, row.records, row.mean_confidence, row.records_per_group) == (2, 1, 2, 2, 0.8, 1.0)


def test_files(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.read_table(spark, str(tmp_path / "x.txt"))
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "x.csv"))
    log, tracker = str(tmp_path / "logs" / "run.log"), str(tmp_path / "iteration.json")
    assert tables.current_iteration(tracker) == 1
    tables.log_run("preprocess", datetime.now(), datetime.now(), 5, log, tracker, {"a": 1})
    assert tables.current_iteration(tracker) == 2 and open(log).read().startswith("2,preprocess,")
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text("x")
    tables.clear_all_data(str(tmp_path), {"b.csv"})
    assert sorted(p.name for p in tmp_path.iterdir()) == ["b.csv", "iteration.json", "logs"]
    tables.clear_files([str(tmp_path / "b.csv"), str(tmp_path / "none")])
    assert json.loads(open(tracker).read()) == {"current_iteration": 2}


def test_pipeline(spark, tmp_path):
    lines = ["record_id,company,domain,phone,address"] + [f"{i},Firm {i // 3}{' Inc' if i % 2 else ''},f{i // 4}.com,{2005550000 + i // 5},Main {i}" for i in range(40)]
    (tmp_path / "in.csv").write_text("\n".join(lines))
    result = run_pipeline(spark, PipelineConfig(str(tmp_path / "in.csv"), str(tmp_path / "out"), log=str(tmp_path / "log.csv")))
    assert result.error is None and set(result.seconds) == {"preprocess", "blocking", "similarity", "model", "clustering", "deduplication", "reporting"}
    assert result.tables["clusters"].count() == result.tables["cleaned"].count() <= 40
    assert len(open(tmp_path / "log.csv").read().splitlines()) == 7
    assert run_pipeline(spark, PipelineConfig(str(tmp_path / "none.csv"), str(tmp_path / "out2"))).error.startswith("preprocess")


def test_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame(SAMPLE, RAW).write.parquet(source)
    write_cleaned(spark.readStream.schema(RAW).parquet(source), str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination(60)
    assert sorted(r.company_clean for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["acme", "acme", "widgets", "widgets"]

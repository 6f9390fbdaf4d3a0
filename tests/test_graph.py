import random

import pytest

from kinfold.operators import decide, graph, pairs, preprocess


def components(links, nodes):
    label = {x: x for x in {y for link in links for y in link} | set(nodes)}
    while True:
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if before == label:
            return label


@pytest.mark.parametrize("in_task", [1 << 18, 0])
def test_components_in_a_task_and_by_rounds(spark, in_task):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(400 + i, 401 + i) for i in range(60)] + [(7, 7), (7, 9), (9, 7)]
    nodes = [1, 500, 501, 400]
    linked = [(a, b) for a, b in links if a != b]
    got = graph.connected_components(spark.createDataFrame(links, "a long, b long").repartition(3), spark.createDataFrame([(n,) for n in nodes], "node long"), in_task=in_task)
    assert {r.node: r.component for r in got.collect()} == components(linked, nodes) and got.count() == len(components(linked, nodes))
    words = [(f"n{a}", f"n{b}") for a, b in linked]
    got = graph.connected_components(spark.createDataFrame(words, "a string, b string"), in_task=in_task)
    assert {r.node: r.component for r in got.collect()} == components(words, [])


@pytest.mark.parametrize("in_task", [1 << 18, 0])
def test_components_of_no_links(spark, in_task):
    none = spark.createDataFrame([(3, 3), (None, 4)], "a long, b long")
    assert graph.connected_components(none, in_task=in_task).collect() == []
    alone = graph.connected_components(none, spark.createDataFrame([(2,), (2,)], "node long"), in_task=in_task)
    assert [tuple(r) for r in alone.collect()] == [(2, 2)]


def test_merges_of_many_components_in_a_worker(spark):
    names = [(f"{i:03}", f"org {i // 3}", None, None, None) for i in range(90)]
    cleaned = preprocess.clean(spark.createDataFrame(names, "record_id string, company string, domain string, phone string, address string"))
    ids = [r.record_id for r in cleaned.orderBy("row_idx").collect()] if "row_idx" in cleaned.columns else sorted(r.record_id for r in cleaned.collect())
    told = []
    for i in range(0, 90, 3):
        a, b, c = ids[i : i + 3]
        told += [(b, c, True, 0.9, c, f"second {i}", False), (a, b, True, 0.9, a, f"first {i}", False)]
    merged = graph.merge_duplicates(cleaned, spark.createDataFrame(told, decide.DECISIONS)).collect()
    want = {}
    for i in range(0, 90, 3):
        a, b, c = ids[i : i + 3]
        want[c] = ([a, b, c], f"second {i}")
    assert {r.record_id: (r.merged_from, r.canonical_company) for r in merged} == want


class Noted:
    """The rule judge, with a line in a file for every pair it is asked about."""

    def __init__(self, path):
        self.path = path

    def decide(self, batch):
        with open(self.path, "a") as f:
            f.writelines(f"{r['id_1']} {r['id_2']}\n" for r in batch)
        return decide.RuleJudge().decide(batch)


def test_a_judge_is_asked_once_about_a_pair(spark, tmp_path):
    cleaned = preprocess.clean(spark.createDataFrame([(f"{i}", f"Acme Works {i % 4}", f"a{i % 4}.com", None, None) for i in range(12)], "record_id string, company string, domain string, phone string, address string"))
    ids = sorted(r.record_id for r in cleaned.collect())
    both = spark.createDataFrame([(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :]], "record_id_1 string, record_id_2 string")
    unique, told = decide.deduplicate(cleaned, pairs.features(cleaned, both), Noted(str(tmp_path / "asked")))
    assert unique.count() <= 12 and told.count() == told.count()
    asked = (tmp_path / "asked").read_text().splitlines()
    assert len(asked) == len(set(asked)) == told.count()

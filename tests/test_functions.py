import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.functions import normalize
from kinfold.functions.similarity import indel_ratio, jaro_winkler, token_set_ratio
from kinfold.operators import hierarchy, linalg
from kinfold.operators.dbscan import dbscan_in_memory


def test_normalizers(spark):
    rows = [("The ACME, Inc.", "HTTPS://www.Acme.com/x", "1234567890"), ("PT Astra International Tbk", "a@b.org", "+1 (200) 555-0000"), ("株式会社ソニー", "acme.com:8080", "5551234"), ("XYZ Sdn Bhd", "acme", ""), (None, None, None), ("ACME Corporation  ", "http://x.co", "12345")]
    df = normalize.fold_to_ascii(spark.createDataFrame(rows, "c string, d string, p string"), "c")
    got = df.select(normalize.company(F.col("c")), F.coalesce(normalize.domain(F.col("d")), F.lit("")), F.coalesce(normalize.phone(F.col("p")), F.lit(""))).collect()
    assert sorted(map(tuple, got)) == sorted([("acme", "acme.com", "(123) 456-7890"), ("astra international", "b.org", "1-(200) 555-0000"), ("sony", "", ""), ("xyz", "", ""), ("", "", ""), ("acme", "x.co", "")])


def test_roles():
    got = normalize.roles(["Record ID", "company", "domain", "phone", "Street", "Street Cont.", "City", "State", "Country Code"])
    assert got == {"company": "company", "domain": "domain", "phone": "phone", "address": ["Street", "Street Cont.", "City", "State"], "id": "Record ID"}
    assert normalize.roles(["x"])["company"] is None


def test_similarities():
    assert jaro_winkler("acme", "widgets") == pytest.approx(0.46428571428571425, abs=1e-15)
    assert jaro_winkler("martha", "marhta") == pytest.approx(0.9611111111111111, abs=1e-15)
    assert jaro_winkler("", "") == 0.0
    assert token_set_ratio("Street 1", "Street 2") == 0.875 and token_set_ratio("", "x") == 0.0 and token_set_ratio("a b", "b a c") == 1.0
    assert indel_ratio("abc", "abc") == 1.0 and indel_ratio("abc", "") == 0.0


def test_thresholds_and_eps():
    assert [hierarchy.adaptive_threshold(d) for d in range(1, 6)] == pytest.approx([1.3, 1.3, 1.6, 1.6, 2.0])
    assert linalg.adaptive_eps(0.1, 100, 0, 5.0) == pytest.approx(0.01) and linalg.adaptive_eps(0.1, 3) == 0.05 and linalg.adaptive_eps(0.1, 1000, 0, 0.1) == pytest.approx(0.09)
    assert linalg.adaptive_eps(0.5, 50, 2, variance=0) == pytest.approx(0.3)
    assert linalg.knee([0, 0, 0, 0, 0.1, 1]) == pytest.approx(0.1)


def test_dbscan_in_memory():
    x = np.array([[0.0], [0.1], [0.2], [5.0], [5.1], [9.0]])
    assert dbscan_in_memory(x, 0.15, 2).tolist() == [0, 0, 0, 1, 1, -1]
    assert dbscan_in_memory(x, 0.15, 3).tolist() == [0, 0, 0, -1, -1, -1]
    assert dbscan_in_memory(np.zeros((0, 2)), 1, 2).tolist() == []


def test_strategies_split_and_cover():
    rng = np.random.default_rng(0)
    for n in (60, 300, 1500):
        x = np.vstack([rng.normal(c, 0.1, (n // 3, 3)) for c in (0, 3, 9)])
        for names in (hierarchy.ADAPTIVE, hierarchy.FIXED_DEPTH, hierarchy.RECURSIVE):
            labels, name = hierarchy.split(x, 1, hierarchy.SplitConfig(strategies=names, domain_first=False))
            assert len(labels) == len(x) and len(np.unique(labels)) > 1 and name in hierarchy.STRATEGIES
    x = np.column_stack([np.r_[np.repeat([4999.0, 4999.5], 20), np.zeros(10)], rng.normal(size=50)])
    assert len(np.unique(hierarchy.split_by_domain(x, 0, 0))) == 3

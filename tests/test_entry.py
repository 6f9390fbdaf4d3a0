import __spark_entry__
from tests.conftest import SMALL


def test_names_match():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 50


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_nothing_else_imports_llm():
    import pathlib

    root = pathlib.Path(__spark_entry__.__file__).parent / "kinfold"
    for p in root.rglob("*.py"):
        if p.parent.name != "llm":
            assert "llm" not in p.read_text(), p


def test_a_query(spark):
    assert __spark_entry__.queries()["domain_scatter"](spark, SMALL).count() > 0

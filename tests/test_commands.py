import pytest

from kinfold.plans import commands


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_steps_by_command(spark, tmp_path, capsys, kind):
    rows = ["record_id,company,domain,phone,address"]
    rows += [f"{i},Acme Works {i % 8} Inc,acme{i % 8}.com,555000{i % 8:04},Street {i}" for i in range(24)]
    (tmp_path / "in.csv").write_text("\n".join(rows) + "\n")
    at = lambda name: str(tmp_path / f"{name}.{kind}")

    def run(*args):
        code = commands.main([str(a) for a in args])
        told = capsys.readouterr()
        assert code == 0, told.err
        return told.out

    assert "rows: 24" in run("preprocess", tmp_path / "in.csv", at("cleaned"), "--dedup", "none")
    assert run("blocking", at("cleaned"), at("pairs"))
    assert "company_sim" in run("similarity", at("cleaned"), at("pairs"), at("features"))
    assert run("model", at("features"), at("scored"), "--coefficients", "--duplicates", at("duplicates"))
    assert run("clustering", at("features"), at("cleaned"), at("clusters"), "--flat")
    assert "groups" in run("review", at("clusters"), tmp_path / "reviews.json")
    assert "review_groups" in run("reporting", at("scored"), at("cleaned"), tmp_path / "report", "--reviews", tmp_path / "reviews.json")
    assert "merged" in run("deduplication", at("features"), at("cleaned"), at("unique"), "--decisions", at("told"))
    kept = commands._read(spark, at("unique"))
    assert 0 < kept.count() <= 24


def test_errors_of_commands(spark, tmp_path, capsys):
    assert commands.main(["blocking", str(tmp_path / "none.parquet"), str(tmp_path / "pairs.parquet")]) == 1
    assert "none.parquet" in capsys.readouterr().err
    with pytest.raises(SystemExit) as e:
        commands.main(["nothing"])
    assert e.value.code == 2

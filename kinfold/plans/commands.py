"""One command a step, over named tables: python -m kinfold.plans.commands COMMAND ...

Tables are Parquet folders or, by their name, CSV folders. Each command writes
its table, then prints the step's statistics as lines of name and value.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocking, decide, model, pairs, preprocess, quality, report
from ..operators.hierarchy import SplitConfig
from ..sources.scratch import cut
from ..sources.tables import read_reviews, read_table, write_table
from .pipeline import cluster_records

#: What a CSV table holds as text and the steps need as numbers.
NUMBERS = {"company_sim": "double", "domain_sim": "double", "phone_exact": "double", "address_sim": "double", "prob": "double", "cluster_id": "long", "row_idx": "long", "label": "int"}


def lines(stats: DataFrame, most: int = 50) -> list[str]:
    """A statistics table as text: of one row a line a column, else a line a row, of the first ``most``."""
    rows = [r.asDict() for r in stats.limit(most).collect()]
    shown = lambda v: f"{v:.4f}" if isinstance(v, float) else "-" if v is None else str(v)
    if len(rows) == 1:
        return [f"{k}: {shown(v)}" for k, v in rows[0].items()]
    return [", ".join(f"{k}: {shown(v)}" for k, v in r.items()) for r in rows]


def _read(spark: SparkSession, path: str) -> DataFrame:
    table = read_table(spark, path)
    return table.withColumns({c: F.col(c).cast(NUMBERS[c]) for c, kind in table.dtypes if kind == "string" and c in NUMBERS})


def _stored(spark: SparkSession, table: DataFrame, path: str) -> DataFrame:
    write_table(table, path)
    return _read(spark, path)


def _preprocess(spark, a):
    cleaned = cut(preprocess.clean(read_table(spark, a.input)))
    stats = preprocess.statistics(cleaned)
    if a.dedup != "none":
        cleaned, removed = (preprocess.keep_first if a.dedup == "composite" else preprocess.keep_first_either)(cleaned)
        if a.removed:
            write_table(removed, a.removed)
    _stored(spark, cleaned, a.output)
    return [stats]


def _blocking(spark, a):
    cleaned = _read(spark, a.cleaned)
    _stored(spark, blocking.candidate_pairs(cleaned), a.output)
    return [blocking.statistics(cleaned)]


def _similarity(spark, a):
    cleaned = _read(spark, a.cleaned)
    for column in pairs.missing_columns(cleaned):
        print(f"missing column: {column}", file=sys.stderr)
    return [pairs.metrics(_stored(spark, pairs.features(cleaned, _read(spark, a.pairs)), a.output))]


def _model(spark, a):
    made = model.train_and_score(_read(spark, a.features), _read(spark, a.labels) if a.labels else None, a.threshold, a.model)
    scored = _stored(spark, made["scored"], a.output)
    if a.duplicates:
        write_table(model.high_confidence(scored, a.threshold), a.duplicates)
    return [made["label_statistics"], model.score_statistics(scored), *([made["coefficients"]] if a.coefficients else [])]


def _clustering(spark, a):
    split = SplitConfig(max_size=a.max_cluster_size, max_depth=a.max_depth, eps=a.eps, min_samples=a.min_samples)
    scored = _read(spark, a.features)
    labels = cut(cluster_records(scored, _read(spark, a.cleaned), None if a.auto_eps else a.eps, a.min_samples, not a.flat, not a.fixed_depth, split))
    rescued = quality.rescue_noise(labels, scored).withColumnRenamed("cluster_id", "rescued")
    told = _stored(spark, labels.join(rescued, "record_id").drop("cluster_id").withColumnRenamed("rescued", "cluster_id"), a.output)
    return [quality.cluster_statistics(told), quality.size_distribution(told)]


def _reporting(spark, a):
    scored = _read(spark, a.scored)
    reviews = read_reviews(spark, a.reviews) if a.reviews else None
    report.write_report(scored, _read(spark, a.cleaned), a.output, reviews=reviews)
    return [report.band_statistics(scored), report.summary(scored, reviews)]


def _review(spark, a):
    reviews = decide.review_clusters(_read(spark, a.clusters), exclude=a.exclude, noise=a.noise, least=a.min_size, most=a.max_size, sample=a.sample)
    reviews.write.mode("overwrite").json(a.output)
    return [report.review_rollup(read_reviews(spark, a.output))]


def _deduplication(spark, a):
    unique, told = decide.deduplicate(_read(spark, a.cleaned), _read(spark, a.features), least=a.similarity, confidence=a.confidence)
    _stored(spark, unique, a.output)
    if a.decisions:
        write_table(told, a.decisions)
    return [decide.decision_summary(told)]


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="kinfold")
    steps = out.add_subparsers(dest="command", required=True)

    def step(name: str, run, *tables: str) -> argparse.ArgumentParser:
        made = steps.add_parser(name)
        made.set_defaults(run=run)
        for table in tables:
            made.add_argument(table)
        return made

    p = step("preprocess", _preprocess, "input", "output")
    p.add_argument("--dedup", choices=["composite", "either", "none"], default="composite")
    p.add_argument("--removed")
    step("blocking", _blocking, "cleaned", "output")
    step("similarity", _similarity, "cleaned", "pairs", "output")
    p = step("model", _model, "features", "output")
    p.add_argument("--labels")
    p.add_argument("--model")
    p.add_argument("--duplicates")
    p.add_argument("--threshold", type=float, default=0.9)
    p.add_argument("--coefficients", action="store_true")
    p = step("clustering", _clustering, "features", "cleaned", "output")
    p.add_argument("--eps", type=float, default=0.1)
    p.add_argument("--min-samples", type=int, default=2)
    p.add_argument("--max-cluster-size", type=int, default=50)
    p.add_argument("--max-depth", type=int, default=20)
    p.add_argument("--auto-eps", action="store_true")
    p.add_argument("--flat", action="store_true")
    p.add_argument("--fixed-depth", action="store_true")
    p = step("reporting", _reporting, "scored", "cleaned", "output")
    p.add_argument("--reviews")
    p = step("review", _review, "clusters", "output")
    p.add_argument("--exclude", type=int, nargs="*", default=[])
    p.add_argument("--noise", action="store_true")
    p.add_argument("--min-size", type=int, default=2)
    p.add_argument("--max-size", type=int)
    p.add_argument("--sample", type=int)
    p = step("deduplication", _deduplication, "features", "cleaned", "output")
    p.add_argument("--decisions")
    p.add_argument("--similarity", type=float, default=0.6)
    p.add_argument("--confidence", type=float, default=0.7)
    return out


def main(args: list[str] | None = None) -> int:
    """Exit 0 if the step ran, 1 for an error, 130 for an interrupt."""
    a = parser().parse_args(args)
    try:
        spark = SparkSession.builder.appName("kinfold").getOrCreate()
        for stats in a.run(spark, a):
            print("\n".join(lines(stats)))
    except KeyboardInterrupt:
        return 130
    except Exception as e:  # noqa: BLE001  a command tells its error
        print(f"{a.command}: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())

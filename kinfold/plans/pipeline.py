"""The whole run: clean, block, compare, score, cluster, decide, report."""

from __future__ import annotations

import argparse
import sys
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocking, decide, features, linalg, model, pairs, preprocess, quality, report
from ..operators.dbscan import auto_eps, dbscan
from ..operators.hierarchy import SplitConfig, connectivity_aware, subdivide
from ..sources.scratch import cut
from ..sources.tables import log_run, read_table, write_table

V3 = ["company_sim", "domain_sim", "company_domain_product", "company_domain_sum", "domain_priority", "domain_dominance"]
STEPS = ("preprocess", "blocking", "similarity", "model", "clustering", "deduplication", "reporting")


@dataclass
class PipelineConfig:
    input_path: str
    output_dir: str
    dedup: str | None = "composite"
    steps: tuple[str, ...] = STEPS
    blocking: blocking.BlockingConfig = field(default_factory=blocking.BlockingConfig)
    threshold: float = 0.9
    eps: float | None = 0.1
    min_samples: int = 2
    hierarchical: bool = True
    adaptive: bool = True
    split: SplitConfig = field(default_factory=SplitConfig)
    log: str | None = None
    tracker: str | None = None


@dataclass
class PipelineResult:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    error: str | None = None


class Stored(dict):
    """Tables by name; one that no step has made yet is read."""

    def __init__(self, read):
        super().__init__()
        self.read = read

    def __missing__(self, name):
        self[name] = self.read(name)
        return self[name]


def vectors(table: DataFrame, columns: list[str], key: str = "record_id") -> DataFrame:
    """node, x: standardized columns as arrays."""
    scaled = linalg.standard_scale(table, columns)
    return scaled.select(F.col(key).alias("node"), F.array(*columns).alias("x"))


def cluster_records(scored: DataFrame, cleaned: DataFrame, eps: float | None = 0.1, min_samples: int = 2, hierarchical: bool = True, adaptive: bool = True, split: SplitConfig | None = None) -> DataFrame:
    """The cleaned records with cluster_id, -1 where none."""
    if adaptive:
        table, columns = features.aggregate_v3(scored, cleaned), V3
    else:
        table = features.aggregate_v2(scored, cleaned)
        columns = [c for c in table.columns if c != "record_id"]
    points = cut(vectors(cut(table), columns))
    labels = dbscan(points, auto_eps(points) if eps is None else eps, min_samples)
    if hierarchical:
        config = split or SplitConfig()
        if adaptive:
            config = SplitConfig(**{**config.__dict__, "domain_column": V3.index("domain_sim")})
            labels = subdivide(points, labels, config).labels
        else:
            labels = connectivity_aware(points, labels, config).labels
    named = labels.select(F.col("node").alias("record_id"), "cluster_id")
    return cleaned.join(named, "record_id", "left").withColumn("cluster_id", F.coalesce("cluster_id", F.lit(-1).cast("long")))


def run_pipeline(spark: SparkSession, config: PipelineConfig) -> PipelineResult:
    """Run the steps in order; each table is written, timed and logged, and an error ends the run and is told.

    A step that isn't asked for leaves its table to an earlier run: steps read
    what is stored in the output folder.
    """
    out = PipelineResult()
    t = Stored(lambda name: spark.read.parquet(f"{config.output_dir}/{name}.parquet"))
    out.tables = t

    def done(step: str, name: str, df: DataFrame, began: datetime) -> None:
        path = f"{config.output_dir}/{name}.parquet"
        write_table(df, path)
        t[name] = spark.read.parquet(path)
        ended = datetime.now()
        out.seconds[step] = (ended - began).total_seconds()
        if config.log:
            log_run(step, began, ended, t[name].count(), config.log, config.tracker or f"{config.output_dir}/iteration.json")

    try:
        for step in (s for s in STEPS if s in config.steps):
            began = datetime.now()
            if step == "preprocess":
                cleaned = preprocess.clean(read_table(spark, config.input_path))
                if config.dedup:
                    keep = preprocess.keep_first if config.dedup == "composite" else preprocess.keep_first_either
                    cleaned, removed = keep(cut(cleaned))
                    write_table(removed, f"{config.output_dir}/removed.parquet")
                done(step, "cleaned", cleaned, began)
            elif step == "blocking":
                done(step, "pairs", blocking.candidate_pairs(t["cleaned"], config.blocking), began)
            elif step == "similarity":
                done(step, "features", pairs.features(t["cleaned"], t["pairs"]), began)
            elif step == "model":
                done(step, "scored", model.train_and_score(t["features"], None, config.threshold, f"{config.output_dir}/model")["scored"], began)
            elif step == "clustering":
                labels = cut(cluster_records(t["features"], t["cleaned"], config.eps, config.min_samples, config.hierarchical, config.adaptive, config.split))
                table = (features.aggregate_v3 if config.adaptive else features.aggregate_v2)(t["features"], t["cleaned"])
                write_table(table.join(labels.select("record_id", "cluster_id"), "record_id"), f"{config.output_dir}/agg_features.parquet")
                rescued = quality.rescue_noise(labels, t["features"]).withColumnRenamed("cluster_id", "rescued")
                done(step, "clusters", labels.join(rescued, "record_id").drop("cluster_id").withColumnRenamed("rescued", "cluster_id"), began)
            elif step == "deduplication":
                unique, told = decide.deduplicate(t["cleaned"], t["features"])
                write_table(told, f"{config.output_dir}/decisions.parquet")
                done(step, "unique_records", unique, began)
            elif step == "reporting":
                report.write_report(t["scored"], t["cleaned"], f"{config.output_dir}/report")
                done(step, "bands", report.band_statistics(t["scored"]), began)
    except Exception as e:  # noqa: BLE001  the result tells what went wrong
        out.error = f"{step}: {e}"
    return out


def main(args: list[str] | None = None) -> int:
    """kinfold INPUT OUTPUT [--steps ...]: exit 0 if all steps ran, 1 for an error."""
    parser = argparse.ArgumentParser(prog="kinfold")
    parser.add_argument("input")
    parser.add_argument("output")
    parser.add_argument("--steps", nargs="+", default=list(STEPS), choices=STEPS)
    parser.add_argument("--dedup", choices=["composite", "either", "none"], default="composite")
    parser.add_argument("--threshold", type=float, default=0.9)
    parser.add_argument("--eps", type=float, default=0.1)
    parser.add_argument("--auto-eps", action="store_true")
    parser.add_argument("--min-samples", type=int, default=2)
    parser.add_argument("--max-cluster-size", type=int, default=50)
    parser.add_argument("--max-depth", type=int, default=20)
    parser.add_argument("--flat", action="store_true")
    parser.add_argument("--fixed-depth", action="store_true")
    parser.add_argument("--log")
    a = parser.parse_args(args)
    spark = SparkSession.builder.appName("kinfold").getOrCreate()
    split = SplitConfig(max_size=a.max_cluster_size, max_depth=a.max_depth, eps=a.eps, min_samples=a.min_samples)
    config = PipelineConfig(a.input, a.output, None if a.dedup == "none" else a.dedup, tuple(a.steps), threshold=a.threshold, eps=None if a.auto_eps else a.eps, min_samples=a.min_samples, hierarchical=not a.flat, adaptive=not a.fixed_depth, split=split, log=a.log)
    result = run_pipeline(spark, config)
    for step, seconds in result.seconds.items():
        print(f"{step}: {seconds:.2f} s")
    if result.error:
        print(result.error, file=sys.stderr)
    return int(result.error is not None)


if __name__ == "__main__":
    sys.exit(main())

"""Similarity features of candidate pairs and their statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import exact, with_similarity

CARRIED = ["company_clean", "domain_clean", "phone_clean"]
MEASURES = ["company_sim", "domain_sim", "phone_exact", "address_sim"]


def attach(cleaned: DataFrame, pairs: DataFrame, columns: list[str]) -> DataFrame:
    """The pairs with both records' columns, named with _1 and _2."""
    if missing := {"record_id", "company_clean"} - set(cleaned.columns):
        raise KeyError(f"missing columns: {sorted(missing)}")
    out = pairs.select("record_id_1", "record_id_2")
    for i in (1, 2):
        side = cleaned.select(F.col("record_id").alias(f"record_id_{i}"), *[F.col(c).alias(f"{c}_{i}") for c in columns])
        out = out.join(side, f"record_id_{i}", "left")
    return out


def features(cleaned: DataFrame, pairs: DataFrame, address: bool = True) -> DataFrame:
    """company_sim (Jaro-Winkler), domain_sim and phone_exact (equality), address_sim (token sets), and the clean columns of both."""
    have = [*CARRIED, "address_clean"] if address else CARRIED
    both = attach(cleaned, pairs, have)
    both = with_similarity(both, "company_clean_1", "company_clean_2", "company_sim", "jaro_winkler")
    both = both.withColumn("domain_sim", exact(F.col("domain_clean_1"), F.col("domain_clean_2"))).withColumn("phone_exact", exact(F.col("phone_clean_1"), F.col("phone_clean_2")))
    if address:
        both = with_similarity(both, "address_clean_1", "address_clean_2", "address_sim", "token_set").drop("address_clean_1", "address_clean_2")
    return both


def metrics(scored: DataFrame) -> DataFrame:
    """measure, mean, std (sample), min, max, null_count: a row for each similarity column."""
    names = [c for c in MEASURES if c in scored.columns]
    once = scored.agg(*[f(c).alias(f"{c}__{k}") for c in names for k, f in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max), ("null_count", lambda c: F.sum(F.col(c).isNull().cast("long"))))])
    parts = ("mean", "std", "min", "max", "null_count")
    rows = F.array(*[F.struct(F.lit(c).alias("measure"), *[F.col(f"{c}__{k}").alias(k) for k in parts]) for c in names])
    return once.select(F.explode(rows).alias("r")).select("r.*")


def missing_columns(cleaned: DataFrame) -> list[str]:
    """Which of phone, domain and address are absent or without any value."""
    names = [c for c in ("phone_clean", "domain_clean", "address_clean") if c in cleaned.columns]
    counts = cleaned.agg(*[F.count(F.nullif(F.col(c), F.lit(""))).alias(c) for c in names]).first()
    return [c for c in ("phone_clean", "domain_clean", "address_clean") if c not in names or not counts[c]]

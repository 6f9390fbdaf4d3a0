"""Candidate pairs: equality blocks and the sorted neighbourhood, their union and statistics.

Every pair is (record_id_1, record_id_2) with row_idx_1 < row_idx_2; rows
without the key (null or empty) take no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import cut
from .ranks import global_rank


@dataclass
class BlockingConfig:
    use_phone_block: bool = True
    use_domain_block: bool = True
    use_company_block: bool = True
    use_fuzzy_block: bool = True
    fuzzy_window_size: int = 5


PAIR = ["record_id_1", "record_id_2", "row_idx_1", "row_idx_2"]


#: Members of a key from which its pairs are formed in several tasks, so many of them in each.
SHARE = 1000


def _keyed(cleaned: DataFrame, key: str) -> DataFrame:
    return cleaned.select("record_id", "row_idx", F.col(key).alias("key")).filter(F.nullif(F.col("key"), F.lit("")).isNotNull())


def _equal(cleaned: DataFrame, columns: dict[str, str]) -> DataFrame:
    """block and the pairs of records with equal keys, for all the blocks (name: column) at once.

    A key of many members is dealt out: each member is one of its left sides in
    one share, and a right side in all of them.
    """
    entries = F.array(*[F.struct(F.lit(name).alias("block"), F.nullif(F.col(c), F.lit("")).alias("key")) for name, c in columns.items()])
    rows = cleaned.select("record_id", "row_idx", F.inline(F.filter(entries, lambda e: e["key"].isNotNull())))
    shared = rows.groupBy("block", "key").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("shares"), F.count("*").alias("n")).filter("n > 1").drop("n")
    rows = rows.join(shared, ["block", "key"])
    on = ["block", "key", "share"]
    left = rows.select("block", "key", F.pmod(F.xxhash64("row_idx"), F.col("shares")).cast("int").alias("share"), F.col("record_id").alias("record_id_1"), F.col("row_idx").alias("row_idx_1"))
    right = rows.select("block", "key", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.col("record_id").alias("record_id_2"), F.col("row_idx").alias("row_idx_2"))
    return left.join(right, on).filter("row_idx_1 < row_idx_2").select("block", *PAIR)


def block(cleaned: DataFrame, key: str) -> DataFrame:
    """Pairs of records with equal keys."""
    return _equal(cut(cleaned.select("record_id", "row_idx", key)), {key: key}).select(PAIR)


def sorted_neighbourhood(cleaned: DataFrame, key: str = "company_clean", window: int = 5) -> DataFrame:
    """Pairs whose keys are at most (window - 1) / 2 apart among the distinct keys in order.

    Only distinct keys are ranked. One side meets the ranks at and after its own,
    so the band is a join on equal ranks.
    """
    reach = (window - 1) // 2
    rows = _keyed(cleaned, key)
    ranks = global_rank(rows.select("key").distinct(), ["key"])
    ranked = rows.join(ranks, "key").select("record_id", "row_idx", "rank")
    own = ranked.select("record_id", "row_idx", F.col("rank").alias("meet"), F.lit(True).alias("own"))
    after = ranked.select("record_id", "row_idx", F.explode(F.sequence(F.col("rank"), F.col("rank") + reach)).alias("meet"), F.col("rank"))
    left = after.select("meet", "rank", F.col("record_id").alias("id_a"), F.col("row_idx").alias("row_a"))
    right = own.select("meet", F.col("record_id").alias("id_b"), F.col("row_idx").alias("row_b"))
    met = left.join(right, "meet").filter((F.col("rank") < F.col("meet")) | (F.col("row_a") < F.col("row_b")))
    first = F.col("row_a") < F.col("row_b")
    swap = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    return met.select(swap("id_a", "id_b").alias("record_id_1"), swap("id_b", "id_a").alias("record_id_2"), F.least("row_a", "row_b").alias("row_idx_1"), F.greatest("row_a", "row_b").alias("row_idx_2"))


COLUMNS = {"phone": "phone_clean", "domain": "domain_clean", "company": "company_clean"}


def _tagged(cleaned: DataFrame, config: BlockingConfig, equal: dict[str, str]) -> DataFrame:
    """block and the pairs of every block asked for."""
    every = _equal(cleaned, equal) if equal else None
    if config.use_fuzzy_block:
        fuzzy = sorted_neighbourhood(cleaned, window=config.fuzzy_window_size).select(F.lit("fuzzy").alias("block"), *PAIR)
        every = fuzzy if every is None else every.unionByName(fuzzy)
    if every is None:
        raise ValueError("no block is asked for")
    return every


def _asked(config: BlockingConfig) -> dict[str, str]:
    return {name: c for name, c in COLUMNS.items() if getattr(config, f"use_{name}_block")}


def _keys(cleaned: DataFrame) -> DataFrame:
    return cut(cleaned.select("record_id", "row_idx", *COLUMNS.values()))


def blocks(cleaned: DataFrame, config: BlockingConfig | None = None) -> dict[str, DataFrame]:
    """The pairs of each block that the configuration asks for."""
    config, rows = config or BlockingConfig(), _keys(cleaned)
    found = {name: _equal(rows, {name: c}).select(PAIR) for name, c in _asked(config).items()}
    if config.use_fuzzy_block:
        found["fuzzy"] = sorted_neighbourhood(rows, window=config.fuzzy_window_size)
    return found


def candidate_pairs(cleaned: DataFrame, config: BlockingConfig | None = None) -> DataFrame:
    """The distinct pairs of all blocks. Records with one company are neighbours too, so that block isn't formed twice."""
    config = config or BlockingConfig()
    equal = {name: c for name, c in _asked(config).items() if not (config.use_fuzzy_block and name == "company")}
    return _tagged(_keys(cleaned), config, equal).select(PAIR).dropDuplicates(PAIR)


def statistics(cleaned: DataFrame, config: BlockingConfig | None = None) -> DataFrame:
    """One row: records, pairs of each block, distinct pairs, possible pairs, reduction ratio."""
    config = config or BlockingConfig()
    rows = _keys(cleaned)
    found = [*_asked(config), *(["fuzzy"] if config.use_fuzzy_block else [])]
    by_pair = _tagged(rows, config, _asked(config)).groupBy("row_idx_1", "row_idx_2").agg(*[F.max((F.col("block") == n).cast("int")).alias(n) for n in found])
    counts = by_pair.agg(F.count("*").alias("output_pairs"), *[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(f"{n}_pairs") for n in found])
    size = rows.agg(F.count("*").alias("input_records"))
    n = F.col("input_records")
    possible = F.expr("input_records * (input_records - 1) DIV 2")
    both = size.crossJoin(counts).withColumn("possible_pairs", possible)
    return both.withColumn("reduction_ratio", F.when(n > 1, 1 - F.col("output_pairs") / F.col("possible_pairs")).otherwise(F.lit(0.0)))

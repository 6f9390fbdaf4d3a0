"""Cleaning of organisation records: column roles, normal forms, keep-first dedup, statistics."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import normalize
from ..sources.scratch import cut
from .graph import connected_components
from .ranks import global_rank

CLEAN = ["company_clean", "domain_clean", "phone_clean", "address_clean"]


def clean(df: DataFrame, order: Column | None = None, anchored: bool = False) -> DataFrame:
    """The raw columns with record_id, row_idx and the four clean columns (null where the role has no column).

    ``order`` gives the natural order of rows; without it they are numbered by
    in_file_order(). Raises ValueError if no column can hold a company.
    """
    role = normalize.roles(df.columns)
    if not role["company"]:
        raise ValueError("no column holds a company name")
    if role["id"]:
        df = df.withColumnRenamed(role["id"], "record_id").withColumn("record_id", F.col("record_id").cast("string"))
    if order is not None:
        df = df.withColumn("row_idx", order)
    else:
        df = in_file_order(df, "row_idx")
    if not role["id"]:
        df = df.withColumn("record_id", F.col("row_idx").cast("string"))
    named = {k: ("record_id" if v == role["id"] else v) for k, v in role.items() if isinstance(v, str)}
    none = F.lit(None).cast("string")
    folded = normalize.fold_to_ascii(df.withColumn("company__plain", F.col(f"`{named['company']}`").cast("string")), "company__plain")
    parts = [F.col(f"`{c}`").cast("string") for c in role["address"]]
    return folded.select(
        *[F.col(f"`{c}`") for c in df.columns],
        normalize.company(F.col("company__plain"), anchored).alias("company_clean"),
        (F.coalesce(normalize.domain(F.col(f"`{named['domain']}`")), F.lit("")) if "domain" in named else none).alias("domain_clean"),
        (F.coalesce(normalize.phone(F.col(f"`{named['phone']}`")), F.lit("")) if "phone" in named else none).alias("phone_clean"),
        (normalize.address(parts) if parts else none).alias("address_clean"),
    )


def in_file_order(df: DataFrame, name: str) -> DataFrame:
    """Number the rows by their files' names, then in the order of each file.

    Spark packs files into partitions by size, so a row's partition says nothing
    of its file; the place of its block does. Rows that come from no file are
    taken in the order of their partitions.
    """
    place = ["_metadata.file_path", "_metadata.file_block_start"]
    try:
        df = df.select("*", *[F.col(c).alias(f"row__{i}") for i, c in enumerate(place)])
        order = ["row__0", "row__1"]
    except AnalysisException:
        order = []
    order.append("row__id")
    return global_rank(df.withColumn("row__id", F.monotonically_increasing_id()), order, name).drop(*order)


def translate_names(df: DataFrame, column: str, translate) -> DataFrame:
    """Replace names through a function of a DataFrame of distinct names (name -> name, translated).

    Names the function leaves out, and empty ones, stay as they are.
    """
    names = df.select(F.col(column).alias("name")).filter("name is not null and name <> ''").distinct()
    done = translate(names).select(F.col("name").alias("tr__from"), F.col("translated").alias("tr__to"))
    joined = df.join(done, F.col(column) == F.col("tr__from"), "left")
    return joined.withColumn(column, F.coalesce("tr__to", F.col(column))).drop("tr__from", "tr__to")


def dedup_key() -> Column:
    return F.concat(F.coalesce("company_clean", F.lit("")), F.lit("|"), F.coalesce("domain_clean", F.lit("")))


def _firsts(rows: DataFrame, key: Column) -> DataFrame:
    """row_idx of the first row of each key: a minimum that every task adds to, so a key of many rows doesn't meet in one."""
    return rows.groupBy(key.alias("first__key")).agg(F.min("row_idx").alias("row_idx")).select("row_idx")


def _given(rows: DataFrame, column: str) -> DataFrame:
    return rows.filter(F.nullif(F.col(column), F.lit("")).isNotNull())


def keep_first(cleaned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, removed): the first row of each company and domain stays; empty values are values here."""
    cleaned = cut(cleaned)
    first = cut(_firsts(cleaned, dedup_key()))
    return cleaned.join(first, "row_idx", "left_semi").select(cleaned.columns), cleaned.join(first, "row_idx", "left_anti").select(cleaned.columns)


def keep_first_either(cleaned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, removed): a row goes if its company or its domain was seen in a row before; empty values never match.

    Kept rows get combined_id, company;domain;phone, and merged_ids, the ids of
    all rows connected to them by shared companies and domains, in row order.
    """
    cleaned = cut(cleaned)
    links = None
    for c in ("company_clean", "domain_clean"):
        some = _given(cleaned, c).select("row_idx", F.col(c).alias("key"))
        first = cut(some.groupBy("key").agg(F.min("row_idx").alias("b"), F.count("*").alias("n")).filter("n > 1").select("key", "b"))
        one = some.join(first, "key").select(F.col("row_idx").alias("a"), "b").filter("a <> b")
        links = one if links is None else links.unionByName(one)
    links = cut(links)
    seen = links.select(F.col("a").alias("row_idx")).distinct()
    groups = connected_components(links)
    ids = cleaned.join(groups, cleaned["row_idx"] == groups["node"]).groupBy("component").agg(F.array_sort(F.collect_list(F.struct("row_idx", "record_id"))).alias("members"))
    merged = groups.join(ids, "component").select(F.col("node").alias("dup__row"), F.array_join(F.transform("members", lambda m: m["record_id"]), ";").alias("merged_ids"))
    text = lambda c: F.coalesce(c, F.lit(""))
    kept = cleaned.join(seen, "row_idx", "left_anti").select(cleaned.columns)
    kept = kept.join(merged, F.col("row_idx") == F.col("dup__row"), "left").drop("dup__row").withColumn("merged_ids", F.coalesce("merged_ids", "record_id"))
    kept = kept.withColumn("combined_id", F.concat_ws(";", text("company_clean"), text("domain_clean"), text("phone_clean")))
    return kept, cleaned.join(seen, "row_idx", "left_semi").select(cleaned.columns)


def statistics(cleaned: DataFrame, company: str = "company") -> DataFrame:
    """One row: rows, distinct companies before and after, missing and empty values, duplicates by company and domain."""
    blank = lambda c: F.sum(F.when(F.nullif(F.col(c), F.lit("")).isNull(), 1).otherwise(0)).cast("long")
    return cleaned.agg(
        F.count("*").alias("rows"),
        F.countDistinct(company).alias("companies_before"),
        F.countDistinct("company_clean").alias("companies_after"),
        blank(company).alias("missing_company"),
        blank("company_clean").alias("empty_company"),
        blank("domain_clean").alias("missing_domain"),
        (F.count("*") - F.countDistinct(F.coalesce("company_clean", F.lit("")))).alias("duplicates_by_company"),
        (F.count("*") - F.countDistinct(F.coalesce("domain_clean", F.lit("")))).alias("duplicates_by_domain"),
    )

"""String similarities that Spark lacks, as Arrow functions over pairs of distinct values."""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

BOOST_FROM = 0.7


@lru_cache(1 << 16)
def jaro_winkler(a: str, b: str) -> float:
    """Jaro similarity, raised by a common prefix of up to 4 characters where it is over 0.7; 0 for an empty side."""
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, first = [False] * len(b), []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == x:
                used[j] = True
                first.append(x)
                break
    n = len(first)
    if not n:
        return 0.0
    second = [y for y, hit in zip(b, used, strict=True) if hit]
    swapped = sum(x != y for x, y in zip(first, second, strict=True)) // 2
    jaro = (n / len(a) + n / len(b) + (n - swapped) / n) / 3
    if jaro <= BOOST_FROM:
        return jaro
    prefix = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return jaro + 0.1 * prefix * (1 - jaro)


def indel_ratio(a: str, b: str) -> float:
    """1 - (insertions + deletions) / total length, by the longest common subsequence in bits."""
    if not a and not b:
        return 1.0
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for y in b:
        u = s & places.get(y, 0)
        s = ((s + u) | (s - u)) & full
    common = len(a) - bin(s).count("1")
    return 2 * common / (len(a) + len(b))


@lru_cache(1 << 16)
def token_set_ratio(a: str, b: str) -> float:
    """Best indel ratio of the common tokens and the common tokens with either side's others; 0 for an empty side."""
    x, y = set((a or "").split()), set((b or "").split())
    if not x or not y:
        return 0.0
    both, left, right = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not left or not right):
        return 1.0
    one, two = f"{both} {left}".strip(), f"{both} {right}".strip()
    best = indel_ratio(one, two)
    if both:
        best = max(best, indel_ratio(both, one), indel_ratio(both, two))
    return best


@pandas_udf(DoubleType())
def _jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([jaro_winkler(x or "", y or "") for x, y in zip(a, b, strict=True)])


@pandas_udf(DoubleType())
def _token_set(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set_ratio(x or "", y or "") for x, y in zip(a, b, strict=True)])


FUNCTIONS = {"jaro_winkler": _jaro_winkler, "token_set": _token_set}


def with_similarity(pairs: DataFrame, left: str, right: str, name: str, function: str) -> DataFrame:
    """Add a similarity, worked out once for each pair of distinct values; equal values never reach Python."""
    a, b = F.coalesce(F.col(left), F.lit("")), F.coalesce(F.col(right), F.lit(""))
    values = pairs.select(a.alias("sim__a"), b.alias("sim__b")).filter("sim__a <> sim__b and sim__a <> '' and sim__b <> ''").distinct()
    scored = values.withColumn("sim__value", FUNCTIONS[function](F.col("sim__a"), F.col("sim__b")))
    joined = pairs.join(scored, (a == F.col("sim__a")) & (b == F.col("sim__b")), "left")
    same = F.when((a == b) & (a != ""), F.lit(1.0)).otherwise(F.coalesce("sim__value", F.lit(0.0)))
    return joined.withColumn(name, same).drop("sim__a", "sim__b", "sim__value")


def exact(a: Column, b: Column) -> Column:
    """1.0 for equal values that are there, else 0.0."""
    return F.when((a == b) & (a != ""), F.lit(1.0)).otherwise(F.lit(0.0))


def euclidean(a: Column, b: Column) -> Column:
    """Distance of two arrays of equal length."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, d: s + d))

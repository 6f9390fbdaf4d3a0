"""Ranks over a whole table without sending it to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import cut

#: Fixed value: the bits of a monotonically increasing id that number a partition's rows.
PLACE = 33


def global_rank(df: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """Add 0, 1, 2, ... in the order of the columns, nulls first.

    Rows are dealt by ranges and sorted there, in one shuffle; a row's id tells
    its range and its place in it, and the counts of the ranges before, a row per
    range, give the offset. Equal rows have no order of their own, so the columns
    should tell all rows apart.
    """
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = cut(dealt.withColumn("rank__id", F.monotonically_increasing_id()))
    counts = placed.groupBy(F.shiftright("rank__id", PLACE).alias("rank__part")).count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("rank__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("rank__part", before.alias("rank__before"))
    ranked = placed.withColumn("rank__part", F.shiftright("rank__id", PLACE)).join(F.broadcast(offsets), "rank__part")
    place = F.col("rank__id").bitwiseAND(F.lit((1 << PLACE) - 1))
    return ranked.withColumn(name, (F.col("rank__before") + place).cast("long")).drop("rank__part", "rank__id", "rank__before")

"""What the operators share: the folder that all executors see, and cut lineage."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import folder

#: Bits of the filter on rows that are wanted: 1 MB, sent in rows of CELL bits.
NEEDED_BITS, CELL = 1 << 23, 1 << 15
_open: list[list[tuple[SparkSession, str]]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str = "zstd", keep: bool = False) -> DataFrame:
    """Write a table to the shared folder and read it back: a cut in the lineage that outlives executors.

    Within temporary() the table goes at the block's end; with ``keep`` it goes
    with the block around that one, if there is one.
    """
    path = scratch(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    if len(_open) > keep:
        _open[-1 - keep].append((df.sparkSession, path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary() -> Iterator[None]:
    """A block whose written tables are removed at its end, as are shuffle files that nothing needs any more."""
    _open.append([])
    try:
        yield
    finally:
        tables = _open.pop()
        for spark, path in tables:
            dropped(spark, path)
        if tables:
            released(tables[0][0])


def dropped(spark: SparkSession, path: str) -> None:
    """Remove a folder of scratch() once nothing reads it any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def released(spark: SparkSession) -> None:
    """Let Spark delete shuffle files that no DataFrame needs any more; it does so when the driver's garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def possibly_in(df: DataFrame, key: Column, wanted: DataFrame, column: str) -> DataFrame:
    """The rows whose key may be in the column of ``wanted`` (all of those that are), by a bitmap of 1 MB of its hashes.

    The bitmap has that size whatever the input, so it can always be sent; the
    larger ``wanted``, the more other rows pass.
    """
    columns = df.columns
    cells = wanted.select(F.pmod(F.xxhash64(column), F.lit(NEEDED_BITS)).alias("x")).groupBy(F.floor(F.col("x") / CELL).alias("needed__cell")).agg(F.bitmap_construct_agg(F.col("x") % CELL).alias("needed__bits"))
    spot = F.col("needed__spot")
    spotted = df.withColumn("needed__spot", F.pmod(F.xxhash64(key), F.lit(NEEDED_BITS))).join(F.broadcast(cells), F.floor(spot / CELL) == F.col("needed__cell"))
    byte = F.conv(F.hex(F.substring("needed__bits", ((spot % CELL) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return spotted.filter(F.call_function("shiftright", byte, (spot % 8).cast("int")) % 2 == 1).select([F.col(f"`{c}`") for c in columns])


def partitions(spark: SparkSession) -> int:
    """Reducer count of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

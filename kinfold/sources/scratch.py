"""Cutting the lineage of iterative plans in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only for a local master without it, a folder of this machine."""
    if at := spark.sparkContext.getConf().get("spark.checkpoint.dir"):
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="kinfold-")
    return _own[app]


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written and read back."""
    path = f"{folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

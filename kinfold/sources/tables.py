"""Reading and writing tables, reviews, models and the run log."""

from __future__ import annotations

import json
import os
from datetime import datetime
from pathlib import Path

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table of strings from CSV, the first sheet of a workbook, or the columns of a Parquet folder.

    Raises FileNotFoundError for a missing path, ValueError for another kind.
    """
    kind = os.path.splitext(path.rstrip("/"))[1].lower()
    if kind not in (".csv", ".xlsx", ".xls", ".parquet"):
        raise ValueError(f"unsupported kind of file: {kind or path}")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        raise FileNotFoundError(path)
    if kind == ".csv":
        return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')
    if kind == ".parquet":
        return spark.read.parquet(path)
    import pandas as pd

    try:
        sheet = pd.read_excel(path, dtype=str)
    except ImportError as e:
        raise RuntimeError("reading workbooks needs a package for them, such as openpyxl") from e
    return spark.createDataFrame(sheet.where(sheet.notna(), None))


def write_table(df: DataFrame, path: str) -> None:
    """Write as Parquet or, for a path that ends in .csv, as a CSV folder, whose lists of strings are joined by semicolons."""
    if path.endswith(".csv"):
        df = df.withColumns({c: F.array_join(F.col(c), ";") for c, kind in df.dtypes if kind == "array<string>"})
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    else:
        df.write.mode("overwrite").parquet(path)


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    from ..operators.report import REVIEWS

    return spark.read.schema(REVIEWS).json(path, multiLine=True)


def _located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI: the log and the tracker lie beside tables, wherever these are."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), str(Path(path).absolute()))


def read_text(path: str) -> str:
    at, name = _located(path)
    with at.open_input_stream(name) as f:
        return f.read().decode("utf-8")


def write_text(text: str, path: str) -> None:
    at, name = _located(path)
    at.create_dir(name.rpartition("/")[0], recursive=True)
    with at.open_output_stream(name) as f:
        f.write(text.encode("utf-8"))


def write_json(rows: list | dict, path: str) -> None:
    """A small result as indented JSON on the driver."""
    write_text(json.dumps(rows, indent=2, ensure_ascii=False), path)


def clear_files(paths: list[str]) -> None:
    for p in paths:
        Path(p).unlink(missing_ok=True)


def clear_all_data(folder: str, exclude: set[str] = frozenset(), tracker: str = "iteration.json") -> None:
    """Delete the files of a folder, but for those named and the iteration tracker; folders stay."""
    for p in Path(folder).iterdir():
        if p.is_file() and p.name not in exclude and str(p) not in exclude and p.name != tracker:
            p.unlink()


def current_iteration(path: str) -> int:
    """The tracked number, 1 if there is none or it can't be read."""
    try:
        return int(json.loads(read_text(path))["current_iteration"])
    except (OSError, ValueError, KeyError, TypeError):
        return 1


def next_iteration(path: str) -> int:
    n = current_iteration(path) + 1
    write_json({"current_iteration": n}, path)
    return n


def log_run(step: str, start: datetime, end: datetime, rows: int, log: str, tracker: str, info: dict | None = None) -> None:
    """Append iteration, step, times, rows, seconds and details as a line; preprocess begins a new iteration."""
    iteration = next_iteration(tracker) if step == "preprocess" else current_iteration(tracker)
    line = [str(iteration), step, start.isoformat(), end.isoformat(), str(rows), f"{(end - start).total_seconds():.2f}"]
    if info is not None:
        line.append(json.dumps(info, default=str))
    try:
        before = read_text(log)
    except FileNotFoundError:
        before = ""
    write_text(before + ",".join(line) + "\n", log)

"""The stateless part of preprocessing on a stream of records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import normalize


def cleaned_stream(rows: DataFrame) -> DataFrame:
    """The clean columns of a stream of raw records; names are taken as ASCII, rows get no row_idx."""
    role = normalize.roles(rows.columns)
    if not role["company"]:
        raise ValueError("no column holds a company name")
    none = F.lit(None).cast("string")
    of = lambda kind, f: F.coalesce(f(F.col(f"`{role[kind]}`").cast("string")), F.lit("")) if role[kind] else none
    parts = [F.col(f"`{c}`").cast("string") for c in role["address"]]
    return rows.withColumns({"company_clean": of("company", normalize.company), "domain_clean": of("domain", normalize.domain), "phone_clean": of("phone", normalize.phone), "address_clean": normalize.address(parts) if parts else none})


def write_cleaned(rows: DataFrame, path: str, checkpoint: str):
    """Start the stream into a Parquet folder; once for what is there."""
    return cleaned_stream(rows).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

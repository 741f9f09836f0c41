"""Small helpers on DataFrames that several operators share."""

from __future__ import annotations

from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

from tileplan.session import shared_dir, written  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns whose names the operator is about to use; names differ by more than case."""
    taken = {n.lower() for n in names}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() not in taken])


def mounted(spark: SparkSession, label: str) -> str:
    """A new folder below the shared folder as a path that every executor has mounted."""
    parts = urlsplit(shared_dir(spark, label))
    if parts.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped files need a mounted shared folder; spark.checkpoint.dir is {parts.scheme}://")
    return parts.path

"""Small helpers around the running Spark session."""

from __future__ import annotations

import datetime as dt
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def build_session(name: str = "tileplan", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on; everything else is left to the cluster."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_USED: ContextVar[list[str] | None] = ContextVar("folders of a scratch block", default=None)


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder below spark.checkpoint.dir, or, on one machine, below the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{root.rstrip('/')}/tileplan/{label}-{uuid.uuid4().hex}"
    if (used := _USED.get()) is not None:
        used.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession):
    """Remove the folders that ``written`` makes inside the block when it ends; their frames must not be used later."""
    token = _USED.set([])
    try:
        yield
    finally:
        folders = _USED.get()
        _USED.reset(token)
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back, which survives the loss of executors."""
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def moment(value: str | dt.datetime | Column) -> Column:
    """A clock value as a timestamp without zone, independent of the session's zone."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp_ntz")


def day_number(value: str | dt.date) -> int:
    """A date as the integer yyyymmdd."""
    return int(str(value)[:10].replace("-", ""))


def small_table(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A few fixed rows as a local relation, of which the optimiser knows the size and which needs no job."""
    fields = to_arrow_schema(schema)
    columns = [pa.array([row[i] for row in rows], type=fields.field(i).type) for i in range(len(schema))]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=schema.names), schema)

"""SRC-01: the core tables as typed scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tileplan.catalogue import Catalogue
from tileplan.functions.scalars import date_to_day
from tileplan.schemas import PARTITIONING, SCHEMAS
from tileplan.sources.reference import reference_tables
from tileplan.sources.tablelog import logged

CORE_TABLES = ["raw_inputs", "trigger_validation", "raw2valid", "processing_tasks", "nomad_job_dispatch",
               "processingtask2nomad", "processing_status_workflow", "products", "indexation_json",
               "indexation_workflow", "tile_geometry", "tile_track", "tile_list"]


#: Where a table lies by the day of one of its times; links by the day of their validation.
LAYOUT = {"raw_inputs": "measurement_day", "trigger_validation": "validation_date", "raw2valid": "validation_date",
          "processing_tasks": "creation_date", "nomad_job_dispatch": "dispatch_date", "processing_status_workflow": "date",
          "products": "creation_date"}
ON_DAY = "on_day"


def scan(spark: SparkSession, root: str, table: str, days: tuple[int, int] | None = None) -> DataFrame:
    """One table below ``root`` with its declared schema; nothing is inferred.

    ``days`` (first and last, yyyymmdd) reads only the folders of these days of a table that ``write_catalogue`` has
    laid out, see ``LAYOUT``.
    """
    names, fields = [f.name for f in SCHEMAS[table]], list(SCHEMAS[table])
    if days is None:
        return spark.read.schema(SCHEMAS[table]).parquet(f"{root}/{table}").select(*names)
    if table not in LAYOUT:
        raise ValueError(f"{table} is not laid out by day")
    key = PARTITIONING.get(table, ON_DAY)
    schema = SCHEMAS[table] if key in names else StructType([*fields, StructField(ON_DAY, LongType())])
    return spark.read.schema(schema).parquet(f"{root}/{table}").where(F.col(key).between(*days)).select(*names)


def jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """The same table from a relational database, read in parts given by the options."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def load_catalogue(spark: SparkSession, root: str) -> Catalogue:
    """SRC-01, SRC-03: all core tables below ``root``, with the code tables.

    A table that a job or ``store_parameters`` has published is read as its log says, stored parameters in place of the
    constant ones; others are the files in their folder.
    """
    codes = reference_tables(spark)
    tables = {name: (lambda n=name: getattr(codes, n)) for name in codes.names()}
    tables.update({name: (lambda n=name: scan(spark, root, n)) for name in CORE_TABLES})
    tables.update({name: (lambda n=name, log=log: log.rows(n)) for name, log in logged(spark, root).items()})
    return Catalogue(tables)


def write_table(df: DataFrame, root: str, table: str, mode: str = "append", day: Column | None = None) -> None:
    """Write rows of a table below ``root``: inputs in folders by measurement day, others by ``day`` if it is given.

    Rows are dealt by ranges of day and tile (or id), so a crowded day is several files, and files of a day hold
    neighbouring tiles, which their statistics tell apart.
    """
    rows = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in SCHEMAS[table]],
                     *([] if day is None else [day.alias(ON_DAY)]))
    key = PARTITIONING.get(table) or (ON_DAY if day is not None else None)
    if key is None:
        rows.write.mode(mode).parquet(f"{root}/{table}")
        return
    within = next(c for c in ("tile", "id", "trigger_validation_id") if c in rows.columns)
    rows.repartitionByRange(key, within).sortWithinPartitions(key, within).write.mode(mode).partitionBy(key).parquet(
        f"{root}/{table}")


def write_catalogue(cat: Catalogue, root: str, tables: list[str] | None = None) -> None:
    """SRC-01: the core tables that ``cat`` has below ``root`` in their layout."""
    for table in tables or [t for t in CORE_TABLES if t in cat.names()]:
        df, column = getattr(cat, table), LAYOUT.get(table)
        if table == "raw2valid":
            when = cat.trigger_validation.select(F.col("id").alias("trigger_validation_id"), column)
            df = df.join(when, "trigger_validation_id", "left")
        by_time = column is not None and table not in PARTITIONING
        write_table(df, root, table, day=date_to_day(F.to_date(df[column])) if by_time else None)

"""STR-01..06: row-change feeds as streams. Every function takes a streaming or a batch DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tileplan.catalogue import Catalogue
from tileplan.operators.tasks import task_of_error, task_with_flavour
from tileplan.schemas import SCHEMAS

PROCESSED = 2
_JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}


def stream_table(spark: SparkSession, root: str, table: str, max_files: int | None = None) -> DataFrame:
    """New rows of a table folder as a stream; the source remembers the files it has read in its checkpoint."""
    reader = spark.readStream.schema(SCHEMAS[table])
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{root}/{table}")


def as_payload(*columns: str | Column) -> Column:
    """A row as JSON text, with null fields and microseconds."""
    return F.to_json(F.struct(*columns), _JSON)


def _payload(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, as_payload(*df.columns).alias("payload"))


def stream_inputs(inputs: DataFrame) -> DataFrame:
    """STR-01: new inputs as JSON."""
    return _payload(inputs, "id")


def stream_processed(changes: DataFrame) -> DataFrame:
    """STR-02: ids of statuses that became processed.

    ``changes`` are inserts, or, with a column ``old_status_id`` and ``is_update``, also updates; an update counts
    only if it changed the status.
    """
    became = F.col("processing_status_id") == PROCESSED
    if "is_update" in changes.columns:
        changed = ~F.col("old_status_id").eqNullSafe(F.col("processing_status_id"))
        became = became & (~F.col("is_update") | changed)
    return changes.filter(became).select("id")


def stream_products(products: DataFrame) -> DataFrame:
    """STR-03: new products as JSON."""
    return _payload(products, "id")


def stream_members(links: DataFrame) -> DataFrame:
    """STR-04: new validation members as JSON."""
    return _payload(links, "trigger_validation_id")


def stream_tasks(tasks: DataFrame, cat: Catalogue) -> DataFrame:
    """STR-05: new tasks with the flavour of their routine, as JSON.

    In a long run give this to ``run_feed`` with a newly opened catalogue, else later validations are unknown to it.
    """
    row = F.struct(*tasks.columns)
    return task_with_flavour(tasks, cat).select(
        "id", "flavour", F.to_json(F.struct(row.alias("processing_task"), "flavour"), _JSON).alias("payload"))


def stream_errors(statuses: DataFrame, cat: Catalogue) -> DataFrame:
    """STR-06: the task of every new error status, as JSON, to be launched again; in a long run as STR-05."""
    found = task_of_error(statuses, cat)
    return found.select("status_id", "id", as_payload(*cat.processing_tasks.columns).alias("payload"))

"""Column names and types of every catalogue table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

_TYPES = {"STRING": StringType(), "BIGINT": LongType(), "INT": IntegerType(), "BOOLEAN": BooleanType(),
          "TIMESTAMP_NTZ": TimestampNTZType()}


def struct(columns: str) -> StructType:
    """A struct from ``name TYPE, ...``, which needs no running session."""
    return StructType([StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in columns.split(","))])


# Table layouts.
_DDL = {
    "raw_inputs": """id STRING, product_type_code STRING, start_date TIMESTAMP_NTZ, publishing_date TIMESTAMP_NTZ,
        tile STRING, measurement_day BIGINT, input_path STRING, is_partial BOOLEAN,
        relative_orbit_number INT, harvesting_date TIMESTAMP_NTZ""",
    "trigger_validation": """id BIGINT, triggering_condition_name STRING, validation_date TIMESTAMP_NTZ,
        is_nrt BOOLEAN, artificial_measurement_day BIGINT""",
    "raw2valid": "trigger_validation_id BIGINT, raw_input_id STRING",
    "processing_tasks": """id BIGINT, trigger_validation_fk_id BIGINT, creation_date TIMESTAMP_NTZ,
        processing_date BIGINT, preceding_input_id STRING, has_ended BOOLEAN, intermediate_files_path STRING""",
    "nomad_job_dispatch": "id STRING, nomad_job_dispatch STRING, dispatch_date TIMESTAMP_NTZ, log_path STRING",
    "processingtask2nomad": "nomad_job_id STRING, processing_task_id BIGINT",
    "processing_status_workflow": """id BIGINT, nomad_job_dispatch_fk_id STRING, processing_status_id INT,
        date TIMESTAMP_NTZ, message STRING, exit_code INT""",
    "products": """id STRING, trigger_validation_fk_id BIGINT, product_type_code STRING, product_path STRING,
        creation_date TIMESTAMP_NTZ, catalogue_date TIMESTAMP_NTZ, kpi_file_path STRING""",
    "indexation_json": "id BIGINT, product_fk_id STRING, indexation_file_type_id INT, path STRING",
    "indexation_workflow": """id BIGINT, product_fk_id STRING, indexation_failure_type_id INT,
        publication_date TIMESTAMP_NTZ, indexation_date TIMESTAMP_NTZ, failure_date TIMESTAMP_NTZ""",
    "raster_type": "product_type STRING, description STRING, processing_level STRING",
    "processing_routine": """name STRING, product_type_code STRING, cpu INT, ram INT, storage_space INT,
        duration INT, docker_image STRING, flavour STRING""",
    "triggering_condition": "name STRING, processing_routine_name STRING, description STRING",
    "processing_status": "id INT, code BIGINT, name STRING, description STRING",
    "indexation_failure_type": "id INT, code BIGINT, name STRING, description STRING",
    "indexation_file_type": "id INT, name STRING, description STRING",
    "log_levels": "id INT, name STRING",
    "sources": """triggering_condition_name STRING, input_type STRING, collection STRING,
        max_day_since_publication_date INT, max_day_since_measurement_date INT, tile_list_file STRING,
        geometry_file STRING, polarisation STRING, timeliness STRING, nrt_harvest_start_date STRING,
        archive_harvest_start_date STRING, archive_harvest_end_date STRING""",
    "triggerer_config": "product_type STRING, last_processing_date BIGINT",
    "launcher_config": "param STRING, value STRING",
    "tile_geometry": "tile STRING, geom STRING",
    "tile_track": "tile STRING, orbit INT",
    "tile_list": "tile STRING",
    "set_index": "trigger_validation_id BIGINT, condition STRING, day BIGINT, n BIGINT, fx BIGINT, fs BIGINT",
}

SCHEMAS = {name: struct(ddl) for name, ddl in _DDL.items()}

#: Column by whose values the rows of a table lie in folders.
PARTITIONING = {"raw_inputs": "measurement_day", "set_index": "day"}

# UDF-02: result row types of the status and dispatch reports.
DISPATCH_INFO = struct(
    "nomad_job_id STRING, nomad_job_dispatch STRING, nomad_job_dispatch_creation_date TIMESTAMP_NTZ, "
    "nomad_job_dispatch_log_file_path STRING"
)
STATUS_HISTORY = struct(
    "id BIGINT, processing_status_date TIMESTAMP_NTZ, processing_status_code BIGINT, "
    "processing_status_name STRING, processing_status_message STRING"
)

# Columns that must not be null, the unique key columns and (column, parent table, parent column) references.
NOT_NULL = {
    "raw_inputs": ["id", "product_type_code", "start_date", "publishing_date", "tile", "measurement_day",
                   "input_path", "is_partial", "harvesting_date"],
    "trigger_validation": ["id", "triggering_condition_name", "validation_date", "is_nrt"],
    "raw2valid": ["trigger_validation_id", "raw_input_id"],
    "processing_tasks": ["id", "trigger_validation_fk_id", "creation_date"],
    "nomad_job_dispatch": ["id"],
    "processingtask2nomad": ["nomad_job_id", "processing_task_id"],
    "processing_status_workflow": ["id", "nomad_job_dispatch_fk_id", "processing_status_id", "date"],
    "products": ["id", "product_type_code", "product_path", "creation_date", "catalogue_date"],
    "indexation_json": ["id", "product_fk_id", "path"],
    "indexation_workflow": ["id", "product_fk_id", "publication_date"],
    "raster_type": ["product_type"],
    "processing_routine": ["name", "product_type_code"],
    "triggering_condition": ["name", "processing_routine_name"],
    "processing_status": ["id", "code", "name"],
    "indexation_failure_type": ["id", "code", "name"],
    "indexation_file_type": ["id", "name"],
}
UNIQUE = {
    "raw_inputs": ["id"],
    "trigger_validation": ["id"],
    "processing_tasks": ["id", "trigger_validation_fk_id"],
    "nomad_job_dispatch": ["id"],
    "processing_status_workflow": ["id"],
    "products": ["id", "product_path"],
    "indexation_json": ["id", "path"],
    "indexation_workflow": ["id"],
    "raster_type": ["product_type"],
    "processing_routine": ["name"],
    "triggering_condition": ["name"],
    "processing_status": ["id", "code", "name"],
    "indexation_failure_type": ["id", "code", "name"],
    "indexation_file_type": ["id", "name"],
}
REFERENCES = {
    "raw_inputs": [("product_type_code", "raster_type", "product_type")],
    "trigger_validation": [("triggering_condition_name", "triggering_condition", "name")],
    "raw2valid": [("trigger_validation_id", "trigger_validation", "id"), ("raw_input_id", "raw_inputs", "id")],
    "processing_tasks": [("trigger_validation_fk_id", "trigger_validation", "id")],
    "processingtask2nomad": [("nomad_job_id", "nomad_job_dispatch", "id"),
                             ("processing_task_id", "processing_tasks", "id")],
    "processing_status_workflow": [("nomad_job_dispatch_fk_id", "nomad_job_dispatch", "id"),
                                   ("processing_status_id", "processing_status", "id")],
    "products": [("trigger_validation_fk_id", "trigger_validation", "id"),
                 ("product_type_code", "raster_type", "product_type")],
    "indexation_json": [("product_fk_id", "products", "id"),
                        ("indexation_file_type_id", "indexation_file_type", "id")],
    "indexation_workflow": [("product_fk_id", "products", "id"),
                            ("indexation_failure_type_id", "indexation_failure_type", "id")],
    "processing_routine": [("product_type_code", "raster_type", "product_type")],
    "triggering_condition": [("processing_routine_name", "processing_routine", "name")],
}


def as_entity(df: DataFrame, table: str) -> DataFrame:
    """PRJ-22: any record shape to the typed columns of a table; absent columns become null."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in SCHEMAS[table]
    ])

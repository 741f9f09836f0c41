"""UDF-01: the catalogue's query functions, callable by name from SQL.

They are SQL functions, so a call becomes part of the plan. ``register`` makes the tables temporary views and the
functions temporary functions of the session.
"""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F
from pyspark.sql.types import StructType

from tileplan.catalogue import Catalogue
from tileplan.operators.inputs import inputs_without_task
from tileplan.operators.status import input_task_summary, processed_flag, ready_to_launch
from tileplan.schemas import DISPATCH_INFO, SCHEMAS, STATUS_HISTORY

def _layout(schema: StructType) -> str:
    """A row type as the columns of a table function."""
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


def _columns(alias: str, schema: StructType) -> str:
    return ", ".join(f"{alias}.{f.name}" for f in schema)


_INPUT, _INPUT_COLUMNS = _layout(SCHEMAS["raw_inputs"]), _columns("r", SCHEMAS["raw_inputs"])
_TASK, _TASK_COLUMNS = _layout(SCHEMAS["processing_tasks"]), _columns("p", SCHEMAS["processing_tasks"])
_DISPATCH = _layout(DISPATCH_INFO)  # UDF-02

# Optional column of the task table: the worker a task runs on.
WORKER = "virtual_machine_id"

TABLES = ["raw_inputs", "raw2valid", "trigger_validation", "processing_tasks", "processingtask2nomad",
          "nomad_job_dispatch", "processing_status_workflow", "processing_status", "processing_routine",
          "triggering_condition", "products", "indexation_workflow", "indexation_json", "indexation_file_type"]

# name(arguments) RETURNS type RETURN body
FUNCTIONS = {
    f"get_input_by_input_path(path STRING) RETURNS TABLE ({_INPUT})":
        f"SELECT {_INPUT_COLUMNS} FROM raw_inputs r WHERE r.input_path = get_input_by_input_path.path",
    f"get_input_by_measurement_day(day BIGINT) RETURNS TABLE ({_INPUT})":
        f"SELECT {_INPUT_COLUMNS} FROM raw_inputs r WHERE r.measurement_day = get_input_by_measurement_day.day",
    f"get_input_by_input_type(in_type STRING) RETURNS TABLE ({_INPUT})":
        f"""SELECT {_INPUT_COLUMNS} FROM raw_inputs r JOIN processing_routine f ON f.product_type_code = r.product_type_code
        JOIN triggering_condition c ON c.processing_routine_name = f.name WHERE f.product_type_code = in_type""",
    f"get_input_without_processing_task() RETURNS TABLE ({_INPUT})":
        f"SELECT {_INPUT_COLUMNS} FROM inputs_without_task_v r",
    "get_number_of_error_statuses_by_processing_task(task BIGINT) RETURNS BIGINT":
        """SELECT count(*) FROM processingtask2nomad n JOIN processing_status_workflow s
        ON s.nomad_job_dispatch_fk_id = n.nomad_job_id WHERE n.processing_task_id = task AND s.processing_status_id IN (4, 5)""",
    "is_processing_task_processed(task BIGINT) RETURNS BOOLEAN":
        "SELECT coalesce(bool_or(t.is_processed), false) FROM processed_flag_v t WHERE t.id = task",
    f"get_processing_tasks_not_finished() RETURNS TABLE ({_TASK})":
        f"SELECT {_TASK_COLUMNS} FROM processing_tasks p WHERE p.has_ended = false",
    f"get_status_history_by_processing_task_id(task BIGINT) RETURNS TABLE ({_layout(STATUS_HISTORY)})":
        """SELECT s.id, s.date, k.code, k.name, s.message FROM processingtask2nomad n
        JOIN processing_status_workflow s ON s.nomad_job_dispatch_fk_id = n.nomad_job_id
        JOIN processing_status k ON k.id = s.processing_status_id WHERE n.processing_task_id = task""",
    f"get_nomad_job_dispatch_list_by_processing_task_id(task BIGINT) RETURNS TABLE ({_DISPATCH})":
        """SELECT j.id, j.nomad_job_dispatch, j.dispatch_date, j.log_path FROM nomad_job_dispatch j
        JOIN processingtask2nomad n ON n.nomad_job_id = j.id WHERE n.processing_task_id = task""",
    f"get_current_nomad_job_dispatch_by_processing_task_id(task BIGINT) RETURNS TABLE ({_DISPATCH})":
        """SELECT x.j.id, x.j.nomad_job_dispatch, x.j.dispatch_date, x.j.log_path FROM (
            SELECT max(struct(j.dispatch_date, s.last_status, j.id, j.nomad_job_dispatch, j.log_path)) AS j
            FROM nomad_job_dispatch j JOIN processingtask2nomad n ON n.nomad_job_id = j.id
            LEFT JOIN (SELECT nomad_job_dispatch_fk_id AS job, max(date) AS last_status FROM processing_status_workflow
                GROUP BY nomad_job_dispatch_fk_id) s ON s.job = j.id WHERE n.processing_task_id = task) x WHERE x.j IS NOT NULL""",
    "are_all_processing_tasks_in_vm_processed(vm STRING) RETURNS BOOLEAN":
        "SELECT bool_and(t.is_processed) FROM processed_flag_v t JOIN task_worker_v w ON w.id = t.id WHERE w.worker = vm",
    f"get_preceding_processing_task(task BIGINT) RETURNS TABLE ({_TASK})":
        f"""SELECT {_TASK_COLUMNS} FROM processing_tasks q JOIN raw2valid m ON m.raw_input_id = q.preceding_input_id
        JOIN processing_tasks p ON p.trigger_validation_fk_id = m.trigger_validation_id WHERE q.id = task""",
    "is_preceding_processing_task_processed(task BIGINT) RETURNS BOOLEAN":
        """SELECT bool_or(t.is_processed) FROM processing_tasks q JOIN raw2valid m ON m.raw_input_id = q.preceding_input_id
        JOIN processed_flag_v t ON t.trigger_validation_fk_id = m.trigger_validation_id WHERE q.id = task""",
    "is_one_processing_task_processed_for_an_input(input_id STRING) RETURNS BOOLEAN":
        "SELECT bool_or(s.any_processed) FROM input_summary_v s WHERE s.raw_input_id = input_id",
    "are_all_processing_tasks_ended_for_an_input(input_id STRING) RETURNS BOOLEAN":
        "SELECT coalesce(bool_and(NOT s.any_unfinished), false) FROM input_summary_v s WHERE s.raw_input_id = input_id",
    "get_ids_of_processing_tasks_ready_to_be_launched() RETURNS TABLE (id BIGINT)": "SELECT id FROM ready_to_launch_v",
    "get_id_of_unprocessed_inputs_with_all_pt_ended(since TIMESTAMP_NTZ) RETURNS TABLE (raw_input_id STRING)":
        """SELECT m.raw_input_id FROM raw2valid m JOIN processing_tasks p ON p.trigger_validation_fk_id = m.trigger_validation_id
        JOIN input_summary_v s ON s.raw_input_id = m.raw_input_id WHERE p.has_ended AND p.creation_date > since
        AND NOT s.any_processed AND NOT s.any_unfinished GROUP BY m.raw_input_id""",
    "is_product_indexed(product STRING) RETURNS BOOLEAN":
        """SELECT coalesce(bool_or(w.indexation_date IS NOT NULL), false) FROM indexation_workflow w
        WHERE w.product_fk_id = product""",
    "is_product_indexation_currently_failed(product STRING) RETURNS BOOLEAN":
        """SELECT coalesce(max_by(w.failure_date IS NOT NULL, w.id), false) FROM indexation_workflow w
        WHERE w.product_fk_id = product""",
    "get_indexation_file_path_by_type_name_by_product_id(type_name STRING, product STRING) RETURNS STRING":
        """SELECT max(j.path) FROM indexation_json j JOIN indexation_file_type f ON f.id = j.indexation_file_type_id
        WHERE j.product_fk_id = product AND f.name = type_name""",
}


def register(spark: SparkSession, cat: Catalogue) -> list[str]:
    """Create the views and functions; returns the names of the functions."""
    for table in TABLES:
        getattr(cat, table).createOrReplaceTempView(table)
    tasks = cat.processing_tasks
    worker = F.col(WORKER) if WORKER in tasks.columns else F.lit(None)
    tasks.select("id", worker.cast("string").alias("worker")).createOrReplaceTempView("task_worker_v")
    inputs_without_task(cat).createOrReplaceTempView("inputs_without_task_v")
    processed_flag(cat).createOrReplaceTempView("processed_flag_v")
    input_task_summary(cat).createOrReplaceTempView("input_summary_v")
    ready_to_launch(cat).createOrReplaceTempView("ready_to_launch_v")
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.split("(")[0] for head in FUNCTIONS]

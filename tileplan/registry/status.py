"""AGG, WIN, SET-01 and JON-31..38 queries."""

from pyspark.sql import functions as F

from tileplan.operators import status as op
from tileplan.registry import query

_RUNS = "processingtask2nomad n JOIN processing_status_workflow s ON s.nomad_job_dispatch_fk_id = n.nomad_job_id"
_DONE = f"SELECT n.processing_task_id FROM {_RUNS} WHERE s.processing_status_id = 2"


@query("agg01_error_count", f"""SELECT p.id, count(x.processing_task_id) AS error_count FROM processing_tasks p
    LEFT JOIN (SELECT n.processing_task_id FROM {_RUNS} WHERE s.processing_status_id IN (4, 5)) x
    ON x.processing_task_id = p.id GROUP BY p.id""")
def _(fx):
    return op.error_count(fx)


@query("agg02_retry_error_count", f"""SELECT n.processing_task_id, count(*) AS number_of_error_by_pt FROM {_RUNS}
    WHERE s.processing_status_id BETWEEN 4 AND 5 AND s.exit_code <> 109 AND s.exit_code <> 404 GROUP BY 1""")
def _(fx):
    return op.retry_error_count(fx)


@query("agg03_all_processed", f"""SELECT p.id % 7 AS worker, min(p.id IN ({_DONE})) AS all_processed
    FROM processing_tasks p GROUP BY 1""")
def _(fx):
    return op.all_processed(op.processed_flag(fx).withColumn("worker", F.col("id") % 7), "worker")


_BY_INPUT = f"""SELECT m.raw_input_id, max(p.id IN ({_DONE})) AS any_processed, max(p.has_ended IS FALSE) AS any_open,
    max(p.has_ended AND p.creation_date > TIMESTAMP '2024-01-10 00:00:00') AS recent
    FROM raw2valid m JOIN processing_tasks p ON p.trigger_validation_fk_id = m.trigger_validation_id GROUP BY 1"""


@query("agg04_any_processed_by_input", f"SELECT raw_input_id, any_processed FROM ({_BY_INPUT}) b")
def _(fx):
    return op.any_processed_by_input(fx)


@query("agg05_all_ended_by_input", f"""SELECT r.id, coalesce(NOT b.any_open, false) AS all_ended FROM raw_inputs r
    LEFT JOIN ({_BY_INPUT}) b ON b.raw_input_id = r.id""")
def _(fx):
    return op.all_ended_by_input(fx)


@query("agg06_inputs_to_replan", f"""SELECT raw_input_id FROM ({_BY_INPUT}) b
    WHERE recent AND NOT any_processed AND NOT any_open""")
def _(fx):
    return op.inputs_to_replan(fx, "2024-01-10 00:00:00")


@query("agg12_wic_pairs", """SELECT a.tile, a.measurement_day, a.id AS id_wics1, b.id AS wics2_id FROM raw_inputs a, raw_inputs b
    WHERE a.product_type_code = 'S1_WICS1_L2B' AND b.product_type_code = 'S2_WICS2_L2B' AND a.tile = b.tile
    AND a.measurement_day = b.measurement_day""")
def _(fx):
    return op.wic_pairs(fx.raw_inputs)


@query("agg14_not_successful", """WITH work AS (SELECT r.measurement_day, n.nomad_job_id FROM raw_inputs r
        JOIN raw2valid m ON m.raw_input_id = r.id JOIN trigger_validation v ON v.id = m.trigger_validation_id
        JOIN processing_tasks p ON p.trigger_validation_fk_id = v.id
        LEFT JOIN processingtask2nomad n ON n.processing_task_id = p.id
        WHERE NOT p.has_ended AND v.triggering_condition_name IN ('CC_TC', 'Backscatter_10m_TC', 'FSC_TC', 'SWS_TC')),
    last_status AS (SELECT nomad_job_dispatch_fk_id AS job, arg_max(processing_status_id, (date, id)) AS status
        FROM processing_status_workflow GROUP BY 1)
    SELECT measurement_day, count(*) FILTER (nomad_job_id IS NULL)
        + count(DISTINCT nomad_job_id) FILTER (status NOT IN (2, 6)) AS total
    FROM work LEFT JOIN last_status ON job = nomad_job_id GROUP BY measurement_day""")
def _(fx):
    return op.not_successful(fx, ["CC_TC", "Backscatter_10m_TC", "FSC_TC", "SWS_TC"])


@query("agg15_routine_types", """SELECT DISTINCT pr.product_type_code FROM processing_routine pr
    WHERE pr.product_type_code IN (SELECT product_type_code FROM raw_inputs)""")
def _(fx):
    present = fx.raw_inputs.select("product_type_code").distinct()
    return op.routine_types(fx.processing_routine).join(present, "product_type_code", "left_semi")


@query("win01_latest_status", """SELECT nomad_job_dispatch_fk_id, processing_status_id, date, exit_code
    FROM processing_status_workflow
    QUALIFY row_number() OVER (PARTITION BY nomad_job_dispatch_fk_id ORDER BY date DESC, id DESC) = 1""")
def _(fx):
    return op.latest_status(fx.processing_status_workflow)


@query("win02_current_dispatch", """SELECT n.processing_task_id, n.nomad_job_id, j.dispatch_date
    FROM processingtask2nomad n JOIN nomad_job_dispatch j ON j.id = n.nomad_job_id
    QUALIFY row_number() OVER (PARTITION BY n.processing_task_id ORDER BY j.dispatch_date DESC, j.id DESC) = 1""")
def _(fx):
    return op.current_dispatch(fx)


@query("win03_last_input", """SELECT product_type_code, start_date AS last_start_date,
    publishing_date AS last_publishing_date FROM raw_inputs
    QUALIFY row_number() OVER (PARTITION BY product_type_code ORDER BY start_date DESC, id DESC) = 1""")
def _(fx):
    return op.last_input(fx.raw_inputs)


@query("win04_index_failed", """SELECT product_fk_id AS id, failure_date IS NOT NULL AS is_failed FROM indexation_workflow
    QUALIFY row_number() OVER (PARTITION BY product_fk_id ORDER BY id DESC) = 1""")
def _(fx):
    return op.index_failed(fx.products, fx.indexation_workflow)


@query("win07_newest_first", "SELECT * FROM raw_inputs")
def _(fx):
    return op.ordered(fx.raw_inputs, *op.newest_first())


@query("win07_oldest_day_first", "SELECT * FROM raw_inputs WHERE product_type_code = 'S2MSI1C'")
def _(fx):
    return op.ordered(fx.raw_inputs.filter(F.col("product_type_code") == "S2MSI1C"), *op.oldest_day_first())


@query("jon31_status_history", f"""SELECT n.processing_task_id, s.id, s.date AS processing_status_date,
    k.code AS processing_status_code, k.name AS processing_status_name, s.message AS processing_status_message
    FROM {_RUNS} JOIN processing_status k ON k.id = s.processing_status_id""")
def _(fx):
    return op.status_history(fx)


@query("jon32_dispatches", """SELECT n.processing_task_id, j.id AS nomad_job_id, j.nomad_job_dispatch,
    j.dispatch_date AS nomad_job_dispatch_creation_date, j.log_path AS nomad_job_dispatch_log_file_path
    FROM nomad_job_dispatch j, processingtask2nomad n WHERE n.nomad_job_id = j.id""")
def _(fx):
    return op.dispatches(fx)


@query("jon33_processed_flag", f"""SELECT p.id, p.trigger_validation_fk_id, p.has_ended, p.creation_date,
    p.id IN ({_DONE}) AS is_processed FROM processing_tasks p""")
def _(fx):
    return op.processed_flag(fx)


@query("jon34_preceding_task", """SELECT p.id, q.id AS preceding_task_id FROM processing_tasks p
    JOIN raw2valid m ON m.raw_input_id = p.preceding_input_id
    JOIN processing_tasks q ON q.trigger_validation_fk_id = m.trigger_validation_id""")
def _(fx):
    return op.preceding_task(fx)


_BEFORE = f"""SELECT p.id, max(q.id IN ({_DONE})) AS preceding_processed FROM processing_tasks p
    JOIN raw2valid m ON m.raw_input_id = p.preceding_input_id
    JOIN processing_tasks q ON q.trigger_validation_fk_id = m.trigger_validation_id GROUP BY p.id"""


@query("jon35_preceding_processed", _BEFORE)
def _(fx):
    return op.preceding_processed(fx)


@query("jon36_ready_to_launch", f"""SELECT p.id FROM processing_tasks p
    WHERE p.id NOT IN (SELECT processing_task_id FROM processingtask2nomad) AND (p.preceding_input_id IS NULL
    OR p.id IN (SELECT id FROM ({_BEFORE}) b WHERE preceding_processed))""")
def _(fx):
    return op.ready_to_launch(fx)


@query("jon37_indexed_flag", """SELECT p.id, EXISTS (SELECT 1 FROM indexation_workflow w WHERE w.product_fk_id = p.id
    AND w.indexation_date IS NOT NULL) AS is_indexed FROM products p""")
def _(fx):
    return op.indexed_flag(fx.products, fx.indexation_workflow)


@query("jon38_index_file", """SELECT p.id AS product_id, j.path FROM products p
    JOIN indexation_json j ON j.product_fk_id = p.id JOIN indexation_file_type f ON f.id = j.indexation_file_type_id
    WHERE f.name = 'INSPIRE'""")
def _(fx):
    return op.index_file(fx, "INSPIRE")

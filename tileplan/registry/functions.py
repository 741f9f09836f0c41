"""UDF-01 queries: the SQL functions called for every row of a table."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tileplan.functions import sql_functions
from tileplan.registry import query
from tileplan.registry.status import _BEFORE, _BY_INPUT, _DONE, _RUNS
from tileplan.sources import sinks


def _sql(fx, text):
    sql_functions.register(fx._spark, fx)
    return fx._spark.sql(text)


@query("udf01_task_functions", f"""SELECT p.id, p.id IN ({_DONE}) AS processed,
    (SELECT count(*) FROM {_RUNS} WHERE n.processing_task_id = p.id AND s.processing_status_id IN (4, 5)) AS n_errors,
    b.preceding_processed FROM processing_tasks p LEFT JOIN ({_BEFORE}) b ON b.id = p.id""")
def _(fx):
    return _sql(fx, """SELECT id, is_processing_task_processed(id) AS processed,
        get_number_of_error_statuses_by_processing_task(id) AS n_errors,
        is_preceding_processing_task_processed(id) AS preceding_processed FROM processing_tasks""")


@query("udf01_input_functions", f"""SELECT r.id, b.any_processed AS one_processed,
    coalesce(NOT b.any_open, false) AS all_ended FROM raw_inputs r LEFT JOIN ({_BY_INPUT}) b ON b.raw_input_id = r.id""")
def _(fx):
    return _sql(fx, """SELECT id, is_one_processing_task_processed_for_an_input(id) AS one_processed,
        are_all_processing_tasks_ended_for_an_input(id) AS all_ended FROM raw_inputs""")


@query("udf01_product_functions", """SELECT p.id, EXISTS (SELECT 1 FROM indexation_workflow w WHERE w.product_fk_id = p.id
    AND w.indexation_date IS NOT NULL) AS indexed,
    (SELECT arg_max(w.failure_date IS NOT NULL, w.id) FROM indexation_workflow w WHERE w.product_fk_id = p.id) AS failed,
    j.path FROM products p JOIN indexation_json j ON j.product_fk_id = p.id""")
def _(fx):
    return _sql(fx, """SELECT id, is_product_indexed(id) AS indexed, is_product_indexation_currently_failed(id) AS failed,
        get_indexation_file_path_by_type_name_by_product_id('INSPIRE', id) AS path FROM products""")


@query("udf01_table_functions", f"""SELECT p.id, n.nomad_job_id, k.name AS status FROM processing_tasks p
    JOIN (SELECT n.processing_task_id, n.nomad_job_id FROM processingtask2nomad n JOIN nomad_job_dispatch j ON j.id = n.nomad_job_id
        QUALIFY row_number() OVER (PARTITION BY n.processing_task_id ORDER BY j.dispatch_date DESC, j.id DESC) = 1) n
    ON n.processing_task_id = p.id
    JOIN processingtask2nomad m ON m.processing_task_id = p.id
    JOIN processing_status_workflow s ON s.nomad_job_dispatch_fk_id = m.nomad_job_id
    JOIN processing_status k ON k.id = s.processing_status_id WHERE p.has_ended IS FALSE""")
def _(fx):
    return _sql(fx, """SELECT p.id, d.nomad_job_id, h.processing_status_name AS status
        FROM get_processing_tasks_not_finished() p, LATERAL get_current_nomad_job_dispatch_by_processing_task_id(p.id) d,
        LATERAL get_status_history_by_processing_task_id(p.id) h""")


@query("udf01_ready_tasks", f"""SELECT p.id FROM processing_tasks p
    WHERE p.id NOT IN (SELECT processing_task_id FROM processingtask2nomad) AND (p.preceding_input_id IS NULL
    OR p.id IN (SELECT id FROM ({_BEFORE}) b WHERE preceding_processed))""")
def _(fx):
    return _sql(fx, "SELECT id FROM get_ids_of_processing_tasks_ready_to_be_launched()")


@query("udf01_input_lookups", """SELECT 'path' AS kind, a.id AS given, b.id AS found FROM raw_inputs a JOIN raw_inputs b ON b.input_path = a.input_path
    UNION ALL SELECT 'day', CAST(measurement_day AS STRING), id FROM raw_inputs
    UNION ALL SELECT 'type', r.product_type_code, r.id FROM raw_inputs r JOIN processing_routine f ON f.product_type_code = r.product_type_code
        JOIN triggering_condition c ON c.processing_routine_name = f.name
    UNION ALL SELECT 'open', 'all', r.id FROM raw2valid m JOIN raw_inputs r ON r.id = m.raw_input_id
        WHERE m.trigger_validation_id NOT IN (SELECT trigger_validation_fk_id FROM processing_tasks)""")
def _(fx):
    return _sql(fx, """SELECT 'path' AS kind, r.id AS given, x.id AS found FROM raw_inputs r, LATERAL get_input_by_input_path(r.input_path) x
        UNION ALL SELECT 'day', CAST(d.measurement_day AS STRING), x.id FROM (SELECT DISTINCT measurement_day FROM raw_inputs) d,
            LATERAL get_input_by_measurement_day(d.measurement_day) x
        UNION ALL SELECT 'type', t.product_type_code, x.id FROM (SELECT DISTINCT product_type_code FROM raw_inputs) t,
            LATERAL get_input_by_input_type(t.product_type_code) x
        UNION ALL SELECT 'open', 'all', x.id FROM get_input_without_processing_task() x""")


@query("udf01_task_lookups", f"""SELECT 'dispatch' AS kind, CAST(n.processing_task_id AS STRING) AS given, j.id AS found
    FROM processingtask2nomad n JOIN nomad_job_dispatch j ON j.id = n.nomad_job_id JOIN processing_tasks p ON p.id = n.processing_task_id
    UNION ALL SELECT 'before', CAST(p.id AS STRING), CAST(q.id AS STRING) FROM processing_tasks p
        JOIN raw2valid m ON m.raw_input_id = p.preceding_input_id JOIN processing_tasks q ON q.trigger_validation_fk_id = m.trigger_validation_id
    UNION ALL SELECT 'replan', 'all', raw_input_id FROM ({_BY_INPUT}) b WHERE recent AND NOT any_processed AND NOT any_open""")
def _(fx):
    return _sql(fx, """SELECT 'dispatch' AS kind, CAST(p.id AS STRING) AS given, d.nomad_job_id AS found
            FROM processing_tasks p, LATERAL get_nomad_job_dispatch_list_by_processing_task_id(p.id) d
        UNION ALL SELECT 'before', CAST(p.id AS STRING), CAST(x.id AS STRING) FROM processing_tasks p,
            LATERAL get_preceding_processing_task(p.id) x
        UNION ALL SELECT 'replan', 'all', x.raw_input_id
            FROM get_id_of_unprocessed_inputs_with_all_pt_ended(TIMESTAMP_NTZ '2024-01-10 00:00:00') x""")


@query("udf01_worker_function", f"""SELECT concat('vm-', CAST(id % 7 AS STRING)) AS vm, bool_and(id IN ({_DONE})) AS all_processed
    FROM processing_tasks GROUP BY 1""")
def _(fx):
    """Tasks with the optional column of the worker they run on."""
    worker = F.concat(F.lit("vm-"), (F.col("id") % 7).cast("string"))
    named = fx.replace(processing_tasks=fx.processing_tasks.withColumn(sql_functions.WORKER, worker))
    sql_functions.register(fx._spark, named)
    return fx._spark.sql(f"""SELECT vm, are_all_processing_tasks_in_vm_processed(vm) AS all_processed
        FROM (SELECT DISTINCT {sql_functions.WORKER} AS vm FROM processing_tasks) w""")


_LATE = """(SELECT id, CASE WHEN CAST(substr(md5(id), 1, 1) AS STRING) < '8' THEN dispatch_date END AS dispatch_date FROM nomad_job_dispatch)"""


@query("udf01_current_dispatch", f"""SELECT p.id, n.job AS nomad_job_id FROM processing_tasks p JOIN (
    SELECT n.processing_task_id AS task, j.id AS job FROM processingtask2nomad n JOIN {_LATE} j ON j.id = n.nomad_job_id
    LEFT JOIN (SELECT nomad_job_dispatch_fk_id AS job, max(date) AS last FROM processing_status_workflow GROUP BY 1) s ON s.job = j.id
    QUALIFY row_number() OVER (PARTITION BY n.processing_task_id ORDER BY j.dispatch_date DESC NULLS LAST, s.last DESC NULLS LAST,
        j.id DESC) = 1) n ON n.task = p.id""")
def _(fx):
    """Half of the dispatches have no date yet; the last status and the id decide among those."""
    late = F.when(F.substring(F.md5("id"), 1, 1) < "8", F.col("dispatch_date"))
    sql_functions.register(fx._spark, fx.replace(nomad_job_dispatch=fx.nomad_job_dispatch.withColumn("dispatch_date", late)))
    return fx._spark.sql("""SELECT p.id, d.nomad_job_id FROM processing_tasks p,
        LATERAL get_current_nomad_job_dispatch_by_processing_task_id(p.id) d""")


@query("snk07_all_cascades", """SELECT 'input' AS kind, id FROM raw_inputs WHERE measurement_day % 10 > 0
    UNION ALL SELECT 'link', raw_input_id FROM raw2valid WHERE raw_input_id NOT IN (SELECT id FROM raw_inputs WHERE measurement_day % 10 = 0)
    UNION ALL SELECT 'validation', CAST(id AS STRING) FROM trigger_validation WHERE id % 3 > 0
    UNION ALL SELECT 'member', CAST(trigger_validation_id AS STRING) FROM raw2valid WHERE trigger_validation_id NOT IN (
        SELECT id FROM trigger_validation WHERE id % 3 = 0)
    UNION ALL SELECT 'task', CAST(id AS STRING) FROM processing_tasks WHERE trigger_validation_fk_id NOT IN (
        SELECT id FROM trigger_validation WHERE id % 3 = 0)""")
def _(fx):
    """Inputs of some days with their links, and a third of the validations with their links and tasks."""
    days, (links,) = sinks.delete_cascade(fx.raw_inputs, "id", [(fx.raw2valid, "raw_input_id")],
                                          fx.raw_inputs.filter("measurement_day % 10 = 0"))
    heads, (members, tasks) = sinks.delete_cascade(
        fx.trigger_validation, "id", [(fx.raw2valid, "trigger_validation_id"), (fx.processing_tasks, "trigger_validation_fk_id")],
        fx.trigger_validation.filter("id % 3 = 0"))
    parts = [("input", days, "id"), ("link", links, "raw_input_id"), ("validation", heads, "id"),
             ("member", members, "trigger_validation_id"), ("task", tasks, "id")]
    return reduce(DataFrame.unionByName, [df.select(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("id"))
                                          for kind, df, c in parts])

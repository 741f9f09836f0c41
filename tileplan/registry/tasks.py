"""JON-20..30, AGG-07..11, SET and TSK queries."""

from pyspark.sql import functions as F

from tileplan.fixtures import AS_OF, CUTOVER
from tileplan.operators import tasks as op
from tileplan.registry import query

LARGE, SMALL = "hma.large", "eo1.large"

# The tasks of a flavour with a member since the cut-over, as the other selections use them.
_SINCE = f"""SELECT p.*, pr.flavour, pr.duration FROM processing_tasks p
    JOIN trigger_validation v ON v.id = p.trigger_validation_fk_id
    JOIN triggering_condition c ON c.name = v.triggering_condition_name
    JOIN processing_routine pr ON pr.name = c.processing_routine_name
    WHERE EXISTS (SELECT 1 FROM raw2valid m, raw_inputs r WHERE m.trigger_validation_id = v.id
                  AND r.id = m.raw_input_id AND r.measurement_day >= {CUTOVER})"""
_RUNS = f"""SELECT t.*, n.nomad_job_id, j.dispatch_date FROM ({_SINCE}) t
    JOIN processingtask2nomad n ON n.processing_task_id = t.id JOIN nomad_job_dispatch j ON j.id = n.nomad_job_id
    WHERE NOT t.has_ended"""
_STATUS = "SELECT 1 FROM processing_status_workflow s WHERE s.nomad_job_dispatch_fk_id = nomad_job_id"


@query("jon20_undispatched", f"""SELECT t.* EXCLUDE (duration) FROM ({_SINCE}) t WHERE t.flavour = '{LARGE}'
    AND t.id NOT IN (SELECT processing_task_id FROM processingtask2nomad)""")
def _(fx):
    return op.undispatched(fx, LARGE, CUTOVER)


@query("jon21_in_error", f"""SELECT DISTINCT t.* EXCLUDE (duration, nomad_job_id, dispatch_date) FROM ({_RUNS}) t
    WHERE t.flavour = '{LARGE}' AND EXISTS ({_STATUS} AND s.processing_status_id IN (4, 5))""")
def _(fx):
    return op.in_error(fx, LARGE, CUTOVER)


@query("jon22_unfinished", f"SELECT * FROM ({_RUNS}) t WHERE flavour = '{LARGE}'")
def _(fx):
    return op.unfinished(fx, LARGE, CUTOVER)


@query("jon23_unfinished_with_callback", f"SELECT * FROM ({_RUNS}) t WHERE flavour = '{LARGE}' AND EXISTS ({_STATUS})")
def _(fx):
    return op.unfinished_with_callback(fx, LARGE, CUTOVER)


@query("jon24_unfinished_with_exit_code", f"""SELECT * FROM ({_RUNS}) t WHERE flavour = '{SMALL}'
    AND EXISTS ({_STATUS} AND s.exit_code IS NOT NULL)""")
def _(fx):
    return op.unfinished_with_exit_code(fx, SMALL, CUTOVER)


_ARCHIVE = f"""SELECT DISTINCT p.*, pr.flavour, r.measurement_day FROM processing_tasks p
    JOIN trigger_validation v ON v.id = p.trigger_validation_fk_id JOIN raw2valid m ON m.trigger_validation_id = v.id
    JOIN raw_inputs r ON r.id = m.raw_input_id JOIN processing_routine pr ON pr.product_type_code = r.product_type_code
    WHERE r.tile IN (SELECT tile FROM tile_list) AND p.id NOT IN (SELECT processing_task_id FROM processingtask2nomad)"""


@query("jon25_archive_undispatched", f"""SELECT DISTINCT t.* EXCLUDE (measurement_day) FROM ({_ARCHIVE}) t
    WHERE flavour = '{SMALL}' AND measurement_day BETWEEN 20240103 AND 20240125""")
def _(fx):
    return op.archive_undispatched(fx, SMALL, fx.tile_list, 20240103, 20240125)


@query("agg11_oldest_archive_day", f"""SELECT min(r.measurement_day) AS oldest_day FROM raw_inputs r
    JOIN raw2valid m ON m.raw_input_id = r.id JOIN trigger_validation v ON v.id = m.trigger_validation_id
    JOIN processing_tasks p ON p.trigger_validation_fk_id = v.id
    WHERE NOT v.is_nrt AND r.product_type_code IN ('S1_WDS_L2B', 'S1_SWS_L2B', 'S1_WICS1_L2B')
    AND r.measurement_day < {CUTOVER} AND r.tile IN (SELECT tile FROM tile_list)
    AND NOT EXISTS (SELECT 1 FROM processingtask2nomad n WHERE n.processing_task_id = p.id)""")
def _(fx):
    return op.oldest_archive_day(fx, SMALL, fx.tile_list, CUTOVER)


@query("jon26_run_info", """SELECT DISTINCT p.id AS processing_task_id, v.id AS trigger_validation_id,
    p.preceding_input_id, p.intermediate_files_path, p.processing_date, r.id AS raw_input_id, r.tile, r.measurement_day,
    r.harvesting_date, r.relative_orbit_number, r.input_path, pr.name AS processing_routine_name, pr.product_type_code,
    pr.ram, pr.docker_image, pr.duration, pr.flavour
    FROM raw_inputs r JOIN raw2valid m ON m.raw_input_id = r.id JOIN trigger_validation v ON v.id = m.trigger_validation_id
    JOIN processing_tasks p ON p.trigger_validation_fk_id = v.id
    JOIN triggering_condition c ON c.name = v.triggering_condition_name
    JOIN processing_routine pr ON pr.name = c.processing_routine_name""")
def _(fx):
    return op.run_info(fx)


@query("jon27_currently_deployed", f"""SELECT DISTINCT p.id FROM processing_tasks p
    JOIN processingtask2nomad n ON n.processing_task_id = p.id
    WHERE NOT p.has_ended AND NOT EXISTS ({_STATUS} AND s.exit_code IS NOT NULL)""")
def _(fx):
    return op.currently_deployed(fx)


@query("jon29_task_with_flavour", """SELECT p.*, pr.flavour FROM processing_tasks p
    JOIN trigger_validation v ON v.id = p.trigger_validation_fk_id
    JOIN triggering_condition c ON c.name = v.triggering_condition_name
    JOIN processing_routine pr ON pr.name = c.processing_routine_name""")
def _(fx):
    return op.task_with_flavour(fx.processing_tasks, fx)


@query("jon30_task_of_error", """SELECT s.id AS status_id, p.* FROM processing_status_workflow s, processingtask2nomad n,
    processing_tasks p WHERE s.processing_status_id IN (4, 5) AND n.nomad_job_id = s.nomad_job_dispatch_fk_id
    AND p.id = n.processing_task_id""")
def _(fx):
    return op.task_of_error(fx.processing_status_workflow, fx)


_PROCESSED = """SELECT n.processing_task_id FROM processingtask2nomad n JOIN processing_status_workflow s
    ON s.nomad_job_dispatch_fk_id = n.nomad_job_id WHERE s.processing_status_id = 2"""


@query("agg07_unprocessed_task_count", f"""SELECT count(DISTINCT p.id) AS n_tasks FROM processing_tasks p
    JOIN raw2valid m ON m.trigger_validation_id = p.trigger_validation_fk_id
    WHERE p.creation_date > TIMESTAMP '2024-01-20 00:00:00' AND m.raw_input_id NOT IN (
        SELECT m2.raw_input_id FROM raw2valid m2 JOIN processing_tasks p2
        ON p2.trigger_validation_fk_id = m2.trigger_validation_id WHERE p2.id IN ({_PROCESSED}))""")
def _(fx):
    return op.unprocessed_task_count(fx, "2024-01-20 00:00:00")


_CC = """FROM trigger_validation v JOIN raw2valid m ON m.trigger_validation_id = v.id
    JOIN raw_inputs r ON r.id = m.raw_input_id LEFT JOIN processing_tasks p ON p.trigger_validation_fk_id = v.id
    WHERE v.triggering_condition_name = 'CC_TC' AND r.measurement_day > 20240101"""


@query("agg08_cc_unfinished_tiles", f"""SELECT r.tile {_CC} AND p.has_ended IS FALSE AND EXISTS (
    SELECT 1 FROM processingtask2nomad n JOIN processing_status_workflow s ON s.nomad_job_dispatch_fk_id = n.nomad_job_id
    WHERE n.processing_task_id = p.id AND s.exit_code IS NOT NULL) GROUP BY r.tile""")
def _(fx):
    return op.cc_unfinished_tiles(fx, 20240101)


@query("agg09_cc_undispatched_tiles", f"""SELECT r.tile, count(*) AS n_rows {_CC} AND p.id IS NOT NULL
    AND p.id NOT IN (SELECT processing_task_id FROM processingtask2nomad) GROUP BY r.tile""")
def _(fx):
    return op.cc_undispatched_tiles(fx, 20240101)


@query("agg10_cc_uncreated_tiles", f"SELECT r.tile, count(*) AS n_rows {_CC} AND p.id IS NULL GROUP BY r.tile")
def _(fx):
    return op.cc_uncreated_tiles(fx, 20240101)


@query("set02_lost_sets", f"""SELECT t.*, NOT EXISTS ({_STATUS}) AS no_callback, true AS no_exit_code FROM ({_RUNS}) t
    WHERE flavour = '{LARGE}' AND NOT EXISTS ({_STATUS} AND s.exit_code IS NOT NULL)""")
def _(fx):
    return op.lost_sets(fx, LARGE, CUTOVER)


@query("set03_lost_union", f"""SELECT t.id, t.nomad_job_id FROM ({_RUNS}) t WHERE flavour = '{LARGE}'
    AND NOT EXISTS ({_STATUS}) UNION SELECT t.id, t.nomad_job_id FROM ({_RUNS}) t WHERE flavour = '{LARGE}'
    AND NOT EXISTS ({_STATUS} AND s.exit_code IS NOT NULL)""")
def _(fx):
    lost = op.lost_sets(fx, LARGE, CUTOVER).select("id", "nomad_job_id", "no_callback", "no_exit_code")
    return lost.filter("no_callback").select("id", "nomad_job_id").union(
        lost.filter("no_exit_code").select("id", "nomad_job_id")).distinct()


def _planning():
    from tileplan.plans import planning as p

    return p


@query("tsk01_plan_tasks", f"""SELECT v.id AS trigger_validation_fk_id, TIMESTAMP '{AS_OF}' AS creation_date,
    CASE WHEN v.triggering_condition_name = 'GFSC_TC' THEN v.artificial_measurement_day END AS processing_date,
    false AS has_ended FROM trigger_validation v WHERE v.id IN (SELECT trigger_validation_id FROM raw2valid)
    AND v.id NOT IN (SELECT trigger_validation_fk_id FROM processing_tasks)""")
def _(fx):
    return _planning().plan_tasks(fx.raw2valid, fx.trigger_validation, fx.processing_tasks, AS_OF)[0]


# Sources joined to the inputs of their type: the windows each input's day falls in.
@query("tsk02_harvest_windows", """SELECT concat(triggering_condition_name, coalesce('/' || timeliness, '')) AS source,
    w.day AS window_start, w.day + 1 AS window_end, count(r.id) AS n_inputs FROM (SELECT *, CAST(unnest(generate_series(
        strptime(archive_harvest_start_date, '%Y%m%d'), strptime(archive_harvest_end_date, '%Y%m%d'), INTERVAL 1 DAY)) AS DATE) AS day
        FROM sources WHERE archive_harvest_end_date IS NOT NULL) w
    LEFT JOIN raw_inputs r ON CAST(r.publishing_date AS DATE) = w.day AND r.product_type_code = w.input_type
    GROUP BY 1, 2, 3""")
def _(fx):
    windows = _planning().harvest_windows(fx.sources, "ARCHIVE", AS_OF)
    kinds = fx.sources.select(F.concat_ws("/", "triggering_condition_name", "timeliness").alias("source"), "input_type")
    published = fx.raw_inputs.groupBy(F.col("product_type_code").alias("input_type"),
                                      F.to_date("publishing_date").alias("window_start")).agg(F.count("*").alias("n"))
    return (published.join(F.broadcast(windows.join(kinds, "source")), ["input_type", "window_start"], "right")
            .select("source", "window_start", "window_end", F.coalesce("n", F.lit(0)).alias("n_inputs")))


@query("tsk03_nrt_window", f"""SELECT concat(triggering_condition_name, coalesce('/' || timeliness, '')) AS source, input_type,
    TIMESTAMP '2024-01-26 00:00:00' AS min_measurement_date, CASE WHEN timeliness IS NOT NULL THEN TIMESTAMP '2024-01-26 00:00:00'
        ELSE greatest(TIMESTAMP '2024-01-26 00:00:00', (SELECT arg_max(publishing_date, start_date) FROM raw_inputs r
            WHERE r.product_type_code = s.input_type)) END AS min_publication_date,
    TIMESTAMP '{AS_OF}' AS max_publication_date FROM sources s""")
def _(fx):
    return _planning().nrt_window(fx.sources, fx.raw_inputs, AS_OF)


_AGES = "(SELECT nomad_job_id, CASE WHEN processing_task_id % 50 = 0 THEN NULL ELSE processing_task_id % 4000 END AS age FROM processingtask2nomad)"


@query("tsk04_lost_tasks", f"""SELECT t.nomad_job_id AS nomad_job_dispatch_fk_id, 4 AS processing_status_id,
    TIMESTAMP '{AS_OF}' AS date, 404 AS exit_code FROM ({_RUNS}) t JOIN {_AGES} a ON a.nomad_job_id = t.nomad_job_id
    WHERE t.flavour = '{LARGE}' AND NOT EXISTS (SELECT 1 FROM processing_status_workflow s
        WHERE s.nomad_job_dispatch_fk_id = t.nomad_job_id AND s.exit_code IS NOT NULL)
    AND (a.age IS NULL OR a.age = 0 OR a.age > 180 * CASE WHEN t.duration < 7 THEN 7 ELSE t.duration END)""")
def _(fx):
    ages = fx.sql(f"SELECT * FROM {_AGES} a")
    return _planning().lost_tasks(fx, ages, LARGE, AS_OF, CUTOVER)


@query("tsk05_archive_batch", f"""SELECT DISTINCT t.* EXCLUDE (measurement_day) FROM ({_ARCHIVE}) t WHERE flavour = '{SMALL}'
    AND measurement_day BETWEEN (SELECT min(x.measurement_day) FROM ({_ARCHIVE}) x JOIN trigger_validation v
        ON v.id = x.trigger_validation_fk_id WHERE x.flavour = '{SMALL}' AND NOT v.is_nrt) AND 20240124""")
def _(fx):
    from tileplan.sources.reference import code_table, run_params

    params = run_params(code_table(fx._spark, "launcher_config"))
    return _planning().archive_batch(fx, SMALL, fx.tile_list, params, 20240125)


@query("tsk06_launch_queue", f"""SELECT t.* EXCLUDE (duration) FROM ({_SINCE}) t WHERE t.flavour = '{LARGE}' AND t.id % 3 > 0
    AND (t.id NOT IN (SELECT processing_task_id FROM processingtask2nomad) OR (NOT t.has_ended AND EXISTS (
        SELECT 1 FROM processingtask2nomad n, processing_status_workflow s WHERE n.processing_task_id = t.id
        AND s.nomad_job_dispatch_fk_id = n.nomad_job_id AND s.processing_status_id IN (4, 5))))
    AND t.id NOT IN (SELECT p.id FROM processing_tasks p JOIN processingtask2nomad n ON n.processing_task_id = p.id
        WHERE NOT p.has_ended AND NOT EXISTS ({_STATUS} AND s.exit_code IS NOT NULL))""")
def _(fx):
    pending = op.undispatched(fx, LARGE, CUTOVER).unionByName(op.in_error(fx, LARGE, CUTOVER))
    queued = fx.processing_tasks.filter(F.col("id") % 3 == 0)
    return _planning().launch_queue(pending, queued, op.currently_deployed(fx))

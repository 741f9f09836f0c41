"""JON-01..19, 28, 39 queries."""

from pyspark.sql import functions as F

from tileplan.fixtures import AS_OF
from tileplan.operators import inputs as op
from tileplan.registry import query
from tileplan.session import moment
from tileplan.sources.reference import code_table


def l1c(fx):
    return fx.raw_inputs.filter(F.col("product_type_code") == "S2MSI1C")


@query("jon01_inputs_by_type", """SELECT r.*, c.name AS condition FROM raw_inputs r, processing_routine p,
    triggering_condition c WHERE r.product_type_code = 'S1_SWS_L2B' AND p.product_type_code = r.product_type_code
    AND c.processing_routine_name = p.name""")
def _(fx):
    return op.inputs_by_type(fx, "S1_SWS_L2B")


@query("jon02_inputs_without_task", """SELECT r.*, m.trigger_validation_id FROM raw2valid m
    JOIN raw_inputs r ON r.id = m.raw_input_id
    WHERE m.trigger_validation_id NOT IN (SELECT trigger_validation_fk_id FROM processing_tasks)""")
def _(fx):
    return op.inputs_without_task(fx)


@query("jon03_new_products", """SELECT id, product_type_code, product_path,
    strftime(creation_date, '%Y-%m-%dT%H:%M:%S.%g') AS creation_date,
    strftime(catalogue_date, '%Y-%m-%dT%H:%M:%S.%g') AS catalogue_date, kpi_file_path
    FROM products WHERE id NOT IN (SELECT id FROM raw_inputs)""")
def _(fx):
    return op.new_products(fx.products, fx.raw_inputs)


def _unvalidated(condition, types):
    return f"""SELECT r.* FROM raw_inputs r LEFT JOIN (SELECT DISTINCT m.raw_input_id FROM raw2valid m
        JOIN trigger_validation v ON v.id = m.trigger_validation_id
        WHERE v.triggering_condition_name = '{condition}') x ON x.raw_input_id = r.id
        WHERE x.raw_input_id IS NULL AND r.product_type_code IN ({types})"""


@query("jon04_unvalidated_inputs", _unvalidated("FSC_TC", "'S2_MAJA_L2A', 'S2_FSC_L2B'"))
def _(fx):
    return op.unvalidated_inputs(fx, "FSC_TC", ["S2_MAJA_L2A", "S2_FSC_L2B"])


# Candidates: every event once more, two thirds of them with a path of their own.
_CAND = """(SELECT concat(input_path, CASE WHEN measurement_day % 3 = 0 THEN '' ELSE '/new' END) AS input_path,
    tile, start_date, measurement_day FROM raw_inputs)"""


def candidates(fx):
    return fx.sql(f"SELECT * FROM {_CAND} c")


@query("jon05_new_by_path", f"""SELECT * FROM {_CAND} c WHERE input_path NOT IN
    (SELECT input_path FROM raw_inputs WHERE measurement_day >= 20240110 AND product_type_code = 'S2MSI1C')""")
def _(fx):
    return op.new_by_path(candidates(fx), fx.raw_inputs, 20240110, "S2MSI1C")


@query("jon06_new_by_tile_start", f"""SELECT * FROM {_CAND} c WHERE (tile, start_date) NOT IN
    (SELECT (tile, start_date) FROM raw_inputs WHERE measurement_day >= 20240110 AND product_type_code = 'IW_GRDH_1S')""")
def _(fx):
    return op.new_by_tile_start(candidates(fx), fx.raw_inputs, 20240110, "IW_GRDH_1S")


@query("jon07_not_validated", _unvalidated("SWS_TC", "'S1_NRB_L2A'"))
def _(fx):
    return op.not_validated(fx.raw_inputs.filter(F.col("product_type_code") == "S1_NRB_L2A"), fx, "SWS_TC")


@query("jon08_same_tile_day", """SELECT a.id, a.tile, a.measurement_day, b.id AS partner_id FROM raw_inputs a
    JOIN raw_inputs b ON a.tile = b.tile AND a.measurement_day = b.measurement_day AND a.id <> b.id
    WHERE a.product_type_code IN ('S1_NRB_L2A', 'S2_FSC_L2B') AND b.product_type_code = 'S2_FSC_L2B'
    AND b.harvesting_date >= TIMESTAMP '2024-01-10 00:00:00'""")
def _(fx):
    left = fx.raw_inputs.filter(F.col("product_type_code").isin("S1_NRB_L2A", "S2_FSC_L2B"))
    return op.same_tile_day(left, fx.raw_inputs, "S2_FSC_L2B", moment("2024-01-10 00:00:00"))


@query("jon09_latest_sig0", """SELECT a.id, a.tile, a.measurement_day, b.id AS sig0_id, b.relative_orbit_number
    FROM raw_inputs a JOIN raw_inputs b ON a.tile = b.tile AND a.measurement_day = b.measurement_day
    WHERE a.product_type_code = 'S2_FSC_L2B' AND b.product_type_code = 'S1_NRB_L2A'
    AND b.harvesting_date >= TIMESTAMP '2024-01-10 00:00:00'
    QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY b.harvesting_date DESC, b.id DESC) = 1""")
def _(fx):
    fsc = fx.raw_inputs.filter(F.col("product_type_code") == "S2_FSC_L2B")
    return op.latest_sig0(fsc, fx.raw_inputs, moment("2024-01-10 00:00:00"))


_RANGE = """r.tile = a.tile AND strptime(CAST(r.measurement_day AS STRING), '%Y%m%d')
    BETWEEN strptime(CAST(a.measurement_day AS STRING), '%Y%m%d') - INTERVAL 90 DAY
    AND strptime(CAST(a.measurement_day AS STRING), '%Y%m%d')"""


@query("jon10_previous_l2a_exists", f"""SELECT a.*, EXISTS (SELECT 1 FROM processing_tasks p
    JOIN trigger_validation v ON v.id = p.trigger_validation_fk_id JOIN products x ON x.trigger_validation_fk_id = v.id
    JOIN raw2valid m ON m.trigger_validation_id = v.id JOIN raw_inputs r ON r.id = m.raw_input_id
    WHERE v.triggering_condition_name = 'CC_TC' AND {_RANGE}) AS previous_l2a
    FROM raw_inputs a WHERE a.product_type_code = 'S2MSI1C'""")
def _(fx):
    return op.previous_l2a_exists(l1c(fx), fx)


@query("jon11_pending_cc_exists", f"""SELECT a.*, EXISTS (SELECT 1 FROM trigger_validation v
    JOIN raw2valid m ON m.trigger_validation_id = v.id JOIN raw_inputs r ON r.id = m.raw_input_id
    WHERE v.triggering_condition_name = 'CC_TC' AND {_RANGE}
    AND v.id NOT IN (SELECT trigger_validation_fk_id FROM processing_tasks)) AS pending_cc
    FROM raw_inputs a WHERE a.product_type_code = 'S2MSI1C'""")
def _(fx):
    return op.pending_cc_exists(l1c(fx), fx)


@query("jon12_latest_l2a", f"""SELECT a.id, a.tile, a.measurement_day, r.id AS l2a_id, r.measurement_day AS l2a_day
    FROM raw_inputs a JOIN raw_inputs r ON {_RANGE}
    WHERE a.product_type_code = 'S2MSI1C' AND r.product_type_code = 'S2_MAJA_L2A'
    QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY r.measurement_day DESC, r.id DESC) = 1""")
def _(fx):
    return op.latest_l2a(l1c(fx), fx.raw_inputs)


@query("jon13_unprocessed_l1c", """SELECT * FROM raw_inputs WHERE product_type_code = 'S2MSI1C'
    AND id NOT IN (SELECT raw_input_id FROM raw2valid)""")
def _(fx):
    return op.unprocessed_l1c(fx.raw_inputs, fx.raw2valid)


@query("jon14_unprocessed_grd", """SELECT * FROM raw_inputs WHERE product_type_code = 'IW_GRDH_1S' AND is_partial
    AND harvesting_date >= TIMESTAMP '2024-01-24 00:00:00' AND id NOT IN (SELECT raw_input_id FROM raw2valid)""")
def _(fx):
    return op.unprocessed_grd(fx.raw_inputs, fx.raw2valid, AS_OF)


@query("jon15_task_today", """SELECT DISTINCT v.triggering_condition_name AS condition, r.tile, r.measurement_day
    FROM processing_tasks p JOIN trigger_validation v ON v.id = p.trigger_validation_fk_id
    JOIN raw2valid m ON m.trigger_validation_id = v.id JOIN raw_inputs r ON r.id = m.raw_input_id
    WHERE p.creation_date >= TIMESTAMP '2024-01-30 00:00:00'""")
def _(fx):
    return op.task_today(fx, "2024-01-30 15:00:00")


@query("jon16_inputs_in_progress", """SELECT r.id, r.tile, s.id AS status_id FROM raw_inputs r
    JOIN raw2valid m ON m.raw_input_id = r.id JOIN processing_tasks p ON p.trigger_validation_fk_id = m.trigger_validation_id
    JOIN processingtask2nomad n ON n.processing_task_id = p.id
    JOIN processing_status_workflow s ON s.nomad_job_dispatch_fk_id = n.nomad_job_id
    WHERE r.measurement_day = 20240112 AND r.product_type_code IN ('S2MSI1C', 'S2_MAJA_L2A')
    AND p.has_ended IS FALSE AND s.processing_status_id IN (1, 2)""")
def _(fx):
    return op.inputs_in_progress(fx, 20240112, ["S2MSI1C", "S2_MAJA_L2A"], [1, 2])


@query("jon17_members_without_task", """SELECT * FROM raw2valid
    WHERE trigger_validation_id NOT IN (SELECT trigger_validation_fk_id FROM processing_tasks)""")
def _(fx):
    return op.members_without_task(fx.raw2valid, fx.processing_tasks)


@query("jon18_task_of_validation", """SELECT p.id AS processing_task_id, p.trigger_validation_fk_id
    FROM processing_tasks p, trigger_validation v
    WHERE v.id = p.trigger_validation_fk_id AND v.triggering_condition_name = 'GFSC_TC'""")
def _(fx):
    gfsc = fx.trigger_validation.filter(F.col("triggering_condition_name") == "GFSC_TC")
    return op.task_of_validation(fx.processing_tasks, gfsc)


@query("jon19_routine_by_condition", """SELECT v.id, p.name AS name, p.product_type_code, p.cpu, p.ram, p.storage_space,
    p.duration, p.docker_image, p.flavour, c.name AS tc_name FROM trigger_validation v
    JOIN triggering_condition c ON c.name = v.triggering_condition_name
    JOIN processing_routine p ON p.name = c.processing_routine_name""")
def _(fx):
    routines = op.conditions_with_routine(fx)
    return (fx.trigger_validation.select("id", F.col("triggering_condition_name").alias("tc_name"))
            .join(F.broadcast(routines), "tc_name"))


@query("jon28_validation_day", """SELECT m.trigger_validation_id, m.raw_input_id, v.triggering_condition_name,
    v.artificial_measurement_day FROM raw2valid m JOIN trigger_validation v ON v.id = m.trigger_validation_id
    WHERE m.raw_input_id IN (SELECT id FROM raw_inputs)""")
def _(fx):
    return op.validation_day(fx)


@query("jon39_products_becoming_inputs", """SELECT DISTINCT p.product_path, p.creation_date, r.tile, r.measurement_day
    FROM products p JOIN raw2valid m ON m.trigger_validation_id = p.trigger_validation_fk_id
    JOIN raw_inputs r ON r.id = m.raw_input_id
    WHERE p.product_type_code IN ('S2_FSC_L2B', 'S1_SWS_L2B', 'S1_WICS1_L2B', 'S2_WICS2_L2B', 'S1_NRB_L2A',
    'S2_MAJA_L2A', 'S2MSI1C', 'IW_GRDH_1S') AND p.creation_date >= TIMESTAMP '2024-01-05 00:00:00'""")
def _(fx):
    return op.products_becoming_inputs(fx, code_table(fx._spark, "condition_inputs"), "2024-01-05 00:00:00")

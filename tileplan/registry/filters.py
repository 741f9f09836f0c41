"""FLT queries."""

from pyspark.sql import functions as F

from tileplan.fixtures import CUTOVER
from tileplan.operators import filters as op
from tileplan.operators.tasks import task_inputs
from tileplan.registry import query
from tileplan.registry.triggers import rules_of

FRM, TO = "2024-01-05 00:00:00", "2024-01-20 12:00:00"


@query("flt01_tiles_by_state", "SELECT * FROM sentinel_tile WHERE state = 'IDLE'")
def _(fx):
    return op.tiles_by_state(fx.sentinel_tile, "IDLE")


@query("flt02_tiles_before", f"SELECT * FROM sentinel_tile WHERE state = 'ERROR' AND NOT acquisition_date > TIMESTAMP '{TO}'")
def _(fx):
    return op.tiles_before(fx.sentinel_tile, TO, "ERROR")


@query("flt03_tiles_after", f"SELECT * FROM sentinel_tile WHERE state = 'IDLE' AND NOT acquisition_date < TIMESTAMP '{FRM}'")
def _(fx):
    return op.tiles_after(fx.sentinel_tile, FRM, "IDLE")


@query("flt04_tiles_between", f"""SELECT * FROM sentinel_tile WHERE state = 'ERROR'
    AND acquisition_date BETWEEN TIMESTAMP '{FRM}' AND TIMESTAMP '{TO}'""")
def _(fx):
    return op.tiles_between(fx.sentinel_tile, FRM, TO, "ERROR")


@query("flt05_harvest_selection", f"""SELECT * FROM sentinel_tile WHERE state IN ('IDLE', 'ERROR')
    AND acquisition_date BETWEEN TIMESTAMP '{FRM}' AND TIMESTAMP '{TO}'""")
def _(fx):
    return op.harvest_selection(fx.sentinel_tile, FRM, TO)


@query("flt06_inputs_by_path", "SELECT * FROM raw_inputs WHERE input_path = 's3://BUCKET/28T08/IN00000000'")
def _(fx):
    return op.inputs_by_path(fx.raw_inputs, "s3://BUCKET/28T08/IN00000000")


@query("flt07_inputs_by_day", "SELECT * FROM raw_inputs WHERE measurement_day = 20240115")
def _(fx):
    return op.inputs_by_day(fx.raw_inputs, 20240115)


@query("flt08_tasks_not_finished", "SELECT * FROM processing_tasks WHERE has_ended IS FALSE")
def _(fx):
    return op.tasks_not_finished(fx.processing_tasks)


@query("flt09_cc_eligible", """SELECT r.* FROM raw_inputs r WHERE product_type_code = 'S2MSI1C'
    AND tile IN (SELECT tile FROM tile_list) AND CAST(publishing_date AS DATE) >= DATE '2024-01-24'
    AND measurement_day >= 20240101""")
def _(fx):
    l1c = fx.raw_inputs.filter(F.col("product_type_code") == "S2MSI1C")
    rules = rules_of(fx)
    return op.cc_eligible(l1c, fx.tile_list, rules.since("CC_TC"), rules.earliest_day("CC_TC"))


@query("flt10_orbit_valid", """SELECT r.* FROM raw_inputs r WHERE EXISTS (SELECT 1 FROM tile_track k
    WHERE k.tile = r.tile AND k.orbit = r.relative_orbit_number)""")
def _(fx):
    return op.orbit_valid(fx.raw_inputs, fx.tile_track)


@query("flt11_eligible_products", """SELECT * FROM named_products
    WHERE product_type_code NOT IN ('S2MSI1C', 'IW_GRDH_1S')""")
def _(fx):
    return op.eligible_products(fx.named_products)


_SCOPE = """SELECT DISTINCT p.id AS task_id, r.measurement_day, pr.flavour FROM processing_tasks p
    JOIN trigger_validation v ON v.id = p.trigger_validation_fk_id JOIN raw2valid m ON m.trigger_validation_id = v.id
    JOIN raw_inputs r ON r.id = m.raw_input_id JOIN triggering_condition c ON c.name = v.triggering_condition_name
    JOIN processing_routine pr ON pr.name = c.processing_routine_name"""


@query("flt12_by_flavour", f"SELECT * FROM ({_SCOPE}) s WHERE flavour = 'eo1.large'")
def _(fx):
    return op.by_flavour(task_inputs(fx).select("task_id", "measurement_day", "flavour").distinct(), "eo1.large")


@query("flt13_cutover", f"SELECT * FROM ({_SCOPE}) s WHERE measurement_day >= {CUTOVER}")
def _(fx):
    return op.cutover(task_inputs(fx).select("task_id", "measurement_day", "flavour").distinct(), CUTOVER)

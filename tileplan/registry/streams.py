"""STR queries: each stream is run over all that is there and its files are read back."""

from pyspark.sql import functions as F

from tileplan.fixtures import AS_OF, CUTOVER, GFSC_LAST_DAY
from tileplan.operators.tasks import currently_deployed
from tileplan.plans import triggers as trg
from tileplan.registry import query
from tileplan.registry.tasks import _AGES, _RUNS
from tileplan.registry.triggers import ALL, _CC_SQL, _GFSC, _WIC, _cand, _orphans_sql, _pairs_sql, rules_of
from tileplan.schemas import SCHEMAS
from tileplan.session import shared_dir
from tileplan.sources.reference import code_table
from tileplan.sources.sinks import set_last_day
from tileplan.streaming import feeds, jobs, pairing

_TS = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f')"


def _json(**fields):
    """JSON text of a row in DuckDB: quoted text, bare numbers and flags, null where null."""
    parts = []
    for name, (kind, expr) in fields.items():
        value = {"text": f"'\"' || {expr} || '\"'", "bare": f"CAST({expr} AS VARCHAR)"}[kind]
        parts.append(f"'\"{name}\":' || coalesce({value}, 'null')")
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


_INPUT = _json(
    id=("text", "id"), product_type_code=("text", "product_type_code"), start_date=("text", _TS.format("start_date")),
    publishing_date=("text", _TS.format("publishing_date")), tile=("text", "tile"),
    measurement_day=("bare", "measurement_day"), input_path=("text", "input_path"), is_partial=("bare", "is_partial"),
    relative_orbit_number=("bare", "relative_orbit_number"), harvesting_date=("text", _TS.format("harvesting_date")))
_TASK = _json(
    id=("bare", "p.id"), trigger_validation_fk_id=("bare", "p.trigger_validation_fk_id"),
    creation_date=("text", _TS.format("p.creation_date")), processing_date=("bare", "p.processing_date"),
    preceding_input_id=("text", "p.preceding_input_id"), has_ended=("bare", "p.has_ended"),
    intermediate_files_path=("text", "p.intermediate_files_path"))
_PRODUCT = _json(
    id=("text", "id"), trigger_validation_fk_id=("bare", "trigger_validation_fk_id"),
    product_type_code=("text", "product_type_code"), product_path=("text", "product_path"),
    creation_date=("text", _TS.format("creation_date")), catalogue_date=("text", _TS.format("catalogue_date")),
    kpi_file_path=("text", "kpi_file_path"))


@query("str01_input_feed", f"SELECT id, {_INPUT} AS payload FROM raw_inputs")
def _(fx):
    return jobs.run_available(feeds.stream_inputs(fx.stream("raw_inputs")), "inputs")


# Every third status row is an update, half of those without a change of the status.
_CHANGES = """(SELECT id, processing_status_id, id % 3 = 0 AS is_update,
    CASE WHEN id % 2 = 0 THEN processing_status_id ELSE 1 END AS old_status_id FROM processing_status_workflow)"""


@query("str02_processed_feed", f"""SELECT id FROM {_CHANGES} c WHERE processing_status_id = 2
    AND (NOT is_update OR old_status_id IS DISTINCT FROM processing_status_id)""")
def _(fx):
    changes = fx.stream("processing_status_workflow").select(
        "id", "processing_status_id", (F.col("id") % 3 == 0).alias("is_update"),
        F.when(F.col("id") % 2 == 0, F.col("processing_status_id")).otherwise(1).alias("old_status_id"))
    return jobs.run_available(feeds.stream_processed(changes), "processed")


def shaped(fx, label, stream, shape):
    path = shared_dir(fx._spark, label)
    jobs.run_feed(stream, shape, path, f"{path}-checkpoint").awaitTermination()
    return fx._spark.read.parquet(path).drop("batch")


@query("str03_product_feed", f"SELECT id, {_PRODUCT} AS payload FROM products")
def _(fx):
    return jobs.run_available(feeds.stream_products(fx.stream("products")), "products")


@query("str04_member_feed", """SELECT trigger_validation_id, '{"trigger_validation_id":' || CAST(trigger_validation_id AS VARCHAR)
    || ',"raw_input_id":"' || raw_input_id || '"}' AS payload FROM raw2valid""")
def _(fx):
    return jobs.run_available(feeds.stream_members(fx.stream("raw2valid")), "members")


@query("str05_task_feed", f"""SELECT p.id, pr.flavour, '{{"processing_task":' || {_TASK} || ',"flavour":"' || pr.flavour || '"}}' AS payload
    FROM processing_tasks p JOIN trigger_validation v ON v.id = p.trigger_validation_fk_id
    JOIN triggering_condition c ON c.name = v.triggering_condition_name
    JOIN processing_routine pr ON pr.name = c.processing_routine_name""")
def _(fx):
    return shaped(fx, "tasks", fx.stream("processing_tasks"), lambda batch: feeds.stream_tasks(batch, fx))


@query("str06_error_feed", f"""SELECT s.id AS status_id, p.id, {_TASK} AS payload FROM processing_status_workflow s
    JOIN processingtask2nomad n ON n.nomad_job_id = s.nomad_job_dispatch_fk_id
    JOIN processing_tasks p ON p.id = n.processing_task_id WHERE s.processing_status_id IN (4, 5)""")
def _(fx):
    return shaped(fx, "errors", fx.stream("processing_status_workflow"), lambda batch: feeds.stream_errors(batch, fx))


@query("str07_ingest", """SELECT name AS id, product_type_code, tile, measurement_day FROM (
    SELECT DISTINCT name, product_type_code, CASE product_type_code WHEN 'S2_MAJA_L2A' THEN split_part(name, '_', 4)[2:]
        WHEN 'S1_NRB_L2A' THEN split_part(name, '_', 6)[2:] ELSE split_part(name, '_', 5)[2:] END AS tile,
    CAST(regexp_extract(name, '_(2024\\d{4})', 1) AS BIGINT) AS measurement_day FROM named_inputs
    WHERE product_type_code NOT IN ('S2MSI1C', 'IW_GRDH_1S')) x""")
def _(fx):
    """Runs twice on the same checkpoint; the second run finds nothing new."""
    root = shared_dir(fx._spark, "ingest")
    table = jobs.BatchTable(fx._spark, root, "raw_inputs")
    table.write(fx.raw_inputs.limit(0), jobs.SEED)
    for _ in range(2):
        jobs.run_ingest(fx.stream("named_products"), root, f"{root}-checkpoint", AS_OF).awaitTermination()
    return table.rows().select("id", "product_type_code", "tile", "measurement_day")


@query("str07_rejects", """SELECT CASE WHEN id % 2 = 0 THEN 'no id' ELSE 'name' END AS reason, product_path FROM products
    WHERE id IS NOT NULL AND product_type_code IN ('GFSC_L2C', 'S1_NRB_L2A', 'S1_SWS_L2B', 'S1_WDS_L2B', 'S1_WICS1_L2B', 'S2_CC_L2B',
        'S2_FSC_L2B', 'S2_MAJA_L2A', 'S2_WICS2_L2B', 'COMB_WICS1S2')""".replace("id % 2", "CAST(right(id, 1) AS INT) % 2"))
def _(fx):
    """Products without an id or with a name of no layout are kept with the reason."""
    root = shared_dir(fx._spark, "rejects")
    even = F.right("id", F.lit(1)).cast("int") % 2 == 0
    broken = fx.stream("products").withColumn("id", F.when(~even, F.concat(F.lit("X"), "id")))
    jobs.run_ingest(broken, root, f"{root}-checkpoint", AS_OF).awaitTermination()
    return jobs.BatchTable(fx._spark, root, "rejects").rows().select("reason", "product_path")


@query("str08_triggers", f"SELECT condition, raw_input_id FROM ({ALL}) c")
def _(fx):
    """Validations and links below a folder, seeded with the stored ones; the result are the new links."""
    root = shared_dir(fx._spark, "triggers")
    heads, links = (jobs.BatchTable(fx._spark, root, t) for t in ("trigger_validation", "raw2valid"))
    heads.write(fx.trigger_validation, jobs.SEED)
    links.write(fx.raw2valid, jobs.SEED)
    jobs.run_triggers(fx.stream("raw_inputs"), lambda: fx, rules_of(fx), root, f"{root}-checkpoint").awaitTermination()
    made = heads.rows().join(fx.trigger_validation.select("id"), "id", "left_anti").select(
        F.col("id").alias("trigger_validation_id"), F.col("triggering_condition_name").alias("condition"))
    return links.rows().join(made, "trigger_validation_id").select("condition", "raw_input_id")


@query("str09_wds_join", """SELECT s.id AS sig0_id, f.id AS fsc_id, s.tile, s.measurement_day FROM raw_inputs s JOIN raw_inputs f
    ON f.tile = s.tile AND f.measurement_day = s.measurement_day
    WHERE s.product_type_code = 'S1_NRB_L2A' AND f.product_type_code = 'S2_FSC_L2B'
    AND EXISTS (SELECT 1 FROM tile_track k WHERE k.tile = s.tile AND k.orbit = s.relative_orbit_number)
    AND f.harvesting_date BETWEEN s.harvesting_date - INTERVAL 7 DAY AND s.harvesting_date + INTERVAL 7 DAY""")
def _(fx):
    side = lambda kind: fx.stream("raw_inputs", f"WHERE product_type_code = '{kind}'")
    return jobs.run_available(pairing.stream_wds(side("S1_NRB_L2A"), side("S2_FSC_L2B"), fx.tile_track), "wds")


@query("str10_grd_pairing", """WITH grd AS (SELECT *, coalesce(relative_orbit_number, -1) AS orbit_key,
        regexp_extract(input_path, '_(\\d{8}T\\d{6})_(\\d{8}T\\d{6})_', 1) AS t0,
        regexp_extract(input_path, '_(\\d{8}T\\d{6})_(\\d{8}T\\d{6})_', 2) AS t1
        FROM raw_inputs WHERE product_type_code = 'IW_GRDH_1S' AND is_partial),
    grp AS (SELECT tile, measurement_day, orbit_key, count(*) AS n, max(harvesting_date) AS last,
        list(id ORDER BY start_date, id) AS ids, list(t0 ORDER BY start_date, id) AS s, list(t1 ORDER BY start_date, id) AS p
        FROM grd GROUP BY 1, 2, 3)
    SELECT tile, measurement_day, orbit_key, CASE WHEN n = 1 THEN 'orphan' ELSE 'pair' END AS kind, ids[1] AS first_id FROM grp
    WHERE (n > 1 AND (p[1] = s[2] OR s[1] = p[2]))
    OR (n = 1 AND last < (SELECT max(harvesting_date) FROM grd) - INTERVAL 130 MINUTE)""")
def _(fx):
    return jobs.run_available(pairing.stream_grd(fx.stream("raw_inputs")), "grd")


@query("str11_planner", """SELECT v.id AS trigger_validation_fk_id,
    CASE WHEN v.triggering_condition_name = 'GFSC_TC' THEN v.artificial_measurement_day END AS processing_date
    FROM trigger_validation v WHERE v.id IN (SELECT trigger_validation_id FROM raw2valid)""")
def _(fx):
    root = shared_dir(fx._spark, "planner")
    table = jobs.BatchTable(fx._spark, root, "processing_tasks")
    table.write(fx.processing_tasks, jobs.SEED)
    jobs.run_planner(fx.stream("raw2valid"), lambda: fx.trigger_validation, root, f"{root}-checkpoint", AS_OF).awaitTermination()
    return table.rows().select("trigger_validation_fk_id", "processing_date")


@query("str12_queue", """SELECT p.id, p.trigger_validation_fk_id, p.creation_date FROM processing_tasks p WHERE p.id NOT IN (
    SELECT q.id FROM processing_tasks q JOIN processingtask2nomad n ON n.processing_task_id = q.id
    WHERE NOT q.has_ended AND NOT EXISTS (SELECT 1 FROM processing_status_workflow s
        WHERE s.nomad_job_dispatch_fk_id = n.nomad_job_id AND s.exit_code IS NOT NULL))""")
def _(fx):
    twice = fx.stream("processing_tasks").withColumn("again", F.explode(F.array(F.lit(0), F.lit(1)))).drop("again")
    path = shared_dir(fx._spark, "queue")
    jobs.run_queue(twice, lambda: currently_deployed(fx), path, f"{path}-checkpoint").awaitTermination()
    return fx._spark.read.parquet(path).select("id", "trigger_validation_fk_id", "creation_date")


_DEPLOYED = """SELECT q.id FROM processing_tasks q JOIN processingtask2nomad n ON n.processing_task_id = q.id
    WHERE NOT q.has_ended AND NOT EXISTS (SELECT 1 FROM processing_status_workflow s
        WHERE s.nomad_job_dispatch_fk_id = n.nomad_job_id AND s.exit_code IS NOT NULL)"""


@query("str12_relaunch", f"""SELECT id, 1 + CAST(id IN (SELECT processing_task_id FROM processingtask2nomad) AS BIGINT) AS n_queued
    FROM processing_tasks WHERE id NOT IN ({_DEPLOYED})""")
def _(fx):
    """All tasks arrive, those with a dispatch are launched, and all come again at once: what still waits stays as it is."""
    spark, root = fx._spark, shared_dir(fx._spark, "relaunch")
    arrive = lambda: fx.processing_tasks.write.mode("append").parquet(f"{root}/tasks")
    launches = fx.processingtask2nomad.select(F.col("processing_task_id").alias("id")).distinct()

    def run():
        tasks = spark.readStream.schema(SCHEMAS["processing_tasks"]).parquet(f"{root}/tasks")
        gone = spark.readStream.schema(launches.schema).parquet(f"{root}/launches")
        jobs.run_queue(tasks, lambda: currently_deployed(fx), f"{root}/queue", f"{root}/checkpoint", gone).awaitTermination()

    launches.limit(0).write.parquet(f"{root}/launches")
    arrive()
    run()
    launches.write.mode("append").parquet(f"{root}/launches")
    arrive()
    run()
    return spark.read.schema(SCHEMAS["processing_tasks"]).parquet(f"{root}/queue").groupBy("id").agg(F.count("*").alias("n_queued"))


@query("str13_restart", "SELECT id FROM raw_inputs")
def _(fx):
    """The second run on the same checkpoint adds no row."""
    path = shared_dir(fx._spark, "restart")
    jobs.run_available(fx.stream("raw_inputs").select("id"), "restart", path)
    return jobs.run_available(fx.stream("raw_inputs").select("id"), "restart", path)


@query("str14_periodic", f"""SELECT DISTINCT {_cand("'WICS1S2_TC'", 'id', nrt='false')} FROM ({_WIC}) x
    UNION ALL SELECT {_cand("'WICS1S2_TC'", 'id', member='partner', nrt='false')} FROM ({_WIC}) y""")
def _(fx):
    """A pass over the whole tables, woken by the input stream."""
    path = shared_dir(fx._spark, "periodic")

    def gap_pass():
        trg.trg_wics1s2(fx, rules_of(fx)).write.mode("overwrite").parquet(path)

    jobs.run_periodic(fx.stream("raw_inputs"), gap_pass, f"{path}-checkpoint").awaitTermination()
    return fx._spark.read.parquet(path)


def _tick(fx, root):
    """One tick of the clock, and no other row ever."""
    fx._spark.sql(f"SELECT TIMESTAMP '{AS_OF}' AS timestamp").write.parquet(f"{root}/ticks")
    return fx._spark.readStream.schema("timestamp TIMESTAMP").parquet(f"{root}/ticks")


_GRD = "TIMESTAMP '2024-01-24 00:00:00'"
_PASSES = f"""SELECT condition, raw_input_id FROM (
        {_pairs_sql(_GRD)} SELECT 'Backscatter_10m_TC' AS condition, g.id AS raw_input_id FROM grd g JOIN hit h
        ON h.tile = g.tile AND h.measurement_day = g.measurement_day AND h.o = g.o) a
    UNION ALL SELECT 'Backscatter_10m_TC', id FROM ({_orphans_sql('2024-01-24 00:00:00', AS_OF)}) b
    UNION ALL SELECT 'CC_TC', id FROM ({_CC_SQL} SELECT id FROM pick WHERE NOT earlier OR l2a IS NOT NULL
        UNION ALL SELECT l2a FROM pick WHERE earlier AND l2a IS NOT NULL) c
    UNION ALL SELECT condition, raw_input_id FROM ({_GFSC}) d
    UNION ALL SELECT DISTINCT 'WICS1S2_TC', id FROM ({_WIC}) e UNION ALL SELECT 'WICS1S2_TC', partner FROM ({_WIC}) f"""


@query("str14_passes", _PASSES)
def _(fx):
    """The four passes of the triggerer over the whole tables, fired by the clock without any new input."""
    root = shared_dir(fx._spark, "passes")
    for name in ("trigger_validation", "raw2valid"):
        jobs.BatchTable(fx._spark, root, name).write(getattr(fx, name), jobs.SEED)
    cat = fx.replace(triggerer_config=set_last_day(code_table(fx._spark, "triggerer_config"), "GFSC_L2C", GFSC_LAST_DAY))
    rules = rules_of(fx, publication_days={**trg._limits(1), "CC_TC": 30})
    jobs.run_triggers(fx.stream("raw_inputs").where("false"), lambda: cat, rules, root, f"{root}-checkpoint",
                      ticks=_tick(fx, root)).awaitTermination()
    heads, links = (jobs.BatchTable(fx._spark, root, t).rows() for t in ("trigger_validation", "raw2valid"))
    made = heads.join(fx.trigger_validation.select("id"), "id", "left_anti").select(
        F.col("id").alias("trigger_validation_id"), F.col("triggering_condition_name").alias("condition"))
    return links.join(made, "trigger_validation_id").select("condition", "raw_input_id")


@query("str14_recovery", f"""SELECT DISTINCT t.nomad_job_id AS nomad_job_dispatch_fk_id, 4 AS processing_status_id, 404 AS exit_code
    FROM ({_RUNS}) t JOIN {_AGES} a ON a.nomad_job_id = t.nomad_job_id WHERE NOT EXISTS (SELECT 1 FROM processing_status_workflow s
        WHERE s.nomad_job_dispatch_fk_id = t.nomad_job_id AND s.exit_code IS NOT NULL)
    AND (a.age IS NULL OR a.age = 0 OR a.age > 180 * CASE WHEN t.duration < 7 THEN 7 ELSE t.duration END)""")
def _(fx):
    """The fifth pass: the lost dispatches of all flavours, fired by the clock."""
    root = shared_dir(fx._spark, "recovery")
    flavours = [r.flavour for r in fx.processing_routine.select("flavour").distinct().collect()]  # code table
    jobs.run_recovery(_tick(fx, root), lambda: fx, lambda: fx.sql(f"SELECT * FROM {_AGES} a"), flavours, root,
                      f"{root}-checkpoint", day=CUTOVER).awaitTermination()
    return jobs.BatchTable(fx._spark, root, "processing_status_workflow").rows().select(
        "nomad_job_dispatch_fk_id", "processing_status_id", "exit_code")

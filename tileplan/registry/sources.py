"""SRC and SNK queries."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tileplan.fixtures import AS_OF
from tileplan.operators.tasks import undispatched
from tileplan.registry import query
from tileplan.schemas import NOT_NULL, REFERENCES, UNIQUE, as_entity
from tileplan.session import moment, shared_dir
from tileplan.sources import catalogue, files, sinks, tablelog


@query("src01_load_catalogue", "SELECT * FROM raw_inputs")
def _(fx):
    root = shared_dir(fx._spark, "catalogue")
    catalogue.write_table(fx.raw_inputs, root, "raw_inputs")
    return catalogue.load_catalogue(fx._spark, root).raw_inputs


_DAYS = {t: f"CAST(strftime({c}, '%Y%m%d') AS BIGINT)" for t, c in catalogue.LAYOUT.items()} | {"raw_inputs": "measurement_day"}
_CORE = [t for t in catalogue.CORE_TABLES if t != "tile_geometry"]


@query("src01_all_tables", " UNION ALL ".join(
    [f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_first_days FROM {t}" for t in _CORE if t not in _DAYS]
    + [f"SELECT '{t}' AS table_name, count(*) AS n_rows, count_if({_DAYS[t]} <= 20240110) AS n_first_days FROM {t}"
       for t in _CORE if t in _DAYS and t != "raw2valid"]
    + [f"""SELECT 'raw2valid' AS table_name, count(*) AS n_rows, count_if({_DAYS['raw2valid']} <= 20240110) AS n_first_days
        FROM raw2valid m LEFT JOIN trigger_validation v ON v.id = m.trigger_validation_id""",
       "SELECT 'tile_geometry' AS table_name, count(DISTINCT tile) AS n_rows, CAST(0 AS BIGINT) AS n_first_days FROM raw_inputs"]))
def _(fx):
    """All core tables written in their layout and read again, whole and by days."""
    spark, root = fx._spark, shared_dir(fx._spark, "catalogue")
    geometry = fx.raw_inputs.select("tile").distinct().withColumn("geom", F.concat(F.lit("POINT "), "tile"))
    catalogue.write_catalogue(fx.replace(tile_geometry=geometry), root)
    cat = catalogue.load_catalogue(spark, root)
    parts = []
    for table in catalogue.CORE_TABLES:
        whole = getattr(cat, table).agg(F.lit(table).alias("table_name"), F.count("*").alias("n_rows"))
        first = F.lit(0).cast("bigint")
        if table in catalogue.LAYOUT:
            days = catalogue.scan(spark, root, table, (0, 20240110)).agg(F.count("*").alias("n_first_days"))
            whole, first = whole.crossJoin(days), F.col("n_first_days")
        parts.append(whole.select("table_name", "n_rows", first.alias("n_first_days")))
    return reduce(DataFrame.unionByName, parts)


@query("src02_reference_tables", """SELECT r.product_type_code, t.processing_level, count(*) AS n_inputs FROM raw_inputs r
    JOIN raster_type t ON t.product_type = r.product_type_code GROUP BY 1, 2""")
def _(fx):
    from tileplan.sources.reference import reference_tables

    kinds = reference_tables(fx._spark).raster_type
    return (fx.raw_inputs.join(kinds, F.col("product_type_code") == F.col("product_type"))
            .groupBy("product_type_code", "processing_level").agg(F.count("*").alias("n_inputs")))


@query("src05_tile_tracks", "SELECT tile, orbit FROM tile_track")
def _(fx):
    return files.tile_tracks(fx.sql("SELECT concat('T', tile, ': 00', CAST(orbit AS STRING)) AS value FROM tile_track"))


@query("src06_tiles", "SELECT tile FROM tile_list")
def _(fx):
    return files.tile_names(fx.sql("SELECT concat('- ', tile) AS value FROM tile_list"))


_CORNERS = "CAST(CAST(substr(tile, 1, 2) AS INT) AS STRING) AS x, CAST(length(tile) AS STRING) AS y, CAST(substr(tile, 1, 2) AS INT) % 3 AS kind"


@query("src04_tile_geometry", f"""SELECT tile, CASE kind WHEN 0 THEN 'POLYGON Z((' || x || ' ' || y || ' 0, 9 9 0, ' || x || ' ' || y || ' 0))'
    WHEN 1 THEN 'MULTIPOLYGON Z(((' || x || ' 1 0, 2 2 0), (5 5 0, 6 6 0)), ((7 ' || y || ' 0, 8 8 0)))' END AS geom
    FROM (SELECT DISTINCT tile, {_CORNERS} FROM raw_inputs) t""")
def _(fx):
    """A GeoJSON file of all tiles: polygons with a hole, multipolygons, and points, which are rejected."""
    spark, root = fx._spark, shared_dir(fx._spark, "geometry")
    feature = F.expr("""concat('{"properties":{"Name":"', tile, '"},"geometry":{"type":', CASE kind
        WHEN 0 THEN concat('"Polygon","coordinates":[[[', x, ',', y, ',0],[9,9,0],[', x, ',', y, ',0]],[[1,1,0]]]')
        WHEN 1 THEN concat('"MultiPolygon","coordinates":[[[[', x, ',1,0],[2,2,0]],[[5,5,0],[6,6,0]]],[[[7,', y, ',0],[8,8,0]]]]')
        ELSE concat('"Point","coordinates":[', x, ',', y, ']') END, '}}')""")
    tiles = fx.sql(f"SELECT DISTINCT tile, {_CORNERS} FROM raw_inputs").select(feature.alias("f"))
    tiles.agg(F.concat(F.lit('{"features":['), F.array_join(F.collect_list("f"), ","), F.lit("]}"))).write.text(root)
    good, refused = files.read_tile_geometry(spark, root)
    return good.unionByName(refused.select("tile", F.lit(None).cast("string").alias("geom")))


@query("src07_aux_ready", """SELECT r.raw_input_id, r.processing_routine_name, r.measurement_day FROM run_inputs r
    WHERE CASE r.processing_routine_name WHEN 'CC' THEN r.measurement_day % 4 > 0
        WHEN 'WICS1' THEN r.measurement_day % 5 > 0 AND r.measurement_day % 7 > 0 ELSE true END""")
def _(fx):
    tasks = fx.run_inputs.select("raw_input_id", "processing_routine_name", "measurement_day")
    return files.aux_ready(tasks, fx.listing)


# Rows offered for insertion: every input twice, the copy published a day later under another path.
_OFFER = """(SELECT * FROM raw_inputs UNION ALL SELECT id, product_type_code, start_date,
    publishing_date + INTERVAL '1' DAY, tile, measurement_day, concat(input_path, '/copy'), is_partial,
    relative_orbit_number, harvesting_date FROM raw_inputs)"""


@query("snk01_insert_ignore", f"""SELECT o.* FROM {_OFFER} o
    WHERE id NOT IN (SELECT id FROM raw_inputs WHERE measurement_day < 20240115)
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY publishing_date, input_path) = 1""")
def _(fx):
    target = fx.raw_inputs.filter(F.col("measurement_day") < 20240115)
    return sinks.insert_ignore(target, fx.sql(f"SELECT * FROM {_OFFER} o"), "id")


def heads(fx):
    return fx.raw_inputs.filter(F.col("product_type_code") == "S2_FSC_L2B").select(
        F.lit("WDS_TC").alias("condition"), moment(AS_OF).alias("validation_date"), F.lit(True).alias("is_nrt"),
        F.lit(None).cast("bigint").alias("artificial_measurement_day"),
        F.concat(F.lit("WDS_TC|"), "id").alias("candidate_key"), F.col("id").alias("raw_input_id"))


_NUMBERED = """SELECT concat('WDS_TC|', id) AS candidate_key, id AS raw_input_id,
    (SELECT max(id) FROM trigger_validation)
    + row_number() OVER (ORDER BY substr(md5(concat('WDS_TC|', id)), 1, 3), concat('WDS_TC|', id)) AS vid
    FROM raw_inputs WHERE product_type_code = 'S2_FSC_L2B'"""


@query("snk02_append_validations", f"""SELECT vid AS id, 'WDS_TC' AS triggering_condition_name,
    TIMESTAMP '{AS_OF}' AS validation_date, true AS is_nrt, CAST(NULL AS BIGINT) AS artificial_measurement_day, candidate_key
    FROM ({_NUMBERED}) n""")
def _(fx):
    return sinks.append_validations(fx.trigger_validation, heads(fx))


@query("snk03_append_members", f"SELECT vid AS trigger_validation_id, raw_input_id FROM ({_NUMBERED}) n")
def _(fx):
    candidates = heads(fx).select("candidate_key", "raw_input_id")
    return sinks.append_members(sinks.append_validations(fx.trigger_validation, heads(fx)), candidates)


@query("snk04_append_tasks", f"""SELECT (SELECT max(id) FROM processing_tasks) + row_number() OVER (
        ORDER BY substr(md5(CAST(v.id AS STRING)), 1, 3), CAST(v.id AS STRING)) AS id,
    v.id AS trigger_validation_fk_id, TIMESTAMP '{AS_OF}' AS creation_date, v.artificial_measurement_day AS processing_date,
    CAST(NULL AS STRING) AS preceding_input_id, false AS has_ended, CAST(NULL AS STRING) AS intermediate_files_path
    FROM trigger_validation v WHERE v.id NOT IN (SELECT trigger_validation_fk_id FROM processing_tasks)""")
def _(fx):
    from tileplan.plans.planning import plan_tasks

    tasks, _ = plan_tasks(fx.raw2valid, fx.trigger_validation, fx.processing_tasks, AS_OF)
    return sinks.append_tasks(fx.processing_tasks, tasks)


@query("snk05_append_dispatch", f"""SELECT (SELECT max(id) FROM processing_status_workflow) + row_number() OVER (
        ORDER BY substr(md5(k), 1, 3), k) AS id, job AS nomad_job_dispatch_fk_id, 3 AS processing_status_id,
    TIMESTAMP '{AS_OF}' AS date, CAST(NULL AS STRING) AS message, CAST(NULL AS INT) AS exit_code
    FROM (SELECT concat('run-', p.id) AS job, concat('run-', p.id, '|{AS_OF}|3') AS k FROM processing_tasks p
          WHERE p.id NOT IN (SELECT processing_task_id FROM processingtask2nomad)) x""")
def _(fx):
    waiting = undispatched(fx, "hma.large", 0).unionByName(undispatched(fx, "eo1.large", 0))
    runs = waiting.select(F.concat(F.lit("run-"), F.col("id").cast("string")).alias("nomad_job_id"),
                          F.col("id").alias("processing_task_id"), F.lit("pending").alias("status_name"),
                          moment(AS_OF).alias("date"), F.lit(None).cast("int").alias("exit_code"))
    return sinks.append_dispatch(fx, runs)[2]


@query("snk07_delete_cascade", """SELECT 'dispatch' AS kind, id FROM nomad_job_dispatch WHERE id NOT LIKE '%-2'
    UNION ALL SELECT 'status' AS kind, CAST(id AS STRING) FROM processing_status_workflow
    WHERE nomad_job_dispatch_fk_id NOT LIKE '%-2'""")
def _(fx):
    gone = fx.nomad_job_dispatch.filter(F.col("id").endswith("-2"))
    jobs, (statuses,) = sinks.delete_cascade(
        fx.nomad_job_dispatch, "id", [(fx.processing_status_workflow, "nomad_job_dispatch_fk_id")], gone)
    return jobs.select(F.lit("dispatch").alias("kind"), "id").unionByName(
        statuses.select(F.lit("status").alias("kind"), F.col("id").cast("string").alias("id")))


@query("snk08_constraint_report", """WITH cut AS (SELECT * FROM raw_inputs WHERE measurement_day % 10 > 0)
    SELECT 'raw2valid' AS table_name, 'not_null' AS rule, c AS column_name, 0 AS violations
    FROM (VALUES ('trigger_validation_id'), ('raw_input_id')) AS v(c)
    UNION ALL SELECT 'raw2valid', 'reference', 'trigger_validation_id', 0
    UNION ALL SELECT 'raw2valid', 'reference', 'raw_input_id', (SELECT count(*) FROM raw2valid
        WHERE raw_input_id NOT IN (SELECT id FROM cut))
    UNION ALL SELECT 'processing_tasks', 'not_null', c, 0
    FROM (VALUES ('id'), ('trigger_validation_fk_id'), ('creation_date')) AS v(c)
    UNION ALL SELECT 'processing_tasks', 'unique', c, (SELECT count(*) FROM processing_tasks WHERE has_ended)
    FROM (VALUES ('id'), ('trigger_validation_fk_id')) AS v(c)
    UNION ALL SELECT 'processing_tasks', 'reference', 'trigger_validation_fk_id', 0""")
def _(fx):
    """The inputs of every tenth day are taken away and the ended tasks doubled, so violations exist."""
    broken = fx.replace(raw_inputs=fx.raw_inputs.filter(F.col("measurement_day") % 10 > 0),
                        processing_tasks=fx.processing_tasks.unionByName(fx.processing_tasks.filter("has_ended")))
    return sinks.constraint_report(broken, ["raw2valid", "processing_tasks"])


def _all_rules():
    """Every declared rule of every table, counted one by one over the broken tables of the query."""
    parts = []
    for t in NOT_NULL:
        rows = f"broken_{t}" if t in ("raw_inputs", "processing_tasks") else t
        line = lambda rule, c, n, t=t: parts.append(
            f"SELECT '{t}' AS table_name, '{rule}' AS rule, '{c}' AS column_name, CAST(({n}) AS BIGINT) AS violations")
        for c in NOT_NULL[t]:
            line("not_null", c, f"SELECT count(*) FROM {rows} WHERE {c} IS NULL")
        for c in UNIQUE.get(t, []):
            line("unique", c, f"SELECT count({c}) - count(DISTINCT {c}) FROM {rows}")
        for c, parent, key in REFERENCES.get(t, []):
            kept = f"broken_{parent}" if parent in ("raw_inputs", "processing_tasks") else parent
            line("reference", c, f"SELECT count(*) FROM {rows} x WHERE x.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {kept} y WHERE y.{key} = x.{c})")
    return """WITH broken_raw_inputs AS (SELECT * FROM raw_inputs WHERE measurement_day % 10 > 0),
        broken_processing_tasks AS (SELECT * FROM processing_tasks UNION ALL SELECT * FROM processing_tasks WHERE has_ended)
        """ + " UNION ALL ".join(parts)


@query("snk08_all_constraints", _all_rules())
def _(fx):
    """All rules of all tables, code tables included, over tables that break some of them."""
    return sinks.constraint_report(fx.replace(
        raw_inputs=fx.raw_inputs.filter(F.col("measurement_day") % 10 > 0),
        processing_tasks=fx.processing_tasks.unionByName(fx.processing_tasks.filter("has_ended"))))


@query("snk05_all_outputs", f"""WITH runs AS (SELECT concat('run-', p.id) AS job, p.id, concat('run-', p.id, '|{AS_OF}|3') AS k
        FROM processing_tasks p WHERE p.id NOT IN (SELECT processing_task_id FROM processingtask2nomad))
    SELECT 'dispatch' AS kind, job AS a, CAST(NULL AS STRING) AS b FROM runs
    UNION ALL SELECT 'link', job, CAST(id AS STRING) FROM runs
    UNION ALL SELECT 'status', job, CAST((SELECT max(id) FROM processing_status_workflow) + row_number() OVER (
        ORDER BY substr(md5(k), 1, 3), k) AS STRING) FROM runs""")
def _(fx):
    """The three tables that a launch adds to."""
    waiting = undispatched(fx, "hma.large", 0).unionByName(undispatched(fx, "eo1.large", 0))
    runs = waiting.select(F.concat(F.lit("run-"), F.col("id").cast("string")).alias("nomad_job_id"),
                          F.col("id").alias("processing_task_id"), F.lit("pending").alias("status_name"),
                          moment(AS_OF).alias("date"), F.lit(None).cast("int").alias("exit_code"))
    jobs, links, statuses = sinks.append_dispatch(fx, runs)
    row = lambda df, kind, a, b: df.select(F.lit(kind).alias("kind"), F.col(a).alias("a"), b.cast("string").alias("b"))
    return row(jobs, "dispatch", "id", F.lit(None)).unionByName(row(links, "link", "nomad_job_id", F.col(
        "processing_task_id"))).unionByName(row(statuses, "status", "nomad_job_dispatch_fk_id", F.col("id")))


@query("prj22_as_entity", "SELECT * EXCLUDE (acquisition_date, state) FROM sentinel_tile")
def _(fx):
    return as_entity(fx.sentinel_tile, "raw_inputs")


@query("snk06_stored_parameters", """SELECT r.product_type_code, count(*) AS n_inputs, max(CASE WHEN r.product_type_code = 'S1_NRB_L2A'
    THEN 77 END) AS stored_days FROM raw_inputs r JOIN sources s ON s.input_type = r.product_type_code GROUP BY 1""")
def _(fx):
    """A parameter that is set, stored and read again by the next catalogue, over the inputs of its sources."""
    root = shared_dir(fx._spark, "parameters")
    catalogue.write_table(fx.raw_inputs, root, "raw_inputs")
    constant = catalogue.load_catalogue(fx._spark, root).sources
    days = "max_day_since_publication_date"
    changed = constant.withColumn(days, F.when(F.col("input_type") == "S1_NRB_L2A", 77))
    tablelog.store_parameters(fx._spark, root, tablelog.parameter_version(fx._spark, root), sources=changed)
    cat = catalogue.load_catalogue(fx._spark, root)
    return (cat.raw_inputs.join(cat.sources.select(F.col("input_type").alias("product_type_code"), days), "product_type_code")
            .groupBy("product_type_code").agg(F.count("*").alias("n_inputs"), F.max(days).alias("stored_days")))

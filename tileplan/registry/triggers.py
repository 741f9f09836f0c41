"""TRG, WIN-05, WIN-06 and AGG-13 queries."""

from pyspark.sql import functions as F

from tileplan.fixtures import AS_OF, GFSC_LAST_DAY
from tileplan.operators.inputs import unprocessed_grd
from tileplan.plans import gapfill, triggers as trg
from tileplan.registry import query
from tileplan.session import shared_dir
from tileplan.sources.reference import code_table
from tileplan.sources.tablelog import TableLog


# A clock whose seven days back reach before the first event.
EARLY = "2024-01-07 00:00:00"


def rules_of(fx, as_of=AS_OF, **more):
    return trg.Rules(as_of=as_of, tiles=fx.tile_list, sws_tracks=fx.tile_track, wics1_tracks=fx.tile_track,
                     wds_tracks=fx.tile_track, sources=fx.sources, **more)


def _cand(condition, key, first="id", member="id", day="CAST(NULL AS BIGINT)", nrt="CAST(NULL AS BOOLEAN)",
          measured="measurement_day"):
    return (f"{condition} AS condition, tile, {measured} AS measurement_day, concat({condition}, '|', {key}) AS candidate_key, "
            f"{first} AS first_id, {member} AS raw_input_id, {day} AS artificial_measurement_day, {nrt} AS is_nrt")


_SINCE = "TIMESTAMP '2024-01-24 00:00:00'"
_TAKEN = """(SELECT m.raw_input_id FROM raw2valid m JOIN trigger_validation v ON v.id = m.trigger_validation_id
    WHERE v.triggering_condition_name = '{}')"""
_ORBIT = "EXISTS (SELECT 1 FROM tile_track k WHERE k.tile = {0}.tile AND k.orbit = {0}.relative_orbit_number)"

SIG0_FULL = f"""SELECT {_cand("'Backscatter_10m_TC'", 'id')} FROM raw_inputs
    WHERE product_type_code = 'IW_GRDH_1S' AND NOT is_partial"""
L2A = " UNION ALL ".join(
    f"""SELECT {_cand(f"'{c}'", 'id')} FROM raw_inputs WHERE product_type_code = 'S2_MAJA_L2A'
    AND harvesting_date >= {_SINCE} AND id NOT IN {_TAKEN.format(c)}""" for c in ("FSC_TC", "WICS2_TC"))


def _sig0(condition, more=""):
    return f"""SELECT * FROM raw_inputs s WHERE product_type_code = 'S1_NRB_L2A' AND harvesting_date >= {_SINCE}
        AND {_ORBIT.format('s')} AND id NOT IN {_TAKEN.format(condition)} {more}"""


SWS = f"""SELECT {_cand("'SWS_TC'", 'id')} FROM ({_sig0('SWS_TC', 'AND tile IN (SELECT tile FROM tile_list)')}) x"""
WICS1 = f"""SELECT {_cand("'WICS1_TC'", 'id')} FROM ({_sig0('WICS1_TC')}) x"""
_WDS_PAIRS = f"""SELECT s.id, s.tile, s.measurement_day, f.id AS fsc FROM ({_sig0('WDS_TC')}) s JOIN raw_inputs f
    ON f.tile = s.tile AND f.measurement_day = s.measurement_day
    WHERE f.product_type_code = 'S2_FSC_L2B' AND f.harvesting_date >= {_SINCE}"""
WDS_SIG0 = f"""SELECT DISTINCT {_cand("'WDS_TC'", 'id')} FROM ({_WDS_PAIRS}) x
    UNION ALL SELECT {_cand("'WDS_TC'", 'id', member='fsc')} FROM ({_WDS_PAIRS}) y"""
_WDS_LAST = f"""SELECT f.id, f.tile, f.measurement_day, s.id AS sig0, {_ORBIT.format('s')} AS valid FROM raw_inputs f
    JOIN raw_inputs s ON f.tile = s.tile AND f.measurement_day = s.measurement_day
    WHERE f.product_type_code = 'S2_FSC_L2B' AND f.harvesting_date >= {_SINCE} AND f.id NOT IN {_TAKEN.format('WDS_TC')}
    AND s.product_type_code = 'S1_NRB_L2A' AND s.harvesting_date >= {_SINCE}
    QUALIFY row_number() OVER (PARTITION BY f.id ORDER BY s.harvesting_date DESC, s.id DESC) = 1"""
WDS_FSC = f"""SELECT {_cand("'WDS_TC'", 'id')} FROM ({_WDS_LAST}) x WHERE valid
    UNION ALL SELECT {_cand("'WDS_TC'", 'id', member='sig0')} FROM ({_WDS_LAST}) y WHERE valid"""


def _wds(order, offered):
    """WDS of a batch input by input: a walk over the heads of each tile and day that keeps what has been bound."""
    return f"""SELECT * FROM (WITH RECURSIVE heads AS (
        SELECT DISTINCT id, tile, measurement_day, true AS is_sig0, CAST(NULL AS VARCHAR) AS sig0 FROM ({_WDS_PAIRS}) p
        UNION ALL SELECT id, tile, measurement_day, false, sig0 FROM ({_WDS_LAST}) l WHERE valid),
    turns AS (SELECT h.*, row_number() OVER (PARTITION BY h.tile, h.measurement_day
        ORDER BY r.harvesting_date {order}, r.id {order}) AS k FROM heads h JOIN raw_inputs r ON r.id = h.id WHERE {offered}),
    walk AS (SELECT DISTINCT tile, measurement_day, CAST(0 AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS id, false AS fires,
            false AS all_fsc, CAST([] AS VARCHAR[]) AS bound FROM turns
        UNION ALL SELECT tile, measurement_day, k, id, fires, all_fsc OR (fires AND is_sig0),
            CASE WHEN fires AND NOT is_sig0 THEN list_append(bound, sig0) ELSE bound END FROM (
            SELECT t.*, w.all_fsc, w.bound, CASE WHEN t.is_sig0 THEN NOT list_contains(w.bound, t.id) ELSE NOT w.all_fsc END AS fires
            FROM walk w JOIN turns t ON t.tile = w.tile AND t.measurement_day = w.measurement_day AND t.k = w.k + 1) s)
    SELECT c.* FROM ({WDS_SIG0} UNION ALL {WDS_FSC}) c WHERE c.first_id IN (SELECT id FROM walk WHERE fires)) wds"""


def _all(order="ASC", offered="true"):
    return " UNION ALL ".join([SIG0_FULL, L2A, SWS, WICS1, _wds(order, offered)])


ALL = _all()


@query("trg01_sig0_full", SIG0_FULL)
def _(fx):
    return trg.trg_sig0_full(fx.raw_inputs)


_OPEN = """SELECT *, coalesce(relative_orbit_number, -1) AS o, regexp_extract(input_path, '_(\\d{8}T\\d{6})_(\\d{8}T\\d{6})_', 1) AS t0,
    regexp_extract(input_path, '_(\\d{8}T\\d{6})_(\\d{8}T\\d{6})_', 2) AS t1 FROM raw_inputs
    WHERE product_type_code = 'IW_GRDH_1S' AND is_partial AND harvesting_date >= {since} AND id NOT IN (SELECT raw_input_id FROM raw2valid)"""


def _pairs_sql(since):
    return f"""WITH grd AS ({_OPEN.replace('{since}', since)}),
    ranked AS (SELECT *, row_number() OVER w AS rk, lead(t0) OVER w AS n0, lead(t1) OVER w AS n1,
        first_value(id) OVER w AS f FROM grd WINDOW w AS (PARTITION BY tile, measurement_day, o ORDER BY start_date, id)),
    hit AS (SELECT tile, measurement_day, o, f FROM ranked WHERE rk = 1 AND (t1 = n0 OR t0 = n1))"""


@query("win06_grd_pairs", _pairs_sql("TIMESTAMP '2023-12-31 00:00:00'")
       + " SELECT tile, measurement_day, o AS orbit_key, f AS first_id FROM hit")
def _(fx):
    grd = unprocessed_grd(fx.raw_inputs, fx.raw2valid, EARLY).withColumn(
        "orbit_key", F.coalesce("relative_orbit_number", F.lit(-1)))
    return trg.grd_pairs(grd)


@query("trg02_sig0_pairs", _pairs_sql("TIMESTAMP '2023-12-31 00:00:00'") + f""" SELECT {_cand(
    "'Backscatter_10m_TC'", "g.tile, '|', CAST(g.measurement_day AS STRING), '|', CAST(g.o AS STRING)", 'f',
    measured='g.measurement_day').replace(' tile,', ' g.tile,')} FROM grd g JOIN hit h ON h.tile = g.tile
    AND h.measurement_day = g.measurement_day AND h.o = g.o""")
def _(fx):
    return trg.trg_sig0_pairs(fx.raw_inputs, fx.raw2valid, EARLY)


def _orphans_sql(since, as_of):
    return f"""SELECT min(id) AS id, tile, measurement_day FROM ({_OPEN.replace('{since}', f"TIMESTAMP '{since}'")}) g
        GROUP BY tile, measurement_day, o HAVING count(*) = 1
        AND min(harvesting_date) <= TIMESTAMP '{as_of}' - INTERVAL '2' HOUR"""


@query("trg03_sig0_orphans", f"""SELECT {_cand("'Backscatter_10m_TC'", 'id')}
    FROM ({_orphans_sql('2024-01-24 00:00:00', AS_OF)}) x WHERE (tile, measurement_day) NOT IN (
    SELECT (tile, measurement_day) FROM ({_orphans_sql('2024-01-23 18:00:00', '2024-01-30 18:00:00')}) p)""")
def _(fx):
    _, before = trg.trg_sig0_orphans(fx.raw_inputs, fx.raw2valid, "2024-01-30 18:00:00")
    return trg.trg_sig0_orphans(fx.raw_inputs, fx.raw2valid, AS_OF, before)[0]


@query("trg04_l2a", L2A)
def _(fx):
    return trg.trg_l2a(fx.raw_inputs, fx, rules_of(fx))


@query("trg05_sws", SWS)
def _(fx):
    return trg.trg_sws(fx.raw_inputs, fx, rules_of(fx))


@query("trg06_wics1", WICS1)
def _(fx):
    return trg.trg_wics1(fx.raw_inputs, fx, rules_of(fx))


@query("trg07_wds_from_sig0", WDS_SIG0)
def _(fx):
    return trg.trg_wds_from_sig0(fx.raw_inputs, fx, rules_of(fx))


@query("trg08_wds_from_fsc", WDS_FSC)
def _(fx):
    return trg.trg_wds_from_fsc(fx.raw_inputs, fx, rules_of(fx))


_FIRST = """SELECT tile, measurement_day, id FROM raw_inputs WHERE product_type_code = 'S2MSI1C'
    AND id NOT IN (SELECT raw_input_id FROM raw2valid) AND tile IN (SELECT tile FROM tile_list)
    AND publishing_date >= TIMESTAMP '2024-01-01 00:00:00' AND measurement_day >= 20240101
    QUALIFY row_number() OVER (PARTITION BY tile ORDER BY measurement_day, id) = 1"""


@query("win05_first_l1c_per_tile", """SELECT tile, measurement_day, id FROM raw_inputs WHERE product_type_code = 'S2MSI1C'
    QUALIFY row_number() OVER (PARTITION BY tile ORDER BY measurement_day, id) = 1""")
def _(fx):
    return trg.first_l1c_per_tile(fx.raw_inputs.filter(F.col("product_type_code") == "S2MSI1C"))


# The events span 30 days, so the 90 days back of the as-of are all days up to the day.
_CC_SQL = f"""WITH cc AS (SELECT v.id, r.tile, r.measurement_day AS d, p.id AS task, p.has_ended FROM trigger_validation v
        JOIN raw2valid m ON m.trigger_validation_id = v.id JOIN raw_inputs r ON r.id = m.raw_input_id
        LEFT JOIN processing_tasks p ON p.trigger_validation_fk_id = v.id WHERE v.triggering_condition_name = 'CC_TC'),
    runs AS (SELECT n.processing_task_id AS task, max(s.exit_code) AS code FROM processingtask2nomad n
        LEFT JOIN processing_status_workflow s ON s.nomad_job_dispatch_fk_id = n.nomad_job_id GROUP BY 1),
    busy AS (SELECT c.tile FROM cc c LEFT JOIN runs u ON u.task = c.task WHERE c.d > 20240101 AND c.task IS NOT NULL
        AND (u.task IS NULL OR (NOT c.has_ended AND u.code IS NOT NULL))),
    pick AS (SELECT f.*,
        EXISTS (SELECT 1 FROM cc c WHERE c.tile = f.tile AND c.d <= f.measurement_day AND c.task IS NOT NULL
            AND c.id IN (SELECT trigger_validation_fk_id FROM products)) AS earlier,
        (SELECT max((r.measurement_day, r.id)) FROM raw_inputs r WHERE r.product_type_code = 'S2_MAJA_L2A'
            AND r.tile = f.tile AND r.measurement_day <= f.measurement_day)[2] AS l2a
        FROM ({_FIRST}) f WHERE f.tile NOT IN (SELECT tile FROM busy) AND NOT EXISTS (SELECT 1 FROM cc c
            WHERE c.tile = f.tile AND c.d <= f.measurement_day AND c.task IS NULL))"""


@query("trg09_cc", _CC_SQL + f""" SELECT {_cand("'CC_TC'", 'id')} FROM pick WHERE NOT earlier OR l2a IS NOT NULL
    UNION ALL SELECT {_cand("'CC_TC'", 'id', member='l2a')} FROM pick WHERE earlier AND l2a IS NOT NULL""")
def _(fx):
    return trg.trg_cc(fx, rules_of(fx, publication_days={"CC_TC": 30}))[0]


@query("trg09_cc_rejects", _CC_SQL + " SELECT id, tile, measurement_day FROM pick WHERE earlier AND l2a IS NULL")
def _(fx):
    return trg.trg_cc(fx, rules_of(fx, publication_days={"CC_TC": 30}))[1]


_WALK = """WITH RECURSIVE work AS (SELECT r.measurement_day, n.nomad_job_id FROM raw_inputs r
        JOIN raw2valid m ON m.raw_input_id = r.id JOIN trigger_validation v ON v.id = m.trigger_validation_id
        JOIN processing_tasks p ON p.trigger_validation_fk_id = v.id
        LEFT JOIN processingtask2nomad n ON n.processing_task_id = p.id
        WHERE NOT p.has_ended AND v.triggering_condition_name IN ('CC_TC', 'Backscatter_10m_TC', 'FSC_TC', 'SWS_TC')),
    last_status AS (SELECT nomad_job_dispatch_fk_id AS job, arg_max(processing_status_id, (date, id)) AS status
        FROM processing_status_workflow GROUP BY 1),
    bad AS (SELECT DISTINCT strptime(CAST(measurement_day AS STRING), '%Y%m%d')::DATE AS day FROM work
        LEFT JOIN last_status ON job = nomad_job_id WHERE nomad_job_id IS NULL OR status NOT IN (2, 6)),
    walk(day, clean, stored, moving) AS (
        SELECT day, day NOT IN (SELECT day FROM bad), CASE WHEN day NOT IN (SELECT day FROM bad) THEN day + 1 ELSE day END,
            day NOT IN (SELECT day FROM bad) FROM (SELECT DATE '2024-01-01' AS day) s
        UNION ALL
        SELECT n.day, n.ok, CASE WHEN n.moving AND n.ok THEN n.day + 1 ELSE n.stored END, n.moving AND n.ok FROM (
            SELECT day + CASE WHEN clean THEN 1 ELSE 7 END AS day, stored, moving,
                day + CASE WHEN clean THEN 1 ELSE 7 END NOT IN (SELECT day FROM bad) AS ok FROM walk) n
        WHERE n.day < DATE '2024-01-31')"""


@query("trg10_gfsc_walk", _WALK + """ SELECT CAST(strftime(day, '%Y%m%d') AS BIGINT) AS measurement_day, clean,
    CAST(strftime((SELECT max(stored) FROM walk), '%Y%m%d') AS BIGINT) AS stored_day FROM walk""")
def _(fx):
    return gapfill.trg_gfsc(fx, rules_of(fx), GFSC_LAST_DAY)[1]


_SETS = """, sets AS (SELECT r.tile, CAST(strftime(w.day, '%Y%m%d') AS BIGINT) AS day, r.id FROM walk w JOIN raw_inputs r
        ON strptime(CAST(r.measurement_day AS STRING), '%Y%m%d')::DATE BETWEEN w.day - 7 AND w.day
        WHERE w.clean AND r.product_type_code IN ('S2_FSC_L2B', 'S1_SWS_L2B') AND r.tile IN (SELECT tile FROM tile_list)),
    lists AS (SELECT tile, day, min(id) AS first_id, string_agg(id, ',' ORDER BY id) AS ids FROM sets GROUP BY 1, 2),
    known AS (SELECT v.artificial_measurement_day AS day, string_agg(m.raw_input_id, ',' ORDER BY m.raw_input_id) AS ids
        FROM trigger_validation v JOIN raw2valid m ON m.trigger_validation_id = v.id
        WHERE v.triggering_condition_name = 'GFSC_TC' GROUP BY v.id, 1)"""
_GFSC = _WALK + _SETS + f""" SELECT {_cand("'GFSC_TC'", "tile, '|', CAST(day AS STRING)", 'first_id', day='day',
    measured='day')} FROM sets JOIN lists USING (tile, day) WHERE (day, ids) NOT IN (SELECT (day, ids) FROM known)"""


@query("trg10_gfsc", _GFSC)
def _(fx):
    return gapfill.trg_gfsc(fx, rules_of(fx), GFSC_LAST_DAY)[0]


_EXISTS = """WITH mine AS (SELECT r.tile, r.measurement_day AS day,
        string_agg(r.id, ',' ORDER BY r.id) AS ids FROM raw_inputs r WHERE r.product_type_code = 'S1_SWS_L2B' GROUP BY 1, 2),
    known AS (SELECT v.artificial_measurement_day AS day, string_agg(m.raw_input_id, ',' ORDER BY m.raw_input_id) AS ids
        FROM trigger_validation v JOIN raw2valid m ON m.trigger_validation_id = v.id
        WHERE v.triggering_condition_name = 'GFSC_TC' GROUP BY v.id, 1)
    SELECT concat(tile, '|', CAST(day AS STRING)) AS candidate_key FROM mine
    WHERE EXISTS (SELECT 1 FROM known k WHERE k.day = mine.day AND k.ids = mine.ids)"""


def _sws_sets(fx):
    return fx.raw_inputs.filter(F.col("product_type_code") == "S1_SWS_L2B").select(
        F.concat_ws("|", "tile", F.col("measurement_day").cast("string")).alias("candidate_key"),
        F.lit("GFSC_TC").alias("condition"), F.col("measurement_day").alias("day"), F.col("id").alias("raw_input_id"))


@query("agg13_exact_set_exists", _EXISTS)
def _(fx):
    return gapfill.exact_set_exists(_sws_sets(fx), fx)


@query("agg13_set_index", _EXISTS)
def _(fx):
    """The same from a stored index of fingerprints, to which the later half of the sets was appended."""
    log = TableLog(fx._spark, shared_dir(fx._spark, "set-index"), "triggers")
    for n in range(2):
        log.commit(n, {"set_index": gapfill.set_index(fx.replace(trigger_validation=fx.trigger_validation.where(f"id % 2 = {n}")))})
    return gapfill.exact_set_exists(_sws_sets(fx), fx.replace(set_index=log.rows("set_index")))


_WIC = f"""SELECT a.id, a.tile, a.measurement_day, b.id AS partner FROM raw_inputs a JOIN raw_inputs b
    ON a.tile = b.tile AND a.measurement_day = b.measurement_day
    WHERE a.product_type_code = 'S1_WICS1_L2B' AND b.product_type_code = 'S2_WICS2_L2B'
    AND a.id NOT IN {_TAKEN.format('WICS1S2_TC')}"""


@query("trg11_wics1s2", f"""SELECT DISTINCT {_cand("'WICS1S2_TC'", 'id', nrt='measurement_day = 20240130')} FROM ({_WIC}) x
    UNION ALL SELECT {_cand("'WICS1S2_TC'", 'id', member='partner', nrt='measurement_day = 20240130')} FROM ({_WIC}) y""")
def _(fx):
    return trg.trg_wics1s2(fx, rules_of(fx, "2024-01-30 12:00:00"))


@query("trg13_trigger_all", ALL)
def _(fx):
    return trg.trigger_all(fx.raw_inputs, fx, rules_of(fx))


_PAIRS = """(VALUES ('Backscatter_10m_TC', 'IW_GRDH_1S'), ('CC_TC', 'S2MSI1C'), ('FSC_TC', 'S2_MAJA_L2A'),
    ('WICS2_TC', 'S2_MAJA_L2A'), ('SWS_TC', 'S1_NRB_L2A'), ('WICS1_TC', 'S1_NRB_L2A'), ('WDS_TC', 'S2_FSC_L2B'))
    AS q(condition, kind)"""


_OFFERED = f"""(SELECT r.id FROM raw_inputs r JOIN {_PAIRS} ON q.kind = r.product_type_code WHERE NOT EXISTS (
    SELECT 1 FROM raw2valid m JOIN trigger_validation v ON v.id = m.trigger_validation_id WHERE m.raw_input_id = r.id
    AND v.triggering_condition_name = q.condition))"""


@query("trg14_backfill", f"""SELECT c.* FROM ({_all('DESC', f'h.id IN {_OFFERED}')}) c
    WHERE split_part(candidate_key, '|', 2) IN {_OFFERED}""")
def _(fx):
    return trg.backfill(fx, rules_of(fx), code_table(fx._spark, "catch_up_pairs"))


_MADE = f"""SELECT h.condition, h.candidate_key, h.first_id,
    (SELECT max(id) FROM trigger_validation) + row_number() OVER (ORDER BY substr(md5(h.candidate_key), 1, 3), h.candidate_key) AS vid,
    CASE WHEN r.product_type_code IN ('S2MSI1C', 'IW_GRDH_1S') THEN r.measurement_day >= 20240110
        ELSE r.harvesting_date BETWEEN r.publishing_date AND r.publishing_date + INTERVAL '3' HOUR END AS is_nrt
    FROM ({ALL}) h JOIN raw_inputs r ON r.id = h.first_id WHERE h.raw_input_id = h.first_id"""


@query("trg12_validations", f"""SELECT vid AS id, condition AS triggering_condition_name, TIMESTAMP '{AS_OF}' AS validation_date,
    is_nrt, CAST(NULL AS BIGINT) AS artificial_measurement_day, candidate_key FROM ({_MADE}) m""")
def _(fx):
    rules = rules_of(fx)
    return trg.materialise(trg.trigger_all(fx.raw_inputs, fx, rules), fx, rules)[0]


@query("trg12_members", f"""SELECT m.vid AS trigger_validation_id, c.raw_input_id FROM ({ALL}) c
    JOIN ({_MADE}) m USING (candidate_key)""")
def _(fx):
    rules = rules_of(fx)
    return trg.materialise(trg.trigger_all(fx.raw_inputs, fx, rules), fx, rules)[1]

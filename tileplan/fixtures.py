"""Catalogue tables derived from the ``events`` table, as SQL that Spark and DuckDB both read.

Every rule is one SELECT over ``events`` or over other rules. ``FixtureCatalogue`` offers them to the
operators as DataFrames; ``with_tables`` puts the rules a check needs in front of its SQL.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tileplan.catalogue import Catalogue
from tileplan.sources import reference

AS_OF = "2024-01-31 00:00:00"
CUTOVER = 20240110
GFSC_LAST_DAY = 20240101


def _id(expr: str) -> str:
    return f"concat('IN', lpad(CAST({expr} AS STRING), 8, '0'))"


def _hours(expr: str) -> str:
    return f"(CAST({expr} AS INT) * INTERVAL '1' HOUR)"


def _two(expr: str) -> str:
    return f"lpad(CAST({expr} AS STRING), 2, '0')"


def _values(table: str) -> str:
    """A code table as VALUES text for both engines."""
    names = [f.name for f in reference.schema(table)]

    def literal(v):
        if v is None:
            return "NULL"
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"

    rows = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in reference.rows(table))
    return f"SELECT * FROM (VALUES {rows}) AS v({', '.join(names)})"


RULES: dict[str, str] = {
    "fx_base": f"""
        SELECT event_id AS e, CAST(floor(event_id / 10) AS BIGINT) AS g, event_id % 10 AS k, user_id AS u, ts, value,
               CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS BIGINT) AS d,
               concat({_two('20 + user_id % 20')}, 'T', {_two('user_id % 100')}) AS tile,
               concat(CAST(year(ts) AS STRING), {_two('month(ts)')}, {_two('day(ts)')}, 'T', {_two('hour(ts)')},
                      {_two('minute(ts)')}, {_two('CAST(floor(second(ts)) AS INT)')}) AS t
        FROM events""",
    "raw_inputs": f"""
        SELECT {_id('e')} AS id,
               CASE k WHEN 0 THEN 'S2MSI1C' WHEN 1 THEN 'IW_GRDH_1S' WHEN 2 THEN 'S2_MAJA_L2A'
                      WHEN 3 THEN 'S1_NRB_L2A' WHEN 4 THEN 'S2_FSC_L2B' WHEN 5 THEN 'S1_SWS_L2B'
                      WHEN 6 THEN 'S1_WICS1_L2B' WHEN 7 THEN 'S2_WICS2_L2B' WHEN 8 THEN 'S1_WDS_L2B'
                      ELSE 'S2_CC_L2B' END AS product_type_code,
               ts AS start_date, ts AS publishing_date, tile, d AS measurement_day,
               CASE WHEN k = 1 THEN concat('s3://EODATA/S1A_IW_GRDH_1SDV_', CAST(d AS STRING), 'T0600',
                        {_two('(CAST(floor(g / 3) AS BIGINT) % 3) * 20')}, '_', CAST(d AS STRING), 'T0600', {_two('(CAST(floor(g / 3) AS BIGINT) % 3) * 20 + 20')},
                        '_000001_00000A_', lpad(CAST(e % 10000 AS STRING), 4, '0'), '.SAFE')
                    ELSE concat('s3://BUCKET/', tile, '/', {_id('e')}) END AS input_path,
               (k = 1 AND u % 3 > 0) AS is_partial,
               CASE WHEN k IN (1, 3) THEN CAST(u % 2 AS INT) END AS relative_orbit_number,
               ts + {_hours('e % 6')} AS harvesting_date
        FROM fx_base""",
    "trigger_validation": f"""
        SELECT e AS id,
               CASE k WHEN 0 THEN 'CC_TC' WHEN 1 THEN 'Backscatter_10m_TC' WHEN 2 THEN 'FSC_TC' WHEN 3 THEN 'SWS_TC'
                      WHEN 4 THEN 'WDS_TC' WHEN 5 THEN 'GFSC_TC' ELSE 'WICS1S2_TC' END AS triggering_condition_name,
               ts + {_hours('6')} AS validation_date, (e % 2 = 0) AS is_nrt,
               CASE WHEN k = 5 THEN d END AS artificial_measurement_day
        FROM fx_base WHERE k <= 6 AND g % 3 > 0""",
    "raw2valid": f"""
        SELECT e AS trigger_validation_id, {_id('e')} AS raw_input_id FROM fx_base WHERE k <= 6 AND g % 3 > 0
        UNION ALL
        SELECT b.e AS trigger_validation_id, {_id('b.e + 2')} AS raw_input_id
        FROM fx_base b WHERE b.k IN (0, 4) AND b.g % 3 > 0 AND b.e + 2 IN (SELECT event_id FROM events)""",
    "processing_tasks": f"""
        SELECT e * 10 AS id, e AS trigger_validation_fk_id, ts + {_hours('7')} AS creation_date,
               CASE WHEN k = 5 THEN d END AS processing_date,
               CASE WHEN g % 8 = 1 THEN {_id('e - 10')} END AS preceding_input_id,
               (g % 4 = 0 OR d % 3 > 0) AS has_ended, CAST(NULL AS STRING) AS intermediate_files_path
        FROM fx_base WHERE k <= 6 AND g % 3 > 0 AND g % 5 > 0""",
    "fx_runs": f"""
        SELECT b.e * 10 AS task_id, b.g, b.k, a.a, b.ts + {_hours('7')} + {_hours('a.a')} AS dispatch_date,
               concat('job-', CAST(b.e * 10 AS STRING), '-', CAST(a.a AS STRING)) AS job_id
        FROM fx_base b JOIN (VALUES (1), (2)) AS a(a) ON a.a = 1 OR b.g % 7 = 3
        WHERE b.k <= 6 AND b.g % 3 > 0 AND b.g % 5 > 0 AND b.g % 7 > 0""",
    "nomad_job_dispatch": """
        SELECT job_id AS id, CAST(NULL AS STRING) AS nomad_job_dispatch, dispatch_date,
               CAST(NULL AS STRING) AS log_path FROM fx_runs""",
    "processingtask2nomad": "SELECT job_id AS nomad_job_id, task_id AS processing_task_id FROM fx_runs",
    "processing_status_workflow": """
        SELECT task_id * 10 + a * 3 + s AS id, job_id AS nomad_job_dispatch_fk_id,
               CASE WHEN s = 0 THEN 3 WHEN s = 1 THEN 1 WHEN a = 1 AND g % 7 = 3 THEN 4 WHEN g % 6 < 3 THEN 2
                    WHEN g % 12 = 4 THEN 4 ELSE 5 END AS processing_status_id,
               dispatch_date + (CAST(s * 5 AS INT) * INTERVAL '1' MINUTE) AS date, CAST(NULL AS STRING) AS message,
               CASE WHEN s < 2 THEN CAST(NULL AS INT) WHEN a = 1 AND g % 7 = 3 THEN 404 WHEN g % 6 < 3 THEN 0
                    WHEN g % 12 = 4 THEN 110 ELSE 109 END AS exit_code
        FROM fx_runs JOIN (VALUES (0), (1), (2)) AS s(s) ON s.s < 2 OR g % 6 < 5
        WHERE g % 13 > 0""",
    "products": f"""
        SELECT concat('CLMS_WSI_', CASE WHEN k = 2 THEN 'FSC' ELSE 'CC' END, '_020m_T', tile, '_', t, '_S2A_V',
                      CAST(e AS STRING)) AS id,
               e AS trigger_validation_fk_id, CASE WHEN k = 2 THEN 'S2_FSC_L2B' ELSE 'S2_CC_L2B' END AS product_type_code,
               concat('s3://HR/', CASE WHEN k = 2 THEN 'FSC' ELSE 'CC' END, '/', tile, '/', CAST(e AS STRING)) AS product_path,
               ts + {_hours('9')} AS creation_date, ts + {_hours('10')} AS catalogue_date,
               CAST(NULL AS STRING) AS kpi_file_path
        FROM fx_base WHERE k IN (0, 2) AND g % 3 > 0 AND g % 5 > 0 AND (g % 4 = 0 OR d % 3 > 0)""",
    "indexation_workflow": f"""
        SELECT trigger_validation_fk_id * 2 + a AS id, id AS product_fk_id,
               CASE WHEN (trigger_validation_fk_id + a) % 3 = 0 THEN 1 END AS indexation_failure_type_id,
               catalogue_date + {_hours('a')} AS publication_date,
               CASE WHEN (trigger_validation_fk_id + a) % 3 > 0 THEN catalogue_date + {_hours('3')} END AS indexation_date,
               CASE WHEN (trigger_validation_fk_id + a) % 3 = 0 THEN catalogue_date + {_hours('4')} END AS failure_date
        FROM products CROSS JOIN (VALUES (0), (1)) AS a(a)""",
    "indexation_json": """
        SELECT trigger_validation_fk_id AS id, id AS product_fk_id, 1 AS indexation_file_type_id,
               concat(product_path, '/INSPIRE.xml') AS path FROM products""",
    "tile_track": """
        SELECT DISTINCT tile, 0 AS orbit FROM fx_base WHERE u % 4 < 3
        UNION ALL SELECT DISTINCT tile, 1 AS orbit FROM fx_base WHERE u % 5 < 2""",
    "tile_list": "SELECT DISTINCT tile FROM fx_base WHERE u % 10 < 8",
    "sentinel_tile": """
        SELECT *, start_date AS acquisition_date,
               CASE CAST(substr(id, 3) AS BIGINT) % 5 WHEN 0 THEN 'IDLE' WHEN 1 THEN 'IN_PROGRESS' WHEN 2 THEN 'ERROR'
                    WHEN 3 THEN 'FAILED' ELSE 'DONE' END AS state FROM raw_inputs""",
    "fx_named": """
        SELECT e, g, k, u, ts, d, t, tile, substr(t, 10, 6) AS hms,
               CASE WHEN e % 17 = 0 THEN '99ZZZ' ELSE tile END AS ntile,
               CASE WHEN e % 19 = 0 THEN 'S9X' ELSE 'S2A' END AS m2, CASE WHEN e % 19 = 0 THEN 'S9X' ELSE 'S1A' END AS m1,
               CASE WHEN e % 19 = 0 THEN 'SENTINEL9X' ELSE 'SENTINEL2A' END AS ml FROM fx_base""",
    "fx_names": """
        SELECT *,
               concat(m2, '_MSIL1C_', t, '_N0500_R095_T', ntile, '_', t, '.SAFE') AS l1c,
               concat(m1, '_IW_GRDH_1SDV_', CAST(d AS STRING), 'T060000_', CAST(d AS STRING),
                      'T060020_000001_00000A_C194.SAFE') AS grd1,
               concat(m1, '_IW_GRDH_1SDV_', CAST(d AS STRING), 'T060020_', CAST(d AS STRING),
                      'T060040_000001_00000B_C195.SAFE') AS grd2,
               concat(ml, '_', CAST(d AS STRING), '-', hms, '-000_L2A_T', ntile, '_C_V1-0') AS l2a,
               concat('SIG0_', t, '_', t, '_000001_00', CAST(u % 2 AS STRING), '_T', ntile, '_10m_', m1,
                      'IWGRDH_ENVEO') AS sig0,
               concat('CLMS_WSI_FSC_060m_T', ntile, '_', t, '_', m2, '_V100') AS fsc,
               concat('CLMS_WSI_SWS_060m_T', ntile, '_', t, '_', m1, '_V100') AS sws,
               concat('CLMS_WSI_WIC_060m_T', ntile, '_', t, '_', m1, '_V100') AS wics1,
               concat('CLMS_WSI_WIC_060m_T', ntile, '_', t, '_', m2, '_V100') AS wics2,
               concat('CLMS_WSI_WDS_060m_T', ntile, '_', t, '_', m1, '_V100') AS wds,
               concat('CLMS_WSI_CC_060m_T', ntile, '_', t, '_', m2, '_V100') AS cc,
               concat('CLMS_WSI_WIC_020m_T', ntile, '_', CAST(d AS STRING), 'T000000P12H_COMB_V100') AS comb,
               concat('CLMS_WSI_GFSC_060m_T', ntile, '_', CAST(d AS STRING), 'P7D_COMB_V102') AS gfsc
        FROM fx_named""",
    "named_inputs": """
        SELECT e,
               CASE k WHEN 0 THEN 'S2MSI1C' WHEN 1 THEN 'IW_GRDH_1S' WHEN 2 THEN 'S2_MAJA_L2A' WHEN 3 THEN 'S1_NRB_L2A'
                      WHEN 4 THEN 'S2_FSC_L2B' WHEN 5 THEN 'S1_SWS_L2B' WHEN 6 THEN 'S1_WICS1_L2B' WHEN 7 THEN 'S2_WICS2_L2B'
                      WHEN 8 THEN CASE WHEN g % 2 = 0 THEN 'S1_WDS_L2B' ELSE 'COMB_WICS1S2' END
                      ELSE CASE WHEN g % 2 = 0 THEN 'S2_CC_L2B' ELSE 'GFSC_L2C' END END AS product_type_code,
               CASE k WHEN 0 THEN l1c WHEN 1 THEN grd1 WHEN 2 THEN l2a WHEN 3 THEN sig0 WHEN 4 THEN fsc WHEN 5 THEN sws
                      WHEN 6 THEN wics1 WHEN 7 THEN wics2 WHEN 8 THEN CASE WHEN g % 2 = 0 THEN wds ELSE comb END
                      ELSE CASE WHEN g % 2 = 0 THEN cc ELSE gfsc END END AS name,
               tile, d, ts
        FROM fx_names""",
    "named_products": f"""
        SELECT name AS id, e AS trigger_validation_fk_id, product_type_code, concat('s3://HR/', name) AS product_path,
               ts + {_hours('9')} AS creation_date, ts + {_hours('10')} AS catalogue_date,
               CAST(NULL AS STRING) AS kpi_file_path FROM named_inputs""",
    "fx_run_members": """
        SELECT e, g, k, d, tile, u, 0 AS m,
               CASE k WHEN 0 THEN 'CC' WHEN 1 THEN 'SIG0' WHEN 2 THEN CASE WHEN g % 2 = 0 THEN 'FSC' ELSE 'WICS2' END
                      WHEN 3 THEN CASE g % 3 WHEN 0 THEN 'SWS' WHEN 1 THEN 'WICS1' ELSE 'WDS' END
                      WHEN 5 THEN 'GFSC' WHEN 6 THEN 'WICS1S2' ELSE 'OTHER' END AS routine,
               CASE k WHEN 0 THEN l1c WHEN 1 THEN grd1 WHEN 2 THEN l2a WHEN 3 THEN sig0 WHEN 5 THEN sws
                      WHEN 6 THEN concat(wics1, '/') ELSE fsc END AS name FROM fx_names WHERE k <= 6
        UNION ALL
        SELECT e, g, k, d, tile, u, 1 AS m,
               CASE k WHEN 0 THEN 'CC' WHEN 1 THEN 'SIG0' WHEN 3 THEN 'WDS' WHEN 5 THEN 'GFSC' ELSE 'WICS1S2' END AS routine,
               CASE k WHEN 0 THEN l2a WHEN 1 THEN grd2 WHEN 3 THEN fsc WHEN 5 THEN fsc ELSE concat(wics2, '/') END AS name
        FROM fx_names WHERE k IN (5, 6) OR (k IN (0, 1) AND g % 2 = 0) OR (k = 3 AND g % 3 = 2)
        UNION ALL
        SELECT e, g, k, d, tile, u, 2 AS m, CASE WHEN k = 3 THEN 'WDS' ELSE 'GFSC' END AS routine,
               concat(fsc, 'B/') AS name FROM fx_names WHERE (k = 3 AND g % 6 = 2) OR (k = 5 AND g % 2 = 0)""",
    "run_inputs": f"""
        SELECT concat({_id('e')}, '-', CAST(m AS STRING)) AS raw_input_id, e AS trigger_validation_id,
               e * 10 AS processing_task_id, routine AS processing_routine_name, tile, d AS measurement_day,
               CAST(u % 2 AS INT) AS relative_orbit_number, CASE WHEN k = 5 THEN d END AS processing_date,
               concat('s3://', CASE WHEN name LIKE '%MSIL1C%' OR name LIKE '%GRDH_1SDV%' THEN 'EODATA' ELSE 'BUCKET' END,
                      '/', tile, '/', name) AS input_path
        FROM fx_run_members""",
    "listing": """
        SELECT concat('CAMS/', substr(CAST(d AS STRING), 1, 4), '/', substr(CAST(d AS STRING), 5, 2), '/',
                      substr(CAST(d AS STRING), 7, 2), '/aerosol.nc') AS path
        FROM (SELECT DISTINCT d FROM fx_base) days WHERE d % 4 > 0
        UNION ALL SELECT concat('FMI_WINDSPEED/', CAST(d AS STRING), '_wind_speed.nc')
        FROM (SELECT DISTINCT d FROM fx_base) days WHERE d % 5 > 0
        UNION ALL SELECT concat('FMI_TEMPERATURE/', CAST(d AS STRING), '_t2m_sum.nc')
        FROM (SELECT DISTINCT d FROM fx_base) days WHERE d % 7 > 0""",
    "sources": """
        SELECT * FROM (VALUES
            ('L1C_TC', 'S2MSI1C', 'Sentinel2', 5, 5, CAST(NULL AS STRING), '20240110', '20240105', '20240112'),
            ('GRD_TC', 'IW_GRDH_1S', 'Sentinel1', 5, 5, 'NRT-3h', '20240110', '20240105', '20240112'),
            ('GRD_TC', 'IW_GRDH_1S', 'Sentinel1', 5, 5, 'Fast-24h', '20240110', NULL, NULL)
        ) AS v(triggering_condition_name, input_type, collection, max_day_since_publication_date,
               max_day_since_measurement_date, timeliness, nrt_harvest_start_date, archive_harvest_start_date,
               archive_harvest_end_date)""",
}
for _code_table in ("raster_type", "processing_routine", "triggering_condition", "processing_status",
                    "indexation_file_type", "indexation_failure_type", "condition_limits"):
    RULES[_code_table] = _values(_code_table)

_WORD = re.compile(r"[a-z_][a-z0-9_]*")


def _needed(sql: str) -> list[str]:
    """The rules a text names, and the rules those need, in the order of RULES."""
    found, todo = set(), [sql]
    while todo:
        for word in set(_WORD.findall(todo.pop())):
            if word in RULES and word not in found:
                found.add(word)
                todo.append(RULES[word])
    order, done = [], set()

    def place(name):
        if name in done:
            return
        done.add(name)
        for word in sorted(set(_WORD.findall(RULES[name]))):
            if word in RULES and word != name:
                place(word)
        order.append(name)

    for name in sorted(found):
        place(name)
    return order


def with_tables(sql: str) -> str:
    """The SQL with the rules it needs as common table expressions; it may start with its own WITH."""
    body = sql.strip()
    ctes = [f"{name} AS ({RULES[name].strip()})" for name in _needed(body)]
    if not ctes:
        return body
    recursive = ""
    if body[:14].upper() == "WITH RECURSIVE":
        recursive, body = "RECURSIVE ", ", " + body[14:].strip()
    elif body[:5].upper() == "WITH ":
        body = ", " + body[5:].strip()
    return f"WITH {recursive}" + ",\n".join(ctes) + "\n" + body


class FixtureCatalogue(Catalogue):
    """The derived tables over the events below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root
        super().__init__({name: (lambda n=name: self.sql(f"SELECT * FROM {n}")) for name in RULES})

    def sql(self, text: str) -> DataFrame:
        query = with_tables(text)
        events = self._spark.read.parquet(f"{self._root}/events.parquet")
        return self._spark.sql(re.sub(r"\bFROM events\b", "FROM {events}", query), events=events)

    def stream(self, name: str, more: str = "") -> DataFrame:
        """A derived table as a stream over the events; lookups inside its rule stay batch reads.

        The table may be one file or a folder of files; a stream takes both by a pattern, but a single file not by its name.
        """
        source = (self._spark.readStream.schema(self._spark.read.parquet(f"{self._root}/events.parquet").schema)
                  .parquet(f"{self._root}/events.parque[t]"))
        query = with_tables(f"SELECT * FROM {name} {more}")
        base = RULES["fx_base"].strip()
        query = query.replace(base, base.replace("FROM events", "FROM {stream}"))
        query = re.sub(r"\bFROM events\b", "FROM {events}", query)
        tables = {"stream": source}
        if "{events}" in query:
            tables["events"] = self._spark.read.parquet(f"{self._root}/events.parquet")
        return self._spark.sql(query, **tables)

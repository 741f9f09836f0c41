"""PRJ queries."""

from pyspark.sql import functions as F

from tileplan.fixtures import AS_OF
from tileplan.functions import names, scalars as s
from tileplan.registry import query

_INPUT = """SELECT e, product_type_code, name, string_split(name, '_') AS p, ts FROM named_inputs"""


@query("prj01_products_to_inputs", f"""SELECT name AS id, product_type_code,
    CASE product_type_code WHEN 'S2_MAJA_L2A' THEN strptime(p[2], '%Y%m%d-%H%M%S-%g')
        WHEN 'S1_NRB_L2A' THEN strptime(p[2], '%Y%m%dT%H%M%S')
        WHEN 'GFSC_L2C' THEN strptime(p[6][:8], '%Y%m%d') ELSE strptime(p[6][:15], '%Y%m%dT%H%M%S') END AS start_date,
    ts + INTERVAL '10' HOUR AS publishing_date,
    CASE product_type_code WHEN 'S2_MAJA_L2A' THEN p[4][2:] WHEN 'S1_NRB_L2A' THEN p[6][2:] ELSE p[5][2:] END AS tile,
    CAST(CASE WHEN product_type_code IN ('S2_MAJA_L2A', 'S1_NRB_L2A') THEN p[2][:8] ELSE p[6][:8] END AS BIGINT)
        AS measurement_day,
    concat('s3://HR/', name) AS input_path, false AS is_partial,
    CASE WHEN product_type_code = 'S1_NRB_L2A' THEN CAST(p[5] AS INT) END AS relative_orbit_number,
    CAST(NULL AS TIMESTAMP) AS harvesting_date
    FROM ({_INPUT}) x WHERE product_type_code NOT IN ('S2MSI1C', 'IW_GRDH_1S')""")
def _(fx):
    return names.products_to_inputs(fx.named_products)


@query("prj01_product_rejects", """SELECT name AS id, product_type_code FROM named_inputs
    WHERE product_type_code IN ('S2MSI1C', 'IW_GRDH_1S')""")
def _(fx):
    return names.product_rejects(fx.named_products)


@query("prj02_parse_grd", f"""SELECT e, p[1] AS mission, p[5] AS start, p[6] AS stop, p[8] AS acquisition_id
    FROM (SELECT e, string_split(string_split(name, '.')[1], '_') AS p FROM named_inputs
          WHERE product_type_code = 'IW_GRDH_1S') x""")
def _(fx):
    grd = fx.named_inputs.filter(F.col("product_type_code") == "IW_GRDH_1S")
    return grd.select("e", names.parse_grd("name").alias("n")).select("e", "n.*")


@query("prj03_parse_l1c", f"""SELECT e, p[1] AS mission, p[3][:8] AS day, p[3] AS stamp, p[6][2:] AS tile
    FROM ({_INPUT}) x WHERE product_type_code = 'S2MSI1C'""")
def _(fx):
    l1c = fx.named_inputs.filter(F.col("product_type_code") == "S2MSI1C")
    return l1c.select("e", names.parse_l1c(F.col("name")).alias("n")).select("e", "n.*")


@query("prj04_parse_l2a", f"""SELECT e, p[1] AS mission, concat('S2', right(p[1], 1)) AS short_mission, p[2][:8] AS day,
    p[2][10:15] AS time, p[4][2:] AS tile FROM ({_INPUT}) x WHERE product_type_code = 'S2_MAJA_L2A'""")
def _(fx):
    l2a = fx.named_inputs.filter(F.col("product_type_code") == "S2_MAJA_L2A")
    return l2a.select("e", names.parse_l2a(F.col("name")).alias("n")).select("e", "n.*")


@query("prj05_parse_sig0", f"""SELECT e, p[8][:3] AS mission, p[2][:8] AS day, p[2][10:] AS time, p[6][2:] AS tile,
    p[5] AS orbit FROM ({_INPUT}) x WHERE product_type_code = 'S1_NRB_L2A'""")
def _(fx):
    sig0 = fx.named_inputs.filter(F.col("product_type_code") == "S1_NRB_L2A")
    return sig0.select("e", names.parse_sig0(F.col("name")).alias("n")).select("e", "n.*")


def _shift(n):
    return (f"CAST(strftime(strptime(CAST(measurement_day AS STRING), '%Y%m%d') + INTERVAL ({n}) DAY, '%Y%m%d') "
            f"AS BIGINT) AS d{abs(n)}")


@query("prj06_day_add", f"SELECT id, {_shift(-90)}, {_shift(-7)}, {_shift(1)} FROM raw_inputs")
def _(fx):
    return fx.raw_inputs.select("id", *[s.day_add("measurement_day", n).alias(f"d{abs(n)}") for n in (-90, -7, 1)])


@query("prj07_deadlines", """SELECT c.condition, DATE '2024-01-31' - max_publication_days AS earliest_publication,
    DATE '2024-01-31' - max_measurement_days AS earliest_measurement, count(v.id) AS n_validations
    FROM condition_limits c JOIN trigger_validation v ON v.triggering_condition_name = c.condition GROUP BY 1, 2, 3""")
def _(fx):
    limits = F.broadcast(s.deadlines(fx.condition_limits, AS_OF))
    return (fx.trigger_validation.join(limits, F.col("triggering_condition_name") == F.col("condition"))
            .groupBy("condition", "earliest_publication", "earliest_measurement")
            .agg(F.count("*").alias("n_validations")))


@query("prj08_iso_ms", "SELECT id, strftime(harvesting_date, '%Y-%m-%dT%H:%M:%S.%g') AS harvesting_text FROM raw_inputs")
def _(fx):
    return fx.raw_inputs.select("id", s.iso_ms("harvesting_date").alias("harvesting_text"))


@query("prj10_dashed_day", """SELECT id, strftime(strptime(CAST(measurement_day AS STRING), '%Y%m%d'), '%Y-%m-%d') AS day
    FROM raw_inputs""")
def _(fx):
    return fx.raw_inputs.select("id", s.dashed_day("measurement_day").alias("day"))


@query("prj11_paths", """SELECT raw_input_id, list_filter(string_split(input_path, '/'), lambda x: x <> '')[-1] AS name,
    concat(rtrim(input_path, '/'), '/') AS dir, string_split(input_path, '/')[-1] AS base FROM run_inputs""")
def _(fx):
    return fx.run_inputs.select("raw_input_id", s.path_name("input_path").alias("name"),
                                s.path_dir("input_path").alias("dir"), s.base_name("input_path").alias("base"))


_NS = """(SELECT id, CASE WHEN has_ended THEN 1704067200000000000 + id * 1000000007 END AS dispatch_ns,
    CASE WHEN id % 70 > 0 THEN 1704067201000000000 + id * 1000000000 END AS submit_ns FROM processing_tasks)"""


@query("prj12_run_times", f"""SELECT id, strftime(make_timestamp(dispatch_ns // 1000), '%Y-%m-%dT%H:%M:%S') AS dispatched,
    floor(1706659200 - coalesce(dispatch_ns, submit_ns) / 1000000000.0)::BIGINT AS age FROM {_NS} n""")
def _(fx):
    runs = fx.sql(f"SELECT * FROM {_NS} n")
    return runs.select("id", s.ns_time("dispatch_ns").alias("dispatched"),
                       F.floor(s.age_seconds("dispatch_ns", "submit_ns", AS_OF)).cast("bigint").alias("age"))


_STATE = "CASE id % 5 WHEN 0 THEN 'running' WHEN 1 THEN 'pending' WHEN 2 THEN 'dead' WHEN 3 THEN 'complete' ELSE 'odd' END"


@query("prj13_map_run_state", f"""SELECT id, CASE ({_STATE}) WHEN 'running' THEN 'started' WHEN 'pending' THEN 'pending'
    WHEN 'dead' THEN 'internal_error' WHEN 'complete' THEN 'processed' END AS status FROM processing_status_workflow""")
def _(fx):
    return fx.processing_status_workflow.select("id", s.map_run_state(F.expr(_STATE)).alias("status"))


@query("prj14_normalise_code", """SELECT e, CASE WHEN e % 3 < 2 THEN CASE e % 2 WHEN 0 THEN 'S1' ELSE 'S2' END END AS satellite,
    CASE e % 3 WHEN 0 THEN 'hma.large' WHEN 1 THEN 'eo1.large' END AS flavour FROM fx_base""")
def _(fx):
    made = fx.sql("""SELECT e, CASE WHEN e % 3 = 2 THEN 'X9' WHEN e % 2 = 0 THEN 's1' ELSE 'S2' END AS sat,
        CASE e % 3 WHEN 0 THEN 'HMA.Large' WHEN 1 THEN 'eo1.LARGE' ELSE 'none' END AS fl FROM fx_base""")
    return made.select("e", s.normalise_code("sat", "satellite").alias("satellite"),
                       s.normalise_code("fl", "flavour").alias("flavour"))


@query("prj17_is_nrt_now", """SELECT id, harvesting_date >= publishing_date
    AND date_diff('microsecond', publishing_date, harvesting_date) <= 10800000000 AS is_nrt FROM raw_inputs""")
def _(fx):
    return fx.raw_inputs.select("id", s.is_nrt_now().alias("is_nrt"))


@query("prj18_is_nrt_past", """SELECT id, CASE WHEN product_type_code IN ('S2MSI1C', 'IW_GRDH_1S')
    THEN measurement_day >= 20240110
    ELSE harvesting_date BETWEEN publishing_date AND publishing_date + INTERVAL '3' HOUR END AS is_nrt FROM raw_inputs""")
def _(fx):
    return s.is_nrt_past(fx.raw_inputs, fx.sources).select("id", "is_nrt")


@query("prj19_half_day", """SELECT id, CASE WHEN date_part('hour', start_date) >= 12 THEN '120000' ELSE '000000' END AS slot
    FROM raw_inputs""")
def _(fx):
    return fx.raw_inputs.select("id", s.half_day(F.hour("start_date")).alias("slot"))


# Acquisition dates spread over the years around the two changes of folder.
_ACQ = "(SELECT id, CAST(CAST('2021-06-01' AS DATE) + CAST(CAST(substr(id, 3) AS BIGINT) % 900 AS INT) AS DATE) AS day FROM raw_inputs)"


@query("prj20_source_root", f"""SELECT id, CASE WHEN day >= DATE '2022-01-01' THEN 'new' ELSE 'old' END AS l1c,
    CASE WHEN day > DATE '2023-02-21' THEN 'new' ELSE 'old' END AS grd FROM {_ACQ} a""")
def _(fx):
    roots = {"l1c": "new", "l1c_old": "old", "grd": "new", "grd_old": "old"}
    return fx.sql(f"SELECT * FROM {_ACQ} a").select(
        "id", s.source_root("L1C", F.col("day"), roots).alias("l1c"), s.source_root("GRD", F.col("day"), roots).alias("grd"))


@query("prj21_pad_orbit", """SELECT id, CASE WHEN u < 1000 THEN right(concat('00', CAST(u AS STRING)), 3)
    ELSE CAST(u AS STRING) END AS orbit FROM (SELECT id, CAST(substr(id, 3) AS BIGINT) % 1200 AS u FROM raw_inputs) x""")
def _(fx):
    return fx.raw_inputs.select("id", s.pad_orbit(F.substring("id", 3, 20).cast("bigint") % 1200).alias("orbit"))


_IMAGE = "concat('registry.', lower(tile), '.example:', CAST(5000 + measurement_day % 10 AS STRING), '/wsi/', lower(product_type_code), ':', id)"


@query("prj15_image_parts", f"""SELECT id, concat('registry.', lower(tile), '.example') AS registry_host, CAST(5000 + measurement_day % 10 AS STRING) AS registry_port,
    concat('wsi/', lower(product_type_code)) AS image_name, id AS tag, {_IMAGE} AS image FROM raw_inputs""")
def _(fx):
    """Image texts taken apart and put together again."""
    parts = fx.sql(f"SELECT id, {_IMAGE} AS image FROM raw_inputs").select("id", s.image_parts("image").alias("p")).select("id", "p.*")
    return parts.withColumn("image", s.image_text(*[F.col(c) for c in ("registry_host", "registry_port", "image_name", "tag")]))


_NAMED = "(SELECT id, date_trunc('second', start_date) AS begin, CAST(right(id, 1) AS INT) AS k FROM raw_inputs)"


@query("prj16_l1c_product_date", f"""SELECT id, strftime(CASE WHEN k BETWEEN 4 AND 6 THEN begin + (k - 3) * INTERVAL '20' SECOND ELSE begin END,
    '%Y%m%dT%H%M%S') AS product_date FROM {_NAMED} n""")
def _(fx):
    """Names from a minute before the interval to two minutes after it; both ends lie outside."""
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    rows = fx.sql(f"SELECT id, begin, begin + (k - 3) * INTERVAL '20' SECOND AS named, begin + INTERVAL '80' SECOND AS until FROM {_NAMED} n")
    xml = F.concat(F.lit('<md xmlns:gml="http://www.opengis.net/gml"><gml:TimePeriod><gml:beginPosition>'), stamp("begin"),
                   F.lit("</gml:beginPosition><gml:endPosition>"), stamp("until"), F.lit("</gml:endPosition></gml:TimePeriod></md>"))
    return rows.select("id", s.l1c_product_date(xml, F.date_format("named", "yyyyMMdd'T'HHmmss")).alias("product_date"))

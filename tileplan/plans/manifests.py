"""AGG-16, TSK-07 and MAN: the inputs of a task by role, and its run manifest.

A manifest is a set of lines (processing_task_id, processing_routine_name, key, value), all routines in one table.
Lines with one value come from the templates by a broadcast join on the routine; lists of inputs are one line per
input. So a task with very many inputs is never gathered into one row.
"""

from __future__ import annotations

import re
from itertools import cycle

from pyspark.sql import Column, DataFrame, functions as F

from tileplan.functions.names import grd_fields, l1c_fields, l2a_fields, name_parts, sig0_fields
from tileplan.functions.scalars import base_name, day_to_date, half_day, pad_orbit, path_dir, path_name, source_root
from tileplan.plans.templates import ROOTS, TITLES, manifest_lines
from tileplan.session import moment
from tileplan.sources.files import aux_ready

# Fixed values.
SPAN_DAYS = "7"
S2_MISSIONS_L1C = ["S2A", "S2B"]
L2A_MISSIONS = ["SENTINEL2A", "SENTINEL2B", "SENTINEL2C"]
S1_MISSIONS = ["S1A", "S1B", "S1C"]
NEED_AUX = ["CC", "WICS1"]
FLOOR, FLOOR_LATE = "2016-08-01", "2016-09-01"
KEYS = {"GRD": "input.GRD", "FSCS": "input.FSCs", "SWS": "input.SWS", "FSC": "input.FSC", "WIC_S1": "input.WIC_S1",
        "WIC_S2": "input.WIC_S2"}


def gather_inputs(run_info: DataFrame) -> DataFrame:
    """AGG-16: the inputs of every task with their role, found by the pattern of their path; one row per role.

    An input no pattern of the routine fits has no row.
    """
    routine, path = F.col("processing_routine_name"), F.col("input_path")
    base, last = base_name(path), path_name(path)
    is_ = lambda *names: routine.isin(*names)
    role = (F.when(is_("FSC", "WICS2"), "L2A").when(is_("SWS", "WICS1"), "SIGMA0")
            .when(is_("CC"), F.when(base.rlike("MSI(L)?1C"), "L1C").when(base.contains("L2A"), "L2A"))
            .when(is_("WDS"), F.when(base.contains("SIG0"), "SIGMA0").when(path.contains("CLMS_WSI_FSC"), "FSCS"))
            .when(is_("SIG0"), F.when(path.contains("GRD"), "GRD"))
            .when(is_("GFSC"), F.when(last.contains("FSC"), "FSC").when(last.contains("SWS"), "SWS"))
            .when(is_("WICS1S2"), F.when(path.contains("S1"), "WIC_S1")))
    # A path of the combined product may name both sensors and then has both roles.
    second = F.when(is_("WICS1S2") & path.contains("S2"), "WIC_S2")
    roles = F.explode(F.array(role, second))
    return run_info.withColumn("role", roles).filter(F.col("role").isNotNull())


def cc_mode(n_inputs: Column) -> Column:
    """TSK-07: two inputs run the nominal mode, else the initial one."""
    return F.when(n_inputs == 2, "L2NOMINAL").otherwise("L2INIT")


def _agrees() -> Column:
    """Whether the name of an input fits its mission, tile and day, as far as its role demands it."""
    parts, tile, day = F.col("parts"), F.col("tile"), F.col("measurement_day").cast("string")
    l1c, l2a, sig0, grd = l1c_fields(parts), l2a_fields(parts), sig0_fields(parts), grd_fields(parts)
    fits = (F.when(F.col("role") == "L1C", l1c["mission"].isin(S2_MISSIONS_L1C) & (l1c["tile"] == tile) & (l1c["day"] == day))
            .when(F.col("role") == "L2A", l2a["mission"].isin(L2A_MISSIONS) & (l2a["tile"] == tile)
                  & ((F.col("processing_routine_name") == "CC") | (l2a["day"] == day)))
            .when(F.col("role") == "SIGMA0", sig0["mission"].isin(S1_MISSIONS) & (sig0["tile"] == tile) & (sig0["day"] == day))
            .when(F.col("role") == "GRD", grd["mission"].isin(S1_MISSIONS) & (F.left(grd["start"], F.lit(8)) == day))
            .otherwise(F.lit(True)))
    return F.coalesce(fits, F.lit(False))


def manifest_tasks(run_info: DataFrame, as_of, l1c_dates: DataFrame | None = None) -> DataFrame:
    """MAN-10: one row per task with the values its manifest needs and the checks it passes.

    First and last slices are the smallest and largest name; everything is ``min``, ``max`` or ``bool_and``, combined
    before the shuffle. ``l1c_dates`` (processing_task_id, product_date) replaces the time in the L1C name.
    """
    rows = gather_inputs(run_info).withColumn("name", path_name("input_path"))
    rows = rows.withColumn("parts", name_parts("name")).withColumn("agrees", _agrees())
    of = lambda f, role: f(F.when(F.col("role") == role, F.col("name")))
    tasks = rows.groupBy("processing_task_id", "processing_routine_name").agg(
        F.min("tile").alias("tile"),
        F.min("measurement_day").alias("input_day"),
        F.min(F.when(F.col("role") == "L1C", F.col("measurement_day"))).alias("l1c_day"),
        F.max("processing_date").alias("processing_date"),
        F.min("relative_orbit_number").alias("relative_orbit_number"),
        F.count("*").alias("n_inputs"),
        F.bool_and("agrees").alias("name_agrees"),
        *[of(F.min, r).alias(r.lower()) for r in ("L1C", "L2A", "SIGMA0", "GRD", "WIC_S1")],
        of(F.max, "GRD").alias("grd_last"))
    routine = F.col("processing_routine_name")
    is_ = lambda *names: routine.isin(*names)
    day = F.when(is_("CC"), F.col("l1c_day")).when(is_("GFSC"), F.col("processing_date")).otherwise(F.col("input_day"))
    tasks = tasks.withColumns({"date": day_to_date(day), "ymd": day.cast("string")})
    if l1c_dates is not None:
        tasks = tasks.join(l1c_dates, "processing_task_id", "left")
    else:
        tasks = tasks.withColumn("product_date", F.lit(None).cast("string"))
    # Each name is split once; the columns keep the optimiser from splitting it again for every field.
    tasks = tasks.withColumns({
        "p_main": name_parts(F.coalesce("l1c", "sigma0", "grd", "wic_s1")), "p_l2a": name_parts("l2a"),
        "p_last": name_parts("grd_last")})
    main_parts = F.col("p_main")
    l1c, l2a, sig0 = l1c_fields(main_parts), l2a_fields(F.col("p_l2a")), sig0_fields(main_parts)
    first, last = grd_fields(main_parts), grd_fields(F.col("p_last"))
    s2, s1 = is_("FSC", "WICS2"), is_("SWS", "WICS1", "WDS")
    join_t = lambda d, t: F.concat(d, F.lit("T"), t)
    # The end of a slice carries the day of its start.
    values = {
        "year": F.substring("ymd", 1, 4), "month": F.substring("ymd", 5, 2), "day": F.substring("ymd", 7, 2),
        "now": F.date_format(moment(as_of), "yyyyMMdd'T'HHmmss"), "span": F.lit(SPAN_DAYS),
        "name": F.when(is_("CC"), F.col("l1c")).when(s2, F.col("l2a")).when(s1, F.col("sigma0")),
        "stamp": (F.when(is_("CC"), F.coalesce("product_date", l1c["stamp"])).when(s2, join_t(l2a["day"], l2a["time"]))
                  .when(s1, join_t(sig0["day"], sig0["time"])).when(is_("SIG0"), first["start"])),
        "stop": join_t(F.left(last["start"], F.lit(8)), F.substring_index(last["stop"], "T", -1)),
        "acquisition": last["acquisition_id"],
        "mission": (F.when(is_("CC"), l1c["mission"]).when(s2, l2a["short_mission"]).when(s1, sig0["mission"])
                    .when(is_("SIG0"), last["mission"])),
        "orbit": F.when(is_("SIG0"), pad_orbit("relative_orbit_number")).when(s1, sig0["orbit"]),
        "slot": half_day(F.substring(F.substring_index(F.get(main_parts, F.lit(5)), "T", -1), 1, 2)
                         .try_cast("int")),
        "mode": cc_mode(F.col("n_inputs")),
        "l2a_folder": F.when(is_("CC"), F.concat_ws("/", F.substring(l2a["day"], 1, 4), F.substring(l2a["day"], 5, 2),
                                                    F.substring(l2a["day"], 7, 2))),
    }
    values["l2a_folder"] = F.when(F.col("n_inputs") == 2, values["l2a_folder"])
    tasks = tasks.withColumns(values)
    floor = F.when(is_("FSC", "GFSC"), FLOOR_LATE).otherwise(FLOOR).cast("date")
    now = moment(as_of)
    start = F.col("date").cast("timestamp_ntz")
    in_time = F.when(is_("WICS2"), (start <= now) & (F.col("date") >= floor)).otherwise(
        (start < now) & (F.col("date") > floor))
    main = (F.when(is_("SIG0"), F.col("grd")).when(is_("WICS1S2"), F.col("wic_s1")).when(is_("GFSC"), F.lit(""))
            .otherwise(F.col("name")))
    # Without a template the routine is unknown.
    reason = (F.when(~routine.isin(list(TITLES)), "unknown routine").when(main.isNull(), "missing input")
              .when(~F.coalesce(in_time, F.lit(False)), "date").when(~F.col("name_agrees"), "name"))
    return tasks.withColumn("reject_reason", reason).drop("p_main", "p_l2a", "p_last")


def manifest_rejects(run_info: DataFrame, as_of) -> DataFrame:
    """MAN-10: the tasks without manifest and why; also those no input of which has a role."""
    checked = manifest_tasks(run_info, as_of).select("processing_task_id", "processing_routine_name", "reject_reason")
    tasks = run_info.select("processing_task_id", "processing_routine_name").distinct()
    unknown = ~F.col("processing_routine_name").isin(list(TITLES))
    reason = F.when(F.col("known").isNull(), F.when(unknown, "unknown routine").otherwise("missing input")).otherwise(
        F.col("reject_reason"))
    return (tasks.join(checked.withColumn("known", F.lit(True)), ["processing_task_id", "processing_routine_name"], "left")
            .select("processing_task_id", "processing_routine_name", reason.alias("reject_reason"))
            .filter(F.col("reject_reason").isNotNull()))


_NAME = re.compile(r"\{(\w+)\}")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _compiled(pattern: str) -> str:
    """A pattern as one SQL concatenation of its text and the task's values; null if one of them is unknown. Values are
    put in as they are, also those that hold braces."""
    pieces = [f"CAST({x} AS STRING)" if name else _text(x) for name, x in zip(cycle((False, True)), _NAME.split(pattern)) if x]
    return f"concat({', '.join(pieces)})" if pieces else "''"


def _by_routine(values: dict[str, str]) -> Column:
    """The SQL value of a task's routine."""
    cases = " ".join(f"WHEN {_text(routine)} THEN {value}" for routine, value in values.items())
    return F.expr(f"CASE processing_routine_name {cases} END")


def manifests(run_info: DataFrame, as_of, roots: dict[str, str] | None = None, l1c_dates: DataFrame | None = None,
              routine: str | None = None, listing: DataFrame | None = None) -> DataFrame:
    """MAN-01..09 and MAN-11: manifest lines of all good tasks, or of those of one routine.

    With ``listing`` (path) of the auxiliary store, tasks whose data of the day is not there yet are held back and come
    again later (SRC-07); ``held_back`` names them.

    The inputs are shuffled once by task to make the task rows. Templates are compiled to one array of key and value
    per routine, which is exploded in place; the list lines join the inputs with the task rows, from the same shuffle.
    """
    roots = {**ROOTS, **(roots or {})}
    if routine is not None:
        run_info = run_info.filter(F.col("processing_routine_name") == routine)
    if listing is not None:
        run_info = _with_aux(run_info, listing)
    wanted = [r for r in TITLES if routine in (None, r)]
    tasks = manifest_tasks(run_info, as_of, l1c_dates).filter(F.col("reject_reason").isNull() & F.col(
        "processing_routine_name").isin(wanted))
    tasks = tasks.withColumns({"l1c_root": source_root("L1C", F.col("date"), roots),
                               "grd_root": source_root("GRD", F.col("date"), roots)})
    tasks = tasks.withColumn("title", _by_routine({r: _compiled(TITLES[r]) for r in wanted}))
    patterns: dict[str, list[str]] = {r: [] for r in wanted}
    for r, key, pattern in manifest_lines(roots):
        if r in patterns:
            patterns[r].append(f"named_struct('key', {_text(key)}, 'value', {_compiled(pattern)})")
    lines = F.explode(_by_routine({r: f"array({', '.join(p)})" for r, p in patterns.items()}))
    columns = ["processing_task_id", "processing_routine_name", "key", "value"]
    single = tasks.select("processing_task_id", "processing_routine_name", lines.alias("line")).select(
        "processing_task_id", "processing_routine_name", "line.key", "line.value").filter(F.col("value").isNotNull())
    return single.unionByName(_list_lines(run_info, tasks, roots).select(*columns))


def _with_aux(run_info: DataFrame, listing: DataFrame) -> DataFrame:
    """SRC-07: the rows of the tasks whose auxiliary data is at hand, by the day that the manifest is made for: that of
    the L1C for CC, that of the inputs for WICS1."""
    return run_info.join(held_back(run_info, listing).select("processing_task_id"), "processing_task_id", "left_anti").select(
        *run_info.columns)


def held_back(run_info: DataFrame, listing: DataFrame) -> DataFrame:
    """SRC-07: (processing_task_id, processing_routine_name, measurement_day) of the tasks that wait for auxiliary data."""
    routine = F.col("processing_routine_name")
    main = F.when(routine == "CC", base_name("input_path").rlike("MSI(L)?1C")).otherwise(F.lit(True))
    days = run_info.filter(routine.isin(NEED_AUX) & main).groupBy("processing_task_id", "processing_routine_name").agg(
        F.min("measurement_day").alias("measurement_day"))
    lacking = days.select("processing_routine_name", "measurement_day").distinct()
    lacking = lacking.join(aux_ready(lacking, listing), ["processing_routine_name", "measurement_day"], "left_anti")
    return days.join(lacking, ["processing_routine_name", "measurement_day"], "left_semi").select(
        "processing_task_id", "processing_routine_name", "measurement_day")


def _list_lines(run_info: DataFrame, tasks: DataFrame, roots: dict[str, str]) -> DataFrame:
    """One line per input of the list-valued keys, for the good tasks."""
    place = tasks.select("processing_task_id", "year", "month", "day", "grd_root")
    rows = gather_inputs(run_info).filter(F.col("role").isin(list(KEYS))).join(place, "processing_task_id")
    name, role = path_name("input_path"), F.col("role")
    value = (F.when(role == "GRD", F.concat_ws("/", "grd_root", "year", "month", "day", name))
             .when(role == "FSCS", F.concat_ws("/", F.lit(roots["products"]), F.lit("FSC"), "tile", "year", "month", "day", name))
             .when(role.isin("FSC", "SWS"), path_dir("input_path"))
             .otherwise(F.col("input_path")))
    keys = F.create_map(*[F.lit(x) for pair in KEYS.items() for x in pair])
    return rows.select("processing_task_id", "processing_routine_name", F.element_at(keys, role).alias("key"),
                       value.alias("value"))

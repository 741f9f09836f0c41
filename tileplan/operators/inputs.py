"""JON-01..19, 28, 39: questions about inputs, validations and their links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tileplan.catalogue import Catalogue
from tileplan.functions.scalars import day_to_date, iso_ms
from tileplan.session import moment

LOOK_BACK_DAYS = 90
GRD_DAYS = 7


def conditions_with_routine(cat: Catalogue) -> DataFrame:
    """JON-19: each condition with its routine and the routine's resources; two code tables, broadcast."""
    tc = F.broadcast(cat.triggering_condition)
    pr = F.broadcast(cat.processing_routine)
    return tc.join(pr, tc.processing_routine_name == pr.name).select(
        tc.name.alias("tc_name"), pr.name.alias("name"), "product_type_code", "cpu", "ram", "storage_space",
        "duration", "docker_image", "flavour")


def members(cat: Catalogue) -> DataFrame:
    """Links with the input they point at: (trigger_validation_id, raw_input_id, tile, measurement_day, type)."""
    ri = cat.raw_inputs.select(F.col("id").alias("raw_input_id"), "tile", "measurement_day", "product_type_code")
    return cat.raw2valid.join(ri, "raw_input_id")


def validated_links(cat: Catalogue, condition: str | None = None) -> DataFrame:
    """Links of the validations of one condition, or of all."""
    tv = cat.trigger_validation
    if condition is not None:
        tv = tv.filter(F.col("triggering_condition_name") == condition)
    return cat.raw2valid.join(tv.select(F.col("id").alias("trigger_validation_id"), "triggering_condition_name"),
                              "trigger_validation_id")


def inputs_by_type(cat: Catalogue, product_type: str) -> DataFrame:
    """JON-01: inputs of a type that some routine with a condition outputs; one row per condition."""
    rt = F.broadcast(cat.raster_type.select(F.col("product_type").alias("product_type_code")))
    routines = conditions_with_routine(cat).select("product_type_code", F.col("tc_name").alias("condition"))
    return (cat.raw_inputs.filter(F.col("product_type_code") == product_type)
            .join(rt, "product_type_code", "left_semi")
            .join(F.broadcast(routines), "product_type_code")
            .select(*cat.raw_inputs.columns, "condition"))


def inputs_without_task(cat: Catalogue) -> DataFrame:
    """JON-02: validated inputs with no task, one row per validation."""
    open_links = (validated_links(cat)
                  .join(cat.processing_tasks, F.col("trigger_validation_id") == F.col("trigger_validation_fk_id"),
                        "left_anti").select("trigger_validation_id", F.col("raw_input_id").alias("id")))
    return cat.raw_inputs.join(open_links, "id").select(*cat.raw_inputs.columns, "trigger_validation_id")


def new_products(products: DataFrame, ri: DataFrame) -> DataFrame:
    """JON-03: products that are not inputs yet, with their dates as ISO text."""
    return products.join(ri.select("id"), "id", "left_anti").select(
        "id", "product_type_code", "product_path", iso_ms("creation_date").alias("creation_date"),
        iso_ms("catalogue_date").alias("catalogue_date"), "kpi_file_path")


def unvalidated_inputs(cat: Catalogue, condition: str, types: list[str]) -> DataFrame:
    """JON-04: inputs of some types with no validation of a condition."""
    return not_validated(cat.raw_inputs.filter(F.col("product_type_code").isin(types)), cat, condition)


def not_validated(ri: DataFrame, cat: Catalogue, condition: str) -> DataFrame:
    """JON-07: the given inputs less those that a validation of the condition holds."""
    taken = validated_links(cat, condition).select(F.col("raw_input_id").alias("id"))
    return ri.join(taken, "id", "left_anti").select(*ri.columns)


def new_by_path(candidates: DataFrame, ri: DataFrame, min_day: int, product_type: str) -> DataFrame:
    """JON-05: candidates whose path no input of the type has since a day."""
    known = ri.filter((F.col("measurement_day") >= min_day) & (F.col("product_type_code") == product_type))
    return candidates.join(known.select("input_path"), "input_path", "left_anti").select(*candidates.columns)


def new_by_tile_start(candidates: DataFrame, ri: DataFrame, min_day: int, product_type: str) -> DataFrame:
    """JON-06: candidates whose tile and start time no input of the type has since a day."""
    known = ri.filter((F.col("measurement_day") >= min_day) & (F.col("product_type_code") == product_type))
    return (candidates.join(known.select("tile", "start_date"), ["tile", "start_date"], "left_anti")
            .select(*candidates.columns))


def same_tile_day(left: DataFrame, ri: DataFrame, product_type: str, since) -> DataFrame:
    """JON-08: for each left input, the inputs of a type on its tile and day, harvested since a date, less itself.

    The result is one row per partner, never a list, so a large group is split by the skew join.
    """
    right = ri.filter((F.col("product_type_code") == product_type) & (F.col("harvesting_date") >= since)).select(
        "tile", "measurement_day", F.col("id").alias("partner_id"))
    return (left.select("id", "tile", "measurement_day").join(right, ["tile", "measurement_day"])
            .filter(F.col("id") != F.col("partner_id")))


def latest_per_tile_day(ri: DataFrame, product_type: str, since=None) -> DataFrame:
    """The last harvested input of a type per tile and day; combined before the shuffle."""
    rows = ri.filter(F.col("product_type_code") == product_type)
    if since is not None:
        rows = rows.filter(F.col("harvesting_date") >= since)
    best = F.max(F.struct("harvesting_date", "id", "relative_orbit_number")).alias("best")
    return rows.groupBy("tile", "measurement_day").agg(best)


def latest_sig0(fsc: DataFrame, ri: DataFrame, since) -> DataFrame:
    """JON-09: for each FSC the last harvested backscatter on its tile and day.

    The right side has one row per tile and day, so the join cannot multiply rows.
    """
    best = latest_per_tile_day(ri, "S1_NRB_L2A", since)
    return (fsc.select("id", "tile", "measurement_day").join(best, ["tile", "measurement_day"])
            .select("id", "tile", "measurement_day", F.col("best.id").alias("sig0_id"),
                    F.col("best.relative_orbit_number").alias("relative_orbit_number")))


def _day_no(day: Column) -> Column:
    return F.date_diff(day_to_date(day), F.lit("1970-01-01").cast("date"))


def _look_back(left: DataFrame, right: DataFrame, best: Column, name: str) -> DataFrame:
    """The best right value per distinct left (tile, day) among right days in [day - 90, day].

    Both sides hold one row per tile and day. Each right day is put in the at most two bins of 91 days from
    which it can be seen, so the join key is (tile, bin) and no key pairs more than 91 with 182 rows,
    however many inputs a tile has.
    """
    width = LOOK_BACK_DAYS + 1
    days = left.select("tile", "measurement_day").distinct().withColumn("n", _day_no(F.col("measurement_day")))
    days = days.withColumn("bin", F.floor(F.col("n") / width))
    seen = right.withColumn("rn", _day_no(F.col("seen_day")))
    seen = seen.withColumn("bin", F.explode(F.array_distinct(F.array(
        F.floor(F.col("rn") / width), F.floor((F.col("rn") + LOOK_BACK_DAYS) / width)))))
    return (days.join(seen, ["tile", "bin"])
            .filter(F.col("rn").between(F.col("n") - LOOK_BACK_DAYS, F.col("n")))
            .groupBy("tile", "measurement_day").agg(best.alias(name)))


def _cc_days(cat: Catalogue, validations: DataFrame) -> DataFrame:
    """Distinct (tile, day) of the members of the given validations."""
    links = members(cat).join(validations, "trigger_validation_id", "left_semi")
    return links.select("tile", F.col("measurement_day").alias("seen_day")).distinct()


def _cc_validations(cat: Catalogue) -> DataFrame:
    return (cat.trigger_validation.filter(F.col("triggering_condition_name") == "CC_TC")
            .select(F.col("id").alias("trigger_validation_id")))


def _flagged(l1c: DataFrame, right: DataFrame, name: str) -> DataFrame:
    found = _look_back(l1c, right, F.lit(True), name)
    return (l1c.join(found, ["tile", "measurement_day"], "left")
            .withColumn(name, F.coalesce(name, F.lit(False))).select(*l1c.columns, name))


def previous_l2a_exists(l1c: DataFrame, cat: Catalogue) -> DataFrame:
    """JON-10: L1C with a flag: a cloud product with a task exists on the tile in the 90 days up to the day."""
    done = _cc_validations(cat)
    for table in (cat.processing_tasks, cat.products):
        done = done.join(table.select(F.col("trigger_validation_fk_id").alias("trigger_validation_id")),
                         "trigger_validation_id", "left_semi")
    return _flagged(l1c, _cc_days(cat, done), "previous_l2a")


def pending_cc_exists(l1c: DataFrame, cat: Catalogue) -> DataFrame:
    """JON-11: L1C with a flag: a cloud validation without task exists on the tile in the 90 days up to the day."""
    pending = _cc_validations(cat).join(
        cat.processing_tasks.select(F.col("trigger_validation_fk_id").alias("trigger_validation_id")),
        "trigger_validation_id", "left_anti")
    return _flagged(l1c, _cc_days(cat, pending), "pending_cc")


def latest_l2a(l1c: DataFrame, ri: DataFrame) -> DataFrame:
    """JON-12: for each L1C the most recent L2A on its tile in the 90 days up to the day, the day included.

    The L2A are first reduced to one per tile and day; the largest id wins within a day.
    """
    l2a = (ri.filter(F.col("product_type_code") == "S2_MAJA_L2A").groupBy("tile", F.col("measurement_day").alias("seen_day"))
           .agg(F.max("id").alias("l2a_id")))
    found = _look_back(l1c, l2a, F.max(F.struct("seen_day", "l2a_id")), "best")
    return (l1c.select("id", "tile", "measurement_day").join(found, ["tile", "measurement_day"])
            .select("id", "tile", "measurement_day", F.col("best.l2a_id").alias("l2a_id"),
                    F.col("best.seen_day").alias("l2a_day")))


def unprocessed_l1c(ri: DataFrame, r2v: DataFrame) -> DataFrame:
    """JON-13: L1C that no validation holds."""
    return (ri.filter(F.col("product_type_code") == "S2MSI1C")
            .join(r2v.select(F.col("raw_input_id").alias("id")), "id", "left_anti").select(*ri.columns))


def unprocessed_grd(ri: DataFrame, r2v: DataFrame, as_of) -> DataFrame:
    """JON-14: partial GRD harvested in the last seven days that no validation holds."""
    since = moment(as_of) - F.make_dt_interval(days=F.lit(GRD_DAYS))
    return (ri.filter((F.col("product_type_code") == "IW_GRDH_1S") & F.col("is_partial")
                      & (F.col("harvesting_date") >= since))
            .join(r2v.select(F.col("raw_input_id").alias("id")), "id", "left_anti").select(*ri.columns))


def task_today(cat: Catalogue, as_of) -> DataFrame:
    """JON-15: (condition, tile, day) of which a task was created since the start of the day of the clock."""
    today = F.date_trunc("day", moment(as_of)).cast("timestamp_ntz")
    fresh = cat.processing_tasks.filter(F.col("creation_date") >= today).select(
        F.col("trigger_validation_fk_id").alias("trigger_validation_id"))
    return (validated_links(cat).join(fresh, "trigger_validation_id", "left_semi")
            .join(cat.raw_inputs.select(F.col("id").alias("raw_input_id"), "tile", "measurement_day"), "raw_input_id")
            .select(F.col("triggering_condition_name").alias("condition"), "tile", "measurement_day").distinct())


def inputs_in_progress(cat: Catalogue, day: int, types: list[str], status_ids=(0, 2)) -> DataFrame:
    """JON-16: inputs of a day and some types whose unfinished task has a status of the given ids.

    One row per input, task and status row. The default ids are those of the reference, where 0 matches nothing.
    """
    ri = cat.raw_inputs.filter((F.col("measurement_day") == day) & F.col("product_type_code").isin(types))
    statuses = (cat.processing_status_workflow.filter(F.col("processing_status_id").isin(list(status_ids)))
                .select(F.col("nomad_job_dispatch_fk_id").alias("nomad_job_id"), F.col("id").alias("status_id")))
    tasks = cat.processing_tasks.filter(~F.col("has_ended")).select(
        F.col("id").alias("processing_task_id"), F.col("trigger_validation_fk_id").alias("trigger_validation_id"))
    return (ri.select(F.col("id").alias("raw_input_id"), "tile")
            .join(cat.raw2valid, "raw_input_id").join(tasks, "trigger_validation_id")
            .join(cat.processingtask2nomad, "processing_task_id").join(statuses, "nomad_job_id")
            .select(F.col("raw_input_id").alias("id"), "tile", "status_id"))


def members_without_task(r2v: DataFrame, pt: DataFrame) -> DataFrame:
    """JON-17: links of validations that have no task."""
    return r2v.join(pt, r2v.trigger_validation_id == pt.trigger_validation_fk_id, "left_anti")


def task_of_validation(pt: DataFrame, tv: DataFrame) -> DataFrame:
    """JON-18: the tasks of the given validations."""
    return pt.join(tv, pt.trigger_validation_fk_id == tv.id, "left_semi").select(
        F.col("id").alias("processing_task_id"), "trigger_validation_fk_id")


def validation_day(cat: Catalogue) -> DataFrame:
    """JON-28: condition and artificial day of each validation, per member input."""
    tv = cat.trigger_validation.select(F.col("id").alias("trigger_validation_id"), "triggering_condition_name",
                                       "artificial_measurement_day")
    return (cat.raw2valid.join(tv, "trigger_validation_id")
            .join(cat.raw_inputs.select(F.col("id").alias("raw_input_id")), "raw_input_id", "left_semi")
            .select("trigger_validation_id", "raw_input_id", "triggering_condition_name",
                    "artificial_measurement_day"))


def products_becoming_inputs(cat: Catalogue, consumed: DataFrame, since) -> DataFrame:
    """JON-39: products since a date of a type that some routine consumes, with the tile and day of their inputs.

    ``consumed`` names the input types of the conditions (``condition_inputs``).
    """
    wanted = (cat.products.filter(F.col("creation_date") >= moment(since))
              .join(consumed.select("product_type_code"), "product_type_code", "left_semi"))
    place = members(cat).select(F.col("trigger_validation_id").alias("trigger_validation_fk_id"), "tile",
                                "measurement_day")
    return (wanted.join(place, "trigger_validation_fk_id")
            .select("product_path", "creation_date", "tile", "measurement_day").distinct())

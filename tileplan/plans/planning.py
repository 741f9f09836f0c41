"""TSK: tasks from validations, harvest windows, recovery of lost work and the launch queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tileplan.catalogue import Catalogue
from tileplan.functions.scalars import date_to_day, day_to_date, harvest_dates, source_key
from tileplan.operators.filters import CUTOVER_DAY
from tileplan.operators.status import last_input
from tileplan.operators.tasks import archive_undispatched, lost_sets, oldest_archive_day
from tileplan.session import moment

# Fixed values.
LOST_CODE = 404
INTERNAL_ERROR = 4
MIN_DURATION = 7
NO_CALLBACK_SECONDS = 3600


def plan_tasks(r2v: DataFrame, tv: DataFrame, pt: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """TSK-01: one task per validation that has none, and the links that were rejected.

    The day of a gap-filled validation becomes the processing date of its task, other tasks have none. A link
    that lacks one of its ids is rejected. The validations are the left side, so they are distinct already.
    """
    complete = F.col("trigger_validation_id").isNotNull() & F.col("raw_input_id").isNotNull()
    linked = r2v.filter(complete).select(F.col("trigger_validation_id").alias("id"))
    gap_filled = F.col("triggering_condition_name") == "GFSC_TC"
    tasks = (tv.join(linked, "id", "left_semi")
             .join(pt.select(F.col("trigger_validation_fk_id").alias("id")), "id", "left_anti")
             .select(F.col("id").alias("trigger_validation_fk_id"), moment(as_of).alias("creation_date"),
                     F.when(gap_filled, F.col("artificial_measurement_day")).alias("processing_date"),
                     F.lit(False).alias("has_ended")))
    return tasks, r2v.filter(~complete)


def harvest_windows(params: DataFrame, mode: str, as_of) -> DataFrame:
    """TSK-02: one window [day, day + 1] per source and day from its start date to the closing day.

    The closing day is today in ``NRT`` mode and the source's end date in ``ARCHIVE`` mode.
    """
    dates = harvest_dates(params, mode)
    closing = F.to_date(moment(as_of)) if mode.upper() == "NRT" else F.col("end_date")
    return (dates.withColumn("closing", closing).filter(F.col("start_date") <= F.col("closing"))
            .withColumn("window_start", F.explode(F.sequence("start_date", "closing")))
            .select("source", "window_start", F.date_add("window_start", 1).alias("window_end")))


def nrt_window(params: DataFrame, ri: DataFrame, as_of) -> DataFrame:
    """TSK-03: the window a running harvest asks for, per source.

    It begins at the last publishing date of the type, or, for a source with a timeliness and a type without
    inputs, at the allowed age; it never begins before that.
    """
    now = moment(as_of)
    days = lambda c: F.make_dt_interval(days=F.col(c).cast("int"))
    last = last_input(ri).select(F.col("product_type_code").alias("input_type"), "last_publishing_date")
    floor = now - days("max_day_since_publication_date")
    return (last.join(params, "input_type", "right")
            .withColumn("known", F.when(F.coalesce("timeliness", F.lit("")) == "", F.col("last_publishing_date")))
            .select(source_key().alias("source"), "input_type",
                    (now - days("max_day_since_measurement_date")).alias("min_measurement_date"),
                    F.greatest(floor, F.coalesce("known", floor)).alias("min_publication_date"),
                    now.alias("max_publication_date")))


def lost_limit() -> Column:
    """Seconds after which a dispatch without exit code counts as lost: three nominal durations of 7 minutes or more."""
    return 3 * 60 * F.greatest(F.lit(MIN_DURATION), F.col("duration"))


def is_lost() -> Column:
    """Whether a dispatch in one of the lost sets is to be put in error, by its age; an unknown or zero age is lost."""
    age = F.col("age")
    unknown = age.isNull() | (age == 0)
    return unknown | F.when(F.col("no_exit_code"), age > lost_limit()).otherwise(age > NO_CALLBACK_SECONDS)


def lost_tasks(cat: Catalogue, ages: DataFrame, flavour: str, as_of, day: int = CUTOVER_DAY) -> DataFrame:
    """TSK-04: status rows that put the lost dispatches of a flavour in error.

    ``ages`` has nomad_job_id and age in seconds as the cluster reports it.
    """
    return (lost_sets(cat, flavour, day).join(ages, "nomad_job_id", "left").filter(is_lost())
            .select(F.col("nomad_job_id").alias("nomad_job_dispatch_fk_id"),
                    F.lit(INTERNAL_ERROR).alias("processing_status_id"), moment(as_of).alias("date"),
                    F.lit(LOST_CODE).alias("exit_code")))


def archive_batch(cat: Catalogue, flavour: str, tiles: DataFrame, params: DataFrame,
                  before: int = CUTOVER_DAY) -> DataFrame:
    """TSK-05: archive tasks from the oldest open day to one interval later, but before the cut-over.

    ``params`` is the one row of ``run_params``. The two days are computed first, from the open tasks only, and are
    literals for the scan of the inputs.
    """
    start = oldest_archive_day(cat, flavour, tiles, before).crossJoin(F.broadcast(params))
    shifted = F.date_add(F.add_months(day_to_date("oldest_day"), F.col("interval_months")), F.col("interval_days"))
    last_open = date_to_day(F.date_sub(day_to_date(F.lit(before)), 1))
    span = start.select("oldest_day", F.least(date_to_day(shifted), last_open).alias("closing_day")).first()
    if span is None or span.oldest_day is None:
        return archive_undispatched(cat, flavour, tiles, 0, 0).limit(0)
    return archive_undispatched(cat, flavour, tiles, span.oldest_day, span.closing_day)


def launch_queue(pending: DataFrame, queued: DataFrame, deployed: DataFrame) -> DataFrame:
    """TSK-06: pending tasks, once each, that are neither queued nor deployed."""
    return (pending.dropDuplicates(["id"]).join(queued.select("id"), "id", "left_anti")
            .join(deployed.select("id"), "id", "left_anti").select(*pending.columns))

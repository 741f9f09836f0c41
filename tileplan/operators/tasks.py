"""JON-20..30 and AGG-07..11: selections of tasks by dispatch, status, flavour and day.

A task is looked at through its validation and the inputs bound to it. Where only the existence of a member
or a status matters the joins are semi or anti joins, so a task appears once and no row is multiplied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tileplan.catalogue import Catalogue
from tileplan.operators.filters import CUTOVER_DAY
from tileplan.operators.inputs import conditions_with_routine, members
from tileplan.session import moment

ERROR_STATUSES = [4, 5]


def task_inputs(cat: Catalogue) -> DataFrame:
    """Every task with its validation, each member input and the routine of its condition."""
    pt = cat.processing_tasks.select(
        F.col("id").alias("task_id"), F.col("trigger_validation_fk_id").alias("trigger_validation_id"),
        "creation_date", "processing_date", "preceding_input_id", "has_ended", "intermediate_files_path")
    tv = cat.trigger_validation.select(F.col("id").alias("trigger_validation_id"), "triggering_condition_name", "is_nrt")
    routine = F.broadcast(conditions_with_routine(cat)).drop("product_type_code")
    links = members(cat).withColumnRenamed("product_type_code", "input_type")
    return (pt.join(tv, "trigger_validation_id").join(links, "trigger_validation_id")
            .join(routine, F.col("triggering_condition_name") == F.col("tc_name")).drop("tc_name"))


def tasks_since(cat: Catalogue, flavour: str, day: int) -> DataFrame:
    """Tasks of a flavour with a member measured since a day, one row each."""
    pt = cat.processing_tasks
    routine = (conditions_with_routine(cat).filter(F.col("flavour") == flavour)
               .select(F.col("tc_name").alias("triggering_condition_name"), "flavour", "duration"))
    tv = (cat.trigger_validation.join(F.broadcast(routine), "triggering_condition_name")
          .select(F.col("id").alias("trigger_validation_fk_id"), "flavour", "duration"))
    recent = (members(cat).filter(F.col("measurement_day") >= day)
              .select(F.col("trigger_validation_id").alias("trigger_validation_fk_id")))
    return (pt.join(tv, "trigger_validation_fk_id").join(recent, "trigger_validation_fk_id", "left_semi")
            .select(*pt.columns, "flavour", "duration"))


def undispatched(cat: Catalogue, flavour: str, day: int = CUTOVER_DAY) -> DataFrame:
    """JON-20: tasks of a flavour since the cut-over day without a dispatch."""
    return (tasks_since(cat, flavour, day)
            .join(cat.processingtask2nomad, F.col("id") == F.col("processing_task_id"), "left_anti")
            .drop("duration"))


def _with_dispatch(tasks: DataFrame, cat: Catalogue) -> DataFrame:
    runs = cat.processingtask2nomad.join(
        cat.nomad_job_dispatch.select(F.col("id").alias("nomad_job_id"), "dispatch_date"), "nomad_job_id")
    return tasks.join(runs, F.col("id") == F.col("processing_task_id")).drop("processing_task_id")


def _status_of_run(cat: Catalogue) -> DataFrame:
    return cat.processing_status_workflow.select(
        F.col("nomad_job_dispatch_fk_id").alias("nomad_job_id"), "processing_status_id", "exit_code")


def in_error(cat: Catalogue, flavour: str, day: int = CUTOVER_DAY) -> DataFrame:
    """JON-21: unfinished tasks of a flavour with any error status."""
    failed = (cat.processingtask2nomad
              .join(_status_of_run(cat).filter(F.col("processing_status_id").isin(ERROR_STATUSES)), "nomad_job_id",
                    "left_semi"))
    return (tasks_since(cat, flavour, day).filter(~F.col("has_ended"))
            .join(failed, F.col("id") == F.col("processing_task_id"), "left_semi").drop("duration"))


def unfinished(cat: Catalogue, flavour: str, day: int = CUTOVER_DAY) -> DataFrame:
    """JON-22: unfinished dispatched tasks with their dispatch and nominal duration, one row per dispatch."""
    return _with_dispatch(tasks_since(cat, flavour, day).filter(~F.col("has_ended")), cat)


def unfinished_with_callback(cat: Catalogue, flavour: str, day: int = CUTOVER_DAY) -> DataFrame:
    """JON-23: the unfinished dispatches that have any status."""
    return unfinished(cat, flavour, day).join(_status_of_run(cat), "nomad_job_id", "left_semi")


def unfinished_with_exit_code(cat: Catalogue, flavour: str, day: int = CUTOVER_DAY) -> DataFrame:
    """JON-24: the unfinished dispatches that have an exit code. The flavour asked for is the one used."""
    ended = _status_of_run(cat).filter(F.col("exit_code").isNotNull())
    return unfinished(cat, flavour, day).join(ended, "nomad_job_id", "left_semi")


def _archive_links(cat: Catalogue, flavour: str, tiles: DataFrame) -> DataFrame:
    """Members on the given tiles whose own type is the output of a routine of the flavour.

    The routine is looked up by the input's type, so images (L1C, GRD), which no routine outputs, drop out.
    """
    types = (cat.processing_routine.filter(F.col("flavour") == flavour).select("product_type_code", "flavour"))
    return (members(cat).join(F.broadcast(types), "product_type_code")
            .join(tiles.select("tile"), "tile", "left_semi")
            .select(F.col("trigger_validation_id").alias("trigger_validation_fk_id"), "measurement_day", "flavour"))


def _undispatched_tasks(cat: Catalogue) -> DataFrame:
    return cat.processing_tasks.join(cat.processingtask2nomad, F.col("id") == F.col("processing_task_id"), "left_anti")


def archive_undispatched(cat: Catalogue, flavour: str, tiles: DataFrame, first_day: int, last_day: int) -> DataFrame:
    """JON-25: undispatched archive tasks of a flavour, on some tiles, in a range of days; one row each."""
    links = _archive_links(cat, flavour, tiles).filter(F.col("measurement_day").between(first_day, last_day))
    return _tasks_of_links(cat, links, flavour)


def _tasks_of_links(cat: Catalogue, links: DataFrame, flavour: str) -> DataFrame:
    return (_undispatched_tasks(cat).join(links.select("trigger_validation_fk_id"), "trigger_validation_fk_id", "left_semi")
            .select(*cat.processing_tasks.columns, F.lit(flavour).alias("flavour")))


def oldest_archive_day(cat: Catalogue, flavour: str, tiles: DataFrame, before: int = CUTOVER_DAY) -> DataFrame:
    """AGG-11: oldest day among the undispatched archive tasks; one row, null if there are none."""
    archive = cat.trigger_validation.filter(~F.col("is_nrt")).select(F.col("id").alias("trigger_validation_fk_id"))
    tasks = (_undispatched_tasks(cat).select("trigger_validation_fk_id")
             .join(archive, "trigger_validation_fk_id", "left_semi"))
    return (_archive_links(cat, flavour, tiles).filter(F.col("measurement_day") < before)
            .join(tasks, "trigger_validation_fk_id", "left_semi")
            .agg(F.min("measurement_day").alias("oldest_day")))


def run_info(cat: Catalogue) -> DataFrame:
    """JON-26: what a launch needs to know of a task, one row per distinct member input."""
    pt = cat.processing_tasks.select(
        F.col("id").alias("processing_task_id"), F.col("trigger_validation_fk_id").alias("trigger_validation_id"),
        "preceding_input_id", "intermediate_files_path", "processing_date")
    tv = cat.trigger_validation.select(F.col("id").alias("trigger_validation_id"), "triggering_condition_name")
    ri = cat.raw_inputs.select(F.col("id").alias("raw_input_id"), "tile", "measurement_day", "harvesting_date",
                               "relative_orbit_number", "input_path")
    routine = F.broadcast(conditions_with_routine(cat).select(
        F.col("tc_name").alias("triggering_condition_name"), F.col("name").alias("processing_routine_name"),
        "product_type_code", "ram", "docker_image", "duration", "flavour"))
    return (pt.join(tv, "trigger_validation_id").join(cat.raw2valid.distinct(), "trigger_validation_id")
            .join(ri, "raw_input_id").join(routine, "triggering_condition_name").drop("triggering_condition_name"))


def currently_deployed(cat: Catalogue) -> DataFrame:
    """JON-27: ids of tasks not ended with a dispatch that has no exit code."""
    ended = _status_of_run(cat).filter(F.col("exit_code").isNotNull())
    running = cat.processingtask2nomad.join(ended, "nomad_job_id", "left_anti")
    return (cat.processing_tasks.filter(~F.col("has_ended"))
            .join(running, F.col("id") == F.col("processing_task_id"), "left_semi").select("id"))


def task_with_flavour(pt: DataFrame, cat: Catalogue) -> DataFrame:
    """JON-29: tasks with the flavour of their routine, found through their validation."""
    routine = conditions_with_routine(cat).select(F.col("tc_name").alias("triggering_condition_name"), "flavour")
    tv = cat.trigger_validation.join(F.broadcast(routine), "triggering_condition_name").select(
        F.col("id").alias("trigger_validation_fk_id"), "flavour")
    return pt.join(tv, "trigger_validation_fk_id", "left").select(*pt.columns, "flavour")


def task_of_error(psw: DataFrame, cat: Catalogue) -> DataFrame:
    """JON-30: the task row behind each error status."""
    failed = psw.filter(F.col("processing_status_id").isin(ERROR_STATUSES)).select(
        F.col("id").alias("status_id"), F.col("nomad_job_dispatch_fk_id").alias("nomad_job_id"))
    runs = (cat.processingtask2nomad
            .join(cat.nomad_job_dispatch.select(F.col("id").alias("nomad_job_id")), "nomad_job_id", "left_semi")
            .select("nomad_job_id", F.col("processing_task_id").alias("id")))
    return failed.join(runs, "nomad_job_id").join(cat.processing_tasks, "id").select(
        "status_id", *cat.processing_tasks.columns)


def unprocessed_task_count(cat: Catalogue, since) -> DataFrame:
    """AGG-07: number of tasks created since a date that have a member input none of whose tasks is processed."""
    from tileplan.operators.status import input_task_summary

    open_inputs = input_task_summary(cat).filter(~F.col("any_processed")).select("raw_input_id")
    links = cat.raw2valid.join(open_inputs, "raw_input_id", "left_semi")
    recent = cat.processing_tasks.filter(F.col("creation_date") > moment(since))
    return (recent.join(links, F.col("trigger_validation_fk_id") == F.col("trigger_validation_id"), "left_semi")
            .agg(F.count("*").alias("n_tasks")))


def _cc_tasks(cat: Catalogue, tasks: DataFrame, since_day: int) -> DataFrame:
    """(tile, task id) of the members, measured after a day, of the given cloud tasks."""
    cc = (cat.trigger_validation.filter(F.col("triggering_condition_name") == "CC_TC")
          .select(F.col("id").alias("trigger_validation_id")))
    tasks = tasks.select(F.col("id").alias("task_id"), F.col("trigger_validation_fk_id").alias("trigger_validation_id"))
    return (members(cat).filter(F.col("measurement_day") > since_day)
            .join(tasks.join(cc, "trigger_validation_id", "left_semi"), "trigger_validation_id")
            .select("tile", "task_id"))


def cc_unfinished_tiles(cat: Catalogue, since_day: int) -> DataFrame:
    """AGG-08: tiles with an unfinished cloud task that returned an exit code, measured after a day."""
    ended = cat.processingtask2nomad.join(_status_of_run(cat).filter(F.col("exit_code").isNotNull()), "nomad_job_id",
                                          "left_semi")
    tasks = cat.processing_tasks.filter(~F.col("has_ended")).join(
        ended, F.col("id") == F.col("processing_task_id"), "left_semi")
    return _cc_tasks(cat, tasks, since_day).select("tile").distinct()


def cc_undispatched_tiles(cat: Catalogue, since_day: int) -> DataFrame:
    """AGG-09: tiles with undispatched cloud tasks measured after a day, with their number of member rows."""
    return _cc_tasks(cat, _undispatched_tasks(cat), since_day).groupBy("tile").agg(F.count("*").alias("n_rows"))


def cc_uncreated_tiles(cat: Catalogue, since_day: int) -> DataFrame:
    """AGG-10: tiles with cloud validations that lack a task, with their number of member rows."""
    lacking = (cat.trigger_validation.filter(F.col("triggering_condition_name") == "CC_TC")
               .join(cat.processing_tasks.select("trigger_validation_fk_id"),
                     F.col("id") == F.col("trigger_validation_fk_id"), "left_anti")
               .select(F.col("id").alias("trigger_validation_id")))
    return (members(cat).filter(F.col("measurement_day") > since_day)
            .join(lacking, "trigger_validation_id", "left_semi").groupBy("tile").agg(F.count("*").alias("n_rows")))


def lost_sets(cat: Catalogue, flavour: str, day: int = CUTOVER_DAY) -> DataFrame:
    """SET-02, SET-03: unfinished dispatches with flags for the two ways of being lost.

    ``no_callback`` means no status at all, ``no_exit_code`` no status with an exit code. Both differences and
    their union come from one pass over the statuses, reduced to one row per dispatch before the join.
    """
    seen = _status_of_run(cat).groupBy("nomad_job_id").agg(F.max(F.col("exit_code").isNotNull()).alias("has_code"))
    return (unfinished(cat, flavour, day).join(seen, "nomad_job_id", "left")
            .withColumn("no_callback", F.col("has_code").isNull())
            .withColumn("no_exit_code", ~F.coalesce("has_code", F.lit(False)))
            .filter(F.col("no_callback") | F.col("no_exit_code")).drop("has_code"))

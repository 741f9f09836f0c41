"""AGG, WIN and JON-31..38: progress of tasks, dispatches and publications.

Latest rows are ``max`` over a struct whose first fields are the order; it is combined before the shuffle, so a
dispatch, task or product with very many rows sends one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tileplan.catalogue import Catalogue
from tileplan.operators.tasks import ERROR_STATUSES
from tileplan.session import moment

PROCESSED = 2
CLOSED_STATUSES = [2, 6]
RETRY_CODES = [109, 404]


def _statuses(cat: Catalogue) -> DataFrame:
    """Status rows with the task their dispatch belongs to."""
    psw = cat.processing_status_workflow.withColumnRenamed("nomad_job_dispatch_fk_id", "nomad_job_id")
    return psw.join(cat.processingtask2nomad, "nomad_job_id")


def error_count(cat: Catalogue) -> DataFrame:
    """AGG-01: number of error statuses of every task, 0 for none."""
    errors = (_statuses(cat).filter(F.col("processing_status_id").isin(ERROR_STATUSES))
              .groupBy("processing_task_id").agg(F.count("*").alias("n")))
    return (cat.processing_tasks.join(errors, F.col("id") == F.col("processing_task_id"), "left")
            .select("id", F.coalesce("n", F.lit(0)).alias("error_count")))


def retry_error_count(cat: Catalogue) -> DataFrame:
    """AGG-02: errors that count towards giving up, per task that has any; no exit code is not counted."""
    counted = F.col("processing_status_id").isin(ERROR_STATUSES) & ~F.col("exit_code").isin(RETRY_CODES)
    return (_statuses(cat).filter(counted).groupBy("processing_task_id")
            .agg(F.count("*").alias("number_of_error_by_pt")))


def processed_tasks(cat: Catalogue) -> DataFrame:
    """Ids of the tasks with a processed status."""
    done = cat.processing_status_workflow.filter(F.col("processing_status_id") == PROCESSED)
    return (cat.processingtask2nomad
            .join(done, F.col("nomad_job_id") == F.col("nomad_job_dispatch_fk_id"), "left_semi")
            .select(F.col("processing_task_id").alias("id")).distinct())


def processed_flag(cat: Catalogue) -> DataFrame:
    """JON-33: every task with a flag: was it processed?"""
    done = processed_tasks(cat).withColumn("done", F.lit(True))
    return (cat.processing_tasks.select("id", "trigger_validation_fk_id", "has_ended", "creation_date")
            .join(done, "id", "left")
            .select("id", "trigger_validation_fk_id", "has_ended", "creation_date",
                    F.coalesce("done", F.lit(False)).alias("is_processed")))


def all_processed(tasks: DataFrame, by: str) -> DataFrame:
    """AGG-03: whether all tasks of a worker were processed; ``tasks`` has a flag ``is_processed``."""
    return tasks.groupBy(by).agg(F.bool_and("is_processed").alias("all_processed"))


def input_task_summary(cat: Catalogue, since=None) -> DataFrame:
    """Per member input: any task processed, any unfinished, any ended one created since a date. One aggregation."""
    tasks = processed_flag(cat)
    recent = F.lit(True) if since is None else F.col("creation_date") > moment(since)
    ended = F.coalesce("has_ended", F.lit(False))
    return (cat.raw2valid.join(tasks, F.col("trigger_validation_id") == F.col("trigger_validation_fk_id"))
            .groupBy("raw_input_id").agg(
                F.bool_or("is_processed").alias("any_processed"),
                F.bool_or(F.coalesce(~F.col("has_ended"), F.lit(False))).alias("any_unfinished"),
                F.bool_or(ended & recent).alias("any_recent_ended")))


def any_processed_by_input(cat: Catalogue) -> DataFrame:
    """AGG-04: per input with a task: was at least one processed?"""
    return input_task_summary(cat).select("raw_input_id", "any_processed")


def all_ended_by_input(cat: Catalogue) -> DataFrame:
    """AGG-05: per input: have all its tasks ended? False for an input without task."""
    known = input_task_summary(cat).select(F.col("raw_input_id").alias("id"), "any_unfinished")
    return (cat.raw_inputs.select("id").join(known, "id", "left")
            .select("id", F.coalesce(~F.col("any_unfinished"), F.lit(False)).alias("all_ended")))


def inputs_to_replan(cat: Catalogue, since) -> DataFrame:
    """AGG-06: inputs with a task ended and created since a date, all tasks ended and none processed."""
    return (input_task_summary(cat, since)
            .filter(F.col("any_recent_ended") & ~F.col("any_processed") & ~F.col("any_unfinished"))
            .select("raw_input_id"))


def latest_status(psw: DataFrame) -> DataFrame:
    """WIN-01: last status of every dispatch, by date and then id."""
    last = F.max(F.struct("date", "id", "processing_status_id", "exit_code")).alias("last")
    return psw.groupBy("nomad_job_dispatch_fk_id").agg(last).select(
        "nomad_job_dispatch_fk_id", F.col("last.processing_status_id").alias("processing_status_id"),
        F.col("last.date").alias("date"), F.col("last.exit_code").alias("exit_code"))


def _dated_dispatches(cat: Catalogue) -> DataFrame:
    """Dispatches of tasks with the two dates they are ordered by; the dispatch date is often not filled."""
    last = (cat.processing_status_workflow.groupBy(F.col("nomad_job_dispatch_fk_id").alias("id"))
            .agg(F.max("date").alias("last_status")))
    return (cat.processingtask2nomad.join(cat.nomad_job_dispatch, F.col("nomad_job_id") == F.col("id"))
            .join(last, "id", "left"))


def current_dispatch(cat: Catalogue) -> DataFrame:
    """WIN-02: the current dispatch of every task: by dispatch date, then last status date, then id."""
    last = F.max(F.struct("dispatch_date", "last_status", "id", "log_path")).alias("last")
    return _dated_dispatches(cat).groupBy("processing_task_id").agg(last).select(
        "processing_task_id", F.col("last.id").alias("nomad_job_id"), F.col("last.dispatch_date").alias("dispatch_date"))


def dispatches(cat: Catalogue) -> DataFrame:
    """JON-32: all dispatches of every task."""
    return (cat.processingtask2nomad.join(cat.nomad_job_dispatch, F.col("nomad_job_id") == F.col("id"))
            .select("processing_task_id", "nomad_job_id", "nomad_job_dispatch",
                    F.col("dispatch_date").alias("nomad_job_dispatch_creation_date"),
                    F.col("log_path").alias("nomad_job_dispatch_log_file_path")))


def status_history(cat: Catalogue) -> DataFrame:
    """JON-31: the statuses of every task with their code and name."""
    names = F.broadcast(cat.processing_status.select(
        F.col("id").alias("processing_status_id"), F.col("code").alias("processing_status_code"),
        F.col("name").alias("processing_status_name")))
    return _statuses(cat).join(names, "processing_status_id").select(
        "processing_task_id", "id", F.col("date").alias("processing_status_date"), "processing_status_code",
        "processing_status_name", F.col("message").alias("processing_status_message"))


def preceding_task(cat: Catalogue) -> DataFrame:
    """JON-34: for every task the tasks of the input it waits for."""
    tasks = cat.processing_tasks.filter(F.col("preceding_input_id").isNotNull()).select(
        "id", F.col("preceding_input_id").alias("raw_input_id"))
    earlier = cat.processing_tasks.select(F.col("id").alias("preceding_task_id"),
                                          F.col("trigger_validation_fk_id").alias("trigger_validation_id"))
    return (tasks.join(cat.raw2valid, "raw_input_id").join(earlier, "trigger_validation_id")
            .select("id", "preceding_task_id"))


def preceding_processed(cat: Catalogue) -> DataFrame:
    """JON-35: for every task with a preceding task: was one of those processed?

    The tasks are summed up per input first, so no pair of tasks is formed.
    """
    before = input_task_summary(cat).select(F.col("raw_input_id").alias("preceding_input_id"),
                                            F.col("any_processed").alias("preceding_processed"))
    return (cat.processing_tasks.select("id", "preceding_input_id").join(before, "preceding_input_id")
            .select("id", "preceding_processed"))


def ready_to_launch(cat: Catalogue) -> DataFrame:
    """JON-36, SET-01: tasks without dispatch whose predecessor is absent or processed."""
    waiting = (cat.processing_tasks.select("id", "preceding_input_id")
               .join(cat.processingtask2nomad, F.col("id") == F.col("processing_task_id"), "left_anti"))
    freed = preceding_processed(cat).filter("preceding_processed").select("id")
    free = waiting.filter(F.col("preceding_input_id").isNull()).select("id")
    return free.union(waiting.select("id").join(freed, "id", "left_semi")).distinct()


def indexed_flag(products: DataFrame, iw: DataFrame) -> DataFrame:
    """JON-37: every product with a flag: was it indexed?"""
    done = iw.filter(F.col("indexation_date").isNotNull()).select(F.col("product_fk_id").alias("id")).distinct()
    return (products.select("id").join(done.withColumn("done", F.lit(True)), "id", "left")
            .select("id", F.coalesce("done", F.lit(False)).alias("is_indexed")))


def index_failed(products: DataFrame, iw: DataFrame) -> DataFrame:
    """WIN-04: every product with a flag: did its latest attempt, by id, fail?"""
    last = iw.groupBy(F.col("product_fk_id").alias("pid")).agg(F.max(F.struct("id", "failure_date")).alias("last"))
    return (products.select("id").join(last, F.col("id") == F.col("pid"), "left")
            .select("id", F.col("last.failure_date").isNotNull().alias("is_failed")))


def index_file(cat: Catalogue, type_name: str) -> DataFrame:
    """JON-38: path of the index file of a type, per product."""
    kinds = F.broadcast(cat.indexation_file_type.filter(F.col("name") == type_name)
                        .select(F.col("id").alias("indexation_file_type_id")))
    return (cat.indexation_json.join(kinds, "indexation_file_type_id", "left_semi")
            .join(cat.products.select(F.col("id").alias("product_fk_id")), "product_fk_id", "left_semi")
            .select(F.col("product_fk_id").alias("product_id"), "path"))


def not_successful(cat: Catalogue, conditions: list[str]) -> DataFrame:
    """AGG-14: per day the number of unsuccessful pieces of work of some conditions.

    Counted are the member rows of unfinished tasks without dispatch, and the dispatches of unfinished tasks
    whose latest status is neither processed nor terminated. All days come from one pass.
    """
    from tileplan.operators.inputs import members

    tv = (cat.trigger_validation.filter(F.col("triggering_condition_name").isin(conditions))
          .select(F.col("id").alias("trigger_validation_id")))
    tasks = (cat.processing_tasks.filter(~F.col("has_ended"))
             .select(F.col("id").alias("processing_task_id"),
                     F.col("trigger_validation_fk_id").alias("trigger_validation_id"))
             .join(tv, "trigger_validation_id", "left_semi"))
    rows = (members(cat).select("trigger_validation_id", "measurement_day").join(tasks, "trigger_validation_id")
            .join(cat.processingtask2nomad, "processing_task_id", "left")
            .groupBy("measurement_day", "nomad_job_id").agg(F.count("*").alias("n")))
    open_runs = (latest_status(cat.processing_status_workflow)
                 .filter(~F.col("processing_status_id").isin(CLOSED_STATUSES))
                 .select(F.col("nomad_job_dispatch_fk_id").alias("nomad_job_id"), F.lit(1).alias("is_open")))
    none = F.col("nomad_job_id").isNull()
    return (rows.join(open_runs, "nomad_job_id", "left").groupBy("measurement_day").agg(
        (F.sum(F.when(none, F.col("n")).otherwise(0)) + F.count("is_open")).alias("total")))


def routine_types(pr: DataFrame) -> DataFrame:
    """AGG-15: distinct product types of the routines."""
    return pr.select("product_type_code").distinct()


def last_input(ri: DataFrame) -> DataFrame:
    """WIN-03: last start date per type, and the publishing date of that latest start."""
    last = F.max(F.struct("start_date", "id", "publishing_date")).alias("last")
    return ri.groupBy("product_type_code").agg(last).select(
        "product_type_code", F.col("last.start_date").alias("last_start_date"),
        F.col("last.publishing_date").alias("last_publishing_date"))


def wic_pairs(ri: DataFrame) -> DataFrame:
    """AGG-12: every WICS1 with all WICS2 of its tile and day, one row per partner.

    Rows instead of an array per WICS1: a crowded tile and day is spread over tasks by the skew join, and no
    list has to fit in one row.
    """
    side = lambda kind, name: ri.filter(F.col("product_type_code") == kind).select(
        "tile", "measurement_day", F.col("id").alias(name))
    return side("S1_WICS1_L2B", "id_wics1").join(side("S2_WICS2_L2B", "wics2_id"), ["tile", "measurement_day"])


def ordered(df: DataFrame, *order: Column) -> DataFrame:
    """WIN-07: the rows in an order, e.g. ``newest_first()``; a range-partitioned sort."""
    return df.orderBy(*order)


def newest_first() -> list[Column]:
    return [F.col("harvesting_date").desc(), F.col("id")]


def oldest_day_first() -> list[Column]:
    return [F.col("measurement_day"), F.col("id")]

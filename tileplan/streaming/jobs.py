"""STR-07, 08, 11, 13, 14: continuous jobs. Each micro-batch is one batch plan of the library.

The rows of a micro-batch, of all the tables that a job writes, are published by one commit of the job's log, see
``sources/tablelog.py``. A batch that is repeated after a failure finds its commit and does nothing, or finds none and
writes its folders anew, so it gives the same rows with the same ids and a crash between two writes shows neither.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tileplan.catalogue import Catalogue
from tileplan.functions.names import products_to_inputs, refused_products
from tileplan.operators.filters import CUTOVER_DAY, eligible_products
from tileplan.plans.gapfill import set_index, trg_gfsc
from tileplan.plans.planning import lost_tasks, plan_tasks
from tileplan.plans.triggers import (
    COLUMNS, Rules, materialise, shared_links, shared_wics1s2, trg_cc, trg_sig0_orphans, trg_sig0_pairs, trigger_all,
)
from tileplan.schemas import SCHEMAS, struct
from tileplan.session import moment, shared_dir, written
from tileplan.sources.sinks import append_tasks, insert_ignore, numbered, set_last_day
from tileplan.sources.tablelog import SEED, TableLog  # noqa: F401
from tileplan.streaming.queue import run_queue  # noqa: F401
from tileplan.streaming.running import start

#: Which job's log a table belongs to; others have one of their own.
LOGS = {"raw_inputs": "ingest", "rejects": "ingest", "trigger_validation": "triggers", "raw2valid": "triggers",
        "triggerer_config": "triggers", "orphans": "triggers", "set_index": "triggers", "pass_runs": "triggers", "processing_tasks": "planner",
        "processing_status_workflow": "recovery", "recovery_runs": "recovery"}
JOB_SCHEMAS = {**SCHEMAS,
               "rejects": StructType([*SCHEMAS["products"].fields, StructField("reason", StringType())]),
               "orphans": struct("tile STRING, measurement_day BIGINT"),
               "pass_runs": struct("pass STRING, last_run TIMESTAMP_NTZ"),
               "recovery_runs": struct("pass STRING, last_run TIMESTAMP_NTZ")}


def log_of(spark: SparkSession, root: str, table: str) -> TableLog:
    return TableLog(spark, root, LOGS.get(table, table), JOB_SCHEMAS)


class BatchTable:
    """One table of a job's log; the rows that were there before are batch -1."""

    def __init__(self, spark: SparkSession, root: str, table: str):
        self.table, self.log = table, log_of(spark, root, table)

    def write(self, df: DataFrame, batch: int) -> None:
        self.log.commit(batch, {self.table: df})

    def rows(self) -> DataFrame:
        return self.log.rows(self.table)


def run_available(stream: DataFrame, label: str, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Everything a stream gives now, written to files in the shared folder and read back (STR-13).

    With the same path and checkpoint a second run adds what is new since, after a crash as well as after a stop.
    """
    spark = stream.sparkSession
    path = path or shared_dir(spark, label)
    (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint or f"{path}-checkpoint")
     .trigger(availableNow=True).start(path).awaitTermination())
    return spark.read.schema(stream.schema).parquet(path)


def run_ingest(products: DataFrame, root: str, checkpoint: str, as_of, every: str | None = None):
    """STR-07: products into the input table below ``root``, each id once.

    Products that cannot become inputs go to the table ``rejects`` with a reason: ``no id``, or ``name`` for an
    unknown type or a name without its fields. A product whose id is there already is no reject. Types that no routine
    reads are not meant for the table and are left out.
    """
    spark, log = products.sparkSession, log_of(products.sparkSession, root, "raw_inputs")

    def work(batch: DataFrame, n: int) -> None:
        if log.has(n, "raw_inputs"):
            return
        offered = eligible_products(batch)
        rows = products_to_inputs(offered, moment(as_of))
        log.commit(n, {"raw_inputs": insert_ignore(log.rows("raw_inputs"), rows, "id"),
                       "rejects": _as_rejects(refused_products(offered))})

    return start(products, work, checkpoint, every)


def _as_rejects(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in JOB_SCHEMAS["rejects"]])


# Seconds between two passes.
PERIODS = {"grd": 300, "l1c": 300, "gfsc": 6 * 3600, "wics1s2": 600}
RECOVERY_PERIODS = {"lost": 600}
GAP_FILLED = "GFSC_L2C"


def clock(spark: SparkSession, every_seconds: int = 1) -> DataFrame:
    """STR-14: a stream of one time a second or so, whether any input comes or not."""
    return spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option(
        "advanceMillisPerBatch", every_seconds * 1000).option(
        "startTimestamp", int(dt.datetime.now(dt.timezone.utc).timestamp() * 1000)).load().select("timestamp")


def due_passes(runs: DataFrame, periods: Mapping[str, int], now: dt.datetime) -> tuple[list[str], dict[str, dt.datetime]]:
    """The passes whose time has come, and when each has run last; ``runs`` has one row a pass."""
    last = {r["pass"]: r.last_run for r in runs.collect()}
    due = [p for p, seconds in periods.items() if p not in last or (now - last[p]).total_seconds() >= seconds]
    return due, {**last, **dict.fromkeys(due, now)}


def _time_of(batch: DataFrame) -> dt.datetime | None:
    """The latest tick of a micro-batch."""
    return batch.agg(F.max(F.col("tick").cast("timestamp_ntz"))).first()[0]


def pass_candidates(due: list[str], cat: Catalogue, rules: Rules, orphans: DataFrame) -> tuple[
        list[DataFrame], dict[str, DataFrame], tuple[DataFrame, DataFrame] | None]:
    """STR-14: the candidates of the passes over whole tables, and what they store for the next time: the orphans given
    out and the day up to which the gap-filled product is complete. Third, candidates that are bound to all partners of their
    tile and day, and those partners: the arguments of ``shared_links``, which gives their other links."""
    found, stored, shared = [], {}, None
    if "grd" in due:
        alone, seen = trg_sig0_orphans(cat.raw_inputs, cat.raw2valid, rules.as_of, orphans)
        found += [trg_sig0_pairs(cat.raw_inputs, cat.raw2valid, rules.as_of), alone]
        stored["orphans"] = seen
    if "l1c" in due:
        found.append(trg_cc(cat, rules)[0])
    if "gfsc" in due:
        day = cat.triggerer_config.where(F.col("product_type") == GAP_FILLED).first()
        if day is not None and day.last_processing_date is not None:
            rows, walk = trg_gfsc(cat, rules, day.last_processing_date)
            found.append(rows)
            reached = walk.agg(F.max("stored_day")).first()[0]
            if reached is not None:
                stored["triggerer_config"] = set_last_day(cat.triggerer_config, GAP_FILLED, reached)
    if "wics1s2" in due:
        own, twins, partners = shared_wics1s2(cat, rules)
        found += [own, twins]
        shared = own, partners
    return [df.select(*COLUMNS) for df in found], stored, shared


def run_triggers(inputs: DataFrame, catalogue: Callable[[], Catalogue], rules: Rules, root: str, checkpoint: str,
                 every: str | None = None, ticks: DataFrame | None = None, periods: Mapping[str, int] = PERIODS):
    """STR-08: new inputs to validations and links below ``root``; with ``ticks`` (``clock``) also STR-14, the periodic
    passes, of which each runs when its period has gone by, with or without new inputs.

    ``catalogue`` opens the other tables anew for every micro-batch (``lambda: load_catalogue(spark, root)``), because
    a scan keeps the list of files it was opened with. Time is that of the latest tick, without ticks that of ``rules``.
    Validations, links, orphans, day and times of the passes are published by one commit.
    """
    spark, log = inputs.sparkSession, log_of(inputs.sparkSession, root, "trigger_validation")
    rows = inputs
    if ticks is not None:
        rows = inputs.withColumn("tick", F.lit(None).cast("timestamp")).unionByName(
            ticks.select(F.col("timestamp").alias("tick")), allowMissingColumns=True)

    def work(batch: DataFrame, n: int) -> None:
        if log.has(n, "trigger_validation"):
            return
        live = log.state().live
        now = catalogue().replace(**{t: log.rows(t) for t in ("trigger_validation", "raw2valid", "triggerer_config", "set_index") if t in live})
        new, dated, stored, found, shared = batch, rules, {}, [], None
        if ticks is not None:
            new, tick = batch.where("tick IS NULL").drop("tick"), _time_of(batch)
            runs = log.rows("pass_runs")
            due, last = due_passes(runs, periods, tick) if tick else ([], {})
            dated = replace(rules, as_of=tick or runs.agg(F.max("last_run")).first()[0] or rules.as_of)
            if due:
                found, stored, shared = pass_candidates(due, now, dated, log.rows("orphans"))
                stored["pass_runs"] = spark.createDataFrame(list(last.items()), JOB_SCHEMAS["pass_runs"])
        if not (found and new.isEmpty()):
            found.append(trigger_all(new.dropDuplicates(["id"]), now, dated).select(*COLUMNS))
        heads, members = materialise(reduce(DataFrame.unionByName, found), now, dated)
        heads, members = written(heads, "new-validations"), written(members, "new-links")
        sets = set_index(now.replace(trigger_validation=heads, raw2valid=members))
        if "set_index" not in live:  # the first batch adds the sets that were there before
            sets = sets.unionByName(set_index(now))
        if shared:  # their validations have no day, so they are in no set
            members = members.unionByName(shared_links(heads, *shared))
        log.commit(n, {"trigger_validation": heads, "raw2valid": members, "set_index": sets}, stored)

    return start(rows, work, checkpoint, every)


def run_recovery(ticks: DataFrame, catalogue: Callable[[], Catalogue], ages: Callable[[], DataFrame], flavours: list[str],
                 root: str, checkpoint: str, every: str | None = None, periods: Mapping[str, int] = RECOVERY_PERIODS,
                 day: int = CUTOVER_DAY):
    """STR-14: the launcher's pass. Status rows for lost dispatches of all flavours below ``root``, so that their tasks are
    in error and come to the queue again; ``ages`` opens the ages of the dispatches as the cluster reports them, ``day`` is the
    earliest measurement day."""
    spark, log = ticks.sparkSession, log_of(ticks.sparkSession, root, "processing_status_workflow")

    def work(batch: DataFrame, n: int) -> None:
        tick = _time_of(batch)
        if tick is None or log.has(n, "processing_status_workflow"):
            return
        due, last = due_passes(log.rows("recovery_runs"), periods, tick)
        if not due:
            return
        known = log.rows("processing_status_workflow")
        cat = catalogue()
        cat = cat.replace(processing_status_workflow=known) if log.state().live.get("processing_status_workflow") else cat
        lost = reduce(DataFrame.unionByName, [lost_tasks(cat, ages(), f, tick, day) for f in flavours]).distinct()
        keyed = lost.withColumn("status_key", F.concat_ws("|", "nomad_job_dispatch_fk_id", F.col("date").cast("string")))
        made = numbered(keyed, "status_key", cat.processing_status_workflow.select("id")).withColumn(
            "message", F.lit(None).cast("string"))
        log.commit(n, {"processing_status_workflow": made},
                   {"recovery_runs": spark.createDataFrame(list(last.items()), JOB_SCHEMAS["recovery_runs"])})

    return start(ticks.select(F.col("timestamp").alias("tick")), work, checkpoint, every)


def run_planner(members: DataFrame, validations: Callable[[], DataFrame], root: str, checkpoint: str, as_of,
                every: str | None = None):
    """STR-11: new links to tasks below ``root``, one per validation; ``validations`` opens them for every batch."""
    log = log_of(members.sparkSession, root, "processing_tasks")

    def work(batch: DataFrame, n: int) -> None:
        if not log.has(n, "processing_tasks"):
            known = log.rows("processing_tasks")
            log.commit(n, {"processing_tasks": append_tasks(known, plan_tasks(batch, validations(), known, as_of)[0])})

    return start(members, work, checkpoint, every)


def run_feed(stream: DataFrame, shape: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
             every: str | None = None):
    """STR-05, 06: the rows that ``shape`` makes of each micro-batch, below ``path``.

    ``shape`` opens the tables it joins with itself, so it sees the rows that came since the start.
    """
    return start(stream, partial(_shaped, shape, path), checkpoint, every)


def _shaped(shape: Callable[[DataFrame], DataFrame], path: str, batch: DataFrame, n: int) -> None:
    shape(batch).write.mode("overwrite").parquet(f"{path}/batch={n}")


def run_periodic(source: DataFrame, work: Callable[[], None], checkpoint: str, every: str | None = None):
    """STR-14: a pass over whole tables after each batch of new rows, at most every so often (600 s, 6 h, …).

    The rows of the stream only wake the pass; what it reads is up to ``work``.
    """
    return start(source, partial(_woken, work), checkpoint, every)


def _woken(work: Callable[[], None], batch: DataFrame, n: int) -> None:
    if not batch.isEmpty():
        work()

"""STR-12: the launch queue as a state by id over two streams, tasks that arrive and tasks that are launched.

An id is in the state from its arrival to its launch and no longer, whatever the time between, so a task that fails
and comes back is queued again at once, one that is still queued is not, and the state is as large as the queue.

The state is a table of ids below the checkpoint, published anew by each micro-batch; ids that wait and events meet in one
shuffle, and windows give every event its turn.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.streaming.state import GroupState
from pyspark.sql.types import StructField, StructType

from tileplan.sources.tablelog import TableLog
from tileplan.streaming.running import start

#: The time of what waited before a micro-batch, which is before that of any event.
BEFORE = 1 - (1 << 63)


def in_turn(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The events of an id by time: an arrival is queued unless it is queued already, a launch takes it out.

    Events of the same time come in the order that loses nothing: a launch first while the id is queued, else an arrival.
    The state is a flag; what is held of a batch is one row per event of the id. This is the rule event by event, for one
    id; the job has ``turns``, the same for all ids at once.
    """
    events = pd.concat(list(batches), ignore_index=True)
    queued, rows = state.exists, []
    for _, same in events.groupby("at", sort=True):
        arrived = list(same.loc[~same["is_launch"], "payload"])
        launched = int(same["is_launch"].sum())
        while (launched if queued else arrived):
            if queued:
                launched -= 1
            else:
                rows.append(arrived.pop(0))
            queued = not queued
    if queued:
        state.update((True,))
    elif state.exists:
        state.remove()
    if rows:
        yield pd.DataFrame({"id": [key[0]] * len(rows), "payload": rows})


def queue_events(tasks: DataFrame, launches: DataFrame, at: str | None = None) -> DataFrame:
    """The events of the queue (id, at, is_launch, task): the rows of ``tasks`` (id, …), and the ids of ``launches``, which leave it.

    ``at`` names the time of an event in both; without it events have the time of their micro-batch. Tasks without
    an id cannot be launched and are left out.
    """
    when = F.current_timestamp() if at is None else F.col(at).cast("timestamp")
    time = F.coalesce(F.unix_micros(when), F.lit(0)).alias("at")
    arrived = tasks.select("id", time, F.lit(False).alias("is_launch"), F.struct(*tasks.columns).alias("task"))
    gone = launches.select(F.col("id").cast(tasks.schema["id"].dataType).alias("id"), time, F.lit(True).alias("is_launch"),
                           F.lit(None).cast(tasks.schema).alias("task"))
    return arrived.unionByName(gone).where("id IS NOT NULL")


def turns(events: DataFrame, waiting: DataFrame) -> DataFrame:
    """The rule of ``in_turn`` for all ids: ``events`` of a micro-batch with the flags ``enters``, for an arrival that enters
    the queue, and ``waits``, on one row of every id that is in it afterwards; ``waiting`` has the ids that were in it.

    At one time a arrivals and l launches of an id leave it queued if a > l, not queued if a < l and as it was if they are
    equal, and let in as many arrivals as there are launches, and one more if it was not queued. So the last time before
    at which they differ tells whether it was. What waited is an arrival before all times. The windows share one shuffle and sort.
    """
    stored = waiting.select("id", F.lit(BEFORE).alias("at"), F.lit(False).alias("is_launch"),
                            F.lit(None).cast(events.schema["task"].dataType).alias("task"))
    same, of_id = W.partitionBy("id", "at"), W.partitionBy("id")
    n = lambda flag: F.count_if(flag).over(same)
    rows = (events.unionByName(stored).repartition("id")
            .withColumn("nth", F.row_number().over(same.orderBy("is_launch")))
            .withColumn("arrivals", n(~F.col("is_launch"))).withColumn("launches", n(F.col("is_launch")))
            .withColumn("after", F.when(F.col("arrivals") > F.col("launches"), True)
                        .when(F.col("arrivals") < F.col("launches"), False))
            .withColumn("queued", F.coalesce(F.last("after", True).over(
                of_id.orderBy("at").rangeBetween(W.unboundedPreceding, -1)), F.lit(False)))
            .withColumn("is_last", F.lead("id").over(of_id.orderBy("at", "is_launch")).isNull()))
    let_in = F.least("arrivals", F.col("launches") + F.when(F.col("queued"), 0).otherwise(1))
    return rows.select(
        "id", "at", "is_launch", "task",
        (~F.col("is_launch") & (F.col("at") > BEFORE) & (F.col("nth") <= let_in)).alias("enters"),
        (F.col("is_last") & F.coalesce("after", "queued")).alias("waits"))


def run_queue(tasks: DataFrame, deployed: Callable[[], DataFrame], path: str, checkpoint: str, launches: DataFrame | None = None,
              at: str | None = None, every: str | None = None):
    """STR-12: the launch queue below ``path``: tasks that arrive, are not queued and not deployed at that moment.

    A deployed task (``deployed`` opens their ids for each micro-batch) is passed over and leaves the queue like one that
    is launched: its row goes to ``<path>-passed``, which is read with the launches. The ids that wait are in
    ``<checkpoint>/waiting``; a micro-batch writes its rows and then publishes them, so one that is repeated finds those before it.
    """
    spark, passed = tasks.sparkSession, f"{path}-passed"
    spark.createDataFrame([], tasks.schema).write.mode("ignore").parquet(f"{passed}/batch=-1")
    out = spark.readStream.schema(tasks.schema).parquet(passed).select("id", *([at] if at else []))
    leaving = out if launches is None else launches.select(*out.columns).unionByName(out)
    ids = StructType([StructField("id", tasks.schema["id"].dataType)])
    log = TableLog(spark, checkpoint, "waiting", {"waiting": ids}, keep=2)

    def work(batch: DataFrame, n: int) -> None:
        if log.has(n, "waiting"):
            return
        running = deployed().select("id").distinct().withColumn("deployed", F.lit(True))
        found = turns(batch, log.rows("waiting")).where("enters OR waits").join(running, "id", "left").persist()
        try:
            rows = lambda which: found.where(f"enters AND deployed IS {which}").select("task.*")
            rows("NULL").write.mode("overwrite").parquet(f"{path}/batch={n}")
            rows("NOT NULL").write.mode("overwrite").parquet(f"{passed}/batch={n}")
            log.commit(n, replace={"waiting": found.where("waits").select("id")})
        finally:
            found.unpersist()

    return start(queue_events(tasks, leaving, at), work, checkpoint, every)

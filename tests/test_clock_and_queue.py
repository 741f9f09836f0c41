"""The launch queue over arrivals and launches, and the passes that a clock fires."""

import datetime as dt

import pytest
from helpers import AS_OF, catalogue, raw, rules, sets, table, ts
from test_triggers import grd

from tileplan.schemas import SCHEMAS
from tileplan.streaming import feeds, jobs, queue


def add(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


EVENT = "id BIGINT, payload STRING, at TIMESTAMP"


@pytest.fixture
def run(spark, tmp_path):
    """Feed arrivals and launches (id, minute) as one micro-batch; returns all that was queued so far."""
    root, n = str(tmp_path), [0]
    minute = lambda m: dt.datetime(2025, 1, 30, 6, m)

    def step(arrived=(), launched=(), deployed=()):
        n[0] += 1
        add(spark, f"{root}/tasks", [(i, f"p{n[0]}", minute(m)) for i, m in arrived], EVENT)
        add(spark, f"{root}/launches", [(i, None, minute(m)) for i, m in launched], EVENT)
        stream = lambda name: spark.readStream.schema(EVENT).parquet(f"{root}/{name}")
        open_ids = lambda: spark.createDataFrame([(i,) for i in deployed], "id BIGINT")
        jobs.run_queue(stream("tasks"), open_ids, f"{root}/queue", f"{root}/checkpoint", stream("launches"), "at").awaitTermination()
        return sets(spark.read.parquet(f"{root}/queue"), "id", "payload")

    return step


def test_relaunch_within_a_minute_is_queued_again(run):
    assert run(arrived=[(1, 0), (2, 0), (2, 1)]) == [(1, "p1"), (2, "p1")]
    assert run(arrived=[(1, 1), (2, 2)], launched=[(1, 0)]) == [(1, "p1"), (1, "p2"), (2, "p1")]  # 2 waits still
    assert run(arrived=[(1, 3)]) == [(1, "p1"), (1, "p2"), (2, "p1")]


def test_events_of_one_batch_and_of_one_time(run):
    # arrives, is launched, fails and comes back between two micro-batches
    assert run(arrived=[(1, 0), (1, 2)], launched=[(1, 1)]) == [(1, "p1"), (1, "p1")]
    # at one time: a launch of what is queued comes first, a launch of what is not comes last
    assert run(arrived=[(1, 5), (2, 5)], launched=[(1, 5), (2, 5)]) == [(1, "p1"), (1, "p1"), (1, "p2"), (2, "p2")]
    assert run(arrived=[(2, 6), (1, 6)])[-2:] == [(2, "p2"), (2, "p3")]


def test_deployed_task_is_passed_over_and_leaves_the_queue(run):
    assert run(arrived=[(1, 0), (3, 0)], deployed=[3]) == [(1, "p1")]
    assert run(arrived=[(3, 4)]) == [(1, "p1"), (3, "p2")]


def test_null_ids_and_launches_of_nothing(run):
    assert run(arrived=[(None, 0)], launched=[(9, 0), (None, 1)]) == []


def test_state_is_as_large_as_the_queue(spark):
    import pandas as pd

    class Held:
        exists = False

        def update(self, value):
            self.exists = True

        def remove(self):
            self.exists = False

    state = Held()
    event = lambda at, launch: pd.DataFrame({"at": [at], "is_launch": [launch], "payload": [None if launch else f"a{at}"]})
    out = [r for at, launch in ((1, False), (2, False), (3, True), (4, False), (5, True))
           for f in queue.in_turn((7,), iter([event(at, launch)]), state) for r in f["payload"]]
    assert out == ["a1", "a4"] and not state.exists


def tick(spark, root, *times):
    add(spark, f"{root}/ticks", [(ts(t),) for t in times], "timestamp TIMESTAMP")


def ticks(spark, root):
    return spark.readStream.schema("timestamp TIMESTAMP").parquet(f"{root}/ticks")


def test_passes_fire_without_input(spark, tmp_path):
    """An orphan appears once its two hours are over, though no row comes; so does an L1C, a merged pair, and the day moves."""
    root = str(tmp_path)
    kept = [grd("alone", "060000", "060020", harvested="2025-01-30 21:00:00"), raw("l1c", "S2MSI1C", day=20250130, harvested="2025-01-30 20:00:00"),
            raw("w1", "S1_WICS1_L2B"), raw("w2", "S2_WICS2_L2B"), raw("f", "S2_FSC_L2B", day=20250129)]
    cat = catalogue(spark, raw_inputs=kept)
    cat = cat.replace(triggerer_config=spark.createDataFrame([("GFSC_L2C", 20250129)], SCHEMAS["triggerer_config"]))
    table(spark, "raw_inputs", []).write.parquet(f"{root}/new")
    stream = spark.readStream.schema(SCHEMAS["raw_inputs"]).parquet(f"{root}/new")

    def run(at):
        tick(spark, root, at)
        jobs.run_triggers(stream, lambda: cat, rules(spark, as_of=AS_OF), root, f"{root}/checkpoint", ticks=ticks(spark, root)).awaitTermination()
        heads, members = (jobs.BatchTable(spark, root, t).rows() for t in ("trigger_validation", "raw2valid"))
        return sets(members.join(heads.withColumnRenamed("id", "trigger_validation_id"), "trigger_validation_id"),
                    "triggering_condition_name", "raw_input_id")

    first = run("2025-01-30 22:00:00")
    assert first == [("CC_TC", "l1c"), ("GFSC_TC", "f"), ("WICS1S2_TC", "w1"), ("WICS1S2_TC", "w2")]
    assert run("2025-01-30 22:04:00") == first  # nothing is due
    later = run("2025-01-30 23:01:00")
    assert later == sorted([*first, ("Backscatter_10m_TC", "alone")])
    log = jobs.log_of(spark, root, "orphans")
    assert sets(log.rows("orphans"), "tile", "measurement_day") == [("32TMP", 20250130)]
    assert sets(log.rows("triggerer_config"), "last_processing_date") == [(20250130,)]
    runs = dict(sets(log.rows("pass_runs"), "pass", "last_run"))
    assert runs["gfsc"] == ts("2025-01-30 22:00:00") and runs["grd"] == ts("2025-01-30 23:01:00")
    assert run("2025-01-30 23:07:00") == later  # an orphan is given out once


def test_new_inputs_and_passes_in_one_batch(spark, tmp_path):
    root = str(tmp_path)
    cat = catalogue(spark, raw_inputs=[raw("w1", "S1_WICS1_L2B"), raw("w2", "S2_WICS2_L2B"), raw("m1", "S2_MAJA_L2A")])
    table(spark, "raw_inputs", [raw("m1", "S2_MAJA_L2A")]).write.parquet(f"{root}/new")
    tick(spark, root, AS_OF)
    stream = spark.readStream.schema(SCHEMAS["raw_inputs"]).parquet(f"{root}/new")
    jobs.run_triggers(stream, lambda: cat, rules(spark), root, f"{root}/checkpoint", ticks=ticks(spark, root),
                      periods={"wics1s2": 600}).awaitTermination()
    heads = jobs.BatchTable(spark, root, "trigger_validation").rows()
    assert sets(heads, "triggering_condition_name") == [("FSC_TC",), ("WICS1S2_TC",), ("WICS2_TC",)]
    assert heads.select("id").distinct().count() == 3


def test_lost_task_appears_without_input(spark, tmp_path):
    root = str(tmp_path)
    cat = catalogue(
        spark, raw_inputs=[raw("m1", "S2_MAJA_L2A")],
        trigger_validation=[{"id": 1, "triggering_condition_name": "FSC_TC", "validation_date": ts(AS_OF), "is_nrt": True}],
        raw2valid=[{"trigger_validation_id": 1, "raw_input_id": "m1"}],
        processing_tasks=[{"id": 5, "trigger_validation_fk_id": 1, "creation_date": ts(AS_OF), "has_ended": False}],
        nomad_job_dispatch=[{"id": "job", "dispatch_date": ts(AS_OF)}],
        processingtask2nomad=[{"nomad_job_id": "job", "processing_task_id": 5}])
    flavours = [r.flavour for r in cat.processing_routine.select("flavour").distinct().collect()]
    age = [60]
    ages = lambda: spark.createDataFrame([("job", age[0])], "nomad_job_id STRING, age BIGINT")

    def run(at):
        tick(spark, root, at)
        jobs.run_recovery(ticks(spark, root), lambda: cat, ages, flavours, root, f"{root}/checkpoint").awaitTermination()
        return sets(jobs.log_of(spark, root, "processing_status_workflow").rows("processing_status_workflow"),
                    "nomad_job_dispatch_fk_id", "processing_status_id", "exit_code")

    assert run("2025-01-31 00:10:00") == []
    age[0] = 20000
    assert run("2025-01-31 00:15:00") == []  # 600 seconds are not over
    assert run("2025-01-31 00:20:00") == [("job", 4, 404)]
    assert run("2025-01-31 00:30:00") == [("job", 4, 404)]  # in error now, no longer lost


def test_clock_gives_times_without_input(spark, tmp_path):
    got = []
    q = jobs.start(jobs.clock(spark), lambda df, n: got.append(df.count()), f"{tmp_path}/c", every="200 milliseconds")
    q.awaitTermination(6)
    q.stop()
    assert sum(got) >= 2


def test_refused_products_are_kept(spark, tmp_path):
    root = str(tmp_path)
    good = "CLMS_WSI_CC_020m_T32TMP_20241211T102339_S2B_V100"
    rows = [(good, "S2_CC_L2B", "one"), (None, "S2_CC_L2B", "two"), ("X_Y", "S2_CC_L2B", "three"), (None, "S2_FSC_L2B", "four"),
            (good, "S2_CC_L2B", "five"), (f"{good}_2", "OTHER", "six")]
    add(spark, f"{root}/products", [(i, 1, k, p, ts(AS_OF), ts(AS_OF), None) for i, k, p in rows], SCHEMAS["products"])
    for _ in range(2):
        jobs.run_ingest(feeds.stream_table(spark, root, "products"), root, f"{root}/checkpoint", AS_OF).awaitTermination()
    assert sets(jobs.BatchTable(spark, root, "raw_inputs").rows(), "id") == [(good,)]
    refused = jobs.BatchTable(spark, root, "rejects").rows()
    assert sets(refused, "product_path", "reason") == [("four", "no id"), ("three", "name"), ("two", "no id")]

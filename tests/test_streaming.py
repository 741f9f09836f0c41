"""Streams: restart, late slices, orphans; the result of a stream is that of the batch."""

import datetime as dt
import shutil

import pytest
from helpers import catalogue, raw, rules, sets, table
from test_triggers import grd

from tileplan.plans import triggers as trg
from tileplan.schemas import SCHEMAS
from tileplan.streaming import feeds, jobs, pairing


def add_file(spark, root, name, rows):
    table(spark, name, rows).coalesce(1).write.mode("append").parquet(f"{root}/{name}")


def test_grd_state_over_several_batches(spark, tmp_path):
    root = str(tmp_path)
    out, run = f"{root}/out", 0

    def feed(*rows):
        add_file(spark, root, "raw_inputs", list(rows))
        stream = feeds.stream_table(spark, root, "raw_inputs")
        return sets(jobs.run_available(pairing.stream_grd(stream), "grd", out, f"{root}/checkpoint"), "kind", "first_id")

    assert feed(grd("a", "060000", "060020", harvested="2025-01-30 06:30:00"),
                grd("lone", "060000", "060020", tile="32TMQ", harvested="2025-01-30 06:30:00")) == []
    assert feed(grd("b", "060020", "060040", at="2025-01-30 06:00:20", harvested="2025-01-30 07:00:00")) == [("pair", "a")]
    clock = grd("clock", "060000", "060020", tile="32TMZ", harvested="2025-01-30 09:00:00")
    assert feed(clock) == [("orphan", "lone"), ("pair", "a")]


def test_triggers_stream_equals_batch_and_survives_a_repeat(spark, tmp_path):
    root = str(tmp_path)
    rows = [raw("m1", "S2_MAJA_L2A"), raw("s1", "S1_NRB_L2A", orbit=9), raw("f1", "S2_FSC_L2B"), raw("g", "IW_GRDH_1S")]
    cat = catalogue(spark, raw_inputs=rows)
    for name in ("trigger_validation", "raw2valid"):
        jobs.BatchTable(spark, root, name).write(getattr(cat, name), jobs.SEED)
    add_file(spark, root, "raw_inputs", rows)
    conf = rules(spark)

    def run(checkpoint):
        jobs.run_triggers(feeds.stream_table(spark, root, "raw_inputs"), lambda: cat, conf, root, checkpoint).awaitTermination()
        return sets(jobs.BatchTable(spark, root, "raw2valid").rows(), "trigger_validation_id", "raw_input_id")

    first = run(f"{root}/checkpoint")
    batch = sets(trg.trigger_all(cat.raw_inputs, cat, conf), "condition", "raw_input_id")
    assert len(first) == len(batch) and sorted(i for _, i in first) == sorted(i for _, i in batch)
    # The same batch again, as after a crash before its commit, leaves the same rows.
    shutil.copytree(f"{root}/checkpoint", f"{root}/lost")
    for part in ("", "."):
        commit = tmp_path / "lost" / "commits" / (f"{part}0" + (".crc" if part else ""))
        if commit.exists():
            commit.unlink()
    assert run(f"{root}/lost") == first


def test_periodic_pass_only_when_woken(spark, tmp_path):
    root, calls = str(tmp_path), []
    add_file(spark, root, "raw_inputs", [raw("a", "S2MSI1C")])
    for _ in range(2):
        stream = feeds.stream_table(spark, root, "raw_inputs")
        jobs.run_periodic(stream, lambda: calls.append(1), f"{root}/checkpoint").awaitTermination()
    assert calls == [1]


def test_queue_drops_repeats(spark, tmp_path):
    task = {"id": 1, "trigger_validation_fk_id": 1, "creation_date": raw("a", "S2MSI1C")["start_date"], "has_ended": False}
    root = str(tmp_path)
    add_file(spark, root, "processing_tasks", [task, task, {**task, "id": 2}, {**task, "id": 3}])
    deployed = spark.createDataFrame([(3,)], "id BIGINT")
    stream = feeds.stream_table(spark, root, "processing_tasks")
    jobs.run_queue(stream, lambda: deployed, f"{root}/queue", f"{root}/checkpoint").awaitTermination()
    assert sets(spark.read.parquet(f"{root}/queue"), "id") == [(1,), (2,)]


def test_queue_takes_old_tasks_after_newer_ones(spark, tmp_path):
    root = str(tmp_path)
    for id, day in ((1, 10), (2, 11), (3, 2), (4, 12)):
        add_file(spark, root, "processing_tasks", [{"id": id, "trigger_validation_fk_id": id, "has_ended": False,
                                                    "creation_date": dt.datetime(2025, 1, day)}])
        stream = feeds.stream_table(spark, root, "processing_tasks")
        deployed = lambda: spark.createDataFrame([(4,)], "id BIGINT")
        jobs.run_queue(stream, deployed, f"{root}/queue", f"{root}/checkpoint").awaitTermination()
    assert sets(spark.read.parquet(f"{root}/queue"), "id") == [(1,), (2,), (3,)]


def test_late_slice_makes_a_pair_and_a_third_is_no_orphan(spark, tmp_path):
    root = str(tmp_path)

    def feed(*rows):
        add_file(spark, root, "raw_inputs", list(rows))
        stream = feeds.stream_table(spark, root, "raw_inputs")
        return sets(jobs.run_available(pairing.stream_grd(stream), "grd", f"{root}/out", f"{root}/checkpoint"),
                    "kind", "first_id")

    clock = lambda id, at: grd(id, "060000", "060020", tile=f"32T{id}", harvested=f"2025-01-30 {at}:00")
    feed(grd("a", "060000", "060020", harvested="2025-01-30 06:30:00"))
    feed(clock("c1", "07:30"))
    assert feed(grd("b", "060020", "060040", at="2025-01-30 06:00:20", harvested="2025-01-30 06:31:00")) == [("pair", "a")]
    feed(grd("c", "060040", "060100", at="2025-01-30 06:00:40", harvested="2025-01-30 07:31:00"))
    assert feed(clock("c2", "12:00")) == [("orphan", "c1"), ("pair", "a")]


def test_triggers_see_inputs_that_come_after_the_start(spark, tmp_path):
    root = str(tmp_path)
    cat = catalogue(spark)
    for name in ("trigger_validation", "raw2valid"):
        jobs.BatchTable(spark, root, name).write(getattr(cat, name), jobs.SEED)
    opened = lambda: cat.replace(raw_inputs=spark.read.schema(SCHEMAS["raw_inputs"]).parquet(f"{root}/raw_inputs"))
    add_file(spark, root, "raw_inputs", [raw("m1", "S2_MAJA_L2A")])
    query = jobs.run_triggers(feeds.stream_table(spark, root, "raw_inputs"), opened, rules(spark), root,
                              f"{root}/checkpoint", every="1 second")
    query.processAllAvailable()
    add_file(spark, root, "raw_inputs", [raw("s1", "S1_NRB_L2A", orbit=9), raw("f1", "S2_FSC_L2B")])
    query.processAllAvailable()
    query.stop()
    made = jobs.BatchTable(spark, root, "trigger_validation").rows()
    assert ("WDS_TC",) in sets(made, "triggering_condition_name")
    assert made.where("is_nrt IS NULL").count() == 0


@pytest.mark.parametrize("is_update,old,hit", [(False, None, True), (True, 1, True), (True, 2, False), (True, None, True)])
def test_processed_feed(spark, is_update, old, hit):
    df = spark.createDataFrame([(7, 2, is_update, old)],
                               "id BIGINT, processing_status_id INT, is_update BOOLEAN, old_status_id INT")
    assert feeds.stream_processed(df).count() == int(hit)

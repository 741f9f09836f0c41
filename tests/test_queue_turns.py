"""The launch queue for all ids at once equals the rule event by event, and no Python worker takes ids one by one."""

import random

import pandas as pd
import pytest

from tileplan import registry
from tileplan.fixtures import FixtureCatalogue
from tileplan.operators.tasks import currently_deployed
from tileplan.streaming import queue

registry.load()

SCHEMA = "id BIGINT, at BIGINT, is_launch BOOLEAN, task STRUCT<id: BIGINT, name: STRING>"


class Held:
    def __init__(self, exists):
        self.exists = exists

    def update(self, value):
        self.exists = True

    def remove(self):
        self.exists = False


def frames(spark, events, waiting):
    return spark.createDataFrame(events, SCHEMA), spark.createDataFrame([(i,) for i in waiting], "id BIGINT")


def test_turns_equal_the_rule_event_by_event(spark):
    pick = random.Random(5)
    waiting = [i for i in range(300) if pick.random() < 0.5]
    events = []
    for i in range(280):  # ids from 280 on only wait
        for n in range(pick.randrange(9)):
            launch = pick.random() < 0.5
            events.append((i, pick.randrange(-1, 3), launch, None if launch else (i, f"t{n}")))
    found = queue.turns(*frames(spark, events, waiting)).collect()
    count, wait = {}, set()
    for i in range(300):
        state = Held(i in waiting)
        mine = pd.DataFrame([(at, launch, task) for j, at, launch, task in events if j == i], columns=["at", "is_launch", "payload"])
        count[i] = sum(len(f) for f in queue.in_turn((i,), iter([mine]), state)) if len(mine) else 0
        wait |= {i} if state.exists else set()
    assert {i: sum(r.enters for r in found if r.id == i) for i in range(300)} == count
    assert sorted(r.id for r in found if r.waits) == sorted(wait)
    taken = [(r.task.id, r.at, r.task.name) for r in found if r.enters]
    assert set(taken) <= {(j, at, task[1]) for j, at, launch, task in events if not launch} and len(taken) == len(set(taken))


def test_turns_need_one_shuffle_and_no_python(spark, capsys):
    queue.turns(*frames(spark, [(1, 0, False, (1, "a"))], [2])).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 1 and "Pandas" not in plan and "Python" not in plan


def test_repeated_batch_and_new_checkpoint(spark, tmp_path):
    """What waits is below the checkpoint: another checkpoint begins with an empty queue."""
    from tileplan.streaming import jobs

    root, seen = str(tmp_path), []
    spark.createDataFrame([(1, "a")], "id BIGINT, name STRING").write.parquet(f"{root}/tasks")
    for checkpoint, path in (("c1", "q1"), ("c1", "q1"), ("c2", "q2")):
        stream = spark.readStream.schema("id BIGINT, name STRING").parquet(f"{root}/tasks")
        jobs.run_queue(stream, lambda: spark.createDataFrame([], "id BIGINT"), f"{root}/{path}", f"{root}/{checkpoint}").awaitTermination()
        seen.append(spark.read.parquet(f"{root}/{path}").count())
    assert seen == [1, 1, 1]


@pytest.mark.parametrize("files", [1, 3])
def test_events_in_a_folder_are_all_queued(spark, tmp_path, files):
    """Larger tables are folders of files; a stream over them has the rows that a batch read has."""
    events = spark.range(400).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + id * INTERVAL '1' HOUR AS ts", "id % 7 AS user_id",
        "'view' AS event_type", "double(id) AS value", "'{}' AS props")
    events.repartition(files).write.parquet(f"{tmp_path}/events.parquet")
    fx = FixtureCatalogue(spark, str(tmp_path))
    expected = {r.id for r in fx.processing_tasks.collect()} - {r.id for r in currently_deployed(fx).collect()}
    found = [r.id for r in registry.QUERIES["str12_queue"](spark, str(tmp_path)).collect()]
    assert expected and sorted(found) == sorted(expected)

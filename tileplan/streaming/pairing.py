"""STR-09 and STR-10: pairing on the streams themselves."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tileplan.functions.names import parse_grd
from tileplan.operators.filters import orbit_valid

LIMIT = "7 days"
WAIT_MS = 2 * 3600 * 1000
LIMIT_MS = 7 * 24 * 3600 * 1000
SLACK_MS = 600 * 1000


def stream_wds(sig0: DataFrame, fsc: DataFrame, tracks: DataFrame, limit: str = LIMIT) -> DataFrame:
    """STR-09: backscatter on a valid orbit with each FSC of its tile and day, harvested within the limit of it.

    Both sides have a watermark of the limit and the join bounds the times, so state older than that is dropped.
    """
    left = orbit_valid(sig0, tracks).select(
        F.col("id").alias("sig0_id"), "tile", "measurement_day",
        F.col("harvesting_date").cast("timestamp").alias("sig0_time")).withWatermark("sig0_time", limit)
    right = fsc.select(
        F.col("id").alias("fsc_id"), F.col("tile").alias("fsc_tile"), F.col("measurement_day").alias("fsc_day"),
        F.col("harvesting_date").cast("timestamp").alias("fsc_time")).withWatermark("fsc_time", limit)
    span = F.expr(f"INTERVAL {limit}")
    return left.join(right, (F.col("tile") == F.col("fsc_tile")) & (F.col("measurement_day") == F.col("fsc_day"))
                     & F.col("fsc_time").between(F.col("sig0_time") - span, F.col("sig0_time") + span)).select(
        "sig0_id", "fsc_id", "tile", "measurement_day")


GROUP = ["tile", "measurement_day", "orbit_key"]
DECISION = "tile STRING, measurement_day BIGINT, orbit_key INT, kind STRING, first_id STRING"
STATE = ("at1 BIGINT, id1 STRING, start1 STRING, stop1 STRING, at2 BIGINT, id2 STRING, start2 STRING, stop2 STRING, "
         "n BIGINT, last_ms BIGINT, paired BOOLEAN")


def decide(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The state of a group of slices: its first two by start and id, their number and the last harvest time.

    Two that follow each other make a pair; the group stays for seven days more, so that further slices of it are no
    orphans. One alone for two hours is an orphan and ends the group. Others wait until seven days have passed.
    Whatever the size of a group, its state is two slices.
    """
    if state.hasTimedOut:
        held = state.get
        if held[8] == 1 and not held[10]:
            yield _decision(key, "orphan", held[1])
        state.remove()
        return
    held = state.get if state.exists else (None,) * 8 + (0, 0, False)
    two = [held[i:i + 4] for i in (0, 4) if held[i] is not None]
    n, last_ms, paired = held[8:]
    for batch in batches:
        n += len(batch)
        last_ms = max(last_ms, int(batch["ms"].max()))
        head = batch.sort_values(["at", "id"]).head(2)
        two = sorted(two + list(zip(head["at"].astype(int), head["id"], head["start"], head["stop"])))[:2]
    if not paired and len(two) == 2 and (two[0][3] == two[1][2] or two[0][2] == two[1][3]):
        yield _decision(key, "pair", two[0][1])
        paired = True
    second = two[1] if len(two) == 2 else (None,) * 4
    state.update((*two[0], *second, n, last_ms, paired))
    # the watermark is the limit behind the newest harvest time, so timers are set back by as much
    due = last_ms + (WAIT_MS + SLACK_MS if n == 1 else LIMIT_MS) - LIMIT_MS
    state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))


def _decision(key: tuple, kind: str, first_id: str) -> pd.DataFrame:
    return pd.DataFrame([(*key, kind, first_id)], columns=["tile", "measurement_day", "orbit_key", "kind", "first_id"])


def stream_grd(grd: DataFrame) -> DataFrame:
    """STR-10: decisions on groups (tile, day, orbit) of partial GRD: a pair of consecutive slices, or an orphan.

    A decision names the group and its first slice; its members are the open slices of the group in the input
    table, joined like in the batch trigger. Time is the harvesting date. A slice up to seven days late still finds its
    group; an orphan is given out when a slice harvested two hours and ten minutes later has come.
    """
    name = parse_grd("input_path")
    event_time = F.col("harvesting_date").cast("timestamp")
    slices = (grd.filter((F.col("product_type_code") == "IW_GRDH_1S") & F.col("is_partial"))
              .select("tile", "measurement_day", F.coalesce("relative_orbit_number", F.lit(-1)).alias("orbit_key"), "id",
                      F.unix_micros(F.col("start_date").cast("timestamp")).alias("at"), name["start"].alias("start"),
                      name["stop"].alias("stop"), event_time.alias("event_time"),
                      F.unix_millis(event_time).alias("ms"))
              .withWatermark("event_time", LIMIT))
    return slices.groupBy(*GROUP).applyInPandasWithState(
        decide, DECISION, STATE, "append", GroupStateTimeout.EventTimeTimeout)

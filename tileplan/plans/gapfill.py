"""AGG-13 and TRG-10: exact set match and the daily walk of the gap-filled product."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tileplan.catalogue import Catalogue
from tileplan.functions.scalars import date_to_day, day_to_date
from tileplan.operators.status import not_successful
from tileplan.plans.triggers import Rules, _rows
from tileplan.session import day_number, written

LOOK_BACK = 7
JUMP = 7
BLOCKING = ["CC_TC", "Backscatter_10m_TC", "FSC_TC", "SWS_TC"]


def _fingerprint() -> list[Column]:
    """Order-free summary of a set of ids. All parts are combined before the shuffle."""
    h = F.xxhash64("raw_input_id")
    return [F.sum("m").alias("n"), F.bit_xor(h).alias("fx"), F.sum(F.pmod(h, F.lit(1 << 31)) * F.col("m")).alias("fs")]


def _stored_sets(cat: Catalogue) -> DataFrame:
    """The validations that bind a set for a day."""
    return cat.trigger_validation.filter(F.col("artificial_measurement_day").isNotNull()).select(
        F.col("id").alias("trigger_validation_id"), F.col("triggering_condition_name").alias("condition"),
        F.col("artificial_measurement_day").alias("day"))


def _counted(links: DataFrame, *more: str) -> DataFrame:
    return links.groupBy("trigger_validation_id", *more, "raw_input_id").agg(F.count("*").alias("m"))


def set_index(cat: Catalogue) -> DataFrame:
    """AGG-13: the fingerprints of the sets that the validations of ``cat`` bind: one row per validation with a day.

    Given the new validations and links of an append, these are the rows to add to a stored index.
    """
    theirs = _counted(cat.raw2valid.join(_stored_sets(cat), "trigger_validation_id"), "condition", "day")
    return theirs.groupBy("trigger_validation_id", "condition", "day").agg(*_fingerprint())


def exact_set_exists(candidates: DataFrame, cat: Catalogue) -> DataFrame:
    """AGG-13: keys of the candidates for which a validation has the same condition, day and members.

    ``candidates`` has candidate_key, condition, day and raw_input_id. Sets are first compared by a fingerprint;
    the pairs that agree are then compared member by member, so the answer does not rest on a hash. Copies of a
    member count. No set is gathered into one row.

    Only stored sets of the candidates' days are looked at. Their fingerprints are read from the table ``set_index`` where
    the catalogue has it (laid out by day, kept up to date by STR-08), and then links are read for the pairs that agree;
    else the links of those days are read once and written.
    """
    ours = candidates.groupBy("candidate_key", "condition", "day", "raw_input_id").agg(F.count("*").alias("m"))
    a = written(ours.groupBy("candidate_key", "condition", "day").agg(*_fingerprint()), "set-fingerprints")
    days = [r.day for r in a.select("day").distinct().collect()]  # calendar days
    if "set_index" in cat.names():
        index, members = cat.set_index.filter(F.col("day").isin(days)), cat.raw2valid
    else:
        members = cat.raw2valid.join(_stored_sets(cat).filter(F.col("day").isin(days)), "trigger_validation_id")
        members = written(_counted(members, "condition", "day"), "stored-sets")
        index = members.groupBy("trigger_validation_id", "condition", "day").agg(*_fingerprint())
    pairs = written(a.join(index, ["condition", "day", "n", "fx", "fs"]).select("candidate_key", "trigger_validation_id", "n"),
                    "set-pairs")
    found = members.join(pairs.select("trigger_validation_id").distinct(), "trigger_validation_id", "left_semi")
    theirs = found if "m" in found.columns else _counted(found)
    equal = (ours.select("candidate_key", "raw_input_id", "m").join(pairs, "candidate_key")
             .join(theirs.select("trigger_validation_id", "raw_input_id", "m"),
                   ["trigger_validation_id", "raw_input_id", "m"])
             .groupBy("candidate_key", "trigger_validation_id", "n").agg(F.sum("m").alias("found"))
             .filter(F.col("found") == F.col("n")))
    return equal.select("candidate_key").distinct()


def gap_walk(unsuccessful: DataFrame, last_day: int, today: dt.date) -> DataFrame:
    """The days the walk visits: (measurement_day, clean, stored_day).

    ``unsuccessful`` has one row (measurement_day, total) per day. From the last processed day to yesterday, a
    day with unsuccessful work jumps seven days and freezes the stored day for the rest of the walk; a clean day
    moves one. The state is two days and a flag, so the walk folds over an array of the days, whose length is the
    number of calendar days, not of inputs. ``stored_day`` is the day to store after the walk.
    """
    start = dt.date(last_day // 10000, last_day // 100 % 100, last_day % 100)
    if start >= today:
        return unsuccessful.sparkSession.createDataFrame(
            [], "measurement_day BIGINT, clean BOOLEAN, stored_day BIGINT")
    bad = (unsuccessful.filter((F.col("measurement_day") >= last_day) & (F.col("measurement_day") < day_number(today))
                               & (F.col("total") != 0))
           .agg(F.collect_set("measurement_day").alias("bad")))
    days = F.sequence(F.lit(start), F.lit(today - dt.timedelta(days=1)))
    visit = lambda day, clean: F.array(F.struct(day.alias("measurement_day"), clean.alias("clean")))
    none = F.filter(visit(F.lit(0).cast("bigint"), F.lit(True)), lambda v: F.lit(False))
    begin = F.struct(F.lit(start).alias("next"), F.lit(last_day).cast("bigint").alias("stored"),
                     F.lit(True).alias("moving"), none.alias("visits"))

    def step(state: Column, day: Column) -> Column:
        number = date_to_day(day)
        clean = ~F.array_contains(F.col("bad"), number)
        moving = state["moving"] & clean
        after = F.struct(
            F.date_add(day, F.when(clean, 1).otherwise(JUMP)).alias("next"),
            F.when(moving, date_to_day(F.date_add(day, 1))).otherwise(state["stored"]).alias("stored"),
            moving.alias("moving"),
            F.concat(state["visits"], visit(number, clean)).alias("visits"))
        return F.when(day < state["next"], state).otherwise(after)

    walked = bad.select(F.aggregate(days, begin, step).alias("w"))
    return walked.select(F.explode("w.visits").alias("v"), F.col("w.stored").alias("stored_day")).select(
        "v.measurement_day", "v.clean", "stored_day")


def trg_gfsc(cat: Catalogue, rules: Rules, last_day: int) -> tuple[DataFrame, DataFrame]:
    """TRG-10: for every clean day of the walk and every allowed tile, all FSC and SWS of the eight days up to it,
    unless a validation of that day has exactly this set. Returns the candidates and the walk.

    An input is put under each of the eight days it counts for, which turns the range into equality of days;
    the days of the walk are at most one row per calendar day and are broadcast. The walk and the sets are written
    once, as the comparison with the stored sets reads them several times.
    """
    walk = written(gap_walk(not_successful(cat, BLOCKING), last_day, rules.today), "gap-walk")
    clean = walk.filter("clean").select(F.col("measurement_day").alias("day"))
    first = day_number(dt.date(last_day // 10000, last_day // 100 % 100, last_day % 100) - dt.timedelta(days=LOOK_BACK))
    date = day_to_date("measurement_day")
    sets = (cat.raw_inputs.filter(F.col("product_type_code").isin("S2_FSC_L2B", "S1_SWS_L2B")
                                  & F.col("measurement_day").between(first, day_number(rules.today)))
            .select("tile", F.col("id").alias("raw_input_id"),
                    F.explode(F.sequence(date, F.date_add(date, LOOK_BACK))).alias("date"))
            .select("tile", "raw_input_id", date_to_day("date").alias("day"))
            .join(F.broadcast(clean), "day").join(rules.tiles.select("tile"), "tile", "left_semi")
            .withColumn("condition", F.lit("GFSC_TC"))
            .withColumn("candidate_key", F.concat_ws("|", "condition", "tile", F.col("day").cast("string"))))
    sets = written(sets, "gap-sets")
    heads = sets.groupBy("candidate_key").agg(F.min("raw_input_id").alias("first_id"))
    fresh = heads.join(exact_set_exists(sets, cat), "candidate_key", "left_anti")
    rows = sets.join(fresh, "candidate_key").withColumn("measurement_day", F.col("day"))
    return _rows(rows, "GFSC_TC", ["tile", "day"], first="first_id", member="raw_input_id", day="day"), walk

"""TRG: which sets of inputs are complete and may be processed.

Every trigger returns member rows of candidates, one row per input bound::

    condition, tile, measurement_day, candidate_key, first_id, raw_input_id, artificial_measurement_day, is_nrt

``candidate_key`` is unique per candidate of a pass, ``first_id`` is the member that decides on the NRT flag. A
candidate is never gathered into one row, so its size does not matter. ``materialise`` turns the rows into
validations and links.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tileplan.catalogue import Catalogue
from tileplan.functions.names import parse_grd
from tileplan.functions.scalars import day_add, is_nrt_past
from tileplan.operators.filters import cc_eligible, orbit_valid
from tileplan.operators.inputs import (
    LOOK_BACK_DAYS, latest_sig0, members, not_validated, unprocessed_grd, unprocessed_l1c, validated_links,
)
from tileplan.session import day_number, moment, written
from tileplan.sources import reference
from tileplan.sources.sinks import append_members, append_validations

ORPHAN_HOURS = 2
COLUMNS = ["condition", "tile", "measurement_day", "candidate_key", "first_id", "raw_input_id",
           "artificial_measurement_day", "is_nrt"]


def _limits(column: int) -> dict[str, int | None]:
    return {row[0]: row[column] for row in reference.rows("condition_limits")}


@dataclass(frozen=True)
class Rules:
    """What the triggers are configured with: tiles, valid orbits per tile, age limits, sources and the clock."""

    as_of: str | dt.datetime
    tiles: DataFrame
    sws_tracks: DataFrame
    wics1_tracks: DataFrame
    wds_tracks: DataFrame
    sources: DataFrame
    publication_days: dict[str, int | None] = field(default_factory=lambda: _limits(1))
    measurement_days: dict[str, int | None] = field(default_factory=lambda: _limits(2))

    @property
    def today(self) -> dt.date:
        return dt.date.fromisoformat(str(self.as_of)[:10])

    def since(self, condition: str) -> Column:
        """Start of the earliest day of publication or harvest a condition accepts, as a literal for the scan."""
        return moment(f"{self.today - dt.timedelta(days=self.publication_days[condition])} 00:00:00")

    def earliest_day(self, condition: str) -> int:
        """Earliest measurement day a condition accepts; 0 without such a limit."""
        days = self.measurement_days[condition]
        return day_number(self.today - dt.timedelta(days=days)) if days else 0


def _rows(df: DataFrame, condition: str | Column, key: list, first: str = "id", member: str = "id", day=None,
          is_nrt: Column | None = None) -> DataFrame:
    """Member rows in the common shape; the key is the condition and the given columns."""
    condition = F.lit(condition) if isinstance(condition, str) else condition
    return df.select(
        condition.alias("condition"), "tile", "measurement_day",
        F.concat_ws("|", condition, *[F.col(c).cast("string") if isinstance(c, str) else c for c in key])
        .alias("candidate_key"),
        F.col(first).alias("first_id"), F.col(member).alias("raw_input_id"),
        (F.lit(None) if day is None else F.col(day)).cast("bigint").alias("artificial_measurement_day"),
        (F.lit(None).cast("boolean") if is_nrt is None else is_nrt).alias("is_nrt"))


def _of_type(df: DataFrame, product_type: str) -> DataFrame:
    return df.filter(F.col("product_type_code") == product_type)


def _recent(df: DataFrame, rules: Rules, condition: str) -> DataFrame:
    return df.filter(F.col("harvesting_date") >= rules.since(condition))


_TILE_DAY = ["tile", "measurement_day"]


def trg_sig0_full(new: DataFrame) -> DataFrame:
    """TRG-01: every whole GRD slice alone."""
    return _rows(_of_type(new, "IW_GRDH_1S").filter(~F.col("is_partial")), "Backscatter_10m_TC", ["id"])


_GROUP = ["tile", "measurement_day", "orbit_key"]


def _open_grd(ri: DataFrame, r2v: DataFrame, as_of) -> DataFrame:
    """Unprocessed partial GRD with the orbit as a group key; inputs without orbit form a group."""
    return unprocessed_grd(ri, r2v, as_of).withColumn("orbit_key", F.coalesce("relative_orbit_number", F.lit(-1)))


def grd_pairs(grd: DataFrame) -> DataFrame:
    """WIN-06: groups (tile, day, orbit) whose first two slices follow each other, with their first id.

    Slices are ordered by start and id. The filter on the rank keeps two rows per group and task before the
    shuffle, so a crowded group is small when it is ranked.
    """
    order = W.partitionBy(*_GROUP).orderBy("start_date", "id")
    two = (grd.select(*_GROUP, "start_date", "id", parse_grd("input_path").alias("n"))
           .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= 2))
    nth = lambda i, c: F.max(F.when(F.col("rank") == i, F.col(c)))
    pairs = two.groupBy(*_GROUP).agg(
        nth(1, "id").alias("first_id"), nth(1, "n.start").alias("start1"), nth(1, "n.stop").alias("stop1"),
        nth(2, "n.start").alias("start2"), nth(2, "n.stop").alias("stop2"))
    follows = (F.col("stop1") == F.col("start2")) | (F.col("start1") == F.col("stop2"))
    return pairs.filter(follows).select(*_GROUP, "first_id")


def trg_sig0_pairs(ri: DataFrame, r2v: DataFrame, as_of) -> DataFrame:
    """TRG-02: groups of two or more unprocessed partial GRD whose first two are consecutive; all members are bound."""
    grd = _open_grd(ri, r2v, as_of)
    return _rows(grd.join(grd_pairs(grd), _GROUP), "Backscatter_10m_TC", _GROUP, first="first_id")


def trg_sig0_orphans(ri: DataFrame, r2v: DataFrame, as_of, previous: DataFrame | None = None):
    """TRG-03: single partial GRD harvested two hours ago or more, whose tile and day the previous pass did not give.

    Returns the candidates and the (tile, day) to hand to the next pass.
    """
    alone = (_open_grd(ri, r2v, as_of).groupBy(*_GROUP)
             .agg(F.count("*").alias("n"), F.min("id").alias("id"), F.min("harvesting_date").alias("harvesting_date"))
             .filter((F.col("n") == 1) & (F.col("harvesting_date") + F.make_dt_interval(hours=F.lit(ORPHAN_HOURS))
                                          <= moment(as_of))))
    state = alone.select("tile", "measurement_day").distinct()
    if previous is not None:
        alone = alone.join(previous, ["tile", "measurement_day"], "left_anti")
    return _rows(alone, "Backscatter_10m_TC", ["id"]), state


# The input type whose arrival may fire each condition on its own, and those that test the orbit.
SINGLE_INPUT = {"FSC_TC": "S2_MAJA_L2A", "WICS2_TC": "S2_MAJA_L2A", "SWS_TC": "S1_NRB_L2A", "WICS1_TC": "S1_NRB_L2A"}
ORBIT_CONDITIONS = ["SWS_TC", "WICS1_TC", "WDS_TC"]
WHOLE = "Backscatter_10m_TC"
OFFERS = [(WHOLE, "IW_GRDH_1S"), *SINGLE_INPUT.items(), ("WDS_TC", "S1_NRB_L2A"), ("WDS_TC", "S2_FSC_L2B")]


def _heads(new: DataFrame, cat: Catalogue, rules: Rules, offers: list[tuple[str, str]]) -> DataFrame:
    """Inputs offered to conditions by (condition, type): recent, not validated for them and on a valid orbit and tile.

    The inputs are read once, whatever the number of conditions; one anti join on (condition, input) and one join
    on (condition, tile, orbit) serve them all. Whole GRD slices fire whatever their age and validations.
    """
    accepts = lambda c: ~F.col("is_partial") if c == WHOLE else F.col("harvesting_date") >= rules.since(c)
    offered = new.filter(F.col("product_type_code").isin(sorted({kind for _, kind in offers}))).select(
        F.explode(F.array(*[F.when((F.col("product_type_code") == kind) & accepts(c), F.lit(c)) for c, kind in offers])).alias(
            "condition"), "id", "product_type_code", "tile", "measurement_day", "relative_orbit_number", "harvesting_date").filter(
        F.col("condition").isNotNull())
    judged = sorted({c for c, _ in offers} - {WHOLE})
    taken = (validated_links(cat).filter(F.col("triggering_condition_name").isin(judged))
             .select(F.col("triggering_condition_name").alias("condition"), F.col("raw_input_id").alias("id")))
    heads = offered.join(taken, ["condition", "id"], "left_anti")
    tracks = {"SWS_TC": rules.sws_tracks, "WICS1_TC": rules.wics1_tracks, "WDS_TC": rules.wds_tracks}
    orbits = [c for c, kind in offers if c in ORBIT_CONDITIONS and kind == "S1_NRB_L2A"]
    if orbits:
        valid = reduce(DataFrame.unionByName, [tracks[c].select(
            F.lit(c).alias("condition"), "tile", F.col("orbit").alias("relative_orbit_number")) for c in orbits])
        on_orbit = valid.distinct().withColumn("on_orbit", F.lit(True))
        bound = F.col("condition").isin(orbits) & (F.col("product_type_code") == "S1_NRB_L2A")
        heads = heads.join(on_orbit, ["condition", "tile", "relative_orbit_number"], "left").filter(~bound | F.col("on_orbit"))
    if any(c == "SWS_TC" for c, _ in offers):
        listed = rules.tiles.select("tile").distinct().withColumn("listed", F.lit(True))
        heads = heads.join(listed, "tile", "left").filter((F.col("condition") != "SWS_TC") | F.col("listed"))
    return heads.select("condition", "id", "product_type_code", "tile", "measurement_day", "harvesting_date")


def trg_single(new: DataFrame, cat: Catalogue, rules: Rules, conditions: list[str] | None = None) -> DataFrame:
    """TRG-04..06 together: the conditions that bind one input."""
    offers = [(c, SINGLE_INPUT[c]) for c in conditions or SINGLE_INPUT]
    return _rows(_heads(new, cat, rules, offers), F.col("condition"), ["id"])


def trg_l2a(new: DataFrame, cat: Catalogue, rules: Rules) -> DataFrame:
    """TRG-04: L2A harvested within the limit, for snow cover and for water and ice, where not validated yet."""
    return trg_single(new, cat, rules, ["FSC_TC", "WICS2_TC"])


def trg_sws(new: DataFrame, cat: Catalogue, rules: Rules) -> DataFrame:
    """TRG-05: recent backscatter on an allowed tile and a valid orbit, not validated yet."""
    return trg_single(new, cat, rules, ["SWS_TC"])


def trg_wics1(new: DataFrame, cat: Catalogue, rules: Rules) -> DataFrame:
    """TRG-06: recent backscatter on a valid orbit of its own list, not validated yet."""
    return trg_single(new, cat, rules, ["WICS1_TC"])


def _with_partners(heads: DataFrame, partners: DataFrame, condition: str, is_nrt: Column | None = None) -> DataFrame:
    """Member rows of heads that have a partner: the head itself and one row per partner."""
    have = heads.join(partners.select("tile", "measurement_day"), ["tile", "measurement_day"], "left_semi")
    own = have.withColumn("partner_id", F.col("id"))
    other = heads.join(partners, ["tile", "measurement_day"])
    return _rows(own.unionByName(other, allowMissingColumns=True), condition, ["id"], member="partner_id", is_nrt=is_nrt)


def trg_wds_from_sig0(new: DataFrame, cat: Catalogue, rules: Rules) -> DataFrame:
    """TRG-07: recent backscatter on a valid orbit, not validated yet, with all recent FSC of its tile and day."""
    heads = _heads(new, cat, rules, [("WDS_TC", "S1_NRB_L2A")]).select("id", "tile", "measurement_day")
    fsc = _recent(_of_type(cat.raw_inputs, "S2_FSC_L2B"), rules, "WDS_TC").select(
        "tile", "measurement_day", F.col("id").alias("partner_id"))
    return _with_partners(heads, fsc, "WDS_TC")


def trg_wds_from_fsc(new: DataFrame, cat: Catalogue, rules: Rules) -> DataFrame:
    """TRG-08: recent FSC, not validated yet, with the last recent backscatter of its tile and day if its orbit is valid.

    Only that backscatter is bound, whether validated or not, and no other FSC.
    """
    fsc = _heads(new, cat, rules, [("WDS_TC", "S2_FSC_L2B")])
    pair = orbit_valid(latest_sig0(fsc, cat.raw_inputs, rules.since("WDS_TC")), rules.wds_tracks)
    member = pair.withColumn("member", F.explode(F.array("id", "sig0_id")))
    return _rows(member, "WDS_TC", ["id"], member="member")


def first_l1c_per_tile(l1c: DataFrame) -> DataFrame:
    """WIN-05: the first L1C of every tile, by day and id; a ``min`` that is combined before the shuffle."""
    return (l1c.groupBy("tile").agg(F.min(F.struct("measurement_day", "id")).alias("first"))
            .select("tile", "first.measurement_day", "first.id"))


def cc_history(cat: Catalogue, since_day: int, from_day: int = 0) -> DataFrame:
    """What is known of cloud classification per (tile, day) from a day on: pending, earlier and busy flags.

    ``pending``: a validation without task; ``earlier``: a task with a product; ``busy``: measured after a day, a
    task without dispatch or an unfinished one that returned an exit code. All flags come from one pass.
    """
    tv = cat.trigger_validation.filter(F.col("triggering_condition_name") == "CC_TC").select(F.col("id").alias("vid"))
    codes = (cat.processing_status_workflow.filter(F.col("exit_code").isNotNull())
             .select(F.col("nomad_job_dispatch_fk_id").alias("nomad_job_id")).distinct().withColumn("ended", F.lit(True)))
    runs = (cat.processingtask2nomad.join(codes, "nomad_job_id", "left").groupBy(F.col("processing_task_id").alias("task"))
            .agg(F.coalesce(F.bool_or("ended"), F.lit(False)).alias("has_code")))
    tasks = cat.processing_tasks.select(F.col("id").alias("task"), F.col("trigger_validation_fk_id").alias("vid"), "has_ended")
    made = cat.products.select(F.col("trigger_validation_fk_id").alias("vid")).distinct().withColumn("made", F.lit(True))
    state = tv.join(tasks, "vid", "left").join(made, "vid", "left").join(runs, "task", "left")
    task = F.col("task").isNotNull()
    failing = F.coalesce(~F.col("has_ended") & F.col("has_code"), F.lit(False))
    state = state.select(F.col("vid").alias("trigger_validation_id"), (~task).alias("pending"),
                         (task & F.coalesce("made", F.lit(False))).alias("earlier"),
                         (task & (F.col("has_code").isNull() | failing)).alias("busy"))
    seen = members(cat.replace(raw_inputs=cat.raw_inputs.filter(F.col("measurement_day") >= from_day)))
    return (seen.join(state, "trigger_validation_id").groupBy("tile", F.col("measurement_day").alias("seen_day"))
            .agg(F.bool_or("pending").alias("pending"), F.bool_or("earlier").alias("earlier"),
                 F.bool_or(F.col("busy") & (F.col("measurement_day") > since_day)).alias("busy")))


def _days_before(day: int, days: int) -> int:
    return day_number(dt.date(day // 10000, day // 100 % 100, day % 100) - dt.timedelta(days=days))


def trg_cc(cat: Catalogue, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """TRG-09: cloud classification of the first eligible unprocessed L1C of every tile.

    The tile is skipped while it has a pending cloud validation in the 90 days up to the day, or unfinished or
    undispatched cloud tasks. Without an earlier cloud product the L1C is bound alone, else with the most recent
    L2A. An earlier product without any L2A goes to the second result, the rejects.

    The history and the L2A are reduced to one row per tile and day and looked up together; there is one left row
    per tile, so a tile brings at most as many rows to the join as there are days. The first and last day of the
    images are computed first: 90 days before the first is a literal for the scans of L2A and history.
    """
    since = rules.earliest_day("CC_TC")
    first = written(first_l1c_per_tile(cc_eligible(unprocessed_l1c(cat.raw_inputs, cat.raw2valid), rules.tiles,
                                                   rules.since("CC_TC"), since)), "first-l1c")
    low, high = first.agg(F.min("measurement_day"), F.max("measurement_day")).first()
    low = _days_before(low, LOOK_BACK_DAYS) if low else 0
    l2a = _of_type(cat.raw_inputs, "S2_MAJA_L2A").filter(F.col("measurement_day").between(low, high or 0)).groupBy(
        "tile", F.col("measurement_day").alias("seen_day")).agg(F.max("id").alias("l2a_id"))
    seen = cc_history(cat, since, min(low, since + 1)).join(l2a, ["tile", "seen_day"], "full")
    in_range = F.col("seen_day").between(day_add("measurement_day", -LOOK_BACK_DAYS), F.col("measurement_day"))
    ready = (first.join(seen, "tile", "left").groupBy("tile", "measurement_day", "id").agg(
        F.bool_or(F.coalesce("busy", F.lit(False))).alias("busy"),
        F.bool_or(F.coalesce(F.col("pending") & in_range, F.lit(False))).alias("pending"),
        F.bool_or(F.coalesce(F.col("earlier") & in_range, F.lit(False))).alias("earlier"),
        F.max(F.when(in_range & F.col("l2a_id").isNotNull(), F.struct("seen_day", "l2a_id"))).alias("l2a"))
        .filter(~F.col("busy") & ~F.col("pending")))
    lacking = F.col("earlier") & F.col("l2a").isNull()
    bound = F.when(F.col("earlier"), F.array("id", "l2a.l2a_id")).otherwise(F.array("id"))
    good = ready.filter(~lacking).withColumn("member", F.explode(bound))
    return (_rows(good, "CC_TC", ["id"], member="member"),
            ready.filter(lacking).select("id", "tile", "measurement_day"))


def _wics1s2(cat: Catalogue, rules: Rules) -> tuple[DataFrame, DataFrame, Column]:
    """Every WICS1 not validated yet, all WICS2 as partners, and whether a head is NRT: only on the day itself."""
    ri = cat.raw_inputs
    heads = not_validated(_of_type(ri, "S1_WICS1_L2B"), cat, "WICS1S2_TC").select("id", "tile", "measurement_day")
    partners = _of_type(ri, "S2_WICS2_L2B").select("tile", "measurement_day", F.col("id").alias("partner_id"))
    return heads, partners, F.col("measurement_day") == day_number(rules.today)


def trg_wics1s2(cat: Catalogue, rules: Rules) -> DataFrame:
    """TRG-11: every WICS1 not validated yet with all WICS2 of its tile and day; NRT only on the day itself."""
    heads, partners, is_nrt = _wics1s2(cat, rules)
    return _with_partners(heads, partners, "WICS1S2_TC", is_nrt)


def shared_wics1s2(cat: Catalogue, rules: Rules) -> tuple[DataFrame, DataFrame, DataFrame]:
    """TRG-11 with the partners of a tile and day kept once, not once a head: the heads' own rows, the partner rows that a
    head has of its own id, and the partners. ``shared_links`` gives the links to all other partners.

    There are as many links as heads times partners of their tile and day, so only the links are ever that many rows.
    """
    heads, partners, is_nrt = _wics1s2(cat, rules)
    have = written(heads.join(partners.select(*_TILE_DAY), _TILE_DAY, "left_semi"), "shared-heads")
    twins = have.join(partners.withColumn("id", F.col("partner_id")), [*_TILE_DAY, "id"])
    own = _rows(have, "WICS1S2_TC", ["id"], member="id", is_nrt=is_nrt)
    return own, _rows(twins, "WICS1S2_TC", ["id"], member="partner_id", is_nrt=is_nrt), partners


#: Heads of a tile and day that one task joins with the partners.
SLICE_HEADS = 1024


def shared_links(validations: DataFrame, own: DataFrame, partners: DataFrame) -> DataFrame:
    """The links of new validations to the partners of their tile and day, see ``shared_wics1s2``.

    The heads of a tile and day are dealt over slices, to each of which its partners go. Spark does not know how many rows
    come out and would put the few that go in into a few tasks, so the number of tasks is that of the session's shuffles.
    """
    ids = validations.select(F.col("id").alias("trigger_validation_id"), "candidate_key")
    heads = own.select(*_TILE_DAY, "candidate_key", "first_id").join(ids, "candidate_key")
    slices = heads.groupBy(*_TILE_DAY).agg(F.ceil(F.count("*") / SLICE_HEADS).alias("slices"))
    tasks, by = int(own.sparkSession.conf.get("spark.sql.shuffle.partitions")), [*_TILE_DAY, "slice"]
    dealt = heads.join(slices, _TILE_DAY).withColumn("slice", F.pmod(F.xxhash64("trigger_validation_id"), "slices"))
    given = partners.join(slices, _TILE_DAY).withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
    pairs = dealt.repartition(tasks, *by).join(given.repartition(tasks, *by).hint("merge"), by)
    return pairs.filter(~F.col("partner_id").eqNullSafe(F.col("first_id"))).select(
        "trigger_validation_id", F.col("partner_id").alias("raw_input_id"))


def wds_in_sequence(heads: DataFrame, ri: DataFrame, rules: Rules, newest_first: bool = False) -> DataFrame:
    """TRG-07 and TRG-08 together: the WDS candidates that fire when their heads come one after the other, by harvest
    and id; ``heads`` are those of ``_heads``, written.

    A firing backscatter binds all FSC of its tile and day, so none of them fires afterwards. A firing FSC binds the
    last backscatter only, so that one does not fire afterwards, while others do. Hence the last backscatter fires
    unless an FSC comes before every backscatter, and an FSC fires if no backscatter has fired before it.

    The recent inputs on the heads' tiles and days are one row per tile and day: whether there is an FSC, and the
    last backscatter. Turns are one more such row, so a crowded day is combined before each shuffle.
    """
    pick, earliest = (F.max, F.greatest) if newest_first else (F.min, F.least)
    before = (lambda a, b: a > b) if newest_first else (lambda a, b: a < b)
    is_fsc, kind = F.col("product_type_code") == "S2_FSC_L2B", F.col("kind")
    recent = _recent(ri.filter(F.col("product_type_code").isin("S1_NRB_L2A", "S2_FSC_L2B")), rules, "WDS_TC")
    days = recent.join(heads.select(*_TILE_DAY).distinct(), _TILE_DAY, "left_semi").groupBy(*_TILE_DAY).agg(
        F.bool_or(is_fsc).alias("has_fsc"),
        F.max(F.when(~is_fsc, F.struct("harvesting_date", "id", "relative_orbit_number"))).alias("last"))
    on_orbit = rules.wds_tracks.select("tile", F.col("orbit").alias("last_orbit")).distinct().withColumn("on_orbit", F.lit(True))
    days = days.select(*_TILE_DAY, "has_fsc", F.col("last.id").alias("last_id"), F.col("last.relative_orbit_number").alias(
        "last_orbit")).join(on_orbit, ["tile", "last_orbit"], "left")
    able = written(heads.join(days, _TILE_DAY).filter(F.when(is_fsc, F.col("on_orbit")).otherwise(F.col("has_fsc"))).select(
        *_TILE_DAY, "id", "last_id", F.struct("harvesting_date", "id").alias("turn"),
        F.when(is_fsc, "fsc").when(F.col("id") == F.col("last_id"), "last").otherwise("sig0").alias("kind")), "wds-heads")
    turn = lambda k: pick(F.when(kind == k, F.col("turn"))).alias(f"{k}_turn")
    turns = able.groupBy(*_TILE_DAY).agg(turn("sig0"), turn("last"), turn("fsc")).withColumn(
        "last_fires", F.coalesce(~before(F.col("fsc_turn"), earliest("sig0_turn", "last_turn")), F.lit(True))).select(
        *_TILE_DAY, "last_fires", earliest("sig0_turn", F.when(F.col("last_fires"), F.col("last_turn"))).alias("closed"))
    fires = (F.when(kind == "sig0", True).when(kind == "last", F.col("last_fires"))
             .otherwise(F.coalesce(before(F.col("turn"), F.col("closed")), F.lit(True))))
    fired = able.join(turns, _TILE_DAY).filter(fires).select(*_TILE_DAY, "id", "last_id", "kind")
    sig0 = fired.filter(kind != "fsc").select("id", *_TILE_DAY).join(
        _of_type(recent, "S2_FSC_L2B").select(*_TILE_DAY, F.col("id").alias("member")), _TILE_DAY)
    own = fired.withColumn("member", F.explode(F.when(kind == "fsc", F.array("id", "last_id")).otherwise(F.array("id"))))
    return _rows(own.select("id", *_TILE_DAY, "member").unionByName(sig0), "WDS_TC", ["id"], member="member")


def trigger_all(new: DataFrame, cat: Catalogue, rules: Rules, newest_first: bool = False) -> DataFrame:
    """TRG-13: new inputs to the triggers of their type, as if one came after the other.

    Every input is offered once to each condition of its type. The heads that are left are written, as the conditions
    on one input and those on a tile and day both read them.
    """
    heads = written(_heads(new, cat, rules, OFFERS), "heads")
    single = _rows(heads.filter(F.col("condition") != "WDS_TC"), F.col("condition"), ["id"])
    return single.unionByName(wds_in_sequence(heads.filter(F.col("condition") == "WDS_TC"), cat.raw_inputs, rules, newest_first))


def catch_up_inputs(cat: Catalogue, pairs: DataFrame) -> DataFrame:
    """The inputs that lack a validation of some condition their type is paired with."""
    offered = cat.raw_inputs.select("id", "product_type_code").join(pairs, "product_type_code")
    taken = validated_links(cat).select(F.col("triggering_condition_name").alias("condition"),
                                        F.col("raw_input_id").alias("id"))
    open_ids = offered.join(taken, ["id", "condition"], "left_anti").select("id")
    return cat.raw_inputs.join(open_ids, "id", "left_semi")


def backfill(cat: Catalogue, rules: Rules, pairs: DataFrame) -> DataFrame:
    """TRG-14: the triggers over everything that lacks a validation; ``pairs`` are the ``catch_up_pairs``. The newest inputs
    come first, which decides which of several WDS fires.

    The inputs to replay are written once, as every trigger reads them.
    """
    return trigger_all(written(catch_up_inputs(cat, pairs), "catch-up"), cat, rules, newest_first=True)


def materialise(candidates: DataFrame, cat: Catalogue, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """TRG-12: candidates as validation rows (with their candidate key) and link rows.

    The row of the first member stands for the candidate. Its input decides on the NRT flag unless the trigger did.
    The candidates are written once, as the ids, the validations and the links all read them.
    """
    candidates = written(candidates, "candidates")
    heads = candidates.filter(F.col("raw_input_id") == F.col("first_id"))
    flags = is_nrt_past(cat.raw_inputs, rules.sources).select(F.col("id").alias("raw_input_id"),
                                                              F.col("is_nrt").alias("input_nrt"))
    heads = (heads.join(flags, "raw_input_id", "left").withColumn("is_nrt", F.coalesce("is_nrt", "input_nrt"))
             .withColumn("validation_date", moment(rules.as_of)))
    validations = append_validations(cat.trigger_validation, heads)
    return validations, append_members(validations, candidates)

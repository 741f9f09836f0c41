"""FLT: row selections. Plain predicates, so they reach the Parquet scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tileplan.session import moment

# Fixed values.
IDLE, ERROR = "IDLE", "ERROR"
ELIGIBLE_PRODUCTS = ["GFSC_L2C", "S1_NRB_L2A", "S1_SWS_L2B", "S1_WDS_L2B", "S1_WICS1_L2B", "S2_CC_L2B",
                     "S2_FSC_L2B", "S2_MAJA_L2A", "S2_WICS2_L2B", "COMB_WICS1S2"]
CUTOVER_DAY = 20250115


def tiles_by_state(df: DataFrame, *states: str) -> DataFrame:
    """FLT-01: tiles in one of the given states."""
    return df.filter(F.col("state").isin(*states))


def tiles_before(df: DataFrame, to, *states: str) -> DataFrame:
    """FLT-02: tiles in a state, acquired at or before a date."""
    return tiles_by_state(df, *states).filter(F.col("acquisition_date") <= moment(to))


def tiles_after(df: DataFrame, frm, *states: str) -> DataFrame:
    """FLT-03: tiles in a state, acquired at or after a date."""
    return tiles_by_state(df, *states).filter(F.col("acquisition_date") >= moment(frm))


def tiles_between(df: DataFrame, frm, to, *states: str) -> DataFrame:
    """FLT-04: tiles in a state, acquired between two dates, both included."""
    return tiles_by_state(df, *states).filter(F.col("acquisition_date").between(moment(frm), moment(to)))


def harvest_selection(df: DataFrame, frm=None, to=None) -> DataFrame:
    """FLT-05: idle and failed tiles to harvest; the dates given decide the range. One scan for both states."""
    if frm is not None and to is not None:
        return tiles_between(df, frm, to, IDLE, ERROR)
    if frm is not None:
        return tiles_after(df, frm, IDLE, ERROR)
    if to is not None:
        return tiles_before(df, to, IDLE, ERROR)
    return tiles_by_state(df, IDLE, ERROR)


def inputs_by_path(ri: DataFrame, path: str) -> DataFrame:
    """FLT-06: inputs stored at a path."""
    return ri.filter(F.col("input_path") == path)


def inputs_by_day(ri: DataFrame, day: int) -> DataFrame:
    """FLT-07: inputs measured on a day; prunes partitions of a table laid out by day."""
    return ri.filter(F.col("measurement_day") == day)


def tasks_not_finished(pt: DataFrame) -> DataFrame:
    """FLT-08: tasks not ended; an unknown end state does not count."""
    return pt.filter(~F.col("has_ended"))


def cc_eligible(l1c: DataFrame, tiles: DataFrame, earliest_publication, earliest_day) -> DataFrame:
    """FLT-09: L1C on an allowed tile, published and measured at or after the limits of the CC condition.

    The limits are a timestamp and a day yyyymmdd, so both reach the scan.
    """
    in_time = (F.col("publishing_date") >= earliest_publication) & (F.col("measurement_day") >= earliest_day)
    return l1c.filter(in_time).join(tiles.select("tile"), "tile", "left_semi").select(*l1c.columns)


def orbit_valid(ri: DataFrame, tracks: DataFrame) -> DataFrame:
    """FLT-10: inputs whose orbit is valid on their tile; an unknown tile or orbit has none."""
    valid = tracks.select("tile", F.col("orbit").alias("relative_orbit_number"))
    return ri.join(valid, ["tile", "relative_orbit_number"], "left_semi").select(*ri.columns)


def eligible_products(products: DataFrame) -> DataFrame:
    """FLT-11: products of the types that may become inputs."""
    return products.filter(F.col("product_type_code").isin(ELIGIBLE_PRODUCTS))


def by_flavour(tasks: DataFrame, flavour: str) -> DataFrame:
    """FLT-12: tasks of one machine flavour."""
    return tasks.filter(F.col("flavour") == flavour)


def cutover(tasks: DataFrame, day: int = CUTOVER_DAY, archive: bool = False) -> DataFrame:
    """FLT-13: current tasks from the cut-over day on, or archive tasks before it."""
    measured = F.col("measurement_day")
    return tasks.filter(measured < day if archive else measured >= day)

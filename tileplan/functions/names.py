"""PRJ-01..05: file and product names to columns, by splitting on the name's own separators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tileplan.functions.scalars import base_name

# Position of each part in the name layouts, counted from 0.
L2B_TYPES = ["S2_WICS2_L2B", "S2_FSC_L2B", "S1_WDS_L2B", "S1_SWS_L2B", "S1_WICS1_L2B", "S2_CC_L2B"]


def _part(name: Column, i: int, sep: str = "_") -> Column:
    return F.get(F.split(name, sep), F.lit(i))


def _time(text: Column, fmt: str) -> Column:
    return F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")


def _after_letter(text: Column) -> Column:
    return F.substr(text, F.lit(2))


def _number(text: Column, kind: str = "bigint") -> Column:
    return text.try_cast(kind)


def grd_fields(p: Column) -> Column:
    return F.struct(F.get(p, F.lit(0)).alias("mission"), F.get(p, F.lit(4)).alias("start"),
                    F.get(p, F.lit(5)).alias("stop"), F.get(p, F.lit(7)).alias("acquisition_id"))


def l1c_fields(p: Column) -> Column:
    stamp = F.get(p, F.lit(2))
    return F.struct(F.get(p, F.lit(0)).alias("mission"), F.substring_index(stamp, "T", 1).alias("day"),
                    stamp.alias("stamp"), _after_letter(F.get(p, F.lit(5))).alias("tile"))


def l2a_fields(p: Column) -> Column:
    mission, moment_ = F.get(p, F.lit(0)), F.get(p, F.lit(1))
    return F.struct(mission.alias("mission"), F.concat(F.lit("S2"), F.right(mission, F.lit(1))).alias("short_mission"),
                    F.substring_index(moment_, "-", 1).alias("day"),
                    F.substring_index(F.substring_index(moment_, "-", 2), "-", -1).alias("time"),
                    _after_letter(F.get(p, F.lit(3))).alias("tile"))


def sig0_fields(p: Column) -> Column:
    stamp = F.get(p, F.lit(1))
    return F.struct(F.try_element_at(p, F.lit(-2)).substr(1, 3).alias("mission"),
                    F.substring_index(stamp, "T", 1).alias("day"), F.substring_index(stamp, "T", -1).alias("time"),
                    _after_letter(F.get(p, F.lit(5))).alias("tile"), F.get(p, F.lit(4)).alias("orbit"))


def name_parts(name: str | Column) -> Column:
    """The parts of a name; keep them in a column where several fields are read from one name."""
    return F.split(name, "_")


def parse_grd(path: str | Column) -> Column:
    """PRJ-02: mission, start, stop and acquisition id of a GRD file."""
    return grd_fields(name_parts(base_name(path)))


def parse_l1c(name: Column) -> Column:
    """PRJ-03: mission, day, time text and tile of an L1C image."""
    return l1c_fields(name_parts(name))


def parse_l2a(name: Column) -> Column:
    """PRJ-04: mission, short mission, day, time and tile of an L2A product."""
    return l2a_fields(name_parts(name))


def parse_sig0(name: Column) -> Column:
    """PRJ-05: mission, day, time, tile and orbit of a backscatter product."""
    return sig0_fields(name_parts(name))


def _product_fields() -> dict[str, Column]:
    """Tile, day, start time and orbit by product type; null where the type or the name does not fit."""
    name, kind = F.col("id"), F.col("product_type_code")
    p1, p5 = _part(name, 1), _part(name, 5)
    maja, sig0 = kind == "S2_MAJA_L2A", kind == "S1_NRB_L2A"
    l2b, comb, gfsc = kind.isin(L2B_TYPES), kind == "COMB_WICS1S2", kind == "GFSC_L2C"
    stamp = "yyyyMMdd'T'HHmmss"
    tile_part = F.when(maja, _part(name, 3)).when(sig0, p5).when(l2b | comb | gfsc, _part(name, 4))
    day_text = (F.when(maja | gfsc, F.when(maja, p1).otherwise(p5).substr(1, 8))
                .when(sig0, F.split_part(p1, F.lit("T"), F.lit(1)))
                .when(l2b | comb, F.split_part(p5, F.lit("T"), F.lit(1))))
    cut = lambda n: F.left(p5, F.length(p5) - n)
    start = (F.when(maja, _time(p1, "yyyyMMdd-HHmmss-SSS"))
             .when(sig0, _time(p1, stamp))
             .when(l2b, _time(p5, stamp))
             .when(comb, _time(cut(4), stamp))
             .when(gfsc, _time(cut(3), "yyyyMMdd")))
    return {
        "start_date": start,
        "tile": _after_letter(tile_part),
        "measurement_day": _number(day_text),
        "relative_orbit_number": F.when(sig0, _number(_part(name, 4), "int")),
    }


def products_to_inputs(products: DataFrame, harvested_at: Column | None = None) -> DataFrame:
    """PRJ-01: product rows as raw input rows, by the layout of their type's name.

    Rows whose type is unknown or whose name does not parse are left to ``product_rejects``.
    """
    good = _with_fields(products).filter(_parsed())
    return good.select(
        "id", "product_type_code", "start_date", F.col("catalogue_date").alias("publishing_date"), "tile",
        "measurement_day", F.col("product_path").alias("input_path"), "is_partial", "relative_orbit_number",
        (F.lit(None).cast("timestamp_ntz") if harvested_at is None else harvested_at).alias("harvesting_date"))


def product_rejects(products: DataFrame) -> DataFrame:
    """PRJ-01: the products that cannot become inputs."""
    return _with_fields(products).filter(~_parsed()).select("id", "product_type_code")


def refused_products(products: DataFrame) -> DataFrame:
    """PRJ-01, SNK-01: the product rows that cannot be stored as inputs, with a reason: ``no id``, which is also the name,
    or ``name``, whose type is unknown or which lacks a field."""
    reason = F.when(F.col("id").isNull(), "no id").when(~_parsed(), "name")
    kept = [c for c in products.columns if c != "is_partial"]
    return _with_fields(products).withColumn("reason", reason).where("reason IS NOT NULL").select(*kept, "reason")


def _with_fields(products: DataFrame) -> DataFrame:
    """Products with the parsed fields. They pass through a one-element array, so that a filter on them is not
    pushed below and the names are parsed once per row."""
    partial = (F.coalesce("is_partial", F.lit(False)) if "is_partial" in products.columns else F.lit(False))
    fields = F.struct(*[c.alias(n) for n, c in _product_fields().items()], partial.alias("is_partial"))
    kept = [c for c in products.columns if c != "is_partial"]
    return products.select(*kept, F.explode(F.array(fields)).alias("f")).select(*kept, "f.*")


def _parsed() -> Column:
    ok = F.col("start_date").isNotNull() & F.col("measurement_day").isNotNull() & (F.length("tile") > 0)
    orbit = (F.col("product_type_code") != "S1_NRB_L2A") | F.col("relative_orbit_number").isNotNull()
    return F.coalesce(ok & orbit, F.lit(False))

"""SRC-04..07: parameter files and listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tileplan.functions.scalars import dashed_day



def _ring(ring: Column) -> Column:
    return F.concat(F.lit("("), F.array_join(F.transform(ring, lambda p: F.array_join(p, " ")), ", "), F.lit(")"))


def read_tile_geometry(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC-04: GeoJSON features as (tile, geom) in WKT, and the features that could not be read.

    A Polygon keeps its first ring only, a MultiPolygon all rings; any other type is rejected. The geometry of a
    feature is read as text and its coordinates parsed by type, as the depth of the arrays depends on it.
    """
    features = (spark.read.option("multiLine", True)
                .schema("features ARRAY<STRUCT<properties: STRUCT<Name: STRING>, "
                        "geometry: STRUCT<type: STRING, coordinates: STRING>>>")
                .json(path).select(F.explode("features").alias("f"))
                .select(F.col("f.properties.Name").alias("tile"), F.col("f.geometry.type").alias("type"),
                        F.col("f.geometry.coordinates").alias("coordinates")))
    polygon = F.from_json("coordinates", "array<array<array<string>>>")
    multi = F.from_json("coordinates", "array<array<array<array<string>>>>")
    polygons = F.transform(multi, lambda p: F.concat(F.lit("("), F.array_join(F.transform(p, _ring), ", "), F.lit(")")))
    geom = (F.when(F.col("type") == "Polygon", F.concat(F.lit("POLYGON Z("), _ring(F.get(polygon, F.lit(0))), F.lit(")")))
            .when(F.col("type") == "MultiPolygon",
                  F.concat(F.lit("MULTIPOLYGON Z("), F.array_join(polygons, ", "), F.lit(")"))))
    out = features.withColumn("geom", geom)
    return (out.filter(F.col("geom").isNotNull()).select("tile", "geom"),
            out.filter(F.col("geom").isNull()).select("tile", "type"))


def tile_tracks(lines: DataFrame, column: str = "value") -> DataFrame:
    """SRC-05: lines ``TILE: orbit orbit`` as (tile, orbit), with the tile's first letter dropped.

    The orbits may be one number, several separated by blanks, or a list in brackets. They are decimal text,
    also with leading zeros.
    """
    text = F.col(column)
    tile = F.regexp_extract(text, r"^\s*['\"]?T?([0-9A-Z]+)['\"]?\s*:", 1)
    orbits = F.regexp_extract_all(F.regexp_extract(text, r":(.*)$", 1), F.lit(r"(\d+)"))
    return (lines.select(tile.alias("tile"), F.explode(orbits).alias("orbit"))
            .filter(F.col("tile") != "").select("tile", F.col("orbit").cast("int").alias("orbit")))


def read_tile_tracks(spark: SparkSession, path: str) -> DataFrame:
    """SRC-05: the valid orbits per tile of a file."""
    return tile_tracks(spark.read.text(path))


def tile_names(lines: DataFrame, column: str = "value") -> DataFrame:
    """SRC-06: tiles of a list, one per line, with or without a leading dash."""
    tile = F.regexp_extract(F.col(column), r"^\s*-?\s*['\"]?([0-9A-Z]+)['\"]?\s*$", 1)
    return lines.select(tile.alias("tile")).filter(F.col("tile") != "").distinct()


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    """SRC-06: the allowed tiles of a file."""
    return tile_names(spark.read.text(path))


def auxiliary_paths(tasks: DataFrame) -> DataFrame:
    """Auxiliary data each task needs: (task, day, folder, file); a folder is enough for CC, WICS1 needs two files."""
    day = F.col("measurement_day").cast("string")
    folder = F.concat(F.lit("CAMS/"), F.replace(dashed_day("measurement_day"), F.lit("-"), F.lit("/")), F.lit("/"))
    need = F.when(F.col("processing_routine_name") == "CC", F.array(folder)).when(
        F.col("processing_routine_name") == "WICS1",
        F.array(F.concat(F.lit("FMI_WINDSPEED/"), day, F.lit("_wind_speed.nc")),
                F.concat(F.lit("FMI_TEMPERATURE/"), day, F.lit("_t2m_sum.nc"))))
    return tasks.withColumn("needed", F.explode(need))


def aux_ready(tasks: DataFrame, listing: DataFrame) -> DataFrame:
    """SRC-07: the tasks whose auxiliary data is in the listing; the others are held back.

    A path counts under its own name and under its folder, so one anti join answers both kinds of need. What is
    needed depends on routine and day only, so the listing is checked once per such pair, not once per task.
    """
    at_hand = listing.select(F.explode(F.array(
        "path", F.regexp_replace("path", r"[^/]*$", ""))).alias("needed"))
    pairs = tasks.select("processing_routine_name", "measurement_day").distinct()
    lacking = (auxiliary_paths(pairs).join(at_hand, "needed", "left_anti")
               .select("processing_routine_name", "measurement_day"))
    return tasks.join(lacking, ["processing_routine_name", "measurement_day"], "left_anti").select(*tasks.columns)

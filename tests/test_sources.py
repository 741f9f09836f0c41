"""Files, parameters, sinks and the integrity report on hand-made rows."""

import json

import pytest
from helpers import catalogue, raw, sets, table
from pyspark.sql import functions as F

from tileplan.sources import files, sinks
from tileplan.sources.catalogue import load_catalogue, write_table
from tileplan.sources.reference import launcher_tiles, reference_tables, run_params


def test_reference_tables(spark):
    cat = reference_tables(spark)
    sizes = {"raster_type": 12, "processing_routine": 9, "triggering_condition": 9, "processing_status": 6,
             "log_levels": 5, "sources": 3, "launcher_config": 3}
    assert {n: getattr(cat, n).count() for n in sizes} == sizes
    params = run_params(cat.launcher_config).first()
    assert (params.waiting_seconds, params.interval_months, params.interval_days) == (600, 1, 15)
    assert sets(launcher_tiles(cat.launcher_config), "tile") == [("32TPR",), ("32TPS",)]


def test_tile_geometry(spark, tmp_path):
    ring = [[0, 0, 1], [1, 0, 1], [1, 1, 1], [0, 0, 1]]
    hole = [[0.2, 0.2, 1], [0.3, 0.2, 1], [0.2, 0.2, 1]]
    feature = lambda name, kind, c: {"type": "Feature", "properties": {"Name": name},
                                     "geometry": {"type": kind, "coordinates": c}}
    path = tmp_path / "tiles.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [
        feature("A", "Polygon", [ring, hole]), feature("B", "MultiPolygon", [[ring, hole], [ring]]),
        feature("C", "Point", [0, 0, 1])]}))
    good, bad = files.read_tile_geometry(spark, str(path))
    wkt = dict(sets(good, "tile", "geom"))
    ring_text, hole_text = "(0 0 1, 1 0 1, 1 1 1, 0 0 1)", "(0.2 0.2 1, 0.3 0.2 1, 0.2 0.2 1)"
    assert wkt == {"A": f"POLYGON Z({ring_text})", "B": f"MULTIPOLYGON Z(({ring_text}, {hole_text}), ({ring_text}))"}
    assert sets(bad, "tile", "type") == [("C", "Point")]


def test_tile_tracks_and_tiles(spark, tmp_path):
    (tmp_path / "tracks").write_text("T26WPS: 016 155\nT27ABC: 8\nT28ABC: [001, 002]\n# none\n")
    assert sets(files.read_tile_tracks(spark, str(tmp_path / "tracks")), "tile", "orbit") == [
        ("26WPS", 16), ("26WPS", 155), ("27ABC", 8), ("28ABC", 1), ("28ABC", 2)]
    (tmp_path / "tiles").write_text("- 32TPR\n- 32TPS\n- 32TPS\n")
    assert sets(files.read_tiles(spark, str(tmp_path / "tiles")), "tile") == [("32TPR",), ("32TPS",)]


def test_aux_ready(spark):
    tasks = spark.createDataFrame([(1, "CC", 20250126), (2, "CC", 20250127), (3, "WICS1", 20250126),
                                   (4, "WICS1", 20250127), (5, "FSC", 20250127)],
                                  "processing_task_id INT, processing_routine_name STRING, measurement_day BIGINT")
    listing = spark.createDataFrame([("CAMS/2025/01/26/a.nc",), ("FMI_WINDSPEED/20250126_wind_speed.nc",),
                                     ("FMI_TEMPERATURE/20250126_t2m_sum.nc",), ("FMI_WINDSPEED/20250127_wind_speed.nc",)],
                                    "path STRING")
    assert sets(files.aux_ready(tasks, listing), "processing_task_id") == [(1,), (3,), (5,)]


def test_catalogue_round_trip(spark, tmp_path):
    rows = table(spark, "raw_inputs", [raw("a", "S2MSI1C"), raw("b", "S2MSI1C", day=20250129)])
    write_table(rows, str(tmp_path), "raw_inputs")
    back = load_catalogue(spark, str(tmp_path)).raw_inputs
    assert sets(back, *rows.columns) == sets(rows, *rows.columns)
    plan = back.filter("measurement_day = 20250129")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(measurement_day" in plan


def test_insert_ignore_keeps_the_first(spark):
    target = table(spark, "raw_inputs", [raw("a", "S2MSI1C")])
    new = table(spark, "raw_inputs", [raw("a", "S2MSI1C"), raw("b", "S2MSI1C", at="2025-01-30 07:00:00", path="late"),
                                      raw("b", "S2MSI1C", path="z"), raw("b", "S2MSI1C", path="y")])
    assert sets(sinks.insert_ignore(target, new, "id"), "id", "input_path") == [("b", "y")]
    nothing = sinks.insert_ignore(new, new, "id")
    assert nothing.count() == 0


def test_rows_without_key_are_not_inserted_and_not_lost(spark):
    new = table(spark, "raw_inputs", [{**raw("a", "S2MSI1C"), "id": None, "input_path": p} for p in "xy"] + [raw("b", "S2MSI1C")])
    assert sets(sinks.insert_ignore(new.limit(0), new, "id"), "id") == [("b",)]
    assert sets(sinks.keyless(new, "id"), "input_path") == [("x",), ("y",)]


def test_numbering_is_dense(spark):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    ids = sinks.numbered(rows, "k", spark.range(10).select("id"))
    got = sorted(r.id for r in ids.collect())
    assert got == list(range(10, 5010))
    again = sinks.numbered(rows.repartition(3), "k", spark.range(10).select("id"))
    assert sets(ids, "k", "id") == sets(again, "k", "id")


def test_update_params(spark):
    cat = reference_tables(spark)
    set_ = sinks.update_params(cat.sources, "GRD_TC/NRT-3h", {"nrt_harvest_start_date": "20250101"})
    assert sets(set_.filter("nrt_harvest_start_date IS NOT NULL"), "timeliness") == [("NRT-3h",)]
    assert sinks.update_params(set_, "GRD_TC/NRT-3h", {"nrt_harvest_start_date": None}).filter(
        "nrt_harvest_start_date IS NOT NULL").count() == 0
    assert sinks.set_last_day(cat.triggerer_config, "GFSC_L2C", 20250102).first().last_processing_date == 20250102


def test_constraint_report(spark):
    cat = catalogue(
        spark, raw_inputs=[raw("a", "S2MSI1C"), raw("a", "S2MSI1C"), {**raw("b", "NOPE"), "tile": None}],
        raw2valid=[{"trigger_validation_id": 9, "raw_input_id": "a"}])
    found = {(r.table_name, r.rule, r.column_name): r.violations
             for r in sinks.constraint_report(cat, ["raw_inputs", "raw2valid"]).collect() if r.violations}
    assert found == {("raw_inputs", "unique", "id"): 1, ("raw_inputs", "not_null", "tile"): 1,
                     ("raw_inputs", "reference", "product_type_code"): 1,
                     ("raw2valid", "reference", "trigger_validation_id"): 1}


@pytest.mark.parametrize("mode,expected", [("NRT", 3), ("ARCHIVE", 0)])
def test_harvest_windows(spark, mode, expected):
    from tileplan.plans.planning import harvest_windows

    df = sinks.update_params(reference_tables(spark).sources, "L1C_TC", {
        "nrt_harvest_start_date": "20250129", "archive_harvest_start_date": "20250110",
        "archive_harvest_end_date": "20250105"})
    windows = harvest_windows(df, mode, "2025-01-31 10:00:00")
    assert windows.count() == expected
    if expected:
        assert max(str(r.window_end) for r in windows.collect()) == "2025-02-01"

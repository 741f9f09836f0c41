"""Crowded keys give whole results, and plans have the shape they are meant to have."""

from collections import Counter

import pytest
from helpers import AS_OF, catalogue, raw, rules, sets
from pyspark.sql import functions as F

from tileplan import registry
from tileplan.operators import inputs as op_inputs, status as op_status
from tileplan.plans import gapfill, manifests as man, triggers as trg

registry.load()
ROOT = "/root/testdata/sf0.001"
N = 2000


def crowd(spark, kind, n=N, prefix="x"):
    """Many inputs of one type on one tile and day."""
    one = catalogue(spark, raw_inputs=[raw("seed", kind, orbit=9, partial=kind == "IW_GRDH_1S")]).raw_inputs
    return one.crossJoin(spark.range(n).select(F.format_string(prefix + "%06d", "id").alias("n"))).withColumn(
        "id", F.col("n")).drop("n")


def test_one_tile_and_day_holds_everything(spark):
    sig0 = crowd(spark, "S1_NRB_L2A", 3, "s")
    ri = crowd(spark, "S2_FSC_L2B").unionByName(sig0)
    cat = catalogue(spark).replace(raw_inputs=ri)
    made = trg.trg_wds_from_sig0(sig0, cat, rules(spark)).groupBy("first_id").count()
    assert sets(made, "count") == [(N + 1,)] * 3
    back = trg.trg_wds_from_fsc(ri, cat, rules(spark))
    assert back.count() == 2 * N and back.filter("raw_input_id LIKE 's%'").select("raw_input_id").distinct().count() == 1


def test_one_grd_group_holds_everything(spark):
    ri = crowd(spark, "IW_GRDH_1S")
    cat = catalogue(spark).replace(raw_inputs=ri.withColumn("input_path", F.when(
        F.col("id") == "x000000", "s3://E/S1A_IW_GRDH_1SDV_20250130T060000_20250130T060020_1_2_3.SAFE").otherwise(
        "s3://E/S1A_IW_GRDH_1SDV_20250130T060020_20250130T060040_1_2_3.SAFE")))
    pairs = trg.trg_sig0_pairs(cat.raw_inputs, cat.raw2valid, AS_OF)
    assert pairs.count() == N and sets(pairs.select("first_id").distinct(), "first_id") == [("x000000",)]


def test_one_tile_holds_all_l1c(spark):
    days = F.expr("20250101 + CAST(substr(id, 2) AS BIGINT) % 28")
    ri = crowd(spark, "S2MSI1C").withColumn("measurement_day", days).unionByName(
        crowd(spark, "S2_MAJA_L2A", 50, "m").withColumn("measurement_day", F.lit(20241010).cast("bigint")))
    l1c = ri.filter("product_type_code = 'S2MSI1C'")
    found = op_inputs.latest_l2a(l1c, ri)
    expected = l1c.filter("measurement_day <= 20250108").count()  # 10 October + 90 days = 8 January
    assert found.count() == expected and sets(found.select("l2a_id").distinct(), "l2a_id") == [("m000049",)]


def test_one_set_holds_everything(spark):
    sws = crowd(spark, "S1_SWS_L2B")
    cat = catalogue(spark, trigger_validation=[{"id": v, "triggering_condition_name": "GFSC_TC",
                                                "artificial_measurement_day": 20250130} for v in (1, 2)])
    links = sws.select(F.lit(1).cast("bigint").alias("trigger_validation_id"), F.col("id").alias("raw_input_id"))
    short = links.filter("raw_input_id <> 'x000000'").withColumn("trigger_validation_id", F.lit(2).cast("bigint"))
    mine = sws.select(F.lit("k").alias("candidate_key"), F.lit("GFSC_TC").alias("condition"),
                      F.lit(20250130).cast("bigint").alias("day"), F.col("id").alias("raw_input_id"))
    assert gapfill.exact_set_exists(mine, cat.replace(raw2valid=links)).count() == 1
    assert gapfill.exact_set_exists(mine, cat.replace(raw2valid=short)).count() == 0


def test_one_task_holds_all_inputs(spark):
    rows = spark.range(N).select(
        F.lit(1).cast("bigint").alias("processing_task_id"), F.lit("GFSC").alias("processing_routine_name"),
        F.format_string("i%d", "id").alias("raw_input_id"), F.lit("32TMP").alias("tile"),
        F.lit(20250130).cast("bigint").alias("measurement_day"), F.lit(None).cast("int").alias("relative_orbit_number"),
        F.lit(20250130).cast("bigint").alias("processing_date"), F.format_string("s3://B/CLMS_WSI_FSC_%d", "id").alias("input_path"))
    keys = Counter(r.key for r in man.manifests(rows, AS_OF).collect())
    assert keys.pop("input.FSC") == N and set(keys.values()) == {1}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in registry.QUERIES if n[:3] in ("jon", "agg", "win")))
def test_no_cartesian_product_or_python(spark, name):
    text = plan(registry.QUERIES[name](spark, ROOT))
    assert "CartesianProduct" not in text and "Python" not in text


def test_filters_and_columns_reach_the_scan(spark, tmp_path, fx):
    from tileplan.sources.catalogue import scan, write_table

    write_table(fx.raw_inputs, str(tmp_path), "raw_inputs")
    ri = scan(spark, str(tmp_path), "raw_inputs")
    text = plan(op_inputs.unprocessed_grd(ri, fx.raw2valid, "2024-01-31 00:00:00").select("id"))
    assert "EqualTo(product" in text and "harvesting_date#" in text.split("DataFilters")[0]
    assert "ReadSchema: struct<id:string,product_type_code:string,is_partial:boolean,harvesting_date:timestamp_ntz>" in text
    pairs = plan(op_status.wic_pairs(ri))
    assert "ReadSchema: struct<id:string,product_type_code:string,tile:string>" in pairs


def test_ranks_are_limited_before_the_shuffle(spark, fx):
    text = plan(trg.grd_pairs(trg._open_grd(fx.raw_inputs, fx.raw2valid, "2024-01-07 00:00:00")))
    partial = [i for i, line in enumerate(text.splitlines()) if "WindowGroupLimit" in line and "Partial" in line]
    assert partial

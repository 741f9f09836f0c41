"""Names and scalar expressions, with the values the layouts are documented with."""

import datetime as dt

from helpers import ts
from pyspark.sql import functions as F

from tileplan.functions import names, scalars as s
from tileplan.schemas import SCHEMAS


def products(spark, rows):
    return spark.createDataFrame(
        [(i, 1, kind, f"s3://HR/{i}", ts("2025-01-01 00:00:00"), ts("2025-01-02 00:00:00"), None) for i, kind in rows],
        SCHEMAS["products"])


def test_products_to_inputs(spark):
    rows = {r.id: r for r in names.products_to_inputs(products(spark, [
        ("SENTINEL2B_20210202-124336-333_L2A_T28WET_C_V1-0_FRE_B11", "S2_MAJA_L2A"),
        ("SIG0_20210102T074131_20210102T074200_043635_009_T28WET_10m_S1AIWGRDH_ENVEO", "S1_NRB_L2A"),
        ("CLMS_WSI_CC_020m_T32TMP_20241211T102339_S2B_V100", "S2_CC_L2B"),
        ("CLMS_WSI_WIC_020m_T32TMP_20241211T120000P12H_COMB_V100", "COMB_WICS1S2"),
        ("CLMS_WSI_GFSC_060m_T28WET_20200801P7D_COMB_V102", "GFSC_L2C")])).collect()}
    by = {r.product_type_code: r for r in rows.values()}
    assert (by["S2_MAJA_L2A"].tile, by["S2_MAJA_L2A"].measurement_day) == ("28WET", 20210202)
    assert by["S2_MAJA_L2A"].start_date == dt.datetime(2021, 2, 2, 12, 43, 36, 333000)
    assert (by["S1_NRB_L2A"].tile, by["S1_NRB_L2A"].relative_orbit_number) == ("28WET", 9)
    assert by["S1_NRB_L2A"].start_date == dt.datetime(2021, 1, 2, 7, 41, 31)
    assert by["S2_CC_L2B"].start_date == dt.datetime(2024, 12, 11, 10, 23, 39)
    assert by["COMB_WICS1S2"].start_date == dt.datetime(2024, 12, 11, 12)
    assert (by["GFSC_L2C"].start_date, by["GFSC_L2C"].measurement_day) == (dt.datetime(2020, 8, 1), 20200801)
    assert all(r.is_partial is False and r.publishing_date == ts("2025-01-02 00:00:00") for r in rows.values())


def test_product_rejects(spark):
    bad = [("X_Y", "S2_MAJA_L2A"), ("CLMS_WSI_GFSC_060m_T28WET_202008017D_COMB_V102_GF-QA", "GFSC_L2C"),
           ("anything", "UNKNOWN"), ("SIG0_20210102T074131_2_3_x_T28WET_10m_S1A_E", "S1_NRB_L2A")]
    df = products(spark, bad + [("CLMS_WSI_CC_020m_T32TMP_20241211T102339_S2B_V100", "S2_CC_L2B")])
    assert {r.id for r in names.product_rejects(df).collect()} == {i for i, _ in bad}
    assert names.products_to_inputs(df).count() == 1


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_image_names(spark):
    grd = one(spark, names.parse_grd(F.lit(
        "s3://E/S1A_IW_GRDH_1SDV_20211227T052658_20211227T052723_041190_04E503_C194.SAFE")))
    assert tuple(grd) == ("S1A", "20211227T052658", "20211227T052723", "04E503")
    l1c = one(spark, names.parse_l1c(F.lit("S2B_MSI1C_20200905T124309_N0500_R095_T28WET_20230328T093834.SAFE")))
    assert (l1c.mission, l1c.day, l1c.tile) == ("S2B", "20200905", "28WET")
    l2a = one(spark, names.parse_l2a(F.lit("SENTINEL2B_20201215-103755-817_L2A_T32TMS_C_V1-0")))
    assert tuple(l2a) == ("SENTINEL2B", "S2B", "20201215", "103755", "32TMS")
    sig0 = one(spark, names.parse_sig0(F.lit(
        "SIG0_20210102T074131_20210102T074200_043635_009_T28WET_10m_S1AIWGRDH_ENVEO")))
    assert tuple(sig0) == ("S1A", "20210102", "074131", "28WET", "009")


def test_scalars(spark):
    assert one(spark, s.day_add(F.lit(20240301), -1)) == 20240229
    assert one(spark, s.day_add(F.lit(20250105), -90)) == 20241007
    assert one(spark, s.dashed_day(F.lit(20250115))) == "2025-01-15"
    assert one(spark, s.path_name(F.lit("s3://a/b/c/"))) == "c" and one(spark, s.base_name(F.lit("s3://a/b/c/"))) == ""
    assert one(spark, s.path_dir(F.lit("s3://a/b"))) == one(spark, s.path_dir(F.lit("s3://a/b/"))) == "s3://a/b/"
    assert [one(spark, s.pad_orbit(F.lit(n))) for n in (7, 16, 155, 1234)] == ["007", "016", "155", "1234"]
    assert one(spark, s.ns_time(F.lit(1704067205 * 10**9 + 999999999))) == "2024-01-01T00:00:05"
    age = one(spark, s.age_seconds(F.lit(None).cast("bigint"), F.lit(1704067200 * 10**9), "2024-01-01 01:00:00"))
    assert age == 3600.0
    assert one(spark, s.age_seconds(F.lit(None).cast("bigint"), F.lit(None).cast("bigint"), "2024-01-01 01:00:00")) is None
    assert one(spark, s.map_run_state(F.lit("lost"))) is None
    assert one(spark, s.normalise_code(F.lit("HMA.LARGE"), "flavour")) == "hma.large"
    image = one(spark, s.image_parts(F.lit("host.org:443/a/b/fsc:1.0")))
    assert tuple(image) == ("host.org", "443", "a/b/fsc", "1.0")
    assert one(spark, s.image_text(*[F.lit(x) for x in image])) == "host.org:443/a/b/fsc:1.0"


def test_l1c_product_date(spark):
    xml = ("<gmd:x xmlns:gmd='m' xmlns:gml='g'><gml:beginPosition>2025-01-01T10:00:00</gml:beginPosition>"
           "<gml:endPosition>2025-01-01T11:00:00</gml:endPosition></gmd:x>")
    at = lambda name, text=xml: one(spark, s.l1c_product_date(F.lit(text), F.lit(name)))
    assert at("20250101T103000") == "20250101T103000"
    assert at("20250101T093000") == "20250101T100000"
    assert at("20250101T100000") == "20250101T100000"  # the begin itself is not inside, and is the result anyway
    assert at("20250101T110000") == "20250101T100000"
    assert at("20250101T103000", "<a/>") is None


def test_harvest_dates(spark):
    row = ("GRD_TC", "IW_GRDH_1S", "S1", 5, 5, None, None, None, "NRT-3h", "20240110", "", "20240120T00")
    df = spark.createDataFrame([row], SCHEMAS["sources"])
    assert tuple(s.harvest_dates(df, "NRT").first()) == ("GRD_TC/NRT-3h", dt.date(2024, 1, 10), None)
    assert tuple(s.harvest_dates(df, "ARCHIVE").first()) == ("GRD_TC/NRT-3h", None, dt.date(2024, 1, 20))


def test_nrt_flag_with_null_dates(spark):
    df = spark.createDataFrame([(None, None)], "publishing_date TIMESTAMP_NTZ, harvesting_date TIMESTAMP_NTZ")
    assert df.select(s.is_nrt_now().alias("v")).first().v is False

"""SRC-02 and SRC-03: code tables with their rows, and run parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tileplan.catalogue import Catalogue
from tileplan.schemas import SCHEMAS, struct
from tileplan.session import small_table

IMAGE_HOST = "registry.example.org:443/production"

# Code tables.
_ROWS = {
    "raster_type": [
        ("S2_MAJA_L2A", "Sentinel-2 surface reflectance", "L2A"),
        ("S2_FSC_L2B", "Fractional Snow Cover", "L2B"),
        ("IW_GRDH_1S", "Sentinel-1 level-1 ground range, VV and VH", "L1S"),
        ("S2MSI1C", "Sentinel-2 level-1C image", "L1C"),
        ("S2_CC_L2B", "Cloud Classification", "L2B"),
        ("S2_WICS2_L2B", "Water and Ice Cover from Sentinel-2", "L2B"),
        ("S1_WICS1_L2B", "Water and Ice Cover from Sentinel-1", "L2B"),
        ("S1_WDS_L2B", "Wet and Dry Snow", "L2B"),
        ("S1_NRB_L2A", "Sentinel-1 normalised backscatter, 10 m", "L2A"),
        ("S1_SWS_L2B", "SAR Wet Snow", "L2B"),
        ("GFSC_L2C", "Gap-filled Fractional Snow Cover", "L2C"),
        ("COMB_WICS1S2", "Combined Water and Ice Cover", "L2C"),
    ],
    "processing_routine": [
        ("FSC", "S2_FSC_L2B", 4, 29879, 16, 10, f"{IMAGE_HOST}/fsc:1.0", "hma.large"),
        ("CC", "S2_CC_L2B", 4, 29879, 32, 13, f"{IMAGE_HOST}/cc:1.0", "hma.large"),
        ("SIG0", "S1_NRB_L2A", 4, 29879, 32, 10, f"{IMAGE_HOST}/sig0:1.0", "hma.large"),
        ("WICS2", "S2_WICS2_L2B", 4, 29879, 16, 10, f"{IMAGE_HOST}/wics2:1.0", "hma.large"),
        ("WDS", "S1_WDS_L2B", 2, 7383, 2, 2, f"{IMAGE_HOST}/wds:1.0", "eo1.large"),
        ("SWS", "S1_SWS_L2B", 2, 7383, 2, 2, f"{IMAGE_HOST}/sws:1.0", "eo1.large"),
        ("WICS1", "S1_WICS1_L2B", 2, 7383, 2, 2, f"{IMAGE_HOST}/wics1:1.0", "eo1.large"),
        ("GFSC", "GFSC_L2C", 2, 7383, 2, 2, f"{IMAGE_HOST}/gfsc:1.0", "eo1.large"),
        ("WICS1S2", "COMB_WICS1S2", 2, 7383, 32, 10, f"{IMAGE_HOST}/wics1s2:1.0", "eo1.large"),
    ],
    "triggering_condition": [
        ("FSC_TC", "FSC", "L2A of the last 7 days"),
        ("CC_TC", "CC", "L1C measured in 30 and published in 7 days on an allowed tile"),
        ("Backscatter_10m_TC", "SIG0", "all consecutive GRD slices over the tile"),
        ("WICS2_TC", "WICS2", "L2A of the last 7 days"),
        ("WDS_TC", "WDS", "backscatter and FSC on the same tile and day"),
        ("SWS_TC", "SWS", "backscatter of the last 7 days on an allowed tile"),
        ("WICS1_TC", "WICS1", "backscatter of the last 7 days"),
        ("GFSC_TC", "GFSC", "FSC and SWS of up to 7 days before"),
        ("WICS1S2_TC", "WICS1S2", "one WICS1 and all WICS2 of the same tile and day"),
    ],
    "processing_status": [
        (1, 0, "started", ""), (2, 1, "processed", ""), (3, 2, "pending", ""), (4, 110, "internal_error", ""),
        (5, 210, "external_error", ""), (6, 99, "terminated", ""),
    ],
    "indexation_failure_type": [
        (1, 110, "error_failed_publication", ""), (2, 120, "error_publication_max_retry", ""),
        (3, 130, "error_timeout_indexation", ""),
    ],
    "indexation_file_type": [(1, "INSPIRE", "")],
    "log_levels": [(50, "CRITICAL"), (40, "ERROR"), (30, "WARNING"), (20, "INFO"), (10, "DEBUG")],
    "sources": [
        ("L1C_TC", "S2MSI1C", "Sentinel2", 5, 5, None, None, None, None, None, None, None),
        ("GRD_TC", "IW_GRDH_1S", "Sentinel1", 5, 5, None, None, "VV%26VH", "NRT-3h", None, None, None),
        ("GRD_TC", "IW_GRDH_1S", "Sentinel1", 5, 5, None, None, "VV%26VH", "Fast-24h", None, None, None),
    ],
    "triggerer_config": [("GFSC_L2C", None)],
    "launcher_config": [("pt_reprocessing_waiting_time", "600"), ("interval", '{"months": 1, "days": 15}'),
                        ("eligible_tiles", "32TPR,32TPS")],
    # Days an input stays eligible after publication and after measurement, by condition.
    "condition_limits": [
        ("FSC_TC", 7, None), ("CC_TC", 7, 30), ("Backscatter_10m_TC", 7, None), ("WICS2_TC", 7, None),
        ("WDS_TC", 7, None), ("SWS_TC", 7, None), ("WICS1_TC", 7, None), ("GFSC_TC", 7, None), ("WICS1S2_TC", 7, None),
    ],
    # Input types each condition consumes.
    "condition_inputs": [
        ("CC_TC", "S2MSI1C"), ("CC_TC", "S2_MAJA_L2A"), ("Backscatter_10m_TC", "IW_GRDH_1S"),
        ("FSC_TC", "S2_MAJA_L2A"), ("WICS2_TC", "S2_MAJA_L2A"), ("SWS_TC", "S1_NRB_L2A"), ("WICS1_TC", "S1_NRB_L2A"),
        ("WDS_TC", "S1_NRB_L2A"), ("WDS_TC", "S2_FSC_L2B"), ("GFSC_TC", "S2_FSC_L2B"), ("GFSC_TC", "S1_SWS_L2B"),
        ("WICS1S2_TC", "S1_WICS1_L2B"), ("WICS1S2_TC", "S2_WICS2_L2B"),
    ],
    # Condition and input type replayed after a restart.
    "catch_up_pairs": [
        ("Backscatter_10m_TC", "IW_GRDH_1S"), ("CC_TC", "S2MSI1C"), ("FSC_TC", "S2_MAJA_L2A"),
        ("WICS2_TC", "S2_MAJA_L2A"), ("SWS_TC", "S1_NRB_L2A"), ("WICS1_TC", "S1_NRB_L2A"), ("WDS_TC", "S2_FSC_L2B"),
    ],
}
_EXTRA = {
    "condition_limits": struct("condition STRING, max_publication_days INT, max_measurement_days INT"),
    "condition_inputs": struct("condition STRING, product_type_code STRING"),
    "catch_up_pairs": struct("condition STRING, product_type_code STRING"),
}


def rows(table: str) -> list[tuple]:
    return list(_ROWS[table])


def schema(table: str) -> StructType:
    return SCHEMAS.get(table) or _EXTRA[table]


def code_table(spark: SparkSession, table: str) -> DataFrame:
    """One code table; its few fixed rows make it safe to broadcast."""
    return F.broadcast(small_table(spark, rows(table), schema(table)))


def reference_tables(spark: SparkSession) -> Catalogue:
    """SRC-02: all code tables with their rows."""
    return Catalogue({name: (lambda n=name: code_table(spark, n)) for name in _ROWS})


def run_params(launcher_config: DataFrame) -> DataFrame:
    """SRC-03: launcher parameters in one row, with the interval decoded from JSON and the tiles from CSV."""
    value = lambda name: F.max(F.when(F.col("param") == name, F.col("value")))
    interval = F.from_json(value("interval"), "months INT, days INT")
    return launcher_config.agg(
        value("pt_reprocessing_waiting_time").cast("int").alias("waiting_seconds"),
        interval["months"].alias("interval_months"),
        interval["days"].alias("interval_days"),
        F.split(value("eligible_tiles"), ",").alias("eligible_tiles"),
    )


def launcher_tiles(launcher_config: DataFrame) -> DataFrame:
    """SRC-03: the launcher's tiles, one per row."""
    return (launcher_config.filter(F.col("param") == "eligible_tiles")
            .select(F.explode(F.split("value", ",")).alias("tile")).select(F.trim("tile").alias("tile")))

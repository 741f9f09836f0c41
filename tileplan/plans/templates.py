"""What a run manifest of each routine holds.

Each line is (routine, key, pattern). A pattern names values of the task in braces; a line whose value is unknown
for a task is left out. Lists of inputs are not here, they have one line per input.
"""

# Folders; give other values to ``manifests`` for another installation.
ROOTS = {
    "work": "/opt/wsi",
    "aux": "s3://AUX",
    "products": "s3://PRODUCTS",
    "intermediate": "s3://INTERMEDIATE-RESULTS",
    "kpi": "s3://KPI-FILES",
    "logs": "s3://LOGS",
    "l1c": "s3://EODATA/Sentinel-2/MSI/L1C",
    "l1c_old": "s3://EODATA/Sentinel-2/MSI/L1C_N0500",
    "grd": "s3://EODATA/Sentinel-1/SAR/IW_GRDH_1S",
    "grd_old": "s3://EODATA/Sentinel-1/SAR/GRD",
}

TITLES = {
    "CC": "CLMS_WSI_CC_020m_T{tile}_{stamp}_{mission}_V100",
    "FSC": "CLMS_WSI_FSC_020m_T{tile}_{stamp}_{mission}_V200",
    "SIG0": "SIG0_{stamp}_{stop}_{acquisition}_{orbit}_T{tile}_10m_{mission}IWGRDH_ENVEO.tif",
    "SWS": "CLMS_WSI_SWS_060m_T{tile}_{stamp}_{mission}_V200",
    "WICS1": "CLMS_WSI_WIC_060m_T{tile}_{stamp}_{mission}_V100",
    "WICS2": "CLMS_WSI_WIC_020m_T{tile}_{stamp}_{mission}_V100",
    "WDS": "CLMS_WSI_WDS_060m_T{tile}_{stamp}_{mission}_V200",
    "GFSC": "CLMS_WSI_GFSC_060m_T{tile}_{ymd}P{span}D_COMB_V102",
    "WICS1S2": "CLMS_WSI_WIC_020m_T{tile}_{ymd}T{slot}P12H_COMB_V100",
}

# Folder names of outputs, logs and quality files.
FOLDERS = {
    "CC": ("CC", "CC", "CC"), "FSC": ("FSC", "FSC", "FSC"), "SIG0": ("Backscatter_10m", "Backscatter_10m", None),
    "SWS": ("SWS", "SWS", "SWS"), "WICS1": ("WIC_S1", "WIC_S1", "WIC_S1"), "WICS2": ("WIC_S2", "WIC_S2", "WIC_S2"),
    "WDS": ("WDS", "WDS", "WDS"), "GFSC": ("GFSC", "GFSC", "GFSC"), "WICS1S2": ("WIC_S1S2", "WIC_S1S2", "WIC_S1S2"),
}

_DAY = "{tile}/{year}/{month}/{day}"
_SIGMA0 = "{intermediate}/Backscatter_10m/" + _DAY + "/{name}"
_S1 = "{aux}/S1_{kind}/S1_{kind}_T{tile}_60m_t{orbit}_V20240827.tif"
_FOREST = "{aux}/MASK_FOREST_URBAN_WATER/MASK_FOREST_URBAN_WATER_T{tile}_60m_V20240827.tif"


def _s1(kind: str) -> str:
    return _S1.replace("{kind}", kind)


LINES = [
    ("CC", "auxiliaries.DTM", "{aux}/DTM/{tile}/"),
    ("CC", "auxiliaries.GIPP", "{aux}/GIPP/GIPP_DATA.zip"),
    ("CC", "auxiliaries.CAMS", "{aux}/CAMS/{year}/{month}/{day}/"),
    ("CC", "conf.maja_userconf", "{aux}/USERCONF/"),
    ("CC", "input.L1C", "{l1c_root}/{year}/{month}/{day}/{name}"),
    ("CC", "input.measurement_date", "{ymd}"),
    ("CC", "input.L2A", "{intermediate}/L2A/{tile}/{l2a_folder}/{l2a}"),
    ("CC", "output.src", "{work}/output/CC/{title}/"),
    ("CC", "output.dst", "{products}/CC/" + _DAY + "/{title}/"),
    ("CC", "qas.src", "{work}/temp/{title}_temp/{title}_QAS.yaml"),
    ("CC", "intermediates.L2A.src", "{work}/output/L2A/"),
    ("CC", "intermediates.L2A.dst", "{intermediate}/L2A/" + _DAY + "/"),
    ("CC", "run_mode", "{mode}"),
    ("FSC", "auxiliaries.DEM", "{aux}/DEM/20m/Copernicus_DSM_04_N02_00_00_DEM_20m_{tile}.tif"),
    ("FSC", "auxiliaries.WATER_MASK", "{aux}/WL/20m/WL_2018_20m_{tile}.tif"),
    ("FSC", "auxiliaries.TCD", "{aux}/TCD/20m/TCD_2018_010m_eu_03035_V2_0_20m_{tile}.tif"),
    ("FSC", "date", "{ymd}"),
    ("FSC", "input.L2A", "{intermediate}/L2A/" + _DAY + "/{name}"),
    ("FSC", "output.src", "{work}/output/{title}/"),
    ("FSC", "output.dst", "{products}/FSC/" + _DAY + "/{title}/"),
    ("FSC", "intermediates.GVmask.src", "{work}/intermediate/{title}_GV_mask.tif"),
    ("FSC", "intermediates.GVmask.dst", "{intermediate}/FSC/" + _DAY + "/{title}/{title}_GV_mask.tif"),
    ("FSC", "qas.src", "{work}/output/tmp/{title}_QAS.yaml"),
    ("SIG0", "date", "{ymd}"),
    ("SIG0", "tile", "{tile}"),
    ("SIG0", "auxiliaries.DEM", "{aux}/DEM/10m/Copernicus_DSM_04_N02_00_00_DEM_10m_{tile}_b60m_wgs84.tif"),
    ("SIG0", "auxiliaries.TILES_UTM", "{aux}/TILES_UTM/tiles_utm.yml"),
    ("SIG0", "output.src", "{work}/output/{title}"),
    ("SIG0", "output.dst", "{intermediate}/Backscatter_10m/" + _DAY + "/{title}"),
    ("SWS", "date", "{ymd}"),
    ("SWS", "input.sigma0", _SIGMA0),
    ("SWS", "input.S2_tile", "{tile}"),
    ("SWS", "auxiliaries.mask_forest_urban_water", _FOREST),
    ("SWS", "auxiliaries.mask_mountain_snow_monthly",
     "{aux}/MASK_MOUNTAIN_SNOW_MONTHLY/T{tile}_60m_MASK_SNOW_m{month}_V20211119.tif"),
    ("SWS", "auxiliaries.mask_non_mountain_area",
     "{aux}/MASK_NON_MOUNTAIN_AREA/MASK_NON_MOUNTAIN_AREA_T{tile}_60m_V20211119.tif"),
    ("SWS", "auxiliaries.s1_reference", _s1("REFERENCE")),
    ("SWS", "auxiliaries.s1_radar_shadow_layover", _s1("RADAR_SHADOW_LAYOVER")),
    ("SWS", "auxiliaries.s1_incidence_angle", _s1("INCIDENCE_ANGLE")),
    ("SWS", "output.src", "{work}/output/{title}/"),
    ("SWS", "output.dst", "{products}/SWS/" + _DAY + "/{title}/"),
    ("SWS", "qas.src", "{work}/output/{title}_QAS.yaml"),
    ("WICS1", "auxiliaries.GRASSLAND", "{aux}/GRASSLAND/60m/GRA_2018_010m_eu_03035_V1_0_60m_{tile}.tif"),
    ("WICS1", "auxiliaries.IMPERVIOUSNESS", "{aux}/IMPERVIOUSNESS/60m/IMD_2018_010m_eu_03035_V2_0_60m_{tile}.tif"),
    ("WICS1", "auxiliaries.TREE_COVER", "{aux}/TCD/60m/TCD_2018_010m_eu_03035_V2_0_60m_{tile}.tif"),
    ("WICS1", "auxiliaries.WATER_LAYER", "{aux}/WL/60m/WL_2018_60m_{tile}.tif"),
    ("WICS1", "date", "{ymd}"),
    ("WICS1", "tile_id", "{tile}"),
    ("WICS1", "input.SIGMA0", _SIGMA0),
    ("WICS1", "input.CLASSIFICATION_COEFFICIENTS", "{aux}/WIC_S1_CLASSIFICATION_COEFFICIENTS/cc_60m_{tile}.tif"),
    ("WICS1", "input.RADARSHADOW", _s1("RADAR_SHADOW_LAYOVER")),
    ("WICS1", "input.TEMPERATURE", "{aux}/FMI_TEMPERATURE/{ymd}_t2m_sum.nc"),
    ("WICS1", "input.WATER_CATEGORY", "{aux}/WIC_S1_WATER_CLASSIFICATION/wc_60m_{tile}.tif"),
    ("WICS1", "input.WIND_SPEED", "{aux}/FMI_WINDSPEED/{ymd}_wind_speed.nc"),
    ("WICS1", "output.src", "{work}/output/{title}/"),
    ("WICS1", "output.dst", "{products}/WIC_S1/" + _DAY + "/{title}/"),
    ("WICS1", "qas.src", "{work}/output/{title}_QAS.yaml"),
    ("WICS2", "auxiliaries.DEM", "{aux}/DEM/20m/Copernicus_DSM_04_N02_00_00_DEM_20m_{tile}.tif"),
    ("WICS2", "auxiliaries.WATER_LAYER", "{aux}/WL/20m/WL_2018_20m_{tile}.tif"),
    ("WICS2", "auxiliaries.SLOPE",
     "{aux}/DTM/{tile}/S2__TEST_AUX_REFDE2_{tile}_1001.DBL.DIR/S2__TEST_AUX_REFDE2_{tile}_1001_SLP_R2.TIF"),
    ("WICS2", "date", "{ymd}"),
    ("WICS2", "input.L2A", "{intermediate}/L2A/" + _DAY + "/{name}"),
    ("WICS2", "output.src", "{work}/output/{title}"),
    ("WICS2", "output.dst", "{products}/WIC_S2/" + _DAY + "/"),
    ("WICS2", "qas.src", "{work}/temp/{title}_temp/{title}_QAS.yaml"),
    ("WDS", "date", "{ymd}"),
    ("WDS", "input.SIGMA0", _SIGMA0),
    ("WDS", "auxiliaries.MASK_FOREST_URBAN_WATER", _FOREST),
    ("WDS", "auxiliaries.S1_REFERENCE", _s1("REFERENCE")),
    ("WDS", "auxiliaries.S1_RADAR_SHADOW_LAYOVER", _s1("RADAR_SHADOW_LAYOVER")),
    ("WDS", "auxiliaries.S1_INCIDENCE_ANGLE", _s1("INCIDENCE_ANGLE")),
    ("WDS", "output.src", "{work}/output/{title}/"),
    ("WDS", "output.dst", "{products}/WDS/" + _DAY + "/{title}/"),
    ("WDS", "qas.src", "{work}/output/{title}_QAS.yaml"),
    ("GFSC", "date", "{year}-{month}-{day}"),
    ("GFSC", "tile", "{tile}"),
    ("GFSC", "aggregation_timespan", "{span}"),
    ("GFSC", "auxiliaries.WATER_MASK", "{aux}/WL/60m/WL_2018_60m_{tile}.tif"),
    ("GFSC", "output.src", "{work}/output/{title}/"),
    ("GFSC", "output.dst", "{products}/GFSC/" + _DAY + "/{title}/"),
    ("GFSC", "qas.src", "{work}/output/{title}_QAS.yaml"),
    ("WICS1S2", "input.measurement_date", "{ymd}"),
    ("WICS1S2", "input.S2_tile", "{tile}"),
    ("WICS1S2", "auxiliaries.WATER_MASK", "{aux}/WL/20m/WL_2018_20m_{tile}.tif"),
    ("WICS1S2", "output.src", "{work}/output/{title}/"),
    ("WICS1S2", "output.dst", "{products}/WIC_S1S2/" + _DAY + "/{title}/"),
    ("WICS1S2", "qas.src", "{work}/temp/{title}temp/{title}_QAS.yaml"),
]

# Log files carry the product title; those of two routines also name the log.
LONG_LOG_NAMES = ("FSC", "SWS")


def manifest_lines(roots: dict[str, str]) -> list[tuple[str, str, str]]:
    """All lines, with the log and quality files every routine has and with the folders filled in."""
    lines = list(LINES)
    for routine, (_, logs, quality) in FOLDERS.items():
        infix = "_processing_routine" if routine in LONG_LOG_NAMES else ""
        for stream in ("STDOUT", "STDERR"):
            end = stream.lower() + ".log"
            lines.append((routine, f"log.{stream}.src", "{work}/logs/processing_routine." + end))
            lines.append((routine, f"log.{stream}.dst",
                          "{logs}/" + logs + "/" + _DAY + "/{now}_{title}" + infix + "." + end))
        if quality:
            lines.append((routine, "qas.dst", "{kpi}/" + quality + "/" + _DAY + "/{title}_QAS.yaml"))

    def fill(pattern: str) -> str:
        for name, root in roots.items():
            pattern = pattern.replace("{" + name + "}", root)
        return pattern

    return [(routine, key, fill(pattern)) for routine, key, pattern in lines]

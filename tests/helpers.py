"""Hand-made rows."""

from __future__ import annotations

import datetime as dt

from tileplan.catalogue import Catalogue
from tileplan.plans.triggers import Rules
from tileplan.schemas import SCHEMAS
from tileplan.sources.reference import reference_tables

AS_OF = "2025-01-31 00:00:00"


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def table(spark, name, rows):
    """Rows given as dictionaries; missing columns are null."""
    schema = SCHEMAS[name]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def raw(id, kind, day=20250130, tile="32TMP", at="2025-01-30 06:00:00", path=None, partial=False, orbit=None,
        harvested=None):
    return {"id": id, "product_type_code": kind, "start_date": ts(at), "publishing_date": ts(at), "tile": tile,
            "measurement_day": day, "input_path": path or f"s3://B/{id}", "is_partial": partial,
            "relative_orbit_number": orbit, "harvesting_date": ts(harvested or at)}


def catalogue(spark, **tables):
    names = ["raw_inputs", "trigger_validation", "raw2valid", "processing_tasks", "nomad_job_dispatch",
             "processingtask2nomad", "processing_status_workflow", "products", "indexation_json", "indexation_workflow"]
    codes = reference_tables(spark)
    made = {n: getattr(codes, n) for n in codes.names()}
    made.update({n: table(spark, n, tables.get(n, [])) for n in names})
    return Catalogue(made)


def rules(spark, tiles=("32TMP",), tracks=(("32TMP", 9),), as_of=AS_OF, **more):
    tile_list = spark.createDataFrame([(t,) for t in tiles], "tile STRING")
    track = spark.createDataFrame(list(tracks), "tile STRING, orbit INT")
    return Rules(as_of=as_of, tiles=tile_list, sws_tracks=track, wics1_tracks=track, wds_tracks=track,
                 sources=reference_tables(spark).sources, **more)


def sets(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())

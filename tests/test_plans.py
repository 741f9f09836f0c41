"""Plans over a stored catalogue: how often tables are read, and with which literal bounds."""

import re

import pytest

from tileplan.operators import tasks as op
from tileplan.plans import gapfill, planning, triggers as trg
from tileplan.registry.triggers import rules_of
from tileplan.sources import catalogue as store
from tileplan.sources.reference import code_table, run_params



@pytest.fixture(scope="module")
def stored(spark, fx, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("catalogue"))
    store.write_catalogue(fx, root)
    return root, store.load_catalogue(spark, root)


@pytest.fixture
def scans(monkeypatch):
    """[(table, partition filters)] of every scan of the frames written on the way and of the result."""
    seen = []

    def look(df):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        for line in re.findall(r"FileScan parquet .*", plan):
            table = re.search(r"Location: [^\[]*\[\S*?/catalogue\d+/(\w+)", line)
            if table:
                seen.append((table[1], re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", line)[1]))
        return df

    for module in (trg, gapfill):
        monkeypatch.setattr(module, "written", lambda df, label, f=module.written: f(look(df), label))
    return seen, look


@pytest.fixture(autouse=True)
def long_plans(spark):
    names = {"spark.sql.maxMetadataStringLength": "4000", "spark.sql.debug.maxToStringFields": "400"}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k in names:
        spark.conf.unset(k)


def test_routing_reads_inputs_three_times_and_links_once(spark, fx, stored, scans):
    seen, look = scans
    _, cat = stored
    look(trg.trigger_all(cat.raw_inputs, cat, rules_of(fx)))
    tables = [t for t, _ in seen]
    assert tables.count("raw_inputs") == 3 and tables.count("raw2valid") == 1 and tables.count("trigger_validation") == 1


def test_look_back_is_a_literal_for_every_scan_of_inputs(spark, fx, stored, scans):
    seen, look = scans
    _, cat = stored
    look(trg.trg_cc(cat, rules_of(fx, publication_days={"CC_TC": 30}))[0])
    inputs = [f for t, f in seen if t == "raw_inputs"]
    assert len(inputs) >= 3 and all(re.search(r"measurement_day#\d+L? >= \d{8}", f) for f in inputs)
    seen.clear()
    look(planning.archive_batch(cat, "eo1.large", fx.tile_list, run_params(code_table(spark, "launcher_config")), 20240125))
    inputs = [f for t, f in seen if t == "raw_inputs"]
    assert inputs and all(re.search(r"measurement_day#\d+L? >= \d{8}", f) and re.search(r"<= \d{8}", f) for f in inputs)


def test_archive_batch_without_open_tasks(spark, fx, stored):
    _, cat = stored
    none = cat.replace(processing_tasks=cat.processing_tasks.limit(0))
    out = planning.archive_batch(none, "eo1.large", fx.tile_list, run_params(code_table(spark, "launcher_config")), 20240125)
    assert out.count() == 0 and out.columns == op.archive_undispatched(cat, "x", fx.tile_list, 0, 0).columns


def test_only_days_of_the_candidates_are_read_from_the_index(spark, fx, stored, tmp_path, scans):
    from tileplan.registry.triggers import _sws_sets
    from tileplan.sources.tablelog import TableLog

    seen, _ = scans
    _, cat = stored
    log = TableLog(spark, f"{tmp_path}/catalogue9", "triggers")
    log.commit(0, {"set_index": gapfill.set_index(cat)})
    day = 20240110
    sets = _sws_sets(fx).where(f"day = {day}")
    gapfill.exact_set_exists(sets, cat.replace(set_index=log.rows("set_index"))).collect()
    filters = [f for t, f in seen if t == "set_index"]
    assert filters and all(str(day) in f for f in filters)


def test_a_day_is_one_folder_a_table(spark, stored):
    root, cat = stored
    for table, column in store.LAYOUT.items():
        df = store.scan(spark, root, table, days=(20240110, 20240110))
        files = df.inputFiles()
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert "20240110" in plan and df.columns == getattr(cat, table).columns, table
        assert len({re.search(r"(on_day|measurement_day)=(\w+)", f)[2] for f in files if "=" in f} & {"20240110"}) <= 1, column
    everything = cat.trigger_validation.count()
    one = store.scan(spark, root, "trigger_validation", days=(20240110, 20240110))
    assert 0 < one.count() < everything
    assert one.exceptAll(cat.trigger_validation.where("CAST(date_format(validation_date, 'yyyyMMdd') AS BIGINT) = 20240110")).count() == 0

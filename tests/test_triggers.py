"""Triggers and planning on hand-made rows: the rules that are easy to get wrong, and properties."""

import datetime as dt
import random

import pytest
from helpers import AS_OF, catalogue, raw, rules, sets
from pyspark.sql import functions as F

from tileplan.operators import inputs as op_inputs, status as op_status, tasks as op_tasks
from tileplan.plans import gapfill, planning, triggers as trg


def grd(id, start, stop, at="2025-01-30 06:00:00", orbit=9, tile="32TMP", harvested=None):
    path = f"s3://E/S1A_IW_GRDH_1SDV_20250130T{start}_20250130T{stop}_041190_04E503_C194.SAFE"
    return raw(id, "IW_GRDH_1S", path=path, partial=True, orbit=orbit, tile=tile, at=at, harvested=harvested)


def pairs(spark, rows):
    cat = catalogue(spark, raw_inputs=rows)
    return sets(trg.trg_sig0_pairs(cat.raw_inputs, cat.raw2valid, AS_OF), "first_id", "raw_input_id")


def test_grd_pair_in_any_order(spark):
    a, b = grd("a", "060000", "060020"), grd("b", "060020", "060040", at="2025-01-30 06:00:20")
    assert pairs(spark, [a, b]) == [("a", "a"), ("a", "b")]
    late_first = [grd("a", "060020", "060040"), grd("b", "060000", "060020", at="2025-01-30 06:00:20")]
    assert pairs(spark, late_first) == [("a", "a"), ("a", "b")]


def test_grd_gap_three_and_null_orbit(spark):
    gap = [grd("a", "060000", "060020"), grd("b", "060030", "060050", at="2025-01-30 06:00:30")]
    assert pairs(spark, gap) == []
    three = [grd("a", "060000", "060020"), grd("b", "060020", "060040", at="2025-01-30 06:00:20"),
             grd("c", "070000", "070020", at="2025-01-30 07:00:00")]
    assert pairs(spark, three) == [("a", "a"), ("a", "b"), ("a", "c")]
    other_orbit = [grd("a", "060000", "060020"), grd("b", "060020", "060040", orbit=10)]
    assert pairs(spark, other_orbit) == []
    no_orbit = [grd("a", "060000", "060020", orbit=None), grd("b", "060020", "060040", orbit=None, at="2025-01-30 06:00:20")]
    assert pairs(spark, no_orbit) == [("a", "a"), ("a", "b")]


def test_grd_orphans(spark):
    cat = catalogue(spark, raw_inputs=[
        grd("old", "060000", "060020", harvested="2025-01-30 21:59:00"),
        grd("young", "060000", "060020", tile="32TMQ", harvested="2025-01-30 22:01:00"),
        grd("two_a", "060000", "060020", tile="32TMR"), grd("two_b", "060020", "060040", tile="32TMR"),
        grd("ancient", "060000", "060020", tile="32TMS", harvested="2025-01-20 00:00:00")])
    first, state = trg.trg_sig0_orphans(cat.raw_inputs, cat.raw2valid, AS_OF)
    assert sets(first, "raw_input_id") == [("old",)]
    second, state2 = trg.trg_sig0_orphans(cat.raw_inputs, cat.raw2valid, AS_OF, state)
    assert sets(second, "raw_input_id") == [] and state2.count() == 1


def one_by_one(rows, newest_first):
    """WDS over inputs that come one after the other: the ids that fire."""
    sig0 = [r for r in rows if r["product_type_code"] == "S1_NRB_L2A"]
    fsc = [r for r in rows if r["product_type_code"] == "S2_FSC_L2B"]
    turn = lambda r: (r["harvesting_date"], r["id"])
    bound, fired = set(), []
    for r in sorted(rows, key=turn, reverse=newest_first):
        if r["id"] in bound or not sig0 or not fsc:
            continue
        fired.append(r["id"])
        bound |= {r["id"], *([f["id"] for f in fsc] if r in sig0 else [max(sig0, key=turn)["id"]])}
    return sorted(fired)


@pytest.mark.parametrize("newest_first", [False, True])
@pytest.mark.parametrize("order", ["sf", "fs", "ssf", "sfs", "fss", "fsf", "ffsfs", "sffs", "s", "f"])
def test_wds_fires_as_if_inputs_came_one_by_one(spark, order, newest_first):
    rows = [raw(f"{kind}{i}", {"s": "S1_NRB_L2A", "f": "S2_FSC_L2B"}[kind], orbit=9, harvested=f"2025-01-30 0{i + 1}:00:00")
            for i, kind in enumerate(order)]
    cat = catalogue(spark, raw_inputs=rows)
    got = trg.trigger_all(cat.raw_inputs, cat, rules(spark), newest_first).where("condition = 'WDS_TC'").select("first_id")
    assert sets(got.distinct(), "first_id") == [(i,) for i in one_by_one(cat.raw_inputs.collect(), newest_first)]


def test_wds_from_fsc_binds_only_the_last_sig0(spark):
    cat = catalogue(spark, raw_inputs=[
        raw("f1", "S2_FSC_L2B"), raw("f2", "S2_FSC_L2B"), raw("s1", "S1_NRB_L2A", orbit=9),
        raw("s2", "S1_NRB_L2A", orbit=9, harvested="2025-01-30 09:00:00")],
        trigger_validation=[{"id": 1, "triggering_condition_name": "WDS_TC"}],
        raw2valid=[{"trigger_validation_id": 1, "raw_input_id": "s2"}, {"trigger_validation_id": 1, "raw_input_id": "f2"}])
    made = trg.trg_wds_from_fsc(cat.raw_inputs, cat, rules(spark))
    assert sets(made, "first_id", "raw_input_id") == [("f1", "f1"), ("f1", "s2")]
    wrong = trg.trg_wds_from_fsc(cat.raw_inputs, cat, rules(spark, tracks=[("32TMP", 10)]))
    assert wrong.count() == 0
    both = trg.trg_wds_from_sig0(cat.raw_inputs, cat, rules(spark))
    assert sets(both, "first_id", "raw_input_id") == [("s1", "f1"), ("s1", "f2"), ("s1", "s1")]


def test_sws_needs_tile_and_orbit(spark):
    cat = catalogue(spark, raw_inputs=[
        raw("ok", "S1_NRB_L2A", orbit=9), raw("no_orbit", "S1_NRB_L2A"), raw("bad_orbit", "S1_NRB_L2A", orbit=8),
        raw("elsewhere", "S1_NRB_L2A", orbit=9, tile="32TMQ"),
        raw("old", "S1_NRB_L2A", orbit=9, harvested="2025-01-23 23:59:00")])
    conf = rules(spark, tracks=[("32TMP", 9), ("32TMQ", 9)])
    assert sets(trg.trg_sws(cat.raw_inputs, cat, conf), "raw_input_id") == [("ok",)]
    assert sets(trg.trg_wics1(cat.raw_inputs, cat, conf), "raw_input_id") == [("elsewhere",), ("ok",)]


def cc_case(spark, task=True, product=True, l2a_day=20250101, **more):
    tables = {
        "raw_inputs": [raw("new1", "S2MSI1C"), raw("new2", "S2MSI1C", at="2025-01-30 07:00:00"),
                       raw("before", "S2MSI1C", day=20250101)] + ([raw("l2a", "S2_MAJA_L2A", day=l2a_day)] if l2a_day else []),
        "trigger_validation": [{"id": 1, "triggering_condition_name": "CC_TC"}],
        "raw2valid": [{"trigger_validation_id": 1, "raw_input_id": "before"}],
        "processing_tasks": [{"id": 5, "trigger_validation_fk_id": 1, "has_ended": True}] if task else [],
        "processingtask2nomad": [{"nomad_job_id": "j", "processing_task_id": 5}] if task else [],
        "products": [{"id": "p", "trigger_validation_fk_id": 1}] if product else [], **more}
    good, bad = trg.trg_cc(catalogue(spark, **tables), rules(spark))
    return sets(good, "first_id", "raw_input_id"), sets(bad, "id")


def test_cc_modes(spark):
    assert cc_case(spark) == ([("new1", "l2a"), ("new1", "new1")], [])
    assert cc_case(spark, product=False) == ([("new1", "new1")], [])
    assert cc_case(spark, l2a_day=None) == ([], [("new1",)])  # an earlier product but no L2A
    assert cc_case(spark, l2a_day=20250130) == ([("new1", "l2a"), ("new1", "new1")], [])  # the day itself counts
    assert cc_case(spark, l2a_day=20241101)[0] == [("new1", "l2a"), ("new1", "new1")]  # 90 days back
    assert cc_case(spark, l2a_day=20241031) == ([], [("new1",)])


def test_cc_blocked(spark):
    assert cc_case(spark, task=False, product=False) == ([], [])  # pending validation
    day = 20250110  # within 30 days: an undispatched task blocks the tile
    blocked = {"raw_inputs": [raw("new1", "S2MSI1C"), raw("before", "S2MSI1C", day=day)], "processingtask2nomad": []}
    assert cc_case(spark, **blocked) == ([], [])
    running = {"processing_tasks": [{"id": 5, "trigger_validation_fk_id": 1, "has_ended": False}],
               "raw_inputs": blocked["raw_inputs"],
               "processing_status_workflow": [{"id": 1, "nomad_job_dispatch_fk_id": "j", "exit_code": 110}]}
    assert cc_case(spark, **running) == ([], [])


@pytest.mark.parametrize("bad,visits,stored", [
    ([], [(20250127, True), (20250128, True), (20250129, True), (20250130, True)], 20250131),
    ([20250128], [(20250127, True), (20250128, False)], 20250128),
    ([20250127], [(20250127, False)], 20250127),
    ([20250130], [(20250127, True), (20250128, True), (20250129, True), (20250130, False)], 20250130)])
def test_gap_walk(spark, bad, visits, stored):
    counts = spark.createDataFrame([(d, 2) for d in bad] + [(20250129, 0)], "measurement_day BIGINT, total BIGINT")
    walk = gapfill.gap_walk(counts, 20250127, dt.date(2025, 1, 31))
    assert sets(walk, "measurement_day", "clean") == visits
    assert {r.stored_day for r in walk.collect()} == {stored}


def test_gap_walk_goes_on_after_a_jump_with_the_stored_day_frozen(spark):
    counts = spark.createDataFrame([(20250102, 1)], "measurement_day BIGINT, total BIGINT")
    walk = gapfill.gap_walk(counts, 20250101, dt.date(2025, 1, 11))
    assert sets(walk, "measurement_day", "clean") == [(20250101, True), (20250102, False), (20250109, True), (20250110, True)]
    assert {r.stored_day for r in walk.collect()} == {20250102}
    assert gapfill.gap_walk(counts, 20250111, dt.date(2025, 1, 11)).count() == 0


def test_exact_set_agrees_with_python_sets(spark):
    rng = random.Random(7)
    ids = [f"i{n}" for n in range(6)]
    stored = {v: (rng.choice([1, 2]), [rng.choice(ids) for _ in range(rng.randint(1, 4))]) for v in range(60)}
    mine = {k: (rng.choice([1, 2]), rng.sample(ids, rng.randint(1, 4))) for k in range(60)}
    cat = catalogue(
        spark, trigger_validation=[{"id": v, "triggering_condition_name": "GFSC_TC", "artificial_measurement_day": d}
                                   for v, (d, _) in stored.items()],
        raw2valid=[{"trigger_validation_id": v, "raw_input_id": i} for v, (_, m) in stored.items() for i in m])
    candidates = spark.createDataFrame([(str(k), "GFSC_TC", d, i) for k, (d, m) in mine.items() for i in m],
                                       "candidate_key STRING, condition STRING, day BIGINT, raw_input_id STRING")
    expected = sorted((str(k),) for k, (d, m) in mine.items()
                      if any(d == e and sorted(m) == sorted(n) for e, n in stored.values()))
    assert expected and sets(gapfill.exact_set_exists(candidates, cat), "candidate_key") == expected


def test_materialise_twice_gives_nothing_new(spark, fx):
    from tileplan.registry.triggers import rules_of

    conf = rules_of(fx)
    new = fx.raw_inputs.filter(F.col("product_type_code") != "IW_GRDH_1S")
    heads, links = trg.materialise(trg.trigger_all(new, fx, conf), fx, conf)
    assert heads.count() > 0
    tv = fx.trigger_validation.unionByName(heads.drop("candidate_key"))
    after = fx.replace(trigger_validation=tv, raw2valid=fx.raw2valid.unionByName(links))
    assert trg.trigger_all(new, after, conf).count() == 0


def test_order_of_the_rows_does_not_matter(spark, fx):
    from tileplan.registry.triggers import rules_of

    conf = rules_of(fx)
    mixed = fx.replace(raw_inputs=fx.raw_inputs.orderBy(F.rand(3)), raw2valid=fx.raw2valid.orderBy(F.rand(4)))
    columns = ["condition", "candidate_key", "raw_input_id"]
    assert sets(trg.trigger_all(fx.raw_inputs, fx, conf), *columns) == sets(
        trg.trigger_all(mixed.raw_inputs, mixed, conf), *columns)


def test_lost_limits(spark):
    rows = [("no age", None, 10, True), ("zero", 0.0, 10, True), ("29 min", 1740.0, 10, False), ("31 min", 1860.0, 10, True),
            ("20 min short", 1200.0, 2, False), ("22 min short", 1320.0, 2, True)]
    df = spark.createDataFrame([(n, a, d, True) for n, a, d, _ in rows], "n STRING, age DOUBLE, duration INT, no_exit_code BOOLEAN")
    assert {(r.n, r.lost) for r in df.select("n", planning.is_lost().alias("lost")).collect()} == {(n, x) for n, _, _, x in rows}
    only_callback = spark.createDataFrame([(3540.0,), (3660.0,)], "age DOUBLE").selectExpr(
        "age", "2 AS duration", "false AS no_exit_code")
    assert [r.lost for r in only_callback.select(planning.is_lost().alias("lost")).collect()] == [False, True]


def test_exit_code_selection_follows_the_flavour(spark):
    cat = catalogue(
        spark, raw_inputs=[raw("a", "S2_MAJA_L2A")], trigger_validation=[{"id": 1, "triggering_condition_name": "FSC_TC"}],
        raw2valid=[{"trigger_validation_id": 1, "raw_input_id": "a"}],
        processing_tasks=[{"id": 5, "trigger_validation_fk_id": 1, "has_ended": False}],
        nomad_job_dispatch=[{"id": "j"}], processingtask2nomad=[{"nomad_job_id": "j", "processing_task_id": 5}],
        processing_status_workflow=[{"id": 1, "nomad_job_dispatch_fk_id": "j", "processing_status_id": 4, "exit_code": 1}])
    assert op_tasks.unfinished_with_exit_code(cat, "hma.large").count() == 1
    assert op_tasks.unfinished_with_exit_code(cat, "eo1.large").count() == 0
    assert op_tasks.in_error(cat, "hma.large").count() == 1 and op_tasks.lost_sets(cat, "hma.large").count() == 0


def test_null_semantics(spark):
    cat = catalogue(
        spark, raw_inputs=[raw(None, "S2_MAJA_L2A"), raw("b", "S2_MAJA_L2A")],
        trigger_validation=[{"id": 1, "triggering_condition_name": "FSC_TC"}],
        raw2valid=[{"trigger_validation_id": 1, "raw_input_id": None}],
        processing_tasks=[{"id": 5, "trigger_validation_fk_id": 1, "has_ended": None}],
        processingtask2nomad=[{"nomad_job_id": "j", "processing_task_id": 5}],
        processing_status_workflow=[{"id": 1, "nomad_job_dispatch_fk_id": "j", "processing_status_id": 4, "exit_code": None},
                                    {"id": 2, "nomad_job_dispatch_fk_id": "j", "processing_status_id": 4, "exit_code": 110}])
    from tileplan.operators.filters import tasks_not_finished

    assert ("b",) in {(r.id,) for r in op_inputs.unvalidated_inputs(cat, "FSC_TC", ["S2_MAJA_L2A"]).collect()}
    assert tasks_not_finished(cat.processing_tasks).count() == 0
    assert sets(op_status.retry_error_count(cat), "number_of_error_by_pt") == [(1,)]
    assert sets(op_status.error_count(cat), "error_count") == [(2,)]


def test_status_ids_of_inputs_in_progress(spark):
    cat = catalogue(
        spark, raw_inputs=[raw("a", "S2MSI1C")], raw2valid=[{"trigger_validation_id": 1, "raw_input_id": "a"}],
        processing_tasks=[{"id": 5, "trigger_validation_fk_id": 1, "has_ended": False}],
        processingtask2nomad=[{"nomad_job_id": "j", "processing_task_id": 5}],
        processing_status_workflow=[{"id": n, "nomad_job_dispatch_fk_id": "j", "processing_status_id": n} for n in (1, 2, 3)])
    found = lambda *ids: sets(op_inputs.inputs_in_progress(cat, 20250130, ["S2MSI1C"], *ids), "status_id")
    assert found() == [(2,)] and found([1, 2]) == [(1,), (2,)]


def test_archive_interval_over_a_month_end(spark):
    from tileplan.sources.reference import reference_tables, run_params

    cat = catalogue(
        spark, raw_inputs=[raw(f"x{d}", "S1_SWS_L2B", day=d) for d in (20240131, 20240315, 20240316)],
        trigger_validation=[{"id": n, "triggering_condition_name": "GFSC_TC", "is_nrt": False} for n in range(3)],
        raw2valid=[{"trigger_validation_id": n, "raw_input_id": f"x{d}"} for n, d in enumerate((20240131, 20240315, 20240316))],
        processing_tasks=[{"id": 10 + n, "trigger_validation_fk_id": n, "has_ended": False} for n in range(3)])
    params = run_params(reference_tables(spark).launcher_config)
    tiles = spark.createDataFrame([("32TMP",)], "tile STRING")
    # 31 January + 1 month = 29 February, + 15 days = 15 March
    assert sets(planning.archive_batch(cat, "eo1.large", tiles, params), "id") == [(10,), (11,)]


def test_plan_rejects_incomplete_links(spark):
    cat = catalogue(spark, trigger_validation=[
        {"id": 1, "triggering_condition_name": "GFSC_TC", "artificial_measurement_day": 20250101},
        {"id": 2, "triggering_condition_name": "FSC_TC", "artificial_measurement_day": 20250101}],
        raw2valid=[{"trigger_validation_id": 1, "raw_input_id": "a"}, {"trigger_validation_id": 1, "raw_input_id": "b"},
                   {"trigger_validation_id": 2, "raw_input_id": "a"}, {"trigger_validation_id": None, "raw_input_id": "c"}])
    tasks, rejected = planning.plan_tasks(cat.raw2valid, cat.trigger_validation, cat.processing_tasks, AS_OF)
    assert sets(tasks, "trigger_validation_fk_id") == [(1,), (2,)]
    assert {r.trigger_validation_fk_id: r.processing_date for r in tasks.collect()} == {1: 20250101, 2: None}
    assert rejected.count() == 1

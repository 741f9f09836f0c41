"""The WICS1S2 links of a crowded tile and day: the same as pair by pair, but only the links are that many rows."""

from functools import reduce

from helpers import catalogue, raw, rules, sets

from tileplan.plans import triggers as trg
from tileplan.streaming import jobs


def test_links_equal_pair_by_pair(spark, monkeypatch):
    monkeypatch.setattr(trg, "SLICE_HEADS", 2)
    inputs = [raw(f"a{i}", "S1_WICS1_L2B") for i in range(9)] + [raw(f"b{i}", "S2_WICS2_L2B") for i in range(40)]
    inputs += [raw("a1", "S1_WICS1_L2B"), raw("b1", "S2_WICS2_L2B"), raw(None, "S1_WICS1_L2B"), raw(None, "S2_WICS2_L2B")]  # repeats, no id
    inputs += [raw("both", "S1_WICS1_L2B"), raw("both", "S2_WICS2_L2B"), raw("alone", "S1_WICS1_L2B", tile="32TMQ")]
    cat, conf = catalogue(spark, raw_inputs=inputs), rules(spark)
    found, stored, shared = jobs.pass_candidates(["wics1s2"], cat, conf, None)
    candidates = reduce(lambda a, b: a.unionByName(b), found)
    assert candidates.count() == 13 and not stored  # one row a head, and one for the head that is its own partner
    heads, links = trg.materialise(candidates, cat, conf)
    all_heads, all_links = trg.materialise(trg.trg_wics1s2(cat, conf), cat, conf)
    assert sets(heads, "id", "candidate_key") == sets(all_heads, "id", "candidate_key")
    got = links.unionByName(trg.shared_links(heads, *shared)).collect()
    key = lambda r: (r.trigger_validation_id, r.raw_input_id or "")
    assert sorted(map(key, got)) == sorted(map(key, all_links.collect())) and len(got) > 400

"""The prefix trie against prefixes in a dictionary."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tileplan.llm import tries
from tileplan.llm.queries import QUERIES

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(t, key=lambda x: x[0])] for c, t in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def below(p):
        leaves, saved = int(not children[p]), (len(members[p]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0)
        for x in list(children[p]):
            more = below(x)
            leaves, saved = leaves + more[0], saved + more[1]
        return leaves, saved

    out = []
    for p, who in members.items():
        out.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), len(children[p]), *below(p),
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def made(spark, rows, tmp_path):
    full = [(*r, "x", 1, "part", b"s") for r in rows]
    spark.createDataFrame(full, "conv_id LONG, turn LONG, role STRING, text STRING, seq STRING, n LONG, part STRING, open BINARY"
                          ).repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    return QUERIES["op12_prefix_trie"](spark, str(tmp_path))


@pytest.mark.parametrize("parts", [1, 2, 9, 60])
def test_random(spark, tmp_path, parts):
    rng = np.random.default_rng(parts)
    said = ["", "a b", "a  b c", None, "x"]
    rows = [(c, t if t else None, ["u", None, "u"][int(rng.integers(0, 3))], said[int(rng.integers(0, 5 if t > 1 else 2))])
            for c in range(150) for t in range(int(rng.integers(1, 6)))]
    rows += [(c, t, "u", "same words") for c in range(200, 320) for t in range(5)]  # many copies
    rows += [(None, 1, "u", "nobody's"), (None, None, None, None), (1000, 2, "u", "gap"), (-7, 1, "u", "below zero")]
    rows = [r for r in rows if r[0] != -7]
    rng.shuffle(rows)
    rows = [tuple(r) for r in rows]
    keep = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert result(made(spark, rows, tmp_path)) == brute(rows)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_edges(spark, tmp_path):
    rows = [(1, 0, "u", "short")]  # h(1) turns are taken away and no conversation 0 gives others
    rows += [(40, t, "u", f"turn {t % 3}") for t in range(700)]
    rows += [(41, 1, "u", "y"), (41, 1, "u", "y"), (41, 1, "u", "y"), (41, 1, "u", "y")]
    assert result(made(spark, rows, tmp_path)) == brute(rows)


def test_chunks_of_members(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tries, "CHUNK", 3)
    rows = [(c, 0, "u", "hello") for c in range(100, 4000, 20)] + [(c, 0, "u", "bye") for c in range(7, 2000, 20)]
    assert result(made(spark, rows, tmp_path)) == brute(rows)


def test_empty(spark, tmp_path):
    assert result(made(spark, [], tmp_path)) == []

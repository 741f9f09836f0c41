"""Substring dedup in words against all windows."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from tileplan.llm import passages
from tileplan.llm.automata import SuffixAutomaton

SCHEMA = "doc_id LONG, text STRING, id STRING, own STRING, pieces INT, n_words INT, copies INT"


def brute(rows, length):
    split = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i:i + length]) for w in split for i in range(len(w) - length + 1))
    out = []
    for (key, _), words in zip(rows, split):
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            if seen[tuple(words[i:i + length])] > 1:
                gone[i:i + length] = [True] * length
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        spans = [i for i, g in enumerate(gone) if g and not (i and gone[i - 1])]
        out.append((key, len(words), sum(gone), hashlib.sha256(kept).hexdigest(), len(spans)))
    return sorted(out, key=repr)


def rows_of(seed):
    rng = np.random.default_rng(seed)
    prose = lambda n, many=3000: " ".join(f"w{x}" for x in rng.integers(0, many, n))
    shared, base = prose(50), prose(200)
    texts = [None, "", " \n\t ", "few words only", base, base, base.replace(" ", "\n "), prose(300), shared, "x " * 500, "a b c " * 200,
             prose(4000), prose(30), prose(30), prose(400, 2), prose(400, 2), prose(34)]
    for k in range(25):  # near copies and a passage in many places
        words = base.split()
        words[int(rng.integers(0, 200))] = f"edit{k}"
        texts += [" ".join(words), f"{prose(20)} {shared} {prose(20)}", f"{shared.upper()}\v{prose(10)}"]
    rows = [(k, t) for k, t in enumerate(texts)]
    return rows + [(None, base), (3, prose(60)), (3, None), (None, None)]


@pytest.mark.parametrize("settings", [
    passages.Settings(), passages.Settings(shard=1), passages.Settings(crowded=100), passages.Settings(most=7, crowded=900),
    passages.Settings(length=8, core=3, most=16), passages.Settings(length=5, core=5)], ids=str)
def test_against_all_windows(spark, settings):
    rows = rows_of(settings.length)
    docs = spark.createDataFrame([(k, t, "i", "o", 1, 2, 3) for k, t in rows], SCHEMA).repartition(4)
    got = passages.without_passages(docs, settings).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, len(r.spans)) for r in got), key=repr) == brute(rows, settings.length)
    assert all(sum(s.end - s.begin for s in r.spans) == r.n_removed for r in got)


def test_empty(spark):
    assert passages.without_passages(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError, match="core"):
        passages.without_passages(spark.createDataFrame([], SCHEMA), passages.Settings(core=36))


@pytest.mark.parametrize("seed", range(6))
def test_automaton(seed):
    rng = np.random.default_rng(seed)
    many = [rng.integers(0, 3, int(rng.integers(0, 25))).tolist() for _ in range(6)]
    weights = rng.integers(1, 3, len(many)).tolist()
    whole = SuffixAutomaton()
    for words, weight in zip(many, weights):
        whole.add(words, weight)
    whole.finish()
    for length in (1, 2, 4):
        seen = Counter()
        for words, weight in zip(many, weights):
            for i in range(len(words) - length + 1):
                seen[tuple(words[i:i + length])] += weight
        for words in [*many, rng.integers(0, 4, 40).tolist()]:  # also a sequence that the collection does not hold
            places = [i for i in range(len(words) - length + 1) if seen[tuple(words[i:i + length])] > 1]
            assert [i for a, b in whole.repeated(words, length) for i in range(a, b)] == places

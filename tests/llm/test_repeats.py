"""Substring dedup against all strings, with crowded groups."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from tileplan.llm import repeats


def brute(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for (key, _), b in zip(rows, raw):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int((gone[:-1] & ~np.append(False, gone[:-1])[:-1]).sum())
        out.append((key, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("settings", [repeats.Settings(), repeats.Settings(batch=1500), repeats.Settings(batch=1),
                                      repeats.Settings(length=60, core=16, batch=700)], ids=str)
def test_against_all_strings(spark, settings):
    rng = np.random.default_rng(settings.length)
    prose = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 4000, n))
    shared, base = prose(130), prose(200)
    texts = [None, "", "short", base, base, "x" * 900, "é" * 500, "ab " * 400, prose(300), shared]
    for k in range(20):
        words = base.split()
        words[int(rng.integers(0, 200))] = f"edit{k}"
        texts += [" ".join(words), f"{prose(20)} {shared} {prose(20)}"]
    rows = [*enumerate(texts), (None, base), (3, prose(60)), (None, None)]
    docs = spark.createDataFrame([(k, t, "i", "o", 1) for k, t in rows], "doc_id LONG, text STRING, id STRING, spans STRING, n INT").repartition(3)
    got = repeats.without_repeats(docs, settings).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr) == brute(rows, settings.length)

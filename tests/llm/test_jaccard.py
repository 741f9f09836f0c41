"""The Jaccard join against brute force where regions are large, shingles frequent and rounds many."""

from __future__ import annotations

import random

import pytest

from test_contracts import sets_and_components
from tileplan.llm.jaccard import Settings, join


def crowd(seed):
    """Copies of two texts with up to four changed words, a passage in many texts, short texts, exact copies."""
    draw = random.Random(seed)
    def words(n):
        return [f"w{draw.randrange(3000)}" for _ in range(n)]

    bases, passage, texts = [words(60), words(45)], words(25), []
    for _ in range(110):
        copy = list(draw.choice(bases))
        for _ in range(draw.randrange(5)):
            copy[draw.randrange(len(copy))] = draw.choice(["other", "words", f"x{draw.randrange(50)}"])
        texts.append(" ".join(copy))
    texts += [" ".join(words(draw.randrange(20)) + passage + words(draw.randrange(12))) for _ in range(60)]
    texts += [" ".join(passage[:draw.randrange(1, 26)]) for _ in range(20)] + texts[:10] + ["", None, "  "]
    draw.shuffle(texts)
    return texts


def brute(texts):
    """(set size, smallest connected position) of each text by all pairs."""
    sets = [sets_and_components([t])[0][0] for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    label, moved = list(range(len(sets))), True
    while moved:
        moved = False
        for a, b in links:
            moved |= label[a] != label[b]
            label[a] = label[b] = min(label[a], label[b])
    return {k: (len(s), label[k]) for k, s in enumerate(sets)}


@pytest.mark.parametrize("settings", [Settings(), Settings(frequent=1, small=3, pivots=16),
                                      Settings(frequent=8, small=20, pivots=16, parts=3, listed=60)],
                         ids=["usual", "large regions", "few listed"])
def test_crowded_regions(spark, settings):
    texts = crowd(1)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING").repartition(3)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in join(docs, settings).collect()} == brute(texts)

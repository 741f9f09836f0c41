"""Quality rules by weak supervision.

Every rule votes good (+1), bad (-1) or abstains (0) on a document. How often each vote is right is not known, so
expectation-maximisation estimates it from how the rules agree over all documents, and the posterior probability of
good quality decides. The votes of r rules form at most 3**r patterns, so the fit needs their counts only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tileplan.llm.arrow import batch_of, slices, text_buffer
from tileplan.llm.tables import without
from tileplan.llm.words import Words, counted, duplicate_lines

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters",
            "n_stutters")


@dataclass(frozen=True)
class Rule:
    """A ratio of two measures: above ``bad`` it votes bad, up to ``good`` it votes good, else it abstains.

    Without ``good`` the rule knows bad documents only. ``floor`` turns it round: below is bad.
    """

    name: str
    part: str
    whole: str
    bad: float | None
    good: float | None = None
    floor: bool = False

    def votes(self, m: dict[str, np.ndarray]) -> np.ndarray:
        ratio = m[self.part] / np.maximum(m[self.whole] if self.whole else 1, 1)
        sign = -1 if self.floor else 1
        out = np.zeros(len(ratio), np.int8)
        if self.good is not None:
            out[sign * ratio <= sign * self.good] = 1
        if self.bad is not None:
            out[sign * ratio > sign * self.bad] = -1
        return out


RULES = (
    Rule("symbols", "n_symbols", "n_words", bad=0.1),
    Rule("stutter", "n_stutters", "n_words", bad=0.25),
    Rule("repeats", "n_repeat_words", "n_words", bad=None, good=0.02),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", bad=0.6),
    Rule("capitals", "n_upper", "n_letters", bad=0.7, good=0.1),
    Rule("long_words", "word_chars", "n_words", bad=15.0, good=6.0),
    Rule("short_words", "word_chars", "n_words", bad=2.0, floor=True),
    Rule("length", "n_words", "", bad=None, good=50, floor=True),
)


@dataclass(frozen=True)
class Settings:
    min_words: int = 10
    max_repeat_percent: int = 20
    rules: tuple[Rule, ...] = field(default=RULES)
    threshold: float = 0.5
    rounds: int = 100


def measures(values: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The measures of each text; n_stutters counts words equal to the word before."""
    words = Words(values, offsets)
    hashes = words.hashes()
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (words.text_of[1:] == words.text_of[:-1])
    folded = values | 32
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": counted(((values & 0xC0) != 0x80) & words.inside, offsets),
        "n_symbols": counted(SYMBOLS[values], offsets),
        "n_dup_lines": duplicate_lines(values, offsets),
        "n_repeat_words": words.repeated_words(),
        "n_lines": counted(values == 10, offsets) + 1,
        "n_upper": counted((values >= 65) & (values <= 90), offsets),
        "n_letters": counted((folded >= 97) & (folded <= 122), offsets),
        "n_stutters": np.bincount(words.text_of[same], minlength=words.texts).astype(np.int64),
    }


def judged(values: np.ndarray, offsets: np.ndarray, settings: Settings) -> tuple[dict, np.ndarray, np.ndarray]:
    """(measures, whether the base check failed, pattern of the votes as a number to base 3)."""
    m = measures(values, offsets)
    failed = (m["n_words"] < settings.min_words) | (
        100 * m["n_repeat_words"] > settings.max_repeat_percent * m["n_words"])
    pattern = np.zeros(len(failed), np.int64)
    for rule in settings.rules:
        pattern = pattern * 3 + rule.votes(m) + 1
    return m, failed, pattern


def posterior(patterns: np.ndarray, counts: np.ndarray, settings: Settings) -> np.ndarray:
    """Probability of good quality for each pattern, fitted to how often the patterns occur.

    The two classes start as "some rule votes bad" and "none does"; each rule has its own chance of each vote in each
    class, smoothed by one pseudo-document. An abstention says nothing about the class, as rules look for different
    faults. The start counts for half in every estimate, so that the classes keep their meaning. Stops when no probability moves by more than 1e-9.
    """
    n = len(settings.rules)
    votes = np.stack([patterns // 3 ** (n - 1 - j) % 3 for j in range(n)], 1) if len(patterns) else np.zeros((0, n), int)
    start = good = np.where((votes == 0).any(1), 0.1, 0.9)
    for _ in range(settings.rounds):
        score = np.zeros((len(patterns), 2))
        belief = (good + start) / 2
        for c, weight in enumerate((counts * (1 - belief), counts * belief)):
            score[:, c] = np.log((weight.sum() + 1) / (counts.sum() + 2))
            for j in range(n):
                chance = np.log((np.bincount(votes[:, j], weights=weight, minlength=3) + 1) / (weight.sum() + 2))
                score[:, c] += np.where(votes[:, j] == 1, 0.0, chance[votes[:, j]])
        new = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -700, 700)))
        moved = np.abs(new - good).max(initial=0)
        good = new
        if moved < 1e-9:
            break
    return good


def fit(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> dict[int, float]:
    """Posterior of every vote pattern that occurs. Documents that fail the base check don't take part."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, seen = pa.schema([("pattern", pa.int64()), ("n", pa.int64())]), {}
        for batch in slices(batches):
            _, failed, pattern = judged(*text_buffer(batch.column("text")), settings)
            for key, n in zip(*np.unique(pattern[~failed], return_counts=True), strict=True):
                seen[int(key)] = seen.get(int(key), 0) + int(n)
        yield batch_of(schema, list(seen), list(seen.values()))

    rows = (docs.select(F.col(text).alias("text")).mapInArrow(count, "pattern LONG, n LONG")
            .groupBy("pattern").agg(F.sum("n").alias("n")).collect())  # 3 ** rules rows at most
    rows = sorted((r.pattern, r.n) for r in rows)
    patterns, counts = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], float)
    return dict(zip(patterns.tolist(), posterior(patterns, counts, settings).tolist(), strict=True))


def quality(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with the measures, base_failed, quality (posterior) and kept.

    A null or empty text has no words and fails the base check; equal texts get equal verdicts; columns of ``docs``
    named like a new column are replaced. An empty table gives no rows.
    """
    added = [*MEASURES, "base_failed", "quality", "kept"]
    docs = without(docs, *added)
    good = fit(docs, settings, text)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            m, failed, pattern = judged(*text_buffer(batch.column(text)), settings)
            belief = np.array([good.get(p, 0.5) for p in pattern.tolist()])
            new = [*m.values(), failed, belief, ~failed & (belief >= settings.threshold)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, new)], names=[*batch.schema.names, *added])

    schema = StructType([*docs.schema.fields])
    for name in MEASURES:
        schema = schema.add(name, "long")
    return docs.mapInArrow(add, schema.add("base_failed", "boolean").add("quality", "double").add("kept", "boolean"))

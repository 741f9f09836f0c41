"""Language by rank-order profiles: how far the most frequent character n-grams of a document are out of place in the
profile of each language (sum of the differences of ranks; an n-gram the profile lacks counts as the profile's length).

N-grams have 1 to 3 characters, letters in small form; a run of other characters stands as one mark between words and
is part of an n-gram at its ends only. They are told apart by 51-bit hashes.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tileplan.llm.arrow import batch_of, slices, text_buffer
from tileplan.llm.words import mix

PROFILE = 300
TABLED = 0x2500
GRAM_BITS = np.uint64(51)  # 12 more number the texts of a slice, see arrow.SLICE_ROWS
FLUSH = 1 << 20


def _letters() -> np.ndarray:
    """Small form of each letter below TABLED; 1 for other characters."""
    out = np.ones(TABLED, np.uint64)
    for code in range(TABLED):
        if unicodedata.category(chr(code))[0] == "L":
            small = chr(code).lower()
            out[code] = ord(small) if len(small) == 1 else code
    return out


LETTERS = _letters()


def letters(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(letters in small form with a mark (1) around each word, text of each), one text after the other."""
    codes = np.frombuffer(values.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    chars = np.concatenate([[0], np.cumsum((values & 0xC0) != 0x80)])[offsets]
    signs = LETTERS[np.minimum(codes, TABLED - 1)]
    high = codes >= TABLED
    if high.any():
        kinds, which = np.unique(codes[high], return_inverse=True)
        signs[high] = np.array([c if chr(c).isalpha() else 1 for c in kinds.tolist()], np.uint64)[which]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(chars))
    # a mark before and after each text, then one mark for each run of marks
    first = chars[:-1] + 2 * np.arange(len(chars) - 1)
    out = np.ones(len(signs) + 2 * (len(chars) - 1), np.uint64)
    owner = np.repeat(np.arange(len(chars) - 1), np.diff(chars) + 2)
    out[np.arange(len(signs)) + 1 + 2 * text] = signs
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 1) | (out[:-1] != 1)
    keep[first] = True
    return out[keep], owner[keep]


def gram_counts(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, n-gram hash, count), by text and hash."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    signs, owner = letters(values, offsets)
    owner = owner.astype(np.uint64) << GRAM_BITS
    shift = np.uint64(21)
    parts = [(signs, owner)]
    two = (signs[:-1] << shift) | signs[1:]
    parts.append((two, owner[1:]))
    three = (two[:-1] << shift) | signs[2:]
    parts.append((three, owner[2:]))
    solid = signs != 1
    valid = [solid, (solid[:-1] | solid[1:]) & (owner[1:] == owner[:-1]), solid[1:-1] & (owner[2:] == owner[:-2])]
    key = np.sort(np.concatenate([(mix(g[v]) >> (np.uint64(64) - GRAM_BITS)) | o[v] for (g, o), v in
                                  zip(parts, valid, strict=True)]))
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(begin, len(key)))
    key = key[begin]
    return (key >> GRAM_BITS).astype(np.int64), key & ((np.uint64(1) << GRAM_BITS) - np.uint64(1)), count


def profiles(docs: DataFrame, size: int = PROFILE, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """The ``size`` most frequent n-grams of each language over all rows, most frequent first; rows without a language
    are left out. Tasks add up what they have seen, so a frequent language is not one task's load."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for name, (gram, n) in seen.items():
                yield batch_of(schema, [name] * len(gram), gram.astype(np.int64), n)
            seen.clear()

        for batch in slices(batches):
            names = np.array(batch.column("lang").to_pylist(), dtype=object)
            owner, gram, n = gram_counts(*text_buffer(batch.column("text")))
            for name in set(names.tolist()):
                at = names[owner] == name
                old = seen.get(name, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
                distinct, which = np.unique(np.concatenate([old[0], gram[at]]), return_inverse=True)
                total = np.bincount(which, weights=np.concatenate([old[1], n[at]]), minlength=len(distinct))
                seen[name] = distinct, total.astype(np.int64)
            if sum(len(g) for g, _ in seen.values()) > FLUSH:
                yield from rows()
        yield from rows()

    ranked = (docs.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
              .mapInArrow(count, "lang STRING, gram LONG, n LONG").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
              .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")))
              .where(F.col("rank") <= size).collect())  # ``size`` rows per language
    out: dict[str, list] = {}
    for row in sorted(ranked, key=lambda r: (r.lang, r.rank)):
        out.setdefault(row.lang, []).append(row.gram)
    return {name: np.array(grams, np.uint64) for name, grams in out.items()}


def nearest(values: np.ndarray, offsets: np.ndarray, known: dict[str, np.ndarray], size: int = PROFILE):
    """(name or "und", score) of each text; score is 1 less the mean distance of its n-grams over ``size``."""
    texts, names = len(offsets) - 1, sorted(known)
    owner, gram, count = gram_counts(values, offsets)
    order = np.lexsort((gram, -count, owner))
    owner, gram = owner[order], gram[order]
    rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
    top = rank < size
    owner, gram, rank = owner[top], gram[top], rank[top]
    many = np.bincount(owner, minlength=texts)
    distance = np.full((texts, len(names)), 0.0)
    for j, name in enumerate(names):
        by = np.argsort(known[name])
        profile = known[name][by]
        at = np.minimum(np.searchsorted(profile, gram), len(profile) - 1)
        out = np.where(profile[at] == gram, np.abs(rank - by[at]), size)
        distance[:, j] = np.bincount(owner, weights=out, minlength=texts)
    if not names:
        return ["und"] * texts, np.zeros(texts)
    best = distance.argmin(1)
    score = 1 - distance[np.arange(texts), best] / np.maximum(many * size, 1)
    return [names[b] if m else "und" for b, m in zip(best, many, strict=True)], np.where(many > 0, score, 0.0)


def predicted(docs: DataFrame, known: dict[str, np.ndarray], size: int = PROFILE, text: str = "text") -> DataFrame:
    """``docs`` (rows to classify) with lang_pred and score in place of ``text``; one pass, no shuffle.

    Null texts and texts without a letter are "und" with score 0, as is everything where no language is known; equal
    distances go to the first name.
    """
    others = [c for c in docs.columns if c != text and c.lower() not in ("lang_pred", "score")]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            lang, score = nearest(*text_buffer(batch.column(text)), known, size)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], pa.array(lang, pa.string()),
                                              pa.array(score)], names=[*others, "lang_pred", "score"])

    from pyspark.sql.types import StructType

    schema = StructType([docs.schema[c] for c in others]).add("lang_pred", "string").add("score", "double")
    return docs.select(*others, text).mapInArrow(add, schema)

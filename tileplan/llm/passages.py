"""Substring dedup in words: suffix automata of shards of the corpus, through which its own texts are streamed.

A window of ``length`` words goes to the shard of its key, the smallest hash of its runs of ``core`` words, so equal
windows meet and no text goes to shards that cannot match it. Neighbouring windows with one key travel as a piece. Keys
found in one place only end there; a piece whose whole content occurs twice is repeated whole. The distinct contents of
the other keys are the reference: a task builds the suffix automaton of a bounded shard of them, with occurrences,
and streams each content through it; its matching statistics give the windows that occur twice. A key whose contents
hold more than ``crowded`` words is dealt over several shards, which then compare their windows, each named once a shard.

Words are 64-bit hashes; windows and contents are told apart by two 64-bit hashes, texts by MD5. A task holds the words
of one text (some 60 bytes a byte of text) or of one shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tileplan.llm.arrow import batch_of, slices, text_buffer
from tileplan.llm.automata import SuffixAutomaton
from tileplan.llm.repeats import EMPTY, INVERSE, runs, sliding
from tileplan.llm.tables import written
from tileplan.llm.words import BASE, Words, mix, powers


@dataclass(frozen=True)
class Settings:
    length: int = 35
    core: int = 8
    most: int = 512  # windows of a piece
    shard: int = 1 << 14  # words of one automaton, or one key where it has more
    crowded: int = 1 << 16  # words of the distinct contents of a key that go to one shard, about


class Runs:
    """Hash of any run of words from running sums."""

    def __init__(self, words: np.ndarray):
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * powers(BASE, len(words))[:len(words)], out=self.sums[1:])
        self.back = powers(INVERSE, len(words) + 1)

    def of(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return mix((self.sums[start + size] - self.sums[start]) * self.back[start] + np.asarray(size, np.uint64))


def pieces(words: Words, settings: Settings):
    """(text, start, windows, key, content, may repeat inside) of each piece, in order; starts are words of the text."""
    length, core = settings.length, settings.core
    none = np.zeros(0, np.int64)
    hashed = words.hashes()
    if len(hashed) < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(bool)
    run = Runs(hashed)
    cores = run.of(np.arange(len(hashed) - core + 1), core)
    width = length - core + 1
    least = sliding(np.minimum, cores, width)
    inside = words.text_of[:len(least)] == words.text_of[length - 1:]
    at = np.flatnonzero(inside)
    if not len(at):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(bool)
    key, owner = least[at], words.text_of[at]
    head = np.append(True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]))
    place = np.arange(len(at))
    head |= (place - np.maximum.accumulate(np.where(head, place, 0))) % settings.most == 0
    first = np.flatnonzero(head)
    count = np.diff(np.append(first, len(at)))
    start, key, owner = at[first], key[first], owner[first]
    # a core that is the least of some window at two places of a text may make a piece repeat inside itself
    padded = np.concatenate([np.zeros(width - 1, np.uint64), np.where(inside, least, 0), np.zeros(width - 1, np.uint64)])
    minimal = np.flatnonzero(cores == sliding(np.maximum, padded, width)[:len(cores)])
    places = np.sort(cores[minimal] ^ mix(words.text_of[minimal].astype(np.uint64)))
    twice = np.unique(places[1:][places[1:] == places[:-1]])
    again = np.isin(key ^ mix(owner.astype(np.uint64)), twice)
    return owner, start - words.first[owner], count, key, run.of(start, count + length - 1), again


PIECE = pa.struct([("key", pa.int64()), ("content", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("again", pa.bool_())])
CUT = pa.schema([("doc_id", pa.int64()), ("id", pa.binary()), ("n_words", pa.int64()), ("sha256", pa.string()),
                 ("pieces", pa.list_(PIECE))])
SPAN = "ARRAY<STRUCT<begin: LONG, end: LONG>>"
SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def as_spans(found: list[tuple[int, int]]) -> list[dict[str, int]]:
    return [{"begin": a, "end": b} for a, b in found]


def cut(docs: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, id, n_words, sha256 of all words, pieces) of each document (doc_id, id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values, offsets = text_buffer(batch.column("text"))
            words = Words(values, offsets)
            owner, start, n, key, content, again = pieces(words, settings)
            rows = pa.StructArray.from_arrays([pa.array(key.astype(np.int64)), pa.array(content.astype(np.int64)), pa.array(start),
                                               pa.array(n), pa.array(again)], fields=list(PIECE))
            bounds = pa.array(np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32))
            data = values.tobytes()
            sha = [hashlib.sha256(b" ".join(data[a:b].split())).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield batch_of(CUT, batch.column("doc_id"), batch.column("id").cast(pa.binary()), words.counts, sha,
                           pa.ListArray.from_arrays(bounds, rows).cast(pa.list_(PIECE)))

    return docs.mapInArrow(run, "doc_id LONG, id BINARY, n_words LONG, sha256 STRING, "
                                "pieces ARRAY<STRUCT<key: LONG, content: LONG, start: LONG, n: LONG, again: BOOLEAN>>")


def contents_of(asked: DataFrame, settings: Settings) -> DataFrame:
    """(key, content, weight, size, words) of the pieces ``asked`` for in each text (text, asked)."""
    schema = pa.schema([("key", pa.int64()), ("content", pa.int64()), ("weight", pa.int64()), ("size", pa.int64()), ("words", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words(*text_buffer(batch.column("text")))
            hashed, out = words.hashes(), []
            for text, wanted in enumerate(batch.column("asked").to_pylist()):
                for p in wanted:
                    a = words.first[text] + p["start"]
                    out.append((p["key"], p["content"], p["weight"], p["size"],
                                hashed[a:a + p["n"] + settings.length - 1].tobytes()))
            yield batch_of(schema, *([list(c) for c in zip(*out)] or [[]] * 5))

    return asked.mapInArrow(run, "key LONG, content LONG, weight LONG, size LONG, words BINARY")


HELD = ("key", "shard", "content", "weight", "words")


def streamed(contents: DataFrame, settings: Settings) -> DataFrame:
    """(key, content, spans): window starts that occur again in a shard; ``contents`` come with those of a (key, shard)
    together, and small ones share an automaton."""
    schema = pa.schema([("key", pa.int64()), ("content", pa.int64()), ("spans", SPANS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def found() -> pa.RecordBatch:
            automaton = SuffixAutomaton()
            for *_, weight, words in held:
                automaton.add(words, weight)
            automaton.finish()
            rows = [(key, content, as_spans(automaton.repeated(words, settings.length)))
                    for key, _, content, weight, words in held if weight == 1]  # others are repeated whole
            return batch_of(schema, *([list(c) for c in zip(*rows)] or [[]] * 3))

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in HELD), strict=True):
                if size > settings.shard and row[:2] != held[-1][:2]:
                    yield found()
                    held.clear()
                    size = 0
                held.append((*row[:-1], np.frombuffer(row[-1], np.uint64).tolist()))
                size += len(held[-1][-1])
        if held:
            yield found()

    return contents.mapInArrow(run, f"key LONG, content LONG, spans {SPAN}").where(F.size("spans") > 0)


def across(contents: DataFrame, settings: Settings) -> DataFrame:
    """(key, content, spans): window starts of the contents of crowded keys that occur in two shards or more. Each shard
    names each of its windows once, with the place of one that it has once."""
    schema = pa.schema([("key", pa.int64()), ("window", pa.int64()), ("weight", pa.int64()), ("content", pa.int64()), ("at", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def named() -> pa.RecordBatch:
            words = [np.frombuffer(row[-1], np.uint64) for row in held]
            many = np.array([len(w) - settings.length + 1 for w in words], np.int64)
            window = np.concatenate([Runs(w).of(np.arange(n), settings.length) for w, n in zip(words, many)])
            row_of = np.repeat(np.arange(len(held)), many)
            at = np.arange(len(window)) - np.repeat(np.cumsum(many) - many, many)
            distinct, first, which = np.unique(window, return_index=True, return_inverse=True)
            weight = np.bincount(which, np.array([row[3] for row in held], float)[row_of]).astype(np.int64)
            content = np.array([row[2] for row in held], np.int64)[row_of[first]]
            return batch_of(schema, np.full(len(distinct), held[0][0], np.int64), distinct.astype(np.int64),
                            np.minimum(weight, 2), content, at[first])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in HELD), strict=True):
                if held and row[:2] != held[-1][:2]:
                    yield named()
                    held.clear()
                held.append(row)
        if held:
            yield named()

    windows = written(contents.mapInArrow(run, "key LONG, window LONG, weight LONG, content LONG, at LONG"), "windows")
    often = windows.groupBy("key", "window").agg(F.sum("weight").alias("many")).where("many > 1").select("key", "window")
    own = windows.where("weight = 1").join(often, ["key", "window"], "left_semi")
    span = F.struct(F.col("at").alias("begin"), (F.col("at") + 1).alias("end"))
    return own.groupBy("key", "content").agg(F.collect_list(span).alias("spans"))  # windows of one piece


def removed(texts: DataFrame, settings: Settings) -> DataFrame:
    """(id, spans, n_removed, kept_sha256) of (id, text, own): maximal runs of words that the windows of ``own`` cover."""
    schema = pa.schema([("id", pa.binary()), ("spans", SPANS), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text, own in zip(batch.column("text").to_pylist(), batch.column("own").to_pylist(), strict=True):
                words = text.encode("utf-8").split()
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, [s["begin"] for s in own], 1)
                np.add.at(change, [s["end"] - 1 + settings.length for s in own], -1)
                gone = np.cumsum(change[:-1]) > 0
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                out.append((as_spans(runs(gone)), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
            yield batch_of(schema, batch.column("id").cast(pa.binary()), *[list(c) for c in zip(*out)])

    return texts.mapInArrow(run, f"id BINARY, spans {SPAN}, n_removed LONG, kept_sha256 STRING")


def without_passages(docs: DataFrame, settings: Settings = Settings(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, spans (removed runs, begin and end in words).

    A null text has no words; texts shorter than ``length`` words lose nothing; a longer text that occurs twice loses all;
    rows with equal or null keys are documents of their own; an empty table gives no rows.
    """
    if not 0 < settings.core <= settings.length:
        raise ValueError("core must be between 1 and length")
    docs = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    named = docs.withColumn("id", F.unhex(F.md5("text")))
    cuts = written(cut(named, settings), "cuts")
    copies = cuts.groupBy("id").agg(F.count("*").alias("copies"))
    once = cuts.where(F.size("pieces") > 0).select("id", "pieces").dropDuplicates(["id"])
    every = written(once.select("id", F.explode("pieces").alias("p")).select("id", "p.*"), "pieces")
    place = F.xxhash64("id", "start")
    keys = every.groupBy("key").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.max("again").alias("r")).where(
        "a <> b OR r").select("key")
    candidates = written(every.join(keys, "key", "left_semi"), "candidates")
    contents = written(candidates.groupBy("key", "content").agg(
        F.min(place).alias("a"), F.max(place).alias("b"), F.max("again").alias("again"), F.min(F.struct("id", "start", "n")).alias("one"))
        .select("key", "content", F.when(F.col("a") != F.col("b"), 2).otherwise(1).cast("long").alias("weight"), "again", "one.*"), "contents")
    groups = contents.groupBy("key").agg(
        F.count("*").alias("many"), F.max("again").alias("r"), F.min("weight").alias("least"),
        F.sum(F.col("n") + settings.length - 1).alias("size")).where("least = 1 AND (many > 1 OR r)").select("key", "size")
    asked = contents.join(groups, "key").groupBy("id").agg(F.collect_list(F.struct(
        "key", "content", "weight", "size", "start", "n")).alias("asked"))  # pieces of one text
    reference = written(contents_of(one_text(named, asked), settings), "reference")
    shards = F.greatest(F.ceil(F.col("size") / max(settings.crowded, 1)), F.lit(1))
    dealt = reference.withColumn("shard", F.pmod(F.xxhash64("content"), shards).cast("long"))
    crowded = dealt.where(F.col("size") > settings.crowded)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n").alias("end")))
    spans = (contents.where("weight > 1").select("key", "content", whole.alias("spans"))
             .union(streamed(together(dealt), settings))
             .union(across(together(crowded), settings)))
    found = candidates.select("key", "content", "id", "start").join(spans, ["key", "content"]).groupBy("id").agg(F.flatten(
        F.collect_list(F.expr("transform(spans, s -> struct(s.begin + start AS begin, s.end + start AS end))"))).alias("own"))
    changed = written(removed(one_text(named, found), settings), "changed")
    repeated = (F.col("copies") > 1) & (F.col("n_words") >= settings.length)
    everything = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_words").alias("end")))
    return cuts.drop("pieces").join(copies, "id").join(changed, "id", "left").select(
        "doc_id", "n_words",
        F.when(repeated, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(repeated, F.lit(EMPTY)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        F.when(repeated, everything).otherwise(F.coalesce("spans", F.slice(everything, 1, 0))).alias("spans"))


def together(dealt: DataFrame) -> DataFrame:
    """The contents of a (key, shard) next to each other in one task."""
    return dealt.repartition("key", "shard").sortWithinPartitions("key", "shard")


def one_text(named: DataFrame, of: DataFrame) -> DataFrame:
    """The rows of ``of`` (id, ...), one an id, with the text."""
    return named.select("id", "text").join(of, "id").dropDuplicates(["id"])

"""Substring dedup: remove every byte that a long enough string occurring elsewhere covers, on a suffix order.

All strings of ``length`` bytes are compared, but not on one machine: each goes to the group of its minimizer, the
smallest hash of its substrings of ``core`` bytes, so equal strings meet. Neighbouring strings with the same minimizer
travel as one piece. A group with one piece has no repeat; a piece whose whole content occurs twice is repeated whole,
so copies are counted, not compared; the distinct pieces of the other groups are put side by side and the
Burrows-Wheeler transform of suffixes.py finds what they share. A group of very many distinct pieces is dealt over several
transforms, which then compare their strings, each named once by each.

Texts are told apart by MD5, pieces of a group by 64-bit hashes; a text that occurs twice is counted once. A task holds
one text (some 60 bytes a byte of it) or the pieces of one transform.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tileplan.llm.arrow import batch_of, slices, text_buffer
from tileplan.llm.suffixes import repeated_starts
from tileplan.llm.tables import written
from tileplan.llm.words import BASE, mix, powers

SIGNS = mix(np.arange(1, 257, dtype=np.uint64))
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
EMPTY = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class Settings:
    length: int = 400
    core: int = 128
    batch: int = 1 << 20  # bytes that one transform takes, about; a group with more is dealt over several


class Hashes:
    """Hash of any substring of a buffer from running sums."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(SIGNS[values] * powers(BASE, n), out=self.sums[1:])
        self.back = powers(INVERSE, n + 1)

    def of(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return mix((self.sums[start + size] - self.sums[start]) * self.back[start] + np.asarray(size, np.uint64))


def sliding(pick, values: np.ndarray, width: int) -> np.ndarray:
    """Minimum or maximum of each window of ``width`` values."""
    out, have = values, 1
    while have * 2 <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return pick(out[:len(out) - rest], out[rest:]) if rest else out


def pieces(values: np.ndarray, offsets: np.ndarray, length: int, core: int):
    """(text, start, number of strings, key, content, may repeat inside) of each piece; see the module."""
    none = np.zeros(0, np.int64)
    if len(values) < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(bool)
    hashes = Hashes(values)
    cores = hashes.of(np.arange(len(values) - core + 1), core)
    width = length - core + 1
    least = sliding(np.minimum, cores, width)
    text = np.searchsorted(offsets, np.arange(len(least)), "right") - 1
    inside = np.arange(len(least)) + length <= offsets[1:][text]
    at = np.flatnonzero(inside)
    if not len(at):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(bool)
    key, owner = least[at], text[at]
    head = np.append(True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1))
    first = np.flatnonzero(head)
    count = np.diff(np.append(first, len(at)))
    start, key, owner = at[first], key[first], owner[first]
    content = hashes.of(start, count + length - 1)
    # a core that is the minimum of its text's strings at two places may make a piece repeat inside itself
    padded = np.concatenate([np.zeros(width - 1, np.uint64), np.where(inside, least, 0), np.zeros(width - 1, np.uint64)])
    minimal = np.flatnonzero(cores == sliding(np.maximum, padded, width)[:len(cores)])
    places = np.sort(cores[minimal] ^ mix((np.searchsorted(offsets, minimal, "right") - 1).astype(np.uint64)))
    twice = np.unique(places[1:][places[1:] == places[:-1]])
    mine = key ^ mix(owner.astype(np.uint64))
    again = np.zeros(len(mine), bool)
    if len(twice):
        again = twice[np.minimum(np.searchsorted(twice, mine), len(twice) - 1)] == mine
    return owner, start - offsets[owner], count, key, content, again


PIECES = "key LONG, content LONG, id BINARY, start LONG, n LONG, again BOOLEAN"
SPANS = "key LONG, content LONG, spans ARRAY<STRUCT<begin: LONG, end: LONG>>"
PIECE_SCHEMA = pa.schema([("key", pa.int64()), ("content", pa.int64()), ("id", pa.binary()), ("start", pa.int64()),
                          ("n", pa.int64()), ("again", pa.bool_())])
SPAN_LIST = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
SPAN_SCHEMA = pa.schema([("key", pa.int64()), ("content", pa.int64()), ("spans", SPAN_LIST)])
HELD = ("key", "shard", "content", "weight", "bytes")


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def cut(texts: DataFrame, settings: Settings) -> DataFrame:
    """The pieces of all texts (id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("id")
            owner, start, n, key, content, again = pieces(*text_buffer(batch.column("text")), settings.length, settings.core)
            yield batch_of(PIECE_SCHEMA, key.astype(np.int64), content.astype(np.int64), ids.take(pa.array(owner)).cast(
                pa.binary()), start, n, again)

    return texts.mapInArrow(run, PIECES)


def shared_by_transform(grouped: DataFrame, settings: Settings) -> DataFrame:
    """Spans of strings that occur again among the pieces of a (key, shard), relative to each piece; ``grouped`` (key,
    shard, content, weight, bytes) comes with those together, and small ones share a transform."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def found() -> pa.RecordBatch:
            rows = [(key, content, [{"begin": a, "end": b} for a, b in runs(flags)]) for (key, _, content, _, _), flags in zip(
                held, repeated_starts([row[-1] for row in held], settings.length), strict=True)]
            return batch_of(SPAN_SCHEMA, *([list(c) for c in zip(*[r for r in rows if r[2]])] or [[]] * 3))

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in HELD), strict=True):
                if size > settings.batch and row[:2] != held[-1][:2]:
                    yield found()
                    held.clear()
                    size = 0
                held.append(row)
                size += len(row[-1])
        if held:
            yield found()

    return grouped.mapInArrow(run, SPANS)


def shared_by_string(crowded: DataFrame, settings: Settings) -> DataFrame:
    """The same between the shards of crowded groups: each shard names each of its strings once, with the place of one
    that it has once."""
    schema = pa.schema([(c, pa.int64()) for c in ("key", "string", "weight", "content", "at")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def named() -> pa.RecordBatch:
            many = np.array([len(row[-1]) - settings.length + 1 for row in held], np.int64)
            string = np.concatenate([Hashes(np.frombuffer(row[-1], np.uint8)).of(np.arange(n), settings.length)
                                     for row, n in zip(held, many.tolist(), strict=True)])
            row_of = np.repeat(np.arange(len(held)), many)
            at = np.arange(len(string)) - np.repeat(np.cumsum(many) - many, many)
            distinct, first, which = np.unique(string, return_index=True, return_inverse=True)
            weight = np.bincount(which, np.array([row[3] for row in held], float)[row_of]).astype(np.int64)
            return batch_of(schema, np.full(len(distinct), held[0][0], np.int64), distinct.astype(np.int64), np.minimum(weight, 2),
                            np.array([row[2] for row in held], np.int64)[row_of[first]], at[first])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in HELD), strict=True):
                if held and row[:2] != held[-1][:2]:
                    yield named()
                    held.clear()
                held.append(row)
        if held:
            yield named()

    strings = written(crowded.mapInArrow(run, "key LONG, string LONG, weight LONG, content LONG, at LONG"), "strings")
    often = strings.groupBy("key", "string").agg(F.sum("weight").alias("many")).where("many > 1").select("key", "string")
    own = strings.where("weight = 1").join(often, ["key", "string"], "left_semi")
    return own.groupBy("key", "content").agg(F.collect_list(F.struct(
        F.col("at").alias("begin"), (F.col("at") + 1).alias("end"))).alias("spans"))  # places of one piece


def merged(spans: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """(id, spans, n_removed, kept_sha256): per text its maximal removed runs; ``spans`` are of string starts."""
    schema = pa.schema([("id", pa.binary()), ("spans", SPAN_LIST), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text, own in zip(batch.column("text").to_pylist(), batch.column("own").to_pylist(), strict=True):
                data = text.encode("utf-8")
                change = np.zeros(len(data) + 1, np.int64)
                np.add.at(change, [s["begin"] for s in own], 1)
                np.add.at(change, [s["end"] - 1 + settings.length for s in own], -1)
                gone = np.cumsum(change[:-1]) > 0
                out.append(([{"begin": a, "end": b} for a, b in runs(gone)], int(gone.sum()), hashlib.sha256(
                    np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest()))
            yield batch_of(schema, batch.column("id").cast(pa.binary()), *([list(c) for c in zip(*out)]))

    own = spans.groupBy("id").agg(F.flatten(F.collect_list("spans")).alias("own"))  # one text's own places
    return texts.join(own, "id").select("id", "text", "own").mapInArrow(
        run, "id BINARY, spans ARRAY<STRUCT<begin: LONG, end: LONG>>, n_removed LONG, kept_sha256 STRING")


def without_repeats(docs: DataFrame, settings: Settings = Settings(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (begin, end in bytes).

    A null text is empty; texts shorter than ``length`` lose nothing; a text that occurs twice loses all; rows with
    equal keys are documents of their own; an empty table gives no rows.
    """
    docs = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    named = docs.withColumn("id", F.unhex(F.md5("text")))
    listed = written(named.select("key", "id", F.octet_length("text").cast("long").alias("n_bytes"),
                                  F.sha2("text", 256).alias("sha256")), "texts")
    copies = listed.groupBy("id").agg(F.count("*").alias("copies"), F.min("key").alias("key"))
    all_pieces = written(cut(named, settings), "pieces")
    place = F.xxhash64("id", "start")
    keys = all_pieces.groupBy("key").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.max("again").alias("r")).where(
        "a <> b OR r").select("key")
    candidates = written(all_pieces.join(keys, "key", "left_semi"), "candidates")
    contents = candidates.groupBy("key", "content").agg(
        F.min(place).alias("a"), F.max(place).alias("b"), F.max("again").alias("again"),
        F.min(F.struct("id", "start", "n")).alias("one"))
    contents = written(contents.select("key", "content", (F.col("a") != F.col("b")).alias("often"), "again", "one.*"), "contents")
    groups = contents.groupBy("key").agg(
        F.count("*").alias("many"), F.max("again").alias("r"), F.sum(F.col("n") + settings.length - 1).alias("size")).where(
        "many > 1 OR r").select("key", "size")
    chosen = candidates.select("id").distinct()
    one = copies.join(chosen, "id", "left_semi").select("id", "key")
    texts = written(named.alias("d").join(one.alias("o"), F.expr("d.key <=> o.key AND d.id = o.id")).select(
        "d.id", "d.text").dropDuplicates(["id"]), "chosen-texts")
    shards = F.greatest(F.ceil(F.col("size") / settings.batch), F.lit(1))
    asked = written(contents.join(groups, "key").join(texts, "id").select(
        "key", F.pmod(F.xxhash64("content"), shards).cast("long").alias("shard"), "content", "size",
        F.when(F.col("often"), 2).otherwise(1).cast("long").alias("weight"),
        F.expr(f"substring(encode(text, 'UTF-8'), int(start) + 1, int(n) + {settings.length - 1})").alias("bytes")), "asked")
    together = lambda df: df.repartition("key", "shard").sortWithinPartitions("key", "shard", "content").select(*HELD)
    whole_piece = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n").alias("end")))
    spans = (contents.where("often").select("key", "content", whole_piece.alias("spans"))
             .union(shared_by_transform(together(asked), settings))
             .union(shared_by_string(together(asked.where(F.col("size") > settings.batch)), settings)))
    spans = spans.groupBy("key", "content").agg(F.flatten(F.collect_list("spans")).alias("spans"))  # three lists at most
    placed = candidates.select("key", "content", "id", "start").join(spans, ["key", "content"]).select(
        "id", F.expr("transform(spans, s -> struct(s.begin + start AS begin, s.end + start AS end))").alias("spans"))
    removed = merged(placed, texts, settings)
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= settings.length)
    everything = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end")))
    spans_of = F.when(whole, everything).otherwise(F.coalesce("spans", F.slice(everything, 1, 0)))
    return (listed.join(copies.select("id", "copies"), "id").join(removed, "id", "left").select(
        F.col("key").alias("doc_id"), "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.size(spans_of).cast("long").alias("n_spans"),
        F.when(whole, F.lit(EMPTY)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        spans_of.alias("spans")))

"""Token ids of a corpus as flat binary files that readers map into memory.

A folder holds, for every part p, ``p.bin`` (the ids of its documents one after the other, unsigned 16 bits if the
vocabulary fits, else 32, little-endian), ``p.off`` (signed 64-bit place of each document's first id counted over
all parts, and one more for the end) and ``p.ids`` (signed 64-bit document ids), and ``index.json`` (type, and for
each part its documents, null document ids and first place). Parts are in ascending order of document id.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tileplan.llm.arrow import batch_of, slices, text_buffer
from tileplan.llm.bpe import encoder, with_end

PART = pa.schema([("part", pa.int64()), ("docs", pa.int64()), ("nulls", pa.int64()), ("tokens", pa.int64())])


def _name(folder: str, part: int, kind: str) -> str:
    return f"{folder}/{part:06d}.{kind}"


def _replace(path: str, *arrays: np.ndarray) -> None:
    """Write a small file whole, or not at all; a repeated task writes the same."""
    own = f"{path}.{os.getpid()}"
    with open(own, "wb") as out:
        for array in arrays:
            array.tofile(out)
    os.replace(own, path)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int, text: str = "text",
                 key: str = "doc_id") -> dict:
    """Encode all documents into ``folder``, which every executor has mounted; returns the content of index.json.

    Documents are range-partitioned by ``key`` and sorted by it (nulls first, equal keys by text), so each part
    is one task's output and no task holds more than a slice of texts. The driver sees one row per part: where a part
    begins is the sum of the tokens of the parts before. A null text is encoded as an empty one.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, coder = TaskContext.get().partitionId(), encoder(tokenizer)
        os.makedirs(folder, exist_ok=True)
        own = f"{_name(folder, part, 'bin')}.{os.getpid()}"
        sizes, keys, nulls, total = [], [], 0, 0
        with open(own, "wb") as out:
            for batch in slices(batches):
                ids, offsets = with_end(*coder.encode(*text_buffer(batch.column("text"))), end_id)
                ids.tofile(out)
                sizes.append(np.diff(offsets))
                nulls += batch.column("key").null_count
                keys.append(batch.column("key").fill_null(0).to_numpy())
                total += len(ids)
        if not sizes:
            os.remove(own)
            return
        os.replace(own, _name(folder, part, "bin"))
        _replace(_name(folder, part, "len"), np.concatenate(sizes).astype(np.int64))
        _replace(_name(folder, part, "ids"), np.concatenate(keys).astype(np.int64))
        yield batch_of(PART, [part], [sum(map(len, sizes))], [nulls], [total])

    rows = (docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
            .repartitionByRange(F.col("key").asc_nulls_first(), F.md5(F.coalesce(F.col("text"), F.lit(""))))
            .sortWithinPartitions(F.col("key").asc_nulls_first(), F.md5(F.coalesce(F.col("text"), F.lit(""))))
            .mapInArrow(encode, "part LONG, docs LONG, nulls LONG, tokens LONG").collect())  # one row per part
    rows = sorted(rows)
    bases = [0, *accumulate(r.tokens for r in rows)]
    parts = [{"part": r.part, "docs": r.docs, "nulls": r.nulls, "start": b} for r, b in zip(rows, bases)]
    index = {"dtype": np.dtype(encoder(tokenizer).dtype).str, "parts": parts, "tokens": bases[-1]}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, start in zip(batch.column("part").to_pylist(), batch.column("start").to_pylist(), strict=True):
                sizes = np.fromfile(_name(folder, part, "len"), np.int64)
                _replace(_name(folder, part, "off"), np.concatenate([[0], np.cumsum(sizes)]) + start)
            yield batch

    each_part(docs, parts).mapInArrow(place, "part LONG, start LONG, nulls LONG").write.format("noop").mode("overwrite").save()
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/index.json", "w") as out:
        json.dump(index, out)
    return index


def each_part(docs: DataFrame, parts: list[dict]) -> DataFrame:
    """One row per part, one task each."""
    rows = [(p["part"], p["start"], p["nulls"]) for p in parts]
    spark = docs.sparkSession
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, max(1, len(rows))),
                                 "part LONG, start LONG, nulls LONG")


class TokenPart:
    """One part, mapped into memory."""

    def __init__(self, folder: str, part: int, dtype: str):
        self.keys = np.fromfile(_name(folder, part, "ids"), np.int64)
        self.offsets = np.memmap(_name(folder, part, "off"), np.int64, "r")
        self.ids = np.memmap(_name(folder, part, "bin"), np.dtype(dtype), "r")

    def document(self, i: int) -> np.ndarray:
        base = self.offsets[0]
        return self.ids[self.offsets[i] - base:self.offsets[i + 1] - base]


def read_tokens(docs: DataFrame, folder: str, index: dict) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32 (of its ids as little-endian unsigned 32 bits)."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, nulls in zip(batch.column("part").to_pylist(), batch.column("nulls").to_pylist(), strict=True):
                files = TokenPart(folder, part, index["dtype"])
                for begin in range(0, len(files.keys), 1 << 16):
                    rows = np.arange(begin, min(begin + (1 << 16), len(files.keys)))
                    crc = [zlib.crc32(files.document(i).astype("<u4").tobytes()) for i in rows]
                    start = np.asarray(files.offsets[rows])
                    yield batch_of(schema, pa.array(files.keys[rows], mask=rows < nulls), start,
                                   np.asarray(files.offsets[rows + 1]) - start, crc)

    return each_part(docs, index["parts"]).mapInArrow(read, "doc_id LONG, start LONG, n_tokens LONG, ids_crc32 LONG")

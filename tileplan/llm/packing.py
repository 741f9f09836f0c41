"""Best-fit packing of documents into sequences of a fixed capacity.

Bulk-synchronous best fit: documents and gaps are ordered by size, and in one step all documents of a length act at
once. Each looks for its successor, the smallest gap that holds it; documents with the same successor are told apart
by rank, each gap takes one, the gaps shrink, and the step repeats until none of that length fits, when the rest open
new sequences. Documents of one length are alike but for their rank, and so are gaps of one size, so a step needs
their counts only: at most ``capacity`` lengths, whatever the number of documents. Tokens, counts, ranks and
placement are Spark's.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tileplan.llm.arrow import batch_of, slices, text_buffer
from tileplan.llm.bpe import encoder, with_end
from tileplan.llm.tables import written

PIECE_SCHEMA = "doc_id LONG, piece INT, start LONG, length LONG, ids_crc32 LONG"
RANKED_ROWS = 4096


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024, keep_ids: bool = False,
           text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents' ids and ``end_id``, cut into pieces of ``capacity`` where longer; the first piece takes the rest.

    ``keep_ids`` adds the ids of each piece (array). A null text counts as an empty one, which is the end id alone.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), *[("ids", pa.list_(pa.int32()))] * keep_ids])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for batch in slices(batches):
            ids, offsets = with_end(*coder.encode(*text_buffer(batch.column("text"))), end_id)
            ids, sizes = ids.astype("<u4"), np.diff(offsets)
            count = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            first = sizes - (count - 1) * capacity
            start = np.where(piece == 0, 0, first[row] + (piece - 1) * capacity)
            length = np.where(piece == 0, first[row], capacity)
            begin = offsets[row] + start
            spans = list(zip(begin.tolist(), (begin + length).tolist(), strict=True))
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in spans]
            more = [pa.array([ids[a:b].astype(np.int32) for a, b in spans], pa.list_(pa.int32()))] * keep_ids
            yield batch_of(schema, batch.column("key").take(pa.array(row)), piece, start, length, crc, *more)

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(
        cut, PIECE_SCHEMA + ", ids ARRAY<INT>" * keep_ids)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, rank_from, rank_to, sequence_from, offset): the documents of a length with these ranks go to as
    many sequences from sequence_from on, at that offset."""
    out: list[tuple[int, int, int, int, int]] = []
    gaps: list[int] = []  # sizes of gaps, ascending
    open_: dict[int, list[tuple[int, int]]] = {}  # gap: runs (first sequence, number)
    opened = 0

    def release(gap: int, first: int, n: int) -> None:
        if gap:
            if gap not in open_:
                bisect.insort(gaps, gap)
            open_.setdefault(gap, []).append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(gaps, length)
            if at == len(gaps):  # no successor: open as many sequences as these documents fill
                n = -(-left // (capacity // length))
                release(capacity, opened, n)
                opened += n
                continue
            gap = gaps.pop(at)
            for first, n in open_.pop(gap):  # sweep over the gaps of this size
                taken = min(n, left)
                if taken:
                    out.append((length, rank, rank + taken, first, capacity - gap))
                    release(gap - length, first, taken)
                if n > taken:
                    release(gap, first + taken, n - taken)
                rank, left = rank + taken, left - taken
    return out


def pack(cut: DataFrame, capacity: int = 1024) -> DataFrame:
    """``cut`` (rows with a ``length`` from 1 to ``capacity``) with sequence_id and offset.

    ``cut`` is read three times and must give the same rows each time, best from a written table; ``_row``, if there,
    is a distinct number of each row. Equal rows are packed as often as they occur.
    """
    spark = cut.sparkSession
    row = F.col("_row") if "_row" in cut.columns else F.monotonically_increasing_id()
    bucketed = cut.drop("sequence_id", "offset").withColumn("_row", row).withColumn(
        "_bucket", F.pmod(F.xxhash64("_row"), F.lit(max(1, cut.count() // RANKED_ROWS))))
    sizes = bucketed.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    counts = {r.length: r.n for r in sizes.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # <= capacity rows
    rows = plan(counts, capacity)
    placed = spark.createDataFrame(rows, "length LONG, _from LONG, _to LONG, _sequence LONG, offset LONG")
    before = sizes.withColumn("_before", F.sum("_n").over(
        Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))).drop("_n")
    ranked = (bucketed.join(before, ["length", "_bucket"])
              .withColumn("_rank", F.coalesce(F.col("_before"), F.lit(0)) - 1 + F.row_number().over(
                  Window.partitionBy("length", "_bucket").orderBy("_row"))))
    joined = ranked.alias("r").join(F.broadcast(placed.alias("p")), F.expr(
        "r.length = p.length AND r._rank >= p._from AND r._rank < p._to"))
    return joined.select(*[F.col(f"r.`{c}`") for c in cut.columns if c not in ("sequence_id", "offset", "_row")],
                         F.expr("p._sequence + r._rank - p._from").alias("sequence_id"), F.col("p.offset"))


def packed(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024) -> DataFrame:
    """Pieces of all documents with their place; see ``pieces`` and ``pack``. The pieces are written once, as encoding
    is the dear part. An empty table gives no rows; documents with equal or null keys stay apart."""
    cut = pieces(docs, tokenizer, end_id, capacity).withColumn("_row", F.monotonically_increasing_id())
    return pack(written(cut, "pieces"), capacity)

"""Prefix trie of conversations: union-find over the common prefixes of sorted neighbours, deepest first.

A conversation is the sequence of the 16-byte digests (MD5) of its turns, so sorted sequences have common prefixes
side by side, and equal conversations are one row with a count. The rows are sorted over all tasks into parts. Inside a
part every pair of neighbours is an edge as deep as their common prefix; joining the components of the edges from the
deepest up makes each component a branching node of the trie, whose members are a run of rows. A prefix that ends in no
branching node has the members of the node below.

A prefix that neighbouring parts share is open: what it has in a part is a sum (members, children, leaves, words), so
the forests of parts are contracted to their open prefixes, at most the length of two conversations a part, and merged by
adding. What a part needs to know about its neighbours are two numbers, the common prefixes at its ends.

A conversation travels as 24 bytes a turn and is the largest unit that a task holds, besides the distinct conversations
of its part; texts are read once. Turns and prefixes are told apart by their MD5.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tileplan.llm.arrow import batch_of
from tileplan.llm.mixing import words_in
from tileplan.llm.tables import written
from tileplan.session import small_table

WIDE = 16  # bytes of a digest
NO_ENDS = hashlib.sha256(b"").hexdigest()
CHUNK = 4096  # conversation ids that travel as one row

PAIR = StructType([StructField("part", IntegerType()), StructField("next", IntegerType())])


def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, seq, words) for each conversation: digests of its turns one after the other, and the words of each.

    Turns are in order of ``turn``, null first, those of equal number by their digest. Null roles and texts are empty;
    rows without a conversation id belong to none and are left out.
    """
    name, said = F.coalesce(F.col(f"`{role}`"), F.lit("")), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.octet_length(name).cast("string"), F.lit(":"), name, said)))
    rows = turns.select(F.col(f"`{conv}`").cast("long").alias("conv_id"), F.struct(
        F.col(f"`{turn}`").alias("turn"), digest.alias("digest"), words_in(said).cast("long").alias("words")).alias("t")).where(
        "conv_id IS NOT NULL")
    own = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return own.select("conv_id", F.unhex(F.array_join(F.transform("t.digest", F.hex), "")).alias("seq"),
                      F.col("t.words").alias("words"))


def rebuilt(own: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Each conversation c begins with the first h turns of conversation c - c % ``group``, h = crc32(c) % ``most``, and
    goes on with its own turns after the first h. Where that conversation is missing, nothing comes first."""
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    donors = own.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("_donor"), F.expr(f"substring(seq, 1, {WIDE * (most - 1)})").alias("_first"),
        F.slice("words", 1, most - 1).alias("_words"))
    named = own.withColumn("_donor", F.col("conv_id") - F.col("conv_id") % group).withColumn("_h", h)
    none = F.expr("CAST('' AS BINARY)")
    return named.join(donors, "_donor", "left").select(
        "conv_id",
        F.concat(F.coalesce(F.expr(f"substring(_first, 1, {WIDE} * _h)"), none), F.expr(f"substring(seq, {WIDE} * _h + 1)")).alias("seq"),
        F.concat(F.coalesce(F.slice("_words", F.lit(1), F.col("_h")), F.slice("words", 1, 0)),
                 F.slice("words", F.col("_h") + 1, F.greatest(F.size("words"), F.lit(1)))).alias("words"))


def member_hashes(ids: DataFrame) -> DataFrame:
    """(seq_id, conv_id, n, ends_sha256) of (seq_id, conv_id): smallest id, number, and the SHA-256 of the ascending ids.

    The ids of a sequence are sorted over many tasks and joined to chunks there, so that the task which hashes a hot
    sequence reads one row for thousands of ids, as a stream.
    """
    chunk = pa.schema([("seq_id", pa.binary()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of one sequence inside a batch, of CHUNK ids at most."""
        for batch in batches:
            conv, seq = batch.column("conv_id").to_numpy(), batch.column("seq_id").cast(pa.binary())
            if not len(conv):
                continue
            key = np.frombuffer(b"".join(seq.to_pylist()), f"V{WIDE}")
            head = np.append(True, key[1:] != key[:-1])
            start = np.flatnonzero(head)
            start = np.unique(np.concatenate([np.arange(a, b, CHUNK) for a, b in zip(start, np.append(start[1:], len(conv)))]))
            end = np.append(start[1:], len(conv))
            yield batch_of(chunk, seq.take(pa.array(start)), conv[start], end - start, [
                ",".join(map(str, conv[a:b].tolist())).encode() for a, b in zip(start, end)])

    out = pa.schema([("seq_id", pa.binary()), ("conv_id", pa.int64()), ("n", pa.int64()), ("ends_sha256", pa.string())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, done = None, []
        for batch in batches:
            for seq, first, n, ids in zip(*(batch.column(c).to_pylist() for c in chunk.names), strict=True):
                if seq != key:
                    if key is not None:
                        done.append((key, least, total, sha.hexdigest()))
                    key, least, total, sha = seq, first, 0, hashlib.sha256()
                elif total:
                    sha.update(b",")
                sha.update(ids)
                total += n
            if len(done) >= CHUNK:
                yield batch_of(out, *map(list, zip(*done)))
                done = []
        if key is not None:
            done.append((key, least, total, sha.hexdigest()))
            yield batch_of(out, *map(list, zip(*done)))

    joined = ids.repartitionByRange("seq_id", "conv_id").sortWithinPartitions("seq_id", "conv_id").mapInArrow(
        chunks, "seq_id BINARY, first LONG, n LONG, ids BINARY")
    return joined.repartition("seq_id").sortWithinPartitions("seq_id", "first").mapInArrow(
        hashed, "seq_id BINARY, conv_id LONG, n LONG, ends_sha256 STRING")


def common(a: bytes, b: bytes) -> int:
    """Turns that two sequences begin with in common."""
    n = min(len(a), len(b)) // WIDE
    differ = np.flatnonzero(np.frombuffer(a, f"V{WIDE}", n) != np.frombuffer(b, f"V{WIDE}", n))
    return int(differ[0]) if len(differ) else n


class Forest:
    """The trie of sorted distinct sequences as compressed nodes: run of rows [low, high], depth, smallest member, parent,
    children. Row i's own end is node i."""

    def __init__(self, shared: np.ndarray, length: np.ndarray, conv: np.ndarray):
        """``shared[i]``: common prefix of rows i - 1 and i, for i > 0; ``length``: turns of each row."""
        m = len(length)
        self.low, self.high, self.depth, self.least = list(range(m)), list(range(m)), length.tolist(), conv.tolist()
        self.parent, self.children = [-1] * m, [0] * m
        leader, top = list(range(m)), list(range(m))  # union-find over rows; the highest node of each component

        def find(x: int) -> int:
            while leader[x] != x:
                leader[x] = leader[leader[x]]
                x = leader[x]
            return x

        edges = np.argsort(-shared[1:], kind="stable") + 1  # deepest first, equal ones from left to right
        for i in edges.tolist():
            a, b = find(i - 1), find(i)
            node = self._at(top[a], int(shared[i]))
            self._below(node, top[b])
            leader[b], top[a] = a, node
        self._at(top[find(0)], 0)

    def _at(self, below: int, depth: int) -> int:
        """The node of a component at ``depth``: its highest one, or a new one above that."""
        if self.depth[below] == depth:
            return below
        for column, value in ((self.low, self.low[below]), (self.high, -1), (self.depth, depth), (self.parent, -1),
                              (self.least, self.least[below]), (self.children, 0)):
            column.append(value)
        self._below(len(self.depth) - 1, below)
        return len(self.depth) - 1

    def _below(self, node: int, child: int) -> None:
        self.parent[child] = node
        self.children[node] += 1
        self.high[node] = self.high[child]
        self.least[node] = min(self.least[node], self.least[child])


NODE = pa.schema([("open", pa.binary()), ("above", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()),
                  ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
                  ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string())])
NODES = ("open BINARY, above BINARY, conv_id LONG, depth LONG, parent_conv_id LONG, n_convs LONG, n_children LONG, "
         "n_leaves LONG, saved_tokens LONG, ends_sha256 STRING")


def part_nodes(seq: list[bytes], words: list[list[int]], n: np.ndarray, conv: np.ndarray, ends: list[str], before: int,
               after: int) -> pa.RecordBatch:
    """Every prefix of a part's rows. ``before``: common prefix of the first row with the row before the part, -1 if there is
    none; ``after``: the same at the end. Prefixes as deep as these are open: their numbers are this part's share, ``open`` is
    their digest. ``above`` is set where only the parent is open, whose smallest member the part does not know."""
    m = len(seq)
    length = np.array([len(s) // WIDE for s in seq], np.int64)
    shared = np.array([before, *map(common, seq[:-1], seq[1:])], np.int64)
    forest = Forest(shared, length, conv)
    low, high, depth, least, parent, children = (np.array(x, np.int64) for x in (
        forest.low, forest.high, forest.depth, forest.least, forest.parent, forest.children))
    # one row per prefix: the depths between a node and its parent, the node's own last
    above = np.where(parent >= 0, depth[parent], -1)
    steps = depth - above
    node = np.repeat(np.arange(len(depth)), steps)
    d = above[node] + 1 + np.arange(len(node)) - np.repeat(np.cumsum(steps) - steps, steps)
    is_node, is_top = d == depth[node], d == above[node] + 1
    a, b = low[node], high[node] + 1
    over = np.where(is_top, parent[node], node)  # whose run is that of the prefix one turn shorter
    continued = (a == 0) & (before >= d)  # the part before has the first members

    def total(x: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(x)])
        return sums[b] - sums[a]

    # words of the first k turns of row i: so_far[first[i] + k]
    first = np.cumsum(length + 1) - (length + 1)
    so_far = np.concatenate([np.concatenate([[0], np.cumsum(np.array(w, np.int64))]) for w in words])
    whole = so_far[first + length]
    new = whole - so_far[first + np.maximum(shared, 0)]  # words of the prefixes that no row before has
    known = so_far[first[a] + np.maximum(d - 1, 0)]  # words above the prefix, which all its members have
    members = total(n)
    saved = total(n * whole) - members * known - total(new) + np.where(continued, 0, new[a] - (whole[a] - known))
    leaves = total(np.append(shared[1:], after) != length)  # else the next row goes on from the end of this one
    n_children = np.where(is_node, children[node], 1) - (continued & (before > d))  # the part before has that child as well

    def open_at(run: np.ndarray, turns: np.ndarray, among: np.ndarray) -> list[bytes | None]:
        """Digest of the first ``turns`` turns of a node's run, if a part next to this one shares them."""
        left, right = among & (low[run] == 0) & (before >= turns), among & (high[run] == m - 1) & (after >= turns)
        return [digests[0][k] if x else digests[1][k] if y else None
                for k, x, y in zip(turns.tolist(), left.tolist(), right.tolist(), strict=True)]

    digests = [prefix_digests(seq[0], before), prefix_digests(seq[-1], after)]
    shares, parent_shares = open_at(node, d, d >= 0), open_at(over, d - 1, d > 0)
    no_parent = np.array([x is not None for x in parent_shares]) | (d == 0)
    return batch_of(
        NODE, shares, parent_shares, least[node], d, pa.array(least[over], mask=no_parent), members, n_children, leaves, saved,
        [ends[i] if e else None for i, e in zip(a.tolist(), (is_node & (length[a] == d)).tolist(), strict=True)])


def prefix_digests(seq: bytes, depth: int) -> list[bytes]:
    """Digests of the first 0, 1, ... ``depth`` turns."""
    state, out = hashlib.md5(), []
    for k in range(depth + 1):
        out.append(state.digest())
        state.update(seq[WIDE * k:WIDE * (k + 1)])
    return out


def between(rows: DataFrame) -> DataFrame:
    """(part, before, after): common prefix of a part's first row with the row before it and of its last row with the
    next, -1 at the ends. One row a part; the driver sees the numbers of the parts only."""
    ends = written(rows.groupBy("part").agg(F.min("seq").alias("first"), F.max("seq").alias("last")), "ends")
    parts = sorted(r.part for r in ends.select("part").collect())
    follows = small_table(rows.sparkSession, list(zip(parts, parts[1:])), PAIR)
    pairs = ends.select("part", "last").join(follows, "part").join(
        ends.select(F.col("part").alias("next"), "first"), "next").select("part", "next", "last", "first")
    met = pa.schema([("part", pa.int32()), ("next", pa.int32()), ("shared", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch_of(met, batch.column("part"), batch.column("next"), list(map(
                common, batch.column("last").to_pylist(), batch.column("first").to_pylist())))

    shared = written(pairs.mapInArrow(run, "part INT, next INT, shared LONG"), "between")
    none = F.lit(-1).cast("long")
    return (ends.select("part").join(shared.select("part", F.col("shared").alias("after")), "part", "left")
            .join(shared.select(F.col("next").alias("part"), F.col("shared").alias("before")), "part", "left")
            .select("part", F.coalesce("before", none).alias("before"), F.coalesce("after", none).alias("after")))


def trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations (conv_id, seq, words), the empty one included: conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Repeated conv_ids are members of their own; a conversation without turns is a member of the root alone; no
    conversations, no rows.
    """
    named = written(conversations.withColumn("seq_id", F.unhex(F.md5("seq"))), "conversations")
    members = written(member_hashes(named.select("seq_id", "conv_id")), "members")
    distinct = members.join(named, ["seq_id", "conv_id"]).dropDuplicates(["seq_id"])
    sorted_rows = distinct.repartitionByRange("seq").sortWithinPartitions("seq")
    rows = written(sorted_rows.select(F.spark_partition_id().alias("part"), "seq", "words", "n", "conv_id", "ends_sha256"), "sorted")
    edges = between(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def done() -> pa.RecordBatch:
            get = lambda c: [r[c] for r in held]
            return part_nodes(get("seq"), get("words"), np.array(get("n"), np.int64), np.array(get("conv_id"), np.int64),
                              get("ends_sha256"), held[0]["before"], held[0]["after"])

        for batch in batches:
            for row in batch.to_pylist():
                if held and row["part"] != held[0]["part"]:
                    yield done()
                    held.clear()
                held.append(row)
        if held:
            yield done()

    nodes = written(rows.join(F.broadcast(edges), "part").repartition("part").sortWithinPartitions("part", "seq").mapInArrow(
        run, NODES), "nodes")
    opened = written(nodes.where("open IS NOT NULL").groupBy("open", "depth").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("above").alias("above"), F.max("ends_sha256").alias("ends_sha256")), "open")
    parents = opened.select(F.col("open").alias("above"), F.col("conv_id").alias("_parent"))
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    closed = nodes.where("open IS NULL")
    looked = closed.where("above IS NOT NULL").select("above", *columns).union(
        opened.where("above IS NOT NULL").select("above", *columns)).join(parents, "above").select(*columns, F.col("_parent").alias("parent_conv_id"))
    rest = closed.where("above IS NULL").select(*columns, "parent_conv_id").union(
        opened.where("above IS NULL").select(*columns, F.lit(None).cast("long")))
    return looked.union(rest).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))

"""Exact Jaccard join of documents on their five-word shingles, in the metric space of Jaccard distance.

Near pairs share a shingle among the first few of each set in one order of all shingles, for else too many would be
missing in one of them. So a shingle gathers a region around its pivot, the set with the fewest shingles before it
(then the smallest id): of near copies the one that all resemble, as the others have rare shingles of their own; a set belongs to the regions of all its first shingles, which is how far the distance lets a
partner be. Very frequent shingles come last in the order; that keeps regions small and changes no result. Each set
knows its place in a region, the number of its shingles before the first that the region has: a pair that shares nothing
earlier can share what follows at most, and that is often too little.

Distances to the pivot come first. By the triangle inequality a pair of a region can be near only if its distances to
the pivot differ by the limit at most, and a pair that is connected already needs no test: so a large group of near
copies costs one test each. What is left of a region joins within the region if it is small, else recursively around
further pivots until none is left. Before whole sets travel, a pair must pass a bound: sets that differ in few
shingles have outlines (numbers of shingles by hash, more slots for larger sets) that differ by no more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tileplan.llm.arrow import batch_of, slices, text_buffer
from tileplan.llm.components import components
from tileplan.llm.tables import written
from tileplan.llm.words import STEP, Words, mix, powers


@dataclass(frozen=True)
class Settings:
    width: int = 5
    percent: int = 80
    frequent: int = 64  # sets sharing a shingle from which it counts as frequent; order only, never the result
    listed: int = 500_000  # frequent shingles that tasks get as a list of 4 MB at most
    parts: int = 64  # a frequent shingle's sets are dealt over so many tasks
    pivots: int = 256  # further pivots of a large region in the first round, four times as many in each next one
    small: int = 1024  # sets of a region from which it is too large to join in one task


SMALLEST = 32


def set_ids(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set (a hash of its members in order), 0 for an empty one."""
    sizes = np.diff(bounds)
    out = np.zeros(len(sizes), np.uint64)
    if len(shingles):
        inside = np.arange(len(shingles)) - np.repeat(bounds[:-1], sizes)
        data = mix(shingles + STEP) * powers(STEP, int(sizes.max()))[inside]
        some = sizes > 0
        out[some] = mix(np.add.reduceat(data, bounds[:-1][some]) ^ sizes[some].astype(np.uint64)) | np.uint64(1)
    return out


def sets_of(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set id, shingles, bounds) of each text."""
    shingles, bounds = Words(*text_buffer(texts), lower=True).shingle_sets(width)
    return set_ids(shingles, bounds), shingles, bounds


def first_shingles(ids: np.ndarray, shingles: np.ndarray, bounds: np.ndarray, percent: int, frequent: np.ndarray):
    """(shingle, set id, place in the order, is frequent) of the first shingles of each distinct set: frequent ones last,
    then by hash."""
    _, once = np.unique(ids, return_index=True)
    once = once[ids[once] != 0]
    sizes = np.diff(bounds)[once]
    owner = np.repeat(np.arange(len(once)), sizes)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    own = shingles[np.repeat(bounds[:-1][once], sizes) + inside]
    late = np.zeros(len(own), bool)
    if len(frequent):
        late = frequent[np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)] == own
        order = np.lexsort((own, late, owner))
        own, late = own[order], late[order]
    length = sizes - (percent * sizes + 99) // 100 + 1
    first = inside < np.repeat(length, sizes)
    return own[first], ids[once][owner[first]], inside[first], late[first]


def outlines(shingles: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Numbers of shingles by hash, at most 255 each, of each set. The number of slots is a power of 2 from an eighth of
    the set's size, so an outline with more slots folds to one with fewer."""
    slots = np.maximum(SMALLEST, 1 << np.ceil(np.log2(np.maximum(np.diff(bounds) / 8, 1))).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(slots)])
    owner = np.repeat(np.arange(len(slots)), np.diff(bounds))
    place = begin[owner] + (shingles & (slots[owner] - 1).astype(np.uint64)).astype(np.int64)
    counts = np.minimum(np.bincount(place, minlength=int(begin[-1])), 255).astype(np.uint8)
    return [counts[a:b].tobytes() for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]


def may_be_near(a: bytes, b: bytes, n_a: int, n_b: int, percent: int) -> bool:
    """Whether sets of these outlines and sizes can be near: they differ in as many shingles as outlines or sizes do."""
    most = (100 - percent) * (n_a + n_b)
    if (100 + percent) * abs(n_a - n_b) > most:
        return False
    size = min(len(a), len(b))
    x, y = (np.frombuffer(o, np.uint8).reshape(-1, size).sum(0, dtype=np.int64) for o in (a, b))
    return (100 + percent) * int(np.abs(x - y).sum()) <= most


def survey(docs: DataFrame, settings: Settings) -> DataFrame:
    """Rows of two kinds: (key, id, n, outline) of each document, and (gram, n) of the shingles that several sets of one
    slice of rows have."""
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("gram", pa.int64()),
                        ("outline", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, shingles, bounds = sets_of(batch.column("text"), settings.width)
            n = batch.num_rows
            yield batch_of(schema, batch.column("key"), ids.astype(np.int64), np.diff(bounds), pa.nulls(n, pa.int64()),
                           outlines(shingles, bounds))
            once = np.zeros(n, bool)
            once[np.unique(ids, return_index=True)[1]] = True  # equal sets count once
            gram, times = np.unique(shingles[np.repeat(once, np.diff(bounds))], return_counts=True)
            several = times > 1
            gram, times = gram[several].astype(np.int64), times[several]
            empty = pa.nulls(len(gram), pa.int64())
            yield batch_of(schema, empty, empty, times, gram, pa.nulls(len(gram), pa.binary()))

    return docs.mapInArrow(run, "key LONG, id LONG, n LONG, gram LONG, outline BINARY")


def regions(docs: DataFrame, frequent: np.ndarray, settings: Settings) -> DataFrame:
    """(x, pivot, place): the sets that share a first shingle, by the pivot of that shingle, and the earliest place of such
    a shingle in the order of the set."""
    spark = docs.sparkSession
    listed = spark.sparkContext.broadcast(frequent)
    out = pa.schema([("gram", pa.int64()), ("id", pa.int64()), ("place", pa.int64()), ("late", pa.bool_())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            gram, ids, place, late = first_shingles(*sets_of(batch.column("text"), settings.width), settings.percent,
                                                    listed.value)
            yield batch_of(out, gram.astype(np.int64), ids.astype(np.int64), place, late)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by gram, part, place and id: the first of each is the pivot. Keeps no group in memory."""
        schema = pa.schema([("gram", pa.int64()), ("x", pa.int64()), ("pivot", pa.int64()), ("place", pa.int64())])
        last_gram, last_part, last_pivot = None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            gram, part, ids = (batch.column(c).to_numpy() for c in ("gram", "part", "id"))
            late = batch.column("late").to_numpy(zero_copy_only=False)
            head = np.append((gram[0], part[0]) != (last_gram, last_part), (gram[1:] != gram[:-1]) | (part[1:] != part[:-1]))
            pivot = np.append(last_pivot, ids[head])[np.cumsum(head)]
            last_gram, last_part, last_pivot = gram[-1], part[-1], pivot[-1]
            keep = (ids != pivot) | late
            yield batch_of(schema, pa.array(gram[keep], mask=~late[keep]), ids[keep], pivot[keep],
                           batch.column("place").to_numpy()[keep])

    rows = docs.mapInArrow(emit, "gram LONG, id LONG, place LONG, late BOOLEAN")
    part = F.when(F.col("late"), F.pmod(F.col("id"), F.lit(settings.parts))).otherwise(0)
    dealt = rows.withColumn("part", part).repartition("gram", "part").sortWithinPartitions("gram", "part", "place", "id")
    met = written(dealt.mapInArrow(gather, "gram LONG, x LONG, pivot LONG, place LONG"), "regions")
    common = met.where(F.col("gram").isNotNull())
    pivots = common.groupBy("gram").agg(F.min(F.struct("place", "x")).alias("least"))
    joined = common.join(pivots, "gram").select("x", F.col("least.x").alias("pivot"), common["place"])
    return met.where(F.col("gram").isNull()).select("x", "pivot", "place").union(joined).where("x <> pivot").groupBy(
        "x", "pivot").agg(F.min("place").alias("place"))


def stored_sets(docs: DataFrame, info: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """(id, shingles as bytes) of the wanted ids, from one document of each."""
    schema = pa.schema([("id", pa.int64()), ("grams", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # rows with equal keys come to one task
        for batch in slices(batches):
            ids, shingles, bounds = sets_of(batch.column("text"), settings.width)
            same = np.flatnonzero(ids.astype(np.int64) == batch.column("id").to_numpy())
            same = [i for i in same.tolist() if ids[i] not in seen]
            same = [same[i] for i in np.sort(np.unique(ids[same], return_index=True)[1])]
            seen.update(ids[same].tolist())
            yield batch_of(schema, ids[same].astype(np.int64),
                           [shingles[bounds[i]:bounds[i + 1]].tobytes() for i in same])

    one = info.select("id", "key").join(wanted, "id", "left_semi").groupBy("id").agg(F.min("key").alias("key"))
    chosen = docs.alias("d").join(one.alias("o"), F.expr("d.key <=> o.key")).select("d.text", "o.id")
    return chosen.mapInArrow(run, "id LONG, grams BINARY")


def measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b and more) with shared, n_a, n_b: sizes of the intersection and of both sets."""
    kept = [c for c in pairs.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(c).to_pylist() for c in ("_a", "_b"))
            shared, n_a, n_b = [], [], []
            for p, q in zip(left, right, strict=True):
                p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                at = np.searchsorted(q, p)
                at[at == len(q)] = 0
                shared.append(int((q[at] == p).sum()))
                n_a.append(len(p))
                n_b.append(len(q))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *map(pa.array, (shared, n_a, n_b))],
                                             names=[*kept, "shared", "n_a", "n_b"])

    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("_a")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("grams").alias("_b")), "b"))
    kinds = ", ".join(f"{c} {t}" for c, t in pairs.dtypes)
    return both.select(*kept, "_a", "_b").mapInArrow(run, f"{kinds}, shared LONG, n_a LONG, n_b LONG")


def screened(pairs: DataFrame, outline: DataFrame, settings: Settings) -> DataFrame:
    """The rows of ``pairs`` (a, b) whose outlines allow that they are near."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = zip(*(batch.column(c).to_pylist() for c in ("_a", "_b", "n_a", "n_b")), strict=True)
                keep = pa.array([may_be_near(*row, settings.percent) for row in rows])
                yield batch_of(schema, batch.column("a").filter(keep), batch.column("b").filter(keep))

    both = pairs.join(outline.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("outline").alias("_a")), "a").join(
        outline.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("outline").alias("_b")), "b")
    return both.select("a", "b", "n_a", "n_b", "_a", "_b").mapInArrow(run, "a LONG, b LONG")


def within_regions(named: DataFrame, outline: DataFrame, settings: Settings, ids_only: bool = False) -> DataFrame:
    """Pairs (a, b) inside each small region that are not connected, that the distances to the pivot (where both are
    known) and the places allow and that pass the bound. ``named`` is (pivot, x, d, place, label). ``ids_only`` gives the
    ids (id) of which there is such a pair."""
    limit = 1 - settings.percent / 100 + 1e-9

    def run(region: pa.Table) -> pa.Table:
        region = region.combine_chunks()
        x, n, label = (region.column(c).to_numpy() for c in ("x", "n", "label"))
        d, left = region.column("d").to_numpy(), n - region.column("place").to_numpy()
        drawn = region.column("outline").to_pylist()
        found = []
        for i in range(len(x) - 1):
            rest = slice(i + 1, None)
            ok = (label[rest] != label[i]) & ~(np.abs(d[rest] - d[i]) > limit)
            ok &= (100 + settings.percent) * np.abs(n[rest] - n[i]) <= (100 - settings.percent) * (n[rest] + n[i])
            ok &= (100 + settings.percent) * np.minimum(left[rest], left[i]) >= settings.percent * (n[rest] + n[i])
            found += [(i, j) for j in (np.flatnonzero(ok) + i + 1).tolist()
                      if may_be_near(drawn[i], drawn[j], int(n[i]), int(n[j]), settings.percent)]
        at = np.array(found, np.int64).reshape(-1, 2)
        if ids_only:
            return pa.table({"id": x[np.unique(at)]})
        return pa.table({"a": x[at].min(1), "b": x[at].max(1)}) if len(at) else pa.table(
            {"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})

    rows = named.join(outline.withColumnRenamed("id", "x"), "x")
    return rows.select("pivot", "x", "d", "place", "label", "n", "outline").groupBy("pivot").applyInArrow(
        run, "id LONG" if ids_only else "a LONG, b LONG").distinct()


def near(percent: int) -> Column:
    return 100 * F.col("shared") >= percent * (F.col("n_a") + F.col("n_b") - F.col("shared"))


def join(docs: DataFrame, settings: Settings = Settings(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    Texts without words (null texts too) are linked with nothing. Equal sets are one set, whatever their number. Rows
    with equal keys are documents of their own; a null key counts in no minimum. An empty table gives no rows.
    """
    docs = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    surveyed = written(survey(docs, settings), "survey")
    info = surveyed.where(F.col("gram").isNull()).select("key", "id", "n")
    outline = written(surveyed.where("gram IS NULL AND n > 0").groupBy("id").agg(
        F.first("n").alias("n"), F.first("outline").alias("outline")), "outlines")
    frequent = (surveyed.where(F.col("gram").isNotNull()).groupBy("gram").agg(F.sum("n").alias("n"))
                .where(F.col("n") > settings.frequent).orderBy(F.desc("n"), "gram").limit(settings.listed).collect())
    listed = np.sort(np.array([r.gram for r in frequent], np.int64).astype(np.uint64))
    members = written(regions(docs, listed, settings), "members")
    stars = written(screened(members.select(F.col("x").alias("a"), F.col("pivot").alias("b")), outline, settings), "stars")

    sizes = members.groupBy("pivot").agg(F.count("*").alias("many"))
    own = members.union(members.select(F.col("pivot").alias("x"), "pivot", F.lit(0).cast("long")).distinct())
    alone = own.join(sizes.where(F.col("many") < settings.small), "pivot", "left_semi").select(
        "pivot", "x", F.lit(None).cast("double").alias("d"), "place", F.col("x").alias("label"))
    crowd = own.join(sizes.where(F.col("many") >= settings.small), "pivot", "left_semi").select(F.col("x").alias("id"))
    wanted = written(within_regions(alone, outline, settings, ids_only=True).union(crowd).distinct(), "wanted")
    sets = written(stored_sets(docs, info, wanted, settings), "sets")

    def tested(pairs: DataFrame) -> DataFrame:
        return written(measured(pairs, sets), "tested")

    measured_stars = tested(stars)
    links = measured_stars.where(near(settings.percent)).select("a", "b")
    labels = components(links)
    distance = 1 - F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared"))
    region = written(members.join(measured_stars.select(F.col("a").alias("x"), F.col("b").alias("pivot"), distance.alias(
        "d")), ["x", "pivot"], "left"), "region")
    named = labelled(labelled(region, labels, "x", "label"), labels, "pivot", "home")
    open_ = named.groupBy("pivot").agg(F.count("*").alias("many"), F.max(F.col("label") != F.col("home")).alias("open")).where(
        "open AND many > 1").select("pivot", "many")
    small = named.join(open_.where(F.col("many") < settings.small).select("pivot"), "pivot", "left_semi")
    pairs = written(within_regions(small, outline, settings), "pairs")
    if pairs.limit(1).count():
        links = links.union(tested(pairs).where(near(settings.percent)).select("a", "b"))
    large = region.join(open_.where(F.col("many") >= settings.small).select("pivot"), "pivot", "left_semi")
    large = written(large.join(outline.select(F.col("id").alias("x"), "n"), "x"), "large")
    used, pivots = None, settings.pivots
    while large.limit(1).count():
        labels = components(links)
        named = labelled(labelled(large, labels, "x", "label"), labels, "pivot", "home")
        open_ = named.where("label <> home")
        if used is not None:
            open_ = open_.join(used, ["pivot", "x"], "left_anti")
        rank = F.row_number().over(Window.partitionBy("pivot").orderBy("place", "x"))
        chosen = written(open_.withColumn("_rank", rank).where(F.col("_rank") <= pivots).select(
            "pivot", "x", "d", "place", "n", "label"), "pivots")
        if not chosen.limit(1).count():
            break
        limit, p = 1 - settings.percent / 100 + 1e-9, settings.percent
        pairs = chosen.alias("q").join(named.alias("m"), F.expr(
            f"q.pivot = m.pivot AND q.x <> m.x AND q.label <> m.label AND coalesce(abs(q.d - m.d) <= {limit}, true) AND "
            f"{100 + p} * least(q.n - q.place, m.n - m.place) >= {p} * (q.n + m.n) AND "
            f"{100 + p} * abs(q.n - m.n) <= {100 - p} * (q.n + m.n)")).select(
            F.least("q.x", "m.x").alias("a"), F.greatest("q.x", "m.x").alias("b")).distinct()
        more = tested(written(screened(pairs, outline, settings), "pairs")).where(near(settings.percent)).select("a", "b")
        links = written(links.union(more).distinct(), "links")
        pivots *= 4
        done = chosen.select("pivot", "x")
        used = written(done if used is None else used.union(done), "used")
    labels = components(links)
    found = labelled(info, labels, "id", "label")
    smallest = found.where("n > 0").groupBy("label").agg(F.min("key").alias("component_id"))
    return found.join(smallest, "label", "left").select(
        F.col("key").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"))


def labelled(rows: DataFrame, labels: DataFrame, column: str, name: str) -> DataFrame:
    """``rows`` with the label of ``column``; an id without links is its own label."""
    of = labels.select(F.col("id").alias(column), F.col("label").alias("_label"))
    return rows.join(of, column, "left").withColumn(name, F.coalesce("_label", column)).drop("_label")

"""Mixing sources to target weights by entropy balancing, on DataFrame functions alone.

Each document of a source gets a rate, the copies expected of it. Of all rates from 0 to the limit that give the source
its target number of tokens, entropy balancing takes those of least relative entropy to 1: min(limit,
exp(lambda * size / mean)), where lambda, one number per source, solves the convex dual. Newton's steps for all
sources run at once over the counts of documents by source and size, kept inside a bracket that halves where a step
leaves it. Rates become whole copies by systematic rounding in order of size, so a source misses its target by less
than its longest document, and a starting point chosen among OFFSETS brings it nearer.

Rates are whole multiples of 2**-20 and sums are of decimals or whole numbers, so a rerun gives the same copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tileplan.llm.tables import without, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
LIMIT = 3
UNIT = 1 << 20
OFFSETS = 32
STEPS = 60
TOLERANCE = 1e-7
RANKED_ROWS = 1024


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """``sources`` (one row per source: _key, source_size) with the column target.

    Sources in order of _key weigh weights[0], weights[1], ..., repeating, and share the sum of all sizes; a target
    stops at ``limit`` times the size, and what is above is shared again by weight among the others. Sorted by
    size / weight, the stopped sources come first, so one running sum finds where they end.
    """
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = F.row_number().over(Window.orderBy("_key")) - 1
    weighed = sources.withColumn("_w", F.element_at(
        F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("double"))
    weighed = weighed.withColumn("_most", limit * F.col("source_size").cast("double"))
    weighed = weighed.withColumn("_ratio", F.col("_most") / F.col("_w"))
    before = Window.orderBy("_ratio", "_key").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("_most").over(before), F.lit(0.0))) / (
        F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
    shared = weighed.withColumn("_level", level).withColumn("_stopped", F.col("_ratio") <= F.col("_level"))
    free = F.max(F.when(~F.col("_stopped"), F.col("_level"))).over(everything)
    return shared.withColumn("target", F.when(F.col("_stopped"), F.col("_most")).otherwise(free * F.col("_w"))).select(
        *sources.columns, "target", F.col("_stopped").alias("_full"))


def _rate(limit: int) -> Column:
    """Rate of a size under its source's lambda."""
    return F.least(F.lit(float(limit)), F.exp(F.col("_lambda") * F.col("size") / F.col("_mean")))


def solve(histogram: DataFrame, wanted: DataFrame, limit: int = LIMIT) -> DataFrame:
    """lambda of each source: ``wanted`` (one row per source) with _mean and _lambda.

    ``histogram`` has one row per source and size (_key, size, _n) and is read once per step. Sources that are full
    or empty need no step.
    """
    state = wanted.withColumn("_mean", F.greatest(F.col("source_size") / F.col("_docs"), F.lit(1e-300)))
    state = (state.withColumn("_low", F.least(F.lit(0.0), F.log(F.greatest(F.col("target"), F.lit(1e-9)) / F.greatest(
        F.col("source_size"), F.lit(1)))) * F.col("_mean"))
        .withColumn("_high", F.log(F.lit(float(limit))) * F.col("_mean"))
        .withColumn("_lambda", F.lit(0.0)).withColumn("_done", F.col("_full") | (F.col("source_size") == 0)))
    state = written(state, "mix-state")
    for _ in range(STEPS):
        if not state.where(~F.col("_done")).limit(1).count():
            break
        tokens = F.col("_n") * F.col("size") * _rate(limit)
        slope = F.when(_rate(limit) < limit, tokens * F.col("size") / F.col("_mean")).otherwise(0.0)
        sums = (histogram.join(state.where(~F.col("_done")).select("_key", "_lambda", "_mean"), "_key")
                .groupBy("_key").agg(F.sum(tokens.cast("decimal(30,6)")).cast("double").alias("_tokens"),
                                     F.sum(slope.cast("decimal(30,6)")).cast("double").alias("_slope")))
        excess = F.col("_tokens") - F.col("target")
        new_low = F.when(excess < 0, F.col("_lambda")).otherwise(F.col("_low"))
        new_high = F.when(excess > 0, F.col("_lambda")).otherwise(F.col("_high"))
        newton = F.col("_lambda") - excess / F.greatest(F.col("_slope"), F.lit(1e-300))
        middle = (new_low + new_high) / 2
        near = F.abs(excess) <= TOLERANCE * F.col("target")
        step = F.when(near, F.col("_lambda")).when((newton > new_low) & (newton < new_high), newton).otherwise(middle)
        state = written(state.join(sums, "_key", "left").select(
            *wanted.columns, "_mean",
            F.when(F.col("_done"), F.col("_low")).otherwise(new_low).alias("_low"),
            F.when(F.col("_done"), F.col("_high")).otherwise(new_high).alias("_high"),
            F.when(F.col("_done"), F.col("_lambda")).otherwise(step).alias("_lambda"),
            (F.col("_done") | near).alias("_done")), "mix-state")
    return state


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT, text: str | None = "text",
           source: str = "source", key: str = "doc_id") -> DataFrame:
    """All rows and columns of ``docs`` with size, source_size, target, copies and taken (copies * size).

    Without ``text`` the sizes are those of a column size. A null text has size 0 and is never taken; a null source is a source of its own, the last; rows that are equal
    are rounded one by one; columns named like a new one are replaced; an empty table gives no rows.
    """
    given_size = words_in(F.col(text)) if text else F.col("size")
    sized = docs.withColumn("_size", given_size)
    docs = without(docs, "size", "source_size", "target", "copies", "taken")
    buckets = max(1, docs.count() // RANKED_ROWS)
    sized = (sized.select(*[f"`{c}`" for c in docs.columns], F.col("_size").alias("size"))
             .withColumn("_key", F.when(F.col(source).isNull(), "1").otherwise(F.concat(F.lit("0"), F.col(source))))
             .withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets))))
    cells = written(sized.groupBy("_key", "size", "_bucket").agg(F.count("*").alias("_n")), "mix-cells")
    histogram = written(cells.groupBy("_key", "size").agg(F.sum("_n").alias("_n")), "mix-sizes")
    sources = histogram.groupBy("_key").agg(F.sum(F.col("size") * F.col("_n")).alias("source_size"),
                                            F.sum("_n").alias("_docs"))
    state = solve(histogram, targets(sources, weights, limit), limit)
    rate = F.when(F.col("_full"), F.lit(limit * UNIT)).otherwise(F.floor(_rate(limit) * UNIT)).cast("long")
    rated = histogram.join(state, "_key").withColumn("_rate", rate)
    rated = written(rated.withColumn("_start", F.coalesce(F.sum(F.col("_n") * F.col("_rate")).over(
        Window.partitionBy("_key").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select(
        "_key", "size", "_n", "_rate", "_start", "source_size", "target"), "mix-rates")

    def whole(value: Column) -> Column:
        return F.shiftright(value, 20)

    tried = rated.withColumn("_offset", F.explode(F.array(*[F.lit(k * UNIT // OFFSETS) for k in range(OFFSETS)])))
    given = whole(F.col("_start") + F.col("_n") * F.col("_rate") + F.col("_offset")) - whole(
        F.col("_start") + F.col("_offset"))
    missed = tried.groupBy("_key", "_offset").agg(
        F.abs(F.sum(given * F.col("size")) - F.first("target")).alias("_missed"))
    best = missed.groupBy("_key").agg(F.min(F.struct("_missed", "_offset")).alias("_best")).select(
        "_key", F.col("_best._offset").alias("_offset"))
    earlier = F.coalesce(F.sum("_n").over(Window.partitionBy("_key", "size").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    starts = (cells.withColumn("_earlier", earlier).drop("_n").join(rated.drop("_n"), ["_key", "size"])
              .join(best, "_key")
              .withColumn("_start", F.col("_start") + F.col("_offset") + F.col("_earlier") * F.col("_rate")))
    ranked = (sized.join(starts, ["_key", "size", "_bucket"])
              .withColumn("_rank", F.row_number().over(
                  Window.partitionBy("_key", "size", "_bucket").orderBy(F.col(key)))))
    end = F.col("_start") + F.col("_rank") * F.col("_rate")
    number = F.when(F.col("size") > 0, whole(end) - whole(end - F.col("_rate"))).otherwise(0).cast("long")
    return ranked.withColumn("copies", number).select(
        *[F.col(f"`{c}`") for c in docs.columns], "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))

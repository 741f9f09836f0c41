"""SNK: what each write adds to, changes in or removes from a table, as a DataFrame; and the integrity report.

The functions return rows. ``write_table`` appends them, so a job that is lost half-way can be run again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tileplan.catalogue import Catalogue
from tileplan.functions.scalars import source_key
from tileplan.schemas import NOT_NULL, REFERENCES, UNIQUE, struct
from tileplan.session import small_table


def insert_ignore(target: DataFrame, new: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """SNK-01: the new rows whose key the target does not have; among equal keys the first in order is kept.

    The first row is a ``min`` over a struct, combined before the shuffle, so many copies of a key cost little. Rows
    without a key cannot be told apart and are left to ``keyless``.
    """
    new = new.filter(F.col(key).isNotNull())
    order = [c for c in (order or ["publishing_date", "input_path"]) if c in new.columns]
    rest = [c for c in new.columns if c != key and c not in order]
    first = (new.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("row"))
             .select(key, *[F.col(f"row.{c}").alias(c) for c in order + rest]).select(*new.columns))
    return first.join(target.select(key), key, "left_anti").select(*new.columns)


def keyless(new: DataFrame, key: str) -> DataFrame:
    """SNK-01: the new rows without a key, which ``insert_ignore`` leaves out."""
    return new.filter(F.col(key).isNull())


def bucket_of(key: Column, digits: int = 3) -> Column:
    """A bucket for numbering: the first hexadecimal digits of the key's MD5."""
    return F.substring(F.md5(key), 1, digits)


def numbered(rows: DataFrame, key: str, last_id: DataFrame, id_name: str = "id", digits: int = 3) -> DataFrame:
    """Rows with dense new ids above the largest existing one, without a sort of all rows in one task.

    A unique key falls in one of 16 ** digits buckets. The rows of a bucket are numbered among themselves and moved
    by the size of the buckets before; those sizes, one row per bucket, are what is broadcast. The same rows get the
    same ids in whatever task they are numbered; other digits give other ids, so keep them for a table.
    """
    from pyspark.sql import Window as W

    rows = rows.withColumn("bucket", bucket_of(F.col(key), digits))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("size"))
    before = F.sum("size").over(W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    start = sizes.select("bucket", F.coalesce(before, F.lit(0)).alias("start"))
    top = last_id.agg(F.coalesce(F.max(last_id.columns[0]), F.lit(0)).alias("top"))
    place = F.row_number().over(W.partitionBy("bucket").orderBy(key))
    return (rows.withColumn("place", place).join(F.broadcast(start), "bucket").crossJoin(F.broadcast(top))
            .withColumn(id_name, F.col("top") + F.col("start") + F.col("place"))
            .drop("bucket", "start", "top", "place"))


def append_validations(tv: DataFrame, heads: DataFrame) -> DataFrame:
    """SNK-02: one validation row per candidate, with its new id and its candidate key."""
    return numbered(heads, "candidate_key", tv.select("id")).select(
        "id", F.col("condition").alias("triggering_condition_name"), "validation_date", "is_nrt",
        "artificial_measurement_day", "candidate_key")


def append_members(validations: DataFrame, candidates: DataFrame) -> DataFrame:
    """SNK-03: the links of the new validations to their members."""
    ids = validations.select(F.col("id").alias("trigger_validation_id"), "candidate_key")
    return candidates.join(ids, "candidate_key").select("trigger_validation_id", "raw_input_id")


def append_tasks(pt: DataFrame, tasks: DataFrame) -> DataFrame:
    """SNK-04: planned tasks as new rows of the task table."""
    keyed = tasks.withColumn("task_key", F.col("trigger_validation_fk_id").cast("string"))
    return numbered(keyed, "task_key", pt.select("id")).select(
        "id", "trigger_validation_fk_id", "creation_date", "processing_date",
        F.lit(None).cast("string").alias("preceding_input_id"), "has_ended",
        F.lit(None).cast("string").alias("intermediate_files_path"))


def append_dispatch(cat: Catalogue, runs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """SNK-05: dispatch, link and status rows of new runs.

    ``runs`` has nomad_job_id, processing_task_id, status_name, date and exit_code; the status is stored by id.
    """
    codes = F.broadcast(cat.processing_status.select(F.col("id").alias("processing_status_id"),
                                                     F.col("name").alias("status_name")))
    text = F.lit(None).cast("string")
    jobs = runs.select(F.col("nomad_job_id").alias("id"), text.alias("nomad_job_dispatch"),
                       F.lit(None).cast("timestamp_ntz").alias("dispatch_date"), text.alias("log_path"))
    links = runs.select("nomad_job_id", "processing_task_id")
    statuses = runs.join(codes, "status_name").withColumn(
        "status_key", F.concat_ws("|", "nomad_job_id", F.col("date").cast("string"), "processing_status_id"))
    statuses = numbered(statuses, "status_key", cat.processing_status_workflow.select("id")).select(
        "id", F.col("nomad_job_id").alias("nomad_job_dispatch_fk_id"), "processing_status_id", "date",
        text.alias("message"), "exit_code")
    return jobs, links, statuses


def update_params(params: DataFrame, key: str, values: dict[str, str | None]) -> DataFrame:
    """SNK-06: source parameters with columns set, or unset by None, where name and timeliness make up the key."""
    hit = source_key("") == key.replace("/", "")
    return params.withColumns({
        c: F.when(hit, F.lit(v).cast(params.schema[c].dataType)).otherwise(F.col(c)) for c, v in values.items()})


def set_last_day(config: DataFrame, product_type: str, day: int) -> DataFrame:
    """SNK-06: the last processed day of a product type set."""
    return config.withColumn("last_processing_date", F.when(
        F.col("product_type") == product_type, F.lit(day).cast("bigint")).otherwise(F.col("last_processing_date")))


def delete_cascade(parent: DataFrame, key: str, children: list[tuple[DataFrame, str]], ids: DataFrame):
    """SNK-07: parent and child tables without the rows of the given ids; ``ids`` has the one column ``id``."""
    gone = ids.select("id")
    left = lambda df, column: df.join(gone.withColumnRenamed("id", "_gone"), df[column] == F.col("_gone"), "left_anti")
    return left(parent, key), [left(child, column) for child, column in children]


def constraint_report(cat: Catalogue, tables: list[str] | None = None) -> DataFrame:
    """SNK-08: number of violations per table, rule and column; rules without violation show 0.

    Every table is read once. A row gives one entry per rule, (space, key, rule): a space is a column that is
    unique or that others refer to, rule 0 means that the key is there. Entries are counted by all three and then by
    space and key, both combined before the shuffle, so copies of a key and a parent that most rows refer to cost little.
    """
    tables = tables or list(NOT_NULL)
    wanted = [(t, c, p, k) for t in tables for c, p, k in REFERENCES.get(t, [])]
    spaces = list(dict.fromkeys([(t, c) for t in tables for c in UNIQUE.get(t, [])] + [(p, k) for _, _, p, k in wanted]))
    labels = ([(t, "not_null", c) for t in tables for c in NOT_NULL.get(t, [])]
              + [(t, "unique", c) for t in tables for c in UNIQUE.get(t, [])] + [(t, "reference", c) for t, c, _, _ in wanted])
    number = {label: i for i, label in enumerate(labels, 1)}
    entry = lambda space, key, rule: F.struct(F.lit(space).alias("space"), key.alias("key"), F.lit(rule).alias("rule"))
    parts = []
    for table in dict.fromkeys([*tables, *[t for t, _ in spaces]]):
        there = [entry(i, F.col(c).cast("string"), 0) for i, (t, c) in enumerate(spaces) if t == table]
        refers = [entry(spaces.index((p, k)), F.col(c).cast("string"), number[t, "reference", c]) for t, c, p, k in wanted if t == table]
        nulls = [F.when(F.col(c).isNull(), entry(-1, F.lit(""), number[table, "not_null", c]))
                 for c in NOT_NULL.get(table, []) if table in tables]
        if entries := there + refers + nulls:
            parts.append(getattr(cat, table).select(F.explode(F.array(*entries)).alias("e")).select("e.*").where("key IS NOT NULL"))
    counts = reduce(DataFrame.unionByName, parts).groupBy("space", "key", "rule").agg(F.count("*").alias("n"))
    by_key = counts.groupBy("space", "key").agg(
        F.max(F.when(F.col("rule") == 0, F.col("n"))).alias("own"),
        F.collect_list(F.struct("rule", "n")).alias("entries"))  # one a rule
    unique_of = F.element_at(F.create_map(F.lit(-2), F.lit(0), *[
        F.lit(x) for i, (t, c) in enumerate(spaces) if (t, "unique", c) in number for x in (i, number[t, "unique", c])]), F.col("space"))
    found = by_key.select("space", "own", F.explode("entries").alias("e")).select(
        F.when(F.col("e.rule") == 0, unique_of).otherwise(F.col("e.rule")).alias("rule"),
        F.when(F.col("e.rule") == 0, F.col("own") - 1).when((F.col("space") < 0) | F.col("own").isNull(), F.col("e.n"))
        .otherwise(0).alias("n")).groupBy("rule").agg(F.sum("n").alias("n"))
    names = small_table(cat.raw_inputs.sparkSession, [(i, *label) for label, i in number.items()],
                        struct("rule INT, table_name STRING, kind STRING, column_name STRING"))
    return names.join(found, "rule", "left").select(
        "table_name", F.col("kind").alias("rule"), "column_name", F.coalesce("n", F.lit(0)).cast("bigint").alias("violations"))

"""PRJ: scalar column expressions, all built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tileplan.session import moment

# Fixed values.
RUN_STATES = {"running": "started", "pending": "pending", "dead": "internal_error", "complete": "processed"}
CODES = {
    "flavour": ["hma.large", "eo1.large"],
    "satellite": ["S1", "S2", "S3", "S4", "S5", "S6"],
    "level": ["L0", "L1", "L1A", "L1B", "L1C", "L1S", "L2A", "L2B", "L2C"],
    "run_mode": ["NRT", "ARCHIVE"],
    "mode": ["ARCHIVE", "NEAR_REAL_TIME"],
}
L1C_NEW_ROOT_FROM = "2022-01-01"
GRD_NEW_ROOT_AFTER = "2023-02-21"
NRT_HOURS = 3


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_to_date(c: str | Column) -> Column:
    """A day yyyymmdd as a date, by arithmetic rather than by parsing text."""
    day = _col(c).cast("int")
    return F.make_date(F.floor(day / 10000).cast("int"), (F.floor(day / 100) % 100).cast("int"), day % 100)


def date_to_day(c: str | Column) -> Column:
    """A date as the integer yyyymmdd."""
    date = _col(c)
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("bigint")


def day_add(c: str | Column, n: int) -> Column:
    """PRJ-06: a day moved by n days."""
    return date_to_day(F.date_add(day_to_date(c), n))


def iso_ms(c: str | Column) -> Column:
    """PRJ-08: a timestamp as ISO text with milliseconds."""
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss.SSS")


def dashed_day(c: str | Column) -> Column:
    """PRJ-10: a day as YYYY-MM-DD."""
    text = _col(c).cast("string")
    return F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))


def path_name(c: str | Column) -> Column:
    """PRJ-11: the last non-empty part of a path."""
    return F.substring_index(F.rtrim(_col(c), F.lit("/")), "/", -1)


def path_dir(c: str | Column) -> Column:
    """PRJ-11: the path ending in exactly one slash."""
    return F.concat(F.rtrim(_col(c), F.lit("/")), F.lit("/"))


def base_name(c: str | Column) -> Column:
    """PRJ-11: the text after the last slash, empty for a path that ends in one."""
    return F.substring_index(_col(c), "/", -1)


def ns_time(c: str | Column) -> Column:
    """PRJ-12: nanoseconds since the epoch as UTC time text."""
    ns = _col(c)
    seconds = ((ns - F.pmod(ns, F.lit(1000000000))) / 1000000000).cast("bigint")
    start = moment("1970-01-01 00:00:00")
    return F.date_format(start + F.make_dt_interval(secs=seconds.cast("decimal(18,6)")), "yyyy-MM-dd'T'HH:mm:ss")


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from start to end with their fraction, without reference to a zone."""
    return (end - start).cast("interval second").cast("decimal(18,6)")


def age_seconds(dispatch_ns: str | Column, submit_ns: str | Column, as_of) -> Column:
    """PRJ-12: age of a run in seconds; the dispatch time falls back to the submit time, null when both lack."""
    since_ns = F.coalesce(_col(dispatch_ns), _col(submit_ns))
    now_s = seconds_between(moment("1970-01-01 00:00:00"), moment(as_of))
    return now_s.cast("double") - since_ns / F.lit(1000000000)


def map_run_state(c: str | Column) -> Column:
    """PRJ-13: state of a run as a status name; unknown states become null."""
    pairs = [F.lit(v) for pair in RUN_STATES.items() for v in pair]
    return F.try_element_at(F.create_map(*pairs), _col(c))


def normalise_code(c: str | Column, kind: str) -> Column:
    """PRJ-14: a code in any case as its official spelling; unknown codes become null."""
    pairs = [F.lit(v) for code in CODES[kind] for v in (code.lower(), code)]
    return F.try_element_at(F.create_map(*pairs), F.lower(_col(c)))


def image_parts(c: str | Column) -> Column:
    """PRJ-15: a container image as a struct of host, port, name and tag."""
    part = lambda i: F.regexp_extract(_col(c), r"^([^:/]+):(\d+)/(.+):([^:/]+)$", i)
    return F.struct(part(1).alias("registry_host"), part(2).alias("registry_port"), part(3).alias("image_name"),
                    part(4).alias("tag"))


def image_text(host: Column, port: Column, name: Column, tag: Column) -> Column:
    """PRJ-15: the parts put together again."""
    return F.concat(host, F.lit(":"), port, F.lit("/"), name, F.lit(":"), tag)


def l1c_product_date(xml: str | Column, name_date: str | Column) -> Column:
    """PRJ-16: the acquisition time of the name if strictly inside the interval of the metadata, else its begin."""
    fmt = "yyyyMMdd'T'HHmmss"
    at = lambda tag: F.try_to_timestamp(F.xpath_string(_col(xml), F.lit(f"//*[name()='gml:{tag}']")),
                                        F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    named = F.try_to_timestamp(_col(name_date), F.lit(fmt))
    inside = (at("beginPosition") < named) & (named < at("endPosition"))
    return F.when(inside, _col(name_date)).otherwise(F.date_format(at("beginPosition"), fmt))


def is_nrt_now() -> Column:
    """PRJ-17: harvested within three hours of publication, both ends included; unknown dates give false."""
    published, harvested = F.col("publishing_date"), F.col("harvesting_date")
    return F.coalesce(harvested.between(published, published + F.make_dt_interval(hours=F.lit(NRT_HOURS))),
                      F.lit(False))


def source_start_days(params: DataFrame) -> DataFrame:
    """Start day per image type for PRJ-18; a few source rows, reduced to one per type."""
    return params.groupBy(F.col("input_type").alias("product_type_code")).agg(
        F.max(F.col("nrt_harvest_start_date").substr(1, 8).cast("bigint")).alias("nrt_start_day"))


def is_nrt_past(ri: DataFrame, params: DataFrame) -> DataFrame:
    """PRJ-18: the inputs with their NRT flag.

    An image type with a start day is NRT from that day on; every other input follows the harvest delay.
    The start days are reduced to the two image types, so the right side of the join has at most two rows.
    """
    starts = source_start_days(params).filter(F.col("product_type_code").isin("S2MSI1C", "IW_GRDH_1S"))
    start = F.coalesce("nrt_start_day", F.lit(0))
    return (ri.join(F.broadcast(starts), "product_type_code", "left")
            .withColumn("is_nrt", F.when(start > 0, F.col("measurement_day") >= start).otherwise(is_nrt_now()))
            .select(*ri.columns, "is_nrt"))


def half_day(hour: Column) -> Column:
    """PRJ-19: slot of the half day an hour lies in."""
    return F.when(hour < 12, "000000").otherwise("120000")


def source_root(kind: str, date: Column, roots: dict[str, str]) -> Column:
    """PRJ-20: image folder by acquisition date."""
    if kind == "L1C":
        return F.when(date < F.lit(L1C_NEW_ROOT_FROM).cast("date"), roots["l1c_old"]).otherwise(roots["l1c"])
    return F.when(date <= F.lit(GRD_NEW_ROOT_AFTER).cast("date"), roots["grd_old"]).otherwise(roots["grd"])


def pad_orbit(c: str | Column) -> Column:
    """PRJ-21: an orbit number padded to at least three digits."""
    text = _col(c).cast("string")
    return F.when(F.length(text) < 3, F.lpad(text, 3, "0")).otherwise(text)


def deadlines(limits: DataFrame, as_of) -> DataFrame:
    """PRJ-07: earliest publication and measurement date per condition; no measurement limit gives null."""
    today = F.to_date(moment(as_of))
    return limits.select(
        "condition",
        F.date_sub(today, F.col("max_publication_days")).alias("earliest_publication"),
        F.when(F.col("max_measurement_days") > 0, F.date_sub(today, F.col("max_measurement_days")))
        .alias("earliest_measurement"),
    )


def source_key(separator: str = "/") -> Column:
    """A source's key: its name, followed by its timeliness where it has one."""
    return F.concat_ws(separator, "triggering_condition_name", F.when(F.col("timeliness") != "", F.col("timeliness")))


def harvest_dates(params: DataFrame, mode: str) -> DataFrame:
    """PRJ-09: start and end date of each source in ``NRT`` or ``ARCHIVE`` mode; empty text becomes null."""
    day = lambda c: (F.try_to_timestamp(F.col(c).substr(1, 8), F.lit("yyyyMMdd")).cast("date")
                     if c in params.columns else F.lit(None).cast("date"))
    prefix = "nrt" if mode.upper() == "NRT" else "archive"
    return params.select(source_key().alias("source"), day(f"{prefix}_harvest_start_date").alias("start_date"),
                         day(f"{prefix}_harvest_end_date").alias("end_date"))

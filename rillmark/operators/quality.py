"""Checks on data. Each returns a small report; ``require_empty`` turns a report into an error."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# fixed values: allowed ranges of forcing variables and how many outliers are tolerated
FORCING_RANGES = {"pWetDays": (0.0, 1.0), "T": (-80.0, 80.0), "Pr": (0.0, 5000.0)}
TOLERATED = 5
WHOLE_NUMBER = r"^[+-]?\d+(\.0*)?$"


def require_empty(report: DataFrame, message: str) -> None:
    first = report.take(5)
    if first:
        raise ValueError(f"{message}: {[tuple(r) for r in first]}")


def check_range(df: DataFrame, ranges: dict[str, tuple[float, float]], tolerated: int = TOLERATED) -> DataFrame:
    """One row per variable with the numbers of values out of range and a verdict: ok, warning or error."""
    counts = df.agg(*[a for v, (lo, hi) in ranges.items() for a in (
        F.count_if(F.col(v) < lo).alias(f"{v}_low"), F.count_if(F.col(v) > hi).alias(f"{v}_high"))])
    rows = F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"{v}_low").alias("too_low"), F.col(f"{v}_high").alias("too_high"))
                               for v in ranges]))
    worst = F.greatest("too_low", "too_high")
    verdict = F.when(worst > tolerated, "error").when(worst > 0, "warning").otherwise("ok")
    return counts.select(rows.alias("_r")).select("_r.*").withColumn("verdict", verdict)


def check_congruent(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of one dataset absent from the other, with the side that lacks them."""
    ka, kb = a.select(*keys).distinct(), b.select(*keys).distinct()
    return (ka.join(kb, keys, "left_anti").withColumn("absent_from", F.lit("second"))
            .unionByName(kb.join(ka, keys, "left_anti").withColumn("absent_from", F.lit("first"))))


def check_variable_count(df: DataFrame, keys: list[str], expected: int) -> None:
    n = len([c for c in df.columns if c not in keys])
    if n != expected:
        raise ValueError(f"expected {expected} variables, got {n}")


def with_units(df: DataFrame, **units: str) -> DataFrame:
    """Attach units to columns as metadata."""
    return df.withColumns({c: F.col(c).alias(c, metadata={"units": u}) for c, u in units.items()})


def check_units(df: DataFrame, variable: str, expected: str) -> None:
    """A different unit is an error, an unknown one only a warning."""
    unit = df.schema[variable].metadata.get("units")
    if unit is None:
        warnings.warn(f"{variable} has no units, assuming {expected}")
    elif unit != expected:
        raise ValueError(f"{variable} is in {unit}, expected {expected}")


def check_contiguous_months(df: DataFrame, keys: list[str]) -> DataFrame:
    """Breaks in the run of months of each key: the months on both sides.

    One row per key and month, so a window partition is bounded by the calendar.
    """
    w = Window.partitionBy(*keys).orderBy("month_index")
    months = df.select(*keys, "month_index").distinct()
    return (months.withColumn("after", F.lag("month_index").over(w))
            .where(F.col("month_index") != F.col("after") + 1).withColumnRenamed("month_index", "resumes"))


def check_links(network: DataFrame) -> DataFrame:
    """Rows whose downstream id does not exist."""
    ids = network.select(F.col("id").alias("downstream_id"))
    return network.where(F.col("downstream_id") > 0).join(ids, "downstream_id", "left_anti").select("id", "downstream_id")


def unused_fits(fits: DataFrame, obs: DataFrame, on: list[str]) -> DataFrame:
    return fits.select(*on).distinct().join(obs.select(*on).distinct(), on, "left_anti")


def missing_fits(fits: DataFrame, obs: DataFrame, on: list[str]) -> DataFrame:
    return obs.select(*on).distinct().join(fits.select(*on).distinct(), on, "left_anti")


def check_complete_days(hourly: DataFrame, first_day: str | None = None) -> DataFrame:
    """Days with other than 24 different hours; the first day of an archive may be short."""
    counts = hourly.groupBy("day").agg(F.count_distinct("hour").alias("hours")).where(F.col("hours") != 24)
    return counts if first_day is None else counts.where(F.col("day") != F.lit(first_day).cast("date"))


def check_missing_days(daily: DataFrame, value: str, known_missing: DataFrame) -> DataFrame:
    """Days without any value which are not known to be missing."""
    empty = daily.groupBy("day").agg(F.count(value).alias("_n")).where(F.col("_n") == 0).select("day")
    return empty.join(known_missing, "day", "left_anti")


def not_integer(df: DataFrame, column: str) -> DataFrame:
    """Values which are not exactly integers."""
    text = F.trim(F.col(column).cast("string"))
    return df.where(~text.rlike(WHOLE_NUMBER)).select(column)


def integer_ids(df: DataFrame, column: str) -> DataFrame:
    """The column as BIGINT; a value that is not exactly an integer is an error."""
    as_text = F.trim(F.col(column).cast("string"))
    whole, good = F.regexp_replace(as_text, r"\.0*$", ""), as_text.rlike(WHOLE_NUMBER)
    return df.withColumn(column, F.when(F.col(column).isNull(), None).when(good, whole.cast("bigint")).otherwise(
        F.raise_error(F.concat(F.lit("not an integer id: "), as_text)).cast("bigint")))

"""Reading tables of observations, forecasts, calendars and parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as C
from ..operators.quality import require_empty


def scan(spark: SparkSession, path: str, variables: list[str] | None = None, fmt: str = "parquet", **options) -> DataFrame:
    """The named columns of a table, all if none are named; an unknown name is an error."""
    df = spark.read.options(**options).format(fmt).load(path)
    if variables is None:
        return df
    unknown = [v for v in variables if v not in df.columns]
    if unknown:
        raise ValueError(f"no such variables in {path}: {unknown}")
    return df.select(*variables)


def variables(df: DataFrame, keys: list[str]) -> list[str]:
    """Names of the data variables."""
    return [c for c in df.columns if c not in keys]


def months(spark: SparkSession, start: int, stop: int, step: int = 1, column: str = "yearmon") -> DataFrame:
    """Dates from start to stop inclusive; YYYY, YYYYMM or YYYYMMDD by their length."""
    if len(str(start)) != len(str(stop)):
        raise ValueError("start and stop must be in the same format")
    kinds = {4: C.year_range, 6: C.month_range, 8: C.day_range}
    if len(str(start)) not in kinds:
        raise ValueError(f"unknown date format: {start}")
    if start > stop:
        raise ValueError("stop is before start")
    make = kinds[len(str(start))]
    return spark.range(1).select(F.explode(make(F.lit(start), F.lit(stop), step)).alias(column))


def scan_months(df: DataFrame, start: int, stop: int, step: int = 1, column: str = "yearmon") -> DataFrame:
    """Rows of the wanted dates: a range filter for the scan, and a semi-join only where a step leaves gaps.

    The list of dates is bounded by the calendar and broadcast.
    """
    out = df.where(F.col(column).between(start, stop))
    if step == 1:
        return out
    wanted = months(df.sparkSession, start, stop, step, column)
    return out.join(F.broadcast(wanted), column, "left_semi")


def missing_months(df: DataFrame, start: int, stop: int, step: int = 1, column: str = "yearmon") -> DataFrame:
    """Wanted dates without any row."""
    present = df.where(F.col(column).between(start, stop)).select(column).distinct()
    return months(df.sparkSession, start, stop, step, column).join(present, column, "left_anti")


def require_months(df: DataFrame, start: int, stop: int, step: int = 1, column: str = "yearmon") -> DataFrame:
    """:func:`scan_months`, after making sure that no date is missing."""
    gone = [row[0] for row in missing_months(df, start, stop, step, column).orderBy(column).take(5)]
    if gone:
        raise ValueError(f"no data for {gone}")
    return scan_months(df, start, stop, step, column)


def scan_slice(df: DataFrame, **dims) -> DataFrame:
    """Rows with constant values of some dimensions, which are dropped; an absent value is an error."""
    out = df
    for name, value in dims.items():
        out = out.where(F.col(name) == F.lit(value))
    if out.isEmpty():
        raise ValueError(f"no data for {dims}")
    return out.drop(*dims)


def dimension_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(name).distinct()


def scan_hindcast(df: DataFrame, target_month: int, lead: int, min_year: int | None = None, max_year: int | None = None,
                  members: list | None = None) -> DataFrame:
    """Hindcasts (``start_index``, ``lead``, ``member``) of one calendar month and lead, within target years."""
    target = F.col("start_index") + F.col("lead")
    year = F.floor(target / 12)
    # the start month is what an archive is partitioned by, so it is filtered as well
    out = df.where((F.col("lead") == lead) & (F.pmod(F.col("start_index"), F.lit(12)) == (target_month - 1 - lead) % 12))
    if min_year is not None:
        out = out.where(year >= min_year)
    if max_year is not None:
        out = out.where(year <= max_year)
    if members is not None:
        out = out.where(F.col("member").isin(members))
    return out.withColumns({"target_month": F.lit(target_month), "target_year": year.cast("int")})


def available_hindcasts(schedule: DataFrame, target_month: int, lead: int, min_year: int, max_year: int,
                        missing: DataFrame, corrupt: DataFrame) -> DataFrame:
    """(run, target) pairs: four daily runs on the scheduled days of the issue month, less known bad ones.

    ``schedule`` lists (month, day). ``run`` is YYYYMMDDHH as a BIGINT.
    """
    issue_month = (target_month - lead - 1) % 12 + 1
    runs = (
        schedule.where(F.col("month") == issue_month)
        .withColumn("year", F.explode(F.sequence(F.lit(min_year - 1), F.lit(max_year))))
        .withColumn("hour", F.explode(F.array(*[F.lit(h) for h in (0, 6, 12, 18)])))
    )
    target = C.add_months(F.col("year") * 100 + F.col("month"), lead)
    run = ((F.col("year").cast("bigint") * 100 + F.col("month")) * 100 + F.col("day")) * 100 + F.col("hour")
    pairs = runs.select(run.alias("run"), target.alias("target")).where(F.floor(F.col("target") / 100) <= max_year)
    for bad in (missing, corrupt):
        pairs = pairs.join(bad.select("run", "target"), ["run", "target"], "left_anti")
    return pairs


def parse_calendar(lines: DataFrame, column: str = "value") -> DataFrame:
    """Condensed calendar lines ``unit crop n (area plant harvest)*n``, one row per subcrop."""
    t = F.split(F.trim(F.col(column)), r"\s+")
    short = F.raise_error(F.concat(F.lit("not a calendar line: "), F.col(column))).cast("boolean")
    whole = F.when(F.size(t) >= 3, F.lit(True)).when(F.trim(F.col(column)) == "", F.lit(False)).otherwise(short)
    parts = lines.where(whole).select(t.alias("t")).withColumn("n", F.col("t")[2].cast("int"))
    rows = parts.where(F.col("n") > 0).select("t", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("subcrop"))

    def item(i: int) -> Column:
        return F.element_at("t", (F.col("subcrop") - 1) * 3 + 4 + i)

    return rows.select(F.col("t")[0].cast("int").alias("unit_code"), F.col("t")[1].cast("int").alias("crop"), "subcrop",
                       item(0).cast("double").alias("area_ha"), item(1).cast("int").alias("plant_month"),
                       item(2).cast("int").alias("harvest_month"))


def scan_text_calendar(spark: SparkSession, path: str, header_lines: int = 0) -> DataFrame:
    """Calendar file; header lines are those which do not start with a unit code and a crop code.

    A split text file has no global line numbers, so the header is told by its form; ``header_lines``
    says how many such lines each file may have at most.
    """
    lines = spark.read.text(path)
    is_row = F.col("value").rlike(r"^\s*\d+\s+\d+\s+\d+(\s|$)")
    if header_lines == 0:
        bad = F.raise_error(F.concat(F.lit("not a calendar line: "), F.col("value"))).cast("boolean")
        return parse_calendar(lines.where(F.when(is_row, F.lit(True)).when(F.trim("value") == "", F.lit(False)).otherwise(bad)))
    others = lines.where(~is_row & (F.trim("value") != "")).groupBy(F.input_file_name().alias("file")).count()
    require_empty(others.where(F.col("count") > header_lines), f"files with more than {header_lines} lines that are no calendar lines")
    return parse_calendar(lines.where(is_row))


# fixed values: parameters a loss model needs
LOSS_PARAMETERS = ("loss_initial", "loss_total", "loss_power", "loss_method", "mean_loss_fit_a", "mean_loss_fit_b")


def loss_parameters(table: DataFrame, names: tuple[str, ...] = LOSS_PARAMETERS) -> DataFrame:
    """Key/value rows (``param``, ``value``) to one typed row; a missing key is an error."""
    wide = table.groupBy().pivot("param", list(names)).agg(F.first("value"))
    out = []
    for n in names:
        c = F.when(F.col(n).isNull(), F.raise_error(F.lit(f"missing parameter {n}")).cast("string")).otherwise(F.trim(F.col(n)))
        out.append((c if n == "loss_method" else c.cast("double")).alias(n))
    return wide.select(*out)


def scan_loss_parameters(spark: SparkSession, path: str) -> DataFrame:
    return loss_parameters(spark.read.csv(path, header=True, schema="param STRING, value STRING"))


def tables_to_features(tables: list[DataFrame], fid: str, columns: list[str]) -> DataFrame:
    """Union of several tables: the id and chosen columns, names in lower case."""
    parts = [t.toDF(*[c.lower() for c in t.columns]).select(fid.lower(), *[c.lower() for c in columns]) for t in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumnRenamed(fid.lower(), "id")


def read_integrated(by_window: list[tuple[int | None, DataFrame]]) -> DataFrame:
    """Union of per-window tables with a ``window`` column (1 when not given); a repeated window is an error."""
    windows = [w or 1 for w, _ in by_window]
    if len(set(windows)) != len(windows):
        raise ValueError(f"repeated window in {windows}")
    parts = [df.withColumn("window", F.lit(w)) for w, (_, df) in zip(windows, by_window)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out

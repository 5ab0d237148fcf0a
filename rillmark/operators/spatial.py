"""Zones over cells (through a coverage table) and blocks of grid cells."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.transforms import CLASS_BREAKS, class_labels, classify_breaks

DOY_TO_RADIANS = 2 * math.pi / 365


def on_coverage(values: DataFrame, coverage: DataFrame) -> DataFrame:
    """Values with the zones of their cell; a cell has few zones, so rows grow by a small factor."""
    return values.join(coverage, "cell_id")


def zonal_stats(values: DataFrame, coverage: DataFrame, variables: list[str], by: list[str] | None = None,
                stats: tuple[str, ...] = ("min", "max", "mean", "sum")) -> DataFrame:
    """Coverage-weighted statistics per zone, columns ``<var>_<stat>``.

    All of them combine map-side, so a zone of a third of all cells reaches the shuffle as one row
    per task.
    """
    f = F.col("fraction")
    aggs = []
    for v in variables:
        x = F.when(f > 0, F.col(v))
        forms = {"min": F.min(x), "max": F.max(x), "sum": F.coalesce(F.sum(x * f), F.lit(0.0)),
                 "mean": F.try_divide(F.sum(x * f), F.sum(F.when(x.isNotNull(), f)))}
        aggs += [forms[s].alias(f"{v}_{s}") for s in stats]
    return on_coverage(values, coverage).groupBy("zone_id", *(by or [])).agg(*aggs)


def zonal_weighted_sum(values: DataFrame, coverage: DataFrame, value: str, weight: str, output: str, by: list[str] | None = None) -> DataFrame:
    """Sum of fraction × value × weight per zone; ``values`` carries the weight."""
    return on_coverage(values, coverage).groupBy("zone_id", *(by or [])).agg(
        F.sum(F.col("fraction") * F.col(value) * F.col(weight)).alias(output))


def zonal_class_fractions(values: DataFrame, coverage: DataFrame, value: str, weights: list[str], zones: DataFrame | None = None,
                          zone_columns: dict[str, str] | None = None, breaks: tuple[float, ...] = CLASS_BREAKS,
                          by: list[str] | None = None) -> DataFrame:
    """Share of the area, and of each weight, in each class of ``value``, per zone.

    ``coverage`` has ``area_m2``, the covered area; ``values`` carries the weights, missing ones
    count as 0. ``zone_columns`` maps columns of ``zones`` to their names in the result.
    """
    by = by or []
    cls = classify_breaks(F.col(value), breaks)
    joined = on_coverage(values, coverage).withColumn("_class", cls)
    amounts = {"area": F.col("area_m2")} | {w: F.col("area_m2") * F.coalesce(F.col(w), F.lit(0.0)) for w in weights}
    aggs = []
    for name, amount in amounts.items():
        for i, label in enumerate(class_labels(breaks)):
            part = F.sum(F.when(F.col("_class") == i, amount).otherwise(0.0))
            aggs.append(F.try_divide(part, F.sum(amount)).alias(f"{name}_weighted_frac_{value}_{label}"))
    out = joined.groupBy("zone_id", *by).agg(*aggs)
    if zones is not None:
        out = out.join(zones.select("zone_id", *[F.col(c).alias(n) for c, n in (zone_columns or {}).items()]), "zone_id", "left")
    return out


def _block(factor: int) -> list[Column]:
    return [F.floor(F.col("row_no") / factor).cast("int").alias("row_no"), F.floor(F.col("col_no") / factor).cast("int").alias("col_no")]


def require_divisible(df: DataFrame, factor: int) -> None:
    """The grid size must be a multiple of the block size."""
    rows, cols = df.agg(F.max("row_no") + 1, F.max("col_no") + 1).first()
    if rows % factor or cols % factor:
        raise ValueError(f"a grid of {rows}x{cols} has no whole blocks of {factor}")


def block_aggregate(df: DataFrame, factor: int, value: str, stat: str, by: list[str] | None = None) -> DataFrame:
    """Sum or mean of blocks of cells; missing cells are skipped, a block without values is missing."""
    agg = {"sum": F.sum, "mean": F.avg}[stat]
    return df.groupBy(*_block(factor), *(by or [])).agg(agg(value).alias(value))


def mean_doy(doy: Column) -> Column:
    """Aggregate: circular mean of days 1…365; halves go up, whatever the last digits of the sums."""
    angle = (doy - 1) * DOY_TO_RADIANS
    mean = F.atan2(F.sum(F.sin(angle)), F.sum(F.cos(angle)))
    day = 1 + F.floor(F.when(mean < 0, mean + 2 * math.pi).otherwise(mean) / DOY_TO_RADIANS + 0.5 + 1e-9)
    return F.when(day > 365, day - 365).otherwise(day).cast("int")


def block_mean_doy(df: DataFrame, factor: int, doy: str, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*_block(factor), *(by or [])).agg(mean_doy(F.col(doy)).alias(doy))


def disaggregate(df: DataFrame, factor: int, amounts: list[str] | None = None) -> DataFrame:
    """Each cell becomes factor² cells with the same values; ``amounts`` are split evenly instead."""
    steps = F.sequence(F.lit(0), F.lit(factor - 1))
    out = df.withColumn("_i", F.explode(steps)).withColumn("_j", F.explode(steps))
    out = out.withColumns({"row_no": F.col("row_no") * factor + F.col("_i"), "col_no": F.col("col_no") * factor + F.col("_j")})
    return out.withColumns({a: F.col(a) / (factor * factor) for a in amounts or []}).drop("_i", "_j")


# fixed values: size of the one-degree forecast grid
ONE_DEGREE_ROWS, ONE_DEGREE_COLS = 181, 360


def one_degree_to_half(df: DataFrame, rows: int = ONE_DEGREE_ROWS, cols: int = ONE_DEGREE_COLS) -> DataFrame:
    """Point-centred one-degree rows and columns (0-based) to half-degree cells.

    The polar rows are half as high and give one row each, all others two; the last column straddles
    the date line, so it gives both the first and the last half-degree column.
    """
    row, col = F.col("row_no"), F.col("col_no")
    to_rows = F.when(row == 0, F.array(F.lit(0))).when(row == rows - 1, F.array(F.lit(2 * rows - 3))).otherwise(F.array(2 * row - 1, 2 * row))
    to_cols = F.when(col == cols - 1, F.array(F.lit(0), F.lit(2 * cols - 1))).otherwise(F.array(2 * col + 1, 2 * col + 2))
    return df.withColumns({"_r": to_rows, "_c": to_cols}).withColumn("row_no", F.explode("_r")).withColumn("col_no", F.explode("_c")).drop("_r", "_c")


def shift_columns(df: DataFrame, cols: int, by: int) -> DataFrame:
    """Rotate columns to the right by ``by`` (left when negative)."""
    return df.withColumn("col_no", F.pmod(F.col("col_no") + by, F.lit(cols)).cast("int"))


def pad_rows(df: DataFrame, rows: int, cols: int, north: int, south: int) -> DataFrame:
    """Rows of missing values before and after the grid; all columns but the cell numbers are NULL there."""
    spark = df.sparkSession
    moved = df.withColumn("row_no", F.col("row_no") + north)
    ids = spark.range((north + south) * cols)
    at = F.floor(F.col("id") / cols)
    blank = ids.select(F.when(at < north, at).otherwise(at + rows).cast("int").alias("row_no"), (F.col("id") % cols).cast("int").alias("col_no"))
    return moved.unionByName(blank, allowMissingColumns=True)


def align_flow_grid(df: DataFrame, extent: tuple[float, float, float, float], dims: tuple[int, int],
                    final_extent: tuple[float, float, float, float], final_dims: tuple[int, int]) -> DataFrame:
    """Rotate by one column where a grid of double resolution is off by one pixel, and pad missing latitudes."""
    dlat, dlon = (extent[3] - extent[2]) / dims[0], (extent[1] - extent[0]) / dims[1]
    out = df
    if extent[:2] != final_extent[:2]:
        off = (extent[0] - final_extent[0]) / dlon
        if dims[1] != 2 * final_dims[1] or abs(abs(off) - 1) > 1e-9:
            raise ValueError("cannot align the flow directions with the grid")
        out = shift_columns(out, dims[1], round(off))
    north, south = (final_extent[3] - extent[3]) / dlat, (extent[2] - final_extent[2]) / dlat
    if north < 0 or south < 0:
        raise ValueError("cannot reduce the extent of the flow directions")
    return pad_rows(out, dims[0], dims[1], round(north), round(south)) if north or south else out

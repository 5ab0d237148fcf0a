"""Combining datasets that share cells, months or grids."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.transforms import EARTH_RADIUS_M
from ..session import cut_lineage


def merge_datasets(dfs: list[DataFrame], keys: list[str]) -> DataFrame:
    """Variables of several datasets with the same keys side by side; a variable named twice is an error.

    A key absent from one dataset is an error as well: the full join shows it without further passes.
    """
    names = [c for df in dfs for c in df.columns if c not in keys]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"variables in more than one dataset: {twice}")
    marked = [df.withColumn(f"_in{i}", F.lit(1)) for i, df in enumerate(dfs)]
    out = reduce(lambda a, b: a.join(b, keys, "full"), marked)
    flags = [F.col(f"_in{i}") for i in range(len(dfs))]
    complete = reduce(lambda a, b: a & b, [f.isNotNull() for f in flags])
    checked = F.when(complete, F.col(keys[0])).otherwise(
        F.raise_error(F.concat(F.lit("datasets differ at "), F.concat_ws("/", *keys))).cast(dict(out.dtypes)[keys[0]]))
    return out.withColumn(keys[0], checked).drop(*[f"_in{i}" for i in range(len(dfs))])


def stack_layers(df: DataFrame, keys: list[str], layers: list[str]) -> DataFrame:
    """Layers side by side to long form with their 1-based position."""
    position = F.array_position(F.array(*[F.lit(c) for c in layers]), F.col("layer")).cast("int")
    return df.unpivot(keys, layers, "layer", "value").withColumn("position", position)


def unstack_layers(df: DataFrame, keys: list[str], layers: list[str]) -> DataFrame:
    return df.groupBy(*keys).pivot("layer", layers).agg(F.first("value"))


def combine_calendars(primary: DataFrame, *alternates: DataFrame) -> DataFrame:
    """Rows of each alternate for (unit, crop) pairs which no earlier calendar knows at all."""
    out = primary
    for alt in alternates:
        out = out.unionByName(alt.join(out.select("unit_code", "crop").distinct(), ["unit_code", "crop"], "left_anti"))
    return out


def attach_zone(points: DataFrame, coverage: DataFrame, cell: str = "cell_id", zone: str = "zone_id") -> DataFrame:
    """The first zone (lowest id) of the cell each point lies in; points outside all zones keep NULL."""
    first = coverage.groupBy(cell).agg(F.min(zone).alias(zone))
    return points.join(first, cell, "left")


def join_by_coarser(fine: DataFrame, coarse: DataFrame, factor: int, op: str, a: str, b: str, output: str, ignore_missing: bool = False) -> DataFrame:
    """Elementwise operation between grids whose cell sizes differ by an integer factor.

    Grids have ``row_no`` and ``col_no``; the coarser value serves all its fine cells.
    """
    key = {"_r": F.floor(F.col("row_no") / factor), "_c": F.floor(F.col("col_no") / factor)}
    other = coarse.select(F.col("row_no").cast("bigint").alias("_r"), F.col("col_no").cast("bigint").alias("_c"), F.col(b).alias("_b"))
    out = fine.withColumns(key).join(other, ["_r", "_c"], "left").drop("_r", "_c")
    x, y = F.col(a), F.col("_b")
    value = {"sum": x + y, "difference": x - y, "product": x * y, "quotient": F.try_divide(x, y)}[op]
    if ignore_missing:
        value = F.when(x.isNull(), y).when(y.isNull(), x).otherwise(value)
    return out.withColumn(output, value).drop("_b")


def psum(*columns: Column) -> Column:
    """Elementwise sum ignoring missing values, missing only where all are."""
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in columns])
    return F.when(F.coalesce(*columns).isNotNull(), total)


def synthetic_forecast(targets: DataFrame, source: DataFrame, keys: list[str], on: str) -> DataFrame:
    """Forecast rows for (keys, target): the observed month itself (``on='yearmon'``) or a calendar-month norm (``on='month'``)."""
    wanted = F.col("target") if on == "yearmon" else (F.col("target") % 100).cast("int")
    return targets.withColumn(on, wanted).join(source, [*keys, on], "left").drop(on)


def climatology_plus_anomaly(climatology: DataFrame, anomaly: DataFrame, on: list[str]) -> DataFrame:
    """Precipitation from a daily climatology and a rate anomaly, temperature from a plain sum."""
    out = anomaly.join(climatology, on)
    kept = [c for c in anomaly.columns if c not in ("Pr_anom", "T_anom")]
    return out.select(*kept, (F.col("Pr_clim") / 86400 + F.col("Pr_anom")).alias("Pr"), (F.col("T_clim") + F.col("T_anom")).alias("T"))


def best_of_versions(df: DataFrame, when: list[str], final: str, preliminary: str, output: str) -> DataFrame:
    """The final version, or the preliminary one for times whose final layer is wholly missing.

    One row per time holds the verdict, found by a partial aggregation and joined back: a layer is
    the whole grid, so a window over it would gather the grid in one task.
    """
    has_final = df.groupBy(*when).agg(F.bool_or(F.col(final).isNotNull()).alias("_final"))
    return (df.join(has_final, when)
            .withColumn(output, F.when(F.col("_final"), F.col(final)).otherwise(F.col(preliminary))).drop("_final"))


def dense_numbers(ids: DataFrame, column: str) -> DataFrame:
    """(column, number): 1, 2, … in ascending order of distinct ids, without gathering them in one place.

    The distinct ids are range-partitioned, sorted and written once; a number is the offset of its
    range plus the place in it. Only one count per partition reaches the offsets.
    """
    ordered = (ids.select(column).distinct().repartitionByRange(column).sortWithinPartitions(column)
               .withColumn("_pid", F.monotonically_increasing_id()))
    kept = cut_lineage(ordered)
    part, place = F.shiftright("_pid", 33), F.col("_pid").bitwiseAND(F.lit((1 << 33) - 1))
    placed = kept.select(column, part.alias("_part"), place.alias("_place"))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition, so the single sorted partition of this window is tiny by construction
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_offset"))
    return placed.join(F.broadcast(offsets), "_part").select(column, (F.col("_offset") + F.col("_place") + 1).alias("number"))


def collapse_ids(df: DataFrame, id_column: str, link_columns: list[str]) -> DataFrame:
    """Dense ids from 1 for the id and all columns linking to it; 0 stays 0."""
    numbers = dense_numbers(df, id_column)
    out = df
    for c in [id_column, *link_columns]:
        m = numbers.select(F.col(id_column).alias("_old"), F.col("number").alias("_new"))
        out = (out.join(m, F.col(c) == F.col("_old"), "left")
               .withColumn(c, F.when(F.col(c) == 0, F.lit(0)).otherwise(F.col("_new"))).drop("_old", "_new"))
    return out


def combos(df: DataFrame, **lists) -> DataFrame:
    """Every row of ``df`` with every combination of short literal lists."""
    out = df
    for name, values in lists.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out


def complete(df: DataFrame, keys: list[str], **dims) -> DataFrame:
    """Every key with every combination of the listed dimension values; new rows have missing variables.

    Dimension values are literal lists (crops, quantiles, members), so the number of rows is known
    beforehand and no product of two tables arises.
    """
    return combos(df.select(*keys).distinct(), **dims).join(df, [*keys, *dims], "left")


# ---- nearest neighbours ---------------------------------------------------------------------------

PARTS = 4
SPLITS = 12
LEAF = 16


def _unit_vector(lat: Column, lon: Column) -> list[Column]:
    return [F.cos(F.radians(lat)) * F.cos(F.radians(lon)), F.cos(F.radians(lat)) * F.sin(F.radians(lon)), F.sin(F.radians(lat))]


def _one_lon(lat: Column, lon: Column) -> Column:
    """The same longitude for the same place: 0 at the poles, -180 up to 180 elsewhere."""
    return F.when(F.abs(lat) == 90, 0.0).when((lon < -180) | (lon >= 180), F.pmod(lon + 180, F.lit(360.0)) - 180).otherwise(lon)


def _box(edge: float) -> list[Column]:
    return [F.floor(F.col(f"{p}") / edge).alias(f"_{p}") for p in ("x", "y", "z")]


def nearest_match(left: DataFrame, right: DataFrame, left_id: str, right_id: str, max_m: float, leaf: int = LEAF) -> DataFrame:
    """(left_id, right_id, distance_m): the nearest right point within ``max_m``, lowest id on ties.

    Both sides have ``lat`` and ``lon``. Points become unit vectors, so neither the date line nor the
    poles need care, and are put into cubes as wide as the search distance: candidates lie in the 27
    cubes around a point. Where a cube holds more than ``leaf`` places it is not paired with its
    points but split into smaller cubes, again and again, dropping every one that cannot hold the
    nearest place; so a crowded cube costs each point a few cubes per split, not its whole content.
    Equal places are merged first, on both sides, whatever longitude they are given at a pole or by full turns.
    """
    chord = 2 * math.sin(min(max_m / EARTH_RADIUS_M, math.pi) / 2)
    edge = max(chord, 1e-9)
    axes = ("x", "y", "z")

    def places(df: DataFrame, name: str) -> DataFrame:
        merged = df.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).groupBy("lat", "lon").agg(F.min(name).alias("_id"))
        at = _unit_vector(F.col("lat"), _one_lon(F.col("lat"), F.col("lon")))
        return merged.select("lat", "lon", "_id", *[v.alias(a) for v, a in zip(at, axes)])

    sites = cut_lineage(places(right, right_id).groupBy(*axes).agg(F.min("_id").alias("_id")))
    queries = places(left, left_id).select(F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), *[F.col(a).alias(f"q{a}") for a in axes])
    frontier = queries
    for a in axes:
        home = F.floor(F.col(f"q{a}") / edge)
        frontier = frontier.withColumn(f"_{a}", F.explode(F.sequence(home - 1, home + 1)))

    def lower_and_upper(width: float) -> tuple[Column, Column]:
        """Smallest and largest squared chord from the query to anywhere in its candidate cube."""
        low, high = [], []
        for a in axes:
            start, q = F.col(f"_{a}") * width, F.col(f"q{a}")
            low.append(F.greatest(start - q, q - (start + width), F.lit(0.0)))
            high.append(F.greatest(q - start, start + width - q))
        return reduce(lambda u, v: u + v, [d * d for d in low]), reduce(lambda u, v: u + v, [d * d for d in high])

    box, width, found = [f"_{a}" for a in axes], edge, []
    where = ["_lat", "_lon"]
    pairs = frontier.join(sites.groupBy(*_box(width)).agg(F.count("*").alias("_n")), box)
    for split in range(SPLITS + 1):
        low, high = lower_and_upper(width)
        pairs = pairs.withColumns({"_low": low, "_high": high}).where(F.col("_low") <= chord * chord * (1 + 1e-9))
        bound = pairs.groupBy(*where).agg(F.min("_high").alias("_best"))
        pairs = cut_lineage(pairs.join(bound, where).where(F.col("_low") <= F.col("_best")).drop("_low", "_high", "_best"))
        # cubes of the last split are far below a millimetre: what is still together is compared place by place
        last = split == SPLITS
        found.append((width, (pairs if last else pairs.where(F.col("_n") <= leaf)).drop("_n")))
        crowded = pairs.where(F.col("_n") > leaf).drop("_n")
        if last or crowded.isEmpty():
            break
        width = width / PARTS
        inner = sites.groupBy(*_box(width)).agg(F.count("*").alias("_n"))
        inner = inner.select("_n", *[F.col(c).alias(f"_in{c}") for c in box], *[F.floor(F.col(c) / PARTS).alias(c) for c in box])
        pairs = crowded.join(inner, box).drop(*box).withColumnsRenamed({f"_in{c}": c for c in box})

    hits = []
    for w, leaves in found:
        close = leaves.join(sites.select("_id", *axes, *_box(w)), box)
        gap = reduce(lambda u, v: u + v, [(F.col(a) - F.col(f"q{a}")) * (F.col(a) - F.col(f"q{a}")) for a in axes])
        hits.append(close.select(*where, F.struct(gap.alias("gap"), F.col("_id").alias("id")).alias("hit")))
    best = reduce(lambda u, v: u.unionByName(v), hits).groupBy(*where).agg(F.min("hit").alias("hit"))
    metres = 2 * EARTH_RADIUS_M * F.asin(F.least(F.lit(1.0), F.sqrt(F.col("hit.gap")) / 2))
    best = best.select(*where, F.col("hit.id").alias(right_id), metres.alias("distance_m")).where(F.col("distance_m") <= max_m)
    return left.join(best, (F.col("lat") == F.col("_lat")) & (F.col("lon") == F.col("_lon"))).select(left_id, right_id, "distance_m")


def near_any(points: DataFrame, vertices: DataFrame, point_id: str, vertex_id: str, distance_m: float = 3000.0) -> DataFrame:
    """(point_id, near): whether any vertex of a densified line lies within the distance."""
    hits = nearest_match(points, vertices, point_id, vertex_id, distance_m).select(point_id, F.lit(True).alias("_hit"))
    return points.select(point_id).join(hits, point_id, "left").select(point_id, F.coalesce("_hit", F.lit(False)).alias("near"))

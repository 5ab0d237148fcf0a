"""Element-wise transforms, unit conversions and grid coordinates as Column functions."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values
EARTH_RADIUS_M = 6371000.0
CLASS_BREAKS = (3, 5, 10, 20, 40)
SECONDS_PER_DAY = 86400
LATENT_HEAT_J_PER_KG = 2.5e6
SENTINEL = -32767


def negate(x: Column) -> Column:
    return -x


def fill0(x: Column) -> Column:
    return F.coalesce(x, F.lit(0.0))


def clamp0(x: Column) -> Column:
    return F.when(x < 0, F.lit(0.0)).otherwise(x)


def clamp(x: Column, lo: Column | float, hi: Column | float) -> Column:
    """Bounded value; a missing value or bound gives a missing result (``greatest`` alone would skip it)."""
    lo, hi = (v if isinstance(v, Column) else F.lit(v) for v in (lo, hi))
    return F.when(x.isNotNull() & lo.isNotNull() & hi.isNotNull(), F.least(F.greatest(x, lo), hi))


def fill(x: Column, replacement: Column | float) -> Column:
    return F.coalesce(x, replacement if isinstance(replacement, Column) else F.lit(replacement))


@dataclass(frozen=True)
class VarSpec:
    """``name@transform@…->alias``."""

    name: str
    transforms: tuple[str, ...] = field(default=())
    alias: str | None = None

    @staticmethod
    def parse(spec: str) -> "VarSpec":
        source, _, alias = spec.partition("->")
        name, *transforms = source.split("@")
        return VarSpec(name.strip(), tuple(transforms), alias.strip() or None)

    @property
    def output(self) -> str:
        return self.alias or self.name


def select_vars(df: DataFrame, keys: list[str], specs: list[str | VarSpec]) -> DataFrame:
    """Keys and the named variables; transforms apply left to right.

    ``[…]`` is a Spark SQL expression of ``x``. Each runs in its own projection, so ``x`` is never
    written out more than once and Catalyst decides what to merge.
    """
    specs = [VarSpec.parse(s) if isinstance(s, str) else s for s in specs]
    out = df.select(*keys, *[F.col(s.name).alias(s.output) for s in specs])
    for depth in range(max((len(s.transforms) for s in specs), default=0)):
        out = out.withColumns({
            s.output: apply_transform(s.output, s.transforms[depth]) for s in specs if depth < len(s.transforms)
        })
    return out


def apply_transform(name: str, transform: str) -> Column:
    named = {"negate": negate, "fill0": fill0, "clamp0": clamp0}
    if transform in named:
        return named[transform](F.col(f"`{name}`"))
    if transform.startswith("[") and transform.endswith("]"):
        return F.expr(re.sub(r"\bx\b", f"`{name}`", transform[1:-1])).cast("double")
    raise ValueError(f"unknown transform: {transform}")


def substitute(v: Column, mapping: dict) -> Column:
    """Replace mapped values, keep the others."""
    if not mapping:
        return v
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), v), v)


def reclassify(df: DataFrame, column: str, table: DataFrame, source: str, target: str, na_default: bool = True) -> DataFrame:
    """Look ``column`` up in ``table``; a NULL row of the table serves missing values.

    Unmatched values become missing, or raise when ``na_default`` is off. Catalyst broadcasts the
    table when it is small.
    """
    known = table.select(F.col(source).alias("_from"), F.col(target).alias("_to"), F.lit(True).alias("_hit"))
    out = df.join(known, F.col(column).eqNullSafe(F.col("_from")), "left")
    value = F.col("_to")
    if not na_default:
        value = F.when(F.col("_hit"), value).otherwise(
            F.raise_error(F.concat(F.lit("no class for "), F.coalesce(F.col(column).cast("string"), F.lit("NULL")))).cast("double"))
    return out.withColumn(column, value).drop("_from", "_to", "_hit")


def assign_to_bin(v: Column, bins: list[float]) -> Column:
    """Greatest bin not above the value, the lowest bin for anything below it."""
    bins = sorted(bins)
    out = F.when(v.isNull(), None)
    for b in reversed(bins[1:]):
        out = out.when(v >= b, F.lit(b))
    return out.otherwise(F.lit(bins[0]))


def class_labels(breaks: tuple[float, ...] = CLASS_BREAKS) -> list[str]:
    mid = [f"{a}_{b}" for a, b in zip(breaks, breaks[1:])]
    return [f"lt_{breaks[0]}", *mid, f"gt_{breaks[-1]}"]


def classify_breaks(v: Column, breaks: tuple[float, ...] = CLASS_BREAKS) -> Column:
    """Number of the left-closed interval, 0 below the first break and for missing values."""
    out = F.when(v.isNull(), 0)
    for i, b in reversed(list(enumerate(breaks, start=1))):
        out = out.when(v >= b, i)
    return out.otherwise(0)


def classify_label(v: Column, breaks: tuple[float, ...] = CLASS_BREAKS) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in class_labels(breaks)]), classify_breaks(v, breaks) + 1)


def flat_index(row: Column, col: Column, ncol: int) -> Column:
    return row.cast("bigint") * ncol + col


def unflatten(index: Column, ncol: int) -> tuple[Column, Column]:
    return F.floor(index / F.lit(ncol)).cast("int"), (index % ncol).cast("int")


def wrap_longitude(lon: Column, shift: float = 0.0) -> Column:
    """0…360 to ±180; ``shift`` moves corners to centres first."""
    moved = lon + F.lit(shift) if shift else lon
    return F.when(moved > 180, moved - 360).otherwise(moved)


def normalize_lonlat(df: DataFrame, dlon: float, dlat: float, north: float = 90.0, corners: bool = False) -> DataFrame:
    """±180 longitudes and row/column numbers with latitudes descending from ``north``."""
    lon = wrap_longitude(F.col("lon"), dlon / 2 if corners else 0.0)
    return df.withColumn("lon", lon).withColumns({
        "row_no": F.floor((F.lit(north) - F.col("lat")) / dlat).cast("int"),
        "col_no": F.floor((F.col("lon") + 180) / dlon).cast("int"),
    })


def cell_centers(row: Column, col: Column, extent: tuple[float, float, float, float], dims: tuple[int, int]) -> tuple[Column, Column]:
    """(lat, lon) of cell centres for extent (xmin, xmax, ymin, ymax) and dims (rows, columns)."""
    xmin, xmax, ymin, ymax = extent
    dlat, dlon = (ymax - ymin) / dims[0], (xmax - xmin) / dims[1]
    return F.lit(ymax - dlat / 2) - row * F.lit(dlat), F.lit(xmin + dlon / 2) + col * F.lit(dlon)


def cell_area_m2(lat: Column, dlat: float, dlon: float) -> Column:
    """Spherical area of the cell centred at ``lat``."""
    band = F.abs(F.sin(F.radians(lat + dlat / 2)) - F.sin(F.radians(lat - dlat / 2)))
    return F.lit(math.pi / 180 * EARTH_RADIUS_M**2 * dlon) * band


def kelvin_to_celsius(t: Column) -> Column:
    return t - 273.15


def flux_to_mm_per_day(kg_m2_s: Column) -> Column:
    return kg_m2_s * SECONDS_PER_DAY


def heat_to_mm_per_day(w_m2: Column) -> Column:
    return w_m2 / LATENT_HEAT_J_PER_KG * SECONDS_PER_DAY


def three_hourly_to_daily(per_3h: Column) -> Column:
    return per_3h * 8


def mm_to_m3(mm: Column, area_m2: Column) -> Column:
    return mm / 1000 * area_m2


def temperature_celsius(t: Column, units: str) -> Column:
    if units in ("degree_Celsius", "degree_C", "C"):
        return t
    if units in ("K", "kelvin"):
        return kelvin_to_celsius(t)
    if units in ("degree_F", "F"):
        return (t - 32) / 1.8
    raise ValueError(f"cannot convert temperature from {units}")


def precipitation_mm(p: Column, units: str, days: Column | int | None = None) -> Column:
    """Length units as they are; rates need the number of days they lasted."""
    lengths = {"mm": 1.0, "cm": 10.0, "m": 1000.0}
    rates = {"mm/day": 1.0, "m/s": 1000.0 * SECONDS_PER_DAY, "mm/s": float(SECONDS_PER_DAY), "kg/m^2/s": float(SECONDS_PER_DAY)}
    if units in lengths:
        return p * lengths[units]
    if units in rates and days is not None:
        return p * rates[units] * days
    raise ValueError(f"cannot convert precipitation from {units}")


def prepare_model_output(df: DataFrame, days: Column, area_m2: Column) -> DataFrame:
    """Monthly temperature, precipitation, PET−E, runoff (mm, m³) and soil water from raw model columns."""
    runoff = (F.col("qs_acc") + F.col("qsb_acc") + F.col("qsm_acc"))
    return df.withColumns({
        "T": kelvin_to_celsius(F.col("tair_f_inst")),
        "Pr": flux_to_mm_per_day(F.col("rainf_f_tavg")) * days,
        "PETmE": heat_to_mm_per_day(F.col("potevap_tavg")) * days - flux_to_mm_per_day(F.col("evap_tavg")) * days,
        "RO_mm": three_hourly_to_daily(runoff) * days,
        "Ws": F.col("soilmoi0_10cm_inst") + F.col("soilmoi10_40cm_inst") + F.col("soilmoi40_100cm_inst"),
    }).withColumn("RO_m3", mm_to_m3(F.col("RO_mm"), area_m2))


def digits_for_resolution(resolution: float) -> int:
    return -math.floor(math.log10(resolution))


def round_to_resolution(x: Column, resolution: float) -> Column:
    """Round so that later fits are not driven by noise below the resolution."""
    return F.round(x, digits_for_resolution(resolution))


def land_mask(fraction: Column, threshold: float) -> Column:
    return F.when(fraction > threshold, F.lit(1))


def linear_interpolation(x: Column, xs: list[float], ys: list[float], left: float | None = None, right: float | None = None) -> Column:
    """Piecewise linear through the knots; ``left`` and ``right`` serve values outside (NULL if not given)."""
    out = F.when(x.isNull(), None).when(x < xs[0], F.lit(left).cast("double"))
    for x0, x1, y0, y1 in zip(xs, xs[1:], ys, ys[1:]):
        out = out.when(x < x1, F.lit(float(y0)) + (x - x0) * F.lit((y1 - y0) / (x1 - x0)))
    return out.when(x == xs[-1], F.lit(float(ys[-1]))).otherwise(F.lit(right).cast("double"))


def crop_extent(df: DataFrame, xmin: float, xmax: float, ymin: float, ymax: float) -> DataFrame:
    return df.where(F.col("lon").between(xmin, xmax) & F.col("lat").between(ymin, ymax))


def clean_stress(df: DataFrame, column: str) -> DataFrame:
    """Drop sentinel values, bound the others to 0…1."""
    return df.where(F.col(column) > SENTINEL).withColumn(column, clamp(F.col(column), 0.0, 1.0))

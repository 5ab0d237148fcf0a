"""Statistics over the layers of a cell (months, members, years)."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric as N
from . import ordered

# fixed values: standard windows in months and the statistics computed for each variable
WINDOWS = (3, 6, 12, 24, 36, 60)
INTEGRATION_PLAN = {
    "Bt_RO": ("min", "max", "sum"),
    "E": ("sum",),
    "PETmE": ("sum",),
    "P_net": ("sum",),
    "Pr": ("sum",),
    "RO_mm": ("sum",),
    "Sa": ("sum",),
    "T": ("ave",),
    "Ws": ("ave",),
}
ENSEMBLE_QUANTILES = (25, 50, 75)


def plain_stat(stat: str, x: Column) -> Column | None:
    """The aggregate of a statistic Spark can combine map-side; None for order statistics."""
    stat = stat.lower()
    if stat == "sum":
        return F.coalesce(F.sum(x), F.lit(0.0))
    if stat == "ave":
        return F.avg(x)
    if stat == "min":
        return F.min(x)
    if stat == "max":
        return F.max(x)
    if stat == "fraction_defined":
        return F.count(x) / F.count("*")
    if stat == "fraction_defined_above_zero":
        return F.try_divide(F.count_if(x > 0), F.count(x))
    if stat == "num_defined":
        return F.count(x)
    return None


def extreme_position(x: Column, layer: Column, largest: bool) -> Column:
    """Aggregate: position of the extreme, the first one on ties."""
    if largest:
        return F.max_by(layer, F.when(x.isNotNull(), F.struct(x, -layer)))
    return F.min_by(layer, F.when(x.isNotNull(), F.struct(x, layer)))


def quantile_of(stat: str) -> float | None:
    """``median`` and ``q25``, ``q97.5`` as a probability; None for anything else."""
    stat = stat.lower()
    if stat == "median":
        return 0.5
    found = re.fullmatch(r"q(\d+(\.\d+)?)", stat)
    if not found:
        return None
    p = float(found.group(1)) / 100
    if p > 1:
        raise ValueError(f"quantile out of range: {stat}")
    return p


def parse_stat(spec: str) -> tuple[str, list[str]]:
    """``stat::var1,var2`` restricts a statistic to variables, ``stat`` alone means all."""
    stat, _, names = spec.partition("::")
    if not stat or (plain_stat(stat, F.lit(1.0)) is None and quantile_of(stat.lower().removeprefix("weighted_")) is None
                    and stat.lower() not in ("which_min", "which_max")):
        raise ValueError(f"unknown statistic: {spec}")
    return stat, [n.strip() for n in names.split(",") if n.strip()]


def integrate(df: DataFrame, keys: list[str], stats: list[str], variables: list[str], layer: str | None = None,
              keep_names: bool = False, bounded: bool = False, weight: str | None = None) -> DataFrame:
    """Several statistics of several variables per key, columns ``<var>_<stat>`` in lower case of the statistic.

    ``weighted_q<N>`` and ``weighted_median`` take the column ``weight``.

    Everything Spark can combine map-side is one pass; quantiles of all variables add one ordered
    pass. To repeat per value of a further dimension, add it to ``keys``.
    """
    plain, tails, weighted, asked = {}, [], {}, []
    for spec in stats:
        stat, names = parse_stat(spec)
        for v in names or variables:
            name = v if keep_names else f"{v}_{stat.lower()}"
            asked.append(name)
            agg = plain_stat(stat, F.col(v))
            if agg is None and stat.lower().startswith("which_"):
                agg = extreme_position(F.col(v), F.col(layer), stat.lower() == "which_max")
            if agg is not None:
                plain[name] = agg
            elif stat.lower().startswith("weighted_"):
                if weight is None:
                    raise ValueError(f"{stat} needs a column of weights")
                weighted.setdefault(v, {})[name] = quantile_of(stat.lower().removeprefix("weighted_"))
            else:
                tails.append((v, name, quantile_of(stat)))
    if keep_names and len(asked) > len(set(asked)):
        raise ValueError("only one statistic per variable when names are kept")
    per_var: dict[str, dict[str, float]] = {}
    for v, name, p in tails:
        per_var.setdefault(v, {})[name] = p
    parts = [df.groupBy(*keys).agg(*[a.alias(n) for n, a in plain.items()])] if plain else []
    if per_var:
        parts.append(ordered.quantiles_of_many(df, keys, per_var, bounded))
    parts += [weighted_quantiles(df, keys, v, weight, ps, bounded) for v, ps in weighted.items()]
    return reduce(lambda a, b: a.join(b, keys, "left"), parts)


def weighted_mean(x: Column, w: Column) -> Column:
    return F.try_divide(F.sum(x * w), F.sum(F.when(x.isNotNull(), w)))


def weighted_quantiles(df: DataFrame, keys: list[str], value: str, weight: str, ps: dict[str, float],
                       bounded: bool = False, ranges: int | None = None) -> DataFrame:
    """Weighted quantiles per key; a key without defined values gives NULL, a bad weight is an error."""
    w = F.when(F.col(weight).isNull() | (F.col(weight) < 0),
               F.raise_error(F.lit("weights must be defined and not negative")).cast("double")).otherwise(F.col(weight))
    base = (
        df.withColumn("_w", w).where(F.col(value).isNotNull())
        .groupBy(*keys, value, "_w").agg(F.count("*").alias("m"))
        .withColumn("mass", F.col("m") * F.col("_w"))
    )
    runs = ordered.running_totals(base, keys, [value, "_w"], ["m", "mass"], bounded, ranges)
    n1 = F.col("all_m") - 1
    first = F.col("below_m") * F.col("_w") + n1 * F.col("below_mass")
    last = (F.col("below_m") + F.col("m") - 1) * F.col("_w") + n1 * (F.col("below_mass") + (F.col("m") - 1) * F.col("_w"))
    points = runs.select(*keys, F.col(value).alias("_x"), (n1 * F.col("all_mass")).alias("_span"),
                         F.explode(F.array(first, last)).alias("_s"))
    at = F.struct("_s", "_x")

    def one(p: float) -> Column:
        goal = F.col("_span") * F.lit(float(p))
        low, high = F.max(F.when(F.col("_s") <= goal, at)), F.min(F.when(F.col("_s") > goal, at))
        share = (F.max(goal) - low["_s"]) / (high["_s"] - low["_s"])
        return F.when(high.isNull(), low["_x"]).otherwise(low["_x"] + (high["_x"] - low["_x"]) * share)

    found = points.groupBy(*keys).agg(*[one(p).alias(n) for n, p in ps.items()])
    return df.select(*keys).distinct().join(found, keys, "left")


def sorted_values(df: DataFrame, keys: list[str], value: str, bounded: bool = False, ranges: int | None = None) -> DataFrame:
    """Values in ascending order as rows (keys, position from 1, value), missing ones last."""
    base = df.groupBy(*keys, value).agg(F.count("*").alias("m"))
    runs = ordered.running_totals(base, keys, [value], ["m"], bounded, ranges)
    return runs.select(*keys, F.explode(F.sequence(F.col("below_m") + 1, F.col("below_m") + F.col("m"))).alias("position"), value)


def ranks(df: DataFrame, history: DataFrame, keys: list[str], value: str, observed: str, bounded: bool = False) -> DataFrame:
    """Rank range of each value among the history of its key, without pairing values and history.

    Adds ``min_rank`` = 1 + smaller ones, ``max_rank`` = 1 + smaller or equal ones, ``n_obs``.
    """
    events = (
        history.where(F.col(observed).isNotNull()).select(*keys, F.col(observed).alias(value), F.lit(1).alias("one"))
        .unionByName(df.where(F.col(value).isNotNull()).select(*keys, value, F.lit(0).alias("one")))
        .groupBy(*keys, value).agg(F.sum("one").alias("m"))
    )
    runs = ordered.running_totals(events, keys, [value], ["m"], bounded).select(
        *keys, value, (F.col("below_m") + 1).alias("min_rank"),
        (F.col("below_m") + F.col("m") + 1).alias("max_rank"), F.col("all_m").alias("n_obs"),
    )
    return df.join(runs, [*keys, value], "left")


def layer_slice(df: DataFrame, starts: DataFrame, keys: list[str], layer: str, value: str, start: str, n: int,
                fill: float | None = None, seed: int | None = None) -> DataFrame:
    """``n`` layers from a start given per key; layers that do not exist take ``fill``, or normal noise made of seed, key and position (from 0)."""
    wanted = starts.select(*keys, F.posexplode(F.sequence(F.col(start), F.col(start) + n - 1)).alias("position", layer))
    present = df.select(*keys, layer, value, F.lit(True).alias("_inside"))
    out = wanted.join(present, [*keys, layer], "left")
    outside = F.lit(fill).cast("double") if seed is None else N.noise(seed, *keys, "position")
    return out.select(*keys, (F.col("position") + 1).alias("position"),
                      F.when(F.col("_inside"), F.col(value)).otherwise(outside).alias(value))


def ensemble_weights(members: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Every model weighs the same, its members share its weight: 1 / (members of model) / models.

    ``members`` lists members (one row each); results carry ``weight``.
    """
    by = by or []
    per_model = members.groupBy(*by, "model").agg(F.count("*").alias("_members"))
    models = per_model.withColumn("_models", F.count("*").over(Window.partitionBy(*by)) if by
                                  else F.lit(per_model.agg(F.count("*").alias("n")).scalar()))
    weights = models.select(*by, "model", (1.0 / F.col("_members") / F.col("_models")).alias("weight"))
    return members.join(weights, [*by, "model"])


def ensemble_members(runs: DataFrame, run_time: str, issue: Column, now: Column | None = None,
                     lag_hours: int | None = None) -> DataFrame:
    """Runs on the last seven days of the issue month at 0, 6, 12 and 18 h; optionally only old enough ones."""
    last = F.last_day(F.to_date(issue.cast("string"), "yyyyMM"))
    day = F.to_date(run_time)
    out = runs.where((day > F.date_sub(last, 7)) & (day <= last) & F.hour(run_time).isin(0, 6, 12, 18)
                     & (F.minute(run_time) == 0))
    if lag_hours is not None:
        out = out.where(F.col(run_time) < now - F.make_interval(hours=F.lit(lag_hours)))
    return out


def ensemble_summary(df: DataFrame, keys: list[str], variables: list[str], weight: str | None = None,
                     bounded: bool = False) -> DataFrame:
    """Quartiles over the members, columns ``<var>_q25`` …; unweighted unless a weight column is named."""
    wanted = {v: {f"{v}_q{q}": q / 100 for q in ENSEMBLE_QUANTILES} for v in variables}
    if weight is None:
        return ordered.quantiles_of_many(df, keys, wanted, bounded)
    parts = [weighted_quantiles(df, keys, v, weight, ps, bounded) for v, ps in wanted.items()]
    return reduce(lambda a, b: a.join(b, keys, "full"), parts)


def climate_norm(df: DataFrame, keys: list[str], variables: list[str], stat: str = "ave", bounded: bool = False) -> DataFrame:
    """Mean or median per calendar month over the years; names are kept."""
    return integrate(df, [*keys, "month"], [stat], variables, keep_names=True, bounded=bounded)


def wet_day_fraction(daily: DataFrame, keys: list[str], precip: str, threshold: float, scale: float = 1.0) -> DataFrame:
    """Share of defined days whose amount exceeds the threshold, per month of column ``day``."""
    month = (F.year("day") * 100 + F.month("day")).cast("int").alias("yearmon")
    return daily.groupBy(*keys, month).agg(
        plain_stat("fraction_defined_above_zero", F.col(precip) * scale - threshold).alias("pWetDays"))


def daily_totals(hourly: DataFrame, keys: list[str], precip: str) -> DataFrame:
    """Daily sums of hourly amounts; a day whose hours are all missing sums to zero."""
    return hourly.groupBy(*keys, "day").agg(plain_stat("sum", F.col(precip)).alias(precip))


def wet_days_with_fallback(wet: DataFrame, months: DataFrame, keys: list[str], first_year: int, years: tuple[int, int]) -> DataFrame:
    """Before ``first_year`` use the long-term mean of the calendar month.

    ``months`` lists the wanted (keys, yearmon); the mean is taken over ``years``.
    """
    year, month = F.floor(F.col("yearmon") / 100), F.col("yearmon") % 100
    norm = (wet.where(year.between(*years)).withColumn("month", month)
            .groupBy(*keys, "month").agg(F.avg("pWetDays").alias("_norm")))
    out = months.withColumn("month", month).join(norm, [*keys, "month"], "left").join(wet, [*keys, "yearmon"], "left")
    return out.select(*keys, "yearmon", F.when(year < first_year, F.col("_norm")).otherwise(F.col("pWetDays")).alias("pWetDays"))


def monthly_mean_temperature(daily: DataFrame, keys: list[str]) -> DataFrame:
    """Monthly means of tmin, tmax and their midpoint."""
    month = (F.year("day") * 100 + F.month("day")).cast("int").alias("yearmon")
    return daily.withColumn("tavg", (F.col("tmin") + F.col("tmax")) / 2).groupBy(*keys, month).agg(
        F.avg("tmin").alias("tmin"), F.avg("tmax").alias("tmax"), F.avg("tavg").alias("tavg"))


def monthly_precip_rate(daily: DataFrame, keys: list[str], precip: str) -> DataFrame:
    """Mean daily amount (tenths of mm) as a rate per second of the month."""
    month = (F.year("day") * 100 + F.month("day")).cast("int").alias("yearmon")
    seconds = F.day(F.last_day("day")) * 86400
    return daily.groupBy(*keys, month).agg(F.avg(F.col(precip) * 10 / seconds).alias("Pr"))


def soil_capacity(layers: DataFrame, max_depth: float) -> DataFrame:
    """Water capacity per map unit: proportion-weighted mean of each whole layer above a depth, then their sum."""
    capacity = F.col("tawc_mm") * (F.col("bottom_m") - F.col("top_m"))
    per_layer = (layers.where(F.col("bottom_m") <= max_depth).groupBy("unit", "layer")
                 .agg((F.sum(capacity * F.col("prop")) / F.sum("prop")).alias("capacity")))
    return per_layer.groupBy("unit").agg(F.sum("capacity").alias("tawc"))


def capacity_factors(plants: DataFrame, reported: list[str], estimated: str) -> DataFrame:
    """Capacity factor per plant: first reported year, else the estimate; fuel mean where not positive.

    Plants of a fuel without any positive factor drop out.
    """
    gwh = F.coalesce(*reported, estimated)
    factor = gwh * 1000 / 24 / 365.25 / F.col("capacity_mw")
    own = plants.select("plant_id", "fuel", F.when(factor.isNotNull(), F.least(F.lit(1.0), factor)).alias("own"))
    fuel = own.where(F.col("own") > 0).groupBy("fuel").agg(F.avg("own").alias("fuel_mean"))
    return own.join(fuel, "fuel").select(
        "plant_id", F.when(F.col("own") > 0, F.col("own")).otherwise(F.col("fuel_mean")).alias("capacity_factor"))

"""L-moments and distributions per key (cell, variable, calendar month, window …)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N
from . import ordered
from .integrate import sorted_values

EULER = 0.5772156649015329
NEWTON_STEPS = 10


def _falling(x: Column, r: int) -> Column:
    out = F.lit(1.0)
    for i in range(r):
        out = out * (x - float(i))
    return out


def _rank_weight(r: int) -> Column:
    """Sum of j(j-1)…(j-r+1) over the 0-based ranks j of a run of equal values."""
    a, m = F.col("below_m").cast("double"), F.col("m").cast("double")
    run = (_falling(a + m, r + 1) - _falling(a, r + 1)) / (r + 1)
    return F.when(F.col("m") == 1, _falling(a, r)).otherwise(run)


def _moments(df: DataFrame, keys: list[str], value: str, bounded: bool, extra: list[Column] = ()) -> DataFrame:
    """Probability-weighted sums of each key, then L-moments; all sums combine map-side."""
    oc = ordered.ordered_counts(df, keys, value, bounded)
    sums = oc.groupBy(*keys).agg(
        F.max("all_m").alias("n_defined"), F.count(value).alias("n_unique"),
        *[F.sum(F.col(value) * _rank_weight(r)).alias(f"_s{r}") for r in range(5)], *extra,
    )
    n = F.col("n_defined").cast("double")
    out = sums.withColumns({f"_b{r}": F.when(n > r, F.col(f"_s{r}") / F.nullif(_falling(n, r + 1), F.lit(0.0))) for r in range(5)})
    b = [F.col(f"_b{r}") for r in range(5)]
    out = out.withColumns({
        "l1": b[0],
        "l2": 2 * b[1] - b[0],
        "_l3": 6 * b[2] - 6 * b[1] + b[0],
        "_l4": 20 * b[3] - 30 * b[2] + 12 * b[1] - b[0],
        "_l5": 70 * b[4] - 140 * b[3] + 90 * b[2] - 20 * b[1] + b[0],
    })
    spread = F.when(F.col("l2") > 0, F.col("l2"))
    return out.withColumns({"t3": F.col("_l3") / spread, "t4": F.col("_l4") / spread, "t5": F.col("_l5") / spread}).drop(
        *[f"_s{r}" for r in range(5)], *[f"_b{r}" for r in range(5)], "_l3", "_l4", "_l5")


def l_moments(df: DataFrame, keys: list[str], value: str, bounded: bool = False) -> DataFrame:
    """l1, l2 and the ratios t3, t4, t5 of the defined values of each key."""
    return _moments(df, keys, value, bounded)


def _gev(lm: DataFrame) -> DataFrame:
    """Generalized extreme value parameters from L-moments; the shape by Newton steps."""
    t3 = F.when((F.col("t3") > -1) & (F.col("t3") < 1), F.col("t3"))
    c = 2 / (3 + t3) - math.log(2) / math.log(3)
    start = 7.8590 * c + 2.9554 * c * c

    def step(k: Column) -> Column:
        p2, p3 = F.pow(F.lit(2.0), -k), F.pow(F.lit(3.0), -k)
        u, v = 1 - p3, 1 - p2
        slope = 2 * (math.log(3) * p3 * v - math.log(2) * p2 * u) / (v * v)
        return F.when(F.abs(k) < N.GUMBEL_BELOW, k).otherwise(k - (2 * u / v - 3 - F.col("t3")) / slope)

    # a fold keeps the expression small: the steps are not written out one inside the other
    out = lm.withColumn("_k", F.aggregate(F.sequence(F.lit(1), F.lit(NEWTON_STEPS)), start, lambda k, _: step(k)))
    k = F.col("_k")
    small = F.abs(k) < N.GUMBEL_BELOW
    out = out.withColumn("_g", F.when(~small & (k > -1), N.gamma(1 + k)))
    out = out.withColumn("scale", F.when(small, F.col("l2") / math.log(2)).otherwise(
        F.col("l2") * k / ((1 - F.pow(F.lit(2.0), -k)) * F.col("_g"))))
    return out.withColumns({
        "location": F.when(small, F.col("l1") - EULER * F.col("scale")).otherwise(
            F.col("l1") - F.col("scale") * (1 - F.col("_g")) / k),
        "shape": F.when(small, F.lit(0.0)).otherwise(k),
    }).drop("_k", "_g")


def _pe3(lm: DataFrame) -> DataFrame:
    """Pearson III parameters (mean, standard deviation, skewness) from L-moments."""
    t3 = F.when((F.col("t3") > -1) & (F.col("t3") < 1), F.col("t3"))
    size = F.abs(t3)
    z1, z2 = 3 * math.pi * t3 * t3, 1 - size
    low = (1 + 0.2906 * z1) / (z1 + 0.1882 * z1 * z1 + 0.0442 * z1 * z1 * z1)
    high = N.horner((0.25361, -0.59567, 0.36067, 0.0), z2) / N.horner((-0.77045, 2.56096, -2.78861, 1.0), z2)
    normal = size <= 1e-6
    out = lm.withColumn("_a", F.when(~normal, F.when(size < 1 / 3, low).otherwise(high)))
    a = F.col("_a")
    ratio = F.exp(N.ln_gamma(a) - N.ln_gamma(a + 0.5))
    root = math.sqrt(math.pi) * F.col("l2")
    return out.withColumns({
        "location": F.when(t3.isNotNull(), F.col("l1")),
        "scale": F.when(normal, root).otherwise(root * F.sqrt(a) * ratio),
        "shape": F.when(normal, F.lit(0.0)).otherwise(2 / F.sqrt(a) * F.signum(t3)),
    }).drop("_a")


def fit(df: DataFrame, keys: list[str], value: str, distribution: str = "gev", nmin_defined: int = 10, nmin_unique: int = 10,
        bounded: bool = False) -> DataFrame:
    """One fit per key: location, scale, shape, n_defined, n_unique.

    Too few defined values give no parameters, too few different ones only the median as location;
    a zero scale or moments no distribution has give no parameters. ``nonparametric`` keeps the
    sorted observations instead, as rows.
    """
    if distribution == "nonparametric":
        return sorted_values(df, keys, value, bounded)
    method = {"gev": _gev, "pe3": _pe3}.get(distribution)
    if method is None:
        raise ValueError(f"unknown distribution: {distribution}")
    lm = _moments(df, keys, value, bounded, [ordered.quantile_column(value, 0.5).alias("_median")])
    out = method(lm)
    enough, varied = F.col("n_defined") >= nmin_defined, F.col("n_unique") >= nmin_unique
    good = enough & varied & (F.col("scale") != 0)
    return out.select(
        *keys, F.lit(distribution).alias("distribution"),
        F.when(enough & ~varied, F.col("_median")).when(good, F.col("location")).alias("location"),
        F.when(good, F.col("scale")).alias("scale"), F.when(good, F.col("shape")).alias("shape"),
        "n_defined", "n_unique",
    )


def to_long(df: DataFrame, keys: list[str], variables: list[str]) -> DataFrame:
    """(keys, variable, value) rows, so one pass serves all variables."""
    return df.unpivot(keys, variables, "variable", "value")


def fit_by_month(df: DataFrame, keys: list[str], variables: list[str], years: tuple[int, int], distribution: str = "gev",
                 bounded: bool = False, **guards) -> DataFrame:
    """A fit per key, variable and calendar month over the years of the reference period.

    ``df`` has ``yearmon``; windows and statistics come in as keys or variable names.
    """
    year = F.floor(F.col("yearmon") / 100)
    base = df.where(year.between(*years)).withColumn("month", (F.col("yearmon") % 100).cast("int"))
    return fit(to_long(base, [*keys, "month"], variables), [*keys, "variable", "month"], "value", distribution, bounded=bounded, **guards)


def fit_hindcasts(df: DataFrame, keys: list[str], value: str, divisor: float = 1.0, bounded: bool = False, **guards) -> DataFrame:
    """A fit per key, target month and lead, all start years and members pooled; ``df`` comes from a hindcast scan."""
    scaled = df.select(*keys, "target_month", "lead", (F.col(value) / divisor).alias(value))
    return fit(scaled, [*keys, "target_month", "lead"], value, bounded=bounded, **guards)


def climate_norm_parametric(df: DataFrame, keys: list[str], value: str, bounded: bool = False, **guards) -> DataFrame:
    """Median of the distribution fitted per key: the value at an anomaly of zero."""
    from .anomaly import value_at

    return value_at(fit(df, keys, value, bounded=bounded, **guards), sa=0.0, median_when_undefined=True, output=value)

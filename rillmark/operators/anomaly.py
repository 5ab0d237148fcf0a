"""Observations and forecasts expressed through fitted distributions."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N
from .integrate import ranks

PARAMETERS = ("location", "scale", "shape")


def _parameters(prefix: str = "") -> list[Column]:
    return [F.col(prefix + p) for p in PARAMETERS]


def value_at(fits: DataFrame, rp: float | None = None, sa: float | None = None, median_when_undefined: bool = False,
             output: str = "value") -> DataFrame:
    """The extreme-value quantile at a return period or anomaly, for every row of ``fits``; fits of other distributions are an error."""
    if (rp is None) == (sa is None):
        raise ValueError("give either a return period or an anomaly")
    p = NormalDist().cdf(sa) if sa is not None else ((1 - 1 / rp) if rp > 0 else -1 / rp)
    if rp is not None and abs(rp) < 1:
        raise ValueError("return periods are at least 1")
    checked = fits.withColumns(dict(zip(PARAMETERS, _of_distribution(fits, "gev"))))
    q = N.qua_gev(F.lit(p), *_parameters())
    if median_when_undefined and p == 0.5:
        q = F.when(F.col("scale").isNull(), F.col("location")).otherwise(q)
    return checked.withColumn(output, q).drop("distribution", *PARAMETERS, "n_defined", "n_unique")


def _of_distribution(fits: DataFrame, distribution: str | None) -> list[Column]:
    """The parameters of fits; one fitted to another distribution than named is an error."""
    if distribution is None or "distribution" not in fits.columns:
        return _parameters()
    other = F.concat(F.lit("a fit of distribution "), F.col("distribution"), F.lit(f" is used as {distribution}"))
    return [F.when(F.col("distribution") != distribution, F.raise_error(other).cast("double")).otherwise(F.col(p)) for p in PARAMETERS]


def with_fits(obs: DataFrame, fits: DataFrame, on: list[str], prefix: str = "", distribution: str | None = None) -> DataFrame:
    """Attach parameters to observations; unmatched observations keep NULL parameters.

    Fits that carry another distribution than the named one are an error.
    """
    params = fits.select(*on, *[c.alias(prefix + p) for p, c in zip(PARAMETERS, _of_distribution(fits, distribution))])
    return obs.join(params, on, "left")


def standard_anomaly(obs: DataFrame, fits: DataFrame, on: list[str], value: str, distribution: str | None = "gev",
                     output: str | None = None) -> DataFrame:
    """Add the anomaly of ``value`` (default name ``<value>_sa``) under the fit with the same ``on`` columns.

    With ``distribution`` None every fit is used by the distribution it carries, gev or pe3; with a name, fits of others are an error.
    """
    if distribution is None:
        out = obs.join(fits.select(*on, "distribution", *PARAMETERS), on, "left").withColumnRenamed("distribution", "_of")
        for d in ("gev", "pe3"):
            out = N.with_cdf(out, d, value, list(PARAMETERS), f"_p_{d}")
        unknown = F.raise_error(F.concat(F.lit("unknown distribution: "), F.col("_of"))).cast("double")
        p = F.when(F.col("_of").isNull(), None).when(F.col("_of") == "gev", F.col("_p_gev")).when(F.col("_of") == "pe3", F.col("_p_pe3")).otherwise(unknown)
        out = out.withColumn("_p", p).drop("_of", "_p_gev", "_p_pe3")
    else:
        out = N.with_cdf(with_fits(obs, fits, on, distribution=distribution), distribution, value, list(PARAMETERS), "_p")
    return N.with_anomaly(out, "_p", output or f"{value}_sa").drop("_p", *PARAMETERS)


def return_period(obs: DataFrame, fits: DataFrame, on: list[str], value: str, distribution: str | None = "gev") -> DataFrame:
    """Add ``<value>_sa`` and ``<value>_rp``."""
    return N.with_return_period(standard_anomaly(obs, fits, on, value, distribution), f"{value}_sa", f"{value}_rp")


def plotting_position(rank: Column, n: Column) -> Column:
    """Tukey's position."""
    return (rank - 1 / 3) / (n + 4 / 3)


def nonparametric_anomaly(obs: DataFrame, history: DataFrame, on: list[str], value: str, observed: str,
                          bounded: bool = False) -> DataFrame:
    """Anomaly from the rank among past observations; ties take the position nearest the middle."""
    ranked = ranks(obs, history, on, value, observed, bounded)
    n = F.coalesce("n_obs", F.lit(0))
    low, high = plotting_position(F.col("min_rank"), n), plotting_position(F.col("max_rank"), n)
    p = (F.when((low < 0.5) & (high > 0.5), 0.5)
         .when(F.abs(0.5 - low) < F.abs(0.5 - high), low).otherwise(high))
    return N.with_anomaly(ranked.withColumn("_p", p), "_p", f"{value}_sa").drop("_p", "min_rank", "max_rank", "n_obs")


def bias_correct(forecast: DataFrame, retro_fits: DataFrame, obs_fits: DataFrame, on: list[str], value: str,
                 distribution: str = "gev", output: str | None = None) -> DataFrame:
    """Map a forecast through its own past distribution to that of the observations; both are of the named kind, or it is an error."""
    out = with_fits(with_fits(forecast, retro_fits, on, "_retro_", distribution), obs_fits, on, "_obs_", distribution)
    retro, observed = ([pre + p for p in PARAMETERS] for pre in ("_retro_", "_obs_"))
    out = N.with_cdf(out, distribution, value, retro, "_p")
    least = 1 / N.EXTREME_CUTOFF
    p = F.coalesce("_p", F.lit(0.5))
    out = out.withColumn("_p", F.when(F.col(value).isNotNull(), F.greatest(F.least(p, F.lit(1 - least)), F.lit(least))))
    out = N.with_quantile(out, distribution, "_p", observed, "_q")
    corrected = (F.when(F.col(value).isNull(), None)
                 .when(F.col("_obs_scale").isNull() | F.col("_obs_shape").isNull(), F.col("_obs_location"))
                 .otherwise(F.col("_q")))
    return out.withColumn(output or value, corrected).drop("_p", "_q", *retro, *observed)


def raw_to_quantile(forecast: DataFrame, retro_fits: DataFrame, on: list[str], value: str, output: str) -> DataFrame:
    """First half of the correction without bounds; 0.5 where the past distribution is not fully known."""
    out = with_fits(forecast, retro_fits, on, distribution="gev")
    known = F.col("location").isNotNull() & F.col("scale").isNotNull() & F.col("shape").isNotNull()
    return out.withColumn(output, F.when(known, N.cdf_gev(F.col(value), *_parameters())).otherwise(F.lit(0.5))).drop(*PARAMETERS)


def quantile_to_corrected(df: DataFrame, obs_fits: DataFrame, on: list[str], quantile: str, output: str) -> DataFrame:
    """Second half; missing where the distribution of the observations is not fully known."""
    out = with_fits(df, obs_fits, on, distribution="gev")
    p = F.col(quantile)
    value = (F.when(p <= 0, F.when(F.col("shape") < 0, F.col("location") + F.col("scale") / F.col("shape")).otherwise(F.lit(float("-inf"))))
             .when(p >= 1, F.when(F.col("shape") > 0, F.col("location") + F.col("scale") / F.col("shape")).otherwise(F.lit(float("inf"))))
             .otherwise(N.qua_gev(p, *_parameters())))
    known = p.isNotNull() & F.col("location").isNotNull() & F.col("scale").isNotNull() & F.col("shape").isNotNull()
    return out.withColumn(output, F.when(known, value)).drop(*PARAMETERS)

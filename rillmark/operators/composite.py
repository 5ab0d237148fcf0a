"""Composite surplus and deficit indices: row-wise, so no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.transforms import VarSpec, clamp, select_vars
from ..functions.numeric import with_return_period
from .anomaly import standard_anomaly

# fixed values: thresholds for "both", and the bound of return periods
RP_THRESHOLD = 3.0
RP_CLAMP = 60.0
SA_THRESHOLD = 0.4307273


def _extreme(columns: list[str], largest: bool) -> tuple[Column, Column]:
    """(value, 1-based position of the first column holding it); missing columns are skipped."""
    cols = [F.col(c) for c in columns]
    value = cols[0] if len(cols) == 1 else (F.greatest if largest else F.least)(*cols)
    cause = F.when(value.isNull(), None)
    for i, c in enumerate(cols, start=1):
        cause = cause.when(c == value, F.lit(i))
    return value, cause


def _masked(c: Column, mask: str | None) -> Column:
    return c if mask is None else F.when(F.col(mask).isNotNull(), c)


def _composite(df: DataFrame, name: str, columns: list[str], largest: bool, bound: float | None, mask: str | None) -> DataFrame:
    value, cause = _extreme(columns, largest)
    value = value if bound is None else clamp(value, -bound, bound)
    number = F.col(f"{name}_cause")
    names = F.when(number.isNotNull(), F.element_at(F.array(*[F.lit(c) for c in columns]), number))
    return df.withColumns({name: _masked(value, mask), f"{name}_cause": _masked(cause, mask)}).withColumn(f"{name}_cause_name", names)


def composite_surplus(df: DataFrame, columns: list[str], bound: float | None = None, mask: str | None = None) -> DataFrame:
    """Largest of the surplus indicators, with its cause by number and name."""
    return _composite(df, "surplus", columns, True, bound, mask)


def composite_deficit(df: DataFrame, columns: list[str], bound: float | None = None, mask: str | None = None) -> DataFrame:
    """Smallest of the deficit indicators, with its cause by number and name."""
    return _composite(df, "deficit", columns, False, bound, mask)


def composite_both(df: DataFrame, threshold: float) -> DataFrame:
    """The larger of surplus and −deficit where both pass the threshold, else 0; missing if either is."""
    s, d = F.col("surplus"), F.col("deficit")
    return df.withColumn("both", F.when(s.isNull() | d.isNull(), None)
                         .when((s > threshold) & (d < -threshold), F.greatest(s, -d)).otherwise(F.lit(0.0)))


def composite(df: DataFrame, surplus: list[str], deficit: list[str], threshold: float, bound: float | None = None,
              mask: str | None = None) -> DataFrame:
    return composite_both(composite_deficit(composite_surplus(df, surplus, bound, mask), deficit, bound, mask), threshold)


def copy_causes(df: DataFrame, causes: DataFrame, keys: list[str]) -> DataFrame:
    """Causes of another composite instead of the own ones."""
    names = ["surplus_cause", "deficit_cause", "surplus_cause_name", "deficit_cause_name"]
    kept = df.drop(*names)
    return kept.join(causes.select(*keys, *[n for n in names if n in causes.columns]), keys, "left")


def composite_spec(method: str, window: int, quantile: int | None = None) -> tuple[list[VarSpec], list[VarSpec]]:
    """(surplus, deficit) variables of the standard composite."""
    unit = {"return_period": "rp", "standard_anomaly": "sa"}[method]
    tail = f"_{unit}" + (f"_q{quantile}" if quantile else "")
    total, mean = ("_sum", "_ave") if window > 1 else ("", "")
    deficit = [VarSpec(f"PETmE{total}{tail}", ("fill0", "negate"), "Neg_PETmE"), VarSpec(f"Ws{mean}{tail}", (), "Ws"),
               VarSpec(f"Bt_RO{total}{tail}", (), "Bt_RO")]
    surplus = [VarSpec(f"RO_mm{total}{tail}", (), "RO_mm"), VarSpec(f"Bt_RO{total}{tail}", (), "Bt_RO")]
    return surplus, deficit


def standard_composite(df: DataFrame, keys: list[str], method: str, window: int, quantile: int | None = None,
                       mask: str | None = None) -> DataFrame:
    """The composite of the standard variables with the standard threshold and bound."""
    surplus, deficit = composite_spec(method, window, quantile)
    specs = list({s.output: s for s in [*surplus, *deficit]}.values())
    chosen = select_vars(df, keys + ([mask] if mask else []), specs)
    by_rp = method == "return_period"
    out = composite(chosen, [s.output for s in surplus], [s.output for s in deficit],
                    RP_THRESHOLD if by_rp else SA_THRESHOLD, RP_CLAMP if by_rp else None, mask)
    return out.drop(*[s.output for s in specs])


def adjusted_composite(sa_composite: DataFrame, fits: DataFrame, rp_composite: DataFrame, keys: list[str], fit_keys: list[str]) -> DataFrame:
    """Return periods of composite anomalies under their own distributions, with the causes of the plain composite.

    ``fits`` has ``fit_keys``, ``indicator`` (surplus or deficit) and parameters.
    """
    out = sa_composite.select(*keys, "surplus", "deficit")
    for name in ("surplus", "deficit"):
        of_name = fits.where(F.col("indicator") == name).drop("indicator")
        out = standard_anomaly(out, of_name, fit_keys, name, output=f"_{name}_sa")
        out = with_return_period(out, f"_{name}_sa", f"_{name}_rp")
    out = out.select(*keys, F.col("_surplus_rp").alias("surplus"), F.col("_deficit_rp").alias("deficit"))
    out = composite(out, ["surplus"], ["deficit"], RP_THRESHOLD, RP_CLAMP)
    return copy_causes(out, rp_composite, keys)

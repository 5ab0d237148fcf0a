"""Power plants and the water they depend on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import power as P
from ..functions.calendar import days_in_yearmon
from ..functions.transforms import assign_to_bin
from .integrate import ensemble_summary
from .joins import attach_zone
from .network import accumulate
from .quality import require_empty
from .spatial import zonal_stats

MINIMUM_WINDOW = 12
LOSS_VARIABLES = ["gross_loss_mwh", "hydro_loss_mwh", "gross_loss_pct", "hydro_loss_pct"]


def upstream_capacity(basins: DataFrame, dams: DataFrame) -> DataFrame:
    """Storage per basin and in everything upstream of it.

    ``dams`` may list a dam in several basins (on a border); the lowest basin id counts.
    """
    placed = dams.groupBy("dam_id").agg(F.min("basin_id").alias("basin_id"), F.min_by("capacity", "basin_id").alias("capacity"))
    own = placed.groupBy("basin_id").agg(F.sum("capacity").alias("capacity"))
    local = basins.join(own, "basin_id", "left").select(
        F.col("basin_id").alias("id"), "downstream_id", F.coalesce("capacity", F.lit(0.0)).alias("capacity"))
    total = accumulate(local, "capacity", "total")
    return local.join(total, "id").select(F.col("id").alias("basin_id"), "capacity", (F.col("total") - F.col("capacity")).alias("capacity_upstream"))


def dams_for_sector(dams: DataFrame, sector: str) -> DataFrame:
    """Dams that matter for a sector; uses are ``use_elec``, ``use_irri``, ``use_supp``, ``use_fcon``, NULL when not served."""
    if sector == "electric_power":
        other = F.col("use_irri").isNull() & F.col("use_supp").isNull() & F.col("use_fcon").isNull()
        return dams.where(F.col("use_elec").isNotNull() | other)
    if sector == "agriculture":
        return dams.where(F.col("use_irri").isNotNull())
    raise ValueError(f"unknown sector: {sector}")


def integration_period(capacity: Column, monthly_flow: Column, periods: list[int]) -> Column:
    """Longest period not above the months of storage; the first where storage or flow is unknown or the flow is zero."""
    months = F.when(capacity.isNotNull() & (monthly_flow != 0), capacity / monthly_flow)
    return F.when(months.isNull(), F.lit(periods[0])).otherwise(assign_to_bin(months, periods))


def require_windows(windows: DataFrame, available: DataFrame, what: str) -> None:
    gone = windows.select("window").distinct().join(available.select("window").distinct(), "window", "left_anti")
    require_empty(gone, f"no {what} for windows")


def basin_loss_factors(storage: DataFrame, flow: DataFrame, fits: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Hydropower loss per basin at the window its storage asks for (at least a year).

    ``storage`` has (id, months_storage), ``flow`` (id, window, flow), ``fits`` (id, window,
    location, scale, shape). The median is the fitted one, or the location where the fit is partial.
    Flows of many months or members have the columns ``by`` too, and so has the result, in one job; a
    basin without flow has one row, without them.
    """
    wanted = storage.select("id", F.greatest("months_storage", F.lit(MINIMUM_WINDOW)).alias("window"))
    require_windows(wanted, flow, "flow")
    require_windows(wanted, fits, "fits")
    params = ["location", "scale", "shape"]
    out = wanted.join(flow, ["id", "window"], "left").join(fits.select("id", "window", *params), ["id", "window"], "left")
    partial = F.col("location").isNull() | F.col("scale").isNull() | F.col("shape").isNull()
    median = F.when(partial, F.col("location")).otherwise(N.qua_gev(F.lit(0.5), *[F.col(c) for c in params]))
    out = out.withColumn("_median", median)
    return out.select("id", "window", *(by or []), P.hydropower_loss(F.col("flow"), F.col("_median")).alias("hydropower_loss"))


def hours_in_month(yearmon: Column) -> Column:
    return days_in_yearmon(yearmon) * 24


def summarize_losses(plants: DataFrame, losses: DataFrame, by: str, hours: int | Column, keys: list[str] | None = None) -> DataFrame:
    """Capacity, generation and losses per basin, province or country; only hydropower plants lose here.

    ``keys`` are further columns of ``losses`` (members, months) to keep apart. Sums combine map-side,
    so one country with a third of all plants is no hot spot.
    """
    hours = hours if isinstance(hours, Column) else F.lit(hours)
    keys = keys or []
    joined = plants.join(losses.withColumnRenamed("id", "basin_id"), "basin_id").where(F.col(by).isNotNull())
    hydro = F.col("fuel") == "Hydro"
    lost = F.when(hydro, F.col("generation_mw") * F.col("hydropower_loss")).otherwise(0.0)

    def whole(x: Column) -> Column:
        # a missing term makes the sum missing rather than too small
        return F.when(F.bool_and(x.isNotNull()), F.sum(x))

    sums = joined.groupBy(by, *keys).agg(
        whole(F.col("capacity_mw")).alias("capacity_tot_mw"), whole(F.col("generation_mw")).alias("_gen"),
        whole(lost).alias("_lost"), whole(F.when(hydro, F.col("generation_mw")).otherwise(0.0)).alias("_hydro"))
    return sums.select(
        by, *keys, "capacity_tot_mw", (F.col("_gen") * hours).alias("generation_tot_mwh"),
        (F.col("_lost") * hours).alias("gross_loss_mwh"), (F.col("_lost") * hours).alias("hydro_loss_mwh"),
        F.try_divide("_lost", "_gen").alias("gross_loss_pct"), F.try_divide("_lost", "_hydro").alias("hydro_loss_pct"))


def classify_cooling(plants: DataFrame, near_coast: DataFrame, factors: DataFrame, once_through: DataFrame) -> DataFrame:
    """Cooling flags and generation of every plant that is not a storage.

    ``near_coast`` has (plant_id, near), ``factors`` (plant_id, capacity_factor), ``once_through`` (plant_id).
    """
    listed = once_through.select("plant_id").distinct().withColumn("_once", F.lit(True))
    out = (plants.where(F.col("fuel") != "Storage").join(near_coast, "plant_id").join(factors, "plant_id")
           .join(listed, "plant_id", "left"))
    wet = F.col("fuel").isin(P.WATER_COOLED_FUELS)
    kept = [c for c in plants.columns if c not in ("generation_mw",)]
    return out.select(
        *kept, (F.col("capacity_factor") * F.col("capacity_mw")).alias("generation_mw"), wet.alias("water_cooled"),
        F.coalesce("_once", F.lit(False)).alias("once_through"), (wet & F.col("near")).alias("seawater_cooled"))


def loss_ensemble_summary(losses: DataFrame, keys: list[str], bounded: bool = False) -> DataFrame:
    """Quartiles of the member losses."""
    return ensemble_summary(losses, keys, LOSS_VARIABLES, bounded=bounded)


def basin_water_stress(stress: DataFrame, coverage: DataFrame, column: str = "stress") -> DataFrame:
    return zonal_stats(stress, coverage, [column], stats=("mean",)).select("zone_id", F.col(f"{column}_mean").alias(column))


def append_boundaries(plants: DataFrame, zone_sets: dict[str, DataFrame]) -> DataFrame:
    """One id per named zone set (country, province, basin) for every plant; NULL outside."""
    out = plants
    for name, coverage in zone_sets.items():
        out = attach_zone(out, coverage.withColumnRenamed("zone_id", name), zone=name)
    return out

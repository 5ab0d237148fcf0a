"""Losses of power plants as Column functions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .transforms import clamp, linear_interpolation

# fixed values: hydropower loss curve, water stress and onset of loss, temperature conversion, fuels
HYDRO_INTERCEPT, HYDRO_SLOPE = 1.013446, 0.281561
STRESS_BINS = [0.0, 0.1, 0.2, 0.4, 0.8, 1.0]
STRESS_ONSET = [30.0, 25.0, 20.0, 15.0, 10.0, 10.0]
WATER_BASE, WATER_SLOPE = 2.5, 0.76
COLD_LOSS_PER_DEGREE = 1 / 30
EFFICIENCY_LOSS_PER_DEGREE = 0.005
RENEWABLE_FUELS = ["Hydro", "Wind", "Solar", "Geothermal", "Wave and Tidal"]
WATER_COOLED_FUELS = ["Coal", "Nuclear", "Waste", "Biomass", "Cogeneration", "Petcoke"]


def hydropower_loss(flow: Column, median: Column) -> Column:
    """Share of generation lost at a flow below its median; none where the median is not positive."""
    share = (F.when(flow > 0, clamp(HYDRO_INTERCEPT + HYDRO_SLOPE * F.ln(flow / median), 0.0, 1.0))
             .when(flow == 0, 0.0))
    return F.when(flow.isNull(), None).when(median > 0, 1 - share).when(median <= 0, 0.0)


def water_cooled_loss(x: Column, onset: Column | float, total: Column | float) -> Column:
    """Exponential loss between the return periods of onset and of total loss."""
    onset, total = (v if isinstance(v, Column) else F.lit(v) for v in (onset, total))
    growth = F.exp(F.lit(math.log(101)) / (total - onset) * (x - onset))
    return 0.01 * clamp(growth - 1, 0.0, 100.0)


def loss_onset(stress: Column) -> Column:
    """Return period at which losses begin, earlier where baseline water stress is high."""
    curve = linear_interpolation(stress, STRESS_BINS, STRESS_ONSET, right=min(STRESS_ONSET))
    return F.when(stress.isNull(), F.lit(max(STRESS_ONSET))).otherwise(curve)


def water_to_air(t: Column) -> Column:
    return (t - WATER_BASE) / WATER_SLOPE


def air_to_water(t: Column) -> Column:
    return WATER_BASE + t * WATER_SLOPE


def _share(c: Column) -> Column:
    return F.coalesce(clamp(c, 0.0, 1.0), F.lit(0.0))


def cold_loss(air: Column, air_rp: Column, limit: Column, limit_rp: Column) -> Column:
    return F.coalesce(F.when((air <= limit) & (air_rp < limit_rp), _share((limit - air) * COLD_LOSS_PER_DEGREE)), F.lit(0.0))


def effluent_loss(basin_air: Column, regulated: Column, rise: Column) -> Column:
    """Scaling back so that warmed cooling water keeps to a regulated temperature."""
    room = regulated - rise
    return F.coalesce(F.when(basin_air >= water_to_air(room), _share((air_to_water(basin_air) - room) / rise)), F.lit(0.0))


def efficiency_loss(air: Column, limit: Column, per_degree: float = EFFICIENCY_LOSS_PER_DEGREE) -> Column:
    return _share(per_degree * (air - limit))


def temperature_loss(air: Column, air_rp: Column, basin_air: Column, cold_limit: Column, cold_limit_rp: Column, efficient_limit: Column,
                     regulated: Column, rise: Column, per_degree: float = EFFICIENCY_LOSS_PER_DEGREE) -> Column:
    """Largest of the cold, effluent and efficiency losses; parts that cannot be computed count as none."""
    return F.greatest(cold_loss(air, air_rp, cold_limit, cold_limit_rp), efficiency_loss(air, efficient_limit, per_degree),
                      effluent_loss(basin_air, regulated, rise))


def reserve_capacity(fuel: Column, water_cooled: Column, seawater_cooled: Column, capacity: Column, generation: Column) -> Column:
    """Unused capacity of plants which do not depend on weather or fresh water."""
    return F.when(fuel.isin(RENEWABLE_FUELS) | (water_cooled & ~seawater_cooled), 0.0).otherwise(capacity - generation)

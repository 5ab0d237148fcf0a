"""Crop calendars and losses as Column functions.

Days count from 1 to 365; a season whose harvest is not after its planting runs over the year's end.
A season counts for the year of its harvest.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .transforms import linear_interpolation

YEAR = 365


def _known(plant: Column, harvest: Column) -> Column:
    return plant.isNotNull() & harvest.isNotNull()


def is_growing_season(day: Column, plant: Column, harvest: Column) -> Column:
    """Whether a day (or month) lies in the season."""
    inside = F.when(harvest > plant, (day >= plant) & (day <= harvest)).otherwise((day >= plant) | (day <= harvest))
    return F.when(_known(plant, harvest), inside)


def days_since_planting(day: Column, plant: Column, harvest: Column) -> Column:
    """Days since the season began, missing outside it."""
    return F.when(is_growing_season(day, plant, harvest), F.pmod(day - plant, F.lit(YEAR)))


def days_until_harvest(day: Column, plant: Column, harvest: Column) -> Column:
    """Days until the season ends, missing outside it."""
    return F.when(is_growing_season(day, plant, harvest), F.pmod(harvest - day, F.lit(YEAR)))


def first_growing_day(start: Column, stop: Column, plant: Column, harvest: Column) -> Column:
    """First day of the season at or after ``start``; for seasons over the year's end the interval may run over it too.

    A plain interval is start…stop. For a season over the year's end the days start…365 are looked
    at before 1…stop.
    """
    within = F.greatest(start, plant)
    plain = F.when(within <= F.least(stop, harvest), within)
    # from the start on: the season's tail if the start is in it, else its beginning
    late = F.when(start <= harvest, start).otherwise(F.greatest(start, plant))
    always = F.when(start <= stop, start)
    return F.when(_known(plant, harvest), F.when(plant == harvest, always).when(plant < harvest, plain).otherwise(late))


def last_growing_day(start: Column, stop: Column, plant: Column, harvest: Column) -> Column:
    """Last day of the season at or before ``stop``, with the same reading of intervals."""
    within = F.least(stop, harvest)
    plain = F.when(within >= F.greatest(start, plant), within)
    late = F.when(stop >= plant, stop).otherwise(F.least(stop, harvest))
    always = F.when(start <= stop, stop)
    return F.when(_known(plant, harvest), F.when(plant == harvest, always).when(plant < harvest, plain).otherwise(late))


def growing_days_this_season(start: Column, stop: Column, plant: Column, harvest: Column) -> Column:
    """Growing days within start…stop of the season ``stop`` belongs to; none when it lies outside."""
    begin = F.when((plant > start) & (plant <= stop), plant).otherwise(start)
    end = F.when((harvest >= begin) & (harvest <= stop), harvest).otherwise(stop)
    days = F.when(is_growing_season(end, plant, harvest), end - begin + 1).otherwise(0)
    return F.when(_known(plant, harvest), days)


def growing_days_this_year(start: Column, stop: Column, plant: Column, harvest: Column) -> Column:
    """Growing days within start…stop which count for this year's harvest."""
    begin = F.when((harvest > plant) & (start < plant), plant).otherwise(start)
    return F.when(_known(plant, harvest), F.greatest(F.lit(0), F.least(stop, harvest) - begin + 1))


def growing_days_next_year(start: Column, stop: Column, plant: Column, harvest: Column) -> Column:
    """Growing days within start…stop which count for next year's harvest."""
    days = F.when(harvest > plant, 0).otherwise(F.greatest(F.lit(0), stop - F.greatest(start, plant) + 1))
    return F.when(_known(plant, harvest), days)


def days_since_planting_this_year(start: Column, stop: Column, plant: Column, harvest: Column) -> Column:
    """Days of growth of this year's harvest up to the end of the interval."""
    end = F.least(stop, harvest)
    days = F.when(start > harvest, 0).when(harvest > plant, F.greatest(F.lit(0), end - plant + 1)).otherwise(YEAR - plant + 1 + end)
    return F.when(_known(plant, harvest), days)


def days_since_planting_next_year(start: Column, stop: Column, plant: Column, harvest: Column) -> Column:
    days = F.when(harvest > plant, 0).otherwise(F.greatest(F.lit(0), stop - plant + 1))
    return F.when(_known(plant, harvest), days)


def days_since_planting_this_season(start: Column, stop: Column, plant: Column, harvest: Column) -> Column:
    """Days of growth of the current season at the end of the interval, 0 when it lies outside."""
    plain = F.when((stop < plant) | (start > harvest), 0).otherwise(F.least(stop, harvest) - plant + 1)
    over = (F.when((start > harvest) & (stop < plant), 0).when(stop > plant, stop - plant + 1)
            .otherwise(YEAR - plant + 1 + F.least(stop, harvest)))
    return F.when(_known(plant, harvest), F.when(plant < harvest, plain).otherwise(over))


def planted_for_this_year(start: Column, stop: Column, plant: Column, harvest: Column) -> Column:
    return (plant < harvest) & (plant >= start) & (plant <= stop)


def planted_for_next_year(start: Column, stop: Column, plant: Column, harvest: Column) -> Column:
    return (plant > harvest) & (plant >= start) & (plant <= stop)


def growing_season_length(plant: Column, harvest: Column) -> Column:
    return F.when(harvest > plant, harvest - plant + 1).otherwise(harvest + YEAR - plant + 1)


# fixed values: an earlier loss curve
OLD_ONSET, OLD_TOTAL, OLD_POWER = 6.0, 70.0, 1.4


def loss_function(rp: Column, onset: Column | float, total: Column | float, power: Column | float) -> Column:
    """Loss rising from 0 at the onset to 1 at the return period of total loss."""
    onset, total, power = (v if isinstance(v, Column) else F.lit(float(v)) for v in (onset, total, power))
    return F.when(rp.isNull(), None).when(rp >= total, 1.0).when(rp <= onset, 0.0).otherwise(F.pow((rp - onset) / (total - onset), power))


def loss_function_old(rp: Column) -> Column:
    return (F.when(rp.isNull(), None).when(rp >= OLD_TOTAL, 1.0).when(rp <= OLD_ONSET, 0.0)
            .otherwise(1 - F.pow((OLD_TOTAL - rp) / (OLD_TOTAL - OLD_ONSET), F.lit(OLD_POWER))))


def combine_losses(losses: list[Column], method: str) -> Column:
    """Largest loss or sum of losses, at most 1."""
    if method == "max":
        out = losses[0] if len(losses) == 1 else F.greatest(*losses)
    elif method == "sum":
        out = sum(losses[1:], losses[0])
    else:
        raise ValueError(f"unknown loss method: {method}")
    return F.least(out, F.lit(1.0))


def initial_fraction(length: Column, a: float, b: float) -> Column:
    """Head start of a crop so that mean losses over its history come out at zero."""
    return 1 / (1 - length * F.lit(a) - length * length * F.lit(b))


def duration_multiplier(months: Column) -> Column:
    return 1.0 + 0.1 * (months - 1)


def growth_stage_multiplier(day: Column, plant: Column, harvest: Column, early: list[tuple[float, float]], late: list[tuple[float, float]]) -> Column:
    """Larger of the factors for days since planting and days until harvest; 1 beyond the tables, missing off season."""
    def curve(days: Column, table: list[tuple[float, float]]) -> Column:
        if not table:
            return F.lit(1.0)
        xs, ys = zip(*table)
        return linear_interpolation(days, list(xs), list(ys), left=1.0, right=1.0)

    a, b = curve(days_since_planting(day, plant, harvest), early), curve(days_until_harvest(day, plant, harvest), late)
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))

"""Month and day arithmetic on YYYYMM integers; crop functions use a 365-day year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: first and last day of each month in a 365-day year
MONTH_STARTS = (1, 32, 60, 91, 121, 152, 182, 213, 244, 274, 305, 335)
MONTH_ENDS = (31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334, 365)
# fixed value: what counts as a month of the 20th or 21st century in a file name
YEARMON_PATTERN = r"(?:19|20)\d{2}(?:0[1-9]|1[0-2])"


def whole(c: Column, n: int) -> Column:
    """Integer division rounding down."""
    return F.floor(c / F.lit(n)).cast("int")


def month_index(yearmon: Column) -> Column:
    return (whole(yearmon, 100) * 12 + yearmon % 100 - 1).cast("int")


def from_month_index(index: Column) -> Column:
    return (whole(index, 12) * 100 + F.pmod(index, F.lit(12)) + 1).cast("int")


def add_months(yearmon: Column, n: Column | int) -> Column:
    return from_month_index(month_index(yearmon) + n)


def next_yearmon(yearmon: Column) -> Column:
    return add_months(yearmon, 1)


def prev_yearmon(yearmon: Column) -> Column:
    return add_months(yearmon, -1)


def add_years(year: Column, n: Column | int) -> Column:
    return year + n


def to_day(yyyymmdd: Column) -> Column:
    return F.make_date(whole(yyyymmdd, 10000), whole(yyyymmdd, 100) % 100, yyyymmdd % 100)


def add_days(yyyymmdd: Column, n: Column | int) -> Column:
    d = F.date_add(to_day(yyyymmdd), n)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.day(d)).cast("int")


def days_in_yearmon(yearmon: Column, leap: bool = True) -> Column:
    """Days of the month; without leap years February always has 28."""
    year = whole(yearmon, 100) if leap else F.lit(2001)
    return F.day(F.last_day(F.make_date(year, yearmon % 100, F.lit(1))))


def start_of_month(month: Column) -> Column:
    return F.when(month.isNotNull(), F.element_at(F.array(*[F.lit(d) for d in MONTH_STARTS]), month))


def end_of_month(month: Column) -> Column:
    return F.when(month.isNotNull(), F.element_at(F.array(*[F.lit(d) for d in MONTH_ENDS]), month))


def doy_to_month(doy: Column) -> Column:
    return F.month(F.date_add(F.lit("2001-01-01").cast("date"), (doy - 1).cast("int")))


def months_since_1960(yearmon: Column) -> Column:
    return month_index(yearmon) - 1960 * 12


def yearmon_from_months_since_1960(n: Column) -> Column:
    """Inverse of :func:`months_since_1960`; fractions count as the month they fall in."""
    return from_month_index(F.floor(n).cast("int") + 1960 * 12)


def lead_months(issue: Column, target: Column, offset: float = 0.0) -> Column:
    """Months from issue to target; forecast archives which label mid-months use offset 0.5."""
    lead = month_index(target) - month_index(issue)
    return lead + F.lit(offset) if offset else lead


def issue_to_reference(yearmon: Column) -> Column:
    """A forecast issued at the end of a month refers to the next one."""
    return next_yearmon(yearmon)


def raw_lead(lead: Column) -> Column:
    return lead - 1


def rolling_months(yearmon: Column, n: int) -> Column:
    """Array of the n months ending with ``yearmon``."""
    return F.transform(F.sequence(month_index(yearmon) - (n - 1), month_index(yearmon)), from_month_index)


def month_range(start: Column, stop: Column, step: Column | int = 1) -> Column:
    """Array of the months from ``start`` to ``stop`` inclusive."""
    step = F.lit(step) if isinstance(step, int) else step
    return F.transform(F.sequence(month_index(start), month_index(stop), step), from_month_index)


def year_range(start: Column, stop: Column, step: int = 1) -> Column:
    return F.sequence(start, stop, F.lit(step))


def day_range(start: Column, stop: Column, step: int = 1) -> Column:
    days = F.sequence(to_day(start), to_day(stop), F.make_interval(days=F.lit(step)))
    return F.transform(days, lambda d: (F.year(d) * 10000 + F.month(d) * 100 + F.day(d)).cast("int"))


def available_start(window: Column | int, start_year: Column, month: Column | None = None) -> Column:
    """First month with a full window, moved on to the wanted calendar month."""
    first = from_month_index(start_year * 12 + window - 1)
    if month is None:
        return first
    return F.when(first % 100 <= month, whole(first, 100) * 100 + month).otherwise((whole(first, 100) + 1) * 100 + month)


def available_range(window: Column | int, start_year: Column, end_year: Column, month: Column | None = None) -> Column:
    """Array of the months with a full window: every month, or one calendar month of every year."""
    end = end_year * 100 + (F.lit(12) if month is None else month)
    return month_range(available_start(window, start_year, month), end, 1 if month is None else 12)


def yearmon_from_name(name: Column) -> Column:
    """The only YYYYMM in a text; none or several is an error."""
    found = F.regexp_extract_all(name, F.lit(YEARMON_PATTERN), F.lit(0))
    return F.when(F.size(found) == 1, found[0].cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("no single month in "), name)).cast("int"))


def quantile_from_name(name: Column) -> Column:
    return F.regexp_extract(name, r"_q(\d+)$", 1).cast("int")

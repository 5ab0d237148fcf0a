"""Running totals in value order by a distributed prefix scan, whatever the sizes of the keys.

All order statistics (quantiles, ranks, L-moments, weighted quantiles) rest on one primitive: for
every distinct (key, value) the totals of all smaller values of that key. Equal rows are first
merged by a partial aggregation. The merged rows are then cut into ranges of about equal size by
(key, value), without regard to where keys begin or end; each range is sorted and summed by itself,
and a key that goes on from range to range gets one more row in each, which carries the totals of
its earlier ranges. A key with most of the table is thus no different from many small ones. The cut
points depend only on the data (hashes of its rows), so a recomputed task gives the same answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# As many ranges as shuffle partitions, within these bounds; rows looked at for each cut point.
FEWEST_RANGES, MOST_RANGES, DRAWN = 16, 2048, 32


def _cuts_up_to(cuts: Column, point: Column, most: int) -> Column:
    """How many of the sorted cut points (``most`` at most) are not above the row, by binary search."""
    def step(at: Column, n: Column) -> Column:
        return F.when(F.get(cuts, at + n - 1) <= point, at + n).otherwise(at)

    return F.aggregate(F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))]), F.lit(0), step)


def with_ranges(base: DataFrame, keys: list[str], order: list[str], ranges: int) -> DataFrame:
    """Add ``_range``, the number of a row's range: (keys, order) do not fall from one range to the next, missing values of a key last.

    The cut points are evenly spaced among rows drawn by their hash, about DRAWN for each, in a subquery of the plan. The hash is of whole
    rows, so that no subquery prunes columns and all read the same shuffle.
    """
    # the flag puts missing values behind the others
    point = F.struct(*keys, *[c for o in order for c in (F.col(o).isNull().alias(f"_no_{o}"), F.col(o))])
    mark = F.pmod(F.xxhash64(*base.columns), F.lit(2**40))
    rows = base.agg(F.count_if(mark % 2 == 0) * 2 + 1).scalar()  # nearly
    # in doubles: as whole numbers the product leaves 64 bits from 2^23 rows on
    drawn = base.select(point.alias("p"), mark.alias("mark")).where(F.col("mark").cast("double") * rows < F.lit(float(2**40 * DRAWN * ranges)))
    sorted_ = drawn.agg(F.sort_array(F.collect_list("p")).alias("a"))
    n = F.size("a")
    places = F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.floor(i * n / ranges)))
    cuts = sorted_.select(F.when(n == 0, F.col("a")).otherwise(F.transform(places, lambda i: F.get("a", i)))).scalar()
    return base.withColumn("_cuts", cuts).withColumn("_range", _cuts_up_to(F.col("_cuts"), point, ranges - 1)).drop("_cuts")


def running_totals(base: DataFrame, keys: list[str], order: list[str], measures: list[str],
                   bounded: bool = False, ranges: int | None = None) -> DataFrame:
    """Add ``below_<m>`` (total of strictly earlier rows) and ``all_<m>`` (total of the key) per measure.

    ``base`` has one row per (keys, order). Pass ``bounded`` only where the construction of ``base``
    bounds the rows of every key (say, one row per year): it saves the cut into ranges.
    """
    by_order = [F.col(c).asc_nulls_last() for c in order]

    def earlier(cols: list[str], *first: str):
        return Window.partitionBy(*cols).orderBy(*first, *by_order).rowsBetween(Window.unboundedPreceding, -1)

    if bounded:
        whole = Window.partitionBy(*keys)
        return base.withColumns(
            {f"below_{m}": F.coalesce(F.sum(m).over(earlier(keys)), F.lit(0)) for m in measures}
            | {f"all_{m}": F.sum(m).over(whole) for m in measures}
        )

    if ranges is None:
        ranges = max(FEWEST_RANGES, min(MOST_RANGES, int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    cut = with_ranges(base, keys, order, ranges)
    parts = cut.groupBy(*keys, "_range").agg(*[F.sum(m).alias(m) for m in measures])
    run = Window.partitionBy(*keys).orderBy("_range")
    before, after = run.rowsBetween(Window.unboundedPreceding, -1), run.rowsBetween(1, Window.unboundedFollowing)
    carried = parts.select(
        *keys, "_range", F.count("*").over(Window.partitionBy(*keys)).alias("_parts"),
        *[F.sum(m).over(before).alias(f"_before_{m}") for m in measures], *[F.sum(m).over(after).alias(f"_after_{m}") for m in measures],
    ).where(F.col("_parts") > 1)
    # one row for each range of a key that has several: it comes first and brings what the other ranges hold
    carry = carried.select(*keys, "_range", F.lit(0).alias("_own"), *[F.coalesce(f"_before_{m}", F.lit(0)).alias(m) for m in measures],
                           *[F.coalesce(f"_after_{m}", F.lit(0)).alias(f"_after_{m}") for m in measures])
    every = cut.withColumn("_own", F.lit(1)).unionByName(carry, allowMissingColumns=True)
    here = [*keys, "_range"]
    return every.withColumns(
        {f"below_{m}": F.coalesce(F.sum(m).over(earlier(here, "_own")), F.lit(0)) for m in measures}
        | {f"all_{m}": F.sum(F.col(m) + F.coalesce(f"_after_{m}", F.lit(0))).over(Window.partitionBy(*here)) for m in measures}
    ).where("_own = 1").drop("_own", "_range", *[f"_after_{m}" for m in measures])


def ordered_counts(df: DataFrame, keys: list[str], value: str, bounded: bool = False,
                   ranges: int | None = None) -> DataFrame:
    """(keys, value, m, below_m, all_m): runs of equal values of each key in order.

    Missing values form a run of multiplicity 0 at the end, so a key without values keeps a row.
    """
    base = df.select(*keys, value)
    if bounded:
        # one shuffle and one sort find the runs; a task holds the rows of one key besides the sort, no table of all its runs
        run, whole = Window.partitionBy(*keys).orderBy(F.col(value).asc_nulls_last()), Window.partitionBy(*keys)
        marked = base.withColumns({
            "below_m": F.rank().over(run).cast("long") - 1, "_row": F.row_number().over(run),
            "_upto": F.count(value).over(run.rangeBetween(Window.unboundedPreceding, Window.currentRow)), "all_m": F.count(value).over(whole)})
        return marked.where(F.col("_row") == F.col("below_m") + 1).select(
            *keys, value, (F.col("_upto") - F.col("below_m")).alias("m"), "below_m", "all_m")
    base = base.groupBy(*keys, value).agg(F.count(value).alias("m"))
    return running_totals(base, keys, [value], ["m"], bounded, ranges)


def value_at_rank(value: str, rank: Column, where: Column | None = None) -> Column:
    """Aggregate: the value whose run of equal rows covers the 0-based ``rank``."""
    covers = (F.col("below_m") <= rank) & (rank < F.col("below_m") + F.col("m"))
    covers = covers if where is None else where & covers
    return F.max(F.when(covers, F.col(value)))


def quantile_column(value: str, p: float, where: Column | None = None) -> Column:
    """Aggregate over :func:`ordered_counts`: linear interpolation at (n-1)p."""
    h = (F.col("all_m") - 1) * F.lit(float(p))
    low, high = value_at_rank(value, F.floor(h), where), value_at_rank(value, F.ceil(h), where)
    part = h - F.floor(h)
    part = F.max(part if where is None else F.when(where, part))
    return low + (high - low) * part


def quantiles(df: DataFrame, keys: list[str], value: str, ps: dict[str, float], bounded: bool = False,
              ranges: int | None = None) -> DataFrame:
    """Exact quantiles per key, one output column per entry of ``ps``."""
    oc = ordered_counts(df, keys, value, bounded, ranges)
    return oc.groupBy(*keys).agg(*[quantile_column(value, p).alias(name) for name, p in ps.items()])


def quantiles_of_many(df: DataFrame, keys: list[str], wanted: dict[str, dict[str, float]], bounded: bool = False) -> DataFrame:
    """The same for several variables in one ordered pass; ``wanted`` maps variables to {output: probability}."""
    if len(wanted) == 1:
        (value, ps), = wanted.items()
        return quantiles(df, keys, value, ps, bounded)
    long = df.select(*keys, *[F.col(v).cast("double").alias(v) for v in wanted]).unpivot(keys, list(wanted), "_variable", "_value")
    oc = ordered_counts(long, [*keys, "_variable"], "_value", bounded)
    return oc.groupBy(*keys).agg(*[
        quantile_column("_value", p, F.col("_variable") == v).alias(name) for v, ps in wanted.items() for name, p in ps.items()])

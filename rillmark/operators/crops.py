"""Crop calendars, production, losses and yields."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import crops as G
from ..functions import numeric as N
from ..session import cut_lineage
from .integrate import ensemble_summary
from .joins import psum
from .spatial import block_aggregate, mean_doy, on_coverage

# fixed values: crops of the assessment (id, name, food, implemented)
CROPS = [
    (1, "wheat", True, True), (2, "rice", True, True), (3, "maize", True, True), (4, "barley", True, False),
    (5, "millet", True, False), (6, "sorghum", True, False), (7, "soybeans", True, True), (8, "sunflower", False, False),
    (9, "potatoes", True, True), (10, "cassava", True, False), (11, "sugarcane", False, False), (12, "sugarbeets", False, False),
    (13, "oilpalm", False, False), (14, "rapeseed", False, False), (15, "groundnuts", True, False), (16, "pulses", True, False),
    (17, "cotton", False, False), (18, "cocoa", False, False), (19, "coffee", False, False),
]
# fixed values: crops of the published calendar (calendar id, id of the assessment, number of subcrops)
CALENDAR_CROPS = [
    (1, 1, 2), (2, 3, 2), (3, 2, 5), (4, 4, 2), (5, None, 2), (6, 5, 1), (7, 6, 2), (8, 7, 1), (9, 8, 1), (10, 9, 2), (11, 10, 1),
    (12, 11, 1), (13, 12, 1), (14, 13, 1), (15, 14, 1), (16, 15, 1), (17, 16, 1), (18, None, 1), (19, None, 1), (20, None, 1),
    (21, 17, 1), (22, 18, 1), (23, 19, 1), (24, None, 1), (25, None, 1), (26, None, 5),
]
# fixed values: crops of the published production data and the id they belong to
PRODUCTION_CROPS = [
    ("whea", 1), ("rice", 2), ("maiz", 3), ("barl", 4), ("pmil", 5), ("smil", 5), ("sorg", 6), ("pota", 9), ("cass", 10),
    ("bean", 16), ("chic", 16), ("cowp", 16), ("pige", 16), ("lent", 16), ("opul", 16), ("soyb", 7), ("grou", 15), ("oilp", 13),
    ("sunf", 8), ("rape", 14), ("sugc", 11), ("sugb", 12), ("cott", 17), ("acof", 19), ("rcof", 19), ("coco", 18),
]


def crop_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CROPS, "crop_id INT, crop STRING, food BOOLEAN, implemented BOOLEAN")


def calendar_crop_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CALENDAR_CROPS, "calendar_id INT, crop_id INT, n_subcrops INT")


def production_crop_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PRODUCTION_CROPS, "source STRING, crop_id INT")


def subcrops(spark: SparkSession, implemented_only: bool = False) -> DataFrame:
    """(crop, food, calendar_id, subcrop, name): ``name_1`` … where a crop has several seasons."""
    joined = crop_table(spark).join(calendar_crop_table(spark), "crop_id")
    if implemented_only:
        joined = joined.where("implemented")
    numbered = joined.select("crop_id", "crop", "food", "calendar_id", "n_subcrops", F.explode(F.sequence(F.lit(1), F.col("n_subcrops"))).alias("subcrop"))
    name = F.when(F.col("n_subcrops") > 1, F.concat_ws("_", "crop", "subcrop")).otherwise(F.col("crop"))
    return numbered.withColumn("name", name)


def model_name(subcrop: Column) -> Column:
    """Yield model of a subcrop: wheat has one for winter and one for spring, other crops one each."""
    return (F.when(subcrop == "wheat_1", "winter_wheat").when(subcrop == "wheat_2", "spring_wheat")
            .otherwise(F.regexp_replace(subcrop, r"_\d+$", "")))


def area_fractions(calendar: DataFrame) -> DataFrame:
    """Share of each subcrop in the area of its crop; crops without area drop out."""
    total = calendar.groupBy("unit_code", "crop").agg(F.sum("area_ha").alias("_total")).where(F.col("_total") > 0)
    return calendar.join(total, ["unit_code", "crop"]).withColumn("area_frac", F.col("area_ha") / F.col("_total")).drop("_total", "area_ha")


def default_area_fractions(calendar: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Every unit with every subcrop of every crop; unknown shares are 0 where another subcrop is known, else missing.

    ``counts`` gives the number of subcrops per crop.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("crop"), F.lit(s).alias("subcrop")) for c, n in counts.items() for s in range(1, n + 1)])
    full = calendar.select("unit_code").distinct().select("unit_code", F.explode(pairs).alias("_p")).select("unit_code", "_p.crop", "_p.subcrop")
    known = calendar.where(F.col("area_frac").isNotNull()).select("unit_code", "crop").distinct().withColumn("_any", F.lit(True))
    out = full.join(calendar, ["unit_code", "crop", "subcrop"], "left").join(known, ["unit_code", "crop"], "left")
    return out.withColumn("area_frac", F.coalesce("area_frac", F.when(F.col("_any"), 0.0))).drop("_any")


def calendar_grid(regions: DataFrame, calendar: DataFrame, factor: int) -> DataFrame:
    """Planting day, harvest day and area share per block of cells and subcrop, all crops in one pass.

    ``regions`` has (row_no, col_no, unit_code); ``calendar`` comes from :func:`default_area_fractions`.
    """
    dated = calendar.withColumns({"plant_doy": C.start_of_month(F.col("plant_month")), "harvest_doy": C.end_of_month(F.col("harvest_month"))})
    cells = regions.join(dated.select("unit_code", "crop", "subcrop", "plant_doy", "harvest_doy", "area_frac"), "unit_code")
    block = [F.floor(F.col(c) / factor).cast("int").alias(c) for c in ("row_no", "col_no")]
    return cells.groupBy(*block, "crop", "subcrop").agg(
        mean_doy(F.col("plant_doy")).alias("plant_doy"), mean_doy(F.col("harvest_doy")).alias("harvest_doy"), F.avg("area_frac").alias("area_frac"))


def allocate_production(production: DataFrame, sources: DataFrame, names: DataFrame, fractions: DataFrame, factor: int) -> DataFrame:
    """Production per cell and subcrop.

    ``production`` has (row_no, col_no, source, production), ``sources`` (source, crop_id), ``names``
    (crop_id, name, n_subcrops), ``fractions`` (row_no, col_no, name, area_frac) on a grid ``factor``
    times coarser. Source crops are added per crop; crops with several subcrops are split by area
    share, where an unknown share is 0. ``sources`` and ``names`` are lists of crops and broadcast: by crop, a few tasks would hold
    all cells.
    """
    per_crop = (production.join(F.broadcast(sources), "source").groupBy("row_no", "col_no", "crop_id")
                .agg(F.coalesce(F.sum("production"), F.lit(0.0)).alias("production")))
    cells = per_crop.join(F.broadcast(names), "crop_id")
    key = {"_r": F.floor(F.col("row_no") / factor).cast("int"), "_c": F.floor(F.col("col_no") / factor).cast("int")}
    shares = fractions.select(F.col("row_no").alias("_r"), F.col("col_no").alias("_c"), "name", "area_frac")
    out = cells.withColumns(key).join(shares, ["_r", "_c", "name"], "left")
    share = F.when(F.col("n_subcrops") > 1, F.coalesce("area_frac", F.lit(0.0))).otherwise(1.0)
    return out.select("row_no", "col_no", "name", (F.col("production") * share).alias("production"))


def stress_losses(df: DataFrame, stresses: list[str], onset: float, total: float, power: float) -> DataFrame:
    """One loss column ``<stress>_loss`` per stress; a missing stress is none."""
    return df.withColumns({f"{s}_loss": G.loss_function(F.coalesce(F.col(s), F.lit(0.0)), onset, total, power) for s in stresses})


def cumulative_crop_loss(monthly: DataFrame, keys: list[str], stresses: list[str], onset: float, total: float, power: float,
                         method: str = "max", mean_fit: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """Monthly, mean and cumulative losses for the harvests of this year and the next.

    ``monthly`` has one row per key and month (``month_index``), the stresses as positive return
    periods, and the calendar (``plant_doy``, ``harvest_doy``). Losses for next year's harvest carry
    over to this year's in January, for seasons over the year's end; all others start anew. A
    window partition is a key's calendar of months.
    """
    df = stress_losses(monthly, stresses, onset, total, power)
    month = (F.col("month_index") % 12 + 1).cast("int")
    plant, harvest = F.col("plant_doy"), F.col("harvest_doy")
    df = df.withColumns({"_year": F.floor(F.col("month_index") / 12).cast("int"), "_from": C.start_of_month(month), "_to": C.end_of_month(month),
                         "_loss": G.combine_losses([F.col(f"{s}_loss") for s in stresses], method)})
    start, stop = F.col("_from"), F.col("_to")
    df = df.withColumns({"_this": G.growing_days_this_year(start, stop, plant, harvest), "_next": G.growing_days_next_year(start, stop, plant, harvest)})
    length = stop - start + 1
    for name in ("this", "next"):
        days = F.col(f"_{name}") * F.col("_loss")
        left = 1 - days / length
        df = df.withColumns({f"_d_{name}": days, f"_z_{name}": F.when(left <= 0, 1).otherwise(0), f"_l_{name}": F.when(left > 0, F.ln(left)).otherwise(0.0)})

    in_year = Window.partitionBy(*keys, "_year").orderBy("month_index").rowsBetween(Window.unboundedPreceding, 0)
    year_before = Window.partitionBy(*keys).orderBy("_year").rangeBetween(-1, -1)
    carried = harvest < plant

    def sums(kind: str) -> tuple[Column, Column]:
        brought = F.when(carried, F.coalesce(F.sum(f"_{kind}_next").over(year_before), F.lit(0)))
        this = F.sum(f"_{kind}_this").over(in_year) + F.coalesce(brought, F.lit(0))
        return this, F.sum(f"_{kind}_next").over(in_year)

    d, z, l = sums("d"), sums("z"), sums("l")
    df = df.withColumns({f"_days_{n}": d[i] for i, n in enumerate(("this", "next"))}
                        | {f"_left_{n}": F.when(z[i] > 0, 0.0).otherwise(F.exp(l[i])) for i, n in enumerate(("this", "next"))})
    since = {"this": G.days_since_planting_this_year(F.lit(1), stop, plant, harvest), "next": G.days_since_planting_next_year(F.lit(1), stop, plant, harvest)}
    known = plant.isNotNull() & harvest.isNotNull()
    out = {"loss": F.when((F.coalesce("_this", F.lit(0)) >= 1) | (F.coalesce("_next", F.lit(0)) >= 1), F.col("_loss"))}
    for name, label in (("this", "current_year"), ("next", "next_year")):
        out[f"mean_loss_{label}"] = F.when(known, F.when(since[name] > 0, F.col(f"_days_{name}") / since[name]).otherwise(0.0))
        out[f"cumulative_loss_{label}"] = F.when(known, F.greatest(1 - G.initial_fraction(since[name], *mean_fit) * F.col(f"_left_{name}"), F.lit(-1.0)))
    return df.select(*keys, "month_index", *[c.alias(n) for n, c in out.items()])


def summarize_crop_loss(production: DataFrame, loss: DataFrame, crops: DataFrame, loss_column: str = "loss") -> DataFrame:
    """Loss relative to production, per quantile: by crop, by kind (food or not) and overall, in one aggregation.

    ``level`` tells which; the loss is missing where nothing is produced.
    """
    keys = ["id", "method", "crop", "subcrop"]
    df = production.join(loss, keys).join(crops.select("crop", "food"), "crop")
    total = F.sum("production")
    known = F.bool_and(F.col(loss_column).isNotNull())
    share = F.when((total > 0) & known, F.sum(loss_column) / total)
    names = ["id", "quantile", "crop", "food"]
    sets = [[F.col(c) for c in s] for s in (["id", "quantile", "crop"], ["id", "quantile", "food"], ["id", "quantile"])]
    out = df.groupingSets(sets, *[F.col(c) for c in names]).agg(
        share.alias(loss_column), total.alias("production"), F.grouping("crop").alias("_no_crop"), F.grouping("food").alias("_no_food"))
    level = F.when(F.col("_no_crop") == 0, "crop").when(F.col("_no_food") == 0, "type").otherwise("overall")
    return out.select(level.alias("level"), *names, loss_column, "production")


def format_crop_loss(summary: DataFrame, level: str, quantiles: list[int], loss_column: str = "loss") -> DataFrame:
    """Wide form: one column per quantile (and kind); quantiles are percents."""
    rows = summary.where(F.col("level") == level)
    at = F.round(F.col("quantile") * 100).cast("int")

    def pick(q: int, extra: Column = F.lit(True)) -> Column:
        return F.max(F.when((at == q) & extra, F.col(loss_column)))

    if level == "crop":
        return rows.groupBy("id", "crop").agg(*[pick(q).alias(f"{loss_column}_q{q}") for q in quantiles])
    if level == "overall":
        return rows.groupBy("id").agg(*[pick(q).alias(f"{loss_column}_overall_q{q}") for q in quantiles])
    kinds = {"food": F.col("food"), "non_food": ~F.col("food")}
    return rows.groupBy("id").agg(*[pick(q, c).alias(f"{loss_column}_{k}_q{q}") for k, c in kinds.items() for q in quantiles])


def unpivot_results(df: DataFrame, variables: list[str], id_column: str) -> DataFrame:
    """Columns named ``var_method_crop[_n][_qNN]`` to rows (id, variable, method, crop, subcrop, quantile, value).

    Names are read once from the schema, not per row.
    """
    prefix = "|".join(sorted(map(re.escape, variables), key=len, reverse=True))
    rows = []
    for column in df.columns:
        found = re.match(rf"({prefix})_([a-z]+)_([a-z]+)(_\d+)?(?:_q(\d+))?$", column)
        if column == id_column or not found:
            continue
        var, method, crop, number, q = found.groups()
        rows.append(F.struct(
            F.lit(var).alias("variable"), F.lit(method).alias("method"), F.lit(crop).alias("crop"), F.lit(crop + (number or "")).alias("subcrop"),
            F.lit(int(q) / 100 if q else None).cast("double").alias("quantile"), F.col(column).cast("double").alias("value")))
    return df.select(F.col(id_column).alias("id"), F.explode(F.array(*rows)).alias("_r")).select("id", "_r.*")


def irrigated_fraction(production: DataFrame, factor: int, by: list[str]) -> DataFrame:
    """Mean share of irrigated production per block; cells produced in neither way do not count."""
    total = psum(F.col("irrigated"), F.col("rainfed"))
    share = production.withColumn("irrigated_fraction", F.try_divide("irrigated", total))
    return block_aggregate(share, factor, "irrigated_fraction", "mean", by)


def dominant_calendar(fraction: DataFrame, irrigated: DataFrame, rainfed: DataFrame, keys: list[str]) -> DataFrame:
    """Dates of the method with most of the production; missing where that is unknown."""
    dates = ["plant_doy", "harvest_doy"]
    out = (fraction.join(irrigated.select(*keys, *[F.col(d).alias(f"_i_{d}") for d in dates]), keys, "left")
           .join(rainfed.select(*keys, *[F.col(d).alias(f"_r_{d}") for d in dates]), keys, "left"))
    wet = F.col("irrigated_fraction") >= 0.5
    return out.select(*keys, "irrigated_fraction", *[
        F.when(wet, F.col(f"_i_{d}")).when(~wet, F.col(f"_r_{d}")).alias(d) for d in dates])


MODEL_MONTHS = 12


def yield_features(anomalies: DataFrame, calendar: DataFrame, yearmon: int, harvest: str, variables: list[str], fill: float = 0.0,
                   seed: int | None = None) -> DataFrame:
    """Model inputs per cell and crop: the twelve months up to the harvest, as probabilities.

    ``anomalies`` has (cell_id, month_index, <variables>), observed and forecast; ``calendar``
    (cell_id, crop, plant_doy, harvest_doy, irrigated_fraction). ``harvest`` is current_year or
    next_year. Missing anomalies are 0; months outside the data take ``fill``, or random normal values
    when a seed is given. Columns ``<var>_11`` … ``<var>_0`` count back from the harvest month, as do
    the season flags.
    """
    now = yearmon // 100 * 12 + yearmon % 100 - 1
    ahead = {"current_year": 0, "next_year": 12}[harvest]
    plant, end = C.doy_to_month(F.col("plant_doy")), C.doy_to_month(F.col("harvest_doy"))
    cal = calendar.where(F.col("plant_doy").isNotNull() & F.col("harvest_doy").isNotNull()).withColumns({"_plant": plant, "_end": end})
    months = cal.select("cell_id", "crop", F.explode(F.sequence(F.lit(0), F.lit(MODEL_MONTHS - 1))).alias("back"),
                        (F.lit(now - yearmon % 100 + ahead) + F.col("_end") - F.col("back")).alias("month_index"))
    outside = F.lit(fill) if seed is None else N.noise(seed, "cell_id", "crop", "back")
    there = anomalies.select("cell_id", "month_index", *variables, F.lit(True).alias("_there"))
    rows = months.join(there, ["cell_id", "month_index"], "left").withColumns(
        {v: F.when(F.col("_there"), F.coalesce(F.col(v), F.lit(0.0))).otherwise(outside) for v in variables})
    rows = rows.withColumns({v: N.norm_cdf(F.col(v)) for v in variables})
    # twelve rows by construction; two calendars of one cell and crop are an error
    wide = rows.groupBy("cell_id", "crop").agg(F.map_from_entries(F.collect_list(F.struct("back", F.struct(*variables)))).alias("_m"))
    wide = wide.select("cell_id", "crop", *[F.col("_m")[b][v].alias(f"{v}_{b}") for v in variables for b in range(MODEL_MONTHS - 1, -1, -1)])
    # months are counted back from the harvest without wrapping, so a season over the year's end is always on
    season = {f"in_season_{b}": G.is_growing_season(F.col("_end") - b, F.col("_plant"), F.col("_end")).cast("int") for b in range(MODEL_MONTHS - 1, -1, -1)}
    flags = cal.select("cell_id", "crop", "irrigated_fraction", *[c.alias(n) for n, c in season.items()])
    return wide.join(flags, ["cell_id", "crop"]).withColumn("harvest", F.lit(harvest))


def fit_yield_model(features: DataFrame, inputs: list[str], label: str, seed: int = 1, trees: int = 20):
    """A random forest fitted on supplied yields, for :func:`score_yield`."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    stages = [VectorAssembler(inputCols=inputs, outputCol="_features", handleInvalid="skip"),
              RandomForestRegressor(featuresCol="_features", labelCol=label, predictionCol="yield", numTrees=trees, seed=seed)]
    return Pipeline(stages=stages).fit(features)


def score_yield(features: DataFrame, models: dict[str, object]) -> DataFrame:
    """Predicted yields, one row per row of ``features``, each crop by its own model.

    Where an input is missing the yield is missing; a crop without a model is an error. Every crop reads the features, so they are
    written once.
    """
    features = cut_lineage(features)
    name = model_name(F.col("crop"))
    known = F.coalesce(name.isin(list(models)), F.lit(False))
    unknown = F.raise_error(F.concat(F.lit("no model for crop "), F.coalesce(F.col("crop"), F.lit("(missing)")))).cast("double")
    out = features.where(~known).withColumn("yield", unknown)
    for crop, model in models.items():
        own = features.where(name == crop)
        complete = reduce(lambda a, b: a & b, (F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in model.stages[0].getInputCols()))
        out = out.unionByName(model.transform(own.where(complete)).drop("_features"))
        out = out.unionByName(own.where(~complete).withColumn("yield", F.lit(None).cast("double")))
    return out


def aggregate_yield(yields: DataFrame, production: DataFrame, coverage: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Production-weighted yield per zone and crop; subcrops are added first, irrigated and rainfed together."""
    by = by or []
    prod = production.select("cell_id", F.col("crop").alias("subcrop"), psum(F.col("irrigated"), F.col("rainfed")).alias("production"))
    crop = F.regexp_replace("subcrop", r"_\d+$", "").alias("crop")
    total = on_coverage(prod, coverage).groupBy("zone_id", crop).agg(F.sum(F.col("fraction") * F.col("production")).alias("_total"))
    scored = yields.select("cell_id", F.col("crop").alias("subcrop"), "yield", *by).join(prod, ["cell_id", "subcrop"])
    weighted = on_coverage(scored, coverage).groupBy("zone_id", crop, *by).agg(
        F.sum(F.col("fraction") * F.col("yield") * F.col("production")).alias("_weighted"))
    return weighted.join(total, ["zone_id", "crop"]).select("zone_id", "crop", *by, F.try_divide("_weighted", "_total").alias("yield"))


def yield_ensemble_summary(yields: DataFrame, keys: list[str], bounded: bool = False) -> DataFrame:
    return ensemble_summary(yields, keys, ["yield"], bounded=bounded)

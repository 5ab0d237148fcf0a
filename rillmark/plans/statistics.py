"""Integration statistics, ensembles, climate norms and trailing windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..lenses import lens, table, with_lenses
from ..operators import integrate as I
from ..operators import windows as W
from .registry import query, r, rounded, rsql

# ---- one statistic each, over the months of a cell --------------------------------------------

_PLAIN = {
    "a1_sum": ("sum", "coalesce(sum(value), 0e0)"),
    "a2_ave": ("ave", "avg(value)"),
    "a3_min": ("min", "min(value)"),
    "a3_max": ("max", "max(value)"),
    "a5_fraction_defined": ("fraction_defined", "count(value) * 1e0 / count(*)"),
    "a6_fraction_defined_above_zero": ("fraction_defined_above_zero",
                                       "count(*) FILTER (value > 0) * 1e0 / nullif(count(value), 0)"),
}


def _register_plain(name, stat, sql):
    @query(name, with_lenses("layers", f"SELECT cell_id, {rsql(sql)} AS value_{stat} FROM layers GROUP BY cell_id"))
    def run(spark, sf_dir):
        return rounded(I.integrate(lens(spark, sf_dir, "layers"), ["cell_id"], [stat], ["value"]), f"value_{stat}")


for _name, (_stat, _sql) in _PLAIN.items():
    _register_plain(_name, _stat, _sql)


@query("a7_num_defined", with_lenses("layers", "SELECT cell_id, count(value) AS value_num_defined FROM layers GROUP BY cell_id"))
def a7(spark, sf_dir):
    return I.integrate(lens(spark, sf_dir, "layers"), ["cell_id"], ["num_defined"], ["value"])


@query("a4_quantiles", with_lenses("layers", f"""
SELECT cell_id, {rsql('quantile_cont(value, 0.5e0)')} AS value_median, {rsql('quantile_cont(value, 0.25e0)')} AS value_q25,
       {rsql('quantile_cont(value, 0.975e0)')} AS "value_q97.5", {rsql('max(value)')} AS value_q100
FROM layers GROUP BY cell_id"""))
def a4(spark, sf_dir):
    out = I.integrate(lens(spark, sf_dir, "layers"), ["cell_id"], ["median", "q25", "q97.5", "q100"], ["value"])
    return out.select("cell_id", *[r(F.col(f"`{c}`")).alias(c) for c in ("value_median", "value_q25", "value_q97.5", "value_q100")])


@query("a4_quantiles_of_raw_lines", f"""
SELECT l_returnflag, l_linestatus, {rsql('quantile_cont(l_extendedprice, 0.5e0)')} AS price_median,
       {rsql('quantile_cont(l_extendedprice, 0.9e0)')} AS price_q90
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def a4_raw(spark, sf_dir):
    # six keys hold the whole table: the ordered pass must not put a key into one task
    df = table(spark, sf_dir, "lineitem").withColumnRenamed("l_extendedprice", "price")
    return rounded(I.integrate(df, ["l_returnflag", "l_linestatus"], ["median", "q90"], ["price"]), "price_median", "price_q90")


_HOT = "CASE WHEN l_suppkey % 5 < 3 THEN 0 ELSE l_suppkey END"


@query("a4_quantiles_of_a_hot_key", f"""
SELECT {_HOT} AS supplier, {rsql('quantile_cont(l_extendedprice, 0.25e0)')} AS price_q25, {rsql('quantile_cont(l_extendedprice, 0.5e0)')} AS price_median,
       {rsql('quantile_cont(l_extendedprice, 0.9e0)')} AS price_q90 FROM lineitem GROUP BY 1""")
def a4_hot(spark, sf_dir):
    # one key holds three fifths of all rows, the others little each
    df = table(spark, sf_dir, "lineitem").select(F.expr(_HOT).alias("supplier"), F.col("l_extendedprice").alias("price"))
    return rounded(I.integrate(df, ["supplier"], ["q25", "median", "q90"], ["price"]), "price_q25", "price_median", "price_q90")


@query("a8_which_extreme", with_lenses("layers", """
, n AS (SELECT *, layer - min(layer) OVER (PARTITION BY cell_id) + 1 AS pos FROM layers)
SELECT cell_id, CAST(arg_min(pos, (value, pos)) FILTER (value IS NOT NULL) AS INT) AS value_which_min,
       CAST(arg_max(pos, (value, -pos)) FILTER (value IS NOT NULL) AS INT) AS value_which_max
FROM n GROUP BY cell_id"""))
def a8(spark, sf_dir):
    df = lens(spark, sf_dir, "layers")
    first = df.groupBy("cell_id").agg(F.min("layer").alias("first"))
    df = df.join(first, "cell_id").withColumn("pos", (F.col("layer") - F.col("first") + 1).cast("int"))
    return I.integrate(df, ["cell_id"], ["which_min", "which_max"], ["value"], layer="pos")


@query("a9_weighted_mean", with_lenses("layers", f"""
SELECT cell_id, {rsql('sum(value * weight) / sum(CASE WHEN value IS NOT NULL THEN weight END)')} AS value_weighted_mean
FROM layers GROUP BY cell_id"""))
def a9(spark, sf_dir):
    return lens(spark, sf_dir, "layers").groupBy("cell_id").agg(
        r(I.weighted_mean(F.col("value"), F.col("weight"))).alias("value_weighted_mean"))


_WQ = """
, i AS (SELECT {k}, {x} AS x, {w} AS w, row_number() OVER o AS i, count(*) OVER (PARTITION BY {k}) AS n,
          coalesce(sum({w}) OVER (PARTITION BY {k} ORDER BY {x}, {w}, {tie} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
          sum({w}) OVER (PARTITION BY {k}) AS total
        FROM {t} WHERE {x} IS NOT NULL WINDOW o AS (PARTITION BY {k} ORDER BY {x}, {w}, {tie}))
, s AS (SELECT *, (i-1)*w + (n-1)*before AS s, (n-1)*total*{p} AS goal FROM i)
, nx AS (SELECT *, lead(x) OVER (PARTITION BY {k} ORDER BY i) AS x2, lead(s) OVER (PARTITION BY {k} ORDER BY i) AS s2 FROM s)
, q AS (SELECT {k}, min(CASE WHEN s2 IS NULL OR x2 = x THEN x ELSE x + (x2-x)*(goal-s)/(s2-s) END) AS v
        FROM nx WHERE s <= goal AND (s2 > goal OR s2 IS NULL) GROUP BY {k})
"""


@query("a10_weighted_quantile", with_lenses("layers", _WQ.format(k="cell_id", x="value", w="weight", tie="layer", t="layers", p="0.7e0") + f"""
SELECT DISTINCT l.cell_id, {rsql('v', 4)} AS value_q70 FROM layers l LEFT JOIN q ON q.cell_id = l.cell_id"""))
def a10(spark, sf_dir):
    return rounded(I.weighted_quantiles(lens(spark, sf_dir, "layers"), ["cell_id"], "value", "weight", {"value_q70": 0.7}),
                   "value_q70", digits=4)


@query("a14_weighted", with_lenses("layers", _WQ.format(k="cell_id", x="value", w="weight", tie="layer", t="layers", p="0.3e0") + f"""
, s1 AS (SELECT cell_id, coalesce(sum(value), 0) AS total, count(value) AS n FROM layers GROUP BY 1)
SELECT s1.cell_id, {rsql('total')} AS value_sum, n AS value_num_defined, {rsql('v', 4)} AS value_weighted_q30 FROM s1 LEFT JOIN q ON q.cell_id = s1.cell_id"""))
def a14_weighted(spark, sf_dir):
    out = I.integrate(lens(spark, sf_dir, "layers"), ["cell_id"], ["SUM", "num_defined", "weighted_Q30"], ["value"], weight="weight")
    return rounded(rounded(out, "value_sum"), "value_weighted_q30", digits=4)


@query("a11_sorted_values", with_lenses("layers", f"""
SELECT cell_id, row_number() OVER (PARTITION BY cell_id ORDER BY value ASC NULLS LAST) AS position, {rsql('value')} AS value FROM layers"""))
def a11(spark, sf_dir):
    return rounded(I.sorted_values(lens(spark, sf_dir, "layers"), ["cell_id"], "value"), "value")


_HALVES = """
, h AS (SELECT cell_id, value AS obs FROM layers WHERE layer < 23976)
, x AS (SELECT cell_id, layer, value FROM layers WHERE layer >= 23976)"""


def _halves(spark, sf_dir):
    df = lens(spark, sf_dir, "layers")
    return df.where("layer >= 23976").select("cell_id", "layer", "value"), \
        df.where("layer < 23976").select("cell_id", F.col("value").alias("obs"))


@query("a12_rank_in_history", with_lenses("layers", _HALVES + """
SELECT x.cell_id, x.layer, CASE WHEN any_value(x.value) IS NOT NULL THEN 1 + count(*) FILTER (obs < x.value) END AS min_rank,
       CASE WHEN any_value(x.value) IS NOT NULL THEN 1 + count(*) FILTER (obs <= x.value) END AS max_rank
FROM x LEFT JOIN h ON h.cell_id = x.cell_id GROUP BY x.cell_id, x.layer"""))
def a12(spark, sf_dir):
    new, old = _halves(spark, sf_dir)
    return I.ranks(new, old, ["cell_id"], "value", "obs").select("cell_id", "layer", "min_rank", "max_rank")


@query("a13_layer_slice", with_lenses("layers", f"""
, n AS (SELECT cell_id, layer - 23939 AS pos, value FROM layers)
, w AS (SELECT cell_id, CAST(cell_id % 9 - 4 + i AS BIGINT) AS pos, CAST(i + 1 AS INT) AS position
        FROM (SELECT DISTINCT cell_id FROM layers), range(12) t(i))
SELECT w.cell_id, position, {rsql('CASE WHEN n.cell_id IS NOT NULL THEN value ELSE -1e0 END')} AS value
FROM w LEFT JOIN n ON n.cell_id = w.cell_id AND n.pos = w.pos"""))
def a13(spark, sf_dir):
    df = lens(spark, sf_dir, "layers").withColumn("pos", F.col("layer") - 23939)
    starts = df.select("cell_id").distinct().withColumn("start", F.col("cell_id").cast("int") % 9 - 4)
    return rounded(I.layer_slice(df, starts, ["cell_id"], "pos", "value", "start", 12, -1.0), "value")


@query("a14_integrate", with_lenses("obs", f"""
SELECT cell_id, {rsql('sum(Pr)')} AS Pr_sum, {rsql('sum(RO_mm)', 9)} AS RO_mm_sum, {rsql('avg(T)', 9)} AS T_ave,
       {rsql('max(Ws)')} AS Ws_max, {rsql('quantile_cont(Pr, 0.5e0)')} AS Pr_median, {rsql('quantile_cont(RO_mm, 0.5e0)', 9)} AS RO_mm_median
FROM obs GROUP BY cell_id"""))
def a14(spark, sf_dir):
    out = I.integrate(lens(spark, sf_dir, "obs"), ["cell_id"], ["sum", "ave::T", "max::Ws", "median"], ["Pr", "RO_mm"], bounded=True)
    return rounded(out, *[c for c in out.columns if c != "cell_id"], digits=9)


@query("a15_integrate_by_dimension", with_lenses("members", f"""
SELECT cell_id, model, {rsql('sum(Pr)')} AS Pr_sum, {rsql('quantile_cont(Pr, 0.75e0)')} AS Pr_q75 FROM members GROUP BY cell_id, model"""))
def a15(spark, sf_dir):
    return rounded(I.integrate(lens(spark, sf_dir, "members"), ["cell_id", "model"], ["sum", "q75"], ["Pr"]), "Pr_sum", "Pr_q75")


@query("a16_ensemble_weights", with_lenses("members", """
, m AS (SELECT DISTINCT target, model, member FROM members)
SELECT target, model, member, round(1e0 / count(*) OVER (PARTITION BY target, model)
       / (SELECT count(DISTINCT model) FROM m b WHERE b.target = m.target), 6) AS weight FROM m"""))
def a16(spark, sf_dir):
    m = lens(spark, sf_dir, "members").select("target", "model", "member").distinct()
    return rounded(I.ensemble_weights(m, ["target"]), "weight")


@query("a16b_ensemble_members", """
SELECT event_id, ts FROM (SELECT event_id, date_trunc('hour', ts) AS ts FROM events)
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-25' AND DATE '2024-01-31' AND hour(ts) IN (0, 6, 12, 18)
  AND ts < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 36 HOUR""")
def a16b(spark, sf_dir):
    runs = table(spark, sf_dir, "events").select("event_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"))
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return I.ensemble_members(runs, "ts", F.lit(202401), now, 36)


@query("a17_ensemble_summary", with_lenses("members", f"""
SELECT cell_id, target, {', '.join(rsql(f'quantile_cont(Pr, {q}e-2)') + f' AS Pr_q{q}' for q in (25, 50, 75))}
FROM members GROUP BY cell_id, target"""))
def a17(spark, sf_dir):
    return rounded(I.ensemble_summary(lens(spark, sf_dir, "members"), ["cell_id", "target"], ["Pr"], bounded=True), "Pr_q25", "Pr_q50", "Pr_q75")


@query("a17_ensemble_summary_weighted", with_lenses("members", """
, m AS (SELECT *, 1e0 / count(*) OVER (PARTITION BY cell_id, model) / (SELECT count(DISTINCT model) FROM members b WHERE b.cell_id = a.cell_id) AS weight
        FROM members a)""" + _WQ.format(k="cell_id", x="Pr", w="weight", tie="target", t="m", p="0.5e0") + f"""
SELECT cell_id, {rsql('v', 4)} AS Pr_q50 FROM q"""))
def a17_weighted(spark, sf_dir):
    weighted = I.ensemble_weights(lens(spark, sf_dir, "members"), ["cell_id"])
    return rounded(I.ensemble_summary(weighted, ["cell_id"], ["Pr"], "weight").select("cell_id", "Pr_q50"), "Pr_q50", digits=4)


@query("a18_climate_norm", with_lenses("obs", f"""
SELECT cell_id, month, {rsql('quantile_cont(Pr, 0.5e0)', 9)} AS Pr, {rsql('quantile_cont(T, 0.5e0)', 9)} AS T FROM obs GROUP BY cell_id, month"""))
def a18(spark, sf_dir):
    return rounded(I.climate_norm(lens(spark, sf_dir, "obs"), ["cell_id"], ["Pr", "T"], "median", bounded=True), "Pr", "T", digits=9)


@query("a20_stat_spec", with_lenses("obs", f"""
SELECT cell_id, {rsql('min(Pr)')} AS Pr_min, {rsql('max(T)')} AS T_max, {rsql('max(Ws)')} AS Ws_max FROM obs GROUP BY cell_id"""))
def a20(spark, sf_dir):
    out = I.integrate(lens(spark, sf_dir, "obs"), ["cell_id"], ["min::Pr", "max::T,Ws"], ["Pr", "T", "Ws"])
    return rounded(out, "Pr_min", "T_max", "Ws_max")


_WET = f"""SELECT cell_id, CAST(year(day)*100 + month(day) AS INT) AS yearmon,
       {rsql('count(*) FILTER (precip - 60e0 > 0) * 1e0 / nullif(count(precip), 0)')} AS pWetDays"""


@query("a21_wet_day_fraction_daily", with_lenses("daily", _WET + " FROM daily GROUP BY 1, 2"))
def a21_daily(spark, sf_dir):
    return rounded(I.wet_day_fraction(lens(spark, sf_dir, "daily"), ["cell_id"], "precip", 60.0), "pWetDays")


@query("a21_wet_day_fraction_hourly", with_lenses("hourly", """
, d AS (SELECT cell_id, day, coalesce(sum(CASE WHEN hour % 4 <> 0 THEN precip/1000 END), 0)*1000 AS precip FROM hourly GROUP BY 1, 2)
""" + _WET + " FROM d GROUP BY 1, 2"))
def a21_hourly(spark, sf_dir):
    hourly = lens(spark, sf_dir, "hourly").withColumn("precip", F.when(F.col("hour") % 4 != 0, F.col("precip") / 1000))
    return rounded(I.wet_day_fraction(I.daily_totals(hourly, ["cell_id"], "precip"), ["cell_id"], "precip", 60.0, 1000.0), "pWetDays")


_WETMONTHS = "SELECT cell_id, yearmon, month, (Pr - floor(Pr / 7) * 7) / 7 AS pWetDays FROM obs"


def _wetmonths(spark, sf_dir):
    return lens(spark, sf_dir, "obs").select(
        "cell_id", "yearmon", "month", ((F.col("Pr") - F.floor(F.col("Pr") / 7) * 7) / 7).alias("pWetDays"))


@query("a22_wet_day_longterm_mean", with_lenses("obs", f"""
, w AS ({_WETMONTHS})
SELECT cell_id, month, {rsql('avg(pWetDays)')} AS pWetDays FROM w WHERE yearmon BETWEEN 199601 AND 199912 GROUP BY 1, 2"""))
def a22(spark, sf_dir):
    years = _wetmonths(spark, sf_dir).where(F.col("yearmon").between(199601, 199912))
    return rounded(I.climate_norm(years, ["cell_id"], ["pWetDays"]), "pWetDays")


@query("a22b_wet_day_with_fallback", with_lenses("obs", f"""
, w AS ({_WETMONTHS})
, n AS (SELECT cell_id, month, avg(pWetDays) AS norm FROM w WHERE yearmon BETWEEN 199701 AND 200012 GROUP BY 1, 2)
SELECT w.cell_id, yearmon, {rsql('CASE WHEN yearmon < 199701 THEN norm ELSE pWetDays END')} AS pWetDays
FROM w LEFT JOIN n ON n.cell_id = w.cell_id AND n.month = w.month"""))
def a22b(spark, sf_dir):
    w = _wetmonths(spark, sf_dir).drop("month")
    return rounded(I.wet_days_with_fallback(w, w.select("cell_id", "yearmon"), ["cell_id"], 1997, (1997, 2000)), "pWetDays")


@query("a23_monthly_mean_temperature", with_lenses("hourly", f"""
, d AS (SELECT cell_id, day, min(precip) AS tmin, max(precip) AS tmax FROM hourly GROUP BY 1, 2)
SELECT cell_id, CAST(year(day)*100 + month(day) AS INT) AS yearmon, {rsql('avg(tmin)')} AS tmin, {rsql('avg(tmax)')} AS tmax,
       {rsql('avg((tmin + tmax) / 2)')} AS tavg FROM d GROUP BY 1, 2"""))
def a23(spark, sf_dir):
    d = lens(spark, sf_dir, "hourly").groupBy("cell_id", "day").agg(F.min("precip").alias("tmin"), F.max("precip").alias("tmax"))
    return rounded(I.monthly_mean_temperature(d, ["cell_id"]), "tmin", "tmax", "tavg")


@query("a24_monthly_precip_rate", with_lenses("daily", f"""
SELECT cell_id, CAST(year(day)*100 + month(day) AS INT) AS yearmon, {rsql('avg(precip * 10 / (day(last_day(day)) * 86400))', 9)} AS Pr
FROM daily GROUP BY 1, 2"""))
def a24(spark, sf_dir):
    return rounded(I.monthly_precip_rate(lens(spark, sf_dir, "daily"), ["cell_id"], "precip"), "Pr", digits=9)


@query("a25_mean_state", with_lenses("obs", f"""
SELECT cell_id, month, {rsql('avg(Ws)', 11)} AS Ws, {rsql('avg(Bt_RO)', 11)} AS Bt_RO FROM obs WHERE yearmon BETWEEN 199601 AND 200012 GROUP BY 1, 2"""))
def a25(spark, sf_dir):
    years = lens(spark, sf_dir, "obs").where(F.col("yearmon").between(199601, 200012))
    return rounded(I.climate_norm(years, ["cell_id"], ["Ws", "Bt_RO"]), "Ws", "Bt_RO", digits=11)


_SOIL = """
SELECT l_partkey AS unit, l_linenumber AS layer, l_quantity AS prop, (l_linenumber - 1) * 0.2e0 AS top_m,
       l_linenumber * 0.2e0 AS bottom_m, l_discount * 1000 AS tawc_mm FROM lineitem"""


@query("a26_soil_capacity", f"""
WITH s AS ({_SOIL}), l AS (SELECT unit, layer, sum(tawc_mm * (bottom_m - top_m) * prop) / sum(prop) AS c FROM s WHERE bottom_m <= 1e0 GROUP BY 1, 2)
, u AS (SELECT unit, sum(c) AS tawc FROM l GROUP BY 1)
SELECT p_partkey AS cell_id, {rsql('tawc')} AS tawc FROM part LEFT JOIN u ON unit = p_partkey""")
def a26(spark, sf_dir):
    layers = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("unit"), F.col("l_linenumber").alias("layer"), F.col("l_quantity").alias("prop"),
        ((F.col("l_linenumber") - 1) * 0.2).alias("top_m"), (F.col("l_linenumber") * 0.2).alias("bottom_m"),
        (F.col("l_discount") * 1000).alias("tawc_mm"))
    cells = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("cell_id"))
    units = I.soil_capacity(layers, 1.0)
    return rounded(cells.join(units, cells.cell_id == units.unit, "left").select("cell_id", "tawc"), "tawc")


_FACTORS = """, g AS (SELECT plant_id, fuel, capacity_mw,
   CASE WHEN plant_id % 3 = 0 THEN NULL ELSE generation_mw * 8.766 * 0.8e0 END AS g1,
   CASE WHEN plant_id % 3 = 1 THEN NULL WHEN plant_id % 7 = 0 THEN 0e0 ELSE generation_mw * 8.766 * 3 END AS g2,
   CASE WHEN plant_id % 2 = 1 THEN NULL ELSE generation_mw * 8.766 END AS est FROM plants)
, f AS (SELECT plant_id, fuel, CASE WHEN coalesce(g1, g2, est) IS NOT NULL AND capacity_mw > 0
        THEN least(1e0, coalesce(g1, g2, est) * 1000 / 24 / 365.25e0 / capacity_mw) END AS own FROM g)
, m AS (SELECT fuel, avg(own) AS fuel_mean FROM f WHERE own > 0 GROUP BY fuel)"""


@query("a27_capacity_factors", with_lenses("plants", _FACTORS + f"""
SELECT plant_id, {rsql('CASE WHEN own > 0 THEN own ELSE fuel_mean END')} AS capacity_factor FROM f JOIN m ON m.fuel = f.fuel"""))
def a27(spark, sf_dir):
    base = F.col("generation_mw") * 8.766
    p = lens(spark, sf_dir, "plants").withColumns({
        "g1": F.when(F.col("plant_id") % 3 != 0, base * 0.8),
        "g2": F.when(F.col("plant_id") % 3 == 1, None).when(F.col("plant_id") % 7 == 0, 0.0).otherwise(base * 3),
        "est": F.when(F.col("plant_id") % 2 == 0, base),
    })
    return rounded(I.capacity_factors(p, ["g1", "g2"], "est"), "capacity_factor")


# ---- trailing windows ---------------------------------------------------------------------------

def _window_sql(n: int, cols: dict[str, str]) -> str:
    """A self-join form, independent of window frames."""
    return f"""SELECT a.cell_id, a.month_index, {', '.join(rsql(e, 9) + ' AS ' + c for c, e in cols.items())}
FROM obs a JOIN obs b ON b.cell_id = a.cell_id AND b.month_index BETWEEN a.month_index - {n - 1} AND a.month_index
GROUP BY a.cell_id, a.month_index HAVING count(*) = {n}"""


@query("w1_rolling_integrate", with_lenses("obs", _window_sql(3, {
    "Pr_sum": "sum(b.Pr)", "T_ave": "avg(b.T)", "Ws_max": "max(b.Ws)", "RO_mm_median": "quantile_cont(b.RO_mm, 0.5e0)"})))
def w1(spark, sf_dir):
    out = W.rolling_integrate(lens(spark, sf_dir, "obs"), ["cell_id"], 3,
                              {"Pr": ("sum",), "T": ("ave",), "Ws": ("max",), "RO_mm": ("median",)})
    return rounded(out, "Pr_sum", "T_ave", "Ws_max", "RO_mm_median", digits=9)


_SEEN = "(CASE WHEN b.month <> 4 THEN b.T - 5 END)"
_ALL_STATS = {"sum": f"coalesce(sum({_SEEN}), 0)", "ave": f"avg({_SEEN})", "min": f"min({_SEEN})", "max": f"max({_SEEN})", "median": f"quantile_cont({_SEEN}, 0.5e0)",
              "q25": f"quantile_cont({_SEEN}, 0.25e0)", "num_defined": f"count({_SEEN})", "fraction_defined": f"count({_SEEN}) / count(*)",
              "fraction_defined_above_zero": f"count(*) FILTER ({_SEEN} > 0) / nullif(count({_SEEN}), 0)"}


@query("w1_all_stats", with_lenses("obs", _window_sql(3, {f"x_{n}": e for n, e in _ALL_STATS.items()})))
def w1_all(spark, sf_dir):
    obs = lens(spark, sf_dir, "obs").withColumn("x", F.when(F.col("month") != 4, F.col("T") - 5))
    out = W.rolling_integrate(obs, ["cell_id"], 3, {"x": tuple(_ALL_STATS)})
    return out.select("cell_id", "month_index", *[r(F.col(f"x_{n}").cast("double"), 9).alias(f"x_{n}") for n in _ALL_STATS])


def _rolled(n: int, p: str, name: str) -> str:
    """Weighted quantile of the last n months: months paired with the windows they are in, then the formula of the whole series."""
    base = f"""
, b{n} AS (SELECT a.cell_id * 100000 + a.month_index AS k, b.month_index AS layer, CASE WHEN b.month <> 4 THEN b.T END AS x, b.Ws AS w
          FROM obs a JOIN obs b ON b.cell_id = a.cell_id AND b.month_index BETWEEN a.month_index - {n - 1} AND a.month_index
          WHERE EXISTS (SELECT 1 FROM obs c WHERE c.cell_id = a.cell_id AND c.month_index BETWEEN a.month_index - {n - 1} AND a.month_index
                        HAVING count(*) = {n}))"""
    steps = _WQ.format(k="k", x="x", w="w", tie="layer", t=f"b{n}", p=p)
    for cte in ("i", "s", "nx", "q"):
        steps = steps.replace(f", {cte} AS (", f", {cte}{n} AS (").replace(f"FROM {cte} ", f"FROM {cte}{n} ").replace(f"FROM {cte})", f"FROM {cte}{n})")
    return base + steps + f""", {name} AS (SELECT DISTINCT b.k, q.v FROM b{n} b LEFT JOIN q{n} q ON q.k = b.k)"""


@query("w1_weighted_quantiles", with_lenses("obs", _rolled(12, "0.3e0", "r12") + _rolled(5, "0.3e0", "r5") + f"""
SELECT 12 AS "window", k // 100000 AS cell_id, CAST(k % 100000 AS INT) AS month_index, {rsql('v', 4)} AS x_weighted_q30 FROM r12
UNION ALL SELECT 5, k // 100000, CAST(k % 100000 AS INT), {rsql('v', 4)} FROM r5"""))
def w1_weighted(spark, sf_dir):
    obs = lens(spark, sf_dir, "obs").withColumn("x", F.when(F.col("month") != 4, F.col("T")))
    out = W.rolling_integrate_many(obs, ["cell_id"], [12, 5], {"x": ("weighted_q30",)}, weight="Ws")
    return rounded(out, "x_weighted_q30", digits=4)


_PLAN_COLS = {"Bt_RO_min": "min(b.Bt_RO)", "Bt_RO_max": "max(b.Bt_RO)", "Bt_RO_sum": "sum(b.Bt_RO)", "PETmE_sum": "sum(b.PETmE)",
              "Pr_sum": "sum(b.Pr)", "RO_mm_sum": "sum(b.RO_mm)", "T_ave": "avg(b.T)", "Ws_ave": "avg(b.Ws)"}


@query("w2_rolling_integrate_many", with_lenses("obs", "\nUNION ALL\n".join(
    f"(SELECT {n} AS \"window\", * FROM ({_window_sql(n, {'Pr_sum': 'sum(b.Pr)', 'T_ave': 'avg(b.T)'})}))" for n in I.WINDOWS)))
def w2(spark, sf_dir):
    out = W.rolling_integrate_many(lens(spark, sf_dir, "obs"), ["cell_id"], list(I.WINDOWS), {"Pr": ("sum",), "T": ("ave",)})
    return rounded(out, "Pr_sum", "T_ave", digits=9)


@query("w3_integration_plan", with_lenses("obs", _window_sql(12, _PLAN_COLS)))
def w3(spark, sf_dir):
    out = W.rolling_integrate(lens(spark, sf_dir, "obs"), ["cell_id"], 12)
    return rounded(out, *_PLAN_COLS, digits=9)


# forecast lens: every half-year is forecast in the month before it, and observed up to then
_FORECAST = """
, fm AS (SELECT *, CAST(floor(target / 100)*12 + target % 100 - 1 AS INT) AS month_index FROM members)
, fc AS (SELECT cell_id, CAST(floor(month_index / 6) * 6 - 1 AS INT) AS issue_index, model, member, month_index, Pr FROM fm)"""


def forecast_lens(spark, sf_dir):
    month = (F.floor(F.col("target") / 100) * 12 + F.col("target") % 100 - 1).cast("int")
    return lens(spark, sf_dir, "members").withColumn("month_index", month).select(
        "cell_id", (F.floor(F.col("month_index") / 6) * 6 - 1).cast("int").alias("issue_index"), "model", "member", "month_index", "Pr")


_J8 = _FORECAST + """
, e AS (SELECT DISTINCT cell_id, issue_index, model, member, month_index AS end_index FROM fc)
, j AS (SELECT e.*, obs.month_index, obs.Pr FROM e JOIN obs ON obs.cell_id = e.cell_id
          AND obs.month_index BETWEEN end_index - 3 AND least(end_index, e.issue_index)
        UNION ALL
        SELECT e.*, fc.month_index, fc.Pr FROM e JOIN fc ON fc.cell_id = e.cell_id AND fc.model = e.model AND fc.member = e.member AND fc.issue_index = e.issue_index
          AND fc.month_index BETWEEN greatest(end_index - 3, e.issue_index + 1) AND end_index)
"""


@query("j8_observed_plus_forecast", with_lenses("obs members", _J8 + f"""
SELECT cell_id, issue_index, model, member, end_index, month_index, {rsql('Pr')} AS Pr FROM j"""))
def j8(spark, sf_dir):
    return rounded(W.observed_plus_forecast(lens(spark, sf_dir, "obs"), forecast_lens(spark, sf_dir), "issue_index", 4, ["cell_id"], ["Pr"]), "Pr")


@query("w4_rolling_forecast", with_lenses("obs members", _J8 + f"""
SELECT cell_id, issue_index, model, member, end_index, {rsql('sum(Pr)')} AS Pr_sum, {rsql('quantile_cont(Pr, 0.5e0)')} AS Pr_median
FROM j GROUP BY 1, 2, 3, 4, 5 HAVING count(*) = 4"""))
def w4(spark, sf_dir):
    out = W.rolling_forecast(lens(spark, sf_dir, "obs"), forecast_lens(spark, sf_dir), "issue_index", 4, ["cell_id"], {"Pr": ("sum", "median")})
    return rounded(out, "Pr_sum", "Pr_median")


def _w4_sql(n: int) -> str:
    return _J8.replace("end_index - 3", f"end_index - {n - 1}") + f"""
SELECT cell_id, issue_index, model, member, end_index, {rsql('sum(Pr)')} AS Pr_sum, {rsql('avg(Pr)')} AS Pr_ave, {rsql('max(Pr)')} AS Pr_max,
       {rsql('quantile_cont(Pr, 0.9e0)')} AS Pr_q90, count(Pr) AS Pr_num_defined
FROM j GROUP BY 1, 2, 3, 4, 5 HAVING count(*) = {n}"""


@query("w4_rolling_forecast_of_five_years", with_lenses("obs members", _w4_sql(60)))
def w4_long(spark, sf_dir):
    out = W.rolling_forecast(lens(spark, sf_dir, "obs"), forecast_lens(spark, sf_dir), "issue_index", 60, ["cell_id"],
                             {"Pr": ("sum", "ave", "max", "q90", "num_defined")})
    return rounded(out, "Pr_sum", "Pr_ave", "Pr_max", "Pr_q90")

"""Agriculture sector."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import crops as X
from ..lenses import lens, table, with_lenses
from ..operators import crops as G
from ..operators import joins as J
from ..session import cut_lineage
from . import sqltext as S
from .registry import query, r, rounded, rsql

# every calendar cell in every month: start and end as days of a 365-day year; some dates are missing
_CM = """
, cm AS (SELECT cell_id, CASE WHEN cell_id % 13 = 5 THEN NULL ELSE plant_doy END AS p, CASE WHEN cell_id % 17 = 9 THEN plant_doy ELSE harvest_doy END AS h, m,
         CAST(dayofyear(make_date(2001, m, 1)) AS INT) AS f, CAST(dayofyear(last_day(make_date(2001, m, 1))) AS INT) AS t FROM calendar, range(1, 13) x(m))
, k AS (SELECT *, p IS NOT NULL AND h IS NOT NULL AS known FROM cm)"""


def _months(spark, sf_dir):
    k = F.col("cell_id")
    cal = lens(spark, sf_dir, "calendar").select(
        "cell_id", F.when(k % 13 != 5, F.col("plant_doy")).alias("p"), F.when(k % 17 == 9, F.col("plant_doy")).otherwise(F.col("harvest_doy")).alias("h"))
    out = J.combos(cal, m=list(range(1, 13)))
    return out.withColumns({"f": C.start_of_month(F.col("m")), "t": C.end_of_month(F.col("m"))})




def _args():
    return F.col("f"), F.col("t"), F.col("p"), F.col("h")


_ON = "CASE WHEN h > p THEN {d} >= p AND {d} <= h ELSE {d} >= p OR {d} <= h END"


@query("g1_is_growing_season", with_lenses("calendar", _CM + f"""
SELECT cell_id, CAST(m AS INT) AS m, CASE WHEN known THEN {_ON.format(d='f')} END AS day_in_season FROM k"""))
def g1(spark, sf_dir):
    return _months(spark, sf_dir).select("cell_id", "m", X.is_growing_season(F.col("f"), F.col("p"), F.col("h")).alias("day_in_season"))


# brute force: the 365 days of every month and season are looked at one by one
@query("g2_days_in_season", with_lenses("calendar", _CM + f"""
, d AS (SELECT cell_id, m, p, h, f, t, known, d, {_ON.format(d='d')} AS grows FROM k, range(1, 366) y(d))
, a AS (SELECT cell_id, m, any_value(known) AS known, any_value(p) AS p, any_value(h) AS h, any_value(f) AS f,
   coalesce(min(CASE WHEN grows AND d >= f AND (d <= t OR h < p) THEN d END), min(CASE WHEN grows AND d <= t AND h < p THEN d END)) AS first_day,
   max(CASE WHEN grows AND d <= t AND (d >= f OR h < p) THEN d END) AS last_day FROM d GROUP BY cell_id, m)
SELECT cell_id, CAST(m AS INT) AS m, CAST(CASE WHEN known AND {_ON.format(d='f')} THEN (f - p + 365) % 365 END AS INT) AS since, CAST(CASE WHEN known AND {_ON.format(d='f')} THEN (h - f + 365) % 365 END AS INT) AS until,
       CAST(CASE WHEN known THEN first_day END AS INT) AS first_day, CAST(CASE WHEN known THEN last_day END AS INT) AS last_day FROM a"""))
def g2(spark, sf_dir):
    f, t, p, h = _args()
    return _months(spark, sf_dir).select("cell_id", "m", X.days_since_planting(f, p, h).alias("since"), X.days_until_harvest(f, p, h).alias("until"),
                                         X.first_growing_day(f, t, p, h).alias("first_day"), X.last_growing_day(f, t, p, h).alias("last_day"))


@query("g3_growing_days", with_lenses("calendar", _CM + f"""
, d AS (SELECT cell_id, m, count(*) FILTER (h > p AND d BETWEEN p AND h OR h <= p AND d <= h) AS this_year, count(*) FILTER (h <= p AND d >= p) AS next_year
        FROM k, range(1, 366) y(d) WHERE d BETWEEN f AND t GROUP BY 1, 2)
, s AS (SELECT *, CASE WHEN p > f AND p <= t THEN p ELSE f END AS b FROM k)
, e AS (SELECT *, CASE WHEN h >= b AND h <= t THEN h ELSE t END AS e FROM s)
SELECT k.cell_id, CAST(k.m AS INT) AS m, CAST(CASE WHEN known THEN CASE WHEN {_ON.format(d='e')} THEN e - b + 1 ELSE 0 END END AS INT) AS this_season,
       CAST(CASE WHEN known THEN this_year END AS INT) AS this_year, CAST(CASE WHEN known THEN next_year END AS INT) AS next_year
FROM e k JOIN d ON d.cell_id = k.cell_id AND d.m = k.m"""))
def g3(spark, sf_dir):
    a = _args()
    return _months(spark, sf_dir).select("cell_id", "m", X.growing_days_this_season(*a).alias("this_season"), X.growing_days_this_year(*a).alias("this_year"),
                                         X.growing_days_next_year(*a).alias("next_year"))


@query("g4_days_since_planting", with_lenses("calendar", _CM + """
SELECT cell_id, CAST(m AS INT) AS m,
  CAST(CASE WHEN NOT known THEN NULL WHEN p < h THEN CASE WHEN t < p OR f > h THEN 0 ELSE least(t, h) - p + 1 END
       WHEN f > h AND t < p THEN 0 WHEN t > p THEN t - p + 1 ELSE 366 - p + least(t, h) END AS INT) AS this_season,
  CAST(CASE WHEN NOT known THEN NULL WHEN f > h THEN 0 WHEN h > p THEN greatest(0, least(t, h) - p + 1) ELSE 366 - p + least(t, h) END AS INT) AS this_year,
  CAST(CASE WHEN NOT known THEN NULL WHEN h > p THEN 0 ELSE greatest(0, t - p + 1) END AS INT) AS next_year,
  p < h AND p BETWEEN f AND t AS planted_this, p > h AND p BETWEEN f AND t AS planted_next,
  CAST(CASE WHEN h > p THEN h - p + 1 ELSE h + 366 - p END AS INT) AS season_length FROM k"""))
def g4(spark, sf_dir):
    a = _args()
    return _months(spark, sf_dir).select(
        "cell_id", "m", X.days_since_planting_this_season(*a).alias("this_season"), X.days_since_planting_this_year(*a).alias("this_year"),
        X.days_since_planting_next_year(*a).alias("next_year"), X.planted_for_this_year(*a).alias("planted_this"), X.planted_for_next_year(*a).alias("planted_next"),
        X.growing_season_length(F.col("p"), F.col("h")).alias("season_length"))


_UNITS = """
WITH u AS (SELECT p_partkey % 200 AS unit_code, CAST(p_size % 3 + 1 AS INT) AS crop, CAST(p_partkey % 2 + 1 AS INT) AS subcrop,
     sum(CASE WHEN p_size % 11 = 0 THEN 0e0 ELSE p_retailprice END) AS area_ha, CAST(min(p_size % 12 + 1) AS INT) AS plant_month, CAST(max(p_size % 12 + 1) AS INT) AS harvest_month FROM part GROUP BY ALL)
, fr AS (SELECT unit_code, crop, subcrop, plant_month, harvest_month, area_ha / nullif(sum(area_ha) OVER (PARTITION BY unit_code, crop), 0) AS area_frac FROM u)
, af AS (SELECT * FROM fr WHERE area_frac IS NOT NULL)"""


def _units(spark, sf_dir):
    s = F.col("p_size")
    return table(spark, sf_dir, "part").groupBy((F.col("p_partkey") % 200).alias("unit_code"), (s % 3 + 1).alias("crop"), (F.col("p_partkey") % 2 + 1).cast("int").alias("subcrop")).agg(
        F.sum(F.when(s % 11 == 0, 0.0).otherwise(F.col("p_retailprice"))).alias("area_ha"), F.min(s % 12 + 1).alias("plant_month"), F.max(s % 12 + 1).alias("harvest_month"))


@query("g5_area_fractions", _UNITS + f"SELECT unit_code, crop, subcrop, plant_month, harvest_month, {rsql('area_frac')} AS area_frac FROM af")
def g5(spark, sf_dir):
    return rounded(G.area_fractions(_units(spark, sf_dir)), "area_frac")


_DEFAULTS = _UNITS + """
, pr AS (SELECT unit_code, c AS crop, s AS subcrop FROM (SELECT DISTINCT unit_code FROM af), (VALUES (1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (3, 2), (3, 3), (4, 1)) v(c, s))
, df AS (SELECT pr.unit_code, pr.crop, pr.subcrop, plant_month, harvest_month, CASE WHEN max(CASE WHEN area_frac IS NOT NULL THEN 1 END) OVER (PARTITION BY pr.unit_code, pr.crop) = 1 THEN coalesce(area_frac, 0) END AS area_frac
         FROM pr LEFT JOIN af ON af.unit_code = pr.unit_code AND af.crop = pr.crop AND af.subcrop = pr.subcrop)"""
_COUNTS = {1: 2, 2: 2, 3: 3, 4: 1}


def _defaults(spark, sf_dir):
    return G.default_area_fractions(G.area_fractions(_units(spark, sf_dir)), _COUNTS)


@query("g6_default_area_fractions", _DEFAULTS + f"SELECT unit_code, crop, subcrop, plant_month, harvest_month, {rsql('area_frac')} AS area_frac FROM df")
def g6(spark, sf_dir):
    return rounded(_defaults(spark, sf_dir), "area_frac")


_GRIDLENS = """, grid AS (SELECT p_partkey AS cell_id, CAST(FLOOR(p_partkey / 40.0e0) AS INT) AS row_no, CAST(p_partkey % 40 AS INT) AS col_no, p_size, p_retailprice FROM part)"""
_MD = """1 + floor(CASE WHEN atan2(sum(sin({a})), sum(cos({a}))) < 0 THEN atan2(sum(sin({a})), sum(cos({a}))) + 2 * pi() ELSE atan2(sum(sin({a})), sum(cos({a}))) END / (2 * pi() / 365) + 0.5e0 + 1e-9)"""


def _mean_doy_sql(e):
    v = _MD.format(a=f"(({e}) - 1) * 2 * pi() / 365")
    return f"CAST(CASE WHEN {v} > 365 THEN {v} - 365 ELSE {v} END AS INT)"


@query("g7_calendar_grid", _DEFAULTS + _GRIDLENS + f"""
, dt AS (SELECT *, dayofyear(make_date(2001, plant_month, 1)) AS pd, dayofyear(last_day(make_date(2001, harvest_month, 1))) AS hd FROM df)
SELECT CAST(row_no // 4 AS INT) AS row_no, CAST(col_no // 4 AS INT) AS col_no, crop, subcrop, {_mean_doy_sql('pd')} AS plant_doy, {_mean_doy_sql('hd')} AS harvest_doy, {rsql('avg(area_frac)')} AS area_frac
FROM grid JOIN dt ON unit_code = cell_id * 7 % 200 GROUP BY 1, 2, 3, 4""")
def g7(spark, sf_dir):
    regions = lens(spark, sf_dir, "grid").select("row_no", "col_no", (F.col("cell_id") * 7 % 200).alias("unit_code"))
    return rounded(G.calendar_grid(regions, _defaults(spark, sf_dir), 4), "area_frac")


@query("g8_allocate_production", f"""
WITH pr AS (SELECT CAST(p_partkey // 40 AS INT) AS row_no, CAST(p_partkey % 40 AS INT) AS col_no, s AS source, CASE WHEN p_size % 6 = 1 THEN NULL ELSE p_retailprice * w END AS production
            FROM part, (VALUES ('whea', 1), ('maiz', 2), ('pmil', 3), ('smil', 4), ('tobacco', 5)) v(s, w))
, so(source, crop) AS (VALUES ('whea', 'wheat'), ('maiz', 'maize'), ('pmil', 'millet'), ('smil', 'millet'))
, nm(crop, name, n) AS (VALUES ('wheat', 'wheat_1', 2), ('wheat', 'wheat_2', 2), ('maize', 'maize_1', 2), ('maize', 'maize_2', 2), ('millet', 'millet', 1))
, cr AS (SELECT row_no, col_no, crop, coalesce(sum(production), 0) AS production FROM pr JOIN so ON so.source = pr.source GROUP BY 1, 2, 3)
, fr AS (SELECT DISTINCT row_no // 4 AS rr, col_no // 4 AS cc, nm.name, CASE WHEN (row_no // 4 + col_no // 4) % 3 = 0 THEN NULL ELSE 0.25e0 * (1 + length(nm.name) % 2) END AS area_frac FROM pr, nm)
SELECT cr.row_no, cr.col_no, nm.name, {rsql('cr.production * CASE WHEN n > 1 THEN coalesce(area_frac, 0) ELSE 1 END')} AS production
FROM cr JOIN nm ON nm.crop = cr.crop LEFT JOIN fr ON rr = row_no // 4 AND cc = col_no // 4 AND fr.name = nm.name""")
def g8(spark, sf_dir):
    cells = table(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 40).cast("int").alias("row_no"), (F.col("p_partkey") % 40).cast("int").alias("col_no"), "p_size", "p_retailprice")
    weights = {"whea": 1, "maiz": 2, "pmil": 3, "smil": 4, "tobacco": 5}
    prod = J.combos(cells, source=list(weights)).withColumn("_w", F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])[F.col("source")]).select(
        "row_no", "col_no", "source", F.when(F.col("p_size") % 6 != 1, F.col("p_retailprice") * F.col("_w")).alias("production"))
    names = G.subcrops(spark).select("crop_id", "name", "n_subcrops")
    blocks = cells.select(F.floor(F.col("row_no") / 4).cast("int").alias("row_no"), F.floor(F.col("col_no") / 4).cast("int").alias("col_no")).distinct()
    fr = J.combos(blocks, name=["wheat_1", "wheat_2", "maize_1", "maize_2", "millet"]).withColumn(
        "area_frac", F.when((F.col("row_no") + F.col("col_no")) % 3 != 0, 0.25 * (1 + F.length("name") % 2)))
    return rounded(G.allocate_production(prod, G.production_crop_table(spark), names, fr, 4), "production")


# monthly stresses of every calendar cell: the return periods come from the observations
_STRESS = """
, cal AS (SELECT cell_id AS c, CASE WHEN cell_id % 13 = 5 THEN NULL ELSE plant_doy END AS p, harvest_doy AS h FROM calendar WHERE cell_id < (SELECT max(cell_id) + 1 FROM obs))
, st AS (SELECT o.cell_id, month_index, month, CASE WHEN month = 8 THEN NULL ELSE Pr / 5 END AS heat, Ws AS cold, p, h FROM obs o JOIN cal ON c = o.cell_id)"""


def _stress(spark, sf_dir):
    obs = lens(spark, sf_dir, "obs").select("cell_id", "month_index", F.when(F.col("month") != 8, F.col("Pr") / 5).alias("heat"), F.col("Ws").alias("cold"))
    cal = lens(spark, sf_dir, "calendar").select("cell_id", F.when(F.col("cell_id") % 13 != 5, F.col("plant_doy")).alias("plant_doy"), "harvest_doy")
    return obs.join(cal, "cell_id")


_LF = "CASE WHEN {x} >= 80 THEN 1e0 WHEN {x} <= 30 THEN 0e0 ELSE pow(({x} - 30) / 50e0, 1.3e0) END"
_G9 = _STRESS + f"""
, ls AS (SELECT *, month_index // 12 AS y, least(1, greatest({_LF.format(x='coalesce(heat, 0)')}, {_LF.format(x='coalesce(cold, 0)')})) AS loss,
         dayofyear(make_date(2001, month, 1)) AS f, dayofyear(last_day(make_date(2001, month, 1))) AS t FROM st)
, gd AS (SELECT *, t - f + 1 AS dim, CASE WHEN p IS NOT NULL THEN greatest(0, least(t, h) - CASE WHEN h > p AND f < p THEN p ELSE f END + 1) END AS this,
         CASE WHEN p IS NULL THEN NULL WHEN h > p THEN 0 ELSE greatest(0, t - greatest(f, p) + 1) END AS nxt FROM ls)
, fa AS (SELECT *, CASE WHEN p IS NULL THEN NULL WHEN f0 > h THEN 0 WHEN h > p THEN greatest(0, least(t, h) - p + 1) ELSE 366 - p + least(t, h) END AS s_this,
         CASE WHEN p IS NULL THEN NULL WHEN h > p THEN 0 ELSE greatest(0, t - p + 1) END AS s_next FROM (SELECT *, 1 AS f0 FROM gd))
, ag AS (SELECT a.cell_id, a.month_index, any_value(a.loss) AS loss, any_value(a.p) AS p, any_value(a.this) AS this, any_value(a.nxt) AS nxt, any_value(a.s_this) AS s_this, any_value(a.s_next) AS s_next,
   sum(CASE WHEN b.y = a.y THEN b.loss * b.this WHEN a.h < a.p THEN b.loss * b.nxt ELSE 0 END) AS d_this, sum(CASE WHEN b.y = a.y THEN b.loss * b.nxt ELSE 0 END) AS d_next,
   product(CASE WHEN b.y = a.y THEN 1 - b.loss * b.this / b.dim WHEN a.h < a.p THEN 1 - b.loss * b.nxt / b.dim ELSE 1 END) AS r_this,
   product(CASE WHEN b.y = a.y THEN 1 - b.loss * b.nxt / b.dim ELSE 1 END) AS r_next
   FROM fa a JOIN fa b ON b.cell_id = a.cell_id AND (b.y = a.y AND b.month_index <= a.month_index OR b.y = a.y - 1) GROUP BY 1, 2)"""


@query("g9_cumulative_crop_loss", with_lenses("obs calendar", _G9 + f"""
SELECT cell_id, month_index, {rsql('CASE WHEN this >= 1 OR nxt >= 1 THEN loss END')} AS loss,
  {rsql('CASE WHEN p IS NOT NULL THEN CASE WHEN s_this > 0 THEN d_this / s_this ELSE 0 END END')} AS mean_loss_current_year,
  {rsql('CASE WHEN p IS NOT NULL THEN CASE WHEN s_next > 0 THEN d_next / s_next ELSE 0 END END')} AS mean_loss_next_year,
  {rsql('CASE WHEN p IS NOT NULL THEN greatest(1 - r_this / (1 - s_this * 0.001e0 - s_this * s_this * 0.000001e0), -1) END')} AS cumulative_loss_current_year,
  {rsql('CASE WHEN p IS NOT NULL THEN greatest(1 - r_next / (1 - s_next * 0.001e0 - s_next * s_next * 0.000001e0), -1) END')} AS cumulative_loss_next_year FROM ag"""))
def g9(spark, sf_dir):
    out = G.cumulative_crop_loss(_stress(spark, sf_dir), ["cell_id"], ["heat", "cold"], 30.0, 80.0, 1.3, "max", (0.001, 0.000001))
    return rounded(out, *[c for c in out.columns if "loss" in c])


_OLD = "CASE WHEN x >= 70 THEN 1e0 WHEN x <= 6 THEN 0e0 ELSE 1 - pow((70 - x) / 64, 1.4e0) END"


@query("g10_loss_function", with_lenses("obs", f"""
, x AS (SELECT cell_id, yearmon, CASE WHEN month = 8 THEN NULL ELSE Pr / 5 END AS x, Ws AS y FROM obs)
SELECT cell_id, yearmon, {rsql('CASE WHEN x IS NOT NULL THEN ' + _LF.format(x='x') + ' END')} AS loss, {rsql('CASE WHEN x IS NOT NULL THEN ' + _OLD + ' END')} AS old_loss,
  {rsql('least(1, ' + _LF.format(x='coalesce(x, 0)') + ' + ' + _LF.format(x='y') + ')')} AS both_losses FROM x"""))
def g10(spark, sf_dir):
    x, y = F.col("x"), F.col("y")
    df = lens(spark, sf_dir, "obs").select("cell_id", "yearmon", F.when(F.col("month") != 8, F.col("Pr") / 5).alias("x"), F.col("Ws").alias("y"))
    both = X.combine_losses([X.loss_function(F.coalesce(x, F.lit(0.0)), 30, 80, 1.3), X.loss_function(y, 30, 80, 1.3)], "sum")
    return df.select("cell_id", "yearmon", r(X.loss_function(x, 30, 80, 1.3)).alias("loss"), r(X.loss_function_old(x)).alias("old_loss"), r(both).alias("both_losses"))


def _curve_sql(x, knots):
    out = f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} < {knots[0][0]} THEN 1e0"
    for (x0, y0), (x1, y1) in zip(knots, knots[1:]):
        out += f" WHEN {x} < {x1} THEN {y0}e0 + ({x} - {x0}) * ({y1}e0 - {y0}e0) / ({x1} - {x0})"
    return out + f" WHEN {x} = {knots[-1][0]} THEN {knots[-1][1]}e0 ELSE 1e0 END"


_EARLY, _LATE = [(10, 1.25), (30, 1.5), (60, 0.5)], [(5, 0.75), (45, 2.0)]


@query("g11_loss_multipliers", with_lenses("calendar", _CM + f"""
, s AS (SELECT cell_id, m, CASE WHEN known AND {_ON.format(d='f')} THEN (f - p + 365) % 365 END AS a, CASE WHEN known AND {_ON.format(d='f')} THEN (h - f + 365) % 365 END AS b FROM k)
SELECT cell_id, CAST(m AS INT) AS m, {rsql('1 / (1 - m * 0.002e0 - m * m * 0.00001e0)')} AS initial, {rsql('1 + 0.1e0 * (m - 1)')} AS duration,
  {rsql('CASE WHEN a IS NULL OR b IS NULL THEN NULL ELSE greatest(' + _curve_sql('a', _EARLY) + ', ' + _curve_sql('b', _LATE) + ') END')} AS stage FROM s"""))
def g11(spark, sf_dir):
    m = F.col("m")
    df = _months(spark, sf_dir)
    stage = X.growth_stage_multiplier(F.col("f"), F.col("p"), F.col("h"), _EARLY, _LATE)
    return df.select("cell_id", "m", r(X.initial_fraction(m, 0.002, 0.00001)).alias("initial"), r(X.duration_multiplier(m)).alias("duration"), r(stage).alias("stage"))


_PROD = """
, pr AS (SELECT l_suppkey AS id, CASE l_linestatus WHEN 'O' THEN 'irrigated' ELSE 'rainfed' END AS method, CASE l_returnflag WHEN 'A' THEN 'maize' WHEN 'N' THEN 'wheat' ELSE 'cotton' END AS crop,
         CASE l_returnflag WHEN 'A' THEN 'maize_' WHEN 'N' THEN 'wheat_' ELSE 'cotton_' END || (l_linenumber % 2 + 1) AS subcrop,
         sum(CASE WHEN l_suppkey % 10 = 0 AND l_returnflag = 'R' THEN 0e0 ELSE l_quantity END) AS production, avg(l_discount) AS d FROM lineitem GROUP BY ALL)
, lo AS (SELECT id, method, crop, subcrop, q AS quantile, CASE WHEN id % 9 = 4 AND q > 0.6e0 AND method = 'rainfed' AND crop = 'wheat' THEN NULL ELSE production * d * q END AS loss FROM pr, (VALUES (0.25e0), (0.5e0), (0.75e0)) v(q))
, j AS (SELECT lo.*, production, crop <> 'cotton' AS food FROM lo JOIN pr USING (id, method, crop, subcrop))
, g AS (SELECT CASE WHEN grouping(crop) = 0 THEN 'crop' WHEN grouping(food) = 0 THEN 'type' ELSE 'overall' END AS level, id, quantile, crop, food,
        CASE WHEN sum(production) > 0 AND count(*) = count(loss) THEN sum(loss) / sum(production) END AS loss, sum(production) AS production
        FROM j GROUP BY GROUPING SETS ((id, quantile, crop), (id, quantile, food), (id, quantile)))"""


def _crop_summary(spark, sf_dir):
    crop = F.when(F.col("l_returnflag") == "A", "maize").when(F.col("l_returnflag") == "N", "wheat").otherwise("cotton")
    base = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("id"), F.when(F.col("l_linestatus") == "O", "irrigated").otherwise("rainfed").alias("method"), crop.alias("crop"),
        F.concat_ws("_", crop, (F.col("l_linenumber") % 2 + 1).cast("string")).alias("subcrop"), "l_discount",
        F.when((F.col("l_suppkey") % 10 == 0) & (F.col("l_returnflag") == "R"), 0.0).otherwise(F.col("l_quantity")).alias("q"))
    pr = base.groupBy("id", "method", "crop", "subcrop").agg(F.sum("q").alias("production"), F.avg("l_discount").alias("d"))
    gap = (F.col("id") % 9 == 4) & (F.col("quantile") > 0.6) & (F.col("method") == "rainfed") & (F.col("crop") == "wheat")
    loss = J.combos(pr, quantile=[0.25, 0.5, 0.75]).withColumn("loss", F.when(~gap, F.col("production") * F.col("d") * F.col("quantile"))).drop("production", "d")
    return G.summarize_crop_loss(pr.drop("d"), loss, G.crop_table(spark))


@query("g12_summarize_crop_loss", with_lenses("layers", _PROD + f"SELECT level, id, quantile, crop, food, {rsql('loss')} AS loss, {rsql('production')} AS production FROM g"))
def g12(spark, sf_dir):
    return rounded(_crop_summary(spark, sf_dir), "loss", "production")


@query("g13_format_crop_loss", with_lenses("layers", _PROD + f"""
, c AS (SELECT id, crop, {', '.join(rsql(f"max(loss) FILTER (round(quantile * 100) = {q})") + f' AS loss_q{q}' for q in (25, 50, 75))} FROM g WHERE level = 'crop' GROUP BY 1, 2)
, o AS (SELECT id, {rsql("max(loss) FILTER (round(quantile * 100) = 50)")} AS loss_overall_q50 FROM g WHERE level = 'overall' GROUP BY 1)
, t AS (SELECT id, {rsql("max(loss) FILTER (round(quantile * 100) = 50 AND food)")} AS loss_food_q50, {rsql("max(loss) FILTER (round(quantile * 100) = 50 AND NOT food)")} AS loss_non_food_q50 FROM g WHERE level = 'type' GROUP BY 1)
SELECT * FROM c JOIN o USING (id) JOIN t USING (id)"""))
def g13(spark, sf_dir):
    s = _crop_summary(spark, sf_dir)
    out = G.format_crop_loss(s, "crop", [25, 50, 75]).join(G.format_crop_loss(s, "overall", [50]), "id").join(G.format_crop_loss(s, "type", [50]), "id")
    return rounded(out, *[c for c in out.columns if c.startswith("loss_")])


@query("g14_unpivot_results", with_lenses("obs", f"""
, w AS (SELECT cell_id, sum(Pr) AS a, avg(T) AS b, max(Ws) AS c FROM obs GROUP BY 1)
SELECT cell_id AS id, 'loss' AS variable, 'irrigated' AS method, 'maize' AS crop, 'maize_1' AS subcrop, 0.25e0 AS quantile, {rsql('a')} AS value FROM w
UNION ALL SELECT cell_id, 'cumulative_loss', 'rainfed', 'cotton', 'cotton', NULL, {rsql('b')} FROM w
UNION ALL SELECT cell_id, 'loss', 'rainfed', 'wheat', 'wheat_2', 0.75e0, {rsql('c')} FROM w"""))
def g14(spark, sf_dir):
    wide = lens(spark, sf_dir, "obs").groupBy("cell_id").agg(
        F.sum("Pr").alias("loss_irrigated_maize_1_q25"), F.avg("T").alias("cumulative_loss_rainfed_cotton"), F.max("Ws").alias("loss_rainfed_wheat_2_q75"))
    return rounded(G.unpivot_results(wide, ["loss", "cumulative_loss"], "cell_id"), "value")


_IRR = """
, pr AS (SELECT cell_id, row_no, col_no, CASE WHEN cell_id % 5 = 0 THEN NULL ELSE value * (cell_id % 7) END AS irrigated, CASE WHEN cell_id % 11 = 0 THEN NULL ELSE value * 2 END AS rainfed FROM grid)
, fr AS (SELECT row_no // 4 AS row_no, col_no // 4 AS col_no, avg(irrigated / nullif(CASE WHEN coalesce(irrigated, rainfed) IS NOT NULL THEN coalesce(irrigated, 0) + coalesce(rainfed, 0) END, 0)) AS f FROM pr GROUP BY 1, 2)"""


@query("g15_dominant_calendar", with_lenses("grid", _IRR + f"""
SELECT CAST(row_no AS INT) AS row_no, CAST(col_no AS INT) AS col_no, {rsql('f')} AS irrigated_fraction, CAST(CASE WHEN f >= 0.5 THEN 10 + row_no WHEN f < 0.5 THEN 100 + col_no END AS INT) AS plant_doy,
       CAST(CASE WHEN f >= 0.5 THEN 200 + row_no WHEN f < 0.5 THEN 300 + col_no END AS INT) AS harvest_doy FROM fr"""))
def g15(spark, sf_dir):
    k = F.col("cell_id")
    prod = lens(spark, sf_dir, "grid").select("row_no", "col_no", F.when(k % 5 != 0, F.col("value") * (k % 7)).alias("irrigated"), F.when(k % 11 != 0, F.col("value") * 2).alias("rainfed"))
    fraction = G.irrigated_fraction(prod, 4, [])
    keys = ["row_no", "col_no"]
    irrigated = fraction.select(*keys, (F.col("row_no") + 10).alias("plant_doy"), (F.col("row_no") + 200).alias("harvest_doy"))
    rainfed = fraction.select(*keys, (F.col("col_no") + 100).alias("plant_doy"), (F.col("col_no") + 300).alias("harvest_doy"))
    return rounded(G.dominant_calendar(fraction, irrigated, rainfed, keys), "irrigated_fraction")


_ANOM = {"T_sa": "(T - 5) / 2", "RO_mm_sa": "(RO_mm - 38) / 8", "Ws_sa": "(Ws - 42) / 6", "Bt_RO_sa": "(Bt_RO * 1000 - 200) / 90", "Pr_sa": "(Pr - 180) / 70", "PETmE_sa": "(PETmE - 4) / 2"}


def _anoms_sql():
    return ", an AS (SELECT cell_id, month_index, " + ", ".join(f"CASE WHEN month = 4 THEN NULL ELSE {e} END AS {n}" for n, e in _ANOM.items()) + " FROM obs)"


def _features(spark, sf_dir, harvest):
    obs = lens(spark, sf_dir, "obs")
    anoms = obs.select("cell_id", "month_index", *[F.when(F.col("month") != 4, F.expr(e)).alias(n) for n, e in _ANOM.items()])
    cal = lens(spark, sf_dir, "calendar").select(
        "cell_id", "crop", F.when(F.col("cell_id") % 6 != 1, F.col("plant_doy")).alias("plant_doy"), "harvest_doy", (F.col("cell_id") % 10 / 10.0).alias("irrigated_fraction"))
    return G.yield_features(anoms, cal, 200104, harvest, list(_ANOM))


_CELLS = """, cal AS (SELECT cell_id, crop, CAST(month(DATE '2001-01-01' + (plant_doy - 1)) AS INT) AS pm, CAST(month(DATE '2001-01-01' + (harvest_doy - 1)) AS INT) AS hm,
  cell_id % 10 / 10e0 AS irrigated_fraction FROM calendar WHERE cell_id % 6 <> 1)
, lg AS (SELECT c.cell_id, crop, pm, hm, irrigated_fraction, b, """ + ", ".join(f"CASE WHEN an.cell_id IS NULL THEN 0e0 ELSE coalesce({n}, 0e0) END AS {n}" for n in _ANOM) + """
  FROM cal c CROSS JOIN range(12) t(b) LEFT JOIN an ON an.cell_id = c.cell_id AND an.month_index = {base} + hm - b)"""


@query("g16_yield_features", with_lenses("obs calendar", _anoms_sql() + _CELLS.replace("{base}", str(2001 * 12 - 1)) + f"""
SELECT cell_id, crop, any_value(irrigated_fraction) AS irrigated_fraction, 'current_year' AS harvest,
  {', '.join(rsql(f"max(CASE WHEN b = {b} THEN {S.cdf(n)} END)", 5) + f' AS {n}_{b}' for n in _ANOM for b in range(12))},
  {', '.join(f"CAST(max(CASE WHEN hm > pm THEN CASE WHEN hm - {b} >= pm AND hm - {b} <= hm THEN 1 ELSE 0 END ELSE 1 END) AS INT) AS in_season_{b}" for b in range(12))}
FROM lg GROUP BY 1, 2"""))
def g16(spark, sf_dir):
    out = _features(spark, sf_dir, "current_year")
    return rounded(out, *[f"{n}_{b}" for n in _ANOM for b in range(12)], digits=5)


@query("g17_score_yield")
def g17(spark, sf_dir):
    # yields to learn from are made of the features, so the forest has something to find
    now = _features(spark, sf_dir, "current_year").withColumn("truth", F.col("Pr_sa_0") - 0.5 * F.col("T_sa_2") + 0.1 * F.col("irrigated_fraction"))
    now = cut_lineage(now)  # read by every level of every tree
    inputs = [f"{n}_{b}" for n in _ANOM for b in range(12)] + [f"in_season_{b}" for b in range(12)] + ["irrigated_fraction"]
    models = {c: G.fit_yield_model(now.where(F.col("crop") == c), inputs, "truth", trees=5) for c in ("maize", "wheat", "cotton")}
    return G.score_yield(_features(spark, sf_dir, "next_year"), models).select("cell_id", "crop", "harvest", r("yield").alias("yield"))


_YP = """
, pr AS (SELECT cell_id, crop || '_' || s AS subcrop, crop, CASE WHEN cell_id % 5 = 0 THEN NULL ELSE production * s END AS irrigated, CASE WHEN cell_id % 4 = 0 THEN NULL ELSE production / s END AS rainfed FROM calendar, (VALUES (1), (2)) v(s))
, pt AS (SELECT cell_id, subcrop, crop, CASE WHEN coalesce(irrigated, rainfed) IS NOT NULL THEN coalesce(irrigated, 0) + coalesce(rainfed, 0) END AS production FROM pr)
, mb AS (SELECT pt.cell_id, subcrop, crop, production, month, CASE WHEN month = 3 THEN NULL ELSE Pr / 100 END AS y FROM pt JOIN (SELECT cell_id, month, sum(Pr) AS Pr FROM obs GROUP BY 1, 2) o ON o.cell_id = pt.cell_id)
, tt AS (SELECT zone_id, crop, sum(fraction * production) AS total FROM pt JOIN coverage c ON c.cell_id = pt.cell_id GROUP BY 1, 2)
, yl AS (SELECT c.zone_id, mb.crop, month, sum(fraction * y * production) / nullif(any_value(total), 0) AS y FROM mb JOIN coverage c ON c.cell_id = mb.cell_id JOIN tt ON tt.zone_id = c.zone_id AND tt.crop = mb.crop GROUP BY 1, 2, 3)"""


def _yields(spark, sf_dir):
    k = F.col("cell_id")
    cal = J.combos(lens(spark, sf_dir, "calendar"), s=[1, 2])
    prod = cal.select("cell_id", F.concat_ws("_", "crop", "s").alias("crop"), F.when(k % 5 != 0, F.col("production") * F.col("s")).alias("irrigated"),
                      F.when(k % 4 != 0, F.col("production") / F.col("s")).alias("rainfed"))
    month = lens(spark, sf_dir, "obs").groupBy("cell_id", "month").agg((F.sum("Pr") / 100).alias("y"))
    yields = prod.select("cell_id", "crop").join(month, "cell_id").select("cell_id", "crop", "month", F.when(F.col("month") != 3, F.col("y")).alias("yield"))
    return G.aggregate_yield(yields, prod, lens(spark, sf_dir, "coverage"), ["month"])


@query("g18_aggregate_yield", with_lenses("obs calendar coverage", _YP + f"SELECT zone_id, crop, month, {rsql('y')} AS yield FROM yl"))
def g18(spark, sf_dir):
    return rounded(_yields(spark, sf_dir), "yield")


@query("g19_subcrops", with_lenses("calendar", """
, s(crop, n, impl) AS (VALUES ('maize', 2, TRUE), ('wheat', 2, TRUE), ('cotton', 1, FALSE))
SELECT cell_id, crop, CAST(i AS INT) AS subcrop, CASE WHEN n > 1 THEN crop || '_' || i ELSE crop END AS name,
       CASE WHEN n = 1 THEN crop WHEN crop = 'wheat' AND i = 1 THEN 'winter_wheat' WHEN crop = 'wheat' THEN 'spring_wheat' ELSE crop END AS model
FROM calendar JOIN s USING (crop), range(1, 3) t(i) WHERE i <= n"""))
def g19(spark, sf_dir):
    names = G.subcrops(spark).select("crop", "subcrop", "name", G.model_name(F.col("name")).alias("model"))
    return lens(spark, sf_dir, "calendar").select("cell_id", "crop").join(names, "crop")


@query("g20_stress_losses", with_lenses("obs calendar", _STRESS + f"""
SELECT cell_id, month_index, {rsql(_LF.format(x='coalesce(heat, 0)'))} AS heat_loss, {rsql(_LF.format(x='coalesce(cold, 0)'))} AS cold_loss FROM st"""))
def g20(spark, sf_dir):
    out = G.stress_losses(_stress(spark, sf_dir), ["heat", "cold"], 30.0, 80.0, 1.3)
    return rounded(out.select("cell_id", "month_index", "heat_loss", "cold_loss"), "heat_loss", "cold_loss")


@query("g21_yield_ensemble_summary", with_lenses("obs calendar coverage", _YP + f"""
SELECT zone_id, crop, {', '.join(rsql(f'quantile_cont(y, {q}e-2)') + f' AS yield_q{q}' for q in (25, 50, 75))} FROM yl GROUP BY 1, 2"""))
def g21(spark, sf_dir):
    # the months stand for members: at most twelve per zone and crop
    out = G.yield_ensemble_summary(_yields(spark, sf_dir), ["zone_id", "crop"], bounded=True)
    return rounded(out, "yield_q25", "yield_q50", "yield_q75")

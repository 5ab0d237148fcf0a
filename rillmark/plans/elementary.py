"""Transforms, unit conversions and month arithmetic over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import transforms as X
from ..lenses import lens, table, with_lenses
from .registry import query, r, rounded, rsql


@query("p1_select_vars", with_lenses("obs", f"""
SELECT cell_id, yearmon, {rsql('-coalesce(CASE WHEN month = 1 THEN NULL ELSE PETmE END, 0)')} AS Neg_PETmE, {rsql('sqrt(Pr) + 1')} AS Pr_root,
       {rsql('T')} AS T FROM obs"""))
def p1(spark, sf_dir):
    df = lens(spark, sf_dir, "obs").withColumn("PETmE", F.when(F.col("month") != 1, F.col("PETmE")))
    out = X.select_vars(df, ["cell_id", "yearmon"], ["PETmE@fill0@negate->Neg_PETmE", "Pr@[sqrt(x)]@[x + 1]->Pr_root", "T"])
    return rounded(out, "Neg_PETmE", "Pr_root", "T")


@query("p2_negate_fill_clamp", with_lenses("layers", f"""
SELECT cell_id, layer, {rsql('-value')} AS negated, coalesce(value, 0e0) AS filled, CASE WHEN value < 0 THEN 0e0 ELSE value END AS clamped FROM layers"""))
def p2(spark, sf_dir):
    v = F.col("value")
    return lens(spark, sf_dir, "layers").select("cell_id", "layer", r(X.negate(v)).alias("negated"), X.fill0(v).alias("filled"), X.clamp0(v).alias("clamped"))


@query("p3_transform_expression", with_lenses("layers", f"""
SELECT cell_id, layer, {rsql('value * value / (1 + abs(value))')} AS ratio, CAST(1 AS DOUBLE) AS constant FROM layers"""))
def p3(spark, sf_dir):
    out = X.select_vars(lens(spark, sf_dir, "layers"), ["cell_id", "layer"], ["value@[x * x / (1 + abs(x))]->ratio", "value@[1]->constant"])
    return rounded(out, "ratio")


@query("p4_fill", with_lenses("layers", "SELECT cell_id, layer, coalesce(value, weight) AS by_column, coalesce(value, -9e0) AS by_constant FROM layers"))
def p4(spark, sf_dir):
    return lens(spark, sf_dir, "layers").select(
        "cell_id", "layer", X.fill(F.col("value"), F.col("weight")).alias("by_column"), X.fill(F.col("value"), -9.0).alias("by_constant"))


@query("p5_clamp", with_lenses("layers", "SELECT cell_id, layer, CASE WHEN value < -20 THEN -20 WHEN value > 60 THEN 60 ELSE value END AS bounded FROM layers"))
def p5(spark, sf_dir):
    return lens(spark, sf_dir, "layers").select("cell_id", "layer", X.clamp(F.col("value"), -20.0, 60.0).alias("bounded"))


@query("p6_normalize_lonlat", with_lenses("points", f"""
, w AS (SELECT id, lat, CASE WHEN lon + 180 + 0.25e0 > 180 THEN lon + 180 + 0.25e0 - 360 ELSE lon + 180 + 0.25e0 END AS lon FROM points)
SELECT id, {rsql('lat')} AS lat, {rsql('lon')} AS lon, CAST(floor((90 - lat) / 0.5e0) AS INT) AS row_no, CAST(floor((lon + 180) / 0.5e0) AS INT) AS col_no FROM w"""))
def p6(spark, sf_dir):
    df = lens(spark, sf_dir, "points").withColumn("lon", F.col("lon") + 180)
    return rounded(X.normalize_lonlat(df, 0.5, 0.5, corners=True), "lat", "lon")


@query("p7_cell_centers", with_lenses("grid", f"""
SELECT cell_id, {rsql('90 - 0.25e0 - row_no * 0.5e0')} AS lat, {rsql('-10 + 0.25e0 + col_no * 0.5e0')} AS lon FROM grid"""))
def p7(spark, sf_dir):
    lat, lon = X.cell_centers(F.col("row_no"), F.col("col_no"), (-10.0, 10.0, -90.0, 90.0), (360, 40))
    return lens(spark, sf_dir, "grid").select("cell_id", r(lat).alias("lat"), r(lon).alias("lon"))


@query("p8_cell_area", with_lenses("points", f"""
SELECT id, {rsql('pi()/180 * 6371000e0*6371000e0 * 0.5e0 * abs(sin((lat+0.25e0)*pi()/180) - sin((lat-0.25e0)*pi()/180)) / 1e6', 4)} AS area_km2 FROM points"""))
def p8(spark, sf_dir):
    return lens(spark, sf_dir, "points").select("id", r(X.cell_area_m2(F.col("lat"), 0.5, 0.5) / 1e6, 4).alias("area_km2"))


@query("p9_substitute", "SELECT p_partkey, CASE p_size WHEN 1 THEN 101 WHEN 7 THEN 107 WHEN 30 THEN 0 ELSE p_size END AS p_size FROM part")
def p9(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.substitute(F.col("p_size"), {1: 101, 7: 107, 30: 0}).alias("p_size"))


@query("p10_reclassify", with_lenses("grid", """
, g AS (SELECT cell_id, CASE WHEN value IS NULL THEN NULL ELSE CAST(s_nationkey AS DOUBLE) END AS value
        FROM grid LEFT JOIN supplier ON s_suppkey = cell_id)
, t AS (SELECT CAST(n_nationkey AS DOUBLE) AS f, n_regionkey * 10e0 AS t FROM nation WHERE n_nationkey % 4 <> 0)
SELECT cell_id, CASE WHEN value IS NULL THEN -1e0 ELSE t END AS value FROM g LEFT JOIN t ON f = value"""))
def p10(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("cell_id"), F.col("s_nationkey").cast("double").alias("nation"))
    g = lens(spark, sf_dir, "grid").join(s, "cell_id", "left").select("cell_id", F.when(F.col("value").isNotNull(), F.col("nation")).alias("value"))
    t = table(spark, sf_dir, "nation").where("n_nationkey % 4 <> 0").select(
        F.col("n_nationkey").cast("double").alias("f"), (F.col("n_regionkey") * 10.0).alias("t"))
    t = t.unionByName(t.sparkSession.range(1).select(F.lit(None).cast("double").alias("f"), F.lit(-1.0).alias("t")))
    return X.reclassify(g, "value", t, "f", "t")


@query("p11_assign_to_bin", with_lenses("obs", """
SELECT cell_id, yearmon, CASE WHEN Pr >= 240 THEN 240 WHEN Pr >= 120 THEN 120 WHEN Pr >= 60 THEN 60 ELSE 30 END AS bin FROM obs"""))
def p11(spark, sf_dir):
    return lens(spark, sf_dir, "obs").select("cell_id", "yearmon", X.assign_to_bin(F.col("Pr"), [60, 30, 240, 120]).alias("bin"))


@query("p12_classify_breaks", with_lenses("layers", """
, c AS (SELECT cell_id, layer, CASE WHEN value IS NULL OR value < 3 THEN 0 WHEN value < 5 THEN 1 WHEN value < 10 THEN 2 WHEN value < 20 THEN 3
                             WHEN value < 40 THEN 4 ELSE 5 END AS class FROM layers)
SELECT cell_id, layer, class, list_extract(['lt_3','3_5','5_10','10_20','20_40','gt_40'], class + 1) AS label FROM c"""))
def p12(spark, sf_dir):
    v = F.col("value")
    return lens(spark, sf_dir, "layers").select("cell_id", "layer", X.classify_breaks(v).alias("class"), X.classify_label(v).alias("label"))


@query("p13_cell_index", with_lenses("grid", "SELECT cell_id, CAST(row_no AS BIGINT) * 40 + col_no AS index, row_no, col_no FROM grid"))
def p13(spark, sf_dir):
    out = lens(spark, sf_dir, "grid").select("cell_id", X.flat_index(F.col("row_no"), F.col("col_no"), 40).alias("index"))
    row, col = X.unflatten(F.col("index"), 40)
    return out.withColumns({"row_no": row, "col_no": col})


@query("p14_unit_conversions", with_lenses("obs", f"""
SELECT cell_id, yearmon, {rsql('T + 270 - 273.15e0')} AS celsius, {rsql('Pr / 86400 * 86400 * day(last_day(make_date(yearmon // 100, yearmon % 100, 1)))')} AS precip_mm,
       {rsql('PETmE / 2.5e6 * 86400')} AS evap_mm_day, {rsql('RO_mm * 8', 9)} AS runoff_daily, {rsql('RO_mm / 1000 * 2500', 9)} AS volume_m3 FROM obs"""))
def p14(spark, sf_dir):
    days = C.days_in_yearmon(F.col("yearmon"))
    return lens(spark, sf_dir, "obs").select(
        "cell_id", "yearmon", r(X.temperature_celsius(F.col("T") + 270, "K")).alias("celsius"),
        r(X.precipitation_mm(F.col("Pr") / 86400, "kg/m^2/s", days)).alias("precip_mm"),
        r(X.heat_to_mm_per_day(F.col("PETmE"))).alias("evap_mm_day"), r(X.three_hourly_to_daily(F.col("RO_mm")), 9).alias("runoff_daily"),
        r(X.mm_to_m3(F.col("RO_mm"), F.lit(2500.0)), 9).alias("volume_m3"))


_DAYS_NOLEAP = "CASE WHEN yearmon % 100 = 2 THEN 28 ELSE day(last_day(make_date(yearmon // 100, yearmon % 100, 1))) END"
_RAW = ("Pr / 1e6 AS rainf_f_tavg, T + 270 AS tair_f_inst, PETmE * 20 AS potevap_tavg, Ws / 1e6 AS evap_tavg, "
        "RO_mm / 100 AS qs_acc, RO_mm / 50 AS qsb_acc, Bt_RO AS qsm_acc, Ws AS soilmoi0_10cm_inst, Ws * 2 AS soilmoi10_40cm_inst, Ws * 3 AS soilmoi40_100cm_inst")


@query("p15_prepare_model_output", with_lenses("obs", f"""
, w AS (SELECT cell_id, yearmon, {_RAW}, {_DAYS_NOLEAP} AS nd,
        pi()/180 * 6371000e0*6371000e0 * 0.5e0 * abs(sin((cell_id % 60 + 0.25e0)*pi()/180) - sin((cell_id % 60 - 0.25e0)*pi()/180)) AS area FROM obs)
SELECT cell_id, yearmon, {rsql('tair_f_inst - 273.15e0')} AS T, {rsql('rainf_f_tavg * 86400 * nd')} AS Pr,
       {rsql('potevap_tavg / 2.5e6 * 86400 * nd - evap_tavg * 86400 * nd', 5)} AS PETmE, {rsql('(qs_acc + qsb_acc + qsm_acc) * 8 * nd', 7)} AS RO_mm,
       {rsql('(qs_acc + qsb_acc + qsm_acc) * 8 * nd / 1000 * area / 1e6', 5)} AS RO_km3, {rsql('soilmoi0_10cm_inst + soilmoi10_40cm_inst + soilmoi40_100cm_inst')} AS Ws FROM w"""))
def p15(spark, sf_dir):
    raw = lens(spark, sf_dir, "obs").selectExpr("cell_id", "yearmon", *[e.strip() for e in _RAW.split(",")])
    area = X.cell_area_m2((F.col("cell_id") % 60).cast("double"), 0.5, 0.5)
    out = X.prepare_model_output(raw, C.days_in_yearmon(F.col("yearmon"), leap=False), area)
    return out.select("cell_id", "yearmon", r("T").alias("T"), r("Pr").alias("Pr"), r("PETmE", 5).alias("PETmE"), r("RO_mm", 7).alias("RO_mm"),
                      r(F.col("RO_m3") / 1e6, 5).alias("RO_km3"), r("Ws").alias("Ws"))


@query("p16_round_to_resolution", with_lenses("obs", f"SELECT cell_id, yearmon, {rsql('RO_mm', 1)} AS RO_mm, {rsql('Bt_RO * 1e6 + 0.3e0', -2)} AS volume FROM obs"))
def p16(spark, sf_dir):
    return lens(spark, sf_dir, "obs").select(
        "cell_id", "yearmon", X.round_to_resolution(F.col("RO_mm"), 0.1).alias("RO_mm"),
        X.round_to_resolution(F.col("Bt_RO") * 1e6 + 0.3, 100.0).alias("volume"))


@query("p17_land_mask", "SELECT p_partkey, CASE WHEN p_size / 50e0 > 0.4e0 THEN 1 END AS land FROM part")
def p17(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.land_mask(F.col("p_size") / 50.0, 0.4).alias("land"))


@query("p18_linear_interpolation", f"""
SELECT p_partkey, {rsql('''CASE WHEN p_size < 5 THEN 1e0 WHEN p_size < 10 THEN 2 + (p_size - 5) * 0.6e0 WHEN p_size < 30 THEN 5 - (p_size - 10) * 0.2e0
       WHEN p_size = 30 THEN 1e0 ELSE NULL END''')} AS y FROM part""")
def p18(spark, sf_dir):
    y = X.linear_interpolation(F.col("p_size"), [5, 10, 30], [2, 5, 1], left=1.0)
    return table(spark, sf_dir, "part").select("p_partkey", r(y).alias("y"))


@query("p19_crop_extent", with_lenses("points", f"SELECT id, {rsql('lon')} AS lon, {rsql('lat')} AS lat FROM points WHERE lon BETWEEN -125 AND 67 AND lat BETWEEN 25 AND 53"))
def p19(spark, sf_dir):
    return rounded(X.crop_extent(lens(spark, sf_dir, "points"), -125, 67, 25, 53), "lon", "lat")


@query("p20_clean_stress", with_lenses("layers", f"""
, s AS (SELECT cell_id, layer, CASE WHEN layer % 5 = 0 THEN -32767e0 ELSE value / 50 END AS stress FROM layers)
SELECT cell_id, layer, {rsql('least(greatest(stress, 0e0), 1e0)')} AS stress FROM s WHERE stress > -32767"""))
def p20(spark, sf_dir):
    s = lens(spark, sf_dir, "layers").select("cell_id", "layer", F.when(F.col("layer") % 5 == 0, -32767.0).otherwise(F.col("value") / 50).alias("stress"))
    return rounded(X.clean_stress(s, "stress"), "stress")


# ---- months and days ---------------------------------------------------------------------------

_IDX = "(yearmon // 100 * 12 + yearmon % 100 - 1)"


def _ym(e: str) -> str:
    return f"CAST(({e}) // 12 * 100 + ({e}) % 12 + 1 AS INT)"


@query("t1_add_months", with_lenses("obs", f"""
SELECT cell_id, yearmon, {_ym(_IDX + ' + 17')} AS later, {_ym(_IDX + ' - 30')} AS earlier, {_ym(_IDX + ' + 1')} AS following, {_ym(_IDX + ' - 1')} AS previous FROM obs"""))
def t1(spark, sf_dir):
    y = F.col("yearmon")
    return lens(spark, sf_dir, "obs").select("cell_id", "yearmon", C.add_months(y, 17).alias("later"), C.add_months(y, -30).alias("earlier"),
                                             C.next_yearmon(y).alias("following"), C.prev_yearmon(y).alias("previous"))


@query("t2_add_years_days", """
SELECT o_orderkey, CAST(year(o_orderdate) + 12 AS INT) AS later_year, CAST(strftime(CAST(o_orderdate AS DATE) + 45, '%Y%m%d') AS INT) AS later_day,
       CAST(strftime(CAST(o_orderdate AS DATE) - 400, '%Y%m%d') AS INT) AS earlier_day FROM orders""")
def t2(spark, sf_dir):
    d = F.col("o_orderdate")
    day = (F.year(d) * 10000 + F.month(d) * 100 + F.day(d)).cast("int")
    return table(spark, sf_dir, "orders").select("o_orderkey", C.add_years(F.year(d), 12).alias("later_year"),
                                                 C.add_days(day, 45).alias("later_day"), C.add_days(day, -400).alias("earlier_day"))


@query("t3_days_in_month", with_lenses("obs", f"""
SELECT cell_id, yearmon, CAST(day(last_day(make_date(yearmon // 100, yearmon % 100, 1))) AS INT) AS days, CAST({_DAYS_NOLEAP} AS INT) AS days_noleap FROM obs"""))
def t3(spark, sf_dir):
    y = F.col("yearmon")
    return lens(spark, sf_dir, "obs").select("cell_id", "yearmon", C.days_in_yearmon(y).alias("days"), C.days_in_yearmon(y, leap=False).alias("days_noleap"))


@query("t4_day_of_year", with_lenses("calendar", """
SELECT cell_id, plant_doy, CAST(month(DATE '2001-01-01' + (plant_doy - 1)) AS INT) AS plant_month,
       CAST(dayofyear(make_date(2001, month(DATE '2001-01-01' + (plant_doy - 1)), 1)) AS INT) AS month_start,
       CAST(dayofyear(last_day(DATE '2001-01-01' + (plant_doy - 1))) AS INT) AS month_end FROM calendar"""))
def t4(spark, sf_dir):
    out = lens(spark, sf_dir, "calendar").select("cell_id", "plant_doy", C.doy_to_month(F.col("plant_doy")).alias("plant_month"))
    return out.withColumns({"month_start": C.start_of_month(F.col("plant_month")), "month_end": C.end_of_month(F.col("plant_month"))})


@query("t5_forecast_coordinates", with_lenses("obs", f"""
SELECT cell_id, yearmon, CAST({_IDX} - 23520 AS INT) AS reference, {_ym(f'{_IDX} - 23520 + 23520')} AS back, CAST({_IDX} - 23940 AS INT) AS lead,
       {_IDX} - 23940 + 0.5e0 AS lead_mid FROM obs"""))
def t5(spark, sf_dir):
    y = F.col("yearmon")
    n = C.months_since_1960(y)
    return lens(spark, sf_dir, "obs").select(
        "cell_id", "yearmon", n.alias("reference"), C.yearmon_from_months_since_1960(n).alias("back"),
        C.lead_months(F.lit(199501), y).alias("lead"), C.lead_months(F.lit(199501), y, 0.5).alias("lead_mid"))


@query("t5b_issue_to_reference", with_lenses("obs", f"SELECT cell_id, yearmon, {_ym(_IDX + ' + 1')} AS reference, CAST(month - 1 AS INT) AS raw_lead FROM obs"))
def t5b(spark, sf_dir):
    return lens(spark, sf_dir, "obs").select("cell_id", "yearmon", C.issue_to_reference(F.col("yearmon")).alias("reference"), C.raw_lead(F.col("month")).alias("raw_lead"))


@query("t6_rolling_months", with_lenses("obs", f"""
SELECT cell_id, yearmon, {_ym(_IDX + ' - i')} AS member FROM obs, range(6) t(i)"""))
def t6(spark, sf_dir):
    return lens(spark, sf_dir, "obs").select("cell_id", "yearmon", F.explode(C.rolling_months(F.col("yearmon"), 6)).alias("member"))




@query("t6_month_ranges", """
WITH s AS (SELECT c_custkey, 1990 + c_custkey % 10 AS y0, 2001 + c_custkey % 4 AS y1, 1 + c_custkey % 12 AS m, 1 + c_custkey % 24 AS w FROM customer)
, f AS (SELECT *, y0 * 12 + w - 1 AS first FROM s)
, a AS (SELECT *, first + (m - 1 - first % 12 + 12) % 12 AS begin FROM f)
SELECT c_custkey, CAST(i // 12 * 100 + i % 12 + 1 AS INT) AS yearmon FROM (SELECT c_custkey, unnest(range(begin, y1 * 12 + m, 12)) AS i FROM a)""")
def t6_ranges(spark, sf_dir):
    c = F.col("c_custkey")
    months = C.available_range((1 + c % 24).cast("int"), (1990 + c % 10).cast("int"), (2001 + c % 4).cast("int"), (1 + c % 12).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", F.explode(months).alias("yearmon"))


@query("t7_month_from_name", with_lenses("obs", "SELECT cell_id, yearmon AS parsed FROM obs"))
def t7(spark, sf_dir):
    name = F.format_string("results_1mo_%d_cell.nc", "yearmon")
    return lens(spark, sf_dir, "obs").select("cell_id", C.yearmon_from_name(name).alias("parsed"))


@query("t8_quantile_from_name", "SELECT p_partkey, CAST(p_size AS INT) AS quantile FROM part")
def t8(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", C.quantile_from_name(F.format_string("Pr_rp_q%d", "p_size")).alias("quantile"))

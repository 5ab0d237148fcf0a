"""Electric power sector."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import power as P
from ..lenses import lens, table, with_lenses
from ..operators import fit as D
from ..operators import integrate as I
from ..operators import power as E
from ..operators import windows as W
from . import sqltext as S
from .registry import query, r, rounded, rsql

_DAMS = """
, net AS (SELECT id AS basin_id, downstream_id FROM network)
, dams AS (SELECT o_orderkey AS dam_id, o_custkey + 1 AS basin_id, o_totalprice / 1000 AS capacity FROM orders
           UNION ALL SELECT o_orderkey, o_custkey + 2, o_totalprice / 1000 FROM orders WHERE o_orderkey % 7 = 0)
, placed AS (SELECT dam_id, min(basin_id) AS basin_id, any_value(capacity) AS capacity FROM dams GROUP BY 1)
, own AS (SELECT net.basin_id, downstream_id, coalesce(sum(capacity), 0) AS capacity FROM net LEFT JOIN placed ON placed.basin_id = net.basin_id GROUP BY 1, 2)
, up AS (SELECT basin_id AS root, basin_id FROM own UNION ALL SELECT up.root, n.basin_id FROM up JOIN own n ON n.downstream_id = up.basin_id)
, cap AS (SELECT root AS basin_id, sum(CASE WHEN own.basin_id = root THEN own.capacity ELSE 0 END) AS capacity,
          sum(CASE WHEN own.basin_id <> root THEN own.capacity ELSE 0 END) AS capacity_upstream FROM up JOIN own ON own.basin_id = up.basin_id GROUP BY root)"""


def _dams(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    at = o.select(F.col("o_orderkey").alias("dam_id"), (F.col("o_custkey") + 1).alias("basin_id"), (F.col("o_totalprice") / 1000).alias("capacity"))
    return at.unionByName(at.where("dam_id % 7 = 0").withColumn("basin_id", F.col("basin_id") + 1))


@query("e1_upstream_capacity", with_lenses("network", _DAMS + f"""
SELECT basin_id, {rsql('capacity', 6)} AS capacity, {rsql('capacity_upstream', 6)} AS capacity_upstream FROM cap""").replace("WITH ", "WITH RECURSIVE ", 1))
def e1(spark, sf_dir):
    basins = lens(spark, sf_dir, "network").select(F.col("id").alias("basin_id"), "downstream_id")
    return rounded(E.upstream_capacity(basins, _dams(spark, sf_dir)), "capacity", "capacity_upstream", digits=6)


_USES = """, d AS (SELECT o_orderkey AS dam_id, CASE WHEN o_orderkey % 5 = 0 THEN 'Main' END AS use_elec, CASE WHEN o_orderkey % 3 = 0 THEN 'Sec' END AS use_irri,
  CASE WHEN o_orderkey % 4 = 1 THEN 'Sec' END AS use_supp, CASE WHEN o_orderkey % 7 = 2 THEN 'Main' END AS use_fcon FROM orders)"""


@query("e2_dams_for_sector", "WITH " + _USES[2:] + """
SELECT dam_id, 'electric_power' AS sector FROM d WHERE use_elec IS NOT NULL OR (use_irri IS NULL AND use_supp IS NULL AND use_fcon IS NULL)
UNION ALL SELECT dam_id, 'agriculture' FROM d WHERE use_irri IS NOT NULL""")
def e2(spark, sf_dir):
    k = F.col("o_orderkey")
    d = table(spark, sf_dir, "orders").select(
        k.alias("dam_id"), F.when(k % 5 == 0, "Main").alias("use_elec"), F.when(k % 3 == 0, "Sec").alias("use_irri"),
        F.when(k % 4 == 1, "Sec").alias("use_supp"), F.when(k % 7 == 2, "Main").alias("use_fcon"))
    parts = [E.dams_for_sector(d, s).select("dam_id", F.lit(s).alias("sector")) for s in ("electric_power", "agriculture")]
    return parts[0].unionByName(parts[1])


@query("e3_integration_period", """
WITH b AS (SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE abs(c_acctbal) END AS cap, CASE WHEN c_custkey % 11 = 0 THEN 0 ELSE 50 + c_custkey % 300 END AS flow FROM customer)
SELECT c_custkey, CAST(CASE WHEN cap IS NULL OR flow = 0 THEN 3 WHEN cap / flow >= 60 THEN 60 WHEN cap / flow >= 36 THEN 36 WHEN cap / flow >= 24 THEN 24 WHEN cap / flow >= 12 THEN 12
       WHEN cap / flow >= 6 THEN 6 ELSE 3 END AS INT) AS months_storage FROM b""")
def e3(spark, sf_dir):
    k = F.col("c_custkey")
    cap, flow = F.when(k % 9 != 0, F.abs("c_acctbal")), F.when(k % 11 == 0, 0).otherwise(50 + k % 300)
    return table(spark, sf_dir, "customer").select("c_custkey", E.integration_period(cap, flow, list(I.WINDOWS)).alias("months_storage"))


_HL = "CASE WHEN {f} IS NULL THEN NULL WHEN {m} > 0 THEN 1 - CASE WHEN {f} > 0 THEN least(greatest(1.013446e0 + 0.281561e0 * ln({f} / {m}), 0), 1) ELSE 0 END ELSE 0 END"


@query("e4_hydropower_loss", with_lenses("obs", f"""
, f AS (SELECT cell_id, yearmon, CASE WHEN month = 5 THEN NULL WHEN month = 6 THEN 0 ELSE Pr END AS flow, CASE WHEN cell_id % 8 = 0 THEN 0e0 ELSE Ws * 4 END AS med FROM obs)
SELECT cell_id, yearmon, {rsql(_HL.format(f='flow', m='med'))} AS loss FROM f"""))
def e4(spark, sf_dir):
    flow = F.when(F.col("month") == 5, None).when(F.col("month") == 6, 0.0).otherwise(F.col("Pr"))
    med = F.when(F.col("cell_id") % 8 == 0, 0.0).otherwise(F.col("Ws") * 4)
    return lens(spark, sf_dir, "obs").select("cell_id", "yearmon", r(P.hydropower_loss(flow, med)).alias("loss"))


# flow and fits of all full windows of 12 and 24 months
_E5 = "".join(f"""
, w{n} AS (SELECT a.cell_id, a.month_index, sum(b.Bt_RO) AS v FROM obs a JOIN obs b ON b.cell_id = a.cell_id AND b.month_index BETWEEN a.month_index - {n - 1} AND a.month_index
         GROUP BY 1, 2 HAVING count(*) = {n})""" + S.gev(f"f{n}", f"w{n}", "cell_id", "v") for n in (12, 24)) + """
, fl AS (SELECT cell_id AS id, month_index, 12 AS "window", v AS flow FROM w12 UNION ALL SELECT cell_id, month_index, 24, v FROM w24)
, fi AS (SELECT cell_id AS id, 12 AS "window", location, scale, shape FROM f12 UNION ALL SELECT cell_id, 24, location, scale, shape FROM f24)
, st AS (SELECT DISTINCT cell_id AS id, CASE WHEN cell_id % 3 = 0 THEN 24 ELSE 12 END AS "window" FROM obs)
, md AS (SELECT st.id, st."window", month_index, flow, CASE WHEN location IS NULL OR scale IS NULL OR shape IS NULL THEN location ELSE """ + S.qua_gev("0.5e0") + """ END AS med
         FROM st LEFT JOIN fl ON fl.id = st.id AND fl."window" = st."window" LEFT JOIN fi ON fi.id = st.id AND fi."window" = st."window")"""


@query("e5_basin_loss_factors", with_lenses("obs", _E5 + f"""
SELECT id, CAST("window" AS INT) AS "window", month_index, {rsql(_HL.format(f='flow', m='med'), 4)} AS hydropower_loss FROM md"""))
def e5(spark, sf_dir):
    rolled = W.rolling_integrate_many(lens(spark, sf_dir, "obs"), ["cell_id"], [12, 24], {"Bt_RO": ("sum",)}).withColumnsRenamed(
        {"cell_id": "id", "Bt_RO_sum": "flow"})
    fits = D.fit(rolled, ["id", "window"], "flow", bounded=True)
    storage = lens(spark, sf_dir, "obs").select(F.col("cell_id").alias("id")).distinct().withColumn(
        "months_storage", F.when(F.col("id") % 3 == 0, 24).otherwise(6))
    return rounded(E.basin_loss_factors(storage, rolled.select("id", "window", "month_index", "flow"), fits, ["month_index"]), "hydropower_loss", digits=4)


@query("e6_water_cooled_loss", with_lenses("obs", f"""
SELECT cell_id, yearmon, {rsql('0.01e0 * least(greatest(exp(ln(101) / (60 - 20) * (Pr / 4 - 20)) - 1, 0), 100)')} AS loss FROM obs"""))
def e6(spark, sf_dir):
    return lens(spark, sf_dir, "obs").select("cell_id", "yearmon", r(P.water_cooled_loss(F.col("Pr") / 4, 20.0, 60.0)).alias("loss"))


@query("e7_loss_onset", with_lenses("layers", f"""
, s AS (SELECT cell_id, layer, CASE WHEN value < 0 THEN 0 ELSE value / 150 END AS s FROM layers)
SELECT cell_id, layer, {rsql('''CASE WHEN s IS NULL THEN 30 WHEN s < 0.1e0 THEN 30 - 50 * s WHEN s < 0.2e0 THEN 25 - 50 * (s - 0.1e0) WHEN s < 0.4e0 THEN 20 - 25 * (s - 0.2e0)
       WHEN s < 0.8e0 THEN 15 - 12.5e0 * (s - 0.4e0) ELSE 10 END''')} AS onset FROM s"""))
def e7(spark, sf_dir):
    s = F.when(F.col("value") < 0, 0.0).otherwise(F.col("value") / 150)
    return lens(spark, sf_dir, "layers").select("cell_id", "layer", s.alias("s")).select("cell_id", "layer", r(P.loss_onset(F.col("s"))).alias("onset"))


@query("e8_temperature_loss", with_lenses("obs", f"""
, t AS (SELECT cell_id, yearmon, (T - 5) * 12 AS air, Pr / 2 - 100 AS rp, CASE WHEN month = 7 THEN NULL ELSE T * 6 END AS bas FROM obs)
SELECT cell_id, yearmon, {rsql('''greatest(coalesce(CASE WHEN air <= -10 AND rp < -30 THEN least(greatest((-10 - air) / 30, 0), 1) ELSE 0 END, 0),
   coalesce(least(greatest(0.005e0 * (air - 20), 0), 1), 0), CASE WHEN bas >= (32 - 8 - 2.5e0) / 0.76e0 THEN least(greatest((2.5e0 + bas * 0.76e0 - 24) / 8, 0), 1) ELSE 0 END)''')} AS loss,
   {rsql('(air - 2.5e0) / 0.76e0')} AS as_air, {rsql('2.5e0 + air * 0.76e0')} AS as_water FROM t"""))
def e8(spark, sf_dir):
    t = lens(spark, sf_dir, "obs").select("cell_id", "yearmon", ((F.col("T") - 5) * 12).alias("air"), (F.col("Pr") / 2 - 100).alias("rp"),
                                          F.when(F.col("month") != 7, F.col("T") * 6).alias("bas"))
    loss = P.temperature_loss(F.col("air"), F.col("rp"), F.col("bas"), F.lit(-10.0), F.lit(-30.0), F.lit(20.0), F.lit(32.0), F.lit(8.0))
    return t.select("cell_id", "yearmon", r(loss).alias("loss"), r(P.water_to_air(F.col("air"))).alias("as_air"), r(P.air_to_water(F.col("air"))).alias("as_water"))


_LOSSES = ", lo AS (SELECT cell_id % 25 + 1 AS id, month, least(1, avg(T) / 10) AS hydropower_loss FROM obs GROUP BY 1, 2)"


def _losses(spark, sf_dir):
    return lens(spark, sf_dir, "obs").groupBy((F.col("cell_id") % 25 + 1).alias("id"), "month").agg(
        F.least(F.lit(1.0), F.avg("T") / 10).alias("hydropower_loss"))


_SUMMARY = """, s AS (SELECT province_id, month, sum(capacity_mw) AS c, sum(generation_mw) AS g, sum(CASE WHEN fuel = 'Hydro' THEN generation_mw * hydropower_loss ELSE 0 END) AS l,
  sum(CASE WHEN fuel = 'Hydro' THEN generation_mw ELSE 0 END) AS h FROM plants JOIN lo ON id = basin_id WHERE province_id <> 4 OR fuel <> 'Hydro' GROUP BY 1, 2)"""
_SUMMARY_COLS = f"""{rsql('c')} AS capacity_tot_mw, {rsql('g * 744', 4)} AS generation_tot_mwh, {rsql('l * 744', 4)} AS gross_loss_mwh, {rsql('l * 744', 4)} AS hydro_loss_mwh,
       {rsql('l / g')} AS gross_loss_pct, {rsql('l / nullif(h, 0)')} AS hydro_loss_pct"""


def _summary(spark, sf_dir):
    plants = lens(spark, sf_dir, "plants").where("province_id <> 4 OR fuel <> 'Hydro'")
    return E.summarize_losses(plants, _losses(spark, sf_dir), "province_id", 744, ["month"])


@query("e9_summarize_losses", with_lenses("obs plants", _LOSSES + _SUMMARY + f"SELECT province_id, month, {_SUMMARY_COLS} FROM s"))
def e9(spark, sf_dir):
    out = rounded(_summary(spark, sf_dir), "generation_tot_mwh", "gross_loss_mwh", "hydro_loss_mwh", digits=4)
    return rounded(out, "capacity_tot_mw", "gross_loss_pct", "hydro_loss_pct")


@query("e10_reserve_capacity", with_lenses("plants", f"""
SELECT plant_id, {rsql('''CASE WHEN fuel IN ('Hydro', 'Wind', 'Solar', 'Geothermal', 'Wave and Tidal') OR (fuel IN ('Coal', 'Nuclear') AND plant_id % 2 = 0) THEN 0 ELSE capacity_mw - generation_mw END''')} AS reserve FROM plants"""))
def e10(spark, sf_dir):
    wet = F.col("fuel").isin("Coal", "Nuclear")
    return lens(spark, sf_dir, "plants").select("plant_id", r(P.reserve_capacity(
        F.col("fuel"), wet, F.col("plant_id") % 2 == 1, F.col("capacity_mw"), F.col("generation_mw"))).alias("reserve"))


@query("e11_classify_cooling", with_lenses("plants", f"""
SELECT plant_id, fuel, {rsql('(plant_id % 10) / 10e0 * capacity_mw')} AS generation_mw, fuel IN ('Coal', 'Nuclear') AS water_cooled, plant_id % 6 = 0 AS once_through,
       fuel IN ('Coal', 'Nuclear') AND plant_id % 3 = 1 AS seawater_cooled FROM plants WHERE plant_id % 20 <> 3"""))
def e11(spark, sf_dir):
    plants = lens(spark, sf_dir, "plants").withColumn("fuel", F.when(F.col("plant_id") % 20 == 3, "Storage").otherwise(F.col("fuel")))
    ids = plants.select("plant_id")
    out = E.classify_cooling(plants, ids.withColumn("near", F.col("plant_id") % 3 == 1), ids.withColumn("capacity_factor", (F.col("plant_id") % 10) / 10.0),
                             ids.where("plant_id % 6 = 0"))
    return out.select("plant_id", "fuel", r("generation_mw").alias("generation_mw"), "water_cooled", "once_through", "seawater_cooled")


@query("e12_loss_ensemble_summary", with_lenses("obs plants", _LOSSES + _SUMMARY + f"""
, v AS (SELECT province_id, l * 744 AS gross_loss_mwh, l * 744 AS hydro_loss_mwh, l / g AS gross_loss_pct, l / nullif(h, 0) AS hydro_loss_pct FROM s)
SELECT province_id, {', '.join(rsql(f'quantile_cont({v}, {q}e-2)', 4) + f' AS {v}_q{q}' for v in E.LOSS_VARIABLES for q in (25, 50, 75))} FROM v GROUP BY 1"""))
def e12(spark, sf_dir):
    # the months stand for members: at most twelve per province
    out = E.loss_ensemble_summary(_summary(spark, sf_dir), ["province_id"], bounded=True)
    return rounded(out, *[c for c in out.columns if c != "province_id"], digits=4)


@query("e13_basin_water_stress", with_lenses("obs coverage", f"""
, s AS (SELECT cell_id, avg(T) / 10 AS stress FROM obs GROUP BY 1)
SELECT zone_id, {rsql('sum(stress * fraction) / sum(fraction)')} AS stress FROM s JOIN coverage ON coverage.cell_id = s.cell_id GROUP BY 1"""))
def e13(spark, sf_dir):
    stress = lens(spark, sf_dir, "obs").groupBy("cell_id").agg((F.avg("T") / 10).alias("stress"))
    return rounded(E.basin_water_stress(stress, lens(spark, sf_dir, "coverage")), "stress")


@query("e14_append_boundaries", with_lenses("coverage", """
, c AS (SELECT cell_id, min(zone_id) AS z FROM coverage GROUP BY 1), p AS (SELECT cell_id, min(zone_id * 10 + cell_id % 3) AS z FROM coverage WHERE cell_id % 5 <> 0 GROUP BY 1)
SELECT c_custkey AS plant_id, c.z AS country_id, p.z AS province_id, b.z AS basin_id FROM customer LEFT JOIN c ON c.cell_id = c_custkey % (SELECT count(*) + 20 FROM supplier)
LEFT JOIN p ON p.cell_id = c_custkey % (SELECT count(*) + 20 FROM supplier) LEFT JOIN (SELECT cell_id, min(zone_id + 100) AS z FROM coverage WHERE fraction > 0.3e0 GROUP BY 1) b ON b.cell_id = c_custkey % (SELECT count(*) + 20 FROM supplier)"""))
def e14(spark, sf_dir):
    places = table(spark, sf_dir, "supplier").agg((F.count("*") + 20).alias("n")).scalar()
    plants = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("plant_id"), (F.col("c_custkey") % places).alias("cell_id"))
    cov = lens(spark, sf_dir, "coverage")
    sets = {"country_id": cov, "province_id": cov.where("cell_id % 5 <> 0").withColumn("zone_id", F.col("zone_id") * 10 + F.col("cell_id") % 3),
            "basin_id": cov.where("fraction > 0.3").withColumn("zone_id", F.col("zone_id") + 100)}
    return E.append_boundaries(plants, sets).select("plant_id", "country_id", "province_id", "basin_id")

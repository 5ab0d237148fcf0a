"""Joins, set operations, checks, sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..lenses import lens, table, with_lenses
from ..operators import integrate as I
from ..operators import joins as J
from ..operators import quality as Q
from ..session import scratch_path
from ..sources import scan as S
from ..sources import sink as K
from .registry import query, r, rounded, rsql

# ---- sources and sinks ----------------------------------------------------------------------------


@query("s1_scan", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def s1(spark, sf_dir):
    return S.scan(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity"])


@query("s2_scan_months", with_lenses("obs", f"""
SELECT cell_id, yearmon, {rsql('Pr')} AS Pr FROM obs WHERE yearmon BETWEEN 199603 AND 200103 AND yearmon % 100 = 3"""))
def s2(spark, sf_dir):
    return rounded(S.require_months(lens(spark, sf_dir, "obs"), 199603, 200103, 12).select("cell_id", "yearmon", "Pr"), "Pr")


@query("s2_missing_months", with_lenses("obs", """
, m AS (SELECT CAST(i // 12 * 100 + i % 12 + 1 AS INT) AS yearmon FROM range(23928, 24036) t(i))
SELECT yearmon FROM m WHERE yearmon NOT IN (SELECT yearmon FROM obs)"""))
def s2_missing(spark, sf_dir):
    return S.missing_months(lens(spark, sf_dir, "obs"), 199401, 200212)


@query("s3_scan_slice", with_lenses("members", f"SELECT cell_id, target, {rsql('Pr')} AS Pr FROM members WHERE model = 'R' AND member = 3"))
def s3(spark, sf_dir):
    return rounded(S.scan_slice(lens(spark, sf_dir, "members"), model="R", member=3), "Pr")


@query("s3_dimension_values", with_lenses("members", "SELECT DISTINCT model FROM members"))
def s3_values(spark, sf_dir):
    return S.dimension_values(lens(spark, sf_dir, "members"), "model")


@query("s4_scan_hindcast", with_lenses("members", f"""
, h AS (SELECT cell_id, CAST((target // 100 * 12 + target % 100 - 1) - member AS INT) AS start_index, CAST(member AS INT) AS lead, model AS member, Pr FROM members)
SELECT cell_id, start_index, member, CAST((start_index + 3) // 12 AS INT) AS target_year, {rsql('Pr')} AS Pr FROM h
WHERE lead = 3 AND (start_index + 3) % 12 = 1 AND (start_index + 3) // 12 BETWEEN 1996 AND 2000 AND member IN ('A', 'N')"""))
def s4(spark, sf_dir):
    from .distributions import hindcast_lens
    out = S.scan_hindcast(hindcast_lens(spark, sf_dir), 2, 3, 1996, 2000, ["A", "N"])
    return rounded(out.select("cell_id", "start_index", "member", "target_year", "Pr"), "Pr")


@query("s4b_available_hindcasts", """
WITH s AS (SELECT DISTINCT month(o_orderdate) AS month, day(o_orderdate) AS day FROM orders)
, p AS (SELECT ((y * 100 + month) * 100 + day) * 100 + h AS run, CAST((y * 12 + month - 1 + 2) // 12 * 100 + (y * 12 + month - 1 + 2) % 12 + 1 AS INT) AS target
        FROM s, range(1995, 2001) t(y), (VALUES (0), (6), (12), (18)) v(h) WHERE month = 12)
SELECT CAST(run AS BIGINT) AS run, target FROM p WHERE target // 100 <= 2000 AND run % 700 <> 6 AND run % 900 <> 18""")
def s4b(spark, sf_dir):
    d = F.col("o_orderdate")
    schedule = table(spark, sf_dir, "orders").select(F.month(d).alias("month"), F.day(d).alias("day")).distinct()
    every = S.available_hindcasts(schedule, 2, 2, 1996, 2000, spark.createDataFrame([], "run BIGINT, target INT"),
                                  spark.createDataFrame([], "run BIGINT, target INT"))
    missing, corrupt = every.where("run % 700 = 6"), every.where("run % 900 = 18")
    return S.available_hindcasts(schedule, 2, 2, 1996, 2000, missing, corrupt)


_CAL = "p_size % 3"


@query("s5_text_calendar", f"""
WITH s AS (SELECT p_partkey, p_size, p_size % 3 AS n FROM part)
SELECT CAST(p_partkey AS INT) AS unit_code, CAST(p_size % 26 + 1 AS INT) AS crop, CAST(i AS INT) AS subcrop, p_size * 10.5e0 * i AS area_ha,
       CAST(1 + (p_size + i) % 12 AS INT) AS plant_month, CAST(1 + (p_size * 5 + i) % 12 AS INT) AS harvest_month FROM s, range(1, 3) t(i) WHERE i <= n""")
def s5(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    def season(i):
        return F.concat_ws(" ", (F.col("p_size") * 10.5 * i).cast("string"), (1 + (F.col("p_size") + i) % 12).cast("string"),
                           (1 + (F.col("p_size") * 5 + i) % 12).cast("string"))
    n = F.col("p_size") % 3
    line = F.concat_ws(" ", F.col("p_partkey").cast("string"), (F.col("p_size") % 26 + 1).cast("string"), n.cast("string"),
                       F.when(n >= 1, season(1)), F.when(n >= 2, season(2)))
    return S.parse_calendar(part.select(line.alias("value")))


@query("s6_loss_parameters", """
SELECT round(avg(l_discount), 6) AS loss_initial, round(max(l_quantity), 6) AS loss_total, round(avg(l_tax), 6) AS loss_power,
       'max' AS loss_method, round(min(l_discount), 6) AS mean_loss_fit_a, round(max(l_tax), 6) AS mean_loss_fit_b FROM lineitem""")
def s6(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").agg(
        F.avg("l_discount").alias("loss_initial"), F.max("l_quantity").alias("loss_total"), F.avg("l_tax").alias("loss_power"),
        F.min("l_discount").alias("mean_loss_fit_a"), F.max("l_tax").alias("mean_loss_fit_b"))
    rows = li.select(*[F.format_string(" %s ", F.col(c).cast("string")).alias(c) for c in li.columns], F.lit("max").alias("loss_method"))
    out = S.loss_parameters(rows.unpivot([], rows.columns, "param", "value"))
    return rounded(out, *[c for c in out.columns if c != "loss_method"])


@query("s6b_variables", with_lenses("obs", "\nUNION ALL ".join(
    f"SELECT '{v}' AS variable, count({v}) AS n_defined FROM obs" for v in ("Pr", "T", "Ws", "RO_mm", "Bt_RO", "PETmE"))))
def s6b(spark, sf_dir):
    df = lens(spark, sf_dir, "obs")
    names = S.variables(df, ["cell_id", "yearmon", "month_index", "month"])
    return df.agg(*[F.count(n).alias(n) for n in names]).unpivot([], names, "variable", "n_defined")


@query("s7_sink_slices", with_lenses("obs", f"""
SELECT cell_id, yearmon, {rsql('CASE WHEN yearmon >= 200101 THEN Pr * 2 ELSE Pr END')} AS Pr FROM obs"""))
def s7(spark, sf_dir):
    path = f"{scratch_path(spark)}/sink-{uuid.uuid4().hex}"
    obs = lens(spark, sf_dir, "obs").select("cell_id", "yearmon", "Pr")
    K.sink(obs.where("yearmon < 200101"), path, ["yearmon"], "create", 2)
    K.sink(obs.where("yearmon >= 200101"), path, ["yearmon"], "append", 2)
    # the slice of a few months replaces them and nothing else
    K.sink(obs.where("yearmon >= 200101").withColumn("Pr", F.col("Pr") * 2), path, ["yearmon"], "slice", 2)
    return rounded(spark.read.parquet(path).select("cell_id", "yearmon", "Pr"), "Pr")


@query("s7b_provenance", with_lenses("obs", f"""
SELECT cell_id, CAST(200112 AS INT) AS yearmon, CAST(200112 AS INT) AS target, CAST(3 AS INT) AS "window", 'CFS' AS model, CAST(NULL AS VARCHAR) AS member, {rsql('sum(Pr)')} AS Pr
FROM obs GROUP BY cell_id"""))
def s7b(spark, sf_dir):
    sums = lens(spark, sf_dir, "obs").groupBy("cell_id").agg(r(F.sum("Pr")).alias("Pr"))
    return K.with_provenance(sums, 200112, window=3, model="CFS")


@query("s8_complete", with_lenses("members", f"""
SELECT k.cell_id, k.target, d.model, {rsql('s')} AS Pr FROM (SELECT DISTINCT cell_id, target FROM members) k, (VALUES ('A'), ('N'), ('R'), ('X')) d(model)
LEFT JOIN (SELECT cell_id, target, model, sum(Pr) AS s FROM members GROUP BY ALL) m ON m.cell_id = k.cell_id AND m.target = k.target AND m.model = d.model"""))
def s8(spark, sf_dir):
    sums = lens(spark, sf_dir, "members").groupBy("cell_id", "target", "model").agg(r(F.sum("Pr")).alias("Pr"))
    return J.complete(sums, ["cell_id", "target"], model=["A", "N", "R", "X"])


@query("s9_tables_to_features", "SELECT s_suppkey AS id, s_acctbal AS balance FROM supplier UNION ALL SELECT c_custkey, c_acctbal FROM customer")
def s9(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("FID"), F.col("s_acctbal").alias("BALANCE"), "s_name")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("fid"), F.col("c_acctbal").alias("Balance"), "c_mktsegment")
    return S.tables_to_features([s, c], "FID", ["Balance"])


@query("s10_sink_csv", with_lenses("obs", f"SELECT cell_id, month, {rsql('sum(Pr)')} AS Pr FROM obs GROUP BY 1, 2"))
def s10(spark, sf_dir):
    path = f"{scratch_path(spark)}/csv-{uuid.uuid4().hex}"
    K.sink_csv(lens(spark, sf_dir, "obs").groupBy("cell_id", "month").agg(r(F.sum("Pr")).alias("Pr")), path, ["cell_id", "month"])
    return spark.read.csv(path, header=True, schema="cell_id BIGINT, month INT, Pr DOUBLE")


@query("s11_read_integrated", with_lenses("obs", f"""
SELECT cell_id, {rsql('sum(Pr)')} AS Pr, 1 AS "window" FROM obs WHERE yearmon = 200011 GROUP BY 1
UNION ALL SELECT cell_id, {rsql('sum(Pr)')}, 12 FROM obs WHERE yearmon BETWEEN 199912 AND 200011 GROUP BY 1"""))
def s11(spark, sf_dir):
    obs = lens(spark, sf_dir, "obs")
    one = obs.where("yearmon = 200011").groupBy("cell_id").agg(r(F.sum("Pr")).alias("Pr"))
    twelve = obs.where("yearmon BETWEEN 199912 AND 200011").groupBy("cell_id").agg(r(F.sum("Pr")).alias("Pr"))
    return S.read_integrated([(None, one), (12, twelve)])


# ---- joins ------------------------------------------------------------------------------------------

@query("j1_merge_datasets", with_lenses("obs", f"SELECT cell_id, yearmon, {rsql('Pr')} AS Pr, {rsql('T')} AS T, {rsql('Ws')} AS Ws FROM obs"))
def j1(spark, sf_dir):
    obs = lens(spark, sf_dir, "obs")
    out = J.merge_datasets([obs.select("cell_id", "yearmon", "Pr"), obs.select("cell_id", "yearmon", "T"), obs.select("cell_id", "yearmon", "Ws")], ["cell_id", "yearmon"])
    return rounded(out, "Pr", "T", "Ws")


@query("j2_stack_layers", with_lenses("obs", f"""
SELECT cell_id, yearmon, 'Ws' AS layer, CAST(1 AS INT) AS position, {rsql('Ws')} AS value FROM obs
UNION ALL SELECT cell_id, yearmon, 'Pr', 2, {rsql('Pr')} FROM obs UNION ALL SELECT cell_id, yearmon, 'T', 3, {rsql('T')} FROM obs"""))
def j2(spark, sf_dir):
    return rounded(J.stack_layers(lens(spark, sf_dir, "obs"), ["cell_id", "yearmon"], ["Ws", "Pr", "T"]), "value")


@query("j2_unstack_layers", with_lenses("members", f"""
SELECT cell_id, target, {', '.join(rsql(f"sum(Pr) FILTER (model = '{m}')") + f' AS {m}' for m in 'ANR')} FROM members GROUP BY 1, 2"""))
def j2b(spark, sf_dir):
    long = lens(spark, sf_dir, "members").groupBy("cell_id", "target", F.col("model").alias("layer")).agg(F.sum("Pr").alias("value"))
    return rounded(J.unstack_layers(long, ["cell_id", "target"], ["A", "N", "R"]), "A", "N", "R")


_CALENDARS = """
WITH k AS (SELECT p_partkey % 97 AS unit_code, CAST(p_size % 5 AS INT) AS crop, p_brand AS brand, count(*) AS n FROM part GROUP BY ALL)
, a AS (SELECT * FROM k WHERE unit_code % 3 = 0 AND crop < 3), b AS (SELECT * FROM k WHERE unit_code % 3 = 0 OR crop = 1), c AS (SELECT * FROM k)
, ab AS (SELECT * FROM a UNION ALL SELECT * FROM b WHERE (unit_code, crop) NOT IN (SELECT (unit_code, crop) FROM a))
SELECT * FROM ab UNION ALL SELECT * FROM c WHERE (unit_code, crop) NOT IN (SELECT (unit_code, crop) FROM ab)"""


@query("j3_combine_calendars", _CALENDARS)
def j3(spark, sf_dir):
    k = table(spark, sf_dir, "part").groupBy((F.col("p_partkey") % 97).alias("unit_code"), (F.col("p_size") % 5).alias("crop"),
                                             F.col("p_brand").alias("brand")).agg(F.count("*").alias("n"))
    return J.combine_calendars(k.where("unit_code % 3 = 0 AND crop < 3"), k.where("unit_code % 3 = 0 OR crop = 1"), k)


@query("j4_attach_zone", with_lenses("coverage", """
SELECT c_custkey, z AS zone_id FROM customer LEFT JOIN (SELECT cell_id, min(zone_id) AS z FROM coverage GROUP BY 1) ON cell_id = c_custkey % (SELECT count(*) + 30 FROM supplier)"""))
def j4(spark, sf_dir):
    # as many places as cells, and 30 without a zone
    places = table(spark, sf_dir, "supplier").agg((F.count("*") + 30).alias("n")).scalar()
    points = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % places).alias("cell_id"))
    return J.attach_zone(points, lens(spark, sf_dir, "coverage")).select("c_custkey", "zone_id")


_SITES = """
, s AS (SELECT p_partkey AS site, ((p_partkey * 37) % 3600) / 10.0E0 - 180 + 0.003e0 * (p_partkey % 3) AS lon, ((p_partkey * 17) % 1800) / 10.0E0 - 90 + 0.002e0 * (p_partkey % 5) AS lat FROM part)
, v AS (SELECT id, site, 2 * 6371000e0 * asin(least(1e0, sqrt(pow(sin(radians(p.lat - s.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(s.lat)) * pow(sin(radians(p.lon - s.lon) / 2), 2)))) AS d
        FROM points p, s WHERE abs(p.lat - s.lat) < 0.1e0)"""


def _sites(spark, sf_dir):
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(k.alias("site"), ((k * 37) % 3600 / 10.0 - 180 + 0.003 * (k % 3)).alias("lon"),
                                               ((k * 17) % 1800 / 10.0 - 90 + 0.002 * (k % 5)).alias("lat"))


@query("j5_nearest_match", with_lenses("points", _SITES + f"""
SELECT id, arg_min(site, (round(d, 3), site)) AS site, {rsql('min(d)', 2)} AS distance_m FROM v WHERE d <= 1000 GROUP BY id"""))
def j5(spark, sf_dir):
    return rounded(J.nearest_match(lens(spark, sf_dir, "points"), _sites(spark, sf_dir), "id", "site", 1000.0), "distance_m", digits=2)


@query("j6_near_any", with_lenses("points", _SITES + """
SELECT p.id, count(v.id) > 0 AS near FROM points p LEFT JOIN v ON v.id = p.id AND d <= 500 GROUP BY p.id"""))
def j6(spark, sf_dir):
    return J.near_any(lens(spark, sf_dir, "points"), _sites(spark, sf_dir), "id", "site", 500.0)


_COARSE = ", c AS (SELECT row_no // 4 AS rr, col_no // 4 AS cc, sum(value) AS b FROM grid WHERE row_no // 4 % 5 <> 2 GROUP BY 1, 2)"


@query("j7_join_by_coarser", with_lenses("grid", _COARSE + f"""
SELECT cell_id, {rsql('value / b')} AS share, {rsql('coalesce(value + b, value, b)')} AS total FROM grid LEFT JOIN c ON rr = row_no // 4 AND cc = col_no // 4"""))
def j7(spark, sf_dir):
    g = lens(spark, sf_dir, "grid")
    from ..operators.spatial import block_aggregate
    coarse = block_aggregate(g, 4, "value", "sum").where("row_no % 5 <> 2")
    out = J.join_by_coarser(g, coarse, 4, "quotient", "value", "value", "share")
    out = J.join_by_coarser(out, coarse, 4, "sum", "value", "value", "total", ignore_missing=True)
    return rounded(out.select("cell_id", "share", "total"), "share", "total")


_TARGETS = ", t AS (SELECT DISTINCT cell_id, target FROM members)"


@query("j8b_synthetic_forecast", with_lenses("obs members", _TARGETS + f"""
, n AS (SELECT cell_id, month, avg(Pr) AS norm FROM obs GROUP BY 1, 2)
SELECT t.cell_id, t.target, {rsql('Pr')} AS perfect, {rsql('norm')} AS norm FROM t LEFT JOIN obs o ON o.cell_id = t.cell_id AND o.yearmon = t.target
LEFT JOIN n ON n.cell_id = t.cell_id AND n.month = t.target % 100"""))
def j8b(spark, sf_dir):
    obs = lens(spark, sf_dir, "obs")
    targets = lens(spark, sf_dir, "members").select("cell_id", "target").distinct()
    out = J.synthetic_forecast(targets, obs.select("cell_id", "yearmon", F.col("Pr").alias("perfect")), ["cell_id"], "yearmon")
    norm = I.climate_norm(obs, ["cell_id"], ["Pr"]).withColumnRenamed("Pr", "norm")
    return rounded(J.synthetic_forecast(out, norm, ["cell_id"], "month"), "perfect", "norm")


@query("j9_climatology_plus_anomaly", with_lenses("obs members", f"""
, a AS (SELECT cell_id, target, model, CAST(target % 100 AS INT) AS month, sum(Pr) / 1e6 AS p, avg(Pr) / 50 AS t FROM members GROUP BY 1, 2, 3)
, c AS (SELECT cell_id, month, avg(Pr) AS p, avg(T) + 280 AS t FROM obs GROUP BY 1, 2)
SELECT a.cell_id, target, model, {rsql('c.p / 86400 + a.p', 9)} AS Pr, {rsql('c.t + a.t')} AS T FROM a JOIN c ON c.cell_id = a.cell_id AND c.month = a.month"""))
def j9(spark, sf_dir):
    anom = lens(spark, sf_dir, "members").groupBy("cell_id", "target", "model").agg((F.sum("Pr") / 1e6).alias("Pr_anom"), (F.avg("Pr") / 50).alias("T_anom"))
    anom = anom.withColumn("month", (F.col("target") % 100).cast("int"))
    clim = lens(spark, sf_dir, "obs").groupBy("cell_id", "month").agg(F.avg("Pr").alias("Pr_clim"), (F.avg("T") + 280).alias("T_clim"))
    out = J.climatology_plus_anomaly(clim, anom, ["cell_id", "month"])
    return out.select("cell_id", "target", "model", r("Pr", 9).alias("Pr"), r("T").alias("T"))


@query("j10_best_of_versions", with_lenses("hourly", f"""
, v AS (SELECT cell_id, day, hour, CASE WHEN hour < 20 AND cell_id % 4 > 0 THEN precip END AS v1, precip * 1.1e0 AS v5 FROM hourly)
SELECT cell_id, day, hour, {rsql('CASE WHEN max(v1) OVER (PARTITION BY day, hour) IS NOT NULL THEN v1 ELSE v5 END')} AS precip FROM v"""))
def j10(spark, sf_dir):
    v = lens(spark, sf_dir, "hourly").select("cell_id", "day", "hour", F.when((F.col("hour") < 20) & (F.col("cell_id") % 4 > 0), F.col("precip")).alias("v1"),
                                             (F.col("precip") * 1.1).alias("v5"))
    return rounded(J.best_of_versions(v, ["day", "hour"], "v1", "v5", "precip").select("cell_id", "day", "hour", "precip"), "precip")


@query("j11_collapse_ids", with_lenses("network", """
, n AS (SELECT id * 10 + id % 3 AS id, CASE WHEN downstream_id = 0 THEN 0 ELSE downstream_id * 10 + downstream_id % 3 END AS downstream_id FROM network)
, m AS (SELECT id AS old, row_number() OVER (ORDER BY id) AS new FROM n)
SELECT a.new AS id, CAST(CASE WHEN n.downstream_id = 0 THEN 0 ELSE b.new END AS BIGINT) AS downstream_id FROM n JOIN m a ON a.old = n.id LEFT JOIN m b ON b.old = n.downstream_id"""))
def j11(spark, sf_dir):
    d = F.col("downstream_id")
    n = lens(spark, sf_dir, "network").select((F.col("id") * 10 + F.col("id") % 3).alias("id"), F.when(d == 0, 0).otherwise(d * 10 + d % 3).alias("downstream_id"))
    return J.collapse_ids(n, "id", ["downstream_id"])


@query("j12_combos", "SELECT s_suppkey, w AS \"window\", q AS quantile FROM supplier, (VALUES (1), (3), (6)) a(w), (VALUES (25), (50), (75)) b(q)")
def j12(spark, sf_dir):
    return J.combos(table(spark, sf_dir, "supplier").select("s_suppkey"), window=[1, 3, 6], quantile=[25, 50, 75])


# ---- checks -----------------------------------------------------------------------------------------

@query("q1_check_range", with_lenses("obs", """
, c AS (SELECT 'T' AS variable, count(*) FILTER (T < 1) AS too_low, count(*) FILTER (T > 8) AS too_high FROM obs
        UNION ALL SELECT 'Pr', count(*) FILTER (Pr < 0), count(*) FILTER (Pr > 5000) FROM obs)
SELECT *, CASE WHEN greatest(too_low, too_high) > 5 THEN 'error' WHEN greatest(too_low, too_high) > 0 THEN 'warning' ELSE 'ok' END AS verdict FROM c"""))
def q1(spark, sf_dir):
    return Q.check_range(lens(spark, sf_dir, "obs"), {"T": (1.0, 8.0), "Pr": Q.FORCING_RANGES["Pr"]})


@query("q2_check_congruent", with_lenses("obs", """
, a AS (SELECT DISTINCT cell_id, month_index FROM obs WHERE month < 9), b AS (SELECT cell_id, month_index + 12 AS month_index FROM a WHERE cell_id % 2 = 0)
SELECT cell_id, month_index, 'second' AS absent_from FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT cell_id, month_index, 'first' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)"""))
def q2(spark, sf_dir):
    a = lens(spark, sf_dir, "obs").where("month < 9").select("cell_id", "month_index")
    b = a.where("cell_id % 2 = 0").select("cell_id", (F.col("month_index") + 12).alias("month_index"))
    return Q.check_congruent(a, b, ["cell_id", "month_index"])


@query("q3_check_units", with_lenses("obs", f"SELECT cell_id, {rsql('sum(Pr)')} AS Pr FROM obs GROUP BY 1"))
def q3(spark, sf_dir):
    df = Q.with_units(lens(spark, sf_dir, "obs"), Pr="mm", T="degree_Celsius")
    Q.check_units(df, "Pr", "mm")
    return df.groupBy("cell_id").agg(r(F.sum("Pr")).alias("Pr"))


@query("q4_check_contiguous_months", with_lenses("obs", """
, l AS (SELECT cell_id, month_index, lag(month_index) OVER (PARTITION BY cell_id ORDER BY month_index) AS after FROM obs)
SELECT cell_id, month_index AS resumes, after FROM l WHERE month_index <> after + 1"""))
def q4(spark, sf_dir):
    return Q.check_contiguous_months(lens(spark, sf_dir, "obs"), ["cell_id"])


@query("q5_check_links", with_lenses("network", """
, n AS (SELECT * FROM network WHERE id % 50 <> 7)
SELECT id, downstream_id FROM n WHERE downstream_id > 0 AND downstream_id NOT IN (SELECT id FROM n)"""))
def q5(spark, sf_dir):
    return Q.check_links(lens(spark, sf_dir, "network").where("id % 50 <> 7"))


_FITTED = ", f AS (SELECT DISTINCT cell_id, month FROM obs WHERE yearmon < 199607), o AS (SELECT DISTINCT cell_id, month FROM obs WHERE yearmon >= 200110 OR cell_id % 10 = 4)"


def _fitted(spark, sf_dir):
    obs = lens(spark, sf_dir, "obs")
    return obs.where("yearmon < 199607").select("cell_id", "month"), obs.where("yearmon >= 200110 OR cell_id % 10 = 4").select("cell_id", "month")


@query("q6_unused_and_missing_fits", with_lenses("obs", _FITTED + """
SELECT *, 'unused' AS kind FROM (SELECT * FROM f EXCEPT SELECT * FROM o) UNION ALL SELECT *, 'missing' FROM (SELECT * FROM o EXCEPT SELECT * FROM f)"""))
def q6(spark, sf_dir):
    fits, obs = _fitted(spark, sf_dir)
    on = ["cell_id", "month"]
    return Q.unused_fits(fits, obs, on).withColumn("kind", F.lit("unused")).unionByName(Q.missing_fits(fits, obs, on).withColumn("kind", F.lit("missing")))


@query("q7_check_complete_days", with_lenses("hourly", """
SELECT day, count(DISTINCT hour) AS hours FROM hourly WHERE NOT (day(day) % 5 = 1 AND hour = 3) AND day <> DATE '2024-01-01' GROUP BY day HAVING count(DISTINCT hour) <> 24"""))
def q7(spark, sf_dir):
    return Q.check_complete_days(lens(spark, sf_dir, "hourly").where("NOT (day(day) % 5 = 1 AND hour = 3)"), "2024-01-01")


@query("q8_check_missing_days", with_lenses("daily", """
SELECT day FROM daily GROUP BY day HAVING count(CASE WHEN day(day) % 7 <> 2 THEN precip END) = 0 AND day <> DATE '2024-01-09'"""))
def q8(spark, sf_dir):
    d = lens(spark, sf_dir, "daily").withColumn("precip", F.when(F.day("day") % 7 != 2, F.col("precip")))
    known = d.select("day").distinct().where(F.col("day") == F.lit("2024-01-09").cast("date"))
    return Q.check_missing_days(d, "precip", known)


@query("q9_integer_ids", "SELECT CAST(c_custkey AS BIGINT) AS id FROM customer")
def q9(spark, sf_dir):
    ids = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 2 == 0, F.concat(F.col("c_custkey").cast("string"), F.lit(".0")))
                                                  .otherwise(F.col("c_custkey").cast("string")).alias("id"))
    return Q.integer_ids(ids, "id")


@query("q9_not_integer", "SELECT CAST(l_discount * 100 + l_orderkey AS VARCHAR) AS id FROM lineitem WHERE FALSE UNION ALL SELECT printf('%.2f', l_tax + l_orderkey) FROM lineitem WHERE round(l_tax * 100) <> 0")
def q9_bad(spark, sf_dir):
    return Q.not_integer(table(spark, sf_dir, "lineitem").select(F.format_string("%.2f", F.col("l_tax") + F.col("l_orderkey")).alias("id")), "id")

"""Zones, blocks of cells, and flow networks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..lenses import lens, table, with_lenses
from ..operators import network as N
from ..operators import spatial as Z
from .registry import query, r, rounded, rsql


@query("z1_zonal_stats", with_lenses("obs coverage", f"""
SELECT zone_id, yearmon, {rsql('min(CASE WHEN fraction > 0 THEN Pr END)')} AS Pr_min, {rsql('max(CASE WHEN fraction > 0 THEN Pr END)')} AS Pr_max,
       {rsql('sum(Pr * fraction) / sum(fraction)')} AS Pr_mean, {rsql('sum(Pr * fraction)')} AS Pr_sum
FROM obs JOIN coverage ON coverage.cell_id = obs.cell_id GROUP BY 1, 2"""))
def z1(spark, sf_dir):
    out = Z.zonal_stats(lens(spark, sf_dir, "obs"), lens(spark, sf_dir, "coverage"), ["Pr"], ["yearmon"])
    return rounded(out, "Pr_min", "Pr_max", "Pr_mean", "Pr_sum")


@query("z2_zonal_weighted_sum", with_lenses("obs coverage", f"""
SELECT zone_id, {rsql('sum(fraction * Pr * T)', 4)} AS weighted FROM obs JOIN coverage ON coverage.cell_id = obs.cell_id GROUP BY 1"""))
def z2(spark, sf_dir):
    out = Z.zonal_weighted_sum(lens(spark, sf_dir, "obs"), lens(spark, sf_dir, "coverage"), "Pr", "T", "weighted")
    return rounded(out, "weighted", digits=4)


_LABELS = ["lt_3", "3_5", "5_10", "10_20", "20_40", "gt_40"]


@query("z3_zonal_class_fractions", with_lenses("obs coverage", f"""
, v AS (SELECT zone_id, yearmon, CASE WHEN Ws IS NULL OR Ws < 3 THEN 0 WHEN Ws < 5 THEN 1 WHEN Ws < 10 THEN 2 WHEN Ws < 20 THEN 3 WHEN Ws < 40 THEN 4 ELSE 5 END AS c,
        fraction * 1000 AS a, CASE WHEN month = 2 THEN NULL ELSE Pr END AS p FROM obs JOIN coverage ON coverage.cell_id = obs.cell_id)
, z AS (SELECT zone_id, yearmon, {', '.join(rsql(f'sum(CASE WHEN c = {i} THEN a ELSE 0 END) / nullif(sum(a), 0)') + f' AS area_weighted_frac_Ws_{n}' for i, n in enumerate(_LABELS))},
        {', '.join(rsql(f'sum(CASE WHEN c = {i} THEN a * coalesce(p, 0) ELSE 0 END) / nullif(sum(a * coalesce(p, 0)), 0)') + f' AS pop_weighted_frac_Ws_{n}' for i, n in enumerate(_LABELS))}
        FROM v GROUP BY 1, 2)
SELECT z.*, n_name AS country FROM z LEFT JOIN nation ON n_nationkey + 1 = zone_id"""))
def z3(spark, sf_dir):
    obs = lens(spark, sf_dir, "obs").withColumn("pop", F.when(F.col("month") != 2, F.col("Pr")))
    cov = lens(spark, sf_dir, "coverage").withColumn("area_m2", F.col("fraction") * 1000)
    zones = table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 1).alias("zone_id"), F.col("n_name").alias("NAME"))
    out = Z.zonal_class_fractions(obs, cov, "Ws", ["pop"], zones, {"NAME": "country"}, by=["yearmon"])
    return rounded(out, *[c for c in out.columns if "_frac_" in c])


@query("z4_block_aggregate", with_lenses("grid", f"""
SELECT CAST(row_no // 5 AS INT) AS row_no, CAST(col_no // 5 AS INT) AS col_no, {rsql('sum(value)')} AS total, {rsql('avg(value)')} AS mean FROM grid GROUP BY 1, 2"""))
def z4(spark, sf_dir):
    g = lens(spark, sf_dir, "grid")
    a = Z.block_aggregate(g, 5, "value", "sum").withColumnRenamed("value", "total")
    b = Z.block_aggregate(g, 5, "value", "mean").withColumnRenamed("value", "mean")
    return rounded(a.join(b, ["row_no", "col_no"]), "total", "mean")


_DOY = """, a AS (SELECT row_no // 2 AS row_no, col_no // 2 AS col_no, atan2(sum(sin((d - 1) * 2 * pi() / 365)), sum(cos((d - 1) * 2 * pi() / 365))) AS m FROM g GROUP BY 1, 2)
, b AS (SELECT row_no, col_no, 1 + floor(CASE WHEN m < 0 THEN m + 2 * pi() ELSE m END / (2 * pi() / 365) + 0.5e0 + 1e-9) AS doy FROM a)
SELECT CAST(row_no AS INT) AS row_no, CAST(col_no AS INT) AS col_no, CAST(CASE WHEN doy > 365 THEN doy - 365 ELSE doy END AS INT) AS d FROM b"""


@query("z5_block_mean_doy", with_lenses("grid calendar", """
, g AS (SELECT row_no, col_no, CASE WHEN value IS NOT NULL THEN harvest_doy + 0.37e0 END AS d FROM grid JOIN calendar ON calendar.cell_id = grid.cell_id)
""" + _DOY))
def z5(spark, sf_dir):
    # the fraction of a day keeps the mean off rounding boundaries
    g = lens(spark, sf_dir, "grid").join(lens(spark, sf_dir, "calendar"), "cell_id").select(
        "row_no", "col_no", F.when(F.col("value").isNotNull(), F.col("harvest_doy") + 0.37).alias("d"))
    return Z.block_mean_doy(g, 2, "d")


@query("z6_disaggregate", with_lenses("grid", f"""
SELECT CAST(row_no * 3 + i AS INT) AS row_no, CAST(col_no * 3 + j AS INT) AS col_no, d8, {rsql('value / 9')} AS value FROM grid, range(3) a(i), range(3) b(j)"""))
def z6(spark, sf_dir):
    return rounded(Z.disaggregate(lens(spark, sf_dir, "grid"), 3, ["value"]).select("row_no", "col_no", "d8", "value"), "value")


@query("z7_one_degree_to_half", with_lenses("grid", f"""
, d AS (SELECT max(row_no) + 1 AS rows FROM grid)
, h AS (SELECT i AS row_no, CASE WHEN i = 0 THEN 0 ELSE (i + 1) // 2 END AS src FROM d, range(0, 2 * rows - 2) t(i))
, w AS (SELECT j AS col_no, CASE WHEN j = 0 OR j = 79 THEN 39 ELSE (j - 1) // 2 END AS src FROM range(80) t(j))
SELECT CAST(h.row_no AS INT) AS row_no, CAST(w.col_no AS INT) AS col_no, {rsql('value')} AS value FROM h, w JOIN grid g ON g.row_no = h.src AND g.col_no = w.src"""))
def z7(spark, sf_dir):
    g = lens(spark, sf_dir, "grid").select("row_no", "col_no", "value")
    rows, cols = N.grid_dims(g)
    return rounded(Z.one_degree_to_half(g, rows, cols), "value")


@query("z8_align_flow_grid", with_lenses("grid", """
, d AS (SELECT max(row_no) + 1 AS rows FROM grid)
SELECT CAST(row_no + 2 AS INT) AS row_no, CAST((col_no + 39) % 40 AS INT) AS col_no, d8 FROM grid
UNION ALL SELECT CAST(i AS INT), CAST(j AS INT), CAST(NULL AS INT) FROM d, range(0, 2) a(i), range(40) b(j)
UNION ALL SELECT CAST(rows + 2 + i AS INT), CAST(j AS INT), NULL FROM d, range(0, 4) a(i), range(40) b(j)"""))
def z8(spark, sf_dir):
    g = lens(spark, sf_dir, "grid").select("row_no", "col_no", "d8")
    rows, cols = N.grid_dims(g)
    return Z.align_flow_grid(g, (-0.5, 19.5, 0.0, rows * 0.5), (rows, cols), (0.0, 20.0, -2.0, rows * 0.5 + 1.0), (rows // 2, cols // 2))


_D8NET = """
, dm AS (SELECT max(row_no) + 1 AS rows FROM grid)
, e AS (SELECT row_no, col_no, d8, value, row_no + CASE WHEN d8 IN (2, 4) THEN 1 ELSE 0 END AS tr, col_no + CASE WHEN d8 IN (1, 2) THEN 1 ELSE 0 END AS tc FROM grid)
, net AS (SELECT row_no, col_no, d8, value, CAST(row_no AS BIGINT) * 40 + col_no + 1 AS id,
          CAST(CASE WHEN d8 = 0 OR tc >= 40 OR tr >= rows THEN 0 ELSE tr * 40 + tc + 1 END AS BIGINT) AS downstream_id FROM e, dm)"""
_UP = """
, up AS (SELECT id AS root, id FROM {net} UNION ALL SELECT up.root, n.id FROM up JOIN {net} n ON n.downstream_id = up.id)"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def _d8net(spark, sf_dir):
    g = lens(spark, sf_dir, "grid")
    rows, cols = N.grid_dims(g)
    return N.d8_to_network(g, rows, cols), rows, cols


@query("z9_aggregate_flows", with_lenses("grid", _D8NET + f"""
SELECT CAST(row_no // 5 AS INT) AS row_no, CAST(col_no // 5 AS INT) AS col_no,
       {rsql('sum(CASE WHEN downstream_id > 0 AND (downstream_id - 1) // 40 // 5 = row_no // 5 AND (downstream_id - 1) % 40 // 5 = col_no // 5 THEN NULL ELSE value END)')} AS value
FROM net GROUP BY 1, 2"""))
def z9(spark, sf_dir):
    net, _, cols = _d8net(spark, sf_dir)
    return rounded(N.aggregate_flows(net, cols, 5, "value"), "value")


_GAPPY = ", net AS (SELECT id, downstream_id, CASE WHEN id % 131 = 7 THEN NULL ELSE flow END AS flow FROM network)"


def _gappy(spark, sf_dir):
    return lens(spark, sf_dir, "network").withColumn("flow", F.when(F.col("id") % 131 != 7, F.col("flow")))


@query("n1_accumulate", _recursive(with_lenses("network", _GAPPY + _UP.format(net="net") + """
SELECT root AS id, CASE WHEN count(*) = count(flow) THEN sum(flow) END AS flow_out FROM up JOIN net ON net.id = up.id GROUP BY root""")))
def n1(spark, sf_dir):
    return N.accumulate(_gappy(spark, sf_dir))


@query("n2_downstream_flow", _recursive(with_lenses("network", _GAPPY + """
, dn AS (SELECT id AS root, downstream_id AS at FROM net UNION ALL SELECT dn.root, n.downstream_id FROM dn JOIN net n ON n.id = dn.at)
SELECT root AS id, CASE WHEN count(net.id) = count(flow) THEN coalesce(sum(flow), 0e0) END AS flow_downstream FROM dn LEFT JOIN net ON net.id = dn.at GROUP BY root""")))
def n2(spark, sf_dir):
    return N.downstream_flow(_gappy(spark, sf_dir))


@query("n3_d8_to_network", with_lenses("grid", _D8NET + "SELECT id, downstream_id FROM net"))
def n3(spark, sf_dir):
    return _d8net(spark, sf_dir)[0].select("id", "downstream_id")


@query("n4_inward_directions", with_lenses("grid", _D8NET + """
SELECT n.id, CAST(coalesce(sum(u.d8), 0) AS INT) AS inward FROM net n LEFT JOIN net u ON u.downstream_id = n.id GROUP BY n.id"""))
def n4(spark, sf_dir):
    return N.inward_directions(_d8net(spark, sf_dir)[0]).select("id", "inward")


@query("n5_accumulate_grid", _recursive(with_lenses("grid", _D8NET + _UP.format(net="net") + f"""
SELECT n.row_no, n.col_no, {rsql('CASE WHEN any_value(n.id) IS NOT NULL AND (count(*) > 1 OR max(n.value) IS NOT NULL) THEN sum(coalesce(u.value, 0)) END')} AS value
FROM up JOIN net u ON u.id = up.id JOIN net n ON n.id = up.root GROUP BY 1, 2""")))
def n5(spark, sf_dir):
    g = lens(spark, sf_dir, "grid")
    rows, cols = N.grid_dims(g)
    return rounded(N.accumulate_grid(g, g, rows, cols), "value")


@query("n5_accumulate_finer_grid", _recursive(with_lenses("grid", _D8NET + _UP.format(net="net") + f"""
, cr AS (SELECT row_no // 5 AS rr, col_no // 5 AS cc, avg(value) AS v FROM grid WHERE (row_no // 5 + col_no // 5) % 6 <> 1 GROUP BY 1, 2)
, fn AS (SELECT net.id, net.row_no, net.col_no, net.downstream_id, v / 25 AS v FROM net LEFT JOIN cr ON rr = row_no // 5 AND cc = col_no // 5)
, ac AS (SELECT n.id, n.row_no, n.col_no, n.downstream_id, CASE WHEN count(*) > 1 OR max(n.v) IS NOT NULL THEN sum(coalesce(u.v, 0)) END AS s
         FROM up JOIN fn u ON u.id = up.id JOIN fn n ON n.id = up.root GROUP BY 1, 2, 3, 4)
SELECT CAST(row_no // 5 AS INT) AS row_no, CAST(col_no // 5 AS INT) AS col_no,
       {rsql('sum(CASE WHEN downstream_id > 0 AND (downstream_id - 1) // 40 // 5 = row_no // 5 AND (downstream_id - 1) % 40 // 5 = col_no // 5 THEN NULL ELSE s END)')} AS value
FROM ac GROUP BY 1, 2""")))
def n5_fine(spark, sf_dir):
    g = lens(spark, sf_dir, "grid")
    rows, cols = N.grid_dims(g)
    coarse = Z.block_aggregate(g, 5, "value", "mean").where("(row_no + col_no) % 6 <> 1")
    return rounded(N.accumulate_grid(g, coarse, rows, cols, factor=5), "value")


_BASINS = """
, cov AS (SELECT c_custkey % (SELECT count(*) FROM supplier) AS cell_id, CAST(c_custkey + 1 AS BIGINT) AS zone_id, 0.5e0 + (c_custkey % 2) / 2e0 AS fraction FROM customer)
, ro AS (SELECT cell_id, {by} sum(RO_mm) AS RO_mm FROM obs GROUP BY ALL)
, lo AS (SELECT zone_id AS id, {by} sum(RO_mm * fraction) AS RO_mm FROM ro JOIN cov ON cov.cell_id = ro.cell_id GROUP BY ALL)
, net AS (SELECT id, downstream_id FROM network)""" + _UP.format(net="net")


def _basins(spark, sf_dir, by):
    runoff = lens(spark, sf_dir, "obs").groupBy("cell_id", *by).agg(F.sum("RO_mm").alias("RO_mm"))
    cells = table(spark, sf_dir, "supplier").agg(F.count("*").alias("n")).scalar()
    k = F.col("c_custkey")
    cov = table(spark, sf_dir, "customer").select((k % cells).alias("cell_id"), (k + 1).alias("zone_id"), (0.5 + (k % 2) / 2.0).alias("fraction"))
    return rounded(N.basin_results(runoff, cov, lens(spark, sf_dir, "network"), "RO_mm", by), "Bt_RO_mm", "RO_mm", digits=4)


@query("n6_basin_results", _recursive(with_lenses("obs network", _BASINS.format(by="") + f"""
, t AS (SELECT root, CASE WHEN count(*) = count(lo.RO_mm) THEN sum(lo.RO_mm) END AS total FROM up LEFT JOIN lo ON lo.id = up.id GROUP BY root)
SELECT root AS id, {rsql('total', 4)} AS Bt_RO_mm, {rsql('me.RO_mm', 4)} AS RO_mm FROM t LEFT JOIN lo me ON me.id = root""")))
def n6(spark, sf_dir):
    return _basins(spark, sf_dir, [])


@query("n6_basin_results_by_month", _recursive(with_lenses("obs network", _BASINS.format(by="month,") + f"""
, nn AS (SELECT root, count(*) AS n FROM up GROUP BY root)
, t AS (SELECT root, month, count(lo.RO_mm) AS n, sum(lo.RO_mm) AS total FROM up JOIN lo ON lo.id = up.id GROUP BY ALL)
SELECT t.root AS id, t.month, {rsql('CASE WHEN t.n = nn.n THEN total END', 4)} AS Bt_RO_mm, {rsql('me.RO_mm', 4)} AS RO_mm
FROM t JOIN nn ON nn.root = t.root LEFT JOIN lo me ON me.id = t.root AND me.month = t.month""")))
def n6_by_month(spark, sf_dir):
    return _basins(spark, sf_dir, ["month"])

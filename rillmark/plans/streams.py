"""Streams drained over the given tables, and user functions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..lenses import lens, table, with_lenses
from ..operators import cells as U
from ..operators import composite as K
from ..operators import fit as D
from ..operators import integrate as I
from ..session import scratch_path
from ..streaming import jobs as R
from . import sqltext as S
from .registry import query, r, rounded, rsql


def _places(spark, name):
    base = f"{scratch_path(spark)}/{name}-{uuid.uuid4().hex}"
    return f"{base}/data", f"{base}/progress"


_CLOSED = """, e AS (SELECT user_id AS cell_id, CAST(ts AS DATE) AS day, sum(value) AS precip FROM events GROUP BY 1, 2)
, c AS (SELECT * FROM e WHERE CAST(day AS TIMESTAMP) + INTERVAL 24 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 36 HOUR)"""


@query("r1_stream_daily_wet", "WITH " + _CLOSED[2:] + f"""
SELECT cell_id, CAST(year(day)*100 + month(day) AS INT) AS yearmon, {rsql('count(*) FILTER (precip > 60) * 1e0 / count(precip)')} AS pWetDays FROM c GROUP BY 1, 2""")
def r1(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    events = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
              .select(F.col("user_id").alias("cell_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("precip")))
    data, progress = _places(spark, "daily")
    R.run_to_files(R.daily_totals(events, ["cell_id"], "ts", "precip", "36 hours"), data, progress, drain=True).awaitTermination()
    daily = spark.read.schema("cell_id BIGINT, day DATE, precip DOUBLE").parquet(data)
    return rounded(R.monthly_wet_days(daily, ["cell_id"], "precip", 60.0), "pWetDays")


_R2 = S.gev("f", "obs", "cell_id, month", "Pr", 5, 5) + f"""
, sc AS (SELECT o.cell_id, o.yearmon, {S.cdf_gev('Pr')} AS p FROM obs o LEFT JOIN f ON f.cell_id = o.cell_id AND f.month = o.month WHERE o.yearmon >= 200001)
, sa AS (SELECT cell_id, yearmon, {S.bounded_sa('p')} AS sa FROM sc)
, rp AS (SELECT *, {S.sa2rp('sa')} AS rp FROM sa)"""


@query("r2_stream_score", with_lenses("obs", _R2 + f"""
SELECT cell_id, yearmon, {rsql('sa', 4)} AS Pr_sa, {rsql('rp', 3)} AS Pr_rp, {rsql('least(greatest(rp, -60), 60)', 3)} AS surplus FROM rp"""))
def r2(spark, sf_dir):
    obs = lens(spark, sf_dir, "obs").select("cell_id", "month", "yearmon", "Pr")
    fits = D.fit(obs, ["cell_id", "month"], "Pr", nmin_defined=5, nmin_unique=5, bounded=True)
    arriving, progress = _places(spark, "arriving")
    obs.where("yearmon >= 200001").write.parquet(arriving)
    stream = spark.readStream.schema(obs.schema).option("maxFilesPerTrigger", 4).parquet(arriving)
    scored = K.composite_surplus(R.score(stream, fits, ["cell_id", "month"], "Pr"), ["Pr_rp"], 60.0)
    data = f"{progress}-scores"
    R.run_scored(scored.select("cell_id", "yearmon", "Pr_sa", "Pr_rp", "surplus"), data, progress, drain=True).awaitTermination()
    out = spark.read.parquet(data).drop("batch")
    return out.select("cell_id", "yearmon", r("Pr_sa", 4).alias("Pr_sa"), r("Pr_rp", 3).alias("Pr_rp"), r("surplus", 3).alias("surplus"))


@query("u2_cell_apply", with_lenses("obs", f"""
, d AS (SELECT cell_id, Pr - lag(Pr) OVER (PARTITION BY cell_id ORDER BY month_index) AS step FROM obs)
SELECT cell_id, {rsql('max(abs(step))')} AS largest_step FROM d GROUP BY 1"""))
def u2(spark, sf_dir):
    import numpy as np

    def largest_step(values):
        return float(np.nanmax(np.abs(np.diff(values))))

    out = U.cell_apply(lens(spark, sf_dir, "obs"), ["cell_id"], "Pr", "month_index", largest_step, "largest_step DOUBLE")
    return rounded(out, "largest_step")


@query("u3_cell_apply_with_parameters", with_lenses("obs", f"""
, p AS (SELECT cell_id, avg(Pr) AS location FROM obs WHERE cell_id % 10 <> 7 GROUP BY 1)
SELECT o.cell_id, CASE WHEN any_value(location) IS NOT NULL THEN count(*) FILTER (Pr > location) ELSE -1 END AS above FROM obs o LEFT JOIN p ON p.cell_id = o.cell_id GROUP BY 1"""))
def u3(spark, sf_dir):
    obs = lens(spark, sf_dir, "obs")
    params = obs.where("cell_id % 10 <> 7").groupBy("cell_id").agg(F.avg("Pr").alias("location"))

    def above(values, parameters):
        return int((values > parameters["location"]).sum()) if parameters else -1

    return U.cell_apply_with_parameters(obs, params, ["cell_id"], "Pr", "month_index", above, "above BIGINT")


@query("u4_random_fill", with_lenses("layers", f"""
, w AS (SELECT s.cell_id, CAST(p AS INT) AS position, ((cell_id % 9 - 4) + p - 1 + 23939) AS at, (CAST('0x' || substr(md5('11|' || cell_id || '|' || (p - 1)), 1, 12) AS BIGINT) + 0.5e0) / 281474976710656e0 AS u
        FROM (SELECT DISTINCT cell_id FROM layers) s CROSS JOIN range(1, 13) t(p))
SELECT w.cell_id, position, {rsql('CASE WHEN l.cell_id IS NOT NULL THEN l.value ELSE ' + S.ppf('u') + ' END')} AS value
FROM w LEFT JOIN layers l ON l.cell_id = w.cell_id AND l.layer = w.at"""))
def u4(spark, sf_dir):
    df = lens(spark, sf_dir, "layers").withColumn("pos", F.col("layer") - 23939)
    starts = df.select("cell_id").distinct().withColumn("start", F.col("cell_id").cast("int") % 9 - 4)
    return rounded(I.layer_slice(df, starts, ["cell_id"], "pos", "value", "start", 12, seed=11), "value")

"""Time the headline queries: BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_QUERIES=all every query."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from rillmark.operators.integrate import plain_stat
from rillmark.plans import load_all
from rillmark.session import build_session

HEADLINE = [
    "flagship_composite", "a1_sum", "a4_quantiles", "a4_quantiles_of_raw_lines", "a10_weighted_quantile", "a12_rank_in_history",
    "a14_integrate", "a17_ensemble_summary", "a18_climate_norm", "w1_rolling_integrate", "w2_rolling_integrate_many", "w4_rolling_forecast",
    "d2_fit_gev", "d6_fit_by_month", "d10_standard_anomaly", "d13_return_period", "d14_nonparametric_anomaly", "d15_bias_correct",
    "c5_standard_composite", "z1_zonal_stats", "z3_zonal_class_fractions", "z4_block_aggregate", "n1_accumulate", "n2_downstream_flow",
    "n5_accumulate_grid", "e5_basin_loss_factors", "e9_summarize_losses", "g9_cumulative_crop_loss", "g12_summarize_crop_loss",
    "g16_yield_features", "g18_aggregate_yield", "j5_nearest_match", "j10_best_of_versions", "r1_stream_daily_wet",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def published_sum(spark, repeats: int = 20) -> dict[str, float]:
    """The published figure: sum per cell, 10,000 cells × 100 layers with 1 % missing, data in memory (median).

    Once as rows kept by cell, once as one vector per cell (the layout of the published run).
    """
    rows = spark.range(1_000_000).select(
        (F.col("id") % 10_000).alias("cell_id"), F.when(F.xxhash64("id") % 100 != 0, F.rand(3)).alias("value")).repartition("cell_id").cache()
    rows.count()
    vectors = rows.groupBy("cell_id").agg(F.collect_list(F.struct("value")).alias("v")).coalesce(
        spark.sparkContext.defaultParallelism).cache()
    vectors.count()
    plans = {
        "published_sum_rows": rows.groupBy("cell_id").agg(plain_stat("sum", F.col("value")).alias("s")),
        "published_sum_vectors": vectors.select("cell_id", F.aggregate("v", F.lit(0.0), lambda a, x: a + F.coalesce(x["value"], F.lit(0.0))).alias("s")),
    }
    out = {}
    for name, plan in plans.items():
        times = []
        for _ in range(repeats):
            began = time.perf_counter()
            run(plan)
            times.append(time.perf_counter() - began)
        out[name] = sorted(times)[len(times) // 2]
    rows.unpersist()
    vectors.unpersist()
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false", spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    registry = load_all().QUERIES
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(registry) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    run(registry["a1_sum"](spark, sf_dir))
    times = {}
    for name in names:
        began = time.perf_counter()
        try:
            run(registry[name](spark, sf_dir))
        except Exception as exc:
            print(f"{name}: {str(exc)[:500]}", file=sys.stderr)
            continue
        times[name] = round(time.perf_counter() - began, 3)
        print(f"{name}: {times[name]}", file=sys.stderr)
    if not chosen:
        times |= {n: round(t, 4) for n, t in published_sum(spark).items()}
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()

"""Crops, power, checks, calendars, sources and sinks."""

import datetime

import pytest
from pyspark.sql import functions as F

from rillmark.functions import calendar as C
from rillmark.functions import crops as X
from rillmark.functions import power as P
from rillmark.functions import transforms as T
from rillmark.operators import crops as G
from rillmark.operators import joins as J
from rillmark.operators import power as E
from rillmark.operators import quality as Q
from rillmark.sources import scan as S
from rillmark.sources import sink as K


def test_seasons_over_the_year_end(spark):
    cal = spark.createDataFrame([("summer", 100, 250), ("winter", 280, 120), ("none", None, 120)], "name STRING, p INT, h INT")
    days = J.combos(cal, d=list(range(1, 366)))
    p, h, d = F.col("p"), F.col("h"), F.col("d")
    out = days.select("name", "d", X.is_growing_season(d, p, h).alias("on"), X.days_since_planting(d, p, h).alias("since"), X.days_until_harvest(d, p, h).alias("until"))
    got = {(r.name, r.d): r for r in out.collect()}
    assert got["none", 5].on is None and got["none", 5].since is None
    season = {"summer": list(range(100, 251)), "winter": list(range(280, 366)) + list(range(1, 121))}
    for name, order in season.items():
        for d in range(1, 366):
            r = got[name, d]
            assert r.on == (d in order)
            assert r.since == (order.index(d) if d in order else None)
            assert r.until == (len(order) - 1 - order.index(d) if d in order else None)
    # the months of a year add up to the season, split by the year of harvest
    months = J.combos(cal, m=list(range(1, 13)))
    f, t = C.start_of_month(F.col("m")), C.end_of_month(F.col("m"))
    sums = months.groupBy("name").agg(F.sum(X.growing_days_this_year(f, t, p, h)).alias("a"), F.sum(X.growing_days_next_year(f, t, p, h)).alias("b"))
    assert {r.name: (r.a, r.b) for r in sums.collect()} == {"summer": (151, 0), "winter": (120, 86), "none": (None, None)}


def sequential_losses(months, plant, harvest):
    """The rule month by month: (days, rest) of this and of next year's harvest."""
    ends, out = (0, *C.MONTH_ENDS), []
    days, left = [0.0, 0.0], [1.0, 1.0]
    for index, loss in months:
        m = index % 12
        f, t = ends[m] + 1, ends[m + 1]
        wraps = harvest <= plant
        grow = [sum(1 for d in range(f, t + 1) if (d <= harvest if wraps else plant <= d <= harvest)),
                sum(1 for d in range(f, t + 1) if wraps and d >= plant)]
        if m == 0:
            days, left = ([days[1], 0.0], [left[1], 1.0]) if harvest < plant else ([0.0, 0.0], [1.0, 1.0])
        for i in range(2):
            days[i] += loss * grow[i]
            left[i] *= 1 - loss * grow[i] / (t - f + 1)
        out.append((index, [1 - x for x in left]))
    return out


@pytest.mark.parametrize("plant,harvest", [(100, 250), (280, 120)])
def test_cumulative_loss_equals_the_sequential_rule(spark, plant, harvest):
    months = [(24000 + i, 0.0 if i % 4 == 0 else 1.0 if i == 15 else (i % 7) / 10) for i in range(36)]
    rows = [(1, i, 10 + 50 * loss, plant, harvest) for i, loss in months]
    df = spark.createDataFrame(rows, "cell_id INT, month_index INT, heat DOUBLE, plant_doy INT, harvest_doy INT")
    out = {r.month_index: r for r in G.cumulative_crop_loss(df, ["cell_id"], ["heat"], 10.0, 60.0, 1.0).collect()}
    for index, (now, ahead) in sequential_losses(months, plant, harvest):
        assert out[index].cumulative_loss_current_year == pytest.approx(now, abs=1e-12)
        assert out[index].cumulative_loss_next_year == pytest.approx(ahead, abs=1e-12)


def test_condensed_calendar_lines(spark, tmp_path):
    path = tmp_path / "calendar.txt"
    path.write_text("unit crop seasons\n4 7 2 10.5 3 8 20 11 2\n5 7 0\n\n6 1 1 1.25 12 5\n")
    out = sorted(tuple(r) for r in S.scan_text_calendar(spark, str(path), 1).collect())
    assert out == [(4, 7, 1, 10.5, 3, 8), (4, 7, 2, 20.0, 11, 2), (6, 1, 1, 1.25, 12, 5)]
    with pytest.raises(Exception, match="not a calendar line"):
        S.scan_text_calendar(spark, str(path)).collect()
    shares = {(r.unit_code, r.subcrop): r.area_frac for r in G.area_fractions(S.scan_text_calendar(spark, str(path), 1)).collect()}
    assert shares[4, 1] == pytest.approx(10.5 / 30.5) and shares[6, 1] == 1.0


def test_unpivot_names(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, 4.0)], "id INT, loss_irrigated_maize_2_q50 DOUBLE, cumulative_loss_rainfed_cotton DOUBLE, other DOUBLE")
    out = sorted((r.variable, r.method, r.crop, r.subcrop, r.quantile, r.value) for r in G.unpivot_results(df, ["loss", "cumulative_loss"], "id").collect())
    assert out == [("cumulative_loss", "rainfed", "cotton", "cotton", None, 3.0), ("loss", "irrigated", "maize", "maize_2", 0.5, 2.0)]


def test_subcrop_names(spark):
    names = {r.name for r in G.subcrops(spark, implemented_only=True).collect()}
    assert names == {"wheat_1", "wheat_2", "maize_1", "maize_2", "rice_1", "rice_2", "rice_3", "rice_4", "rice_5", "soybeans", "potatoes_1", "potatoes_2"}


def test_yield_model_runs_where_a_calendar_exists(spark):
    rows = [(i, c, float(i % 9), float(i % 4), 2.0 * (i % 9)) for i in range(60) for c in ("wheat_1", "wheat_2")]
    df = spark.createDataFrame(rows, "cell_id INT, crop STRING, a DOUBLE, b DOUBLE, y DOUBLE")
    models = {n: G.fit_yield_model(df, ["a", "b"], "y", trees=3) for n in ("winter_wheat", "spring_wheat")}
    out = G.score_yield(df.drop("y"), models)
    assert out.count() == 120 and out.where("yield IS NULL").isEmpty()


def test_scored_yields_keep_rows_and_need_a_model(spark):
    rows = [(i, "wheat_1", float(i) if i % 3 else None, 1.0, 2.0 * i) for i in range(30)]
    df = spark.createDataFrame(rows, "cell_id INT, crop STRING, a DOUBLE, b DOUBLE, y DOUBLE")
    models = {"winter_wheat": G.fit_yield_model(df, ["a", "b"], "y", trees=2)}
    out = G.score_yield(df.drop("y"), models).collect()
    assert len(out) == 30 and {r.cell_id for r in out if r["yield"] is None} == set(range(0, 30, 3))
    with pytest.raises(Exception, match="no model for crop"):
        G.score_yield(df.withColumn("crop", F.lit("rice_1")), models).collect()


def test_calendar_lines_are_not_dropped(spark, tmp_path):
    path = tmp_path / "calendar.txt"
    path.write_text("head\n1 1 1 10.0 4 9\nbroken line\n")
    with pytest.raises(ValueError, match="no calendar lines"):
        S.scan_text_calendar(spark, str(path), 1)
    assert S.scan_text_calendar(spark, str(path), 2).count() == 1


def test_power_curves(spark):
    one = spark.range(1)
    val = lambda c: one.select(c.alias("v")).first().v
    assert val(P.water_cooled_loss(F.lit(20.0), 20.0, 60.0)) == 0.0 and val(P.water_cooled_loss(F.lit(60.0), 20.0, 60.0)) == pytest.approx(1.0)
    assert val(P.loss_onset(F.lit(None).cast("double"))) == 30.0 and val(P.loss_onset(F.lit(0.3))) == pytest.approx(17.5) and val(P.loss_onset(F.lit(2.0))) == 10.0
    assert val(P.hydropower_loss(F.lit(5.0), F.lit(0.0))) == 0.0 and val(P.hydropower_loss(F.lit(0.0), F.lit(1.0))) == 1.0
    assert val(P.water_to_air(P.air_to_water(F.lit(17.0)))) == pytest.approx(17.0)
    assert val(E.integration_period(F.lit(30.0), F.lit(2.0), [3, 6, 12, 24])) == 12 and val(E.integration_period(F.lit(30.0), F.lit(0.0), [3, 6])) == 3


def test_losses_of_many_months_are_those_of_each(spark):
    storage = spark.createDataFrame([(1, 6), (2, 12), (3, 6)], "id INT, months_storage INT")
    rows = [(i, 12, m, float(i * m % 7)) for i in (1, 2) for m in range(5)]
    flow = spark.createDataFrame(rows, "id INT, window INT, month_index INT, flow DOUBLE")
    fits = spark.createDataFrame([(1, 12, 3.0, 1.0, 0.1), (2, 12, 2.0, None, None)], "id INT, window INT, location DOUBLE, scale DOUBLE, shape DOUBLE")
    together = {(r.id, r.month_index): r.hydropower_loss for r in E.basin_loss_factors(storage, flow, fits, ["month_index"]).collect()}
    each = {(r.id, m if r.id < 3 else None): r.hydropower_loss for m in range(5)
            for r in E.basin_loss_factors(storage, flow.where(F.col("month_index") == m).drop("month_index"), fits).collect()}
    assert together == each and len(together) == 11


def test_missing_window_data_is_an_error(spark):
    storage = spark.createDataFrame([(1, 30)], "id INT, months_storage INT")
    flow = spark.createDataFrame([(1, 12, 3.0)], "id INT, window INT, flow DOUBLE")
    fits = spark.createDataFrame([(1, 12, 3.0, 1.0, 0.1)], "id INT, window INT, location DOUBLE, scale DOUBLE, shape DOUBLE")
    with pytest.raises(ValueError, match="no flow"):
        E.basin_loss_factors(storage, flow, fits)


def test_transforms(spark):
    df = spark.createDataFrame([(1, -2.0), (2, None), (3, 5.0)], "id INT, v DOUBLE")
    out = {r.id: r for r in T.select_vars(df, ["id"], ["v@fill0@negate->n", "v@clamp0->c", "v@[x * x]->q"]).collect()}
    assert out[1].n == 2.0 and out[2].n == 0.0 and out[1].c == 0.0 and out[2].c is None and out[3].q == 25.0
    assert df.select(T.clamp(F.col("v"), -1.0, 1.0).alias("v")).collect()[1].v is None
    table = spark.createDataFrame([(5.0, 1.0), (None, 9.0)], "a DOUBLE, b DOUBLE")
    assert {r.id: r.v for r in T.reclassify(df, "v", table, "a", "b").collect()} == {1: None, 2: 9.0, 3: 1.0}
    with pytest.raises(Exception, match="no class"):
        T.reclassify(df, "v", table, "a", "b", na_default=False).collect()
    assert T.class_labels() == ["lt_3", "3_5", "5_10", "10_20", "20_40", "gt_40"]


def test_month_arithmetic(spark):
    one = spark.range(1)
    val = lambda c: one.select(c.alias("v")).first().v
    assert val(C.add_months(F.lit(201501), -2)) == 201411 and val(C.next_yearmon(F.lit(201212))) == 201301
    assert val(C.add_days(F.lit(20160228), 2)) == 20160301 and val(C.days_in_yearmon(F.lit(201602))) == 29
    assert val(C.days_in_yearmon(F.lit(201602), leap=False)) == 28
    assert val(C.available_range(24, F.lit(1950), F.lit(1953), F.lit(3))) == [195203, 195303]
    assert val(C.yearmon_from_name(F.lit("fit_Pr_198402.nc"))) == 198402
    with pytest.raises(Exception, match="no single month"):
        val(C.yearmon_from_name(F.lit("a_198402_198403")))
    assert [r.yearmon for r in S.months(spark, 199811, 199902).collect()] == [199811, 199812, 199901, 199902]
    assert [r.yearmon for r in S.months(spark, 2000, 2006, 3).collect()] == [2000, 2003, 2006]
    assert [r.yearmon for r in S.months(spark, 20160228, 20160302).collect()] == [20160228, 20160229, 20160301, 20160302]
    with pytest.raises(ValueError):
        S.months(spark, 1999, 199902)


def test_missing_input_is_an_error(spark):
    df = spark.createDataFrame([(199901, 1.0)], "yearmon INT, v DOUBLE")
    with pytest.raises(ValueError, match="no data"):
        S.require_months(df, 199901, 199902)
    with pytest.raises(ValueError, match="no data"):
        S.scan_slice(df, yearmon=200001)
    with pytest.raises(ValueError, match="repeated window"):
        S.read_integrated([(None, df), (1, df)])


def test_checks(spark):
    df = spark.createDataFrame([(float(i), 0.5) for i in range(20)], "T DOUBLE, pWetDays DOUBLE")
    verdicts = {r.variable: r.verdict for r in Q.check_range(df, {"T": (0.0, 10.0), "pWetDays": (0.0, 1.0)}).collect()}
    assert verdicts == {"T": "error", "pWetDays": "ok"}
    with pytest.raises(ValueError):
        Q.check_units(Q.with_units(df, T="K"), "T", "degree_Celsius")
    with pytest.warns(UserWarning):
        Q.check_units(df, "T", "degree_Celsius")
    with pytest.raises(Exception, match="not an integer"):
        Q.integer_ids(spark.createDataFrame([("1.5",)], "id STRING"), "id").collect()
    with pytest.raises(ValueError, match="more than one"):
        J.merge_datasets([df, df], ["pWetDays"])
    a = spark.createDataFrame([(1, 2.0)], "id INT, a DOUBLE")
    with pytest.raises(Exception, match="datasets differ"):
        J.merge_datasets([a, spark.createDataFrame([(2, 2.0)], "id INT, b DOUBLE")], ["id"]).collect()


def test_slices_replace_only_themselves(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], "id INT, crop STRING, v DOUBLE")
    K.sink(df, path, ["crop"], "create")
    K.sink(df.where("crop = 'b'").withColumn("v", F.lit(9.0)), path, ["crop"], "slice", 2)
    assert {(r.crop, r.v) for r in spark.read.parquet(path).collect()} == {("a", 1.0), ("b", 9.0)}
    with pytest.raises(Exception):
        K.sink(df, path, ["crop"], "create")


def test_grids_of_forecasts(spark):
    from rillmark.operators import spatial as Z

    cells = [(i, j, 100.0 * i + j) for i in range(4) for j in range(3)]
    out = {(r.row_no, r.col_no): r.v for r in Z.one_degree_to_half(spark.createDataFrame(cells, "row_no INT, col_no INT, v DOUBLE"), 4, 3).collect()}
    rows, cols = [0, 1, 1, 2, 2, 3], [2, 0, 0, 1, 1, 2]
    assert out == {(i, j): 100.0 * rows[i] + cols[j] for i in range(6) for j in range(6)}


def test_streaming_drops_late_rows(spark, tmp_path):
    from rillmark.streaming import jobs as R

    source = tmp_path / "in"
    schema = "cell_id BIGINT, ts TIMESTAMP, v DOUBLE"
    day = lambda d, h: datetime.datetime(2024, 1, d, h)
    batches = [[(1, day(1, 3), 5.0), (1, day(1, 9), 1.0), (1, day(5, 1), 2.0)], [(1, day(1, 12), 100.0), (1, day(9, 1), 1.0)]]
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        R.run_to_files(R.daily_totals(stream, ["cell_id"], "ts", "v", "1 day"), out, progress, drain=True).awaitTermination()
    totals = {r.day.day: r.v for r in spark.read.parquet(out).collect()}
    assert totals == {1: 6.0, 5: 2.0}


def test_features_are_scored_from_one_written_table(spark):
    made = spark.range(40).select(F.col("id").alias("cell_id"), F.lit("maize").alias("crop"), F.col("id").cast("double").alias("x"))
    model = G.fit_yield_model(made.withColumn("y", F.col("x") * 2), ["x"], "y", trees=2)
    plan = G.score_yield(made, {"maize": model})._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in plan


def test_no_shuffle_by_crop(spark):
    prod = spark.range(100).select((F.col("id") / 10).cast("int").alias("row_no"), (F.col("id") % 10).cast("int").alias("col_no"), F.lit("a").alias("source"), F.lit(1.0).alias("production"))
    fractions = spark.createDataFrame([(0, 0, "c", 1.0)], "row_no INT, col_no INT, name STRING, area_frac DOUBLE")
    names = spark.range(1).select(F.lit(1).alias("crop_id"), F.lit("c").alias("name"), F.lit(1).alias("n_subcrops"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = G.allocate_production(prod, spark.range(1).select(F.lit("a").alias("source"), F.lit(1).alias("crop_id")), names, fractions, 4)
        assert "hashpartitioning(crop_id" not in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

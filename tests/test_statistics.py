"""Statistics against hand values, numpy, and their own skew-safe form."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillmark.operators import fit as D
from rillmark.operators import integrate as I
from rillmark.operators import ordered as O
from rillmark.operators import windows as W


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [(1, i, v) for i, v in enumerate([2.0, 4.0, None, 9.0, 4.0, 30.0], start=1)]
    rows += [(2, i, None) for i in range(1, 5)]
    return spark.createDataFrame(rows, "cell_id INT, layer INT, x DOUBLE")


def as_dict(df, key="cell_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_plain_statistics_skip_missing_values(vectors):
    out = as_dict(I.integrate(vectors, ["cell_id"], ["sum", "ave", "min", "max", "fraction_defined", "fraction_defined_above_zero", "num_defined"], ["x"]))
    a, b = out[1], out[2]
    assert (a["x_sum"], a["x_ave"], a["x_min"], a["x_max"], a["x_num_defined"]) == (49.0, 9.8, 2.0, 30.0, 5)
    assert a["x_fraction_defined"] == pytest.approx(5 / 6) and a["x_fraction_defined_above_zero"] == 1.0
    assert b["x_sum"] == 0.0 and b["x_num_defined"] == 0 and b["x_fraction_defined"] == 0.0
    assert all(b[f"x_{s}"] is None for s in ("ave", "min", "max", "fraction_defined_above_zero"))


def test_extreme_positions_take_the_first_of_ties(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, 1.0), (1, 3, None), (1, 4, 1.0), (1, 5, 5.0)], "cell_id INT, layer INT, x DOUBLE")
    out = as_dict(I.integrate(df, ["cell_id"], ["which_min", "which_max"], ["x"], layer="layer"))[1]
    assert (out["x_which_min"], out["x_which_max"]) == (2, 1)


def test_quantiles_of_hand_values(vectors):
    out = as_dict(I.integrate(vectors, ["cell_id"], ["median", "q25", "q0", "q100"], ["x"]))
    assert (out[1]["x_median"], out[1]["x_q25"], out[1]["x_q0"], out[1]["x_q100"]) == (4.0, 4.0, 2.0, 30.0)
    assert out[2]["x_median"] is None


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(5)
    rows = [(0, rnd.choice([rnd.gauss(0, 1), float(rnd.randint(-3, 3))]), rnd.uniform(0.1, 3)) for _ in range(3000)]
    rows += [(rnd.randint(1, 40), rnd.gauss(5, 2), rnd.uniform(0.1, 3)) for _ in range(1500)] + [(7, None, 1.0)]
    return spark.createDataFrame(rows, "k INT, x DOUBLE, w DOUBLE").repartition(5), rows


def test_hot_keys_are_cut_into_ranges_with_the_same_result(skewed):
    df, rows = skewed
    by_key = {}
    for k, x, _ in rows:
        if x is not None:
            by_key.setdefault(k, []).append(x)
    ps = {"a": 0.03, "b": 0.5, "c": 0.9, "d": 1.0}
    for ranges in (2, 16, 300):
        out = as_dict(O.quantiles(df, ["k"], "x", ps, ranges=ranges), "k")
        assert len(out) == len(by_key)
        for k, xs in by_key.items():
            for name, p in ps.items():
                assert out[k][name] == pytest.approx(np.quantile(xs, p), abs=1e-12)
    runs = O.ordered_counts(df, ["k"], "x", ranges=300)
    assert runs.where("k = 0 AND m > 0").agg(F.sum("m")).first()[0] == len(by_key[0])


def test_ranges_are_even_and_in_order(skewed):
    df, _ = skewed
    base = df.groupBy("k", "x").agg(F.count("x").alias("m"))
    rows = [(r._range, r.k, r.x is None, r.x or 0.0) for r in O.with_ranges(base, ["k"], ["x"], 50).collect()]
    assert [r[0] for r in sorted(rows, key=lambda r: r[1:])] == sorted(r[0] for r in rows)
    sizes = np.bincount([r[0] for r in rows])
    assert len(sizes) == 50 and sizes.max() < 2.5 * sizes.mean()  # the hot key is no exception
    assert len({r[0] for r in rows if r[1] == 0}) > 20


def test_one_plan_for_hot_and_even_keys(skewed, spark):
    def operators(df):
        plan = O.quantiles(df, ["k"], "x", {"a": 0.5})._jdf.queryExecution().executedPlan().toString()
        return sorted(w for w in plan.replace("(", " ").split() if w.endswith("Exec") or w in ("Window", "Exchange", "Sort", "BroadcastExchange", "BroadcastHashJoin"))

    df, _ = skewed
    even = df.withColumn("k", F.col("k") + F.pmod(F.xxhash64("x"), F.lit(50)).cast("int"))
    assert operators(df) == operators(even) and "BroadcastExchange" not in operators(df)


def test_ranges_of_more_rows_than_whole_numbers_allow(spark):
    # from 2^23 rows on, a product of hash and number of rows did not fit 64 bits
    n = 9_000_000
    base = spark.range(n).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("x"))
    sizes = [r["count"] for r in O.with_ranges(base, ["k"], ["x"], 16).groupBy("_range").count().collect()]
    assert len(sizes) == 16 and sum(sizes) == n and max(sizes) < 2 * n / 16


def test_bounded_runs_are_found_by_one_sort(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 2.0), (1, None), (1, 1.0), (2, None), (1, None)], "k INT, x DOUBLE")
    out = O.ordered_counts(df, ["k"], "x", bounded=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and plan.count("Exchange") == 1
    assert {(r.k, r.x, r.m, r.below_m, r.all_m) for r in out.collect()} == {(1, 1.0, 1, 0, 3), (1, 2.0, 2, 1, 3), (1, None, 0, 3, 3), (2, None, 0, 0, 0)}


def test_missing_values_come_last_in_hot_keys(skewed, spark):
    df, rows = skewed
    gaps = df.unionByName(spark.createDataFrame([(0, None, 1.0)] * 7, df.schema))
    out = sorted((r.position, r.x) for r in I.sorted_values(gaps, ["k"], "x", ranges=100).where("k = 0").collect())
    xs = sorted(x for k, x, _ in rows if k == 0)
    assert [x for _, x in out] == xs + [None] * 7 and [p for p, _ in out] == list(range(1, len(xs) + 8))


def test_hot_keys_in_weighted_quantiles(skewed):
    df, _ = skewed
    plain = as_dict(I.weighted_quantiles(df, ["k"], "x", "w", {"q": 0.3}, bounded=True), "k")
    cut = as_dict(I.weighted_quantiles(df, ["k"], "x", "w", {"q": 0.3}, ranges=100), "k")
    assert plain.keys() == cut.keys()
    assert all(cut[k]["q"] == pytest.approx(plain[k]["q"], rel=1e-9) for k in plain)


def test_order_statistics_of_an_empty_table(skewed):
    assert O.quantiles(skewed[0].where("false"), ["k"], "x", {"a": 0.5}).count() == 0


def test_weighted_quantile_equals_plain_for_equal_weights_and_ignores_scale(spark):
    rows = [(1, float(x), 2.5, 25.0) for x in (5, 3, 8, 1, 9, 9, 4)]
    df = spark.createDataFrame(rows, "cell_id INT, x DOUBLE, w DOUBLE, w10 DOUBLE")
    ps = {f"q{i}": i / 10 for i in range(11)}
    a = as_dict(I.weighted_quantiles(df, ["cell_id"], "x", "w", ps))[1]
    b = as_dict(I.weighted_quantiles(df, ["cell_id"], "x", "w10", ps))[1]
    for n, p in ps.items():
        assert a[n] == pytest.approx(np.quantile([r[1] for r in rows], p)) and a[n] == pytest.approx(b[n])


def test_bad_weights_are_errors_and_empty_cells_are_missing(spark):
    df = spark.createDataFrame([(1, None, 1.0)], "cell_id INT, x DOUBLE, w DOUBLE")
    assert as_dict(I.weighted_quantiles(df, ["cell_id"], "x", "w", {"q": 0.5}))[1]["q"] is None
    bad = spark.createDataFrame([(1, 1.0, -1.0)], "cell_id INT, x DOUBLE, w DOUBLE")
    with pytest.raises(Exception, match="weights"):
        I.weighted_quantiles(bad, ["cell_id"], "x", "w", {"q": 0.5}).collect()


def test_ranks_in_history(spark):
    new = spark.createDataFrame([(1, 3.0), (1, 0.0), (1, None), (2, 4.0)], "cell_id INT, x DOUBLE")
    old = spark.createDataFrame([(1, 1.0), (1, 3.0), (1, 3.0), (1, 8.0)], "cell_id INT, obs DOUBLE")
    out = {(r.cell_id, r.x): (r.min_rank, r.max_rank) for r in I.ranks(new, old, ["cell_id"], "x", "obs").collect()}
    assert out == {(1, 3.0): (2, 4), (1, 0.0): (1, 1), (1, None): (None, None), (2, 4.0): (1, 1)}


def test_model_weights(spark):
    one = spark.createDataFrame([("a", str(i)) for i in range(4)], "model STRING, member STRING")
    assert {r.weight for r in I.ensemble_weights(one).collect()} == {0.25}
    two = one.unionByName(spark.createDataFrame([("b", str(i)) for i in range(10)], "model STRING, member STRING"))
    out = {r.model: r.weight for r in I.ensemble_weights(two).collect()}
    assert out["a"] == pytest.approx(0.5 / 4) and out["b"] == pytest.approx(0.5 / 10)


def test_statistic_specifications():
    assert I.parse_stat("q25::Pr,T") == ("q25", ["Pr", "T"]) and I.parse_stat("SUM") == ("SUM", [])
    with pytest.raises(ValueError):
        I.parse_stat("mode")


def test_soil_capacity(spark):
    rows = [(1, "D1", 70.0, 0.0, 0.4, 15.0), (1, "D2", 70.0, 0.4, 0.6, 17.0), (1, "D1", 30.0, 0.0, 0.4, 19.0), (1, "D2", 30.0, 0.4, 0.6, 21.0)]
    df = spark.createDataFrame(rows, "unit INT, layer STRING, prop DOUBLE, top_m DOUBLE, bottom_m DOUBLE, tawc_mm DOUBLE")
    assert I.soil_capacity(df, 1.0).first().tawc == pytest.approx(0.4 * (0.7 * 15 + 0.3 * 19) + 0.2 * (0.7 * 17 + 0.3 * 21))
    assert I.soil_capacity(df, 0.5).first().tawc == pytest.approx(0.4 * (0.7 * 15 + 0.3 * 19))


def test_rolling_windows_need_every_month(spark):
    rows = [(1, m, float(m)) for m in (1, 2, 3, 5, 6, 7, 8)]
    df = spark.createDataFrame(rows, "cell_id INT, month_index INT, Pr DOUBLE")
    out = {r.month_index: r.Pr_sum for r in W.rolling_integrate(df, ["cell_id"], 3, {"Pr": ("sum",)}).collect()}
    assert out == {3: 6.0, 7: 18.0, 8: 21.0}
    twice = df.unionByName(df.where("month_index = 2"))
    with pytest.raises(Exception, match="two rows"):
        W.rolling_integrate(twice, ["cell_id"], 3, {"Pr": ("sum",)}).collect()


def _months(spark, seed=4):
    """Cells with gaps and missing values: rows, and a frame of them."""
    rnd = random.Random(seed)
    rows = [(c, m, None if rnd.random() < 0.2 else float(rnd.randint(-5, 9)), rnd.choice([0.5, 1.0, 2.0]))
            for c in range(6) for m in range(100, 180) if c % 2 or rnd.random() > 0.05]
    return rows, spark.createDataFrame(rows, "cell_id INT, month_index INT, x DOUBLE, w DOUBLE").repartition(4)


def test_windows_of_many_lengths_against_numpy(spark):
    rows, df = _months(spark)
    stats = ("sum", "ave", "min", "max", "num_defined", "fraction_defined", "fraction_defined_above_zero", "median", "q90", "weighted_q30")
    got = {(r.window, r.cell_id, r.month_index): r for r in W.rolling_integrate_many(df, ["cell_id"], [1, 3, 12, 60], {"x": stats}, weight="w").collect()}
    values = {(c, m): (x, w) for c, m, x, w in rows}
    want = 0
    for c, m in values:
        for n in (1, 3, 12, 60):
            months = [values.get((c, i)) for i in range(m - n + 1, m + 1)]
            if None in months:
                assert (n, c, m) not in got
                continue
            want += 1
            r, pairs = got[n, c, m], sorted((x, w) for x, w in months if x is not None)
            xs = [x for x, _ in pairs]
            assert (r.x_sum, r.x_num_defined, r.x_min, r.x_max) == (sum(xs), len(xs), min(xs, default=None), max(xs, default=None))
            assert r.x_ave == (pytest.approx(np.mean(xs)) if xs else None) and r.x_fraction_defined == pytest.approx(len(xs) / n)
            assert r.x_fraction_defined_above_zero == (pytest.approx(sum(x > 0 for x in xs) / len(xs)) if xs else None)
            if not xs:
                assert r.x_median is None and r.x_weighted_q30 is None
                continue
            assert r.x_median == pytest.approx(np.median(xs)) and r.x_q90 == pytest.approx(np.quantile(xs, 0.9))
            places = [k * w + (len(xs) - 1) * sum(v for _, v in pairs[:k]) for k, (_, w) in enumerate(pairs)]
            assert r.x_weighted_q30 == pytest.approx(np.interp(0.3 * (len(xs) - 1) * sum(w for _, w in pairs), places, xs))
    assert len(got) == want > 300
    with pytest.raises(ValueError, match="weights"):
        W.rolling_integrate(df, ["cell_id"], 3, {"x": ("weighted_median",)})
    with pytest.raises(ValueError, match="unknown"):
        W.rolling_integrate(df, ["cell_id"], 3, {"x": ("which_min",)})


def test_window_plans_do_not_grow_with_the_window(spark):
    _, df = _months(spark)

    def plan(n):
        return W.rolling_integrate(df, ["cell_id"], n, {"x": ("sum", "ave", "min", "max", "num_defined")})._jdf.queryExecution().optimizedPlan().toString()

    short, long = plan(12), plan(60)
    assert short.count("windowexpression") == long.count("windowexpression") and short.count("windowspec") == long.count("windowspec")
    # running frames and lags alone: no frame reaches back a number of months to be gone through for each row
    assert not any(f"specifiedwindowframe({kind}, -{n}, currentrow" in p.lower() for p in (short, long) for kind in ("rowframe", "rangeframe") for n in (11, 59))


def test_forecast_windows_against_their_months(spark):
    rows, obs = _months(spark, 7)
    rnd = random.Random(8)
    fc = [(c, issue, "m", k, t, None if rnd.random() < 0.1 else float(rnd.randint(0, 9))) for c in range(6) for issue in (130, 150, 171) for k in range(2)
          for t in range(issue - 2, issue + 15) if rnd.random() > 0.03]
    forecast = spark.createDataFrame(fc, "cell_id INT, issue INT, model STRING, member INT, month_index INT, x DOUBLE").repartition(3)
    seen = {(c, m): x for c, m, x, _ in rows}
    own = {(c, i, k, t): x for c, i, _, k, t, x in fc}
    for n in (1, 4, 12, 60):
        stats = {"x": ("sum", "ave", "num_defined", "fraction_defined_above_zero", "min", "max", "median")}
        got = {(r.cell_id, r.issue, r.member, r.end_index): r for r in W.rolling_forecast(obs, forecast, "issue", n, ["cell_id"], stats).collect()}
        want = 0
        for c, i, _, k, t, _ in fc:
            months = [own.get((c, i, k, m), "gap") if m > i else seen.get((c, m), "gap") for m in range(t - n + 1, t + 1)]
            if "gap" in months:
                assert (c, i, k, t) not in got
                continue
            want += 1
            r, xs = got[c, i, k, t], [x for x in months if x is not None]
            assert (r.x_sum, r.x_num_defined, r.x_min, r.x_max) == (sum(xs), len(xs), min(xs, default=None), max(xs, default=None))
            assert r.x_median == (pytest.approx(np.median(xs)) if xs else None) and r.x_ave == (pytest.approx(np.mean(xs)) if xs else None)
        assert len(got) == want > 50


def test_l_moments_and_extreme_value_fit(spark):
    from rillmark.functions import numeric as N

    # quantiles of known distributions at evenly spaced probabilities: the fit must find them again
    cases = {1: (10.0, 2.0, 0.3), 2: (5.0, 1.0, -0.35), 3: (0.0, 3.0, 0.0), 4: (100.0, 20.0, 0.9)}
    n = 4000
    rows = []
    for k, (loc, scale, shape) in cases.items():
        for i in range(n):
            y = -math.log((i + 0.5) / n)
            rows.append((k, loc - scale * math.log(y) if shape == 0 else loc + scale / shape * (1 - y**shape)))
    df = spark.createDataFrame(rows, "k INT, x DOUBLE")
    out = as_dict(D.fit(df, ["k"], "x"), "k")
    for k, (loc, scale, shape) in cases.items():
        assert out[k]["location"] == pytest.approx(loc, abs=0.02 * scale) and out[k]["scale"] == pytest.approx(scale, rel=0.03)
        assert out[k]["shape"] == pytest.approx(shape, abs=0.02)
    # the shape solves its equation for strongly skewed moments as well
    lm = spark.createDataFrame([(t3, 1.0, 1.0) for t3 in (-0.95, -0.5, 0.0, 0.1699250014, 0.17, 0.6, 0.95)], "t3 DOUBLE, l1 DOUBLE, l2 DOUBLE")
    for r in D._gev(lm).collect():
        k = r.shape
        t3 = 2 * math.log(3) / math.log(2) - 3 if k == 0 else 2 * (1 - 3**-k) / (1 - 2**-k) - 3
        assert t3 == pytest.approx(r.t3, abs=1e-6)
    assert N.NORMAL_BELOW == 1e-6


def test_fit_guards(spark):
    rows = [(1, float(i)) for i in range(12)] + [(2, float(i % 3)) for i in range(12)] + [(3, float(i)) for i in range(6)]
    rows += [(3, None)] * 6 + [(4, None)] * 12
    out = as_dict(D.fit(spark.createDataFrame(rows, "k INT, x DOUBLE"), ["k"], "x"), "k")
    assert out[1]["shape"] is not None
    assert out[2]["location"] == 1.0 and out[2]["scale"] is None
    assert out[3]["location"] is None and out[3]["n_defined"] == 6
    assert out[4]["location"] is None and out[4]["n_defined"] == 0


def test_l_moments_match_direct_formula(spark):
    xs = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0, 5.0, 3.0, 5.0]
    out = D.l_moments(spark.createDataFrame([(1, x) for x in xs], "k INT, x DOUBLE"), ["k"], "x").first()
    s, n = sorted(xs), len(xs)
    b = [sum(math.comb(i, r) * x for i, x in enumerate(s)) / math.comb(n - 1, r) / n for r in range(4)]
    l2 = 2 * b[1] - b[0]
    assert out.l1 == pytest.approx(b[0]) and out.l2 == pytest.approx(l2)
    assert out.t3 == pytest.approx((6 * b[2] - 6 * b[1] + b[0]) / l2)
    assert out.t4 == pytest.approx((20 * b[3] - 30 * b[2] + 12 * b[1] - b[0]) / l2)


def test_weighted_statistic_needs_weights(spark):
    df = spark.createDataFrame([(1, 2.0, 1.0), (1, 4.0, 3.0), (1, None, 5.0)], "cell_id int, x double, w double")
    with pytest.raises(ValueError, match="weights"):
        I.integrate(df, ["cell_id"], ["weighted_q50"], ["x"])
    out = I.integrate(df, ["cell_id"], ["weighted_median::x", "SUM"], ["x"], weight="w").first()
    assert out.x_sum == 6.0 and 2.0 < out.x_weighted_median <= 4.0


def test_noise_does_not_depend_on_partitions(spark):
    df = spark.range(40).selectExpr("cast(id % 4 as int) cell_id", "cast(id as int) layer", "cast(id as double) value")
    starts = df.select("cell_id").distinct().withColumn("start", F.lit(-3))
    one, two = ({(r.cell_id, r.position): r.value for r in I.layer_slice(df.repartition(n), starts.repartition(n), ["cell_id"], "layer", "value", "start", 8, seed=3).collect()} for n in (1, 7))
    assert one == two and len(set(one.values())) > 20

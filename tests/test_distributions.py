"""Normal, extreme-value and Pearson III functions, anomalies, bias correction, composites."""

import math
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from rillmark.functions import numeric as N
from rillmark.operators import anomaly as A
from rillmark.operators import composite as K
from rillmark.operators import fit as D

FITS = "cell_id INT, location DOUBLE, scale DOUBLE, shape DOUBLE"


def test_normal_functions(spark):
    xs = [-38.0, -8.0, -6.5, -3.0, -1.0, -0.1, 0.0, 0.4, 1.5, 5.0, 7.2]
    ps = [1e-12, 1e-5, 0.02, 0.07, 0.3, 0.5, 0.6, 0.925, 0.98, 0.99999]
    nd = NormalDist()
    for r in spark.createDataFrame([(x,) for x in xs], "x DOUBLE").select("x", N.norm_cdf(F.col("x")).alias("p")).collect():
        # the published approximation is good to 1e-15; its tails keep some eight digits, of which
        # return periods up to 1000 (tails above 0.001) use none
        exact = 0.5 * math.erfc(-r.x / math.sqrt(2))
        assert r.p == pytest.approx(exact, abs=1e-15) and r.p == pytest.approx(exact, rel=1e-7, abs=1e-300)
    for r in spark.createDataFrame([(p,) for p in ps], "p DOUBLE").select("p", N.norm_ppf(F.col("p")).alias("x")).collect():
        assert r.x == pytest.approx(nd.inv_cdf(r.p), rel=1e-12, abs=1e-14)
    edge = spark.createDataFrame([(0.0,), (1.0,), (None,), (1.5,)], "p DOUBLE")
    assert [r.sa for r in N.with_anomaly(edge, "p", "sa").collect()] == [-100.0, 100.0, None, None]


def test_gamma(spark):
    xs = [0.05, 0.5, 1.0, 1.3, 2.0, 7.5, 40.0]
    for r in spark.createDataFrame([(x,) for x in xs], "x DOUBLE").select("x", N.ln_gamma(F.col("x")).alias("g")).collect():
        assert r.g == pytest.approx(math.lgamma(r.x), rel=1e-12, abs=1e-12)


def test_conversions_between_anomaly_and_return_period(spark):
    df = spark.createDataFrame([(-0.246,), (0.0,), (2.0,), (9.0,), (-9.0,)], "sa DOUBLE")
    out = [r.rp for r in N.with_return_period(df, "sa", "rp").collect()]
    assert out[0] == pytest.approx(-2.483, abs=1e-3) and out[1] == 0.0 and out[3] == 1000.0 and out[4] == -1000.0
    back = spark.createDataFrame([(out[0],), (out[2],)], "rp DOUBLE").select(N.rp2sa(F.col("rp")).alias("sa")).collect()
    assert [b.sa for b in back] == pytest.approx([-0.246, 2.0])
    q = spark.createDataFrame([(-15.0,), (15.0,)], "rp DOUBLE").select(N.rp2quantile(F.col("rp")).alias("q")).collect()
    assert [r.q for r in q] == pytest.approx([1 / 15, 14 / 15])


@pytest.mark.parametrize("kind,shapes", [("gev", [-0.4, 0.0, 0.3, 0.9]), ("pe3", [-1.5, -0.01, 0.0, 1e-5, 0.02, 0.8, 2.5])])
def test_quantile_inverts_probability(spark, kind, shapes):
    rows = [(s, p / 50) for s in shapes for p in range(1, 50)]
    df = spark.createDataFrame(rows, "shape DOUBLE, p DOUBLE").withColumns({"location": F.lit(10.0), "scale": F.lit(3.0)})
    params = ["location", "scale", "shape"]
    out = N.with_cdf(N.with_quantile(df, kind, "p", params, "x"), kind, "x", params, "back").collect()
    for r in out:
        assert r.back == pytest.approx(r.p, abs=1e-9)


def test_extreme_value_bounds_and_sign(spark):
    # a positive shape is bounded above: location + scale / shape
    df = spark.createDataFrame([(9.0, 0.5), (2.0, 0.5), (-9.0, -0.5)], "x DOUBLE, shape DOUBLE").withColumns({"location": F.lit(0.0), "scale": F.lit(1.0)})
    assert [r.p for r in N.with_cdf(df, "gev", "x", ["location", "scale", "shape"], "p").collect()] == [1.0, 1.0, 0.0]
    worked = spark.createDataFrame([(1, 110.6)], "cell_id INT, Ws DOUBLE")
    fits = spark.createDataFrame([(1, 131.2, 29.3, 0.764)], FITS)
    r = A.return_period(worked, fits, ["cell_id"], "Ws").first()
    assert r.Ws_sa == pytest.approx(-0.943, abs=2e-3) and r.Ws_rp == pytest.approx(-5.8, abs=0.05)


def test_bias_correction_cases(spark):
    fc = spark.createDataFrame([(1, 12.0), (2, 12.0), (3, 12.0), (4, None), (5, 1e6), (6, 12.0)], "cell_id INT, x DOUBLE")
    retro = spark.createDataFrame([(1, 10.0, 2.0, 0.1), (2, 10.0, 2.0, 0.1), (3, None, None, None), (4, 10.0, 2.0, 0.1), (5, 10.0, 2.0, 0.1)], FITS)
    obs = spark.createDataFrame([(1, 20.0, 4.0, 0.1), (2, 20.0, None, None), (3, 20.0, 4.0, 0.0), (4, 20.0, 4.0, 0.1), (5, 20.0, 4.0, 0.1)], FITS)
    out = {r.cell_id: r.x for r in A.bias_correct(fc, retro, obs, ["cell_id"], "x").collect()}
    assert out[1] == pytest.approx(24.0)  # same shape: the standardized value carries over
    assert out[2] == 20.0 and out[4] is None and out[6] is None
    assert out[3] == pytest.approx(20 - 4 * math.log(-math.log(0.5)))
    assert out[5] == pytest.approx(20 + 4 / 0.1 * (1 - (-math.log(0.99)) ** 0.1))


def test_value_at_undefined_median(spark):
    fits = spark.createDataFrame([(1, 7.0, None, None), (2, 7.0, 2.0, 0.0)], FITS)
    out = {r.cell_id: r.value for r in A.value_at(fits, sa=0.0, median_when_undefined=True).collect()}
    assert out[1] == 7.0 and out[2] == pytest.approx(7 - 2 * math.log(math.log(2)))
    assert {r.value for r in A.value_at(fits.where("cell_id = 1"), rp=10.0, median_when_undefined=True).collect()} == {None}


def test_nonparametric_anomaly_straddling_the_middle_is_zero(spark):
    obs = spark.createDataFrame([(1, 5.0), (1, 1.0)], "cell_id INT, x DOUBLE")
    hist = spark.createDataFrame([(1, v) for v in (1.0, 5.0, 5.0, 5.0, 9.0)], "cell_id INT, obs DOUBLE")
    out = {r.x: r.x_sa for r in A.nonparametric_anomaly(obs, hist, ["cell_id"], "x", "obs").collect()}
    assert out[5.0] == pytest.approx(0.0, abs=1e-15)
    assert out[1.0] == pytest.approx(NormalDist().inv_cdf((2 - 1 / 3) / (5 + 4 / 3)))


def test_composites(spark):
    rows = [(1, 4.0, 9.0, -4.0, -7.0, 1), (2, 4.0, None, 1.0, None, None), (3, None, None, -5.0, -5.0, 1), (4, 3.0, 3.0, -1.0, 0.0, 1)]
    df = spark.createDataFrame(rows, "cell_id INT, s1 DOUBLE, s2 DOUBLE, d1 DOUBLE, d2 DOUBLE, mask INT")
    out = {r.cell_id: r for r in K.composite(df, ["s1", "s2"], ["d1", "d2"], 2.0, 5.0).collect()}
    assert (out[1].surplus, out[1].surplus_cause, out[1].deficit, out[1].deficit_cause, out[1].both) == (5.0, 2, -5.0, 2, 5.0)
    assert (out[2].surplus, out[2].surplus_cause_name, out[2].deficit, out[2].both) == (4.0, "s1", 1.0, 0.0)
    assert (out[3].surplus, out[3].surplus_cause, out[3].deficit_cause, out[3].both) == (None, None, 1, None)
    assert out[4].surplus_cause == 1 and out[4].both == 0.0
    masked = {r.cell_id: r for r in K.composite_surplus(df, ["s1", "s2"], mask="mask").collect()}
    assert masked[2].surplus is None and masked[2].surplus_cause is None and masked[2].surplus_cause_name is None
    surplus, deficit = K.composite_spec("return_period", 12, 50)
    assert [s.name for s in surplus] == ["RO_mm_sum_rp_q50", "Bt_RO_sum_rp_q50"] and deficit[0].transforms == ("fill0", "negate")


def test_fits_carry_their_distribution(spark):
    rows = [(c, float(v)) for c in (1, 2) for v in (1, 2, 4, 7, 11, 16, 22, 29, 37, 46, 56, 90)]
    df = spark.createDataFrame(rows, "cell_id int, x double")
    gev, pe3 = D.fit(df, ["cell_id"], "x", "gev"), D.fit(df, ["cell_id"], "x", "pe3")
    for wrong in (lambda: A.standard_anomaly(df, pe3, ["cell_id"], "x"), lambda: A.value_at(pe3, rp=10.0), lambda: A.bias_correct(df, gev, pe3, ["cell_id"], "x"),
                  lambda: A.raw_to_quantile(df, pe3, ["cell_id"], "x", "p"), lambda: A.standard_anomaly(df, gev, ["cell_id"], "x", "pe3")):
        with pytest.raises(Exception, match="is used as"):
            wrong().collect()
    mixed = gev.where("cell_id = 1").unionByName(pe3.where("cell_id = 2"))
    got = {(r.cell_id, r.x): r.x_sa for r in A.standard_anomaly(df, mixed, ["cell_id"], "x", None).collect()}
    for cell, fits, name in ((1, gev, "gev"), (2, pe3, "pe3")):
        for r in A.standard_anomaly(df.where(f"cell_id = {cell}"), fits, ["cell_id"], "x", name).collect():
            assert got[cell, r.x] == pytest.approx(r.x_sa)
    with pytest.raises(Exception, match="unknown distribution"):
        A.standard_anomaly(df, gev.withColumn("distribution", F.lit("gamma")), ["cell_id"], "x", None).collect()


def test_incomplete_gamma_folds_carry_one_number(spark):
    # a row made for every term of the series took most of the time
    df = spark.range(3).select((F.col("id") + 2.5).alias("a"), (F.col("id") + 1.5).alias("x"))
    made = df.select(N._gamma_series(F.col("a"), F.col("x"), N.ln_gamma(F.col("a"))).alias("p"))
    assert "transform" not in made._jdf.queryExecution().analyzed().toString()

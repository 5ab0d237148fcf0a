"""Normal, gamma and extreme-value functions as Column expressions.

Shape follows Hosking's sign: the extreme-value distribution is bounded above for shape > 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: Wichura (1988), algorithm AS 241, PPND16; numerator and denominator, lowest order first
PPF_CENTRE = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
     4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
)
PPF_MIDDLE = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
     1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
PPF_TAIL = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
     2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)
# fixed values: Hart (1968) as given by West (2005), highest order first
CDF_NUMERATOR = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871,
                 221.213596169931, 220.206867912376)
CDF_DENOMINATOR = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674,
                   637.333633378831, 793.826512519948, 440.413735824752)
# terms of the continued fraction beyond 7 standard deviations
FRACTION_TERMS = 16
# fixed values: Lanczos approximation of the gamma function, g = 7, n = 9
LANCZOS_G = 7
LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
           12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)
# fixed values: bounds of anomalies, of return periods, and of corrected forecast quantiles
MAX_ANOMALY = 100.0
MAX_RETURN_PERIOD = 1000.0
EXTREME_CUTOFF = 100.0
GUMBEL_BELOW = 1e-6


def horner(coefficients, x):
    """Polynomial with the highest order first; works for Columns and for SQL text alike."""
    if isinstance(x, str):
        out = repr(coefficients[0])
        for c in coefficients[1:]:
            out = f"({out} * {x} + ({c!r}))"
        return out
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


def _ppf(p: Column, q: Column, rest: Column) -> Column:
    def ratio(table, x):
        return horner(table[0][::-1], x) / horner(table[1][::-1], x)

    centre = q * ratio(PPF_CENTRE, F.lit(0.180625) - q * q)
    tail = F.when(rest <= 5, ratio(PPF_MIDDLE, rest - 1.6)).otherwise(ratio(PPF_TAIL, rest - 5))
    return (F.when(p == 0, F.lit(float("-inf"))).when(p == 1, F.lit(float("inf")))
            .when((p < 0) | (p > 1), None)
            .when(F.abs(q) <= 0.425, centre).otherwise(F.signum(q) * tail))


def _ppf_parts(p: Column) -> tuple[Column, Column]:
    inside = F.when((p > 0) & (p < 1), p)
    return p - 0.5, F.sqrt(-F.ln(F.when(inside < 0.5, inside).otherwise(1 - inside)))


def norm_ppf(p: Column) -> Column:
    """Quantile of the standard normal distribution; infinite at 0 and 1, NULL outside."""
    return _ppf(p, *_ppf_parts(p))


def _upper_tail(z: Column, e: Column) -> Column:
    near = e * horner(CDF_NUMERATOR, z) / horner(CDF_DENOMINATOR, z)
    far = z + 0.65
    for n in range(FRACTION_TERMS, 0, -1):
        far = z + F.lit(float(n)) / far
    return (F.when(z > 37, F.lit(0.0)).when(z < 7.07106781186547, near)
            .otherwise(e / far / math.sqrt(2 * math.pi)))


def norm_cdf(x: Column) -> Column:
    """Probability of the standard normal distribution."""
    z = F.abs(x)
    upper = _upper_tail(z, F.exp(-z * z / 2))
    return F.when(x.isNull(), None).when(x > 0, 1 - upper).otherwise(upper)


# The same in steps: each intermediate value is a column of its own projection, computed once per row,
# which keeps the generated code small however the input was computed.

def with_anomaly(df: DataFrame, p: str, output: str) -> DataFrame:
    """Add the anomaly of the probability ``p``, between ±100."""
    q, rest = _ppf_parts(F.col(p))
    out = df.withColumns({"_q": q, "_rest": rest})
    out = out.withColumn(output, _ppf(F.col(p), F.col("_q"), F.col("_rest"))).drop("_q", "_rest")
    bounded = F.least(F.greatest(F.col(output), F.lit(-MAX_ANOMALY)), F.lit(MAX_ANOMALY))
    return out.withColumn(output, F.when(F.col(output).isNotNull(), bounded))


def with_return_period(df: DataFrame, sa: str, output: str) -> DataFrame:
    """Add the signed return period of an anomaly, between ±1000."""
    z = F.abs(F.col(sa))
    out = df.withColumns({"_z": z, "_e": F.exp(-z * z / 2)})
    out = out.withColumn("_tail", _upper_tail(F.col("_z"), F.col("_e")))
    return out.withColumn(output, _rp(F.col(sa), F.col("_tail"))).drop("_z", "_e", "_tail")


def _rp(sa: Column, tail: Column) -> Column:
    size = F.when(tail * MAX_RETURN_PERIOD <= 1, F.lit(MAX_RETURN_PERIOD)).otherwise(1 / tail)
    return F.when(sa.isNotNull(), F.signum(sa) * size)


def ln_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x > 0."""
    # shifting by one keeps the series in its range for x below 1/2
    y = x
    series = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], start=1):
        series = series + F.lit(c) / (y + F.lit(float(i)))
    t = y + (LANCZOS_G + 0.5)
    return F.lit(0.5 * math.log(2 * math.pi)) + (y + 0.5) * F.ln(t) - t + F.ln(series) - F.ln(x)


def gamma(x: Column) -> Column:
    return F.exp(ln_gamma(x))


def cdf_gev(x: Column, location: Column, scale: Column, shape: Column) -> Column:
    y = (x - location) / F.nullif(scale, F.lit(0.0))
    reach = F.greatest(F.lit(0.0), 1 - shape * y)
    # e^(-y) written as a power; at the bound it is 0 for shape > 0 and infinite for shape < 0
    weight = (F.when(shape == 0, F.exp(-y)).when(reach > 0, F.pow(reach, 1 / shape))
              .when(shape > 0, F.lit(0.0)).otherwise(F.lit(float("inf"))))
    defined = x.isNotNull() & location.isNotNull() & scale.isNotNull() & shape.isNotNull()
    return F.when(defined, F.exp(-weight))


def qua_gev(p: Column, location: Column, scale: Column, shape: Column) -> Column:
    y = -F.ln(p)
    return F.when(shape == 0, location - scale * F.ln(y)).otherwise(location + scale / shape * (1 - F.pow(y, shape)))


def sa2rp(sa: Column) -> Column:
    """Signed return period of an anomaly, between ±1000; 0 for an anomaly of 0."""
    z = F.abs(sa)
    return _rp(sa, _upper_tail(z, F.exp(-z * z / 2)))


def rp2sa(rp: Column) -> Column:
    """Inverse of :func:`sa2rp`; NULL for return periods below 1."""
    return F.when(F.abs(rp) >= 1, F.signum(rp) * norm_ppf(1 - 1 / F.abs(rp)))


def rp2quantile(rp: Column) -> Column:
    return F.when(rp > 0, 1 - 1 / rp).when(rp < 0, -1 / rp)


def quantile2rp(q: Column) -> Column:
    return (F.when(q >= 1, F.lit(float("inf"))).when(q > 0.5, 1 / (1 - q))
            .when(q > 0, -1 / q).when(q <= 0, F.lit(float("-inf"))))


# From this shape on the incomplete gamma function follows its uniform expansion around the normal distribution.
LARGE_SHAPE = 400.0
# fixed values: Taylor coefficients of the first two terms of that expansion (DLMF 8.12.11)
EXPANSION_0 = (-1 / 3, 1 / 12, -2 / 135, 1 / 864, 1 / 2835, -139 / 777600, 1 / 25515)
EXPANSION_1 = (-1 / 540, -1 / 288, 1 / 378, -77 / 77760, 1 / 4860)
# steps towards a quantile: Newton's, or halving where those leave the bracket
QUANTILE_STEPS = 24


def _far(a: Column) -> Column:
    """Where the upper tail of the gamma distribution is below 1e-15."""
    return a + 40 + 12 * F.sqrt(a)


def _gamma_series(a: Column, x: Column, lg: Column) -> Column:
    """x^a e^-x / gamma(a + 1) times the sum of x^n / ((a + 1) ... (a + n)) (DLMF 8.7.1): all terms are positive, so nothing cancels."""
    terms = F.ceil(F.greatest(F.lit(0.0), x - a) + 9 * F.sqrt(x) + 40).cast("int")

    # from the last term back, 1 + x / (a + 1) (1 + x / (a + 2) (1 + ...)): one number goes from step to step
    total = F.aggregate(F.sequence(terms, F.lit(1), F.lit(-1)), F.lit(1.0), lambda s, n: 1 + s * x / (a + n))
    return total * F.exp(a * F.ln(x) - x - lg - F.ln(a))


def _gamma_expansion(a: Column, x: Column) -> Column:
    """The uniform expansion for large shapes (DLMF 8.12), two terms."""
    mu = (x - a) / a
    near = F.lit(0.0)
    for k in range(16, 1, -1):
        near = near * mu + F.lit((-1.0) ** k / k)
    half = F.when(F.abs(mu) < 0.1, near * mu * mu).otherwise(mu - F.log1p(mu))
    eta = F.signum(mu) * F.sqrt(2 * half)
    c0 = F.when(F.abs(eta) < 0.2, horner(EXPANSION_0[::-1], eta)).otherwise(1 / mu - 1 / eta)
    c1 = F.when(F.abs(eta) < 0.2, horner(EXPANSION_1[::-1], eta)).otherwise(1 / (eta * eta * eta) - 1 / (mu * mu * mu) - 1 / (mu * mu) - 1 / (12 * mu))
    return norm_cdf(eta * F.sqrt(a)) - F.exp(-a * half) / F.sqrt(2 * math.pi * a) * (c0 + c1 / a)


def lower_gamma(a: Column, x: Column, lg: Column) -> Column:
    """Regularized lower incomplete gamma function P(a, x); ``lg`` is ln_gamma(a)."""
    return (F.when(a.isNull() | x.isNull(), None).when(x <= 0, 0.0).when(x > _far(a), 1.0)
            .when(a < LARGE_SHAPE, _gamma_series(a, x, lg)).otherwise(_gamma_expansion(a, x)))


def inverse_lower_gamma(a: Column, p: Column, lg: Column) -> Column:
    """x with P(a, x) = p. It lies above (p gamma(a + 1))^(1 / a), as P(a, x) < x^a / gamma(a + 1)."""
    low = F.least(_far(a), F.exp((F.ln(p) + lg + F.ln(a)) / a))
    start = F.when(a > 1, F.least(_far(a), F.greatest(low, a + norm_ppf(p) * F.sqrt(a)))).otherwise(low)

    def step(acc: Column, _: Column) -> Column:
        x = acc["x"]

        def moved(f: Column) -> Column:
            lo, hi = F.when(f < 0, x).otherwise(acc["lo"]), F.when(f < 0, acc["hi"]).otherwise(x)
            newton = x - F.try_divide(f, F.exp((a - 1) * F.ln(x) - x - lg))
            inside = (newton >= lo) & (newton <= hi)
            # the error is squared by each of Newton's steps, so the one after a step this small would change no digit
            there = inside & (F.abs(newton - x) <= 1e-9 * x)
            to = F.when(inside, newton).otherwise((lo + hi) / 2)
            return F.struct(lo.alias("lo"), hi.alias("hi"), to.alias("x"), F.coalesce(there, F.lit(False)).alias("there"))

        return F.when(acc["there"], acc).otherwise(F.transform(F.array(lower_gamma(a, x, lg) - p), moved)[0])

    first = F.struct(low.alias("lo"), _far(a).alias("hi"), start.alias("x"), F.lit(False).alias("there"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(QUANTILE_STEPS)), first, step, lambda acc: acc["x"])
    return F.when(a.isNull() | p.isNull(), None).when(p <= 0, 0.0).when(p >= 1, float("inf")).otherwise(found)


NORMAL_BELOW = 1e-6


def _with_cdf_pe3(df: DataFrame, x: str, params: list[str], output: str) -> DataFrame:
    """Pearson III with location = mean, scale = standard deviation, shape = skewness."""
    location, scale, shape = (F.col(c) for c in params)
    alpha = F.when(F.abs(shape) >= NORMAL_BELOW, 4 / (shape * shape))
    out = df.withColumns({"_a": alpha, "_z": (F.col(x) - location) / F.nullif(scale, F.lit(0.0))})
    out = out.withColumns({"_y": F.greatest(F.lit(0.0), 2 * F.col("_z") / F.nullif(shape, F.lit(0.0)) + F.col("_a")), "_lg": ln_gamma(F.col("_a"))})
    out = out.withColumn("_g", lower_gamma(F.col("_a"), F.col("_y"), F.col("_lg")))
    p = F.when(F.col("_a").isNull(), norm_cdf(F.col("_z"))).when(shape < 0, 1 - F.col("_g")).otherwise(F.col("_g"))
    defined = F.col("_z").isNotNull() & shape.isNotNull()
    return out.withColumn(output, F.when(defined, p)).drop("_a", "_z", "_y", "_lg", "_g")


def _with_quantile_pe3(df: DataFrame, p: str, params: list[str], output: str) -> DataFrame:
    location, scale, shape = (F.col(c) for c in params)
    out = df.withColumn("_a", F.when(F.abs(shape) >= NORMAL_BELOW, 4 / (shape * shape)))
    out = out.withColumns({"_y": F.when(shape > 0, F.col(p)).otherwise(1 - F.col(p)), "_lg": ln_gamma(F.col("_a"))})
    out = out.withColumn("_g", inverse_lower_gamma(F.col("_a"), F.col("_y"), F.col("_lg")))
    beta = F.abs(scale * shape) / 2
    side = F.when(shape > 0, 1.0).otherwise(-1.0)
    q = F.when(F.col("_a").isNull(), location + scale * norm_ppf(F.col(p))).otherwise(
        location + side * beta * (F.col("_g") - F.col("_a")))
    return out.withColumn(output, F.when(shape.isNotNull(), q)).drop("_a", "_y", "_lg", "_g")


def with_cdf(df: DataFrame, distribution: str, x: str, params: list[str], output: str) -> DataFrame:
    """Add the probability of column ``x`` under the named distribution with parameter columns ``params``."""
    if distribution == "gev":
        return df.withColumn(output, cdf_gev(F.col(x), *[F.col(c) for c in params]))
    if distribution == "pe3":
        return _with_cdf_pe3(df, x, params, output)
    raise ValueError(f"unknown distribution: {distribution}")


def with_quantile(df: DataFrame, distribution: str, p: str, params: list[str], output: str) -> DataFrame:
    """Add the quantile of column ``p`` under the named distribution."""
    if distribution == "gev":
        return df.withColumn(output, qua_gev(F.col(p), *[F.col(c) for c in params]))
    if distribution == "pe3":
        return _with_quantile_pe3(df, p, params, output)
    raise ValueError(f"unknown distribution: {distribution}")


def noise(seed: int, *columns: str) -> Column:
    """A standard normal number made of a seed and the values of columns, the same in every attempt and partitioning."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns])), 1, 12), 16, 10)
    return norm_ppf((bits.cast("double") + 0.5) / float(1 << 48))

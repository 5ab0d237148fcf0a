"""Pieces of DuckDB text for functions neither engine has: normal distribution, extreme-value fits."""

from __future__ import annotations

from ..functions.numeric import CDF_DENOMINATOR, CDF_NUMERATOR, FRACTION_TERMS, PPF_CENTRE, PPF_MIDDLE, PPF_TAIL, horner


def ppf(p: str) -> str:
    def ratio(t, x):
        return f"{horner(t[0][::-1], x)} / {horner(t[1][::-1], x)}"

    def tail(rest):
        return f"(CASE WHEN {rest} <= 5 THEN {ratio(PPF_MIDDLE, f'({rest} - 1.6e0)')} ELSE {ratio(PPF_TAIL, f'({rest} - 5e0)')} END)"

    return f"""(CASE WHEN {p} IS NULL OR {p} < 0 OR {p} > 1 THEN NULL WHEN {p} = 0 THEN '-inf'::DOUBLE WHEN {p} = 1 THEN 'inf'::DOUBLE
      WHEN abs({p} - 0.5e0) <= 0.425e0 THEN ({p} - 0.5e0) * {ratio(PPF_CENTRE, f'(0.180625e0 - ({p} - 0.5e0) * ({p} - 0.5e0))')}
      WHEN {p} < 0.5e0 THEN -{tail(f'sqrt(-ln({p}))')} ELSE {tail(f'sqrt(-ln(1 - {p}))')} END)"""


def cdf(x: str) -> str:
    z = f"abs({x})"
    far = f"({z} + 0.65e0)"
    for n in range(FRACTION_TERMS, 0, -1):
        far = f"({z} + {n}e0 / {far})"
    upper = f"""(CASE WHEN {z} > 37 THEN 0e0 WHEN {z} < 7.07106781186547e0 THEN exp(-{z} * {z} / 2) * {horner(CDF_NUMERATOR, z)} / {horner(CDF_DENOMINATOR, z)}
      ELSE exp(-{z} * {z} / 2) / {far} / sqrt(2 * pi()) END)"""
    return f"(CASE WHEN {x} IS NULL THEN NULL WHEN {x} > 0 THEN 1 - {upper} ELSE {upper} END)"


def bounded_sa(p: str) -> str:
    return f"(CASE WHEN {p} IS NULL THEN NULL ELSE least(greatest({ppf(p)}, -100e0), 100e0) END)"


def sa2rp(x: str) -> str:
    tail = cdf(f"(-abs({x}))")
    return f"(CASE WHEN {x} IS NULL THEN NULL ELSE sign({x}) * CASE WHEN {tail} * 1000 <= 1 THEN 1000e0 ELSE 1 / {tail} END END)"


def cdf_gev(x: str, pre: str = "") -> str:
    a, b, k = f"{pre}location", f"{pre}scale", f"{pre}shape"
    y = f"(({x} - {a}) / {b})"
    return f"""(CASE WHEN {x} IS NULL OR {a} IS NULL OR {b} IS NULL OR {k} IS NULL THEN NULL
      WHEN {k} = 0 THEN exp(-exp(-{y})) WHEN 1 - {k} * {y} <= 0 THEN CASE WHEN {k} > 0 THEN 1e0 ELSE 0e0 END
      ELSE exp(-exp(ln(1 - {k} * {y}) / {k})) END)"""


def qua_gev(p: str, pre: str = "") -> str:
    a, b, k = f"{pre}location", f"{pre}scale", f"{pre}shape"
    return f"(CASE WHEN {k} = 0 THEN {a} - {b} * ln(-ln({p})) ELSE {a} + {b} / {k} * (1 - pow(-ln({p}), {k})) END)"


def moments(name: str, source: str, keys: str, x: str) -> str:
    """CTEs ending in ``<name>_l`` with n, u, med, l1, l2, t3, t4, t5 per key; keys without values keep a row."""
    on = " AND ".join(f"a.{k.strip()} IS NOT DISTINCT FROM b.{k.strip()}" for k in keys.split(","))
    ks = ", ".join(f"a.{k.strip()}" for k in keys.split(","))
    return f"""
, {name}_r AS (SELECT {keys}, {x} AS x, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY {x}) - 1 AS DOUBLE) AS j FROM {source} WHERE {x} IS NOT NULL)
, {name}_s AS (SELECT {keys}, count(*) AS n, count(DISTINCT x) AS u, quantile_cont(x, 0.5e0) AS med, sum(x) AS s0, sum(x*j) AS s1, sum(x*j*(j-1)) AS s2,
      sum(x*j*(j-1)*(j-2)) AS s3, sum(x*j*(j-1)*(j-2)*(j-3)) AS s4 FROM {name}_r GROUP BY {keys})
, {name}_b AS (SELECT {keys}, n, u, med, s0/n AS b0, CASE WHEN n>1 THEN s1/n/(n-1) END AS b1, CASE WHEN n>2 THEN s2/n/(n-1)/(n-2) END AS b2,
      CASE WHEN n>3 THEN s3/n/(n-1)/(n-2)/(n-3) END AS b3, CASE WHEN n>4 THEN s4/n/(n-1)/(n-2)/(n-3)/(n-4) END AS b4 FROM {name}_s)
, {name}_m AS (SELECT {keys}, n, u, med, b0 AS l1, 2*b1-b0 AS l2, 6*b2-6*b1+b0 AS l3, 20*b3-30*b2+12*b1-b0 AS l4, 70*b4-140*b3+90*b2-20*b1+b0 AS l5 FROM {name}_b)
, {name}_l AS (SELECT {ks}, coalesce(n, 0) AS n, coalesce(u, 0) AS u, med, l1, l2, CASE WHEN l2>0 THEN l3/l2 END AS t3, CASE WHEN l2>0 THEN l4/l2 END AS t4,
      CASE WHEN l2>0 THEN l5/l2 END AS t5 FROM (SELECT DISTINCT {keys} FROM {source}) a LEFT JOIN {name}_m b ON {on})"""


def gev(name: str, source: str, keys: str, x: str, nmin_defined: int = 10, nmin_unique: int = 10) -> str:
    """CTEs ending in ``<name>`` (keys, location, scale, shape, n_defined, n_unique); the shape by bisection."""
    out = moments(name, source, keys, x)
    tau = "(2 * (1 - pow(3e0, -({k}))) / (1 - pow(2e0, -({k}))) - 3)"
    out += f"\n, {name}_k0 AS (SELECT *, -0.99999999e0 AS lo, 60e0 AS hi FROM {name}_l)"
    steps = 64
    for i in range(steps):
        # the ratio falls as the shape grows; 0.1699… is its value at shape 0, where the formula is undefined
        mid = "((lo + hi) / 2)"
        value = f"CASE WHEN abs({mid}) < 1e-9 THEN 2 * ln(3) / ln(2) - 3 ELSE {tau.format(k=mid)} END"
        out += f"""
, {name}_k{i + 1} AS (SELECT * EXCLUDE (lo, hi), CASE WHEN {value} > t3 THEN {mid} ELSE lo END AS lo, CASE WHEN {value} > t3 THEN hi ELSE {mid} END AS hi FROM {name}_k{i})"""
    out += f"""
, {name}_k AS (SELECT *, CASE WHEN t3 > -1 AND t3 < 1 THEN (lo + hi) / 2 END AS k FROM {name}_k{steps})
, {name}_p AS (SELECT *, CASE WHEN abs(k) < 1e-6 THEN l2 / ln(2) WHEN k IS NULL THEN NULL ELSE l2 * k / ((1 - pow(2e0, -k)) * gamma(1 + k)) END AS sc FROM {name}_k)
, {name} AS (SELECT {keys}, CASE WHEN n >= {nmin_defined} AND u < {nmin_unique} THEN med WHEN n >= {nmin_defined} AND sc <> 0 THEN
      CASE WHEN abs(k) < 1e-6 THEN l1 - 0.5772156649015329e0 * sc ELSE l1 - sc * (1 - gamma(1 + k)) / k END END AS location,
      CASE WHEN n >= {nmin_defined} AND u >= {nmin_unique} AND sc <> 0 THEN sc END AS scale,
      CASE WHEN n >= {nmin_defined} AND u >= {nmin_unique} AND sc <> 0 THEN CASE WHEN abs(k) < 1e-6 THEN 0e0 ELSE k END END AS shape,
      n AS n_defined, u AS n_unique FROM {name}_p)"""
    return out

"""Neighbours, grids and flow networks against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from rillmark.operators import joins as J
from rillmark.operators import network as N
from rillmark.operators import power as E
from rillmark.operators import spatial as Z


def brute_nearest(left, right, limit):
    def gap(a, b):
        (la, lo), (lb, lp) = a, b
        u = [math.cos(math.radians(la)) * math.cos(math.radians(lo)), math.cos(math.radians(la)) * math.sin(math.radians(lo)), math.sin(math.radians(la))]
        v = [math.cos(math.radians(lb)) * math.cos(math.radians(lp)), math.cos(math.radians(lb)) * math.sin(math.radians(lp)), math.sin(math.radians(lb))]
        return 2 * 6371000 * math.asin(min(1.0, math.dist(u, v) / 2))
    out = {}
    for i, a in left:
        best = min(((gap(a, b), j) for j, b in right))
        if best[0] <= limit:
            out[i] = best
    return out


@pytest.mark.parametrize("leaf", [2, 16])
def test_nearest_match_in_crowded_places(spark, leaf):
    rnd = random.Random(3)
    # a crowd of places within a few hundred metres, others across the date line and at the pole
    spots = [(48.0, 11.0)] * 60 + [(0.0, 179.999)] * 6 + [(0.0, -179.999)] * 6 + [(89.9999, 10.0)] * 4 + [(-30.0, 60.0)] * 4
    off = lambda la, d: (la + rnd.uniform(-d, d) * (la < 89), rnd.uniform(-d, d) * (1 if la < 89 else 1e4))
    place = lambda la, lo, d: (lambda o: (o[0], lo + o[1]))(off(la, d))
    right = [(j, place(la, lo, 2e-3)) for j, (la, lo) in enumerate(spots)]
    right += [(1000, right[0][1])]  # the same place again
    left = [(i, place(la, lo, 4e-3)) for i, (la, lo) in enumerate(spots)]
    left += [(500, (89.9999, -170.0)), (501, (10.0, 10.0))]
    mk = lambda rows, name: spark.createDataFrame([(i, p[0], p[1]) for i, p in rows], f"{name} INT, lat DOUBLE, lon DOUBLE")
    out = {r.id: (r.distance_m, r.site) for r in J.nearest_match(mk(left, "id"), mk(right, "site"), "id", "site", 1000.0, leaf).collect()}
    want = brute_nearest(left, right, 1000.0)
    assert out.keys() == want.keys()
    for i, (d, j) in want.items():
        assert out[i][0] == pytest.approx(d, abs=1e-2) and out[i][1] == j
    near = {r.id: r.near for r in J.near_any(mk(left, "id"), mk(right, "site"), "id", "site", 1000.0).collect()}
    assert near == {i: i in want for i, _ in left}


def test_nearest_match_knows_a_pole_by_any_longitude(spark):
    right = spark.createDataFrame([(0, -90.0, -180.0), (1800, -90.0, 0.0), (7, 10.0, 180.0), (3, 10.0, -180.0)], "site INT, lat DOUBLE, lon DOUBLE")
    left = spark.createDataFrame([(1, -90.0, 0.0), (2, -90.0, 77.0), (3, 10.0, 180.0), (4, 10.0, -540.0)], "id INT, lat DOUBLE, lon DOUBLE")
    out = {r.id: r.site for r in J.nearest_match(left, right, "id", "site", 1000.0).collect()}
    assert out == {1: 0, 2: 0, 3: 3, 4: 3}


def brute_network(rows):
    down, flow = {i: d for i, d, _ in rows}, {i: f for i, _, f in rows}
    total = {i: 0.0 for i in down}
    below = {i: 0.0 for i in down}
    for i in down:
        at, chain = i, []
        while at > 0:
            total[at] = None if total[at] is None or flow[i] is None else total[at] + flow[i]
            if at != i:
                below[i] = None if below[i] is None or flow[at] is None else below[i] + flow[at]
            at = down[at]
    return total, below


@pytest.mark.parametrize("kind", ["chain", "star", "random"])
def test_accumulation_both_ways(spark, kind):
    rnd = random.Random(8)
    n = 90
    down = {"chain": lambda i: i - 1, "star": lambda i: 0 if i == 1 else 1, "random": lambda i: rnd.randint(-1, i - 1)}[kind]
    rows = [(i, down(i), None if kind == "random" and i % 29 == 5 else float(rnd.randint(1, 9))) for i in range(1, n + 1)]
    df = spark.createDataFrame(rows, "id BIGINT, downstream_id BIGINT, flow DOUBLE")
    total, below = brute_network(rows)
    assert {r.id: r.flow_out for r in N.accumulate(df).collect()} == total
    assert {r.id: r.flow_downstream for r in N.downstream_flow(df).collect()} == below


def _written(spark, network, run):
    """Bytes that a job leaves and writes in the scratch folder, against those of the network written the same way."""
    import pathlib

    from rillmark import session

    sizes, write = [], session.write_round

    def spy(df, *by):
        out = write(df, *by)
        sizes.append(sum(pathlib.Path(f.removeprefix("file://")).stat().st_size for f in out.inputFiles()))
        return out

    N.write_round = spy
    try:
        run(network).count()
    finally:
        N.write_round = write
    spy(network)
    return sum(sizes[:-1]) / sizes[-1]


def test_rounds_write_little(spark):
    rows = [(i, 0 if i % 120 == 1 else i - 1 - min((i - 1) % 7, (i - 1) % 120 - 1), float((i * 7919) % 1000) / 7) for i in range(1, 60_001)]
    df = spark.createDataFrame(rows, "id BIGINT, downstream_id BIGINT, flow DOUBLE").coalesce(1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        assert _written(spark, df, N.accumulate) <= 3
        assert _written(spark, df, N.downstream_flow) <= 3
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")


def test_cycles_are_named(spark):
    rows = [(1, 0, 1.0), (2, 1, 1.0), (3, 5, 1.0), (4, 3, 1.0), (5, 4, 1.0), (6, 5, 1.0), (7, 6, 1.0)]
    df = spark.createDataFrame(rows, "id BIGINT, downstream_id BIGINT, flow DOUBLE")
    for run in (N.accumulate, N.downstream_flow):
        with pytest.raises(ValueError, match=r"cycle through \[3, 4, 5\]"):
            run(df)


def test_small_basins(spark):
    rows = [(1, 0, 2.0), (2, 1, 3.0), (3, 1, 5.0), (4, 3, 7.0), (5, -1, 11.0)]
    df = spark.createDataFrame(rows, "id BIGINT, downstream_id BIGINT, flow DOUBLE")
    assert {r.id: r.flow_out for r in N.accumulate(df).collect()} == {1: 17.0, 2: 3.0, 3: 12.0, 4: 7.0, 5: 11.0}
    broken = df.unionByName(spark.createDataFrame([(9, 77, 1.0)], df.schema))
    with pytest.raises(ValueError, match="do not exist"):
        N.accumulate(broken)


def grid(spark, rows, name="d8", kind="INT"):
    cells = [(i, j, v) for i, line in enumerate(rows) for j, v in enumerate(line)]
    return spark.createDataFrame(cells, f"row_no INT, col_no INT, {name} {kind}")


def as_grid(df, name):
    cells = {(r.row_no, r.col_no): r[name] for r in df.collect()}
    rows, cols = max(i for i, _ in cells) + 1, max(j for _, j in cells) + 1
    return [[cells[i, j] for j in range(cols)] for i in range(rows)]


def test_directions_wrap_and_cross_the_pole(spark):
    dirs = grid(spark, [[64, 16, 128, 0], [1, 2, 8, 1]])
    flat = N.d8_to_network(dirs, 2, 4)
    assert as_grid(flat, "downstream_id") == [[0, 1, 0, 0], [6, 0, 0, 0]]
    wrapped = as_grid(N.d8_to_network(dirs, 2, 4, True, True), "downstream_id")
    # north from row 0 mirrors the column: 0 -> 3; northeast from column 2 -> 1, then one east -> 2
    assert wrapped[0] == [4, 1, 3, 0]
    # southeast from the last row, column 1: mirrored to 2, one east -> 3; southwest, column 2: mirrored to 1 -> 0; east wraps
    assert wrapped[1] == [6, 8, 5, 5]
    assert as_grid(N.inward_directions(flat), "inward")[0][0] == 16


def test_grid_accumulation_rules(spark):
    dirs = grid(spark, [[1, 1, 4], [1, 1, 0], [0, 16, 16]])
    flow = grid(spark, [[1.0, None, 2.0], [None, None, 5.0], [3.0, None, 4.0]], "value", "DOUBLE")
    out = as_grid(N.accumulate_grid(dirs, flow, 3, 3), "value")
    assert out == [[1.0, 1.0, 3.0], [None, 0.0, 8.0], [7.0, 4.0, 4.0]]


def test_grid_accumulation_on_finer_directions(spark):
    dirs = grid(spark, [[1, 1, 1, 0], [1, 1, 1, 0]])
    flow = grid(spark, [[8.0, 4.0]], "value", "DOUBLE")
    # of each block only what leaves it counts: the right column of each
    assert as_grid(N.accumulate_grid(dirs, flow, 2, 4, factor=2), "value") == [[8.0, 12.0]]


def test_total_at_sinks_equals_total_flow(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.randint(0, i - 1), rnd.random()) for i in range(1, 200)]
    df = spark.createDataFrame(rows, "id BIGINT, downstream_id BIGINT, flow DOUBLE")
    sinks = N.accumulate(df).join(df.where("downstream_id = 0").select("id"), "id").agg(F.sum("flow_out")).first()[0]
    assert sinks == pytest.approx(sum(r[2] for r in rows))


def test_blocks_and_days_of_year(spark):
    g = grid(spark, [[1.0, None, 5.0, 6.0], [3.0, None, None, 7.0]], "value", "DOUBLE")
    assert as_grid(Z.block_aggregate(g, 2, "value", "sum"), "value") == [[4.0, 18.0]]
    assert as_grid(Z.block_aggregate(g.where("col_no < 2 OR value IS NULL"), 2, "value", "mean"), "value")[0][0] == 2.0
    with pytest.raises(ValueError):
        Z.require_divisible(g, 3)
    days = spark.createDataFrame([(360, 4), (10, 4), (100, 5), (None, 5), (364, 6), (1, 6)], "doy INT, k INT")
    out = {r.k: r.d for r in days.groupBy("k").agg(Z.mean_doy(F.col("doy")).alias("d")).collect()}
    assert out[4] == 3 and out[5] == 100 and out[6] == 365


def test_dense_ids(spark):
    df = spark.createDataFrame([(70, 500), (500, 0), (20, 70), (9, 20)], "id BIGINT, down BIGINT")
    out = sorted((r.id, r.down) for r in J.collapse_ids(df, "id", ["down"]).collect())
    assert out == [(1, 2), (2, 3), (3, 4), (4, 0)]


def test_loss_summary_without_hydropower_is_missing(spark):
    plants = spark.createDataFrame([(1, 1, "Hydro", 10.0, 5.0), (1, 1, "Coal", 20.0, 8.0), (2, 2, "Gas", 30.0, 9.0), (2, None, "Gas", 1.0, 1.0)],
                                   "basin_id INT, province_id INT, fuel STRING, capacity_mw DOUBLE, generation_mw DOUBLE")
    losses = spark.createDataFrame([(1, 0.4), (2, 0.9)], "id INT, hydropower_loss DOUBLE")
    out = {r.province_id: r for r in E.summarize_losses(plants, losses, "province_id", 10).collect()}
    assert set(out) == {1, 2}
    assert out[1].gross_loss_mwh == 20.0 and out[1].gross_loss_pct == pytest.approx(2 / 13) and out[1].hydro_loss_pct == pytest.approx(0.4)
    assert out[2].gross_loss_mwh == 0.0 and out[2].hydro_loss_pct is None


def test_flow_of_many_months_is_that_of_each(spark):
    net = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, 3), (5, 0)], "id long, downstream_id long")
    flows = [(i, m, float(10 * i + m)) for i in (1, 2, 3, 4, 5) for m in (1, 2, 3) if (i, m) not in ((4, 2), (9, 9))]
    values = spark.createDataFrame(flows, "id long, month int, flow double")
    got = {(r.id, r.month): r.flow_out for r in N.accumulate(net, values=values, by=["month"]).collect()}
    for m in (1, 2, 3):
        own = net.join(values.where(f"month = {m}"), "id", "left")
        for r in N.accumulate(own).collect():
            assert got.get((r.id, m)) == r.flow_out

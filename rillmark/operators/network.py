"""Flow along a forest of (id, downstream_id) links, and grids of flow directions.

Both totals contract the forest. Leaves, nodes with no other upstream, are raked off: their own total is final, it is handed to the node
downstream, and they leave all later rounds. As long as that takes a third of the nodes or more, it is repeated; most nodes of a river
network go this way in few rounds. What is left, the long stems, goes by pointer doubling: after k rounds every node knows the node 2^k
steps down the river, so the rounds grow with the logarithm of the longest river; nodes that neither hand on nor are handed anything any
more leave. Each round is aggregations (partial sums first, so a node with very many tributaries is no hot spot) and equi-joins on ids; it
is written to the scratch folder, and the round before it is deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, drop_round, write_round
from .quality import check_links, require_empty
from .spatial import disaggregate, zonal_stats

# A round of raking must take one in so many nodes.
WORTH = 3


def _links(network: DataFrame) -> DataFrame:
    """(id, ptr): the node downstream, missing for sinks."""
    require_empty(check_links(network), "links to ids that do not exist")
    return network.select("id", F.when(F.col("downstream_id") > 0, F.col("downstream_id")).alias("ptr"))


def _rake(links: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The layers of leaves (id, ptr) that come off one after the other, and the links of the nodes that stay."""
    layers, rest, n = [], links, None
    while n is None or n:
        marked = write_round(rest.join(_fed(rest), "id", "left").select("id", "ptr", F.coalesce("_leaf", F.lit(True)).alias("leaf")), "leaf")
        leaves, stay = marked.where("leaf").drop("leaf"), marked.where("NOT leaf").drop("leaf")
        count = {r.leaf: r["count"] for r in marked.groupBy("leaf").count().collect()}
        taken, left = count.get(True, 0), count.get(False, 0)
        if taken * WORTH < taken + left:
            if n is None:
                return [], marked.drop("leaf")
            drop_round(marked)
            break
        layers.append(leaves)
        rest, n = stay, left
    return layers, rest


def _doubled(pointers: DataFrame) -> DataFrame:
    """Pointers of twice the length; those that would lead past a sink are gone."""
    ahead = pointers.select(F.col("id").alias("ptr"), F.col("ptr").alias("nptr"))
    return pointers.join(ahead, "ptr").select("id", F.col("nptr").alias("ptr"))


def _no_cycle(pointers: DataFrame, steps: int, nodes: int) -> None:
    """After as many steps as there are nodes, what still points anywhere points to a cycle."""
    if steps > nodes:
        names = sorted(r.ptr for r in pointers.select("ptr").distinct().limit(10).collect())
        raise ValueError(f"the network has a cycle through {names}")


def _fed(links: DataFrame) -> DataFrame:
    return links.where("ptr IS NOT NULL").select(F.col("ptr").alias("id"), F.lit(False).alias("_leaf")).distinct()


def _rake_sums(network: DataFrame, names: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """For one row a node (id, ptr, names): the final rows (id, names) of each layer of leaves, and what stays, with their sums handed on."""
    layers, state = [], network
    while True:
        marked = write_round(state.join(_fed(state), "id", "left").select("id", "ptr", *names, F.coalesce("_leaf", F.lit(True)).alias("leaf")), "leaf")
        count = {r.leaf: r["count"] for r in marked.groupBy("leaf").count().collect()}
        taken, left = count.get(True, 0), count.get(False, 0)
        if taken * WORTH < taken + left or not left:
            return layers, marked.drop("leaf")
        leaves = marked.where("leaf")
        layers.append(leaves.select("id", *names))
        handed = leaves.where("ptr IS NOT NULL").groupBy(F.col("ptr").alias("id")).agg(*[F.sum(n).alias(f"_{n}") for n in names])
        kept = marked.where("NOT leaf").join(handed, "id", "left")
        state = kept.select("id", "ptr", *[(F.col(n) + F.coalesce(f"_{n}", F.lit(0))).alias(n) for n in names])


def _upstream_sums(links: DataFrame, values: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """(id, keys, names): each named column summed, per keys, over the node and everything upstream of it.

    The links do not depend on the keys, so many months or members share them. Without keys, ``values`` has one row a node.
    """
    sums = [F.sum(n).alias(n) for n in names]
    if not keys:
        finals, rest = _rake_sums(links.join(values, "id").select("id", "ptr", *names), names)
        state = rest.select("id", *names)
        pointers = rest.where("ptr IS NOT NULL").select("id", "ptr")
    else:
        state, finals = values.select("id", *keys, *names), []
        layers, rest = _rake(links)
        for leaves in layers:
            mine = leaves.select("id", "ptr", F.lit(True).alias("leaf"))
            held = write_round(state.join(mine, "id", "left").withColumn("leaf", F.coalesce("leaf", F.lit(False))), "leaf")
            finals.append(held.where("leaf").select("id", *keys, *names))
            handed = held.where("leaf AND ptr IS NOT NULL").select(F.col("ptr").alias("id"), *keys, *names)
            state = held.where("NOT leaf").select("id", *keys, *names).unionByName(handed).groupBy("id", *keys).agg(*sums)
        pointers = rest.where("ptr IS NOT NULL")
    nodes = left = pointers.count()
    first, steps = True, 1
    while left:
        _no_cycle(pointers, steps, nodes)
        pushed = state.join(pointers, "id").drop("id").withColumnRenamed("ptr", "id")
        summed = state.unionByName(pushed).groupBy("id", *keys).agg(*sums)
        ahead = write_round(_doubled(pointers))
        left = ahead.count()
        live = ahead.select(F.explode(F.array("id", "ptr")).alias("id")).distinct().withColumn("live", F.lit(True))
        held = write_round(summed.join(live, "id", "left").withColumn("live", F.coalesce("live", F.lit(False))), "live")
        finals.append(held.where("NOT live").select("id", *keys, *names))
        state = held.where("live").select("id", *keys, *names)
        if not first:
            drop_round(pointers)
        pointers, first, steps = ahead, False, 2 * steps
    every = state
    for part in finals:
        every = every.unionByName(part)
    return every


def accumulate(network: DataFrame, flow: str = "flow", output: str = "flow_out", values: DataFrame | None = None, by: list[str] | None = None) -> DataFrame:
    """Own flow plus all flow from upstream; a missing flow makes everything downstream missing.

    Flows of many months or members come in ``values`` (id, ``by`` columns, flow) and are accumulated in one pass; the result then has
    the (id, by) with a row at the node or upstream of it, and a row that is absent counts as a missing flow. A cycle is an error that
    names nodes of it.
    """
    value, by = F.col(flow).cast("double"), by or []
    links = _links(network)
    if values is None:
        own = network.select("id", F.coalesce(value, F.lit(0.0)).alias("s"), F.when(value.isNull(), 1).otherwise(0).cast("bigint").alias("gaps"))
        return _upstream_sums(links, own, [], ["s", "gaps"]).select("id", F.when(F.col("gaps") == 0, F.col("s")).alias(output))
    flows = values.join(network.select("id"), "id", "left_semi").select(
        "id", F.lit(False).alias("_node"), *by, F.coalesce(value, F.lit(0.0)).alias("s"), F.when(value.isNull(), 0).otherwise(1).cast("bigint").alias("n"))
    nodes = network.select("id", F.lit(True).alias("_node"), F.lit(0.0).alias("s"), F.lit(1).cast("bigint").alias("n"))
    total = _upstream_sums(links, flows.unionByName(nodes, allowMissingColumns=True), ["_node", *by], ["s", "n"])
    whole = total.where("_node").select("id", F.col("n").alias("_nodes"))
    return total.where("NOT _node").join(whole, "id").select("id", *by, F.when(F.col("n") == F.col("_nodes"), F.col("s")).alias(output))


def downstream_flow(network: DataFrame, flow: str = "flow", output: str = "flow_downstream") -> DataFrame:
    """Flow of all nodes between a node (not counted) and the sea; missing if any is missing.

    The stems that raking leaves are doubled first; the leaves then take over from the node below them, layer by layer from the sea.
    """
    value = F.col(flow).cast("double")
    own = network.select(F.col("id").alias("ptr"), F.coalesce(value, F.lit(0.0)).alias("v"), F.when(value.isNull(), 1).otherwise(0).cast("bigint").alias("g"))
    layers, rest = _rake(_links(network))
    # the flow from the next node down to just before the pointer's goal, then to the sea
    first = rest.join(own, "ptr", "left").select("id", "ptr", F.coalesce("v", F.lit(0.0)).alias("s"), F.coalesce("g", F.lit(0)).alias("gaps"))
    state = write_round(first.withColumn("done", F.col("ptr").isNull()), "done")
    finals, nodes, steps = [state.where("done").select("id", "s", "gaps")], state.count(), 1
    active = state.where("NOT done").select("id", "ptr", "s", "gaps")
    while not active.isEmpty():
        _no_cycle(active, steps, nodes)
        ahead = active.select(F.col("id").alias("ptr"), F.col("ptr").alias("nptr"), F.col("s").alias("_s"), F.col("gaps").alias("_g"))
        for part in finals:
            ahead = ahead.unionByName(part.select(F.col("id").alias("ptr"), F.lit(None).cast("bigint").alias("nptr"), F.col("s").alias("_s"), F.col("gaps").alias("_g")))
        moved = active.join(ahead, "ptr").select("id", F.col("nptr").alias("ptr"), (F.col("s") + F.col("_s")).alias("s"), (F.col("gaps") + F.col("_g")).alias("gaps"))
        held = write_round(moved.withColumn("done", F.col("ptr").isNull()), "done")
        finals.append(held.where("done").select("id", "s", "gaps"))
        active, steps = held.where("NOT done").select("id", "ptr", "s", "gaps"), 2 * steps
    every = finals[0]
    for part in finals[1:]:
        every = every.unionByName(part)
    for leaves in reversed(layers):
        below = every.select(F.col("id").alias("ptr"), "s", "gaps").join(own, "ptr").select("ptr", (F.col("s") + F.col("v")).alias("s"), (F.col("gaps") + F.col("g")).alias("gaps"))
        mine = leaves.join(below, "ptr", "left").select("id", F.coalesce("s", F.lit(0.0)).alias("s"), F.coalesce("gaps", F.lit(0)).alias("gaps"))
        every = every.unionByName(mine)
    return every.select("id", F.when(F.col("gaps") == 0, F.col("s")).alias(output))


# fixed values: direction codes and their steps (rows, columns)
STEPS = {1: (0, 1), 2: (1, 1), 4: (1, 0), 8: (1, -1), 16: (0, -1), 32: (-1, -1), 64: (-1, 0), 128: (-1, 1)}


def downstream_cell(direction: Column, row: Column, col: Column, rows: int, cols: int, wrap_x: bool, wrap_y: bool) -> tuple[Column, Column]:
    """(row, column) a cell drains to, NULL for sinks.

    Leaving over a pole keeps the row and mirrors the column; leaving east or west comes in at the
    other side; both only where the grid wraps that way.
    """
    dr = F.when(direction.isNull(), None)
    dc = F.when(direction.isNull(), None)
    for code, (i, j) in STEPS.items():
        dr, dc = dr.when(direction == code, i), dc.when(direction == code, j)
    to_row = row + dr
    over = (to_row < 0) | (to_row >= rows)
    from_col = F.when(over, cols - 1 - col).otherwise(col)
    to_col = from_col + dc
    around = (to_col < 0) | (to_col >= cols)
    flows = dr.isNotNull()
    if not wrap_y:
        flows = flows & ~over
    if not wrap_x:
        flows = flows & ~around
    return F.when(flows, F.when(over, row).otherwise(to_row)), F.when(flows, F.pmod(to_col, F.lit(cols)))


def grid_dims(df: DataFrame) -> tuple[int, int]:
    rows, cols = df.agg(F.max("row_no") + 1, F.max("col_no") + 1).first()
    return rows, cols


def d8_to_network(dirs: DataFrame, rows: int, cols: int, wrap_x: bool = False, wrap_y: bool = False, direction: str = "d8") -> DataFrame:
    """Adds ``id`` (1-based cell number) and ``downstream_id`` (0 for sinks)."""
    r, c = downstream_cell(F.col(direction), F.col("row_no"), F.col("col_no"), rows, cols, wrap_x, wrap_y)
    number = F.col("row_no").cast("bigint") * cols + F.col("col_no") + 1
    target = r.cast("bigint") * cols + c + 1
    return dirs.withColumns({"id": number, "downstream_id": F.coalesce(target, F.lit(0)).cast("bigint")})


def inward_directions(network: DataFrame, direction: str = "d8") -> DataFrame:
    """Sum of the direction codes pointing into each cell, 0 where none does; takes :func:`d8_to_network`."""
    into = (network.where(F.col("downstream_id") > 0).groupBy(F.col("downstream_id").alias("id"))
            .agg(F.sum(direction).cast("int").alias("_in")))
    return network.select("id", "row_no", "col_no").join(into, "id", "left").select(
        "id", "row_no", "col_no", F.coalesce("_in", F.lit(0)).alias("inward"))


def aggregate_flows(network: DataFrame, cols: int, factor: int, flow: str) -> DataFrame:
    """Sum per block of the flows that leave it, missing where there is none."""
    target_row, target_col = F.floor((F.col("downstream_id") - 1) / cols), (F.col("downstream_id") - 1) % cols
    block = [F.floor(F.col(c) / factor).cast("int") for c in ("row_no", "col_no")]
    stays = (F.col("downstream_id") > 0) & (F.floor(target_row / factor) == block[0]) & (F.floor(target_col / factor) == block[1])
    return network.groupBy(block[0].alias("row_no"), block[1].alias("col_no")).agg(F.sum(F.when(~stays, F.col(flow))).alias(flow))


def accumulate_grid(dirs: DataFrame, flows: DataFrame, rows: int, cols: int, factor: int = 1, wrap_x: bool = False,
                    wrap_y: bool = False, flow: str = "value", direction: str = "d8") -> DataFrame:
    """Accumulated flow per cell of the flow grid.

    A missing source counts as 0 downstream, and a missing cell with inflow becomes its inflow. The
    direction grid may be ``factor`` times finer: amounts are then split evenly, and of each block
    only what leaves it counts.
    """
    amounts = flows.select("row_no", "col_no", flow)
    if factor > 1:
        amounts = disaggregate(amounts, factor, [flow])
    net = d8_to_network(dirs.select("row_no", "col_no", direction), rows, cols, wrap_x, wrap_y, direction)
    net = cut_lineage(net.join(amounts, ["row_no", "col_no"], "left"))
    own = F.col(flow).cast("double")
    sums = _upstream_sums(_links(net), net.select("id", F.coalesce(own, F.lit(0.0)).alias("s")), [], ["s"])
    fed = net.where(F.col("downstream_id") > 0).select(F.col("downstream_id").alias("id")).distinct().withColumn("_fed", F.lit(True))
    out = (net.join(sums, "id").join(fed, "id", "left")
           .withColumn(flow, F.when(own.isNotNull() | F.col("_fed"), F.col("s"))).drop("s", "_fed"))
    if factor > 1:
        return aggregate_flows(out, cols, factor, flow)
    return out.select("row_no", "col_no", flow)


def basin_results(values: DataFrame, coverage: DataFrame, network: DataFrame, runoff: str, by: list[str] | None = None) -> DataFrame:
    """Runoff summed per basin, and accumulated along the network: one value per basin, or per basin and ``by`` (months, members)."""
    local = cut_lineage(zonal_stats(values, coverage, [runoff], by, ("sum",)).withColumnRenamed(f"{runoff}_sum", runoff).withColumnRenamed("zone_id", "id"))
    flows = local if by else network.select("id").join(local, "id", "left")
    return accumulate(network.select("id", "downstream_id"), runoff, f"Bt_{runoff}", flows, by).join(local, ["id", *(by or [])], "left")

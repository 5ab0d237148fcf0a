"""Exact top-k search by inner product: three phases with a uniform threshold over slices of the dimensions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillmark.llm.common import fields, stored

#: Rows of a block of candidates and of queries; bytes of query blocks that one wave broadcasts; slices of the dimensions.
BLOCK, QUERY_BLOCK, WAVE_BYTES, SLICES = 4096, 1024, 32 << 20, 2
SCALE = 256


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) for each component. Vectors that are missing or hold a missing or non-finite component are left out,
    and rows without vec_id; rows of one vec_id are one vector (the smallest)."""
    rows = fields(vectors, "vec_id", "embedding").withColumn("embedding", F.col("embedding").cast("array<double>"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter("vec_id is not null and embedding is not null").filter(~bad)
    rows = rows.select("vec_id", F.transform("embedding", lambda x: F.floor(x * scale)).alias("v"))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(vectors: Iterable, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right.T in integers: by floating point where that is exact, else in 64 bits, else in Python's integers."""
    most = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * left.shape[1]
    if most < 2**53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left @ right.T if most < 2**62 else left.astype(object) @ right.astype(object).T


def _packed(rows: DataFrame, size: int, block: str) -> DataFrame:
    """Blocks of about ``size`` rows: (block, ids, lens, data), the vectors end to end."""
    blocks = max(1, -(-rows.count() // size))
    dealt = rows.withColumn(block, F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    wide = "tau" in rows.columns

    def pack(key, part):
        part = part.sort_values("vec_id")
        out = {block: [key[0]], "ids": [part.vec_id.to_numpy(np.int64).tobytes()], "lens": [np.array([len(v) for v in part.v], np.int32).tobytes()],
               "data": [np.concatenate([np.asarray(v, np.int64) for v in part.v]).tobytes()]}
        if wide:
            out["taus"] = [part.tau.to_numpy(np.float64).tobytes()]
        return pd.DataFrame(out)

    return dealt.groupBy(block).applyInPandas(pack, f"{block} long, ids binary, lens binary, data binary" + ", taus binary" * wide)


def _unpack(ids: bytes, lens: bytes, data: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    n, flat = np.frombuffer(lens, np.int32), np.frombuffer(data, np.int64)
    ends = np.cumsum(n)
    return np.frombuffer(ids, np.int64), _matrix([flat[e - k : e] for e, k in zip(ends, n)], width)


class _Best:
    """The k best of each query seen so far: higher scores first, then smaller ids."""

    def __init__(self, k: int):
        self.k, self.held = k, {}

    def offer(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if query in self.held:
            old_scores, old_ids = self.held[query]
            scores, ids = np.concatenate([old_scores, scores]), np.concatenate([old_ids, ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.held[query] = scores[order], ids[order]

    def frame(self) -> pd.DataFrame:
        rows = [(q, int(i), int(s)) for q, (scores, ids) in self.held.items() for s, i in zip(scores, ids)]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype("int64")


def _phase(k: int, slices: int):
    """Phase 1 (without cutoffs) or 2 and 3 (with) over the pairs of blocks that a task has."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = _Best(k)
        for frame in frames:
            for r in frame.itertuples(index=False):
                width = max(np.frombuffer(r.lens, np.int32).max(initial=0), np.frombuffer(r.q_lens, np.int32).max(initial=0), 1)
                ids, x = _unpack(r.ids, r.lens, r.data, width)
                queries, q = _unpack(r.q_ids, r.q_lens, r.q_data, width)
                parts = [_exact(q[:, s], x[:, s]) for s in (slice(i * width // slices, (i + 1) * width // slices) for i in range(slices))]
                total = sum(parts)
                taus = np.frombuffer(r.taus, np.float64) if hasattr(r, "taus") else None
                for row, query in enumerate(queries):
                    other = ids != query
                    if taus is None:  # each slice's local list
                        chosen = set()
                        for part in parts:
                            local = np.where(other, part[row], part[row].min() - 1)
                            chosen.update(np.argpartition(-local, min(k, len(local)) - 1)[:k].tolist())
                        at = np.array([i for i in sorted(chosen) if other[i]], np.int64)
                    else:  # entries that reach the cutoff in a slice; their whole scores decide
                        enough = np.logical_or.reduce([slices * part[row] >= taus[row] for part in parts])
                        at = np.flatnonzero(enough & other)
                        at = at[total[row, at] >= taus[row]]
                    if len(at):
                        best.offer(int(query), total[row, at], ids[at])
        if best.held:
            yield best.frame()

    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, slices: int = SLICES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``vectors`` (vec_id, v) of highest inner product with each of ``queries``.

    A query's own vec_id is no candidate; ties go to the smaller vec_id; shorter vectors count as filled with zeros. Queries come in waves of
    blocks of bounded size, which are broadcast; candidates stay where they are, in blocks. Phase 1 takes the k best of each block by each
    slice of the dimensions, with their whole scores: the k-th best of those, tau, is a safe cutoff. A row of score tau or more must reach
    tau / slices in some slice, so phase 2 collects those entries alone, and phase 3 scores them in full. Tables without rows give none.
    """
    blocks = stored(_packed(vectors, BLOCK, "block"))
    queries = stored(queries)
    count = queries.count()
    widest = vectors.agg(F.max(F.size("v"))).first()[0] or 1
    waves = max(1, -(-count * widest * 8 // WAVE_BYTES))
    parts, schema = [], "query_id long, vec_id long, score long"
    for wave in range(waves):
        own = queries if waves == 1 else queries.filter(F.pmod(F.xxhash64(F.lit(7), "vec_id"), F.lit(waves)) == wave)
        found = _pairs(blocks, _packed(own, QUERY_BLOCK, "q_block")).mapInPandas(_phase(k, slices), schema)
        by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        tau = found.withColumn("n", F.row_number().over(by)).filter(F.col("n") <= k).groupBy("query_id").agg(F.min("score").alias("tau"), F.count(F.lit(1)).alias("n"))
        cut = own.join(tau, own.vec_id == tau.query_id, "left").select("vec_id", "v", F.when(F.col("n") == k, F.col("tau").cast("double")).otherwise(float("-inf")).alias("tau"))
        parts.append(stored(_pairs(blocks, _packed(stored(cut), QUERY_BLOCK, "q_block")).mapInPandas(_phase(k, slices), schema)))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return every.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _pairs(blocks: DataFrame, query_blocks: DataFrame) -> DataFrame:
    """Every block of candidates with every block of queries of the wave (WAVE_BYTES at most, so it is broadcast)."""
    stored_queries = stored(query_blocks)
    n = stored_queries.agg(F.max("q_block")).first()[0]
    names = [F.col(c).alias(c if c in ("q_block", "taus") else f"q_{c}") for c in stored_queries.columns]
    numbers = F.sequence(F.lit(0).cast("long"), F.lit(n if n is not None else 0).cast("long"))
    return blocks.withColumn("q_block", F.explode(numbers)).join(F.broadcast(stored_queries.select(*names)), "q_block")

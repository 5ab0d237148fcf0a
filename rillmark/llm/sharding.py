"""Longest-processing-time sharding: groups that stay together, by size, each to the least-loaded shard."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import fields, hex_spread, running, stored, text_key

#: Groups of at least this part of a shard are placed one by one; there are at most shards * FINE of them, whatever the table.
FINE = 1024
#: All smaller groups are placed in so many bundles, drawn by hash.
BUNDLES = 8192


def longest_first(sizes: list[tuple[int, int]], shards: int) -> dict[int, int]:
    """item -> shard: items (item, size) from the largest down, each to the shard with the least so far (ties: smaller numbers)."""
    loads = [(0, shard) for shard in range(shards)]
    placed = {}
    for item, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(loads)
        placed[item] = shard
        heapq.heappush(loads, (load + size, shard))
    return placed


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Put documents (doc_id, text) into shards of nearly equal bytes; equal texts stay together (law ``bytes``).

    Returns doc_id, size (UTF-8 bytes + 1), text_crc32, shard, slot (gapless from 0 within the shard). A group of equal texts that weighs at
    least 1/FINE of a shard is an item of its own; the others are items in bundles by their hash. So the driver's heap gets at most
    shards * FINE + BUNDLES numbers however many documents there are. Missing texts are one group of size 1 each and CRC 0, apart from
    empty ones; repeated rows are documents of their own; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = fields(docs, "doc_id", "text").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"), text_key("text").alias("k"))
    rows = stored(rows)
    groups = rows.groupBy("k").agg(F.sum("size").alias("weight"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    large = F.col("weight") * (shards * FINE) >= F.lit(total)
    items = stored(groups.select("k", "weight", large.alias("large"), F.pmod("k.h1", F.lit(BUNDLES)).alias("bundle")))
    big = [((r.k.h1, r.k.h2, r.k.n), r.weight) for r in items.filter("large").select("k", "weight").collect()]
    small = [(r.bundle, r.weight) for r in items.filter("not large").groupBy("bundle").agg(F.sum("weight").alias("weight")).collect()]
    big.sort(key=lambda x: (-x[1], x[0]))
    placed = longest_first([(-1 - i, w) for i, (_, w) in enumerate(big)] + small, shards)
    alone = spark.createDataFrame([(*k, placed[-1 - i]) for i, (k, _) in enumerate(big)], "h1 long, h2 long, n int, own int")
    bundles = spark.createDataFrame([(b, placed[b]) for b, _ in small], "bundle long, common int")
    # both have a proven bound: shards * FINE and BUNDLES rows
    put = rows.select("*", "k.h1", "k.h2", "k.n", F.pmod("k.h1", F.lit(BUNDLES)).alias("bundle"))
    put = put.join(F.broadcast(alone), ["h1", "h2", "n"], "left").join(F.broadcast(bundles), "bundle", "left")
    put = put.withColumn("shard", F.coalesce("own", "common")).withColumn("_md5", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    put = put.select("doc_id", "size", "text_crc32", "shard", "_md5", hex_spread(F.col("_md5")).alias("_spread"))
    return running(put, "shard", ["_md5", "size", "text_crc32"], "_spread", None, "slot").drop("_md5", "_spread")

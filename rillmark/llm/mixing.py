"""Mixing sources to target weights by a low-discrepancy schedule of equal-word blocks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillmark.llm.common import fields, hex_spread, running, set_aside, stored, word_count

#: Weights of the sources by code point, missing last, and how often a source may be repeated (fixed values of the contract).
WEIGHTS = (5, 2, 1)
REPEATS = 3
#: The golden ratio's fraction of 2^31, odd: n * GOLDEN mod 2^31 visits every point once and stays evenly spread.
GOLDEN, POINTS = 1327217885, 2**31
#: The schedule has about 2^BLOCK_BITS blocks, of at most MAX_BLOCK words.
BLOCK_BITS, MAX_BLOCK = 18, 4096
#: Schedule slots ranked by one task; cells of the point axis by which slots find their source.
CHUNK, CELLS = 16384, 4096


@dataclass
class Mix:
    """``sources``: source, source_no, source_size, target. ``slots``: slot, source_no, block. ``rows``: the documents with what the mix takes."""

    sources: DataFrame
    slots: DataFrame
    rows: DataFrame


def targets(sources: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Add ``source_no``, ``target`` and its span of the point axis to (source, source_size): one row per source.

    All sizes together are shared by weight; a target stops at ``repeats`` times its source's size and the rest is shared among the others
    again. With sources by (limit / weight), the first one whose share of what is left fits its limit fixes the common level.
    The windows without key see one row per distinct source, never documents.
    """
    w = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = sources.withColumn("source_no", (F.row_number().over(w) - 1).cast("long"))
    df = df.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights) + 1).cast("int")).cast("double"))
    df = df.withColumn("_limit", F.col("source_size") * float(repeats)).withColumn("_ratio", F.col("_limit") / F.col("_w"))
    by = Window.orderBy("_ratio", "source_no")
    df = df.withColumns({
        "_pos": F.row_number().over(by),
        "_all": F.sum("source_size").over(every),
        "_full": F.coalesce(F.sum("_limit").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "_rest": F.sum("_w").over(by.rowsBetween(0, Window.unboundedFollowing)),
    })
    df = df.withColumn("_level", (F.col("_all") - F.col("_full")) / F.col("_rest"))
    first = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_pos", "_level"))).over(every)
    df = df.withColumn("_first", first)
    df = df.withColumn("target", F.when(F.col("_pos") < F.col("_first._pos"), F.col("_limit")).otherwise(F.col("_first._level") * F.col("_w")))
    upto = F.sum("target").over(Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0))
    share = F.when(F.col("_all") > 0, F.least(F.lit(1.0), upto / F.col("_all"))).otherwise(0.0)
    df = df.withColumn("hi", F.floor(share * POINTS))
    df = df.withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("source_no")), F.lit(0)))
    return df.select("source", "source_no", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"), "lo", "hi")


def _schedule(sources: DataFrame, points: int, block: int) -> DataFrame:
    """(slot, source_no, block): the slot's rank within its source is the number of the block it takes.

    Slots find their source through cells of the point axis and equality; ranks come from counts of chunks of slots and their running
    sums. Points that fall to a source whose target is met are void; blocks which the points leave over (the discrepancy grows with the
    logarithm of the number of points) follow at the end.
    """
    spark = sources.sparkSession
    width = POINTS // CELLS
    spans = sources.filter("hi > lo").select("source_no", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))).alias("cell"))
    slots = spark.range(points).withColumnRenamed("id", "slot")
    slots = slots.withColumn("_p", (F.col("slot") % POINTS) * GOLDEN % POINTS).withColumn("cell", F.floor(F.col("_p") / width))
    slots = slots.join(spans, "cell").filter("_p >= lo and _p < hi").select("slot", "source_no", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    counts = slots.groupBy("source_no", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("source_no", "chunk", F.coalesce(before, F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("source_no", "chunk").orderBy("slot")) - 1
    ranked = slots.withColumn("_n", within).join(starts, ["source_no", "chunk"]).select("slot", "source_no", (F.col("start") + F.col("_n")).alias("block"))
    need = sources.select("source_no", F.ceil(F.floor("target") / block).alias("need"))
    taken = ranked.join(need, "source_no").filter("block < need").select("slot", "source_no", "block")
    have = counts.groupBy("source_no").agg(F.sum("n").alias("have"))
    late = need.join(have, "source_no", "left").withColumn("have", F.coalesce("have", F.lit(0))).filter("need > have")
    late = late.select("source_no", F.explode(F.sequence("have", F.col("need") - 1)).alias("block"))
    return taken.unionByName(late.select((F.lit(points) + F.col("block")).alias("slot"), "source_no", "block"))


def mix(docs: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> Mix:
    """Mix documents (doc_id, text, source) to target weights.

    Every source is a stream of words: its documents in shuffled order (by MD5 of the id), again from the start when it ends, at most
    ``repeats`` times, cut into blocks of equal words. Slot n of the schedule goes to the source in whose span of cumulative weights the
    point n * golden ratio mod 1 lies, and takes that source's next block; the last block stops at the target (rounded down). ``rows`` has
    doc_id, source, size, source_size, target, taken (words taken, repeats counted) and text_hash for every document.

    A missing text has no words; a missing source is a source of its own, last; a missing id is shuffled as an empty one. Documents without
    words take part with taken 0. Repeated rows are documents of their own. Without words or rows all targets are 0. Reruns agree.
    """
    rows = fields(docs, "doc_id", "text", "source", source="string")
    rows = stored(rows.select("doc_id", "source", word_count("text").alias("size"), F.xxhash64("text").alias("text_hash")))
    sources = stored(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, repeats))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    block = max(1, min(MAX_BLOCK, total >> BLOCK_BITS))
    points = -(-total // block)

    named = rows.join(sources.select(F.col("source").alias("_source"), "source_no", "source_size", "target"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    streams = named.filter("size > 0").withColumn("_md5", digest).withColumn("_spread", hex_spread(F.col("_md5")))
    streams = stored(running(streams, "source_no", ["_md5", "size", "text_hash"], "_spread", "size", "start").drop("_md5", "_spread"))

    slots = _schedule(sources, points, block)
    limit = F.floor("target").cast("long")
    passes = streams.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    passes = passes.withColumn("from", F.col("pass") * F.col("source_size") + F.col("start")).withColumn("to", F.least(F.col("from") + F.col("size"), limit)).filter("from < to")
    pieces = passes.select("source_no", "start", "from", "to", F.explode(F.sequence(F.floor(F.col("from") / block), F.floor((F.col("to") - 1) / block))).alias("block"))
    words = F.least("to", (F.col("block") + 1) * block) - F.greatest("from", F.col("block") * block)
    used = pieces.join(slots.select("source_no", "block"), ["source_no", "block"]).groupBy("source_no", "start").agg(F.sum(words).alias("taken"))
    full = streams.join(used, ["source_no", "start"], "left")
    columns = ["doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "text_hash"]
    empty = named.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return Mix(sources, slots, full.select(*columns).unionByName(empty.select(*columns)))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """The mix as documents: a copy for each time a document is taken whole, and its first words where the target ends within it.

    Rows equal in id, source and text count together. ``n_chars`` becomes the length of the text that is returned.
    """
    rows, own = set_aside(docs, "doc_id", "text", "source", "n_chars")
    taken = mix(docs, weights, repeats).rows.groupBy("doc_id", "source", "text_hash").agg(F.max("size").alias("size"), F.sum("taken").alias("taken")).filter("taken > 0")
    taken = taken.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), "text_hash", "size", "taken")
    rows = rows.withColumn("_hash", F.xxhash64("text")).dropDuplicates(["doc_id", "source", "_hash"])
    joined = rows.join(taken, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("_hash") == F.col("text_hash")))
    last = F.floor((F.col("taken") - 1) / F.col("size"))
    copies = joined.withColumn("_left", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), last), lambda i: F.col("taken") - i * F.col("size"))))
    head = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), F.lit(1), F.col("_left").cast("int")), "")
    copies = copies.withColumn("text", F.when(F.col("_left") < F.col("size"), head).otherwise(F.col("text")))
    return copies.withColumn("n_chars", F.length("text").cast("long")).select(*own)

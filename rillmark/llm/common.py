"""Helpers of the training-data operators: input columns, stored tables, running positions that no hot key can hold up."""

from __future__ import annotations

import functools
import gc
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillmark.session import scratch_path

#: The white space that separates words, and what is not in it (fixed values of the contracts).
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that one task numbers or sums at a time; a larger key is cut into as many ranges as it needs.
RANGE_ROWS = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fields(df: DataFrame, *names: str, **types: str) -> DataFrame:
    """Only the named columns, also where others differ from them by case alone; ``types`` casts some."""
    places = [next(i for i, c in enumerate(df.columns) if c == name) for name in names]
    plain = df.toDF(*(f"_c{i}" for i in range(len(df.columns))))
    return plain.select(*((F.col(f"_c{i}").cast(types[n]) if n in types else F.col(f"_c{i}")).alias(n) for i, n in zip(places, names)))


def set_aside(df: DataFrame, *core: str) -> tuple[DataFrame, list[Column]]:
    """``df`` with all other columns renamed out of the way, and the columns that give it its own names back."""
    names = [c if c in core else f"_x{i}" for i, c in enumerate(df.columns)]
    return df.toDF(*names), [F.col(n).alias(c) for n, c in zip(names, df.columns)]


def stored(df: DataFrame, *by: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later steps neither recompute it nor lose it with an executor."""
    path = f"{scratch_path(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete what ``stored`` wrote for these tables. What was made of them must have been written itself.

    Spark deletes the shuffles of finished jobs when the driver's garbage is collected; a job of many steps should not wait for that.
    """
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/table-" in folder and scratch_path(df.sparkSession).rsplit("/", 1)[-1] in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)
    gc.collect()
    tables[0].sparkSession._jvm.java.lang.System.gc()


#: What operators remember in a Python worker from task to task, by the module that does.
_MEMORIES: dict[str, list] = {}


def remembered(fn: Callable) -> Callable:
    """``fn`` with its last four results kept from task to task, until a task of another operator begins in the same worker."""
    kept = functools.lru_cache(maxsize=4)(fn)
    _MEMORIES.setdefault(fn.__module__, []).append(kept)
    return kept


def begin_task(module: str) -> None:
    """Free what other operators than ``module`` remember in this Python worker, and what Arrow holds of earlier batches: workers outlive the
    stage they were started for."""
    others = [kept for name, all_kept in _MEMORIES.items() if name != module for kept in all_kept if kept.cache_info().currsize]
    for kept in others:
        kept.cache_clear()
    if others:
        gc.collect()
    pa.default_memory_pool().release_unused()


def plain(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def text_key(text: Column | str) -> Column:
    """128 bits that stand for a text, so that grouping equal texts does not shuffle them; missing is a value of its own."""
    text = F.col(text) if isinstance(text, str) else text
    return F.struct(F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"), F.coalesce(F.octet_length(text), F.lit(-1)).alias("n"))


def running(df: DataFrame, key: str, order: list[str], spread: str, value: str | None, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` (None: the number of rows) over the earlier rows of the same key.

    ``spread`` names a column with numbers from 0 to 2^32 - 1, evenly distributed and not falling as the rows follow each other; ``order``
    breaks its ties. A key is cut into ranges of about RANGE_ROWS rows by it, which are summed first and then run through one by one,
    so the largest key takes many tasks. ``df`` is read three times.
    """
    amount = F.col(value) if value else F.lit(1)
    counts = df.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / RANGE_ROWS).alias("_ranges"))
    cut = df.join(counts.withColumnRenamed(key, "_key"), F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
    cut = cut.withColumn("_range", F.floor(F.col(spread) * F.col("_ranges") / F.lit(float(2**32)))).drop("_ranges")
    sums = cut.groupBy(F.col(key).alias("_key"), F.col("_range").alias("_r")).agg(F.sum(amount).alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy("_key").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select("_key", "_r", F.coalesce(before, F.lit(0)).alias("_start"))
    within = F.sum(amount).over(Window.partitionBy(key, "_range").orderBy(spread, *order).rowsBetween(Window.unboundedPreceding, -1))
    placed = cut.withColumn("_within", F.coalesce(within, F.lit(0)))
    joined = placed.join(starts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_r")))
    return joined.withColumn(out, (F.col("_start") + F.col("_within")).cast("long")).drop("_key", "_r", "_start", "_within", "_range")


def hex_spread(hexed: Column) -> Column:
    """The first 32 bits of a hexadecimal digest as a number."""
    return F.conv(F.substring(hexed, 1, 8), 16, 10).cast("long")

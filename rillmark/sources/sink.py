"""Writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_provenance(df: DataFrame, yearmon: int, target: int | None = None, window: int | None = None, model: str | None = None,
                    member: str | None = None) -> DataFrame:
    """Issue month, target (the issue month when not given), window, model and member as columns."""
    lit = {"yearmon": (yearmon, "int"), "target": (target or yearmon, "int"), "window": (window, "int"),
           "model": (model, "string"), "member": (member, "string")}
    return df.withColumns({c: F.lit(v).cast(t) for c, (v, t) in lit.items()})


def sink(df: DataFrame, path: str, partition_by: list[str], mode: str = "slice", files_per_partition: int | None = None) -> None:
    """``create`` refuses an existing table, ``append`` adds rows, ``slice`` replaces only the partitions in ``df``.

    Rows of a partition are brought together first, spread over a few writers so that a large partition
    (one month may be most of the table) is not written by one task. The writer follows from the row's values, so a task
    that runs again sends its rows to the same places.
    """
    if files_per_partition:
        df = df.repartition(*partition_by, F.pmod(F.xxhash64(*df.columns), F.lit(files_per_partition)))
    writer = df.write.partitionBy(*partition_by)
    if mode == "create":
        writer.mode("errorifexists").parquet(path)
    elif mode == "append":
        writer.mode("append").parquet(path)
    elif mode == "slice":
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        raise ValueError(f"unknown mode: {mode}")


def append_variables(existing: DataFrame, new: DataFrame, keys: list[str], path: str, partition_by: list[str]) -> None:
    """A table with further variables; written to a new place, since Spark cannot overwrite what it reads."""
    from ..operators.joins import merge_datasets

    sink(merge_datasets([existing, new], keys), path, partition_by, "create")


def sink_csv(df: DataFrame, path: str, order: list[str]) -> None:
    """Summaries as CSV with a header, in order across the part files."""
    df.orderBy(*order).write.mode("overwrite").csv(path, header=True)


def bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """A copy bucketed and sorted by cell: fits and rolling windows then read it without a shuffle."""
    df.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(table)

"""User functions of the values of one cell, for what the built-in statistics cannot say.

A function sees all values of its key at once, so one key must fit a task.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _schema(df: DataFrame, keys: list[str], output: str) -> str:
    kinds = dict(df.dtypes)
    return ", ".join([f"`{k}` {kinds[k]}" for k in keys] + [output])


def cell_apply(df: DataFrame, keys: list[str], value: str, order: str, fn: Callable, output: str) -> DataFrame:
    """``fn(values)`` per key, values as a numpy array in the order of ``order`` (missing as NaN).

    ``fn`` gives a number for an output like ``"spread DOUBLE"``, or a list for ``"smooth ARRAY<DOUBLE>"``.
    """
    name = output.split()[0]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        values = pdf.sort_values(order)[value].to_numpy(float)
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in keys}, name: [fn(values)]})

    return df.select(*keys, order, value).groupBy(*keys).applyInPandas(run, _schema(df, keys, output))


def cell_apply_with_parameters(df: DataFrame, parameters: DataFrame, keys: list[str], value: str, order: str, fn: Callable, output: str) -> DataFrame:
    """``fn(values, parameters)`` per key, where ``parameters`` has at most one row per key (given as a dict, empty when absent)."""
    name = output.split()[0]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty:
            return pd.DataFrame({**{k: [] for k in keys}, name: []})
        given = right.drop(columns=keys).iloc[0].to_dict() if len(right) else {}
        values = left.sort_values(order)[value].to_numpy(float)
        return pd.DataFrame({**{k: [left[k].iloc[0]] for k in keys}, name: [fn(values, given)]})

    grouped = df.select(*keys, order, value).groupBy(*keys)
    return grouped.cogroup(parameters.groupBy(*keys)).applyInPandas(run, _schema(df, keys, output))

"""The registered queries against DuckDB on the smallest tables."""

import re

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from check_oracles import normal
from rillmark.lenses import TABLES

SAMPLE = ["flagship_composite", "a4_quantiles_of_raw_lines", "a10_weighted_quantile", "w2_rolling_integrate_many", "d3_fit_guards",
          "z3_zonal_class_fractions", "n1_accumulate", "e9_summarize_losses", "g9_cumulative_crop_loss", "j10_best_of_versions"]


def test_every_query_with_sql_is_registered():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries)
    weak = set(queries) - set(oracles)
    assert {n for n in weak if not re.match(r"op\d+_|pipeline$", n)} == {"g17_score_yield"}


def test_entry(spark):
    df = entry.entry(spark)
    assert set(df.columns) == {"cell_id", "month_index", "surplus", "deficit", "both"} and not df.isEmpty()


@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = entry.queries()[name](spark, sf_dir)
    rows = pd.DataFrame([r.asDict() for r in got.collect()], columns=got.columns, dtype=object)
    cur = con.execute(entry.oracle_sql()[name])
    want = pd.DataFrame(cur.fetchall(), columns=[d[0] for d in cur.description], dtype=object)
    assert sorted(rows.columns) == sorted(want.columns)
    assert normal(rows) == normal(want)

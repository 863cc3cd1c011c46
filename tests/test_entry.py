"""Driver contract: entry() runs; every registered query runs at sf0.001; a sample of the
SQL twins agrees with DuckDB there."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from corpusforge.plans.catalog import QUERIES
from corpusforge.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
CHECKED = ["process_documents", "clean_text", "dedup_keep_first", "split_stratified", "agg_mean",
           "calib_isotonic_apply", "triage_issues", "pair_shift", "plan_rows", "validate_rows",
           "mix_real", "ensemble_vote", "calib_isotonic_fit", "pair_queue", "process_rows"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["split", "lang", "n", "emoji_micro"]
    assert df.count() >= 0


def test_every_query_has_a_callable_and_runs(spark):
    qs = E.queries()
    assert set(E.oracle_sql()) <= set(qs)
    for name in QUERIES:             # the optional subpackage's queries have tests of their own
        qs[name](spark, SF).limit(1).collect()


def _norm(v):
    if isinstance(v, float):
        return f"{round(v, 9):.9f}" if not math.isnan(v) else "nan"
    return None if v is None else str(v)


@pytest.mark.parametrize("name", CHECKED)
def test_oracle_agrees(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    order = sorted(cols)
    a = sorted(tuple(_norm(r[c]) for c in order) for r in df.collect())
    b = sorted(tuple(_norm(dict(zip(cols, r))[c]) for c in order) for r in res.fetchall())
    assert a == b

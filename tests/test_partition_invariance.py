"""Same answers for 1, 4 and 17 shuffle partitions (results never depend on partitioning)."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
NAMES = ["split_stratified", "split_random", "pair_shift", "agg_array_union", "ensemble_median",
         "triage_issues", "dedup_keep_first", "calib_isotonic_apply"]


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


@pytest.mark.parametrize("name", NAMES)
def test_partition_invariance(spark, name):
    q = E.queries()[name]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in ("1", "4", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(_rows(q(spark, SF)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] == results[2]

import random

import pytest

from corpusforge.llm.common import connected_components, discard, materialise, merge_components
from tests.llm.helpers import components


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(i, i + 1) for i in range(40)], [(50, i) for i in range(20)] + [(7, 99)],
    [tuple(random.Random(3).sample(range(60), 2)) for _ in range(1)] + [(random.Random(i).randrange(60), random.Random(i + 99).randrange(60)) for i in range(45)],
])
def test_components(spark, links):
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == components(nodes, [x for x in links if x[0] != x[1]])


def test_component_nodes_may_be_structs(spark):
    df = spark.sql("select struct('b' as x, 1 as y) as a, struct('a' as x, 9 as y) as b")
    assert {r["component"]["x"] for r in connected_components(df).collect()} == {"a"}


def test_tables_can_be_discarded(spark):
    df = materialise(spark.range(5))
    assert df.count() == 5
    discard(df)
    discard(spark.range(1))          # not ours: nothing happens
    with pytest.raises(Exception):
        spark.read.parquet(df._llm_path)


def test_merged_components(spark):
    first, more = [(1, 2), (2, 3), (10, 11)], [(3, 11), (2, 10), (20, 21), (20, 1), (30, 31), (1, 3)]
    comp = connected_components(spark.createDataFrame(first, "a bigint, b bigint"))
    got = {r["node"]: r["component"] for r in merge_components(comp, spark.createDataFrame(more, "a bigint, b bigint")).collect()}
    assert got == components({n for x in first + more for n in x}, first + more)
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert {r["node"]: r["component"] for r in merge_components(comp, none).collect()} == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10}


def test_pivot_rounds_name_the_places_of_open_keys_only(spark, monkeypatch):
    """Keys of one component leave, merged components take their new name, lone nodes too."""
    from corpusforge.llm import common
    from pyspark.sql import functions as F
    monkeypatch.setattr(common, "PAIRS_A_PLACE", 0)
    group = lambda n: n // 10  # noqa: E731  nodes link when they are of one ten
    place = [(k, n) for k, nodes in {1: (1, 2, 3), 2: (11, 12, 21, 22), 3: (1, 11, 31, 32, 33), 4: (31, 34), 5: (3, 35, 36)}.items() for n in nodes]
    comp = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (35, 35), (36, 35)], "node bigint, component bigint")
    asked = []

    def refine(r, nodes):
        asked.append({x["node"] for x in nodes.collect()})
        return nodes.select("node", F.lit(0).alias("sub"), ((F.col("node") * (7 + 4 * r)) % 13).alias("rank"))

    def choose(met):
        return met.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")

    open_, got, tested = common.pivot_rounds(spark.createDataFrame(place, "key bigint, node bigint"), comp, refine, choose,
                                             lambda pairs: pairs.where("a div 10 = b div 10"), rounds=3)
    got = {x["node"]: x["component"] for x in got.collect()}
    assert all(got[n] <= n and group(got[n]) == group(n) for n in got) and got[3] == 1 and got[36] == got[35]
    assert asked[0] == {n for k, n in place if k > 1} and asked[-1] <= asked[0] and 34 not in asked[-1]
    left = {(x["key"], x["node"]): x["c"] for x in open_.collect()}
    assert left == {(k, n): got.get(n, n) for k, n in place if k in {x for x, _ in left}} and 1 not in {k for k, _ in left}
    for k in {k for k, _ in place}:
        named = {got.get(n, n) for x, n in place if x == k}
        assert (len(named) > 1) == (k in {x for x, _ in left})
    assert {(x["a"], x["b"]) for x in tested.where("a div 10 = b div 10").collect()}


def test_later_pivot_rounds_read_open_keys_only(spark, monkeypatch):
    """All places meet the components once, not once a round, and one row a node does so."""
    from corpusforge.llm import common
    from pyspark.sql import functions as F
    monkeypatch.setattr(common, "PAIRS_A_PLACE", -1)
    monkeypatch.setattr(common, "STALE_ROUNDS", 99)
    plans, write = [], common.materialise
    monkeypatch.setattr(common, "materialise", lambda df: plans.append(df._jdf.queryExecution().analyzed().toString()) or write(df))
    places = spark.createDataFrame([(i % 3, i) for i in range(12)], "key bigint, node bigint").withColumn("key", F.expr("key + 1000003"))
    common.pivot_rounds(places, spark.createDataFrame([(1, 0), (0, 0)], "node bigint, component bigint"),
                        lambda r, nodes: nodes.select("node", F.lit(0).alias("sub"), "node", F.lit(0).alias("rank")).select("node", "sub", "rank"),
                        lambda met: met.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), lambda pairs: pairs.where("false"), rounds=3)
    mine = [p for p in plans if "1000003" in p]
    assert len(mine) == 1 and "collect_list" in mine[0]

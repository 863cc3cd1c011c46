"""Shared helpers: session set-up, intermediate tables, row keys, connected components."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from corpusforge.session import ensure_checkpoint_dir, ship_package

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# "words" of the contracts: maximal runs of anything but ASCII white space
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Shared checkpoint folder and the package on the Python workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def _shuffle_cleanup(spark: SparkSession):
    """Drop a job's shuffle files when it ends: its result is in the shared folder by then."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` (shared by driver and executors) and
    read it again: the lineage is cut, a lost executor costs nothing already done, and the
    planner knows the table's true size."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    with _shuffle_cleanup(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._llm_path = path
    return out


def discard(df: DataFrame | None) -> None:
    """Delete a table made by :func:`materialise` that no later step reads."""
    path = getattr(df, "_llm_path", None)
    if path:
        jvm_path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(jvm_path, True)


def null_last(c: Column | str) -> list[Column]:
    """Sort keys that put NULL after every value."""
    c = F.col(c) if isinstance(c, str) else c
    return [c.isNull(), c]


def positions(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """``df`` and ``pos``: the row's place (from 0) in its group by ``order``, nulls first.

    Rows are dealt by ranges of (group, order), so one group may span many partitions; places are
    counted inside the sorted partitions and moved on by the counts of the partitions before, a
    table of at most one row a partition.  Rows equal in group and order may be cut anywhere and
    stand in any order among themselves.  The sorted table is written before it is used.
    """
    keys = [F.col(f"`{g}`").asc_nulls_first() for g in group] + list(order) + [F.col("_salt").asc()]
    dealt = df.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(
        *keys).drop("_salt")
    at = [df.columns.index(g) for g in group]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, held = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            begins = np.zeros(n, bool)
            for i in at:
                c = batch.column(i)
                same = pc.fill_null(pc.equal(c.slice(1), c.slice(0, n - 1)), False)
                both = pc.and_(c.slice(1).is_null(), c.slice(0, n - 1).is_null())
                begins[1:] |= ~pc.or_(same, both).to_numpy(zero_copy_only=False)
            first = tuple(batch.column(i)[0].as_py() for i in at)
            begins[0] = last is None or first != last
            idx = np.arange(n)
            start = np.maximum.accumulate(np.where(begins, idx, -1))
            place = np.where(start < 0, idx + held, idx - start)
            last, held = tuple(batch.column(i)[n - 1].as_py() for i in at), int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(place.astype(np.int64))],
                names=[*batch.schema.names, "_part", "_place"])

    schema = StructType([*df.schema.fields]).add("_part", IntegerType()).add("_place", LongType())
    placed = materialise(dealt.mapInArrow(run, schema))
    before = Window.partitionBy(*[F.col(f"`{g}`") for g in group]).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    counts = placed.groupBy(*[F.col(f"`{g}`") for g in group], "_part").agg(F.count("*").alias("_n"))
    moved = materialise(counts.select(*[F.col(f"`{g}`").alias(f"_g{i}") for i, g in enumerate(group)],
                                      F.col("_part").alias("_p"), F.sum("_n").over(before).alias("_before"))
                        .where("_before > 0"))                       # at most one row a partition
    on = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        on = on & F.col(f"`{g}`").eqNullSafe(F.col(f"_g{i}"))
    return placed.join(F.broadcast(moved), on, "left").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_place") + F.coalesce("_before", F.lit(0))).alias("pos"))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``: the smallest node reachable.

    Alternating large-star / small-star contraction.  Every round is two shuffled
    aggregations of linear size, its result is written to the shared folder, and nothing is
    collected.  The rounds end when the links are a forest of stars.  Nodes may be of any
    orderable type.  Raises if the rounds do not converge.
    """
    cur = materialise(edges.where("a != b").select(F.greatest("a", "b").alias("u"),
                                                   F.least("a", "b").alias("v")).distinct())
    for _ in range(max_rounds):
        if _are_stars(cur):
            centres = cur.select(F.col("v").alias("node")).distinct()
            return (cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
                    .unionByName(centres.select("node", F.col("node").alias("component"))))
        both = cur.select("u", "v").unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large-star: neighbours above u move to u's smallest neighbour
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        # small-star: u and its smaller neighbours move to the smallest of them
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.*").where("u != v").distinct())
        nxt = materialise(small)
        discard(cur)
        cur = nxt
    raise RuntimeError(f"components did not converge in {max_rounds} rounds")


def merge_components(comp: DataFrame, links: DataFrame) -> DataFrame:
    """Components of ``comp(node, component)`` and further ``links(a, b)`` together.  Only the distinct
    pairs of components that the links join are contracted, however many links there are."""
    loose = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct().join(
        comp, "node", "left_anti").select("node", F.col("node").alias("component"))
    base = materialise(comp.unionByName(loose))
    side = {x: base.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in "ab"}
    joined = links.join(side["a"], "a").join(side["b"], "b").where("ca != cb").select(
        F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct()
    up = connected_components(joined).select(F.col("node").alias("component"), F.col("component").alias("top"))
    return base.join(up, "component", "left").select("node", F.coalesce("top", "component").alias("component"))


PIVOT_ROUNDS, PAIRS_A_PLACE, STALE_ROUNDS = 4, 8, 2


def pivot_rounds(places: DataFrame, comp: DataFrame, refine: Callable[[int, DataFrame], DataFrame],
                 choose: Callable[[DataFrame], DataFrame], verify: Callable[[DataFrame], DataFrame], rounds: int = PIVOT_ROUNDS,
                 least: int = 0, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Merge components by one pivot a key and round, until few pairs are left to test.

    ``places(key, node)`` are the candidates' keys (a node has few), ``comp(node, component)`` the components so far.
    The pairs that a join of the places would make between components are counted beforehand from
    the counts of (key, component).  While there are more than ``PAIRS_A_PLACE`` a place, the nodes
    of a key are parted by ``refine``: ``(node, sub, rank)`` of round r for the given nodes, ``sub``
    being a value that similar nodes are likely to agree in.  The least ``rank`` of a part is its
    pivot (ties by a hash of round and node, so that neighbouring keys agree on theirs), and every
    node of another component is tested against one of its parts' pivots: ``choose`` reduces
    ``(a, b, w)`` (pivot, node, keys shared) to one pivot a node, ``verify`` keeps those that link.  A round is linear in the places.  The rounds end early where ``STALE_ROUNDS`` in
    succession merge less than a fiftieth of the components that are left; what then remains goes to
    the caller.

    ``least`` rounds are made however few the pairs.  ``keep``: further columns of the places.

    Returns ``(key, node, *keep, c)`` for the keys with nodes of several components, the components, and
    the pairs ``(a, b)`` tested here, or None.
    """
    tested, before, stale = None, None, 0
    for r in range(rounds + 1):
        # one row a node meets the components, with its few keys
        named = places.groupBy("node").agg(F.collect_list(F.struct("key", *keep)).alias("ks")).join(comp, "node", "left")
        cur = materialise(named.select(F.explode("ks").alias("k"), "node", F.coalesce("component", "node").alias("c"))
                          .select("k.key", "node", *[f"k.{x}" for x in keep], "c"))
        mixed = materialise(cur.groupBy("key", "c").agg(F.count("*").alias("n")).groupBy("key").agg(
            F.sum("n").alias("t"), F.sum(F.col("n").cast("double") * F.col("n")).alias("q"), F.count("*").alias("k")).where("k > 1"))
        pairs, size = mixed.agg(F.sum((F.col("t").cast("double") * F.col("t") - F.col("q")) / 2), F.sum("t")).head()
        open_ = materialise(cur.join(mixed.select("key"), "key"))
        discard(cur), discard(mixed)
        if r:
            discard(places)
        if r == rounds or not pairs or r >= least and pairs <= PAIRS_A_PLACE * size:
            return open_, comp, tested
        left = open_.agg(F.count_distinct("c")).head()[0]
        stale = stale + 1 if before is not None and left > 0.98 * before else 0
        if stale == STALE_ROUNDS:
            return open_, comp, tested
        before = left
        parts = materialise(open_.join(refine(r, open_.select("node").distinct()), "node"))
        pivot = materialise(parts.groupBy("key", "sub").agg(
            F.min(F.struct("rank", F.xxhash64(F.lit(r), "node"), "node", "c")).alias("p"), F.min("c").alias("lo"), F.max("c").alias("hi"))
            .where("lo < hi").select("key", "sub", F.col("p.node").alias("a"), F.col("p.c").alias("ca")))
        met = parts.withColumnRenamed("node", "b").join(pivot, ["key", "sub"]).where("c != ca").groupBy("a", "b").agg(
            F.count("*").alias("w"))
        chosen = materialise(choose(met).select("a", "b"))
        discard(parts), discard(pivot)
        tested = chosen if tested is None else tested.unionByName(chosen)
        comp = materialise(merge_components(comp, verify(chosen)))
        places = open_.select("key", "node", *keep)         # components only grow: a key of one component stays so
        places._llm_path = open_._llm_path


def size_part(n: Column, r: int, percent: int) -> Column:
    """Number of the range of sizes that holds ``n``: twice as wide as sizes of linked sets can differ,
    its ends moved from round to round."""
    return F.floor(F.log(n) / (2 * math.log(100 / percent)) + (r * 0.618034) % 1).cast("long")


def _are_stars(links: DataFrame) -> bool:
    """Whether every ``u`` hangs on one ``v`` that hangs on nothing itself; ``v < u`` throughout."""
    ends = links.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where(
        "up > 1 or (up = 1 and down = 1)").isEmpty()

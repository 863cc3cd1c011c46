"""Chat formatting by tool-call linking (operator 1), in DataFrame and SQL functions only.

1. Calls and results are hash-joined by (conversation, call identifier).  Of several calls with
   one identifier the first (turn, name, arguments) counts and the others are duplicates; of
   several results the first (turn, content) is linked.  Results without a call are orphans.
2. Calls are ordered topologically.  Where every dependency of a conversation points to a call
   that is earlier by (turn, call_id), that order is topological, and a join shows it.  In the
   other conversations a call's wave is one above the highest wave it depends on, found in
   rounds that place the calls whose dependencies are all placed; unknown dependencies are
   ignored, and calls on and behind a cycle have no wave and come last.  ``seq`` numbers
   a conversation's calls by (wave, turn, call_id) over a range-partitioned sort, so no
   conversation is ever gathered in one task, however long it is.
3. Arguments are validated against the JSON schema of the called tool; a tool without a schema
   or arguments that do not parse are invalid.
4. A row's JSON is canonical: keys in code point order, no white space, absent instead of null.

Defined cases: null conversation or call identifiers link with nothing and have no number; null or
empty arguments are invalid; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.schema import compile_schema
from corpusforge.llm.common import discard, materialise

KEY = ["conv_id", "call_id"]


def call_waves(calls: DataFrame, max_rounds: int = 10_000) -> DataFrame:
    """``(conv_id, call_id, wave)``: 0 throughout conversations whose (turn, call_id) order is
    topological, else by rounds, null on and behind a cycle.

    ``calls`` has distinct keys, ``turn`` and ``depends_on`` (array of call identifiers).
    """
    nodes = calls.select(*KEY, F.struct("turn", "call_id").alias("at"), "depends_on")
    raw = nodes.select(*KEY, "at", F.explode(F.array_distinct("depends_on")).alias("dep"))
    known = raw.join(nodes.select("conv_id", F.col("call_id").alias("dep"), F.col("at").alias("dep_at")), ["conv_id", "dep"])
    unordered = materialise(known.where("dep_at >= at").select("conv_id").distinct())
    if unordered.isEmpty():
        return nodes.select(*KEY, F.lit(0).alias("wave"))
    mine = calls.join(unordered, "conv_id", "left_semi")
    return (nodes.join(unordered, "conv_id", "left_anti").select(*KEY, F.lit(0).alias("wave"))
            .unionByName(mine.select(*KEY).join(_waves_by_rounds(mine, max_rounds), KEY, "left")))


def _waves_by_rounds(nodes: DataFrame, max_rounds: int) -> DataFrame:
    """As many rounds as the longest chain of dependencies has calls; more than ``max_rounds`` raise."""
    raw = nodes.select(*KEY, F.explode(F.array_distinct("depends_on")).alias("dep"))
    edges = materialise(raw.join(nodes.select("conv_id", F.col("call_id").alias("dep")), ["conv_id", "dep"]))
    placed = materialise(nodes.join(edges.select(*KEY).distinct(), KEY, "left_anti").select(
        *KEY, F.lit(0).alias("wave")))
    front = placed
    for wave in range(1, max_rounds + 1):
        # calls with a dependency in the front, all of whose dependencies are placed by now
        near = edges.join(front.select("conv_id", F.col("call_id").alias("dep")), ["conv_id", "dep"]).select(
            *KEY).distinct()
        seen = placed.select("conv_id", F.col("call_id").alias("dep"), F.lit(1).alias("known"))
        ready = (edges.join(near, KEY).join(seen, ["conv_id", "dep"], "left").groupBy(*KEY)
                 .agg(F.count("*").alias("all"), F.count("known").alias("known")).where("all = known")
                 .select(*KEY, F.lit(wave).alias("wave")))
        front = materialise(ready)
        if front.isEmpty():
            return placed
        before, placed = placed, materialise(placed.unionByName(front))
        discard(before)
    raise RuntimeError(f"a chain of more than {max_rounds} calls")


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``seq``: the number of a call in its conversation, from 0."""
    order = [F.col("conv_id"), F.col("wave").isNull(), F.col("wave"), F.col("turn"), F.col("call_id")]
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = materialise(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                         .select("*", F.spark_partition_id().alias("_part"), local.alias("_at")))
    held = placed.groupBy("conv_id", "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_begin"))
    before = F.coalesce(F.expr("sum(_n) over (partition by conv_id order by _part rows between unbounded preceding "
                               "and 1 preceding)"), F.lit(0))          # one row a conversation and partition
    offset = materialise(held.select("conv_id", "_part", (before - F.col("_begin")).alias("_off")))
    return placed.join(offset, ["conv_id", "_part"]).withColumn("seq", F.col("_off") + F.col("_at")).drop("_part", "_at", "_off")


def canonical(value: Column) -> Column:
    """JSON text with its keys in code point order and no white space; null where it does not parse."""
    return F.to_json(F.try_parse_json(value))


def _with_arguments(row: Column) -> Column:
    """JSON of a row, its canonical arguments (the first key) put in front where there are any."""
    rest = F.to_json(row)
    return F.when(F.col("arguments").isNull(), rest).otherwise(
        F.concat(F.lit('{"arguments":'), F.col("arguments"), F.lit(","), F.substring(rest, F.lit(2), F.length(rest))))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Linked calls and orphan results.

    ``calls(conv_id, call_id, turn, name, arguments, depends_on)``,
    ``results(conv_id, call_id, turn, content)``; ``schemas`` by tool name.  Returns ``kind`` (call,
    duplicate_call or orphan_result), ``conv_id, call_id, turn, seq, name, valid, n_results`` and
    ``json``.
    """
    valid = F.lit(False)
    for name, schema in schemas.items():
        valid = F.when(F.col("name") == name, compile_schema(schema, F.col("arguments"))).otherwise(valid)
    # arguments are parsed once; everything below works on this table
    read = materialise(calls.select(*KEY, "turn", "name", canonical(F.col("arguments")).alias("arguments"), "depends_on",
                                    F.coalesce(valid, F.lit(False)).alias("valid")))
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    unique = materialise(read.where(named).groupBy(*KEY).agg(
        F.min(F.struct("turn", "name", "arguments", "valid", "depends_on")).alias("c"), F.count("*").alias("copies"))
        .select(*KEY, "c.*", "copies"))
    answers = results.where(named).groupBy(*KEY).agg(
        F.min(F.struct("turn", "content")).alias("r"), F.count("*").alias("n_results"))
    linked = _numbered(unique.drop("depends_on").join(answers, KEY, "left").join(call_waves(unique), KEY)
                       .withColumn("n_results", F.coalesce("n_results", F.lit(0))))
    shown = ["turn", "seq", "name", "valid", "n_results"]
    none = F.lit(None).cast("long").alias("seq")
    zero = F.lit(0).cast("long")
    result = F.when(F.col("r").isNotNull(), F.struct(F.col("r.content").alias("content"), F.col("r.turn").alias("turn")))
    rows = linked.select(F.lit("call").alias("kind"), *KEY, *shown, _with_arguments(
        F.struct("call_id", "name", result.alias("result"), "seq", "turn", "valid")).alias("json"))
    extra = linked.where("copies > 1").select(
        F.lit("duplicate_call").alias("kind"), *KEY, "turn", "seq", "name", "valid", (F.col("copies") - 1).alias("n_results"),
        F.lit(None).cast("string").alias("json"))
    orphans = results.join(unique.select(*KEY), KEY, "left_anti").select(
        F.lit("orphan_result").alias("kind"), *KEY, "turn", none, F.lit(None).cast("string").alias("name"),
        F.lit(False).alias("valid"), zero.alias("n_results"), F.to_json(F.struct("call_id", "content", "turn")).alias("json"))
    lost = read.where(~named).select(
        F.lit("call").alias("kind"), *KEY, "turn", none, "name", "valid", zero.alias("n_results"),
        _with_arguments(F.struct("call_id", "name", "turn")).alias("json"))
    return rows.unionByName(extra).unionByName(orphans).unionByName(lost)


# How the plain chats of ``conversations`` are read as tool calls -------------------------------
SCHEMAS = {
    "lookup": {"type": "object", "required": ["text", "words"], "additionalProperties": False,
               "properties": {"text": {"type": "string", "maxLength": 120}, "turn": {"type": "integer"},
                              "words": {"type": "integer", "minimum": 1, "maximum": 20}}},
    "search": {"type": "object", "required": ["text", "words"],
               "properties": {"text": {"type": "string", "minLength": 20}, "words": {"type": "integer"}}},
    "compose": {"type": "object", "required": ["text", "words"],
                "properties": {"text": {"type": "string"}, "words": {"type": "integer", "maximum": 60}}},
}


def chat_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of a chat table ``(conv_id, turn, role, text)``.

    Every user turn calls the tool fit for its length with its text as argument and depends on
    the user turn two before it and on the conversation's first turn; every other speaker but
    the system answers the turn before it.
    """
    ident = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))

    def earlier(n: Column) -> Column:
        return F.concat_ws("-", F.col("conv_id").cast("string"), n.cast("string"))
    words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "[ \n]", -1), lambda w: w != ""))
    c = conversations.select("conv_id", "turn", "role", "text", words.alias("words"))
    name = F.when(F.col("words") <= 20, "lookup").when(F.col("words") <= 40, "search").otherwise("compose")
    calls = c.where("role = 'user'").select(
        "conv_id", F.when(F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), ident).alias("call_id"), "turn",
        name.alias("name"), F.to_json(F.struct("words", "turn", "text")).alias("arguments"),
        F.filter(F.array(earlier(F.col("turn") - 2), F.when(F.col("turn") > 0, earlier(F.lit(0)))),
                 lambda x: x.isNotNull()).alias("depends_on"))
    results = c.where("role not in ('user', 'system')").select(
        "conv_id", F.when(F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), earlier(F.col("turn") - 1))
        .alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results

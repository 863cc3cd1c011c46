"""Conversation structure repair by weighted CYK interval parsing (operator 13).

A conversation's role initials shall read ``(s?(ua)+)?``.  Edits per row: Keep 0, Rerole (to user or
assistant) 2, Delete 3 (the only one for blank and duplicate rows); Insert an empty user or assistant
turn anywhere 2; a truncated row that stays costs 1 more.

1. The grammar in Chomsky normal form has a symbol ``T_pq`` for what takes the pattern from state
   ``p`` to ``q`` (:data:`SYMBOLS`) and the rules ``T_pq -> T_pr T_rq`` (:data:`RULES`).  A row's cell
   holds, per symbol, the cheapest ``(cost, audit)`` of its edits; insertions, which span no row,
   are closed over on both sides of it (:func:`row_cell`).
2. Cells are combined bottom-up by span length.  As every ``T_pq`` splits at every place, one split
   a span is enough: the chart holds spans of 1, 2, 4, ... rows (:func:`chart`), linear in their number.
   Audits of one span and one cost are never a proper prefix of each other (their cost would differ),
   so the least ``(cost, audit)`` of a span is made of least parts.
3. Rows are placed by a range sort that may cut a conversation, and dealt in blocks of ``BLOCK`` turns.
   A block is parsed whole; blocks of long conversations are combined ``FAN`` at a time in rounds,
   and the way down gives each block the states it starts and ends with, from which its edits follow.
   No task holds a conversation, only the two texts that are one value by their meaning (the audit,
   and the repaired text while it is hashed, which is streamed) grow with it.

Faults: blank (nothing but white space), duplicate (role and text of an earlier row), truncated (ends
without ``.``, ``!`` or ``?``); the first that holds counts.

Defined cases: null role and text are one space; null turns come first; rows of one turn are ordered by
role, the first 256 characters of the text, and its digest; a null conversation id is a conversation of
its own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import materialise, positions

BLOCK, FAN = 256, 64
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
START, SYSTEM, USER, DONE = range(4)               # nothing yet, after s, after u, after a
STEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, DONE: USER}, "a": {USER: DONE}}
SYMBOLS = [(0, 0), (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3)]
_AT = {s: i for i, s in enumerate(SYMBOLS)}
RULES = [(_AT[p, q], _AT[p, r], _AT[r, q]) for p, q in SYMBOLS for r in range(4) if (p, r) in _AT and (r, q) in _AT]
INITIALS, FATES = "suax", "otbd"                   # any other role; fine, truncated, blank, duplicate
_SPACES = " \t\n\x0b\x0c\r"


class Repair(NamedTuple):
    report: DataFrame          # one row a conversation with rows
    blocks: DataFrame          # (conv, block, lines): the repaired turns, in blocks


# ---------------------------------------------------------------- grammar

def _combine(left: list, right: list) -> list:
    out: list = [None] * len(SYMBOLS)
    for o, l, r in RULES:
        a, b = left[l], right[r]
        if a is not None and b is not None:
            c = (a[0] + b[0], a[1] + b[1])
            if out[o] is None or c < out[o]:
                out[o] = c
    return out


def _lexical(steps: list[tuple[int, int, int, str]]) -> list:
    out: list = [None] * len(SYMBOLS)
    for p, q, cost, letter in steps:
        at = _AT[p, q]
        if out[at] is None or (cost, letter) < out[at]:
            out[at] = (cost, letter)
    return out


def _insertions() -> list:
    """What insertions alone can do: the closure of single ones."""
    one = _lexical([(p, p, 0, "") for p in range(4)]
                   + [(p, q, INSERT, "I") for role in "ua" for p, q in STEPS[role].items()])
    while (more := _combine(one, one)) != one:
        one = more
    return one


@lru_cache(maxsize=None)
def row_cell(symbol: str) -> tuple:
    """The cell of one row, ``symbol`` naming its initial and its fate."""
    initial, fate = divmod(ord(symbol) - 65, 4)
    steps = [(p, p, DELETE, "D") for p in range(4)]
    if FATES[fate] in "ot":
        more = TRUNCATED if FATES[fate] == "t" else 0
        steps += [(p, q, KEEP + more, "K") for p, q in STEPS.get(INITIALS[initial], {}).items()]
        steps += [(p, q, REROLE + more, "R") for role in "ua" for p, q in STEPS[role].items()]
    closed = _insertions()
    return tuple(_combine(_combine(closed, _lexical(steps)), closed))


def chart(cells: list) -> list[list]:
    """Cells by span length, from the shortest; the last row has one cell."""
    levels = [cells]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([_combine(row[i], row[i + 1]) if i + 1 < len(row) else row[i] for i in range(0, len(row), 2)])
    return levels


def descend(levels: list[list], p: int, q: int) -> list[tuple[int, int]]:
    """Start and end state of every cell of the shortest spans in the best parse from ``p`` to ``q``."""
    ends = [(p, q)]
    for row in reversed(levels[:-1]):
        nxt = []
        for i, (a, b) in enumerate(ends):
            if 2 * i + 1 == len(row):
                nxt.append((a, b))
                continue
            left, right = row[2 * i], row[2 * i + 1]
            split = min((left[_AT[a, r]][0] + right[_AT[r, b]][0], left[_AT[a, r]][1] + right[_AT[r, b]][1], r)
                        for r in range(4) if (a, r) in _AT and (r, b) in _AT and left[_AT[a, r]] and right[_AT[r, b]])[2]
            nxt += [(a, split), (split, b)]
        ends = nxt
    return ends


@lru_cache(maxsize=50_000)
def _short(symbols: str) -> list:
    return chart([row_cell(s) for s in symbols])[-1][0]


def parse(symbols: str) -> list:
    """The cell of a span of rows."""
    return _short(symbols) if len(symbols) <= 16 else chart([row_cell(s) for s in symbols])[-1][0]


def best_end(cell: list) -> int:
    return min((q for q in (START, DONE) if cell[_AT[START, q]]), key=lambda q: cell[_AT[START, q]])


def lines(symbols: str, p: int, audit: str) -> list[tuple[str, str | None, int]]:
    """``(edit, new role or None, row or -1)`` of every turn that the audit leaves, from state ``p``."""
    out, row = [], 0
    for edit in audit:
        if edit == "K":
            role = INITIALS[(ord(symbols[row]) - 65) // 4]
        elif edit != "D":
            role = "a" if p == USER else "u"
        if edit != "D":
            p = STEPS[role][p]
            out.append((edit, None if edit == "K" else "user" if role == "u" else "assistant", -1 if edit == "I" else row))
        row += edit != "I"
    return out


def illegal_pairs(initials: str) -> int:
    return sum(pair not in ("su", "ua", "au") for pair in map("".join, zip(initials, initials[1:])))


# ---------------------------------------------------------------- tables

def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` with the faults that the contract plants by CRC-32 of ``conv_id:turn``."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = conversations.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")],
                                (F.crc32(key) % 20).alias("_f")).where("_f <> 0")
    text = F.when(F.col("_f") == 1, "").when(F.col("_f") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_f") == 4, "user").otherwise(F.col("role"))
    twice = F.explode(F.when(F.col("_f") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), twice.alias("_copy")).drop("_copy")


def _key(conv_id: str) -> Column:
    """A conversation id that is never null."""
    return F.when(F.col(conv_id).isNull(), "").otherwise(F.concat(F.lit(":"), F.col(conv_id).cast("string")))


def _places(turns: DataFrame) -> DataFrame:
    """``(conv, turn, role, text, code, digest, pos)``: the rows in order; ``code`` is initial and fate."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    first = F.substring(role, 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    ended = F.rtrim(text, F.lit(_SPACES))
    fate = F.when(F.length(ended) == 0, 2).when(F.right(ended, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1)
    rows = turns.select(_key("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
                        text.alias("text"), (initial * 4 + fate).alias("code"),
                        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"))
    return positions(rows, ["conv"], [F.col("turn").asc_nulls_first(), F.col("role").asc(),
                                      F.substring("text", 1, 256).asc(), F.col("digest").asc()])


def _nodes(placed: DataFrame) -> DataFrame:
    """Parsed blocks: ``(conv, key, symbols, first, last, illegal, blank, duplicate, truncated, costs, audits, q)``."""
    code = F.col("pos") * 32 + 1 + F.col("code")
    rows = placed.select("conv", F.expr(f"pos div {BLOCK}").alias("key"), code.alias("v"))
    firsts = placed.where("code % 4 <> 2").groupBy("conv", "digest").agg(F.min("pos").alias("pos"))
    marks = firsts.select("conv", F.expr(f"pos div {BLOCK}").alias("key"), (F.col("pos") * 32).alias("v"))
    blocks = rows.unionByName(marks).groupBy("conv", "key").agg(F.sort_array(F.collect_list("v")).alias("vs"))
    schema = pa.schema([("conv", pa.string()), ("key", pa.int64()), ("symbols", pa.string()), *_NODE,
                        ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, key, vs in zip(*[c.to_pylist() for c in batch.columns]):
                symbols, new = [], False
                for v in vs:
                    c = v % 32 - 1
                    if c < 0:
                        new = True                              # the next row is the first of its role and text
                        continue
                    symbols.append(chr(65 + (c if new or c % 4 == 2 else c // 4 * 4 + 3)))
                    new = False
                symbols = "".join(symbols)
                fates = [(ord(s) - 65) % 4 for s in symbols]
                initials = "".join(INITIALS[(ord(s) - 65) // 4] for s in symbols)
                out.append({"conv": conv, "key": key, "symbols": symbols, "blank": fates.count(2), "duplicate": fates.count(3),
                            "truncated": fates.count(1),
                            **_node(parse(symbols), initials[0], initials[-1], illegal_pairs(initials))})
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    return blocks.select("conv", "key", "vs").mapInArrow(
        run, f"conv string, key long, symbols string, {_NODE_DDL}, blank long, duplicate long, truncated long")


_NODE = [("first", pa.string()), ("last", pa.string()), ("illegal", pa.int64()),
         ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())), ("q", pa.int32())]
_NODE_DDL = "first string, last string, illegal long, costs array<long>, audits array<string>, q int"
_NODE_COLUMNS = ["first", "last", "illegal", "costs", "audits", "q"]


def _node(cell: list, first: str, last: str, illegal: int) -> dict:
    return {"first": first, "last": last, "illegal": illegal, "costs": [c and c[0] for c in cell],
            "audits": [c and c[1] for c in cell], "q": best_end(cell)}


def _cell(row: dict) -> list:
    return [None if c is None else (c, a) for c, a in zip(row["costs"], row["audits"])]


def _families(batches: Iterator[pa.RecordBatch]):
    """Rows of a stream sorted by (conv, up, key), by parent: at most ``FAN`` nodes and one of ends."""
    def rows():
        for batch in batches:
            yield from batch.to_pylist()
    for at, members in groupby(rows(), key=lambda r: (r["conv"], r["up"])):
        yield at, list(members)


def _dealt(nodes: DataFrame) -> DataFrame:
    return nodes.repartition("conv", "up").sortWithinPartitions("conv", "up", "key")


def _parents(nodes: DataFrame) -> DataFrame:
    schema = pa.schema([("conv", pa.string()), ("key", pa.int64()), *_NODE])

    def run(batches):
        for (conv, up), kids in _families(batches):
            cell = chart([_cell(k) for k in kids])[-1][0]
            illegal = sum(k["illegal"] for k in kids) + sum(
                illegal_pairs(a["last"] + b["first"]) for a, b in zip(kids, kids[1:]))
            yield pa.RecordBatch.from_pylist([{"conv": conv, "key": up, **_node(cell, kids[0]["first"], kids[-1]["last"],
                                                                                illegal)}], schema=schema)
    return _dealt(nodes.withColumn("up", F.expr(f"key div {FAN}"))).mapInArrow(run, f"conv string, key long, {_NODE_DDL}")


def _child_ends(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """``(conv, key, p, q)`` of the nodes, given those of their parents."""
    schema = pa.schema([("conv", pa.string()), ("key", pa.int64()), ("p", pa.int32()), ("q", pa.int32())])
    rows = nodes.select("conv", F.expr(f"key div {FAN}").alias("up"), "key", "costs", "audits").unionByName(
        ends.select("conv", F.col("key").alias("up"), F.lit(-1).cast("long").alias("key"), "p", "q"), allowMissingColumns=True)

    def run(batches):
        for (conv, _), (end, *kids) in _families(batches):
            found = descend(chart([_cell(k) for k in kids]), end["p"], end["q"])
            yield pa.RecordBatch.from_pylist([{"conv": conv, "key": k["key"], "p": p, "q": q}
                                              for k, (p, q) in zip(kids, found)], schema=schema)
    return _dealt(rows).mapInArrow(run, "conv string, key long, p int, q int")


def _plans(nodes: DataFrame) -> DataFrame:
    """``(conv, key, whole, plan)`` of blocks with start and end state: :func:`lines`."""
    schema = pa.schema([("conv", pa.string()), ("key", pa.int64()), ("whole", pa.bool_()), ("plan", pa.list_(pa.struct(
        [("edit", pa.string()), ("role", pa.string()), ("row", pa.int32())])))])

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                audit = r["audits"][_AT[r["p"], r["q"]]]
                out.append({"conv": r["conv"], "key": r["key"], "whole": r["whole"], "plan": [
                    dict(zip(("edit", "role", "row"), x)) for x in lines(r["symbols"], r["p"], audit)]})
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    return nodes.select("conv", "key", "symbols", "audits", "p", "q", "whole").mapInArrow(
        run, "conv string, key long, whole boolean, plan array<struct<edit:string,role:string,row:int>>")


def repair(turns: DataFrame) -> Repair:
    """Faults, cheapest edits and repaired turns of ``turns(conv_id, turn, role, text)``.

    ``report``: conv (key of the id), gaps, blank, duplicate, truncated, illegal, cost, audit.
    ``blocks``: conv, block, whole (the conversation is one block), lines (edit, role, text).
    """
    placed = _places(turns)
    nodes = materialise(_nodes(placed))
    long_ = materialise(nodes.where("key > 0").select("conv").distinct())
    single = nodes.join(long_, "conv", "left_anti")
    tops = single.select("conv", *_NODE_COLUMNS)
    plans = single.withColumns({"p": F.lit(START), "whole": F.lit(True)})
    if not long_.isEmpty():
        levels = [materialise(nodes.join(long_, "conv").select("conv", "key", "symbols", *_NODE_COLUMNS))]
        while True:
            levels.append(materialise(_parents(levels[-1])))
            if levels[-1].where("key > 0").isEmpty():
                break
        tops = tops.unionByName(levels[-1].select("conv", *_NODE_COLUMNS))
        ends = levels[-1].select("conv", "key", F.lit(START).alias("p"), "q")
        for level in reversed(levels[:-1]):
            ends = materialise(_child_ends(level, ends))
        parts = levels[0].drop("q").join(ends, ["conv", "key"]).withColumn("whole", F.lit(False))
        columns = ["conv", "key", "symbols", "audits", "p", "q", "whole"]
        plans = plans.select(*columns).unionByName(parts.select(*columns))

    end = F.when(F.col("q") == START, _AT[START, START]).otherwise(_AT[START, DONE])
    faults = nodes.select("conv", "blank", "duplicate", "truncated")
    top = tops.select("conv", "illegal", F.get("costs", end).alias("cost"), F.get("audits", end).alias("audit"))
    span = placed.groupBy("conv").agg(F.max("turn").alias("hi"), F.min("turn").alias("lo"), F.countDistinct("turn").alias("n"))
    gaps = span.select("conv", F.expr("coalesce(try_cast(cast(hi as decimal(38,0)) - lo + 1 - n as bigint), 0)").alias("gaps"))
    both = faults.unionByName(top, True).unionByName(gaps, True)
    report = both.groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                                      F.max("audit").alias("audit"))

    rows = placed.select("conv", F.expr(f"pos div {BLOCK}").alias("key"),
                         F.struct((F.col("pos") % BLOCK).alias("at"), "role", "text").alias("r"))
    joined = rows.unionByName(_plans(plans), True).groupBy("conv", "key").agg(
        F.sort_array(F.collect_list("r")).alias("rows"),         # one block
        F.first("plan", ignorenulls=True).alias("plan"), F.first("whole", ignorenulls=True).alias("whole"))
    line = F.transform("plan", lambda x: F.struct(
        x["edit"].alias("edit"), F.coalesce(x["role"], F.get("rows", x["row"])["role"]).alias("role"),
        F.when(x["row"] < 0, "").otherwise(F.get("rows", x["row"])["text"]).alias("text")))
    return Repair(report, joined.select("conv", F.col("key").alias("block"), "whole", line.alias("lines")))


def repaired_turns(repair_: Repair) -> DataFrame:
    """``(conv, block, seq, edit, role, text)``: the repaired turns; order by block, then seq."""
    return repair_.blocks.select("conv", "block", F.posexplode("lines").alias("seq", "l")).select("conv", "block", "seq", "l.*")


def text_digests(repair_: Repair) -> DataFrame:
    """``(conv, repaired_sha256)`` of the repaired ``role:text``, newline-joined."""
    text = F.array_join(F.transform("lines", lambda l: F.concat(l["role"], F.lit(":"), l["text"])), "\n")
    parts = materialise(repair_.blocks.select("conv", "block", "whole", F.when(F.col("whole"), F.sha2(text, 256)).alias("sha"),
                                              F.when(~F.col("whole") & (F.size("lines") > 0), text).alias("text")))
    schema = pa.schema([("conv", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches):
        conv, h, empty = None, sha256(), True
        for batch in batches:
            out = []
            for c, _, t in zip(*[x.to_pylist() for x in batch.columns]):
                if c != conv:
                    if conv is not None:
                        out.append({"conv": conv, "repaired_sha256": h.hexdigest()})
                    conv, h, empty = c, sha256(), True
                if t is not None:
                    h.update((t if empty else "\n" + t).encode())
                    empty = False
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if conv is not None:
            yield pa.RecordBatch.from_pylist([{"conv": conv, "repaired_sha256": h.hexdigest()}], schema=schema)
    streamed = parts.where("not whole").select("conv", "block", "text").repartition("conv").sortWithinPartitions(
        "conv", "block").mapInArrow(run, "conv string, repaired_sha256 string")
    return parts.where("whole").select("conv", F.col("sha").alias("repaired_sha256")).unionByName(streamed)


def repair_report(conversations: DataFrame) -> DataFrame:
    """One row per original conversation: the report of the damaged rows and the repaired text's digest."""
    fixed = repair(damage(conversations))
    ids = conversations.select(_key("conv_id").alias("conv"), "conv_id").distinct()
    rows = ids.unionByName(fixed.report, True).unionByName(text_digests(fixed), True)
    zero = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return rows.groupBy("conv").agg(
        F.max("conv_id").alias("conv_id"), *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in zero],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(sha256(b"").hexdigest())).alias("repaired_sha256")).drop("conv")

import itertools
import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from corpusforge.llm import catalog
from corpusforge.llm import dialogrepair as dr
from tests.conftest import SF_SMALL

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
WS = " \t\n\x0b\x0c\r"
NEXT = {("", "s"): "S", ("", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}


def _insertions(best):
    changed = True
    while changed:
        changed = False
        for state, (cost, audit, out) in list(best.items()):
            for role in ("user", "assistant"):
                to = NEXT.get((state, role[0]))
                if to and (to not in best or (cost + 2, audit + "I") < best[to][:2]):
                    best[to], changed = (cost + 2, audit + "I", out + ((role, ""),)), True
    return best


def _cheapest(rows, fates):
    """A walk from left to right, one state at a time; no grammar, no spans."""
    best = _insertions({"": (0, "", ())})
    for (_, role, text), fate in zip(rows, fates):
        new = {}
        for state, (cost, audit, out) in best.items():
            options = [(state, cost + 3, audit + "D", out)]
            if fate in "ot":
                more = cost + (fate == "t")
                options += [(NEXT.get((state, role[:1])), more, audit + "K", out + ((role, text),))]
                options += [(NEXT.get((state, r[0])), more + 2, audit + "R", out + ((r, text),)) for r in ("user", "assistant")]
            for to, *value in options:
                if to is not None and (to not in new or tuple(value[:2]) < new[to][:2]):
                    new[to] = tuple(value)
        best = _insertions(new)
    return min((best[s] for s in ("", "A") if s in best), key=lambda v: v[:2])


def _brute(table):
    by = defaultdict(list)
    for conv, turn, role, text in table:
        rows = by[conv]
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        rows += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    out = []
    for conv, rows in by.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [r[0] for r in rows if r[0] is not None]
        seen, fates = set(), ""
        for _, role, text in rows:
            end = text.strip(WS)
            fates += "b" if not end else "d" if (role, text) in seen else "o" if end[-1] in ".!?" else "t"
            seen.add((role, text))
        initials = [r[1][:1] for r in rows]
        cost, audit, left = _cheapest(rows, fates) if rows else (0, "", ())
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, fates.count("b"), fates.count("d"),
                    fates.count("t"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()))
    return sorted(out, key=str)


def _run(df):
    return sorted((tuple(r) for r in dr.repair_report(df).select(*COLUMNS).collect()), key=str)


def _table():
    rnd = random.Random(4)
    rows = []
    for conv in [None, *range(40)]:
        for t in range(rnd.choice([1, 3, 9, 40])):
            rows.append((conv, rnd.choice([None, t, t, t, rnd.randrange(9)]),
                         rnd.choice(["system", "user", "assistant", "assistant", "tool", None, "", "User"]),
                         rnd.choice(["a.", " ", "", "b", None, "q? \n", f"x!{t}", "é。", "long " * 200 + "end."])))
    rows += [(999, t, rnd.choice(["user", "assistant"]), rnd.choice([f"t{t}.", f"w{t}", "hello."])) for t in range(700)]
    return rows + rows[:30]


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = catalog.QUERIES["op13_dialog_repair"](spark, SF_SMALL).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == _brute(rows)


@pytest.mark.parametrize("block,fan", [(256, 64), (8, 4), (1, 2)])
def test_nulls_ties_repeats_and_long_conversations(spark, monkeypatch, block, fan):
    monkeypatch.setattr(dr, "BLOCK", block)
    monkeypatch.setattr(dr, "FAN", fan)
    assert _run(spark.createDataFrame(_table(), SCHEMA).repartition(7)) == _brute(_table())


def test_extra_columns_and_empty_table(spark):
    df = spark.createDataFrame(_table()[:60], SCHEMA).selectExpr("*", "1 AS conv", "2 AS pos", "'x' AS code", "role AS audit")
    assert _run(df) == _brute(_table()[:60])
    assert _run(df.limit(0)) == []


def _all_edits(symbols):
    """Least (cost, audit) by trying every audit of up to two insertions a place."""
    best = None
    rows = [(dr.INITIALS[(ord(s) - 65) // 4], dr.FATES[(ord(s) - 65) % 4]) for s in symbols]
    edits = [("D", "K", "R") if f in "ot" else ("D",) for _, f in rows]
    for chosen in itertools.product(*edits):
        for places in itertools.product(range(3), repeat=len(rows) + 1):
            audit, n, ok = "I" * places[0], places[0], True
            kept = [(None, n_) for n_ in range(places[0])]
            cost = 2 * sum(places)
            for (initial, fate), e, more in zip(rows, chosen, places[1:]):
                audit += e + "I" * more
                cost += {"D": 3, "K": 0, "R": 2}[e] + (e != "D" and fate == "t")
                if e != "D":
                    kept.append((initial if e == "K" else None, n))
                    n += 1
                kept += [(None, n + i) for i in range(more)]
                n += more
            want = ("s" if n % 2 else "") + "ua" * (n // 2)
            ok = n != 1 and all(x is None and want[i] != "s" or x == want[i] for x, i in kept)
            if ok and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def test_chart_against_every_edit_sequence():
    symbols = [chr(65 + 4 * i + f) for i in range(4) for f in (0, 1, 2)]
    rnd = random.Random(5)
    for n in (1, 2, 3, 4):
        for _ in range(25):
            s = "".join(rnd.choice(symbols) for _ in range(n))
            cell = dr.parse(s)
            assert cell[dr.SYMBOLS.index((0, dr.best_end(cell)))] == _all_edits(s), s


def test_way_down_gives_the_parse(spark):
    rnd = random.Random(6)
    s = "".join(chr(65 + 4 * rnd.randrange(4) + rnd.randrange(3)) for _ in range(37))
    cells = [dr.parse(s[i:i + 5]) for i in range(0, len(s), 5)]
    levels = dr.chart(cells)
    q = dr.best_end(levels[-1][0])
    ends = dr.descend(levels, 0, q)
    parts = [c[dr.SYMBOLS.index(e)] for c, e in zip(cells, ends)]
    assert (sum(c for c, _ in parts), "".join(a for _, a in parts)) == levels[-1][0][dr.SYMBOLS.index((0, q))]
    assert levels[-1][0] == dr.parse(s)


def test_repaired_turns_follow_the_pattern(spark):
    fixed = dr.repair(spark.createDataFrame(_table(), SCHEMA))
    by = defaultdict(list)
    for r in dr.repaired_turns(fixed).orderBy("conv", "block", "seq").collect():
        by[r.conv].append(r)
    for turns in by.values():
        assert re.fullmatch("s?(ua)+", "".join(t.role[0] for t in turns))
        assert all(t.text == "" for t in turns if t.edit == "I")

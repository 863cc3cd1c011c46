"""Quality rules as a learned decision list (operator 11), in DataFrame and SQL functions only.

1. :func:`statistics`: one pass over the texts gives every document's counts and shares.  Repeated
   8-word windows are found inside the row: window hashes, a hash set to see whether any repeats,
   and a sort of (hash, place) only for the documents where one does.
2. :func:`learn`: sequential covering on the labelled rows that pass the base rules.  A rule grows by
   the threshold condition with the highest information gain (:func:`_grow`), is pruned to the prefix
   of conditions with the best (p - n) / (p + n) on held-out rows, and is taken while it is precise
   there; the rows it covers go, and the next rule is sought.  Every step is one aggregation of the
   rows to a histogram (feature, bin), whose size is that of the thresholds.
3. :func:`verdict`: the ordered rules as one Spark conditional expression; :func:`describe` as SQL text.

``train_rows`` bounds the labelled sample (by hash of the id, whatever the table's size); the
statistics and the verdict cover all rows.

Defined cases: a null or empty text has no word and fails the base rules; labels that are null
or contradict each other are left out; ties between conditions go to the earlier feature, the lower
threshold, ``>=`` before ``<``; rows of one id are one labelled row (the least by its statistics); without
labelled rows the list is empty and every row that passes the base rules is kept; an empty table gives
an empty result; other columns of the documents are not read.
"""

from __future__ import annotations

from math import log2
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.hashing import hash48
from corpusforge.llm.common import materialise

WINDOW = 8
_WS = r"\x20\x09-\x0D"
_TAIL = 1 << 30                                     # "to the end" of an array slice
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = {                                        # shares, so that length alone moves none of them
    "mean_word": "word_chars / n_words",
    "symbol_share": "n_symbols / word_chars",
    "dup_line_share": "n_dup_lines / n_lines",
    "repeat_share": "n_repeat_words / n_words",
    "same_share": "n_same / n_words",
    "upper_share": "n_upper / word_chars",
    "digit_share": "n_digits / word_chars",
    "bang_share": "n_bangs / n_words",
    "lone_share": "n_lone / n_words",
    "word_count": "n_words",
}


class Rule(NamedTuple):
    conditions: tuple[tuple[str, str, float], ...]  # (feature, ">=" or "<", threshold), all of them
    keep: bool                                      # the verdict
    right: int                                      # held-out rows covered rightly and wrongly
    wrong: int


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often the body names it."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def window_hashes(words: Column) -> Column:
    """A hash of every ``WINDOW`` consecutive words, in order: hashes of neighbours at distance 1, 2, 4."""
    hashes, span = F.transform(words, lambda w: F.xxhash64(w)), 1
    while span < WINDOW:
        hashes = _let(hashes, lambda h, d=span: F.zip_with(h, F.slice(h, d + 1, _TAIL), lambda a, b: F.xxhash64(a, b)))
        span *= 2
    return F.slice(hashes, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))


def repeated_words(hashes: Column, width: int = WINDOW) -> Column:
    """Words inside the windows (given by hash, in order) that occur twice or more."""
    def covered(places: Column) -> Column:
        steps = F.zip_with(places, F.slice(places, 2, _TAIL), lambda a, b: F.least(F.lit(width), F.coalesce(b - a, F.lit(width))))
        return F.aggregate(steps, F.lit(0), lambda acc, x: acc + x)

    def repeats(s: Column) -> Column:
        pairs = F.zip_with(s, F.slice(s, 2, _TAIL), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(
            F.array().cast("array<int>")))
        return _let(F.sort_array(F.array_distinct(F.flatten(pairs))), covered)
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(_let(placed, repeats)).cast("long")


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts, :data:`FEATURES` and ``base_failed`` of every row of ``docs``."""
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def count(pattern: str) -> Column:
        return F.regexp_count("text", F.lit(pattern)).cast("long")
    parts = text.select(
        "doc_id", F.split(F.trim("text", F.lit(" \t\n\x0b\x0c\r")), f"[{_WS}]+").alias("words"),
        F.filter(F.split("text", "\n", -1), lambda line: line.rlike(f"[^{_WS}]")).alias("lines"),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        count(r"\p{Lu}").alias("n_upper"), count(r"\p{Nd}").alias("n_digits"), count("!").alias("n_bangs"),
        count(rf"(?<![^{_WS}])[^\p{{L}}\p{{Nd}}{_WS}]+(?![^{_WS}])").alias("n_lone"))
    word_chars = F.length(F.array_join("words", ""))
    twice = F.zip_with("words", F.slice("words", 2, _TAIL), lambda a, b: a == b)   # a word as the one before
    counted = parts.select("doc_id", F.when(word_chars > 0, F.size("words")).otherwise(0).cast("long").alias("n_words"),
                           word_chars.cast("long").alias("word_chars"), "n_symbols",
                           (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                           F.size("lines").cast("long").alias("n_lines"), "n_upper", "n_digits", "n_bangs", "n_lone",
                           F.size(F.filter(twice, lambda same: same)).cast("long").alias("n_same"),
                           window_hashes(F.col("words")).alias("windows"))
    rows = counted.withColumn("n_repeat_words", repeated_words(F.col("windows"))).drop("windows")
    shares = {f: F.expr(f"round(coalesce(try_divide(cast({x.split(' / ')[0]} as double), {(x.split(' / ') + ['1'])[1]}), 0), 6)")
              for f, x in FEATURES.items()}
    return rows.withColumns({**shares, "base_failed": F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")})


# ---------------------------------------------------------------- learning

def condition(feature: str, op: str, threshold: float) -> Column:
    return F.col(feature) >= F.lit(threshold) if op == ">=" else F.col(feature) < F.lit(threshold)


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & condition(*c)
    return out


def verdict(rules: list[Rule], default: bool = True) -> Column:
    """The ordered list as one conditional expression."""
    if not rules:
        return F.lit(default)
    out = F.when(_all(rules[0].conditions), F.lit(rules[0].keep))
    for r in rules[1:]:
        out = out.when(_all(r.conditions), F.lit(r.keep))
    return out.otherwise(F.lit(default))


def describe(rules: list[Rule], default: bool = True) -> str:
    """The list as SQL text."""
    lines = [f"WHEN {' AND '.join(f'{f} {op} {t!r}' for f, op, t in r.conditions)} THEN {str(r.keep).lower()}" for r in rules]
    return "\n".join(["CASE", *lines, f"ELSE {str(default).lower()} END"]) if rules else str(default).lower()


def labelled_rows(stats: DataFrame, labels: DataFrame, train_rows: int, seed: int) -> DataFrame:
    """The labelled sample: one row an id with its features, ``bad`` and ``grow``; about ``train_rows`` at most."""
    one = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("lo"), F.max("quality").alias("hi")).where("lo = hi")
    one = materialise(one.select("doc_id", (F.col("lo") == 0).alias("bad"), hash48(F.lit(seed), F.col("doc_id")).alias("h")))
    n = one.count()
    picked = one.where(F.col("h") < F.lit(int(min(1.0, train_rows / max(n, 1)) * 2 ** 48)))   # about train_rows rows
    features = list(FEATURES)
    rows = stats.where("not base_failed").join(F.broadcast(picked), "doc_id").groupBy("doc_id", "bad", "h").agg(
        F.min(F.struct(*features)).alias("s"))
    return materialise(rows.select("bad", (F.col("h") % 3 < 2).alias("grow"), "s.*").repartition(4))


def thresholds(rows: DataFrame, cuts: int = 24) -> dict[str, list[float]]:
    """Candidate thresholds: quantiles of either class and the means of neighbouring ones."""
    at = [i / cuts for i in range(cuts + 1)]
    found = rows.where("grow").groupBy("bad").agg(*[F.percentile(f, at).alias(f) for f in FEATURES]).collect()   # two rows
    out = {}
    for f in FEATURES:
        values = sorted({round(v, 6) for r in found for v in r[f]})
        means = [round((a + b) / 2, 6) for a, b in zip(values, values[1:])]
        out[f] = sorted({*values, *means})
    return out


def _bin(feature: str, values: list[float]) -> Column:
    return F.size(F.filter(F.lit(values), lambda t: t <= F.col(feature)))


def _histogram(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[str, list[list[int]]]:
    """``[bad, good]`` rows by feature and bin (the number of its thresholds at or below the value)."""
    bins = F.posexplode(F.array(*[F.col(f"_{f}") for f in cuts])).alias("f", "b")
    out = {f: [[0, 0] for _ in range(len(c) + 1)] for f, c in cuts.items()}
    names = list(cuts)
    for r in rows.select("bad", bins).groupBy("f", "b").agg(F.count_if("bad").alias("p"), F.count("*").alias("t")).collect():
        out[names[r.f]][r.b] = [r.p, r.t - r.p]       # as many rows as thresholds
    return out


def _best(hist: dict[str, list[list[int]]], cuts: dict[str, list[float]], p0: int, n0: int):
    """``(gain, condition, p, n)`` of the condition with the highest information gain."""
    before, best = log2(p0 / (p0 + n0)), None
    for f, values in cuts.items():
        total = [sum(x) for x in zip(*hist[f])]
        below = [0, 0]
        for j, t in enumerate(values):
            below = [a + b for a, b in zip(below, hist[f][j])]
            for op, (p, n) in ((">=", [a - b for a, b in zip(total, below)]), ("<", below)):
                if p:
                    gain = p * (log2(p / (p + n)) - before)
                    if best is None or gain > best[0] + 1e-9:
                        best = (gain, (f, op, t), p, n)
    return best


def _grow(rows: DataFrame, cuts: dict[str, list[float]], most: int) -> list[tuple[str, str, float]]:
    """Conditions added one by one until no good row is covered or none gains."""
    rule: list[tuple[str, str, float]] = []
    while len(rule) < most:
        hist = _histogram(rows.where(_all(rule)), cuts)
        p, n = [sum(x) for x in zip(*next(iter(hist.values())))]
        if not p or not n:
            break
        best = _best(hist, cuts, p, n)
        if best is None or best[0] <= 1e-9:
            break
        rule.append(best[1])
    return rule


def _prune(rows: DataFrame, rule: list[tuple[str, str, float]]) -> tuple[list, int, int]:
    """The prefix of the rule with the best (p - n) / (p + n) on ``rows``, the shorter of equals, and its p, n."""
    sums = [F.count_if(_all(rule[:i + 1]) & side).alias(f"{k}{i}") for i in range(len(rule))
            for k, side in (("p", F.col("bad")), ("n", ~F.col("bad")))]
    r = rows.agg(*sums).first()
    worth = [((r[f"p{i}"] - r[f"n{i}"]) / max(1, r[f"p{i}"] + r[f"n{i}"]), -i) for i in range(len(rule))]
    i = -max(worth)[1]
    return rule[:i + 1], r[f"p{i}"], r[f"n{i}"]


def learn(rows: DataFrame, most_rules: int = 12, most_conditions: int = 4, min_precision: float = 0.9,
          min_rows: int = 3) -> list[Rule]:
    """Ordered rules that reject; ``rows`` has the features, ``bad`` and ``grow``."""
    cuts = thresholds(rows)
    if not all(cuts.values()):
        return []
    binned = materialise(rows.withColumns({f"_{f}": _bin(f, c) for f, c in cuts.items()}))
    rules: list[Rule] = []
    left = F.lit(True)
    while len(rules) < most_rules:
        rule = _grow(binned.where(F.col("grow") & left), cuts, most_conditions)
        if not rule:
            break
        rule, p, n = _prune(binned.where(~F.col("grow") & left), rule)
        if p < min_rows or p < min_precision * (p + n):
            break
        rules.append(Rule(tuple(rule), False, p, n))
        left = left & ~_all(rule)
    return rules


def judge(docs: DataFrame, labels: DataFrame, train_rows: int = 20_000, seed: int = 5) -> tuple[DataFrame, list[Rule]]:
    """Statistics of every document with ``kept``, and the rules learned from ``labels(doc_id, quality)``."""
    stats = materialise(statistics(docs))
    rules = learn(labelled_rows(stats, labels, train_rows, seed))
    return stats.withColumn("kept", ~F.col("base_failed") & verdict(rules)), rules

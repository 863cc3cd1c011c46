"""K4-K7 on the worked example; T2 finds flipped labels and nothing in self-labelled mode."""

import pytest
from pyspark.sql import functions as F

from corpusforge.operators import calibrate as cb
from corpusforge.operators import triage as tr

X = [0.1, 0.4, 0.35, 0.8, 0.8, 0.9]
Y = [0, 0, 1, 1, 0, 1]


def _pairs(spark, label="k"):
    return spark.createDataFrame([(i, label, x, y) for i, (x, y) in enumerate(zip(X, Y))],
                                 "row_id bigint, label string, p double, y int")


def test_isotonic_matches_pav(spark):
    params = cb.fit(_pairs(spark), ["k", "missing"], method="isotonic")
    probe = spark.createDataFrame([(i, "k", x) for i, x in enumerate([0.0, 0.1, 0.35, 0.6, 0.85, 0.9, 1.0])] +
                                  [(99, "missing", 0.3)], "row_id bigint, label string, p double")
    got = {r["row_id"]: round(r["p"], 6) for r in cb.apply(probe, params).collect()}
    assert got == {0: 0.0, 1: 0.0, 2: 0.5, 3: 0.5, 4: 0.75, 5: 1.0, 6: 1.0, 99: 0.3}
    methods = {r["key"]: r["method"] for r in params.collect()}
    assert methods == {"k": "isotonic", "missing": "identity"}


def test_platt_equals_c1_logistic_regression(spark):
    params = cb.fit(_pairs(spark), ["k"], method="platt").first()
    assert params["coef"] == pytest.approx(0.3325, abs=1e-3)
    assert params["intercept"] == pytest.approx(-0.1857, abs=1e-3)


def test_single_class_is_identity(spark):
    df = spark.createDataFrame([(1, "k", 0.2, 1), (2, "k", 0.9, 1)], "row_id bigint, label string, p double, y int")
    assert cb.fit(df, ["k"]).first()["method"] == "identity"


def test_truth_extraction(spark):
    truth = spark.createDataFrame([(1, None, 0.6, {"a": 1.0}, {}, "yes"), (2, True, None, {}, {"a": 0.4}, "1"),
                                   (3, None, 2.5, {}, {}, None)],
                                  "row_id bigint, label boolean, overall double, truth map<string,double>, labels map<string,double>, text string")
    o = {r[0]: r[1] for r in truth.select("row_id", cb.overall_truth(truth, ["text", "label", "overall"])).collect()}
    assert o == {1: 1, 2: 1, 3: 2}        # half-to-even: 2.5 -> 2
    lt = sorted(tuple(r) for r in cb.label_truth_long(truth, "row_id").collect())
    assert lt == [(1, "a", 1), (2, "a", 0)]


def test_mark_versions():
    assert cb.calibration_mark(False, None, False) == (False, None)
    assert cb.calibration_mark(True, None, False, method="isotonic") == (False, "isotonic")
    assert cb.calibration_mark(True, "/p/calib_v3.json", True) == (True, "calib_v3")


def test_triage_self_labelled_flags_nothing_and_flips_are_found(spark):
    import random
    rng = random.Random(0)
    rows = []
    for i in range(300):
        y = int(rng.random() < 0.4)
        p = min(1.0, max(0.0, 0.5 * y + 0.5 * rng.random()))
        given = 1 - y if i % 37 == 0 else y
        rows.append((i, "a", p, given))
    probs = spark.createDataFrame([(i, l, p) for i, l, p, _ in rows], "row_id bigint, label string, p double")
    given = spark.createDataFrame([(i, l, g) for i, l, _, g in rows], "row_id bigint, label string, y int")
    assert tr.find_label_issues(tr.hard_labels(probs, ["a"]), probs).count() == 0
    flagged = {r[0] for r in tr.find_label_issues(given, probs).collect()}
    assert flagged and len(flagged & {i for i in range(300) if i % 37 == 0}) >= len(flagged) // 2
    assert tr.find_label_issues(given, probs, engine="other").count() == 0


def test_calibrate_checks_the_pairing(spark):
    preds = spark.createDataFrame([(1, "k", 0.2), (2, "k", 0.7)], "row_id bigint, label string, p double")
    truth = spark.createDataFrame([(1, "k", 0)], "row_id bigint, label string, y int")
    twice = spark.createDataFrame([(1, "k", 0), (2, "k", 1), (2, "k", 1)], "row_id bigint, label string, y int")
    for wrong in (truth, twice):
        with pytest.raises(ValueError):
            cb.calibrate(preds, wrong, ["k"], on=["row_id"])


def test_isotonic_does_not_depend_on_pieces(spark):
    rows = [(i, "k", ((i * 37) % 200) / 200, int(((i * 37) % 200 + (i * 61) % 90) > 150)) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id bigint, label string, p double, y int")
    one = cb.fit(df.coalesce(1), ["k"]).first()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    many = cb.fit(df.repartition(9), ["k"]).first()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert one["x"] == many["x"] and one["y"] == many["y"] and one["y"] == sorted(one["y"])


def _curve(spark, n=600, labels=("k", "l")):
    rows = [(i, k, ((i * 37 + 11 * j) % 500) / 500, int(((i * 37) % 500 + (i * 61 * (j + 1)) % 230) > 380))
            for j, k in enumerate(labels) for i in range(n)]
    return spark.createDataFrame(rows, "row_id bigint, label string, p double, y int")


def _python_isotonic(rows):
    """Pool adjacent violators over (x, mean y) in order, and the interpolation between the knots."""
    by = {}
    for x, y in rows:
        s, n = by.get(x, (0, 0))
        by[x] = (s + y, n + 1)
    levels = []
    for x in sorted(by):
        levels.append([x, x, *by[x]])
        while len(levels) > 1 and levels[-2][2] * levels[-1][3] >= levels[-1][2] * levels[-2][3]:
            b = levels.pop()
            a = levels.pop()
            levels.append([a[0], b[1], a[2] + b[2], a[3] + b[3]])
    knots = [(x, s / n) for lo, hi, s, n in levels for x in ((lo,) if lo == hi else (lo, hi))]

    def value(v):
        if v <= knots[0][0]:
            return knots[0][1]
        for (x0, y0), (x1, y1) in zip(knots, knots[1:]):
            if v <= x1:
                return y0 if v == x0 else y1 if v == x1 else y0 + (v - x0) * (y1 - y0) / (x1 - x0)
        return knots[-1][1]
    return knots, value


@pytest.mark.parametrize("limit", [None, 0])
def test_bisection_and_range_merge_give_the_same_values(spark, limit):
    df = _curve(spark)
    params = cb.fit_segments(df, ["k", "l", "none"])
    probe = [(i, k, x) for i, x in enumerate([-0.5, 0.0, 0.0005, 0.3333, 0.5, 0.501, 0.9, 0.998, 1.0, 2.0, None])
             for k in ("k", "l", "none", None)] + [(100 + i, "k", 0.25) for i in range(500)]
    table = spark.createDataFrame(probe, "row_id bigint, label string, p double")
    got = {(r["row_id"], r["label"]): r["p"] for r in cb.apply(table, params, broadcast_knots=limit).collect()}
    assert len(got) == len(probe)
    fits = {k: _python_isotonic([(r["p"], r["y"]) for r in df.where(F.col("label") == k).collect()]) for k in ("k", "l")}
    for i, k, x in probe:
        want = x if k not in fits or x is None else fits[k][1](x)
        assert got[(i, k)] == (pytest.approx(want) if want is not None else None), (k, x)
    arrays = {r["key"]: list(zip(r["x"], r["y"])) for r in cb.as_arrays(params).where("method = 'isotonic'").collect()}
    assert arrays == {k: [(x, pytest.approx(y)) for x, y in fits[k][0]] for k in fits}


def test_platt_by_range(spark):
    params = cb.fit_segments(_pairs(spark), ["k"], method="platt")
    probe = spark.createDataFrame([(i, "k", i / 10) for i in range(11)], "row_id bigint, label string, p double")
    a = [r["p"] for r in cb.apply(probe, params).orderBy("row_id").collect()]
    b = [r["p"] for r in cb.apply(probe, params, broadcast_knots=0).orderBy("row_id").collect()]
    assert a == b and a == sorted(a)


def test_pooling_crosses_ranges(spark):
    """Falling truths: every level is pooled into one, through all ranges; rising ones keep theirs."""
    rows = [(i, "down", i / 300, int(i < 150)) for i in range(300)] + [(i, "up", i / 300, int(i >= 150)) for i in range(300)]
    df = spark.createDataFrame(rows, "row_id bigint, label string, p double, y int")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = {r["key"]: (r["x"], r["y"]) for r in cb.fit(df, ["down", "up"]).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got["down"] == ([0.0, 299 / 300], [0.5, 0.5])
    assert got["up"] == ([0.0, 149 / 300, 0.5, 299 / 300], [0.0, 0.0, 1.0, 1.0])


def test_probabilities_are_not_shuffled_by_label(spark):
    df = _curve(spark)
    params = cb.fit_segments(df, ["k", "l"])
    for limit in (None, 0):
        out = cb.apply(df, params, broadcast_knots=limit)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(label" not in plan and "hashpartitioning(_by" not in plan
        if limit is None:                       # the bisection is computed once a row
            assert plan.split("Initial Plan")[0].count("aggregate(sequence") == 1


def test_object_form_of_parameters(spark, tmp_path):
    (tmp_path / "hand.json").write_text("""{
  "overall": {"method": "isotonic", "x": [0.1, 0.5, 0.9], "y": [0.0, 0.4, 1.0]},
  "a": {"method": "platt", "coef": [2.0], "intercept": [-1.0]},
  "b": {"method": "identity"}
}""")
    params = cb.load_params_object(spark, str(tmp_path / "hand.json"))
    probe = spark.createDataFrame([(1, "overall", 0.3), (2, "overall", 0.0), (3, "a", 0.5), (4, "b", 0.7), (5, "c", 0.2)],
                                  "row_id bigint, label string, p double")
    got = {r["row_id"]: r["p"] for r in cb.apply(probe, params).collect()}
    assert got == {1: pytest.approx(0.2), 2: 0.0, 3: pytest.approx(0.5), 4: 0.7, 5: 0.2}
    cb.save_params_object(params, str(tmp_path / "again"))
    back = {r["key"]: r for r in cb.load_params_object(spark, str(tmp_path / "again")).collect()}
    assert back["overall"]["x"] == [0.1, 0.5, 0.9] and back["a"]["coef"] == 2.0 and back["b"]["method"] == "identity"


def test_pairing_checked_in_the_plan(spark):
    preds = spark.createDataFrame([(1, "k", 0.2), (2, "k", 0.7)], "row_id bigint, label string, p double")
    truth = spark.createDataFrame([(1, "k", 0), (2, "k", 1)], "row_id bigint, label string, y int")
    on = ["row_id", "label"]
    assert sorted(map(tuple, cb.pair_with_truth(preds, truth, on, check="plan").select("row_id", "p", "y").collect())) == [(1, 0.2, 0), (2, 0.7, 1)]
    for p, t in ((preds, truth.limit(1)), (preds.limit(1), truth), (preds, truth.union(truth)), (preds.union(preds), truth)):
        with pytest.raises(ValueError), cb.pairing_errors():
            cb.pair_with_truth(p, t, on, check="plan").select("y").collect()


def test_asof_backward(spark):
    import random as rnd
    from corpusforge.operators.asof import asof_backward
    rng = rnd.Random(5)
    right = sorted({(k, rng.randrange(1000)) for k in ("a", "b", "c") for _ in range(40)}) + [("solo", 3)]
    left = [(i, rng.choice(["a", "a", "a", "b", "c", "d", None]), rng.choice([None, rng.randrange(1100), 500])) for i in range(2000)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        out = asof_backward(spark.createDataFrame(left, "id int, k string, t int"), spark.createDataFrame(right, "k string, rt int"),
                            by="k", on="t", right_on="rt")
        got = {r["id"]: (r["asof"]["rt"] if r["asof"] else None) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = {i: max((t for kk, t in right if kk == k and x is not None and t <= x), default=None) for i, k, x in left}
    assert got == want


def test_labels_of_all_rows(spark):
    probs = spark.createDataFrame([(1, "a", 0.1), (2, "b", 0.2), (3, None, 0.5)], "row_id bigint, label string, p double")
    assert tr.detect_labels(probs) == ["a"] and tr.detect_labels(probs, every=True) == ["a", "b"]
    assert tr.detect_labels(probs.limit(0), every=True) == []

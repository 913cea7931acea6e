"""Linear fits against MLlib and the optimality conditions; boosted trees against plain Python, with constraints that must hold."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Matrices
from pyspark.sql import functions as F

from panelkit.operators.boosting import BoostedTrees, TreeSetting, best_split, bin_rows, grow_all, leaf_weight
from panelkit.operators.metrics import discrimination
from panelkit.operators.penalised import fit_all
from panelkit.plans.modelling import (C_GRID, TREE_GRID, coefficient_table, expanding_folds, fit_levels, monotonicity, optimality, random_settings,
                                      search_logreg, train_logreg, train_trees)


def linear_rows(spark, n=600, folds=2, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)) @ np.array([[1, .6, 0, 0], [0, .8, 0, 0], [0, 0, 1, .2], [0, 0, 0, 1]])
    y = (rng.random(n) < 1 / (1 + np.exp(-(x @ [1.5, -1, 0.2, 0] - 0.4)))).astype(float)
    return spark.createDataFrame([(i % folds, x[i].tolist(), float(y[i])) for i in range(n)], "fold int, x array<double>, y double").repartition(3)


def by_mllib(rows, c, l1, bounds=None):
    model = LogisticRegression(labelCol="y", regParam=1 / (c * rows.count()), elasticNetParam=l1, standardization=False, maxIter=2000, tol=1e-9)
    if bounds:
        model = model.setLowerBoundsOnCoefficients(Matrices.dense(1, 4, [b[0] for b in bounds])).setUpperBoundsOnCoefficients(
            Matrices.dense(1, 4, [b[1] for b in bounds]))
    fit = model.fit(rows.withColumn("features", array_to_vector("x")))
    return np.r_[fit.coefficients.toArray(), fit.intercept]


def test_all_penalties_equal_single_fits(spark):
    rows = linear_rows(spark)
    settings = [(c, l1) for c in (C_GRID[0], 0.1, 10.0) for l1 in (0.0, 0.5, 1.0)]
    found = fit_all(rows, settings, 4)
    assert sorted(found) == [0, 1] and all(f.converged for fits in found.values() for f in fits)
    assert max(f.passes for fits in found.values() for f in fits) <= 15
    for fold, fits in found.items():
        part = rows.filter(F.col("fold") == fold).cache()
        for (c, l1), fit in zip(settings, fits):
            assert np.abs(by_mllib(part, c, l1) - np.r_[fit.coefficients, fit.intercept]).max() < 1e-4, (c, l1)


def test_bounds_equal_single_fits(spark):
    rows, inf = linear_rows(spark, folds=1), math.inf
    bounds = [(0.0, inf), (0.0, inf), (-inf, 0.0), (-inf, inf)]
    fit = fit_all(rows, [(1.0, 0.0)], 4, bounds)[0][0]
    assert np.abs(by_mllib(rows, 1.0, 0.0, bounds) - np.r_[fit.coefficients, fit.intercept]).max() < 1e-4
    assert fit.coefficients[1] == 0 and fit.coefficients[2] == 0 and fit.converged


def test_unfinished_and_empty_fits_say_so(spark):
    rows = linear_rows(spark, folds=1)
    assert not fit_all(rows, [(1.0, 0.0)], 4, max_passes=1)[0][0].converged
    assert fit_all(rows.limit(0), [(1.0, 0.0)], 4) == {}
    same = fit_all(rows.withColumn("y", F.lit(1.0)), [(1.0, 1.0)], 4, max_passes=8)[0][0]  # one class: the intercept has no end
    assert not same.converged and np.isfinite(same.coefficients).all()


def panel(spark, n=1500, seed=4):
    rng = np.random.default_rng(seed)
    x, z, m = rng.random(n), rng.random(n), rng.random(n)
    y = (rng.random(n) < 0.15 + 0.5 * x - 0.3 * (z > 0.4) + 0.2 * (m < 0.1)).astype(int)
    day = [dt.date(2023, 1 + i % 9, 1) for i in range(n)]
    return spark.createDataFrame([(str(i), float(x[i]), None if m[i] < 0.1 else float(z[i]), "ab"[i % 2], int(y[i]), day[i]) for i in range(n)],
                                 "loan_id string, x double, z double, c string, label int, d date")


def test_search_and_signs(spark):
    df = panel(spark)
    found = search_logreg(df, ["x", "z"], ["c"], "d", expanding_folds(df, "d", n_splits=2), grid=[0.01, 1.0])
    assert set(found["scores"]) == {(c, l1) for c in (0.01, 1.0) for l1 in (0.0, 1.0)} and not found["unconverged"]
    assert all(len(v) == 2 and min(v) > 0.5 for v in found["scores"].values()) and found["cv_auc"] == max(np.mean(v) for v in found["scores"].values())
    free = train_logreg(df, ["x", "z"], ["c"], {"x": 0.5, "z": 0.1}, 1.0, 0.0, directions={"x": 1, "z": 1})
    assert free.dropped[0] == "z" and max(r["unmet"] for r in optimality(free, df).collect()) < 1e-9
    held = train_logreg(df, ["x", "z"], ["c"], {}, 1.0, 0.5, directions={"x": 1, "z": 1}, signs="bounds")
    told = {r["feature"]: r for r in optimality(held, df, directions={"x": 1, "z": 1}).collect()}
    assert told["z"]["coefficient"] == 0 and told["z"]["slope"] > 0 and max(r["unmet"] for r in told.values()) < 1e-9
    assert max(r["unmet"] for r in optimality(held, df).collect()) > 1e-3  # without the bound it would move
    odds = {r["feature"]: r for r in coefficient_table(held, spark).collect()}
    assert odds["x"]["odds_ratio"] == pytest.approx(math.exp(told["x"]["coefficient"]))


# ---- boosted trees ----
def plain_leaf(g, h, s, low, high):
    pull = math.copysign(max(abs(g) - s.reg_alpha, 0), g)
    return min(max(-pull / (h + s.reg_lambda), low), high)


def plain_gain(g, h, w, s):
    return -(2 * g * w + (h + s.reg_lambda) * w * w + 2 * s.reg_alpha * abs(w))


def plain_tree(rows, g, h, s, signs, depth, low=-math.inf, high=math.inf):
    """A tree as nested tuples by trying every value of every feature as a cut, missing to either side."""
    total = plain_gain(sum(g), sum(h), plain_leaf(sum(g), sum(h), s, low, high), s)
    best = None
    for f in range(len(signs)) if depth else ():
        values = sorted({r[f] for r in rows if not math.isnan(r[f])})
        for cut in values[1:]:
            for missing_left in (False, True):
                left = [missing_left if math.isnan(r[f]) else r[f] < cut for r in rows]
                gl, hl = sum(a for a, k in zip(g, left) if k), sum(a for a, k in zip(h, left) if k)
                gr, hr = sum(g) - gl, sum(h) - hl
                if min(hl, hr) < s.min_child_weight:
                    continue
                wl, wr = plain_leaf(gl, hl, s, low, high), plain_leaf(gr, hr, s, low, high)
                gain = plain_gain(gl, hl, wl, s) + plain_gain(gr, hr, wr, s) - total
                if signs[f] * (wr - wl) >= 0 and gain > max(1e-6, s.gamma) and (best is None or gain > best[0] + 1e-9):
                    best = (gain, f, cut, missing_left, left, wl, wr)
    if best is None:
        return None
    _, f, cut, missing_left, left, wl, wr = best
    mid = (wl + wr) / 2
    bounds = {1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid))}.get(signs[f], ((low, high),) * 2)
    halves = []
    for side, w, (lo, hi) in ((True, wl, bounds[0]), (False, wr, bounds[1])):
        at = [k for k, inside in enumerate(left) if inside is side]
        child = plain_tree([rows[k] for k in at], [g[k] for k in at], [h[k] for k in at], s, signs, depth - 1, lo, hi)
        halves.append(w if child is None else child)
    return (f, cut, missing_left, *halves)


def told(tree, cuts, rate, node=0):
    f = int(tree.feature[node])
    if f < 0:
        return tree.value[node] / rate
    return f, cuts[f][tree.bin[node]], bool(tree.missing_left[node]), told(tree, cuts, rate, 2 * node + 1), told(tree, cuts, rate, 2 * node + 2)


def alike(a, b):
    if isinstance(a, tuple) and isinstance(b, tuple):
        return a[:2] == b[:2] and alike(a[3], b[3]) and alike(a[4], b[4])
    return not isinstance(a, tuple) and not isinstance(b, tuple) and abs(a - b) < 1e-9


def plain_value(tree, row):
    while isinstance(tree, tuple):
        f, cut, missing_left, left, right = tree
        tree = left if (missing_left if math.isnan(row[f]) else row[f] < cut) else right
    return tree


@pytest.mark.parametrize("setting, signs", [
    (TreeSetting(rounds=3, learning_rate=0.3, max_depth=3), [0, 0, 0]),
    (TreeSetting(rounds=3, learning_rate=0.5, max_depth=4, min_child_weight=2, reg_lambda=3, reg_alpha=0.3, gamma=0.2), [0, 0, 0]),
    (TreeSetting(rounds=4, learning_rate=0.5, max_depth=3), [-1, 1, 0]),
    (TreeSetting(rounds=2, learning_rate=1.0, max_depth=4, reg_lambda=0.1), [1, -1, 1])])
def test_trees_equal_plain_python(spark, setting, signs):
    rng = np.random.default_rng(11)
    n = 160
    x = np.column_stack([rng.integers(0, 12, n), rng.integers(0, 7, n), rng.integers(0, 2, n)]).astype(float)
    x[rng.random(n) < 0.15, 1] = np.nan
    y = (rng.random(n) < 0.2 + 0.04 * x[:, 0] + 0.2 * (x[:, 2] == 1)).astype(float)
    cuts = [sorted({v for v in x[:, f] if v == v})[1:] for f in range(3)]
    base = math.log(y.mean() / (1 - y.mean()))
    rows = spark.createDataFrame([(0, i * 7919, float(y[i]), x[i].tolist()) for i in range(n)], "fold int, r long, y double, x array<double>").repartition(3)
    fit = grow_all(bin_rows(rows, cuts, ["fold", "r", "y"]), [setting], {0: cuts}, signs, {0: base}, refresh=4)[0, 0]
    assert len(fit.trees) == setting.rounds
    margin = np.full(n, base)
    for tree in fit.trees:
        p = 1 / (1 + np.exp(-margin))
        expected = plain_tree(x.tolist(), (p - y).tolist(), (p * (1 - p)).tolist(), setting, signs, setting.max_depth)
        assert alike(told(tree, cuts, setting.learning_rate), expected)
        margin += setting.learning_rate * np.array([plain_value(expected, r) for r in x.tolist()])
    model = BoostedTrees(["a", "b", "c"], cuts, fit.trees, base, signs)
    assert np.abs(model.margins(x) - margin).max() < 1e-9


def test_settings_and_folds_do_not_touch_each_other(spark):
    rng = np.random.default_rng(5)
    rows = spark.createDataFrame([(i % 2, int(rng.integers(1 << 60)), float(rng.random() < 0.4), [float(rng.integers(20)), float(rng.integers(5))])
                                  for i in range(800)], "fold int, r long, y double, x array<double>")
    cuts = [[float(k) for k in range(1, 20)], [1.0, 2.0, 3.0, 4.0]]
    rows = bin_rows(rows, cuts, ["fold", "r", "y"])
    settings = [TreeSetting(rounds=4, max_depth=2), TreeSetting(rounds=3, max_depth=4, subsample=0.7, colsample=0.5)]
    base = {0: -0.3, 1: -0.5}
    both = grow_all(rows, settings, {0: cuts, 1: cuts}, [0, 0], base, refresh=5)
    for fold in (0, 1):
        alone = grow_all(rows.filter(F.col("fold") == fold), settings, {fold: cuts}, [0, 0], base, refresh=100)
        for i in (0, 1):
            for a, b in zip(both[fold, i].trees, alone[fold, i].trees):
                assert (a.feature == b.feature).all() and (a.bin == b.bin).all() and np.abs(a.value - b.value).max() < 1e-9
    half = both[0, 1].trees[0]
    assert len(set(half.feature[half.feature >= 0].tolist())) <= 1  # one of two columns a tree


def test_split_of_nothing():
    setting = TreeSetting()
    zeros = np.zeros((2, 4))
    assert best_split(zeros, zeros, [2, 0], [0], [0, 0], setting, -np.inf, np.inf) is None
    assert float(leaf_weight(0.0, 0.0, TreeSetting(reg_lambda=0))) == 0.0


def test_constraints_hold_against_the_data(spark):
    df = panel(spark)
    card = train_trees(df, df.filter("loan_id < '3'"), ["x", "z"], ["c"], "d", None, rounds=12, settings=[TreeSetting(max_depth=4, learning_rate=0.3)],
                       constraints={"x": -1, "z": 1, "c_a": 1}, patience=50)
    walked = {r["model_input"]: r for r in monotonicity(card, df, df, {"x": -1, "z": 1, "c_a": 1}, n_rows=120).collect()}
    assert {r["rows_violating"] for r in walked.values()} == {0.0} and len(walked) == 3
    free = train_trees(df, df.filter("loan_id < '3'"), ["x", "z"], ["c"], "d", None, rounds=12, settings=[TreeSetting(max_depth=4, learning_rate=0.3)],
                       constraints={}, patience=50)
    assert max(r["rows_violating"] for r in monotonicity(free, df, df, {"x": -1, "z": 1}, n_rows=120).collect()) > 0.5


def test_trees_are_as_good_as_mllib_s(spark):
    train, valid = panel(spark, 4000, 1), panel(spark, 2000, 2)
    card = train_trees(train, valid, ["x", "z"], ["c"], "d", expanding_folds(train, "d", n_splits=2), rounds=40,
                       settings=[TreeSetting(rounds=10, learning_rate=0.2, max_depth=d, min_child_weight=5) for d in (2, 3)], patience=15)
    assert len(card.hyper["searched"]) == 2 and card.hyper["rounds"] == int(np.argmax(card.hyper["validation_auc"])) + 1 == len(card.model.trees)
    ours = discrimination(card.transform(valid), "model_predictions", "label").first()["auc"]
    assert ours == pytest.approx(max(card.hyper["validation_auc"]))
    shaped = lambda df: VectorAssembler(inputCols=["x", "zz", "ca"], outputCol="features").transform(
        df.withColumns({"zz": F.coalesce("z", F.lit(0.5)), "ca": (F.col("c") == "a").cast("double")}))
    model = GBTClassifier(labelCol="label", maxIter=20, maxDepth=3, stepSize=0.2, seed=1).fit(shaped(train))
    theirs = discrimination(model.transform(shaped(valid)).withColumn("p", vector_to_array("probability")[1]), "p", "label").first()["auc"]
    assert ours > theirs - 0.01


def test_search_space_and_levels(spark):
    picks = random_settings(30)
    assert len({repr(p) for p in picks}) == 30 and set(TREE_GRID) == set(vars(picks[0]))
    assert all(getattr(p, k) in v for p in picks for k, v in TREE_GRID.items())
    assert len(random_settings(30, grid={"rounds": [1, 2], "gamma": [0, 1]})) == 4
    df = spark.range(30).selectExpr("CAST(id AS STRING) AS many", "IF(id % 3 = 0, NULL, CAST(id % 3 AS STRING)) AS few")
    assert fit_levels(df, ["few"]) == {"few": ["1", "2", "Unknown"]}
    with pytest.raises(ValueError):
        fit_levels(df, ["few", "many"], most=10)


def test_rows_travel_in_blocks(spark):
    """Passes of growing trees get no list for each row: rows are packed once, and all of them come back scored."""
    from panelkit.operators.boosting import pack, scored
    rng, n = np.random.default_rng(8), 500
    x = rng.random((n, 2))
    rows = spark.createDataFrame([(i % 2, i, float(x[i].sum() > 1), [float(x[i, 0]), None if i % 10 == 0 else float(x[i, 1])]) for i in range(n)],
                                 "fold int, r long, y double, x array<double>").repartition(3)
    cuts = [[0.3, 0.6], [0.5]]
    binned, sizes, base = bin_rows(rows, cuts, ["fold", "r", "y"]), {k: [2, 1] for k in (0, 1)}, {0: 0.1, 1: -0.2}
    blocks = pack(binned)
    assert "array" not in str(blocks.dtypes) and blocks.count() <= 6 and blocks.filter("m is not null").isEmpty()
    fits = grow_all(binned, [TreeSetting(rounds=3, max_depth=2), TreeSetting(rounds=2, max_depth=1)], {0: cuts, 1: cuts}, [0, 0], base, refresh=2)
    got = sorted((r["fold"], r["setting"], r["y"], round(r["p"], 12)) for r in scored(blocks, fits, sizes, base, 2).collect())
    wanted = []
    for (k, i), fit in fits.items():
        at = np.arange(n) % 2 == k
        some = np.where((np.arange(n) % 10 == 0)[:, None] & np.array([False, True]), np.nan, x)[at]
        z = BoostedTrees(["a", "b"], cuts, fit.trees, base[k], [0, 0]).margins(some)
        wanted += [(k, i, float(a), round(float(p), 12)) for a, p in zip(x[at].sum(axis=1) > 1, 1 / (1 + np.exp(-z)))]
    assert got == sorted(wanted)


def test_numbers_travel_in_blocks(spark):
    """Passes of linear fits read packed rows, all of them, and no list for each row."""
    from panelkit.operators.penalised import pack_numbers
    rows = linear_rows(spark)
    blocks = pack_numbers(rows, 4)
    assert "array" not in str(blocks.dtypes) and blocks.count() <= 6
    got = sorted((b["fold"], *r, y) for b in blocks.collect() for r, y in zip(np.frombuffer(b["x"]).reshape(-1, 4).tolist(), np.frombuffer(b["y"]).tolist()))
    assert got == sorted((r["fold"], *r["x"], r["y"]) for r in rows.collect())

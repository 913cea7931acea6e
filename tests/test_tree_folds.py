"""Boosted trees over folds that overlap: rows are read, counted and binned once for all folds, with each fold's own caps and cut points."""

import datetime
import math

import numpy as np
from pyspark.sql import functions as F

from panelkit.operators.boosting import Tree, TreeSetting, _joint, bin_folds, bin_rows, grow_all, pack, walk
from panelkit.operators.quantiles import collect_quantiles, quantiles_of_unions
from panelkit.plans import modelling
from panelkit.plans.modelling import WHOLE, _fold_months, _tree_folds, expanding_folds, fit_levels, train_trees
from panelkit.session import materialize


def months_of_rows(spark, n=900, seed=3):
    """Rows of nine months with gaps in every column: numbers are null or NaN, labels and dates null, keys come twice."""
    rng, rows = np.random.default_rng(seed), []
    for i in range(n):
        day = None if rng.random() < 0.05 else datetime.date(2024, 1 + int(rng.integers(9)), 5)
        x = [None if u < 0.1 else math.nan if u < 0.13 else float(v) for u, v in zip(rng.random(2), (rng.normal(), rng.integers(6)))]
        rows.append((str(i // 2), day, *x, str(rng.choice(["a", "b", "c"])) if rng.random() < 0.9 else None, None if rng.random() < 0.04 else int(rng.random() < 0.4)))
    return spark.createDataFrame(rows, "loan_id string, d date, x double, z double, c string, label int")


def plain(rows, name, position):
    """Caps as interpolated quantiles of the numbers, cut points as quantiles of the clipped numbers of labelled rows, NaN above all."""
    known = sorted(r[name] for r in rows if r[name] is not None and not math.isnan(r[name]))
    caps = [known[math.floor(p)] + (p - math.floor(p)) * (known[math.ceil(p)] - known[math.floor(p)]) for p in (q * (len(known) - 1) for q in (0.01, 0.99))]
    clipped = sorted(caps[1] if math.isnan(r[name]) else min(max(r[name], caps[0]), caps[1]) for r in rows if r[name] is not None and r["label"] is not None)
    return caps, sorted({clipped[max(math.ceil(i / 64 * len(clipped)) - 1, 0)] for i in range(1, 64)})


def test_each_fold_has_its_own_caps_and_cuts(spark):
    df = materialize(months_of_rows(spark), "rows")
    levels, folds = fit_levels(df, ["c"]), expanding_folds(df, "d", n_splits=3, val_months=1)
    months = _fold_months(folds)
    made, rows = _tree_folds(df, ["x", "z"], ["c"], levels, "label", "d", months), df.collect()
    assert len(months) == 3 and set(made.cuts) == {0, 1, 2, WHOLE}
    for k in made.cuts:
        here = [r for r in rows if k == WHOLE or (r["d"] is not None and r["d"].replace(day=1) in months[k][0])]
        for i, name in enumerate(("x", "z")):
            caps, cuts = plain(here, name, i)
            assert np.allclose(made.preps[k].caps[name], caps, rtol=0, atol=1e-12) and np.allclose(made.cuts[k][i], cuts, rtol=0, atol=1e-12)
        known = [r for r in here if r["label"] is not None]
        for i, level in enumerate(levels["c"], 2):
            flags = sorted(float((r["c"] or "Unknown") == level) for r in known)
            assert made.cuts[k][i] == sorted({flags[max(math.ceil(j / 64 * len(flags)) - 1, 0)] for j in range(1, 64)})
        mean = sum(r["label"] for r in known) / len(known)
        assert math.isclose(made.base[k], math.log(mean / (1 - mean)), rel_tol=1e-12)


def test_blocks_of_all_folds_equal_rows_of_each(spark):
    df = materialize(months_of_rows(spark), "rows")
    levels, months = fit_levels(df, ["c"]), _fold_months(expanding_folds(df, "d", n_splits=3, val_months=1))
    made = _tree_folds(df, ["x", "z"], ["c"], levels, "label", "d", months)
    for of, side in ((made.fitting, 0), (made.scoring, 1)):
        of = {k: v for k, v in of.items() if k != WHOLE}
        got = []
        for b in pack(made.blocks(df, of, "label", "loan_id")).collect():
            r = np.frombuffer(b["r"], dtype=np.int64)
            assert len(b["y"]) == len(r)  # a byte a label
            got += [(b["fold"], int(key), int(y), bytes(x)) for key, y, x in zip(r, b["y"], np.frombuffer(b["bins"], dtype=np.uint8).reshape(-1, len(r)).T)]
        wanted = []
        for k, sides in enumerate(months):
            prep = made.preps[k]
            rows = prep.encoded(df.filter(F.trunc("d", "MM").isin(sides[side])).filter("label IS NOT NULL")).select(
                F.xxhash64("loan_id").alias("r"), F.col("label").cast("double").alias("y"), F.array(*[F.col(f"x_{c}") for c in prep.inputs]).alias("x"))
            wanted += [(k, r["r"], int(r["y"]), bytes(r["bins"])) for r in bin_rows(rows, made.cuts[k], ["r", "y"]).collect()]
        assert sorted(got) == sorted(wanted) and wanted


def test_search_reads_its_rows_once(spark, monkeypatch):
    """However many folds there are, one pass over the training rows makes the rows of all of them."""
    df, scans = materialize(months_of_rows(spark), "rows"), []

    def watched(rows, *args, **kwargs):
        scans.append(rows._jdf.queryExecution().executedPlan().toString().count("FileScan"))
        return grow_all(rows, *args, **kwargs)

    monkeypatch.setattr(modelling, "grow_all", watched)
    card = train_trees(df, df, ["x", "z"], ["c"], "d", expanding_folds(df, "d", n_splits=3, val_months=1), rounds=2,
                       settings=[TreeSetting(rounds=2, max_depth=d, subsample=s) for d, s in ((1, 1.0), (2, 0.7))], patience=5)
    assert len(card.hyper["searched"][0][1]) == 3 and scans == [1, 1]


def test_quantiles_of_unions_by_slices(spark):
    df = materialize(months_of_rows(spark).withColumn("p", F.expr("CAST(loan_id AS INT) % 4")), "rows")
    unions, probs = {7: {0}, 8: {0, 1, 2}, 9: {0, 1, 2, 3}, 10: set()}, [0.01, 0.25, 0.5, 0.99]
    for interpolate in (True, False):
        for edges in ({"x": [-0.5, 0.0, 0.1, 0.7], "z": [1.0, 3.0]}, {"x": [], "z": []}):
            found = quantiles_of_unions(df, ["x", "z"], probs, "p", unions, interpolate, edges)
            for u, parts in unions.items():
                assert found[u] == collect_quantiles(df.filter(F.col("p").isin(sorted(parts))), ["x", "z"], probs, interpolate)


def test_nodes_by_bits_equal_walks_of_rows():
    rng = np.random.default_rng(4)
    for _ in range(60):
        depth, n, cuts, known = int(rng.integers(1, 9)), 203, rng.integers(1, 64, 4), {}
        bins = np.column_stack([rng.integers(0, c + 2, n) for c in cuts]).astype(np.uint8)
        for _ in range(2):
            tree, reached = Tree.empty(depth), [0]
            for node in range(2 ** depth - 1):
                if node in reached and rng.random() < 0.75:
                    f = int(rng.integers(4))
                    tree.feature[node], tree.bin[node], tree.missing_left[node] = f, rng.integers(cuts[f]), rng.random() < 0.4
                    reached += [2 * node + 1, 2 * node + 2]
            wanted = []
            for row in bins:
                at = 0
                while (f := tree.feature[at]) >= 0:
                    at = 2 * at + 1 + int(not tree.missing_left[at] if row[f] > cuts[f] else row[f] > tree.bin[at])
                wanted.append(at)
            assert walk(*tree.steps(), bins, cuts, known).tolist() == wanted == tree.nodes(np.asfortranarray(bins), cuts).tolist()


def test_features_summed_together(spark):
    """Sums of features with few bins are taken by their joint value; trees are the same as with each feature by itself."""
    assert _joint([2, 2, 63, 2, 2, 2], range(6)) == [[0, 1, 3, 4], [5], [2]] and _joint([2, 0, 3], {0, 2}) == [[0, 2]]
    rng, n = np.random.default_rng(9), 1500
    x = np.column_stack([*[rng.integers(0, 2, n) for _ in range(5)], rng.random(n)]).astype(float)
    x[rng.random((n, 6)) < 0.1] = np.nan
    y = (rng.random(n) < 0.3 + 0.2 * (x[:, 0] == 1) + 0.2 * (x[:, 4] == 0) * (x[:, 5] > 0.4)).astype(float)
    cuts = [*[[0.0, 1.0]] * 5, [i / 30 for i in range(1, 30)]]
    rows = spark.createDataFrame([(1, 0, i * 7919, float(y[i]), *x[i].tolist()) for i in range(n)],
                                 "__part int, fold int, r long, y double, " + ", ".join(f"x{i} double" for i in range(6))).repartition(3)
    blocks = bin_folds(rows, {0: [f"x{i}" for i in range(6)]}, {0: cuts}, {0: {1}})
    single = bin_rows(rows.withColumn("x", F.array(*[f"x{i}" for i in range(6)])), cuts, ["fold", "r", "y"])
    settings = [TreeSetting(rounds=3, max_depth=3, subsample=s, colsample=c) for s, c in ((1.0, 1.0), (0.7, 0.6))]
    fits = [grow_all(t, settings, {0: cuts}, [0] * 6, {0: -0.2}, refresh=4) for t in (blocks, single)]
    for i in (0, 1):
        for a, b in zip(*(f[0, i].trees for f in fits)):
            assert (a.feature == b.feature).all() and (a.bin == b.bin).all() and np.abs(a.value - b.value).max() < 1e-9
    first, base = fits[0][0, 0].gains[0][0], 1 / (1 + math.exp(0.2))
    left = [bool(b) if not math.isnan(v) else first["missing_left"] for v in x[:, first["feature"]] for b in [v < cuts[first["feature"]][first["bin"]]]]
    assert math.isclose(first["left"][0], sum(base - v for v, inside in zip(y, left) if inside), rel_tol=1e-9)

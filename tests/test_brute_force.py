"""Distributed operators against direct computation, with ties, nulls and one key holding a third of the rows."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelkit.operators.asof import asof_join
from panelkit.operators.drift import binned, contingency, decile_edges, evidence, information_value, psi, shares
from panelkit.operators.impute import median_fill
from panelkit.operators.lookback import history_mean, lookback
from panelkit.operators.metrics import calibration, discrimination
from panelkit.operators.profile import (column_profile, explained_variance, label_correlations, mode_of, spearman_lookup,
                                        spearman_matrix, top_value_share, vif, vif_elimination)
from panelkit.operators.quantiles import collect_quantiles, exact_quantiles
from panelkit.operators.ranking import average_ranks, distinct_values, running_totals
from panelkit.operators.selection import selection_report

D = dt.date
FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def skewed(n=3000, seed=7):
    """Rows of 40 keys, one of which holds a third; scores with ties."""
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 40, n))
    score = np.round(rng.random(n), 2) * np.where(rng.random(n) < 0.3, 0, 1)
    label = (rng.random(n) < 0.2 + 0.5 * score).astype(int)
    return pd.DataFrame({"key": key, "score": score, "label": label, "value": np.where(rng.random(n) < 0.1, np.nan, rng.normal(size=n))})


def brute_auc(y, p):
    ranks = pd.Series(p).rank().to_numpy()
    bad = y.sum()
    good = len(y) - bad
    return None if not bad or not good else (ranks[y == 1].sum() - bad * (bad + 1) / 2) / (bad * good)


def brute_curve(y, p):
    cuts = np.unique(p)[::-1]
    return cuts, [((p >= c) & (y == 1)).sum() / (y == 1).sum() for c in cuts], [((p >= c) & (y == 0)).sum() / (y == 0).sum() for c in cuts]


def test_discrimination_per_key(spark):
    pdf = skewed()
    found = {r["key"]: r for r in discrimination(spark.createDataFrame(pdf), "score", "label", ["key"], threshold=0.5).collect()}
    assert len(found) == pdf.key.nunique()
    for k, g in pdf.groupby("key"):
        y, p = g.label.to_numpy(), g.score.to_numpy()
        cuts, tpr, fpr = brute_curve(y, p)
        gap = np.array(tpr) - np.array(fpr)
        assert found[k]["auc"] == pytest.approx(brute_auc(y, p))
        assert found[k]["ks"] == pytest.approx(max(gap.max(), 0))
        if gap.max() > 0:
            assert found[k]["youden_threshold"] == pytest.approx(cuts[np.argmax(gap)])
        assert found[k]["brier"] == pytest.approx(((p - y) ** 2).mean())
        flag = p >= 0.5
        assert found[k]["recall"] == pytest.approx((flag & (y == 1)).sum() / y.sum())


@FEW
@given(st.lists(st.tuples(st.sampled_from([0.0, 0.25, 0.5, 0.75, 1.0]), st.integers(0, 1)), min_size=4, max_size=40))
def test_auc_of_reversed_score(spark, pairs):
    df = spark.createDataFrame(pairs, "score double, label int")
    a = discrimination(df, "score", "label").first()
    b = discrimination(df.withColumn("score", 1 - F.col("score")), "score", "label").first()
    if a["auc"] is None:
        assert b["auc"] is None and a["ks"] is None
    else:
        assert a["auc"] == pytest.approx(1 - b["auc"])
        assert a["gini"] == pytest.approx(2 * a["auc"] - 1)


def test_running_totals_do_not_depend_on_slices(spark):
    df = spark.createDataFrame(skewed())
    made = []
    for edges in ([], [0.0], list(np.linspace(-3, 3, 25))):
        base = distinct_values(df, ["value"], ["key"], ["label"], edges={"value": edges})
        out = running_totals(base, ["key", "feature"], "value", ["n", "label"], "slice")
        made.append(sorted(map(tuple, out.select("key", "value", "n_before", "label_before", "n_total").collect())))
    assert made[0] == made[1] == made[2]


def test_null_keys_form_a_group(spark):
    df = spark.createDataFrame([(None, 0.1, 0), (None, 0.2, 1), ("a", 0.3, 1), ("a", 0.1, 0)], "k string, score double, label int")
    assert {r["k"]: r["auc"] for r in discrimination(df, "score", "label", ["k"]).collect()} == {None: 1.0, "a": 1.0}
    medians = {r["k"]: r["value"] for r in exact_quantiles(df, ["score"], [0.5], ["k"]).collect()}
    assert medians == {None: pytest.approx(0.15), "a": pytest.approx(0.2)}


@pytest.mark.parametrize("interpolate", [True, False])
def test_quantiles_per_key(spark, interpolate):
    pdf = skewed()
    probs = [0.0, 0.01, 0.1, 0.5, 0.9, 1.0]
    found = {(r["key"], r["feature"], r["prob"]): r["value"] for r in exact_quantiles(
        spark.createDataFrame(pdf).replace(float("nan"), None), ["value", "score"], probs, ["key"], interpolate,
        edges={"value": list(np.linspace(-2, 2, 17)), "score": [0.1, 0.5]}).collect()}
    for k, g in pdf.groupby("key"):
        for c in ("value", "score"):
            v = g[c].dropna().sort_values().to_numpy()
            for p in probs:
                want = np.quantile(v, p) if interpolate else v[max(math.ceil(p * len(v)) - 1, 0)]
                assert found[(k, c, p)] == pytest.approx(want), (k, c, p)


@FEW
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6)), min_size=1, max_size=50), st.floats(0, 1))
def test_quantile_property(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    clean = [v for v in values if v is not None]
    found = collect_quantiles(df, ["v"], [p])["v"]
    assert found == ([] if not clean else [pytest.approx(np.quantile(clean, p), abs=1e-6)])


def test_average_ranks(spark):
    pdf = skewed()
    found = {r["value"]: r["avg_rank"] for r in average_ranks(spark.createDataFrame(pdf), ["score"]).collect()}
    assert found == dict(zip(pdf.score, pdf.score.rank()))


def brute_bins(s, inner):
    return s.map(lambda v: "__MISSING__" if pd.isna(v) else str(sum(v > e for e in inner)))


def test_iv_psi_and_woe(spark):
    pdf = skewed()
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    edges = decile_edges(df, ["value", "score"])
    for f in ("value", "score"):
        want = np.unique(np.quantile(pdf[f].dropna(), np.linspace(0, 1, 11)))[1:-1]
        assert edges[f] == pytest.approx(list(want))
    iv = {r["feature"]: r["iv"] for r in information_value(contingency(binned(df, edges, keep=["label"]), "label")).collect()}
    bins = {f: brute_bins(pdf[f], edges[f]) for f in edges}
    for f, b in bins.items():
        tab = pd.crosstab(b, pdf.label).reindex(columns=[0, 1], fill_value=0)
        good, bad = (tab[0] + 0.5) / (tab[0].sum() + 0.5), (tab[1] + 0.5) / (tab[1].sum() + 0.5)
        assert iv[f] == pytest.approx(((bad - good) * np.log(bad / good)).sum())
    later = df.filter("key <> 0")
    found = {r["feature"]: r["psi"] for r in psi(shares(binned(df, edges)), shares(binned(later, edges))).collect()}
    for f, b in bins.items():
        e, a = b.value_counts(normalize=True), b[pdf.key != 0].value_counts(normalize=True)
        idx = e.index.union(a.index)
        e, a = e.reindex(idx, fill_value=0) + 1e-4, a.reindex(idx, fill_value=0) + 1e-4
        assert found[f] == pytest.approx(((a - e) * np.log(a / e)).sum())
    same = psi(shares(binned(df, edges)), shares(binned(df, edges))).collect()
    assert all(r["psi"] == pytest.approx(0.0) for r in same)
    woe = evidence(contingency(binned(df, {}, ["key"], keep=["label"]), "label"))
    assert woe.count() == pdf.key.nunique()


def test_psi_with_levels_on_one_side(spark):
    e = spark.createDataFrame([("f", "a", 0.5), ("f", "b", 0.5)], "feature string, bin string, share double")
    a = spark.createDataFrame([(1, "f", "a", 0.5), (1, "f", "c", 0.5), (2, "f", "a", 0.5), (2, "f", "b", 0.5)], "m int, feature string, bin string, share double")
    found = {r["m"]: r["psi"] for r in psi(e, a, ["m"]).collect()}
    assert found[2] == pytest.approx(0.0)
    assert found[1] == pytest.approx(2 * 0.5 * math.log(0.5001 / 0.0001))


def events(n=1500, seed=3):
    rng = np.random.default_rng(seed)
    start = dt.date(2024, 1, 1)
    who = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 25, n))
    return pd.DataFrame({"who": [f"c{w}" for w in who], "day": [start + dt.timedelta(int(d)) for d in rng.integers(0, 200, n)],
                         "fe_1": rng.normal(size=n).round(3), "fe_2": np.where(rng.random(n) < 0.2, np.nan, rng.integers(0, 9, n))})


def test_lookback_deviation_far_from_zero(spark):
    pdf = pd.DataFrame({"who": 1, "day": [dt.date(2024, 1, 1 + k % 20) for k in range(4000)], "fe_1": [1e9 + 0.001 * (k % 7) for k in range(4000)]})
    keys = spark.createDataFrame([(1, dt.date(2024, 1, 25))], "who long, at date")
    for rollup in (False, True):
        made = lookback(spark.createDataFrame(pdf), keys, ["who"], "day", "at", ["fe_1"], (30,), ("std",), trend=None, dedupe=False, rollup=rollup).first()
        assert made["fe_1_std_30d"] == pytest.approx(pdf.fe_1.std(), rel=1e-3), rollup


@pytest.mark.parametrize("stats, rollup", [(("mean", "max", "min", "std"), True), (("mean", "max", "min", "std"), False),
                                           (("mean", "median", "max", "min", "std"), True)])
def test_lookback_against_pandas(spark, stats, rollup):
    pdf = events()
    keys = pdf[["who", "day"]].drop_duplicates().sample(200, random_state=1).rename(columns={"day": "at"})
    made = lookback(spark.createDataFrame(pdf).replace(float("nan"), None), spark.createDataFrame(keys), ["who"], "day", "at", ["fe_1", "fe_2"],
                    (30, 60, 90), stats, latest=True, rollup=rollup).toPandas().set_index(["who", "at"])
    seen = 0
    for _, k in keys.iterrows():
        before = pdf[pdf.who == k["who"]].assign(days=lambda d: [(k["at"] - x).days for x in d.day])
        before = before[before.days > 0].drop_duplicates()
        if before.empty:
            assert (k["who"], k["at"]) not in made.index
            continue
        r = made.loc[(k["who"], k["at"])]
        seen += 1
        for w in (30, 60, 90):
            part = before[before.days <= w]
            assert (0 if pd.isna(r[f"click_count_{w}d"]) else r[f"click_count_{w}d"]) == len(part)
            for c in ("fe_1", "fe_2"):
                for s in stats:
                    v = part[c].dropna()
                    if s == "median":
                        want = v.sort_values().iloc[(len(v) + 1) // 2 - 1] if len(v) else np.nan
                    else:
                        want = getattr(v, s)() if len(v) else np.nan
                    assert r[f"{c}_{s}_{w}d"] == pytest.approx(want, abs=1e-7, nan_ok=True), (s, w, c)
        a, b = before[before.days <= 30].fe_1.mean(), before[(before.days > 30) & (before.days <= 60)].fe_1.mean()
        assert r["fe_1_trend_30d"] == pytest.approx(a - b, abs=1e-9, nan_ok=True)
        assert r["fe_1_latest"] in set(before[before.days == before.days.min()].fe_1)
    assert seen > 150


def test_history_mean_against_pandas(spark):
    pdf = events(600)
    keys = pdf[["who", "day"]].drop_duplicates().head(120).rename(columns={"day": "at"})
    found = {(r["who"], r["at"]): r["fe_1_hist_mean"] for r in history_mean(
        spark.createDataFrame(pdf), spark.createDataFrame(keys), ["who"], "day", "at", ["fe_1"]).collect()}
    for _, k in keys.iterrows():
        part = pdf[(pdf.who == k["who"]) & (pdf.day < k["at"])]
        if len(part):
            assert found.pop((k["who"], k["at"])) == pytest.approx(part.fe_1.mean())
    assert not found


@pytest.mark.parametrize("slices", [1, None, 100])
@pytest.mark.parametrize("strict", [True, False])
def test_asof_against_pandas(spark, slices, strict):
    pdf = events(800)
    left = pdf[["who", "day"]].assign(row=range(len(pdf)))
    right = pdf.sample(150, random_state=2).rename(columns={"day": "known"})[["who", "known", "fe_1"]].drop_duplicates(["who", "known"])
    found = {r["row"]: r["fe_1"] for r in asof_join(spark.createDataFrame(left), spark.createDataFrame(right), ["who"], "day", "known",
                                                    ["fe_1"], strict, slices).collect()}
    assert len(found) == len(left)
    for _, k in left.iterrows():
        part = right[(right.who == k["who"]) & ((right.known < k["day"]) if strict else (right.known <= k["day"]))]
        assert found[k["row"]] == (None if part.empty else part.sort_values("known").fe_1.iloc[-1])


def test_spearman_with_nulls(spark):
    pdf = skewed(800)[["score", "value"]].assign(third=lambda d: d.score * 2 + np.arange(len(d)) / 500)
    df = spark.createDataFrame(pdf).replace(float("nan"), None)

    def brute(a, b):
        both = pdf[[a, b]].dropna()
        return np.corrcoef(both[a].rank(), both[b].rank())[0, 1]

    pair = spearman_lookup(df, list(pdf.columns))
    for a, b in (("score", "value"), ("score", "third"), ("value", "third")):
        assert pair(a, b) == pytest.approx(brute(a, b))
    assert spearman_matrix(df, ["score", "third"])[0, 1] == pytest.approx(brute("score", "third"))


def test_profile_and_correlations(spark):
    pdf = skewed(1000)
    df = spark.createDataFrame(pdf).replace(float("nan"), None).withColumn("flat", F.lit(2.0))
    r = {x["feature"]: x for x in column_profile(df, ["value", "score"]).collect()}
    for c in ("value", "score"):
        assert r[c]["skew"] == pytest.approx(pdf[c].skew())
        lo, hi = pdf[c].quantile(0.01), pdf[c].quantile(0.99)
        assert (r[c]["p01"], r[c]["p99"]) == (pytest.approx(lo), pytest.approx(hi))
        assert r[c]["share_outside_p01_p99"] == pytest.approx(((pdf[c] < lo) | (pdf[c] > hi)).mean())
    found = {x["feature"]: x["correlation"] for x in label_correlations(df, ["value", "flat"], "label").collect()}
    both = pdf[["value", "label"]].dropna()
    assert found == {"value": pytest.approx(np.corrcoef(both.value, both.label)[0, 1]), "flat": None}
    filled = median_fill(df, ["value"]).toPandas()
    assert filled.value.isna().sum() == 0 and filled.value.median() == pytest.approx(pdf.value.median())


def test_collinearity(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=400), rng.normal(size=400)
    pdf = pd.DataFrame({"a": a, "b": b, "c": a + 0.05 * rng.normal(size=400)})
    df = spark.createDataFrame(pdf)
    found = vif(df, ["a", "b", "c"])
    for j in pdf:
        others = np.column_stack([np.ones(400), pdf.drop(columns=j)])
        fit = others @ np.linalg.lstsq(others, pdf[j], rcond=None)[0]
        r2 = 1 - ((pdf[j] - fit) ** 2).sum() / ((pdf[j] - pdf[j].mean()) ** 2).sum()
        assert found[j] == pytest.approx(1 / (1 - r2), rel=1e-6)
    kept, _ = vif_elimination(df, ["a", "b", "c"])
    assert "b" in kept and len(kept) == 2
    ratios = [r["explained_variance"] for r in explained_variance(df, ["a", "b", "c"]).orderBy("component").collect()]
    want = np.sort(np.linalg.eigvalsh(pdf.corr()))[::-1] / 3
    assert ratios == pytest.approx(list(want))


def test_collinearity_of_constant_and_copied_columns(spark):
    rng = np.random.default_rng(6)
    a = rng.normal(size=200)
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": rng.normal(size=200), "copy": a * 3, "flat": 1.0}))
    found = vif(df, ["a", "b", "copy", "flat"])
    assert found["flat"] == found["a"] == found["copy"] == math.inf and found["b"] == pytest.approx(1.0, abs=0.1)
    assert len(vif_elimination(df, ["a", "b", "copy", "flat"])[0]) == 2


def test_selection_report(spark):
    rng = np.random.default_rng(11)
    n = 2000
    strong = rng.normal(size=n)
    pdf = pd.DataFrame({
        "label": (rng.random(n) < 1 / (1 + np.exp(-2 * strong))).astype(int), "strong": strong, "copy": strong * 2 + 0.001 * rng.normal(size=n),
        "noise": rng.normal(size=n), "empty": np.where(rng.random(n) < 0.7, np.nan, strong), "constant": 1.0,
        "data_split": np.where(np.arange(n) < 1200, "train", np.where(np.arange(n) < 1600, "validation", "test")),
        "shifted": strong + np.where(np.arange(n) < 1200, 0, 4)})
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    roles = {c: "numeric" for c in ("strong", "copy", "noise", "empty", "constant", "shifted")}
    report = {r["feature"]: r for r in selection_report(df, roles).collect()}
    assert report["empty"]["drop_reason"] == "1 missing"
    assert report["constant"]["drop_reason"] == "2 near-constant"
    assert report["noise"]["drop_reason"] in ("3 IV", "")
    assert report["shifted"]["drop_reason"] == "4 PSI"
    kept = [f for f in ("strong", "copy") if report[f]["selected_xgb"]]
    assert len(kept) == 1
    other = ({"strong", "copy"} - set(kept)).pop()
    assert report[other]["drop_reason"] == f"5 |rho| with {kept[0]}"


def test_calibration_bins(spark):
    pdf = skewed(1000).assign(score=lambda d: np.random.default_rng(1).random(len(d)))
    found = sorted(tuple(r)[1:] for r in calibration(spark.createDataFrame(pdf), "score", "label").collect())
    cuts = np.quantile(pdf.score, np.linspace(0, 1, 11))
    at = np.searchsorted(cuts[1:-1], pdf.score)
    want = sorted((len(g), g.score.mean(), g.label.mean()) for _, g in pdf.groupby(at))
    assert [tuple(map(pytest.approx, w)) for w in want] == found


def test_mode_prefers_the_smallest(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", None), ("j", "z"), ("j", "z"), ("j", "a")], "k string, v string")
    assert dict(tuple(r) for r in mode_of(df, ["k"], "v").collect()) == {"k": "a", "j": "z"}


def busy_day(n=6000, seed=9):
    """Times of day of one key on one day, and a few rows of others over years."""
    rng = np.random.default_rng(seed)
    day = dt.datetime(2024, 5, 3)
    hot = [("hot", day + dt.timedelta(seconds=int(s)), float(v)) for s, v in zip(rng.integers(0, 86400, n // 3), rng.random(n))]
    rest = [(f"k{int(k)}", dt.datetime(2022, 1, 1) + dt.timedelta(hours=int(h)), float(v)) for k, h, v in
            zip(rng.integers(0, 200, n - n // 3), rng.integers(0, 24 * 1000, n), rng.random(n))]
    return pd.DataFrame(hot + rest, columns=["who", "at", "v"])


@pytest.mark.parametrize("on", [["who"], []])
def test_asof_of_a_busy_day(spark, on):
    right, left = busy_day().drop_duplicates(["who", "at"]), busy_day(seed=10).rename(columns={"at": "asked"}).drop(columns="v").assign(row=range(6000))
    if not on:
        right = right.sort_values(["at", "v"]).drop_duplicates("at", keep="last")
    made = asof_join(spark.createDataFrame(left).repartition(5), spark.createDataFrame(right).repartition(5), on, "asked", "at", ["v"], slices=32)
    found = {r["row"]: r["v"] for r in made.collect()}
    expected = pd.merge_asof(left.sort_values("asked"), right.sort_values("at"), left_on="asked", right_on="at", by=on or None, suffixes=("", "_r"))
    assert len(found) == 6000 and all((found[r.row] is None) if np.isnan(r.v) else found[r.row] == r.v for r in expected.itertuples())


def test_asof_slices_hold_alike_many_rows(spark):
    """A key with a third of all rows on one day is spread over about a third of the slices."""
    from panelkit.operators import asof
    frame = spark.createDataFrame(busy_day())
    seen = {}
    real = asof.with_slices

    def watch(df, edges):
        out = real(df, edges)
        seen["rows"] = [r["count"] for r in out.groupBy("who", "__n__slice").count().collect()]
        return out

    asof.with_slices = watch
    try:
        asof_join(frame.withColumnRenamed("at", "asked"), frame, ["who"], "asked", "at", ["v"], slices=32).count()
    finally:
        asof.with_slices = real
    assert max(seen["rows"]) < 12000 / 32 * 1.5


def test_asof_of_nulls_and_nothing(spark):
    left = spark.createDataFrame([("a", None), (None, D(2024, 1, 2)), ("a", D(2024, 1, 2)), ("a", D(2024, 1, 2))], "k string, d date")
    right = spark.createDataFrame([("a", D(2024, 1, 1), 1), ("a", D(2024, 1, 1), 2), ("a", None, 3), (None, D(2024, 1, 1), 4)], "k string, t date, v int")
    assert sorted((r["k"], r["d"], r["v"]) for r in asof_join(left, right, ["k"], "d", "t", ["v"]).collect() if r["k"] and r["d"]) == [
        ("a", D(2024, 1, 2), 2)] * 2
    assert [r["v"] for r in asof_join(left, right, ["k"], "d", "t", ["v"]).collect() if not (r["k"] and r["d"])] == [None, None]
    assert {r["v"] for r in asof_join(left, right.limit(0), ["k"], "d", "t", ["v"]).collect()} == {None}
    assert asof_join(left.limit(0), right, ["k"], "d", "t", ["v"]).collect() == []


@pytest.mark.parametrize("rollup", [False, True])
@pytest.mark.parametrize("few, sliced", [(3, True), (3, False), (10 ** 6, False)])
def test_window_medians_are_exact(spark, rollup, few, sliced, monkeypatch):
    from panelkit.operators import ranking
    if sliced:
        monkeypatch.setattr(ranking, "SMALL", 0)
    pdf = events(900)
    pdf.loc[pdf.index % 3 == 0, "who"] = pdf.who.iloc[0]
    keys = pdf[["who", "day"]].drop_duplicates().sample(60, random_state=1).rename(columns={"day": "at"})
    made = lookback(spark.createDataFrame(pdf).replace(float("nan"), None), spark.createDataFrame(keys), ["who"], "day", "at", ["fe_1"], (30, 90),
                    ("mean", "median"), trend=None, dedupe=False, rollup=rollup, few=few)
    seen = 0
    for r in made.collect():
        part = pdf[(pdf.who == r["who"]) & (pdf.day < r["at"])]
        days = part.day.map(lambda d: (r["at"] - d).days)
        for w in (30, 90):
            values = sorted(part[days <= w].fe_1.dropna())
            assert r[f"fe_1_median_{w}d"] == (values[-(-len(values) // 2) - 1] if values else None)
            seen += bool(values)
    assert seen > 60


def test_median_of_very_many_values(spark):
    rows = spark.range(45000, numPartitions=6).selectExpr("IF(id % 3 = 0, 'b', 'a') AS who", "date_add(DATE '2024-01-01', CAST(id % 28 AS INT)) AS day",
                                                          "CAST((id * 7919) % 45007 AS DOUBLE) AS v")
    key = spark.createDataFrame([("a", D(2024, 2, 1)), ("b", D(2024, 1, 2))], "who string, at date")
    found = {r["who"]: r["v_median_60d"] for r in lookback(rows, key, ["who"], "day", "at", ["v"], (60,), ("median",), trend=None, dedupe=False).collect()}
    told = rows.toPandas()
    a, b = sorted(told[told.who == "a"].v), sorted(told[(told.who == "b") & (told.day < D(2024, 1, 2))].v)
    assert len(a) > 10000 and found == {"a": a[-(-len(a) // 2) - 1], "b": b[-(-len(b) // 2) - 1]}


@pytest.mark.parametrize("sliced", [False, True])
def test_rank_correlation_of_all_pairs(spark, sliced, monkeypatch):
    from panelkit.operators import ranking
    from panelkit.operators.rankcorr import pairwise_spearman
    if sliced:
        monkeypatch.setattr(ranking, "SMALL", 0)
    rng = np.random.default_rng(12)
    n = 1500
    base = rng.normal(size=n)
    pdf = pd.DataFrame({"a": base, "b": np.round(base + rng.normal(size=n), 1), "c": np.where(rng.random(n) < 0.3, np.nan, -base + rng.normal(size=n)),
                        "d": np.where(rng.random(n) < 0.34, 0.0, rng.integers(0, 5, n)), "e": np.where(rng.random(n) < 0.5, np.nan, np.round(rng.random(n), 1)), "f": 7.0})
    found = pairwise_spearman(spark.createDataFrame(pdf).repartition(5).replace(float("nan"), None), list(pdf.columns))
    expected = pdf.corr("spearman").to_numpy()
    assert np.allclose(found, expected, atol=1e-12, equal_nan=True) and np.isnan(found[5]).all()
    with_nan = pairwise_spearman(spark.createDataFrame(pdf), ["c", "a"])
    assert np.allclose(with_nan, pdf[["c", "a"]].corr("spearman"), atol=1e-12)
    assert np.isnan(pairwise_spearman(spark.createDataFrame(pdf).limit(0), ["a", "b"])).all()


def test_top_values_from_a_small_summary(spark):
    rng = np.random.default_rng(13)
    n = 6000
    pdf = pd.DataFrame({"often": np.where(rng.random(n) < 0.4, "x", rng.integers(0, 3000, n).astype(str)), "unique": [f"v{k}" for k in range(n)],
                        "gone": [None if k % 3 else f"g{k}" for k in range(n)], "pairs": [f"p{k // 2}" for k in range(n)], "one": "z", "none": [None] * n,
                        "even": [f"e{k % 40}" for k in range(n)]})
    df = spark.createDataFrame(pdf, "often string, unique string, gone string, pairs string, one string, none string, even string").repartition(6)
    for tracked, candidates in ((64, 4), (8192, 32)):
        found = {r["feature"]: r["top_value_share"] for r in top_value_share(df, list(pdf.columns), tracked, candidates).collect()}
        assert found == {c: pytest.approx(pdf[c].value_counts(dropna=False).iloc[0] / n) for c in pdf.columns}
    assert [r["top_value_share"] for r in top_value_share(df.limit(0), ["often"]).collect()] in ([None], [])


def test_asof_rows_of_a_task_are_bounded(spark, monkeypatch):
    """More rows make more tasks of the ordered pass, not larger ones, and the same result."""
    from panelkit.operators import asof
    rng, n = np.random.default_rng(5), 4000
    left = spark.createDataFrame(pd.DataFrame({"who": rng.integers(0, 300, n), "asked": rng.integers(0, 1000, n), "row": np.arange(n)}))
    right = spark.createDataFrame(pd.DataFrame({"who": rng.integers(0, 300, n), "at": rng.integers(0, 1000, n), "v": rng.random(n)}))
    made = lambda: asof_join(left, right, ["who"], "asked", "at", ["v"], strict=True)
    plain = made()
    few = sorted(tuple(r) for r in plain.collect())
    monkeypatch.setattr(asof, "TASK_ROWS", 100)
    more = made()
    told = more._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in told and ", 80" in told and "RepartitionByExpression" not in plain._jdf.queryExecution().optimizedPlan().toString()
    assert few == sorted(tuple(r) for r in more.collect())

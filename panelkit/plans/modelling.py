"""Preprocessing, training, evaluation and scoring of scorecards and boosted trees."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.functions.dates import month_start
from panelkit.functions.encode import MOST_LEVELS, collected_levels, one_hot
from panelkit.functions.numeric import clip, signed_log
from panelkit.operators.boosting import (BINS, BoostedTrees, Growing, TreeSetting, bin_folds, bin_rows, fit_cuts, flag_cuts, grow_all, pack, refreshed, scored, stepped)
from panelkit.operators.drift import apply_woe, binned, contingency, evidence
from panelkit.operators.metrics import discrimination
from panelkit.operators.penalised import LinearModel, fit_all, unmet
from panelkit.operators.profile import sample_skewness, spearman_with_label
from panelkit.operators.quantiles import collect_quantiles, quantiles_of_unions
from panelkit.operators.ranking import slice_count, slice_edges
from panelkit.session import materialize
from panelkit.sources.sinks import write_table

# Prior sign of each feature's effect on default risk, and the search grids.
EXPECTED_DIRECTION = {
    "InterestRate_x_Debt": +1, "Delay_from_due_date": +1, "Num_Credit_Inquiries": +1,
    "Credit_History_Age_Years": -1, "Credit_Cards_imputed": +1, "Amount_invested_monthly": -1,
    "Age_imputed": -1, "Debt_per_Credit_Account": +1, "Annual_Income": -1, "Num_Fin_Pdts": +1,
    "Credit_Mix_Bad": +1, "Credit_Mix_Good": -1,
    "Payment_of_Min_Amount_Yes": +1, "Payment_of_Min_Amount_No": -1,
}
#: Most iterations of the linear solvers.
SOLVER_LIMIT = 5000
C_GRID = [10 ** (-3 + i / 2) for i in range(9)]
TREE_GRID = {"rounds": [200, 300, 500, 800], "learning_rate": [0.02, 0.05, 0.1], "max_depth": [2, 3, 4, 5], "min_child_weight": [1, 5, 10, 20],
             "subsample": [0.7, 0.8, 1.0], "colsample": [0.7, 0.8, 1.0], "reg_lambda": [1, 5, 10], "reg_alpha": [0, 0.1, 1], "gamma": [0, 0.5, 1]}
FREE = (-float("inf"), float("inf"))
#: Draws of the search, most rounds of the final fit, and rounds without a better validation AUC after which it stops.
DRAWS, MOST_ROUNDS, PATIENCE = 30, 3000, 100


# ---- preprocessing --------------------------------------------------------------------------------------------------
@dataclass
class LinearPrep:
    """Winsorise, signed log where skewed, median fill with indicator, standardise; categories by weight of evidence."""

    numeric: list[str]
    categorical: list[str]
    caps: dict[str, tuple[float, float]] = field(default_factory=dict)
    logged: set[str] = field(default_factory=set)
    medians: dict[str, float] = field(default_factory=dict)
    indicators: list[str] = field(default_factory=list)
    scales: dict[str, tuple[float, float]] = field(default_factory=dict)
    woe: DataFrame | None = None

    @property
    def inputs(self) -> list[str]:
        return [*self.numeric, *[f"{c}_missing" for c in self.indicators], *[f"{c}_woe" for c in self.categorical]]

    def shaped(self, name: str) -> Column:
        """A numeric column capped and, where fitted so, logged."""
        value = clip(F.col(name).cast("double"), *self.caps[name])
        return signed_log(value) if name in self.logged else value

    def unscaled(self, df: DataFrame) -> DataFrame:
        df = apply_woe(df, self.woe, self.categorical) if self.categorical else df
        return df.withColumns({
            **{f"x_{c}": F.coalesce(self.shaped(c), F.lit(self.medians[c])) for c in self.numeric},
            **{f"x_{c}_missing": F.col(c).isNull().cast("double") for c in self.indicators},
            **{f"x_{c}_woe": F.col(f"{c}_woe") for c in self.categorical}}).drop(*[f"{c}_woe" for c in self.categorical])

    def scaled(self, df: DataFrame) -> DataFrame:
        return self.unscaled(df).withColumns({f"x_{c}": (F.col(f"x_{c}") - m) / s for c, (m, s) in self.scales.items()})

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.scaled(df)
        assembler = VectorAssembler(inputCols=[f"x_{c}" for c in self.inputs], outputCol="features")
        return assembler.transform(out).drop(*[f"x_{c}" for c in self.inputs])


CAPPED = [0.01, 0.99]


def _pairs(cuts: Mapping[str, Sequence[float]]) -> dict[str, tuple[float, float]]:
    return {c: (v[0], v[1]) if len(v) == 2 else (0.0, 0.0) for c, v in cuts.items()}


def _caps(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    return _pairs(collect_quantiles(train, columns, CAPPED))


def fit_linear_prep(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str = "label",
                    skew_limit: float = 1.0) -> LinearPrep:
    """Each step is fitted on the output of the one before, as a few numbers per column."""
    prep = LinearPrep(list(numeric), list(categorical), caps=_caps(train, numeric))
    capped = train.select(*[prep.shaped(c).alias(c) for c in numeric])
    row = capped.agg(*[sample_skewness(c).alias(f"skew_{c}") for c in numeric],
                     *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}") for c in numeric]).first()
    prep.logged = {c for c in numeric if row[f"skew_{c}"] is not None and abs(row[f"skew_{c}"]) > skew_limit}
    prep.indicators = [c for c in numeric if row[f"null_{c}"] > 0]
    shaped = train.select(*[prep.shaped(c).alias(c) for c in numeric])
    middle = collect_quantiles(shaped, numeric, [0.5])
    prep.medians = {c: middle[c][0] if middle[c] else 0.0 for c in numeric}
    if categorical:
        long = binned(train, {}, categorical, keep=[label])
        prep.woe = materialize(evidence(contingency(long, label)).select("feature", "bin", "woe"), "woe")
    names = prep.inputs
    stats = prep.unscaled(train).agg(*[F.avg(f"x_{c}").alias(f"m_{i}") for i, c in enumerate(names)],
                                     *[F.stddev_pop(f"x_{c}").alias(f"s_{i}") for i, c in enumerate(names)]).first()
    prep.scales = {c: (stats[f"m_{i}"], stats[f"s_{i}"] or 1.0) for i, c in enumerate(names)}
    return prep


@dataclass
class TreePrep:
    """Winsorise, fill with the median (or leave missing if no median was fitted), one-hot of the training levels (an unseen level sets
    no column)."""

    numeric: list[str]
    categorical: list[str]
    caps: dict[str, tuple[float, float]]
    medians: dict[str, float]
    levels: dict[str, list[str]]

    @property
    def inputs(self) -> list[str]:
        flags = [n for c in self.categorical for n in one_hot(c, self.levels[c], f"{c}_")]
        return [*self.numeric, *flags]

    def number(self, name: str) -> Column:
        """A numeric column capped and filled."""
        return F.coalesce(clip(F.col(name).cast("double"), *self.caps[name]), F.lit(self.medians.get(name, float("nan"))))

    def encoded(self, df: DataFrame) -> DataFrame:
        made = {f"x_{c}": self.number(c) for c in self.numeric}
        for c in self.categorical:
            made.update({f"x_{n}": e.cast("double") for n, e in one_hot(f"f_{c}", self.levels[c], f"{c}_").items()})
        filled = df.withColumns({f"f_{c}": F.coalesce(F.col(c).cast("string"), F.lit("Unknown")) for c in self.categorical}) \
            if self.categorical else df
        return filled.withColumns(made).drop(*[f"f_{c}" for c in self.categorical])

    def transform(self, df: DataFrame) -> DataFrame:
        names = [f"x_{c}" for c in self.inputs]
        return VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep").transform(self.encoded(df)).drop(*names)


def fit_levels(train: DataFrame, categorical: Sequence[str], most: int = MOST_LEVELS) -> dict[str, list[str]]:
    """The levels of each category, in order, null as "Unknown"; raises if one has more than ``most``, as each becomes a column."""
    filled = train.fillna("Unknown", list(categorical)) if categorical else train
    return collected_levels(filled, {c: (c, None) for c in categorical}, most) if categorical else {}


def fit_tree_prep(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], fill: bool = True,
                  levels: Mapping[str, Sequence[str]] | None = None, most: int = MOST_LEVELS, caps: Mapping[str, tuple[float, float]] | None = None) -> TreePrep:
    """Caps, medians (if missing values are to be filled) and the levels of each category, which become model inputs; given levels and caps are
    taken as they are."""
    middle = collect_quantiles(train, numeric, [0.5]) if fill else {}
    known = fit_levels(train, categorical, most) if levels is None else {c: list(levels[c]) for c in categorical}
    return TreePrep(list(numeric), list(categorical), _caps(train, numeric) if caps is None else dict(caps), {c: v[0] if v else 0.0 for c, v in middle.items()}, known)


# ---- folds ----------------------------------------------------------------------------------------------------------
def expanding_folds(rows: DataFrame, date: str, n_splits: int = 4, val_months: int = 2) -> DataFrame:
    """Fold table (fold, month, part): fit on all earlier months, score the next ones, at least three fit months.

    Short histories use one-month folds. Built from the distinct months only.
    """
    months = rows.select(month_start(date).alias("month")).filter(F.col("month").isNotNull()).distinct()
    order = Window.partitionBy(F.lit(0)).orderBy("month")  # one row per month
    placed = months.withColumns({"pos": F.row_number().over(order) - 1,
                                 "total": F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))})
    short = F.col("total") < 3 + n_splits * val_months
    step = F.when(short, 1).otherwise(val_months)
    splits = F.when(short, F.greatest(F.lit(1), F.least(F.lit(n_splits), F.col("total") - 3))).otherwise(n_splits)
    folds = placed.withColumns({"step": step, "splits": splits}).withColumn(
        "left", F.explode(F.sequence(F.col("splits"), F.lit(1), F.lit(-1))))
    cut = F.col("total") - F.col("left") * F.col("step")
    made = folds.withColumn("cut", cut).filter(F.col("cut") >= 3)
    part = F.when(F.col("pos") < F.col("cut"), "fit").when(F.col("pos") < F.col("cut") + F.col("step"), "score")
    dense = F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy("cut"))
    return (made.withColumns({"part": part, "fold": dense}).filter(F.col("part").isNotNull())
            .select("fold", "month", "part"))


def _fold_months(folds: DataFrame) -> list[tuple[list, list]]:
    """Months that each fold fits on and scores."""
    bounds: dict[int, dict[str, list]] = {}
    for r in folds.collect():  # months times folds
        bounds.setdefault(r["fold"], {"fit": [], "score": []})[r["part"]].append(r["month"])
    return [(b["fit"], b["score"]) for _, b in sorted(bounds.items())]


def _fold_parts(train: DataFrame, date: str, folds: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    month = month_start(date)
    return [(train.filter(month.isin(fit)), train.filter(month.isin(score))) for fit, score in _fold_months(folds)]


# ---- linear model ---------------------------------------------------------------------------------------------------
@dataclass
class Scorecard:
    """A fitted model with its preprocessing, inputs and threshold."""

    name: str
    prep: LinearPrep | TreePrep
    model: object
    threshold: float = 0.5
    hyper: dict = field(default_factory=dict)
    dropped: list[str] = field(default_factory=list)

    @property
    def features(self) -> list[str]:
        return [*self.prep.numeric, *self.prep.categorical]

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``model_predictions``."""
        if isinstance(self.prep, TreePrep):
            names = [f"x_{c}" for c in self.prep.inputs]
            return self.prep.encoded(df).withColumn("model_predictions", 1 / (1 + F.exp(-self.model.margin(F.array(*names))))).drop(*names)
        margin = self.model.margin(vector_to_array("features"))
        return self.prep.transform(df).withColumn("model_predictions", 1 / (1 + F.exp(-margin))).drop("features")


def save_card(card: Scorecard, spark: SparkSession, path: str) -> None:
    """The model, its weight-of-evidence table and its fitted numbers."""
    prep = card.prep
    numbers = {k: v for k, v in vars(prep).items() if k != "woe"}
    if isinstance(prep, LinearPrep):
        numbers["logged"] = sorted(prep.logged)
        if prep.woe is not None:
            write_table(prep.woe, f"{path}/woe")
    if isinstance(card.model, LinearModel):
        meta_model = asdict(card.model)
    else:
        meta_model = None
        card.model.save(spark, f"{path}/model")
    meta = {"kind": type(prep).__name__, "model": meta_model, "prep": numbers, "name": card.name, "threshold": card.threshold, "hyper": card.hyper,
            "dropped": card.dropped, "has_woe": getattr(prep, "woe", None) is not None}
    write_table(spark.createDataFrame([(json.dumps(meta),)], "meta string"), f"{path}/meta")


def load_card(spark: SparkSession, path: str) -> Scorecard:
    """A saved scorecard."""
    meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
    numbers = meta["prep"]
    numbers["caps"] = {k: tuple(v) for k, v in numbers["caps"].items()}
    if meta["kind"] == "LinearPrep":
        numbers["logged"] = set(numbers["logged"])
        numbers["scales"] = {k: tuple(v) for k, v in numbers["scales"].items()}
        prep = LinearPrep(**numbers, woe=spark.read.parquet(f"{path}/woe") if meta["has_woe"] else None)
        model = LinearModel(**meta["model"])
    else:
        prep, model = TreePrep(**numbers), BoostedTrees.load(spark, f"{path}/model")
    return Scorecard(meta["name"], prep, model, meta["threshold"], meta["hyper"], meta["dropped"])


def _linear(prep: LinearPrep, train: DataFrame, label: str, c: float, l1: float, bounds: Sequence[tuple[float, float]] | None = None) -> LinearModel:
    """One fit on prepared rows; raises if it has not come to the optimum within the solver limit."""
    x, width = vector_to_array("features").alias("x"), len(prep.inputs)
    rows = prep.transform(train).select(F.lit(0).alias("fold"), x, F.col(label).cast("double").alias("y"))
    fit = fit_all(rows, [(c, l1)], width, bounds, 1e-12, SOLVER_LIMIT)[0][0]
    if not fit.converged:
        raise ValueError(f"not converged in {fit.passes} passes")
    return LinearModel(prep.inputs, fit.coefficients.tolist(), fit.intercept)


def search_logreg(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], date: str, folds: DataFrame,
                  label: str = "label", grid: Sequence[float] = C_GRID, penalties: Sequence[float] = (0.0, 1.0)) -> dict:
    """Penalty strength and type with the best mean AUC over the time folds.

    Preprocessing is fitted for each fold; the prepared rows of all folds are one table. All settings of all folds are fitted in the
    same passes over it (see ``fit_all``), and one more job ranks the held-out rows of all of them. ``unconverged`` lists
    (fold, C, l1) of fits that did not reach the optimum; ``rows`` and ``held`` are the prepared rows, ``fits`` the coefficients by fold.
    """
    settings = [(c, l1) for c in grid for l1 in penalties]
    fitting, scoring, preps = [], [], []
    for fold, (fit, score) in enumerate(_fold_parts(train, date, folds)):
        prep = fit_linear_prep(fit, numeric, categorical, label)
        preps.append(prep)
        for part, into in ((fit, fitting), (score, scoring)):
            into.append(prep.transform(part).select(F.lit(fold).alias("fold"), vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y")))
    width = len(preps[0].inputs)
    if any(len(p.inputs) != width for p in preps):  # a fold without missing values has fewer indicators; they are told apart by width
        widest = max(len(p.inputs) for p in preps)
        fitting, scoring = ([t.withColumn("x", F.concat("x", F.array_repeat(F.lit(0.0), widest - len(p.inputs)))) for t, p in zip(tables, preps)]
                            for tables in (fitting, scoring))
        width = widest
    rows = materialize(reduce(DataFrame.unionByName, fitting), "fold-fit")
    held = materialize(reduce(DataFrame.unionByName, scoring), "fold-score")
    fits = fit_all(rows, settings, width, max_passes=SOLVER_LIMIT)
    weights = train.sparkSession.createDataFrame(
        [(k, i, f.coefficients.tolist(), f.intercept) for k, found in fits.items() for i, f in enumerate(found)],
        "fold int, setting int, w array<double>, b double")  # one row a fit
    margin = sum((F.col("x")[i] * F.col("w")[i] for i in range(width)), F.col("b"))
    ranked = held.join(F.broadcast(weights), "fold").select("fold", "setting", "y", (1 / (1 + F.exp(-margin))).alias("p"))
    aucs = {(r["fold"], r["setting"]): r["auc"] for r in discrimination(ranked, "p", "y", ["fold", "setting"]).collect()}
    scores = {s: [0.5 if aucs.get((k, i)) is None else aucs[k, i] for k in sorted(fits)] for i, s in enumerate(settings)}
    best = max(scores, key=lambda k: float(np.mean(scores[k])))
    return {"C": best[0], "l1": best[1], "cv_auc": float(np.mean(scores[best])), "scores": scores, "fits": fits, "settings": settings, "rows": rows, "held": held,
            "passes": max(f.passes for found in fits.values() for f in found),
            "unconverged": [(k, *settings[i]) for k, found in fits.items() for i, f in enumerate(found) if not f.converged]}


def train_logreg(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], iv: Mapping[str, float],
                 c: float, l1: float, label: str = "label", directions: Mapping[str, int] = EXPECTED_DIRECTION, signs: str = "drop") -> Scorecard:
    """Penalised logistic regression whose coefficients have the expected signs.

    ``signs`` "drop": a wrong-sign feature with the least information value is dropped until none is left; raises if the last
    feature has the wrong sign too. "bounds": coefficients are held at or above (below) zero while fitting, so one fit is enough, no
    feature is dropped, and one that would have the wrong sign gets zero.
    """
    numeric, categorical, dropped = list(numeric), list(categorical), []
    if signs == "bounds":
        prep = fit_linear_prep(train, numeric, categorical, label)
        return Scorecard("logreg", prep, _linear(prep, train, label, c, l1, sign_bounds(prep, directions)), hyper={"C": c, "l1": l1, "signs": signs})
    while True:
        prep = fit_linear_prep(train, numeric, categorical, label)
        model = _linear(prep, train, label, c, l1)
        weights = dict(zip(prep.inputs, model.coefficients))
        wrong = [f for f in numeric if f in directions and np.sign(weights[f]) not in (0, directions[f])]
        wrong += [f for f in categorical if np.sign(weights[f"{f}_woe"]) not in (0, 1)]
        if wrong and len(numeric) + len(categorical) == 1:
            raise ValueError(f"{wrong[0]} is left alone and has the wrong sign")
        if not wrong:
            return Scorecard("logreg", prep, model, hyper={"C": c, "l1": l1}, dropped=dropped)
        worst = min(wrong, key=lambda f: iv.get(f, 0.0))
        dropped.append(worst)
        (numeric if worst in numeric else categorical).remove(worst)


def sign_bounds(prep: LinearPrep, directions: Mapping[str, int]) -> list[tuple[float, float]]:
    """Least and greatest coefficient of each model input: numbers by their direction, weights of evidence not negative, the rest free."""
    by_sign = {1: (0.0, float("inf")), -1: (-float("inf"), 0.0)}
    return [by_sign[1] if n.removesuffix("_woe") in prep.categorical and n.endswith("_woe") else by_sign.get(directions.get(n), FREE) for n in prep.inputs]


def optimality(card: Scorecard, train: DataFrame, label: str = "label", directions: Mapping[str, int] | None = None) -> DataFrame:
    """Per model input of a linear card: coefficient, slope of the penalised mean log loss there, and ``unmet``, how far it is from the
    optimality conditions (with ``directions``, of a fit within bounds). One pass over the rows."""
    prep, (c, l1) = card.prep, (card.hyper["C"], card.hyper["l1"])
    x, size = vector_to_array("features"), len(prep.inputs)
    made = prep.transform(train)
    gap = 1 / (1 + F.exp(-card.model.margin(x))) - F.col(label).cast("double")
    row = made.agg(F.count(F.lit(1)).alias("n"), F.avg(gap).alias(f"g{size}"), *[F.avg(gap * x[i]).alias(f"g{i}") for i in range(size)]).first()
    bounds = [*(sign_bounds(prep, directions) if directions is not None else [FREE] * size), FREE]
    strength = np.array([1.0 / (c * row["n"])] * size + [0.0])
    w = np.array([*card.model.coefficients, card.model.intercept])
    slope = np.array([row[f"g{i}"] for i in range(size + 1)]) + strength * (1 - l1) * w
    left = unmet(w, slope, strength * l1, *(np.array([b[side] for b in bounds]) for side in (0, 1)))
    rows = [(n, float(a), float(b), float(u)) for n, a, b, u in zip([*prep.inputs, "(intercept)"], w, slope, left)]
    return train.sparkSession.createDataFrame(rows, "feature string, coefficient double, slope double, unmet double")


def coefficient_table(card: Scorecard, spark) -> DataFrame:
    """Coefficient per standard deviation and odds ratio of each model input."""
    rows = [(n, float(w), float(np.exp(w))) for n, w in zip(card.prep.inputs, card.model.coefficients)]
    return spark.createDataFrame(rows, "feature string, coef_per_1sd double, odds_ratio double")


# ---- boosted trees --------------------------------------------------------------------------------------------------
def random_settings(n: int, seed: int = 42, grid: Mapping[str, Sequence] = TREE_GRID) -> list[TreeSetting]:
    """Different random picks from the tree grid; as many as it has if ``n`` is more."""
    rng, total = np.random.default_rng(seed), int(np.prod([len(v) for v in grid.values()]))
    out: dict[int, TreeSetting] = {}
    while len(out) < min(n, total):
        k = rest = int(rng.integers(total))
        picked = {}
        for name, values in grid.items():
            rest, at = divmod(rest, len(values))
            picked[name] = values[at]
        out.setdefault(k, TreeSetting(**picked))
    return list(out.values())


#: The fold of all training rows.
WHOLE = -1


@dataclass
class _TreeFolds:
    """What is fitted in each fold, ``WHOLE`` among them, before its trees grow: preparation, cut points and the log-odds of the mean label.
    ``part`` numbers the rows by the folds that have them; ``fitting`` and ``scoring`` hold each fold's parts."""

    part: Column
    fitting: dict[int, set[int]]
    scoring: dict[int, set[int]]
    preps: dict[int, TreePrep]
    cuts: dict[int, list[list[float]]]
    base: dict[int, float]

    def blocks(self, train: DataFrame, of: Mapping[int, set[int]], label: str, key: str) -> DataFrame:
        """Binned rows of some folds, each by its own caps and cut points, from one pass."""
        prep = self.preps[WHOLE]
        flags = replace(prep, numeric=[], caps={}, medians={})
        rows = _labelled(train.withColumn("__part", self.part), label)
        rows = rows if WHOLE in of else rows.filter(F.col("__part").isin(sorted(set().union(*of.values()))))
        numbers = {k: {f"n{k}_{i}": self.preps[k].number(c) for i, c in enumerate(prep.numeric)} for k in of}
        others = {f"f{i}": F.col(f"x_{c}") for i, c in enumerate(flags.inputs)}
        made = flags.encoded(rows).select("__part", F.xxhash64(key).alias("r"), F.col(label).cast("double").alias("y"), *[
            e.alias(c) for some in (*numbers.values(), others) for c, e in some.items()])
        return bin_folds(made, {k: [*numbers[k], *others] for k in of}, {k: self.cuts[k] for k in of}, of)


def _labelled(rows: DataFrame, label: str) -> DataFrame:
    return rows.filter(F.col(label).cast("double").isNotNull())


def _tree_folds(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], levels: Mapping[str, Sequence[str]], label: str, date: str,
                months: Sequence[tuple[list, list]]) -> _TreeFolds:
    """Caps and cut points of all folds and of all rows: the folds overlap, so each row is counted once, by the folds that have it."""
    places: dict[object, set] = {}  # of a month: folds that fit on it (0) or score it (1)
    for k, sides in enumerate(months):
        for side, some in enumerate(sides):
            for m in some:
                places.setdefault(m, set()).add((k, side))
    kinds: dict[frozenset, list] = {}
    for m, found in places.items():
        kinds.setdefault(frozenset(found), []).append(m)
    number = F.coalesce(*[F.when(month_start(date).isin(some), F.lit(n)) for n, some in enumerate(kinds.values(), 1)], F.lit(0))
    fitting, scoring = ({k: {n for n, found in enumerate(kinds, 1) if (k, side) in found} for k in range(len(months))} for side in (0, 1))
    parts = {**fitting, WHOLE: set(range(len(kinds) + 1))}
    rows = train.withColumn("__part", number)
    edges = slice_edges(rows, numeric, max(slice_count(rows), 8 * BINS)) if numeric else {}  # many, so that few rows are near a wanted rank
    caps = {k: _pairs(v) for k, v in quantiles_of_unions(rows, numeric, CAPPED, "__part", parts, edges=edges).items()} if numeric else {k: {} for k in parts}
    preps = {k: fit_tree_prep(train, numeric, categorical, fill=False, levels=levels, caps=caps[k]) for k in parts}
    kept = _labelled(rows, label)
    cuts = fit_cuts(kept, numeric, caps, parts, edges) if numeric else {k: [] for k in parts}
    flags = replace(preps[WHOLE], numeric=[], caps={}, medians={})
    told = flags.encoded(kept).groupBy("__part").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("double")).alias("y"), *[F.sum(f"x_{c}").alias(f"f{i}") for i, c in enumerate(flags.inputs)]).collect()  # a row a part
    base = {}
    for k, some in parts.items():
        here = [r for r in told if r["__part"] in some]
        n = sum(r["n"] for r in here)
        mean = (sum(r["y"] for r in here) / n if n else None) or 0.5
        mean = min(max(mean, 1e-6), 1 - 1e-6)
        base[k] = float(np.log(mean / (1 - mean)))
        cuts[k] = [*cuts[k], *[flag_cuts(n, int(sum(r[f"f{i}"] for r in here))) for i in range(len(flags.inputs))]]
    return _TreeFolds(number, parts, scoring, preps, cuts, base)


def search_trees(train: DataFrame, fitted: _TreeFolds, settings: Sequence[TreeSetting], constraints: Mapping[str, int], label: str = "label", key: str = "loan_id",
                 seed: int = 42) -> list[list[float]]:
    """AUC of each setting on each fold's later months: caps and cut points are fitted in each fold, levels on the whole training set.
    All folds and settings grow in the same passes over one table, which one pass makes."""
    signs = [int(constraints.get(n, 0)) for n in fitted.preps[WHOLE].inputs]
    parts, cuts, base = ({k: found[k] for k in fitted.scoring} for found in (fitted.fitting, fitted.cuts, fitted.base))
    fits = grow_all(fitted.blocks(train, parts, label, key), settings, cuts, signs, base, seed)
    held, sizes = pack(fitted.blocks(train, fitted.scoring, label, key), "fold-score"), {k: [len(c) for c in v] for k, v in cuts.items()}
    ranked = materialize(scored(held, fits, sizes, base, len(settings)), "fold-scores")
    aucs = {(r["fold"], r["setting"]): r["auc"] for r in discrimination(ranked, "p", "y", ["fold", "setting"]).collect()}  # one a fit
    return [[0.5 if aucs.get((k, i)) is None else aucs[k, i] for k in sorted(cuts)] for i in range(len(settings))]


class _Watch:
    """Validation AUC after every round of one fit; tells when the last better round is ``patience`` rounds ago."""

    def __init__(self, rows: DataFrame, sizes: Mapping[int, Sequence[int]], base: Mapping[int, float], patience: int):
        self.rows, self.sizes, self.base, self.patience = pack(rows, "trees-valid"), sizes, base, patience
        self.seen, self.aucs = 0, []

    def look(self, fit: Growing) -> None:
        fresh = fit.trees[self.seen:]
        if not fresh:
            return
        steps = stepped(self.rows, fresh, self.sizes[0], self.base[0])
        found = {r["round"]: r["auc"] for r in discrimination(steps, "p", "y", ["round"]).collect()}  # one a round
        self.aucs += [0.5 if found.get(i) is None else found[i] for i in range(len(fresh))]
        self.rows = refreshed(self.rows, {(0, 0): fit}, {(0, 0): self.seen}, self.sizes, self.base, 1)
        self.seen = len(fit.trees)

    @property
    def best(self) -> int:
        return int(np.argmax(self.aucs)) if self.aucs else -1

    def __call__(self, fits: Mapping[tuple[int, int], Growing]) -> set:
        self.look(fits[0, 0])
        return {(0, 0)} if len(self.aucs) - 1 - self.best >= self.patience else set()


def train_trees(train: DataFrame, valid: DataFrame, numeric: Sequence[str], categorical: Sequence[str], date: str, folds: DataFrame | None, n_iter: int = DRAWS,
                label: str = "label", rounds: int = MOST_ROUNDS, seed: int = 42, settings: Sequence[TreeSetting] | None = None, key: str = "loan_id",
                patience: int = PATIENCE, constraints: Mapping[str, int] | None = None, priors: Mapping[str, int] = EXPECTED_DIRECTION) -> Scorecard:
    """Boosted trees with monotone constraints: random search over time folds, then early stopping by the AUC of the validation rows.

    Each input is constrained to its direction: the prior one, else that of the training data (see ``direction_table``), unless
    ``constraints`` are given. Missing numbers stay missing: each split learns where they go. ``key`` tells rows apart for
    row sampling. ``hyper`` holds the setting, the number of rounds kept, the AUC of each round and of each searched setting.
    """
    levels = fit_levels(train, categorical)
    if constraints is None:
        table = direction_table(train.fillna("Unknown", list(categorical)), numeric, levels, label, priors).collect()  # one row an input
        constraints = {r["model_input"]: int(r["constraint"] or 0) for r in table}
    settings = list(settings or random_settings(n_iter, seed))
    fitted = _tree_folds(train, numeric, categorical, levels, label, date, _fold_months(folds) if len(settings) > 1 else [])
    scores = search_trees(train, fitted, settings, constraints, label, key, seed) if len(settings) > 1 else [[0.0]]
    best = settings[int(np.argmax([np.mean(s) for s in scores]))]
    prep, cuts, base = fitted.preps[WHOLE], fitted.cuts[WHOLE], fitted.base[WHOLE]
    rows = fitted.blocks(train, {WHOLE: fitted.fitting[WHOLE]}, label, key).withColumn("fold", F.lit(0))
    inputs = F.array(*[F.col(f"x_{c}") for c in prep.inputs]).alias("x")
    held = bin_rows(prep.encoded(_labelled(valid, label)).select(F.lit(0).alias("fold"), F.xxhash64(key).alias("r"), F.col(label).cast("double").alias("y"), inputs),
                    cuts, ["fold", "r", "y"])
    # levels become inputs under cleaned names, so constraints may name either form
    clean = {f"{c}_{v}": n for c in categorical for v, n in zip(levels[c], one_hot(c, levels[c], f"{c}_"))}
    wanted = {clean.get(n, n): s for n, s in constraints.items()}
    signs = [int(wanted.get(n, 0)) for n in prep.inputs]
    watch = _Watch(held, {0: [len(c) for c in cuts]}, {0: base}, patience)
    fit = grow_all(rows, [replace(best, rounds=rounds)], {0: cuts}, signs, {0: base}, seed, patience=watch)[0, 0]
    watch.look(fit)
    kept = watch.best + 1 if watch.aucs else len(fit.trees)
    model = BoostedTrees(prep.inputs, [list(c) for c in cuts], fit.trees[:kept], base, signs)
    return Scorecard("trees", prep, model, hyper={**asdict(best), "rounds": kept, "validation_auc": watch.aucs, "searched": [[asdict(s), a] for s, a in zip(settings, scores)],
                                                  "constraints": dict(zip(prep.inputs, signs)), "gains": fit.gains[:kept]})


def direction_table(train: DataFrame, numeric: Sequence[str], levels: Mapping[str, Sequence[str]], label: str = "label",
                    priors: Mapping[str, int] = EXPECTED_DIRECTION) -> DataFrame:
    """Direction of each input in the data, its prior, the constraint in use and whether the two conflict."""
    rho = (spearman_with_label(train, numeric, label)
           .select(F.col("feature").alias("model_input"), F.col("spearman").alias("strength"))) if numeric else None
    y = F.col(label).cast("double")
    parts = []
    for f, values in levels.items():
        for v in values:
            at = F.coalesce(F.col(f) == v, F.lit(False))
            parts.append(F.struct(F.lit(f"{f}_{v}").alias("model_input"),
                                  (F.avg(F.when(at, y)) - F.avg(F.when(~at, y))).alias("strength")))
    out = rho
    if parts:
        diffs = train.agg(*[p.alias(f"p{i}") for i, p in enumerate(parts)]).select(
            F.inline(F.array(*[F.col(f"p{i}") for i in range(len(parts))])))
        out = diffs if out is None else out.unionByName(diffs)
    known = train.sparkSession.createDataFrame([(k, int(v)) for k, v in priors.items()], "model_input string, prior int")
    out = out.join(known, "model_input", "left").withColumn("data_direction", F.signum("strength").cast("int"))
    return out.withColumns({
        "constraint": F.coalesce("prior", "data_direction"),
        "conflict": F.coalesce((F.col("data_direction") != 0) & (F.col("prior") != F.col("data_direction")), F.lit(False))})


def monotonicity(card: Scorecard, rows: DataFrame, train: DataFrame, constraints: Mapping[str, int], key: str = "loan_id",
                 n_rows: int = 300, n_grid: int = 20) -> DataFrame:
    """Share of sampled rows whose log-odds move against the constraint as one input walks its training range.

    The sample of rows is the operator's own limit. Each row is repeated along a fixed grid per input by explode.
    """
    names = [f"x_{c}" for c in card.prep.inputs]
    trees = isinstance(card.prep, TreePrep)
    encoded = card.prep.encoded if trees else card.prep.scaled  # what the model was fitted on
    sample = materialize(encoded(rows.orderBy(F.xxhash64(key), key).limit(n_rows)).select(key, *names), "ice")
    wanted = [c for c in constraints if f"x_{c}" in names and constraints[c] != 0]
    base = encoded(train).select(*[F.when(~F.isnan(f"x_{c}"), F.col(f"x_{c}")).alias(c) for c in wanted])
    grids = {c: sorted(set(v)) for c, v in
             collect_quantiles(base, wanted, [i / (n_grid - 1) for i in range(n_grid)]).items()}
    walks = F.array(*[F.struct(F.lit(c).alias("model_input"), F.array(*map(F.lit, g)).alias("grid"))
                      for c, g in grids.items() if len(g) >= 2])
    spread = (sample.select("*", F.inline(walks))
              .select(key, *names, "model_input", F.posexplode("grid").alias("step", "at")))
    spread = spread.withColumns({n: F.when(F.col("model_input") == n[2:], F.col("at")).otherwise(F.col(n)) for n in names})
    scored = spread.withColumn("logodds", card.model.margin(F.array(*names)))  # the margin, as a probability that has come to 1 has no odds
    scored = scored.select(key, "model_input", "step", "logodds")
    order = Window.partitionBy(key, "model_input").orderBy("step")  # one row per grid step
    sign = F.create_map(*[F.lit(x) for kv in constraints.items() for x in kv])
    moves = scored.withColumn("against", (F.col("logodds") - F.lag("logodds").over(order))
                              * F.try_element_at(sign, F.col("model_input")) < -1e-6)
    per_row = moves.groupBy(key, "model_input").agg(
        F.max(F.coalesce("against", F.lit(False)).cast("int")).alias("violates"),
        (F.max_by("logodds", "step") - F.min_by("logodds", "step")).alias("effect"))
    return per_row.groupBy("model_input").agg(F.avg("violates").alias("rows_violating"),
                                              F.avg("effect").alias("logodds_effect_min_to_max"))


# ---- scoring and evaluation -----------------------------------------------------------------------------------------
def youden_cut(scored: DataFrame, label: str = "label", score: str = "model_predictions") -> float:
    """Threshold with the largest gap between caught bads and false alarms."""
    return discrimination(materialize(scored.select(score, label), "scores"), score, label).first()["youden_threshold"]


def evaluate(card: Scorecard, df: DataFrame, label: str = "label", split: str = "data_split") -> DataFrame:
    """All metrics of a model per split; rows are scored once and the scores written, as the metrics read them more than once."""
    scored = materialize(card.transform(df).select(split, label, "model_predictions"), "scores")
    return split_metrics(scored, card.name, card.threshold, label, split)


def split_metrics(scored: DataFrame, name: str, threshold: float, label: str = "label", split: str = "data_split") -> DataFrame:
    """All metrics of given scores per split."""
    return (discrimination(scored, "model_predictions", label, [split], threshold)
            .withColumns({"model": F.lit(name), "threshold": F.lit(float(threshold))}))


def score_rows(card: Scorecard, rows: DataFrame, date: str, role: str = "adhoc") -> DataFrame:
    """Prediction rows of every month in the frame; a month or a whole history is the same job."""
    return prediction_rows(card.transform(rows), date, card.name, card.threshold, role)


def prediction_rows(scored: DataFrame, date: str, name: str, threshold: float, role: str = "adhoc") -> DataFrame:
    """Scored rows in the layout of the predictions table."""
    source = F.col("feature_source") if "feature_source" in scored.columns else F.lit("gold_feature_store")
    return scored.select(
        "Customer_ID", "loan_id", F.col(date).alias("snapshot_date"), F.lit(name).alias("model_name"),
        F.lit(role).alias("model_role"), "model_predictions", F.lit(float(threshold)).alias("decision_threshold"),
        source.alias("feature_source"), (F.col("model_predictions") >= threshold).cast("int").alias("predicted_default"))

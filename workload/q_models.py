"""Preprocessing, training, evaluation and scoring."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelkit.operators.drift import binned, contingency, decile_edges, information_value
from panelkit.operators.metrics import discrimination, score_summary
from panelkit.operators.penalised import fit_all
from panelkit.operators.quality import metric_gaps, missing_shares
from panelkit.plans.inference import rows_to_score
from panelkit.operators.boosting import TreeSetting
from panelkit.plans.modelling import (C_GRID, TREE_GRID, coefficient_table, evaluate, expanding_folds, fit_linear_prep, fit_tree_prep, load_card,
                                      monotonicity, optimality, prediction_rows, random_settings, save_card, score_rows, search_logreg,
                                      split_metrics, train_logreg, train_trees, youden_cut)
from panelkit.session import fresh_path, materialize
from panelkit.sources.sinks import write_partitions
from workload.q_aggregates import split_panel
from workload.registry import query
from workload.views import view

NUMERIC, LEVELS = ["InterestRate_x_Debt", "Delay_from_due_date", "Age_imputed"], ["Credit_Mix"]
DIRECTIONS = {"InterestRate_x_Debt": 1, "Delay_from_due_date": 1, "Age_imputed": -1}
RISK = "CASE WHEN x1 / 5000 + x2 - coalesce(x3, 25) + (CAST(loan_id AS INT) * 37) % 97 > 130 THEN 1 ELSE 0 END"


def training_rows(spark, d):
    """Panel with named features and an outcome that depends on them."""
    return split_panel(spark, d).selectExpr(
        "loan_id", "Customer_ID", "label_date", "month", "data_split", f"{RISK} AS label", "x1 AS InterestRate_x_Debt",
        "x2 AS Delay_from_due_date", "x3 AS Age_imputed", "level AS Credit_Mix")


def part(spark, d, split):
    return training_rows(spark, d).filter(F.col("data_split") == split)


def linear(spark, d):
    """Scorecard without a search."""
    train = materialize(part(spark, d, "train"), "train")
    iv = {r["feature"]: r["iv"] for r in information_value(contingency(
        binned(train, decile_edges(train, NUMERIC), LEVELS, keep=["label"]), "label")).collect()}
    card = train_logreg(train, NUMERIC, LEVELS, iv, c=1.0, l1=0.0, directions=DIRECTIONS)
    card.threshold = youden_cut(card.transform(part(spark, d, "validation")))
    return card


def single(spark, d):
    """Scorecard of one number, whose fit SQL can follow."""
    return train_logreg(part(spark, d, "train"), ["InterestRate_x_Debt"], [], {}, c=1.0, l1=0.0, directions={})


def trees(spark, d, rounds=12, **search):
    """Boosted trees with early stopping; one setting unless a search is asked for."""
    train, valid = materialize(part(spark, d, "train"), "train"), materialize(part(spark, d, "validation"), "validation")
    card = train_trees(train, valid, NUMERIC, LEVELS, "label_date", expanding_folds(train, "label_date"), rounds=rounds, patience=10, priors=DIRECTIONS,
                       **(search or {"settings": [TreeSetting(max_depth=3, learning_rate=0.3, min_child_weight=5)]}))
    card.threshold = youden_cut(card.transform(valid))
    return card


def newton_sql(strengths, steps=9):
    """A one-feature logistic regression by Newton steps in SQL: table t (z, label) and m (n) give fit (c, w, i)."""
    values = ", ".join(f"({c!r}e0)" for c in strengths)
    out = [f"w0 AS (SELECT c, 1 / (c * n) AS lam, 0e0 AS w, 0e0 AS i FROM (VALUES {values}) v(c), m)"]
    for k in range(1, steps + 1):
        out.append(f"""w{k} AS (SELECT c, lam, w - (hii * gw - hwi * gi) / (hww * hii - hwi * hwi) AS w, i - (hww * gi - hwi * gw) / (hww * hii - hwi * hwi) AS i FROM
 (SELECT c, lam, w, i, avg((p - label) * z) + lam * w AS gw, avg(p - label) AS gi, avg(p * (1 - p) * z * z) + lam AS hww, avg(p * (1 - p) * z) AS hwi, avg(p * (1 - p)) AS hii
 FROM (SELECT c, lam, w, i, z, label, 1 / (1 + exp(-(i + w * z))) AS p FROM t, w{k - 1}) GROUP BY c, lam, w, i))""")
    return ",\n ".join(out) + f", fit AS (SELECT c, w, i FROM w{steps})"


ONE = f"""WITH @split_panel, s AS (SELECT loan_id, Customer_ID, label_date, month, data_split, {RISK} AS label, x1 FROM split_panel WHERE data_split IS NOT NULL),
 q AS (SELECT quantile_cont(x1, 0.01) AS lo, quantile_cont(x1, 0.99) AS hi FROM s WHERE data_split = 'train'), c AS (SELECT s.* REPLACE (least(greatest(x1, lo), hi) AS x1) FROM s, q),
 k AS (SELECT abs(skewness(x1)) > 1 AS k1 FROM c WHERE data_split = 'train'), l AS (SELECT c.* REPLACE (CASE WHEN k1 THEN sign(x1) * ln(1 + abs(x1)) ELSE x1 END AS x1) FROM c, k),
 m AS (SELECT avg(x1) AS a, stddev_pop(x1) AS b, count(*) AS n FROM l WHERE data_split = 'train'), z AS (SELECT l.* EXCLUDE (x1), (x1 - a) / b AS z FROM l, m),
 t AS (SELECT z, label FROM z WHERE data_split = 'train'), {newton_sql([1])}, p AS (SELECT z.*, 1 / (1 + exp(-(i + w * z))) AS score FROM z, fit)"""


CAPS = ", ".join(f"quantile_cont({c}, 0.01) FILTER (data_split = 'train') AS {c}_lo, quantile_cont({c}, 0.99) FILTER (data_split = 'train') AS {c}_hi" for c in ("x1", "x3", "x5"))
PREP = f"""WITH @split_panel, s AS (SELECT *, exp(x2 / 20) AS x5 FROM split_panel WHERE data_split IS NOT NULL), q AS (SELECT {CAPS} FROM s),
 c AS (SELECT loan_id, data_split, label, level, x3 IS NULL AS gone, """ + ", ".join(
    f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, {c}_lo), {c}_hi) END AS {c}" for c in ("x1", "x3", "x5")) + """ FROM s, q),
 k AS (SELECT abs(skewness(x1)) > 1 AS k1, abs(skewness(x3)) > 1 AS k3, abs(skewness(x5)) > 1 AS k5 FROM c WHERE data_split = 'train'),
 l AS (SELECT c.* EXCLUDE (x1, x3, x5), CASE WHEN k1 THEN sign(x1) * ln(1 + abs(x1)) ELSE x1 END AS x1, CASE WHEN k3 THEN sign(x3) * ln(1 + abs(x3)) ELSE x3 END AS x3,
 CASE WHEN k5 THEN sign(x5) * ln(1 + abs(x5)) ELSE x5 END AS x5 FROM c, k),
 m AS (SELECT quantile_cont(x3, 0.5) AS m3 FROM l WHERE data_split = 'train'),"""


@query("ml1_linear_preprocessing", PREP + """ tab AS (SELECT coalesce(level, '__MISSING__') AS bin, sum(label) + 0.5e0 AS b, sum(1 - label) + 0.5e0 AS g FROM l WHERE data_split = 'train' GROUP BY 1),
 w AS (SELECT bin, ln((b / (SELECT sum(label) + 0.5e0 FROM l WHERE data_split = 'train')) / (g / (SELECT sum(1 - label) + 0.5e0 FROM l WHERE data_split = 'train'))) AS woe FROM tab),
 f AS (SELECT loan_id, data_split, x1, coalesce(x3, m3) AS x3, x5, CASE WHEN gone THEN 1e0 ELSE 0e0 END AS x3_missing, coalesce(woe, 0) AS level_woe FROM l LEFT JOIN w ON coalesce(level, '__MISSING__') = bin, m),
 z AS (SELECT avg(x1) AS a1, stddev_pop(x1) AS s1, avg(x3) AS a3, stddev_pop(x3) AS s3, avg(x5) AS a5, stddev_pop(x5) AS s5, avg(x3_missing) AS am, stddev_pop(x3_missing) AS sm, avg(level_woe) AS aw, stddev_pop(level_woe) AS sw
 FROM f WHERE data_split = 'train') SELECT loan_id, round((x1 - a1) / s1, 6) AS x1, round((x3 - a3) / s3, 6) AS x3, round((x5 - a5) / s5, 6) AS x5, round((x3_missing - am) / sm, 6) AS x3_missing,
 round((level_woe - aw) / sw, 6) AS level_woe FROM f, z""")
def ml1(spark, d):
    rows = split_panel(spark, d).withColumn("x5", F.exp(F.col("x2") / 20))
    prep = fit_linear_prep(rows.filter("data_split = 'train'"), ["x1", "x3", "x5"], ["level"])
    made = prep.transform(rows).select("loan_id", vector_to_array("features").alias("v"))
    return made.select("loan_id", *[F.round(F.col("v")[i], 6).alias(n) for i, n in enumerate(prep.inputs)])


@query("ml2_tree_preprocessing", """WITH @split_panel, s AS (SELECT * FROM split_panel WHERE data_split IS NOT NULL), q AS (SELECT quantile_cont(x3, 0.01) AS lo, quantile_cont(x3, 0.99) AS hi, quantile_cont(x3, 0.5) AS m FROM s WHERE data_split = 'train')
 SELECT loan_id, round(coalesce(least(greatest(x3, lo), hi), m), 8) AS x3, CASE WHEN model = '1-URGENT' THEN 1e0 ELSE 0e0 END AS urgent, CASE WHEN model = '5-LOW' THEN 1e0 ELSE 0e0 END AS low FROM s, q""".replace(
    "coalesce(least(greatest(x3, lo), hi), m)", "CASE WHEN x3 IS NULL THEN m ELSE least(greatest(x3, lo), hi) END"))
def ml2(spark, d):
    rows = split_panel(spark, d)
    prep = fit_tree_prep(rows.filter("data_split = 'train'"), ["x3"], ["model"])
    at = {n: i for i, n in enumerate(prep.inputs)}
    made = prep.transform(rows).select("loan_id", vector_to_array("features").alias("v"))
    return made.select("loan_id", F.round(F.col("v")[at["x3"]], 8).alias("x3"), F.col("v")[at["model_1_URGENT"]].alias("urgent"),
                       F.col("v")[at["model_5_LOW"]].alias("low"))


@query("ml3_expanding_folds", """WITH @split_panel, m AS (SELECT month, row_number() OVER (ORDER BY month) - 1 AS pos, count(*) OVER () AS total FROM (SELECT DISTINCT month FROM split_panel WHERE data_split = 'train')),
 f AS (SELECT m.*, i, total - i * 2 AS cut FROM m, (SELECT unnest([4, 3, 2, 1]) AS i))
 SELECT CAST(5 - i AS INTEGER) AS fold, month, CASE WHEN pos < cut THEN 'fit' ELSE 'score' END AS part FROM f WHERE pos < cut + 2""")
def ml3(spark, d):
    return expanding_folds(part(spark, d, "train"), "label_date")


FOLDS = """m AS (SELECT month, row_number() OVER (ORDER BY month) - 1 AS pos, count(*) OVER () AS total FROM (SELECT DISTINCT month FROM split_panel WHERE data_split = 'train')),
 f AS (SELECT month, CAST(4 - i AS INTEGER) AS fold, pos < total - i * 2 AS fits FROM m, (SELECT unnest([4, 3, 2, 1]) AS i) WHERE pos < total - i * 2 + 2),
 sizes AS (SELECT fold, count(*) FILTER (fits) AS n_fit, count(*) FILTER (NOT fits) AS n_score FROM f JOIN split_panel USING (month) WHERE data_split = 'train' GROUP BY fold)"""


@query("ml4_penalty_search", f"""WITH @split_panel, {FOLDS} SELECT fold, n_fit, n_score, round(c, 9) AS c, l1, true AS converged, true AS at_optimum, true AS better_than_chance
 FROM sizes, (SELECT unnest([{", ".join(repr(c) + "e0" if "e" not in repr(c) else repr(c) for c in C_GRID)}]) AS c), (SELECT unnest([0e0, 1e0]) AS l1)""")
def ml4(spark, d):
    """All penalties on all folds; the slope at each fit, taken anew from the rows by expressions, must be held by the penalty."""
    train = part(spark, d, "train")
    found = search_logreg(train, NUMERIC, LEVELS, "label_date", expanding_folds(train, "label_date"))
    sizes, width = found["rows"].groupBy("fold").agg(F.count(F.lit(1)).alias("n_fit")), len(found["fits"][0][0].coefficients)
    held = found["held"].groupBy("fold").agg(F.count(F.lit(1)).alias("n_score"))
    fits = spark.createDataFrame(
        [(k, i, *found["settings"][i], f.coefficients.tolist(), f.intercept, f.converged, float(found["scores"][found["settings"][i]][k]))
         for k, some in found["fits"].items() for i, f in enumerate(some)],
        "fold int, setting int, c double, l1 double, w array<double>, b double, converged boolean, auc double")
    gap = 1 / (1 + F.exp(-sum((F.col("x")[j] * F.col("w")[j] for j in range(width)), F.col("b")))) - F.col("y")
    slopes = found["rows"].join(fits.select("fold", "setting", "w", "b"), "fold").select("fold", "setting", "x", gap.alias("gap")).groupBy("fold", "setting").agg(
        F.avg("gap").alias("gi"), F.array(*[F.avg(F.col("gap") * F.col("x")[j]) for j in range(width)]).alias("g"))
    made = fits.join(sizes, "fold").join(held, "fold").join(slopes, ["fold", "setting"])
    strength = 1 / (F.col("c") * F.col("n_fit"))
    one = F.zip_with("g", "w", lambda g, w: F.when(w == 0, F.abs(g) - strength * F.col("l1")).otherwise(
        F.abs(g + strength * (1 - F.col("l1")) * w + strength * F.col("l1") * F.signum(w))))
    return made.select("fold", "n_fit", "n_score", F.round("c", 9).alias("c"), "l1", "converged",
                       ((F.array_max(one) < 1e-8) & (F.abs("gi") < 1e-8)).alias("at_optimum"), (F.col("auc") > 0.5).alias("better_than_chance"))


@query("ml4_one_feature_fits", ONE.split(", w0 AS")[0] + f""", {newton_sql([0.001, 0.1, 1, 10])}
 SELECT c, round(w, 8) AS coefficient, round(i, 8) AS intercept, round(exp(w), 8) AS odds_ratio FROM fit""")
def ml4_one(spark, d):
    """Fits at four strengths in the same passes, against Newton steps in SQL."""
    train, strengths = part(spark, d, "train"), [0.001, 0.1, 1.0, 10.0]
    prep = fit_linear_prep(train, ["InterestRate_x_Debt"], [])
    rows = prep.transform(train).select(F.lit(0).alias("fold"), vector_to_array("features").alias("x"), F.col("label").alias("y"))
    fits = fit_all(rows, [(c, 0.0) for c in strengths], 1, tolerance=1e-12)[0]
    made = spark.createDataFrame([(c, float(f.coefficients[0]), f.intercept) for c, f in zip(strengths, fits)], "c double, w double, i double")
    return made.select("c", F.round("w", 8).alias("coefficient"), F.round("i", 8).alias("intercept"), F.round(F.exp("w"), 8).alias("odds_ratio"))


WRONG = {"InterestRate_x_Debt": 1, "Delay_from_due_date": -1, "Age_imputed": -1}


@query("ml5_sign_enforcement", """SELECT feature, true AS expected_sign, true AS odds_follow, 'Delay_from_due_date' AS dropped FROM
 (SELECT unnest(['InterestRate_x_Debt', 'Age_imputed', 'Age_imputed_missing']) AS feature)""")
def ml5(spark, d):
    train = part(spark, d, "train")
    card = train_logreg(train, NUMERIC, [], {"Delay_from_due_date": 0.1}, 1.0, 0.0, directions=WRONG)
    sign = F.try_element_at(F.create_map(*[F.lit(x) for kv in WRONG.items() for x in kv]), F.col("feature"))
    return coefficient_table(card, spark).select(
        "feature", F.coalesce(F.signum("coef_per_1sd") == sign, F.lit(True)).alias("expected_sign"),
        (F.abs(F.log("odds_ratio") - F.col("coef_per_1sd")) < 1e-12).alias("odds_follow"), F.lit(",".join(card.dropped)).alias("dropped"))


@query("ml5_signs_by_bounds", """SELECT feature, feature = 'Delay_from_due_date' AS held_at_zero, true AS expected_sign, true AS at_optimum FROM
 (SELECT unnest(['InterestRate_x_Debt', 'Delay_from_due_date', 'Age_imputed', 'Age_imputed_missing', 'Credit_Mix_woe', '(intercept)']) AS feature)""")
def ml5_bounds(spark, d):
    """One fit within bounds: the feature with the wrong sign stays at zero, where its slope pushes against the bound."""
    train = materialize(part(spark, d, "train"), "train")
    card = train_logreg(train, NUMERIC, LEVELS, {}, 1.0, 0.0, directions=WRONG, signs="bounds")
    told = optimality(card, train, directions=WRONG)
    sign = F.try_element_at(F.create_map(*[F.lit(x) for kv in {**WRONG, "Credit_Mix_woe": 1}.items() for x in kv]), F.col("feature"))
    return told.select("feature", (F.col("coefficient") == 0).alias("held_at_zero"),
                       F.coalesce(F.signum("coefficient") * sign >= 0, F.lit(True)).alias("expected_sign"), (F.col("unmet") < 1e-9).alias("at_optimum"))


@query("ml6_boosted_trees", f"""WITH @split_panel SELECT data_split, count(*) AS n, CAST(sum({RISK}) AS BIGINT) AS n_bad, true AS better_than_chance, true AS kept_the_best_round, CAST(5 AS INTEGER) AS n_searched,
 CAST(4 AS INTEGER) AS n_folds FROM split_panel WHERE data_split IS NOT NULL GROUP BY data_split""")
def ml6(spark, d):
    """Search over all nine parameters and four folds, then early stopping. Rounds are fewer than a full run's (see ``TREE_GRID``), the other
    eight parameters keep their whole ranges."""
    card = trees(spark, d, rounds=20, n_iter=5, settings=random_settings(5, grid={**TREE_GRID, "rounds": [5, 8]}))
    aucs, searched = card.hyper["validation_auc"], card.hyper["searched"]
    best = aucs.index(max(aucs)) + 1 == len(card.model.trees)
    return evaluate(card, training_rows(spark, d)).select(
        "data_split", "n", "n_bad", (F.col("auc") > 0.7).alias("better_than_chance"), F.lit(best).alias("kept_the_best_round"),
        F.lit(len(searched)).alias("n_searched"), F.lit(len(searched[0][1])).alias("n_folds"))


@query("ml6_first_splits", f"""WITH @split_panel, s AS (SELECT {RISK} AS y, x1, x2, x3 FROM split_panel WHERE data_split = 'train'),
 q AS (SELECT quantile_cont(x1, 0.01) AS l1, quantile_cont(x1, 0.99) AS h1, quantile_cont(x2, 0.01) AS l2, quantile_cont(x2, 0.99) AS h2, quantile_cont(x3, 0.01) AS l3, quantile_cont(x3, 0.99) AS h3 FROM s),
 v AS (SELECT y, 'InterestRate_x_Debt' AS f, least(greatest(x1, l1), h1) AS x FROM s, q UNION ALL SELECT y, 'Delay_from_due_date', least(greatest(x2, l2), h2) FROM s, q
 UNION ALL SELECT y, 'Age_imputed', CASE WHEN x3 IS NOT NULL THEN least(greatest(x3, l3), h3) END FROM s, q),
 cuts AS (SELECT DISTINCT f, unnest(quantile_disc(x, [{", ".join(f"{i}/64" for i in range(1, 64))}])) AS cut FROM v GROUP BY f),
 base AS (SELECT avg(y) AS p FROM s), g AS (SELECT f, x, p - y AS g, p * (1 - p) AS h FROM v, base), total AS (SELECT sum(g) / 3 AS g, sum(h) / 3 AS h FROM g),
 sides AS (SELECT g.f, cut, left_too, sum(g) FILTER (x < cut OR (left_too AND x IS NULL)) AS gl, sum(h) FILTER (x < cut OR (left_too AND x IS NULL)) AS hl FROM g JOIN cuts USING (f), (SELECT unnest([false, true]) AS left_too)
 GROUP BY g.f, cut, left_too),
 parts AS (SELECT f, cut, left_too, gl, hl, t.g - gl AS gr, t.h - hl AS hr, -gl / (hl + 1) AS wl, -(t.g - gl) / (t.h - hl + 1) AS wr, t.g * t.g / (t.h + 1) AS before FROM sides, total t WHERE hl >= 1 AND t.h - hl >= 1),
 fits AS (SELECT *, gl * gl / (hl + 1) + gr * gr / (hr + 1) - before AS gain FROM parts WHERE CASE WHEN f = 'Age_imputed' THEN wr <= wl ELSE wr >= wl END)
 SELECT f AS feature, round(cut, 6) AS cut, round(gain, 6) AS gain, round(wl, 8) AS left_weight, round(wr, 8) AS right_weight, round(hl, 6) AS left_curvature FROM fits
 QUALIFY row_number() OVER (PARTITION BY f ORDER BY gain DESC, left_too, cut) = 1""")
def ml6_first(spark, d):
    """The first split of a tree that may use one feature only, for each feature, against the best of all cuts by SQL."""
    train, valid = materialize(part(spark, d, "train"), "train"), part(spark, d, "validation")
    rows = []
    for name in NUMERIC:
        card = train_trees(train, valid, [name], [], "label_date", None, rounds=1, settings=[TreeSetting(max_depth=1)], constraints=DIRECTIONS)
        told = card.hyper["gains"][0][0]
        rows.append((name, float(card.model.cuts[0][told["bin"]]), told["gain"], told["left"][2], told["right"][2], told["left"][1]))
    made = spark.createDataFrame(rows, "feature string, cut double, gain double, left_weight double, right_weight double, left_curvature double")
    digits = {"cut": 6, "gain": 6, "left_weight": 8, "right_weight": 8, "left_curvature": 6}
    return made.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query("ml6_scores_from_nodes", f"""WITH @split_panel SELECT data_split, count(*) AS n, count(*) AS n_same FROM split_panel WHERE data_split IS NOT NULL GROUP BY data_split""")
def ml6_nodes(spark, d):
    """Scores of the model against its saved table of nodes, walked by joins: each row goes down every tree a level a join."""
    card = trees(spark, d, rounds=6)
    names = card.prep.inputs
    rows = materialize(card.prep.encoded(training_rows(spark, d)).select("loan_id", "data_split", F.create_map(
        *[x for n in names for x in (F.lit(n), F.col(f"x_{n}"))]).alias("inputs")), "inputs")
    nodes = materialize(card.model.table(spark), "nodes")
    at = rows.crossJoin(nodes.select("tree").distinct()).withColumn("node", F.lit(0))  # rows times trees, the work of scoring
    for _ in range(card.hyper["max_depth"]):
        x = F.try_element_at("inputs", F.col("feature"))
        right = F.when(F.isnan(x), ~F.col("missing_left")).otherwise(x >= F.col("cut")).cast("int")
        at = at.join(nodes, ["tree", "node"]).select("loan_id", "data_split", "inputs", "tree", F.when(F.col("feature").isNull(), F.col("node")).otherwise(
            2 * F.col("node") + 1 + right).alias("node"))
    margins = at.join(nodes, ["tree", "node"]).groupBy("loan_id", "data_split").agg((F.sum("value") + F.lit(card.model.base)).alias("margin"))
    scored = card.transform(training_rows(spark, d)).select("loan_id", "model_predictions")
    same = F.abs(1 / (1 + F.exp(-F.col("margin"))) - F.col("model_predictions")) < 1e-12
    return margins.join(scored, "loan_id").groupBy("data_split").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(same, 1)).alias("n_same"))


METRICS = """c AS (SELECT k, score, sum(label) AS b, sum(1 - label) AS g FROM p GROUP BY k, score),
 t AS (SELECT k, score, b, g, sum(b) OVER w * 1e0 AS tp, sum(g) OVER w * 1e0 AS fp, sum(b) OVER (PARTITION BY k) * 1e0 AS nb, sum(g) OVER (PARTITION BY k) * 1e0 AS ng FROM c WINDOW w AS (PARTITION BY k ORDER BY score DESC)),
 m AS (SELECT k, sum(b * ((ng - fp) + g / 2e0)) / (max(nb) * max(ng)) AS auc, greatest(max(tp / nb - fp / ng), 0) AS ks, sum(b * tp / (tp + fp)) / max(nb) AS ap,
 sum(CASE WHEN score >= 0.5 THEN b END) * 1e0 AS caught, sum(CASE WHEN score >= 0.5 THEN g END) * 1e0 AS wrong, max(nb) AS nb FROM t GROUP BY k),
 l AS (SELECT k, count(*) AS n, avg(label) AS rate, avg(score) AS mean, avg((score - label) * (score - label)) AS brier, avg(-CASE WHEN label = 1 THEN ln(score) ELSE ln(1 - score) END) AS loss FROM p GROUP BY k)"""
DIGITS = {"auc": 8, "gini": 8, "average_precision": 8, "log_loss": 8} | dict.fromkeys(["default_rate", "mean_score", "ks", "brier", "precision", "recall", "f1"], 9)


@query("ml7_evaluation_by_split", ONE.replace(", p AS (SELECT z.*,", ", scored AS (SELECT z.*,") + f""", pp AS (SELECT data_split AS k, score, label FROM scored), {METRICS.replace("c AS", "cc AS").replace("FROM c ", "FROM cc ")
 .replace("t AS (", "tt AS (").replace("FROM t ", "FROM tt ").replace("m AS (", "mm AS (").replace("l AS (", "ll AS (").replace("FROM p ", "FROM pp ")}
 SELECT k AS data_split, n, round(rate, 9) AS default_rate, round(mean, 7) AS mean_score, round(auc, 8) AS auc, round(2 * auc - 1, 8) AS gini, round(ks, 9) AS ks, round(ap, 8) AS average_precision,
 round(brier, 7) AS brier, round(loss, 7) AS log_loss, 'logreg' AS model, 0.5e0 AS threshold FROM mm JOIN ll USING (k)""")
def ml7(spark, d):
    made = evaluate(single(spark, d), training_rows(spark, d)).drop("n_bad", "n_good", "youden_threshold", "precision", "recall", "f1")
    digits = {c: n for c, n in DIGITS.items() if c in made.columns} | dict.fromkeys(["mean_score", "brier", "log_loss"], 7)
    return made.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query("ml7_split_metrics", f"""WITH @split_panel, p AS (SELECT data_split AS k, score, label FROM split_panel WHERE data_split IS NOT NULL), {METRICS}
 SELECT k AS data_split, n, round(rate, 9) AS default_rate, round(mean, 9) AS mean_score, round(auc, 8) AS auc, round(2 * auc - 1, 8) AS gini, round(ks, 9) AS ks, round(ap, 8) AS average_precision,
 round(brier, 9) AS brier, round(loss, 8) AS log_loss, round(caught / (caught + wrong), 9) AS precision, round(caught / nb, 9) AS recall, round(2 * caught / (caught + wrong + nb), 9) AS f1,
 'panel' AS model, 0.5e0 AS threshold FROM m JOIN l USING (k)""")
def ml7_metrics(spark, d):
    made = split_metrics(split_panel(spark, d).withColumn("model_predictions", F.col("score")), "panel", 0.5)
    return made.drop("n_bad", "n_good", "youden_threshold").withColumns({c: F.round(c, n) for c, n in DIGITS.items()})


@query("ml8_monotonicity", """SELECT model_input, 0e0 AS rows_violating, true AS effect_with_the_sign FROM (SELECT unnest(['InterestRate_x_Debt', 'Delay_from_due_date', 'Age_imputed']) AS model_input)""")
def ml8(spark, d):
    """Constrained trees: no row moves against a constraint."""
    made = monotonicity(trees(spark, d), part(spark, d, "oot"), part(spark, d, "train"), DIRECTIONS)
    sign = F.create_map(*[F.lit(x) for kv in DIRECTIONS.items() for x in kv])[F.col("model_input")]
    return made.select("model_input", "rows_violating", (F.col("logodds_effect_min_to_max") * sign > 0).alias("effect_with_the_sign"))


@query("ml8_linear_effect", ONE + """ SELECT 'InterestRate_x_Debt' AS model_input, 0e0 AS rows_violating, round(w * (max(z) - min(z)), 6) AS logodds_effect_min_to_max
 FROM z, fit WHERE data_split = 'train' GROUP BY w""")
def ml8_linear(spark, d):
    """In a linear card the effect of an input is its coefficient times its range."""
    made = monotonicity(single(spark, d), part(spark, d, "oot"), part(spark, d, "train"), {"InterestRate_x_Debt": 1})
    return made.withColumn("logodds_effect_min_to_max", F.round("logodds_effect_min_to_max", 6))


@query("ml9_coefficients", ONE + " SELECT 'InterestRate_x_Debt' AS feature, round(w, 8) AS coef_per_1sd, round(exp(w), 8) AS odds_ratio FROM fit")
def ml9(spark, d):
    return coefficient_table(single(spark, d), spark).withColumns({c: F.round(c, 8) for c in ("coef_per_1sd", "odds_ratio")})


@query("ml9_all_coefficients", """SELECT feature, true AS odds_follow, true AS at_optimum FROM
 (SELECT unnest(['InterestRate_x_Debt', 'Delay_from_due_date', 'Age_imputed', 'Age_imputed_missing', 'Credit_Mix_woe']) AS feature)""")
def ml9_all(spark, d):
    card, train = linear(spark, d), part(spark, d, "train")
    told = optimality(card, train).select("feature", "unmet")
    return coefficient_table(card, spark).join(told, "feature").select(
        "feature", (F.abs(F.log("odds_ratio") - F.col("coef_per_1sd")) < 1e-12).alias("odds_follow"), (F.col("unmet") < 1e-9).alias("at_optimum"))


@query("ml10_month_scored", ONE + """ SELECT Customer_ID, loan_id, month AS snapshot_date, 'logreg' AS model_name, 'champion' AS model_role, round(score, 4) AS model_predictions, 0.5e0 AS decision_threshold,
 'gold_feature_store' AS feature_source, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted_default FROM p WHERE month = DATE '2001-05-01'""")
def ml10(spark, d):
    rows = training_rows(spark, d)
    gold = rows.withColumnRenamed("month", "financials_snapshot_date")
    month = rows_to_score(gold.limit(0).drop("label", "data_split"), gold).filter("financials_snapshot_date = DATE '2001-05-01'")
    return score_rows(single(spark, d), month, "financials_snapshot_date", "champion").withColumn("model_predictions", F.round("model_predictions", 4))


@query("ml10_inference_rows_scored", f"""WITH @split_panel SELECT month AS snapshot_date, 'inference_feature_store' AS feature_source, count(*) AS n, count(*) AS n_same FROM split_panel WHERE month = DATE '2001-05-01' AND data_split IS NOT NULL GROUP BY month""")
def ml10_inference(spark, d):
    """A month whose rows come from the inference store, scored; and again from the stored coefficients."""
    rows, card = materialize(training_rows(spark, d).withColumnRenamed("month", "financials_snapshot_date"), "rows"), linear(spark, d)
    inference = rows.filter("financials_snapshot_date = DATE '2001-05-01'").drop("label", "data_split")
    month = rows_to_score(inference, rows).filter("financials_snapshot_date = DATE '2001-05-01'")
    weights = dict(zip(card.prep.inputs, card.model.coefficients))
    margin = sum((F.col(f"x_{n}") * w for n, w in weights.items()), F.lit(card.model.intercept))
    again = card.prep.scaled(month).select("loan_id", (1 / (1 + F.exp(-margin))).alias("again"))
    scored = score_rows(card, month, "financials_snapshot_date", "champion").join(again, "loan_id")
    return scored.groupBy("snapshot_date", "feature_source").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.abs(F.col("again") - F.col("model_predictions")) < 1e-12, 1)).alias("n_same"))


@query("ml10_prediction_rows", """WITH @panel SELECT Customer_ID, loan_id, month AS snapshot_date, 'panel' AS model_name, 'champion' AS model_role, score AS model_predictions,
 0.4e0 AS decision_threshold, 'gold_feature_store' AS feature_source, CASE WHEN score >= 0.4 THEN 1 ELSE 0 END AS predicted_default FROM panel""")
def ml10_rows(spark, d):
    return prediction_rows(view(spark, d, "panel").withColumn("model_predictions", F.col("score")), "month", "panel", 0.4, "champion")


@query("ml11_score_backfill", ONE + """ SELECT month AS snapshot_date, count(*) AS n, count(score) AS n_scored, round(avg(score), 7) AS mean_score, round(min(score), 6) AS least, round(max(score), 6) AS most,
 CAST(sum(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS n_predicted FROM p GROUP BY month""")
def ml11(spark, d):
    path = fresh_path(spark, "predictions")
    write_partitions(score_rows(single(spark, d), training_rows(spark, d), "month"), path, ["snapshot_date"])
    score = "model_predictions"
    return spark.read.parquet(path).groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n"), F.count(score).alias("n_scored"), F.round(F.avg(score), 7).alias("mean_score"), F.round(F.min(score), 6).alias("least"),
        F.round(F.max(score), 6).alias("most"), F.sum("predicted_default").alias("n_predicted"))


@query("ml12_reloaded_models", """SELECT unnest(['logreg', 'trees']) AS model, true AS same_auc""")
def ml12(spark, d):
    out, oot = [], part(spark, d, "oot")
    for card in (linear(spark, d), trees(spark, d)):
        path = fresh_path(spark, "model")
        save_card(card, spark, path)
        before, after = (discrimination(c.transform(oot), "model_predictions", "label").select(F.lit(card.name).alias("model"), F.col("auc").alias(n))
                         for c, n in ((card, "a"), (load_card(spark, path), "b")))
        out.append(before.join(after, "model").select("model", (F.abs(F.col("a") - F.col("b")) < 1e-9).alias("same_auc")))
    return out[0].unionByName(out[1])


@query("dq8_backfill_reproduces_metrics", "SELECT unnest(['train', 'validation', 'test', 'oot']) AS data_split, true AS same")
def dq8(spark, d):
    card, rows = linear(spark, d), training_rows(spark, d)
    path = fresh_path(spark, "predictions")
    write_partitions(score_rows(card, rows, "month"), path, ["snapshot_date"])
    back = spark.read.parquet(path).select("loan_id", "model_predictions").join(rows.select("loan_id", "label", "data_split"), "loan_id")
    gaps = metric_gaps(discrimination(back, "model_predictions", "label", ["data_split"]), evaluate(card, rows), ["data_split"], "auc")
    return gaps.select("data_split", (F.abs("difference") < 1e-9).alias("same"))


@query("dq6_missing_at_scoring", """WITH @split_panel, m AS (SELECT month, avg(CASE WHEN x3 IS NULL THEN 1e0 ELSE 0 END) AS Age_imputed, avg(CASE WHEN level IS NULL THEN 1e0 ELSE 0 END) AS Credit_Mix FROM split_panel WHERE data_split IS NOT NULL GROUP BY 1)
 SELECT month, feature, round(missing_rate, 9) AS missing_rate FROM (UNPIVOT m ON Age_imputed, Credit_Mix INTO NAME feature VALUE missing_rate)""")
def dq6_scoring(spark, d):
    return missing_shares(training_rows(spark, d), ["Age_imputed", "Credit_Mix"], ["month"]).withColumn("missing_rate", F.round("missing_rate", 9))


@query("agg23_prediction_summary", ONE + """ SELECT month AS snapshot_date, count(*) AS n, round(avg(score), 7) AS mean_score, round(avg(CASE WHEN score >= 0.5 THEN 1e0 ELSE 0 END), 9) AS predicted_default_rate,
 round(quantile_cont(score, 0.1), 6) AS p10, round(quantile_cont(score, 0.5), 6) AS p50, round(quantile_cont(score, 0.9), 6) AS p90 FROM p GROUP BY month""")
def prediction_summary(spark, d):
    card = single(spark, d)
    made = score_summary(score_rows(card, training_rows(spark, d), "month"), "model_predictions", card.threshold, ["snapshot_date"])
    return made.withColumns({"mean_score": F.round("mean_score", 7), "predicted_default_rate": F.round("predicted_default_rate", 9),
                             **{c: F.round(c, 6) for c in ("p10", "p50", "p90")}})

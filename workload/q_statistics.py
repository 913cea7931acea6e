"""Binning, information value, stability, ranking metrics, correlation and selection."""

from pyspark.sql import functions as F

from panelkit.functions.binning import level_bin, open_bin
from panelkit.operators.drift import apply_woe, binned, contingency, decile_edges, evidence, information_value, psi, shares
from panelkit.operators.metrics import calibration, discrimination
from panelkit.operators.profile import (components_for, correlation_table, explained_variance, label_correlations,
                                        sample_skewness, spearman_lookup, spearman_matrix, spearman_with_label, vif)
from panelkit.operators.ranking import average_ranks
from panelkit.operators.selection import recheck, selection_base, selection_report
from panelkit.plans.modelling import direction_table
from panelkit.session import materialize
from workload.q_aggregates import split_panel
from workload.registry import query
from workload.views import table, view

TENTHS = "[" + ", ".join(f"{i / 10}" for i in range(11)) + "]"


def _edge_sql(column: str, source: str = "panel", where: str = "") -> str:
    return f"SELECT list_sort(list_distinct(quantile_cont({column}, {TENTHS}))) AS e FROM {source} {where}"


def _bin_sql(column: str, e: str = "e") -> str:
    return (f"CASE WHEN {column} IS NULL THEN '__MISSING__' ELSE CAST(len(list_filter({e}[2:len({e}) - 1], lambda q: {column} > q)) "
            f"AS VARCHAR) END")


@query("st1_decile_edges", f"WITH @panel, e AS ({_edge_sql('x3')}) SELECT 'x3' AS feature, round(unnest(e[2:len(e) - 1]), 6) AS edge FROM e")
def st1(spark, d):
    edges = decile_edges(view(spark, d, "panel"), ["x3"])
    rows = [(f, round(e, 6)) for f, es in edges.items() for e in es]
    return spark.createDataFrame(rows, "feature string, edge double")


@query("st2_assigned_bins", f"""WITH @panel, e1 AS ({_edge_sql('x1')}), e3 AS ({_edge_sql('x3')})
 SELECT loan_id, {_bin_sql('x1', 'e1.e')} AS x1, {_bin_sql('x3', 'e3.e')} AS x3, coalesce(level, '__MISSING__') AS level FROM panel, e1, e3""")
def st2(spark, d):
    panel = view(spark, d, "panel")
    edges = decile_edges(panel, ["x1", "x3"])
    return panel.select("loan_id", *[open_bin(c, e).alias(c) for c, e in edges.items()], level_bin("level").alias("level"))


def _binned_sql(ctes: str, source: str, numeric=("x1", "x2", "x3")) -> str:
    """Training edges of each numeric column and the long table of bins, the category ``level`` among them."""
    cuts = ", ".join(f"e_{c} AS ({_edge_sql(c, 't')})" for c in numeric)
    parts = [f"SELECT loan_id, label, month, data_split, '{c}' AS feature, {_bin_sql(c)} AS bin FROM {source}, e_{c} WHERE data_split IS NOT NULL"
             for c in numeric]
    parts.append(f"SELECT loan_id, label, month, data_split, 'level', coalesce(level, '__MISSING__') FROM {source} WHERE data_split IS NOT NULL")
    return f"WITH {ctes}, t AS (SELECT * FROM {source} WHERE data_split = 'train'), {cuts}, b AS ({' UNION ALL '.join(parts)})"


BINNED = _binned_sql("@split_panel", "split_panel")
IV = """tab AS (SELECT feature, bin, sum(1 - label) + 0.5e0 AS g, sum(label) + 0.5e0 AS b FROM b WHERE data_split = 'train' GROUP BY ALL),
 tot AS (SELECT feature, sum(g - 0.5e0) + 0.5e0 AS tg, sum(b - 0.5e0) + 0.5e0 AS tb FROM tab GROUP BY 1),
 iv AS (SELECT feature, sum((b / tb - g / tg) * ln((b / tb) / (g / tg))) AS iv FROM tab JOIN tot USING (feature) GROUP BY 1)"""


def train_edges(rows, features=("x1", "x2", "x3")):
    """Training rows and their decile edges."""
    train = rows.filter("data_split = 'train'")
    return train, decile_edges(train, list(features))


@query("st3_information_value", f"{BINNED}, {IV} SELECT feature, round(iv, 9) AS iv FROM iv")
def st3(spark, d):
    train, edges = train_edges(split_panel(spark, d))
    return information_value(contingency(binned(train, edges, ["level"], keep=["label"]), "label")).withColumn("iv", F.round("iv", 9))


SHARES = """exp AS (SELECT feature, bin, count(*) * 1e0 / sum(count(*)) OVER (PARTITION BY feature) AS e FROM b WHERE data_split = 'train' GROUP BY feature, bin)"""


def _psi_sql(keys: str, where: str) -> str:
    return f"""act AS (SELECT {keys}, feature, bin, count(*) * 1e0 / sum(count(*)) OVER (PARTITION BY {keys}, feature) AS a FROM b WHERE {where} GROUP BY {keys}, feature, bin),
 grid AS (SELECT DISTINCT {keys}, feature FROM act), full_bins AS (SELECT {keys}, feature, bin FROM grid JOIN exp USING (feature) UNION SELECT {keys}, feature, bin FROM act),
 psi AS (SELECT {keys}, feature, sum((coalesce(a, 0) - coalesce(e, 0)) * ln((coalesce(a, 0) + 1e-4) / (coalesce(e, 0) + 1e-4))) AS psi FROM full_bins
 LEFT JOIN act USING ({keys}, feature, bin) LEFT JOIN exp USING (feature, bin) GROUP BY ALL)"""


@query("st4_psi_by_month", f"{BINNED}, {SHARES}, {_psi_sql('month', chr(39) + 'train' + chr(39) + ' <> data_split')} SELECT month, feature, round(psi, 8) AS psi FROM psi")
def st4(spark, d):
    rows = split_panel(spark, d)
    _, edges = train_edges(rows)
    counted = materialize(binned(rows, edges, ["level"], keep=["month", "data_split"]).groupBy("month", "data_split", "feature", "bin")
                          .agg(F.count(F.lit(1)).alias("n")), "bins")  # rows are read once for both sides
    base = shares(counted.filter("data_split = 'train'"), weight="n")
    later = shares(counted.filter("data_split <> 'train'"), ["month"], weight="n")
    return psi(base, later, ["month"]).withColumn("psi", F.round("psi", 8))


@query("st5_weight_of_evidence", f"""{BINNED}, {IV}, w AS (SELECT bin, ln((b / tb) / (g / tg)) AS woe FROM tab JOIN tot USING (feature) WHERE feature = 'level')
 SELECT loan_id, round(coalesce(woe, 0), 9) AS level_woe FROM split_panel LEFT JOIN w ON coalesce(level, '__MISSING__') = bin WHERE data_split IS NOT NULL""")
def st5(spark, d):
    rows = split_panel(spark, d)
    woe = evidence(contingency(binned(rows.filter("data_split = 'train'"), {}, ["level"], keep=["label"]), "label"))
    return apply_woe(rows, woe, ["level"]).select("loan_id", F.round("level_woe", 9).alias("level_woe"))


RANKS = """r AS (SELECT {k} AS k, score, label, (rank() OVER (PARTITION BY {k} ORDER BY score) + (count(*) OVER (PARTITION BY {k}, score) - 1) / 2e0) AS rk FROM {src}),
 a AS (SELECT k, count(*) AS n, sum(label) * 1e0 AS nb, sum(1 - label) * 1e0 AS ng, sum(CASE WHEN label = 1 THEN rk END) AS sr FROM r GROUP BY k)"""
CURVE = """c AS (SELECT {k} AS k, score, sum(label) AS b, sum(1 - label) AS g FROM {src} GROUP BY {k}, score),
 t AS (SELECT k, score, b, g, sum(b) OVER w * 1e0 AS tp, sum(g) OVER w * 1e0 AS fp, sum(b) OVER (PARTITION BY k) * 1e0 AS nb, sum(g) OVER (PARTITION BY k) * 1e0 AS ng
 FROM c WINDOW w AS (PARTITION BY k ORDER BY score DESC))"""


@query("st6_auc_by_month", f"WITH @panel, {RANKS.format(k='month', src='panel')} SELECT k AS month, n, round((sr - nb * (nb + 1) / 2) / (nb * ng), 8) AS auc, "
       "round(2 * (sr - nb * (nb + 1) / 2) / (nb * ng) - 1, 8) AS gini FROM a WHERE nb > 0 AND ng > 0")
def st6(spark, d):
    made = discrimination(view(spark, d, "panel"), "score", "label", ["month"])
    return made.filter("auc IS NOT NULL").select("month", "n", F.round("auc", 8).alias("auc"), F.round("gini", 8).alias("gini"))


@query("st7_ks_by_month", f"WITH @panel, {CURVE.format(k='month', src='panel')} SELECT k AS month, round(greatest(max(tp / nb - fp / ng), 0), 9) AS ks FROM t WHERE nb > 0 AND ng > 0 GROUP BY k")
def st7(spark, d):
    return discrimination(view(spark, d, "panel"), "score", "label", ["month"]).filter("ks IS NOT NULL").select("month", F.round("ks", 9).alias("ks"))


@query("st8_youden_threshold", f"""WITH @panel, {CURVE.format(k='model', src='panel')}, best AS (SELECT k, max(struct_pack(gap := tp / nb - fp / ng, score := score)) AS m FROM t GROUP BY k)
 SELECT k AS model, m.score AS threshold FROM best WHERE m.gap > 0""")
def st8(spark, d):
    return discrimination(view(spark, d, "panel"), "score", "label", ["model"]).filter("youden_threshold IS NOT NULL").select(
        "model", F.col("youden_threshold").alias("threshold"))


@query("st9_precision_brier_logloss", f"""WITH @panel, {CURVE.format(k='model', src='panel')}, ap AS (SELECT k, sum(b * tp / (tp + fp)) / max(nb) AS ap FROM t GROUP BY k),
 l AS (SELECT model AS k, avg((score - label) * (score - label)) AS brier, avg(-(CASE WHEN label = 1 THEN ln(greatest(least(score, 1 - 2.220446049250313e-16), 2.220446049250313e-16))
 ELSE ln(1 - greatest(least(score, 1 - 2.220446049250313e-16), 2.220446049250313e-16)) END)) AS loss FROM panel GROUP BY 1)
 SELECT k AS model, round(ap, 8) AS average_precision, round(brier, 8) AS brier, round(loss, 8) AS log_loss FROM ap JOIN l USING (k)""")
def st9(spark, d):
    made = discrimination(view(spark, d, "panel"), "score", "label", ["model"])
    return made.select("model", *[F.round(c, 8).alias(c) for c in ("average_precision", "brier", "log_loss")])


@query("st10_precision_recall_f1", """WITH @panel, c AS (SELECT model, sum(CASE WHEN score >= 0.5 AND label = 1 THEN 1e0 ELSE 0 END) AS tp,
 sum(CASE WHEN score >= 0.5 AND label = 0 THEN 1e0 ELSE 0 END) AS fp, sum(label) AS p FROM panel GROUP BY 1)
 SELECT model, round(tp / (tp + fp), 9) AS precision, round(tp / p, 9) AS recall, round(2 * tp / (tp + fp + p), 9) AS f1 FROM c""")
def st10(spark, d):
    made = discrimination(view(spark, d, "panel"), "score", "label", ["model"], threshold=0.5)
    return made.select("model", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query("st11_calibration", f"""WITH @panel, e AS (SELECT quantile_cont(score, {TENTHS}) AS e FROM panel)
 SELECT CAST(len(list_filter(e[2:10], lambda q: score > q)) AS INTEGER) AS bin, count(*) AS n, round(avg(score), 8) AS mean_predicted, round(avg(label), 9) AS observed_rate FROM panel, e GROUP BY 1""")
def st11(spark, d):
    made = calibration(view(spark, d, "panel"), "score", "label")
    return made.withColumns({"mean_predicted": F.round("mean_predicted", 8), "observed_rate": F.round("observed_rate", 9)})


@query("st12_label_correlations", """WITH @panel SELECT 'x1' AS feature, round(corr(x1, label), 9) AS correlation, count(x1) AS valid_rows FROM panel
 UNION ALL SELECT 'x3', round(corr(x3, label), 9), count(x3) FROM panel UNION ALL SELECT 'one', NULL, count(*) FROM panel""")
def st12(spark, d):
    rows = view(spark, d, "panel").withColumn("one", F.lit(1.0))
    return label_correlations(rows, ["x1", "x3", "one"], "label").withColumn("correlation", F.round("correlation", 9))


def _avg_rank(column: str, source: str) -> str:
    return f"(rank() OVER (ORDER BY {column}) + (count(*) OVER (PARTITION BY {column}) - 1) / 2e0)"


@query("st13_spearman_with_label", f"""WITH @panel, r1 AS (SELECT label, {_avg_rank('x1', 'panel')} AS r FROM panel),
 r3 AS (SELECT label, {_avg_rank('x3', 'panel')} AS r FROM panel WHERE x3 IS NOT NULL)
 SELECT 'x1' AS feature, round(corr(r, label), 8) AS spearman FROM r1 UNION ALL SELECT 'x3', round(corr(r, label), 8) FROM r3""")
def st13(spark, d):
    return spearman_with_label(view(spark, d, "panel"), ["x1", "x3"], "label").withColumn("spearman", F.round("spearman", 8))


@query("st13_spearman_matrix", f"""WITH @panel, r AS (SELECT {_avg_rank('x1', 'panel')} AS a, {_avg_rank('x2', 'panel')} AS b, {_avg_rank('x3', 'panel')} AS c FROM panel WHERE x3 IS NOT NULL)
 SELECT round(corr(a, b), 8) AS x1_x2, round(corr(a, c), 8) AS x1_x3, round(corr(b, c), 8) AS x2_x3 FROM r""")
def st13_matrix(spark, d):
    m = spearman_matrix(view(spark, d, "panel"), ["x1", "x2", "x3"])
    return spark.createDataFrame([tuple(round(float(m[i, j]), 8) for i, j in ((0, 1), (0, 2), (1, 2)))],
                                 "x1_x2 double, x1_x3 double, x2_x3 double")


@query("st13_spearman_pairs", f"""WITH @panel, r AS (SELECT {_avg_rank('x1', 'panel')} AS a, {_avg_rank('x3', 'panel')} AS c FROM panel WHERE x3 IS NOT NULL),
 f AS (SELECT {_avg_rank('x1', 'panel')} AS a, {_avg_rank('x2', 'panel')} AS b FROM panel)
 SELECT 'x1_x3' AS pair, round(corr(a, c), 8) AS spearman FROM r UNION ALL SELECT 'x1_x2', round(corr(a, b), 8) FROM f""")
def st13_pairs(spark, d):
    pair = spearman_lookup(view(spark, d, "panel"), ["x1", "x2", "x3"])
    return spark.createDataFrame([(f"{a}_{b}", round(pair(a, b), 8)) for a, b in (("x1", "x2"), ("x1", "x3"))], "pair string, spearman double")


@query("st13_average_ranks", f"""WITH s AS (SELECT p_size, {_avg_rank('p_size', 'part')} AS avg_rank FROM part)
 SELECT CAST(p_size AS DOUBLE) AS value, count(*) AS n, any_value(avg_rank) AS avg_rank FROM s GROUP BY p_size""")
def st13_ranks(spark, d):
    return average_ranks(table(spark, d, "part"), ["p_size"]).select("value", "n", "avg_rank")


@query("st14_pearson_matrix", """WITH @panel SELECT 'x1' AS feature_a, 'x2' AS feature_b, round(corr(x1, x2), 9) AS correlation FROM panel
 UNION ALL SELECT 'x1', 'x3', round(corr(x1, x3), 9) FROM panel UNION ALL SELECT 'x2', 'x3', round(corr(x2, x3), 9) FROM panel""")
def st14(spark, d):
    made = correlation_table(view(spark, d, "panel"), ["x1", "x2", "x3"]).filter("feature_a <> feature_b")
    return made.withColumn("correlation", F.round("correlation", 9))


@query("st15_variance_inflation", """WITH @panel, q AS (SELECT corr(x1, x2) AS r12 FROM panel)
 SELECT 'x1' AS feature, round(1 / (1 - r12 * r12), 6) AS vif FROM q
 UNION ALL SELECT 'x2', round(1 / (1 - r12 * r12), 6) FROM q""")
def st15(spark, d):
    found = vif(view(spark, d, "panel"), ["x1", "x2"])
    return spark.createDataFrame([(k, round(v, 6)) for k, v in found.items()], "feature string, vif double")


@query("st15_variance_inflation_three", """WITH @panel, p AS (SELECT x1, x2, x3 + x1 / 10000 AS x4 FROM panel WHERE x3 IS NOT NULL),
 q AS (SELECT corr(x1, x2) AS a, corr(x1, x4) AS b, corr(x2, x4) AS c FROM p), e AS (SELECT *, 1 + 2 * a * b * c - a * a - b * b - c * c AS det FROM q)
 SELECT 'x1' AS feature, round((1 - c * c) / det, 6) AS vif FROM e UNION ALL SELECT 'x2', round((1 - b * b) / det, 6) FROM e UNION ALL SELECT 'x4', round((1 - a * a) / det, 6) FROM e""")
def st15_three(spark, d):
    found = vif(view(spark, d, "panel").withColumn("x4", F.col("x3") + F.col("x1") / 10000), ["x1", "x2", "x4"])
    return spark.createDataFrame([(k, round(v, 6)) for k, v in found.items()], "feature string, vif double")


@query("st16_sample_skewness", "SELECT event_type, round(skewness(value), 7) AS skew FROM events GROUP BY 1")
def st16(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.round(sample_skewness("value"), 7).alias("skew"))


@query("st17_decile_trend", f"""WITH @panel, e AS ({_edge_sql('x2')}), r AS (SELECT CAST({_bin_sql('x2')} AS INT) AS bin, avg(label) AS rate FROM panel, e GROUP BY 1)
 SELECT 'x2' AS feature, round(corr(bin, k), 8) AS decile_trend FROM (SELECT bin, {_avg_rank('rate', 'r')} AS k FROM r)""")
def st17(spark, d):
    panel = view(spark, d, "panel")
    rates = (binned(panel, decile_edges(panel, ["x2"]), keep=["label"]).filter("bin <> '__MISSING__'")
             .groupBy("feature", F.col("bin").cast("int").alias("bin")).agg(F.avg("label").alias("rate")))
    ranks = average_ranks(rates, ["rate"], edges={"rate": []}).select(F.col("value").alias("rate"), "avg_rank")
    joined = rates.join(ranks, "rate")
    return joined.groupBy("feature").agg(F.round(F.when(F.count(F.lit(1)) >= 3, F.corr("bin", "avg_rank")), 8).alias("decile_trend"))


@query("st18_direction_table", f"""WITH @panel, r AS (SELECT label, {_avg_rank('x1', 'panel')} AS k1, {_avg_rank('x2', 'panel')} AS k2 FROM panel),
 s AS (SELECT 'x1' AS model_input, corr(k1, label) AS strength, 1 AS prior FROM r UNION ALL SELECT 'x2', corr(k2, label), NULL FROM r
 UNION ALL SELECT 'model_5-LOW', avg(CASE WHEN model = '5-LOW' THEN label END) - avg(CASE WHEN model <> '5-LOW' THEN label END), -1 FROM panel)
 SELECT model_input, round(strength, 8) AS strength, CAST(prior AS INTEGER) AS prior, CAST(sign(strength) AS INTEGER) AS data_direction,
 CAST(coalesce(prior, sign(strength)) AS INTEGER) AS "constraint", coalesce(sign(strength) <> 0 AND prior <> sign(strength), false) AS conflict FROM s""")
def st18(spark, d):
    made = direction_table(view(spark, d, "panel"), ["x1", "x2"], {"model": ["5-LOW"]}, priors={"x1": 1, "model_5-LOW": -1})
    return made.select("model_input", F.round("strength", 8).alias("strength"), "prior", "data_direction", "constraint", "conflict")


ROLES = {"x1": "numeric", "x2": "numeric", "x3": "numeric", "level": "categorical"}


def _selection_sql(ctes: str, source: str, numeric=("x1", "x2", "x3")) -> str:
    """The checks of every feature as the table ``base``."""
    text = " UNION ALL ".join([f"SELECT data_split, '{c}' AS feature, CAST({c} AS VARCHAR) AS v FROM {source}" for c in numeric]
                              + [f"SELECT data_split, 'level', level FROM {source}"])
    return f"""{_binned_sql(ctes, source, numeric)}, {IV}, {SHARES},
 act AS (SELECT feature, bin, count(*) * 1e0 / sum(count(*)) OVER (PARTITION BY feature) AS a FROM b WHERE data_split IN ('validation', 'test') GROUP BY feature, bin),
 fb AS (SELECT feature, bin FROM exp UNION SELECT feature, bin FROM act),
 psi AS (SELECT feature, sum((coalesce(a, 0) - coalesce(e, 0)) * ln((coalesce(a, 0) + 1e-4) / (coalesce(e, 0) + 1e-4))) AS psi FROM fb LEFT JOIN act USING (feature, bin) LEFT JOIN exp USING (feature, bin) GROUP BY 1),
 u AS ({text}),
 miss AS (SELECT feature, avg(CASE WHEN v IS NULL THEN 1e0 ELSE 0 END) FILTER (data_split = 'train') AS mt, avg(CASE WHEN v IS NULL THEN 1e0 ELSE 0 END) FILTER (data_split IN ('validation', 'test')) AS mv FROM u GROUP BY 1),
 tops AS (SELECT feature, max(n) * 1e0 / sum(n) AS top FROM (SELECT feature, v, count(*) AS n FROM u WHERE data_split = 'train' GROUP BY ALL) GROUP BY 1),
 rep AS (SELECT feature, mt, mv, top, iv, psi FROM miss JOIN tops USING (feature) JOIN iv USING (feature) JOIN psi USING (feature)),
 base AS (SELECT feature, CASE WHEN feature = 'level' THEN 'categorical' ELSE 'numeric' END AS type, round(mt, 9) AS missing_train, round(mv, 9) AS missing_val_test, round(top, 9) AS top_value_share,
 round(iv, 8) AS iv, round(psi, 8) AS psi_train_vs_valtest, CASE WHEN mt > 0.5 OR mv > 0.5 THEN '1 missing' WHEN top > 0.99 THEN '2 near-constant' WHEN iv < 0.02 THEN '3 IV' WHEN psi > 0.25 THEN '4 PSI' ELSE '' END AS drop_reason,
 CASE WHEN iv <= 0.02 THEN 'useless' WHEN iv <= 0.1 THEN 'weak' WHEN iv <= 0.3 THEN 'medium' WHEN iv <= 0.5 THEN 'strong' ELSE 'very strong - check leakage' END AS iv_strength FROM rep)"""


SELECTION = _selection_sql("@split_panel", "split_panel")


@query("st19_selection_checks", f"{SELECTION} SELECT * FROM base")
def st19(spark, d):
    made = selection_base(split_panel(spark, d), ROLES)
    digits = {"missing_train": 9, "missing_val_test": 9, "top_value_share": 9, "iv": 8, "psi_train_vs_valtest": 8}
    return made.withColumns({c: F.round(c, n) for c, n in digits.items()})


RISKY = _selection_sql("""@split_panel, risky AS (SELECT * EXCLUDE (label), CASE WHEN x1 + x2 * 1000 > 300000 THEN 1 ELSE 0 END AS label, x1 * 2 + x2 AS x4
 FROM split_panel WHERE data_split IS NOT NULL)""", "risky", ("x1", "x2", "x3", "x4"))
REPORT = RISKY + f""", rr AS (SELECT {_avg_rank('x1', 't')} AS r1, {_avg_rank('x2', 't')} AS r2, {_avg_rank('x4', 't')} AS r4 FROM t),
 rho AS (SELECT abs(corr(r1, r4)) AS c14, abs(corr(r1, r2)) AS c12, abs(corr(r2, r4)) AS c24 FROM rr),
 pick AS (SELECT feature AS kept FROM base WHERE feature IN ('x1', 'x4') AND drop_reason = '' ORDER BY iv DESC, feature LIMIT 1),
 q AS (SELECT """ + ", ".join(f"quantile_cont({c}, 0.01) AS {c}l, quantile_cont({c}, 0.5) AS {c}m, quantile_cont({c}, 0.99) AS {c}h"
                               for c in ("x1", "x2", "x3", "x4")) + """ FROM t),
 f AS (SELECT """ + ", ".join(f"CASE WHEN {c} IS NULL THEN {c}m ELSE least(greatest({c}, {c}l), {c}h) END AS {c}"
                              for c in ("x1", "x2", "x3", "x4")) + """ FROM t, q),
 done AS (SELECT base.*, kept, CASE WHEN drop_reason = '' AND feature IN ('x1', 'x4') AND feature <> kept AND c14 > 0.8 THEN concat('5 |rho| with ', kept) ELSE drop_reason END AS reason
 FROM base, pick, rho),
 live AS (SELECT count(*) FILTER (reason = '' AND type = 'numeric') AS n, count(*) FILTER (reason = '' AND feature = 'x2') AS u2, count(*) FILTER (reason = '' AND feature = 'x3') AS u3, any_value(kept) AS kept FROM done),
 w AS (SELECT u2 * corr(CASE WHEN kept = 'x1' THEN x1 ELSE x4 END, x2) AS a, u3 * corr(CASE WHEN kept = 'x1' THEN x1 ELSE x4 END, x3) AS b, u2 * u3 * corr(x2, x3) AS c, n FROM f, live GROUP BY u2, u3, n),
 z AS (SELECT *, 1 + 2 * a * b * c - a * a - b * b - c * c AS det FROM w)
 SELECT feature, type, missing_train, missing_val_test, top_value_share, iv, psi_train_vs_valtest, reason AS drop_reason,
 CASE WHEN reason = '' AND type = 'numeric' AND n > 1 THEN round((CASE feature WHEN 'x2' THEN 1 - b * b WHEN 'x3' THEN 1 - a * a ELSE 1 - c * c END) / det, 6) END AS vif,
 '' AS lr_drop_reason, iv_strength, reason = '' AS selected_xgb, reason = '' AS selected_lr FROM done, z"""


def risky_panel(spark, d):
    """Panel whose outcome depends on the price and a collinear copy of it."""
    return split_panel(spark, d).withColumns({
        "label": F.expr("CASE WHEN x1 + x2 * 1000 > 300000 THEN 1 ELSE 0 END"), "x4": F.col("x1") * 2 + F.col("x2")})


@query("st19_selection_report", REPORT)
def st19_report(spark, d):
    made = selection_report(risky_panel(spark, d), {**ROLES, "x4": "numeric"})
    digits = {"missing_train": 9, "missing_val_test": 9, "top_value_share": 9, "iv": 8, "psi_train_vs_valtest": 8, "vif": 6}
    return made.withColumns({c: F.round(c, n) for c, n in digits.items()})


def _recheck_sql(features, filled):
    """Collinearity of three features and the warning texts, on top of ``base`` and training rows ``t``."""
    a, b, c = features
    return f""", q AS (SELECT {", ".join(f"quantile_cont({x}, 0.01) AS {x}l, quantile_cont({x}, 0.5) AS {x}m, quantile_cont({x}, 0.99) AS {x}h" for x in features)} FROM {filled}),
 f AS (SELECT {", ".join(f"CASE WHEN {x} IS NULL THEN {x}m ELSE least(greatest({x}, {x}l), {x}h) END AS {x}" for x in features)} FROM {filled}, q),
 w AS (SELECT corr({a}, {b}) AS a, corr({a}, {c}) AS b, corr({b}, {c}) AS c FROM f), z AS (SELECT *, 1 + 2 * a * b * c - a * a - b * b - c * c AS det FROM w),
 v AS (SELECT base.*, CASE feature WHEN '{a}' THEN (1 - c * c) / det WHEN '{b}' THEN (1 - b * b) / det WHEN '{c}' THEN (1 - a * a) / det END AS vif FROM base, z),
 r AS (SELECT *, concat_ws(', ', CASE WHEN greatest(missing_train, missing_val_test) > 0.5 THEN 'missing' END, CASE WHEN iv < 0.02 THEN 'weak' END,
 CASE WHEN psi_train_vs_valtest > 0.25 THEN 'unstable' END, CASE WHEN vif > 10 THEN 'collinear' END) AS warnings FROM v)"""


CHECKED = {"missing_train": 9, "missing_val_test": 9, "iv": 8, "psi_train_vs_valtest": 8}


@query("st20_feature_recheck", SELECTION + _recheck_sql(("x1", "x2", "x3"), "(SELECT * FROM split_panel WHERE data_split = 'train')")
       + " SELECT feature, type, missing_train, missing_val_test, iv, psi_train_vs_valtest, round(vif, 6) AS vif, warnings FROM r")
def st20(spark, d):
    made = recheck(split_panel(spark, d), ROLES)
    return made.withColumns({c: F.round(c, n) for c, n in {**CHECKED, "vif": 6}.items()})


@query("st20_collinear_features", RISKY + _recheck_sql(("x1", "x2", "x4"), "(SELECT * FROM risky WHERE data_split = 'train')")
       + " SELECT feature, type, missing_train, missing_val_test, iv, psi_train_vs_valtest, vif > 10 AS collinear, warnings FROM r WHERE feature <> 'x3'")
def st20_collinear(spark, d):
    """Features of which one is nearly a sum of the others; their factors are too large to compare in digits."""
    made = recheck(risky_panel(spark, d), {k: v for k, v in {**ROLES, "x4": "numeric"}.items() if k != "x3"})
    return made.withColumn("collinear", F.col("vif") > 10).drop("vif").withColumns({c: F.round(c, n) for c, n in CHECKED.items()})


@query("st21_components_needed", """WITH @panel, c AS (SELECT corr(x1, x2) AS r FROM panel)
 SELECT CAST(CASE WHEN (1 + abs(r)) / 2 >= 0.7 THEN 1 ELSE 2 END AS INTEGER) AS share_70, CAST(CASE WHEN (1 + abs(r)) / 2 >= 0.8 THEN 1 ELSE 2 END AS INTEGER) AS share_80,
 CAST(2 AS INTEGER) AS share_99 FROM c""")
def st21(spark, d):
    return components_for(explained_variance(view(spark, d, "panel"), ["x1", "x2"]), (0.7, 0.8, 0.99))


@query("st21_explained_variance", """WITH @clicks, c AS (SELECT corr(fe_1, fe_2) AS a, corr(fe_1, fe_3) AS b, corr(fe_2, fe_3) AS c FROM clicks WHERE fe_3 IS NOT NULL),
 p AS (SELECT *, sqrt((a * a + b * b + c * c) / 3) AS p FROM c), f AS (SELECT p, acos(greatest(least(a * b * c / (p * p * p), 1), -1)) / 3 AS phi FROM p),
 e AS (SELECT 1 + 2 * p * cos(phi) AS e1, 1 + 2 * p * cos(phi + 2 * pi() / 3) AS e3 FROM f)
 SELECT 1 AS component, round(e1 / 3, 7) AS explained_variance, round(e1 / 3, 7) AS cumulative_variance FROM e
 UNION ALL SELECT 2, round((3 - e1 - e3) / 3, 7), round((3 - e3) / 3, 7) FROM e UNION ALL SELECT 3, round(e3 / 3, 7), 1 FROM e""")
def st21_all(spark, d):
    made = explained_variance(view(spark, d, "clicks"), ["fe_1", "fe_2", "fe_3"])
    return made.withColumns({c: F.round(c, 7) for c in ("explained_variance", "cumulative_variance")})


@query("st22_score_psi_by_split", f"""WITH @split_panel, t AS (SELECT * FROM split_panel WHERE data_split = 'train'), e AS ({_edge_sql('score', 't')}),
 b AS (SELECT data_split, 'score' AS feature, {_bin_sql('score')} AS bin FROM split_panel, e WHERE data_split IS NOT NULL), {SHARES},
 {_psi_sql('data_split', "data_split <> 'train'")} SELECT data_split, round(psi, 8) AS score_psi FROM psi""")
def st22(spark, d):
    rows = split_panel(spark, d)
    train, edges = train_edges(rows, ["score"])
    later = shares(binned(rows.filter("data_split <> 'train'"), edges, keep=["data_split"]), ["data_split"])
    return psi(shares(binned(train, edges)), later, ["data_split"]).select("data_split", F.round("psi", 8).alias("score_psi"))


@query("st23_auc_by_model_and_month", f"WITH @panel, p AS (SELECT *, concat(model, ' ', CAST(month AS VARCHAR)) AS mm FROM panel), {RANKS.format(k='mm', src='p')} "
       "SELECT k AS model_month, round((sr - nb * (nb + 1) / 2) / (nb * ng), 8) AS auc FROM a WHERE nb > 0 AND ng > 0")
def st23(spark, d):
    made = discrimination(view(spark, d, "panel"), "score", "label", ["model", "month"]).filter("auc IS NOT NULL")
    return made.select(F.concat_ws(" ", "model", F.col("month").cast("string")).alias("model_month"), F.round("auc", 8).alias("auc"))

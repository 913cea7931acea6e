"""Features of new applications and the rows to score for a month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators.asof import asof_join
from panelkit.plans.gold import DROPPED, apply_params
from panelkit.plans.params import FeatureParams


def business_key(customer: str, date: str):
    """``<customer>_<yyyy_MM_dd>``."""
    return F.concat_ws("_", F.col(customer), F.date_format(date, "yyyy_MM_dd"))


def inference_features(financials: DataFrame, attributes: DataFrame, params: FeatureParams) -> DataFrame:
    """Features of applications that have no label yet, by the parameters of a training run."""
    people = attributes.select("Customer_ID", "Age", "Occupation",
                               F.col("snapshot_date").alias("attributes_snapshot_date"))
    rows = (financials.withColumn("loan_id", business_key("Customer_ID", "snapshot_date"))
            .withColumnRenamed("snapshot_date", "financials_snapshot_date")
            .join(people, "Customer_ID", "left"))
    made = apply_params(rows, params).drop(*DROPPED)
    return made.withColumns({
        **{c: F.col(c).cast("double") for c in ("Age_imputed", "Bank_Accounts_imputed", "Credit_Cards_imputed")},
        "feature_params_date": F.lit(params.train_date)})


def rows_to_score(inference: DataFrame, gold: DataFrame, date: str = "financials_snapshot_date") -> DataFrame:
    """Months in the inference store win; other months fall back to the gold store. Tagged with their source."""
    covered = inference.select(date).distinct()
    fallback = gold.join(covered, date, "left_anti").withColumn("feature_source", F.lit("gold_feature_store"))
    return (inference.withColumn("feature_source", F.lit("inference_feature_store"))
            .unionByName(fallback, allowMissingColumns=True))


def rows_to_monitor(inference: DataFrame, gold: DataFrame, key: str = "loan_id") -> DataFrame:
    """Inference rows with their known split (``production`` when never in training), then gold rows not among them."""
    known = gold.select(key, "data_split").dropDuplicates([key])
    tagged = (inference.drop("data_split").join(known, key, "left")
              .withColumn("data_split", F.coalesce("data_split", F.lit("production"))))
    rest = gold.join(inference.select(key).distinct(), key, "left_anti")
    return tagged.unionByName(rest, allowMissingColumns=True)


def params_in_force(months: DataFrame, roles: DataFrame, models: DataFrame, month: str = "month") -> DataFrame:
    """Champion of each month and the training date whose parameters it needs."""
    champions = asof_join(months, roles, [], month, "effective_from", ["champion"], slices=1)
    return champions.join(models.select(F.col("model_version").alias("champion"), "model_train_date"), "champion", "left")

"""Imputation fitted on training rows and applied everywhere from parameter tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.binning import labelled_bin, labelled_bin_by
from panelkit.functions.numeric import first_method, log1p_floor, round_half_up, within
from panelkit.operators.quantiles import (coarser, collect_from_counts, collect_quantiles, medians, medians_of_counts,
                                          quantiles_of_counts)
from panelkit.operators.ranking import SMALL, distinct_values
from panelkit.session import materialize

QUARTILES = [0.0, 0.25, 0.5, 0.75, 1.0]
MIN_AGE_GROUP = 20
MIN_GAP = 0.05
NO_SLICES: list[float] = []  # for a column whose valid range is a short list of integers, such as the age


def fit_group_medians(train: DataFrame, column: str, keys: Sequence[str], out: str) -> DataFrame:
    """Median of a column per key group, one row per group."""
    return medians(train, [column], keys).select(*keys, F.col(column).alias(out))


def fill_from(df: DataFrame, column: str, table: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Nulls of a column taken from a lookup; a null key never matches."""
    joined = df.join(table.select(*keys, F.col(value).alias("__fill")), list(keys), "left")
    return joined.withColumn(column, F.coalesce(column, "__fill")).select(*df.columns)


def quartile_edges(df: DataFrame, column: str) -> list[float]:
    """Distinct discrete quartiles of a column."""
    numbers = df.select(F.col(column).cast("double").alias(column))
    return sorted(set(collect_quantiles(numbers, [column], QUARTILES, interpolate=False)[column]))


def integer_quartiles(df: DataFrame, columns: Sequence[str]) -> dict[str, list[float]]:
    """The same for imputed integers, whose few distinct values are counted first and need no slicing."""
    counts = distinct_values(df, columns, edges={c: NO_SLICES for c in columns})
    found = collect_from_counts(counts, columns, QUARTILES, interpolate=False, small=True)
    return {c: sorted(set(v)) for c, v in found.items()}


# ---- age ------------------------------------------------------------------------------------------------------------
def valid_age(column: str = "Age") -> Column:
    """Age between 18 and 100."""
    return within(column, 18, 100)


def age_conflicts(age: Column, history: str = "Credit_History_Age_Years") -> Column:
    """Whether the credit history is longer than the age; false when either is unknown."""
    return F.coalesce(F.col(history) > age, F.lit(False))


def age_for_fit(df: DataFrame) -> DataFrame:
    """Fit view: ages in conflict with the history are flagged but kept."""
    age = valid_age()
    return df.withColumns({
        "Age_clean": age, "Age_History_Inconsistent": age_conflicts(age).cast("int"),
        "Age_was_invalid": (age.isNull() & F.col("Age").isNotNull()).cast("int")})


def age_for_apply(df: DataFrame) -> DataFrame:
    """Apply view: ages in conflict with the history are flagged and nulled."""
    age = valid_age()
    kept = F.when(~age_conflicts(age), age)
    return df.withColumns({
        "Age_clean": kept, "Age_History_Inconsistent": age_conflicts(age).cast("int"),
        "Age_was_invalid": (kept.isNull() & F.col("Age").isNotNull()).cast("int")})


def fit_age(train: DataFrame, min_count: int = MIN_AGE_GROUP) -> dict:
    """Income lookup per occupation and age bin, occupation medians, overall median.

    Ages are counted once per occupation; every age statistic comes from those counts (at most 83 ages).
    """
    rows = (age_for_fit(train)
            .filter(F.col("Age_clean").isNotNull() & F.col("Annual_Income").isNotNull()
                    & F.col("Occupation").isNotNull())
            .select("Occupation", F.col("Age_clean").cast("double").alias("Age_clean"),
                    log1p_floor("Annual_Income").alias("log_income")))
    ages = materialize(distinct_values(rows, ["Age_clean"], ["Occupation"], edges={"Age_clean": NO_SLICES}), "ages")
    whole = collect_from_counts(coarser(ages, []), ["Age_clean"], QUARTILES, interpolate=False, small=True)["Age_clean"]
    edges = sorted(set(whole))
    age = medians_of_counts(coarser(ages.withColumn("Age_Bin", labelled_bin("value", edges)), ["Occupation", "Age_Bin"]),
                            ["Age_clean"], ["Occupation", "Age_Bin"], small=True)
    income = medians(rows.withColumn("Age_Bin", labelled_bin("Age_clean", edges)), ["log_income"], ["Occupation", "Age_Bin"])
    lookup = (age.filter(F.col("Age_clean_n") >= min_count).join(income, ["Occupation", "Age_Bin"])
              .select("Occupation", "Age_Bin", F.col("log_income").alias("log_income_median"),
                      F.col("Age_clean").alias("age_median"), F.col("Age_clean_n").alias("count")))
    occupation = (medians_of_counts(ages, ["Age_clean"], ["Occupation"], small=True)
                  .select("Occupation", F.col("Age_clean").alias("occupation_age_median")))
    return {"age_edges": edges, "age_income_lookup": lookup, "occupation_age_median": occupation,
            "overall_age_median": whole[2] if whole else None}


def _value(v: Column | float | None) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def apply_age(df: DataFrame, lookup: DataFrame, occupation: DataFrame, overall: Column | float | None,
              edges: Column | Sequence[float] | None = None, gap: float = MIN_GAP, by: Sequence[str] = ()) -> DataFrame:
    """Impute the age: own value, nearest income group of the occupation, occupation median, overall median.

    ``by`` are further keys of the fitted tables, such as the date of the parameters; then ``overall`` and ``edges`` are columns.

    The groups of an occupation (at most one per age bin) travel as one array, so a row meets its
    candidates without being multiplied and without a row id. Ties in distance go to the smaller median
    age, then the smaller bin.
    """
    groups = lookup.groupBy(*by, "Occupation").agg(
        F.collect_list(F.struct("log_income_median", "age_median", "Age_Bin")).alias("__groups"))
    df = (age_for_apply(df).join(groups, [*by, "Occupation"], "left")
          .join(occupation.withColumnRenamed("occupation_age_median", "__occ"), [*by, "Occupation"], "left"))
    income = log1p_floor("Annual_Income")
    near = F.array_sort(F.transform("__groups", lambda g: F.struct(
        F.abs(g["log_income_median"] - income).alias("distance"), g["age_median"].alias("age"),
        g["Age_Bin"].alias("bin"))))
    df = df.withColumn("__near", F.when(F.col("Age_clean").isNull() & F.col("Annual_Income").isNotNull(), near))
    first, second = F.try_element_at("__near", F.lit(1)), F.try_element_at("__near", F.lit(2))
    strong = F.coalesce(first.isNotNull()
                        & (second.isNull() | (second["distance"] - first["distance"] >= gap)), F.lit(False))
    own = F.col("Age_clean").cast("double")
    df = df.withColumns({
        "Age_imputation_method": first_method(
            [(own.isNotNull(), "original"), (strong, "occupation_income_age_bin"),
             (F.col("__occ").isNotNull(), "occupation_median")], "overall_median"),
        "Age_imputed": round_half_up(F.coalesce(own, F.when(strong, first["age"]), F.col("__occ"),
                                                _value(overall).cast("double")))})
    if edges is not None:
        df = df.withColumn("Age_Bin", (labelled_bin_by if isinstance(edges, Column) else labelled_bin)("Age_imputed", edges))
    return df.drop("__groups", "__near", "__occ")


# ---- account counts -------------------------------------------------------------------------------------------------
def fit_counts(train: DataFrame, columns: dict[str, int]) -> dict[str, dict]:
    """P95 cap and medians of count columns by (occupation, age bin), occupation and overall.

    ``columns`` maps each column to the least group size. Values are counted once at the finest level; the
    caps and the medians of all levels come from those counts.
    """
    keys, names = ["Occupation", "Age_Bin"], list(columns)
    counts = materialize(distinct_values(train, names, keys), "counts")
    small = counts.count() <= SMALL
    caps = collect_from_counts(coarser(counts, []), names, [0.95], interpolate=False, small=small)
    caps = {c: v[0] if v else None for c, v in caps.items()}
    valid = F.lit(False)
    for c, cap in caps.items():
        if cap is not None:
            valid = valid | ((F.col("feature") == c) & F.col("value").between(0.0, cap))
    none = F.lit(None).cast("string")
    level = F.explode(F.array(*[F.struct(F.lit(name).alias("level"), a.alias("k1"), b.alias("k2")) for name, a, b in (
        ("group", F.col("Occupation"), F.col("Age_Bin")), ("occupation", F.col("Occupation"), none), ("overall", none, none))]))
    spread = counts.filter(valid).select(level.alias("l"), "feature", "slice", "value", "n").select("l.*", "feature", "slice", "value", "n")
    table = materialize(quantiles_of_counts(coarser(spread, ["level", "k1", "k2"]), [0.5], ["level", "k1", "k2"],
                                            interpolate=False, small=small), "count-medians")
    overall = {r["feature"]: r["value"] for r in table.filter("level = 'overall'").collect()}  # one row per column
    out = {}
    for c, least in columns.items():
        rows = table.filter(F.col("feature") == c)
        out[c] = {
            "p95": caps[c], "overall_median": overall.get(c),
            "group_stats": rows.filter((F.col("level") == "group") & (F.col("n") >= least))
                               .select(F.col("k1").alias("Occupation"), F.col("k2").alias("Age_Bin"), F.col("value").alias("median")),
            "occupation_median": rows.filter("level = 'occupation'")
                                     .select(F.col("k1").alias("Occupation"), F.col("value").alias("occupation_median"))}
    return out


def apply_counts(df: DataFrame, column: str, stem: str, p95: Column | float, group_stats: DataFrame,
                 occupation_median: DataFrame, overall_median: Column | float | None, by: Sequence[str] = ()) -> DataFrame:
    """Adds ``<stem>_clean``, ``_Was_Invalid``, ``_imputed`` and ``_imputation_method``; ``by`` as in ``apply_age``."""
    clean = within(column, 0, p95)
    df = (df.join(group_stats.withColumnRenamed("median", "__group"), [*by, "Occupation", "Age_Bin"], "left")
          .join(occupation_median.withColumnRenamed("occupation_median", "__occ"), [*by, "Occupation"], "left"))
    return df.withColumns({
        f"{stem}_clean": clean,
        f"{stem}_Was_Invalid": (clean.isNull() & F.col(column).isNotNull()).cast("int"),
        f"{stem}_imputed": round_half_up(F.coalesce(clean.cast("double"), "__group", "__occ",
                                                    _value(overall_median).cast("double"))),
        f"{stem}_imputation_method": first_method(
            [(clean.isNotNull(), "original"), (F.col("__group").isNotNull(), "occupation_age_bin_median"),
             (F.col("__occ").isNotNull(), "occupation_median")], "overall_median"),
    }).drop("__group", "__occ")


def median_fill(df: DataFrame, columns: Sequence[str], fitted: dict[str, float] | None = None) -> DataFrame:
    """Numeric nulls replaced by column medians (fitted here unless given)."""
    if fitted is None:
        fitted = {c: v[0] for c, v in collect_quantiles(df, columns, [0.5]).items() if v}
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in fitted.items()})


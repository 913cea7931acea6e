"""Rank correlation of all column pairs from one long shuffle to ranks and one regroup to rows, missing values taken pair by pair."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.operators.ranking import distinct_values, running_totals
from panelkit.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the functions that run in tasks travel with the job

#: Numbers that a task holds at once.
BLOCK = 1 << 21


def _pair_sums(columns: int, partner: np.ndarray):
    """Over batches of rows (lists of column number and centred ranks): for all pairs the sum of products and of squares, one table a task."""
    step = max(1, BLOCK // max(columns * columns, 1))

    def run(batches):
        total = np.zeros((2, columns, columns))
        for batch in batches:
            lists = batch.column(0)
            for begin in range(0, len(lists), step):
                part = lists.slice(begin, step)
                at, ranks = part.flatten().flatten()
                row = np.repeat(np.arange(len(part)), part.value_lengths().to_numpy(zero_copy_only=False))
                values = ranks.flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)
                dense = np.full((len(part), columns, values.shape[1]), np.nan)
                dense[row, at.to_numpy(zero_copy_only=False)] = values
                seen = ~np.isnan(dense[:, :, 0])
                x = np.where(seen[:, :, None] & seen[:, None, :], dense[:, :, partner], 0.0)  # column a, among rows that also have b
                total[0] += np.einsum("nab,nba->ab", x, x)
                total[1] += np.einsum("nab,nab->ab", x, x)
        flat = total.reshape(-1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat)], names=["at", "value"])
    return run


def pairwise_spearman(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Rank correlation of every column pair over the rows where both are present; NaN where either does not vary. Null and NaN are missing.

    A column's ranks among the rows that also have another column differ only for partners with missing values. So every
    distinct value is ranked once overall and once for each such partner, all in the same ordered pass, from counts of the rows
    that have the partner. The long table of (row, column, value) meets the ranks in one join, whatever the number of columns, and
    is regrouped to rows once; sums over pairs are added in one more job. Only a number for each pair reaches the driver.
    """
    names = list(columns)
    number = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    rows = materialize(df.select(*[number(c).alias(f"c{i}") for i, c in enumerate(names)]), "numbers")
    short = [f"c{i}" for i in range(len(names))]
    counted = rows.agg(F.count(F.lit(1)).alias("all"), *[F.count(c).alias(c) for c in short]).first()
    gaps = [c for c in short if counted[c] < counted["all"]]
    present = [f"has_{c}" for c in gaps]
    flagged = rows.withColumns({f"has_{c}": F.col(c).isNotNull().cast("long") for c in gaps})
    totals = running_totals(distinct_values(flagged, short, sums=present), ["feature"], "value", ["n", *present], "slice")
    centred = [F.col(f"{m}_before") + (F.col(m) + 1) / F.lit(2.0) - (F.col(f"{m}_total") + 1) / F.lit(2.0) for m in ["n", *present]]
    ranks = materialize(totals.select("feature", "value", F.array(*centred).alias("ranks")), "ranks")
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(i).alias("at"), F.col(c).alias("value")) for i, c in enumerate(short)])
    numbered = rows.withColumn("row", F.monotonically_increasing_id())  # a step of its own: numbers go to rows, not to their values
    long = numbered.select("row", F.inline(items)).filter("value is not null")
    grouped = long.join(ranks, ["feature", "value"]).groupBy("row").agg(F.collect_list(F.struct("at", "ranks")).alias("entries"))  # one entry a column
    schema = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("value", T.DoubleType())])
    partner = np.array([1 + gaps.index(c) if c in gaps else 0 for c in short])
    table = grouped.select("entries").mapInArrow(_pair_sums(len(short), partner), schema).groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    sums = np.zeros(2 * len(short) ** 2)
    sums[table.column("at").to_numpy()] = table.column("value").to_numpy()
    products, squares = sums.reshape(2, len(short), len(short))
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where((squares > 0) & (squares.T > 0), products / np.sqrt(squares * squares.T), np.nan)

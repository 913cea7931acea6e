"""Multi-hot, one-hot and their inverse."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.text import column_name

#: Most levels of a category that become columns.
MOST_LEVELS = 200


def elements(column: str, sep: str = ",") -> Column:
    """Elements of a separated list."""
    return F.split(F.col(column), sep)


def vocabulary(df: DataFrame, column: str, sep: str | None = None) -> DataFrame:
    """Distinct values (or list elements) of a column, one per row, to be kept with the fitted parameters."""
    values = F.explode(elements(column, sep)) if sep else F.col(column)
    return df.select(values.alias("level")).filter(F.col("level").isNotNull()).distinct()


def collected_levels(df: DataFrame, columns: Mapping[str, tuple[str, str | None]], most: int = MOST_LEVELS, rest: str | None = None) -> dict[str, list[str]]:
    """Levels of several columns (name -> column and separator of its list elements, if it holds lists), in order, from one pass.

    They become column names, so each may have at most ``most``. Without ``rest`` more raise; with it the most frequent
    stay, of equal counts the first in order, and ``rest`` is added as the name of all others.
    """
    def entries(name: str, column: str, sep: str | None) -> Column:
        values = F.array_distinct(elements(column, sep)) if sep else F.array(F.col(column).cast("string"))
        return F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.struct(F.lit(name).alias("name"), v.alias("level")))

    items = F.concat(*[entries(name, column, sep) for name, (column, sep) in columns.items()])
    counts = df.select(F.inline(items)).filter(F.col("level").isNotNull()).groupBy("name", "level").count()
    if rest is None:
        rows = counts.select("name", "level").limit(most * len(columns) + 1).collect()
    else:
        place = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("count"), "level"))
        rows = counts.withColumn("place", place).filter(F.col("place") <= most + 1).orderBy("place").collect()
    found: dict[str, list[str]] = {name: [] for name in columns}
    for r in rows:
        found[r["name"]].append(r["level"])
    for name, levels in found.items():
        if len(levels) > most:
            if rest is None:
                raise ValueError(f"{name} has more than {most} levels")
            found[name] = [*sorted(levels[:most]), rest]
        else:
            found[name] = sorted(levels)
    return found


def multi_hot(column: str, levels: Sequence[str], prefix: str, sep: str = ",") -> dict[str, Column]:
    """One 0/1 column per list element."""
    parts = elements(column, sep)
    return {prefix + column_name(v): F.when(F.array_contains(parts, v), 1).otherwise(0) for v in levels}


def one_hot(column: str, levels: Sequence[str], prefix: str, rest: str | None = None) -> dict[str, Column]:
    """One 0/1 column per level; the level ``rest``, if it is one, stands for all values not listed."""
    own = [v for v in levels if v != rest]
    made = {prefix + column_name(v): F.when(F.col(column) == v, 1).otherwise(0) for v in own}
    if rest in levels:
        made[prefix + column_name(rest)] = F.when(F.col(column).isNotNull() & ~F.col(column).isin(own), 1).otherwise(0)
    return made


def collapse(columns: Sequence[str], prefix: str, missing: str = "Unknown") -> Column:
    """The level of the first set 0/1 column, or a name for none."""
    return F.coalesce(*[F.when(F.col(c) == 1, F.lit(c[len(prefix):])) for c in columns], F.lit(missing))

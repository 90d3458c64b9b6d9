"""Draw ordinals: how many values a stateful generator has given before a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1 << 16


def with_prefix_sums(df: DataFrame, id_col: str, draws: dict[str, Column], block: int = BLOCK, by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with, under each name, the sum of its draws over all rows before each by id, or only over those of equal
    ``by`` (columns without nulls). One pass serves all names: over blocks of blocks of ids, then over blocks, then within
    a block. One row for every block * block ids is all that is ever summed in one place."""
    if not draws:
        return df
    n = range(len(draws))
    before = lambda column, window: F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    df = df.withColumns({**{f"_draw{k}": d.cast("long") for k, d in enumerate(draws.values())}, "_block": F.floor(F.col(id_col) / block)})
    sums = df.groupBy(*by, "_block").agg(*[F.sum(f"_draw{k}").alias(f"_n{k}") for k in n]).withColumn("_super", F.floor(F.col("_block") / block))
    tops = sums.groupBy(*by, "_super").agg(*[F.sum(f"_n{k}").alias(f"_n{k}") for k in n])
    tops = tops.select(*by, "_super", *[before(f"_n{k}", Window.partitionBy(*by).orderBy("_super")).alias(f"_top{k}") for k in n])
    sums = sums.select(*by, "_block", "_super", *[before(f"_n{k}", Window.partitionBy(*by, "_super").orderBy("_block")).alias(f"_low{k}") for k in n]).join(tops, [*by, "_super"])
    inside = {f"_inside{k}": before(f"_draw{k}", Window.partitionBy(*by, "_block").orderBy(id_col)) for k in n}
    placed = df.withColumns(inside).join(sums.select(*by, "_block", *[(F.col(f"_low{k}") + F.col(f"_top{k}")).alias(f"_before{k}") for k in n]), [*by, "_block"])
    return placed.withColumns({name: F.col(f"_before{k}") + F.col(f"_inside{k}") for k, name in enumerate(draws)}).drop("_block", *[f"{p}{k}" for k in n for p in ("_draw", "_before", "_inside")])


def with_prefix_sum(df: DataFrame, id_col: str, draws: Column, name: str, block: int = BLOCK, by: tuple[str, ...] = ()) -> DataFrame:
    return with_prefix_sums(df, id_col, {name: draws}, block, by)

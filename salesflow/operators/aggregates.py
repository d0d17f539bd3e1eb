"""The aggregates. Each exists once and serves batch views, speed views and tests.

All of them are partial + final hash aggregates: a hot key costs one row per
map task in the exchange, however many input rows it has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from salesflow.functions.cleaning import UNKNOWN, fill_unknown, is_complete

MEASURES = ("sales_ratio", "sale_amount")


def count_by(df: DataFrame, key: str, fill: str = UNKNOWN) -> DataFrame:
    """Rows per key; a null key counts as ``fill``, an empty string stays its own group."""
    return (
        fill_unknown(df.select(key), fill)
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("total_customer"))
    )


def totals(df: DataFrame) -> DataFrame:
    """Sums of ratio and amount and the number of rows that have both.

    One row always: ``(null, null, 0)`` without complete rows. Here
    ``total_customer`` counts complete rows only, unlike :func:`count_by`.
    """
    return (
        df.select(*MEASURES).filter(is_complete([F.col(m) for m in MEASURES]))
        .agg(F.sum("sales_ratio").alias("total_sales_ratio"),
             F.sum("sale_amount").alias("total_sale_amount"),
             F.count(F.lit(1)).alias("total_customer"))
    )


VIEW_KEYS = ("property_type", "town")


def sale_cells(df: DataFrame, *keys: str) -> DataFrame:
    """One pass over the sales: counts and sums per combination of ``keys``.

    The views are sums over these cells, so a run reads the sales once.
    """
    complete = is_complete([F.col(m) for m in MEASURES])
    return (
        fill_unknown(df.select(*keys, *MEASURES)).groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"),
             F.count_if(complete).alias("complete_rows"),
             F.sum(F.when(complete, F.col("sales_ratio"))).alias("ratio"),
             F.sum(F.when(complete, F.col("sale_amount"))).alias("amount"))
    )


def cells_by(cells: DataFrame, *keys: str) -> DataFrame:
    """:func:`count_by` from cells."""
    return cells.groupBy(*keys).agg(F.sum("rows").alias("total_customer"))


def cells_totals(cells: DataFrame, *keys: str) -> DataFrame:
    """:func:`totals` from cells, optionally per key."""
    return cells.groupBy(*keys).agg(
        F.sum("ratio").alias("total_sales_ratio"),
        F.sum("amount").alias("total_sale_amount"),
        F.coalesce(F.sum("complete_rows"), F.lit(0)).alias("total_customer"))


def column_modes(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> DataFrame:
    """The most frequent non-null value of each column, the smallest on ties.

    ``weight`` names a column of row counts, for rows that stand for several.
    Counting per value is spread over the cluster; only one candidate per task
    reaches the last step.
    """
    best_first = F.struct((-F.col("n")).alias("n"), F.col("value"))
    times = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return (
        df.unpivot([weight] if weight else [], list(columns), "column_name", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value").agg(times.alias("n"))
        .groupBy("column_name").agg(F.min_by("value", best_first).alias("mode"))
    )


def mean_by_key(df: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """Mean of the present (not null, not NaN) values per key; null keys are left out."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.avg(F.nanvl(F.col(value), F.lit(None).cast("double"))).alias(alias))
    )


def ratio_of_sums(numerator: Column, denominator: Column) -> Column:
    """Quotient of two sums; null when the denominator is 0."""
    return F.try_divide(numerator, denominator)


def observed_rows(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows while the next action runs: no second job.

    After the action: ``observation.get["rows"]``.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen

"""Serving: the latest batch result plus the speed partials since its cutoff.

A batch run with ``started_at = c`` covers the sales created before ``c``; the
partials created at or after ``c`` cover the rest. Both together are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.functions.cleaning import closed_window
from salesflow.operators.aggregates import ratio_of_sums

TOTAL_COLUMNS = ("total_sales_ratio", "total_sale_amount", "total_customer")


def latest(df: DataFrame, by: str = "ended_at") -> DataFrame:
    """The newest row; an aggregate, so no sort. No row for an empty table."""
    newest = F.max_by(F.struct(*df.columns), F.col(by))
    return df.agg(newest.alias("r")).filter("r IS NOT NULL").select("r.*")


def cutoff(batch: DataFrame, by: str = "started_at") -> Column:
    """The newest ``by`` of a batch view as a scalar subquery: one plan, one round trip."""
    return batch.agg(F.max(by)).scalar()


def since(speed: DataFrame, start: Column, now: Column) -> DataFrame:
    """Speed partials of the closed window; also prunes by date where the table has it."""
    if "created_date" in speed.columns:
        speed = closed_window(speed, "created_date", start.cast("date"), now.cast("date"))
    return closed_window(speed, "created_at", start, now)


def window_totals(speed: DataFrame, start: Column, now: Column) -> DataFrame:
    """Sums of the partial totals in a window; 0 when there are none."""
    return since(speed, start, now).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast(speed.schema[c].dataType).alias(c)
          for c in TOTAL_COLUMNS])


def window_sum_by_key(speed: DataFrame, key: str, start: Column, now: Column) -> DataFrame:
    """Sum of the partial counts per key in a window."""
    return since(speed, start, now).groupBy(key).agg(
        F.sum("total_customer").alias("total_customer"))


def view_sum_by_key_run(batch: DataFrame, key: str) -> DataFrame:
    """Sum of the batch counts per key and run."""
    return batch.groupBy(key, "started_at").agg(F.sum("total_customer").alias("total_customer"))


def serve_totals(batch: DataFrame, speed: DataFrame, now: Column) -> DataFrame:
    """Merged totals and the average ratio, one row; nulls while there is no batch run."""
    last = latest(batch)
    start = last.select("started_at").scalar()
    both = (
        last.select(*TOTAL_COLUMNS, F.lit(1).alias("runs"))
        .unionByName(window_totals(speed, start, now).withColumn("runs", F.lit(0)))
    )
    merged = both.agg(
        F.sum("runs").alias("runs"), *[F.sum(c).alias(c) for c in TOTAL_COLUMNS])
    return merged.select(
        *[F.when(F.col("runs") > 0, F.col(c)).alias(c) for c in TOTAL_COLUMNS],
    ).withColumn("average_sale_ratio",
                 ratio_of_sums(F.col("total_sales_ratio"), F.col("total_customer")))


def union_sum(key: str, *counts: DataFrame) -> DataFrame:
    """Stack counts and add them up per key; null keys are left out."""
    stacked = counts[0].select(key, "total_customer")
    for other in counts[1:]:
        stacked = stacked.unionByName(other.select(key, "total_customer"))
    return (
        stacked.filter(F.col(key).isNotNull())
        .groupBy(key).agg(F.sum("total_customer").alias("total_customer"))
    )


def serve_by_key(batch: DataFrame, speed: DataFrame, key: str, now: Column) -> DataFrame:
    """Merged count per key: the newest run plus the partials since its cutoff."""
    start = cutoff(batch)
    newest_run = batch.filter(F.col("started_at") == cutoff(batch))
    return union_sum(
        key,
        view_sum_by_key_run(newest_run, key),
        window_sum_by_key(speed, key, start, now))


def top_k(df: DataFrame, by: str, key: str, k: int = 10) -> DataFrame:
    """The ``k`` rows with the highest ``by``; ties in key order. Never a full sort."""
    return df.orderBy(F.desc(by), F.asc(key)).limit(k)

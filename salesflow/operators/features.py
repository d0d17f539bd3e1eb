"""Features of the price model: modes, dummies, scaling, town encoding, split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow import schemas
from salesflow.functions.cleaning import open_range
from salesflow.operators.aggregates import column_modes, mean_by_key
from salesflow.session import stage

# Categories with a dummy column each (fixed values).
PROPERTY_CATEGORIES = [
    "Commercial", "Residential", "Vacant Land", "Apartments", "Industrial", "Public Utility",
    "Condo", "Two Family", "Three Family", "Single Family", "Four Family",
]
RESIDENTIAL_CATEGORIES = ["Single Family", "Condo", "Two Family", "Three Family", "Four Family"]
# Sales that are fit for the model (fixed values).
RATIO_RANGE = (0.3, 1.3)
AMOUNT_LIMIT = 1_500_000

LABEL = "SALE_AMOUNT"
FEATURES = [
    "LIST_YEAR", "ASSESSED_VALUE",
    *[f"Property_{c}" for c in PROPERTY_CATEGORIES],
    *[f"Residential_{c}" for c in RESIDENTIAL_CATEGORIES],
    "TOWN_ENCODED",
]
# Columns of a sale that are not features.
KEPT = ("list_year", "assessed_value", "sale_amount")
DROPPED = [name for name in schemas.LAKE.names if name not in KEPT]


def number(column: str) -> Column:
    """NaN counts as missing in features and statistics."""
    return F.nanvl(F.col(column), F.lit(None).cast("double"))


def drop_columns(df: DataFrame, columns: Sequence[str] = tuple(DROPPED)) -> DataFrame:
    return df.drop(*columns)


def impute_mode(df: DataFrame, modes: dict[str, str]) -> DataFrame:
    """Fill null category columns with a value each."""
    return df.na.fill(modes)


def modes_of(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The mode of each column; a column without values has none."""
    return {r.column_name: r.mode for r in column_modes(df, columns).collect()}


def dummies(column: str, prefix: str, categories: Sequence[str]) -> list[Column]:
    """A 0/1 column per category; any other value, or none, is 0 everywhere."""
    return [
        F.coalesce((F.col(column) == c).cast("double"), F.lit(0.0)).alias(f"{prefix}_{c}")
        for c in categories
    ]


def with_dummies(df: DataFrame, *columns: Column) -> DataFrame:
    """Put columns beside a frame."""
    return df.select("*", *columns)


@dataclass(frozen=True)
class Moments:
    mean: float | None
    std: float | None

    def scale(self, value: Column) -> Column:
        """(x - mean) / population std; without spread only centred."""
        return (value - F.lit(self.mean)) / F.lit(self.std or 1.0)


def moments(df: DataFrame, *columns: str) -> dict[str, Moments]:
    """Mean and population standard deviation of the present values, in one pass."""
    row = df.agg(*[
        f(number(c)).alias(f"{n}_{i}")
        for i, c in enumerate(columns) for n, f in (("m", F.avg), ("s", F.stddev_pop))
    ]).first()
    return {c: Moments(row[f"m_{i}"], row[f"s_{i}"]) for i, c in enumerate(columns)}


def lookup(df: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Add the columns of ``stats`` (one row per key); unmatched and null keys get null.

    Whether ``stats`` is broadcast is Spark's choice, by its size in bytes; otherwise the
    join shuffles and adaptive execution splits hot keys.
    """
    return df.join(stats, key, "left")


@dataclass(frozen=True)
class FeatureStats:
    """What the features learn from data."""

    modes: dict[str, str]
    value: Moments
    year: Moments
    towns: DataFrame  # town, town_mean
    town_mean: float | None  # mean over all rows, for towns not seen
    town: Moments


def prepared(df: DataFrame, modes: dict[str, str]) -> DataFrame:
    """Categories imputed, sales with an implausible ratio left out."""
    return open_range(impute_mode(df, modes), "sales_ratio", *RATIO_RANGE)


def _feature_cells(df: DataFrame) -> DataFrame:
    """One pass over the sales: what the statistics need, per (town, categories)."""
    low, high = RATIO_RANGE
    ratio = F.col("sales_ratio")
    kept = (ratio > low) & (ratio < high)
    parts = [F.count(F.lit(1)).alias("rows"), F.count_if(kept).alias("kept_rows")]
    for c in ("assessed_value", "list_year", "sale_amount"):
        x = F.when(kept, number(c))
        parts += [F.count(x).alias(f"n_{c}"), F.avg(x).alias(f"m_{c}"),
                  F.var_pop(x).alias(f"v_{c}")]
    keys = ["town", "property_type", "residential_type"]
    return df.groupBy(*keys).agg(*parts)


def _pooled(cells: DataFrame, count: str, mean: str, variance: str | None = None) -> Moments:
    """Overall mean and population deviation from counts, means and variances of groups."""
    used = cells.filter((F.col(count) > 0) & F.col(mean).isNotNull())
    n = F.sum(count)
    m = used.agg((F.sum(F.col(count) * F.col(mean)) / n).alias("m")).first().m
    if m is None:
        return Moments(None, None)
    inner = F.col(variance) if variance else F.lit(0.0)
    spread = inner + F.pow(F.col(mean) - F.lit(m), 2)
    return Moments(m, used.agg(F.sqrt(F.sum(F.col(count) * spread) / n).alias("s")).first().s)


def fit_features(df: DataFrame) -> FeatureStats:
    """Learn modes, scales and town means from sales, in one pass over them.

    Pass the training part only; passing everything gives whole-table statistics
    that leak the test part.
    """
    cells = stage(_feature_cells(df), "feature-cells")
    modes = {
        r.column_name: r.mode
        for r in column_modes(cells, ["property_type", "residential_type"], "rows").collect()}
    towns = stage(
        cells.filter(F.col("town").isNotNull()).groupBy("town").agg(
            (F.sum(F.col("n_sale_amount") * F.col("m_sale_amount")) / F.sum(
                F.when(F.col("n_sale_amount") > 0, F.col("n_sale_amount")))).alias("town_mean"),
            F.sum("kept_rows").alias("rows")).filter(F.col("rows") > 0),
        "towns")

    def scale(c: str) -> Moments:
        return _pooled(cells, f"n_{c}", f"m_{c}", f"v_{c}")

    return FeatureStats(
        modes, scale("assessed_value"), scale("list_year"), towns.select("town", "town_mean"),
        scale("sale_amount").mean, _pooled(towns, "rows", "town_mean"))


_STATE = "value struct<mean: double, std: double>, year struct<mean: double, std: double>, " \
    "town struct<mean: double, std: double>, town_mean double, modes map<string, string>"


def save_features(spark: SparkSession, stats: FeatureStats, path: str) -> None:
    """Store what the features have learnt: one row of numbers and the town table."""
    def pair(m: Moments) -> tuple:
        return (m.mean, m.std)

    stats.towns.write.mode("overwrite").parquet(f"{path}/towns")
    row = (pair(stats.value), pair(stats.year), pair(stats.town), stats.town_mean, stats.modes)
    spark.createDataFrame([row], _STATE).write.mode("overwrite").parquet(f"{path}/state")


def load_features(spark: SparkSession, path: str) -> FeatureStats:
    """What :func:`save_features` has stored."""
    row = spark.read.schema(_STATE).parquet(f"{path}/state").first()
    towns = spark.read.schema("town string, town_mean double").parquet(f"{path}/towns")
    return FeatureStats(row.modes, Moments(*row.value), Moments(*row.year), towns, row.town_mean,
                        Moments(*row.town))


def target_encode(df: DataFrame, stats: FeatureStats) -> DataFrame:
    """``TOWN_ENCODED``: scaled mean amount of the town.

    A town that was not seen gets the overall mean; no town, no value.
    """
    known = F.coalesce(
        F.col("town_mean"), F.when(F.col("town").isNotNull(), F.lit(stats.town_mean)))
    return (
        lookup(df, stats.towns, "town")
        .withColumn("TOWN_ENCODED", stats.town.scale(known)).drop("town_mean")
    )


def feature_frame(df: DataFrame, stats: FeatureStats, *keep: str) -> DataFrame:
    """The 19 features and the label, plus the columns named in ``keep``.

    Rows with a missing feature or label are dropped.
    """
    encoded = target_encode(prepared(df, stats.modes), stats)
    return encoded.select(
        *keep,
        stats.year.scale(F.col("list_year")).alias("LIST_YEAR"),
        stats.value.scale(number("assessed_value")).alias("ASSESSED_VALUE"),
        *dummies("property_type", "Property", PROPERTY_CATEGORIES),
        *dummies("residential_type", "Residential", RESIDENTIAL_CATEGORIES),
        "TOWN_ENCODED",
        number("sale_amount").alias(LABEL),
    ).na.drop(subset=["LIST_YEAR", "ASSESSED_VALUE", "TOWN_ENCODED", LABEL])


def bucket(key: str, seed: int = 0) -> Column:
    """A number below 1000003 that depends on the key only; null keys share one."""
    mixed = (F.pmod(F.coalesce(F.col(key), F.lit(0)), F.lit(1000003)) * 7919 + F.lit(seed))
    return F.pmod(mixed, F.lit(1000003))


def in_test(key: str, share: float = 0.15, seed: int = 0) -> Column:
    return F.pmod(bucket(key, seed), F.lit(100)) < F.lit(round(share * 100))


def train_test_split(df: DataFrame, key: str, share: float = 0.15,
                     seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """About ``share`` of the keys for testing. A row's side never changes, whatever
    the partitioning, and rows of one key stay on one side."""
    test = in_test(key, share, seed)
    return df.filter(~test), df.filter(test)


def fold(key: str, folds: int = 5, seed: int = 0) -> Column:
    return F.pmod(bucket(key, seed), F.lit(folds))


def encode_by_mean(df: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """Add the mean of ``value`` per ``key``, learnt from the same rows."""
    return lookup(df, stage(mean_by_key(df, key, value, alias), "means"), key)

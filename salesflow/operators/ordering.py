"""Orders and limits. Positions are in :func:`salesflow.sources.files.slice_rows`."""

from __future__ import annotations

from pyspark.sql import DataFrame

from salesflow.sources.files import with_position


def sort_by_date(df: DataFrame, *ties: str, date: str = "date_recorded") -> DataFrame:
    """Global sort by date, then ``ties``, then place in the source files.

    The last key lets a hot date span several range partitions.
    """
    return with_position(df).orderBy(date, *ties, "_tie").drop("_tie")


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in an explicit order."""
    return df.orderBy(*order).limit(n)


def bounded_sample(df: DataFrame, n: int = 1000) -> DataFrame:
    """At most ``n`` rows, whichever come first. For a look at the data: checks
    run over all rows unless this is asked for."""
    return df.limit(n)

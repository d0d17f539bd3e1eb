"""A sales lake derived from the star-schema test tables.

``sales(spark, sf_dir, "town", ...)`` joins only the tables that the requested
columns come from: every foreign key of the test tables has exactly one match
(checked by the tests), so a join whose columns are not asked for changes
nothing. Which side of a join is broadcast is left to Spark's own size check.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow import schemas
from salesflow.session import ROUND_BYTES, rounds_of, shuffles_removed, stored_bytes, work_dir
from salesflow.sources.log import remove


def _columns() -> dict[str, tuple[Column, frozenset[str]]]:
    """Expression of each column and the tables beyond ``lineitem`` that it needs."""
    c, when, lit = F.col, F.when, F.lit
    line, qty = c("l_linenumber"), c("l_quantity")
    part, orders = frozenset({"part"}), frozenset({"orders"})
    customer = frozenset({"orders", "customer"})
    nation = customer | {"nation"}
    kind = c("p_type")
    none = frozenset()
    return {
        "serial_number": (c("l_orderkey") * 10 + line, none),
        "list_year": (F.year("l_shipdate"), none),
        "date_recorded": (c("l_shipdate").cast("date"), none),
        "town": (when(line == 7, None).otherwise(c("n_name")), nation),
        "address": (c("c_name"), customer),
        "assessed_value": (c("p_retailprice") * qty, part),
        "sale_amount": (when(line == 6, None).otherwise(c("l_extendedprice")), none),
        "sales_ratio": (
            when(line == 5, None)
            .when((line == 3) & (qty == 50), lit(float("nan")))
            .otherwise(qty / lit(40.0)), none),
        "property_type": (
            when(line == 4, None)
            .when((line == 2) & (c("l_returnflag") == "A"), "")
            .when(kind == "ECONOMY", "Condo").when(kind == "LARGE", "Commercial")
            .when(kind == "MEDIUM", "Single Family").when(kind == "PROMO", "Vacant Land")
            .when(kind == "SMALL", "Two Family").otherwise("Residential"), part),
        "residential_type": (
            when(line >= 3, None).when(c("l_linestatus") == "F", "Single Family")
            .otherwise("Condo"), none),
        "non_use_code": (lit(None), none),
        "assessor_remarks": (
            when(c("l_tax") == 0, "").otherwise(c("o_orderpriority")), orders),
        "opm_remarks": (c("o_orderstatus"), orders),
        "location": (
            F.concat(lit("POINT ("), c("l_suppkey").cast("string"), lit(" "),
                     c("l_partkey").cast("string"), lit(")")), none),
        "created_at": (c("l_shipdate"), none),
    }


def spread(df: DataFrame) -> DataFrame:
    """A scan with fewer splits than cores, dealt out to all of them.

    The test tables are files of one row group, which is one task. For work that
    is heavy per row; a table of many row groups passes unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def sales(spark: SparkSession, sf_dir: str, *columns: str, heavy: bool = False,
          share: tuple[int, int] | None = None) -> DataFrame:
    """The derived sales, with the lake schema (or the given columns of it).

    ``heavy`` announces expensive work per row, see :func:`spread`. ``share`` (i, n) are those of every n-th order,
    dealt by a hash: all shares together are all sales.
    """
    names = list(columns) or schemas.LAKE.names
    made = _columns()
    needs = frozenset().union(*[made[n][1] for n in names])

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def mine(df: DataFrame, order: str) -> DataFrame:
        if share is None or share[1] == 1:
            return df
        return df.filter(F.pmod(F.xxhash64(F.col(order).cast("long")), F.lit(share[1])) == share[0])

    df = mine(table("lineitem"), "l_orderkey")
    if heavy:
        df = spread(df)
    if "part" in needs:
        df = df.join(table("part"), F.col("p_partkey") == F.col("l_partkey"))
    if "orders" in needs:
        # orders get their customers first: the rows of lineitem are shuffled once, not once per table
        orders = mine(table("orders"), "o_orderkey")
        if "customer" in needs:
            owner = table("customer")
            if "nation" in needs:
                owner = owner.join(table("nation"), F.col("n_nationkey") == F.col("c_nationkey"))
            orders = orders.join(owner, F.col("c_custkey") == F.col("o_custkey"))
        df = df.join(orders, F.col("o_orderkey") == F.col("l_orderkey"))
    return df.select(*[
        made[n][0].cast(schemas.LAKE[n].dataType).alias(n) for n in names])


_STAGED: dict[tuple[str, str, bool], str] = {}


def sales_files(spark: SparkSession, sf_dir: str, lake: bool = False) -> str:
    """The derived sales as parquet files, written once per application.

    Stands for the files a feed delivers (sale schema) or for the lake table
    (``lake=True``: with ``created_at``), which in use exist already.
    """
    key = (spark.sparkContext.applicationId, sf_dir, lake)
    if key not in _STAGED:
        _STAGED[key] = _store_sales(spark, sf_dir, lake)
    return _STAGED[key]


def _store_sales(spark: SparkSession, sf_dir: str, lake: bool = False) -> str:
    """Joined in rounds (:func:`salesflow.session.rounds_of`), each with the lines of its share of the orders."""
    path = work_dir(spark, "lake" if lake else "sales")
    schema = schemas.LAKE if lake else schemas.SALE
    rounds = rounds_of(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    with shuffles_removed(spark):
        for i in range(rounds):
            made = sales(spark, sf_dir, *schema.names, heavy=True, share=(i, rounds))
            made.write.mode("append").option("compression", "zstd").parquet(path)
    return path


def is_large(spark: SparkSession, sf_dir: str) -> bool:
    """Whether what is made of the tables is too large to be kept beside what is made of that in turn."""
    return stored_bytes(spark.read.parquet(f"{sf_dir}/lineitem.parquet")) > ROUND_BYTES


@contextmanager
def sales_once(spark: SparkSession, sf_dir: str) -> Iterator[str]:
    """The files of :func:`sales_files` for a reader that stores what it makes of them.

    Those of large tables are removed after that, unless another query has them already.
    """
    if (spark.sparkContext.applicationId, sf_dir, False) in _STAGED or not is_large(spark, sf_dir):
        yield sales_files(spark, sf_dir)
        return
    path = _store_sales(spark, sf_dir)
    try:
        yield path
    finally:
        remove(spark, path)

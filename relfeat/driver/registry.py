"""Registration of queries and the small helpers they share."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relfeat.sources.tables import Condition, scan_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels")


class Tables:
    """The driver tables of one folder, and the two joins most queries start from."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        return scan_table(self.spark, f"{self.folder}/{name}.parquet")

    def scan(self, name: str, *where: Condition) -> DataFrame:
        """The rows of a table that meet all conditions, which the scan itself looks at."""
        return scan_table(self.spark, f"{self.folder}/{name}.parquet", where=where)

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines with their customer, standing for instalments: see LINES."""
        joined = self.lineitem.join(self.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        return joined.withColumns(
            {
                "dpd": F.round(F.col("l_discount") * 100).cast("int"),
                "months": (F.year("o_orderdate") - 2002) * 12 + F.month("o_orderdate") - 1,
                "flag": F.nullif(F.col("l_returnflag"), F.lit("N")),
                "disc": F.when(F.col("l_discount") != 0, F.col("l_discount")),
            }
        )

    @cached_property
    def customers(self) -> DataFrame:
        """Customers with their nation and region: see CUSTOMERS."""
        return self.customer.join(self.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
            self.region, F.col("n_regionkey") == F.col("r_regionkey")
        )


# the same two joins for the checking engine
LINES = """(SELECT *, CAST(round(l_discount * 100) AS INTEGER) AS dpd,
  CAST((year(o_orderdate) - 2002) * 12 + month(o_orderdate) - 1 AS INTEGER) AS months,
  nullif(l_returnflag, 'N') AS flag, CASE WHEN l_discount <> 0 THEN l_discount END AS disc
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
CUSTOMERS = """(SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

LINE_TIES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def query(name: str, sql: str | None = None):
    """Register ``f(tables)``; without SQL only the rows are checked."""

    def register(f: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} exists already")
        QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column: the two engines add in different orders."""
    return df.selectExpr(
        *[
            f"round(`{f.name}`, {digits}) AS `{f.name}`" if isinstance(f.dataType, T.DoubleType) else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


def rounded_sql(body: str, digits: int = 6, keep: Sequence[str] = ()) -> str:
    """The same for the checking engine; ``keep`` names the columns that are not numbers."""
    if not keep:
        return f"SELECT round(COLUMNS(*), {digits}) + 0 FROM ({body})"
    names = ", ".join(keep)
    return f"SELECT {names}, round(COLUMNS(* EXCLUDE ({names})), {digits}) + 0 FROM ({body})"

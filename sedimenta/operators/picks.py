"""Picking one row a key by a total order, so that the order of arrival never shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The whole first row of each key (rank pushed below the shuffle by Catalyst's group limit)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def first_n(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= n)

"""Exact-name set algebra on DataFrames: semi- and anti-joins, never NOT IN."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def minus(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right.select(*on), on, "left_anti")


def held(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right.select(*on), on, "left_semi")


def split(left: DataFrame, right: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """(the part that right doesn't hold, the part that it holds)."""
    return minus(left, right, on), held(left, right, on)


def merge(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).distinct()


def difference_count(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows in just one of two sets."""
    return left.subtract(right).union(right.subtract(left)).groupBy().count()


def disjoint(left: DataFrame, right: DataFrame, on: list[str]) -> bool:
    return held(left, right, on).isEmpty()

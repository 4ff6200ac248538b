"""Sinks: name lists in byte order, lists by year, manifests, Parquet. All of them go through Spark's commit protocol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def refuse_bad_names(df: DataFrame, keys: list[str]) -> int:
    """The number of rows; raises where a name is null, empty or not in lower case, or where a key comes twice. One pass and one shuffle."""
    bad = F.col("name").isNull() | (F.col("name") == "") | (F.col("name") != F.lower("name")) | F.col("name").rlike(r"[\r\n]")
    r = df.groupBy(*keys).agg(F.count("*").alias("n"), F.bool_or(bad).alias("bad")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if("bad").alias("bad"), F.count_if(F.col("n") > 1).alias("twice")).first()
    if r["bad"] or r["twice"]:
        raise ValueError(f"{r['bad']} names are not plain lower-case lines and {r['twice']} come more than once")
    return r["rows"]


def name_list(df: DataFrame, path: str, files: int | None = None) -> int:
    """One name a line, in byte order over the part files as they are numbered. `files=1` gives a single file, for small lists."""
    rows = refuse_bad_names(df, ["name"])
    out = df.select("name").repartitionByRange(files, "name") if files else df.select("name")
    (out.sortWithinPartitions("name") if files else out.orderBy("name")).write.mode("errorifexists").text(path)
    return rows


def year_lists(df: DataFrame, path: str, files: int | None = None) -> int:
    """(name, year) as a folder a year; ranges over both columns, so that a big year is many tasks."""
    rows = refuse_bad_names(df, ["name", "year"])
    spread = df.select("name", "year").repartitionByRange(*([files] if files else []), "year", "name").sortWithinPartitions("year", "name")
    spread.write.mode("errorifexists").partitionBy("year").text(path)
    return rows


def manifest(df: DataFrame, path: str, order: list[str], rows: int | None = None) -> None:
    """CSV with a header in a total order. With `rows`, refused where the table has another number of rows."""
    if rows is not None and df.count() != rows:
        raise ValueError("the manifest doesn't have a row for every line")
    df.orderBy(*order).write.mode("errorifexists").option("header", "true").csv(path)


def by_class(df: DataFrame, path: str) -> None:
    """(source, name): a folder a source. Source names are plain words, since they name folders."""
    if not df.where(~F.col("source").rlike(r"^[a-z0-9_]+\z")).isEmpty():
        raise ValueError("a source's name is not a plain word")
    df.select("source", "name").repartitionByRange("source", "name").sortWithinPartitions("source", "name").write.partitionBy("source").text(path)


def tables(frames: dict[str, DataFrame], path: str) -> None:
    for name, df in frames.items():
        df.write.mode("errorifexists").option("compression", "zstd").parquet(f"{path}/{name}")

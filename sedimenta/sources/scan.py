"""Scans: text lines with their file, name lists, delimited tables, JSON lines, dated file names.

Plain text files are splittable; gzip files are a task each, so big ones should be kept as many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def lines(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """(value, file_name): a row a line, split at \\n only; a bare carriage return stays in the line. `.part` files are not read."""
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    found = reader.text(path).select("value", F.col("_metadata.file_name").alias("file_name"))
    return found.where(~F.col("file_name").endswith(".part"))


def normal_name(value: Column) -> Column:
    """A line of a name list as a name; null where it is blank."""
    return F.nullif(F.lower(F.trim(F.replace(value, F.lit("\r"), F.lit("")))), F.lit(""))


def name_list(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return lines(spark, path).select(normal_name(F.col("value")).alias("name")).where("name is not null")


def year_lists(spark: SparkSession, path: str) -> DataFrame:
    """(name, year) from files named YYYY.txt."""
    got = lines(spark, path, "[0-9][0-9][0-9][0-9].txt")
    out = got.select(normal_name(F.col("value")).alias("name"), F.regexp_extract("file_name", r"([0-9]{4})\.txt\z", 1).cast("int").alias("year"))
    return out.where("name is not null")


def delimited(spark: SparkSession, path: str | list[str], schema: str, sep: str = "\t", header: bool = False, quote: str = "") -> DataFrame:
    """Declared columns, no inference. An empty quote turns quoting off."""
    return spark.read.schema(schema).option("sep", sep).option("header", header).option("quote", quote).csv(path)


def tagged(parts: dict[str, DataFrame], tag: str = "source") -> DataFrame:
    """The union of tables by column name, each row with its table's name."""
    out = None
    for name, df in parts.items():
        df = df.withColumn(tag, F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def journal(spark: SparkSession, path: str | list[str], schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, refused): JSON lines with the declared columns and `raw`; lines that are no JSON object are refused, never fatal.

    A damaged file yields the blocks before its damage.
    """
    got = spark.read.option("lineSep", "\n").option("ignoreCorruptFiles", "true").text(path).select("value", F.col("_metadata.file_name").alias("file_name"))
    got = got.where(F.trim("value") != "").withColumn("record", F.from_json("value", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"}))
    good = F.col("record").isNotNull() & F.col("record._bad").isNull()
    return got.where(good).select("record.*", F.col("value").alias("raw"), "file_name").drop("_bad"), got.where(~good).select("value", "file_name")


def has_key(raw: Column, key: str) -> Column:
    """The JSON object has the key, be its value null or not."""
    return F.coalesce(F.array_contains(F.json_object_keys(raw), key), F.lit(False))

"""What the training-data operators share: the folder that all executors see, lineage cuts, and Arrow helpers."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.sources import files

#: Rows of an Arrow batch that carries texts, so that a batch of long texts stays small.
TEXT_ROWS = 1000
WORD_SPACE = r"[\x20\x09-\x0D]+"
#: Ids of up to so many rows are broadcast where they tell which texts are read, so that the texts aren't shuffled.
TOLD = 4_000_000
#: The folders given out within each open scratch().
_made: list[list[str]] = []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir; only where that is unset (tests), below a folder of our own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            base = current.get()
        elif spark.sparkContext.master.startswith("local"):
            base = f"file://{tempfile.mkdtemp(prefix='sedimenta-')}"
            spark.sparkContext.setCheckpointDir(base)
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    if _made:
        _made[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What shared_dir gives out within is deleted at the end: nothing that lives on may read it."""
    _made.append([])
    try:
        yield
    finally:
        for path in _made.pop():
            files.remove(spark, path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that none of df's columns has, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: the lineage ends there and a lost executor costs nothing."""
    return written(df, shared_dir(df.sparkSession, name))


def written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def told(ids: DataFrame) -> DataFrame:
    """ids (written), for a join with texts: broadcast unless they are very many."""
    return F.broadcast(ids) if ids.count() <= TOLD else ids


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """docs with a distinct number for each row, the same whenever it is read: a row's place in its file. What isn't just a table of Parquet
    files, each of them once, is written first."""
    plan = docs._jdf.queryExecution().analyzed()
    if re.fullmatch(r"Relation.*\] parquet\s*", plan.toString(), re.DOTALL):
        paths = list(plan.relation().location().inputFiles())
        if len(paths) == len(set(paths)):
            meta = docs.metadataColumn("_metadata")
            found = sorted(r[0] for r in docs.select(meta["file_path"]).distinct().collect())
            path, number = free_name(docs, "path"), free_name(docs, "number")
            places = docs.sparkSession.createDataFrame(list(zip(found, range(len(found)), strict=True)), f"{path} string, {number} long")
            placed = docs.select("*", meta["file_path"].alias(path), meta["row_index"].alias(name)).join(F.broadcast(places), path)
            return placed.select(*docs.columns, (F.shiftleft(number, 40) + F.col(name)).alias(name))
    return materialise(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")


def small_text_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], after: Callable[[], None] | None = None) -> DataFrame:
    """mapInArrow whose state is made once for each task by make(); after() runs at the task's end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield step(batch)
        if after:
            after()

    return df.mapInArrow(run, schema)


def trim() -> None:
    """Give freed memory back to the system: a Python worker lives on after a task, and with it what its allocators hold."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not this C library's
        pass


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [t or "" for t in batch.column(name).to_pylist()]


def blobs(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The column's UTF-8 bytes, null as empty."""
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


class Memo(dict):
    """word -> value, filled on demand by make(word); of bounded size: the older half goes when it is full."""

    def __init__(self, make: Callable, most: int = 400_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            for k in list(self)[: self.most // 2]:
                del self[k]
        value = self[key] = self.make(key)
        return value


def mix(column) -> F.Column:
    """A bijection of longs that scatters neighbouring ids (two xorshift rounds)."""
    for a, b, c in ((13, 7, 17), (23, 17, 26)):
        column = column.bitwiseXOR(F.shiftleft(column, a))
        column = column.bitwiseXOR(F.shiftrightunsigned(column, b))
        column = column.bitwiseXOR(F.shiftleft(column, c))
    return column


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of edges (a long, b long); root is the smallest node of its component.

    Contraction: each round every node moves to its smallest neighbour in a scattered order (three steps along
    that order), the edges are relabelled and loops and repeats go. The image of a connected graph is connected,
    so rounds may stop short of the local minimum. About a third of the nodes outlive a round, whatever the
    shape; no hub gathers rows, since contraction merges them. Every round is written to the shared folder.
    Nodes are at no time on the driver; it reads one count a round.
    """
    spark = edges.sparkSession
    e = edges.where("a is not null and b is not null and a <> b")
    e = materialise(e.select("a", "b").distinct(), f"{name}-edges")
    moves: list[DataFrame] = []
    while not e.isEmpty():
        both = e.union(e.select("b", "a"))
        least = both.groupBy("a").agg(F.min(F.struct(mix(F.col("b")).alias("k"), F.col("b").alias("to"))).alias("m"))
        step = least.select(F.col("a").alias("node"), F.when(F.col("m.k") < mix(F.col("a")), F.col("m.to")).otherwise(F.col("a")).alias("to"))
        step = materialise(step, f"{name}-step")
        for _ in range(2):
            again = step.select(F.col("node").alias("to"), F.col("to").alias("next"))
            step = materialise(step.join(again, "to").select("node", F.col("next").alias("to")), f"{name}-step")
        moves.append(step)
        left = step.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = step.select(F.col("node").alias("b"), F.col("to").alias("y"))
        moved = e.join(left, "a").select("b", "x")
        moved = moved.join(right, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        e = materialise(moved.distinct(), f"{name}-edges")
    if not moves:
        return spark.createDataFrame([], "node long, root long")
    found = moves[0].select("node", F.col("to").alias("at"))
    for step in moves[1:]:
        found = materialise(found, f"{name}-at")
        found = found.join(step.select(F.col("node").alias("at"), "to"), "at", "left").select("node", F.coalesce("to", "at").alias("at"))
    found = materialise(found, f"{name}-at")
    roots = materialise(found.groupBy("at").agg(F.min("node").alias("root")), f"{name}-roots")
    return found.join(roots, "at").select("node", "root")


def union_find(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and edges a-b: the smallest node of each node's component."""
    label = np.arange(n)
    while len(a):
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        np.minimum.at(label, high, low)
        while True:
            deeper = label[label]
            if np.array_equal(deeper, label):
                break
            label = deeper
        live = label[a] != label[b]
        a, b = a[live], b[live]
    return label

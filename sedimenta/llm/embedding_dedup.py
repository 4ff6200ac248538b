"""Embedding near-dedup by an inverted multi-index.

Unit vectors are cut into halves; each half has its own codebook (k-means on a bounded sample), and the pairs of code
words form a grid of cells. Every vector lives in its nearest cell. It also visits further cells in the order of the
multi-sequence: of the sum over both halves of the squared distance to the cell's border, until that sum passes a budget. Of each half only
the code words whose border lies within the budget are looked at, never the whole grid.
The budget is the smallest that lets a sample's true pairs, and vectors moved to just the threshold, meet with the
target recall, each kind by itself; with recall 1 it is the squared distance at the threshold, at which no pair can be missed. What meets in
a cell is verified by the exact cosine in double precision.

Codebooks grow with the square root of the vectors, so that a cell keeps about 64; the sample grows with the codebooks. Equal vectors are
one node with a count. A cell with more than HOMES homes or VISITS visitors is cut into blocks that meet pairwise, each a task's worth: the same
pairs are compared in more tasks, the result doesn't depend on it. Blocks pass on counts and edges to each class's first, never pairs.
A pair that could meet in both vectors' cells is counted in the lower cell only.

Defined results: a vector that is null, empty, zero, or holds null or non-finite numbers, or whose label is null, links with nothing, as do vectors of
different lengths; its component is itself. Rows that repeat a vec_id are vectors of their own under one id. A cosine of just the threshold links.
The GRIDS most frequent vector lengths have codebooks, any others one cell each. Only vec_id, embedding and label are read; other columns, whatever
their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.common import components, materialise, read, union_find

THRESHOLD, RECALL = 0.98, 0.999
#: Bounds of the sample for codebooks and budget (distinct vectors with the smallest hash): from SAMPLE up to SAMPLE_MOST with the number of vectors.
SAMPLE, SAMPLE_MOST = 4096, 32768
#: True pairs of the sample that bear on the budget: so many partners a vector, drawn at random.
PARTNERS = 8
HOMES, VISITS, GRIDS = 1024, 4096, 256


def book_size(n: int) -> int:
    """Code words of a half, a power of two, for n vectors."""
    return int(min(SAMPLE_MOST // 8, max(1, 2 ** round(np.log2(max(1.0, n**0.5 / 8))))))


def sample_size(n: int) -> int:
    return min(SAMPLE_MOST, max(SAMPLE, 8 * book_size(n)))


def vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, code, vector): code names label, length and numbers; null where the row links with nothing."""
    rows = embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, out = [], []
            for label, e in zip(batch.column("label").to_pylist(), batch.column("embedding"), strict=True):
                v = None
                if label is not None and e.is_valid and len(e.values) and not e.values.null_count:
                    v = e.values.to_numpy() + 0.0
                    top = np.abs(v).max()
                    if not np.isfinite(top) or top == 0:
                        v = None
                    else:
                        v = v / top  # no overflow in the norm; the direction is what counts
                        v = v / np.sqrt(v @ v)
                codes.append(None if v is None else hashlib.sha1(f"{label}|{len(v)}|".encode() + (e.values.to_numpy() + 0.0).tobytes()).digest())
                out.append(None if v is None else v.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([None if x is None else str(x) for x in batch.column("label").to_pylist()]), pa.array(codes, pa.binary()), pa.array(out, pa.binary())], names=["vec_id", "label", "code", "vector"])

    return rows.mapInArrow(run, "vec_id long, label string, code binary, vector binary")


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    centres = x[np.random.default_rng(7).choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = np.concatenate([((centres * centres).sum(1) - 2 * x[at : at + 1024] @ centres.T).argmin(1) for at in range(0, len(x), 1024)])
        order = np.argsort(near, kind="stable")
        held, first = np.unique(near[order], return_index=True)
        centres[held] = np.add.reduceat(x[order], first) / np.diff(np.r_[first, len(x)])[:, None]
    return centres


class Half:
    """The codebook of one half."""

    def __init__(self, x: np.ndarray, size: int):
        distinct = np.unique(x, axis=0)
        self.book = kmeans(distinct, min(size, len(distinct)))
        squared = (self.book * self.book).sum(1)
        apart = np.sqrt(np.maximum(0.0, squared[:, None] + squared[None] - 2 * self.book @ self.book.T))
        self.squared, self.apart = squared, np.where(apart < 1e-9, np.inf, apart)

    def distances(self, x: np.ndarray) -> np.ndarray:
        """(n, k): squared distances, less the square of x."""
        return self.squared - 2 * x @ self.book.T

    def border(self, d: np.ndarray, row: np.ndarray, word: np.ndarray) -> np.ndarray:
        """At least the squared distance from each row's vector to the cell of the word."""
        out = np.zeros(len(row))
        step = max(1, (1 << 20) // len(self.book))
        for at in range(0, len(row), step):
            r, w = row[at : at + step], word[at : at + step]
            out[at : at + step] = np.maximum(0.0, ((d[r, w][:, None] - d[r]) / (2 * self.apart[w])).max(1)) ** 2
        return out

    def within(self, d: np.ndarray, budget: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, word, border) of all words whose border lies within the budget, by row.

        The plane between a row's nearest word and another rules out most words; only the others are looked at closely.
        """
        home = d.argmin(1)
        gap = np.maximum(0.0, d - d[np.arange(len(d)), home][:, None]) / (2 * self.apart[home])
        row, word = np.nonzero(gap * gap <= budget)
        border = self.border(d, row, word)
        live = border <= budget
        return row[live], word[live], border[live]


class Grid:
    """Codebooks of both halves, and the budget of a visit."""

    def __init__(self, sample: np.ndarray, labels: np.ndarray, n: int, threshold: float = THRESHOLD, recall: float = RECALL):
        self.cut = sample.shape[1] // 2
        self.halves = [Half(x, book_size(n)) for x in (sample[:, : self.cut], sample[:, self.cut :])]
        self.words = len(self.halves[1].book)
        self.budget = 2 - 2 * threshold + 1e-9  # at which no pair is missed
        if recall < 1:
            needed = [x for x in self.needed(sample, labels, threshold) if len(x)]
            self.budget = float(min([self.budget, *([1.25 * max(np.quantile(x, recall) for x in needed)] if needed else [])]))

    def distances(self, x: np.ndarray) -> list[np.ndarray]:
        return [h.distances(part) for h, part in zip(self.halves, (x[:, : self.cut], x[:, self.cut :]), strict=True)]

    def home(self, x: np.ndarray) -> np.ndarray:
        a, b = self.distances(x)
        return a.argmin(1) * self.words + b.argmin(1)

    def cost(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        row = np.arange(len(x))
        a, b = self.distances(x)
        return self.halves[0].border(a, row, cell // self.words) + self.halves[1].border(b, row, cell % self.words)

    def needed(self, x: np.ndarray, labels: np.ndarray, threshold: float) -> list[np.ndarray]:
        """Budgets at which pairs meet: each vector and a copy moved to just the threshold; true pairs of the sample."""
        rng = np.random.default_rng(11)
        away = rng.normal(size=x.shape)
        away -= (away * x).sum(1)[:, None] * x
        away /= np.maximum(np.linalg.norm(away, axis=1)[:, None], 1e-12)
        true = []
        for a in range(0, len(x), 512):
            i, j = np.nonzero((x[a : a + 512] @ x.T >= threshold) & (labels[a : a + 512, None] == labels[None, :]))
            live = i + a != j
            i, j = i[live], j[live]
            order = np.lexsort((rng.random(len(i)), i))
            i, j = i[order], j[order]
            nth = np.arange(len(i)) - np.searchsorted(i, i)
            true.append(np.stack([i + a, j], 1)[nth < PARTNERS])
        true = np.concatenate(true)
        pairs = [(x, threshold * x + np.sqrt(1 - threshold**2) * away), (x[true[:, 0]], x[true[:, 1]])]
        return [np.minimum(self.cost(p, self.home(q)), self.cost(q, self.home(p))) for p, q in pairs]

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, is home) of all cells within budget, each row's nearest first: the multi-sequence, up to the budget."""
        rows, cells = [], []
        for at in range(0, len(x), 1024):
            d = self.distances(x[at : at + 1024])
            (ra, wa, ca), (rb, wb, cb) = (h.within(y, self.budget) for h, y in zip(self.halves, d, strict=True))
            order = np.lexsort((cb, rb))  # each row's words of the second half, nearest first
            rb, wb, cb = rb[order], wb[order], cb[order]
            low, high = np.searchsorted(rb, ra), np.searchsorted(rb, ra, "right")
            i = np.repeat(np.arange(len(ra)), high - low)
            j = np.arange(len(i)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[i]
            cost = ca[i] + cb[j]
            live = np.flatnonzero(cost <= self.budget)
            live = live[np.lexsort((cost[live], ra[i[live]]))]
            rows.append(ra[i[live]] + at)
            cells.append(wa[i[live]] * self.words + wb[j[live]])
        rows, cells = np.concatenate(rows), np.concatenate(cells)
        return rows, cells, cells == self.home(x)[rows]


class OneCell:
    """For vectors of rare lengths: all live in one cell."""

    budget = 0.0

    def home(self, x: np.ndarray) -> np.ndarray:
        return np.zeros(len(x), np.int64)

    def cost(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        return np.zeros(len(x))

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.arange(len(x)), self.home(x), np.ones(len(x), bool)


def placed(nodes: DataFrame, grids: dict[int, Grid]) -> DataFrame:
    """(label, dim, cell, home, node, times, vector) for the home and every visited cell of each node."""
    held = nodes.sparkSession.sparkContext.broadcast(grids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column("vector").to_pylist()
            dims = np.array([len(v) // 8 for v in data])
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = np.frombuffer(b"".join(data[i] for i in at), np.float64).reshape(len(at), dim)
                rows, cells, home = held.value.get(int(dim), OneCell()).visits(x)
                take = pa.array(at[rows])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").take(take), pa.array(np.full(len(rows), dim, np.int32)), pa.array(cells.astype(np.int32)), pa.array(home), *(batch.column(c).take(take) for c in ("node", "times", "vector"))],
                    names=["label", "dim", "cell", "home", "node", "times", "vector"],
                )

    return nodes.select("label", "node", "times", "vector").mapInArrow(run, "label string, dim int, cell int, home boolean, node long, times long, vector binary")


def blocks(rows: DataFrame) -> DataFrame:
    """rows with (bh, bq), the block of homes and of visitors, and role h or q; crowded cells in several blocks."""
    count = rows.groupBy("label", "dim", "cell").agg(F.sum(F.col("home").cast("int")).alias("homes"), F.count(F.lit(1)).alias("all"))
    count = count.where((F.col("homes") > HOMES) | (F.col("all") > VISITS))
    count = materialise(count.select("label", "dim", "cell", F.ceil(F.col("homes") / HOMES).cast("int").alias("sh"), F.ceil(F.col("all") / VISITS).cast("int").alias("sq")), "vectors-crowded")
    sized = rows.join(count, ["label", "dim", "cell"], "left").withColumns({"sh": F.coalesce("sh", F.lit(1)), "sq": F.coalesce("sq", F.lit(1))})
    scattered = F.xxhash64("node")
    own_h, own_q = F.pmod(scattered, F.col("sh")).cast("int"), F.pmod(scattered, F.col("sq")).cast("int")
    names = ["label", "dim", "cell", "home", "node", "times", "vector"]
    h = sized.where("home").select(*names, own_h.alias("bh"), F.explode(F.sequence(F.lit(0), F.col("sq") - 1)).alias("bq"), F.lit(0).alias("role"))
    q = sized.select(*names, F.explode(F.sequence(F.lit(0), F.col("sh") - 1)).alias("bh"), own_q.alias("bq"), F.lit(1).alias("role"))
    return h.union(q)


def verify(rows: DataFrame, grids: dict[int, Grid], threshold: float = THRESHOLD) -> DataFrame:
    """(node, links, peer): counts of verified links, and edges to the first of each block's class; sorted rows come in."""
    held = rows.sparkSession.sparkContext.broadcast(grids)

    def block(dim: int, cell: int, role: np.ndarray, home: np.ndarray, node: np.ndarray, times: np.ndarray, vector: list[bytes]) -> tuple[np.ndarray, ...]:
        grid = held.value.get(dim, OneCell())
        x = np.frombuffer(b"".join(vector), np.float64).reshape(len(vector), dim)
        h, q = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        if not len(h) or not len(q):
            return ()
        homes = grid.home(x[q]) if (~home[q]).any() else np.full(len(q), cell)
        nodes, at = np.unique(node, return_inverse=True)
        weight = np.zeros(len(nodes), np.int64)
        weight[at] = times
        links = np.zeros(len(nodes), np.int64)
        root = np.arange(len(nodes))
        for a in range(0, len(q), 256):
            i, j = np.nonzero(x[q[a : a + 256]] @ x[h].T >= threshold)
            i, j = q[a + i], h[j]
            of = np.searchsorted(q, i)
            inner = home[i]
            live = np.where(inner, node[i] < node[j], True)
            other = np.flatnonzero(live & ~inner)
            if len(other):  # the visitor's home is a lower cell: counted there if the pair meets there too
                lower = other[homes[of[other]] < cell]
                both = grid.cost(x[j[lower]], homes[of[lower]]) <= grid.budget
                live[lower[both]] = False
            i, j = at[i[live]], at[j[live]]
            links += np.bincount(i, weight[j], len(nodes)).astype(np.int64) + np.bincount(j, weight[i], len(nodes)).astype(np.int64)
            root = union_find(len(nodes), np.r_[np.arange(len(nodes)), i], np.r_[root, j])
        seen = np.flatnonzero(links)
        return nodes[seen], links[seen], nodes[root[seen]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts = None, []

        def done() -> Iterator[pa.RecordBatch]:
            if len(parts):
                table = pa.Table.from_batches(parts).combine_chunks()
                role, home, node, times = (table.column(c).to_numpy() for c in ("role", "home", "node", "times"))
                out = block(key[1], key[2], role, home, node, times, table.column("vector").to_pylist())
                if len(out):
                    yield pa.RecordBatch.from_arrays([pa.array(o) for o in out], names=["node", "links", "peer"])

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("label", "dim", "cell", "bh", "bq")), strict=True))
            at = 0
            for i in range(1, len(keys) + 1):
                if i == len(keys) or keys[i] != keys[at]:
                    if keys[at] != key:
                        yield from done()
                        key, parts = keys[at], []
                    parts.append(batch.slice(at, i - at))
                    at = i
        yield from done()

    return rows.mapInArrow(run, "node long, links long, peer long")


def near_groups(embeddings: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id) for every row; with recall 1 no link is missed."""
    spark = embeddings.sparkSession
    rows = materialise(vectors(embeddings), "vectors-rows")
    nodes = rows.where("code is not null").groupBy("code").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("times"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    nodes = materialise(nodes.withColumn("node", F.monotonically_increasing_id()), "vectors-nodes")
    dim = (F.octet_length("vector") / 8).cast("int")
    grids = {}
    for d, n in nodes.groupBy(dim.alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").limit(GRIDS).collect():
        of_dim = nodes.where(dim == d)
        chosen = F.broadcast(of_dim.select("code").orderBy("code").limit(sample_size(n)))  # codes first: tasks send no vectors to choose from
        got = of_dim.join(chosen, "code", "left_semi").orderBy("code").select("label", "vector").collect()  # at most SAMPLE_MOST rows
        grids[d] = Grid(np.frombuffer(b"".join(r["vector"] for r in got), np.float64).reshape(len(got), d), np.array([r["label"] for r in got]), n, threshold, recall)
    key = ["label", "dim", "cell", "bh", "bq"]
    rows_in = materialise(placed(nodes, grids), "vectors-placed")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = materialise(verify(blocks(rows_in).repartition(tasks, *key).sortWithinPartitions(*key, "role", "node"), grids, threshold), "vectors-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("peer").alias("b")), "vectors")
    named = nodes.select("code", "node", "first", "times").join(links, "node", "left").join(roots, "node", "left")
    named = named.select("code", "first", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"))
    named = materialise(named, "vectors-named")
    least = materialise(named.groupBy("root").agg(F.min("first").alias("component_id")), "vectors-least")
    by_code = materialise(named.join(least, "root").select("code", "n_links", "component_id"), "vectors-components")
    linked = rows.where("code is not null").select("vec_id", "code").join(by_code, "code").select("vec_id", "n_links", "component_id")
    return linked.union(rows.where("code is null").select("vec_id", F.lit(0).cast("long"), "vec_id"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_groups(read(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))

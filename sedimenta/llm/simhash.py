"""SimHash near-dedup by anchor-point covering.

Anchors are the words of a product code on 61 of the 64 bits: two perfect Golay codes of 23 bits and a perfect Hamming code
of 15. Each block of bits lies within its code's covering radius (3, 3, 1) of just one code word. Two fingerprints
at 2 or fewer differing bits have a midpoint at most one bit from either, so a fingerprint is replicated to the anchors
nearest to itself and to each of its one-bit neighbours: all within the covering radius plus the threshold, about 16, and any
two that link meet at their midpoint's anchor. (The full ball of that radius would add anchors at which no link needs to be
found.)

At an anchor, fingerprints link if and only if they share a midpoint: at most 64 bits' worth a fingerprint, so a
crowded anchor costs in proportion to its fingerprints, never to their pairs. Anchors with more than CROWD fingerprints are dealt
out by midpoint, which at most 65 fingerprints share. Links go on as edges to each group's first, never as pairs.

Defined results: null is empty, its fingerprint is zero and links like any other; null ids belong to their fingerprint's
component, whose id is the smallest non-null id (null if there is none).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.common import blobs, components, map_rows, materialise, read, small_text_batches, union_find

SHINGLE, SEED, BITS = 3, 42, 64
CROWD = 4096
#: Generator polynomials (public): Golay [23, 12] and Hamming [15, 11]; (length, check bits, polynomial).
CODES = ((23, 11, 0b101011100011), (23, 11, 0b101011100011), (15, 4, 0b10011))


def fingerprint(data: bytes, size: int = SHINGLE) -> int:
    words = data.lower().split()
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)) if len(words) > size else [b" ".join(words)]
    return majority(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64))


def majority(h: np.ndarray) -> int:
    """The bits set in over half of h."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int32) if len(bits) < 256 else np.add.reduce(bits, 0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp long): the fingerprint's bits as a signed number."""
    small_text_batches(docs.sparkSession)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            got = np.array([fingerprint(t, size) for t in blobs(batch)], np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(got)], names=["doc_id", "fp"])

        return step

    return map_rows(docs.select("doc_id", "text"), "doc_id long, fp long", make)


@lru_cache(maxsize=1)
def codes() -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each block: its first bit, its length, syndromes of bytes (by byte number), and the coset leader of each syndrome."""
    out, first = [], 0
    for n, checks, poly in CODES:

        def remainder(x: int, poly=poly, checks=checks) -> int:
            for i in range(x.bit_length() - 1, checks - 1, -1):
                if x >> i & 1:
                    x ^= poly << (i - checks)
            return x

        by_bit = [remainder(1 << i) for i in range(n)]
        table = np.zeros((-(-n // 8), 256), np.int64)
        for b in range(n):
            values = np.arange(256)
            table[b // 8] ^= np.where(values >> (b % 8) & 1, by_bit[b], 0)
        leaders = np.zeros(1 << checks, np.int64)
        reached = {0: 0}
        while len(reached) < 1 << checks:  # breadth first: leaders of rising weight
            for s, e in list(reached.items()):
                for b in range(n):
                    if s ^ by_bit[b] not in reached:
                        reached[s ^ by_bit[b]] = e | 1 << b
        for s, e in reached.items():
            leaders[s] = e
        out.append((first, n, table, leaders))
        first += n
    return out


def nearest(block: np.ndarray, code: tuple) -> np.ndarray:
    _, _, table, leaders = code
    s = np.zeros(len(block), np.int64)
    for i in range(len(table)):
        s ^= table[i][block >> (8 * i) & 255]
    return block ^ leaders[s]


def anchor(fp: np.ndarray) -> np.ndarray:
    """The nearest code word, of the fingerprint's 61 covered bits."""
    out = np.zeros(len(fp), np.int64)
    for code in codes():
        first, n = code[:2]
        out |= nearest(fp >> first & (1 << n) - 1, code) << first
    return out


def midpoints(fp: np.ndarray) -> np.ndarray:
    """(len(fp), 65): each fingerprint and its one-bit neighbours."""
    flips = np.r_[np.uint64(0), np.uint64(1) << np.arange(BITS, dtype=np.uint64)]
    return (fp.view(np.uint64)[:, None] ^ flips[None, :]).view(np.int64)


def anchors(fps: DataFrame) -> DataFrame:
    """(anchor, fp) for every anchor that a distinct fingerprint is replicated to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            for at in range(0, len(fp), 4096):
                part = np.ascontiguousarray(fp[at : at + 4096])
                near = np.sort(anchor(midpoints(part).ravel()).reshape(-1, BITS + 1), 1)
                new = np.ones(near.shape, bool)
                new[:, 1:] = near[:, 1:] != near[:, :-1]
                yield pa.RecordBatch.from_arrays([pa.array(near[new]), pa.array(np.repeat(part, new.sum(1)))], names=["anchor", "fp"])

    return fps.select("fp").mapInArrow(run, "anchor long, fp long")


def linked(group: np.ndarray, mid: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect all fingerprints of a group that share a midpoint, transitively: each to the smallest of its class."""
    if not len(fp):
        return fp, fp
    order = np.lexsort((fp, mid, group))
    group, mid, fp = group[order], mid[order], fp[order]
    same = np.flatnonzero((group[1:] == group[:-1]) & (mid[1:] == mid[:-1]))
    nodes = np.unique(np.concatenate([fp[same], fp[same + 1]]))
    a, b = np.searchsorted(nodes, fp[same]), np.searchsorted(nodes, fp[same + 1])
    root = union_find(len(nodes), a, b)
    live = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[live], nodes[root[live]]


def compare(rows: DataFrame) -> DataFrame:
    """Edges (a, b) found at the anchors of rows (anchor, fp), which come sorted by anchor within each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_a, kept_f = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def edges(a: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            alone = np.ones(len(a), bool)  # an anchor with one fingerprint has nothing to compare
            alone[1:] &= a[1:] != a[:-1]
            alone[:-1] &= a[1:] != a[:-1]
            a, f = a[~alone], f[~alone]
            out = [[], []]
            begin = 0
            while begin < len(a):  # whole anchors, a few thousand rows at a time
                stop = min(len(a), begin + 8192)
                while stop < len(a) and a[stop] == a[stop - 1]:
                    stop += 1
                mid = midpoints(np.ascontiguousarray(f[begin:stop]))
                at = np.repeat(a[begin:stop], BITS + 1)
                own = anchor(mid.ravel()) == at
                x, y = linked(at[own], mid.ravel()[own], np.repeat(f[begin:stop], BITS + 1)[own])
                out[0].append(x)
                out[1].append(y)
                begin = stop
            x, y = (np.concatenate(o) if o else np.zeros(0, np.int64) for o in out)
            return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])

        for batch in batches:
            a = np.r_[kept_a, batch.column("anchor").to_numpy()]
            f = np.r_[kept_f, batch.column("fp").to_numpy()]
            cut = int(np.searchsorted(a, a[-1])) if len(a) else 0  # the last anchor may go on
            kept_a, kept_f = a[cut:], f[cut:]
            if cut:
                yield edges(a[:cut], f[:cut])
        if len(kept_a):
            yield edges(kept_a, kept_f)

    return rows.mapInArrow(run, "a long, b long")


def compare_crowded(rows: DataFrame) -> DataFrame:
    """The same for crowded anchors: their fingerprints go to their midpoints, and each links to the midpoint's smallest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, f = batch.column("anchor").to_numpy(), np.ascontiguousarray(batch.column("fp").to_numpy())
            for at in range(0, len(f), 4096):
                mid = midpoints(f[at : at + 4096])
                own = anchor(mid.ravel()) == np.repeat(a[at : at + 4096], BITS + 1)
                yield pa.RecordBatch.from_arrays([pa.array(mid.ravel()[own]), pa.array(np.repeat(f[at : at + 4096], BITS + 1)[own])], names=["mid", "fp"])

    mids = rows.mapInArrow(run, "mid long, fp long")
    groups = mids.groupBy("mid").agg(F.collect_set("fp").alias("fps")).where("size(fps) > 1")  # at most 65 each
    return groups.select(F.array_min("fps").alias("b"), F.explode("fps").alias("a")).where("a <> b").select("a", "b")


def classes(fps: DataFrame) -> DataFrame:
    """(fp, root) for the distinct fingerprints that link with another: root names the component."""
    placed = materialise(anchors(fps), "simhash-anchors")
    crowded = materialise(placed.groupBy("anchor").count().where(F.col("count") > CROWD).select("anchor"), "simhash-crowded")
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if crowded.isEmpty():
        edges = compare(placed.repartition(n, "anchor").sortWithinPartitions("anchor"))
    else:
        rest = placed.join(crowded, "anchor", "left_anti")
        edges = compare(rest.repartition(n, "anchor").sortWithinPartitions("anchor")).union(compare_crowded(placed.join(crowded, "anchor", "left_semi")))
    return components(edges, "simhash").select(F.col("node").alias("fp"), "root")


def near_groups(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) for every row of docs."""
    rows = materialise(fingerprints(docs, size), "simhash-rows")
    firsts = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-firsts")
    roots = materialise(classes(firsts), "simhash-roots")
    named = firsts.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = materialise(named, "simhash-named")
    least = materialise(named.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-least")
    by_fp = materialise(named.join(least, "root").select("fp", "component_id"), "simhash-components")
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_groups(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

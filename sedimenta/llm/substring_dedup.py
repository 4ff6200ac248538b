"""Substring dedup on a compacted De Bruijn graph of word k-mers.

Edges are windows of WINDOW words between nodes of WINDOW - 1 words. An edge belongs to the smallest document that it starts
in; other documents lose the words of edges that a smaller document has. Edges by themselves are as many as words, so:

1. Paths. Each text is a path; it is cut at sampled nodes (a hash of the next words decides, so equal passages are cut
   alike) and each nonbranching stretch between cuts, with the words its last edges reach over, is one label. Equal stretches
   are compacted by a join on the label: those that a smaller document has are settled, edges and all. Only the first
   copy of a stretch goes on, and the smallest document of any edge is always among these.
2. Branches. Of the edges that are left, a window's minimiser (the smallest hash of its inner seven-word grams) is joined; an edge
   can be shared only if its minimiser is in two documents.
3. Edges that may be shared are joined by their own label, which gives each its source: document, group and place of the words.
4. Spans. Repeated stretches and edges that follow each other in the document and in the source are one span. A span's words
   are verified against the words at the source's coordinates: each distinct span goes to its source's group, which digests
   the words there; a span that differs stops the job, since it would mean equal labels of unequal words.

A word's code is its XXH3 of 128 bits, a label is 128 bits of BLAKE2 over the codes, a span's digest is a keyed BLAKE2 of the
words themselves; the minimiser's 64 bits and the cuts only select. Joins are requests and answers: documents
are kept in groups of GROUP_BYTES or more, a table bucketed by group; a group asks once for each of its distinct keys, however
many of its documents hold it, so that a passage in a third of all documents is one request a group. Keys are dealt
over partitions by hash. Groups grow with the number of partitions (see `group_bytes`), so that a request doesn't shrink to its header.

Defined results: null is empty. A document without doc_id keeps all words and is no source; rows that repeat an id are judged each
by other ids, so copies under one id all stay or all go. Texts of fewer than WINDOW words keep all. Of documents that share a window the
smallest id keeps it; there are no other ties. A text of any length is read whole, in a group of its own if it is longer than a
group; memory follows the longest text. Columns of documents may have any names: the group's column gets a name that none of them has.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.common import free_name, materialise, read, shared_dir, small_text_batches, trim

WINDOW, GRAM, CUT_GRAM, CUT, SEED = 13, 7, 4, 48, 20240229
GROUP_BYTES, GROUP_DOCS = 1 << 20, 1024
U = np.uint64
BASE = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F))
STRETCH, GRAMS, EDGE = 0, 1, 2


def group_bytes(parts: int) -> int:
    """Text of a group: 1 MB, more beyond 128 key partitions, 8 MB at most (memory of a task)."""
    return min(8 * GROUP_BYTES, max(GROUP_BYTES, parts * (GROUP_BYTES // 128)))


def fmix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def rolling(values: np.ndarray, n: int, base: np.uint64) -> np.ndarray:
    """A hash of each n values in a row, to select by."""
    size = len(values) - n + 1
    if size <= 0:
        return np.zeros(0, U)
    out = values[:size].copy()
    for i in range(1, n):
        out *= base
        out += values[i : i + size]
    return fmix(out)


class Group:
    """The words of a group of documents, and their codes."""

    def __init__(self, docs: list[int | None], data: list[bytes], coded: bool = True):
        split = [d.split() for d in data]  # at ASCII white space
        self.bounds = np.r_[0, np.cumsum([len(w) for w in split], dtype=np.int64)]  # of the documents, in words
        self.words = list(chain.from_iterable(split))
        self.n = len(self.words)
        if not coded:
            return
        self.code = memoryview(b"".join(map(xxhash.xxh3_128_digest, self.words, repeat(SEED))))
        self.hash = np.ascontiguousarray(np.frombuffer(self.code, U).reshape(-1, 2)[:, 0])
        self.index = np.repeat(np.arange(len(docs)), np.diff(self.bounds))  # document of each word
        self.known = np.array([d is not None for d in docs], bool)
        self.docs = np.array([d or 0 for d in docs], np.int64)
        self.starts = (np.arange(self.n) + WINDOW <= self.bounds[1:][self.index]) & self.known[self.index] if self.n else np.zeros(0, bool)  # edges begin here

    def labels(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """128 bits (n, 2) of the codes of words low to high (exclusive)."""
        code = self.code
        return np.frombuffer(b"".join(hashlib.blake2b(code[16 * a : 16 * b], digest_size=16).digest() for a, b in zip(low.tolist(), high.tolist(), strict=True)), U).reshape(-1, 2)

    def digests(self, low: np.ndarray, n: np.ndarray) -> list[bytes]:
        """Of the words themselves, n from low on."""
        return [hashlib.blake2b(b" ".join(self.words[a : a + k]), digest_size=16, key=b"span").digest() for a, k in zip(low.tolist(), n.tolist(), strict=True)]

    def stretches(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """first and last+1 word of the starts of each stretch, its document, and its label (n, 2)."""
        h = rolling(self.hash, CUT_GRAM, BASE[1])
        cut = np.zeros(self.n, bool)
        cut[: len(h)] = h % U(CUT) == 0
        cut[1 : len(h)] &= h[1:] != h[:-1]
        full = np.diff(self.bounds) >= WINDOW
        first = self.bounds[:-1][full & self.known]
        cut[first] = True
        cut &= self.starts
        low = np.flatnonzero(cut)
        doc = self.index[low]
        last = self.bounds[1:][doc] - WINDOW + 1
        high = np.minimum(np.r_[low[1:], self.n], last)
        return low, high, doc, self.labels(low, high + WINDOW - 1)

    def open_starts(self, answer: dict) -> tuple[np.ndarray, np.ndarray]:
        """Starts that stretches don't settle, and the repeated stretches as (first start, starts, source group, source place)."""
        low, high, doc, label = self.stretches()
        owner, group, place = lookup(label, answer.get(STRETCH))
        settled = owner < self.docs[doc]
        mark = np.zeros(self.n + 1, np.int64)
        np.add.at(mark, low[settled], 1)
        np.add.at(mark, high[settled], -1)
        taken = np.cumsum(mark[:-1]) > 0
        return np.flatnonzero(self.starts & ~taken), np.stack([low, high - low, group, place], 1)[settled]

    def minimisers(self, at: np.ndarray) -> np.ndarray:
        grams = rolling(self.hash, GRAM, BASE[0])
        out = np.full(len(at), U(0xFFFFFFFFFFFFFFFF))
        for i in range(WINDOW - GRAM + 1):
            np.minimum(out, grams[at + i], out=out)
        return fmix(out)  # minima crowd near zero; scattered again to be dealt evenly

    def ask(self, level: int, answer: dict) -> tuple[np.ndarray, np.ndarray]:
        """(keys (n, 1 or 2), their first words) of a level, given the answers of those before."""
        if level == STRETCH:
            low, _, _, label = self.stretches()
            return label, low
        at, _ = self.open_starts(answer)
        key = self.minimisers(at)
        if level == GRAMS:
            return key[:, None], at
        at = at[np.isin(key, answer[GRAMS])] if GRAMS in answer else at[:0]
        return self.labels(at, at + WINDOW), at

    def spans(self, answer: dict) -> np.ndarray:
        """Repeated spans as (first word, words, source group, source place): hits that follow each other here and in the source."""
        at, hits = self.open_starts(answer)
        if GRAMS in answer and EDGE in answer:
            at = at[np.isin(self.minimisers(at), answer[GRAMS])]
            owner, group, place = lookup(self.labels(at, at + WINDOW), answer[EDGE])
            live = owner < self.docs[self.index[at]]
            hits = np.concatenate([hits, np.stack([at, np.ones_like(at), group, place], 1)[live]])
        hits = hits[np.argsort(hits[:, 0], kind="stable")]
        if not len(hits):
            return hits
        first, n, group, place = hits.T
        follows = (first[1:] == first[:-1] + n[:-1]) & (group[1:] == group[:-1]) & (place[1:] == place[:-1] + n[:-1]) & (self.index[first[1:]] == self.index[first[:-1]])
        begin = np.flatnonzero(np.r_[True, ~follows])
        return np.stack([first[begin], np.add.reduceat(n, begin) + WINDOW - 1, group[begin], place[begin]], 1)


def lookup(keys: np.ndarray, answer: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, group and place of 128-bit keys; the largest long where there is no answer."""
    out = np.full((len(keys), 3), np.iinfo(np.int64).max)
    if answer is not None and len(answer[0]) and len(keys):
        table, owner = answer  # sorted by the first half, then by the second
        at = np.searchsorted(table[:, 0], keys[:, 0])
        live = np.arange(len(keys))
        while len(live):  # first halves rarely repeat
            live = live[at[live] < len(table)]
            live = live[table[at[live], 0] == keys[live, 0]]
            same = table[at[live], 1] == keys[live, 1]
            out[live[same]] = owner[at[live[same]]]
            live = live[~same]
            at[live] += 1
    return out[:, 0], out[:, 1], out[:, 2]


def packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers, each from its least value on and as narrow as its range allows."""
    out = []
    for x in columns:
        least = x.min()
        x = (x - least).view(U) if x.dtype == np.int64 else x - least
        kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if int(x.max()) <= np.iinfo(k).max)
        out.append(np.array([int(least), np.dtype(kind).itemsize], np.int64).tobytes() + x.astype(kind).tobytes())
    return b"".join(out)


def unpacked(blob: bytes, at: int, n: int, columns: int) -> list[np.ndarray]:
    out = []
    for _ in range(columns):
        least, width = np.frombuffer(blob, np.int64, 2, at).tolist()
        x = np.frombuffer(blob, f"u{width}", n, at + 16)
        out.append((x.astype(U) + U(least & (1 << 64) - 1)).view(np.int64))
        at += 16 + n * width
    return out


def requests(group: Group, level: int, answer: dict, parts: int) -> list[tuple[int, bytes]]:
    """(partition, packed keys) of a group: each key once, with its smallest document, the place there, and its largest document."""
    keys, at = group.ask(level, answer)
    if not len(keys):
        return []
    doc_id = group.docs[group.index[at]]
    order = np.lexsort((doc_id, *keys.T[::-1]))
    keys, doc_id, at = keys[order], doc_id[order], at[order]
    first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
    last = np.r_[first[1:], len(keys)] - 1
    keys, least, most, place = keys[first], doc_id[first], doc_id[last], at[first]
    part = ((keys[:, 0] >> U(40)) * U(parts) >> U(24)).astype(np.int64)  # rising with the key
    cuts = np.searchsorted(part, np.arange(parts + 1))
    out = []
    for p in np.unique(part).tolist():
        a, b = cuts[p], cuts[p + 1]
        columns = (least[a:b], most[a:b]) if level == GRAMS else (least[a:b], most[a:b], place[a:b])
        out.append((p, np.int64(b - a).tobytes() + np.ascontiguousarray(keys[a:b]).tobytes() + packed(*columns)))
    return out


def asked(blob: bytes, level: int) -> list[np.ndarray]:
    """[keys, smallest document, largest document, place but for minimisers] of a request."""
    n, width = int(np.frombuffer(blob, np.int64, 1)[0]), 1 if level == GRAMS else 2
    return [np.frombuffer(blob, U, n * width, 8).reshape(n, width), *unpacked(blob, 8 + 8 * n * width, n, 2 if level == GRAMS else 3)]


def answers(level: int):
    """What a partition of keys answers: to each group its keys that other documents share, with their owner, its group and place."""

    def run(table: pa.Table) -> pa.Table:
        groups = np.array(table.column("g").to_pylist(), np.int64)
        parts = [asked(x, level) for x in table.column("blob").to_pylist()]
        source = np.repeat(np.arange(len(parts)), [len(p[1]) for p in parts])
        keys, least, most, *place = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        order = np.lexsort((least, *keys.T[::-1]))  # the owner's request first
        keys, least, most, source = keys[order], least[order], most[order], source[order]
        first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
        number = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(keys)]))
        owner = least[first][number]
        hit = owner < (np.maximum.reduceat(most, first)[number] if level == GRAMS else most)
        columns = [keys[hit]]
        if level != GRAMS:
            columns += [np.stack([owner, groups[source[first]][number], place[0][order][first][number]], 1)[hit]]
        source = source[hit]
        order = np.argsort(source, kind="stable")  # keys stay sorted within a group
        columns = [c[order] for c in columns]
        cuts = np.searchsorted(source[order], np.arange(len(groups) + 1))
        del keys, least, most, owner, number, hit, order
        trim()
        out = [(g, b"".join(c[a:b].tobytes() for c in columns)) for g, a, b in zip(groups.tolist(), cuts[:-1], cuts[1:], strict=True) if a < b]
        return pa.table({"g": pa.array([g for g, _ in out], pa.int64()), "level": pa.array([level] * len(out), pa.int32()), "blob": pa.array([x for _, x in out], pa.binary())})

    return run


def answered(table: pa.Table) -> dict:
    """Of a group: level -> (keys, (owner, group, place)), sorted; for minimisers the keys alone."""
    found: dict[int, list] = {}
    for level, blob in zip(table.column("level").to_pylist(), table.column("blob").to_pylist(), strict=True):
        if level == GRAMS:
            found.setdefault(level, []).append((np.frombuffer(blob, U),))
        else:
            n = len(blob) // 40
            found.setdefault(level, []).append((np.frombuffer(blob, U, 2 * n).reshape(n, 2), np.frombuffer(blob, np.int64, 3 * n, 16 * n).reshape(n, 3)))
    out = {}
    for level, parts in found.items():
        keys, *owner = (np.concatenate(x) for x in zip(*parts, strict=True))
        if level == GRAMS:
            out[level] = np.sort(keys)
        else:
            order = np.lexsort((keys[:, 1], keys[:, 0]))
            out[level] = (keys[order], owner[0][order])
    return out


def group_of(table: pa.Table, coded: bool = True) -> Group:
    data = [t or b"" for t in table.column("text").cast(pa.binary()).to_pylist()]
    return Group(table.column("doc_id").to_pylist(), data, coded)


class Grouped:
    """The documents in a table bucketed by group, so that joins with answers move the answers only."""

    def __init__(self, docs: DataFrame, columns: list[str]):
        spark = self.spark = docs.sparkSession
        small_text_batches(spark)
        self.parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.columns = columns
        name = self.group = free_name(docs, "group")
        most_bytes, most_docs = group_bytes(2 * self.parts), GROUP_DOCS

        def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            g, docs_in, bytes_in = TaskContext.get().partitionId() << 32, 0, 0
            for batch in batches:
                out = []
                for n in batch.column("text").cast(pa.binary()).to_pylist():
                    n = len(n or b"")
                    if docs_in and (docs_in >= most_docs or bytes_in + n > most_bytes):
                        g, docs_in, bytes_in = g + 1, 0, 0
                    docs_in, bytes_in = docs_in + 1, bytes_in + n
                    out.append(g)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64()), *batch.columns], names=[name, *batch.schema.names])

        kept = docs.select(*columns)
        schema = f"`{name}` long, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
        table = f"grouped_{uuid.uuid4().hex[:12]}"
        writer = kept.mapInArrow(number, schema).repartition(self.parts, name).write.format("parquet").bucketBy(self.parts, name)
        writer.option("path", shared_dir(spark, "grouped")).saveAsTable(table)
        self.table = spark.table(table)

    def join(self, found: DataFrame | None, run, schema: str) -> DataFrame:
        """run(rows of a group, rows of found with its number in g) for every group."""
        found = found if found is not None else self.spark.createDataFrame([], "g long, level int, blob binary")

        def one(left: pa.Table, right: pa.Table) -> pa.Table:
            out = run(left, right)
            trim()
            return out

        return self.table.groupBy(self.group).cogroup(found.groupBy("g")).applyInArrow(one, schema)


def ask(grouped: Grouped, level: int, found: DataFrame | None) -> DataFrame:
    parts, name = 2 * grouped.parts, grouped.group

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        g = left.column(name)[0].as_py() if left.num_rows else 0
        out = requests(group_of(left), level, answered(right), parts) if left.num_rows else []
        return pa.table({"p": pa.array([p for p, _ in out], pa.int32()), "g": pa.array([g] * len(out), pa.int64()), "blob": pa.array([b for _, b in out], pa.binary())})

    requested = grouped.join(found, run, "p int, g long, blob binary")
    return materialise(requested.groupBy("p").applyInArrow(answers(level), "g long, level int, blob binary"), "substring-answers")


SPANS = "g long, first long, n long, source long, place long, digest binary"


def spans(grouped: Grouped, found: DataFrame) -> DataFrame:
    """The repeated spans of all groups, with the digest of their words."""
    name = grouped.group

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        hits, digests, g = np.zeros((0, 4), np.int64), [], 0
        if left.num_rows:
            group, g = group_of(left), left.column(name)[0].as_py()
            hits = group.spans(answered(right))
            digests = group.digests(hits[:, 0], hits[:, 1])
        columns = [pa.array([g] * len(hits), pa.int64()), *(pa.array(c) for c in hits.T), pa.array(digests, pa.binary())]
        return pa.table(columns, names=["g", "first", "n", "source", "place", "digest"])

    return materialise(grouped.join(found, run, SPANS), "substring-spans")


def verified(grouped: Grouped, rows: DataFrame) -> DataFrame:
    """rows, if the words at each distinct span's source coordinates are the span's words."""
    claims = rows.select(F.col("source").alias("g"), "place", "n", "digest").distinct()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        wrong = right.num_rows
        if left.num_rows and right.num_rows:
            own = group_of(left, coded=False).digests(right.column("place").to_numpy(), right.column("n").to_numpy())
            wrong = sum(x != y for x, y in zip(own, right.column("digest").to_pylist(), strict=True))
        return pa.table({"wrong": pa.array([wrong], pa.int64())})

    wrong = grouped.join(claims, run, "wrong long").agg(F.sum("wrong")).first()[0]
    if wrong:
        raise ValueError(f"{wrong} spans differ from the words at their source's coordinates")
    return rows


def repeats(docs: DataFrame, columns: list[str]) -> tuple[Grouped, DataFrame]:
    """The documents in groups, and their repeated spans."""
    grouped = Grouped(docs, columns)
    found = None
    for level in (STRETCH, GRAMS, EDGE):
        new = ask(grouped, level, found)
        found = new if found is None else found.union(new)
    return grouped, verified(grouped, spans(grouped, found)).select("g", "first", "n")


def gone(group: Group, rows: pa.Table) -> np.ndarray:
    """For each word whether a repeated span covers it."""
    first, n = rows.column("first").to_numpy(), rows.column("n").to_numpy()
    mark = np.bincount(first, minlength=group.n + 1) - np.bincount(first + n, minlength=group.n + 1)
    return np.cumsum(mark[: group.n]) > 0


def kept_words(group: Group, lost: np.ndarray, i: int) -> bytes:
    """The words of document i that stay, by one space."""
    a, b = group.bounds[i], group.bounds[i + 1]
    if not lost[a:b].any():
        return b" ".join(group.words[a:b])
    return b" ".join([group.words[k] for k in (a + np.flatnonzero(~lost[a:b])).tolist()])


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped, found = repeats(read(spark, sf_dir, "documents"), ["doc_id", "text"])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()), "kept_sha256": pa.array([], pa.string())})
        group = group_of(left, coded=False)
        lost = gone(group, right)
        total = np.r_[0, np.cumsum(lost)]
        sha = [hashlib.sha256(kept_words(group, lost, i)).hexdigest() for i in range(left.num_rows)]
        return pa.table({"doc_id": left.column("doc_id"), "n_words": pa.array(np.diff(group.bounds).astype(np.int64)), "n_removed": pa.array(np.diff(total[group.bounds])), "kept_sha256": pa.array(sha)})

    return grouped.join(found, run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents),
k AS (SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS gram FROM (SELECT r, doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d)),
own AS (SELECT gram, min(doc_id) AS owner FROM k GROUP BY gram),
hit AS (SELECT DISTINCT r, unnest(generate_series(i, i + 12)) AS i FROM k JOIN own USING (gram) WHERE owner < doc_id),
kept AS (SELECT p.r, string_agg(p.x, ' ' ORDER BY p.i) AS t, count(*) AS n FROM (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d) p ANTI JOIN hit ON p.r = hit.r AND p.i = hit.i GROUP BY p.r)
SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256 FROM d LEFT JOIN kept ON d.r = kept.r
"""


def remove(docs: DataFrame) -> DataFrame:
    """docs with the repeated words gone from text; a text that loses nothing stays as it is. n_chars, if there, follows."""
    columns = docs.columns
    grouped, found = repeats(docs, columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left_out = left.select(columns)
        if not left.num_rows:
            return left_out
        group = group_of(left, coded=False)
        lost = gone(group, right)
        total = np.diff(np.r_[0, np.cumsum(lost)][group.bounds])
        text = [t if not n else kept_words(group, lost, i).decode() for i, (t, n) in enumerate(zip(left.column("text").to_pylist(), total.tolist(), strict=True))]
        left_out = left_out.set_column(columns.index("text"), "text", pa.array(text, pa.string()))
        if "n_chars" in columns:
            sizes = [n if not cut else len(t) for n, cut, t in zip(left.column("n_chars").to_pylist(), total.tolist(), text, strict=True)]
            left_out = left_out.set_column(columns.index("n_chars"), "n_chars", pa.array(sizes, left.schema.field("n_chars").type))
        return left_out

    return grouped.join(found, run, schema)

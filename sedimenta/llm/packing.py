"""Best-fit packing by linear grouping.

Token lengths are integers up to the sequence size, so the whole plan is made on the histogram of lengths, which has
at most `size` entries whatever the input:
1. large lengths, in falling order, are cut into groups of equal cardinality and rounded up to their group's largest;
2. configurations of the few rounded sizes are chosen by column generation (multiplicative-weight prices, a knapsack over
   capacities for the column), whole multiples first, the remainder by best fit;
3. actual lengths take the places of the rounded ones, in falling order, which leaves room in the sequences;
4. small lengths go by best fit, largest first, into the room that is left, then into new sequences.
The plan is a table of runs: (length, first rank, last rank, first sequence, places a sequence, offset). Documents only need
their rank among documents of equal length: a local rank from the task that tokenised them plus a sum over tasks.

Defined results: a null text is empty and packs as the single end id; rows that repeat an id are packed each.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sedimenta.llm.bpe import Merges
from sedimenta.llm.common import Memo, map_rows, materialise, read, small_text_batches, texts, trim

SIZE = 2048
END = 0
#: Groups of equal cardinality of the large lengths; lengths over LARGE of the size count as large.
GROUPS = 128
LARGE = 0.12


#: Characters whose case, class and normal form are plain: printable ASCII, tab and line ends, Latin letters with marks.
PLAIN = "\t\n\r\x20-\x7E\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u0148\u014A-\u017E"
ODD = re.compile(f"[^{PLAIN}]|<\\|")
#: Of lower-cased plain characters: letters, a digit, what follows an apostrophe, marks.
WORD = re.compile(r"[a-z\u00DF-\u00F6\u00F8-\u017E]+|[0-9]|'(?:[stmd]|re|ve|ll)|[!-/:-@\[-`{-~]+")
CLOSE = "</w>"
#: Letters of texts that are cut into words at a time (a longer text alone), and of the words kept with their ids: a Python worker stays small
#: whatever the texts are.
CUT = 1_000_000
KEPT = 4_000_000


def by_letters(batch: list[str], most: int = CUT) -> Iterator[list[str]]:
    """The batch's texts in order, as many together as have `most` letters."""
    some, held = [], 0
    for text in batch:
        if some and held + len(text) > most:
            yield some
            some, held = [], 0
        some.append(text)
        held += len(text)
    if some:
        yield some


class WordTokenizer:
    """The ids that the tokenizers library gives, for a lower-casing word BPE with word ends.

    Words of plain characters are merged by the rounds of bpe.py, once for each distinct word; runs between spaces
    that hold any other character, or may hold a special token, go to the library itself. The tokenizer drops white
    space and joins nothing across it, so runs are independent.
    """

    def __init__(self, path: str, most: int = 400_000):
        self.path = path
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)["model"]
        if spec["end_of_word_suffix"] != CLOSE or spec["continuing_subword_prefix"] or spec["byte_fallback"] or spec["ignore_merges"]:
            raise ValueError("only word BPE with word ends is read")
        ids = spec["vocab"]
        two = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["merges"]]
        self.merges = Merges(max(ids.values()) + 1, [(ids[a], ids[b], rank, ids[a + b]) for rank, (a, b) in enumerate(two)])
        # The byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 on, in order.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in shown]
        letter = {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(rest)}
        self.inner = np.array([ids[letter[b]] for b in range(256)])
        self.final = np.array([ids[letter[b] + CLOSE] for b in range(256)])
        self.most = most
        self.known: dict[str, bytes] = {}
        self.letters = 0  # of known
        self.odd: dict[str, bytes] = Memo(self.by_library, 50_000)
        self.odd_letters = 0

    @cached_property
    def library(self):
        """Read only where a run needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def by_library(self, run: str) -> bytes:
        self.odd_letters += len(run)
        if self.odd_letters > KEPT:
            self.odd.clear()
            self.odd_letters = len(run)
        return np.array(self.library.encode(run, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        more = sum(map(len, new))
        if len(self.known) + len(new) > self.most or self.letters + more > KEPT:
            self.known = {w: self.known[w] for w in words if w in self.known}
            self.letters = sum(map(len, self.known))
        self.letters += more
        for at in range(0, len(new), 100_000):
            part = [w.encode() for w in new[at : at + 100_000]]
            size = np.array([len(w) for w in part])
            data = np.frombuffer(b"".join(part), np.uint8)
            sym = self.inner[data]
            last = np.cumsum(size) - 1
            sym[last] = self.final[data[last]]
            ids, seg = self.merges.run(sym, np.repeat(np.arange(len(part)), size))
            stop = (4 * np.cumsum(np.bincount(seg, minlength=len(part)))).tolist()
            ids = ids.astype("<u4").tobytes()
            self.known.update(zip(new[at : at + 100_000], map(ids.__getitem__, map(slice, [0, *stop[:-1]], stop)), strict=True))

    def encode(self, batch: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out = []
        for some in by_letters(batch):
            cut: list[list[list[str] | bytes]] = []
            for text in some:
                if not ODD.search(text):
                    cut.append([WORD.findall(text.lower())])
                    continue
                parts, plain = [], []
                for run in text.replace("\n", " ").split(" "):
                    if ODD.search(run):
                        parts += [plain, self.odd[run]]
                        plain = []
                    else:
                        plain += WORD.findall(run.lower())
                cut.append([*parts, plain])
            self.learn(set().union(*(p for parts in cut for p in parts if isinstance(p, list))))
            out += [b"".join(p if isinstance(p, bytes) else b"".join(map(self.known.__getitem__, p)) for p in parts) for parts in cut]
        return out


@lru_cache(maxsize=1)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"


def pieces(docs: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """One row a piece, with the task that cut it and its rank among that task's pieces of equal length."""
    small_text_batches(docs.sparkSession)

    def make():
        tok = tokenizer(path)
        task = TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        end = np.array([END], "<u4").tobytes()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            cols: list[list] = [[] for _ in range(7)]
            ids = batch.column("doc_id").to_pylist()
            for doc, data in zip(ids, tok.encode(texts(batch)), strict=True):
                data += end
                for n, at in enumerate(range(0, len(data), 4 * size)):
                    part = data[at : at + 4 * size]
                    length = len(part) // 4
                    for col, value in zip(cols, (doc, n, at // 4, length, zlib.crc32(part), task, seen[length]), strict=True):
                        col.append(value)
                    seen[length] += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])

        return step

    return map_rows(docs.select("doc_id", "text"), PIECES, make, trim)


def knapsack(sizes: np.ndarray, prices: np.ndarray, size: int) -> list[int]:
    """Indices, with repeats, of the sizes that fit into size at the highest price (unbounded knapsack)."""
    best, pick = np.zeros(size + 1), np.full(size + 1, -1)
    for cap in range(int(sizes.min()), size + 1):
        fit = np.searchsorted(sizes, cap, "right")
        value = best[cap - sizes[:fit]] + prices[:fit]
        top = int(np.argmax(value))
        if value[top] > best[cap - 1] + 1e-12:
            best[cap], pick[cap] = value[top], top
        else:
            best[cap] = best[cap - 1]
    out, cap = [], size
    while cap > 0:
        if pick[cap] < 0 or best[cap] == best[cap - 1]:
            cap -= 1
        else:
            out.append(int(pick[cap]))
            cap -= int(sizes[pick[cap]])
    return out


def configurations(sizes: np.ndarray, counts: np.ndarray, size: int, rounds: int = 150) -> list[tuple[list[int], int]]:
    """(configuration, multiplicity) covering counts of the rounded sizes, few in all.

    The fractional covering problem is solved by multiplicative weights: prices rise for sizes that lag behind, and the best column at
    the current prices is used. Multiplicities are rounded down; what stays uncovered is left to the caller's best fit.
    """
    need = counts.astype(float)
    used: dict[tuple[int, ...], float] = {}
    covered = np.zeros(len(sizes))
    for _ in range(rounds):
        left = need - covered
        if (left < 1).all():
            break
        live = np.flatnonzero(left >= 1)
        share = left[live] / need[live]
        prices = sizes[live] * (1 + 0.35 * (share / share.max()) + 0.05 * sizes[live] / size)
        column = live[knapsack(sizes[live], prices, size)]
        each, times = np.unique(column, return_counts=True)
        whole = int(min(left[each] // times))
        if whole < 1:  # the column repeats a size more often than is left: a greedy one from what is there
            rest, column = size, []
            for i in live[::-1]:
                k = int(min(left[i], rest // sizes[i]))
                column += [int(i)] * k
                rest -= k * int(sizes[i])
            each, times = np.unique(column, return_counts=True)
            whole = int(min(left[each] // times))
        part = max(1, whole if whole < 8 else whole // 2)
        used[tuple(np.repeat(each, times).tolist())] = used.get(tuple(np.repeat(each, times).tolist()), 0) + part
        covered[each] += times * part
    return [(list(c), int(m)) for c, m in used.items()]


def plan(histogram: dict[int, int], size: int = SIZE, groups: int = GROUPS) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, rank from, rank to, first sequence, places a sequence, offset) for lengths 1..size."""
    left = {n: c for n, c in histogram.items() if c}
    bins: list[tuple[dict[int, int], int]] = []  # contents (length -> how often), number of such sequences
    if left.get(size):
        bins.append(({size: 1}, left.pop(size)))
    large = sorted((n for n in left if n > LARGE * size), reverse=True)
    total = sum(left[n] for n in large)
    if total:
        # 1. Equal cardinality, in falling order of length; one length can make up several groups' worth.
        each = -(-total // groups)
        spans, group, filled = [], {}, 0
        for n in large:
            take = left[n]
            while take:
                part = min(take, each - filled)
                group[n] = group.get(n, 0) + part
                filled, take = filled + part, take - part
                if filled == each:
                    spans.append(group)
                    group, filled = {}, 0
        if group:
            spans.append(group)
        merged: dict[int, list[list[int]]] = {}  # rounded size -> actual lengths in falling order with counts
        for g in spans:
            merged.setdefault(max(g), []).extend([n, c] for n, c in sorted(g.items(), reverse=True))
        sizes = np.array(sorted(merged))
        counts = np.array([sum(c for _, c in merged[s]) for s in sizes.tolist()])
        # 2. and 3. Runs of sequences with equal contents: cut wherever the actual length at one of the places changes.
        for column, times in configurations(sizes, counts, size):
            while times:
                contents: dict[int, int] = {}
                run = times
                for s, k in zip(*np.unique(sizes[column], return_counts=True), strict=True):
                    n, c = merged[int(s)][0]
                    if c >= k:
                        run = min(run, c // int(k))
                    else:
                        run = 1
                for s, k in zip(*np.unique(sizes[column], return_counts=True), strict=True):
                    queue, want = merged[int(s)], int(k) * run
                    while want:
                        part = min(want, queue[0][1])
                        if part < want or want == part and run == 1 or part == int(k) * run:
                            contents[queue[0][0]] = contents.get(queue[0][0], 0) + (part if run == 1 else part // run)
                        queue[0][1] -= part
                        want -= part
                        left[queue[0][0]] -= part
                        if not queue[0][1]:
                            queue.pop(0)
                bins.append((contents, run))
                times -= run
    # 4. Best fit, largest first, for the small ones and what the configurations left.
    room: dict[int, list[tuple[dict[int, int], int]]] = {}
    for contents, times in bins:
        room.setdefault(size - sum(n * k for n, k in contents.items()), []).append((contents, times))
    free = np.zeros(size + 1, bool)
    free[list(room)] = True
    for n in sorted((n for n in left if left[n]), reverse=True):
        todo = left[n]
        while todo:
            at = n + int(np.argmax(free[n:]))
            if not free[at]:
                at, times, contents = size, -(-todo // (size // n)), {}
            else:
                contents, times = room[at].pop()
                free[at] = bool(room[at])
            fit = at // n
            run = min(times, todo // fit)
            if run < times:  # the rest of these sequences keep their room
                if not run:
                    run, fit = 1, todo
                if times > run and (contents or at < size):
                    room.setdefault(at, []).append((contents, times - run))
                    free[at] = True
            todo -= run * fit
            then = {**contents, n: contents.get(n, 0) + fit}
            room.setdefault(at - n * fit, []).append((then, run))
            free[at - n * fit] = True
    out, sequence, rank = [], 0, dict.fromkeys(histogram, 0)
    for contents, times in (b for some in room.values() for b in some):
        offset = 0
        for n, k in contents.items():
            out.append((n, rank[n], rank[n] + k * times, sequence, k, offset))
            rank[n] += k * times
            offset += n * k
        sequence += times
    if rank != {n: c for n, c in histogram.items()}:
        raise AssertionError("the plan doesn't hold every document once")
    return out


def pack(docs: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    spark = docs.sparkSession
    cut = materialise(pieces(docs, path, size), "pack-pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `size` rows
    runs: dict[int, list[tuple[int, ...]]] = {}
    for n, *run in plan(histogram, size):
        runs.setdefault(n, []).append(tuple(run))
    table = {n: np.array(sorted(r), np.int64) for n, r in runs.items()}
    # A task's count of a length is small data, at most `size` rows a task, and two columns of the pieces are read again for it: each table
    # that is written costs every task a file and the processes that Hadoop starts to set its mode.
    counts = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # The starts grow with the number of tasks, so they are dealt out and not broadcast; the pieces needn't be sorted to meet them.
    ranked = cut.join(starts.hint("shuffle_hash"), ["length", "task"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))
    placed = spark.sparkContext.broadcast(table)  # bounded by the number of runs, which follows from `size` and the groups

    def make():
        lookup = placed.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                n = int(length[part[0]])
                low, _, first, places, at = lookup[n].T
                run = np.searchsorted(low, rank[part], "right") - 1
                nth = rank[part] - low[run]
                sequence[part] = first[run] + nth // places[run]
                offset[part] = at[run] + nth % places[run] * n
            return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

        return step

    return map_rows(ranked, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long", make)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_packing(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), path or vocabulary())

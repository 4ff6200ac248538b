"""Toxicity by a linear-chain conditional random field over words.

Training (driver, a bounded sample of labelled rows): the tables label documents, not words, so word labels are derived: words and word
beginnings whose share among toxic documents is far above their share among the others are cues; in toxic documents words with
a cue are labelled toxic, all other words are not. A two-label CRF with cue weights and transitions is fitted to the sentences by its exact
gradient, equal sentences counted by their number and sentences without a cue by their length; a logistic curve
turns a document's marginals into its score.

Scoring (executors, whole texts): forward-backward over every word. Words without a cue all share one potential, so a
gap of k of them is the k-th power of one 2x2 matrix and only cue words cost a step; the marginals are exact.

Defined results: null is empty; a text without cue words, the empty one included, has the score of none, below 0.5 wherever both classes were
learnt from. Rows that repeat an id are scored each by its text; in the sample an id counts once, with its least text and as
toxic if any of its labels says so, and a text that has both labels counts once under each. Equal texts have equal scores. A text of any length is
scored whole; training reads whole texts too and its memory follows the distinct sentences. labels, lang, source and doc_id are never inputs of a
score. `tag` returns any columns of documents, whatever their names, if `score` and `spans` are names that none of them has.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.common import Memo, map_rows, materialise, read, small_text_batches, texts

#: Bound of the training sample: labelled documents of each class, those with the smallest hash of their id.
SAMPLE = 2000
WORD = re.compile(r"[^\W_]+")
#: A cue: at least SUPPORT distinct toxic training documents hold it, and its log odds are at least ODDS.
SUPPORT, ODDS = 6, 3.0
SENTENCE = 64


def features(word: str) -> list[str]:
    return ["=" + word, *(word[:n] for n in range(4, min(len(word), 9)))]


@dataclass
class Tagger:
    """weights: cue -> weight for label 1; bias: of label 1 for every word; trans[a, b]; curve: of a document's score."""

    weights: dict[str, float]
    bias: float = -4.0
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))
    curve: np.ndarray = field(default_factory=lambda: np.array([-3.0, 6.0, 0.0]))

    def cue(self, word: str) -> float:
        w = self.weights
        return sum(w[f] for f in features(word) if f in w)

    def gaps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """The matrix of one word without a cue, taken apart: its powers are right @ diag(1, ratio^k) @ left, scaled."""
        m = np.exp(self.trans + np.array([0.0, self.bias]))
        values, right = np.linalg.eig(m)
        order = np.argsort(-values.real)
        right = right.real[:, order]
        return right, np.linalg.inv(right), m, float(values.real[order[1]] / values.real[order[0]])

    def marginals(self, at: list[int], cue: list[float], n: int) -> np.ndarray:
        """P(label 1) of the cue words at positions `at` with cue sums `cue`, in a text of n words."""
        right, left, _, ratio = self.gaps_kept
        size = len(at)
        emit = np.stack([np.ones(size), np.exp(np.clip(self.bias + np.array(cue), -30, 30))], 1)
        step = np.exp(self.trans)
        forward = np.zeros((size, 2))
        # The first word has the start potential; an empty gap before it is the start vector itself.
        v, gone = np.exp(self.start), 0
        for i, p in enumerate(at):
            gap = p - gone
            if i == 0:
                if gap:
                    first = v * np.array([1.0, math.exp(self.bias)])
                    v = first @ (right * np.array([1.0, ratio ** (gap - 1)])) @ left
                    v = v @ step
            else:
                v = v @ (right * np.array([1.0, ratio**gap])) @ left @ step
            v = v * emit[i]
            v /= v.sum()
            forward[i] = v
            gone = p + 1
        back = (right * np.array([1.0, ratio ** (n - gone)])) @ left @ np.ones(2)
        out = np.zeros(size)
        for i in range(size - 1, -1, -1):
            both = forward[i] * back
            out[i] = both[1] / both.sum()
            back = step @ (emit[i] * back) if i else back
            if i:
                back = (right * np.array([1.0, ratio ** (at[i] - at[i - 1] - 1)])) @ left @ back
                back /= back.sum()
        return out

    @property
    def gaps_kept(self):
        if not hasattr(self, "_gaps"):
            self._gaps = self.gaps()
        return self._gaps

    def score(self, p: np.ndarray) -> float:
        x = np.array([1.0, p.max(), math.log1p(p.sum())]) if len(p) else np.array([1.0, 0.0, 0.0])
        return 1 / (1 + math.exp(-float(np.clip(self.curve @ x, -30, 30))))

    def tag(self, text: str, cues: dict[str, float]) -> tuple[float, list[tuple[int, int]]]:
        """Score, and the character offsets of the words whose marginal is at least a half."""
        words = split(text)
        got = list(map(cues.__getitem__, words))
        if not any(got):
            return self.score(np.zeros(0)), []
        at = [i for i, c in enumerate(got) if c]
        p = self.marginals(at, [got[i] for i in at], len(words))
        spans = []
        if (p >= 0.5).any():
            where = {i for i, x in zip(at, p, strict=True) if x >= 0.5}
            spans = [m.span() for i, m in enumerate(WORD.finditer(text)) if i in where]
        return self.score(p), spans


def split(text: str) -> list[str]:
    """The words, in lower case, one for each WORD of the text."""
    low = text.lower()
    return WORD.findall(low) if len(low) == len(text) else [w.lower() for w in WORD.findall(text)]


def cues_of(docs: list[tuple[str, int]]) -> dict[str, float]:
    held = [Counter(), Counter()]
    total = [0, 0]
    for text, toxic in docs:
        total[toxic] += 1
        held[toxic].update({f for w in set(split(text)) for f in features(w)})
    odds = {f: math.log((n + 0.5) / (total[1] + 1)) - math.log((held[0][f] + 0.5) / (total[0] + 1)) for f, n in held[1].items() if n >= SUPPORT}
    return {f: o for f, o in odds.items() if o >= ODDS}


def fit(docs: list[tuple[str, int]], rounds: int = 35) -> Tagger:
    """docs: (text, toxic) of the sample. Repeated rows count once."""
    docs = list(dict.fromkeys(docs))
    tagger = Tagger(dict.fromkeys(cues_of(docs), 0.0))
    names = {f: i for i, f in enumerate(tagger.weights)}
    found = Memo(lambda w: tuple(names[f] for f in features(w) if f in names))
    times: Counter = Counter()  # (cues of each word, toxic) -> sentences
    for text, toxic in docs:
        ids = [found[w] for w in split(text)]
        for at in range(0, len(ids), SENTENCE):
            part = tuple(ids[at : at + SENTENCE])
            times[part, bool(toxic) and any(part)] += 1
    if names and times:
        rows = sorted(times)
        crf(tagger, [r for r, _ in rows], [[int(bool(toxic and x)) for x in r] for r, toxic in rows], np.array([times[r] for r in rows], float), rounds)
    if not docs:
        return tagger
    x, y = [], []
    cue = Memo(tagger.cue)
    for text, toxic in docs:
        seq = split(text)
        got = [cue[w] for w in seq]
        at = [i for i, c in enumerate(got) if c]
        p = tagger.marginals(at, [got[i] for i in at], len(seq)) if at else np.zeros(0)
        x.append([1.0, p.max() if len(p) else 0.0, math.log1p(p.sum())])
        y.append(toxic)
    x, y, w = np.array(x), np.array(y, float), np.zeros(3)
    for _ in range(30):  # Newton steps with a small ridge
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (q * (1 - q))[:, None]).T @ x + np.eye(3) * 0.05
        w += np.linalg.solve(h, x.T @ (y - q) - 0.05 * w)
    tagger.curve = w
    return tagger


#: Sentences of a step of the gradient, so that its dense arrays have a bounded size.
BLOCK = 8192


class Block:
    """Sentences as arrays: cues by position, tags, and what the tags show."""

    def __init__(self, rows: list[tuple], tags: list[list[int]], times: np.ndarray):
        self.s, self.t, self.times = len(rows), max(map(len, rows)), times
        self.mask = np.arange(self.t)[None, :] < np.array([len(r) for r in rows])[:, None]
        self.y = np.zeros((self.s, self.t), np.int64)
        pos, ids = [], []
        for i, (r, g) in enumerate(zip(rows, tags, strict=True)):
            self.y[i, : len(g)] = g
            for j, f in enumerate(r):
                pos += [i * self.t + j] * len(f)
                ids += f
        self.pos, self.ids = np.array(pos, np.int64), np.array(ids, np.int64)
        y, live = self.y, self.mask[:, 1:]
        self.pairs = np.array([[(((y[:, :-1] == a) & (y[:, 1:] == b) & live) * times[:, None]).sum() for b in (0, 1)] for a in (0, 1)])
        self.start = np.array([((y[:, 0] == a) * times).sum() for a in (0, 1)])

    def gradient(self, w: np.ndarray, bias: float, trans: np.ndarray, start: np.ndarray) -> list:
        """Of the log likelihood, each sentence as often as it was seen."""
        s, t, mask, times = self.s, self.t, self.mask, self.times
        emit = np.zeros((s, t, 2))
        emit[:, :, 1] = bias + np.bincount(self.pos, w[self.ids], s * t).reshape(s, t)
        alpha, beta = np.zeros((s, t, 2)), np.zeros((s, t, 2))
        a = start + emit[:, 0]
        alpha[:, 0] = a
        for j in range(1, t):
            a = np.where(mask[:, j, None], np.logaddexp(a[:, :1] + trans[0], a[:, 1:] + trans[1]) + emit[:, j], a)
            alpha[:, j] = a
        z = np.logaddexp(a[:, 0], a[:, 1])
        b = np.zeros((s, 2))
        pairs = np.zeros((2, 2))
        for j in range(t - 1, 0, -1):
            beta[:, j] = b
            x = emit[:, j] + b
            live = mask[:, j]
            edge = np.exp(np.clip(alpha[:, j - 1, :, None] + trans + x[:, None, :] - z[:, None, None], -60, 0))
            pairs += (edge[live] * times[live][:, None, None]).sum(0)
            b = np.where(live[:, None], np.logaddexp(trans[:, 0] + x[:, :1], trans[:, 1] + x[:, 1:]), b)
        beta[:, 0] = b
        p = np.exp(np.clip(alpha[:, :, 1] + beta[:, :, 1] - z[:, None], -60, 0)) * mask
        diff = np.where(mask, self.y - p, 0.0) * times[:, None]
        begin = np.stack([((1 - p[:, 0]) * times).sum(), (p[:, 0] * times).sum()])
        return [np.bincount(self.ids, diff.ravel()[self.pos], len(w)), diff.sum(), self.pairs - pairs, self.start - begin]


def crf(tagger: Tagger, rows: list[tuple], tags: list[list[int]], times: np.ndarray, rounds: int) -> None:
    """Maximum conditional likelihood of the tags, by full gradients with adaptive steps; sentence i was seen times[i] times."""
    blocks = [Block(rows[at : at + BLOCK], tags[at : at + BLOCK], times[at : at + BLOCK]) for at in range(0, len(rows), BLOCK)]
    params = [np.zeros(len(tagger.weights)), -3.0, np.zeros((2, 2)), np.zeros(2)]
    ridge = (0.02, 0.0, 0.1, 0.0)
    sums = [np.full_like(params[0], 1e-3), 1e-3, np.full((2, 2), 1e-3), np.full(2, 1e-3)]
    for _ in range(rounds):
        parts = [block.gradient(*params) for block in blocks]
        for k in range(4):
            g = sum(p[k] for p in parts) - ridge[k] * params[k]
            sums[k] = sums[k] + g * g
            params[k] = params[k] + 0.5 * g / np.sqrt(sums[k])
    w, bias, trans, start = params
    tagger.weights = {f: x for f, x in zip(tagger.weights, w.tolist(), strict=True) if abs(x) > 0.05}
    tagger.bias, tagger.trans, tagger.start = float(bias), trans, start


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> list[tuple[str, int]]:
    """At most `size` documents of each class outside the held-out fold, one text an id."""
    named = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out()).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    order = F.xxhash64("doc_id")
    ids = named.where("toxic = 1").orderBy(order, "doc_id").limit(size).union(named.where("toxic = 0").orderBy(order, "doc_id").limit(size))
    ids = materialise(ids, "toxic-sample")
    got = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")  # 2 * size ids at most
    got = got.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).collect()  # as many rows
    return [(r["text"], r["toxic"]) for r in sorted(got, key=lambda r: r["doc_id"])]


def train(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Tagger:
    return fit(sample(docs, labels, size))


def tag(docs: DataFrame, tagger: Tagger, columns: list[str] | None = None, score: str = "toxic_score", spans: str = "toxic_spans") -> DataFrame:
    """columns of docs (doc_id by default), the score and the toxic spans (start, end in characters)."""
    small_text_batches(docs.sparkSession)
    keep = columns or ["doc_id"]
    model = docs.sparkSession.sparkContext.broadcast(tagger)
    fields = [f for f in docs.select(*keep).schema.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", `{score}` double, `{spans}` array<struct<start:int,end:int>>"
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    read_cols = [*keep, *(["text"] if "text" not in keep else [])]

    def make():
        cues = Memo(model.value.cue)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [model.value.tag(t, cues) for t in texts(batch)]
            places = pa.array([[{"start": a, "end": b} for a, b in x[1]] for x in found], kind)
            return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array([x[0] for x in found], pa.float64()), places], names=[*keep, score, spans])

        return step

    return map_rows(docs.select(*read_cols), schema, make)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = tag(docs, train(docs, read(spark, sf_dir, "labels")))
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"), F.size("toxic_spans").alias("n_spans"))

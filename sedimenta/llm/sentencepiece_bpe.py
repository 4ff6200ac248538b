"""SentencePiece BPE, encoded and decoded by vectorised merge rounds.

A text is cut where no piece of the model can reach across: before a run of word marks that follows another
character, and around line feeds. Distinct segments are encoded together by the merge rounds of bpe.py. Any two pieces
whose concatenation is a piece are a pair, ranked by its score. Decoding gathers the pieces' bytes by id.

Defined results: null is empty; an empty text has no ids.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sedimenta.llm.bpe import Merges
from sedimenta.llm.common import map_rows, read, small_text_batches, texts

MARK = "▁"


def wire(data: bytes):
    """(field, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at : at + size]
            at += size


class PieceModel:
    def __init__(self, path: str):
        with open(path, "rb") as file:
            data = file.read()
        pieces, scores, kinds, spec = [], [], [], {}
        for field, value in wire(data):
            if field == 1:
                got = dict(wire(value))
                pieces.append(got[1].decode())
                scores.append(float(np.frombuffer(got.get(2, b"\0\0\0\0"), "<f4")[0]))
                kinds.append(got.get(3, 1))
            elif field == 3:
                spec = dict(wire(value))
        if spec.get(2) or spec.get(4, 1) or not spec.get(3, 1) or not spec.get(5, 1):
            raise ValueError("only models without normalisation, with a dummy prefix and escaped white space are read")
        normal = {p: i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k == 1}
        self.ids = normal
        self.byte_ids = np.zeros(256, np.int64)
        out = []
        for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)):
            if k == 6:
                self.byte_ids[int(p[1:-1], 16)] = i
            out.append(bytes([int(p[1:-1], 16)]) if k == 6 else p.replace(MARK, " ").encode() if k == 1 else b"")
        self.size = len(pieces)
        self.piece_bytes = np.frombuffer(b"".join(out), np.uint8)
        self.piece_at = np.concatenate([[0], np.cumsum([len(x) for x in out])])
        if any(MARK in p.lstrip(MARK) or (len(p) > 1 and "\n" in p) for p in normal):
            raise ValueError("a piece reaches across a segment border")
        self.segment = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in normal.values()}, reverse=True))}
        pairs = [(normal[p[:c]], normal[p[c:]], order[scores[i]], i) for p, i in normal.items() for c in range(1, len(p)) if p[:c] in normal and p[c:] in normal]
        self.merges = Merges(self.size, pairs)
        self.char_ids = -1 - np.arange(0x110000)  # characters without a piece: below zero
        for p, i in normal.items():
            if len(p) == 1:
                self.char_ids[ord(p)] = i

    def segments(self, text: str) -> list[str]:
        return self.segment.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode_segments(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, offsets of the segments in them)."""
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sym, seg = self.merges.run(self.char_ids[code], np.repeat(np.arange(len(words)), [len(w) for w in words]))
        odd = np.flatnonzero(sym < 0)
        if len(odd):  # characters without a piece: their UTF-8 bytes
            raw = [chr(-1 - int(c)).encode() for c in sym[odd]]
            times = np.ones(len(sym), np.int64)
            times[odd] = [len(x) for x in raw]
            out = np.repeat(sym, times)
            out[out < 0] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
            sym, seg = out, np.repeat(seg, times)
        return sym, np.r_[0, np.cumsum(np.bincount(seg, minlength=len(words)))]

    def decode_bytes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces' bytes one after another, and the length of each."""
        size = self.piece_at[ids + 1] - self.piece_at[ids]
        ends = np.cumsum(size)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.piece_at[ids] - (ends - size), size)
        return self.piece_bytes[place], size

    def encode(self, text: str) -> np.ndarray:
        words = self.segments(text)
        return self.encode_segments(words)[0] if words else np.zeros(0, np.int64)

    def decode(self, ids: np.ndarray) -> str:
        data = self.decode_bytes(np.asarray(ids, np.int64))[0].tobytes()
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    return PieceModel(path)


@lru_cache(maxsize=1)
def coder(path: str) -> Coder:
    """One a worker process: what it knows serves later tasks."""
    return Coder(path)


class Coder:
    """Encodes batches of texts; segments that occur again within a task are not merged again."""

    def __init__(self, path: str, most: int = 300_000):
        self.model, self.most = model(path), most
        self.known: dict[str, tuple[str, bytes]] = {}

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > self.most:
            self.known = {w: self.known[w] for w in words if w in self.known}
        for at in range(0, len(new), 100_000):
            part = new[at : at + 100_000]
            ids, begin = self.model.encode_segments(part)
            data, size = self.model.decode_bytes(ids)
            stop = np.r_[0, np.cumsum(size)][begin].tolist()
            data, begin, shown = data.tobytes(), begin.tolist(), list(map(str, ids.tolist()))
            for i, w in enumerate(part):
                self.known[w] = (",".join(shown[begin[i] : begin[i + 1]]), data[stop[i] : stop[i + 1]])

    def rows(self, batch: list[str]) -> list[tuple[int, bytes, bytes]]:
        """For each text: number of ids, the ids in decimal, and the decoded bytes."""
        out, cut, n = [], [], 0
        for t in batch:
            cut.append(self.model.segments(t))
            n += len(cut[-1])
            if n > 300_000:
                out += self.some(cut)
                cut, n = [], 0
        return out + self.some(cut)

    def some(self, cut: list[list[str]]) -> list[tuple[int, bytes, bytes]]:
        self.learn(set().union(*cut))
        out = []
        for words in cut:
            got = list(map(self.known.__getitem__, words))
            ids = ",".join([x[0] for x in got])
            data = b"".join([x[1] for x in got])
            out.append((ids.count(",") + 1 if got else 0, ids.encode(), data[1:] if data[:1] == b" " else data))
        return out


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    small_text_batches(docs.sparkSession)

    def make():
        code = coder(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = code.rows(texts(batch))
            sha = [[hashlib.sha256(r[k]).hexdigest() for r in rows] for k in (1, 2)]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()), *map(pa.array, sha)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        return step

    return map_rows(docs.select("doc_id", "text"), SCHEMA, make)


def op3_sentencepiece(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return encode_decode(read(spark, sf_dir, "documents"), path)

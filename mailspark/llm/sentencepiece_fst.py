"""SentencePiece encoding and decoding with weighted finite-state transducers (operator 7).

A model file is compiled into three machines: the normaliser N (blanks to the piece mark, a mark in front), the piece
transducer P (a trie from characters to pieces, with a byte arc chain for every character outside it), and the pair
machine M, whose states are pieces. For a unigram model an arc weighs minus the piece's log probability and M is free:
the tropical shortest path through input o P is the encoding. For a byte-pair model the weights of P are zero and an
arc of M from piece a to piece b weighs zero where the merges leave the pair "ab" apart and infinity where they don't; the
one path of finite weight through input o P o M is what merging yields, as a sequence is the result of merging exactly
when each of its pieces and each adjacent pair is. Arcs of M are found when first met, by following the merges that made
the two pieces, and remembered.

The path search explores the composed lattice lazily. In a model none of whose pieces has the
mark after another character, paths never cross a word's start, so words are composed one by one and remembered in a
bounded cache. Texts are encoded in tasks, whole; nothing is shuffled.

Null text: null. Empty text: no ids. Characters outside the model become their UTF-8 bytes' pieces. Decoding maps byte
runs back to text, drops the mark in front and control pieces. Repeated rows are encoded each; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import Cache

MARK = "▁"
INF = float("inf")
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def wire(data: bytes) -> Iterator[tuple[int, object]]:
    """Fields of one protobuf message: (number, int or bytes)."""
    i = 0

    def varint() -> int:
        nonlocal i
        out = shift = 0
        while True:
            b = data[i]
            i += 1
            out |= (b & 127) << shift
            if b < 128:
                return out
            shift += 7

    while i < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, data[i : i + size]
            i += size


def as_bytes(ids) -> bytes:
    return struct.pack(f"{len(ids)}i", *ids)


@dataclass
class Machines:
    """The compiled model. ``kind``: 1 unigram, 2 byte-pair."""

    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    kind: int = 1
    byte_fallback: bool = False
    dummy_prefix: bool = True
    trim: bool = True
    escape: bool = True
    unk: int = 0


def read_model(path: str) -> Machines:
    m = Machines()
    with open(path, "rb") as f:
        data = f.read()
    charsmap = b""
    for number, value in wire(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in wire(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = float(np.frombuffer(v, "<f4")[0])
                elif n == 3:
                    kind = v
            m.pieces.append(piece)
            m.scores.append(score)
            m.types.append(kind)
        elif number == 2:
            spec = dict(wire(value))
            m.kind, m.byte_fallback, m.unk = spec.get(3, 1), bool(spec.get(35, 0)), spec.get(40, 0)
        elif number == 3:
            spec = dict(wire(value))
            charsmap = spec.get(2, b"")
            m.dummy_prefix, m.trim, m.escape = bool(spec.get(3, 1)), bool(spec.get(4, 1)), bool(spec.get(5, 1))
    if charsmap:
        raise ValueError("models with a character map are not supported")
    if m.kind not in (1, 2):
        raise ValueError("only unigram and byte-pair models are supported")
    return m


class Transducer:
    """N, P and M of one model, and the shortest path of an input through them."""

    def __init__(self, machines: Machines, words: int = 1_000_000):
        m = self.m = machines
        self.trie: dict = {}
        self.id_of: dict[str, int] = {}
        self.byte_id = {int(p[3:-1], 16): i for i, (p, t) in enumerate(zip(m.pieces, m.types)) if t == BYTE}
        for i, (p, t) in enumerate(zip(m.pieces, m.types)):
            if t in (NORMAL, USER):
                self.id_of[p] = i
                at = self.trie
                for c in p:
                    at = at.setdefault(c, {})
                at[""] = i
        self.longest = max(map(len, self.id_of), default=1)
        self.reach: dict[str, int] = {}  # the first two characters of pieces: their greatest length
        for p in self.id_of:
            self.reach[p[:2]] = max(len(p), self.reach.get(p[:2], 1))
        inner = any(p[k] == MARK and p[k - 1] != MARK for p in self.id_of for k in range(1, len(p)))
        self.by_word = not inner
        self.made: dict[int, tuple[int, int] | None] = {}  # how merging made a piece
        self.apart = Cache(self._apart, 400_000)
        self.single: dict[int, bool] = {}
        self.kinds = np.array(m.types, np.int8)
        self.encoded = Cache(lambda w: as_bytes(self.shortest(MARK + w)), words)

    # N
    def normalise(self, text: str) -> str:
        if self.m.trim:
            text = " ".join(x for x in text.split(" ") if x)
        if not text:
            return ""
        if self.m.dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK) if self.m.escape else text

    # M
    def merged(self, piece: str) -> tuple[int, ...]:
        """Plain merging of a short string, to see how a piece or a pair of pieces is made: the best-scored adjacent pair,
        leftmost among equals, until none is left. Ids, -1 for a character outside the model."""
        parts = list(piece)
        while len(parts) > 1:
            best, where = -INF, -1
            for k in range(len(parts) - 1):
                i = self.id_of.get(parts[k] + parts[k + 1])
                if i is not None and self.m.scores[i] > best:
                    best, where = self.m.scores[i], k
            if where < 0:
                break
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        return tuple(self.id_of.get(p, -1) for p in parts)

    def stands(self, i: int) -> bool:
        """Whether merging a piece's own characters yields the piece."""
        got = self.single.get(i)
        if got is None:
            got = self.single[i] = self.merged(self.m.pieces[i]) == (i,)
        return got

    def _apart(self, pair: tuple[int, int]) -> bool:
        a, b = pair
        return self.merged(self.m.pieces[a] + self.m.pieces[b]) == (a, b)

    # shortest path
    def shortest(self, text: str) -> tuple[int, ...]:
        whole = self.id_of.get(text)
        if self.m.kind == 2:
            if whole is not None and self.stands(whole):
                return (whole,)
            return self._by_pairs(text)
        return self._by_weight(text)

    def arcs(self, text: str, at: int) -> list[tuple[int, int]]:
        """(end, piece) of every piece that starts at ``at``, shortest first; -1 for a character outside the model."""
        out, node, end = [], self.trie, at
        for c in text[at : at + self.longest]:
            node = node.get(c)
            if node is None:
                break
            end += 1
            if "" in node:
                out.append((end, node[""]))
        if not out or out[0][0] > at + 1:
            out.insert(0, (at + 1, -1))
        return out

    def fallback(self, c: str) -> tuple[int, ...]:
        return tuple(self.byte_id[x] for x in c.encode()) if self.m.byte_fallback else (self.m.unk,)

    def _by_weight(self, text: str) -> tuple[int, ...]:
        n = len(text)
        cost, back = [INF] * (n + 1), [(0, -1)] * (n + 1)
        cost[0] = 0.0
        low = min(self.m.scores) - 10
        for at in range(n):
            for end, i in self.arcs(text, at):
                c = cost[at] - (low if i < 0 else self.m.scores[i])
                if c < cost[end]:
                    cost[end], back[end] = c, (at, i)
        return self._path(text, back)

    def _by_pairs(self, text: str) -> tuple[int, ...]:
        """Explores states (position, last piece) depth first, longest arcs first; any path of finite weight is shortest. The
        start of an encoding is the encoding of that start, so a position from which the search failed is never tried
        again and the work stays linear in the lattice."""
        n, at, last = len(text), 0, -1
        path: list[tuple[int, int]] = []  # (start, piece)
        dead: set[int] = set()
        apart, stands, piece_of, reach = self.apart, self.single, self.id_of.get, self.reach.get
        end = min(n, reach(text[0:2], 1))
        ends = []  # for each piece of the path, the next shorter end to try
        while at < n:
            while end > at:
                i = piece_of(text[at:end], -1)
                if (i >= 0 or end == at + 1) and end not in dead:
                    if i < 0 or ((end == at + 1 or (stands[i] if i in stands else self.stands(i))) and (last < 0 or apart[last, i])):
                        break
                end -= 1
            else:
                dead.add(at)
                at, _ = path.pop()
                end = ends.pop()
                last = path[-1][1] if path else -1
                continue
            path.append((at, i))
            ends.append(end - 1)
            at, last = end, i
            end = min(n, at + reach(text[at : at + 2], 1))
        ends = [p[0] for p in path[1:]] + [n]
        return tuple(x for (start, i), end in zip(path, ends) for x in ((i,) if i >= 0 else self.fallback(text[start:end])))

    def _path(self, text: str, back) -> tuple[int, ...]:
        out, at = [], len(text)
        while at:
            start, i = back[at]
            out.append((i,) if i >= 0 else self.fallback(text[start:at]))
            at = start
        return tuple(x for ids in reversed(out) for x in ids)

    def encode(self, text: str) -> np.ndarray:
        s = self.normalise(text)
        if not s:
            return np.empty(0, np.int32)
        if not self.by_word:
            return np.array(self.shortest(s), np.int32)
        # a word starts at a mark that follows another character; runs of marks stay with the word they precede
        words, known = s.split(MARK), self.encoded
        first = as_bytes(self.shortest(words[0])) if words[0] else b""
        if "" not in words[1:]:
            out = [known[w] for w in words[1:]]
        else:
            out, head = [], ""
            for w in words[1:]:
                if not w:
                    head += MARK
                else:
                    out.append(as_bytes(self.shortest(head + MARK + w)) if head else known[w])
                    head = ""
            if head:
                out.append(as_bytes(self.shortest(head)))
        return np.frombuffer(first + b"".join(out), np.int32)

    # the inverse machine
    def decode(self, ids: np.ndarray) -> str:
        kinds = self.kinds[ids]
        if (kinds == NORMAL).all():
            text = "".join(map(self.m.pieces.__getitem__, ids.tolist()))
        else:
            text = self._decode_mixed(ids.tolist())
        text = text.replace(MARK, " ") if self.m.escape else text
        return text[1:] if self.m.dummy_prefix and text.startswith(" ") else text

    def _decode_mixed(self, ids: list[int]) -> str:
        out, pending = [], bytearray()
        for i in ids:
            kind = self.m.types[i]
            if kind == BYTE:
                pending.append(int(self.m.pieces[i][3:-1], 16))
                continue
            if pending:
                out.append(pending.decode("utf-8", "replace"))
                pending = bytearray()
            if kind == UNKNOWN:
                out.append(" ⁇ ")
            elif kind != CONTROL:
                out.append(self.m.pieces[i])
        return "".join(out) + pending.decode("utf-8", "replace")


_LOADED: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One per process and model file."""
    if path not in _LOADED:
        _LOADED[path] = Transducer(read_model(path))
    return _LOADED[path]


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)``: the model at ``path`` must be readable in every task, as an installed package's files are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(path)
        for b in batches:
            ids = pa.array((None if x is None else t.encode(x) for x in b.column(1).to_pylist()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], ["doc_id", "ids"])

    plain = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return plain.mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, ids)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(path)
        for b in batches:
            text = pa.array((None if x is None else t.decode(np.array(x, np.int64)) for x in b.column(1).to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), text], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def coding_report(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_ids, n_byte_ids, ids_crc32, decoded_crc32, round_trip)``: encodes every whole text, decodes the ids again and
    compares with the normalised text. Ids are digested in the task that makes them (little-endian unsigned 32-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(path)
        is_byte = t.kinds == BYTE
        for b in batches:
            rows = []
            for x in b.column(1).to_pylist():
                if x is None:
                    rows.append((0, 0, 0, 0, True))
                    continue
                ids = t.encode(x)
                back = t.decode(ids)
                wanted = t.normalise(x).replace(MARK, " ")
                wanted = wanted[1:] if t.m.dummy_prefix and wanted.startswith(" ") else wanted
                rows.append((len(ids), int(is_byte[ids].sum()), zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(back.encode()), back == wanted))
            cols = list(zip(*rows)) if rows else [()] * 5
            arrays = [pa.array(c, k) for c, k in zip(cols, [pa.int64()] * 4 + [pa.bool_()])]
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays], ["doc_id", "n_ids", "n_byte_ids", "ids_crc32", "decoded_crc32", "round_trip"])

    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return plain.mapInArrow(run, "doc_id long, n_ids long, n_byte_ids long, ids_crc32 long, decoded_crc32 long, round_trip boolean")

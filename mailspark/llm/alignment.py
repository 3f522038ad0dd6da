"""Alignment of two tokenizers' tokens by byte offsets (operator 11).

A is a byte-level BPE vocabulary and encodes space+text, B is a SentencePiece model and encodes the text (and adds the
space itself). Both token sequences spell the same bytes, so each becomes an array of byte offsets at which its tokens end.
``skip_runs`` walks both arrays by diagonal run skipping: at the current shift between the two indices it compares
stretches of doubling, then halving length and jumps over one-to-one tokens; where the arrays differ it advances the smaller
end until both ends meet, which closes one irregular group and sets the new shift.

Words between single blanks are encoded once and remembered while a task's cache has room: neither vocabulary has a token
that goes on past a blank, and A's splitting pattern begins a new part at each blank that a visible character follows.
Texts with other blanks, and texts with words that either model doesn't spell back, are encoded whole. A link joins the last A and the last B token of a
group. How often each id pair is linked is counted over all documents; the ``most_known`` most frequent pairs (a documented
bound) go to all tasks, the others meet their documents in a shuffle join, so that no document moves for a frequent pair.

Null text, empty text, or text that a tokenizer doesn't spell back byte for byte: no tokens, zeros, empty digest. Repeated
rows are aligned each and count each. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import Stages, byte_slices, tidy

MARK = "▁"
#: A blank that no visible character follows, or a text that begins with white space.
OTHER_BLANKS = re.compile(r" (?:\s|\Z)|\A\s")


@dataclass(frozen=True)
class AlignConfig:
    """``a``, ``b``: model files that every task can read. ``pattern``: A's splitting pattern. ``words``: a task's
    cache of words is emptied before a slice of texts when it holds more."""

    a: str
    b: str
    pattern: str
    words: int = 400_000
    most_known: int = 1 << 17


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible Latin-1 characters stand for themselves,
    the other bytes in their order for the characters from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [x for x in range(256) if x not in set(plain)]
    return {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, their tokens' bytes and the word cache."""

    def __init__(self, cfg: AlignConfig):
        with open(cfg.a, encoding="utf-8") as f:
            model = json.load(f)
        special = {x["content"] for x in model["added_tokens"]}
        chars = byte_of_char()
        vocab = {i: bytes(chars[c] for c in t) for t, i in model["model"]["vocab"].items() if t not in special}
        joined = [x if isinstance(x, str) else " ".join(x) for x in model["model"]["merges"]]
        ids = [model["model"]["vocab"][x.replace(" ", "")] for x in joined]
        if ids != sorted(ids):
            raise ValueError("A's ids must be in the order of its merges")
        self.a = tiktoken.Encoding("a", pat_str=cfg.pattern, mergeable_ranks={v: k for k, v in vocab.items()}, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=cfg.b)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.a_bytes = [vocab.get(i, b"") for i in range(max(vocab) + 1)]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(names)]
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        self.by_word = not any(MARK in p.lstrip(MARK) for p in names)
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.words = cfg.words

    def checked(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of a whole text by both, None where one doesn't spell it back."""
        spelled = b" " + text.encode()
        a, b = self.a.encode_ordinary(" " + text), self.b.encode(text, num_threads=1)
        if b"".join(map(self.a_bytes.__getitem__, a)) != spelled or b"".join(map(self.b_bytes.__getitem__, b)) != spelled:
            return None
        return a, b

    def learn(self, words: list[str]) -> None:
        """Remembers both encodings of a blank and each word, as bytes; empty where one doesn't spell it back. The words are
        encoded as one text, blanks between, and told apart by where their bytes end."""
        got = self.checked(" ".join(words))
        if got is None:
            if len(words) > 1:
                half = len(words) // 2
                self.learn(words[:half])
                self.learn(words[half:])
            else:
                self.known[words[0]] = b"", b""
            return
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        cut = []
        for ids, size in zip(got, (self.a_len, self.b_len)):
            ids = np.array(ids, np.int32)
            reached = np.cumsum(size[ids])
            at = np.searchsorted(reached, ends) + 1
            if (reached[at - 1] != ends).any():
                raise AssertionError("a token goes on past a blank")
            raw, at = ids.tobytes(), (at * 4).tolist()
            cut.append([raw[i:j] for i, j in zip([0, *at], at)])
        self.known.update(zip(words, zip(*cut)))

    def encode(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Both id arrays of each text."""
        plain = [x.split(" ") if x and self.by_word and not OTHER_BLANKS.search(x) else None for x in texts]
        known = self.known
        if len(known) > self.words:
            known.clear()
        if new := list({w for ws in plain if ws for w in ws if w not in known}):
            self.learn(new)
        none = np.empty(0, np.int32)
        for text, words in zip(texts, plain):
            if not text:
                yield none, none
                continue
            if words:
                a, b = zip(*map(known.__getitem__, words))
                if all(a):
                    yield np.frombuffer(b"".join(a), np.int32), np.frombuffer(b"".join(b), np.int32)
                    continue
            got = self.checked(text)
            yield (none, none) if got is None else (np.array(got[0], np.int32), np.array(got[1], np.int32))


def skip_runs(a: list[int], b: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Stretches ``(i, j, n, p, q)`` for two increasing lists of ends whose last end is the same: from tokens i and j on, n
    tokens end one to one; then the tokens before p and q are one irregular group (none where p is i + n)."""
    out = []
    i = j = 0
    n = len(a)
    while i < n:
        # at this shift: exponential probes, then halved ones up to the first difference
        start, at, step, growing = i, j, 4, True
        while step:
            x = a[i : i + step]
            if x and x == b[j : j + step]:
                i += len(x)
                j += len(x)
                step = step * 2 if growing else step // 2
            else:
                growing = False
                step //= 2
        same = i - start
        if i < n:
            # up to the next common end
            x, y = a[i], b[j]
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            i += 1
            j += 1
        out.append((start, at, same, i, j))
    return out


def last_tokens(runs: list[tuple[int, int, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the last A and B tokens of each group."""
    x, y = [], []
    for i, j, n, p, q in runs:
        x += range(i, i + n)
        y += range(j, j + n)
        if p > i + n:
            x.append(p - 1)
            y.append(q - 1)
    return np.array(x, np.int32), np.array(y, np.int32)


def aligned(t: Tokenizers, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, int, int, int, int]]]]:
    """For each text A's ids, B's ids, and the stretches of their alignment."""
    for a, b in t.encode(texts):
        yield a, b, skip_runs(np.cumsum(t.a_len[a]).tolist(), np.cumsum(t.b_len[b]).tolist())


_LOADED: dict[AlignConfig, Tokenizers] = {}


def tokenizers(cfg: AlignConfig) -> Tokenizers:
    """One per process and setting; tasks empty its cache when they end."""
    if cfg not in _LOADED:
        _LOADED[cfg] = Tokenizers(cfg)
    return _LOADED[cfg]


def align(docs: DataFrame, cfg: AlignConfig) -> DataFrame:
    """``(doc_id, a_ids, b_ids, a_last, b_last)`` for every row of ``docs(doc_id, text)``: both tokenizers' ids, and for each
    group the numbers of its last tokens."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(cfg)
        for batch in batches:
            for part in byte_slices(batch, 1, 2_000_000):
                rows = [(a, b, *last_tokens(runs)) for a, b, runs in aligned(t, part.column(1).to_pylist())]
                cols = [pa.array([r[k] for r in rows], pa.list_(pa.int32())) for k in range(4)]
                yield pa.RecordBatch.from_arrays([part.column(0), *cols], ["doc_id", "a_ids", "b_ids", "a_last", "b_last"])
        t.known.clear()

    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return plain.mapInArrow(run, "doc_id long, a_ids array<int>, b_ids array<int>, a_last array<int>, b_last array<int>")


def spelled_groups(a: np.ndarray, b: np.ndarray, runs: list[tuple[int, int, int, int, int]], names: list[str]) -> str:
    """``a1,a2|b1;a3|b2,b3``: ids of the groups."""
    x, y = [names[i] for i in a.tolist()], [names[i] for i in b.tolist()]
    out = []
    for i, j, n, p, q in runs:
        out += map("|".join, zip(x[i : i + n], y[j : j + n]))
        if p > i + n:
            out.append(",".join(x[i + n : p]) + "|" + ",".join(y[j + n : q]))
    return ";".join(out)


def group_digests(docs: DataFrame, cfg: AlignConfig) -> DataFrame:
    """``(row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times)``: the alignment of every row, digested in
    the task that makes it. ``pairs`` are the distinct linked id pairs, A's id in the upper 32 bits, and ``times`` how often
    the document has each; ``row`` tells rows apart."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(cfg)
        names = [str(i) for i in range(max(len(t.a_bytes), len(t.b_bytes)))]
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in byte_slices(batch, 1, 2_000_000):
                n, shas, pairs, times = [], [], [], []
                for a, b, runs in aligned(t, part.column(1).to_pylist()):
                    x, y = last_tokens(runs)
                    n.append((len(a), len(b), len(x)))
                    shas.append(hashlib.sha256(spelled_groups(a, b, runs, names).encode()).hexdigest() if runs else "")
                    got, often = np.unique((a[x].astype(np.int64) << 32) | b[y], return_counts=True)
                    pairs.append(got)
                    times.append(often)
                ends = pa.array(np.cumsum([0, *map(len, pairs)]), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x), pa.int64())) for x in (pairs, times)]
                counts = np.array(n, np.int64)
                ids = pa.array(np.arange(row, row + len(n)))
                row += len(n)
                cols = [pa.array(counts[:, k]) for k in (0, 1, 2, 2)]
                yield pa.RecordBatch.from_arrays([ids, part.column(0), *cols, pa.array(shas, pa.string()), *lists], NAMES)
        t.known.clear()

    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return plain.mapInArrow(
        run, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"
    )


NAMES = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]


def pair_counts(digests: DataFrame) -> DataFrame:
    """``(pair, count, best)``: how many links hold an id pair, and whether no pair of its B id has more."""
    links = digests.select(F.inline(F.arrays_zip("pairs", "times")))
    counts = links.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count"))
    b = F.col("pair").bitwiseAND((1 << 32) - 1).alias("b")
    highest = counts.groupBy(b).agg(F.max("count").alias("highest"))
    both = counts.withColumn("b", b).join(highest, "b")
    return both.select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def link_report(docs: DataFrame, cfg: AlignConfig) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` for every row of ``docs``: ``n_best`` counts
    links whose pair is the most frequent one of its B id, ``count_sum`` adds up the links' pair counts."""
    stages = Stages(docs.sparkSession, "alignment")
    rows = stages.keep(group_digests(docs, cfg))
    counts = stages.keep(pair_counts(rows))
    top = F.broadcast(counts.orderBy(F.desc("count"), "pair").limit(cfg.most_known))
    links = rows.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    met = links.join(top, "pair", "left")
    sums = [F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")]

    def valued(part: DataFrame) -> DataFrame:
        best = F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best")
        return part.select("row", best, (F.col("times") * F.col("count")).alias("count_sum")).groupBy("row").agg(*sums)

    frequent = valued(met.where(F.col("count").isNotNull()))
    others = valued(met.where(F.col("count").isNull()).select("row", "pair", "times").join(counts, "pair"))
    found = frequent.unionByName(others).groupBy("row").agg(*sums)
    zero = F.lit(0).cast("long")
    return rows.join(found, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"
    )

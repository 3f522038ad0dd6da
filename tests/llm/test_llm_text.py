"""Token alignment, collocations and fingerprints against brute force."""

import gc
import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mailspark.llm import alignment, collocations, fingerprint
from mailspark.llm.queries import ALIGN

SF01 = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, row int, pair string"
EDGES = [
    None, "", " ", "  ", "a", "naïve café 日本語 \U0001f600", "  two  blanks ", "one two ", " one", "tab\tand\nline\r\n\n end", "x" * 5000,
    "<|endoftext|> here", "<s> </s> <unk> <0x41> ▁ mark", "it's 12,345.67 don't STOP", "\x00\x01 y", "nbsp inside 　 z", "word " * 3000 + "end",
]


@pytest.fixture(scope="module")
def texts():
    return pq.read_table(f"{SF01}/documents.parquet", columns=["text"])["text"].to_pylist()


def docs_of(spark, texts, langs=None):
    return spark.createDataFrame([(i, t, (langs or ["en"] * len(texts))[i], 7, "clash") for i, t in enumerate(texts)], DOCS)


# token alignment


class Plain:
    """Both libraries on whole texts, groups by the common ends, links one by one."""

    def __init__(self):
        self.a = Tokenizer.from_file(ALIGN.a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=ALIGN.b)
        # the usual byte alphabet, written out by its definition
        self.byte = {}
        extra = 0
        for x in range(256):
            if 33 <= x <= 126 or 161 <= x <= 172 or 174 <= x <= 255:
                self.byte[chr(x)] = x
            else:
                self.byte[chr(256 + extra)] = x
                extra += 1

    def tokens(self, text):
        if not text:
            return None
        spelled = (" " + text).encode()
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        ab = [bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in a]
        bb = []
        for i in b:
            p = self.b.id_to_piece(i)
            bb.append(bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode())
        if b"".join(ab) != spelled or b"".join(bb) != spelled:
            return None
        return a, np.cumsum([len(x) for x in ab]).tolist(), b, np.cumsum([len(x) for x in bb]).tolist()

    def report(self, texts):
        parts = []
        for t in texts:
            got = self.tokens(t)
            if got is None:
                parts.append(None)
                continue
            a, ea, b, eb = got
            ends = sorted(set(ea) & set(eb))
            at_a, at_b = {e: k for k, e in enumerate(ea)}, {e: k for k, e in enumerate(eb)}
            groups, links, i, j = [], [], 0, 0
            for e in ends:
                p, q = at_a[e], at_b[e]
                groups.append(",".join(map(str, a[i : p + 1])) + "|" + ",".join(map(str, b[j : q + 1])))
                links.append((a[p], b[q]))
                i, j = p + 1, q + 1
            parts.append((len(a), len(b), groups, links))
        counts = Counter(x for p in parts if p for x in p[3])
        best = defaultdict(int)
        for (_, b), c in counts.items():
            best[b] = max(best[b], c)
        out = []
        for k, p in enumerate(parts):
            if p is None:
                out.append((k, 0, 0, 0, 0, 0, 0, ""))
                continue
            n_a, n_b, groups, links = p
            out.append((
                k, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
                hashlib.sha256(";".join(groups).encode()).hexdigest(),
            ))
        return out


def test_runs_close_at_every_common_end():
    rng = random.Random(1)
    for _ in range(500):
        n = rng.randrange(1, 60)
        a = sorted(rng.sample(range(1, 100), min(n, 40)) + [100])
        b = sorted(rng.sample(range(1, 100), rng.randrange(0, 60)) + [100])
        x, y = alignment.last_tokens(alignment.skip_runs(a, b))
        common = sorted(set(a) & set(b))
        assert [a[i] for i in x] == common == [b[j] for j in y]
    same = list(range(1, 1000))
    assert alignment.skip_runs(same, same) == [(0, 0, 999, 999, 999)]
    assert alignment.skip_runs([], []) == []


@pytest.mark.parametrize("most_known", [1 << 17, 50])
def test_alignment_against_brute_force(spark, texts, most_known):
    some = EDGES + texts[:400] + texts[:3]
    cfg = alignment.AlignConfig(ALIGN.a, ALIGN.b, ALIGN.pattern, words=500, most_known=most_known)
    got = sorted(map(tuple, alignment.link_report(docs_of(spark, some), cfg).collect()))
    assert got == Plain().report(some)


def test_alignment_arrays_and_edges(spark):
    rows = alignment.align(docs_of(spark, EDGES), ALIGN).orderBy("doc_id").collect()
    plain = Plain()
    for r, t in zip(rows, EDGES):
        got = plain.tokens(t)
        if got is None:
            assert not r["a_ids"] and not r["b_ids"] and not r["a_last"]
        else:
            assert list(r["a_ids"]) == got[0] and list(r["b_ids"]) == got[2]
            assert [got[1][i] for i in r["a_last"]] == [got[3][j] for j in r["b_last"]] == sorted(set(got[1]) & set(got[3]))
    empty = docs_of(spark, EDGES).limit(0)
    assert alignment.link_report(empty, ALIGN).count() == 0
    nulls = spark.createDataFrame([(None, "a b"), (None, "a b"), (5, None)], "doc_id long, text string")
    got = alignment.link_report(nulls, ALIGN).collect()
    assert len(got) == 3 and len({tuple(r) for r in got if r["doc_id"] is None}) == 1


# collocations


def brute_collocations(rows, cfg):
    counts = defaultdict(Counter)
    words = Counter()
    fold = {chr(x): chr(x + 32) for x in range(65, 91)}
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(fold.get(c, c) for c in text or "")
        words[lang] += 0
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            ws = [w for w in re.split("[ \t]+", piece) if w]
            words[lang] += len(ws)
            for n in range(1, 5):
                for i in range(len(ws) - n + 1):
                    counts[lang][tuple(ws[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= cfg.least}
        kept = []
        for p, a in cands.items():
            score, k = min((cfg.scale * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            inside = any(
                len(q) > len(p) and 100 * c >= cfg.contained * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, c in cands.items()
            )
            if not inside:
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[: cfg.top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, words[lang], -s))
    return sorted(out)


def test_collocations_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(12)] + ["Émile", "ÉMILE", "New", "york", "a b"]
    phrases = ["new york city hall", "red RED wine", "of the", "x y x y x y", "one two"]
    rows = []
    for i in range(300):
        parts = [rng.choice(phrases) if rng.random() < 0.3 else rng.choice(vocabulary) for _ in range(rng.randrange(0, 30))]
        rows.append((rng.choice([" ", "  ", "\t", ". ", ",", "\r\n", "!?"]).join(parts), rng.choice(["en", "fr", None, "und"])))
    rows += [(None, "en"), ("", None), ("...", "zz"), ("word " * 5000, "en")]
    df = spark.createDataFrame([(i, t, x, 1, "c") for i, (t, x) in enumerate(rows)], DOCS).repartition(5)
    for cfg in (
        collocations.Phrases(least=5, top=40),
        collocations.Phrases(least=3, top=7, sketch_bits=10, block_bits=6, slice_bytes=3000),
        collocations.Phrases(least=2, contained=50, sketch_bits=4, block_bits=3),
    ):
        got = sorted(map(tuple, collocations.collocations(df, cfg).collect()))
        assert got == brute_collocations(rows, cfg)
    assert collocations.collocations(df.limit(0)).count() == 0


def test_long_texts_are_read_in_parts():
    rng = random.Random(2)
    text = "".join(rng.choice(["ab ", "c, ", "d\n", "e "]) for _ in range(5000))
    parts = list(collocations.segments(text, 700))
    assert "".join(parts) == text and len(parts) > 5
    assert all(p[-1] in ",\n" for p in parts[:-1])
    whole = collocations.numbered([text], ["en"])
    assert collocations.numbered([text] * 2, ["en", "en"])[0].tolist() == whole[0].tolist() * 2
    assert list(collocations.segments("", 5)) == [] and list(collocations.segments("x" * 50, 7)) == ["x" * 50]


def test_slices_leave_nothing_behind(spark):
    """A slice's words go with it, without a garbage collection, and rows leave in small batches."""
    words = [f"word{i}" for i in range(60_000)]
    gc.collect()
    gc.disable()
    try:
        tracemalloc.start()
        for _ in range(4):
            collocations.numbered([" ".join(words)], ["en"])
        assert tracemalloc.get_traced_memory()[0] < 1_000_000
    finally:
        tracemalloc.stop()
        gc.enable()
    cfg = collocations.Phrases()
    b = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([" ".join(words * 2)])], ["lang", "text"])
    rows = list(collocations.padded_windows(b, np.full(1 << (cfg.sketch_bits - 3), 255, np.uint8), cfg))
    assert sum(r.num_rows for r in rows) == 60_003 and sum(sum(r.column(5).to_pylist()) for r in rows) == 120_000
    assert max(r.num_rows for r in [*rows, *collocations.cell_counts(b, cfg)]) <= collocations.STRIDE
    cells = [len(x) // 2 for r in collocations.cell_counts(b, cfg) for x in r.column(1).to_pylist()]
    assert sum(cells) <= 4 * 60_000 + 3 and len([k for r in collocations.cell_counts(b, cfg) for k in r.column(0).to_pylist()]) == len(cells)


def test_scores_past_64_bits(spark):
    big = 8_000_000_000_000
    rows = [("en", 2, "a b", big), ("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 0, "", 3 * big)]
    counts = spark.createDataFrame(rows, "lang string, size int, phrase string, f long")
    got = collocations.scored(counts, collocations.Phrases()).collect()
    assert [(r["a"], r["score"]) for r in got] == [(big, 2_000_000 * big // (2 * big + 1))]


# fingerprints


def brute_fingerprint(text: bytes) -> str:
    def letters(size):
        window, out, h, p, open_chunk = [0] * 7, [], 0, 1, False
        for c in text:
            window = [c, *window[:6]]
            h, p, open_chunk = (h + c * p) % 2**64, p * fingerprint.BASE % 2**64, True
            shifted = 0
            for k, x in enumerate(window):
                shifted ^= (x << (5 * k)) % 2**32
            roll = (sum(window) + sum((7 - k) * x for k, x in enumerate(window)) + shifted) % 2**32
            if roll % size == size - 1 and len(out) < 63:
                out.append(h)
                h, p, open_chunk = 0, 1, False
        if open_chunk:
            out.append(h)
        return "".join(chr(fingerprint.LETTERS[((v ^ v >> 32) * fingerprint.BASE % 2**64) >> 58]) for v in out)

    k = 0
    while 192 << k < len(text):
        k += 1
    while k and len(letters(3 << k)) < 32:
        k -= 1
    return f"{3 << k}:{letters(3 << k)}:{letters(6 << k)}"


def brute_likeness(a, b):
    def levenshtein(x, y):
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            prev, row[0] = row[0], i
            for j, d in enumerate(y, 1):
                prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (c != d))
        return row[-1]

    def alike(x, y):
        x, y = (re.sub(r"(.)\1{3,}", r"\1\1\1", s) for s in (x, y))
        short, long = sorted((len(x), len(y)))
        run = max(1, min(3, short // 3))
        if not short or not {x[i : i + run] for i in range(len(x) - run + 1)} & {y[i : i + run] for i in range(len(y) - run + 1)}:
            return 0.0
        return 1 - levenshtein(x, y) / long

    if a == b:
        return 1.0
    (s, x1, x2), (t, y1, y2) = a.split(":"), b.split(":")
    s, t = int(s), int(t)
    if s == t:
        return max(alike(x1, y1), alike(x2, y2))
    return alike(x1, y2) if s == 2 * t else alike(x2, y1) if t == 2 * s else 0.0


def test_signatures_against_brute_force(texts):
    rng = random.Random(3)
    some = [(t or "").encode() for t in EDGES] + [t.encode()[:6000] for t in texts[:80]]
    some += [bytes(rng.randrange(256) for _ in range(n)) for n in (1, 6, 7, 8, 191, 192, 193, 3000)]
    wanted = [brute_fingerprint(t) for t in some]
    assert fingerprint.signatures(some) == wanted
    assert [fingerprint.signatures([t])[0] for t in some] == wanted


def test_slices_of_a_long_text(monkeypatch):
    rng = random.Random(4)
    text = bytes(rng.randrange(97, 110) for _ in range(5000))
    wanted = fingerprint.signatures([b"before", text, b"", text[:100]])
    size = 256
    monkeypatch.setattr(fingerprint, "SLICE", size)
    monkeypatch.setattr(fingerprint, "UP_SLICE", pow(fingerprint.BASE, size, 1 << 64))
    monkeypatch.setattr(fingerprint, "DOWN_SLICE", pow(fingerprint.INVERSE, size, 1 << 64))
    assert fingerprint.signatures([b"before", text, b"", text[:100]]) == wanted


def brute_neighbours(rows):
    """Rows in the order of (doc_id descending, given)."""
    out = []
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1] or ""
        t = t or ""
        third = len(t) // 3
        changed = t[: len(t) - third] + following[:third]
        own, new, nxt = (brute_fingerprint(x.encode()) for x in (t, changed, following))
        out.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), own, new, round(brute_likeness(own, new), 9), round(brute_likeness(own, nxt), 9)))
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 7])
def test_neighbours_against_brute_force(spark, texts, parts):
    some = [(i, t if t is None else t[:4000]) for i, t in enumerate(EDGES + texts[:60])]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = fingerprint.edited_neighbours(docs_of(spark, [t for _, t in some])).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    got = sorted((*r[:5], round(r[5], 9), round(r[6], 9)) for r in got)
    assert got == brute_neighbours(some[::-1])


def test_fingerprint_edges(spark, texts):
    one = fingerprint.edited_neighbours(docs_of(spark, ["only text here"])).first()
    assert one["edited_sha256"] == hashlib.sha256(b"only text " + b"only").hexdigest() and one["near_next"] == 1.0
    assert fingerprint.edited_neighbours(docs_of(spark, ["x"]).limit(0)).count() == 0
    rows = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (3, "later"), (3, "other"), (3, None)], "doc_id long, text string")
    got = fingerprint.edited_neighbours(rows).collect()
    assert len(got) == 5 and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    prints = {r["fingerprint"] for r in fingerprint.fingerprints(rows.where("text = 'a b c'")).collect()}
    assert len(prints) == 1


def test_edited_texts_are_nearer_than_neighbours(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = fingerprint.edited_neighbours(docs).where("n_chars >= 200").agg(
        F.avg((F.col("near_edited") > F.col("near_next")).cast("int")), F.avg("near_edited"), F.avg("near_next")
    ).first()
    assert got[0] > 0.95 and got[1] > 0.5 and got[2] < 0.2

"""Sharding, chat formatting, SentencePiece coding, packing: brute force, invariants and round trips."""

import re
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from mailspark.llm import chat, packing, sentencepiece_fst, sharding
from mailspark.llm.common import Stages

SF01 = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, shard string, length int"
TEXTS = [None, "", " ", "a", "naïve café 日本語 \U0001f600", "  two  blanks ", "\n\t x \n", "x" * 5000, "word " * 30_000, "▁▁ a ▁", "<s> </s> <unk> <0x41>", "it's 12,345.67 don't STOP", "\x00\x01 y", " z 　z"]


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "clash", 5) for i, t in enumerate(texts)], DOCS)


# sharding


def brute_shards(rows, cfg):
    """The two passes in plain Python."""

    def hashed(*parts):
        h = xxhash.xxh64_intdigest(":".join("" if p is None else str(p) for p in parts).encode(), seed=42)
        return h - 2**64 if h >= 2**63 else h

    sized = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    records = [(*k, c) for k, n in sized.items() for c in range(1, n + 1)]
    buckets = max(1, -(-sum(r[1] for r in records) // cfg.bucket_bytes))
    cells = max(1, -(-len(records) // (buckets * cfg.cell_rows)))
    held = defaultdict(list)
    for r in records:
        held[hashed(cfg.seed, "bucket", *r) % buckets, hashed(cfg.seed, "cell", *r) % cells].append(r)
    out, place = [], 0
    for (b, c), items in sorted(held.items()):
        items.sort(key=lambda r: (r[0] is not None, r))
        for i in range(len(items) - 1, 0, -1):
            j = hashed(cfg.seed, "draw", b, c, i) % (i + 1)
            items[i], items[j] = items[j], items[i]
        for r in items:
            out.append((r[0], r[1], r[2], "rows", place % cfg.shards, place // cfg.shards, None))
            place += 1
    return sorted(out, key=str)


@pytest.mark.parametrize("cfg", [sharding.Shuffle(), sharding.Shuffle(shards=5, bucket_bytes=50_000, cell_rows=7)])
def test_shards_against_brute_force(spark, cfg):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = sorted(map(tuple, sharding.shard_plan(df, cfg).collect()), key=str)
    assert got == brute_shards(rows, cfg)
    counts = Counter(r[4] for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == cfg.shards
    for s in counts:
        assert sorted(r[5] for r in got if r[4] == s) == list(range(counts[s]))


def test_shard_edges(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "a")] * 500 + [(None, None), (None, "x")]
    df = spark.createDataFrame([(i, t, "e", "s", 1) for i, t in rows], DOCS)
    cfg = sharding.Shuffle(shards=4, bucket_bytes=2000)
    got = sorted(map(tuple, sharding.shard_plan(df, cfg).collect()), key=str)
    assert len(got) == len(rows)
    assert Counter(r[0] for r in got) == Counter(i for i, _ in rows)
    assert {r[1] for r in got if r[0] == 0} == {8}
    assert sharding.shard_plan(df.limit(0)).count() == 0
    assert got == brute_shards(rows, cfg)
    # other partitioning, same order
    assert got == sorted(map(tuple, sharding.shard_plan(df.repartition(7, "text"), cfg).collect()), key=str)


def test_written_shards(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "a")] * 20
    df = spark.createDataFrame([(i, t, "e", "s", 1) for i, t in rows], DOCS)
    cfg = sharding.Shuffle(shards=3)
    sharding.write_shards(df, str(tmp_path / "out"), cfg)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(((r["doc_id"], r["text"], r["lang"]) for r in back.collect()), key=str) == sorted(((i, t, "e") for i, t in rows), key=str)
    assert sorted(r["count"] for r in back.groupBy("shard").count().collect()) == [11, 11, 12]


def test_written_shards_keep_clashing_columns(spark, tmp_path):
    names = ["shard", "_id", "_crc", "_size", "_copy", "_slot", "row"]
    rows = [(i % 9 if i % 4 else None, f"text {i % 3}", *(f"{n}{i}" for n in names)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)).repartition(5)
    sharding.write_shards(df, str(tmp_path / "out"), sharding.Shuffle(shards=4))
    back = spark.read.parquet(str(tmp_path / "out"))
    own = [{"shard": "shard_in", "_slot": "_slot_in"}.get(n, n) for n in names]
    assert sorted(map(tuple, back.select("doc_id", "text", *own).collect()), key=str) == sorted(rows, key=str)
    plan = sorted(map(tuple, sharding.shard_plan(df, sharding.Shuffle(shards=4)).select("doc_id", "shard", "slot").collect()), key=str)
    assert sorted(map(tuple, back.select("doc_id", "shard", "_slot").collect()), key=str) == plan


def test_sharding_uses_no_python(spark):
    plan = sharding.shard_plan(docs_of(spark, TEXTS))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# chat


def brute_chat(rows, fmt):
    out = []
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn, role, text or ""))
    for conv, said in talks.items():
        for p in {r for _, r, _ in said if r is not None and r not in fmt.non_speakers}:
            segs = []
            for turn, role, text in said:
                head = fmt.assistant if role == p else fmt.system if role in fmt.non_speakers else fmt.user % (role or "unknown")
                segs.append(((turn is not None, turn or 0), (role is not None, role or ""), head + text + fmt.end, turn, role, len(head)))
            at = 0
            for _, _, seg, turn, role, skip in sorted(segs, key=lambda s: s[:3]):
                end = at + len(seg)
                out.append((conv, p, turn, role, seg, at, end, at + skip if role == p else None, end if role == p else None))
                at = end
    return sorted(out, key=str)


CONV = "conv_id long, turn long, role string, text string, start string, perspective int"


def test_chat_against_brute_force(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi \U0001f600"), (1, 2, "bob", "yo"), (1, 3, "ann", None), (1, 4, "cyd", ""), (2, 0, "system", "alone"), (None, 0, "x", "n1"), (None, 1, "y", "n2"), (3, None, "a", "t"), (3, 0, None, "t"), (3, 0, "b", "u"), (3, 0, "b", "u")]
    rows += [(9, i, f"p{i % 3}", "m" * (i % 17)) for i in range(3000)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], CONV)
    got = sorted(map(tuple, chat.rotate(df).collect()), key=str)
    assert got == brute_chat(rows, chat.ChatFormat())
    assert chat.rotate(df.limit(0)).count() == 0


def test_chat_sf(spark):
    df = spark.read.parquet(f"{SF01}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, chat.rotate(df).collect()), key=str) == brute_chat(rows, chat.ChatFormat())


def test_chat_uses_no_python(spark):
    plan = chat.rotate(spark.read.parquet(f"{SF01}/conversations.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_running_sum_over_ranges(spark):
    df = spark.range(0, 5000).select(F.lit(1).alias("g"), F.col("id").alias("o"), (F.col("id") % 10).alias("v"))
    got = {r["o"]: r["s"] for r in chat.running_before(df, ["g"], ["o"], "v", "s", Stages(spark, "t")).collect()}
    assert got == dict(enumerate(np.concatenate([[0], np.cumsum(np.arange(5000) % 10)[:-1]]).tolist()))


# SentencePiece

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_pieces_equal_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    df = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").union(docs_of(spark, TEXTS).select(F.col("doc_id") + 10**6, "text"))
    text = {r["doc_id"]: r["text"] for r in df.collect()}
    coded = sentencepiece_fst.encode_documents(df, MODEL).cache()
    for r in coded.collect():
        want = None if text[r["doc_id"]] is None else sp.encode(text[r["doc_id"]])
        assert r["ids"] == want, text[r["doc_id"]][:50]
    for r in sentencepiece_fst.decode_ids(coded, MODEL).collect():
        t = text[r["doc_id"]]
        assert r["text"] == (None if t is None else sp.decode(sp.encode(t)))
    for r in sentencepiece_fst.coding_report(df, MODEL).collect():
        ids = sp.encode(text[r["doc_id"]] or "")
        assert r["n_ids"] == len(ids) and r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert r["round_trip"] or "▁" in text[r["doc_id"]]
    assert sentencepiece_fst.coding_report(df.limit(0), MODEL).count() == 0


def test_unigram_shortest_path():
    m = sentencepiece_fst.Machines(pieces=["<unk>", "▁", "a", "b", "ab", "▁a", "ba", "▁ab"], scores=[0, -2, -3, -3, -2.5, -2.8, -2.6, -9], types=[2] + [1] * 7, kind=1)
    t = sentencepiece_fst.Transducer(m)

    def best(s):
        ways = [(0.0, [])]
        table = {0: (0.0, [])}
        for end in range(1, len(s) + 1):
            ways = [(table[at][0] + m.scores[t.id_of[s[at:end]]], table[at][1] + [t.id_of[s[at:end]]]) for at in range(end) if at in table and s[at:end] in t.id_of]
            if ways:
                table[end] = max(ways, key=lambda w: w[0])
        return table[len(s)][1]

    for text in ("ab", "aba", "abab", "ba ab", "aab bba"):
        assert t.encode(text).tolist() == [i for w in re.findall("▁[^▁]*", t.normalise(text)) for i in best(w)]
    assert t.encode("a?").tolist()[-1] == 0


# packing

PACK = packing.PackConfig(tokenizer=public_tokenizers.path("word_bpe_49k.json"))


def whole_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PACK.tokenizer)
    return [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in texts]


def check_packing(rows, ids, cfg):
    """Every id in one piece, CRCs right, sequences gapless and within the window."""
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(ids)
    for i, got in pieces.items():
        at = 0
        for r in sorted(got, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids[i])
            part = ids[i][at : at + r["length"]]
            assert len(part) == r["length"] and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += r["length"]
        assert at == len(ids[i])
    for spans in seqs.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= cfg.window
    assert sorted(seqs) == list(range(len(seqs)))
    return sum(map(len, ids.values())) / (cfg.window * len(seqs))


def test_word_ids_equal_the_tokenizer():
    known = packing.WordIds(PACK.tokenizer, 500)
    letters = [chr(i) for i in [*range(0x21, 0x3000), *range(0xFB00, 0xFB50), *range(0x1F00, 0x2000)]]
    words = [w for c in letters for w in (c + ",", f"A{c}x'") if w.encode().split() == [w.encode()]]
    words += ["<|ENDOFTEXT|>", "a<|endoftext|>.", "don't", "X'S", "''", "\u0391\u03a3!", "e\u0301,"]
    for at in range(0, len(words), 400):
        some = words[at : at + 400]
        known.learn({w.encode() for w in some})
        for w, e in zip(some, known.tokenizer.encode_batch(some, add_special_tokens=False)):
            assert np.frombuffer(known.ids[w.encode()], "<u4").tolist() == e.ids, w


def test_split_texts_equal_the_tokenizer():
    known = packing.WordIds(PACK.tokenizer, 2000)
    rng = random.Random(3)
    signs = "aAzZÉéßİıΣσ\u0338\u0301'st.,!<>|=9 \n×…日ǅreµª\u00a0\x1c"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(5000)]
    texts += ["don't THEY'LL 'they a≠b <|endoftext|> x<|ENDOFTEXT|>y.", "İstanbul, ΑΣ. ΟΔΟΣ! é,É. …! naïve×÷a ªº.", "Kelvin \u212a, 日本語。テキスト! ﬁ ſt.", "", " "]
    for at in range(0, len(texts), 500):
        some = texts[at : at + 500]
        split = [known.split(t) for t in some]
        known.learn(set().union(*split))
        for t, words, e in zip(some, split, known.tokenizer.encode_batch(some, add_special_tokens=False)):
            assert np.frombuffer(b"".join(known.ids[w] for w in words), "<u4").tolist() == e.ids, t


def test_packing_sf(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    data = df.select("doc_id", "text").collect()
    ids = dict(zip((r["doc_id"] for r in data), whole_ids([r["text"] for r in data])))
    assert check_packing(packing.pack(df, PACK).collect(), ids, PACK) > 0.97


def test_packing_edges(spark):
    texts = TEXTS + ["same text here"] * 50
    df = docs_of(spark, texts)
    rows = packing.pack(df, PACK).collect()
    check_packing(rows, dict(enumerate(whole_ids(texts))), PACK)
    assert packing.pack(df.limit(0), PACK).count() == 0
    again = df.union(df.where("doc_id = 4")).union(df.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    packed = packing.pack(again, PACK)
    assert packed.count() == len(rows) + 2
    windows = packing.sequences(again, packed, PACK, pad_id=0).collect()
    held = Counter(x for r in windows for x in r["ids"] if x)
    want = Counter(x for r in whole_ids([*texts, texts[4], None]) for x in r if x)
    assert held == want
    for r in windows:
        n = len(r["ids"])
        assert n == PACK.window or n & (n - 1) == 0


def test_nnls():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = rng.integers(0, 3, (8, 20)).astype(float), rng.integers(0, 50, 8).astype(float)
        x = packing.nnls(a, b)
        slope = a.T @ (b - a @ x)
        # the optimality conditions
        assert (x >= 0).all() and (slope <= 1e-6 * 1e3).all() and np.abs(slope[x > 1e-9]).max(initial=0) < 1e-5


def test_plan_uses_everything():
    rng = np.random.default_rng(1)
    for full in (16, 256):
        counts = {int(b): int(n) for b, n in zip(range(1, full + 1), rng.integers(0, 300, full))}
        used = Counter()
        for uses, repeats in packing.plan(counts, full, 3):
            assert sum(b * m for b, m in uses.items()) <= full and repeats > 0
            for b, m in uses.items():
                used[b] += m * repeats
        assert used == Counter({b: n for b, n in counts.items() if n})


def test_words_alone_give_the_same_ids():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PACK.tokenizer)
    for text in [x for x in TEXTS if x]:
        alone = [i for w in text.encode().split() for i in t.encode(w.decode(), add_special_tokens=False).ids]
        assert alone == t.encode(text, add_special_tokens=False).ids, text[:40]

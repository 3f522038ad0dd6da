"""Near-duplicates of documents and vectors, repeated passages: brute force on small tables."""

import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from mailspark.llm import embed_dedup, minhash, passages
from mailspark.llm.common import Cache, Stages, components, mix64

DOCS = "doc_id long, text string, lang string, component string, n long"
SF01 = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "clash", 1) for i, t in pairs], DOCS)


def brute_components(nodes, links):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text, k):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lower)
    if 0 < len(w) < k:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute_near(pairs, k, percent):
    sets = [shingles(t, k) for _, t in pairs]
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    met = set()
    for hits in where.values():
        met |= {(a, b) for x, a in enumerate(hits) for b in hits[x + 1 :]}
    links = []
    for a, b in met:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            links.append((pairs[a][0], pairs[b][0]))
    comp = brute_components([i for i, _ in pairs], links)
    return {i: (len(s), comp[i], comp[i] == i) for (i, _), s in zip(pairs, sets)}


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (250, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(1, 300)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df, Stages(spark, "t")).collect()}
    nodes = {n for e in edges for n in e}
    want = brute_components(nodes, edges)
    assert all(got.get(n, n) == want[n] for n in nodes)
    assert components(df.limit(0), Stages(spark, "t")).count() == 0


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(edits):
            w[int(rng.integers(len(w)))] = f"e{rng.integers(10**6)}"
        out.append(" ".join(w))
    return out


def near_cases(seed=2):
    rng = np.random.default_rng(seed)
    word = lambda n: [f"w{i}" for i in rng.integers(0, 3000, n)]
    texts = [None, "", "  \n", "one", "ONE", "one two", "One  TWO", "É one two three", "é one two three", "a a a a a a", "a a a"]
    for n, edits in ((60, 1), (120, 2), (200, 4), (80, 2), (300, 7)):
        texts += family(rng, word(n), 14, edits)
    chain = word(100)  # neighbours are near, ends are not
    for i in range(12):
        chain = chain[3:] + [f"c{i}_{j}" for j in range(3)]
        texts.append(" ".join(chain))
    texts += [" ".join(word(50))] * 30 + [" ".join(word(int(n))) for n in rng.integers(3, 90, 60)]
    texts.append("long " + " ".join(f"l{i}" for i in range(30_000)))
    order = rng.permutation(len(texts))
    return [(int(i), texts[j]) for i, j in enumerate(order)]


def test_near_duplicates_against_brute_force(spark):
    pairs = near_cases()
    for k, percent in ((3, 85), (5, 80)):
        df = docs_of(spark, pairs)
        got = {r["doc_id"]: tuple(r)[1:] for r in minhash.near_duplicates(df, minhash.MinMax(shingle=k, percent=percent)).collect()}
        assert got == brute_near(pairs, k, percent)


def test_near_duplicates_sf(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    pairs = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in minhash.near_duplicates(df, minhash.MinMax(shingle=3, percent=85)).collect()}
    assert got == brute_near(pairs, 3, 85)


def test_near_dedup_keeps_one_of_each_group(spark):
    pairs = near_cases(4)
    df = docs_of(spark, pairs + [pairs[20], pairs[20]]).union(docs_of(spark, [(None, "only null id here"), (None, None)]))
    kept = minhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    want = brute_near(pairs, 5, 80)
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(i for i, v in want.items() if v[2])
    assert None in ids
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_near_duplicates_of_repeated_and_null_ids(spark):
    rng = np.random.default_rng(14)
    word = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 9000, n))
    a, b, c, d = (word(60) for _ in range(4))
    near = lambda t: t + " more"
    # (doc_id, text), component, kept
    cases = [
        ((1, near(a)), 1, True), ((2, a), 1, False), ((2, b), 2, True), ((3, near(b)), 2, False),
        ((None, c), None, None), ((None, near(c)), None, None), ((4, near(d)), 4, True), ((None, d), 4, False),
        ((4, a), 1, False), ((5, ""), 5, True), ((None, ""), None, True),
    ]
    pairs = [x for x, _, _ in cases]
    df = docs_of(spark, pairs)
    got = {(r["doc_id"], r["t"]): r for r in minhash.judged(df, minhash.MinMax()).collect()}
    hashes = [r[0] for r in docs_of(spark, pairs).select(minhash.text_hash()).collect()]
    for (p, comp, kept), t in zip(cases, hashes):
        assert got[p[0], t]["component_id"] == comp and kept in (None, got[p[0], t]["kept"]), p
    assert sum(got[None, t]["kept"] for t in hashes[4:6]) == 1
    left = [(r["doc_id"], r["text"]) for r in minhash.drop_near_duplicates(df.union(df)).collect()]
    want = [p for p, _, kept in cases if kept]
    assert len(left) == len(want) + 1 and set(want) < set(left)


def test_minmax_uses_both_ends():
    cfg = minhash.MinMax()
    assert cfg.bands * cfg.rows == 128
    words = Cache(lambda w: zlib.crc32(w))
    sets = minhash.shingle_sets(["a b c d e f g"] * 2 + ["h i j k l m"], 3, words)
    off = minhash.starts([len(s) for s in sets])
    bands = minhash.band_hashes(np.concatenate(sets), off, cfg)
    assert (bands[0] == bands[1]).all() and not (bands[0] == bands[2]).any()


def test_odd_sketches_never_differ_in_more_bits_than_the_sets():
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 900, int(n)).astype(np.uint64)) for n in rng.integers(1, 1200, 40)]
    for cells in (64, 2048):
        bits = minhash.odd_bits(np.concatenate(sets), minhash.starts([len(s) for s in sets]), cells)
        flips = lambda x, y: sum(int(v).bit_count() for v in (bits[x] ^ bits[y]).view(np.uint64))  # noqa: E731, B023
        for x, y in itertools.combinations(range(40), 2):
            assert flips(x, y) <= len(np.setxor1d(sets[x], sets[y]))
    assert minhash.odd_bits(np.empty(0, np.uint64), np.zeros(1, np.int64), 64).shape == (0, 1)


def test_pairs_to_confirm_grow_with_a_family_not_with_its_square(spark, monkeypatch):
    """Families just under the threshold (none, or every so many, of their pairs link), of texts below and above ``short`` shingles."""
    asked, plain = [], minhash.confirmed

    def counting(pairs, sets, cfg):
        asked.append(pairs.count())
        return plain(pairs, sets, cfg)

    monkeypatch.setattr(minhash, "confirmed", counting)
    cfg = minhash.MinMax(shingle=3, percent=85)
    def run(n, words, edits):
        rng = np.random.default_rng(n)
        texts = family(rng, [f"w{i}" for i in rng.integers(0, 3000, words)], n, edits)
        asked.clear()
        got = {r["doc_id"]: tuple(r)[1:] for r in minhash.near_duplicates(docs_of(spark, list(enumerate(texts))), cfg).collect()}
        return sum(asked), got, texts

    _, got, texts = run(100, 200, 3)
    assert got == brute_near(list(enumerate(texts)), 3, 85)
    # smaller families have fewer pairs than their bands draw centres for
    for words, edits in ((200, 4), (1500, 28)):
        small, large = run(300, words, edits)[0], run(1200, words, edits)[0]
        assert large < 5 * small, (words, edits, small, large)


# vectors


def brute_vectors(rows, least=0.9):
    good = []
    for n, (i, v) in enumerate(rows):
        if i is not None and v is not None and not any(x is None or not np.isfinite(x) for x in v) and any(v):
            good.append((n, i, np.array(v, float)))
    links = []
    for x, (n, i, v) in enumerate(good):
        for m, j, w in good[x + 1 :]:
            if len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= least:
                links.append((n, m))
    comp = brute_components(range(len(rows)), links)
    low = defaultdict(list)
    for n, (i, _) in enumerate(rows):
        low[comp[n]].append(i)
    degree = np.bincount(np.array(links, int).ravel(), minlength=len(rows)) if links else np.zeros(len(rows), int)
    named = {n: min((x for x in low[comp[n]] if x is not None), default=None) for n in range(len(rows))}
    return sorted(((i, int(degree[n]), named[n], i == named[n]) for n, (i, _) in enumerate(rows)), key=str)


def vector_rows(seed, n, dim=64):
    rng = np.random.default_rng(seed)
    rows = [rng.standard_normal(dim) for _ in range(n)]
    for g in range(12):
        base = rng.standard_normal(dim)
        rows += [base + s * rng.standard_normal(dim) for s in rng.uniform(0.05, 0.5, 8)]
    rows += [rows[3]] * 40 + [rows[5] * 7.5, rows[5] * 1e-30, -rows[5]]
    rows = [[float(x) for x in v] for v in rows]
    rows += [None, [0.0] * dim, [float("nan")] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1), [float("inf")] * dim, [], [1.0, 0.0], [1.0, 0.1], [3.0], [4.0], [-4.0]]
    return [(int(i), v) for i, v in enumerate(rows)]


def test_vectors_against_brute_force(spark):
    rows = vector_rows(1, 300)
    df = spark.createDataFrame([(i, v, 0, 9) for i, v in rows], "vec_id long, embedding array<double>, label int, n_links int")
    got = {r["vec_id"]: tuple(r) for r in embed_dedup.vector_links(df).collect()}
    want = {t[0]: t for t in brute_vectors(rows)}
    assert len(got) == len(rows)
    right, found = sum(t[1] for t in want.values()), sum(t[1] for t in got.values())
    assert all(got[i][1] <= want[i][1] for i in want)  # none below the least cosine
    assert found >= 0.97 * right


def test_vector_edges(spark):
    rows = [(7, [1.0, 2.0]), (7, [1.0, 2.0]), (7, [2.0, -1.0]), (None, [1.0, 2.0]), (3, [1.0, 2.0001]), (9, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, embed_dedup.vector_links(df).collect()), key=str)
    assert got == brute_vectors(rows)
    assert embed_dedup.vector_links(df.limit(0)).count() == 0


def test_vector_recall_sf(spark):
    df = spark.read.parquet(f"{SF01}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert sorted(map(tuple, embed_dedup.vector_links(df).collect()), key=str) == brute_vectors(rows)


def test_vectors_of_any_size_and_many_lengths(spark):
    """Huge, tiny and mixed components; a hundred lengths in one table."""
    rng = np.random.default_rng(21)
    rows = [(1, [1e200, 1e200]), (2, [1e200, -1e200]), (3, [-1e200, -1e200]), (4, [1e-200, 1e-200]), (5, [2e-310, 2e-310]), (6, [1e308, 1e-300]), (7, [3.0, 0.0])]
    for d in range(3, 103):
        x = rng.standard_normal(d)
        rows += [(10 * d, x.tolist()), (10 * d + 1, (x * 1e-150).tolist()), (10 * d + 2, rng.standard_normal(d).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed_dedup.vector_links(df).collect()}
    assert got[1] == got[4] == got[5] == (2, 1) and got[2] == (0, 2) and got[3] == (0, 3) and got[6] == got[7] == (1, 6)
    for d in range(10, 103):
        assert got[10 * d] == got[10 * d + 1] == (1, 10 * d) and got[10 * d + 2] == (0, 10 * d + 2)


def test_directions_in_blocks():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, 8))
    whole, parts = embed_dedup.Projections(), embed_dedup.Projections(block_floats=8 * 64)
    a = np.concatenate([b for _, b in embed_dedup.direction_blocks(8, 300, parts)])
    assert a.shape == (300, 8)
    p = x.astype(np.float32) @ a.T
    order = np.argsort(-np.abs(p), axis=1)[:, : parts.lists]
    want = [{(2 * j + (p[i, j] < 0)) for j in order[i]} for i in range(len(x))]
    lists, far = embed_dedup.farthest(x, 300, parts)
    assert [set(r.tolist()) for r in lists] == want
    assert embed_dedup.farthest(x, 300, whole)[0].shape == lists.shape


def test_calibrated_recall():
    cfg = embed_dedup.Projections()
    for m in (512, 4096):
        assert embed_dedup.calibrated_count(64, m, cfg) >= 2


# passages


def own_units(text, cfg):
    """The cut rule word by word: (words of a unit, the unit as it stands)."""
    words = re.findall(r"\S+\s*", text)
    if not words:
        return []
    words[0] = re.match(r"\s*", text).group() + words[0]
    ends = [w.strip()[-1] in ".!?" or "\n" in re.search(r"\s*$", w).group() for w in words]
    keys = []
    for k in range(len(words) - 1):
        a, b = (np.uint64(passages.word_value(w)) >> np.uint64(1) for w in words[k : k + 2])
        with np.errstate(over="ignore"):
            mixed = int(mix64(np.array([a * passages.MULTIPLIER + b], np.uint64))[0]) >> 1
        keys.append(mixed if ends[k] else mixed | 1 << 63)
    out, lo, far = [], 0, cfg.shortest - 1
    for hi in [k + 1 for k, e in enumerate(ends[:-1]) if e] + [len(words)]:
        cuts = [lo]
        if hi - lo > cfg.whole:
            # a place k + 1 is a cut if its key is the smallest of its neighbours', the first of equal ones
            near = []
            for k in range(lo, hi - 1):
                left, right = keys[max(0, k - far) : k], keys[k + 1 : k + 1 + far]
                if all(keys[k] < x for x in left) and all(keys[k] <= x for x in right) and cfg.shortest <= k + 1 <= len(words) - cfg.shortest:
                    near.append(k + 1)
            for b in [*near, hi]:
                while b - cuts[-1] > cfg.longest:
                    places = range(cuts[-1] + cfg.shortest, min(cuts[-1] + cfg.longest, b - cfg.shortest) + 1)
                    cuts.append(min(places, key=lambda x: keys[x - 1]))
                cuts.append(b)
            cuts.pop()
        out += [words[x:y] for x, y in zip(cuts, [*cuts[1:], hi])]
        lo = hi
    return out


def sentence_count(text):
    return sum(bool(re.search("[^ \\t\\n]", x)) for x in re.split("(?<=[.!?])[ \\t\\n]+|\\n+", text or ""))


def brute_passages(pairs, cfg):
    runs, parts, reach = defaultdict(list), {}, {}
    for i, t in pairs:
        crc = zlib.crc32((t or "").encode()) if t else 0
        if (i, crc) in parts:
            continue
        p = own_units(t, cfg) if t else []
        if p:
            assert "".join(w for u in p for w in u) == t
        parts[i, crc] = p
        for k in range(len(p)):
            e = k + cfg.run
            while e <= len(p) and sum(map(len, p[k:e])) < cfg.least_words:
                e += 1
            if e <= len(p):
                reach[i, crc, k] = e
                runs[tuple(tuple(w.strip().lower() for w in u) for u in p[k:e])].append(((i is not None, i or 0), crc, k, i))
    gone = defaultdict(set)
    for hits in runs.values():
        for _, crc, k, i in sorted(hits, key=lambda x: x[:3])[1:]:
            gone[i, crc] |= set(range(k, reach[i, crc, k]))
    out = []
    for i, t in pairs:
        crc = zlib.crc32((t or "").encode()) if t else 0
        drop = gone[i, crc]
        text = "".join(w for k, u in enumerate(parts[i, crc]) if k not in drop for w in u) if drop else t
        out.append((i, sentence_count(t), len(drop), text))
    return sorted(out, key=str)


def passage_cases():
    rng = np.random.default_rng(8)
    word = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 4000, n))
    prose = lambda n: " ".join(word(int(k)).capitalize() + rng.choice([".", "!", "?", ".\n"]) for k in rng.integers(2, 15, n))
    shared = [prose(9) for _ in range(4)] + [word(70), word(120)]
    out = [None, "", "\n\n", "One. Two. Three.", "One. Two. Three.", prose(3) + "\n\n\n"]
    for k in range(60):
        out.append(prose(6) + " " + shared[k % 6] + " " + prose(5))
    whole = " ".join(word(7) + "." for _ in range(6))
    out += [out[10]] * 3 + [whole, whole, "A b c d e f. G h i j k l. " * 6, "x. " * 2000]
    return [(int(i), t) for i, t in enumerate(out)]


def test_passages_against_brute_force(spark):
    pairs = passage_cases()
    pairs += [pairs[9], pairs[9], (None, pairs[12][1]), (pairs[9][0], pairs[14][1])]
    cfg = passages.Spans()
    df = docs_of(spark, pairs)
    got = sorted(((r["doc_id"], r["n_sentences"], r["n_removed"], r["text"]) for r in passages.repeated_passages(df, cfg).collect()), key=str)
    assert got == brute_passages(pairs, cfg)


def test_shared_passages_go_and_own_text_stays(spark):
    pairs = passage_cases()
    cfg = passages.Spans()
    out = {r["doc_id"]: r for r in passages.repeated_passages(docs_of(spark, pairs), cfg).collect()}
    text = dict(pairs)
    for r in out.values():
        if r["removed"]:
            spans = [tuple(map(int, x.split(":"))) for x in r["removed"].split(",")]
            kept, at = "", 0
            for a, b in spans:
                kept, at = kept + text[r["doc_id"]][at:a], b
            assert kept + text[r["doc_id"]][at:] == r["text"]
    # planted in every sixth document: all but the first lose most of the passage and hardly anything else
    for k in range(6, 60):
        lost = len(text[6 + k].split()) - len(out[6 + k]["text"].split())
        assert lost >= 30
        first, last = text[6 + k].split()[0], text[6 + k].split()[-1]
        assert out[6 + k]["text"].split()[0] == first and out[6 + k]["text"].split()[-1] == last


def test_without_repeats(spark):
    pairs = passage_cases()
    df = docs_of(spark, pairs).withColumn("n_chars", F.length("text").cast("int")).withColumn("starts", F.lit(1))
    got = {r["doc_id"]: r for r in passages.without_repeats(df).collect()}
    assert passages.without_repeats(df).columns == df.columns
    want = {i: t for i, _, _, t in brute_passages(pairs, passages.Spans())}
    gone = {i for i, t in want.items() if (t is not None and not t.split() and dict(pairs)[i].split())}
    assert set(got) == set(want) - gone and gone
    assert all(got[i]["text"] == want[i] and got[i]["n_chars"] == (None if want[i] is None else len(want[i])) for i in got)
    assert passages.without_repeats(df.limit(0)).count() == 0


def test_passages_sf(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    pairs = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = sorted(((r["doc_id"], r["n_sentences"], r["n_removed"], r["text"]) for r in passages.repeated_passages(df).collect()), key=str)
    assert got == brute_passages(pairs, passages.Spans())


def test_sentences_of_few_words_stay_whole():
    """One shared stretch inside two sentences of up to ``whole`` words is no passage; sentences are units."""
    cfg = passages.Spans()
    picked = passages.picker(cfg)
    text = "One two three four five six seven eight nine ten eleven twelve. A b. C!\nD e f? " + "long " * 30
    parts = passages.sentences(text, cfg, picked)
    assert parts[:4] == ["One two three four five six seven eight nine ten eleven twelve. ", "A b. ", "C!\n", "D e f? "]
    assert all(cfg.shortest <= len(p.split()) <= cfg.longest for p in parts[4:])


def test_passage_columns_may_clash(spark):
    pairs = passage_cases()
    names = ["_d", "_c", "_starts", "_kept", "row", "crc", "cell", "starts", "d", "c", "new", "h", "at"]
    df = docs_of(spark, pairs).select("doc_id", "text", *[F.lit(k).alias(x) for k, x in enumerate(names)])
    got = passages.without_repeats(df)
    assert got.columns == df.columns
    assert {tuple(r[x] for x in names) for r in got.collect()} == {tuple(range(len(names)))}
    few = passages.Spans(cells=2)
    assert sorted(map(str, passages.without_repeats(df, few).collect())) == sorted(map(str, got.collect()))
    assert minhash.drop_near_duplicates(df).columns == df.columns and minhash.drop_near_duplicates(df).count() > 0


def planted(passage, seed):
    rng = np.random.default_rng(seed)
    around = lambda: " ".join(f"o{x}" for x in rng.integers(0, 10**9, int(rng.integers(30, 60))))
    return f"{around()} {passage} {around()}"


def held(spark, kinds):
    """Every passage is planted in two texts of their own words; the shares of its words that the second text loses."""
    pairs = [(2 * i + j, planted(p, 2 * i + j)) for i, p in enumerate(kinds) for j in range(2)]
    out = {r["doc_id"]: r["text"] for r in passages.repeated_passages(docs_of(spark, pairs)).collect()}
    own = lambda t: [w for w in t.split() if w[0] == "o"]
    for i, t in pairs:
        assert own(out[i]) == own(t)
    return [(len(pairs[2 * i + 1][1].split()) - len(out[2 * i + 1].split())) / len(p.split()) for i, p in enumerate(kinds)]


def test_passages_of_short_sentences(spark):
    rng, kinds = np.random.default_rng(11), []
    for end in (".", "!!", "\n", " |"):
        for longest in (1, 2, 3):
            for words in (50, 60, 200):
                rows, left = [], words
                while left > 0:
                    n = min(left, int(rng.integers(1, longest + 1)))
                    rows.append(" ".join(f"u{i}{x}" for i, x in enumerate(rng.integers(0, 3000, n))) + end)
                    left -= n
                kinds.append(" ".join(rows))
    shares = held(spark, kinds)
    assert min(shares) > 0.4 and np.mean(shares) > 0.8
    # all words but a few last ones lie in some run, and every run holds words enough
    cfg = passages.Spans()
    for t in kinds:
        picked = passages.picker(cfg)
        parts = [len(x.split()) for x in passages.sentences(t, cfg, picked)]
        ends = passages.run_ends(passages.units(passages.values_of(passages.words_of(t), picked), cfg), cfg)
        h, at = passages.hashed_runs(t, cfg, picked)
        assert at.tolist() == list(range(len(ends))) and sum(parts[ends[-1] :]) <= cfg.whole
        assert all(sum(parts[i:e]) >= cfg.least_words and e - i >= cfg.run for i, e in enumerate(ends))


def test_passages_in_long_sentences(spark):
    rng = np.random.default_rng(12)
    kinds = [f" {i}q".join(["", *map(str, rng.integers(0, 10**6, n))]) for i in range(12) for n in (50, 60)]
    # words apart by tabs or no-break spaces
    kinds += [blank.join(f"t{i}{x}" for x in rng.integers(0, 10**6, 60)) for i, blank in enumerate("\t\u00a0" * 4)]
    # few words, drawn or in turn
    for few in range(1, 14):
        kinds.append(" ".join(f"f{few}{'abcdefghijklm'[x]}" for x in rng.integers(0, few, 50)))
        kinds.append(" ".join(f"g{few}{'abcdefghijklm'[x % few]}" for x in range(50)))
    shares = held(spark, kinds)
    assert min(shares) > 0.2 and np.mean(shares) > 0.75


def test_pieces_hang_on_the_words_around_alone():
    cfg, rng = passages.Spans(), np.random.default_rng(13)
    picked = passages.picker(cfg)
    for k in range(300):
        p = " ".join(f"w{x}" for x in rng.integers(0, (2, 40, 10**6)[k % 3], 50))
        cut = [passages.sentences(planted(p, 2 * k + j), cfg, picked) for j in range(2)]
        assert all(cfg.shortest <= len(s.split()) <= cfg.longest for parts in cut for s in parts)
        runs = []
        for parts in cut:
            ends = [next((e for e in range(i + cfg.run, len(parts) + 1) if len("".join(parts[i:e]).split()) >= cfg.least_words), 0) for i in range(len(parts))]
            runs.append({"".join(parts[i:e]) for i, e in enumerate(ends) if e})
        assert runs[0] & runs[1]

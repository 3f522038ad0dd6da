"""Secret scan by a randomness test battery (operator 5), DataFrame functions only.

Three fixed patterns give base spans. The battery looks at every run of 20 or more characters of the usual encodings:
the smallest fitting alphabet is inferred (hex, letters, base32, lower alphanumeric, base64), and three tests compare the run
with uniform draws: chi-squared of symbol counts, Wald-Wolfowitz runs about the alphabet's middle, and lag-one serial
correlation of symbol numbers. Each is turned around into an equivalence test: its null hypothesis is that the run departs
from uniform at least as much as ordinary writing (``departure`` per alphabet, ``dependence`` for order), so a small
p-value shows randomness and short runs, which can't show it, get large ones. A run's p-value is the largest of the three
(all nulls must fall). Benjamini-Hochberg control over the whole corpus, separately in bands of length, decides which
runs become spans. Its cutoff comes from a histogram of p-values on a fixed grid, each counted at its bin's upper
edge, so nothing but a few hundred counts is gathered.

Null text counts as empty: no spans. Repeated rows are scanned each. Positions are code points, ends exclusive. Extra
columns are ignored (``scan``) or kept (``redact``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import Stages

ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""(?i)^(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
# A greedy run that is long enough is the same match with the bound inside the pattern.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
RUN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
#: Name of the column that holds found spans; no table should have it.
FOUND = "_secret_scan_found"
KINDS = ("assign", "access", "hex", "random")
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: pattern of the folded run, alphabet, least departure (sum of (q - u)^2 / u) that ordinary writing shows
ALPHABETS = (
    (r"^[0-9a-f]+$", "0123456789abcdef", 0.6),
    (r"^[a-z]+$", "abcdefghijklmnopqrstuvwxyz", 0.5),
    (r"^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.8),
    (r"^[a-z0-9]+$", "abcdefghijklmnopqrstuvwxyz0123456789", 1.0),
    (r"^", BASE64, 1.3),
)


@dataclass(frozen=True)
class Battery:
    fdr: float = 0.05
    dependence: float = 0.6
    bands: tuple[int, ...] = field(default=(20, 28, 40, 64))  # lower ends of the length bands
    bins: int = 400
    per_decade: int = 20
    mark: str = "[SECRET]"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), 0)


def running(a: Column, block: int = 256) -> Column:
    """Sums of the elements before each place, in blocks, so that long arrays don't cost their square."""
    total = lambda x: F.aggregate(x, F.lit(0), lambda p, q: p + q)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / block).cast("int")), lambda b: total(F.slice(a, b * block + 1, F.lit(block))))

    def inner(s: Column) -> Column:
        at = F.transform(s["b"], lambda _, b: total(F.slice(s["b"], F.lit(1), b)))
        return let(F.struct(s["a"].alias("a"), at.alias("at")), lambda t: F.transform(t["a"], lambda _, i: F.get(t["at"], F.floor(i / block).cast("int")) + total(F.slice(t["a"], F.floor(i / block).cast("int") * block + 1, i % block))))

    return let(F.struct(a.alias("a"), blocks.alias("b")), inner)


def matches(text: Column, regex: str) -> Column:
    """``array<struct<s, start, end>>`` of the leftmost non-overlapping matches: what lies between them comes from a split
    by the same pattern, and lengths add up to positions."""

    def placed(b: Column) -> Column:
        steps = F.transform(b["m"], lambda x, i: F.length(x) + F.length(F.get(b["p"], i)))
        return let(F.struct(b["m"].alias("m"), b["p"].alias("p"), running(steps).alias("at")), lambda c: F.transform(c["m"], lambda x, i: F.struct(x.alias("s"), (F.get(c["at"], i) + F.length(F.get(c["p"], i))).alias("start"), (F.get(c["at"], i) + F.length(F.get(c["p"], i)) + F.length(x)).alias("end"))))

    both = F.struct(F.regexp_extract_all(text, F.lit(regex), F.lit(0)).alias("m"), F.split(text, regex, -1).alias("p"))
    none = F.from_json(F.lit("[]"), "array<struct<s:string,start:int,end:int>>")
    return F.when(text.rlike(regex), let(both, placed)).otherwise(none)


def spans_of(kind: int, found: Column) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """``array<struct<start, kind, end>>`` of the three fixed patterns."""
    value = lambda m: F.length(F.regexp_extract(m["s"], ASSIGN_VALUE, 1)) >= 8
    return F.array_sort(F.concat(spans_of(0, F.filter(matches(text, ASSIGN), value)), spans_of(1, matches(text, ACCESS)), spans_of(2, matches(text, HEX))))


def normal_cdf(z: Column) -> Column:
    """The normal distribution function to about 1e-4: a logistic curve with a cubic term."""
    return 1 / (1 + F.exp(F.least(-1.5976 * z - 0.07056 * z * z * z, F.lit(700.0))))


def randomness(run: Column, cfg: Battery) -> Column:
    """The p-value of one run: small where it looks drawn uniformly from its alphabet."""
    bare = F.rtrim(run, F.lit("="))
    folded = F.when(bare.rlike("^[0-9A-F]+$"), F.lower(bare)).when(bare.rlike("^[A-Z]+$"), F.lower(bare)).otherwise(F.translate(bare, "-_", "+/"))

    def alphabet(s: Column) -> Column:
        pick = None
        for pattern, letters, departure in ALPHABETS:
            row = F.struct(s.alias("s"), F.lit(letters).alias("letters"), F.lit(float(len(letters))).alias("k"), F.lit(departure).alias("departure"))
            pick = F.when(s.rlike(pattern), row) if pick is None else pick.when(s.rlike(pattern), row)
        return pick

    def numbers(a: Column) -> Column:
        x = F.transform(F.split(a["s"], ""), lambda c: (F.position(c, a["letters"]) - 1).cast("double"))
        return F.struct(x.alias("x"), a["k"].alias("k"), a["departure"].alias("departure"))

    def tests(v: Column) -> Column:
        add = lambda p, q: p + q
        x, k, n = v["x"], v["k"], F.size(v["x"]).cast("double")
        squares = F.aggregate(F.array_distinct(x), F.lit(0.0), lambda acc, c: acc + F.pow(F.size(F.filter(x, lambda y: y == c)).cast("double"), F.lit(2.0)))
        chi = k / n * squares - n
        mean0 = k - 1 + n * v["departure"]
        p_chi = normal_cdf((chi - mean0) / F.sqrt(2 * (k - 1 + 2 * n * v["departure"])))
        next_ = F.slice(x, F.lit(2), F.greatest(F.size(x) - 1, F.lit(0)))
        high = F.aggregate(x, F.lit(0.0), lambda acc, y: acc + F.when(y >= k / 2, 1.0).otherwise(0.0))
        low = n - high
        turns = F.aggregate(F.zip_with(F.slice(x, F.lit(1), F.greatest(F.size(x) - 1, F.lit(0))), next_, lambda p, q: F.when((p >= k / 2) != (q >= k / 2), 1.0).otherwise(0.0)), F.lit(1.0), add)
        expected = 2 * high * low / n + 1
        spread = (expected - 1) * (expected - 2) / (n - 1)
        z_runs = F.when(spread > 0, (turns - expected) / F.sqrt(spread)).otherwise(F.lit(99.0))
        mean = F.aggregate(x, F.lit(0.0), add) / n

        def serial(m: Column) -> Column:
            var = F.aggregate(x, F.lit(0.0), lambda acc, y: acc + (y - m) * (y - m))
            cov = F.aggregate(F.zip_with(F.slice(x, F.lit(1), F.greatest(F.size(x) - 1, F.lit(0))), next_, lambda p, q: (p - m) * (q - m)), F.lit(0.0), add)
            return F.when(var > 0, cov / var * F.sqrt(n)).otherwise(F.lit(99.0))

        order = lambda z: normal_cdf(F.abs(z) - cfg.dependence * F.sqrt(n))
        return F.greatest(p_chi, order(z_runs), order(let(mean, serial)))

    return let(folded, lambda s: let(alphabet(s), lambda a: let(numbers(a), tests)))


def candidates(text: Column, base: Column, cfg: Battery) -> Column:
    """``array<struct<start, kind, end, p>>`` of runs that no base span covers."""
    open_ = F.filter(matches(text, RUN), lambda m: ~F.exists(base, lambda b: (b["start"] <= m["start"]) & (b["end"] >= m["end"])))
    return F.transform(open_, lambda m: F.struct(m["start"].alias("start"), F.lit(3).alias("kind"), m["end"].alias("end"), randomness(m["s"], cfg).alias("p")))


def scanned(docs: DataFrame, cfg: Battery, *cols: str) -> DataFrame:
    """``cols`` and a struct FOUND of ``base`` and ``runs`` of every document, in one narrow pass."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    both = let(F.struct(text.alias("t"), base_spans(text).alias("b")), lambda s: F.struct(s["b"].alias("base"), candidates(s["t"], s["b"], cfg).alias("runs")))
    return docs.select(*cols, both.alias(FOUND))


def length_band(n: Column, cfg: Battery) -> Column:
    out = F.lit(0)
    for i, low in enumerate(cfg.bands):
        out = F.when(n >= low, F.lit(i)).otherwise(out)
    return out


def cutoffs(runs: DataFrame, cfg: Battery) -> list[float]:
    """The Benjamini-Hochberg cutoff of each length band (0 where nothing is discovered) over all ``runs(start, end, p)``.
    The driver gets at most bands x bins counts."""
    bin_ = F.least(F.floor(-F.log10(F.greatest("p", F.lit(1e-300))) * cfg.per_decade), F.lit(cfg.bins)).cast("int")
    counts = runs.groupBy(length_band(F.col("end") - F.col("start"), cfg).alias("band"), bin_.alias("bin")).count().collect()
    out = []
    for band in range(len(cfg.bands)):
        rows = sorted(((r["bin"], r["count"]) for r in counts if r["band"] == band), reverse=True)
        total, so_far, best = sum(c for _, c in rows), 0, 0.0
        for b, c in rows:
            so_far += c
            edge = math.pow(10, -b / cfg.per_decade)
            if total * edge <= cfg.fdr * so_far:
                best = max(best, edge)
        out.append(best)
    return out


def discovered(runs: Column, cuts: list[float], cfg: Battery) -> Column:
    cut = F.array(*(F.lit(c) for c in cuts))
    found = F.filter(runs, lambda r: r["p"] <= F.get(cut, length_band(r["end"] - r["start"], cfg)))
    return F.transform(found, lambda r: F.struct(r["start"].alias("start"), r["kind"].alias("kind"), r["end"].alias("end")))


def written(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def scan(docs: DataFrame, cfg: Battery = Battery()) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random)`` for every row of ``docs(doc_id, text)``.
    Spans of all documents are written once; the cutoffs and the result read them."""
    stages = Stages(docs.sparkSession, "secrets")
    found = stages.keep(scanned(docs, cfg, "doc_id").select("doc_id", f"{FOUND}.base", f"{FOUND}.runs"))
    cuts = cutoffs(found.select(F.explode("runs").alias("r")).select("r.*"), cfg)
    added = discovered(F.col("runs"), cuts, cfg)
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.array_sort(F.concat("base", added))).alias("spans"),
        F.size(added).cast("long").alias("n_random"),
    )


def covered(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with each stretch that spans cover replaced by ``mark``; spans are sorted by start and may overlap."""

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        out = F.when(fresh, F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    done = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    return let(done, lambda d: F.concat(d["out"], F.substring(text, d["at"] + 1, F.length(text))))


def redact(docs: DataFrame, cfg: Battery = Battery()) -> DataFrame:
    """``docs`` with secrets in ``text`` replaced by ``mark`` and ``n_chars``, where there is one, counted anew; all rows
    and columns stay. The corpus-wide cutoffs take a first pass, the replacement a second; texts are never shuffled."""
    runs = scanned(docs, cfg).select(F.explode(f"{FOUND}.runs").alias("r")).select("r.*")
    cuts = cutoffs(runs, cfg)
    with_spans = scanned(docs, cfg, "*")
    spans = F.array_sort(F.concat(f"{FOUND}.base", discovered(F.col(f"{FOUND}.runs"), cuts, cfg)))
    out = with_spans.withColumn("text", F.when(F.size(spans) > 0, covered(F.col("text").cast("string"), spans, cfg.mark)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out.select(*docs.columns)

"""Vectorizer and grid configuration."""

from __future__ import annotations

from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's: the four weightings in their
# loop order, the vocabulary limits, the ridge values, the seed, the number of
# cross-validation folds, the solver's iteration cap and the preset winner.
# ---------------------------------------------------------------------------
VECTORIZERS = ("BINARY", "TF", "TF_IDF", "TF_IDF_BIGRAMS")
WORDS_TO_KEEP = (100, 250, 500, 1000)
RIDGES = (1e-8, 1e-6, 1e-4, 1e-2, 1.0, 10.0)
SEED = 12345
N_FOLDS = 10
MAX_ITER = 500
PRESET_RIDGE = 10.0
PRESET_WORDS_TO_KEEP = 1000
PRESET_VECTORIZER = "TF_IDF"


@dataclass(frozen=True)
class VectorizerConfig:
    """How text becomes weighted terms.

    ``weighting``: BINARY (1 if present), TF (ln(1+f)), TF_IDF
    (ln(1+f) * ln(N/df)); ``bigrams`` adds 2-grams to the 1-grams.
    ``words_to_keep`` is the per-class limit K (ties at the cut are kept).
    ``stemmer``: "none" or "lovins"; ``stopwords``: None or a tuple of
    words tested against the (stemmed) term; ``stop_before_stem`` moves the
    stopword test in front of stemming.
    """

    weighting: str = "TF_IDF"
    bigrams: bool = False
    words_to_keep: int = PRESET_WORDS_TO_KEEP
    stemmer: object = "none"  # "none" or a per-word function str -> str
    stopwords: tuple[str, ...] | None = None
    stop_before_stem: bool = False

    def __post_init__(self):
        if self.weighting not in ("BINARY", "TF", "TF_IDF"):
            raise ValueError(f"unknown weighting {self.weighting!r}")
        if self.stemmer == "lovins":
            raise NotImplementedError("pass operators.lovins.lovins(endings): the list of endings is a parameter (see README)")
        if not (self.stemmer == "none" or callable(self.stemmer)):
            raise ValueError(f"unknown stemmer {self.stemmer!r}")
        if self.words_to_keep < 1:
            raise ValueError("words_to_keep must be >= 1")

    @property
    def kind(self) -> str:
        """The reference's vectorizer name (V6)."""
        if self.bigrams:
            return "TF_IDF_BIGRAMS"
        return self.weighting

    @property
    def stemmer_name(self) -> str:
        return self.stemmer if isinstance(self.stemmer, str) else getattr(self.stemmer, "__name__", "custom")

    @property
    def tokenizer(self) -> str:
        return "ngram12" if self.bigrams else "word"

    @staticmethod
    def for_kind(kind: str, **kw) -> "VectorizerConfig":
        """V6: the reference's vectorizer selector."""
        kind = kind.upper()
        if kind == "TF_IDF_BIGRAMS":
            return VectorizerConfig(weighting="TF_IDF", bigrams=True, **kw)
        if kind in ("BINARY", "TF", "TF_IDF"):
            return VectorizerConfig(weighting=kind, bigrams=False, **kw)
        raise ValueError(f"unknown vectorizer {kind!r}")

    def with_k(self, k: int) -> "VectorizerConfig":
        return replace(self, words_to_keep=k)


def default_stopwords() -> tuple[str, ...]:
    """Spark's built-in English stopword list (the reference's list is not
    available; see README). Read from the Spark ML jar that ships with
    PySpark, so no running SparkContext is needed; falls back to the JVM."""
    import glob
    import os
    import zipfile

    import pyspark

    jars = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar"))
    for jar in jars:
        with zipfile.ZipFile(jar) as z:
            name = "org/apache/spark/ml/feature/stopwords/english.txt"
            if name in z.namelist():
                return tuple(w for w in z.read(name).decode("utf-8").split("\n") if w.strip())
    from pyspark.ml.feature import StopWordsRemover

    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def tfidf_preset(k: int = PRESET_WORDS_TO_KEEP, stemmer: str = "none", stopwords=True) -> VectorizerConfig:
    """V5: the reference's preset filter: lower-case, K per class,
    stopwords, word tokens, TF-IDF (the Lovins stemmer is not available
    yet, see README)."""
    sw = default_stopwords() if stopwords is True else (tuple(stopwords) if stopwords else None)
    return VectorizerConfig(weighting="TF_IDF", bigrams=False, words_to_keep=k, stemmer=stemmer, stopwords=sw)


@dataclass(frozen=True)
class GridSpec:
    """M8: the tuning grid; defaults are the reference's 96 points."""

    vectorizers: tuple[str, ...] = VECTORIZERS
    words_to_keep: tuple[int, ...] = WORDS_TO_KEEP
    ridges: tuple[float, ...] = RIDGES
    n_folds: int = N_FOLDS
    max_iter: int = MAX_ITER
    stemmer: object = "none"  # "none" or a per-word function str -> str
    stopwords: tuple[str, ...] | str | None = "default"  # the default list, a tuple, or None

    def stop_list(self) -> tuple[str, ...] | None:
        return default_stopwords() if self.stopwords == "default" else self.stopwords

    def points(self):
        """Grid points in the reference's loop order (vectorizer, K, ridge)."""
        for v in self.vectorizers:
            v_ord = VECTORIZERS.index(v)
            for k in self.words_to_keep:
                for r in self.ridges:
                    yield v_ord, v, k, r

import pytest

from mailspark.config import GridSpec, VectorizerConfig, tfidf_preset


def test_kinds():
    assert VectorizerConfig.for_kind("TF_IDF_BIGRAMS").bigrams
    assert VectorizerConfig.for_kind("binary").weighting == "BINARY"
    with pytest.raises(ValueError):
        VectorizerConfig.for_kind("BM25")


def test_grid_order():
    pts = list(GridSpec().points())
    assert len(pts) == 96
    assert pts[0] == (0, "BINARY", 100, 1e-8) and pts[-1] == (3, "TF_IDF_BIGRAMS", 1000, 10.0)


def test_preset(spark):
    p = tfidf_preset()
    assert p.weighting == "TF_IDF" and p.words_to_keep == 1000 and len(p.stopwords) > 100
    with pytest.raises(NotImplementedError):
        VectorizerConfig(stemmer="lovins")

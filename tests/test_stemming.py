"""T4 job over distinct terms with a plugged-in per-word stemmer."""

from mailspark.config import VectorizerConfig
from mailspark.operators import terms as TM


# a lambda is pickled by value, so Python workers need not import this module
strip_s = lambda w: w[:-1] if len(w) > 3 and w.endswith("s") else w


def test_stem_merges_counts_and_bigrams(spark):
    d = spark.createDataFrame([(1, "cats cat dogs", "ham"), (2, "", "spam")], "doc_id BIGINT, text STRING, label STRING")
    c = TM.doc_term_counts(d, VectorizerConfig(stemmer=strip_s), outer=True)
    got = {(r["doc_id"], r["term"]): r["f"] for r in c.collect()}
    assert got[(1, "cat")] == 2 and got[(1, "dog")] == 1 and (2, None) in got
    b = TM.doc_term_counts(d, VectorizerConfig(stemmer=strip_s, bigrams=True))
    gb = {r["term"]: r["f"] for r in b.collect()}
    assert gb["cat cat"] == 1 and gb["cat dog"] == 1 and gb["cat"] == 2


def test_stopwords_see_the_stem(spark):
    d = spark.createDataFrame([(1, "cats cat dogs", "ham")], "doc_id BIGINT, text STRING, label STRING")
    after = {r["term"] for r in TM.doc_term_counts(d, VectorizerConfig(stemmer=strip_s, stopwords=("cat",))).collect()}
    assert after == {"dog"}
    before = {r["term"] for r in TM.doc_term_counts(d, VectorizerConfig(stemmer=strip_s, stopwords=("cat",), stop_before_stem=True)).collect()}
    assert before == {"cat", "dog"}


def test_documents_of_stopwords_alone_stay(spark):
    d = spark.createDataFrame([(1, "the the", "ham"), (2, "free of charge", "spam")], "doc_id BIGINT, text STRING, label STRING")
    for stemmer in ("none", strip_s):
        c = TM.doc_term_counts(d, VectorizerConfig(stemmer=stemmer, stopwords=("the",)), outer=True).collect()
        assert [(r["term"], r["f"]) for r in c if r["doc_id"] == 1] == [(None, None)]
        assert {r["term"] for r in c if r["doc_id"] == 2} == {"free", "of", "charge"}


def test_bigrams_never_jump_a_stopword(spark):
    d = spark.createDataFrame([(1, "free of charge don't", "ham")], "doc_id BIGINT, text STRING, label STRING")
    for stemmer in ("none", strip_s):
        terms = {r["term"] for r in TM.doc_term_counts(d, VectorizerConfig(stemmer=stemmer, bigrams=True, stopwords=("of", "don't"))).collect()}
        assert terms == {"free", "charge", "free of", "of charge", "charge don", "don t"}


def test_s_stem():
    from mailspark.operators.stemming import s_stem

    assert [s_stem(w) for w in ("ponies", "houses", "cats", "bus", "glass", "goes", "aies", "s", "ies")] == ["pony", "house", "cat", "bus", "glass", "goe", "aie", "", "y"]


#: A few of the paper's endings, enough for its examples.
SOME_ENDINGS = {
    "ationally": "B", "ation": "B", "ally": "B", "al": "BB", "ing": "N", "ed": "E", "ion": "Q", "ia": "A", "ic": "A", "ical": "A", "e": "A", "es": "E",
    "s": "W", "ix": "A", "ly": "B", "ness": "A", "ingly": "B", "ate": "A", "ar": "X", "or": "T", "y": "B", "en": "F", "ous": "A", "is": "A", "a": "A",
}


def test_lovins_examples():
    from mailspark.operators.lovins import lovins

    stem = lovins(SOME_ENDINGS)
    # longest ending whose condition holds: "ationally" leaves one letter, so "ally" goes
    assert stem("nationally") == "nation"
    assert [stem(w) for w in ("sitting", "rubbing", "embedded", "metallic", "beginning", "rabbited")] == ["sit", "rub", "embed", "metal", "begin", "rabbit"]
    # recoding brings variants together
    assert stem("induction") == stem("induced") == "induc"
    assert stem("absorption") == "absorb" and stem("consumption") == "consum" and stem("believed") == "belief"
    assert stem("dissolved") == stem("dissolution")[:8] == "dissolut"
    assert stem("magnetic") == "magnet" and stem("admitted") == "admis" and stem("admission") == "admis"
    assert stem("analytic") == "analys" and stem("analysis") == "analys"
    # conditions hold an ending back, and two letters always stay
    assert stem("king") == "king" and stem("sing") == "sing" and stem("see") == "se" and stem("as") == "as" and stem("") == ""


def test_lovins_conditions():
    import pytest

    from mailspark.operators.lovins import CONDITIONS, RECODINGS, lovins

    assert len(CONDITIONS) == 29 and len(RECODINGS) == 34
    holds = lambda c, stem: lovins({"zzz": c})(stem + "zzz") != lovins({})(stem + "zzz")
    yes = {"B": "abc", "C": "abcd", "D": "abcde", "E": "ab", "F": "abc", "G": "abf", "H": "ball", "I": "ab", "J": "ab", "K": "abuqe", "L": "ros", "M": "ab", "N": "abc", "O": "ai"}
    yes |= {"P": "ab", "Q": "abc", "R": "an", "S": "dr", "T": "as", "U": "am", "V": "ac", "W": "ab", "X": "uqe", "Y": "in", "Z": "ab", "AA": "ph", "BB": "abc", "CC": "al"}
    no = {"B": "ab", "C": "abc", "D": "abcd", "E": "ae", "F": "ab", "G": "abc", "H": "al", "I": "ao", "J": "aa", "K": "al", "L": "as", "M": "am", "N": "sab", "O": "ab"}
    no |= {"P": "ac", "Q": "abl", "R": "ab", "S": "att", "T": "ot", "U": "ab", "V": "ab", "W": "au", "X": "ab", "Y": "an", "Z": "af", "AA": "ab", "BB": "met", "CC": "ab"}
    assert all(holds(c, s) for c, s in yes.items()) and not any(holds(c, s) for c, s in no.items())
    with pytest.raises(ValueError):
        lovins({"ing": "ZZ"})


def test_lovins_from_a_file_in_the_preset(spark, tmp_path):
    from mailspark.config import tfidf_preset
    from mailspark.operators.lovins import lovins, read_endings

    (tmp_path / "endings.txt").write_text("# ending condition\n\n" + "\n".join(f"{e} {c}" for e, c in SOME_ENDINGS.items()))
    endings = read_endings(spark, str(tmp_path / "endings.txt"))
    assert endings == SOME_ENDINGS
    cfg = tfidf_preset(stemmer=lovins(endings), stopwords=("rub",))
    d = spark.createDataFrame([(1, "Rubbing rubbed sitting SITS", "ham")], "doc_id BIGINT, text STRING, label STRING")
    assert {(r["term"], r["f"]) for r in TM.doc_term_counts(d, cfg).collect()} == {("sit", 2)}

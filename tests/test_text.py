import pytest
from pyspark.sql import functions as F

from crossfade.functions.text import clean_name, normalize_title, standardize_text, title_case


def apply(spark, function, texts):
    rows = [(i, text) for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, text string")
    return [row.out for row in df.select("i", function("text").alias("out")).orderBy("i").collect()]


def test_standardize_text(spark):
    texts = ["  Été-Live (2011)!", None, "", "ＡＢＣ ﬁn", "a_b\tc d", "Straße", "Ωmega ΣΑΣ", "x́y", "...", "日本 語"]
    expected = ["ete live 2011", "", "", "abc fin", "a_b c d", "straße", "ωmega σας", "xy", "", "日本 語"]
    assert apply(spark, standardize_text, texts) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("ete live 2011", "Ete 2011"),
        ("hot gear feat someone", "Hot Gear"),
        ("Song (Live at Home) [2001]", "Song"),
        ("Song feat. Someone Else", "Song"),
        ("song ft somebody live", "Song"),
        ("alive featured liveness", "Alive Featured Liveness"),
        ("tune remastered 2011 radio edit", "Tune"),
        ("tune remastered 20115", "Tune 20115"),
        ("live live remix", ""),
        ("foo_bar baz", "Foo_Bar Baz"),
        ("ßa ÉCOLE", "SSa École"),
        (None, ""),
    ],
)
def test_clean_name(spark, text, expected):
    assert apply(spark, clean_name, [text]) == [expected]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("hot gear feat someone", "hot gear"),
        ("Hot Gear cover by x", "hot gear"),
        ("hot gear covered", "hot gear"),
        ("discover hardcover", "discover hardcover"),
        ("Hot Gear (Acoustic)", "hot gear"),
        ("øft feature", "øft feature"),
        (None, ""),
    ],
)
def test_normalize_title(spark, text, expected):
    assert apply(spark, normalize_title, [text]) == [expected]


def test_end_of_line_stops_the_cut(spark):
    df = spark.createDataFrame([("a feat b\nnext",)], "text string")
    assert df.select(normalize_title("text")).first()[0] == "a next"


def test_title_case_of_marks_and_digits(spark):
    df = spark.createDataFrame([("a1b c-d e.f",)], "text string")
    assert df.select(title_case(F.col("text"))).first()[0] == "A1b C-D E.F"


def test_decomposition_keeps_texts_as_arrow_strings(spark, monkeypatch):
    import unicodedata

    from crossfade.functions import text

    # a batch of Python objects takes several times the size of its texts
    monkeypatch.setattr(text.F, "pandas_udf", lambda *a: pytest.fail("texts as Python objects"))
    nfkd = text.nfkd

    letters = "".join(map(chr, range(0x80, 0xD7FF)))
    assigned = "".join(c for c in letters if unicodedata.category(c) != "Cn")
    texts = ["plain", None, "", "Ǆ ﬁ ½ e\u0323\u0301 e\u0301\u0323 가", assigned]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    found = [r[1] for r in df.select("id", nfkd("text")).orderBy("id").collect()]
    assert found == [t and unicodedata.normalize("NFKD", t) for t in texts]

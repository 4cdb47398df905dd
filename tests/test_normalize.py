import pytest
from pyspark.sql import functions as F

from termshard.functions import normalize as N
from termshard.functions import tokens as K

SAME = None
GOLDEN = [
    ("Baca https://x.id/a?b=1 sekarang!", "baca sekarang", SAME, SAME, SAME,
     "baca httpsxidab sekarang"),
    ('http://x.com"foo bar', "bar", "foo bar", "foo bar", SAME, "httpxcomfoo bar"),
    ("Halo @joséabc #Tag", "halo tag", SAME, SAME, SAME, "halo josabc tag"),
    ("covid-19 3d 1.000,50", "covid d", SAME, SAME, SAME, SAME),
    ("Jalan-jalan ke-kota", "jalan jalan ke kota", SAME, SAME, "ke kota", "jalanjalan kekota"),
    ("kejar-kejaran", "kejar kejaran", SAME, SAME, SAME, "kejarkejaran"),
    ("ABSTRAKPenelitian ini", "abstrakpenelitian ini", SAME, "abstrak penelitian ini", SAME, SAME),
    ("LatarBelakangMasalah", "latarbelakangmasalah", SAME, "latarbelakang masalah", SAME, SAME),
    ("JudulABSTRAKX", "judulabstrakx", SAME, "judul abstrak x", SAME, SAME),
    ("e-mail/web", "e mail web", SAME, SAME, SAME, "emailweb"),
    ("a\u00a0b", "a b", SAME, SAME, SAME, SAME),
    ("www.a.b\u00a0next", "next", SAME, SAME, SAME, "wwwab next"),
    ("", "", SAME, SAME, SAME, SAME),
    (None, "", SAME, SAME, SAME, SAME),
]
FORMS = ["plain", "quoted", "headed", "reduplicated", "query"]


def test_golden_forms(spark):
    df = spark.createDataFrame([(g[0],) for g in GOLDEN], "text string").coalesce(1)
    got = df.select(*[N.normalize(F.col("text"), f).alias(f) for f in FORMS]).collect()
    for golden, row in zip(GOLDEN, got):
        expected = [golden[1] if v is SAME else v for v in golden[1:]]
        assert list(row) == expected, golden[0]


def test_unknown_form_is_refused():
    with pytest.raises(ValueError):
        N.normalize(None, "shouting")


def test_noise_filter(spark):
    words = ["ab", "xyz", "baaa", "hmmm", "abc", "baa", "dan", "nan", "123"]
    df = spark.createDataFrame([(words,)], "tokens array<string>")
    kept = df.select(K.drop_noise(F.col("tokens"))).first()[0]
    assert kept == ["abc", "baa", "dan", "nan"]
    longer = df.select(K.drop_noise(F.col("tokens"), min_len=4)).first()[0]
    assert longer == []


def test_tokens_keep_order_and_repeats(spark):
    df = spark.createDataFrame([("b a b c",), ("",)], "text string").coalesce(1)
    rows = df.select(K.drop_words(K.split_words(F.col("text")), ["a"]).alias("t")).collect()
    assert [r.t for r in rows] == [["b", "b", "c"], []]
    assert df.select(K.drop_words(K.split_words(F.col("text")), [])).first()[0] == list("babc")

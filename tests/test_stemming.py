import pytest
from pyspark.sql import functions as F

from termshard.operators import stemming
from termshard.operators.stem_english import english_stem, shape
from termshard.operators.stem_indonesian import with_indonesian_stem

ENGLISH = """caresses caress flies fli dies die mules mule denied deni died die agreed agre
owned own humbled humbl sized size meeting meet stating state itemization item sensational
sensat traditional tradit reference refer colonizer colon plotted plot ponies poni ties tie
cats cat feed feed plastered plaster bled bled motoring motor sing sing conflated conflat
troubled troubl hopping hop tanned tan falling fall hissing hiss fizzed fizz failing fail
filing file happy happi sky sky relational relat conditional condit rational ration digitizer
digit radicalli radic differentli differ vietnamization vietnam operator oper hopefulness hope
formaliti formal sensibiliti sensibl triplicate triplic formative form electriciti electr
goodness good revival reviv allowance allow inference infer adjustable adjust replacement
replac adoption adopt communism commun effective effect probate probat rate rate cease ceas
controll control roll roll monitoring monitor dying die skies sky yes ye at at""".split()

INDONESIAN = """menyapu sapu memukul pukul diambilnya ambil pelajaran ajar membaca baca bermain
main belajar ajar makanan makan mengambil ambil menulis tulis pengiriman kirim mempermainkan main
kekasihku kasih bukulah buku memperbaiki baik dipertanyakan tanya berlari lari mengecat cat
perlakuan laku gerakan gerak dan dan xyzabc xyzabc kuambil ambil kauambil ambil idealisme ideal
normalisasi normal gerigi gigi kinerja kerja telunjuk tunjuk gemuruh guruh idealis ideal
kemuning kuning""".split()


def pairs(flat):
    return dict(zip(flat[::2], flat[1::2]))


def table(spark, words):
    return spark.createDataFrame([(w,) for w in words], "term string")


def test_english(spark):
    golden = pairs(ENGLISH)
    got = table(spark, golden).select("term", english_stem("term").alias("stem")).collect()
    assert {r["term"]: r["stem"] for r in got} == golden


def test_indonesian(spark):
    golden = pairs(INDONESIAN)
    roots = table(spark, set(golden.values()) - {"xyzabc"})
    got = with_indonesian_stem(table(spark, golden), roots, roots_fit=True).collect()
    assert {r["term"]: r["id_stem"] for r in got} == golden


@pytest.mark.parametrize("hot", [None, 0, 1, 1000])
def test_shuffled_roots_give_the_same(spark, hot):
    golden = pairs(INDONESIAN)
    roots = table(spark, set(golden.values()) - {"xyzabc"})
    got = with_indonesian_stem(table(spark, golden), roots, roots_fit=False, hot=hot).collect()
    assert {r["term"]: r["id_stem"] for r in got} == golden


def test_forms_that_many_words_share_are_not_shuffled(spark):
    """A short form of every word is one task's key in a plain join; here it comes by broadcast."""
    words = table(spark, [f"di{'abcdefghijklmnop'[i % 16]}{'xyz'[i % 3]}{i}an".replace("0", "o") for i in range(300)] + ["dimakan"])
    got = with_indonesian_stem(words, table(spark, ["makan"]), roots_fit=False, hot=2)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and got.filter("id_stem = 'makan'").count() == 1


def test_forbidden_pair_stays(spark):
    got = with_indonesian_stem(table(spark, ["diajaran"]), table(spark, ["ajar"]), True)
    assert got.first()["id_stem"] == "diajaran"


def test_hybrid_prefers_indonesian_then_english(spark):
    tokens = spark.createDataFrame(
        [(["makanan", "monitoring", "monitoring", "table"],)], "tokens array<string>"
    )
    terms = stemming.distinct_terms(tokens)
    stems = stemming.stem_map(terms, table(spark, ["makan"]), "hybrid").collect()
    assert {r["term"]: (r["stem"], r["uses"]) for r in stems} == {
        "makanan": ("makan", 1), "monitoring": ("monitor", 2), "table": ("table", 1),
    }
    with pytest.raises(ValueError):
        stemming.stem_map(terms, table(spark, []), "latin")


def test_runs_of_y_of_any_length(spark):
    """A y is a vowel after a consonant, letter by letter."""
    words = [a + "y" * n + z for n in range(1, 201) for a in ("", "b", "a") for z in ("", "s", "e")]

    def letters(word):
        out = ""
        for c in word:
            out += "V" if c in "aeiou" or (c == "y" and out.endswith("C")) else "C"
        return out

    rows = table(spark, words).selectExpr("term", f"{shape('term')} AS shape").collect()
    assert {r["term"]: r["shape"] for r in rows} == {w: letters(w) for w in words}

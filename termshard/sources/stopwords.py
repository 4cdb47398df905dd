"""Stop words: a base list and extra words from text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Common Indonesian function words; a caller may pass another base list.
INDONESIAN_STOP_WORDS = (
    "yang untuk pada ke para namun menurut antara dia dua ia seperti jika sehingga kembali "
    "dan tidak ini karena kepada oleh saat harus sementara setelah belum kami sekitar bagi "
    "serta di dari telah sebagai masih hal ketika adalah itu dalam bisa bahwa atau hanya kita "
    "dengan akan juga ada mereka sudah saya terhadap secara agar lain anda begitu mengapa "
    "kenapa yaitu yakni daripada itulah lagi maka tentang demi dimana kemana pula sambil "
    "sebelum sesudah supaya guna kah pun sampai sedangkan selagi tetapi apakah kecuali sebab "
    "selain seolah seraya seterusnya tanpa agak boleh dapat dsb dst dll dahulu dulunya anu "
    "demikian tapi ingin nggak mari nanti melainkan oh ok seharusnya sebetulnya setiap "
    "setidaknya sesuatu pasti saja toh ya walau tolong tentu amat apalagi bagaimanapun"
).split()


def words_table(spark: SparkSession, words) -> DataFrame:
    return spark.createDataFrame([(w,) for w in sorted(set(words))], "term string")


def read_word_file(spark: SparkSession, path) -> DataFrame:
    """One word per line, trimmed, lower-cased, blank lines skipped."""
    word = F.lower(F.regexp_replace("value", r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))
    return spark.read.text(path).select(word.alias("term")).filter("term != ''")


def stop_words(base: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """The base words and the extra ones, each once."""
    terms = base.select("term")
    return (terms.unionByName(extra.select("term")) if extra is not None else terms).distinct()


def spark_stop_words(spark: SparkSession, language: str) -> DataFrame:
    """One of the lists that come with Spark, e.g. ``english`` or ``german``."""
    from pyspark.ml.feature import StopWordsRemover

    return words_table(spark, StopWordsRemover.loadDefaultStopWords(language))

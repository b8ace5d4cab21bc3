"""Word vectors make their input once; cleaning keeps the characters it kept."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from marlstone.functions import text
from marlstone.operators import models


def test_word_vectors_make_their_rows_once(spark):
    """Counting, training and scoring read the words; cleaning them each time took half of the run."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def words(number):
        made.add(1)
        return [f"word{number % 3}", "and", "more"]

    table = spark.range(0, 60, numPartitions=2).select(F.col("id").alias("key"), words.asNondeterministic()("id").alias("words"))
    found = models.embed_text(table, method="word2vec", size=4)
    rows = found.select("key", vector_to_array("features").alias("v")).collect()
    assert made.value == 60
    assert sorted(r["key"] for r in rows) == list(range(60)) and all(len(r["v"]) == 4 and any(r["v"]) for r in rows)


def test_cleaning_drops_all_but_letters_and_blanks(spark):
    codes = [c for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000] + [0x1D400, 0x1F600]
    whole = "".join(f"{chr(c)}." for c in codes)
    kept = spark.createDataFrame([(whole,)], "x string").select(text._letters(F.col("x"))).first()[0]
    want = [c for c in map(chr, codes) if c.isascii() and c.isalpha() or c in text._SPACE_CHARACTERS]
    assert kept == "".join(want).lower()

"""Text operators that need more than one row or a lookup table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marlstone.functions.numbers import polarity

SENTIMENTS = ("negative", "neutral", "positive")


def explode_parallel(df: DataFrame, arrays: dict[str, str], check: bool = True) -> DataFrame:
    """Explode arrays side by side: ``arrays`` maps array column to output name.

    Rows with empty arrays give one row of nulls. With ``check`` a row whose
    arrays differ in length fails the query; without it the shorter is padded.
    """
    names = list(arrays)
    if check:
        first = names[0]
        uneven = F.lit(False)
        for other in names[1:]:
            uneven = uneven | (F.size(first) != F.size(other))
        # Checked inside the zipped expression, so the check cannot be pruned away.
        zipped = F.when(uneven, F.raise_error(F.lit("arrays differ in length"))).otherwise(
            F.arrays_zip(*names)
        )
    else:
        zipped = F.arrays_zip(*names)
    rest = [c for c in df.columns if c not in arrays]
    lines = df.select(*rest, F.explode_outer(zipped).alias("_item"))
    return lines.select(*rest, *[F.col("_item")[a].alias(out) for a, out in arrays.items()])


def explode_aspects(df: DataFrame, col: str, out: str = "aspect") -> DataFrame:
    """One row per text and aspect; texts without an aspect drop out."""
    # A plain explode would make the optimizer filter on the array's size at the
    # scan, and so repeat the expressions behind the array there.
    return df.withColumn(out, F.explode_outer(col)).drop(col).where(F.col(out).isNotNull())


def keyword_table(spark: SparkSession, aspects: Mapping[str, Sequence[str]]) -> DataFrame:
    """(aspect, keyword) of keywords given as a mapping; a table of any size does as well."""
    return spark.createDataFrame([(a, k) for a in aspects for k in aspects[a]], "aspect string, keyword string")


def tag_keywords(
    df: DataFrame, key: str, words: Column, keywords: DataFrame, longest: int, out: str = "aspects"
) -> DataFrame:
    """Add the sorted aspects that have a keyword among the words of each text.

    ``keywords`` (aspect, keyword) holds words or runs of up to ``longest`` words with
    single blanks between them; a longer one fails the query. The runs of a text are
    joined with that table, so that neither the plan nor the work for a text grows with the
    number of keywords, as ``text.tag_aspects`` does, which looks for one after the other.
    ``key`` is unique and not null. Null or empty texts and keywords match nothing.
    """
    held = df.select(F.col(key).alias("_key"), words.alias("_words"))

    def run_of(n: int) -> Column:
        # One too short, at the end of the text, only repeats a shorter run.
        return F.transform("_words", lambda _, i: F.array_join(F.slice("_words", i + 1, F.lit(n)), " "))

    runs = [F.col("_words"), *map(run_of, range(2, longest + 1))]
    lines = held.select("_key", F.explode(F.array_distinct(F.flatten(F.array(*runs)))).alias("_run"))
    size = F.size(F.split("keyword", " "))
    too_long = F.raise_error(F.lit(f"a keyword has more than {longest} words")).cast("string")
    table = keywords.where("keyword <> ''").select(
        "aspect", F.when(size > longest, too_long).otherwise(F.col("keyword")).alias("_run")
    )
    met = lines.join(table.distinct(), "_run").groupBy("_key").agg(F.array_sort(F.collect_set("aspect")).alias(out))
    tagged = df.join(met, df[key] == met["_key"], "left").drop("_key")
    return tagged.withColumn(out, F.coalesce(out, F.array().cast("array<string>")))


def lexicon_sentiment(
    df: DataFrame,
    key: str,
    words: Column,
    lexicon: DataFrame,
    keep: Sequence[str] = (),
    alpha: float = 15.0,
) -> DataFrame:
    """(key, keep..., compound, sentiment) from the valence of each text's words.

    ``lexicon`` is (token, valence) with unique tokens. The compound score is
    ``s / sqrt(s^2 + alpha)`` for the valence sum ``s`` (Hutto and Gilbert 2014).
    The words of one text are combined in the task that exploded them, so only
    one short row per text is shuffled. ``key`` is unique per text, so grouping
    by the kept columns as well changes nothing and keeps the aggregate hashed.
    """
    lookup = lexicon.select("token", F.col("valence").cast("double"))
    exploded = df.select(key, *keep, F.explode_outer(words).alias("token"))
    scored = exploded.join(lookup, "token", "left")
    valence = F.coalesce(F.sum("valence"), F.lit(0.0))
    sums = scored.groupBy(key, *keep).agg(valence.alias("_s"))
    compound = F.col("_s") / F.sqrt(F.col("_s") * F.col("_s") + alpha)
    sums = sums.withColumn("compound", F.round(compound, 4)).drop("_s")
    return sums.withColumn("sentiment", polarity(F.col("compound")))


def lemmatize(
    df: DataFrame,
    key: str,
    words: Column,
    lemmas: DataFrame,
    out: str = "lemma_text",
    keep: Sequence[str] = (),
) -> DataFrame:
    """(key, keep..., out): every word replaced by its lemma where ``lemmas`` (token, lemma) has one.

    Words come back in their old order. One group is one text; ``key`` is unique per text.
    """
    lookup = lemmas.select("token", "lemma")
    placed = df.select(key, *keep, F.posexplode_outer(words).alias("_pos", "token"))
    mapped = placed.join(lookup, "token", "left")
    item = F.struct("_pos", F.coalesce("lemma", "token").alias("word"))
    texts = mapped.groupBy(key, *keep).agg(F.sort_array(F.collect_list(item)).alias("_items"))
    return texts.select(key, *keep, F.concat_ws(" ", F.transform("_items", lambda x: x["word"])).alias(out))


def replace_words(
    df: DataFrame, key: str, words: Column, lemmas: DataFrame, out: str = "lemma_text", copies: str | None = None
) -> DataFrame:
    """``df`` with ``out``, its words with each replaced by its lemma, as ``lemmatize`` does.

    Only the distinct words of a text travel to the lookup, and only those that ``lemmas``
    (token, lemma) has come back; the text and the other columns are joined to them once.
    ``key`` is unique and not null. Every word is repeated as often as the column ``copies`` says.
    """
    held = df.select(F.col(key).alias("_key"), words.alias("_words"))
    lines = held.select("_key", F.explode(F.array_distinct("_words")).alias("token"))
    # A word with several lemmas stands for all of them.
    lemma = F.coalesce("lemma", "token")
    lookup = lemmas.groupBy("token").agg(F.sort_array(F.collect_list(lemma)).alias("_own"))
    met = lines.join(lookup, "token").groupBy("_key").agg(
        F.map_from_entries(F.collect_list(F.struct("token", "_own"))).alias("_met")
    )
    found = df.join(met, df[key] == met["_key"], "left").drop("_key")
    times = F.lit(1) if copies is None else F.col(copies)

    def replaced(word: Column) -> Column:
        own = F.coalesce(F.try_element_at("_met", word), F.array(word))
        return F.flatten(F.transform(own, lambda x: F.array_repeat(x, times)))

    plain = F.col("_met").isNull() & (times == 1)
    new = F.when(plain, words).otherwise(F.flatten(F.transform(words, replaced)))
    return found.withColumn(out, F.concat_ws(" ", new)).drop("_met")


def top_terms(df: DataFrame, group: str, words: Column, n: int = 200) -> DataFrame:
    """(group, term, freq, rank): the n most frequent words of each group.

    Counted with map-side combine; the rank limit is applied before the
    shuffle as well, so no task receives a group's whole vocabulary.
    """
    terms = df.select(group, F.explode(words).alias("term"))
    counts = terms.groupBy(group, "term").agg(F.count(F.lit(1)).alias("freq"))
    # First per slice of the vocabulary, then over the slices' winners.
    order = [F.desc("freq"), F.asc("term")]
    sliced = counts.withColumn("_slice", F.pmod(F.xxhash64("term"), F.lit(64)))
    local = Window.partitionBy(group, "_slice").orderBy(*order)
    winners = sliced.withColumn("rank", F.row_number().over(local)).where(F.col("rank") <= n)
    overall = Window.partitionBy(group).orderBy(*order)
    ranked = winners.drop("_slice").withColumn("rank", F.row_number().over(overall))
    return ranked.where(F.col("rank") <= n)


def aspect_sentiment_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("aspect", "sentiment").agg(F.count(F.lit(1)).alias("n"))


def aspect_sentiment_by_entity(df: DataFrame) -> DataFrame:
    """(entity, aspect) with one count column per sentiment."""
    counts = [
        F.count_if(F.col("sentiment") == sentiment).alias(sentiment) for sentiment in SENTIMENTS
    ]
    return df.groupBy("entity", "aspect").agg(*counts)


def unmatched_rate(df: DataFrame, col: str) -> DataFrame:
    """Number of texts with and without an entry in an array column."""
    counts = df.groupBy((F.size(col) == 0).alias("unmatched")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)

"""News texts to aspect sentiment: explode, clean, classify, tag, score, count."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.text import (
    CLIMATE_ASPECTS,
    SENTIMENT_LABELS,
    SPECIFICITY_LABELS,
    normalize,
    tag_aspects,
)
from marlstone.operators.models import score_rows
from marlstone.operators.text_ops import (
    aspect_sentiment_by_entity,
    aspect_sentiment_counts,
    explode_aspects,
    explode_parallel,
    lexicon_sentiment,
    replace_words,
)
from marlstone.session import stable


def labelled_texts(news: DataFrame, wanted: str) -> DataFrame:
    """(entity, text) of the articles with the wanted label, a row per article.

    ``news``: entity, labels array<string>, articles array<struct<description>>
    of equal lengths.
    """
    lines = explode_parallel(news, {"labels": "label", "articles": "article"})
    kept = lines.where(F.col("label") == wanted)
    text = F.coalesce(F.col("article.description"), F.lit(""))
    return kept.withColumn("text", text).drop("article", "label")


def aspect_sentiment(
    texts: DataFrame,
    key: str,
    lexicon: DataFrame,
    aspects: Mapping[str, Sequence[str]] = CLIMATE_ASPECTS,
    mode: str = "substring",
) -> DataFrame:
    """(key, entity, aspect, compound, sentiment): one row per text and aspect.

    The words of texts without an aspect are not scored; only the key, the
    entity and the aspect list travel with the scores.
    """
    clean = texts.withColumn("clean_text", normalize(F.col("text")))
    tagged = clean.withColumn("aspects", tag_aspects(F.col("clean_text"), aspects, mode))
    # Not a filter: pushed down, it would repeat the cleaning for every keyword.
    words = F.when(F.size("aspects") > 0, F.split("clean_text", " "))
    scored = lexicon_sentiment(tagged, key, words, lexicon, keep=["entity", "aspects"])
    return explode_aspects(scored, "aspects")


def classified_aspects(
    texts: DataFrame,
    key: str,
    relevant: Callable[[DataFrame], DataFrame],
    specificity: Callable,
    stance: Callable,
    lexicon: DataFrame,
    lemmas: DataFrame,
    aspects: Mapping[str, Sequence[str]] = CLIMATE_ASPECTS,
    stances: Mapping[int, str] = SENTIMENT_LABELS,
) -> DataFrame:
    """(key, entity, specific, sentiment_label, aspect, compound, sentiment): the whole flow.

    Texts are cleaned; ``relevant`` keeps those about the subject, given ``words`` and
    ``clean_text`` (such as ``models.classify_text`` with a fitted model). Two
    user-supplied scorers (see ``models.score_rows``) read the text that is left: one says
    whether it is ``specific``, one gives its ``sentiment_label``. Aspects are tagged in the
    lemmas, polarity comes from the lexicon, and every aspect of a text is a row.
    """
    clean = texts.withColumn("clean_text", normalize(F.col("text")))
    kept = relevant(clean.withColumn("words", F.split("clean_text", " ")))
    kept = kept.select(key, "entity", "text", "clean_text")
    scored = score_rows(kept, "text", specificity, SPECIFICITY_LABELS, "specific")
    scored = score_rows(scored, "text", stance, stances, "sentiment_label")
    marks = ["entity", "specific", "sentiment_label"]
    # Stored, as the lookups read it several times; no row of a word holds its text.
    kept = scored.select(key, *marks, "clean_text").withColumn("_row", F.monotonically_increasing_id())
    kept = stable(kept)
    words = F.split("clean_text", " ")
    # Copies of a row count as one, whose lemmas repeat.
    same = kept.groupBy(key, *marks, F.md5("clean_text").alias("_text"))
    same = same.agg(F.min("_row").alias("_row"), F.count(F.lit(1)).cast("int").alias("_copies"))
    once = kept.join(same.select("_row", "_copies"), "_row")
    lemma = replace_words(once, "_row", words, lemmas, copies="_copies")
    tagged = lemma.select(key, *marks, "clean_text", tag_aspects(F.col("lemma_text"), aspects).alias("aspects"))
    rated = lexicon_sentiment(tagged, key, words, lexicon, keep=[*marks, "aspects"])
    return explode_aspects(rated, "aspects")


def dashboard_tables(aspects: DataFrame) -> dict[str, DataFrame]:
    """The tables behind the two dashboard charts."""
    return {
        "overall": aspect_sentiment_counts(aspects),
        "by_entity": aspect_sentiment_by_entity(aspects),
    }

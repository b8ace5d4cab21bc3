"""Queries of the text domain."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.catalog.bindings import (
    CORPUS_ASPECTS,
    LEMMAS,
    LEXICON,
    NEWS,
    TEXTS,
    Tables,
    aspects_sql,
    clean_sql,
    kept_words_sql,
    with_,
    words_sql,
)
from marlstone.catalog.registry import Registry
from marlstone.functions.text import (
    CLIMATE_ASPECTS,
    clean_text,
    extract_field,
    lengths_match,
    remove_stopwords,
    tag_aspects,
    tokens,
)
from marlstone.operators import grouping, text_ops
from marlstone.plans import news as plan
from marlstone.session import scratch_path
from marlstone.sources import files

QUERIES = Registry()


@QUERIES.add("cleaned_documents", f"SELECT doc_id, {clean_sql('text')} AS clean_text FROM documents")
def cleaned_documents(t: Tables):
    return t.raw("documents").select("doc_id", clean_text(F.col("text")).alias("clean_text"))


@QUERIES.add(
    "document_tokens",
    f"""SELECT doc_id, CAST(len(w) AS INTEGER) AS n_words, array_to_string(w, '|') AS words
        FROM (SELECT doc_id, {words_sql('text')} AS w FROM documents)""",
)
def document_tokens(t: Tables):
    words = t.raw("documents").select("doc_id", tokens(clean_text(F.col("text"))).alias("w"))
    return words.select("doc_id", F.size("w").alias("n_words"), F.concat_ws("|", "w").alias("words"))


@QUERIES.add(
    "words_without_stopwords",
    f"""SELECT doc_id, CAST(len(w) AS INTEGER) AS n_words, array_to_string(w, '|') AS words
        FROM (SELECT doc_id, {kept_words_sql('text')} AS w FROM documents)""",
)
def words_without_stopwords(t: Tables):
    kept = remove_stopwords(tokens(clean_text(F.col("text"))))
    words = t.raw("documents").select("doc_id", kept.alias("w"))
    return words.select("doc_id", F.size("w").alias("n_words"), F.concat_ws("|", "w").alias("words"))


@QUERIES.add("normalized_documents", with_(TEXTS) + "SELECT doc_id, clean_text FROM texts")
def normalized_documents(t: Tables):
    return t.texts.select("doc_id", "clean_text")


@QUERIES.add(
    "article_text_field",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type ELSE json_extract_string(props, '$.k') END
         AS extracted FROM events""",
)
def article_text_field(t: Tables):
    mixed = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("props"))
    return t.raw("events").select("event_id", extract_field(mixed, "k").alias("extracted"))


@QUERIES.add(
    "brace_texts",
    """SELECT event_id, CASE WHEN json_valid(x) AND json_type(x) = 'OBJECT'
         THEN coalesce(json_extract_string(x, '$.k'), '') ELSE x END AS extracted
       FROM (SELECT event_id, CASE event_id % 6 WHEN 0 THEN '{' || event_type || '} news today'
           WHEN 1 THEN props || ' trailing' WHEN 2 THEN '{' WHEN 3 THEN event_type
           WHEN 4 THEN '  {"other": 1}' ELSE props END AS x FROM events)""",
)
def brace_texts(t: Tables):
    """Objects, and plain texts that begin with a brace."""
    kind, name = F.col("event_id") % 6, F.col("event_type")
    mixed = (
        F.when(kind == 0, F.concat(F.lit("{"), name, F.lit("} news today")))
        .when(kind == 1, F.concat("props", F.lit(" trailing")))
        .when(kind == 2, "{")
        .when(kind == 3, name)
        .when(kind == 4, '  {"other": 1}')
        .otherwise(F.col("props"))
    )
    return t.raw("events").select("event_id", extract_field(mixed, "k").alias("extracted"))


@QUERIES.add(
    "array_length_match",
    with_(NEWS)
    + """SELECT conv_id % 4 <> 0 OR n = 1 AS length_match, count(*) AS n FROM (
           SELECT conv_id, count(*) AS n FROM news GROUP BY conv_id) GROUP BY 1""",
)
def array_length_match(t: Tables):
    # Every fourth record keeps one label only.
    labels = F.when(F.col("conv_id") % 4 == 0, F.slice("labels", 1, 1)).otherwise(F.col("labels"))
    uneven = t.news.withColumn("labels", labels)
    match = lengths_match(F.col("labels"), F.col("articles"))
    return uneven.groupBy(match.alias("length_match")).agg(F.count(F.lit(1)).alias("n"))


@QUERIES.add(
    "exploded_articles",
    with_(NEWS) + "SELECT conv_id, entity, label, description FROM news",
)
def exploded_articles(t: Tables):
    lines = text_ops.explode_parallel(t.news, {"labels": "label", "articles": "article"})
    return lines.select("conv_id", "entity", "label", F.col("article.description").alias("description"))


@QUERIES.add(
    "labelled_articles",
    with_(NEWS) + "SELECT conv_id, entity, description AS text FROM news WHERE label = 'assistant'",
)
def labelled_articles(t: Tables):
    return plan.labelled_texts(t.news, "assistant")


def _tagged_sql(aspects: dict, mode: str) -> str:
    return with_(TEXTS) + f"""SELECT doc_id, CAST(len(a) AS INTEGER) AS n_aspects,
      array_to_string(a, ',') AS aspects FROM (
        SELECT doc_id, {aspects_sql('clean_text', aspects, mode)} AS a FROM texts)"""


def _tagged(t: Tables, aspects: dict, mode: str):
    found = tag_aspects(F.col("clean_text"), aspects, mode)
    tagged = t.texts.select("doc_id", found.alias("a"))
    return tagged.select("doc_id", F.size("a").alias("n_aspects"), F.concat_ws(",", "a").alias("aspects"))


@QUERIES.add("climate_aspects", _tagged_sql(CLIMATE_ASPECTS, "substring"))
def climate_aspects(t: Tables):
    return _tagged(t, CLIMATE_ASPECTS, "substring")


@QUERIES.add("climate_aspects_whole_words", _tagged_sql(CLIMATE_ASPECTS, "word"))
def climate_aspects_whole_words(t: Tables):
    return _tagged(t, CLIMATE_ASPECTS, "word")


@QUERIES.add("climate_aspects_by_table", _tagged_sql(CLIMATE_ASPECTS, "word"))
def climate_aspects_by_table(t: Tables):
    """The same as whole words, by a join with the keywords."""
    texts = t.texts.select("doc_id", F.split("clean_text", " ").alias("words"))
    keywords = text_ops.keyword_table(t.spark, CLIMATE_ASPECTS)
    tagged = text_ops.tag_keywords(texts, "doc_id", F.col("words"), keywords, 3, "a")
    return tagged.select("doc_id", F.size("a").alias("n_aspects"), F.concat_ws(",", "a").alias("aspects"))


@QUERIES.add("corpus_aspects", _tagged_sql(CORPUS_ASPECTS, "substring"))
def corpus_aspects(t: Tables):
    return _tagged(t, CORPUS_ASPECTS, "substring")


@QUERIES.add(
    "texts_without_aspect",
    with_(TEXTS)
    + f"""SELECT unmatched, n, CAST(n AS DOUBLE) / (SELECT count(*) FROM texts) AS share FROM (
            SELECT len({aspects_sql('clean_text', CLIMATE_ASPECTS)}) = 0 AS unmatched, count(*) AS n
            FROM texts GROUP BY 1)""",
)
def texts_without_aspect(t: Tables):
    tagged = t.texts.select("doc_id", tag_aspects(F.col("clean_text")).alias("aspects"))
    return text_ops.unmatched_rate(tagged, "aspects")


# Valences are whole numbers, so their sums are exact in any order.
_SENTIMENT = """sentiment AS (
  SELECT doc_id, entity, clean_text, compound,
         CASE WHEN compound >= 0.05 THEN 'positive' WHEN compound <= -0.05 THEN 'negative'
              ELSE 'neutral' END AS sentiment
  FROM (SELECT doc_id, entity, clean_text, round(s / sqrt(s * s + 15), 4) AS compound FROM (
    SELECT doc_id, any_value(entity) AS entity, any_value(clean_text) AS clean_text,
           coalesce(sum(valence), 0) AS s
    FROM (SELECT doc_id, entity, clean_text, unnest(string_split(clean_text, ' ')) AS token FROM texts)
         LEFT JOIN lexicon USING (token) GROUP BY doc_id)))"""

_ASPECT_ROWS = f"""aspect_rows AS (
  SELECT doc_id, entity, unnest({aspects_sql('clean_text', CORPUS_ASPECTS)}) AS aspect, compound, sentiment
  FROM sentiment)"""


@QUERIES.add(
    "lexicon_sentiment",
    with_(TEXTS, LEXICON, _SENTIMENT) + "SELECT doc_id, entity, compound, sentiment FROM sentiment",
)
def lexicon_sentiment(t: Tables):
    words = F.split("clean_text", " ")
    return text_ops.lexicon_sentiment(t.texts, "doc_id", words, t.lexicon, keep=["entity"])


@QUERIES.add(
    "lemmatized_documents",
    with_(TEXTS, LEMMAS)
    + """SELECT doc_id, string_agg(coalesce(lemma, token), ' ' ORDER BY pos) AS lemma_text FROM (
           SELECT doc_id, unnest(string_split(clean_text, ' ')) AS token,
                  generate_subscripts(string_split(clean_text, ' '), 1) AS pos FROM texts)
         LEFT JOIN lemmas USING (token) GROUP BY doc_id""",
)
def lemmatized_documents(t: Tables):
    return text_ops.lemmatize(t.texts, "doc_id", F.split("clean_text", " "), t.lemmas)


def _aspect_rows(t: Tables):
    return plan.aspect_sentiment(t.texts, "doc_id", t.lexicon, CORPUS_ASPECTS)


@QUERIES.add(
    "aspect_sentiment",
    with_(TEXTS, LEXICON, _SENTIMENT, _ASPECT_ROWS) + "SELECT * FROM aspect_rows",
)
def aspect_sentiment(t: Tables):
    return _aspect_rows(t)


@QUERIES.add(
    "aspect_sentiment_counts",
    with_(TEXTS, LEXICON, _SENTIMENT, _ASPECT_ROWS)
    + "SELECT aspect, sentiment, count(*) AS n FROM aspect_rows GROUP BY aspect, sentiment",
)
def aspect_sentiment_counts(t: Tables):
    return text_ops.aspect_sentiment_counts(_aspect_rows(t))


@QUERIES.add(
    "aspect_sentiment_by_entity",
    with_(TEXTS, LEXICON, _SENTIMENT, _ASPECT_ROWS)
    + """SELECT entity, aspect, count(*) FILTER (sentiment = 'negative') AS negative,
           count(*) FILTER (sentiment = 'neutral') AS neutral,
           count(*) FILTER (sentiment = 'positive') AS positive FROM aspect_rows GROUP BY entity, aspect""",
)
def aspect_sentiment_by_entity(t: Tables):
    return text_ops.aspect_sentiment_by_entity(_aspect_rows(t))


@QUERIES.add(
    "aspects_by_total",
    with_(TEXTS, LEXICON, _SENTIMENT, _ASPECT_ROWS)
    + """SELECT aspect, sentiment, n, CAST(sum(n) OVER (PARTITION BY aspect) AS BIGINT) AS total FROM (
           SELECT aspect, sentiment, count(*) AS n FROM aspect_rows GROUP BY aspect, sentiment)""",
)
def aspects_by_total(t: Tables):
    counts = text_ops.aspect_sentiment_counts(_aspect_rows(t))
    return grouping.order_by_total(counts, "aspect", "n")


@QUERIES.add(
    "default_entity",
    with_(TEXTS, LEXICON, _SENTIMENT, _ASPECT_ROWS)
    + "SELECT entity FROM aspect_rows ORDER BY aspect, sentiment, entity LIMIT 1",
)
def default_entity(t: Tables):
    return grouping.first_group(_aspect_rows(t), ["aspect", "sentiment", "entity"], "entity")


def _by_length(classes: int):
    """A stand-in scorer of texts: the class is the length modulo ``classes``."""

    def make():
        import numpy as np

        def scorer(batch):
            at = np.array([len(text) % classes for text in batch])
            return (at[:, None] == np.arange(classes)).astype("float64")

        return scorer

    return make


@QUERIES.add(
    "classified_aspects",
    with_(
        TEXTS.replace("FROM documents", "FROM documents WHERE length(text) % 5 <> 0"),
        LEXICON,
        LEMMAS,
        _SENTIMENT,
        """lemma_texts AS (
          SELECT doc_id, string_agg(coalesce(lemma, token), ' ' ORDER BY pos) AS lemma_text FROM (
            SELECT doc_id, unnest(string_split(clean_text, ' ')) AS token,
                   generate_subscripts(string_split(clean_text, ' '), 1) AS pos FROM texts)
          LEFT JOIN lemmas USING (token) GROUP BY doc_id)""",
    )
    + f"""SELECT doc_id, s.entity, unnest({aspects_sql('lemma_text', CORPUS_ASPECTS)}) AS aspect,
            CASE length(text) % 2 WHEN 1 THEN 'yes' ELSE 'no' END AS specific,
            CASE length(text) % 3 WHEN 0 THEN 'risk' WHEN 1 THEN 'neutral' ELSE 'opportunity' END
              AS sentiment_label, compound, sentiment
          FROM sentiment s JOIN lemma_texts USING (doc_id) JOIN texts USING (doc_id)""",
)
def classified_aspects(t: Tables):
    """Relevance, scorers, lemmas, aspects and polarity, with rules in place of models."""
    texts = t.raw("documents").select("doc_id", F.col("source").alias("entity"), "text")
    return plan.classified_aspects(
        texts, "doc_id", lambda df: df.where(F.length("text") % 5 != 0),
        _by_length(2), _by_length(3), t.lexicon, t.lemmas, CORPUS_ASPECTS,
    )


@QUERIES.add(
    "dashboard_report",
    with_(TEXTS, LEXICON, _SENTIMENT, _ASPECT_ROWS)
    + "SELECT aspect, sentiment, count(*) AS n FROM aspect_rows GROUP BY aspect, sentiment",
)
def dashboard_report(t: Tables):
    path = scratch_path(t.spark, "report")
    files.write_report(plan.dashboard_tables(_aspect_rows(t)), path)
    return t.spark.read.schema("aspect string, sentiment string, n long").json(f"{path}/overall")


@QUERIES.add(
    "top_terms",
    with_(TEXTS)
    + """SELECT lang, term, freq, CAST(rank AS INTEGER) AS rank FROM (
           SELECT lang, term, freq, row_number() OVER (PARTITION BY lang ORDER BY freq DESC, term) AS rank
           FROM (SELECT lang, term, count(*) AS freq FROM (
             SELECT lang, unnest(regexp_extract_all(clean_text, '[a-z]+')) AS term FROM texts)
           GROUP BY lang, term)) WHERE rank <= 200""",
)
def top_terms(t: Tables):
    return text_ops.top_terms(t.texts, "lang", tokens(F.col("clean_text")), 200)

"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.centroids import centroid_clusters
from marlstone.llm.knn import top_k_inner_product
from marlstone.llm.language import LanguageModel, fit_languages, identify_languages
from marlstone.llm.licenses import PHRASES, TEMPLATES, license_scan, needed, words_of
from marlstone.llm.mixing import mix_sources
from marlstone.llm.packing import pack_documents
from marlstone.llm.prefix_trie import conversation_trie
from marlstone.llm.quality import QualityModel, fit_quality, score_quality
from marlstone.llm.sharding import shard_by_bytes
from marlstone.llm.simhash import simhash_groups
from marlstone.llm.token_counts import count_tokens
from marlstone.llm.vector_dedup import near_duplicate_vectors
from marlstone.llm.wrappers import extract_articles

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


LICENSE_THRESHOLD = 0.9
LICENSE_WINDOW = 48


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(
        _table(spark, sf_dir, "documents"), threshold=LICENSE_THRESHOLD, window=LICENSE_WINDOW
    )


def _op1_sql() -> str:
    """Every block of every text against every template."""

    def place(words: list[str]) -> str:
        return " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(words))

    def sql_list(words) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    phrases = {label: place(words_of(phrase)) for phrase, label in PHRASES.items()}
    places = " OR ".join(f"({p})" for p in phrases.values())
    bases = ", ".join(
        f"CASE WHEN len(list_filter(range(1, len(w) + 1), lambda i: {p})) > 0 THEN '{label}' END"
        for label, p in phrases.items()
    )
    sets = [(label, sorted(set(words_of(text)))) for label, text in TEMPLATES]
    templates = ", ".join(
        f"('{label}', {sql_list(words)}, {needed(len(words), LICENSE_THRESHOLD)})"
        for label, words in sets
    )
    half = LICENSE_WINDOW // 2
    return f"""
WITH t(label, words, need) AS (VALUES {templates}), d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), p AS (
  SELECT doc_id, w, list_filter(range(1, len(w) + 1), lambda i: {places}) AS places,
    list_filter([{bases}], lambda x: x IS NOT NULL) AS base
  FROM d
), b AS (
  SELECT doc_id, list_distinct(w[b * {half} + 1 : b * {half} + {LICENSE_WINDOW}]) AS own
  FROM (SELECT doc_id, w, unnest(range(0, (len(w) + {half - 1}) // {half})) AS b FROM d)
), m AS (
  SELECT doc_id, list(DISTINCT label) AS found, max(shared / size) AS part
  FROM (SELECT doc_id, label, need, len(words) AS size, len(list_intersect(own, words)) AS shared
        FROM b, t)
  WHERE shared >= need GROUP BY doc_id
)
SELECT p.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
  list_min(places) - 1 AS first_word, list_max(places) - 1 AS last_word,
  array_to_string(list_sort(base), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, coalesce(found, [])))), ',') AS labels,
  CAST(CASE WHEN len(places) > 0 THEN 1 ELSE coalesce(part, 0) END AS DOUBLE) AS score
FROM p LEFT JOIN m USING (doc_id)
"""


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).drop("row")


def _remainder(divisor: int) -> Column:
    """crc32 of the id as text, by which rows are held out."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


LANGUAGE_HELD_OUT = 2
QUALITY_HELD_OUT = 0
QUALITY_THRESHOLD = 0.3


def language_model(documents: DataFrame) -> LanguageModel:
    return fit_languages(documents.where(_remainder(4) != LANGUAGE_HELD_OUT))


def quality_model(documents: DataFrame, labels: DataFrame) -> QualityModel:
    return fit_quality(documents, labels.where(_remainder(5) != QUALITY_HELD_OUT))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    found = identify_languages(documents, language_model(documents))
    return found.withColumn("held_out", _remainder(4) == LANGUAGE_HELD_OUT)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = quality_model(documents, _table(spark, sf_dir, "labels"))
    found = score_quality(documents, model, threshold=QUALITY_THRESHOLD)
    return found.withColumn("held_out", _remainder(5) == QUALITY_HELD_OUT)


def op5_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


_OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), found AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
       f.component_id, e.vec_id = f.component_id AS kept
FROM embeddings e JOIN found f USING (vec_id)
"""


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_inner_product(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


_OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND q.vec_id % 20 = 0 AND len(q.e) = len(c.e)
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
    AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shard_by_bytes(_table(spark, sf_dir, "documents"))
    return sharded.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "fingerprint", "component_id")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(_table(spark, sf_dir, "embeddings"))


def _op11_sql(k: int = 40, rounds: int = 5) -> str:
    """The rounds spelt out one after the other."""

    def assigned(at: int) -> str:
        return f"""
a{at} AS MATERIALIZED (
  SELECT vec_id, v, arg_min(cluster, distance * {k} + cluster) AS cluster, min(distance) AS distance
  FROM (SELECT vec_id, v, cluster, row, CAST(list_sum(list_transform(range(1, 65),
          lambda i: (v[i] - c[i]) * (v[i] - c[i]))) AS BIGINT) AS distance FROM kept, c{at})
  GROUP BY vec_id, v, row
)"""

    def moved(at: int) -> str:
        return f"""
s{at} AS (
  SELECT cluster, i, CAST(floor((sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*))
    AS BIGINT) AS x FROM (SELECT cluster, v, unnest(range(1, 65)) AS i FROM a{at}) GROUP BY cluster, i
), c{at + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(n.c, o.c) AS c FROM c{at} o
  LEFT JOIN (SELECT cluster, list(x ORDER BY i) AS c FROM s{at} GROUP BY cluster) n USING (cluster)
)"""

    steps = ", ".join(f"{assigned(at)}, {moved(at)}" for at in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS row,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS cluster, v AS c FROM kept
  QUALIFY cluster < {k}
), {steps}, {assigned(rounds)}, i AS (
  SELECT cluster, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM a{rounds} GROUP BY cluster
)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, cluster_inertia,
  (SELECT CAST(sum(cluster_inertia) AS BIGINT) FROM i) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN i USING (cluster) JOIN c{rounds} USING (cluster)
"""


def op12_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_articles(_table(spark, sf_dir, "pages"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(_table(spark, sf_dir, "conversations"))


_OP13_SQL = r"""
WITH own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), hashed AS (
  SELECT conv_id, turns, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
    lambda c, x: list_reduce(list_prepend(xor(c, x), [CAST(0 AS BIGINT) FOR i IN range(8)]),
      lambda d, y: xor(d >> 1, 3988292384 * (d & 1))))) % 4 AS h
  FROM own
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1 : c.h], c.turns[c.h + 1 :]) AS turns
  FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20
), paths AS (
  SELECT conv_id, depth, len(turns) = depth AS ended, turns[1 : depth] AS prefix
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt)
), nodes AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(array_to_string(coalesce(list(conv_id ORDER BY conv_id) FILTER (ended), []), ','))
      AS ends_sha256
  FROM paths GROUP BY depth, prefix
), members AS (
  SELECT p.conv_id AS member, n.conv_id, depth FROM paths p JOIN nodes n USING (depth, prefix)
), linked AS (
  SELECT n.*, m.conv_id AS parent_conv_id FROM nodes n
  LEFT JOIN members m ON m.member = n.conv_id AND m.depth = n.depth - 1
), valued AS (
  SELECT l.*, coalesce(n, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1)
    * len(regexp_extract_all(prefix[depth].t, '[^ 	-
]+')) END AS saved
  FROM linked l LEFT JOIN (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n
    FROM linked WHERE depth > 0 GROUP BY ALL) USING (conv_id, depth)
), totals AS (
  SELECT m.conv_id, m.depth, count(*) FILTER (v.n_children = 0) AS n_leaves, sum(v.saved) AS saved
  FROM valued v JOIN members m ON m.member = v.conv_id AND m.depth <= v.depth GROUP BY ALL
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
  CAST(t.saved AS BIGINT) AS saved_tokens, ends_sha256
FROM valued v JOIN totals t USING (conv_id, depth)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_mixing": op2_mixing,
    "op3_language": op3_language,
    "op4_quality": op4_quality,
    "op5_vector_dedup": op5_vector_dedup,
    "op6_top_k": op6_top_k,
    "op7_token_counts": op7_token_counts,
    "op8_sharding": op8_sharding,
    "op9_simhash": op9_simhash,
    "op10_packing": op10_packing,
    "op11_centroids": op11_centroids,
    "op12_html": op12_html,
    "op13_prefix_trie": op13_prefix_trie,
}

SQL: dict[str, str] = {
    "op1_license_scan": _op1_sql(),
    "op5_vector_dedup": _OP5_SQL,
    "op6_top_k": _OP6_SQL,
    "op11_centroids": _op11_sql(),
    "op13_prefix_trie": _OP13_SQL,
}

"""Language identification with several TF-IDF n-gram centroids per language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

UNKNOWN = "und"
#: N-grams of 1 to 3 letters, hashed.
ORDERS = (1, 2, 3)
BUCKETS = 1 << 13
#: Characters of a text that are counted at once.
CHUNK = 1 << 20


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Hashed counts of a whole text's n-grams; None if it has no letter.

    Letters are lower-cased, and every run of other characters is one space. Very
    long texts are counted in chunks; the last two letters and whether a run is open go
    on into the next one, so that the size of the chunks changes nothing.
    """
    if not text:
        return None
    counts, some = np.zeros(BUCKETS), False
    whole = f" {text.lower()} "
    carried, in_word = np.zeros(0, dtype=np.uint32), True
    for at in range(0, len(whole), CHUNK):
        part = whole[at : at + CHUNK].encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(part, dtype="<u4")
        known = _letters()[codes]
        some |= bool(known.any())
        # Of a run of other characters the first stays, as a space.
        kept = known.copy()
        kept[1:] |= known[:-1]
        kept[0] |= in_word
        in_word = bool(known[-1])
        codes = np.concatenate([carried, np.where(known, codes, np.uint32(32))[kept]])
        mixed = np.zeros(len(codes), dtype=np.uint32)
        for n in ORDERS:
            if len(codes) < n:
                break
            mixed = mixed[: len(codes) - n + 1] * np.uint32(1_000_003) + codes[n - 1 :] + np.uint32(n)
            # What lies within the carried letters is counted already.
            new = mixed[max(0, len(carried) - n + 1) :]
            slots = (new * np.uint32(2_654_435_761)) >> np.uint32(32 - 13)
            counts += np.bincount(slots, minlength=BUCKETS)
        carried = codes[-(ORDERS[-1] - 1) :]
    return counts if some else None


def unit_vectors(texts, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised TF-IDF vectors, and which of the texts have one."""
    rows = np.zeros((len(texts), BUCKETS), dtype=np.float32)
    known = np.zeros(len(texts), dtype=bool)
    for i, text in enumerate(texts):
        counts = ngram_counts(text)
        if counts is not None:
            weighted = np.log1p(counts) * idf
            rows[i] = weighted / np.sqrt(weighted @ weighted)
            known[i] = True
    return rows, known


def cluster(vectors: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from farthest starts: unit centroids, and the cluster of each vector."""
    chosen = [vectors.mean(axis=0)]
    for _ in range(min(k, len(vectors))):
        nearest = np.max([vectors @ c for c in chosen], axis=0)
        chosen.append(vectors[np.argmin(nearest)])
    centroids = np.array(chosen[1:])
    for _ in range(rounds):
        own = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.array(
            [vectors[own == c].sum(axis=0) if (own == c).any() else centroids[c] for c in range(len(centroids))]
        )
        centroids = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return centroids, np.argmax(vectors @ centroids.T, axis=1)


@dataclass(frozen=True)
class LanguageModel:
    """Centroids by language: a few rows of ``BUCKETS`` numbers per language."""

    idf: np.ndarray
    languages: tuple[str, ...]  # of each centroid
    centroids: np.ndarray
    least: np.ndarray  # cosine below which a centroid rejects

    def predict(self, texts) -> pd.DataFrame:
        """lang, score and rejected of each text."""
        n = len(texts)
        lang, score = np.full(n, UNKNOWN, dtype=object), np.zeros(n)
        rejected = np.ones(n, dtype=bool)
        for at in range(0, n, 64):
            vectors, known = unit_vectors(texts[at : at + 64], self.idf)
            if len(self.languages) and known.any():
                near = vectors @ self.centroids.T
                best = np.argmax(near, axis=1)
                cosine = near[np.arange(len(best)), best]
                rows = at + np.flatnonzero(known)
                lang[rows] = np.array(self.languages, dtype=object)[best[known]]
                score[rows] = np.clip(cosine[known], 0, 1)
                rejected[rows] = cosine[known] < self.least[best[known]]
        return pd.DataFrame({"lang": lang, "score": score, "rejected": rejected})


def fit_languages(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 400,
    clusters: int = 3,
    slack: float = 0.4,
) -> LanguageModel:
    """Learn centroids from rows whose ``lang_col`` isn't null and whose text has a letter.

    Document frequencies are counted over all these rows, combined in the tasks.
    Centroids are clustered in a task per language, from at most ``per_language``
    different texts of it, those with the smallest hash. A centroid rejects below
    ``slack`` times the smallest cosine that any of its sample's texts has with it:
    the distance is then beyond all that was seen in that language.
    """
    rows = labelled.select(
        F.col(text_col).cast("string").alias("t"), F.col(lang_col).cast("string").alias("lang")
    ).where(F.col("lang").isNotNull() & F.col("t").isNotNull())

    def frequencies(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, seen = np.zeros(BUCKETS, dtype=np.int64), 0
        for pdf in frames:
            for text in pdf["t"]:
                counts = ngram_counts(text)
                if counts is not None:
                    total += counts > 0
                    seen += 1
        yield pd.DataFrame({"slot": np.arange(-1, BUCKETS), "n": [seen, *total]})

    # BUCKETS + 1 rows, whatever the documents.
    counted = (
        rows.select("t").mapInPandas(frequencies, "slot int, n long")
        .groupBy("slot").agg(F.sum("n").alias("n")).collect()
    )
    found = np.zeros(BUCKETS + 1)
    for r in counted:
        found[r["slot"] + 1] = r["n"]
    idf = (np.log((1 + found[0]) / (1 + found[1:])) + 1).astype(np.float32)

    # One row per language.
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return LanguageModel(idf, (), np.zeros((0, BUCKETS)), np.zeros(0))
    # A hash below this keeps some times per_language rows of a language.
    keep = F.create_map(*[F.lit(v) for l, n in sizes.items() for v in (l, min(1.0, 8 * per_language / n))])
    share = F.pmod(F.xxhash64("t"), F.lit(1_000_000)) / 1_000_000
    order = Window.partitionBy("lang").orderBy("hash", "t")
    sample = (
        rows.where(share < keep[F.col("lang")])
        .distinct()
        .withColumn("hash", F.xxhash64("t"))
        .withColumn("at", F.row_number().over(order))
        .where(F.col("at") <= per_language)
    )

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        vectors, known = unit_vectors(pdf.sort_values("at")["t"].tolist(), idf)
        vectors = vectors[known]
        if not len(vectors):
            return pd.DataFrame({"lang": [], "cluster": [], "centroid": [], "least": []})
        centroids, own = cluster(vectors, clusters)
        cosine = (vectors * centroids[own]).sum(axis=1)
        least = [float(cosine[own == c].min(initial=1.0)) for c in range(len(centroids))]
        return pd.DataFrame(
            {
                "lang": pdf["lang"].iloc[0],
                "cluster": range(len(centroids)),
                "centroid": [c.astype(np.float32).tolist() for c in centroids],
                "least": least,
            }
        )

    learnt = (
        sample.groupBy("lang")
        .applyInPandas(learn, "lang string, cluster int, centroid array<float>, least double")
        .collect()
    )
    learnt.sort(key=lambda r: (r["lang"], r["cluster"]))
    return LanguageModel(
        idf,
        tuple(r["lang"] for r in learnt),
        np.array([r["centroid"] for r in learnt], dtype=np.float32).reshape(-1, BUCKETS),
        slack * np.array([r["least"] for r in learnt]),
    )


def predicted_language(model: LanguageModel, text: Column) -> Column:
    """Struct of lang, score (cosine with the nearest centroid) and rejected."""

    @pandas_udf("lang string, score double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return model.predict(texts.tolist())

    return predict(text.cast("string"))


def identify_languages(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, lang_pred, score, rejected.

    lang_pred is the language of the nearest centroid by cosine, score that cosine
    in 0 .. 1 and rejected whether it is farther than the centroid accepts. Texts that
    are null or have no letter are `und`, score 0, rejected, and so is all if nothing
    was learnt. Whole texts are read. Ids may repeat or be null; an empty table gives
    an empty table; other columns are not read.
    """
    read = docs.select(
        F.col(id_col), predicted_language(model, F.col(text_col)).alias("_p")
    )
    return read.select(
        id_col, F.col("_p.lang").alias("lang_pred"), F.col("_p.score").alias("score"),
        F.col("_p.rejected").alias("rejected"),
    )

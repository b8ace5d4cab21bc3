"""Quality classifier: averaged word and character n-gram embeddings, softmax output."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

#: Slots of words and word pairs, and of character n-grams (3 to 5 bytes).
BITS = 16
SLOTS = 1 << BITS
#: The slot of all pairs of one word twice.
REPEATED = 0
#: Bytes of a text that are hashed at once.
CHUNK = 1 << 20

_STEP = np.uint32(16_777_619)
_MIX = np.uint32(2_654_435_761)
_POWERS = np.cumprod(np.full(1 << 12, _STEP, dtype=np.uint32), dtype=np.uint32)


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes * _MIX) >> np.uint32(32 - BITS)


def subwords(text: str | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashed (word, character) n-grams of a whole text, chunk by chunk.

    Words are runs between ASCII white space, in their own case, and give one slot
    each and one for each pair of neighbours; character n-grams are runs of 3 to 5
    bytes of the words joined by single spaces. An open word, the last word's hash and
    the last four bytes go on into the next chunk, so that their size changes nothing.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    rest, lead, before = b"", b" ", np.zeros(0, dtype=np.uint32)
    for at in range(0, len(data), CHUNK):
        rest += data[at : at + CHUNK]
        end = len(rest)
        if at + CHUNK < len(data):
            end = 1 + max(rest.rfind(space) for space in (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c"))
        words, rest = rest[:end].split(), rest[end:]
        if not words:
            continue
        joined = b" ".join(words) + b" "
        codes = np.frombuffer(joined, dtype=np.uint8).astype(np.uint32)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(lengths + 1) - lengths - 1
        place = np.arange(len(codes)) - np.repeat(starts, lengths + 1)
        powers = _POWERS[place % len(_POWERS)]
        powers[starts + lengths] = 0
        whole = np.add.reduceat(codes * powers, starts, dtype=np.uint32)
        row = np.concatenate([before, whole])
        pairs = _slots(row[:-1] * _STEP + row[1:] + np.uint32(1))
        pairs[row[:-1] == row[1:]] = REPEATED
        before = whole[-1:]
        codes = np.concatenate([np.frombuffer(lead, dtype=np.uint8).astype(np.uint32), codes])
        grams, mixed = [], np.zeros(len(codes), dtype=np.uint32)
        for n in range(1, 6):
            if len(codes) < n:
                break
            mixed = mixed[: len(codes) - n + 1] * _STEP + codes[n - 1 :]
            if n >= 3:
                # What lies within the carried bytes is counted already.
                grams.append(_slots(mixed[0 if lead == b" " else max(0, len(lead) - n + 1) :] + np.uint32(n)))
        lead = (lead + joined)[-4:]
        yield np.concatenate([_slots(whole), pairs]), np.concatenate(grams)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(slots, weights): character slots follow the word slots; each kind's weights add up to 1."""
    counts = np.zeros((2, SLOTS))
    for both in subwords(text):
        for row, slots in zip(counts, both, strict=True):
            row += np.bincount(slots, minlength=SLOTS)
    counts /= np.maximum(counts.sum(axis=1, keepdims=True), 1)
    flat = counts.ravel()
    slots = np.flatnonzero(flat)
    return slots, flat[slots]


def train(
    samples: list[tuple[np.ndarray, np.ndarray, int]],
    class_weights: dict[int, float],
    dim: int = 8,
    epochs: int = 4,
    rate: float = 1.0,
    seed: int = 11,
) -> tuple[np.ndarray, float]:
    """Stochastic gradient descent in numpy over (slots, weights, label 0 or 1).

    A document is the weighted mean of its slots' vectors, one mean for words and
    one for characters, added; a softmax over two classes follows. Returns what
    prediction needs: for each slot, its vector times the difference of the two
    output vectors, and the difference of their biases.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (2 * SLOTS, dim))
    out, bias = np.zeros((dim, 2)), np.zeros(2)
    steps, step = epochs * len(samples), 0
    for _ in range(epochs):
        for i in rng.permutation(len(samples)):
            slots, weights, label = samples[i]
            pace = rate * (1 - step / steps) * class_weights[label]
            step += 1
            hidden = weights @ vectors[slots]
            logits = hidden @ out + bias
            chance = np.exp(logits - logits.max())
            chance /= chance.sum()
            chance[label] -= 1
            back = out @ chance
            out -= 0.1 * pace * np.outer(hidden, chance)
            bias -= 0.1 * pace * chance
            vectors[slots] -= pace * np.outer(weights / weights.max(), back)
    return vectors @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0])


@dataclass(frozen=True)
class QualityModel:
    """One number per slot; ``prior`` where nothing could be learnt."""

    slots: np.ndarray
    bias: float

    def score(self, texts) -> np.ndarray:
        out = np.empty(len(texts))
        words, chars = self.slots[:SLOTS], self.slots[SLOTS:]
        for i, text in enumerate(texts):
            totals, numbers = np.zeros(2), np.zeros(2)
            for both in subwords(text):
                for kind, (table, slots) in enumerate(zip((words, chars), both, strict=True)):
                    totals[kind] += table[slots].sum()
                    numbers[kind] += len(slots)
            logit = self.bias + (totals / np.maximum(numbers, 1)).sum()
            out[i] = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
        return out


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    per_class: int = 2000,
) -> QualityModel:
    """Learn P(label 1) from at most about ``per_class`` labelled documents of each class.

    The classes are counted over all labels that are 0 or 1, and the sample, which
    a hash of the id picks, is weighted back to their shares. Only the ids in the
    sample, bounded by ``per_class``, are broadcast to find their texts; one task trains on
    the sample's features, of which a text has at most ``2 * SLOTS``. An id with
    several labels counts as 1 if any is 1.
    """
    marked = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(label_col).cast("int").alias("label"))
    )
    sizes = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return QualityModel(np.zeros(2 * SLOTS), 0.0)
    share = F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(1_000_000)) / 1_000_000
    keep = F.create_map(*[F.lit(v) for c, n in sizes.items() for v in (c, min(1.0, per_class / n))])
    picked = marked.where(share < keep[F.col("label")])
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("t"))

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                slots, weights = zip(*map(features, pdf["t"]), strict=True)
                yield pd.DataFrame({"id": pdf["_id"], "label": pdf["label"], "slots": slots, "weights": weights})

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(n=pdf["slots"].map(len)).sort_values(["id", "label", "n"])
        drawn = pdf["label"].value_counts()
        total, all_drawn = sum(sizes.values()), len(pdf)
        weight = {c: (sizes[c] / total) / (drawn[c] / all_drawn) for c in drawn.index}
        samples = [
            (np.asarray(s), np.asarray(w), int(c))
            for s, w, c in zip(pdf["slots"], pdf["weights"], pdf["label"], strict=True)
            if len(s)
        ]
        slots, bias = train(samples, weight)
        return pd.DataFrame({"slots": [slots.tolist()], "bias": [bias]})

    rows = texts.join(F.broadcast(picked), "_id").mapInPandas(
        extract, f"id {dict(texts.dtypes)['_id']}, label int, slots array<int>, weights array<double>"
    )
    # One group: the bounded sample.
    fitted = rows.groupBy().applyInPandas(learn, "slots array<double>, bias double").first()
    if fitted is None:
        return QualityModel(np.zeros(2 * SLOTS), 0.0)
    return QualityModel(np.array(fitted["slots"]), fitted["bias"])


def quality_score(model: QualityModel, text: Column) -> Column:
    """P(label 1) of a text, 0 to 1."""

    @pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts.tolist()))

    return score(text.cast("string"))


def score_quality(
    docs: DataFrame,
    model: QualityModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.3,
) -> DataFrame:
    """One row per row of ``docs``: id, score and predicted (1 if score >= threshold).

    Whole texts are scored. Null and empty texts get the score of no feature, which
    the learnt bias gives. Ids may repeat or be null; an empty table gives an empty
    table; other columns are not read.
    """
    scored = docs.select(F.col(id_col), quality_score(model, F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

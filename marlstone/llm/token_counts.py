"""Token counts of whole texts with a public tokenizer."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A worker keeps the lengths of at most so many pieces, of at most so many bytes.
KEPT_PIECES = 400_000
KEPT_BYTES = 32


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def drops_white_space(path: str) -> bool:
    """Whether a tokenizer's texts may be cut at ASCII white space without changing their tokens.

    Tried on words of letters, digits and marks with each white space character, and
    runs of two, before, between and behind them.
    """

    def ids(text: str) -> list[int]:
        return _tokenizer(path).encode(text, add_special_tokens=False).ids

    words = ("word", "7", "'s", "--", "\u00e9")
    runs = [a + b for a in " \t\n\x0b\x0c\r" for b in ("", " ", "\n")]
    return all(
        ids(f"{run}{a}{run}{b}{run}") == ids(a) + ids(b) for run in runs for a in words for b in words
    )


class _Counter:
    """Lengths of texts, with the lengths of frequent short pieces kept between batches."""

    def __init__(self, path: str, batch_bytes: int):
        self.tokenizer = _tokenizer(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cut = drops_white_space(path)
        self.batch_bytes = batch_bytes
        self.known: dict[bytes, int] = {}

    def _encode(self, pieces: list[bytes]) -> dict[bytes, int]:
        """Lengths of the pieces, encoded in batches of about ``batch_bytes`` each."""
        lengths: dict[bytes, int] = {}
        at = 0
        while at < len(pieces):
            end, held = at, 0
            while end < len(pieces) and (end == at or held + len(pieces[end]) <= self.batch_bytes):
                held += len(pieces[end])
                end += 1
            batch = pieces[at:end]
            coded = self.tokenizer.encode_batch_fast(
                [p.decode() for p in batch], add_special_tokens=False
            )
            lengths.update(zip(batch, map(len, coded), strict=True))
            at = end
        return lengths

    def count(self, texts: list[bytes]) -> list[int]:
        split = [t.split() if self.cut else [t] for t in texts]
        wanted = set().union(*split) if split else set()
        fresh = self._encode(sorted(wanted - self.known.keys(), key=len))
        lengths = {p: self.known[p] for p in wanted & self.known.keys()} | fresh
        out = [sum(map(lengths.__getitem__, pieces)) for pieces in split]
        if len(self.known) + len(fresh) > KEPT_PIECES:
            self.known = {}
        room = KEPT_PIECES - len(self.known)
        short = (p for p in fresh if len(p) <= KEPT_BYTES)
        self.known.update((p, fresh[p]) for p, _ in zip(short, range(room), strict=False))
        return out


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_bytes: int = 1 << 20,
    limit: int = 2048,
) -> DataFrame:
    """One row per row of ``docs``: its id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Texts are encoded in an Arrow function that returns lengths only, without
    added special tokens, truncation or padding. Within a task, texts are dealt
    into batches of about ``batch_bytes``; every text is split at ASCII white
    space. That is a safe boundary for tokenizers that drop white space between
    words: no normal form, word pattern or special string reaches over it, so the
    lengths of the pieces add up to the length of the whole text, and each
    distinct piece of a batch is encoded once. A text without white space stays
    whole, however long, and so does every text for a tokenizer that isn't seen to
    drop white space (``drops_white_space``).

    Null and empty texts have 0 bytes and 0 tokens. Ids may repeat or be null;
    an empty table gives an empty table; other columns are not read.
    ``tokenizer_path`` must be readable on the executors.
    """

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(tokenizer_path, batch_bytes)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            n = len(texts)
            sizes, tokens = [], []
            at = 0
            while at < n:
                group, held = [], 0
                while at < n and (not group or held < batch_bytes):
                    text = texts[at].as_py() or b""
                    group.append(text)
                    held += len(text)
                    at += 1
                sizes.extend(map(len, group))
                tokens.extend(counter.count(group))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([t > limit for t in tokens], pa.bool_()),
                ],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    read = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    kind = dict(read.dtypes)[id_col]
    return read.mapInArrow(
        lengths, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )

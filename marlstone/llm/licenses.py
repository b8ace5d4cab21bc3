"""License notices: phrases, and a set-similarity join of text blocks with templates."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.storage import store

# The word pattern, the phrases and their labels.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Notices in common use, by label.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "You may not use this file except in compliance with the License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc", "Licensed under CC BY-NC 4.0"),
    ("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = str.maketrans(_UPPER, _UPPER.lower())


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(_LOWER))


def needed(size: int, threshold: float) -> int:
    """Words of a template of ``size`` distinct words that a block must contain."""
    return math.ceil(threshold * size - 1e-9)


def windows(lengths: list[int], window: int) -> list[int]:
    """For each template of so many words the words in its blocks: twice as many, by doublings of ``window``."""
    if window < 2:
        raise ValueError("a window needs two words or more")
    return [window * (1 << max(0, math.ceil(math.log2(max(2 * n, 1) / window)))) for n in lengths]


class _Phrases:
    """Places of word sequences, found from their last word."""

    def __init__(self, phrases: Mapping[str, str]):
        self.by_last: dict[str, list[tuple[list[str], str]]] = {}
        for phrase, label in phrases.items():
            words = words_of(phrase)
            self.by_last.setdefault(words[-1], []).append((words, label))

    def find(self, words: list[str]) -> tuple[list[int], set[str]]:
        places, labels = [], set()
        for last, phrases in self.by_last.items():
            at = -1
            for _ in range(words.count(last)):
                at = words.index(last, at + 1)
                for phrase, label in phrases:
                    start = at - len(phrase) + 1
                    if start >= 0 and words[start : at + 1] == phrase:
                        places.append(start)
                        labels.add(label)
        return places, labels


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = 0.9,
    window: int = 48,
) -> DataFrame:
    """One row per row of ``docs`` with its license phrases and the templates that it contains.

    Columns: id, n_words, n_base (places where a phrase's words stand
    consecutively), first_word and last_word (smallest and largest start of those;
    else null), base_labels, labels (base_labels and those of matched templates;
    distinct, sorted, comma-joined, empty without any) and score: 1 where a phrase
    stands, else the largest containment of a matched template, else 0.

    The template part is an exact set-similarity join. Blocks are runs of
    ``window`` words, half a window apart, so every run of up to half a window lies
    in a block whole. Templates longer than half of it, such as whole license texts, are
    sought in blocks of twice, four times, ... as many words (``windows``). A block matches a template if it contains at least
    ``threshold`` of the template's distinct words, ceil(threshold * size) of them.
    Words are ordered by their number of places in all of ``docs``, rarest first,
    and:

    * length filter: a block has at least the words a template needs; words that no
      template of its window has can't be in an overlap, so blocks are cut to the templates'
      vocabulary first;
    * prefix filter: if a block and a template share t words, the template's first
      size - t + 1 words and the block's first size - t + 1 words share one. Block
      words join template words on that;
    * positional filter: a shared prefix word at positions i and j leaves at most
      1 + min(rest of template, rest of block) shared words from there on;
    * the overlap of the pairs that are left is counted exactly.

    The template table is as large as its list, whatever the documents; it alone is
    broadcast. Null texts are as empty ones: no words, labels empty, score 0. Ids
    may repeat or be null; an empty table gives an empty table; other columns are
    not read.
    """
    spans = windows([len(words_of(text)) for _, text in templates], window)
    names = [(i, label, sorted(set(words_of(text)))) for i, (label, text) in enumerate(templates)]
    need = {i: needed(len(words), threshold) for i, _, words in names}
    rank = _frequency_order(
        docs.select(F.col(text_col).cast("string").alias("t")),
        {w for _, _, words in names for w in words},
    )
    # For each window: the ranks of its templates' words, and the least words one of them needs.
    kinds = {
        span: (
            {rank[w] for i, _, words in names if spans[i] == span for w in words if w in rank},
            min(need[i] for i in need if spans[i] == span),
        )
        for span in sorted(set(spans))
    }
    spotter = _Phrases(phrases)

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            columns = ("n_words", "n_base", "first_word", "last_word", "base", "spans", "blocks")
            out: dict[str, list] = {c: [] for c in columns}
            for text in pdf["t"]:
                words = words_of(text)
                places, labels = spotter.find(words)
                out["n_words"].append(len(words))
                out["n_base"].append(len(places))
                out["first_word"].append(min(places) if places else None)
                out["last_word"].append(max(places) if places else None)
                out["base"].append(sorted(labels))
                # Places of vocabulary words, as (position, rank).
                known = [(p, r) for p, r in enumerate(map(rank.get, words)) if r is not None]
                found = []
                for span, (own, least) in kinds.items():
                    step = span // 2
                    blocks: dict[int, set[int]] = {}
                    for p, r in known:
                        if r not in own:
                            continue
                        b = p // step
                        blocks.setdefault(b, set()).add(r)
                        if b:
                            blocks.setdefault(b - 1, set()).add(r)
                    found += [(span, sorted(b)) for b in blocks.values() if len(b) >= least]
                out["spans"].append([span for span, _ in found])
                out["blocks"].append([b for _, b in found])
            yield pd.DataFrame(
                {
                    "_id": pdf["_id"],
                    "n_words": out["n_words"],
                    "n_base": out["n_base"],
                    "first_word": pd.array(out["first_word"], dtype="Int64"),
                    "last_word": pd.array(out["last_word"], dtype="Int64"),
                    "base": out["base"],
                    "spans": out["spans"],
                    "blocks": out["blocks"],
                }
            )

    read = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("t"))
    kind = read.schema["_id"].dataType.simpleString()
    scanned = store(
        read.mapInPandas(
            scan,
            f"_id {kind}, n_words long, n_base long, first_word long, last_word long, "
            "base array<string>, spans array<int>, blocks array<array<int>>",
        ).withColumn("_row", F.monotonically_increasing_id())
    )
    spark = docs.sparkSession
    ordered = [(i, label, sorted(rank[w] for w in words)) for i, label, words in names]
    prefixes = spark.createDataFrame(
        [
            (i, label, words, need[i], spans[i], at, words[at])
            for i, label, words in ordered
            for at in range(len(words) - need[i] + 1)
        ],
        "template int, label string, words array<int>, need int, span int, i int, word int",
    )
    blocks = scanned.select("_row", "spans", F.posexplode("blocks").alias("block", "own"))
    blocks = blocks.withColumn("span", F.get("spans", F.col("block")))
    tokens = blocks.select("_row", "span", "block", "own", F.posexplode("own").alias("j", "word"))
    met = (
        tokens.join(F.broadcast(prefixes), ["span", "word"])
        # Of the template at most size - i words can be shared from here on, of the block size - j.
        .where(F.least(F.size("words") - F.col("i"), F.size("own") - F.col("j")) >= F.col("need"))
        .withColumn("shared", F.size(F.array_intersect("own", "words")))
        .where(F.col("shared") >= F.col("need"))
    )
    matched = met.groupBy("_row").agg(
        F.collect_set("label").alias("found"), F.max(F.col("shared") / F.size("words")).alias("part")
    )
    both = scanned.drop("spans", "blocks").join(matched, "_row", "left")
    empty = F.array().cast("array<string>")
    labels = F.array_sort(F.array_union("base", F.coalesce("found", empty)))
    return both.select(
        F.col("_id").alias(id_col),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0))
        .otherwise(F.coalesce("part", F.lit(0.0)))
        .alias("score"),
    )


def _frequency_order(texts: DataFrame, vocabulary: set[str]) -> dict[str, int]:
    """Rank of each vocabulary word, fewest places in all texts first.

    Counts are combined in the tasks; the result has a row per vocabulary word.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = dict.fromkeys(sorted(vocabulary), 0)
        for pdf in frames:
            for text in pdf["t"]:
                for word in filter(totals.__contains__, words_of(text)):
                    totals[word] += 1
        yield pd.DataFrame({"word": list(totals), "n": list(totals.values())})

    counted = (
        texts.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    )
    places = dict.fromkeys(vocabulary, 0) | {r["word"]: r["n"] for r in counted.collect()}
    return {w: r for r, w in enumerate(sorted(places, key=lambda w: (places[w], w)))}

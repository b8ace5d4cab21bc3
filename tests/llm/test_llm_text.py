"""Operators on texts against brute force, and their edge cases."""

import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from marlstone.llm import language, packing, quality, sharding, simhash
from marlstone.llm.language import fit_languages, identify_languages, ngram_counts
from marlstone.llm.licenses import license_scan, windows, words_of
from marlstone.llm.mixing import mix_sources, mixed_documents
from marlstone.llm.packing import pack_documents
from marlstone.llm.queries import QUERIES, SQL, language_model, quality_model
from marlstone.llm.sharding import shard_by_bytes
from marlstone.llm.simhash import simhash_groups, without_near_copies
from marlstone.llm.token_counts import count_tokens, drops_white_space

SF = "/root/testdata/sf0.001"
LONG = "the rand of lyen thes erat " * 60_000

DOCS = [
    (1, "Released under the MIT License.\nIs it here?", "en", "a", 0),
    (2, None, None, None, 1),
    (3, "", "en", "a", 2),
    (4, LONG, "en", "b", 3),
    (4, LONG, "en", "b", 3),
    (5, "Der und die\tdas Ü ist ß", "de", "é", 4),
    (None, "same text here for all", "en", "b", 5),
    (7, "same text here for all", "en", None, 6),
    (7, "same text here for all", "en", "b", 7),
    (8, "123 ... %%%", "en", "a", 8),
    (9, "<|endoftext|>It's 2024\x1fnow é 　x<|startoftext|>", "en", "a", 9),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    """Edge cases, with columns whose names the operators use themselves."""
    table = spark.createDataFrame(DOCS, SCHEMA)
    names = ("_id", "row", "size", "_row", "score", "shard", "bin", "cluster", "label", "_text", "t", "src")
    return table.withColumns({n: F.lit("x") for n in names})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    return (text or "").encode().split()


# --- licenses --------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(name, spark):
    from compare import connect, differences

    class Query:
        sql = SQL[name]

        def __call__(self, *args):
            return QUERIES[name](*args)

    assert differences(name, Query(), spark, connect(SF), SF) is None


def test_license_edges(docs, empty):
    got = {r["doc_id"]: r for r in license_scan(docs).collect()}
    assert license_scan(docs).count() == len(DOCS)
    one = got[1]
    assert (one["n_words"], one["n_base"], one["first_word"], one["last_word"]) == (8, 1, 3, 3)
    assert (one["base_labels"], one["labels"], one["score"]) == ("mit", "mit", 1.0)
    for null in (got[2], got[3]):
        assert (null["n_words"], null["n_base"], null["first_word"]) == (0, 0, None)
        assert (null["base_labels"], null["labels"], null["score"]) == ("", "", 0.0)
    assert got[4]["n_words"] == 360_000
    assert license_scan(empty).count() == 0


def test_license_join_equals_all_pairs(spark):
    rng = np.random.default_rng(3)
    templates = (("x", "a b c d e f"), ("y", "c d e g"), ("z", "h a b"))
    texts = [" ".join(rng.choice(list("abcdefghijkl"), rng.integers(0, 40))) for _ in range(200)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = license_scan(table, phrases={"q r": "q"}, templates=templates, threshold=0.7, window=12)
    for r in got.collect():
        w, labels, best = words_of(texts[r["doc_id"]]), set(), 0.0
        for at in range(0, len(w), 6):
            for label, template in templates:
                t = set(template.split())
                share = len(t & set(w[at : at + 12])) / len(t)
                if share >= 0.7 - 1e-12:
                    labels.add(label)
                    best = max(best, share)
        assert r["labels"] == ",".join(sorted(labels))
        assert r["score"] == pytest.approx(best)


def test_windows_follow_the_templates():
    assert windows([0, 24, 25, 48, 49, 2000], 48) == [48, 48, 96, 96, 192, 6144]
    with pytest.raises(ValueError, match="two words"):
        windows([3], 1)


def test_whole_license_texts_are_templates(spark):
    rng = np.random.default_rng(8)
    common, own = [f"w{i}" for i in range(60)], [f"v{i}" for i in range(400)]
    whole = [*rng.choice(common, 150), *rng.choice(own, 150, replace=False)]
    half = [*rng.choice(common, 40), *own[:30]]
    templates = (("whole", " ".join(whole)), ("half", " ".join(half)), ("short", "w1 w2 v3 v4"))
    spans = windows([len(words_of(t)) for _, t in templates], 48)
    assert spans == [768, 192, 48]
    texts = []
    for i in range(60):
        body = [w for w in (whole, half)[i % 2] if w in common or rng.random() > 0.006 * i]
        around = [list(rng.choice([*common, "x", "y"], rng.integers(0, 2000))) for _ in range(2)]
        texts.append(" ".join([*around[0], *body, *around[1]]))
    texts.append(" ".join([*whole[:150], *["x"] * 900, *whole[150:]]))
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = set()
    for r in license_scan(table, templates=templates).collect():
        w, labels, best = words_of(texts[r["doc_id"]]), set(), 0.0
        for (label, template), span in zip(templates, spans, strict=True):
            t = set(template.split())
            share = max(len(t & set(w[at : at + span])) / len(t) for at in range(0, len(w), span // 2))
            if share >= 0.9 - 1e-12:
                labels.add(label)
                best = max(best, share)
        assert r["labels"] == ",".join(sorted(labels))
        assert r["score"] == pytest.approx(best)
        found |= {(r["doc_id"], label) for label in labels}
    assert {(0, "whole"), (1, "half")} <= found and (58, "whole") not in found and (60, "whole") not in found


# --- mixing ----------------------------------------------------------------------


def water_fill(sizes, weights, share, cap):
    """Targets as stated: the excess is reshared by weight until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), sum(sizes.values()) * share, set(names)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= cap * sizes[s]:
                left += target[s] - cap * sizes[s]
                target[s] = cap * sizes[s]
                open_.discard(s)
    return target


def test_mixing_meets_targets(given):
    rows = [r.asDict() for r in mix_sources(given).collect()]
    source = {r["doc_id"]: r["source"] for r in given.collect()}
    text = {r["doc_id"]: r["text"] for r in given.collect()}
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        s = source[r["doc_id"]]
        assert r["size"] == len(words(text[r["doc_id"]]))
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        largest[s] = max(largest.get(s, 0), r["size"])
    targets = water_fill(sizes, (5, 2, 1), 1.5, 2.0)
    for r in rows:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(targets[s], rel=1e-9)
    for s, t in targets.items():
        assert abs(taken[s] - t) <= max(0.05 * t, largest[s] / 2)
    again = {(r["doc_id"], r["taken"]) for r in mix_sources(given.repartition(3)).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in rows}


def test_rates_solve_the_dual(spark):
    """The tilt is the root of the words' equation, found here by bisection."""
    from marlstone.llm.mixing import balanced_rates

    cells = [("0a", 1, 10), ("0a", 50, 4), ("0a", 900, 1), ("0b", 7, 3), ("0b", 70, 3)]
    goals = {"0a": 600.0, "0b": 400.0}
    table = spark.createDataFrame(cells, "src string, size long, n long")
    sizes = {s: sum(z * n for t, z, n in cells if t == s) for s in goals}
    targets = spark.createDataFrame([(s, sizes[s], t) for s, t in goals.items()], "src string, source_size long, target double")
    for r in balanced_rates(table, targets, 2.0).collect():
        own = [(z, n) for s, z, n in cells if s == r["src"]]
        low, high = -1.0, 1.0
        for _ in range(200):
            mid = (low + high) / 2
            words_ = sum(n * z * min(2.0, np.exp(mid * z)) for z, n in own)
            low, high = (mid, high) if words_ < goals[r["src"]] else (low, mid)
        assert r["tilt"] / r["scale"] == pytest.approx(low, rel=1e-4)


def test_mixing_edges(docs, empty):
    rows = mix_sources(docs).collect()
    assert len(rows) == len(DOCS)
    assert {r["size"] for r in rows if r["doc_id"] in (2, 3)} == {0}
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in rows)
    assert mix_sources(empty).count() == 0 and mixed_documents(empty).count() == 0


# --- language and quality --------------------------------------------------------


def test_language_held_out_accuracy(spark, given):
    got = QUERIES["op3_language"](spark, SF)
    known = got.join(given.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    right = known.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.95
    for r in got.collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    assert got.count() == given.count()


def test_language_edges(docs, empty, given):
    model = language_model(given)
    got = identify_languages(docs, model)
    assert got.count() == len(DOCS)
    by = {r["doc_id"]: r for r in got.collect()}
    for i in (2, 3, 8):
        assert (by[i]["lang_pred"], by[i]["score"], by[i]["rejected"]) == ("und", 0.0, True)
    assert by[4]["lang_pred"] == "en" and not by[4]["rejected"]
    assert identify_languages(empty, model).count() == 0
    nothing = fit_languages(empty)
    assert {r["lang_pred"] for r in identify_languages(docs, nothing).collect()} == {"und"}


def test_ngram_counts_are_those_of_the_letters():
    # Runs of other characters are one space: " ab c " has 6 + 5 + 4 n-grams.
    assert ngram_counts("Ab--9 C").sum() == 6 + 5 + 4
    assert np.array_equal(ngram_counts("Ab--9 C"), ngram_counts("ab c!"))
    assert ngram_counts("...") is None and ngram_counts(None) is None


def test_quality_held_out(spark):
    got = QUERIES["op4_quality"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    ahead = np.mean([g > b for g in good for b in bad])
    assert ahead >= 0.9
    for r in got.collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.3)


def test_quality_edges(spark, docs, empty, given):
    model = quality_model(given, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = quality.score_quality(docs, model).collect()
    assert len(rows) == len(DOCS) and all(0 <= r["score"] <= 1 for r in rows)
    by = {r["doc_id"]: r["score"] for r in rows}
    assert by[2] == by[3]
    assert quality.score_quality(empty, model).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int")
    blank = quality.fit_quality(given, none)
    assert {r["score"] for r in quality.score_quality(docs, blank).collect()} == {0.5}


def test_subwords_share_of_repeats():
    slots, weights = quality.features("To To To")
    word = dict(zip(slots.tolist(), weights.tolist(), strict=True))
    # Three words and two pairs of the same word.
    assert word[quality.REPEATED] == pytest.approx(2 / 5)
    assert sum(w for s, w in word.items() if s < quality.SLOTS) == pytest.approx(1)


# --- tokens ----------------------------------------------------------------------


@pytest.mark.parametrize(("name", "cut"), [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_token_counts_equal_the_library(spark, docs, given, name, cut):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    assert drops_white_space(path) == cut
    library = Tokenizer.from_file(path)
    texts = [r["text"] for r in given.select("text").limit(60).collect()] + [d[1] for d in DOCS]
    texts += ["a\x0bb\x0cc\x85d e", " '", "don't  'RE we'll", "x" * 5000, "\t\n", "İİ ́a"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in count_tokens(table, path, limit=100, batch_bytes=4096).collect():
        text = texts[r["doc_id"]] or ""
        assert r["n_tokens"] == len(library.encode(text, add_special_tokens=False))
        assert r["n_bytes"] == len(text.encode())
        assert r["over_limit"] == (r["n_tokens"] > 100)
    assert count_tokens(docs, path).count() == len(DOCS)


def test_token_counts_of_nothing(empty):
    import public_tokenizers

    assert count_tokens(empty, public_tokenizers.path("word_bpe_49k.json")).count() == 0


# --- sharding --------------------------------------------------------------------


def test_differencing_finds_the_classic_split():
    # 8, 7, 6, 5, 4 in two parts: differencing gives 16 and 14.
    sums = np.array([[8, 0], [7, 0], [6, 0], [5, 0], [4, 0]])
    total, parts = sharding.difference(sums)
    assert sorted(total.tolist()) == [14, 16]
    again = np.zeros(2, dtype=int)
    for row, part in zip(sums, parts, strict=True):
        again[part] += row
    assert again.tolist() == total.tolist()


@pytest.mark.parametrize("block", [50_000, 20])
def test_shards_are_even_and_whole(given, block):
    rows = shard_by_bytes(given, block=block).collect()
    text = {r["doc_id"]: r["text"] for r in given.collect()}
    assert len(rows) == len(text)
    loads, slots, home = np.zeros(8), {}, {}
    for r in rows:
        own = (text[r["doc_id"]] or "").encode()
        assert r["size"] == len(own) + 1 and r["text_crc32"] == zlib.crc32(own)
        loads[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert home.setdefault(own, r["shard"]) == r["shard"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # No worse than one group away from even.
    groups = {}
    for t in text.values():
        groups[t] = groups.get(t, 0) + len(t.encode()) + 1
    assert loads.max() - loads.min() <= max(groups.values())
    assert loads.max() <= max(max(groups.values()), 1.02 * loads.sum() / 8)


def test_sharding_edges(docs, empty):
    rows = shard_by_bytes(docs).collect()
    assert len(rows) == len(DOCS)
    assert len({r["shard"] for r in rows if r["size"] == len("same text here for all") + 1}) == 1
    assert {r["size"] for r in rows if r["doc_id"] in (2, 3)} == {1}
    assert shard_by_bytes(empty).count() == 0


# --- SimHash ---------------------------------------------------------------------


def slow_print(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def slow_components(prints, ids, radius):
    near = np.bitwise_count(prints[:, None] ^ prints[None]) <= radius
    label = np.array(ids)
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label
        label = new


def test_simhash_equals_brute_force(given):
    rows = sorted(simhash_groups(given).collect(), key=lambda r: r["doc_id"])
    texts = {r["doc_id"]: r["text"] for r in given.collect()}
    prints = np.array([slow_print(texts[r["doc_id"]]) for r in rows], dtype=np.uint64)
    assert [r["fingerprint"] for r in rows] == [f"{int(p):016x}" for p in prints]
    want = slow_components(prints, [r["doc_id"] for r in rows], 3)
    assert [r["component_id"] for r in rows] == want.tolist()
    kept = {r["doc_id"] for r in without_near_copies(given).collect()}
    assert kept == set(want.tolist())


@pytest.mark.parametrize("same", [True, False])
def test_tiles_find_every_group(same):
    rng = np.random.default_rng(5)
    roots = rng.integers(0, 2**63, 300, dtype=np.uint64)
    flips = [roots]
    for _ in range(4):
        bits = np.uint64(1) << rng.integers(0, 64, (300, 2)).astype(np.uint64)
        flips.append(flips[-1] ^ bits[:, 0] ^ bits[:, 1])
    prints = np.unique(np.concatenate(flips))
    rng.shuffle(prints)
    a, b = (prints, prints) if same else (prints[::2], prints[1::2])
    src, dst = simhash.compare_tiles(a, b, same, 3, size=64)
    assert len(src) < len(prints)
    assert (np.bitwise_count(src ^ dst) >= 0).all()
    found = {int(p): int(p) for p in prints}

    def top(p):
        while found[p] != p:
            p = found[p]
        return p

    for x, y in zip(src.tolist(), dst.tolist(), strict=True):
        found[max(top(x), top(y))] = min(top(x), top(y))
    near = np.bitwise_count(prints[:, None] ^ prints[None]) <= 3
    if not same:
        side = np.isin(prints, a)
        near &= side[:, None] != side[None]
    label = prints.copy()
    while True:
        new = np.array([min(label[i], label[row].min(initial=label[i])) for i, row in enumerate(near)])
        if (new == label).all():
            break
        label = new
    groups = {}
    for p, l in zip(prints.tolist(), label.tolist(), strict=True):
        groups.setdefault(l, set()).add(top(p))
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len({top(p) for p in prints.tolist()})


def test_simhash_over_many_tiles(given, spark):
    prints = simhash_groups(given).select(F.conv("fingerprint", 16, -10).cast("long").alias("print")).distinct()
    whole = simhash.link_fingerprints(prints, 12)
    tiled = simhash.link_fingerprints(prints, 12, tile=4)
    from marlstone.llm.components import connected_components

    one, two = ({tuple(r) for r in connected_components(e).collect()} for e in (whole, tiled))
    assert one == two and one


def test_simhash_edges(docs, empty):
    rows = simhash_groups(docs).collect()
    assert len(rows) == len(DOCS)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[2][0]["fingerprint"] == "0" * 16 and by[3][0]["component_id"] == 2
    assert by[None][0]["component_id"] == 7
    kept = without_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 4, 5, 7, 8, 9]
    assert simhash_groups(empty).count() == 0 and without_near_copies(empty).count() == 0


# --- packing ---------------------------------------------------------------------


def slow_best_fit(sizes, sources, clusters, capacity):
    bins, out = [], []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        fits = [
            (b["left"], i)
            for i, b in enumerate(bins)
            if b["left"] >= size and source not in b["s"] and (cluster < 0 or cluster not in b["c"])
        ]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append({"left": capacity, "s": set(), "c": set()})
        out.append((i, capacity - bins[i]["left"]))
        bins[i]["left"] -= size
        bins[i]["s"].add(source)
        bins[i]["c"].add(cluster)
    return out


def test_best_fit_equals_full_search():
    rng = np.random.default_rng(9)
    for _ in range(20):
        n = 300
        sizes = rng.integers(1, 60, n)
        sources = np.where(rng.random(n) < 0.33, 0, rng.integers(0, 9, n))
        clusters = np.where(rng.random(n) < 0.3, rng.integers(0, 4, n), -1)
        bins, at = packing.best_fit(sizes, sources, clusters, 60)
        assert list(zip(bins.tolist(), at.tolist(), strict=True)) == slow_best_fit(
            sizes.tolist(), sources.tolist(), clusters.tolist(), 60
        )


@pytest.mark.parametrize("chunk", [1, 3, 64, 1000])
def test_chunks_leave_no_seams(given, monkeypatch, chunk):
    """One long word, many short ones, and real texts count the same in chunks of any size."""
    texts = [r["text"] for r in given.limit(20).collect()]
    texts += ["é" * 3000, "ab " * 2000, "  x\t\ty \x0b", "Σίσυφος ΟΔΟΣ 12 ss", "", None, " . "]
    whole = [(quality.features(t), language.ngram_counts(t)) for t in texts]
    monkeypatch.setattr(quality, "CHUNK", chunk)
    monkeypatch.setattr(language, "CHUNK", chunk)
    for text, (features, counts) in zip(texts, whole, strict=True):
        if text and len(text) > 500 * chunk:
            continue
        again = quality.features(text)
        assert all(np.array_equal(a, b) for a, b in zip(features, again, strict=True))
        assert np.array_equal(counts, language.ngram_counts(text)) if counts is not None else language.ngram_counts(text) is None


def test_a_word_of_millions_of_letters_is_one_word():
    slots, weights = quality.features("a" * 1_200_000)
    assert (slots < quality.SLOTS).sum() == 1
    counts = language.ngram_counts("ab" * 1_500_000)
    # Letters and the two spaces; pairs; triples.
    assert counts.sum() == 3_000_002 + 3_000_001 + 3_000_000


def test_best_fit_equals_full_search_for_many_sources_and_clusters():
    """More of either than a machine word has bits."""
    rng = np.random.default_rng(10)
    sizes = -np.sort(-rng.integers(1, 200, 3000))
    sources = np.where(rng.random(3000) < 0.33, 0, rng.integers(0, 200, 3000))
    clusters = np.where(rng.random(3000) < 0.7, rng.integers(0, 500, 3000), -1)
    bins, at = packing.best_fit(sizes, sources, clusters, 400)
    assert list(zip(bins.tolist(), at.tolist(), strict=True)) == slow_best_fit(
        sizes.tolist(), sources.tolist(), clusters.tolist(), 400
    )


def test_many_small_pieces_of_different_sources_share_a_bin(spark):
    table = spark.createDataFrame([(i, "w " * 16 + str(i), f"s{i}") for i in range(120)], "doc_id long, text string, source string")
    assert pack_documents(table, capacity=2048).select("bin").distinct().count() == 1


def test_numbers_are_for_what_repeats():
    import pandas as pd

    got = packing.numbers_of(pd.Series([5, 7, 5, None, 9, 7, None], dtype="Int64"))
    assert got[0] == got[2] >= 0 and got[1] == got[5] >= 0 and got[0] != got[1]
    assert got[3] == got[4] == got[6] == -1


@pytest.mark.parametrize("block", [20_000, 50])
def test_packing_keeps_every_word_and_no_conflict(given, block):
    rows = pack_documents(given, capacity=512, block=block).collect()
    facts = {r["doc_id"]: r for r in given.collect()}
    words_in, bins = {}, {}
    for r in rows:
        words_in.setdefault(r["doc_id"], []).append((r["first_word"], r["n_words"], r["piece"]))
        bins.setdefault(r["bin"], []).append(r)
    for i, parts in words_in.items():
        at = 0
        for k, (start, n, piece) in enumerate(sorted(parts)):
            assert (start, piece) == (at, k)
            at += n
        assert at == len(words(facts[i]["text"]))
    assert set(words_in) == set(facts)
    for held in bins.values():
        at = 0
        for r in sorted(held, key=lambda r: r["at"]):
            assert r["at"] == at
            at += r["n_words"]
        assert at <= 512
        own = [facts[r["doc_id"]] for r in held]
        assert len({d["source"] for d in own}) == len(own)
        assert len({d["text"] for d in own}) == len(own)


def test_packing_edges(docs, empty):
    rows = pack_documents(docs).collect()
    assert {r["doc_id"] for r in rows} == {d[0] for d in DOCS}
    assert all(r["bin"] is None and r["n_words"] == 0 for r in rows if r["doc_id"] in (2, 3))
    long = [r for r in rows if r["doc_id"] == 4]
    assert sum(r["n_words"] for r in long) == 2 * 360_000
    assert len({r["bin"] for r in long}) == len(long)
    assert pack_documents(empty).count() == 0


# --- pipeline --------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, columns = docs, docs.columns
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, SF)
        after.write.parquet(str(tmp_path / str(at)))
        after = spark.read.parquet(str(tmp_path / str(at)))
        ids = {r["doc_id"] for r in after.select("doc_id").collect()}
        if name in ("quality", "language", "near_copies"):
            assert after.columns == columns and after.count() == len(ids) < before.count() + 1
            assert after.exceptAll(before).count() == 0
        elif name == "mix":
            most = after.groupBy("doc_id").count().agg(F.max("count")).first()[0]
            assert after.columns == columns and most <= 2
        else:
            pieces = after.agg(F.sum("n_words")).first()[0]
            text = " ".join(r["text"] for r in before.collect())
            assert pieces == len(words(text))
        if name == "quality":
            labels = spark.read.parquet(f"{SF}/labels.parquet")
            good = labels.where("quality = 1")
            assert good.join(after, "doc_id", "left_anti").count() <= 0.02 * good.count()
        before = after
    whole = corpus_pipeline.run(spark, SF)
    assert whole.select("doc_id", "piece", "n_words").exceptAll(before.select("doc_id", "piece", "n_words")).count() == 0


def test_pipeline_stages_on_edges(spark, docs, empty, given):
    for name, stage in corpus_pipeline.STAGES[2:]:
        assert stage(spark, empty, SF).count() == 0, name
        stage(spark, docs, SF).count()
    for _, stage in corpus_pipeline.STAGES[:2]:
        assert stage(spark, empty, SF).count() == 0
    kept = corpus_pipeline.keep_known_languages(spark, docs.unionByName(given, allowMissingColumns=True), SF)
    assert not {2, 3, 8} & {r["doc_id"] for r in kept.where("_id is not null").collect()}


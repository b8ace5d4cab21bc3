"""Centroid clusters, page wrappers and the conversation trie against brute force."""

import hashlib
import json
import random
import re
import zlib
from collections import defaultdict
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm import prefix_trie
from marlstone.llm.centroids import centroid_clusters, cluster_vectors
from marlstone.llm.markup import folded, parse
from marlstone.llm.prefix_trie import conversation_trie
from marlstone.llm.queries import QUERIES
from marlstone.llm.wrappers import (
    Reader,
    Wrapper,
    decide,
    extract_articles,
    infer_wrappers,
    merge,
    of_page,
)

SF = "/root/testdata/sf0.001"


# Centroid clusters


def brute_clusters(rows, k, rounds, size=64):
    kept = [(i, np.floor(256 * np.array(v, dtype=np.float64)).astype(np.int64)) for i, v in rows]
    kept.sort(key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1].tolist()))
    x = np.array([v for _, v in kept])
    c = x[:k].copy()
    for at in range(rounds + 1):
        apart = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        chosen, least = apart.argmin(axis=1), apart.min(axis=1)
        if at < rounds:
            for j in range(len(c)):
                if (chosen == j).any():
                    c[j] = x[chosen == j].sum(axis=0) // (chosen == j).sum()
    shas = [hashlib.sha256(",".join(map(str, v.tolist())).encode()).hexdigest() for v in c]
    return sorted(
        (i, int(chosen[n]), int(least[n]), int(least[chosen == chosen[n]].sum()), int(least.sum()), shas[chosen[n]])
        for n, (i, _) in enumerate(kept)
    )


def test_centroids_of_the_table_equal_brute_force(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = QUERIES["op11_centroids"](spark, SF)
    assert dict(got.dtypes)["cluster"] == "int" and dict(got.dtypes)["inertia"] == "bigint"
    assert sorted(map(tuple, got.collect())) == brute_clusters(rows, 40, 5)


def test_centroid_edges(spark):
    rng = np.random.default_rng(2)
    good = [(i, [float(np.float32(x)) for x in rng.standard_normal(4)]) for i in range(12)]
    good += [good[3], (20, good[4][1]), (21, [0.0, -0.0, -0.001, 0.5])]
    bad = [
        (30, None), (31, []), (32, [1.0] * 3), (33, [1.0] * 5), (34, [1.0, None, 0.0, 0.0]),
        (35, [float("nan"), 0.0, 0.0, 0.0]), (36, [float("inf"), 0.0, 0.0, 0.0]), (37, [3e38, 0.0, 0.0, 0.0]),
    ]
    schema = "vec_id long, embedding array<float>"
    table = spark.createDataFrame(good + bad, schema).withColumns(
        {n: F.lit("x") for n in ("cluster", "distance", "v", "draw", "inertia")}
    )
    got = centroid_clusters(table, k=5, rounds=3, size=4)
    assert sorted(map(tuple, got.collect())) == brute_clusters(good, 5, 3)
    # Fewer vectors than centroids: each is its own.
    few = centroid_clusters(table.where("vec_id < 3"), k=5, size=4).collect()
    assert sorted(r["cluster"] for r in few) == [0, 1, 2] and {r["inertia"] for r in few} == {0}
    empty = spark.createDataFrame([], schema)
    assert centroid_clusters(empty).collect() == [] and cluster_vectors(empty)[1] == []


def test_empty_cluster_keeps_its_centroid(spark):
    # Two equal starts: ties go to the first, so the second is never chosen.
    rows = [(i, [1.0, 1.0]) for i in range(2)] + [(i, [1.0 + i, 0.0]) for i in range(2, 6)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = centroid_clusters(table, k=6, rounds=2, size=2)
    assert sorted(map(tuple, got.collect())) == brute_clusters(rows, 6, 2)


# Page wrappers


def brute_article(html):
    """For the given pages only: blocks of the article element."""
    inner = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    lines = re.sub(r"</?(p|h1)>", "\n", inner.replace("<br>", " "))
    lines = re.sub(r"<[^>]*>", "", lines).split("\n")
    return "\n".join(t for t in (" ".join(unescape(line).split()) for line in lines) if t)


def test_articles_of_the_table(spark):
    got = {r["page_id"]: r for r in QUERIES["op12_html"](spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        row = got[page["page_id"]]
        assert row["text"] == brute_article(page["html"])
        assert row["n_chars"] == len(row["text"]) and row["url"] == page["url"]


def read_alone(html):
    return Reader(json.dumps(decide(of_page(html)))).read(html)


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        (None, ""),
        ("plain & simple", "plain & simple"),
        ("a < b and <b>c</b>d", "a < b and cd"),
        ("<p>one<p>two<div>three</div>four", "one\ntwo\nthree\nfour"),
        ("<P CLASS='x'>&eacute;&nbsp;&#x41;\n\t b<br>c</P>", "é A b c"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\nb\nc\nd"),
        ("<table><tr><td>a<td>b<tr><th>c</table>", "a\nb\nc"),
        ("<script>if (a<b) '</p>'</SCRIPT ><p>x</p><style>p{}</style>", "x"),
        ("<script>never closed <p>x", ""),
        ("<p>x<!-- <p>y</p> --><!--> z</p>", "x z"),
        ('<p title="a>b">x</p><p data-x=\'">\'>y</p>', "x\ny"),
        ("<p>x <span class='ad-slot'>buy</span>y</p>", "x y"),
        ("<article><p>x</p><div hidden>h</div><aside>s</aside></article><p>out</p>", "x"),
        ("<article><header><h1>T</h1></header><p>x</p><footer>f</footer></article>", "T\nx"),
        ("<div class='site-header'>top</div><main><p>x</p></main><div id='comments'><article>c</article></div>", "x"),
        ("<div class='has-sidebar'><p>x</p></div><div class='sidebar'>s</div>", "x"),
        ("<nav>m</nav><form><p>name</p></form><div role='dialog'>d</div><p>x</p>", "x"),
        ("<nav><a href='/'>m</a><article><p>the nav never ends</p></article>", "the nav never ends"),
        ("<p>x</p></div></p><p>y</p></body></html>junk", "x\ny\njunk"),
        ("<p>" + "w " * 500_000 + "end", "w " * 500_000 + "end"),
        ("<div>" * 5000 + "deep<p>er" + "</div>" * 5000 + "out", "deep\ner\nout"),
    ],
)
def test_single_pages(html, text):
    assert read_alone(html) == text


def test_a_wrapper_generalises_its_pages():
    pages = [
        "<h1>A</h1><p>x</p><p>y</p><dl><dt>a<dd>b<dt>c<dd>d</dl><small>same</small><div>All rights</div>",
        "<h1>B</h1><ul><li>z</ul><p>x</p><div>All rights</div>",
        "<p>x</p><ul><li>z</ul><div>All rights</div>",
    ]
    whole = of_page(pages[0])
    for page in pages[1:]:
        merge(whole, of_page(page))
    # The first heading is missing once, lists and paragraphs swap places, the last text is fixed.
    assert whole.expression() == "# h1[#]? (ul[li[=]]? p[#]?)+ dl[(dt[#] dd[#])+]? div[=]"
    packed = json.loads(json.dumps(whole.packed()))
    assert Wrapper.unpacked(packed).expression() == whole.expression()


def site(rng, number):
    """A page without article tags, and its main text."""

    def words(n):
        return " ".join(rng.choice("lorem ipsum dolor sit amet elit sed do eiusmod".split()) for _ in range(n))

    lines = [words(4)] + [words(rng.randrange(20, 60)) for _ in range(rng.randrange(2, 7))]
    body = f"<h2>{lines[0]}</h2>" + "".join(
        f"<p>{t}</p>" if rng.random() < 0.7 else f"<blockquote>{t}</blockquote>" for t in lines[1:]
    )
    links = "".join(f"<div><a href='/{w}'>{w}</a></div>" for w in words(5).split())
    advert = f"<div class='ad-box'><p>{words(9)}</p></div>" if rng.random() < 0.5 else ""
    html = (
        f"<body><div class='top'>{links}</div><p>Welcome to our site number one</p><div class='page'>{body}{advert}</div>"
        f"<section id='comments'><p>{words(30)}</p></section><p>All rights reserved</p></body>"
    )
    return (number, f"https://Site{number % 2}.example/{number}", html), "\n".join(lines)


def test_wrappers_find_what_one_page_cannot_show(spark):
    rng = random.Random(4)
    made = [site(rng, n) for n in range(40)]
    table = spark.createDataFrame([row for row, _ in made], "page_id long, url string, html string").repartition(7)
    got = {r["page_id"]: r["text"] for r in extract_articles(table).collect()}
    assert got == {row[0]: text for row, text in made}
    wrappers = infer_wrappers(table).collect()
    assert sorted((w["host"], w["n_pages"]) for w in wrappers) == [("site0.example", 20), ("site1.example", 20)]


def test_many_classes_fall_back_to_tags():
    """Class names made anew on every page neither grow the wrapper nor cost text."""
    pages = [
        "".join(f"<div class='{chr(97 + n)}{chr(97 + i % 26)}{chr(97 + i // 26)}'><p>{n} {i}</p></div>" for i in range(40))
        for n in range(6)
    ]
    whole = of_page(pages[0])
    for page in pages[1:]:
        merge(whole, of_page(page))
    assert whole.expression() == "div[p[#]]*"
    reader = Reader(json.dumps(decide(whole)))
    assert reader.read(pages[2]) == "\n".join(f"2 {i}" for i in range(40))


def test_decisions_do_not_depend_on_the_order():
    rng = random.Random(5)
    pages = [site(rng, n)[0][2] for n in range(30)]
    made = set()
    for _ in range(5):
        rng.shuffle(pages)
        parts = [of_page(p) for p in pages[:7]], [of_page(p) for p in pages[7:]]
        for part in parts:
            for other in part[1:]:
                merge(part[0], other)
        merge(parts[0][0], parts[1][0])
        made.add(json.dumps(decide(parts[0][0])))
    assert len(made) == 1


def test_copies_of_a_page_are_no_template(spark):
    html = "<body><h1>Title</h1><p>The very same article.</p></body>"
    table = spark.createDataFrame([(n, "http://a.example/x", html) for n in range(5)], "page_id long, url string, html string")
    assert {r["text"] for r in extract_articles(table).collect()} == {"Title\nThe very same article."}


def test_page_edges(spark):
    rows = [
        (1, None, "<p>x</p>"), (2, "http://a.example", None), (3, "http://a.example", ""),
        (None, "no scheme", "<p>y 😀</p>"), (5, "", "<p>z</p>"), (5, "", "<p>z</p>"),
    ]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    table = table.withColumns({n: F.lit("x") for n in ("host", "text", "part", "wrapper", "decisions", "n_chars")})
    got = sorted(map(tuple, extract_articles(table).collect()), key=str)
    assert got == sorted(
        [
            (1, None, "x", 1), (2, "http://a.example", "", 0), (3, "http://a.example", "", 0),
            (None, "no scheme", "y 😀", 3), (5, "", "z", 1), (5, "", "z", 1),
        ],
        key=str,
    )
    assert extract_articles(table.limit(0)).collect() == []


def test_folding():
    assert folded(["a &amp;", "&nbsp; b\r\n", "\t c "]) == "a & b c"
    assert parse("<p>a</p>").items[0].label == "p"


# Conversation trie


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            tie = hashlib.sha256((text or "").encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, role or "", tie, text or ""))
    turns = {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in own.items()}
    members = defaultdict(list)
    length = {}
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt = turns.get(c - c % 20, [])[:h] + turns[c][h:]
        length[c] = len(rebuilt)
        for d in range(len(rebuilt) + 1):
            members[tuple(rebuilt[:d])].append(c)
    below = defaultdict(list)
    for node in members:
        if node:
            below[node[:-1]].append(node)
    total = {}
    for node in sorted(members, key=len, reverse=True):
        leaves = 0 if below[node] else 1
        saved = (len(members[node]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for child in below[node]:
            leaves, saved = leaves + total[child][0], saved + total[child][1]
        total[node] = leaves, saved
    return sorted(
        (
            m[0], len(node), members[node[:-1]][0] if node else None, len(m), len(below[node]), *total[node],
            hashlib.sha256(",".join(str(c) for c in m if length[c] == len(node)).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def sorted_rows(df):
    return sorted(map(tuple, df.collect()))


def test_trie_of_the_table_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert sorted_rows(QUERIES["op13_prefix_trie"](spark, SF)) == brute_trie(map(tuple, rows))


TURNS = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def talks():
    """Deep, shallow, equal and hardly branching conversations; null and repeated turns."""
    rng = random.Random(6)
    rows = [(0, t, "user", f"deep {t}") for t in range(90)] + [(20, t, "user", f"deep {t}") for t in range(70)]
    for c in range(1, 400):
        for t in range(rng.randrange(1, 9)):
            said = rng.choice(["hi", "hi there", "", None, "a\tb  c"])
            rows.append((c if c != 40 else 5000, rng.choice([t, t, None]), rng.choice(["user", None]), said))
    rows += [(c, 0, "user", "the same") for c in range(1000, 2500)]
    return rows + [rows[5], rows[5], (None, 0, "user", "lost"), (399, 99, "user", "long " * 100_000)]


def test_trie_with_deep_bands_ties_and_many_ends(many_blocks, talks, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 50)
    table = many_blocks.createDataFrame(talks, TURNS).repartition(6)
    table = table.withColumns({n: F.lit("x") for n in ("depth", "a", "b", "at", "part", "words", "band", "ids")})
    want = brute_trie(talks)
    assert sorted_rows(conversation_trie(table, band=4)) == want
    assert sorted_rows(conversation_trie(table, band=100)) == want


def test_trie_of_nothing(spark):
    empty = spark.createDataFrame([], TURNS)
    assert conversation_trie(empty).collect() == []
    silent = spark.createDataFrame([(3, 0, "user", "x"), (7, 0, None, None)], TURNS)
    assert sorted_rows(conversation_trie(silent)) == brute_trie(map(tuple, silent.collect()))


def test_hot_parents_are_joined_apart(spark, monkeypatch):
    rows = [(c, t, "user", "hi" if t < 4 else str(c)) for c in range(0, 600, 20) for t in range(6)]
    original = prefix_trie._with_parents
    monkeypatch.setattr(prefix_trie, "_with_parents", lambda nodes, count: original(nodes, count, 5))
    assert sorted_rows(conversation_trie(spark.createDataFrame(rows, TURNS))) == brute_trie(rows)

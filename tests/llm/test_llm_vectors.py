"""Operators on vectors against brute force, and their edge cases."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm.components import LocalForest, connected_components
from marlstone.llm.knn import top_k_inner_product
from marlstone.llm.queries import QUERIES, SQL
from marlstone.llm.storage import with_position
from marlstone.llm.vector_dedup import near_duplicate_vectors, passes_needed

SCHEMA = "vec_id long, embedding array<float>, label int"


def table_of(spark, vectors, ids=None):
    rows = [(i, v, 0) for i, v in zip(ids if ids is not None else range(len(vectors)), vectors, strict=True)]
    return spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit("x"), "cell": F.lit("y"), "n_links": F.lit(3)})


@pytest.fixture(scope="module")
def clustered():
    """Loose vectors, pairs, one large group of near copies and one of exact ones."""
    rng = np.random.default_rng(1)
    loose = rng.standard_normal((300, 16))
    near = loose[0] + 0.08 * rng.standard_normal((400, 16))
    pairs = loose[1:60] + 0.1 * rng.standard_normal((59, 16))
    same = np.repeat(loose[200:201], 150, axis=0)
    return np.concatenate([loose, near, pairs, same]).astype(np.float32)


def brute_links(x):
    x = x.astype(np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    label = np.arange(len(x))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return near.sum(axis=1) - 1, label
        label = new


def test_near_duplicates_equal_brute_force(spark, clustered):
    got = near_duplicate_vectors(table_of(spark, clustered.tolist()), window=16, block=64, tile=100)
    rows = sorted(got.collect(), key=lambda r: r["vec_id"])
    links, label = brute_links(clustered)
    found = np.array([r["n_links"] for r in rows])
    # Never more than there are; nearly all of them at the given window.
    assert (found <= links).all() and found.sum() >= 0.95 * links.sum()
    component = np.array([r["component_id"] for r in rows])
    assert (component == label).mean() >= 0.95
    assert [r["kept"] for r in rows] == (component == np.arange(len(rows))).tolist()


def test_query_equals_sql_where_vectors_link(spark, tmp_path):
    """The given vectors with near copies, scaled copies and a large group around one of them."""
    con = duckdb.connect()
    con.execute("CREATE VIEW given AS SELECT * FROM '/root/testdata/sf0.01/embeddings.parquet'")
    con.execute(f"""COPY (
      SELECT vec_id, embedding FROM given
      UNION ALL SELECT vec_id + 10000, list_transform(embedding, lambda x, i: CASE WHEN i <= 1 + vec_id % 12 THEN 0 ELSE x END)
        FROM given
      UNION ALL SELECT vec_id + 20000, list_transform(embedding, lambda x: 2 * x) FROM given WHERE vec_id % 3 = 0
      UNION ALL SELECT g.vec_id + 30000, list_transform(g.embedding, lambda x, i: 0.25 * x + c.embedding[i])
        FROM given g, (SELECT embedding FROM given WHERE vec_id = 7) c WHERE g.vec_id < 250
    ) TO '{tmp_path}/embeddings.parquet' (FORMAT parquet)""")
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet'")
    columns = ["vec_id", "n_links", "component_id", "kept"]
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({SQL['op5_vector_dedup']})").fetchall()
    got = QUERIES["op5_vector_dedup"](spark, str(tmp_path)).select(columns).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert max(r[1] for r in want) >= 200 and sum(r[1] > 0 for r in want) > 1000
    assert any(r[1] == 0 for r in want)


def test_pairs_at_the_threshold_meet(spark):
    """Pairs just above the threshold, in many loose vectors and with a narrow window."""
    rng = np.random.default_rng(3)
    first = rng.standard_normal((1500, 32))
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    away = rng.standard_normal(first.shape)
    away -= (away * first).sum(axis=1, keepdims=True) * first
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    both = np.concatenate([first, 0.905 * first + np.sqrt(1 - 0.905**2) * away])
    got = near_duplicate_vectors(table_of(spark, both.tolist()), window=32, block=256).collect()
    assert sum(r["n_links"] for r in got) >= 0.98 * brute_links(both.astype(np.float32))[0].sum()


def test_more_passes_for_more_rows_and_harder_pairs():
    easy = passes_needed(10_000, 256, 0.95, 0.99)
    assert passes_needed(10_000_000, 256, 0.95, 0.99) > easy
    assert passes_needed(10_000, 256, 0.9, 0.99) > easy
    assert passes_needed(1, 256, 0.95, 0.99) >= 1


EDGES = [
    (1, [1.0, 0.0]),
    (2, [1.0, 0.0]),
    (3, [0.0, 0.0]),
    (4, None),
    (5, [1.0, None]),
    (6, [float("nan"), 1.0]),
    (7, [float("inf"), 1.0]),
    (8, []),
    (9, [1.0]),
    (10, [0.99, 0.1]),
    (11, [-1.0, 0.0]),
    (None, [1.0, 0.0]),
    (2, [1.0, 0.0]),
    (12, [1e-30, 0.0]),
]


def test_near_duplicate_edges(spark):
    ids, vectors = zip(*EDGES, strict=True)
    rows = near_duplicate_vectors(table_of(spark, vectors, ids)).collect()
    assert len(rows) == len(EDGES)
    by = {r["vec_id"]: r for r in rows}
    assert all((by[i]["n_links"], by[i]["component_id"], by[i]["kept"]) == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 11))
    assert by[1]["component_id"] == by[2]["component_id"] == by[10]["component_id"] == by[12]["component_id"] == 1
    # Three rows of [1, 0] with an id, one near them, one far shorter but parallel.
    assert {by[i]["n_links"] for i in (1, 2, 10, 12)} == {4}
    assert by[None]["component_id"] is None and by[None]["kept"]
    assert near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def brute_top(x, k, step):
    whole = np.floor(64 * x.astype(np.float64)).astype(np.int64)
    out = set()
    for q in range(0, len(x), step):
        scores = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(len(x)), -scores)) if i != q][:k]
        out |= {(q, r, int(i), int(scores[i])) for r, i in enumerate(order, 1)}
    return out


@pytest.mark.parametrize("queries_per_pivot", [1024, 4])
def test_top_k_equals_brute_force(spark, clustered, queries_per_pivot):
    got = top_k_inner_product(
        table_of(spark, clustered.tolist()), F.col("vec_id") % 20 == 0,
        queries_per_pivot=queries_per_pivot, chunk=100,
    )
    assert {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()} == brute_top(clustered, 20, 20)


def test_top_k_prunes_far_cells(spark):
    """Two far clusters: the bound keeps each query to its own, and the result exact."""
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(40, 0.1, (200, 4)), rng.normal(-40, 0.1, (200, 4))]).astype(np.float32)
    got = top_k_inner_product(table_of(spark, x.tolist()), F.col("vec_id") % 20 == 0, k=3, queries_per_pivot=5)
    assert {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()} == brute_top(x, 3, 20)


def test_top_k_edges(spark):
    ids, vectors = zip(*EDGES, strict=True)
    got = top_k_inner_product(table_of(spark, vectors, ids), F.col("vec_id") % 2 == 0, k=20)
    rows = got.collect()
    # Usable: 1, 2, 3, 10, 11, 12 of two components; 2, 10, 12 are queries. 9 has one component.
    assert {r["query_id"] for r in rows} == {2, 10, 12}
    assert all(r["query_id"] != r["vec_id"] for r in rows)
    assert [r["vec_id"] for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == 2] == [1, 10, 3, 12, 11]
    assert top_k_inner_product(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 2 == 0).count() == 0
    odd = table_of(spark, [[1.0, 2.0]], [3])
    assert top_k_inner_product(odd, F.col("vec_id") % 2 == 0).count() == 0


def test_top_k_of_every_length(spark):
    """Each length among its own, the rarer ones too."""
    rng = np.random.default_rng(4)
    x = [rng.standard_normal(2 + i % 3 // 2 * 3 + (i >= 57)).astype(np.float32) for i in range(60)]
    got = top_k_inner_product(table_of(spark, [v.tolist() for v in x]), F.col("vec_id") % 5 == 0, k=4)
    want = set()
    whole = [np.floor(64 * v.astype(np.float64)).astype(np.int64) for v in x]
    for q in range(0, 60, 5):
        scored = [(-int(whole[q] @ whole[i]), i) for i in range(60) if i != q and len(x[i]) == len(x[q])]
        want |= {(q, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:4], 1)}
    assert {tuple(r) for r in got.collect()} == want
    assert len({len(v) for v in x}) == 4


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    edges += [(60, 50), (50, 60), (70, 70), (None, 3), (-5, -9)]
    got = connected_components(spark.createDataFrame(edges, "src long, dst long"))
    label = {r["node"]: r["component"] for r in got.collect()}
    assert got.count() == len(label)
    assert all(label[i] == 0 for i in range(41)) and all(label[100 + i] == 100 for i in range(30))
    assert label[60] == 50 and label[70] == 70 and label[-5] == -9
    none = spark.createDataFrame([], "src long, dst long")
    assert connected_components(none).count() == 0


def test_local_forest_keeps_groups():
    forest = LocalForest(8)
    forest.link(np.array([7, 1, 2]), np.array([6, 2, 7]))
    forest.link(np.array([], dtype=int), np.array([], dtype=int))
    nodes, roots = forest.edges()
    assert nodes.tolist() == [2, 6, 7] and roots.tolist() == [1, 1, 1]


def test_positions_are_gapless_in_a_hot_group(many_blocks):
    rows = many_blocks.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit("b")).otherwise(F.lit("a")).alias("g"), (-F.col("id")).alias("v")
    )
    got = with_position(rows, ["g"], ["v"], "at").collect()
    for g in "ab":
        own = sorted((r["at"], r["v"]) for r in got if r["g"] == g)
        assert [at for at, _ in own] == list(range(len(own)))
        assert [v for _, v in own] == sorted(v for _, v in own)
    everyone = with_position(rows, [], ["v"], "at").collect()
    assert sorted(r["at"] for r in everyone) == list(range(5000))


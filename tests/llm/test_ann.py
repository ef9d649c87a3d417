import numpy as np

from linkloom.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, members string"


def plain(ids, x, k=5):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(ids % 50 == 0):
        s = unit @ unit[i]
        s[i] = -9
        out[int(ids[i])] = ids[np.lexsort((ids, -np.round(s, 12)))[:k]].tolist()
    return out


def test_whole_table_is_exact_in_one_list(spark, sf_small):
    vectors = spark.read.parquet(f"{sf_small}/embeddings.parquet").limit(250)
    rows = vectors.orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = ann.nearest(spark.createDataFrame(rows, vectors.schema)).collect()
    got = {q: [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] for q in {r.query_id for r in found}}
    assert got == plain(ids, x)


def test_recall_over_many_lists_and_parts(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 64)
    monkeypatch.setattr(ann, "PART_ROWS", 20)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(10, 32))
    x = np.round(centres[rng.integers(0, 10, 4000)] + 0.8 * rng.normal(size=(4000, 32)), 3)
    x[1000:1400] = x[1000]  # one very common vector
    ids = np.arange(4000)
    rows = [(int(i), v.tolist(), 0, "x", "x") for i, v in zip(ids, x, strict=True)]
    found = ann.nearest(spark.createDataFrame(rows, SCHEMA.replace("float", "double"))).collect()
    expected = plain(ids, x)
    assert len(found) == 5 * len(expected)
    hits = sum(r.vec_id in expected[r.query_id] for r in found)
    assert hits / len(found) >= 0.9
    for r in found:
        if 1000 <= r.query_id < 1400:
            assert r.vec_id in expected[r.query_id]  # the smallest other ids
        a, b = x[r.query_id], x[r.vec_id]
        assert abs(r.score - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12


def test_graph_reaches_the_lists_in_range():
    rng = np.random.default_rng(0)
    centroids = ann.unit(rng.normal(size=(600, 16)))
    graph = ann.CentroidGraph(centroids)
    wanted = got = 0
    for q in ann.unit(rng.normal(size=(40, 16))):
        d = np.sqrt(2 - 2 * centroids @ q)
        inside = set(np.flatnonzero(d <= 1.1 * d.min()).tolist())
        wanted, got = wanted + len(inside), got + len(inside & set(graph.lists(q, ratio=1.1)))
    assert got / wanted > 0.95


def test_lists_are_balanced():
    x = ann.unit(np.random.default_rng(1).normal(size=(3000, 8)))
    centroids = ann.balanced_centroids(np.concatenate([x, np.repeat(x[:1], 500, 0)]), 100)
    assert len(centroids) >= 35 and np.isfinite(centroids).all()


def test_rows_of_any_kind(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [None, 1.0]), (5, [1.0, 2.0, 3.0]), (6, [inf, 1.0]), (50, [2.0, 0.0]), (None, [0.0, 1.0]), (7, [])]
    found = ann.nearest(spark.createDataFrame([(i, v, None, "x", "x") for i, v in rows], SCHEMA)).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id if r.vec_id is not None else -1, r.score) for r in found) == [
        (0, 1, 0, 1.0), (0, 1, 0, 1.0), (0, 2, 50, 1.0), (0, 2, 50, 1.0), (0, 3, -1, 0.0), (0, 3, -1, 0.0), (50, 1, 0, 1.0), (50, 2, 0, 1.0), (50, 3, -1, 0.0),
    ]
    assert ann.nearest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_vectors_of_extreme_size(spark):
    base = np.random.default_rng(5).normal(size=(120, 4))
    scale = np.where(np.arange(120) % 3 == 0, 1e300, np.where(np.arange(120) % 3 == 1, 1e-300, 1.0))
    rows = [(int(i), (v * s).tolist(), 0, "x", "x") for i, (v, s) in enumerate(zip(base, scale, strict=True))]
    rows += [(1000, (base[50] * 1e-305).tolist(), 0, "", "")]
    found = ann.nearest(spark.createDataFrame(rows, SCHEMA.replace("float", "double"))).collect()
    got = {q: [(r.vec_id, round(r.score, 9)) for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 50, 100, 1000)}
    unit = ann.unit(np.vstack((base, base[50:51])))
    ids = np.append(np.arange(120), 1000)
    for q, near in got.items():
        at = int(np.flatnonzero(ids == q)[0])
        s = unit @ unit[at]
        s[at] = -9
        best = np.lexsort((ids, -np.round(s, 9)))[:5]
        assert [v for v, _ in near] == ids[best].tolist() and np.allclose([x for _, x in near], s[best])

from __future__ import annotations

import numpy as np

from fleetspark.llm.vector_graph import Settings, build_graph, near_duplicates, search


def test_links_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16))
    x = np.concatenate((base, base[:10].repeat(6, axis=0) + rng.normal(scale=0.05, size=(60, 16)), base[:3], rng.normal(size=(80, 16))))
    rows = [(i, [float(v) for v in r], i % 2 if i < 100 else 1) for i, r in enumerate(x)]
    odd = [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [None] * 16, 1), (904, [1.0, 2.0], 1), (905, rows[0][1], None), (None, rows[0][1], 0)]
    df = spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<float>, label int")
    got = {r["id"]: (r["n_links"], r["component_id"]) for r in near_duplicates(df, 0.93, settings=Settings(shard=40)).collect()}
    e = np.array([r[1] for r in rows], np.float32).astype(np.float64)
    e /= np.linalg.norm(e, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    linked = (e @ e.T >= 0.93) & (label[:, None] == label[None]) & ~np.eye(len(e), dtype=bool)
    found = sum(got[i][0] for i in range(len(rows)))
    assert all(got[i][0] <= linked[i].sum() for i in range(len(rows))) and found >= 0.9 * linked.sum()
    component = np.arange(len(rows))
    for _ in range(len(rows)):
        component = np.minimum(component, np.where(linked, component[None], len(rows)).min(axis=1))
    assert np.mean([got[i][1] == component[i] for i in range(len(rows))]) >= 0.95
    assert all(got[i] == (0, i) for i in (900, 901, 902, 903, 904, 905)) and None not in got


def _pairs_beside_a_hot_group():
    """A third near copies of one vector, pairs of cosine 0.93 to 0.97, and single vectors; whose links are found."""
    rng = np.random.default_rng(11)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    hot = unit(unit(rng.normal(size=64)) + rng.normal(scale=0.01, size=(500, 64)))
    one = unit(rng.normal(size=(250, 64)))
    side = rng.normal(size=one.shape)
    side = unit(side - (side * one).sum(axis=1, keepdims=True) * one)
    cosine = rng.uniform(0.935, 0.97, (250, 1))
    x = np.concatenate((hot, one, cosine * one + np.sqrt(1 - cosine**2) * side, unit(rng.normal(size=(500, 64)))))
    return x, x @ x.T >= 0.93


def test_a_hot_group_does_not_hide_lost_pairs(spark):
    x, linked = _pairs_beside_a_hot_group()
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r["id"]: r["n_links"] for r in near_duplicates(df, 0.93, settings=Settings(shard=10)).collect()}
    n, true = np.array([got[i] for i in range(len(x))]), linked.sum(axis=1) - 1
    assert (n <= true).all() and n[:500].sum() >= 0.95 * true[:500].sum()
    assert n[500:1000].sum() >= 0.95 * true[500:1000].sum()


def test_a_missed_recall_is_made_up_by_blocks(spark):
    x, linked = _pairs_beside_a_hot_group()
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    settings = Settings(shard=60, overlap=1, most_overlap=1, recall=1.0)
    got = {r["id"]: r["n_links"] for r in near_duplicates(df, 0.93, settings=settings).collect()}
    assert [got[i] for i in range(len(x))] == (linked.sum(axis=1) - 1).tolist()


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"), 0.9).count() == 0


def test_graph_reaches_and_search_finds():
    rng = np.random.default_rng(1)
    x = np.concatenate((rng.normal(size=(300, 24)), rng.normal(size=24) + rng.normal(scale=0.02, size=(200, 24))))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    edges, medoid = build_graph(x, 16, 32, 1.2)
    seen, front = {medoid}, [medoid]
    while front:
        front = [v for u in front for v in edges[u] if v >= 0 and v not in seen and not seen.add(v)]
    assert len(seen) == len(x)
    hits, true = search(x, edges, medoid, x, 0.93, 16), x @ x.T >= 0.93
    assert not (hits & ~true).any() and hits.sum() >= 0.95 * true.sum()

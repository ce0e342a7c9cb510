import numpy as np
import pytest
from pyspark.sql import functions as F

from rawline.llm.ann import probe_masks, search


def brute(ids, x, near, asks):
    out = {}
    for i, q in zip(ids, x):
        if asks(i):
            s = sorted(((-float(v @ q), j) for j, v in zip(ids, x) if j != i))[:near]
            out[i] = [j for _, j in s]
    return out


def table(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(c) for c in v], 5) for i, v in zip(ids, x)], "vec_id long, embedding array<float>, rank int")


@pytest.mark.parametrize("kind", ["random", "clusters", "scaled"])
def test_recall(spark, kind):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1500, 24))
    if kind == "clusters":
        x = x[rng.integers(0, 30, 1500)] + 0.2 * rng.standard_normal((1500, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if kind == "scaled":
        x *= rng.uniform(0.2, 3, 1500)[:, None]
    x = x.astype(np.float32).astype(float)
    ids = np.arange(1500)
    got = search(table(spark, ids, x), F.col("vec_id") % 20 == 0).toPandas()
    want = brute(ids, x, 20, lambda i: i % 20 == 0)
    hit = [len(set(got[got.query_id == q].vec_id) & set(w)) for q, w in want.items()]
    assert np.mean(hit) / 20 >= 0.9
    assert (got.groupby("query_id").size() == 20).all() and got.query_id.nunique() == 75
    assert not got.duplicated(["query_id", "vec_id"]).any() and (got.query_id != got.vec_id).all()
    for r in got.sample(50, random_state=1).itertuples():
        assert abs(r.score - x[r.query_id] @ x[r.vec_id]) < 1e-12
    order = got.sort_values(["query_id", "rank"])
    same = order.query_id.to_numpy()[1:] == order.query_id.to_numpy()[:-1]
    assert (np.diff(order.score.to_numpy())[same] <= 0).all()


def test_odd_rows_ties_and_copies(spark):
    data = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [1.0, 0.0]), (2, [1.0, 0.0]), (5, [0.0, 1.0]), (40, None), (60, [0.0, 0.0]), (80, [float("nan"), 1.0]), (100, [1.0, None]), (120, []), (None, [1.0, 0.0]), (140, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = search(df, F.col("vec_id") % 20 == 0, near=3).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 2), (0, 2, 3), (0, 3, 20), (20, 1, 0), (20, 2, 2), (20, 3, 3)]


def test_empty(spark):
    assert search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).count() == 0


def test_large_buckets_are_sliced(spark, monkeypatch):
    import rawline.llm.ann as m

    monkeypatch.setattr(m, "SLICE", 16)
    rng = np.random.default_rng(2)
    x = np.ones((200, 4)) + 1e-3 * rng.standard_normal((200, 4))
    x = x.astype(np.float32).astype(float)
    got = search(table(spark, range(200), x), F.col("vec_id") % 20 == 0, near=5).toPandas()
    want = brute(range(200), x, 5, lambda i: i % 20 == 0)
    assert all(list(got[got.query_id == q].sort_values("rank").vec_id) == w for q, w in want.items())


def test_probes_come_by_estimated_success():
    frac = np.array([0.2, 0.9, 0.5])
    masks = probe_masks(frac, 20)
    cost = [sum((frac[j] if d < 0 else 1 - frac[j]) ** 2 for j, d in m) for m in masks]
    assert cost == sorted(cost) and len({tuple(sorted(m)) for m in masks}) == len(masks)
    assert len(probe_masks(frac, 1000)) == 27

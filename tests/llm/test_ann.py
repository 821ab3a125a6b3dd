import numpy as np
import pandas as pd
import pytest

from noticelake.llm import ann


def brute(rows, queries, k):
    """rows: (id, vector); exact answer by the stated rules."""
    seen = {(i, tuple(v)) for i, v in rows}
    out = {}
    for q, v in {(i, tuple(v)) for i, v in queries}:
        scored = sorted(((-float(np.dot(np.float64(v), np.float64(x))), i) for i, x in seen if i != q))
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in want[q]} & set(got.loc[got["query_id"] == q, "vec_id"])) for q in want)
    return hits / sum(map(len, want.values()))


@pytest.mark.parametrize("shard", [8192, 150])
def test_recall_and_scores(spark, shard):
    emb = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = ann.nearest(emb, emb.filter("vec_id % 20 = 0"), shard=shard).toPandas()
    pdf = pd.read_parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = list(zip(pdf["vec_id"], pdf["embedding"], strict=True))
    want = brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    assert len(got) == sum(map(len, want.values()))
    assert recall(got, want) >= 0.95
    by = dict(rows)
    for r in got.itertuples():
        assert abs(r.score - float(np.dot(np.float64(by[r.query_id]), np.float64(by[r.vec_id])))) < 1e-12
    for _, g in got.groupby("query_id"):
        g = g.sort_values("rank")
        assert g["rank"].tolist() == list(range(1, len(g) + 1))
        assert list(zip(-g["score"], g["vec_id"], strict=True)) == sorted(zip(-g["score"], g["vec_id"], strict=True))


def test_recall_over_many_full_shards(spark):
    """Clusters of unlike norms, in shards that are thirty times as large as the beam."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(200, 32))
    x = (centres[rng.integers(0, 200, 16_000)] + 0.7 * rng.normal(size=(16_000, 32))) * rng.uniform(0.8, 1.2, (16_000, 1))
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(16_000), "embedding": x.tolist()}), "vec_id long, embedding array<double>").repartition(4)
    got = ann.nearest(df, df.filter("vec_id % 200 = 0"), shard=4000).toPandas()
    want = {}
    for q in range(0, 16_000, 200):
        score = x @ x[q]
        score[q] = -np.inf
        want[q] = [(int(i), 0.0) for i in np.argsort(-score)[:20]]
    assert recall(got, want) >= 0.9


def test_equal_vectors_and_bad_rows(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(30, 4)).round(3)
    rows = [(i, base[i % 7].tolist()) for i in range(200)] + [(300 + i, (3 * v).tolist()) for i, v in enumerate(base)]
    bad = [(900, None), (901, [0.0] * 4), (902, [1.0, None, 1.0, 1.0]), (903, [float("nan"), 1.0, 1.0, 1.0]), (904, [float("inf"), 0.0, 0.0, 1.0]), (905, [1.0, 2.0]), (None, [9.0] * 4)]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in [*rows, rows[0], *bad]], "vec_id long, embedding array<double>, shard int, ids string")
    got = ann.nearest(df, df.filter("vec_id % 20 = 0 or vec_id > 890"), k=5).toPandas()
    want = brute(rows, [r for r in rows if r[0] % 20 == 0], 5)
    assert {q: list(zip(g.sort_values("rank")["vec_id"], strict=True)) for q, g in got.groupby("query_id")} == {q: [(i,) for i, _ in w] for q, w in want.items()}


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.nearest(df, df.filter("vec_id = 0")).orderBy("rank").collect()] == [(0, 1, 2, 1.0), (0, 2, 1, 0.0)]
    assert ann.nearest(df, df.limit(0)).count() == 0
    assert ann.nearest(df.limit(0), df).count() == 0

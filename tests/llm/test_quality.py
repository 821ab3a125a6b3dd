import zlib

import numpy as np
import pandas as pd

from noticelake.llm import quality


def test_features_have_one_length_and_use_whole_texts(monkeypatch):
    texts = ["", "a", "Hello, world!\n\nx", "é" * 10, "x " * 5000]
    whole = [quality.features(t) for t in texts]
    assert {v.shape for v in whole} == {(quality.N_FEATURES,)} and all(np.isfinite(v).all() for v in whole)
    monkeypatch.setattr(quality, "_PIECE", 7)
    for t, v in zip(texts, whole, strict=True):
        assert np.allclose(quality.features(t), v)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = quality.op7_quality_classifier(spark, sf).toPandas()
    labels = pd.read_parquet(f"{sf}/labels.parquet")
    assert len(got) == 1000 and got["score"].between(0, 1).all()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got["doc_id"]]).all()
    assert (got["predicted"] == (got["score"] >= 0.5)).all()
    held = got[got["held_out"]].merge(labels, on="doc_id")
    assert (held["predicted"] == held["quality"]).mean() > 0.95
    again = quality.op7_quality_classifier(spark, sf).toPandas()
    assert again.sort_values("doc_id")["score"].round(9).tolist() == got.sort_values("doc_id")["score"].round(9).tolist()


def test_held_out_labels_are_not_learnt(spark):
    docs = spark.createDataFrame([(i, "good text here" if i % 2 else "### $$$") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200) if zlib.crc32(str(i).encode()) % 3 == 1], "doc_id long, quality int")
    model = quality.train(docs, labels)
    assert model.weights is None and model.prior == 0.5


def test_cases(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "no id"), (5, "long words " * 30_000)]
    docs = spark.createDataFrame([(i, t, 0.1, "en") for i, t in rows], "doc_id long, text string, score double, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.train(docs, labels)
    assert quality.score(docs.select("doc_id", "text"), model).count() == 5
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 5
    assert quality.keep_good(docs.limit(0), labels).count() == 0


def test_prior_from_positives_alone():
    rng = np.random.default_rng(0)
    p = rng.normal(2, 1, (2000, 4)).astype(np.float32)
    u = np.vstack([rng.normal(2, 1, (900, 4)), rng.normal(-2, 1, (2100, 4))]).astype(np.float32)
    assert 0.2 < quality.estimate_prior(p, u) < 0.45
    model = quality.fit(p, u)
    assert (model.score(rng.normal(2, 1, (500, 4))) > 0.5).mean() > 0.9 and (model.score(rng.normal(-2, 1, (500, 4))) < 0.5).mean() > 0.9


def test_repeated_ids_and_labels_that_disagree(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(quality, "fit", lambda p, u, prior: taken.append((len(p), len(u), prior)) or quality.Model(0.5))
    train = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    docs = spark.createDataFrame([(i, f"text {i} {k}") for i in train for k in range(50)], "doc_id long, text string")
    labels = [(i, 1) for i in train[:10]] + [(i, 0) for i in train[10:15]] + [(i, i % 2) for i in train[:4]] + [(train[0], 0), (train[0], 1), (train[5], 1)]
    quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    unlike = {i for i, y in labels if (i, 1 - y) in labels}
    assert taken == [(10 - len(unlike), len(train) - 15 + len(unlike), (10 - len(unlike)) / (15 - len(unlike)))]


def test_a_table_that_is_labelled_throughout(spark):
    good, bad = "The river runs past the old mill and into the quiet valley below the hills.", "@@@ ### $$$ !!! %%% 12 ~~ << >> == ++ ^^ && **"
    docs = spark.createDataFrame([(i, f"{good if i % 3 else bad} {i}") for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    scores = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    held = [i for i in scores if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((scores[i] >= 0.5) == (i % 3 > 0) for i in held) / len(held) > 0.95

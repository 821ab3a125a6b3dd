import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pandas as pd

import corpus_pipeline
from noticelake.llm import near_text, packing, quality


def near_representatives(df):
    """The smallest id of each component over all pairs whose five-word shingles have a Jaccard similarity of 0.8 or more."""
    df = df.sort_values("doc_id", ignore_index=True)
    sets = [near_text.shingles(t or "") for t in df["text"]]
    by = {}
    for k, s in enumerate(sets):
        for g in s:
            by.setdefault(g, []).append(k)
    shared = Counter(p for ks in by.values() for p in combinations(ks, 2))
    label = list(range(len(sets)))
    for (i, j), n in shared.items():
        if 5 * n >= 4 * (len(sets[i]) + len(sets[j]) - n) and label[i] != label[j]:
            a, b = sorted((label[i], label[j]))
            label = [a if x == b else x for x in label]
    return set(df["doc_id"][[k for k, x in enumerate(label) if k == x]])


def test_stages_against_brute_force(spark, tmp_path):
    """Each stage on its predecessor's rows, against plain Python."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "exact dedup", "SimHash near-dedup", "PII surrogates", "best-fit packing"]
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append(docs.toPandas())
    start = pd.read_parquet(f"{sf}/documents.parquet")

    model = quality.train(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    scores = model.score(np.vstack([quality.features(t) for t in start["text"]]))
    assert set(kept[0]["doc_id"]) == set(start["doc_id"][scores >= 0.5])

    low = kept[0]["text"].map(lambda t: t.translate({c: c + 32 for c in range(65, 91)}))
    assert set(kept[1]["doc_id"]) == set(kept[0].groupby(low)["doc_id"].max())

    assert set(kept[2]["doc_id"]) == near_representatives(kept[1])

    assert set(kept[3]["doc_id"]) == set(kept[2]["doc_id"])
    assert not kept[3]["text"].str.contains(r"@mail\d\.example\.com").any()
    assert (kept[3]["n_chars"] == kept[3]["text"].str.len()).all()
    plain = kept[2].set_index("doc_id")["text"]
    same = kept[3].set_index("doc_id")["text"].reindex(plain.index)
    clean = ~plain.str.contains(r"[0-9@]")
    assert (plain[clean] == same[clean]).all() and clean.sum() > 100

    enc = packing.encoder()
    for doc, part in kept[4].groupby("doc_id"):
        x = np.array([*enc.encode_ordinary(same[doc]), 0], "<u4")
        for r in part.itertuples():
            assert r.ids_crc32 == zlib.crc32(x[r.start : r.start + r.length].tobytes())
        assert part["length"].sum() == len(x)
    assert set(kept[4]["doc_id"]) == set(kept[3]["doc_id"])
    spans = kept[4].sort_values(["sequence_id", "offset"])
    assert (spans.groupby("sequence_id")["length"].cumsum() - spans["length"] == spans["offset"]).all()
    loads = spans.groupby("sequence_id")["length"].sum()
    assert loads.max() <= 2048 and len(loads) <= -(-loads.sum() // 2048) * 1.01 + 1


def test_odd_rows(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows, columns with clashing names, and an empty table, through every stage."""
    long = " ".join(f"word{k}" for k in range(60_000))
    rows = [(1, None), (2, ""), (3, "Same text here"), (3, "Same text here"), (4, "same TEXT here"), (None, "no id at all"), (None, "no id at all"), (5, long), (6, long + " end"), (7, "mail a@b.example now"), (8, "mail a@b.example now!")]
    kind = "doc_id long, text string, lang string, source string, n_chars long, id int, digest string, score double, node int, row int, mentions_0 int, entity string, `a.b` int"
    docs = spark.createDataFrame([(i, t, None, "s", None, 1, "d", 2.0, 3, 4, 5, "e", 6) for i, t in rows], kind).repartition(3)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    one, none = docs, docs.limit(0)
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        one, none = stage(spark, one, str(tmp_path)), stage(spark, none, str(tmp_path))
        if name != "best-fit packing":
            assert one.columns == docs.columns
        sizes.append(one.count())
        assert none.count() == 0
        kept = one if name == "PII surrogates" else None
        if kept is not None:
            texts = {r["doc_id"]: (r["text"], r["n_chars"], r["a.b"]) for r in kept.collect()}
    # Without labels all stay; empty texts, both spellings and repeated rows are one each; then the longer of the long ones goes.
    assert sizes[:4] == [11, 7, 6, 6] and set(texts) == {2, 4, None, 5, 7, 8}
    assert "a@b.example" not in texts[7][0] and texts[8][0] == texts[7][0] + "!" and texts[7][1:] == (len(texts[7][0]), 6)
    assert {r["doc_id"] for r in one.collect()} == set(texts) and one.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_run(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and rows.count() > 0

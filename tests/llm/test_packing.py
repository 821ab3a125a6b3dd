import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from noticelake.llm import packing


@pytest.fixture(scope="module")
def hf():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def check(rows, texts, hf, capacity):
    """Every document whole, every sequence gapless and within capacity."""
    ids = [[*hf.encode(t or "", add_special_tokens=False).ids, 0] for _, t in texts]
    want = []
    for (i, _), x in zip(texts, ids, strict=True):
        first = len(x) % capacity or capacity
        edges = [0, *range(first, len(x) + 1, capacity)]
        want += [(i, k, a, b - a, zlib.crc32(np.array(x[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(((r["id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=key) == sorted(want, key=key)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), sum(map(len, ids))


TEXTS = [(0, None), (1, ""), (2, "one"), (2, "one"), (None, "no id"), (3, "é ñ <|endoftext|> 你好 'll don't  x\n\n y"), (4, "word " * 9000), (5, "x" * 5000), (6, " \t\n ")]


@pytest.mark.parametrize(("capacity", "group"), [(2048, 50_000), (64, 7), (8, 2)])
def test_pieces_and_places(spark, hf, capacity, group):
    texts = TEXTS + [(100 + k, f"text {k} " * (k % 23)) for k in range(150)]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in texts], "doc_id long, text string, length int, bin int").repartition(5)
    rows = packing.pack_documents(df, capacity=capacity, group_items=group).collect()
    bins, total = check(rows, texts, hf, capacity)
    if group == 50_000:
        assert bins <= -(-total // capacity) + 2


def test_vocabulary_is_the_same(hf, spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    enc = packing.encoder()
    for (t,) in docs:
        assert enc.encode_ordinary(t) == hf.encode(t, add_special_tokens=False).ids


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(TypeError, match="whole numbers"):
        packing.pack_documents(spark.createDataFrame([], "doc_id string, text string"))


def test_best_fit_prefers_tightest():
    bins, offsets, loads = packing.best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert loads.tolist() == [10, 10] and sorted(loads[bins].tolist()) == [10] * 5 and offsets[0] == 0


def test_added_tokens_have_their_ids(spark, tmp_path):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [(1, "end <|endoftext|> start"), (2, "<|endoftext|><|endoftext|>"), (3, "<|endoftext| > no"), (4, "x " * 3000 + "<|endoftext|>\n y"), (5, None)]
    assert 50256 in plain.encode(texts[0][1], add_special_tokens=False).ids
    df = spark.createDataFrame(texts, "doc_id long, text string")
    check(packing.pack_documents(df, added=True).collect(), texts, plain, 2048)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [r.asDict() for r in packing.op4_best_fit_packing(spark, str(tmp_path)).withColumnRenamed("doc_id", "id").collect()]
    check(rows, texts, plain, 2048)


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 2_000_000, "a <|endoftext|>" + " \t" * 700_000 + "b"])
@pytest.mark.parametrize("added", [False, True])
def test_long_runs_of_white_space(spark, hf, text, added):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = not added
    ids = plain.encode(text, add_special_tokens=False).ids
    assert packing.encode_whole(added=added)(text) == ids
    if not added:
        rows = packing.pack_documents(spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")).collect()
        check(rows, [(1, text), (2, "short")], hf, packing.CAPACITY)

import base64
import random

import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from noticelake.llm import bpe


@pytest.fixture(scope="module")
def enc():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def slices(texts):
    data, offsets, first = bpe.pretokens(texts)
    cut = [data[a:b].decode() for a, b in zip(offsets, offsets[1:], strict=False)]
    return [cut[a:b] for a, b in zip(first, first[1:], strict=False)]


PIECES = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'S", "'", "''", " ", "  ", "\n", "\t", " ", "　", "\x85", "\x1c", "a", "Zz", "é", "你好", "7", "٣", "½", "!", "…", "🙂", "l", "v", "r", "e", "́"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), max_size=5))
def test_boundaries_match_the_pattern(texts):
    assert slices(texts) == [regex.findall(public_tokenizers.PATTERN, t) for t in texts]


def test_boundaries_across_blocks():
    rng = random.Random(3)
    texts = ["".join(rng.choices(PIECES, k=5000)), "x" * 2000, " " * 1500 + "a", "", "don't " * 700]
    assert slices(texts) == [regex.findall(public_tokenizers.PATTERN, t) for t in texts]


def test_ids_match_the_library(enc, monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choices(PIECES + ["hello", " world", "ing", "tion"], k=rng.randint(0, 60))) for _ in range(300)]
    texts += ["", "a" * 5000, "ab" * 3000, "!?" * 300, "né" * 400, "hello world " * 50]
    want = [enc.encode_ordinary(t) for t in texts]
    for size in (bpe.CACHE, 64):
        monkeypatch.setattr(bpe, "CACHE", size)
        c = bpe.Codec()
        ids, begins, edges = c.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:], strict=False)] == want
        for t, a, b in zip(texts, edges, edges[1:], strict=False):
            decoded, ends = c.decode(ids[a:b])
            assert decoded.tobytes() == t.encode()
            assert begins[a:b].tolist() == [0, *ends.tolist()][: b - a]


SHORT = st.text(alphabet="ab7 \x01!'é\n\U0001f642", max_size=3)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(SHORT, max_size=4), min_size=1, max_size=5))
def test_tables_of_short_texts_cold_and_warm(enc, tables):
    c = bpe.Codec.__new__(bpe.Codec)
    c.__dict__.update(bpe.codec().__dict__)
    c._forget()
    for texts in tables:
        ids, _, edges = c.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:], strict=False)] == [enc.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("tables", [[["x"]], [["hello", " world", "7"]], [["hello"], ["hello\x01"], ["7"]], [[chr(k)] for k in range(300)]])
def test_single_characters(enc, tables):
    c = bpe.Codec()
    for texts in tables:
        ids, _, edges = c.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:], strict=False)] == [enc.encode_ordinary(t) for t in texts]


def test_long_runs():
    """Runs on which the library's own pattern gives up; the pattern's rules are plain there."""
    c = bpe.codec()
    for run in (" ", "\n", "\t "):
        text = "a" + run * 1_000_000 + "b"
        data, offsets, _ = bpe.pretokens([text])
        begin = len(data) - 2 if run[-1] == " " else len(data) - 1
        assert offsets.tolist() == sorted({0, 1, len(data) - 2, begin, len(data)})
        ids, _, _ = c.encode([text])
        assert c.decode(ids)[0].tobytes() == data


def test_whole_table_against_the_library(spark, enc):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    got = {r["id"]: list(r["token_ids"]) for r in bpe.encode(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {r["doc_id"]: enc.encode_ordinary(r["text"] or "") for r in docs}


def test_query_columns(spark, enc):
    rows = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "x y"), (4, "long text " * 20_000)]
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, token_ids string")
    got = sorted((str(r["id"]), list(r["token_ids"]), bytes(r["decoded"])) for r in bpe.decode(bpe.encode(df)).collect())
    assert got == sorted((str(i), enc.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    assert bpe.encode(df.limit(0)).count() == 0

"""Token alignment against a plain version over all pairs of tokens."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from noticelake.llm import alignment as A

SP = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
JSON = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
JSON.encode_special_tokens = True
NONE = (0, 0, 0, 0, 0, 0, "")


def letters() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


LETTERS = letters()


def both(text):
    if not text:
        return None
    want = f" {text}".encode()
    a, b = JSON.encode(f" {text}", add_special_tokens=False).ids, SP.encode(text)
    bytes_a = [bytes(LETTERS[c] for c in JSON.id_to_token(i)) for i in a]
    bytes_b = [bytes([int(SP.id_to_piece(i)[3:5], 16)]) if SP.is_byte(i) else SP.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return None
    spans = []
    for ids, pieces in ((a, bytes_a), (b, bytes_b)):
        at, own = 0, []
        for i, x in zip(ids, pieces, strict=True):
            own.append((i, at, at + len(x)))
            at += len(x)
        spans.append(own)
    return spans


def plain(texts):
    found, holds, best = [both(t) for t in texts], Counter(), defaultdict(int)
    links = [[] if f is None else [(i, j) for i, x, y in f[0] for j, u, v in f[1] if x < v and u < y] for f in found]
    for own in links:
        holds.update(set(own))
    for (i, _), n in holds.items():
        best[i] = max(best[i], n)
    out = []
    for f, own in zip(found, links, strict=True):
        if f is None:
            out.append(NONE)
            continue
        common = sorted({y for _, _, y in f[0]} & {y for _, _, y in f[1]})
        groups = ["|".join(",".join(str(i) for i, x, _ in side if lo <= x < hi) for side in f) for lo, hi in zip([0, *common], common, strict=False)]
        out.append((len(f[0]), len(f[1]), len(common), len(own), sum(holds[p] == best[p[0]] for p in own), sum(holds[p] for p in own), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


TEXTS = ["Hello world, it's 2024!", "Hello world", None, "", "Hello world", " two  spaces\n\n\tand tabs ", "naïve façade — ünïcödé 漢字 🙂🙂", "a▁b", "<s> <|endoftext|> <0x41> <unk>", "x\x00y", "!", "Что это такое? " * 30, "the the the and", "é   ﻿", "0"]


def test_against_plain_version(spark):
    rows = spark.createDataFrame([(k, t, "x", 3) for k, t in enumerate(TEXTS)], "doc_id long, text string, a string, n long").repartition(3)
    got = {r[0]: tuple(r)[1:] for r in A.align(rows).collect()}
    want = plain(TEXTS)
    assert [got[k] for k in range(len(TEXTS))] == want
    assert want[7] == NONE and want[8] != NONE


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=6))
def test_parts(texts):
    """Links, groups and shards' inputs of any texts, without Spark."""
    found = [both(t) for t in texts]
    sides = [[np.array([i for i, _, _ in f[k]] if f else [], np.int64) for f in found] for k in (0, 1)]
    own = A.Aligned(*sides, A._sizes("a", None), A._sizes("b", None))
    want = plain(texts)
    assert [hashlib.sha256(g).hexdigest() if g else "" for g in own.groups()] == [w[-1] for w in want]
    assert np.diff(own.link_edges).tolist() == [w[3] for w in want]


def test_counts_given_on_in_parts(spark):
    rows = spark.createDataFrame([(k % 7 or None, t) for k, t in enumerate(TEXTS * 5)], "doc_id long, text string").coalesce(1)
    coded = A.aligned(rows)
    whole = {r["pair"]: r["n"] for r in A.pair_counts(coded).collect()}
    parts = A.pair_counts(coded, most=20).collect()
    sums = Counter()
    for r in parts:
        sums[r["pair"]] += r["n"]
    assert sums == whole and len(parts) >= len(whole)
    assert sorted(tuple(r)[1:] for r in A.align(rows).collect()) == sorted(plain(TEXTS * 5))


def test_long_texts_and_empty_table(spark):
    texts = [" " * 2_000_000, "\n" * 1_200_000, "word " * 100_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: r for r in A.align(rows).collect()}
    ids = JSON.encode(" " + texts[0], add_special_tokens=False).ids
    assert got[0]["n_a"] == len(ids) and got[0]["n_b"] == len(SP.encode(texts[0])) and got[2]["n_a"] == 100_001
    assert A.align(rows.limit(0)).count() == 0


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() if len(r["text"] or "") < 3000][:40]
    got = {r[0]: tuple(r)[1:] for r in A.align(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [got[k] for k, _ in docs] == plain([t for _, t in docs])
    assert A.op11_token_alignment(spark, "/root/testdata/sf0.001").columns[0] == "doc_id"

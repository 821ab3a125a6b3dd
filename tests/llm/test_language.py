"""Language identification: code lengths against a plain coder, held-out accuracy, defined cases."""

from collections import Counter, defaultdict
from math import log2

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from noticelake.llm import language as L


def trees_of(samples: dict[str, list[bytes]], order: int) -> L.Trees:
    keys, owners, counts = [], [], []
    for g, name in enumerate(sorted(samples)):
        texts = samples[name]
        k, n = L.gram_counts(np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts], np.int64), order)
        keys.append(k), counts.append(n), owners.append(np.full(len(k), g))
    return L.Trees(sorted(samples), np.concatenate(keys), np.concatenate(owners), np.concatenate(counts), order)


class Plain:
    """Escape method C with exclusions, byte by byte."""

    def __init__(self, texts: list[bytes], order: int):
        self.order, self.after = order, defaultdict(Counter)
        for t in texts:
            for i in range(len(t)):
                for k in range(min(i, order) + 1):
                    self.after[t[i - k : i]][t[i]] += 1

    def bits(self, context: bytes, symbol: int) -> float:
        excluded, total = set(), 0.0
        for k in range(min(len(context), self.order), -1, -1):
            seen = {s: n for s, n in self.after.get(context[len(context) - k :], {}).items() if s not in excluded}
            if not seen:
                continue
            weight = sum(seen.values()) + len(seen)
            if symbol in seen:
                return total + log2(weight / seen[symbol])
            total += log2(weight / len(seen))
            excluded |= set(seen)
        return total + log2(256 - len(excluded))


TEXTS = st.lists(st.binary(min_size=0, max_size=30).map(lambda b: bytes(97 + x % 4 for x in b)), min_size=1, max_size=5)


@settings(max_examples=40, deadline=None)
@given(TEXTS, TEXTS, TEXTS, st.integers(1, 6))
def test_code_lengths(a, b, texts, order):
    texts = [*texts, b"abz", b""]
    score = L.Scorer(trees_of({"x": a, "y": b}, order))
    got = score(np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts], np.int64))
    for g, learned in enumerate((a, b)):
        plain = Plain(learned, order)
        for t, bits in zip(texts, got[:, g], strict=True):
            assert bits == pytest.approx(sum(plain.bits(t[:i], t[i]) for i in range(len(t))), rel=1e-5, abs=1e-4)


def test_probabilities_sum_to_one():
    trees = trees_of({"x": [b"abracadabra", b"banana"], "y": [b"xyz"]}, 3)
    for context in (b"", b"a", b"ab", b"bra", b"zzz"):
        data = np.frombuffer(b"".join(context + bytes([s]) for s in range(256)), np.uint8)
        keys = L.grams(data, L._placed(np.full(256, len(context) + 1)), 3)[len(context) :: len(context) + 1]
        assert np.exp2(-trees.lengths(keys)).sum(0) == pytest.approx([1, 1])


def test_hash_table_that_is_full_and_long_texts(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 110, n).astype(np.uint8)) for n in (0, 5, 40_000, 0, 1, 3000)]
    trees = trees_of({"x": texts[2:3], "y": texts[5:]}, 4)
    lengths, data = np.array([len(t) for t in texts]), np.frombuffer(b"".join(texts), np.uint8)
    want = L.Scorer(trees)(data, lengths)
    monkeypatch.setattr(L, "_KEPT", 2048)
    monkeypatch.setattr(L, "_GATHER", 2048)
    assert np.allclose(L.Scorer(trees)(data, lengths), want, rtol=1e-6)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = L.op12_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in rows if r["held_out"] and r["lang_pred"] != "und"]
    assert len(held) > 100 and sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows) and len(rows) == docs.count()


def test_defined_cases(spark):
    learned = [(k, f"der und die das nicht {k} ist" if k % 2 else f"the and of that not {k} is", "de" if k % 2 else "en") for k in range(40)]
    odd = [(100, None, "de"), (101, "", "de"), (102, "12 34 !?", None), (None, "und das ist nicht", "fr"), (103, "the of and", None), (104, "ж" * 50_000, None), (103, "the of and", None)]
    docs = spark.createDataFrame([(*r, "x", 5) for r in learned + odd], "doc_id long, text string, lang string, id string, score int")
    trees = L.learn(docs)
    assert trees.languages == ["de", "en"]
    rows = {}
    for r in L.identify(docs, trees).collect():
        rows.setdefault(r["id"], []).append(r)
    assert [rows[k][0]["lang_pred"] for k in (100, 101, 102)] == ["und"] * 3 and rows[100][0]["score"] == 0
    assert rows[None][0]["lang_pred"] == "de" and rows[None][0]["held_out"] and len(rows[103]) == 2 and rows[103][0]["lang_pred"] == "en"
    assert rows[104][0]["lang_pred"] in ("de", "en") and len(rows[104][0]["bits"]) == 2
    none = L.learn(docs.filter("lang = 'xx'"))
    assert none.languages == [] and {r["lang_pred"] for r in L.identify(docs, none).collect()} == {"und"}
    assert L.identify(docs.limit(0), trees).count() == 0


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(k, "a" * 100, "en" if k % 3 else "de") for k in range(3000)], "doc_id long, text string, lang string")
    sizes = {r["lang"]: r["n"] for r in L.sample(docs, max_bytes=5000).groupBy("lang").count().withColumnRenamed("count", "n").collect()}
    assert sizes == {"en": 50, "de": 50}


def test_models_that_follow_each_other(spark):
    """Workers keep a scorer for the tasks that follow, but only with its own trees."""
    texts = [(k, ("und der die das " if k % 2 else "the of and that ") * 5 + str(k)) for k in range(40)]
    docs = spark.createDataFrame([(k, t, "de" if k % 2 else "en") for k, t in texts], "doc_id long, text string, lang string")
    for a, b in (("de", "en"), ("x", "y"), ("en", "de"), ("p", "q")):
        own = docs.withColumn("lang", F.when(F.col("lang") == "de", a).otherwise(b))
        got = {r["id"]: r["lang_pred"] for r in L.identify(docs, L.learn(own)).collect()}
        assert got == {k: a if k % 2 else b for k, _ in texts}

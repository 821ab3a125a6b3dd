import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from noticelake.llm import simhash


def brute_components(fps, reps):
    parent = {r: r for r in reps}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = find(reps[i]), find(reps[j])
                parent[max(a, b)] = min(a, b)
    return {r: find(r) for r in reps}


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprint_matches_definition():
    for text in ["", " \t\n", "One", "one two", "A b\tc D\x0be", "É à b ÉÉ c d", "x " * 500, "the cat sat on the mat the cat sat"]:
        assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(str(i % 97) for i in range(1000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_PIECE", 17)
    assert simhash.fingerprint(text) == whole


def clusters(rng, centres, each, spread):
    fps = set()
    for _ in range(centres):
        c = rng.getrandbits(64)
        for _ in range(each):
            f = c
            for b in rng.sample(range(64), rng.randint(0, spread)):
                f ^= 1 << b
            fps.add(f)
    return sorted(fps)


def test_links_and_components_match_brute_force(spark):
    rng = random.Random(1)
    fps = sorted({*clusters(rng, 20, 15, 5), *(rng.getrandbits(64) for _ in range(100)), 0, 2**64 - 1, 7})
    reps = rng.sample(range(10_000), len(fps))
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)), r) for f, r in zip(fps, reps, strict=True)], "fp long, rep long")
    for block, group in ((16_384, 8192), (5, 8192), (16_384, 40), (7, 3), (16_384, 0.001)):
        found = {r["node"]: r["component"] for r in simhash.components(simhash.near_links(df, block, group)).collect()}
        assert {r: found.get(r, r) for r in reps} == brute_components(fps, reps)


def test_upper_nodes_prune_pairs():
    """Three levels over one wide group: many pairs fall away above the leaves, and no link does."""
    rng = random.Random(5)
    items = np.array(sorted({*clusters(rng, 60, 10, 3), *(rng.getrandbits(64) for _ in range(2500))}), np.uint64)
    order = items.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        order ^= order >> np.uint64(shift)
    items = items[np.argsort(order)]
    compared = []
    label = simhash.links(np.zeros(len(items), np.int64), items, compared=compared)
    assert sum(compared) < 0.75 * len(items) * (len(items) - 1) / 2 and len(items) > simhash.LEAF**2
    want = brute_components([int(f) for f in items], list(range(len(items))))
    assert label.tolist() == [want[k] for k in range(len(items))]


def test_near_duplicates_cases(spark):
    base = [" ".join(random.Random(k).choices("alpha beta gamma delta eps zeta eta theta".split(), k=200)) for k in range(6)]
    rows = [(10 * k + 5, t) for k, t in enumerate(base)] + [(3, base[0].upper()), (99, base[1] + " tail"), (5, base[0])]
    rows += [(200, None), (201, ""), (202, " \n "), (None, base[2]), (None, "only here"), (300, "word"), (301, "long " * 20_000)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, fp string, id int")
    out = simhash.near_duplicates(df).collect()
    assert len(out) == len(rows)
    ids = [i for i, _ in rows if i is not None]
    by_fp = {}
    for i, t in rows:
        if i is not None:
            f = slow_fingerprint(t or "")
            by_fp[f] = min(i, by_fp.get(f, i))
    want = brute_components(list(by_fp), list(by_fp.values()))
    want = {(i, want[by_fp[slow_fingerprint(t or "")]]) for i, t in rows if i is not None}
    assert {(r["id"], r["component_id"]) for r in out if r["id"] is not None} == want
    assert sorted(r["component_id"] is None for r in out if r["id"] is None) == [False, True]
    with pytest.raises(TypeError, match="whole numbers"):
        simhash.near_duplicates(df.withColumn("doc_id", F.lit("a")))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).count() == 0

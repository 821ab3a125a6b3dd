import hashlib
import random

import xxhash
from pyspark.sql import functions as F

from noticelake.llm import line_dedup

M = 2**64


def slow_chunks(lines):
    h = [xxhash.xxh64_intdigest(x.encode()) for x in lines]
    out, first = [], 0
    for i in range(len(lines)):
        r = sum(h[i - j] * pow(line_dedup._BASE, j, M) for j in range(line_dedup.WINDOW) if i >= j) % M
        if (r >> 33) % line_dedup.DIVISOR == 0 or i == len(lines) - 1:
            out.append((first, i + 1))
            first = i + 1
    return out


def brute(rows):
    seen = {}
    for i, t in {(i, t) for i, t in rows if t is not None}:
        lines = t.split("\n")
        for k, (a, b) in enumerate(slow_chunks(lines)):
            c = "\n".join(lines[a:b])
            if b - a > 1 and c.strip():
                seen.setdefault(c, []).append((i is None, i or 0, hashlib.sha256(t.encode()).digest(), k))
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None))
            continue
        d = hashlib.sha256(t.encode()).digest()
        lines, kept = t.split("\n"), []
        for k, (a, b) in enumerate(slow_chunks(lines)):
            c = "\n".join(lines[a:b])
            places = seen.get(c, [])
            if len(places) < 2 or min(places) == (i is None, i or 0, d, k):
                kept += lines[a:b]
        out.append((i, "\n".join(kept)))
    return out


def corpus(rng):
    passages = [[f"passage {p} line {k} {rng.random()}" for k in range(rng.randint(2, 9))] for p in range(5)]
    rows = []
    for i in range(80):
        lines = []
        for _ in range(rng.randint(0, 4)):
            lines += [f"own {rng.random()}" for _ in range(rng.randint(0, 3))]
            if rng.random() < 0.6:
                lines += rng.choice(passages)
        rows.append((i, "\n".join(lines)))
    return rows


def test_chunks_match_definition_and_shift():
    rng = random.Random(8)
    lines = [str(rng.random()) for _ in range(200)]
    assert line_dedup.chunks(lines) == slow_chunks(lines)
    assert line_dedup.chunks([""]) == [(0, 1)]
    cut = {tuple(lines[a:b]) for a, b in line_dedup.chunks(lines)}
    moved = {tuple((["new"] + lines)[a:b]) for a, b in line_dedup.chunks(["new"] + lines)}
    assert len(cut & moved) >= len(cut) - 2


def test_matches_brute_force(spark):
    rows = corpus(random.Random(9))
    rows += [(3, rows[3][1]), (3, rows[4][1]), (500, rows[5][1]), (None, rows[6][1]), (501, None), (502, ""), (503, "\n" * 50), (504, "\n" * 50), (505, "x y\n" * 30_000)]
    df = spark.createDataFrame([(i, t, 7, "k", 1, 2, 3, 4) for i, t in rows], "doc_id long, text string, chunk int, key string, _id int, drop int, row int, `a.b` int")
    out = line_dedup.drop_repeated_lines(df)
    assert out.columns == [*df.columns, "lines", "removed"]
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=key) == sorted(brute(rows), key=key)
    assert line_dedup.drop_repeated_lines(df.limit(0)).count() == 0


def test_clashing_keys_are_told_apart_by_bytes(spark, monkeypatch):
    cut = line_dedup.document_chunks
    monkeypatch.setattr(line_dedup, "document_chunks", lambda *a: cut(*a).withColumn("key", F.lit(b"same")))
    rows = corpus(random.Random(10))[:30]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(brute(rows)) == sorted((r["doc_id"], r["text"]) for r in line_dedup.drop_repeated_lines(df).collect())


def brute_runs(rows):
    """Later occurrences of pairs of neighbouring lines; ids are in order and each but the last once."""
    first, out = {}, []
    for i, t in rows:
        lines = t.split("\n")
        away = set()
        for k, pair in enumerate(zip(lines, lines[1:], strict=False)):
            if not "".join(pair).strip():
                continue
            at = first.setdefault(pair, (i, k))
            if at != (i, k):
                away |= {k + 1} if at == (i, k - 1) else {k, k + 1}
        out.append((i, "\n".join(x for k, x in enumerate(lines) if k not in away), len(lines), len(away)))
    return out


def test_whole_runs_are_removed(spark):
    rng = random.Random(12)
    passages = [[f"passage {p} line {k} {rng.random()}" for k in range(n)] for p, n in enumerate([*range(2, 11)] * 3)]
    rows = []
    for p in passages * 3:
        own = [[f"own {rng.random()}" for _ in range(rng.randint(1, 3))] for _ in range(2)]
        rows.append((len(rows), "\n".join(own[0] + p + own[1])))
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, pair int")
    out = line_dedup.drop_repeated_runs(df)
    assert out.columns == [*df.columns, "lines", "removed"]
    got = {r["doc_id"]: r["removed"] for r in out.collect()}
    assert got == {i: len(p) if i >= len(passages) else 0 for i, p in enumerate(passages * 3)}
    rows = corpus(random.Random(13))
    rows += [(503, "\n" * 50), (504, "\n" * 50), (505, "x y\n" * 3000), (506, "a\nb\na\nb\na"), (507, "")]
    df = spark.createDataFrame([*rows, rows[7]], "doc_id long, text string")
    want = brute_runs(rows)
    assert sorted(map(tuple, line_dedup.drop_repeated_runs(df).collect())) == sorted([*want, want[7]])
    odd = spark.createDataFrame([(None, "p\nq"), (1, "p\nq"), (2, None)], "doc_id long, text string")
    assert {tuple(r) for r in line_dedup.drop_repeated_runs(odd).collect()} == {(None, "", 2, 2), (1, "p\nq", 2, 0), (2, None, 0, 0)}
    assert line_dedup.drop_repeated_runs(df.limit(0)).count() == 0


def test_clashing_pair_keys_are_told_apart_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "line_pairs", lambda docs, content=False, cut=line_dedup.line_pairs: cut(docs, content).withColumn("key", F.substring("key", 1, 0)))
    rows = corpus(random.Random(14))[:40]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, lines int, own_id int")
    out = line_dedup.drop_repeated_runs(df)
    assert out.columns == ["doc_id", "text", "own_id", "lines", "removed"]
    assert sorted((r["doc_id"], r["text"], r["lines"], r["removed"]) for r in out.collect()) == sorted(brute_runs(rows))


def test_query_removes_runs(spark, tmp_path):
    rows = [(1, "a one\nb two"), (2, "c\na one\nb two\nd")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r["doc_id"]: r["n_removed"] for r in line_dedup.op5_line_dedup(spark, str(tmp_path)).collect()} == {1: 0, 2: 2}

import hashlib

from pyspark.sql import functions as F

from noticelake.llm import exact_dedup

UP = {c: c + 32 for c in range(65, 91)}


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(UP), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[(t or "").translate(UP)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").translate(UP).encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(1, "Same Text"), (2, "same text"), (3, "SAME TEXT É"), (4, "same text é"), (5, None), (6, ""), (7, ""), (None, "same text"), (None, "alone"), (None, "ALONE"), (2, "same text"), (8, "long " * 50_000), (9, "LONG " * 50_000), *((100 + k, "hot") for k in range(400))]


def found(df, **more):
    cols = ["id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("d")]
    return sorted((tuple(r) for r in exact_dedup.duplicate_groups(df, **more).select(*cols).collect()), key=str)


def test_matches_brute_force(spark):
    df = spark.createDataFrame([(i, t, "n", 1) for i, t in ROWS], "doc_id long, text string, norm string, salt int").repartition(7)
    assert found(df) == brute(ROWS)
    assert found(df, salts=1) == brute(ROWS)
    assert exact_dedup.duplicate_groups(df.limit(0)).count() == 0


def test_equal_digests_of_different_texts(spark, monkeypatch):
    own = exact_dedup._normalised
    monkeypatch.setattr(exact_dedup, "_normalised", lambda *a: own(*a).withColumn("digest", F.when(F.length("norm") < 10, F.unhex(F.lit("00"))).otherwise(F.col("digest"))))
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert [x[:4] for x in found(df)] == [x[:4] for x in brute(ROWS)] or sorted(str(x[:4]) for x in found(df)) == sorted(str(x[:4]) for x in brute(ROWS))


def test_drop_leaves_one_row_of_each_group(spark):
    rows = [(1, "a"), (1, "A"), (1, "a"), (2, "b"), (2, "b"), (3, "B"), (3, "b"), (None, "c"), (None, "C"), (4, None), (5, ""), (6, "alone"), (7, "d"), (None, "d")]
    df = spark.createDataFrame([(i, t, 1, 2, 3, 4) for i, t in rows], "doc_id long, text string, id int, digest int, row int, `a.b` int").repartition(3)
    out = exact_dedup.drop_duplicates(df)
    assert out.columns == df.columns
    got = [(r["doc_id"], (r["text"] or "").lower()) for r in out.collect()]
    assert sorted(got, key=str) == sorted([(1, "a"), (3, "b"), (None, "c"), (5, ""), (6, "alone"), (7, "d")], key=str)
    assert exact_dedup.drop_duplicates(df.limit(0)).count() == 0


def test_copies_of_a_partition_become_one_row_before_the_shuffle(spark):
    rows = [(k, "hot " * 30 if k % 3 else f"alone {k}") for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).select("*")
    merged = exact_dedup._merge(exact_dedup._normalised(df, "doc_id", "text").filter("norm LIKE 'hot%'"), 16)
    assert [(r["keep_id"], r["group_size"]) for r in merged.collect()] == [(2999, 2000)]
    plan = merged._jdf.queryExecution().executedPlan()
    sent = [n for n in _nodes(plan) if n.nodeName() == "Exchange" and "salt" in n.toString()]
    assert {n.metrics().apply("shuffleRecordsWritten").value() for n in sent} == {4}
    out = exact_dedup.duplicate_groups(df)
    assert out.filter("kept").count() == 1001 and out.filter("keep_id = 2999").count() == 2000


def _nodes(plan):
    inner = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan.plan() if "QueryStage" in plan.nodeName() else None
    below = [inner] if inner is not None else [plan.children().apply(k) for k in range(plan.children().size())]
    return [plan] + [x for b in below for x in _nodes(b)]


def test_a_filter_that_lets_everything_pass(spark, monkeypatch):
    """The filter saves work only: with none, the result is the same and still at most one row per text and partition travels."""
    monkeypatch.setattr(exact_dedup, "with_possible", lambda rows, *a: rows.withColumn("possible", F.lit(True)))
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(4).select("*")
    assert found(df) == brute(ROWS)
    rows = exact_dedup._normalised(df, "doc_id", "text")
    merged = exact_dedup._merge(exact_dedup.held_rows(rows, rows.select("digest").distinct()), 16)
    assert merged.count() == len({(t or "").translate(UP) for _, t in ROWS})
    merged.collect()
    sent = [n for n in _nodes(merged._jdf.queryExecution().executedPlan()) if n.nodeName() == "Exchange" and "salt" in n.toString()]
    texts = {(t or "").translate(UP) for _, t in ROWS}
    assert sent and all(len(texts) <= n.metrics().apply("shuffleRecordsWritten").value() <= 4 * len(texts) < len(ROWS) / 8 for n in sent)
    assert exact_dedup.drop_duplicates(df).count() == merged.count()


def test_many_repeated_digests_and_a_small_filter(spark):
    rows = [(k, f"text {k % 900}") for k in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(df, most_blocks=1) == brute(rows)


def test_text_ids(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "X"), (None, "x")], "doc_id string, text string")
    assert sorted((str(r["id"]), r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.duplicate_groups(df).collect()) == [("None", "b", 3, False), ("a", "b", 3, False), ("b", "b", 3, True)]

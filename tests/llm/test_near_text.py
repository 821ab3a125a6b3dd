import random

from pyspark.sql import functions as F

from noticelake.llm import near_text


def brute(rows):
    """The smallest id of each component over all pairs of similarity 0.8 or more."""
    sets = [near_text.shingles(t or "") for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if label[i] != label[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    return sorted(min(rows[j][0] for j in range(len(rows)) if label[j] == k) for k in set(label))


def test_all_near_copies_are_found(spark):
    rng = random.Random(21)
    word = lambda: f"w{rng.randrange(5000)}"
    rows = [(900, None), (901, ""), (902, " \n"), (903, "a b"), (904, "A  b")]
    line = " ".join(word() for _ in range(12))
    for _ in range(25):
        base = [word() for _ in range(rng.randint(20, 120))]
        for _ in range(rng.choice([1, 2, 3, 9])):
            w = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 5])):
                w[rng.randrange(len(w))] = word()
            text = " ".join(w)
            rows.append((len(rows), text.upper() if rng.random() < 0.3 else text + (" " + line if rng.random() < 0.4 else "")))
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, node string, row int, `a.b` int").repartition(5)
    out = near_text.keep_representatives(df)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.collect()) == brute(rows)
    assert near_text.keep_representatives(df.limit(0)).count() == 0


def test_repeated_rows_and_rows_without_id(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(5, text), (5, text), (None, text + " more"), (None, "alone"), (None, "alone"), (7, "other words here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["text"]) for r in near_text.keep_representatives(df).collect()), key=str)
    assert got == sorted([(5, text), (None, "alone"), (7, "other words here")], key=str)
    named = df.selectExpr("'n' || doc_id AS doc_id", "text")
    assert near_text.keep_representatives(named).count() == 3


def test_rows_that_share_a_hash_are_compared(spark, monkeypatch):
    """Different rows under one hash all stay; rows of one id and text come once."""
    monkeypatch.setattr(near_text, "_hash_of", lambda id_col, text_col: F.pmod(F.coalesce(F.col(id_col), F.lit(0)), F.lit(3)).cast("long"))
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(20))) for k in range(12)] + [(4, "another text of the same id"), (None, "no id"), (None, "no id"), (5, None), (5, ""), (7, " ".join(f"w7x{j}" for j in range(20)))]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, node string")
    out = near_text.keep_representatives(df)
    got = sorted((str(r["doc_id"]), r["text"] or "") for r in out.collect())
    assert out.columns == df.columns and got == sorted({(str(i), t or "") for i, t in rows})
    numbered = near_text._numbered(df, "doc_id", "text")
    assert numbered.count() == numbered.select("node").distinct().count() == len(got)

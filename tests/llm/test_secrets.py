import hashlib
import random
import re

from noticelake.llm import secrets


def base_spans(text):
    out = []
    pattern = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for number, (p, ok) in enumerate([(pattern, lambda m: len(m[2]) >= 6), (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), (r"[0-9a-f]+", lambda m: len(m[0]) >= 24)]):
        out += [(m.start(), number, m.end()) for m in re.finditer(p, text) if ok(m)]
    return sorted(out)


def all_spans(text, scope=secrets.SCOPE):
    roles = [r for _, r, _ in secrets.KINDS]
    found = base_spans(text)
    for number in range(secrets.BASE, len(secrets.KINDS)):
        for m in re.finditer(secrets.KINDS[number][2], text):
            if number != 4 or all(re.search(c, m[0]) for c in ("[0-9]", "[a-z]", "[A-Z]")):
                found.append((m.start(), number, m.end()))
    found.sort()

    def stop(x):
        return x[0] + len(re.match(r"[^?#]*", text[x[0] : x[2]])[0]) if x[1] == 5 else x[2]

    def links(x):
        out = []
        for r in ("secret", "identifier", "endpoint"):
            if r in secrets.WANTS[roles[x[1]]]:
                before = [stop(y) for y in found if roles[y[1]] == r and stop(y) <= x[0]]
                after = [y[0] for y in found if roles[y[1]] == r and y[0] >= stop(x)]
                out += [(r, max(before))] if before and x[0] - max(before) <= scope else []
                out += [(r, min(after))] if after and min(after) - stop(x) <= scope else []
        return out

    told = [(*x, links(x)) for x in found]
    return [x for x in told if x[1] < secrets.BASE or x[3] or (x[1] == 5 and re.match(secrets.USERINFO, text[x[0] : x[2]]))]


PARTS = ['token = "abc123def456"', "password: token: abcdef12345", "PassWord=short", "api_key:'x.y/z=+_-1'", "AKIA" + "Z9" * 10, "AKIAAKIA", "AKIA" * 6, "0123456789abcdef01234567", "deadbeef" * 2, "client_id=zoe.1", "user: anna", "https://example.com/x?y", "Ab1" * 12, "jdbc:mysql://h/db", "https://ann:pw12@h.org/x", "https://h.org/a?token=abcdef99&x", "https://h.org/blob/Ab1Cd2Ef3Gh4Ij5Kl6Mn7Op8Qr9St0Uv1Wx2/readme", "é", "🙂", " ", "\n", "plain words here ", "x" * 90, "y " * 120]


def test_matches_brute_force(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 25))) for _ in range(300)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(7, texts[7]), (7, "token=other1234"), (None, texts[3]), (900, None), (901, ""), (902, "w " * 50_000 + PARTS[0])]
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, pos int, kind string")
    got = secrets.find_secrets(df).collect()
    told = lambda i, spans: (str(i), [(s[0], s[1], s[2], [tuple(x) for x in s[-1]]) for s in spans])
    assert sorted(told(r["id"], r["found"]) for r in got) == sorted(told(i, all_spans(t or "")) for i, t in rows)
    assert secrets.find_secrets(df.limit(0)).count() == 0


def test_query_matches_base_contract(spark):
    sf = "/root/testdata/sf0.01"
    names = [k for k, _, _ in secrets.KINDS]
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        spans = base_spans(r["text"] or "")
        want[r["doc_id"]] = [sum(s[1] == k for s in spans) for k in range(3)] + [hashlib.sha256(",".join(f"{names[n]}:{a}:{b}" for a, n, b in spans).encode()).hexdigest()]
    got = {r["doc_id"]: [r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]] for r in secrets.op1_secret_scan(spark, sf).collect()}
    assert got == want


def test_parts_of_one_address_complete_nothing(spark):
    path = "see https://example.com/blob/Ab1Cd2Ef3Gh4Ij5Kl6Mn7Op8Qr9St0Uv1Wx2/readme now"
    rows = [(1, path), (2, "https://h.org/a?token=abcdef99"), (3, "https://ann:pw12@h.org/x"), (4, path + " token=abcdef99")]
    got = {r["id"]: [(s["kind"], [x["role"] for x in s["links"]]) for s in r["found"]] for r in secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == [] and got[2] == [("endpoint", ["secret"]), ("assign", ["endpoint"])] and got[3] == [("endpoint", [])]
    assert got[4] == [("endpoint", ["secret"]), ("assign", ["endpoint"])]


def test_query_matches_sql(spark, tmp_path):
    import duckdb

    rng = random.Random(6)
    rows = [(k, "".join(rng.choices(PARTS, k=rng.randint(0, 25)))) for k in range(200)] + [(5, None)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = sorted(con.execute(secrets.ORACLES["op1_secret_scan"]).fetchall())
    got = sorted(tuple(r) for r in secrets.op1_secret_scan(spark, str(tmp_path)).collect())
    assert got == want and any(r[-1] for r in got)

import hashlib
import re

import regex
from pyspark.sql import functions as F

from noticelake.llm import pii

TEXT = """Write to Jo.Doe+x@Mail1.Example.com or JO.DOE+X@MAIL1.EXAMPLE.COM, call +1 (136) 555-7479 or +1.136.555.7479,
from 22.102.42.45. Cards 7536784127813050 4845168114407329 and 4970-1012-3456-7890; id 123-45-6789, DE44 5001 0517 5407 3249 31, GB29 NWBK 6016 1331 9268 19.
Mr. John Smith met Mrs Anna Maria Kay; Mr John Smith left. Госпожа Ирина Петрова. Version 2.0. of 1.2.3. Année 2024 été.09@mail2.example.com.
Then SMITH and Smith's dog saw Kay; John Smith paid; Иван Петров and Петрова wrote to иван@почта.рф. Κυρία Ελένη Νίκου."""


def run(spark, rows, key="k"):
    df = spark.createDataFrame([(i, t, "m", 1, 2, 3, 4) for i, t in rows], "doc_id long, text string, entity string, attempt int, _text int, digest int, `a.b` int")
    out = pii.pseudonymise(df, key)
    assert out.columns == [*df.columns, "mentions_found"]
    return [(r["doc_id"], r["text"], r["mentions_found"]) for r in out.collect()]


def luhn(digits):
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def mod97(account):
    x = re.sub("[^0-9A-Z]", "", account)
    return int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


# An independent version in plain Python --------------------------------------------------------------------------------

EXPRESSION = regex.compile(pii.ANY.replace("IsCyrillic", "Cyrillic").replace("IsGreek", "Greek"))
TITLES = {**dict.fromkeys(pii.MALE, "m"), **dict.fromkeys(pii.FEMALE, "f")}
KNOWN = {n: g for (_, g), names in pii.GIVEN.items() for n in names}


def kind_of(m):
    for kind, p in pii.KINDS[:-1]:
        if regex.fullmatch(p, m):
            return kind
    return "name"


def script_of(text):
    return "cyrillic" if regex.search(r"\p{Cyrillic}", text) else "greek" if regex.search(r"\p{Greek}", text) else "latin"


def whole_name(m):
    """The entities of a name's words, or None if it is no name by itself."""
    words = m.split(" ")
    title = words[0].rstrip(".") if words[0].rstrip(".") in TITLES else None
    if title:
        words = words[1:]
    elif words[0] not in KNOWN or len(words) == 1:
        return None
    gender = TITLES[title] if title else KNOWN[words[0]]
    script = script_of(m)
    out = [(w, f"name|{script}|g|{gender}|{w.lower()}") for w in words[:-1]]
    return [*out, (words[-1], f"name|{script}|s|{gender if script == 'cyrillic' else 'x'}|{words[-1].lower()}")]


def mentions(text):
    """(start, end, kind, parts) of each mention."""
    own = {}
    for m in EXPRESSION.finditer(text):
        for w, e in (whole_name(m[0]) or []) if kind_of(m[0]) == "name" else []:
            for v in (w, w.upper()):
                if len(w) > 2:
                    own[v] = min(own.get(v, e), e)
    words = "|".join(sorted(own))
    p = regex.compile(EXPRESSION.pattern + (rf"|(?:(?<!\p{{L}})(?:{words})(?:\x20(?:{words}))*(?!\p{{L}}))" if own else ""))
    out = []
    for m in p.finditer(text):
        kind = kind_of(m[0])
        if kind == "name":
            parts = whole_name(m[0]) or [(w, own[w]) for w in m[0].split(" ")]
        else:
            form = {"email": m[0].lower(), "ip": m[0], "phone": re.sub("[^0-9+]", "", m[0])}.get(kind, re.sub("[^0-9A-Z]", "", m[0]))
            parts = [(m[0], f"{kind}|{form}")]
        out.append((m.start(), m.end(), kind, parts))
    return out


def new_form(entity, attempt, key):
    h = hashlib.sha256(f"{key}\x1f{entity}\x1f{attempt}".encode()).hexdigest()
    low = h.translate(str.maketrans("abcdef", "012345"))
    number = lambda at, n: int(h[at - 1 : at - 1 + n], 16)
    kind, form = entity.split("|", 1)
    more = max(0, attempt - 4)
    if kind == "name":
        script, role, gender, _ = form.split("|")
        s = pii.SYLLABLES[script]
        syllables = lambda at: "".join(s[number(at + k, 1) % len(s)] for k in range(6))
        if role == "s":
            word = syllables(9) + (syllables(17) if more else "") + (("нова" if gender == "f" else "нов") if script == "cyrillic" else "")
        else:
            names = pii.GIVEN[script, "f" if gender == "f" else "m"]
            word = names[number(1, 6) % len(names)] + (syllables(17) if more else syllables(17)[:4] if attempt > 2 else "")
        return word.lower(), f"name|{script}|{role}|{gender}|{word.lower()}"
    first = str(number(1, 2) % 9 + 1)
    if kind == "email":
        spell = lambda x, script: x.translate(str.maketrans("0123456789abcdef", pii.LETTERS[script]))
        new = spell(h[:10], script_of(form.split("@")[0])) + "@" + spell(h[10:18], "latin") + ".example"
    elif kind == "ip":
        new = ".".join(str(number(1 + 4 * k, 4) % 254 + 1) for k in range(4))
    elif kind == "ssn":
        new = str(number(1, 2) % 5 + 1) + low[2:5] + str(number(7, 2) % 9 + 1) + low[8 : 11 + more] + str(number(33, 2) % 9 + 1)
    elif kind == "card":
        body = first + low[2 : len(form) + more]
        new = next(body + d for d in "0123456789" if luhn(body + d))
    elif kind == "iban":
        rest = "".join(low[k] if c.isdigit() else "ABCDEFGHIJKLMNOP"[int(h[k], 16)] for k, c in enumerate(form[4:]))
        new = next(x for x in (f"{form[:2]}{k:02d}{rest}" for k in range(2, 99)) if mod97(x))
    else:
        sign = re.match("[^0-9]*", form)[0]
        new = sign + first + low[2 : 2 + len(form) - len(sign) - 1 + more]
    return new, f"{kind}|{new}"


def brute(rows, key):
    found = [mentions(t) if t is not None else [] for _, t in rows]
    entities = sorted({e for ms in found for m in ms for _, e in m[3]}, key=lambda e: e.encode())
    attempt, clash = dict.fromkeys(entities, 0), True
    while clash:
        taken, clash = {}, []
        for e in sorted(entities, key=lambda e: (attempt[e], e.encode())):
            real = new_form(e, attempt[e], key)[1]
            if real in taken or real in attempt:
                clash.append(e)
            taken.setdefault(real, e)
        for e in clash:
            attempt[e] += 1
    out = []
    for (i, t), ms in zip(rows, found, strict=True):
        if t is None:
            out.append((i, None, []))
            continue
        text, at = "", 0
        for a, b, kind, parts in ms:
            m, new = t[a:b], [new_form(e, attempt[e], key)[0] for _, e in parts]
            if kind == "name":
                title = re.match(rf"(?:{'|'.join(TITLES)})\.? ", m)
                cased = (n.upper() if w == w.upper() and len(w) > 1 else n.title() for n, (w, _) in zip(new, parts, strict=True))
                said = (title[0] if title else "") + " ".join(cased)
            elif kind in ("email", "ip"):
                said = new[0].upper() if kind == "email" and m == m.upper() else new[0]
            else:
                left = iter(new[0])
                said = "".join(next(left) if re.match("[0-9A-Z+]", c) else c for c in m) + "".join(left)
            text, at = text + t[at:a] + said, b
        out.append((i, text + t[at:], [m[2] for m in ms]))
    return out


def test_forms(spark):
    ((_, text, kinds),) = run(spark, [(1, TEXT)])
    assert kinds == ["email", "email", "phone", "phone", "ip", "card", "card", "card", "ssn", "iban", "iban", *["name"] * 4, "email", *["name"] * 6, "email", "name"]
    for secret in ("Doe", "DOE", "555", "7479", "22.102.42.45", "7536784127813050", "4845168114407329", "4970-1012", "45-6789", "5001 0517", "NWBK", "Smith", "SMITH", "Maria", "Kay", "Петров", "Иван", "иван", "été.09", "Νίκου"):
        assert secret not in text
    m = re.match(r"Write to (\S+) or (\S+), call (\+\d \(\d{3}\) \d{3}-\d{4}) or (\+\d\.\d{3}\.\d{3}\.\d{4}),\nfrom (\d+\.\d+\.\d+\.\d+)\. Cards (\d{16}) (\d{16}) and (\d{4}-\d{4}-\d{4}-\d{4}); id (\d{3}-\d\d-\d{4}), (DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d), (GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d)\.\n", text)
    assert m and m[1].upper() == m[2] and re.sub(r"\D", "", m[3]) == re.sub(r"\D", "", m[4])
    assert all(luhn(re.sub(r"\D", "", m[k])) for k in (6, 7, 8)) and mod97(m[10]) and mod97(m[11])
    names = re.search(r"Mr\. (\w+ \w+) met Mrs (\w+ \w+ \w+); Mr (\w+ \w+) left\. Госпожа ([А-я]+) ([А-я]+)\. Version 2\.0\. of 1\.2\.3\. Année 2024 ", text)
    assert names and names[1] == names[3] and names[1].split()[0] in pii.GIVEN["latin", "m"] and names[2].split()[0] in pii.GIVEN["latin", "f"] and names[4] in pii.GIVEN["cyrillic", "f"]
    later = re.search(r"Then (\w+) and (\w+)'s dog saw (\w+); (\w+ \w+) paid; ([А-я]+) ([А-я]+) and ([А-я]+) wrote to ([а-я]+)@", text)
    surname = names[1].split()[1]
    assert (later[1], later[2], later[4], later[3], later[7]) == (surname.upper(), surname, names[1], names[2].split()[2], names[5])
    assert later[5] in pii.GIVEN["cyrillic", "m"] and later[6].endswith("ов")


def test_matches_brute_force_and_cases(spark):
    rows = [(1, TEXT), (1, TEXT), (2, None), (3, ""), (None, "a@b.example"), (4, "nothing here, 12 of 34"), (5, "x " * 60_000 + "a@b.example"), (6, "Mr O'Brien-Kay and Dr. Who, mr john"), (7, "Frau Müller; MÜLLER. Sarah Connor, Connors")]
    rows += [(10 + k, f"Mr {n} Kay{k % 7} or +1{k}{k} at 1.2.3.{k} u{k}@x.org, {4000 + k} 1234 5678 9012") for k, n in enumerate(["John", "Peter", "Xaver"] * 15)]
    assert sorted(run(spark, rows), key=str) == sorted(brute(rows, "k"), key=str)
    assert run(spark, []) == []
    other = run(spark, [(None, "a@b.example")], key="another")
    assert other[0][1] != brute([(None, "a@b.example")], "k")[0][1]


def test_distinct_surrogates_under_collisions(spark, monkeypatch):
    # A hash of few values makes nearly all collide at first.
    monkeypatch.setattr(pii, "_hash", lambda key, e, a: F.sha2(F.pmod(F.xxhash64(e, a), F.lit(150)).cast("string"), 256))
    rows = [(k, f"u{k % 40}@mail.example.com and 10.0.0.{k % 40} and U{k % 40}@MAIL.example.com") for k in range(80)]
    got = run(spark, rows)
    found = {}
    for i, t, _ in got:
        a, _, b, _, c = t.split(" ")
        assert a == c
        assert found.setdefault(i % 40, (a, b)) == (a, b)
    assert len({a for a, _ in found.values()}) == len({b for _, b in found.values()}) == 40


def test_surrogates_are_no_real_entities(spark):
    first = spark.createDataFrame([("ip|1.2.3.4",)], "entity string")
    one = F.array(F.struct("entity", F.lit(0).alias("attempt")))
    new = "ip|" + first.select(pii._drawn(one, "entity attempt", "k")[0]["new"]).first()[0]
    both = first.union(spark.createDataFrame([(new,)], "entity string"))
    assert {r["entity"]: r["attempt"] for r in pii.tries(both, "k").collect()}["ip|1.2.3.4"] > 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    got = pii.op8_pii_surrogates(spark, sf).collect()
    was = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(got) == len(was)
    for r in got:
        emails = re.findall(r"[\w.]+@mail\d\.example\.com", was[r["doc_id"]], re.I)
        assert r["n_email"] == len(emails) and not any(e in r["text"] for e in emails)
        phones, cards = re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}", was[r["doc_id"]]), re.findall(r"(?<!\d)\d{16}(?!\d)", was[r["doc_id"]])
        ips = re.findall(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d])", was[r["doc_id"]])
        assert (r["n_phone"], r["n_card"], r["n_ip"], r["n_name"]) == (len(phones), len(cards), len(ips), 0)
        assert not any(x in r["text"] for x in phones + cards + ips)


def test_query_takes_the_key_of_the_session(spark, tmp_path):
    spark.createDataFrame([(1, "a@b.example")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    text = lambda: pii.op8_pii_surrogates(spark, str(tmp_path)).first()["text"]
    assert text() != text()
    spark.conf.set("spark.noticelake.surrogates.key", "k")
    try:
        assert text() == text() == brute([(1, "a@b.example")], "k")[0][1]
    finally:
        spark.conf.unset("spark.noticelake.surrogates.key")


def test_short_forms_that_are_used_up(spark):
    # All of +10000 to +59999 are real, more than half of the surrogates of that form.
    numbers = [f"+{k}" for k in range(10_000, 60_000)]
    got = run(spark, [(k, "\n".join(numbers[k::20])) for k in range(20)])
    new = [x for _, t, _ in got for x in t.split("\n")]
    assert len(set(new)) == len(new) == 50_000 and not set(new) & set(numbers)
    assert all(re.fullmatch(r"\+\d{5,}", x) for x in new)


def test_long_runs_of_words_labels_and_hyphens(spark):
    """A loop of the regular expressions that recursed once a turn would end the executor here."""
    n = 100_000
    rows = [(1, "Mr John Smith left. " + "Smith " * n), (2, "Mr A" + "-A" * n + " left"), (3, "a@b" + ".b" * n), (4, "Mr John Smith. " + "Smith-Smith " * n), (5, "x@y.com " * n)]
    got = {i: (t, found) for i, t, found in run(spark, rows)}
    assert len(set(got[1][0].split("left. ")[1].split())) == 1 and "Smith" not in got[1][0] and got[1][1] == ["name", "name"]
    assert got[2][0].endswith(" left") and "-A-A" not in got[2][0] and got[2][1] == ["name"]
    assert got[3] == (rows[2][1], []) and got[5][1] == ["email"] * n and len(set(got[5][0].split())) == 1
    assert "Smith" not in got[4][0]

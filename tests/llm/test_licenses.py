import random
from collections import Counter

from noticelake.llm import licenses


def brute(text):
    """Every unit against every template."""
    units, at = set(), 0
    text = text.replace("\r\n\r\n", "  \n\n").replace("\r\n", " \n")
    for block in text.split("\n\n"):
        start = at
        for line in block.split("\n"):
            units.add((start, start + len(line)))
            start += len(line) + 1
        units.add((at, at + len(block)))
        at += len(block) + 2
    units.add((0, len(text)))
    out = []
    for a, b in units:
        w = licenses.words(text[a:b])
        grams = Counter(zip(w, w[1:], strict=False))
        best = []
        for name, t in licenses.TEMPLATES:
            v = licenses.words(t)
            other = Counter(zip(v, v[1:], strict=False))
            total = grams.total() + other.total()
            if grams and 2 * (grams & other).total() / total >= 0.8:
                best.append((-2 * (grams & other).total() / total, name))
        if best:
            out.append((a, b, min(best)[1], -min(best)[0]))
    return sorted(out)


def test_matches_brute_force(spark):
    rng = random.Random(6)
    texts = []
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(0, 6)):
            w = rng.choice(licenses.TEMPLATES)[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                w[rng.randrange(len(w))] = rng.choice(["new", "The", "2.0", ""])
            if len(w) > 20:
                w.insert(len(w) // 2, "\n")
            parts.append(rng.choice([" ".join(w), " ".join(w).upper(), "plain words in a line"]))
        texts.append(rng.choice(["\n", "\n\n", "\n"]).join(parts))
    texts += [t.replace("\n", "\r\n") for t in texts[:40]]
    rows = list(enumerate(texts)) + [(0, texts[0]), (None, texts[1]), (900, None), (901, ""), (902, "\n" * 5), (903, "word " * 50_000 + "\nReleased under the MIT License.")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, found string")
    got = sorted((str(r["id"]), [tuple(x) for x in r["found"]]) for r in licenses.scan_licenses(df).collect())
    assert got == sorted((str(i), brute(t or "")) for i, t in rows)
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def test_lines_that_end_in_two_characters():
    known = licenses.Templates(licenses.TEMPLATES, licenses.THRESHOLD)
    name, words = next((n, t.split()) for n, t in licenses.TEMPLATES if len(t.split()) > 60)
    wrapped = "\n".join(" ".join(words[k : k + 12]) for k in range(0, len(words), 12))
    unix = f"/* x */\n\n{wrapped}\n\nint main() {{}}\n"
    found = [x[2] for x in known.scan(unix)]
    assert name in found and [x[2:] for x in known.scan(unix.replace("\n", "\r\n"))] == [x[2:] for x in known.scan(unix)]

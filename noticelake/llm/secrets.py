"""Operator 1, secret scans with multipart credential linking (DataFrame functions only).

Base findings stand alone: assignments to a secret's name, access identifiers, long hex runs. Weak
candidates (an identifier, a mixed token, an endpoint) are reported only where a part that completes them
lies within a scope and apart from them: identifier and endpoint need a secret, a mixed token needs an identifier or
endpoint. An endpoint is its address; what stands in its query counts as beside it, so a token there completes it, but
a part of its path does not. An endpoint that holds user and password is complete by itself. Every finding tells its
links: the role and the place of the nearest part of each kind that completes it, before and after.

Each text is matched where it is read. A match list and the texts between matches give lengths only; the
rows that travel are (id, digest, kind, position, lengths) and one marker per document, never text. One
shuffle by document then serves all that follows: running sums turn lengths into places, the interval join
is a pair of running extremes over the places where spans begin and stop (the nearest part of each role that stopped
before a span begins, and that begins after it stops), so no pairs are formed, and a last grouping joins the spans of
a document. Repeated rows are merged per input partition before any shuffle.

Defined cases: null text is empty; repeated rows (same id and text) are each reported, with the same spans;
null ids are kept; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticelake.llm.common import table, text_of

#: Code points between parts of one credential, at most.
SCOPE = 200

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
IDENT = r"""(?i:access_?key_?id|client_?id|user_?name|user|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{4,}"""
KEY = r"[A-Za-z0-9+/_-]{32,}={0,2}"
ENDPOINT = r"""(?i:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3)://[^\s"'<>]+"""

#: kind, role, pattern; the first three are the base kinds. Kinds sort in this order.
KINDS = (
    ("assign", "secret", ASSIGN),
    ("access", "identifier", ACCESS),
    ("hex", "secret", HEX),
    ("ident", "identifier", IDENT),
    ("key", "secret", KEY),
    ("endpoint", "endpoint", ENDPOINT),
)
BASE = 3
#: What completes a part.
WANTS = {"secret": ("identifier", "endpoint"), "identifier": ("secret",), "endpoint": ("secret",)}
#: An endpoint with user and password.
USERINFO = r"^[a-zA-Z0-9:]+://[^\s/?#:@]+:[^\s/?#@]+@"


def _may_match(kind: str, text: Column, pattern: str) -> Column:
    """A cheap test that holds for every text with a match."""
    if kind == "assign":
        low = F.lower(text)
        named = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api_key") | low.contains("apikey")
        return named & text.rlike(pattern)
    if kind == "access":
        return text.contains("AKIA")
    if kind == "endpoint":
        return text.contains("://")
    return text.rlike(pattern)


def _counts(kind: str, match: Column) -> Column:
    """Whether a match is a finding: what the pattern cannot say without changing where later matches begin."""
    if kind == "assign":
        return F.length(F.regexp_extract(match, ASSIGN, 2)) >= 6
    if kind == "key":
        return match.rlike("[0-9]") & match.rlike("[a-z]") & match.rlike("[A-Z]")
    return F.lit(True)


def _matches(number: int, text: Column) -> Column:
    """array<struct<kind, pos, gap, len, core, alone, ok>>: every match of a kind, and the length of the text before it."""
    kind, _, pattern = KINDS[number]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    listed = F.transform(
        F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: F.struct(m.alias("m"), g.alias("g"))),
        lambda x, i: F.struct(
            F.lit(number).alias("kind"),
            i.alias("pos"),
            F.length(x["g"]).alias("gap"),
            F.length(x["m"]).alias("len"),
            F.length(F.regexp_extract(x["m"], r"^[^?#]*", 0) if kind == "endpoint" else x["m"]).alias("core"),
            (x["m"].rlike(USERINFO) if kind == "endpoint" else F.lit(False)).alias("alone"),
            _counts(kind, x["m"]).alias("ok"),
        ),
    )
    return F.when(_may_match(kind, text, pattern), listed).otherwise(F.array().cast("array<struct<kind:int,pos:int,gap:int,len:int,core:int,alone:boolean,ok:boolean>>"))


def _placed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, digest, kind, start, stop, end, alone, copies: the findings, and a row of kind -1 for each different document."""
    marker = F.array(F.struct(F.lit(-1).alias("kind"), F.lit(0).alias("pos"), F.lit(0).alias("gap"), F.lit(0).alias("len"), F.lit(0).alias("core"), F.lit(False).alias("alone"), F.lit(True).alias("ok")))
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = rows.select("id", F.unhex(F.sha2("text", 256)).alias("digest"), F.inline(F.concat(marker, *(_matches(k, F.col("text")) for k in range(len(KINDS))))))
    once = rows.groupBy("id", "digest", "kind", "pos", "gap", "len", "core", "alone", "ok").agg(F.count(F.lit(1)).alias("copies")).repartition("id", "digest")
    end = F.sum(F.col("gap") + F.col("len")).over(Window.partitionBy("id", "digest", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    start = F.col("end") - F.col("len")
    return once.withColumn("end", end).filter("ok").select("id", "digest", "kind", start.alias("start"), (start + F.col("core")).alias("stop"), "end", "alone", "copies")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per document: id, found: array<struct<start, number, end, kind, weak, links>> by start, then kind as listed.

    links: array<struct<role, at>>, the parts that complete a finding: where one stops before it or begins after it.
    """
    role = F.element_at(F.array(*(F.lit(r) for _, r, _ in KINDS)), F.col("kind") + 1)
    placed = _placed(docs, id_col, text_col).withColumn("role", F.when(F.col("kind") >= 0, role))
    # Every span has a place where it stops and one where it begins; at one place, stops come first.
    events = placed.select("*", F.inline(F.array(F.struct(F.col("stop").alias("at"), F.lit(0).alias("side")), F.struct(F.col("start").alias("at"), F.lit(1).alias("side")))))
    whole = Window.partitionBy("id", "digest")
    before = whole.orderBy("at", "side").rowsBetween(Window.unboundedPreceding, -1)
    after = whole.orderBy(F.desc("at"), F.desc("side")).rowsBetween(Window.unboundedPreceding, -1)
    for r in WANTS:
        mine = F.col("role") == r
        events = events.withColumn(f"before_{r}", F.max(F.when(mine & (F.col("side") == 0), F.col("at"))).over(before))
        events = events.withColumn(f"after_{r}", F.min(F.when(mine & (F.col("side") == 1), F.col("at"))).over(after))
    keys = ["id", "digest", "kind", "start", "stop", "end", "alone", "copies", "role"]
    spans = events.groupBy(*keys).agg(*(F.max(F.when(F.col("side") == int(w == "before"), F.col(f"{w}_{r}"))).alias(f"{w}_{r}") for r in WANTS for w in ("before", "after")))
    links = []
    for r in WANTS:
        wanted = F.col("role").isin([own for own, wants in WANTS.items() if r in wants])
        for w, gap in (("before", F.col("start") - F.col(f"before_{r}")), ("after", F.col(f"after_{r}") - F.col("stop"))):
            links.append(F.when(wanted & (gap <= scope), F.struct(F.lit(r).alias("role"), F.col(f"{w}_{r}").alias("at"))))
    linked = spans.withColumn("links", F.filter(F.array(*links), lambda x: x.isNotNull()))
    reported = (F.col("kind") < BASE) | F.col("alone") | (F.size("links") > 0)
    name = F.element_at(F.array(*(F.lit(k) for k, _, _ in KINDS)), F.col("kind") + 1)
    span = F.when((F.col("kind") >= 0) & reported, F.struct("start", F.col("kind").alias("number"), "end", name.alias("kind"), (F.col("kind") >= BASE).alias("weak"), "links"))
    joined = linked.groupBy("id", "digest").agg(F.sort_array(F.collect_list(span)).alias("found"), F.max(F.when(F.col("kind") < 0, F.col("copies"))).alias("copies"))
    return joined.select("id", "found", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("id", "found")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("found", lambda s: s["number"] == k)).cast("long")
    spelled = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("found", lambda s: ~s["weak"])
    return found.select(
        F.col("id").alias("doc_id"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(spelled(base), 256).alias("base_sha256"),
        spelled(F.col("found")).alias("spans"),
        F.array_join(F.flatten(F.transform("found", lambda s: F.transform(s["links"], lambda x: F.concat(s["start"].cast("string"), F.lit(":"), s["end"].cast("string"), F.lit(">"), x["role"], F.lit("@"), x["at"].cast("string"))))), ",").alias("links"),
    )


QUERIES = {"op1_secret_scan": op1_secret_scan}


def _oracle() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    extra = {"assign": f"length(regexp_extract(m, {quote(ASSIGN)}, 2)) >= 6", "key": "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]')"}
    parts = [
        f"""SELECT r, {k} AS number, '{kind}' AS kind, '{role}' AS role, m, g, pos, ({extra.get(kind, 'true')}) AS ok
FROM (SELECT r, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS g, generate_subscripts(ms, 1) AS pos
      FROM (SELECT r, regexp_extract_all(t, {quote(p)}) AS ms, string_split_regex(t, {quote(p)}) AS gs FROM d))"""
        for k, (kind, role, p) in enumerate(KINDS)
    ]
    near = ", ".join(f"(SELECT max(y.stop_) FROM spans y WHERE y.r = x.r AND y.role = '{r}' AND y.stop_ <= x.start_) AS before_{r}, (SELECT min(y.start_) FROM spans y WHERE y.r = x.r AND y.role = '{r}' AND y.start_ >= x.stop_) AS after_{r}" for r in WANTS)
    links = []
    for r in WANTS:
        wanted = ", ".join(f"'{own}'" for own, wants in WANTS.items() if r in wants)
        for at, gap in ((f"before_{r}", f"start_ - before_{r}"), (f"after_{r}", f"after_{r} - stop_")):
            links.append(f"CASE WHEN role IN ({wanted}) AND {gap} <= {SCOPE} THEN start_ || ':' || end_ || '>{r}@' || {at} END")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
hits AS ({" UNION ALL ".join(parts)}),
placed AS (SELECT *, sum(length(g) + length(m)) OVER (PARTITION BY r, number ORDER BY pos ROWS UNBOUNDED PRECEDING) AS end_ FROM hits),
spans AS (SELECT r, number, kind, role, CAST(end_ - length(m) AS BIGINT) AS start_, CAST(end_ AS BIGINT) AS end_,
  CAST(end_ - length(m) + CASE WHEN number = 5 THEN length(regexp_extract(m, '^[^?#]*')) ELSE length(m) END AS BIGINT) AS stop_,
  number = 5 AND regexp_matches(m, {quote(USERINFO)}) AS alone FROM placed WHERE ok),
linked AS (SELECT *, list_filter([{", ".join(links)}], lambda x: x IS NOT NULL) AS links FROM (SELECT x.*, {near} FROM spans x)),
told AS (SELECT r, count(*) FILTER (number = 0) AS n0, count(*) FILTER (number = 1) AS n1, count(*) FILTER (number = 2) AS n2,
  string_agg(kind || ':' || start_ || ':' || end_, ',' ORDER BY start_, number) FILTER (number < {BASE}) AS base,
  string_agg(kind || ':' || start_ || ':' || end_, ',' ORDER BY start_, number) AS spans,
  string_agg(array_to_string(links, ','), ',' ORDER BY start_, number) FILTER (len(links) > 0) AS links
  FROM linked WHERE number < {BASE} OR alone OR len(links) > 0 GROUP BY r)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(links, '') AS links
FROM d LEFT JOIN told USING (r)
"""


ORACLES = {"op1_secret_scan": _oracle()}

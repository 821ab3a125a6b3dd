"""Operator 13, conversation structure repair by a DuckDB recursive query inside hash-partitioned batches.

A conversation's rows are damaged in a repeatable way, their faults are found, and the cheapest edits are sought that
give role initials ``(s?(ua)+)?``. Edits: K keeps a row (0), R gives it the role user or assistant (1), D deletes it
(2; required for blank and duplicate rows), I inserts an empty turn (5); a truncated row that is not deleted adds 5.
Of equally cheap edits the ASCII-least audit counts.

The grammar has four states. One recursion of the query advances one row in all conversations of a batch at once and
keeps the least (cost, audit) of each state; a row's move may begin with one insertion. (Two insertions in a row lead
back to the same state or to one that deleting reaches for less, so they are never cheapest. At equal cost no audit
of the same rows is a proper beginning of another, so the least of each state is enough.)

Conversations are cut into segments of ``SEGMENT`` rows, each solved from every state that it may start in, and the
segments' results are put together in order, so the depth of the recursion has a bound. Conversations of up to
``LONG`` rows and ``LONG_BYTES`` are dealt by hash of their id, whole, in one shuffle. Rows of longer ones are
dealt by range of (id, turn, role, text), so that one conversation may lie in many tasks; their segments are solved
where they lie and only costs and audits meet. What stays sequential there is SHA-256 itself: a long conversation's
repaired rows stream through one hash, of which nothing but its state is held.

Defined cases: a null role or text is read as one space, and so are null ids and turns where the damage is drawn; a
null id is a conversation of its own; null turns come first; rows of one turn follow by role and text, as bytes, after
damage; repeated rows are rows; role initials are compared in their own case; an empty table gives an empty result;
other columns are never read. Turns are whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.llm.common import broadcast_if_few, checkpoint, dealt_checkpoint, table

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
INITIALS = "sua"
KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
TRUNCATION = 5
#: Where a role's initial leads.
STEP = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: Rows of a segment; rows and bytes past which a conversation is dealt by range; rows and bytes solved at once.
SEGMENT = 128
LONG = 20_000
LONG_BYTES = 32_000_000
BATCH = 20_000
BATCH_BYTES = 32_000_000

RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
COUNTS = ("blank", "duplicate", "truncated")


def moves() -> list[tuple[int, int, str, int, int, str]]:
    """(state, fault, initial, next state, cost, edits): the least way of taking one row; initial '' is any other."""
    out = []
    for state in range(4):
        inserted = [(STEP[state, r], INSERT, "I") for r in "ua" if (state, r) in STEP]
        for fault in range(4):
            for initial in (*INITIALS, ""):
                best: dict[int, tuple[int, str]] = {}
                for s, paid, done in [(state, 0, ""), *inserted]:
                    ways = [(s, DELETE, "D")]
                    if fault not in (BLANK, DUPLICATE):
                        more = TRUNCATION * (fault == TRUNCATED)
                        ways += [(STEP[s, r], cost + more, edit) for r, cost, edit in ((initial, KEEP, "K"), ("u", REROLE, "R"), ("a", REROLE, "R")) if (s, r) in STEP]
                    for to, cost, edit in ways:
                        best[to] = min(best.get(to, (99, "")), (paid + cost, done + edit))
                out += [(state, fault, initial, to, cost, edits) for to, (cost, edits) in best.items()]
    return out


_SOLVE = """
WITH RECURSIVE best(seg, start, place, state, way) AS (
    SELECT seg, start, 0, start, {'cost': 0, 'audit': ''} FROM starts
    UNION ALL
    SELECT b.seg, b.start, b.place + 1, m.next, min({'cost': b.way.cost + m.cost, 'audit': b.way.audit || m.edits})
    FROM best b JOIN places p ON p.seg = b.seg AND p.place = b.place
    JOIN moves m ON m.state = b.state AND m.fault = p.fault AND m.initial = p.initial
    GROUP BY b.seg, b.start, b.place + 1, m.next
)
SELECT b.seg, b.start, b.state, b.way.cost AS cost, b.way.audit AS audit
FROM best b JOIN (SELECT seg, max(place) + 1 AS size FROM places GROUP BY seg) s ON s.seg = b.seg AND s.size = b.place
"""


@lru_cache(maxsize=1)
def _connection():
    import duckdb

    con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
    con.execute("CREATE TABLE moves(state INT, fault INT, initial VARCHAR, next INT, cost INT, edits VARCHAR)")
    con.executemany("INSERT INTO moves VALUES (?, ?, ?, ?, ?, ?)", moves())
    return con


def solve(seg: np.ndarray, place: np.ndarray, fault: np.ndarray, initial: pa.Array, first: np.ndarray) -> list[dict[int, dict[int, tuple[int, str]]]]:
    """For each segment (numbered from 0): start -> end -> (cost, audit). first: segments that start in EMPTY only."""
    con = _connection()
    starts = np.concatenate([np.flatnonzero(first), np.repeat(np.flatnonzero(~first), 4)])
    states = np.concatenate([np.zeros(first.sum(), int), np.tile(np.arange(4), (~first).sum())])
    con.register("places", pa.table({"seg": pa.array(seg, pa.int32()), "place": pa.array(place, pa.int32()), "fault": pa.array(fault, pa.int32()), "initial": initial}))
    con.register("starts", pa.table({"seg": pa.array(starts, pa.int32()), "start": pa.array(states, pa.int32())}))
    found = con.sql(_SOLVE).to_arrow_table().to_pydict()
    con.unregister("places")
    con.unregister("starts")
    out: list[dict] = [{} for _ in range(len(first))]
    for s, start, end, cost, audit in zip(*(found[c] for c in ("seg", "start", "state", "cost", "audit")), strict=True):
        out[s].setdefault(start, {})[end] = (cost, audit)
    return out


def _joined(parts: list[dict[int, dict[int, tuple[int, str]]]]) -> dict[int, dict[int, tuple[int, list[str]]]]:
    """Segments' results in a row: start -> end -> (cost, audits of the segments). Neighbours are joined pairwise, level by level."""
    level = [{s: {e: (cost, audit, None) for e, (cost, audit) in ends.items()} for s, ends in p.items()} for p in parts]
    while len(level) > 1:
        longer = []
        for i in range(0, len(level) - 1, 2):
            a, b = level[i], level[i + 1]
            both: dict[int, dict] = {}
            for s, ends in a.items():
                best = both.setdefault(s, {})
                for mid, left in ends.items():
                    for e, right in b.get(mid, {}).items():
                        way = (left[0] + right[0], left[1] + right[1])
                        if e not in best or way < best[e][:2]:
                            best[e] = (*way, (left, right))
            longer.append(both)
        level = longer + level[len(longer) * 2 :]

    def leaves(way: tuple) -> list[str]:
        out, todo = [], [way]
        while todo:
            cost, audit, pair = todo.pop()
            if pair is None:
                out.append(audit)
            else:
                todo += [pair[1], pair[0]]
        return out

    return {s: {e: (way[0], leaves(way)) for e, way in ends.items()} for s, ends in level[0].items()}


def cheapest(parts: list[dict]) -> tuple[int, list[str]]:
    """The least cost of a conversation and the audits of its segments; a last insertion closes an open user turn."""
    if not parts:
        return 0, []
    ends = _joined(parts)[EMPTY] if len(parts) > 1 else {e: (cost, [audit]) for e, (cost, audit) in parts[0][EMPTY].items()}
    ways = [ends[e] for e in (EMPTY, ASSISTANT) if e in ends]
    if USER in ends:
        cost, audits = ends[USER]
        ways.append((cost + INSERT, [*audits[:-1], audits[-1] + "I"]))
    return min(ways, key=lambda w: (w[0], "".join(w[1]))) if len(ways) > 1 else ways[0]


def lines_of(audit: str, state: int, roles: list[str]) -> tuple[list[tuple[str | None, int]], int]:
    """What an audit of some rows gives: (role, number of the row, -1 if inserted) in order, and the state after it."""
    out, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        if edit == "K":
            initial = roles[at][:1]
        else:
            initial = "a" if state == USER else "u"
        role = roles[at] if edit == "K" else "assistant" if initial == "a" else "user"
        out.append((role, -1 if edit == "I" else at))
        at += edit != "I"
        state = STEP[state, initial]
    return out, state


def _in_order() -> list[Column]:
    return [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def _spaced(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damaged(turns: DataFrame) -> DataFrame:
    """``turns``: conv, turn, role, text. With damage done, and ``gone`` for rows that are dropped (kept as a sign of their conversation)."""
    draw = F.crc32(F.concat(_spaced(F.col("conv")), F.lit(":"), _spaced(F.col("turn")))) % 20
    rows = turns.select("conv", "turn", _spaced(F.col("role")).alias("role"), _spaced(F.col("text")).alias("text"), draw.alias("draw"))
    gone = F.col("draw") == 0
    text = F.when(F.col("draw") == 1, F.lit("")).when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    done = rows.select("conv", F.when(~gone, F.col("turn")).alias("turn"), F.when(gone, "").when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"), F.when(gone, "").otherwise(text).alias("text"), gone.alias("gone"), F.explode(times).alias("copy"))
    return done.drop("copy")


def _plain_fault(text: Column) -> Column:
    """The fault that a row's own text shows."""
    bare = F.rtrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", BLANK).when(F.substring(bare, -1, 1).isin(".", "!", "?"), NONE).otherwise(TRUNCATED).cast("int")


def _initials(roles: list[str]) -> list[str]:
    return [r[:1] if r and r[0] in INITIALS else "" for r in roles]


def _illegal(initials: list[str], same: np.ndarray) -> np.ndarray:
    """Whether each row but the first and its predecessor (of the same conversation) break the alternation."""
    code = np.array([INITIALS.find(i) if i else 3 for i in initials], np.int64)
    pair = code[:-1] * 4 + code[1:]
    return same & ~np.isin(pair, [INITIALS.index(a) * 4 + INITIALS.index(b) for a, b in ("su", "ua", "au")])


def _tables(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Whole groups of rows, several at a time. ``batches`` are sorted by group; ``key`` tells neighbours apart."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BATCH or sum(b.nbytes for b in held) >= BATCH_BYTES:
            rows = pa.Table.from_batches(held)
            keys = rows[key].to_numpy()
            change = np.flatnonzero(keys[1:] != keys[:-1])
            if len(change):
                yield rows.slice(0, int(change[-1]) + 1)
                held = rows.slice(int(change[-1]) + 1).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _repair_table(rows: pa.Table) -> pa.Table:
    """One row per conversation of ``rows`` (conv, key, turn, role, text, fault, gone; whole conversations in order)."""
    keys = rows["key"].to_numpy()
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    of_all = np.zeros(len(keys), np.int64)
    of_all[heads[1:]] = 1
    of_all = np.cumsum(of_all)
    there = ~rows["gone"].to_numpy()
    live = rows.filter(pa.array(there)).combine_chunks()
    conv, n, total = of_all[there], live.num_rows, len(heads)
    first_row = np.searchsorted(conv, np.arange(total))
    place = np.arange(n) - first_row[conv] if n else np.zeros(0, np.int64)
    roles, texts, fault = live["role"].to_pylist(), live["text"].to_pylist(), live["fault"].to_numpy().copy()
    if n:
        con = _connection()
        con.register("live", pa.table({"i": pa.array(np.arange(n)), "conv": pa.array(conv), "role": live["role"], "text": live["text"]}))
        again = con.sql("SELECT i FROM live QUALIFY row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1").to_arrow_table()["i"].to_numpy()
        con.unregister("live")
        fault[again] = np.where(fault[again] == BLANK, BLANK, DUPLICATE)
    initials = _initials(roles)
    fresh = place % SEGMENT == 0
    seg = np.cumsum(fresh) - 1
    found = solve(seg, place % SEGMENT, fault, pa.array(initials, pa.string()), place[fresh] == 0) if n else []
    counts = {name: np.bincount(conv[fault == k], minlength=total) for name, k in zip(COUNTS, (BLANK, DUPLICATE, TRUNCATED), strict=True)}
    illegal = np.bincount(conv[1:][_illegal(initials, conv[1:] == conv[:-1])], minlength=total) if n else np.zeros(total, np.int64)
    known = live["turn"].is_valid().to_numpy() if n else np.zeros(0, bool)
    turn, owner = live["turn"].fill_null(0).to_numpy()[known], conv[known]
    gaps = np.zeros(total, np.int64)
    if len(turn):
        new = np.append(True, (owner[1:] != owner[:-1]) | (turn[1:] != turn[:-1]))
        head, tail = np.append(True, owner[1:] != owner[:-1]), np.append(owner[1:] != owner[:-1], True)
        gaps[owner[head]] = turn[tail] - turn[head] + 1 - np.bincount(owner[new], minlength=total)[owner[head]]
    edges, seg_of = np.append(first_row, n), np.append(seg, len(found))
    cost, audit, digest = [], [], []
    for c in range(total):
        a, b = int(edges[c]), int(edges[c + 1])
        paid, audits = cheapest(found[seg_of[a] : seg_of[b]]) if b > a else (0, [])
        line, _ = lines_of("".join(audits), EMPTY, roles[a:b])
        cost.append(paid)
        audit.append("".join(audits))
        digest.append(hashlib.sha256("\n".join(f"{r}:{texts[a + i] if i >= 0 else ''}" for r, i in line).encode()).hexdigest())
    names = {"gaps": gaps, **counts, "illegal": illegal, "cost": cost}
    return pa.table({"conv": rows["conv"].take(pa.array(heads)), **{k: pa.array(v, pa.int64()) for k, v in names.items()}, "audit": pa.array(audit, pa.string()), "repaired_sha256": pa.array(digest, pa.string())})


def _repair_short(rows: DataFrame, kind: str) -> DataFrame:
    """``rows``: conv, turn, role, text, gone. Whole conversations by hash of their id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _tables(batches, "key"):
            yield from _repair_table(whole).combine_chunks().to_batches()

    key = F.concat(F.when(F.col("conv").isNull(), "0").otherwise("1"), F.coalesce(F.col("conv").cast("string"), F.lit("")))
    dealt = rows.repartition("conv").sortWithinPartitions(*_in_order())
    return dealt.select("*", key.alias("key"), _plain_fault(F.col("text")).alias("fault")).mapInArrow(run, f"conv {kind}, {RESULT}")


_PIECE = "part int, seg long, cost_of array<struct<start:int,state:int,cost:long,audit:string>>, rows long, head string, tail string, blank long, duplicate long, truncated long, illegal long, least long, most long, turns long"


def _segments(rows: DataFrame, kind: str) -> DataFrame:
    """One row per segment of ``rows`` (conv, key, part, seg, place, turn, role, fault; sorted), solved from every state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _tables(batches, "seg"):
            df, convs = rows.to_pandas(), rows["conv"]
            names = df["seg"].to_numpy()
            seg = np.cumsum(np.append(0, names[1:] != names[:-1]))
            initials = _initials(df["role"].tolist())
            heads = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
            found = solve(seg, df["place"].to_numpy(), df["fault"].to_numpy(), pa.array(initials, pa.string()), np.zeros(len(heads), bool))
            bad = np.append(False, _illegal(initials, seg[1:] == seg[:-1]))
            out = []
            for s, (a, b) in enumerate(zip(heads, np.append(heads[1:], len(df)), strict=True)):
                turn, fault = df["turn"].iloc[a:b].dropna(), df["fault"].to_numpy()[a:b]
                ways = [{"start": x, "state": y, "cost": cost, "audit": audit} for x, ends in found[s].items() for y, (cost, audit) in ends.items()]
                least, most = (int(turn.iloc[0]), int(turn.iloc[-1])) if len(turn) else (None, None)
                out.append({"conv": convs[int(a)].as_py(), "part": int(df["part"].iloc[a]), "seg": int(names[a]), "cost_of": ways, "rows": int(b - a), "head": initials[a], "tail": initials[b - 1], "blank": int((fault == BLANK).sum()), "duplicate": int((fault == DUPLICATE).sum()), "truncated": int((fault == TRUNCATED).sum()), "illegal": int(bad[a:b].sum()), "least": least, "most": most, "turns": int(turn.nunique())})
            yield pa.RecordBatch.from_pylist(out, schema=wanted)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    wanted = to_arrow_schema(_parse_datatype_string(f"conv {kind}, {_PIECE}"))
    return rows.mapInArrow(run, f"conv {kind}, {_PIECE}")


def _numbered(dealt: DataFrame, kind: str) -> DataFrame:
    """``dealt`` (sorted within partitions, n copies of each row) as single rows with part, seg and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seg, place, last, size = TaskContext.get().partitionId(), -1, 0, None, 0
        out: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                for copy in range(row["n"]):
                    if row["key"] != last or place == SEGMENT:
                        seg, place, last = seg + 1, 0, row["key"]
                    if len(out) >= BATCH or size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(out, schema=wanted)
                        out, size = [], 0
                    fault = row["fault"] if row["fault"] == BLANK or (row["first"] and not copy) else DUPLICATE
                    out.append({"conv": row["conv"], "part": part, "seg": seg, "place": place, "turn": row["turn"], "role": row["role"], "text": row["text"], "fault": fault})
                    place, size = place + 1, size + len(row["text"])
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=wanted)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    ddl = f"conv {kind}, part int, seg long, place int, turn long, role string, text string, fault int"
    wanted = to_arrow_schema(_parse_datatype_string(ddl))
    return dealt.mapInArrow(run, ddl)


def _composed(pieces: DataFrame, kind: str) -> DataFrame:
    """Per conversation its counts, cost and audit (seg -1), and per segment the state it starts in and its audit."""

    def run(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(["part", "seg"], ignore_index=True)
        parts = []
        for ways in df["cost_of"]:
            p: dict[int, dict] = {}
            for w in ways:
                p.setdefault(w["start"], {})[w["state"]] = (w["cost"], w["audit"])
            parts.append(p)
        cost, audits = cheapest(parts)
        # Segments that meet may share a turn, and their rows at the seam are neighbours too.
        seams = sum(int(_illegal([a, b], np.ones(1, bool))[0]) for a, b in zip(df["tail"], df["head"][1:], strict=False))
        known = df[df["least"].notna()]
        shared = int((known["most"].to_numpy()[:-1] == known["least"].to_numpy()[1:]).sum())
        gaps = int(known["most"].max() - known["least"].min()) + 1 - (int(known["turns"].sum()) - shared) if len(known) else 0
        out, state = [], EMPTY
        for p, s, audit in zip(df["part"], df["seg"], audits, strict=True):
            out.append({"part": p, "seg": s, "state": state, "audit": audit})
            inner = {e: way[1] for e, way in parts[len(out) - 1][state].items()}
            state = next((e for e, a in inner.items() if a == audit), ASSISTANT)
        total = {"part": -1, "seg": -1, "state": 0, "audit": "".join(audits), "gaps": gaps, "cost": cost, "illegal": int(df["illegal"].sum()) + seams} | {k: int(df[k].sum()) for k in COUNTS}
        done = pd.DataFrame([total, *out]).astype({k: "Int64" for k in ("gaps", "cost", "illegal", *COUNTS)})
        done.insert(0, "conv", [df["conv"].iloc[0]] * len(done))
        return done[["conv", "part", "seg", "state", "audit", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]]

    return pieces.groupBy("conv").applyInPandas(run, f"conv {kind}, part int, seg long, state int, audit string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long")


def _hashed(lines: DataFrame, kind: str) -> DataFrame:
    """``lines``: conv, key, line; dealt by conversation and sorted. One SHA-256 per conversation; lines stream through it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, conv, h = None, None, None
        for batch in batches:
            done = []
            for c, key, line in zip(batch["conv"].to_pylist(), batch["key"].to_pylist(), batch["line"].to_pylist(), strict=True):
                if key != last:
                    if h is not None:
                        done.append((conv, h.hexdigest()))
                    last, conv, h = key, c, hashlib.sha256()
                else:
                    h.update(b"\n")
                h.update(line.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], batch["conv"].type), pa.array([d for _, d in done])], ["conv", "repaired_sha256"])
        if h is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], batch["conv"].type), pa.array([h.hexdigest()])], ["conv", "repaired_sha256"])

    return lines.mapInArrow(run, f"conv {kind}, repaired_sha256 string")


def _repair_long(rows: DataFrame, kind: str) -> DataFrame:
    """``rows`` as in ``_repair_short``, of conversations that may be too long for one task."""
    every = rows.select("conv").distinct()
    live = rows.filter("NOT gone").groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    # Equal rows of a conversation: the one of the least turn (null before any) came first.
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    firsts = live.groupBy(F.col("conv").alias("own_conv"), F.col("role").alias("own_role"), F.col("text").alias("own_text")).agg(F.min(place).alias("least"))
    same = F.col("conv").eqNullSafe(F.col("own_conv")) & (F.col("role") == F.col("own_role")) & (F.col("text") == F.col("own_text"))
    first = F.col("turn").eqNullSafe(F.col("least.turn"))
    key = F.concat(F.when(F.col("conv").isNull(), "0").otherwise("1"), F.coalesce(F.col("conv").cast("string"), F.lit("")))
    marked = live.join(firsts, same).select("conv", "turn", "role", "text", "n", first.alias("first"), _plain_fault(F.col("text")).alias("fault"), key.alias("key"))
    # The range sample would run the joins a second time.
    marked = dealt_checkpoint(marked)
    dealt = marked.repartitionByRange(*_in_order()).sortWithinPartitions(*_in_order())
    numbered = dealt_checkpoint(_numbered(dealt, kind))
    found = checkpoint(_composed(dealt_checkpoint(_segments(numbered.drop("text"), kind)), kind))

    @F.pandas_udf("array<string>")
    def lines(audits: pd.Series, states: pd.Series, held: pd.Series) -> pd.Series:
        out = []
        for audit, state, own in zip(audits, states, held, strict=True):
            made, _ = lines_of(audit, state, [r["role"] for r in own])
            out.append([f"{r}:{own[i]['text'] if i >= 0 else ''}" for r, i in made])
        return pd.Series(out, dtype=object)

    held = numbered.groupBy("conv", "part", "seg").agg(F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("held"))
    slices = found.filter("seg >= 0").select(F.col("conv").alias("own_conv"), F.col("part").alias("own_part"), F.col("seg").alias("own_seg"), "state", "audit")
    here = F.col("conv").eqNullSafe(F.col("own_conv")) & (F.col("part") == F.col("own_part")) & (F.col("seg") == F.col("own_seg"))
    told = held.join(slices, here).select("conv", "part", "seg", F.posexplode(lines("audit", "state", "held")).alias("at", "line"), key.alias("key"))
    sums = _hashed(told.repartition("conv").sortWithinPartitions("conv", "part", "seg", "at").select("conv", "key", "line"), kind)
    totals = found.filter("seg < 0").select(F.col("conv").alias("t_conv"), *(F.col(c) for c in ("gaps", *COUNTS, "illegal", "cost", "audit")))
    sums = sums.withColumnRenamed("conv", "s_conv")
    out = every.join(totals, F.col("conv").eqNullSafe(F.col("t_conv")), "left").join(sums, F.col("conv").eqNullSafe(F.col("s_conv")), "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", *COUNTS, "illegal", "cost")]
    return out.select("conv", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", damage: bool = True, long: int = LONG, long_bytes: int = LONG_BYTES) -> DataFrame:
    """One row per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Without ``damage`` the rows are repaired as they are.
    """
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    kind = rows.schema["conv"].dataType.simpleString()
    sizes = rows.groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("bytes"))
    huge = checkpoint(sizes.filter((F.col("n") > long) | (F.col("bytes") > long_bytes)).select(F.col("conv").alias("huge")))
    rows = damaged(rows) if damage else rows.select("conv", "turn", _spaced(F.col("role")).alias("role"), _spaced(F.col("text")).alias("text"), F.lit(False).alias("gone"))
    if huge.isEmpty():
        return _repair_short(rows, kind)
    same, few = F.col("conv").eqNullSafe(F.col("huge")), broadcast_if_few(huge)
    return _repair_short(rows.join(few, same, "left_anti"), kind).unionByName(_repair_long(rows.join(few, same, "left_semi"), kind))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(table(spark, sf_dir, "conversations")).withColumnRenamed("conv", "conv_id")


QUERIES = {"op13_conversation_repair": op13_conversation_repair}

_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(s) + 1), lambda i: ascii(substr(s, i::INT, 1))::BIGINT)),
    lambda c, b: xor(c >> 8, list_reduce(list_prepend(xor(c, b) & 255, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))))"""

#: The same rules over whole conversations, edit by edit: one recursion takes one row, after at most one insertion.
ORACLES = {
    "op13_conversation_repair": rf"""
WITH RECURSIVE drawn AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC} % 20 AS d
    FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations)
), hurt AS (
    SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
           CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM drawn, (VALUES (0), (1)) c(copy) WHERE d <> 0 AND (copy = 0 OR d = 3)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM hurt
), faulty AS (
    SELECT *, left(role, 1) AS ini, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 AS again,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS before
    FROM placed
), marked AS (
    SELECT *, CASE WHEN bare = '' THEN 'b' WHEN again THEN 'd' WHEN right(bare, 1) IN ('.', '!', '?') THEN '' ELSE 't' END AS fault FROM faulty
), steps(state, ini, nxt) AS (VALUES ('e', 's', 's'), ('e', 'u', 'u'), ('s', 'u', 'u'), ('a', 'u', 'u'), ('u', 'a', 'a')
), ids AS (SELECT DISTINCT conv_id FROM conversations
), best(conv_id, k, state, way) AS (
    SELECT conv_id, 0::BIGINT, 'e', {{'cost': 0, 'audit': '', 'body': NULL::VARCHAR}} FROM ids
    UNION ALL
    SELECT conv_id, k, state, min(way) FROM (
        WITH opened AS (
            SELECT conv_id, k, state, way.cost AS cost, way.audit AS audit, way.body AS body FROM best
            UNION ALL
            SELECT conv_id, k, nxt, way.cost + 5, way.audit || 'I', concat_ws(chr(10), way.body, CASE nxt WHEN 'u' THEN 'user:' ELSE 'assistant:' END)
            FROM best JOIN steps USING (state) WHERE nxt <> 's'
        ), next_row AS (
            SELECT o.*, m.role, m.text, m.ini, m.fault FROM opened o JOIN marked m ON m.conv_id IS NOT DISTINCT FROM o.conv_id AND m.k = o.k + 1
        )
        SELECT conv_id, k + 1 AS k, state, {{'cost': cost + 2, 'audit': audit || 'D', 'body': body}} AS way FROM next_row
        UNION ALL
        SELECT conv_id, k + 1, nxt, {{'cost': cost + CASE fault WHEN 't' THEN 5 ELSE 0 END, 'audit': audit || 'K', 'body': concat_ws(chr(10), body, role || ':' || text)}}
        FROM next_row n JOIN steps s ON s.state = n.state AND s.ini = n.ini WHERE fault IN ('', 't')
        UNION ALL
        SELECT conv_id, k + 1, nxt, {{'cost': cost + 1 + CASE fault WHEN 't' THEN 5 ELSE 0 END, 'audit': audit || 'R', 'body': concat_ws(chr(10), body, CASE nxt WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text)}}
        FROM next_row n JOIN steps s ON s.state = n.state AND s.nxt <> 's' WHERE fault IN ('', 't')
    ) GROUP BY conv_id, k, state
), sizes AS (SELECT conv_id, max(k) AS n FROM marked GROUP BY conv_id
), ended AS (
    SELECT b.conv_id, min(CASE state WHEN 'u' THEN {{'cost': way.cost + 5, 'audit': way.audit || 'I', 'body': concat_ws(chr(10), way.body, 'assistant:')}} ELSE way END) AS way
    FROM best b JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM b.conv_id AND s.n = b.k WHERE state <> 's' GROUP BY b.conv_id
), told AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
           count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id
)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(e.way.cost, 0)::BIGINT AS cost, coalesce(e.way.audit, '') AS audit, sha256(coalesce(e.way.body, '')) AS repaired_sha256
FROM ids i LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM i.conv_id
""",
}

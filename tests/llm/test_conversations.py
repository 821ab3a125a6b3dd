"""Conversation repair against its SQL and against every possible edit sequence."""

import itertools
import re

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from noticelake.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"
COST = {"K": 0, "R": 1, "D": 2, "I": 5}


def sql(rows: list[tuple]) -> pd.DataFrame:
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations(conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if len(rows):
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [list(r) for r in rows])
    return con.execute(C.ORACLES["op13_conversation_repair"]).df()


def normal(df):
    return sorted(tuple("" if pd.isna(v) else str(int(v)) if isinstance(v, float) else str(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


def both(spark, data, **more):
    got = C.repair(spark.createDataFrame(data, SCHEMA), **more).withColumnRenamed("conv", "conv_id").toPandas()
    assert normal(got) == normal(sql(data))
    return got


def hard():
    data = [(1, t, r, x) for t, (r, x) in enumerate([("user", "Hi."), ("user", "Hi."), ("assistant", ""), (None, "Yes!"), ("system", None), ("User", "no stop"), ("", "End?  \n")])]
    data += [(2, None, "user", "a."), (2, None, "assistant", "b."), (2, 5, "user", "a."), (2, 5, "user", "a."), (2, 9, "tool", "z.")]
    data += [(None, t, "user" if t % 2 else "assistant", f"w {t}.") for t in range(9)]
    data += [(3, 3, "system", " \t\x0b")]
    roles = ["user", "assistant", "system", "tool", "unknown"]
    data += [(c, t, roles[(c * 7 + t * t) % 5], f"text {t * c % 11}" + (".", "", "!  ")[(t + c) % 3]) for c in range(10, 40) for t in range(c % 6, 20)]
    return data


def test_against_sql(spark):
    got = both(spark, hard())
    assert got["audit"].str.contains("R").any() and got["conv_id"].isna().sum() == 1


def test_long_conversations_dealt_by_range(spark):
    data = hard() + [(100, t // 2, ("user", "assistant", "system", "tool")[t * t % 7 % 4], f"line {t % 290}" + (".", " ")[t % 5 == 4]) for t in range(900)]
    short, long = both(spark, data), both(spark, data, long=4)
    assert normal(short) == normal(long)
    assert len(long.loc[long["conv_id"] == 100, "audit"].iloc[0]) > 3 * C.SEGMENT


def test_repeated_rows_and_extra_columns(spark):
    data = [(1, 1, "user", "same.")] * 300 + [(1, 2, "assistant", "fine.")]
    got = both(spark, data)
    assert normal(got) == normal(both(spark, data, long=10))
    made = spark.createDataFrame([(1, 1, "user", "A.", "x", 7)], SCHEMA + ", conv string, cost int")
    assert C.repair(made, damage=False).collect()[0][:] == (1, 0, 0, 0, 0, 0, 2, "D", C.hashlib.sha256().hexdigest())


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.repair(empty).count() == 0 and C.repair(empty, long=0).count() == 0


def test_all_rows_dropped(spark):
    import zlib

    gone = [c for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    got = both(spark, [(c, 0, "user", "x.") for c in gone])
    assert (got["audit"] == "").all() and (got["cost"] == 0).all() and len(got) == 3
    assert normal(got) == normal(both(spark, [(c, 0, "user", "x.") for c in gone], long=0))


def every_way(roles, faults):
    """(cost, audit) of all edit sequences with at most one insertion at each place."""
    best = None
    for edits in itertools.product(*[[i + e for i in ("", "I") for e in ("D",) + (() if f in (1, 2) else ("K", "u", "a"))] for f in faults], ["", "I"]):
        for fill in itertools.product("ua", repeat=sum("I" in e for e in edits)):
            fill, made, cost, audit = list(fill), "", 0, ""
            for k, e in enumerate(edits):
                if "I" in e:
                    made += fill.pop(0)
                    cost, audit = cost + 5, audit + "I"
                x = e.replace("I", "")
                if x:
                    made += {"D": "", "K": roles[k][:1] or "?"}.get(x, x)
                    sign = x if x in "DK" else "R"
                    cost += COST[sign] + (5 if faults[k] == 3 and x != "D" else 0)
                    audit += sign
            if re.fullmatch(r"(s?(ua)+)?", made) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "", "User"]), st.integers(0, 3)), min_size=1, max_size=4), st.integers(1, 3))
def test_against_every_edit_sequence(rows, width):
    roles, faults = [r for r, _ in rows], [f for _, f in rows]
    place = np.arange(len(rows))
    seg = place // width
    found = C.solve(seg, place % width, np.array(faults), pa.array(C._initials(roles), pa.string()), np.arange(seg[-1] + 1) == 0)
    cost, audits = C.cheapest(found)
    assert (cost, "".join(audits)) == every_way(roles, faults)


def test_query(spark):
    assert C.QUERIES["op13_conversation_repair"](spark, "/root/testdata/sf0.001").columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

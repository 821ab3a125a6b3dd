"""The set filter: no member is missed, few others pass, parts merge."""

import pytest
from pyspark.sql import functions as F

from noticelake.operators import delta
from noticelake.operators import membership as M
from noticelake.sources import files


@pytest.fixture(scope="module")
def keys(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") > 0, F.concat(F.lit("https://h/"), F.col("id"))).alias("url"), "id")
    return rows.cache()


def test_members_always_pass_and_few_others_do(keys):
    held = keys.filter("id % 4 = 0")
    blocks = M.blocks_for(5_000)
    told = M.with_possible(keys, M.filter_of(held, F.col("url"), blocks=blocks), blocks, F.col("url"))
    assert told.columns == ["url", "id", "possible"]
    assert told.filter("id % 4 = 0 AND NOT possible").isEmpty()
    assert told.filter("id % 4 <> 0 AND possible").count() < 15_000 * 0.02


def test_parts_merge(keys):
    blocks = 3
    parts = [M.filter_of(keys.filter(F.col("id") % 4 == k), F.col("url"), blocks=blocks) for k in (0, 1)]
    whole = {tuple(r) for r in M.filter_of(keys.filter("id % 4 < 2"), F.col("url"), blocks=blocks).collect()}
    assert {tuple(r) for r in M.merged(*parts).collect()} == whole and len(whole) == blocks
    with pytest.raises(Exception, match="filters of different sizes"):
        M.merged(parts[0], M.filter_of(keys, F.col("url"), blocks=1)).collect()


def test_full_and_empty_filters(keys):
    crowded = M.filter_of(keys.filter("id < 10000"), F.col("url"), blocks=1)
    assert M.with_possible(keys, crowded, 1, F.col("url")).filter("id < 10000 AND NOT possible").isEmpty()
    assert M.with_possible(keys, M.filter_of(keys.limit(0), F.col("url"), blocks=2), 2, F.col("url")).filter("possible").isEmpty()
    assert (M.blocks_for(0), M.blocks_for(32_768), M.blocks_for(10**12)) == (1, 12, M.MOST_BLOCKS)


def test_only_possible_hits_meet_the_old_snapshot(spark, tmp_path):
    """A stored filter of three snapshots: most new items never enter the join, and the result is the join's."""
    rows = spark.range(30_000).select(F.concat(F.lit("u"), "id").alias("url"), "id")
    root = str(tmp_path / "snapshots")
    for k in range(3):
        files.write_snapshot(rows.filter(f"id >= {k * 1000} AND id < {k * 1000 + 1500}"), root, f"v{k}", key="url", blocks=8)
    old = spark.read.parquet(root)
    known = files.read_key_filter(spark, root)
    new = rows.filter("id % 3 = 0").unionByName(spark.createDataFrame([(None, -1)], "url string, id long"))
    for prune in (False, True):
        got = delta.new_items_by_filter(new, old, known, 8, prune_old=prune)
        assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in delta.new_items(new, old).collect())
    met = M.with_possible(new, known, 8, F.col("url")).filter("possible").count()
    assert 1166 <= met < 1166 + 9000 * 0.02
    assert files.read_key_filter(spark, root, ["v0"]).count() == 8 and files.read_key_filter(spark, str(tmp_path / "none")).count() == 0

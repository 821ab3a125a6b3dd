"""Operator 9, approximate nearest neighbours on robust-pruned directed graphs, one per shard.

Equal vectors form one node that carries the k+1 smallest of their ids: more can never be among the k
nearest. Nodes are dealt by hash into shards of bounded size. A shard's graph grows from random links: a
greedy search proposes neighbours for every node, and robust pruning keeps a neighbour only if no kept one
is closer to it (by the factor alpha), first with alpha 1, then with a larger one that leaves long edges.
Vectors get one more component that makes all norms equal, so that nearest means largest inner product.

A shard is one task's: its nodes come first, sorted, then all queries. The task builds the graph, keeps it in memory
and streams the queries past it, so no graph is ever shuffled and a lost task repeats its own shard only. A beam
search proposes nodes, which are scored again in double precision on the original vectors; the shards' best meet in
one ranking per query.

Defined cases: vectors that are null, all zero, or hold null or non-finite components take no part, nor do
those of another length than the most common one; equal scores rank by smaller id; repeated rows (same id
and vector) count once; rows with a null id are left out; an empty table or no queries give an empty result;
other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticelake.llm.common import checkpoint, table

#: Nodes of a shard, at most about. Tables of fewer than SPREAD such shards get up to SPREAD smaller ones, of SMALL nodes or
#: more. The number depends on the table alone, so a table gives the same result on any cluster.
SHARD = 65_536
SMALL = 8192
SPREAD = 8
#: Neighbours that pruning leaves, and links that a node may gather before it is pruned again.
DEGREE = 32
ROOM = 64
BUILD_BEAM = 64
SEARCH_BEAM = 128
ALPHA = 1.2
_CHUNK = 512
_START_LINKS = 16
_EXPAND = 4


def usable(vec: Column) -> Column:
    """Not null, not all zero, every component a finite number."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vec.isNotNull() & fine & F.exists(vec, lambda x: x != 0), F.lit(False))


class Graph:
    """Points (rows of equal norm), each with up to ROOM out-neighbours; -1 fills."""

    def __init__(self, points: np.ndarray, links: np.ndarray, entry: int):
        self.points, self.links, self.entry = points, links, entry

    def search(self, queries: np.ndarray, width: int, trail: bool = False) -> tuple[np.ndarray, np.ndarray] | np.ndarray:
        """Beam search of each query: the ids of its beam, nearest first (-1 fills). With trail, all expanded nodes too."""
        m, n = len(queries), len(self.points)
        rows = np.arange(m)[:, None]
        beam = np.full((m, width), -1)
        near = np.full((m, width), -np.inf, np.float32)
        done = np.ones((m, width), bool)
        beam[:, 0], near[:, 0], done[:, 0] = self.entry, queries @ self.points[self.entry], False
        seen, stamp = np.zeros((m, n + 1), bool), np.zeros((m, n + 1), np.int16)
        seen[:, self.entry] = seen[:, n] = True
        trails = []
        while True:
            value = np.where(done, -np.inf, near)
            pick = np.argpartition(-value, min(_EXPAND, width) - 1, axis=1)[:, :_EXPAND]
            live = value[rows, pick] > -np.inf
            if not live.any():
                break
            done[rows, pick] = True
            node = np.where(live, beam[rows, pick], -1)
            if trail:
                trails.append(node)
            found = np.where(node[:, :, None] >= 0, self.links[node], -1).reshape(m, -1)
            found = np.where(found < 0, n, found)
            place = np.arange(found.shape[1], dtype=np.int16)
            stamp[rows, found] = place[None, :]
            fresh = ~seen[rows, found] & (stamp[rows, found] == place[None, :])
            seen[rows, found] = True
            score = np.full(found.shape, -np.inf, np.float32)
            i, j = np.nonzero(fresh)
            score[i, j] = np.einsum("ij,ij->i", queries[i], self.points[found[i, j]])
            beam = np.concatenate([beam, np.where(fresh, found, -1)], axis=1)
            near = np.concatenate([near, score], axis=1)
            done = np.concatenate([done, ~fresh], axis=1)
            best = np.argpartition(-near, width - 1, axis=1)[:, :width]
            beam, near, done = beam[rows, best], near[rows, best], done[rows, best]
        order = np.argsort(-near, axis=1, kind="stable")
        beam = np.where(near > -np.inf, beam, -1)[rows, order]
        return (beam, np.concatenate(trails, axis=1)) if trail else beam

    def prune(self, nodes: np.ndarray, candidates: np.ndarray, alpha: float) -> np.ndarray:
        """Robust pruning: up to DEGREE of each node's candidates (-1 fills), diverse ones."""
        candidates = np.sort(np.where(candidates == nodes[:, None], -1, candidates), axis=1)
        candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
        rows = np.arange(len(nodes))
        vectors = self.points[candidates]
        norm2 = float(self.points[0] @ self.points[0])
        distance = np.where(candidates >= 0, norm2 - np.einsum("ijk,ik->ij", vectors, self.points[nodes]), np.inf)
        between = norm2 - vectors @ vectors.transpose(0, 2, 1)  # half the squared distances, as all norms are equal
        out = np.full((len(nodes), ROOM), -1, np.int32)
        for k in range(DEGREE):
            pick = distance.argmin(1)
            ok = distance[rows, pick] < np.inf
            if not ok.any():
                break
            out[ok, k] = candidates[rows, pick][ok]
            distance[(alpha * alpha * between[rows, pick] <= distance) & ok[:, None]] = np.inf
            distance[rows, pick] = np.inf
        return out

    def _add_back_links(self, nodes: np.ndarray, alpha: float) -> None:
        source = np.repeat(nodes, ROOM)
        target = self.links[nodes].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        to, first, count = np.unique(target, return_index=True, return_counts=True)
        used = (self.links[to] >= 0).sum(1)
        roomy = used + count <= ROOM
        mine = np.repeat(roomy, count)
        place = np.arange(len(source)) - np.repeat(first, count) + np.repeat(used, count)
        self.links[target[mine], place[mine]] = source[mine]
        # The others are pruned; those with like numbers of new links are padded together.
        size = np.where(roomy, 0, 1 << np.ceil(np.log2(count)).astype(int))
        for s in np.unique(size[size > 0]):
            full = np.flatnonzero(size == s)
            for at in range(0, len(full), _CHUNK):
                p = full[at : at + _CHUNK]
                place = first[p][:, None] + np.arange(s)[None, :]
                new = np.where(np.arange(s)[None, :] < count[p][:, None], source[np.minimum(place, len(source) - 1)], -1)
                self.links[to[p]] = self.prune(to[p], np.concatenate([self.links[to[p]], new], axis=1), alpha)


def build(points: np.ndarray, seed: int = 1) -> Graph:
    n = len(points)
    rng = np.random.default_rng(seed)
    links = np.full((n, ROOM), -1, np.int32)
    links[:, :_START_LINKS] = rng.integers(0, n, (n, _START_LINKS))
    centre = points.mean(0)
    g = Graph(points, links, int(((points - centre) ** 2).sum(1).argmin()))
    for alpha in (1.0, ALPHA):
        order = rng.permutation(n)
        for at in range(0, n, _CHUNK):
            nodes = order[at : at + _CHUNK]
            beam, trail = g.search(points[nodes], min(BUILD_BEAM, n), trail=True)
            g.links[nodes] = g.prune(nodes, np.concatenate([beam, trail, g.links[nodes]], axis=1), alpha)
            g._add_back_links(nodes, alpha)
    return g


class Shard:
    """A graph with the original vectors of its nodes and the ids that each node stands for."""

    def __init__(self, nodes: pd.DataFrame, norm2: float):
        self.raw = np.vstack(nodes["vec"].to_list()).astype(np.float64)
        extra = np.sqrt(np.maximum(norm2 - (self.raw**2).sum(1), 0))
        self.graph = build(np.hstack([self.raw, extra[:, None]]).astype(np.float32))
        self.members = np.concatenate(nodes["ids"].to_list()).astype(np.int64)
        self.edges = np.append(0, np.cumsum(nodes["ids"].map(len))).astype(np.int64)

    def answer(self, queries: pd.DataFrame, k: int, beam: int) -> Iterator[pd.DataFrame]:
        raw, edges, step = self.raw, self.edges, max(64, min(_CHUNK, 16_000_000 // len(self.raw)))
        for at in range(0, len(queries), step):
            part = queries.iloc[at : at + step]
            ids, q = part["key"].to_numpy(), np.vstack(part["vec"].to_list()).astype(np.float64)
            found = self.graph.search(np.hstack([q, np.zeros((len(q), 1))]).astype(np.float32), min(beam, len(raw)))
            score = np.where(found >= 0, (raw[found] * q[:, None, :]).sum(2), -np.inf)
            best = np.argsort(-score, axis=1, kind="stable")[:, : k + 1]  # one more: the query's own
            rows = np.arange(len(q))[:, None]
            found, score = found[rows, best], score[rows, best]
            i, j = np.nonzero(found >= 0)
            node = found[i, j]
            count = edges[node + 1] - edges[node]
            member = self.members[np.repeat(edges[node] - (np.cumsum(count) - count), count) + np.arange(count.sum())]
            df = pd.DataFrame({"query_id": np.repeat(ids[i], count), "vec_id": member, "score": np.repeat(score[i, j], count)})
            df = df[df["query_id"] != df["vec_id"]].sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
            yield df.groupby("query_id").head(k)


def _searched(batches: Iterator[pd.DataFrame], k: int, beam: int, norm2: float) -> Iterator[pd.DataFrame]:
    """Rows shard, query, key, vec, ids, sorted: a shard's nodes, then its queries. What the queries find comes out."""
    number, nodes, index = None, [], None
    for batch in batches:
        for (shard, query), part in batch.groupby(["shard", "query"], sort=True):
            if shard != number:
                number, nodes, index = shard, [], None
            if not query:
                nodes.append(part)
            elif nodes or index:
                if index is None:
                    index, nodes = Shard(pd.concat(nodes, ignore_index=True), norm2), []
                yield from index.answer(part, k, beam)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", shard: int = SHARD, small: int = SMALL, beam: int = SEARCH_BEAM) -> DataFrame:
    """Per row of ``queries`` its k best among ``vectors`` by inner product: query_id, rank, vec_id, score."""
    clean = lambda df, name: df.select(F.col(id_col).cast("long").alias(name), F.col(vec_col).cast("array<double>").alias("vec")).filter(usable(F.col("vec")) & F.col(name).isNotNull())
    rows = clean(vectors, "id")
    common = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if common is None:
        return empty
    sized = F.size("vec") == common["d"]
    smallest = rows.filter(sized).withColumn("r", F.dense_rank().over(Window.partitionBy("vec").orderBy("id"))).filter(F.col("r") <= k + 1)
    nodes = checkpoint(smallest.groupBy("vec").agg(F.sort_array(F.collect_set("id")).alias("ids")))
    stats = nodes.agg(F.count(F.lit(1)), F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))).first()
    n, norm2 = stats[0], float(stats[1])
    asked = clean(queries, "query_id").filter(sized).distinct()
    shards = max(-(-n // shard), min(SPREAD, -(-n // min(small, shard))))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard")
    held = nodes.select(F.pmod(F.xxhash64("vec"), F.lit(shards)).alias("shard"), F.lit(0).alias("query"), F.col("ids")[0].alias("key"), "vec", "ids")
    dealt = held.unionByName(asked.select(every, F.lit(1).alias("query"), F.col("query_id").alias("key"), "vec", F.lit(None).cast("array<bigint>").alias("ids")))
    # By range, each shard is a task of its own; by hash, some tasks would build several.
    sorted_ = dealt.repartitionByRange(shards, "shard").sortWithinPartitions("shard", "query", "key")
    found = sorted_.mapInPandas(lambda batches: _searched(batches, k, beam, norm2), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


QUERIES = {"op9_nearest_neighbours": op9_nearest_neighbours}

#: The search is approximate; tests hold its recall against brute force.
ORACLES: dict[str, str] = {}

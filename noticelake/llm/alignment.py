"""Operator 11, cross-tokenizer alignment with packed pair keys and sorted count shards.

A text is tokenised in two ways (A: byte-level BPE of the text after a space; B: pieces, which add that space), and
both are laid over the same bytes. Tokens whose byte ranges overlap are linked; the stretches between two such
overlaps' edges are the links, one each. Offsets at which tokens of both sides end cut them into groups.

1. Every text is tokenised and aligned once. A link's pair of ids is one long (A in the upper half); the pairs of all
   links are written as a compressed table.
2. ``np.unique`` makes a text's pairs distinct, and they are counted over a task's texts, so each task gives few
   (pair, texts) rows, in pieces of bounded size.
3. These rows are range-partitioned by pair and sorted; summing runs of equal pairs gives each partition's sorted
   shard: two flat files in the shared folder, pairs and counts. A task that is run again writes new files; those of
   the run that counted are the ones named in its result.
4. Tasks map the shards into memory and look the pairs of their texts up by binary search, so a task reads the pages it
   needs and tasks of a machine share them. The largest count per A id, a row per entry of A at most, is broadcast.

Shards lie where ``spark.checkpoint.dir`` says. On a mounted folder they are mapped there; from other stores (hdfs, s3)
a worker copies a shard to its own temporary folder at first use.

Defined cases: a text that is null, empty, or whose joined bytes of A or of B differ from space and text has no tokens:
zeros and ''. Repeated rows and rows without id are documents of their own and count as such; an empty table gives an
empty result; other columns are never read; texts of any length are read whole. Ids are whole numbers.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import unquote, urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.llm.common import checkpoint_folder, dealt_checkpoint, table, whole_ids
from noticelake.llm.packing import encode_whole, token_bytes

SPACE = "▁"
#: Bytes of text aligned at once, links read at once, and different pairs that a task counts before it gives them on.
_CHUNK = 1_000_000
_LINKS = 1_000_000
PAIRS = 2_000_000

ALIGNED = "id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs binary"
ALIGNED_NAMES = ("id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs")
RESULT = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Pieces:
    """Tokenizer B: ids, and each id's bytes."""

    def __init__(self, path: str | None = None):
        import public_tokenizers
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
        self.bytes = [self._bytes(i) for i in range(self.model.vocab_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(SPACE, " ").encode()


@lru_cache(maxsize=2)
def pieces(path: str | None = None) -> Pieces:
    return Pieces(path)


@lru_cache(maxsize=4)
def _sizes(side: str, path: str | None) -> np.ndarray:
    every = token_bytes(path) if side == "a" else pieces(path).bytes
    return np.fromiter(map(len, every), np.int64, len(every))


def _runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(sizes):
        n = max(1, int(np.searchsorted(np.cumsum(sizes[at:], dtype=np.int64), most, "right")))
        yield at, n
        at += n


def _side(ids: list[np.ndarray], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids in a row, how many each document has, and where each token ends in the joined bytes."""
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.concatenate([np.empty(0, np.int64), *ids])
    return flat, n, np.cumsum(sizes[flat])


@lru_cache(maxsize=2)
def _digits(most: int) -> np.ndarray:
    """Each number up to ``most`` as decimal digits, aligned to the right, and a free cell after them; empty cells are 0."""
    power = 10 ** np.arange(len(str(most)) - 1, -1, -1)
    number = np.arange(most + 1)[:, None]
    cells = np.where((number >= power) | (power == 1), number // power % 10 + ord("0"), 0)
    return np.concatenate([cells, np.zeros((most + 1, 1), int)], axis=1).astype(np.uint8)


class Aligned:
    """Documents' tokens of both sides over their joined bytes."""

    def __init__(self, ids_a: list[np.ndarray], ids_b: list[np.ndarray], sizes_a: np.ndarray, sizes_b: np.ndarray):
        self.a, self.n_a, end_a = _side(ids_a, sizes_a)
        self.b, self.n_b, end_b = _side(ids_b, sizes_b)
        self.most = max(len(sizes_a), len(sizes_b)) - 1
        ends = np.concatenate([end_a, end_b])
        ends.sort(kind="stable")  # two sorted runs
        ends = ends[np.append(True, ends[1:] != ends[:-1])[: len(ends)]]
        at_a, at_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
        closes_a, closes_b = np.zeros((2, len(ends)), bool)
        closes_a[at_a], closes_b[at_b] = True, True
        #: Each link's pair of ids, and where the documents' links end.
        self.pairs = self.a[np.cumsum(closes_a) - closes_a] << 32 | self.b[np.cumsum(closes_b) - closes_b]
        self.link_edges = np.append(0, np.append(0, at_a + 1)[np.cumsum(self.n_a)])
        #: The tokens of A and of B that end a group.
        self.last_a, self.last_b = closes_b[at_a], closes_a[at_b]
        self.n_groups = np.diff(np.append(0, np.cumsum(self.last_a))[np.append(0, np.cumsum(self.n_a))])

    def groups(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2`` of each document: tokens are laid out group by group, A before B, and written as digits with one mark after each."""
        group_a, group_b = np.cumsum(self.last_a) - self.last_a, np.cumsum(self.last_b) - self.last_b
        many = int(self.last_a.sum())
        held_a, held_b = np.bincount(group_a, minlength=many), np.bincount(group_b, minlength=many)
        to_a = np.arange(len(self.a)) + (np.cumsum(held_b) - held_b)[group_a]
        to_b = np.arange(len(self.b)) + np.cumsum(held_a)[group_b]
        cells = np.empty((len(self.a) + len(self.b), _digits(self.most).shape[1]), np.uint8)
        cells[to_a], cells[to_b] = _digits(self.most)[self.a], _digits(self.most)[self.b]
        cells[to_a, -1] = np.where(self.last_a, ord("|"), ord(","))
        cells[to_b, -1] = np.where(self.last_b, ord(";"), ord(","))
        shown = cells > 0
        text = cells[shown].tobytes()
        edges = np.append(0, np.cumsum(shown.sum(1)))[np.append(0, np.cumsum(self.n_a + self.n_b))].tolist()
        return [text[x : max(x, y - 1)] for x, y in zip(edges, edges[1:], strict=False)]


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, groups_sha256, and ``pairs``: the packed pair of every link, little-endian."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_a, b = encode_whole(a_path), pieces(b_path)
        sizes_a, sizes_b, none = _sizes("a", a_path), _sizes("b", b_path), np.empty(0, np.int64)
        for batch in batches:
            for at, n in _runs(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False), _CHUNK):
                part = batch.slice(at, n)
                ids_a, ids_b = [], []
                for text in part["text"].to_pylist():
                    own_a = own_b = none
                    if text:
                        want, found = f" {text}".encode(), b.model.encode(text)
                        if b"".join([b.bytes[i] for i in found]) == want:
                            own_a, own_b = np.array(encode_a(f" {text}"), np.int64), np.array(found, np.int64)
                        # A's tokens are cut from the bytes one after another, so only their length can differ.
                        if sizes_a[own_a].sum() != len(want):
                            own_a = own_b = none
                    ids_a.append(own_a)
                    ids_b.append(own_b)
                own = Aligned(ids_a, ids_b, sizes_a, sizes_b)
                data, edges = own.pairs.astype("<i8").tobytes(), own.link_edges * 8
                digest = [hashlib.sha256(g).hexdigest() if g else "" for g in own.groups()]
                pairs = pa.array([data[x:y] for x, y in zip(edges, edges[1:], strict=False)], pa.binary())
                yield pa.RecordBatch.from_arrays([part["id"], *(pa.array(c, pa.int64()) for c in (own.n_a, own.n_b, own.n_groups)), pa.array(digest, pa.string()), pairs], [*ALIGNED_NAMES])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, ALIGNED)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of documents with all their links' pairs, and how many links each has."""
    for batch in batches:
        sizes = pc.binary_length(batch["pairs"]).to_numpy(zero_copy_only=False).astype(np.int64)
        for at, n in _runs(sizes, 8 * _LINKS):
            part = batch.slice(at, n)
            yield part, np.frombuffer(b"".join(part["pairs"].to_pylist()), "<i8"), sizes[at : at + n] // 8


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys once, with their counts summed, in order."""
    known, at = np.unique(np.concatenate(keys), return_inverse=True)
    return known, np.bincount(at, np.concatenate(counts), len(known)).astype(np.int64)


def pair_counts(rows: DataFrame, most: int = PAIRS) -> DataFrame:
    """``pair``, ``n``: how many documents of a task (or of a part of it with ``most`` different pairs) hold the pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, waiting = [], [], 0
        for _, pairs, links in _links(batches):
            code, known = pd.factorize(pairs)
            once = np.unique(np.repeat(np.arange(len(links)), links) * len(known) + code)  # each pair once per document
            n = np.bincount(once % max(1, len(known)), minlength=len(known))
            keys.append(known)
            counts.append(n)
            waiting += len(known)
            if waiting > most:
                known, n = _summed(keys, counts)
                keys, counts, waiting = [known], [n], len(known)
                if waiting > most // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(known), pa.array(n)], ["pair", "n"])
                    keys, counts, waiting = [], [], 0
        if waiting:
            known, n = _summed(keys, counts)
            yield pa.RecordBatch.from_arrays([pa.array(known), pa.array(n)], ["pair", "n"])

    return rows.select("pairs").mapInArrow(run, "pair long, n long")


def _store(folder: str):
    """A file system of pyarrow and the folder's path in it."""
    from pyarrow import fs

    where = urlparse(folder)
    if where.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(where.path)
    return fs.FileSystem.from_uri(folder)


def write_shards(partial: DataFrame, folder: str) -> DataFrame:
    """Sums ``partial`` into sorted shards. One row per shard (shard, first, rows) and, with shard null, per A id of a shard (a, best)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{TaskContext.get().partitionId()}-{uuid.uuid4().hex}"
        store, path = _store(folder)
        store.create_dir(path, recursive=True)
        first, rows, tail = None, 0, None
        ids, best = [], []
        keys_to, counts_to = (store.open_output_stream(f"{path}/{name}.{kind}") for kind in ("pairs", "counts"))

        def put(known: np.ndarray, n: np.ndarray) -> None:
            nonlocal rows
            keys_to.write(known.astype("<i8").tobytes())
            counts_to.write(n.astype("<i8").tobytes())
            rows += len(known)
            a = known >> 32
            heads = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
            ids.append(a[heads])
            best.append(np.maximum.reduceat(n, heads))

        for batch in batches:
            keys, n = batch["pair"].to_numpy(), batch["n"].to_numpy()
            if not len(keys):
                continue
            if tail is not None:
                keys, n = np.append(tail[0], keys), np.append(tail[1], n)
            heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            known, n = keys[heads], np.add.reduceat(n, heads)
            first = known[0] if first is None else first
            tail = known[-1], n[-1]  # the next batch may go on with this run
            if len(known) > 1:
                put(known[:-1], n[:-1])
        if tail is not None:
            put(np.array([tail[0]]), np.array([tail[1]]))
        keys_to.close()
        counts_to.close()
        if rows:
            a = np.concatenate(ids)
            heads = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
            top = np.maximum.reduceat(np.concatenate(best), heads)
            none = [None] * len(heads)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name, *none], pa.string()), pa.array([int(first), *none], pa.int64()), pa.array([rows, *none], pa.int64()), pa.array([None, *a[heads].tolist()], pa.int64()), pa.array([None, *top.tolist()], pa.int64())],
                ["shard", "first", "rows", "a", "best"],
            )

    ranged = partial.repartitionByRange("pair").sortWithinPartitions("pair")
    return ranged.mapInArrow(run, "shard string, first long, rows long, a long, best long")


class Shards:
    """Sorted count shards, mapped into memory when a key first falls into them."""

    def __init__(self, folder: str, names: list[str], firsts: np.ndarray, rows: list[int]):
        self.folder, self.names, self.firsts, self.rows, self.held = folder, names, firsts, rows, {}

    def _open(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        store, path = _store(self.folder)
        found = []
        for kind in ("pairs", "counts"):
            own = f"{path}/{self.names[k]}.{kind}"
            if store.type_name != "local":
                with tempfile.NamedTemporaryFile(delete=False) as to, store.open_input_stream(own) as data:
                    while block := data.read(1 << 22):
                        to.write(block)
                    own = to.name
            found.append(np.memmap(own, "<i8", "r", shape=(self.rows[k],)))
        return found[0], found[1]

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The counts of ``keys``, which are sorted and all present."""
        out = np.empty(len(keys), np.int64)
        shard = np.searchsorted(self.firsts, keys, "right") - 1
        heads = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(keys) else []
        for x, y in zip(heads, [*heads[1:], len(keys)], strict=True):
            k = int(shard[x])
            if k not in self.held:
                self.held[k] = self._open(k)
            pairs, counts = self.held[k]
            out[x:y] = counts[np.searchsorted(pairs, keys[x:y])]
        return out


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    whole_ids(docs, id_col)
    spark = docs.sparkSession
    folder = f"{checkpoint_folder(spark)}/alignment-{uuid.uuid4().hex}"
    aligned(docs, id_col, text_col, a_path, b_path).write.option("compression", "zstd").parquet(f"{folder}/links")
    rows = spark.read.schema(ALIGNED).parquet(f"{folder}/links")
    # The range sample would count all pairs a second time.
    partial = dealt_checkpoint(pair_counts(rows))
    told = dealt_checkpoint(write_shards(partial, f"{folder}/shards"))
    shards = sorted(told.filter("shard IS NOT NULL").select("first", "shard", "rows").collect())
    tops = told.filter("shard IS NULL").groupBy("a").agg(F.max("best").alias("best")).toArrow()
    best = np.zeros(int(max(tops["a"].to_pylist(), default=0)) + 1, np.int64)
    best[tops["a"].to_numpy()] = tops["best"].to_numpy()
    shared = spark.sparkContext.broadcast((best, f"{folder}/shards", [s["shard"] for s in shards], np.array([s["first"] for s in shards], np.int64), [s["rows"] for s in shards]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, *where = shared.value
        count_of = Shards(*where)
        for part, pairs, links in _links(batches):
            code, known = pd.factorize(pairs)
            order = np.argsort(known)
            count = np.empty(len(known), np.int64)
            count[order] = count_of(known[order])
            most = count == top[known >> 32]
            edges = np.append(0, np.cumsum(links))
            sums = [np.diff(np.append(0, np.cumsum(x[code]))[edges]) for x in (most, count)]
            kept = [part[c] for c in ("id", "n_a", "n_b", "n_groups")]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x, pa.int64()) for x in (links, *sums)), part["groups_sha256"]], [c.split()[0] for c in RESULT.split(", ")])

    done = dealt_checkpoint(rows.mapInArrow(run, RESULT))
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return done


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


QUERIES = {"op11_token_alignment": op11_token_alignment}

#: SQL has no tokeniser; tests compare with a plain version over token pairs.
ORACLES: dict[str, str] = {}

"""Operator 6, byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Pre-tokens are found without a regular expression. Each code point gets a class from a table; looking at
most three characters ahead turns classes into ten symbols; every symbol is a transition function on eight
states. These functions and their compositions form a small monoid, so a text's states come from an
associative scan over one-byte numbers: blocks are composed side by side, the blocks' totals are scanned,
and a second pass yields the state before every code point. State and symbol tell whether a pre-token
begins. Byte offsets of the pre-tokens cut the UTF-8 bytes; each slice is merged once and then cached.

The rules are those of the pattern that ships with the rank files: contractions ('s 't 're 've 'm 'll 'd),
letters, digits or other marks with at most one space before them, and white space, whose last character
before other text stands alone unless it is a space.

Defined cases: null is the empty text, with no ids; repeated rows and null ids are kept; an empty table gives
an empty result; other columns are never read. Whole texts are encoded, of any length.
"""

from __future__ import annotations

import base64
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelake.llm.common import table, text_of

# Code-point classes.
LETTER, DIGIT, OTHER, SPACE = range(4)
# Symbols: a class with what its neighbours ahead decide.
S_LETTER, S_DIGIT, S_OTHER, S_SHORT, S_LONG, S_WHITE, S_GLUE, S_LAST = range(8)
# States: what the token that is open may still take.
NONE, IN_LETTERS, IN_DIGITS, IN_OTHERS, GLUED, IN_WHITE, WANTS_1, WANTS_2 = range(8)
_STATES = 8
_BLOCK = 512
#: Slices that a task keeps merged; beyond it, the older half is forgotten.
CACHE = 400_000
#: Bytes of text that are put together before they are scanned.
_CHUNK = 1_000_000
#: The characters with the property White_Space (fixed by Unicode).
WHITE_SPACE = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a token begins with this code point."""
    if symbol == S_LETTER:
        if state == WANTS_2:
            return WANTS_1, False
        if state == WANTS_1:
            return NONE, False
        return IN_LETTERS, state not in (IN_LETTERS, GLUED)
    if symbol == S_DIGIT:
        return IN_DIGITS, state not in (IN_DIGITS, GLUED)
    if symbol in (S_OTHER, S_SHORT, S_LONG):
        if state in (IN_OTHERS, GLUED):
            return IN_OTHERS, False
        return {S_OTHER: IN_OTHERS, S_SHORT: WANTS_1, S_LONG: WANTS_2}[symbol], True
    if symbol == S_WHITE:
        return IN_WHITE, state != IN_WHITE
    return (GLUED if symbol == S_GLUE else NONE), True


@lru_cache(maxsize=1)
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """number of each symbol's function (16: again as a text's first), compositions, effects on NONE, begins[state, symbol]."""
    plain = [tuple(_step(s, a)[0] for s in range(_STATES)) for a in range(8)]
    first = [(_step(NONE, a)[0],) * _STATES for a in range(8)]
    known: dict[tuple, int] = {}
    todo = [tuple(range(_STATES)), *plain, *first]
    while todo:
        f = todo.pop(0)  # the identity comes first and so is number 0
        if f not in known:
            known[f] = len(known)
            todo += [tuple(g[x] for x in f) for g in plain + first]
    compose = np.array([[known[tuple(g[x] for x in f)] for g in known] for f in known], np.uint8)
    begins = np.array([[_step(s, a)[1] for a in range(8)] for s in range(_STATES)])
    if len(known) > 255:
        raise ValueError("the functions do not fit a byte")
    return np.array([known[f] for f in plain + first], np.uint8), compose, np.array([f[NONE] for f in known], np.uint8), begins


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": DIGIT}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8)
    out[WHITE_SPACE] = SPACE
    return out


def _symbols(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The symbol of each code point; starts: where texts begin."""
    kind = _classes()[points]
    n = len(points)
    last = np.zeros(n, bool)
    last[np.append(starts[1:], n) - 1] = True
    ahead = np.append(kind[1:], SPACE)
    ahead[last] = SPACE
    out = kind.copy()
    white = np.flatnonzero(kind == SPACE)
    stands = ahead[white] != SPACE
    out[white] = np.where(stands, np.where(points[white] == 0x20, S_GLUE, S_LAST), S_WHITE)
    quotes = np.flatnonzero((points == 0x27) & (ahead == LETTER))
    if len(quotes):
        a = points[quotes + 1]
        two = ~last[quotes + 1]
        b = np.where(two, points[np.minimum(quotes + 2, n - 1)], 0)
        out[quotes[np.isin(a, [ord(c) for c in "stmd"])]] = S_SHORT
        pair = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        out[quotes[pair]] = S_LONG
    return out


def _states_before(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The state before each code point, by a blocked associative scan of the functions."""
    of_symbol, compose, at_none, _ = _monoid()
    functions = of_symbol[symbols]
    functions[starts] = of_symbol[8 + symbols[starts]]
    n, width = len(functions), len(compose)
    flat = compose.ravel()
    blocks = -(-n // _BLOCK)
    grid = np.zeros(blocks * _BLOCK, np.uint8)  # number 0 is the identity
    grid[:n] = functions
    grid = np.ascontiguousarray(grid.reshape(blocks, _BLOCK).T)
    run = np.empty_like(grid)
    total = np.zeros(blocks, np.uint8)
    for j in range(_BLOCK):
        run[j] = total
        total = flat[total.astype(np.int32) * width + grid[j]]
    carried = total.copy()
    step = 1
    while step < blocks:  # doubling scan over the blocks' totals
        carried[step:] = flat[carried[:-step].astype(np.int32) * width + carried[step:]]
        step *= 2
    before = np.append(np.zeros(1, np.uint8), carried[:-1])
    states = at_none[flat[before.astype(np.int32)[None, :] * width + run]]
    return states.T.ravel()[:n]


def pretokens(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, the byte offsets of all pre-tokens (and the end), and each text's first pre-token."""
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(lengths) - lengths
    starts = np.unique(begin[lengths > 0])
    if not len(points):
        return b"", np.zeros(1, np.int64), np.zeros(len(texts) + 1, np.int64)
    symbols = _symbols(points, starts)
    states = _states_before(symbols, starts)
    begins = _monoid()[3].ravel()[states.astype(np.int32) * 8 + symbols]
    begins[starts] = True
    at = np.flatnonzero(begins)
    width = 1 + (points > 0x7F).view(np.uint8) + (points > 0x7FF) + (points > 0xFFFF)
    ends = np.cumsum(width, dtype=np.int64)
    offsets = np.append((ends - width)[at], ends[-1])
    return joined.encode(), offsets, np.append(np.searchsorted(at, begin), len(at))


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte-pair merging of one slice: always the pair of lowest rank, the leftmost of equals."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > 100:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    get, none = ranks.get, sys.maxsize
    pairs = [get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
    while pairs:
        best = min(pairs)
        if best == none:
            break
        i = pairs.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap over linked parts, for slices without bound."""
    n = len(piece)
    end, prev, alive = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(b"\x01" * n)
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (rank := ranks.get(piece[i : end[j]])) is not None:
            heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not alive[i] or j >= n or end[j] != stop:
            continue
        alive[j], end[i] = 0, stop
        if stop < n:
            prev[stop] = i
        offer(i)
        if prev[i] >= 0:
            offer(prev[i])
    return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


class _Pairs:
    """A hash table from two neighbouring ids to the id they merge to (which is also its rank), read for whole arrays."""

    NONE = np.int32(2**31 - 1)

    def __init__(self, ranks: dict[bytes, int]):
        get = ranks.get
        found = [(a << 20 | b, v) for k, v in ranks.items() for i in range(1, len(k)) if (a := get(k[:i])) is not None and (b := get(k[i:])) is not None]
        keys, values = np.array([k for k, _ in found], np.uint64), np.array([v for _, v in found], np.int32)
        bits = max(8, int(len(keys)).bit_length() + 3)
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, 2**64 - 1, np.uint64), np.full(1 << bits, self.NONE, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] == 2**64 - 1
            self.keys[slot[free]] = keys[left[free]]  # of several for a slot, the last one stays
            self.values[slot[free]] = values[left[free]]
            out = self.keys[slot] != keys[left]
            left, slot = left[out], (slot[out] + 1) & self.last

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = (a.astype(np.uint64) << np.uint64(20)) | b.astype(np.uint64)
        slot = self._slot(keys)
        seen = self.keys[slot]
        out = np.where(seen == keys, self.values[slot], self.NONE)
        left = np.flatnonzero((seen != keys) & (seen != 2**64 - 1))
        while len(left):
            slot[left] = (slot[left] + 1) & self.last
            seen = self.keys[slot[left]]
            hit = seen == keys[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (seen != 2**64 - 1)]
        return out


class Codec:
    """Ranks with a bounded cache from slice to ids."""

    #: Slices up to this many bytes are merged side by side, longer ones each for itself.
    WIDE = 64

    def __init__(self, path: str | None = None):
        import public_tokenizers

        with open(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.widths = np.zeros(max(self.ranks.values(), default=0) + 1, np.int64)
        for k, v in self.ranks.items():
            self.widths[v] = len(k)
        self.starts = np.cumsum(self.widths) - self.widths
        self.pairs = _Pairs(self.ranks)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.bytes = np.frombuffer(b"".join(sorted(self.ranks, key=self.ranks.get)), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.cache, self.ids, self.count, self.first, self.used = {}, np.empty(1 << 16, np.int32), np.empty(CACHE, np.int32), np.empty(CACHE, np.int64), 0

    def _merge_many(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Merge slices of at most WIDE bytes side by side. Returns a row of ids for each, and how many of them count."""
        none, size = _Pairs.NONE, np.fromiter(map(len, pieces), np.int64, len(pieces))
        width = int(size.max())
        ids = self.byte_ids[np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)]
        rank = self.pairs(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(pieces), width - 1)
        columns = np.arange(width)
        rank[columns[None, 1:] >= size[:, None]] = none
        out, rows = ids.copy(), np.arange(len(pieces))
        while rank.shape[1]:
            best = rank.argmin(1)
            new = rank[np.arange(len(rank)), best]
            open_ = new != none
            out[rows[~open_], : ids.shape[1]] = ids[~open_]
            if not open_.any():
                return out, size
            ids, rank, rows, best, new = ids[open_], rank[open_], rows[open_], best[open_], new[open_]
            size[rows] -= 1
            each = np.arange(len(rows))
            right = columns[None, : ids.shape[1] - 1] > best[:, None]
            ids[each, best] = new
            ids = np.where(right, ids[:, 1:], ids[:, :-1])
            rank = np.where(right[:, :-1] | (columns[None, : rank.shape[1] - 1] == best[:, None]), rank[:, 1:], rank[:, :-1])
            for at, ok in ((best - 1, best > 0), (best, best < size[rows] - 1)):
                i, j = each[ok], at[ok]
                rank[i, j] = self.pairs(ids[i, j], ids[i, j + 1])
        out[rows, : ids.shape[1]] = ids
        return out, size

    def _keep(self, pieces: list[bytes], ids: np.ndarray, count: np.ndarray) -> None:
        k, n = len(self.cache), len(ids)
        while self.used + n > len(self.ids):
            self.ids = np.append(self.ids, np.empty_like(self.ids))
        self.ids[self.used : self.used + n] = ids
        self.count[k : k + len(pieces)] = count
        self.first[k : k + len(pieces)] = self.used + np.cumsum(count) - count
        self.used += n
        self.cache.update(zip(pieces, range(k, k + len(pieces)), strict=True))

    def _learn(self, pieces: list[bytes]) -> None:
        by: dict[int, list[bytes]] = {}
        for p in pieces:
            by.setdefault(0 if len(p) > self.WIDE else (len(p) + 3) // 4 * 4, []).append(p)
        for p in by.pop(0, []):
            ids = merge(p, self.ranks)
            self._keep([p], np.array(ids, np.int32), np.array([len(ids)]))
        for group in by.values():
            ids, size = self._merge_many(group)
            self._keep(group, ids[np.arange(ids.shape[1])[None, :] < size[:, None]], size)

    def _numbers(self, slices: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For runs of slices: their ids, and how many each has. The cache is emptied between runs when it is full."""
        for at in range(0, len(slices), CACHE // 2):
            run = slices[at : at + CACHE // 2]
            k = np.fromiter(map(self.cache.get, run, repeat(-1)), np.int64, len(run))
            if len(unknown := np.flatnonzero(k < 0)):
                missing = list(dict.fromkeys([run[i] for i in unknown.tolist()]))
                if len(self.cache) + len(missing) > CACHE:
                    self._forget()
                    missing, unknown = list(dict.fromkeys(run)), np.arange(len(run))
                self._learn(missing)
                k[unknown] = np.fromiter(map(self.cache.__getitem__, [run[i] for i in unknown.tolist()]), np.int64, len(unknown))
            n = self.count[k].astype(np.int64)
            where = np.repeat(self.first[k] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield self.ids[where], n

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all texts in a row, the byte offset in its text at which each token begins, and the texts' edges among them."""
        data, offsets, first = pretokens(texts)
        edges = offsets.tolist()
        found = list(self._numbers([data[a:b] for a, b in zip(edges, edges[1:], strict=False)]))
        ids = np.concatenate([np.empty(0, np.int32), *(x for x, _ in found)])
        per = np.concatenate([np.empty(0, np.int64), *(n for _, n in found)])
        cuts = np.append(0, np.cumsum(per))[first]
        begins = np.cumsum(self.widths[ids]) - self.widths[ids] - np.repeat(offsets[first[:-1]], np.diff(cuts))
        return ids, begins.astype(np.int32), cuts.astype(np.int32)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all tokens, and where each token ends."""
        widths = self.widths[ids]
        ends = np.cumsum(widths)
        return self.bytes[np.repeat(self.starts[ids] - (ends - widths), widths) + np.arange(ends[-1] if len(ends) else 0)], ends


@lru_cache(maxsize=1)
def codec(path: str | None = None) -> Codec:
    return Codec(path)


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows that hold about _CHUNK bytes each."""
    at = 0
    while at < len(sizes):
        n = max(1, int(np.searchsorted(np.cumsum(sizes[at : at + 4096]), _CHUNK, "right")))
        yield at, n
        at += n


def _lists(values: np.ndarray, edges: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values, pa.int32()))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """One row per document: id, token_ids (array<int>), token_offsets (array<int>, byte offsets into the UTF-8 text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        for batch in batches:
            for at, n in _slices(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False)):
                part = batch.slice(at, n)
                ids, begins, edges = c.encode(part["text"].to_pylist())
                yield pa.RecordBatch.from_arrays([part["id"], _lists(ids, edges), _lists(begins, edges)], ["id", "token_ids", "token_offsets"])

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, token_ids array<int>, token_offsets array<int>")


def decode(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``encoded`` (id, token_ids, any others) with ``decoded`` (binary): the bytes of token_ids. Null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        for batch in batches:
            for at, n in _slices(4 * pc.fill_null(pc.list_value_length(batch["token_ids"]), 0).to_numpy(zero_copy_only=False)):
                part = batch.slice(at, n)
                sizes = pc.fill_null(pc.list_value_length(part["token_ids"]), 0).to_numpy(zero_copy_only=False)
                data, ends = c.decode(part["token_ids"].flatten().to_numpy(zero_copy_only=False))
                edges = np.append(0, ends)[np.append(0, np.cumsum(sizes))].astype(np.int32)
                text = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(edges), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([*part.columns, text], [*part.schema.names, "decoded"])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())]))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = decode(encode(table(spark, sf_dir, "documents")))
    return coded.select(
        F.col("id").alias("doc_id"),
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {"op6_byte_bpe": op6_byte_bpe}

#: SQL has no tokeniser; tests compare with the tiktoken library and check the round trip.
ORACLES: dict[str, str] = {}

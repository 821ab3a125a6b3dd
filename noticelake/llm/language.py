"""Operator 12, language identification by prediction by partial matching.

Each language has a variable-order context tree over bytes: how often each byte followed each context of up to
``ORDER`` bytes. A byte's code length is read from the longest context that the language knows; a byte that was not
seen there is reached by escapes to shorter ones. An escape from a context weighs as much as the number of different
bytes seen there (method C), and bytes that a longer context could have coded are excluded from the shorter. Below
the empty context all bytes not yet excluded are alike. The statistics are frozen: coding a text does not change them.
A text goes to the language that codes it in the fewest bits; the score is that language's share of the probability
that all languages give the text.

As counts are frozen, a byte's code length depends on the byte and its context alone. So the lengths of a gram, in
all languages at once, are worked out when a task first meets it and looked up in a hash table after that.

Learning takes whole texts in the order of a hash of their id until a language has ``max_bytes`` (and the text that
crosses this bound); it is the only part that reads a sample. The model grows with the number of languages only, each
bounded by ``max_bytes`` and one text, and is broadcast. Every text is scored, and whole.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, as is any text where nothing could be
learned; rows without language or id are not learned from, and rows without id count as held out; of rows that repeat an
id and language one is learned from; of languages with equal lengths the first by name counts; an empty table gives an
empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticelake.llm.common import broadcast_if_few, checkpoint, table

#: Bytes of the longest context (a gram and its length mark fit a long up to 6).
ORDER = 5
#: Bytes that are learned from in each language.
MAX_BYTES = 600_000
FOLDS = 5
UNKNOWN = "und"
#: Bytes of text worked on at once; numbers (grams times languages) that a task keeps, and gathers at once.
_CHUNK = 2_000_000
_KEPT = 8_000_000
_GATHER = 8_000_000


def grams(data: np.ndarray, place: np.ndarray, order: int) -> np.ndarray:
    """Each byte with the up to ``order`` bytes of its text before it, as one number; a 1 above them marks how many there are."""
    out = data.astype(np.int64)
    for back in range(1, order + 1):
        before = np.zeros(len(data), np.int64)
        before[back:] = data[:-back]
        out += np.where(place >= back, before << (8 * back), 0)
    return out + (np.int64(1) << (8 * (np.minimum(place, order) + 1)))


def _placed(lengths: np.ndarray) -> np.ndarray:
    """The number of each byte in its text."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def gram_counts(data: np.ndarray, lengths: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of 1 to order + 1 bytes and how often each occurs."""
    place = _placed(lengths)
    found = []
    for size in range(1, order + 2):
        whole = grams(data, place, size - 1)
        found.append(np.unique(whole[place >= size - 1], return_counts=True))
    return np.concatenate([k for k, _ in found]), np.concatenate([n for _, n in found])


def _shorter(keys: np.ndarray, size: int) -> np.ndarray:
    """Grams of ``size`` bytes without their first byte."""
    return (keys & ((np.int64(1) << (8 * (size - 1))) - 1)) | (np.int64(1) << (8 * (size - 1)))


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places in ``sorted_keys``; its length where a key is absent."""
    at = np.searchsorted(sorted_keys, keys)
    hit = at < len(sorted_keys)
    hit[hit] = sorted_keys[at[hit]] == keys[hit]
    return np.where(hit, at, len(sorted_keys))


class Trees:
    """The context trees of all languages, side by side."""

    def __init__(self, languages: list[str], keys: np.ndarray, owners: np.ndarray, counts: np.ndarray, order: int = ORDER):
        self.languages, self.order, self.levels = languages, order, []
        for size in range(1, order + 2):
            own = (keys >> (8 * size)) == 1
            level, at = np.unique(keys[own], return_inverse=True)
            table_ = np.zeros((len(level), len(languages)), np.int32)
            np.add.at(table_, (at, owners[own]), counts[own])
            self.levels.append((level, table_))
        self._ready = False

    def __getstate__(self) -> dict:
        return {"languages": self.languages, "order": self.order, "levels": self.levels, "_ready": False}

    def _prepare(self) -> None:
        """Per context: total and number of different bytes, and both without what the next longer context can code."""
        # A last row of zeros stands for what is absent.
        none = np.zeros((1, len(self.languages)))
        self.counts, self.nodes, self.plain, self.rest = [], [], [], []
        with np.errstate(divide="ignore"):
            for size, (keys, counts) in enumerate(self.levels, 1):
                nodes, at = np.unique(keys >> 8, return_inverse=True)
                total, kinds = np.zeros((2, len(nodes), len(self.languages)))
                np.add.at(total, at, counts)
                np.add.at(kinds, at, counts > 0)
                self.nodes.append(nodes)
                self.counts.append(np.concatenate([counts, none]))
                self.plain.append((np.concatenate([total, none]), np.concatenate([kinds, none])))
                if size > 1:
                    lower = self.counts[-2]
                    shared = np.zeros_like(total)
                    np.add.at(shared, at, np.where(counts > 0, lower[_find(self.levels[size - 2][0], _shorter(keys, size))], 0))
                    below = _find(self.nodes[-2], _shorter(nodes, size - 1))
                    self.rest.append((np.concatenate([self.plain[-2][0][below] - shared, none]), np.concatenate([self.plain[-2][1][below] - kinds, none])))
        self._ready = True

    def lengths(self, wanted: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each gram (rows) in each language (columns)."""
        if not self._ready:
            self._prepare()
        out = np.zeros((len(wanted), len(self.languages)))
        todo = np.ones_like(out, bool)
        above: np.ndarray | None = None  # of each gram, the context one byte longer
        size_of = np.searchsorted(np.int64(1) << (8 * np.arange(1, self.order + 2)), wanted, "right")
        with np.errstate(divide="ignore", invalid="ignore"):
            for size in range(self.order + 1, 0, -1):
                key = (wanted & ((np.int64(1) << (8 * size)) - 1)) | (np.int64(1) << (8 * size))
                key[size_of < size] = -1
                count = self.counts[size - 1][_find(self.levels[size - 1][0], key)]
                node = _find(self.nodes[size - 1], np.where(key < 0, -1, key >> 8))
                total, kinds = (x[node] for x in self.plain[size - 1])
                if above is not None:
                    entered = self.plain[size][0][above] > 0
                    total = np.where(entered, self.rest[size - 1][0][above], total)
                    kinds = np.where(entered, self.rest[size - 1][1][above], kinds)
                coded = todo & (count > 0)
                out += np.where(coded, np.log2(total + kinds) - np.log2(count), 0)
                todo &= ~coded
                out += np.where(todo & (kinds > 0), np.log2(total + kinds) - np.log2(kinds), 0)
                above = node
            out += np.where(todo, np.log2(256 - self.plain[0][1][0])[None, :], 0)
        return out


class Scorer:
    """Code lengths of texts, with a hash table from gram to its lengths."""

    def __init__(self, trees: Trees):
        self.trees, self.wide = trees, len(trees.languages)
        self.most = max(1024, _KEPT // max(1, self.wide))
        self.bits = int(self.most).bit_length() + 1
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(1 << self.bits, np.int64)  # no gram is 0
        self.rows = np.zeros(1 << self.bits, np.int32)
        self.lengths, self.used = np.empty((1024, self.wide), np.float32), 0

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _learn(self, new: np.ndarray) -> None:
        while self.used + len(new) > len(self.lengths):
            self.lengths = np.concatenate([self.lengths, np.empty_like(self.lengths)])
        self.lengths[self.used : self.used + len(new)] = self.trees.lengths(new)
        row = np.arange(self.used, self.used + len(new), dtype=np.int32)
        self.used += len(new)
        slot, last = self._slot(new), (1 << self.bits) - 1
        while len(new):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = new[free]  # of several for a slot, the last one stays
            mine = self.keys[slot] == new
            self.rows[slot[mine]] = row[mine]
            new, row, slot = new[~mine], row[~mine], (slot[~mine] + 1) & last

    def _row_of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The row of each gram, -1 where it is new, and the new grams' places."""
        slot, last = self._slot(keys), (1 << self.bits) - 1
        out = np.where(self.keys[slot] == keys, self.rows[slot], -1)
        left = np.flatnonzero((out < 0) & (self.keys[slot] != 0))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & last
            seen = self.keys[slot]
            hit = seen == keys[left]
            out[left[hit]] = self.rows[slot[hit]]
            on = ~hit & (seen != 0)
            left, slot = left[on], slot[on]
        return out, np.flatnonzero(out < 0)

    def __call__(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Bits of each text (rows) in each language (columns)."""
        out = np.zeros((len(lengths), self.wide))
        ends = np.cumsum(lengths)
        place = _placed(lengths)
        keys = grams(data, place, self.trees.order)
        step = max(1024, min(_GATHER // max(1, self.wide), self.most))
        for at in range(0, len(keys), step):
            own = keys[at : at + step]
            rows, new = self._row_of(own)
            if len(new):
                fresh = np.unique(own[new])
                if self.used + len(fresh) > self.most:
                    self._forget()
                    fresh, new = np.unique(own), np.arange(len(own))
                self._learn(fresh)
                rows[new] = self._row_of(own[new])[0]
            first, end = np.searchsorted(ends, at, "right"), np.searchsorted(ends, at + len(own), "left")
            texts = np.arange(first, end + 1)
            texts = texts[lengths[texts] > 0]
            begin = np.maximum(ends[texts] - lengths[texts], at) - at
            out[texts] += np.add.reduceat(self.lengths[rows], begin, axis=0, dtype=np.float64)
        return out


def _fold(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % FOLDS


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_bytes: int = MAX_BYTES) -> DataFrame:
    """``lang``, ``text``: what is learned from."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).filter("lang IS NOT NULL AND octet_length(text) > 0")
    rows = rows.filter(_fold("id") != 0)
    sizes = checkpoint(rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes")))
    # In the order of the hash, four times the wanted share is enough; languages with few bytes come whole.
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    near = rows.withColumn("draw", draw).join(broadcast_if_few(sizes), "lang").filter(F.col("draw") * F.col("bytes") <= 4 * max_bytes)
    once = near.groupBy("lang", "id", "draw").agg(F.max("text").alias("text"))
    order = Window.partitionBy("lang").orderBy("draw", "id")
    before = F.sum(F.octet_length("text")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return once.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < max_bytes).select("lang", "text")


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = ORDER, max_bytes: int = MAX_BYTES) -> Trees:
    """The context trees of all languages of the rows that may be learned from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in pc.unique(batch["lang"]).to_pylist():
                own = batch.filter(pc.equal(batch["lang"], name))
                texts = [t.encode() for t in own["text"].to_pylist()]
                keys, counts = gram_counts(np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts]), order)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(keys), pa.array(counts, pa.int64())], ["lang", "gram", "n"])

    counted = sample(docs, id_col, text_col, lang_col, max_bytes).mapInArrow(run, "lang string, gram long, n long")
    found = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(pc.unique(found["lang"]).to_pylist())
    owners = pc.index_in(found["lang"], pa.array(names, pa.string())).to_numpy()
    return Trees(names, found["gram"].to_numpy(), owners, found["n"].to_numpy(), order)


#: A worker's scorer, for tasks that follow with the same trees.
_SCORER: list[Scorer] = []


def identify(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, lang_pred, score, bits (code length in each language, in the order of ``trees.languages``)."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _SCORER or _SCORER[0].trees is not shared.value:
            _SCORER[:] = [Scorer(shared.value)]
        score, names = _SCORER[0], np.array([*shared.value.languages, UNKNOWN], object)
        for batch in batches:
            for at, n in _slices(batch):
                part = batch.slice(at, n)
                text = pc.fill_null(part["text"], "").cast(pa.binary())
                lengths = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
                bits = score(np.frombuffer(b"".join(text.to_pylist()), np.uint8), lengths)
                best = bits.argmin(1) if len(names) > 1 else np.zeros(n, np.int64)
                least = bits.min(1, keepdims=True) if len(names) > 1 else np.zeros((n, 1))
                with np.errstate(under="ignore"):
                    share = 1 / np.exp2(np.maximum(least - bits, -1000)).sum(1) if len(names) > 1 else np.zeros(n)
                known = part["letters"].to_numpy(zero_copy_only=False) & (len(names) > 1)
                names_of = names[np.where(known, best, len(names) - 1)]
                edges = pa.array(np.arange(n + 1) * bits.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays([part["id"], part["held_out"], pa.array(names_of, pa.string()), pa.array(np.where(known, share, 0.0)), pa.ListArray.from_arrays(edges, pa.array(bits.ravel()))], ["id", "held_out", "lang_pred", "score", "bits"])

    text = F.col(text_col).cast("string")
    held_out = F.coalesce(_fold(id_col) == 0, F.lit(True))
    rows = docs.select(F.col(id_col).alias("id"), held_out.alias("held_out"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"), text.alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double, bits array<double>")


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Runs of rows that hold about _CHUNK bytes each."""
    sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
    at = 0
    while at < len(sizes):
        n = max(1, int(np.searchsorted(np.cumsum(sizes[at:], dtype=np.int64), _CHUNK, "right")))
        yield at, n
        at += n


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn(docs)).select(F.col("id").alias("doc_id"), "held_out", "lang_pred", "score")


QUERIES = {"op12_language_id": op12_language_id}

#: SQL cannot express the trees; tests hold code lengths against a plain PPM coder and measure held-out accuracy.
ORACLES: dict[str, str] = {}

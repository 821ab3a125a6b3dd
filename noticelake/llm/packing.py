"""Operator 4, best-fit packing by hierarchical residual packing.

Documents are tokenised and cut into pieces in the task that reads them, and packed there at once: best fit
in falling length over the pieces of the partition, so the first round needs no shuffle. A bin is final when
no other underfull bin could still fit into it, judged exactly against the smallest load that is left. The
rest, a small part, travel on as items of their bin's load: dealt by hash into groups of bounded size, packed
best-fit again, with fewer groups each round until one group is left or a round merges nothing. Only (bin, load) rows move;
pieces learn their final sequence by one join at the end.

Defined cases: null text is empty and an empty text is the lone end id; repeated rows are packed each for
itself; null ids are carried; an empty table gives an empty result; other columns are never read. A text of
any length is encoded whole. Ids are whole numbers; others are refused.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from pathlib import Path

import numpy as np
import pandas as pd
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.llm.common import checkpoint, table, text_of, whole_ids

CAPACITY = 2048
END_ID = 0
#: Pieces that a task packs at once, and bins that a group of a later round holds.
LOCAL_ITEMS = 500_000
GROUP_ITEMS = 50_000

PIECES = "id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, load long"


@lru_cache(maxsize=2)
def added_tokens(path: str | None = None) -> dict[str, int]:
    """The added tokens of the JSON file beside the rank file."""
    import public_tokenizers

    with open(Path(path).with_suffix(".json") if path else public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


@lru_cache(maxsize=2)
def encoder(path: str | None = None, added: bool = False) -> tiktoken.Encoding:
    """The byte-level BPE of 50,257 ids. ``encode_ordinary`` reads added tokens' strings as ordinary text.

    With ``added``, ``encode`` gives the added tokens of byte_bpe_50k.json their ids, as that file's own library does.
    The rank file is the vocabulary of byte_bpe_50k.json; tests hold the ids of both ways against that library.
    """
    import public_tokenizers

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added_tokens(path) if added else {})


@lru_cache(maxsize=4)
def exact_encoder(path: str | None = None, added: bool = False):
    """The library that the JSON file is made for."""
    import public_tokenizers
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(str(Path(path).with_suffix(".json")) if path else public_tokenizers.path("byte_bpe_50k.json"))
    known.encode_special_tokens = not added
    return known


@lru_cache(maxsize=4)
def encode_whole(path: str | None = None, added: bool = False) -> Callable[[str], list[int]]:
    """From a text of any length to its ids.

    The fast library gives up on runs of about a million white-space characters; such texts take the JSON file's own.
    """
    known = encoder(path, added)
    fast = partial(known.encode, allowed_special="all" if added else set(), disallowed_special=())

    def encode(text: str) -> list[int]:
        try:
            return fast(text)
        except ValueError:
            return exact_encoder(path, added).encode(text, add_special_tokens=False).ids

    return encode


@lru_cache(maxsize=2)
def token_bytes(path: str | None = None) -> list[bytes]:
    """The bytes of each id of the rank file; none for ids that it lacks."""
    known = encoder(path)
    out = [b""] * (known.max_token_value + 1)
    for piece in known.token_byte_values():
        out[known.encode_single_token(piece)] = piece
    return out


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit in falling length. Returns each item's bin (numbered from 0), its offset there, and the bins' loads.

    Open bins are kept by what room they have left; one bit per room finds the tightest that fits.
    """
    bins, offsets, loads = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    by_room: dict[int, list[int]] = {}
    rooms = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(loads)
            loads.append(0)
        bins[i], offsets[i] = b, loads[b]
        loads[b] += size
        if room > size:
            by_room.setdefault(room - size, []).append(b)
            rooms |= 1 << (room - size)
    return bins, offsets, np.array(loads, np.int64)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece: all of full capacity but the first, which holds what remains."""
    first = n - (n - 1) // capacity * capacity
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def packed_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None, added: bool = False) -> DataFrame:
    """Tokenise, cut and pack within each input partition. One row per piece, with its local bin, offset and the bin's load."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encode_whole(tokenizer, added)
        base, made, held = TaskContext.get().partitionId() << 36, 0, []

        def flush() -> pd.DataFrame:
            nonlocal made
            out = pd.DataFrame(held, columns=["id", "piece", "start", "length", "ids_crc32"])
            bins, offsets, loads = best_fit(out["length"].to_numpy(np.int64), capacity)
            out["id"] = out["id"].astype("Int64")
            out["bin"], out["offset"], out["load"] = base + made + bins, offsets, loads[bins]
            made += len(loads)
            held.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch["id"], batch["text"], strict=True):
                ids = np.array([*encode(text), end_id], "<u4")
                held += [(doc, k, a, n, zlib.crc32(ids[a : a + n])) for k, (a, n) in enumerate(cut(len(ids), capacity))]
            if len(held) >= LOCAL_ITEMS:
                yield flush()
        if held:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    return rows.mapInPandas(run, PIECES)


def merge_bins(bins: DataFrame, capacity: int, group_items: int = GROUP_ITEMS) -> DataFrame:
    """``bins``: bin, load. Packs underfull bins into one another, round by round. Returns bin, sequence, shift for all that took part."""

    def pack(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("bin", ignore_index=True)
        own, offsets, loads = best_fit(df["load"].to_numpy(np.int64), capacity)
        first = np.empty(len(loads), np.int64)  # a new bin is named after the bin at its start
        first[own[offsets == 0]] = df["bin"].to_numpy()[offsets == 0]
        return pd.DataFrame({"bin": df["bin"], "parent": first[own], "at": offsets, "parent_load": loads[own]})

    rest, placed, groups, number = bins.filter(F.col("load") < capacity), None, None, 0
    while True:
        low = rest.agg(F.min("load")).first()[0]
        if low is None:
            break
        rest = rest.filter(F.col("load") <= capacity - low)
        count = rest.count()
        if count < 2:
            break
        need = -(-count // group_items)
        groups = need if groups is None else max(1, min(need, groups // 2))
        groups = max(groups, need)
        dealt = rest.withColumn("grp", F.pmod(F.xxhash64("bin", F.lit(number)), F.lit(groups)))
        step = checkpoint(dealt.groupBy("grp").applyInPandas(pack, "bin long, parent long, at long, parent_load long"))
        if placed is None:
            placed = step.select("bin", F.col("parent").alias("sequence"), F.col("at").alias("shift"))
        else:
            moved = step.select(F.col("bin").alias("sequence"), "parent", "at")
            placed = placed.join(moved, "sequence", "left").select("bin", F.coalesce("parent", "sequence").alias("sequence"), (F.col("shift") + F.coalesce("at", F.lit(0))).alias("shift"))
        placed = checkpoint(placed)
        rest = step.filter("bin = parent").select("bin", F.col("parent_load").alias("load"))
        left, number = rest.count(), number + 1
        if groups == 1 or left == count:
            break
    if placed is None:
        return bins.select("bin", F.col("bin").alias("sequence"), F.lit(0).cast("long").alias("shift")).limit(0)
    return placed


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None, group_items: int = GROUP_ITEMS, added: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset. ``added``: strings of added tokens get their own ids."""
    whole_ids(docs, id_col)
    pieces = checkpoint(packed_pieces(docs, id_col, text_col, capacity, end_id, tokenizer, added))
    placed = merge_bins(pieces.filter("offset = 0").select("bin", "load"), capacity, group_items)
    joined = pieces.join(placed, "bin", "left")
    return joined.select("id", "piece", "start", "length", "ids_crc32", F.coalesce("sequence", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), added=True).withColumnRenamed("id", "doc_id")


QUERIES = {"op4_best_fit_packing": op4_best_fit_packing}

#: SQL has no tokeniser; tests check lengths, placement and ids against the tokenizers library.
ORACLES: dict[str, str] = {}

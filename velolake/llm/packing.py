"""Best-fit packing of tokenised documents, with a certificate from dual-feasible functions.

Pieces are packed in partitions by best-fit decreasing. Of many dual-feasible functions the one that
bounds the number of sequences of all pieces best gives every partition its bound, so the bounds of
partitions add up to that of all pieces, but for less than one sequence each. A partition that meets
its bound is certified and settles. Those with gaps exchange the documents of their sequences with room: these
are dealt anew and packed again; a new packing counts only if it needs fewer sequences. When no gap is left,
or none can be closed, a partition's certificate may still hide a part of a sequence, so what has room
in all partitions is packed together and the partitions made of it are certified in turn.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velolake.session import stored

CAPACITY = 1024
END_ID = 2
# Pieces that a partition packs at a time, on average.
PARTITION_PIECES = 16384
VOCABULARY = "byte_bpe_50k"

# The pattern of the vocabulary's pre-tokeniser, and its special token.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = {"<|endoftext|>": 50256}

_PIECES = "piece_id long, doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = "piece_id long, length long, round int, part long, bin long, offset long, room long, certified boolean"
# A sequence id has six bits for its round.
LAST_ROUND = 63


@lru_cache
def encoder(vocabulary: str) -> Callable[[str], np.ndarray]:
    """Text to ids as tokenizers gives them for the vocabulary, by the same ranks in tiktoken, which is faster.

    Like there, the special token's string in a text is that token.
    """
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding(vocabulary, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    return lambda text: encoding.encode_to_numpy(text, allowed_special="all")


def piece_bounds(count: int, capacity: int = CAPACITY) -> Iterator[tuple[int, int]]:
    """Start and end of a document's pieces: all of `capacity` but the first, which has the rest."""
    start, end = 0, (count - 1) % capacity + 1
    while start < count:
        yield start, end
        start, end = end, end + capacity


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """piece_id (unique), doc_id, piece, start, length, ids_crc32; stored. Null text is empty."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, number = encoder(vocabulary), TaskContext.get().partitionId() << 33
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                ids = np.append(encode(text.as_py() or ""), END_ID).astype("<u4")
                for piece, (start, end) in enumerate(piece_bounds(len(ids), capacity)):
                    rows.append((number, doc_id.as_py(), piece, start, end - start, zlib.crc32(ids[start:end])))
                    number += 1
            if rows:
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                                 names=[x.split()[0] for x in _PIECES.split(", ")])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(texts.mapInArrow(cut, _PIECES), "pieces")


def _weights(lengths: np.ndarray, least: int, k: int, capacity: int) -> tuple[np.ndarray, int]:
    """Values of a dual-feasible function at `lengths`: numerators, and their denominator.

    Pieces that leave less than `least` count 1, pieces shorter than `least` 0 (k = 0). k from 1 on rounds
    the others to floor((k + 1) x) / k, k = -1 to multiples of `least`.
    """
    if k < 0:
        whole = capacity // least
        halves = np.where(2 * lengths > capacity, 2 * (whole - (capacity - lengths) // least),
                          np.where(2 * lengths == capacity, whole, 2 * (lengths // least)))
        return halves, 2 * whole
    cut = np.where(lengths > capacity - least, capacity, np.where(lengths < least, 0, lengths))
    if not k:
        return cut, capacity
    scaled = (k + 1) * cut
    # x stays where (k + 1) x is whole
    return np.where(scaled % capacity == 0, cut * k, scaled // capacity * capacity), k * capacity


def best_function(lengths: np.ndarray, counts: np.ndarray, capacity: int = CAPACITY) -> tuple[int, np.ndarray, int]:
    """The bound of all pieces, and the dual-feasible function that gives it: its numerators per length from 0 on, and their denominator."""
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    best, total, below = (1, 0), 0, 1
    for least in np.unique(np.append(lengths[2 * lengths <= capacity], 1)).tolist():
        for k in (0, 1, 2, 3, 4, -1):
            values, denominator = _weights(lengths, least, k, capacity)
            found = int((values * counts).sum())
            if found * below > total * denominator:
                best, total, below = (least, k), found, denominator
    return -(-total // below), *_weights(np.arange(capacity + 1), *best, capacity)


def lower_bound(lengths: np.ndarray, counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """Sequences that any packing needs, by dual-feasible functions of length / capacity."""
    return best_function(lengths, counts, capacity)[0]


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece: longest first, each into the bin with the least room that fits."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins: dict[int, list[int]] = {}  # room -> bins
    rooms: list[int] = []  # rooms that some bin has, in order
    made = 0
    for i in np.argsort(-np.asarray(lengths), kind="stable"):
        length = int(lengths[i])
        at = bisect_left(rooms, length)
        if at < len(rooms):
            room = rooms[at]
            same = open_bins[room]
            number = same.pop()
            if not same:
                del open_bins[room], rooms[at]
        else:
            room, number, made = capacity, made, made + 1
        bins[i], offsets[i] = number, capacity - room
        left = room - length
        if left:
            if left not in open_bins:
                open_bins[left] = []
                insort(rooms, left)
            open_bins[left].append(number)
    return bins, offsets


def _rooms(pieces: pd.DataFrame, capacity: int) -> pd.Series:
    return capacity - pieces.groupby(["round", "part", "bin"])["length"].transform("sum")


def _packer(turn: int, capacity: int, weights: np.ndarray, denominator: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    def pack(key: tuple, pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["length", "piece_id"], ascending=[False, True], ignore_index=True)
        lengths = pieces["length"].to_numpy()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        made = int(bins.max()) + 1
        before = len(pieces[["round", "part", "bin"]].drop_duplicates()) if turn else made + 1
        if made < before:
            pieces["round"], pieces["part"], pieces["bin"], pieces["offset"] = turn, key[0], bins, offsets
        pieces["room"] = _rooms(pieces, capacity)
        pieces["certified"] = min(made, before) <= -(-int(weights[lengths].sum()) // denominator)
        return pieces[[x.split()[0] for x in _PACKED.split(", ")]]

    return pack


def pack(pieces: DataFrame, capacity: int = CAPACITY, partition_pieces: int = PARTITION_PIECES) -> DataFrame:
    """piece_id, sequence_id and offset of every piece of `token_pieces`.

    Pieces of `capacity` are sequences of their own. The bound of all pieces needs only the number
    of pieces of each length. Partitions hold about `partition_pieces`. Partitions with gaps exchange as long as that
    saves a sequence or certifies a partition; then everything with room is dealt anew. It ends when the packing
    meets the bound, when everything with room was packed together, when dealing everything saved no
    sequence, or after LAST_ROUND rounds. No pieces give no rows.
    """
    whole = pieces.filter(F.col("length") == capacity).select("piece_id", F.col("length"), F.lit(-1).alias("round"), F.col("piece_id").alias("part"),
                                                              F.lit(0).cast("long").alias("bin"), F.lit(0).cast("long").alias("offset"))
    short = pieces.filter(F.col("length") < capacity)
    by_length = short.groupBy("length").agg(F.count(F.lit(1)).alias("n")).toPandas()  # fewer rows than `capacity`
    least, weights, denominator = best_function(by_length["length"].to_numpy(), by_length["n"].to_numpy(), capacity)
    columns = ["piece_id", "length", "round", "part", "bin", "offset"]
    free = short.select("piece_id", "length", F.lit(0).alias("round"), F.lit(0).cast("long").alias("part"),
                        F.lit(0).cast("long").alias("bin"), F.lit(0).cast("long").alias("offset"))
    settled, resting = [whole.select(columns)], []  # sequences without room; those with room in certified partitions
    full = rest = rest_pieces = turn = 0
    count, everything, before = int(by_length["n"].sum()), True, None  # `before`: all sequences after the round before
    while count:
        parts = -(-count // partition_pieces)
        unit = F.xxhash64("round", "part", "bin", F.lit(turn)) if turn else F.xxhash64("piece_id")  # sequences leave whole
        dealt = free.withColumn("to", F.pmod(unit, F.lit(parts)))
        packed = stored(dealt.groupBy("to").applyInPandas(_packer(turn, capacity, weights, denominator), _PACKED), f"packed-{turn}")
        sequence, roomy = F.struct("round", "part", "bin"), F.col("room") > 0
        gap, rests = roomy & ~F.col("certified"), roomy & F.col("certified")
        closed, open_, left, more, more_pieces = packed.agg(
            F.count_distinct(F.when(~roomy, sequence)), F.count_distinct(F.when(gap, sequence)), F.count_if(gap),
            F.count_distinct(F.when(rests, sequence)), F.count_if(rests)).first()
        full, rest, rest_pieces = full + closed, rest + more, rest_pieces + more_pieces
        settled.append(packed.filter(~roomy).select(columns))
        resting.append(packed.filter(rests).select(columns))
        gaps, total = packed.filter(gap).select(columns), full + open_ + rest
        saved = before is None or total < before
        if total <= least or turn == LAST_ROUND or (everything and (parts == 1 or not saved)):
            settled += [gaps, *resting]
            break
        if left and (everything or saved or more):
            free, count, everything = gaps, left, False
        else:
            free, count, everything = reduce(DataFrame.unionByName, [gaps, *resting]), left + rest_pieces, True
            resting, rest, rest_pieces = [], 0, 0
        before, turn = total, turn + 1
    out = reduce(DataFrame.unionByName, settled)
    sequence = F.when(F.col("round") < 0, F.col("piece_id") * 2).otherwise(
        F.shiftleft(F.shiftleft("part", 20) + F.col("bin"), 6) * 2 + F.col("round") * 2 + 1)
    return out.select("piece_id", sequence.alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and END_ID; longer ones are cut into pieces of `capacity`, the first with
    the rest. Null and empty texts are the end id alone. Repeated rows are documents of their own;
    other columns are ignored; an empty table gives no rows.
    """
    pieces = token_pieces(docs, capacity, vocabulary)
    return pieces.join(pack(pieces, capacity), "piece_id").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

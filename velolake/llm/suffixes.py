"""Removal of repeated byte strings by a distributed merge sort of suffixes.

Of all byte positions only anchors are sorted: of each window of WINDOW positions the one with the
least hash of the GRAM bytes there. Equal strings of LENGTH bytes have their anchor at the same
offset, so a string repeats only where the bytes from its anchor on repeat. Anchors whose next
PREFIX bytes are unique are dropped by counting hashes of them.

For each other anchor one suffix is sorted: the bytes from it to the end of the last string that
it stands for, then the bytes before it, backwards. Tasks sort their suffixes into runs for each
bucket of prefixes, collapse equal ones and send them front-coded. A bucket merges its runs with a
loser tree that knows the common prefix of every contender with the last output, so that bytes
known to be equal are never compared again. Suffixes that share PREFIX bytes come out together;
which of their strings are equal then follows from common prefixes in both directions.

A prefix that very many anchors share is split: each of its strings is a suffix of its own, and
the whole string names the bucket.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velolake.llm.common import BYTE_CODES, mixed, powers, text_chunks
from velolake.session import stored

LENGTH = 400
WINDOW, GRAM = 256, 8
# Bytes from an anchor that all strings which it stands for include.
PREFIX = LENGTH - WINDOW + 1
# A prefix that more anchors share is split by whole strings.
HOT = 1 << 14
# A task sends its runs when they hold about so many bytes; a bucket is to merge about so many.
RUN_BYTES, BUCKET_BYTES = 16 << 20, 32 << 20

_ANCHORS = "doc long, code long, key long, place long"
_RUNS = "bucket long, shared array<int>, lengths array<int>, forward array<int>, repeats array<boolean>, doc array<long>, code array<long>, at array<long>, data binary"
_SPANS = "doc long, code long, first long, last long"
_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of texts that stand one after the other: text, position, first and last string start.

    Positions count in `data`. Of equal hashes in a window the leftmost is the anchor.
    """
    none = (np.empty(0, np.int64),) * 4
    sizes = np.diff(offsets)
    if not (sizes >= LENGTH).any():
        return none
    grams = np.empty(len(data) - GRAM + 1, "<u8")
    for k in range(GRAM):
        whole = data[k:k + (len(data) - k) // GRAM * GRAM].view("<u8")
        grams[k::GRAM] = whole[:len(range(k, len(grams), GRAM))]
    order = (mixed(grams) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    padded = np.full(-(-(len(order) + WINDOW) // WINDOW) * WINDOW, np.iinfo(np.uint64).max)
    padded[:len(order)] = order
    blocks = padded.reshape(-1, WINDOW)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    # String starts of all texts, and the anchor of each.
    counts = np.maximum(sizes - LENGTH + 1, 0)
    start = np.arange(counts.sum()) + np.repeat(offsets[:-1] - np.concatenate(([0], counts.cumsum()[:-1])), counts)
    anchor = (np.minimum(back[start], ahead[start + WINDOW - 1]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    edge = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    at = anchor[edge]
    return np.searchsorted(offsets, at, side="right") - 1, at, start[edge], start[np.append(edge[1:], len(start)) - 1]


def prefix_keys(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes of the PREFIX bytes from each position on."""
    out, factors = np.empty(len(at), np.uint64), powers(PREFIX)
    for i in range(0, len(at), 1024):
        out[i:i + 1024] = (BYTE_CODES[data[at[i:i + 1024, None] + np.arange(PREFIX)]] * factors).sum(1, dtype=np.uint64)
    return mixed(out)


def packed_place(at: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """An anchor's position in its text and the distances to its first and last string start, in one number."""
    return (at << 16) | ((at - first) << 8) | (at - last)


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, and doc (never null) and code, which name a text, and the text as bytes."""
    text, doc_id = F.coalesce(F.col("text").cast("string"), F.lit("")), F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(-1 << 63)).alias("doc"), F.xxhash64(text).alias("code"), text.cast("binary").alias("text"))


def document_anchors(texts: DataFrame) -> DataFrame:
    """doc, code, key (hash of the prefix) and place of every anchor, stored."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, offsets in text_chunks(batch.column("text")):
                text, at, low, high = anchors(data, offsets)
                if len(at):
                    rows = pa.array(text + first)
                    begin = offsets[text]
                    yield pa.RecordBatch.from_arrays([batch.column("doc").take(rows), batch.column("code").take(rows), pa.array(prefix_keys(data, at).view(np.int64)),
                                                      pa.array(packed_place(at - begin, low - begin, high - begin))], names=["doc", "code", "key", "place"])

    return stored(texts.mapInArrow(find, _ANCHORS), "anchors")


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which `known` bytes are known to be equal."""
    end, step = min(len(a), len(b)), 16
    while known < end:
        stop = min(known + step, end)
        if a[known:stop] != b[known:stop]:
            while stop - known > 1:
                middle = (known + stop) // 2
                if a[known:middle] == b[known:middle]:
                    known = middle
                else:
                    stop = middle
            return known
        known, step = stop, step * 2
    return end


class Run:
    """A front-coded sorted run: its current suffix and the prefix it shares with the one before."""

    __slots__ = ("data", "at", "next", "shared", "lengths", "text", "known", "row")

    def __init__(self, shared: np.ndarray, lengths: np.ndarray, data: bytes) -> None:
        self.shared, self.lengths, self.data = shared.tolist(), lengths.tolist(), data
        self.at, self.row, self.text, self.known = 0, -1, b"", 0
        self.advance()

    def advance(self) -> None:
        self.row += 1
        if self.row == len(self.shared):
            self.text, self.known = None, -1
            return
        self.known, length = self.shared[self.row], self.lengths[self.row]
        self.text = self.text[:self.known] + self.data[self.at:self.at + length]
        self.at += length


def merge_runs(runs: list[Run]) -> Iterator[tuple[int, int, bytes, int]]:
    """Run, row, suffix and prefix shared with the suffix before, of all runs in order.

    A loser tree: each inner node keeps the loser of its match. `known` of a run is the length of
    the prefix that its suffix shares with the last winner of its matches. The longer it is, the
    smaller the suffix; only equal lengths call for a comparison, which starts behind that prefix.
    """
    count = len(runs)
    if not count:
        return
    losers = [-1] * count  # losers[n] for inner nodes n >= 1; leaves are count .. 2 * count - 1

    def match(a: int, b: int) -> tuple[int, int]:
        """Winner and loser of two runs; sets what the loser shares with the winner."""
        x, y = runs[a], runs[b]
        if x.known != y.known:
            return (a, b) if x.known > y.known else (b, a)
        if x.text is None:
            return a, b
        shared = common_prefix(x.text, y.text, x.known)
        if shared == len(x.text) or (shared < len(y.text) and x.text[shared] < y.text[shared]):
            y.known = shared
            return a, b
        x.known = shared
        return b, a

    def play(node: int) -> int:
        if node >= count:
            return node - count
        winner, losers[node] = match(play(2 * node), play(2 * node + 1))
        return winner

    for run in runs:
        run.known = -1 if run.text is None else 0
    winner = play(1) if count > 1 else 0
    while runs[winner].text is not None:
        run = runs[winner]
        yield winner, run.row, run.text, run.known
        run.advance()
        node = (winner + count) // 2
        while node:
            winner, losers[node] = match(losers[node], winner)
            node //= 2


def repeated_offsets(group: list[tuple[bytes, int, int]]) -> list[list[tuple[int, int]]]:
    """For suffixes (text, forward bytes, count) that share a prefix: the ranges of offsets whose strings repeat.

    The string at offset a has a bytes before the anchor and LENGTH - a from it on. With f bytes
    alike from the anchors on and l before them, two suffixes agree at the offsets LENGTH - f .. l.
    """
    bounds = [(LENGTH - forward, len(text) - forward) for text, forward, _ in group]
    out: list[list[tuple[int, int]]] = [[b] if item[2] > 1 else [] for b, item in zip(bounds, group, strict=True)]
    if len(group) == 1:
        return out
    if len(group) <= 12:
        ahead, back = [t[:f] for t, f, _ in group], [t[f:] for t, f, _ in group]
        for i in range(len(group)):
            for j in range(i):
                low = LENGTH - common_prefix(ahead[i], ahead[j], PREFIX)
                high = common_prefix(back[i], back[j])
                if low <= high:
                    out[i].append((low, high))
                    out[j].append((low, high))
        return out
    whole = [text[forward:][::-1] + text[:forward] for text, forward, _ in group]
    for a in range(min(b[0] for b in bounds), max(b[1] for b in bounds) + 1):
        held = [i for i, (low, high) in enumerate(bounds) if low <= a <= high]
        strings = [whole[i][bounds[i][1] - a:bounds[i][1] - a + LENGTH] for i in held]
        tally = Counter(strings)
        for i, string in zip(held, strings, strict=True):
            if tally[string] > 1:
                if out[i] and out[i][-1][1] == a - 1:
                    out[i][-1] = (out[i][-1][0], a)
                else:
                    out[i].append((a, a))
    return out


def sorted_runs(found: DataFrame, buckets: int) -> DataFrame:
    """Front-coded sorted runs of the suffixes of `found`: doc, code, text, and places (inverted for split ones)."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows = []
            for bucket, entries in held.items():
                entries.sort(key=lambda e: e[:2])
                shared, lengths, forward, repeats, refs, parts, before = [], [], [], [], [], [], b""
                for text, ahead, *ref in entries:
                    if shared and text == before and ahead == forward[-1]:
                        if not repeats[-1]:
                            repeats[-1] = True
                            settled.append((refs[-1], ahead, text))
                            refs[-1] = None
                        settled.append((tuple(ref), ahead, text))
                        continue
                    known = common_prefix(before, text)
                    shared.append(known)
                    lengths.append(len(text) - known)
                    forward.append(ahead)
                    repeats.append(False)
                    refs.append(tuple(ref))
                    parts.append(text[known:])
                    before = text
                refs = [r or (0, 0, 0) for r in refs]
                rows.append((bucket, shared, lengths, forward, repeats, *map(list, zip(*refs, strict=True)), b"".join(parts)))
            # What repeats within a run needs no answer: its spans go to any bucket.
            spread: dict[int, list[tuple]] = {}
            for (doc, code, at), ahead, text in settled:
                spread.setdefault(code % buckets, []).append((doc, code, at - (len(text) - ahead), at + ahead))
            for bucket, spans in spread.items():
                docs, codes, first, last = map(list, zip(*spans, strict=True))
                rows.append((bucket, None, first, last, None, docs, codes, [], None))
            settled.clear()
            held.clear()
            for i in range(0, len(rows), 64):
                chosen = rows[i:i + 64]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*chosen, strict=True), types, strict=True)], names=names)

        names = [x.split()[0] for x in _RUNS.split(", ")]
        whole, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
        types = [pa.int64(), whole, whole, whole, pa.list_(pa.bool_()), longs, longs, longs, pa.binary()]
        settled: list[tuple] = []
        for batch in batches:
            ids, codes, texts, places = (batch.column(n) for n in ("doc", "code", "text", "places"))
            for row in range(batch.num_rows):
                text, doc, code = texts[row].as_py(), ids[row].as_py(), codes[row].as_py()
                data = np.frombuffer(text, np.uint8)
                packed = places[row].values.to_numpy()
                split = packed < 0
                packed = np.where(split, ~packed, packed)
                at, first, last = packed >> 16, (packed >> 16) - (packed >> 8 & 255), (packed >> 16) - (packed & 255)
                keys = prefix_keys(data, at[~split]) % np.uint64(buckets)
                for a, low, high, bucket in zip(at[~split].tolist(), first[~split].tolist(), last[~split].tolist(), keys.tolist(), strict=True):
                    end = high + LENGTH
                    held.setdefault(bucket, []).append((text[a:end] + text[low:a][::-1], end - a, doc, code, a))
                    size += end - low
                for low, high in zip(first[split].tolist(), last[split].tolist(), strict=True):
                    for p in range(low, high + 1):
                        string = text[p:p + LENGTH]
                        bucket = int.from_bytes(hashlib.blake2b(string, digest_size=8).digest(), "little") % buckets
                        held.setdefault(bucket, []).append((string, LENGTH, doc, code, p))
                        size += LENGTH
                if size >= RUN_BYTES:
                    yield from flush()
                    size = 0
        yield from flush()

    return found.select("doc", "code", "text", "places").mapInArrow(build, _RUNS)


def merged_spans(rows: pd.DataFrame) -> pd.DataFrame:
    """The repeated byte spans that the runs of one bucket show: doc, code, first, last (behind the span)."""
    out: list[tuple] = []
    done = rows["shared"].isna()
    for row in rows[done].itertuples():
        out += zip(row.doc, row.code, row.lengths, row.forward, strict=True)
    kept = [row for row in rows[~done].itertuples()]
    runs = [Run(row.shared, row.lengths, row.data) for row in kept]
    group: list[list] = []  # text, forward bytes, count, references

    def settle() -> None:
        for (*_, refs), ranges in zip(group, repeated_offsets([tuple(item[:3]) for item in group]), strict=True):
            for doc, code, at in refs:
                out.extend((doc, code, at - high, at - low + LENGTH) for low, high in ranges)

    for run, number, text, shared in merge_runs(runs):
        row = kept[run]
        forward, count = int(row.forward[number]), 2 if row.repeats[number] else 1
        if group and shared < PREFIX:
            settle()
            group = []
        same = None
        for item in reversed(group):
            if len(item[0]) != len(text) or item[0] != text:
                break
            if item[1] == forward:
                same = item
                break
        if same is None:
            same = [text, forward, 0, []]
            group.append(same)
        same[2] += count
        if not row.repeats[number]:
            same[3].append((row.doc[number], row.code[number], row.at[number]))
    if group:
        settle()
    return united(pd.DataFrame(out, columns=["doc", "code", "first", "last"]).astype("int64"))


def united(spans: pd.DataFrame) -> pd.DataFrame:
    """The spans of each document as maximal runs: a bucket gives one row for what overlaps or touches in it."""
    if spans.empty:
        return spans
    spans = spans.sort_values(["doc", "code", "first", "last"], ignore_index=True)
    behind = spans.groupby(["doc", "code"], sort=False)["last"].cummax().shift(fill_value=0)
    other = (spans["doc"] != spans["doc"].shift()) | (spans["code"] != spans["code"].shift())
    run = (other | (spans["first"] > behind)).cumsum()
    return spans.groupby(run, sort=False).agg({"doc": "first", "code": "first", "first": "min", "last": "max"}).reset_index(drop=True)


def removed(docs: DataFrame) -> DataFrame:
    """doc, code and the byte spans (first, last behind it) of strings of LENGTH bytes that start elsewhere too."""
    texts = _texts(docs)
    every = document_anchors(texts)
    # Stored, so that the join sees two plain shuffles and can split the rows of a hot prefix.
    counts = stored(every.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "prefix-counts")
    place = F.when(F.col("n") > HOT, F.bitwise_not("place")).otherwise(F.col("place"))
    chosen = every.join(counts.hint("shuffle_hash"), "key").select("doc", "code", place.alias("place"))
    found = stored(chosen.groupBy("doc", "code").agg(F.collect_set("place").alias("places")), "anchor-lists")
    places = found.agg(F.sum(F.size("places"))).first()[0] or 0
    buckets = max(16, -(-places * (LENGTH + WINDOW // 2) // BUCKET_BYTES))
    return sorted_runs(texts.join(found, ["doc", "code"]), buckets).groupBy("bucket").applyInPandas(merged_spans, _SPANS)


def union_spans(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that the spans cover."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(first.tolist(), last.tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def dedup_strings(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Every byte of a LENGTH-byte string of UTF-8 text that also starts anywhere else, in the same
    document or another, is removed; strings never cross documents. Null text is empty, and texts
    shorter than LENGTH lose nothing. Repeated rows repeat each other's strings. Other columns are
    ignored; an empty table gives no rows.
    """
    spans = stored(removed(docs).groupBy("doc", "code").agg(F.collect_set(F.struct("first", "last")).alias("spans")), "spans")
    texts = _texts(docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, found in zip(batch.column("doc_id"), batch.column("text"), batch.column("spans"), strict=True):
                text, runs = text.as_py(), []
                if found.is_valid:
                    pairs = found.values
                    runs = union_spans(pairs.field("first").to_numpy(), pairs.field("last").to_numpy())
                digest, at = hashlib.sha256(), 0
                for a, b in runs:
                    digest.update(text[at:a])
                    at = b
                digest.update(text[at:])
                rows.append((doc_id.as_py(), len(text), sum(b - a for a, b in runs), len(runs), digest.hexdigest()))
            if rows:
                types = [pa.int64()] * 4 + [pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                                 names=[x.split()[0] for x in _RESULT.split(", ")])

    return texts.join(spans, ["doc", "code"], "left").select("doc_id", "text", "spans").mapInArrow(cut, _RESULT)

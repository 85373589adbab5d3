"""Removal of passages of many words that an earlier document holds, by seed and extend.

Seeds: of each window of LENGTH words the gram with the least hash among its first WINDOW grams is
the anchor (winnowing), so equal windows have their anchor at one offset. A seed stands for the run
of windows that share its anchor. Seeds are joined on their core, the words behind the anchor that
all those windows include; a core that one document alone holds is dropped.

Extend: seeds of one core with the same words in all their windows are one class, and all but the
smallest doc_id of a class lose those words. One seed per class is then extended from the anchor to
both sides, word by word, against the seeds of the core's classes with smaller doc_ids; what both
ways give together is a maximal repeat, kept if it is as long as a window. A core of very many
classes is extended window by window instead: each window names its own group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velolake.llm.common import BASE, BYTE_CODES, mixed, powers, text_chunks
from velolake.llm.shingles import word_hashes
from velolake.session import stored

LENGTH = 50
WINDOW, GRAM = 32, 8
# Words from an anchor on that all windows which it stands for include.
CORE = LENGTH - WINDOW + 1
# A core with more classes is extended window by window.
HOT = 32

_SEEDS = "doc long, code long, key long, whole long, place long"
_CONTEXTS = "key long, whole long, least long, kinds long, back int, words string"
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


class RangeHashes:
    """Hashes of runs of words, from sums over their prefixes."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum(hashes * powers(len(hashes))[:len(hashes)], dtype=np.uint64)))
        self.back = np.full(len(hashes) + 1, _INVERSE, np.uint64)
        self.back[0] = 1
        self.back = np.multiply.accumulate(self.back)

    def __call__(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[first]) * self.back[first] + (end - first).astype(np.uint64))


def sliding_least(values: np.ndarray, window: int) -> np.ndarray:
    """The least of each `window` values in a row; the last ones have fewer."""
    padded = np.full(-(-(len(values) + window) // window) * window, np.iinfo(values.dtype).max, values.dtype)
    padded[:len(values)] = values
    blocks = padded.reshape(-1, window)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    at = np.arange(len(values))
    return np.minimum(behind[at], ahead[at + window - 1])


def seeds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """text, key, whole and place of the seeds of texts that stand one after the other.

    key is a hash of the core, whole one of all words of the windows and where the anchor is among
    them; place packs the anchor's word number and its distances to the first and last window.
    """
    hashes, counts = word_hashes(data, offsets, BYTE_CODES)
    windows = np.maximum(np.diff(counts) - LENGTH + 1, 0)
    if not windows.any():
        return (np.empty(0, np.int64),) * 4
    ranged = RangeHashes(hashes)
    at = np.arange(len(hashes) - GRAM + 1)
    order = (ranged(at, at + GRAM) & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    start = np.arange(windows.sum()) + np.repeat(counts[:-1] - np.concatenate(([0], windows.cumsum()[:-1])), windows)
    anchor = (sliding_least(order, WINDOW)[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    edge = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    anchor, first, last = anchor[edge], start[edge], start[np.append(edge[1:], len(start)) - 1]
    text = np.searchsorted(counts, anchor, side="right") - 1
    shape = ((anchor - first) << 6) | (anchor - last)
    whole = mixed(ranged(first, last + LENGTH) ^ shape.astype(np.uint64))
    return text, ranged(anchor, anchor + CORE).view(np.int64), whole.view(np.int64), ((anchor - counts[text]) << 12) | shape


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, code (hash of the text), which with the doc_id names a text, and the text as bytes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("code"), text.cast("binary").alias("text"))


def document_seeds(texts: DataFrame) -> DataFrame:
    """doc, code, key, whole and place of every seed, stored. Rows without doc_id have none."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, offsets in text_chunks(batch.column("text")):
                text, key, whole, place = seeds(data, offsets)
                if len(text):
                    rows = pa.array(text + first)
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(rows), batch.column("code").take(rows), pa.array(key), pa.array(whole), pa.array(place)],
                                                     names=[x.split()[0] for x in _SEEDS.split(", ")])

    return stored(texts.filter("doc_id IS NOT NULL").mapInArrow(find, _SEEDS), "seeds")


def shared_seeds(found: DataFrame) -> DataFrame:
    """Seeds of cores that several documents hold, with their class's least doc_id and the core's number of classes, stored."""
    classes = stored(found.groupBy("key", "whole").agg(F.min("doc").alias("least"), F.max("doc").alias("most")), "seed-classes")
    cores = classes.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.min("least").alias("low"), F.max("most").alias("high"))
    cores = stored(cores.filter("low < high").select("key", "kinds"), "cores")
    # Stored, so that the join sees two plain shuffles and can split the seeds of a hot class.
    held = stored(classes.join(cores.hint("shuffle_hash"), "key").select("key", "whole", "least", "kinds"), "shared-classes")
    return stored(found.join(held.hint("shuffle_hash"), ["key", "whole"]), "shared-seeds")


def seed_contexts(texts: DataFrame, shared: DataFrame) -> DataFrame:
    """key, whole, least, kinds, back and words of one seed per class, stored.

    words has all words of the seed's windows, the anchor is word number `back` of them.
    """
    owners = shared.filter("kinds > 1 AND doc = least").groupBy("key", "whole", "kinds", F.col("doc").alias("doc_id")).agg(F.min("code").alias("code"), F.min(F.struct("code", "place")).alias("at"))
    places = owners.groupBy("doc_id", "code").agg(F.collect_list(F.struct("key", "whole", "kinds", F.col("at.place").alias("place"))).alias("places"))
    # Rows that repeat a document repeat its contexts; one is enough.
    asked = texts.join(stored(places, "seed-places").hint("shuffle_hash"), ["doc_id", "code"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, text, places in zip(batch.column("doc_id"), batch.column("text"), batch.column("places"), strict=True):
                words, doc = text.as_py().split(), doc.as_py()
                for seed in places.as_py():
                    anchor, back, ahead = seed["place"] >> 12, seed["place"] >> 6 & 63, seed["place"] & 63
                    span = words[anchor - back:anchor - ahead + LENGTH]
                    rows.append((seed["key"], seed["whole"], doc, seed["kinds"], back, b" ".join(span)))
                if len(rows) >= 4096:
                    yield _batch(rows, _CONTEXTS)
                    rows = []
            if rows:
                yield _batch(rows, _CONTEXTS)

    contexts = asked.select("doc_id", "text", "places").mapInArrow(cut, _CONTEXTS)
    return stored(contexts, "seed-contexts")


_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[kind]) for c, (_, kind) in zip(zip(*rows, strict=True), fields, strict=True)], names=[name for name, _ in fields])


def alike(a: list, b: list) -> int:
    """Number of leading items that two lists share."""
    count = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        count += 1
    return count


def extended(group: list[tuple[int, int, int, list]]) -> list[tuple[int, int, int]]:
    """whole, low, high for each repeat of the seeds (whole, least, back, words) of a core.

    A repeat holds the windows that start `low` to `high` words before the anchor.
    """
    sides = sorted(((least, whole, words[:back][::-1], words[back:]) for whole, least, back, words in group), key=itemgetter(0))
    out = []
    for i, (least, whole, behind, ahead) in enumerate(sides):
        ranges = set()
        for earlier, _, other_behind, other_ahead in sides[:i]:
            if earlier == least:
                break
            right = alike(ahead, other_ahead)
            low, high = max(LENGTH - right, LENGTH - len(ahead)), alike(behind, other_behind)
            if max(low, 0) <= high:
                ranges.add((max(low, 0), high))
        out += [(whole, low, high) for low, high in ranges]
    return out


def extended_seeds(contexts: DataFrame) -> DataFrame:
    """key, whole, low, high of the repeats that the class's own document loses, stored."""
    schema = "key long, whole long, low int, high int"

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("key", "whole", "least", "back", "words")), strict=True))
        out: list[tuple] = []
        for key, group in groupby(rows, key=itemgetter(0)):
            held = {whole: (whole, least, back, words.split(" ")) for _, whole, least, back, words in group}
            out += [(key, *found) for found in extended(list(held.values()))]
            if len(out) >= 4096:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    few = contexts.filter(F.col("kinds") <= HOT).select("key", "whole", "least", "back", "words")
    pairs = few.repartition("key").sortWithinPartitions("key").mapInArrow(extend, schema)
    # Many classes: every window of theirs is a group of its own.
    words = F.split("words", " ")
    windows = contexts.filter(F.col("kinds") > HOT).select("key", "whole", "least", "back", words.alias("words"), F.posexplode(F.sequence(F.lit(1), F.size(words) - (LENGTH - 1))))
    window = F.array_join(F.slice("words", F.col("col"), LENGTH), " ")
    windows = windows.select("key", "whole", "least", (F.col("back") - F.col("pos")).alias("before"), F.xxhash64(window).alias("x"), F.xxhash64(window, F.lit(1)).alias("y"))
    windows = stored(windows, "seed-windows")
    first = windows.groupBy("key", "before", "x", "y").agg(F.min("least").alias("low"), F.max("least").alias("high")).filter("low < high")
    first = stored(first.select("key", "before", "x", "y", F.col("low").alias("first")), "first-windows")
    later = windows.join(first.hint("shuffle_hash"), ["key", "before", "x", "y"]).filter("least > first")
    return stored(pairs.union(later.select("key", "whole", F.col("before").cast("int").alias("low"), F.col("before").cast("int").alias("high"))).distinct(), "extended-seeds")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, code and spans (first word, word behind the last) of what an earlier document holds too."""
    texts = _texts(docs)
    shared = shared_seeds(document_seeds(texts))
    anchor = F.shiftright("place", 12)
    whole = shared.filter("doc > least").select(
        F.col("doc").alias("doc_id"), "code", (anchor - F.shiftright("place", 6).bitwiseAND(63)).alias("first"), (anchor - F.col("place").bitwiseAND(63) + LENGTH).alias("last"))
    parts = extended_seeds(seed_contexts(texts, shared)).groupBy("key", "whole").agg(F.collect_list(F.struct("low", "high")).alias("parts"))
    own = shared.filter("doc = least AND kinds > 1").join(stored(parts, "seed-parts").hint("shuffle_hash"), ["key", "whole"])
    own = own.select(F.col("doc").alias("doc_id"), "code", "place", F.explode("parts").alias("part"))
    own = own.select("doc_id", "code", (anchor - F.col("part.high")).alias("first"), (anchor - F.col("part.low") + LENGTH).alias("last"))
    return whole.union(own).groupBy("doc_id", "code").agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def dedup_passages(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, text (the words that stay, joined by one space), n_words, n_removed, spans (of words, maximal).

    Every word goes that a window of LENGTH words covers whose words also start, in this order, in a
    document with a smaller doc_id; windows are judged on the whole input. Null and empty texts have
    no words; texts with fewer than LENGTH words lose none. Rows of one doc_id do not count as
    earlier for one another; rows without doc_id lose nothing and take nothing. Other columns are
    ignored; an empty table gives no rows. A task holds one text at a time, whole.
    """
    spans = stored(repeated_spans(docs), "passage-spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, gone, bounds = [], [], [], []
            for text, found in zip(batch.column("text"), batch.column("spans"), strict=True):
                words = text.as_py().split()
                counts.append(len(words))
                kept, runs, at = words, [], 0
                if found.is_valid:
                    for first, last in sorted(zip(found.values.field("first").to_pylist(), found.values.field("last").to_pylist(), strict=True)):
                        if runs and first <= runs[-1]["last"]:
                            runs[-1]["last"] = max(runs[-1]["last"], last)
                        else:
                            runs.append({"first": first, "last": last})
                    kept = []
                    for run in runs:
                        kept += words[at:run["first"]]
                        at = run["last"]
                    kept += words[at:]
                texts.append(b" ".join(kept))
                gone.append(len(words) - len(kept))
                bounds.append(runs)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary()), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(bounds, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))], names=["doc_id", "text", "n_words", "n_removed", "spans"])

    rows = _texts(docs).join(spans, ["doc_id", "code"], "left").select("doc_id", "text", "spans")
    rows = rows.mapInArrow(cut, "doc_id long, text binary, n_words long, n_removed long, spans array<struct<first: long, last: long>>")
    return rows.withColumn("text", F.col("text").cast("string"))


ORACLE = r"""
WITH words AS (SELECT doc_id, row_number() OVER () AS row, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents),
starts AS (SELECT doc_id, row, s, array_to_string(w[s:s + 49], ' ') AS line FROM words, unnest(range(1, len(w) - 48)) AS t(s)),
owner AS (SELECT line, min(doc_id) AS least FROM starts GROUP BY line),
hit AS (SELECT row, s FROM starts JOIN owner USING (line) WHERE doc_id > least),
each AS (SELECT row, i, w[i] AS word FROM words, unnest(range(1, len(w) + 1)) AS t(i)),
marked AS (SELECT each.row, i, word, max(s) OVER (PARTITION BY each.row ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
    FROM each LEFT JOIN hit ON hit.row = each.row AND hit.s = each.i),
kept AS (SELECT row, count(*) FILTER (gone) AS gone, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS text FROM marked GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (row)
"""

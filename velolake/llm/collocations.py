"""Word collocations by partitioned mining (SON): frequent in a shard, united, then counted exactly.

A shard is a fixed share of the tasks. A phrase with a support of SUPPORT in all shards together has
its share of that, SUPPORT / SHARDS, in at least one of them. Each shard is mined completely at this
lowered support, level by level: words, then pairs of frequent words, then longer phrases of
frequent pairs. What is frequent in any shard is a candidate; a last pass counts the candidates
over all texts and shards, by the phrases themselves. A task holds the words of one chunk of text
at a time and passes on what it counted there; Spark adds the counts up.

Candidates reach the tasks as a bit filter of a fixed size. A phrase that passes it by chance is
counted in vain and falls below the support; none is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velolake.llm.common import mixed, text_chunks
from velolake.llm.shingles import LOWER_CODES, hashed_words
from velolake.session import setting, stored

SUPPORT, LONGEST = 30, 4
# Each shard is mined by half of all tasks, so few shards cost nothing and rule out the most.
SHARDS = 2
# A part of a longer phrase goes if the longer one has so many hundredths of its occurrences.
ABSORBED = 80
TOP = 2000
# Bytes of text that a task counts together, and the rows that it passes on at a time.
CHUNK_BYTES, BATCH_ROWS = 2 << 20, 1 << 16
# Texts come to a task in batches of about a chunk too.
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
# log2 of the bits of the filter (16 MB), and the bits that a phrase sets.
FILTER_BITS, PROBES = 27, 4

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(10, 14)]] = True
_BETWEEN = _BREAK.copy()
_BETWEEN[[9, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_COUNTS = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.binary()), ("n", pa.int64())])
_FACTORS = mixed(np.arange(1, LONGEST + 1, dtype=np.uint64)) | np.uint64(1)
_ODD = mixed(np.arange(101, 101 + PROBES, dtype=np.uint64)) | np.uint64(1)


@dataclass
class Words:
    """Words of many texts of one language: hashes, whether the next is in the same piece, their lengths, and the bytes of the texts."""

    hashes: np.ndarray
    linked: np.ndarray
    lengths: np.ndarray
    data: np.ndarray

    @classmethod
    def of(cls, lang: str, parts: list[tuple[np.ndarray, np.ndarray]]) -> Words:
        """Of texts that stand one after the other, in parts of bytes and offsets."""
        own = np.uint64(xxhash.xxh64_intdigest(lang.encode()))
        columns = []
        for data, offsets in parts:
            hashes, first, lengths, counts = hashed_words(data, offsets, LOWER_CODES, _BETWEEN)
            # The number of breaks before a word; the end of a text is a break too.
            pieces = np.cumsum(_BREAK[data])[first] + np.repeat(np.arange(len(counts) - 1), np.diff(counts))
            columns.append((mixed(hashes ^ own), np.append(pieces[1:] == pieces[:-1], False)[:len(pieces)], lengths, data))
        return cls(*map(np.concatenate, zip(*columns, strict=True)))

    def spelled(self) -> pa.Array:
        """Every word, A-Z as a-z."""
        ends = np.cumsum(self.lengths, dtype=np.int64)
        buffers = [None, pa.py_buffer(np.append(0, ends)), pa.py_buffer(_LOWER[self.data[~_BETWEEN[self.data]]])]
        return pa.Array.from_buffers(pa.large_binary(), len(self.hashes), buffers)

    def keys(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the `size` words from each place on, and whether they are in one piece."""
        places = max(len(self.hashes) - size + 1, 0)
        keys, inside = np.full(places, size, np.uint64), np.ones(places, bool)
        for k in range(size):
            keys += self.hashes[k:k + places] * _FACTORS[k]
            if k:
                inside &= self.linked[k - 1:k - 1 + places]
        return mixed(keys), inside


def language_words(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[str, Words]]:
    """The texts of each language, about `most` bytes of all languages at a time."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0
    for batch in batches:
        for lang in pc.unique(batch.column("lang")).to_pylist():
            for _, _, data, offsets in text_chunks(batch.column("text").filter(pc.equal(batch.column("lang"), lang))):
                held.setdefault(lang, []).append((data, offsets))
                size += len(data)
                if size >= most:
                    yield from ((name, Words.of(name, parts)) for name, parts in held.items())
                    held, size = {}, 0
    yield from ((name, Words.of(name, parts)) for name, parts in held.items())


def passing(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys the filter holds; some that it was not given are among them."""
    found = np.ones(len(keys), bool)
    unused = np.uint64(64 - (64 * len(bits) - 1).bit_length())
    for factor in _ODD:
        place = (keys * factor) >> unused
        found &= (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0
    return found


def possible(words: Words, size: int, bits: np.ndarray | None, part: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the phrases of `size` words whose parts of `part` words all pass the filter, and their keys."""
    keys, inside = words.keys(size)
    places = np.flatnonzero(inside)
    if bits is not None and len(places):
        if part == size:
            places = places[passing(bits, keys[places])]
        else:
            frequent = passing(bits, words.keys(part)[0])
            for k in range(size - part + 1):
                places = places[frequent[places + k]]
    return places, keys[places]


def locally_frequent(texts: DataFrame, sizes: tuple[int, ...], held: DataFrame | None) -> DataFrame:
    """Keys of the phrases of these sizes that are frequent in a shard, given those of the frequent parts one level below."""
    bits = sent_filter(held) if held is not None else None
    part, most, shards = min(sizes) - 1, CHUNK_BYTES, SHARDS

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % shards
        for _, words in language_words(batches, most):
            for size in sizes:
                keys, counts = np.unique(possible(words, size, bits.value if bits else None, part)[1], return_counts=True)
                for i in range(0, len(keys), BATCH_ROWS):
                    some = slice(i, i + BATCH_ROWS)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys[some]), shard, np.int32)), pa.array(keys[some].view(np.int64)), pa.array(counts[some])], names=["shard", "key", "n"])

    counted = texts.mapInArrow(tally, "shard int, key long, n long").groupBy("shard", "key").agg(F.sum("n").alias("n"))
    # n >= SUPPORT / SHARDS, in whole numbers.
    with setting(texts.sparkSession, _BATCH, str(CHUNK_BYTES)):
        return stored(counted.filter(F.col("n") * shards >= SUPPORT).select("key").distinct(), "local-phrases")


def sent_filter(keys: DataFrame) -> Broadcast:
    """The keys as a bit filter of 2 ** FILTER_BITS bits, sent to all tasks; its size does not depend on their number."""
    unused = 64 - FILTER_BITS

    def spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("key").to_numpy().view(np.uint64)
            place = np.concatenate([(own * factor) >> np.uint64(unused) for factor in _ODD])
            yield pa.RecordBatch.from_arrays([pa.array((place >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (place & np.uint64(63))).view(np.int64))], names=["at", "bits"])

    found = keys.mapInArrow(spots, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    bits[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(bits)


def phrase_counts(batches: Iterator[pa.RecordBatch], bits: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """lang, size, phrase, n of the phrases that pass the filter in each chunk of `most` bytes, and of size 0 the number of words."""
    for lang, words in language_words(batches, most):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(([lang], [0], [b""], [len(words.hashes)]), _COUNTS.types, strict=True)], schema=_COUNTS)
        spelled = words.spelled()
        for size in range(1, LONGEST + 1):
            places, keys = possible(words, size, bits, size)
            _, first, inverse, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
            # Phrases that differ and share a key count one by one.
            strange = np.zeros(len(places), bool)
            for k in range(size):
                strange |= words.hashes[places + k] != words.hashes[places[first[inverse]] + k]
            np.subtract.at(counts, inverse[strange], 1)
            at = np.concatenate([places[first], places[strange]])
            counts = np.append(counts, np.ones(len(at) - len(first), np.int64))
            for i in range(0, len(at), BATCH_ROWS):
                some = at[i:i + BATCH_ROWS]
                phrases = pc.binary_join_element_wise(*(spelled.take(pa.array(some + k)) for k in range(size)), pa.scalar(b" ", pa.large_binary()))
                columns = [pa.repeat(lang, len(some)), pa.repeat(pa.scalar(size, pa.int32()), len(some)), phrases.cast(pa.binary()), pa.array(counts[i:i + BATCH_ROWS])]
                yield pa.RecordBatch.from_arrays(columns, schema=_COUNTS)


def counted_phrases(texts: DataFrame, candidates: DataFrame) -> DataFrame:
    """lang, size, phrase, n of all phrases that occur SUPPORT times, and of size 0 the number of words per lang, stored."""
    bits, most = sent_filter(candidates), CHUNK_BYTES

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from phrase_counts(batches, bits.value, most)

    counts = texts.mapInArrow(tally, "lang string, size int, phrase binary, n long").groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    counts = counts.filter((F.col("n") >= SUPPORT) | (F.col("size") == 0))
    with setting(texts.sparkSession, _BATCH, str(CHUNK_BYTES)):
        return stored(counts.select("lang", "size", F.col("phrase").cast("string").alias("phrase"), "n"), "phrase-counts")


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the `top` phrases of 2 to 4 words per language.

    Texts are taken with A-Z as a-z and split into pieces at breaks, pieces into words at blanks and
    tabs. a is the phrase's number of occurrences, SUPPORT at least, l and r those of its two parts
    at the cut with the lowest score floor(2000000 * a / (l + r)), the earliest of equals; n is the
    number of words of the language. Phrases inside a longer one that has ABSORBED hundredths of
    their occurrences go. By score, then a (both descending), then phrase. Null lang is `und`; null
    and empty texts have no words; repeated rows count each; doc_id and other columns are ignored;
    an empty table gives no rows. A task counts CHUNK_BYTES of text, or one longer text, at a time.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").cast("binary").alias("text"))
    words = locally_frequent(texts, (1,), None)
    pairs = locally_frequent(texts, (2,), words)
    longer = locally_frequent(texts, tuple(range(3, LONGEST + 1)), pairs)
    counts = counted_phrases(texts, words.union(pairs).union(longer))

    found = counts.filter("size > 1").withColumnRenamed("n", "a")
    total = counts.filter("size = 0").select("lang", F.col("n").alias("n"))
    part = counts.filter("size > 0").select("lang", F.col("phrase").alias("part"), F.col("n").alias("times"))
    parts = found.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), "size")
    left, right = F.expr("substring_index(phrase, ' ', k)"), F.expr("substring_index(phrase, ' ', k - size)")
    cuts = (parts.withColumn("part", left).join(part.withColumnRenamed("times", "l"), ["lang", "part"])
            .withColumn("part", right).join(part.withColumnRenamed("times", "r"), ["lang", "part"]))
    cuts = cuts.withColumn("score", F.expr("(cast(2000000 AS decimal(10,0)) * cast(a AS decimal(19,0))) div (cast(l AS decimal(19,0)) + cast(r AS decimal(19,0)))").cast("long"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # Every contiguous part of two words or more, with the most occurrences of a phrase around it.
    around = found.filter("size > 2").select("lang", "size", F.split("phrase", " ").alias("words"), F.col("a").alias("times"), F.explode(F.expr("sequence(2, size - 1)")).alias("m"))
    around = around.select("lang", "words", "times", "m", F.explode(F.expr("sequence(1, size - m + 1)")).alias("at"))
    around = around.groupBy("lang", F.array_join(F.slice("words", F.col("at"), F.col("m")), " ").alias("phrase")).agg(F.max("times").alias("most"))
    kept = scored.join(around, ["lang", "phrase"], "left").filter(
        F.col("most").isNull() | (F.lit(100).cast("decimal(5,0)") * F.col("most").cast("decimal(19,0)") < F.lit(ABSORBED).cast("decimal(5,0)") * F.col("a").cast("decimal(19,0)")))
    # Each task ranks its own rows and passes on `top` per language.
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase"))
    ranked = kept.withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))


ORACLE = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
listed AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda s: array_to_string(w[s:s + k - 1], ' '))) AS phrase FROM (SELECT lang, w, unnest([1, 2, 3, 4]) AS k FROM words)),
grams AS (SELECT lang, k, phrase, count(*) AS f FROM listed GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE k = 1 GROUP BY lang),
found AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= 30),
cuts AS (SELECT p.lang, p.phrase, a, c, x.f AS l, y.f AS r, CAST(2000000::HUGEINT * a // (x.f + y.f) AS BIGINT) AS score
    FROM (SELECT *, array_to_string(w[1:c], ' ') AS head, array_to_string(w[c + 1:k], ' ') AS tail FROM (SELECT *, unnest(range(1, k)) AS c FROM found)) p
    JOIN grams x ON x.lang = p.lang AND x.phrase = p.head JOIN grams y ON y.lang = p.lang AND y.phrase = p.tail),
scored AS (SELECT lang, phrase, a, first({'l': l, 'r': r, 'score': score} ORDER BY score, c) AS cut FROM cuts GROUP BY ALL),
inner_parts AS (SELECT lang, a, unnest(list_transform(range(1, k - m + 2), lambda s: array_to_string(w[s:s + m - 1], ' '))) AS phrase FROM (SELECT *, unnest(range(2, k)) AS m FROM found)),
around AS (SELECT lang, phrase, max(a) AS most FROM inner_parts GROUP BY ALL),
kept AS (SELECT scored.* FROM scored LEFT JOIN around USING (lang, phrase) WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY cut.score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, cut.l AS l, cut.r AS r, n, cut.score AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

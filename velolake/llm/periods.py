"""Runs of periodic words in whole texts, by a dictionary of basic factors.

The dictionary names, for each power of two, the runs of so many words: equal runs of one text have
one name, a run that occurs once has none. Names of twice the length come from pairs of names. An
occurrence whose successor is within twice the length proposes the distance as a period; proposals
along one arithmetic progression, or at neighbouring places, are one. Each is extended to both
sides by the names, longest first, and equal stretches with multiples of a period are one run.

Work is per text, so tasks need no exchange: several texts are named together, text by text apart.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velolake.llm.common import SPACE, text_chunks

# A run has at least so many words and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4

_RUNS = "array<struct<start: long, length: long, period: long>>"
_RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def renamed(names: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """0, 1, ... at the places whose name occurs again, -1 at all others, of `size` places."""
    _, inverse, counts = np.unique(names, return_inverse=True, return_counts=True)
    again = counts > 1
    out = np.full(size, -1, np.int64)
    out[at] = np.where(again, np.cumsum(again) - 1, -1)[inverse]
    return out


def basic_factors(words: np.ndarray, text: np.ndarray) -> list[np.ndarray]:
    """Names of the factors of 1, 2, 4, ... words at every place, as long as any repeats within its text.

    `words` has a number per word and -1 between texts, `text` the number of each place's text.
    """
    at = np.flatnonzero(words >= 0)
    if not len(at):
        return []
    names = renamed(text[at] * (int(words.max()) + 1) + words[at], at, len(words))
    levels, length = [], 1
    while (names >= 0).any():
        levels.append(names)
        at = np.flatnonzero(names >= 0)
        at = at[at + length < len(names)]
        at = at[names[at + length] >= 0]
        if not len(at):
            break
        names = renamed(names[at] * (int(names.max()) + 1) + names[at + length], at, len(names))
        length *= 2
    return levels


def proposals(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances: one of each progression of successors, or stretch of neighbours, with one distance."""
    places, periods = [], []
    for level, names in enumerate(levels):
        length = 1 << level
        at = np.flatnonzero(names >= 0)
        at = at[np.argsort(names[at], kind="stable")]
        step = np.where(names[at[1:]] == names[at[:-1]], at[1:] - at[:-1], 0)
        # Shorter distances were proposed by shorter factors.
        near = (step > length // 2) & (step <= 2 * length)
        distance = np.zeros(len(names), np.int64)
        distance[at[:-1]] = np.where(near, step, 0)
        heads = np.append(True, step[1:] != step[:-1])[:len(step)] & near
        head = at[:-1][heads]
        head = head[(head == 0) | (distance[head - 1] != distance[head])]
        places.append(head)
        periods.append(distance[head])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(places), np.concatenate(periods)


def extended(levels: list[np.ndarray], place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and the place behind the last of the stretch around each place that keeps the period."""
    low, high, size = place.copy(), place.copy(), len(levels[0])
    for level in reversed(range(len(levels))):
        names, length = levels[level], 1 << level
        far = np.minimum(high + period, size - 1)
        same = (high + period < size) & (names[np.minimum(high, size - 1)] == names[far]) & (names[far] >= 0)
        high += np.where(same, length, 0)
        left = np.maximum(low - length, 0)
        same = (low >= length) & (names[left] == names[left + period]) & (names[left] >= 0)
        low -= np.where(same, length, 0)
    return low, high + period


def runs_of(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, length and smallest period of every run, by start, then period."""
    levels = basic_factors(words, text)
    place, period = proposals(levels)
    if not len(place):
        return place, place, place
    start, end = extended(levels, place, period)
    whole = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    start, end, period = start[whole], end[whole], period[whole]
    # A stretch of one period also has its multiples: the smallest stays.
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    first = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))[:len(start)]
    start, end, period = start[first], end[first], period[first]
    order = np.lexsort((period, start))
    return start[order], (end - start)[order], period[order]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_words, runs (start, length, period; by start, then period) and the collapsed text.

    Words are numbered from 0. A run is a stretch of words that are identical `period` apart, at
    least LEAST_WORDS words and LEAST_PERIODS periods long, which no neighbouring word extends; the
    collapsed text lacks the words of every run behind its first period and joins the others by one
    space. Null and empty texts have no words and no runs. Every row is its own text, repeated rows
    too, and rows without doc_id are kept; other columns are ignored; an empty table gives no rows.
    A task holds about 1 MB of texts at a time, or one longer text, whole.
    """
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column("text")):
                content = data.tobytes()
                number: dict[bytes, int] = defaultdict(count().__next__)
                split = [content[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                sizes = np.fromiter(map(len, split), np.int64, len(split))
                # One place more per text keeps the texts apart.
                begin = np.concatenate(([0], np.cumsum(sizes + 1)))
                words = np.full(begin[-1], -1, np.int64)
                inside = np.ones(begin[-1], bool)
                inside[begin[1:] - 1] = False
                words[inside] = np.fromiter((number[w] for text in split for w in text), np.int64, int(sizes.sum()))
                start, length, period = runs_of(words, np.repeat(np.arange(len(split)), sizes + 1))
                owner = np.searchsorted(begin, start, side="right") - 1
                drop = np.zeros(begin[-1] + 1, np.int64)
                np.add.at(drop, start + period, 1)
                np.add.at(drop, start + length, -1)
                gone = np.cumsum(drop) > 0
                texts = []
                for row, own in enumerate(split):
                    lost = gone[begin[row]:begin[row] + len(own)]
                    texts.append(b" ".join([w for w, x in zip(own, lost, strict=True) if not x] if lost.any() else own))
                runs = pa.StructArray.from_arrays([pa.array(start - begin[owner]), pa.array(length), pa.array(period)], fields=list(_RUN_TYPE))
                bounds = pa.array(np.searchsorted(owner, np.arange(len(split) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, end - first), pa.array(sizes), pa.ListArray.from_arrays(bounds, runs), pa.array(texts, pa.binary())],
                                                 names=["doc_id", "n_words", "runs", "text"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(find, f"doc_id long, n_words long, runs {_RUNS}, text binary").withColumn("text", F.col("text").cast("string"))


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, every tenth text (by a checksum of the doc_id) with periodic words from some word on."""
    words = F.filter(F.split(F.col("text").cast("string"), f"[{SPACE}]+"), lambda x: x != "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.crc32(F.col("doc_id").cast("long").cast("string")).alias("h"))
    chosen = F.col("h") % 10 == 0
    rows = rows.withColumn("words", F.when(chosen, words)).withColumn("n", F.size("words")).withColumn("g", F.expr("h div 10"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    periodic = F.expr("array_join(transform(words, (w, i) -> IF(i < a, w, element_at(words, cast(a + (i - a) % p + 1 AS int)))), ' ')")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), periodic).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """What periodic_runs found, as the longest run of each text and digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line: Column = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"), F.sha2(line, 256).alias("runs_sha256"), F.sha2(F.col("text"), 256).alias("collapsed_sha256"))


ORACLE = r"""
WITH source AS (SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w,
    xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda acc, x: list_reduce([0, 1, 2, 3, 4, 5, 6, 7],
        lambda v, k: xor(v >> 1, 3988292384 * (v & 1)), xor(acc, x)), 4294967295), 4294967295) AS h FROM documents),
chosen AS (SELECT *, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM source),
words AS (SELECT row, doc_id, CASE WHEN a IS NULL THEN w ELSE list_transform(range(0, len(w)),
    lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(w) - a) // (3 + g % 8)) END]) END AS w FROM chosen),
each AS (SELECT row, i, w[i + 1] AS word, len(w) AS n FROM words, unnest(range(0, len(w))) AS t(i)),
same AS (SELECT x.row, x.i, y.i - x.i AS q FROM each x JOIN each y ON x.row = y.row AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT row, q, i, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS island FROM same),
stretches AS (SELECT row, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY row, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT row, start, length, min(q) AS period FROM stretches GROUP BY row, start, length),
listed AS (SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
    first({'start': start, 'length': length, 'period': period} ORDER BY length DESC, start, period) AS best FROM runs GROUP BY row),
gone AS (SELECT DISTINCT row, i FROM runs, unnest(range(start + period, start + length)) AS t(i)),
kept AS (SELECT each.row, string_agg(word, ' ' ORDER BY each.i) AS text FROM each ANTI JOIN gone USING (row, i) GROUP BY each.row)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.start AS BIGINT) AS start, CAST(best.length AS BIGINT) AS length, CAST(best.period AS BIGINT) AS period,
    CAST(1000 * best.length // best.period AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM words LEFT JOIN listed USING (row) LEFT JOIN kept USING (row)
"""

"""Exact Jaccard self-join of word-shingle sets, as linked components.

Equal sets are one class. Classes that share one of the rarest shingles of both (the prefix of a
global order, common shingles last) are candidates, since sets with a similarity of 4/5 must.

Two relations between sets save work:
* Answers are derived from similar sets. Classes that agree in a pair of least hashes are checked
  against one leader of all that do. Those found similar share the leader's answer, its component,
  and are never paired with one another. Of the pairs that remain, each set is first checked
  against the set that shares most with it, and pairs that then are in one component are done.
* Index lists are skipped in blocks. A list whose classes are all of one component is left out
  whole; the others are read by blocks of set size. First the classes of a block are checked against
  one of them, the one with the fewest rarer shingles, which closes most blocks. In those that stay
  open a pair is made only if the shingle's positions in both sets leave room for the overlap that
  they need: similar sets pass this at the first shingle of both prefixes that they share.

What remains is bounded once more by all shingles that both prefixes share, and checked on the full
sets, which are computed again from the texts that are needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velolake.llm.common import mixed, text_chunks
from velolake.llm.graph import components
from velolake.llm.shingles import shingle_sets
from velolake.session import scratch_scope, stored

# 100 * overlap >= SIMILARITY * union.
SIMILARITY = 80
# The order puts so many of the most frequent shingles last; 8 bytes each go to every task. The
# order changes which shingles are compared first, never the result.
COMMON = 1 << 17
# A shingle counts as frequent where documents with so much text hold it at least so often.
TALLY_BYTES, LOCAL_REPEATS = 16 << 20, 4
# The hash range is cut in 2 * MARKS parts; a mark is a hash of the least hashes of two of them.
MARKS = 4
# Rounds that check one pair of each set before all pairs that are still open.
BEST_ROUNDS = 1
# Sets that are checked against one set at a time.
GROUP = 256
# A task sends sets to where they are compared in batches of about so many bytes.
SENT_BYTES = 16 << 20

_SETS = "doc_id long, code long, n int, key long, key2 long, odd int, marks array<long>, prefix array<long>"
_PARTS = np.arange(2 * MARKS, dtype=np.uint64) << np.uint64(65 - (2 * MARKS).bit_length())


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, code (hash of the text) and text."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("code"), text.alias("text"))


def common_shingles(texts: DataFrame, count: int = COMMON) -> np.ndarray:
    """The most frequent shingles, the rarest of them first, by their numbers of documents over all texts.

    Stretches of TALLY_BYTES that hold a shingle fewer than LOCAL_REPEATS times do not report it.
    """
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, size = [], 0
            for _, end, data, offsets in text_chunks(batch.column("text")):
                sets += shingle_sets(data, offsets)
                size += len(data)
                if size < TALLY_BYTES and end < batch.num_rows:
                    continue
                tokens = np.concatenate(sets)
                tokens.sort()
                edge = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])) if len(tokens) else np.empty(0, np.int64)
                n = np.diff(np.append(edge, len(tokens)))
                often = n >= LOCAL_REPEATS
                yield pa.RecordBatch.from_arrays([pa.array(tokens[edge[often]].view(np.int64)), pa.array(n[often])], names=["token", "n"])
                sets, size = [], 0

    counts = texts.select("text").mapInArrow(tally, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    counts = stored(counts.withColumn("step", F.floor(F.log2("n") * 16).cast("int")), "shingle-counts")
    # As many of the highest steps as hold at most `count` shingles; there are at most 1024 steps.
    held, least = 0, 1024
    for row in sorted(counts.groupBy("step").agg(F.count(F.lit(1)).alias("held")).collect(), reverse=True):
        held += row["held"]
        if held > count:
            break
        least = row["step"]
    top = counts.filter(F.col("step") >= least).select("token", "n").toPandas()
    return top.sort_values(["n", "token"])["token"].to_numpy(np.int64).view(np.uint64)


def prefix_length(n: int, similarity: int = SIMILARITY) -> int:
    """Shingles of a set of `n` of which a similar set has at least one, whichever order they are in."""
    return n - -(-similarity * n // 100) + 1 if n else 0


def least_marks(tokens: np.ndarray) -> np.ndarray:
    """MARKS numbers that similar sets of sorted hashes are likely to share some of."""
    at = np.searchsorted(tokens, _PARTS)
    least = np.append(tokens, np.uint64(0))[at]
    return mixed(least[::2] ^ mixed(least[1::2] + np.arange(MARKS, dtype=np.uint64))).view(np.int64)


def with_prefixes(texts: DataFrame, common: np.ndarray, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, code, n, key and key2 (hash of the set), odd (shingles that are not common), marks, prefix of every row, stored.

    marks and prefix are null for copies of an earlier set in the same batch of rows, and for empty sets.
    """
    order = np.argsort(common)
    ranked = common[order]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys, odd, marks, prefixes, seen = [], [], [], [], [], set()
            for _, _, data, offsets in text_chunks(batch.column("text")):
                for tokens in shingle_sets(data, offsets):
                    n.append(len(tokens))
                    key = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
                    keys.append(key)
                    odd.append(len(tokens))
                    if key in seen or not len(tokens):
                        marks.append(None)
                        prefixes.append(None)
                        continue
                    seen.add(key)
                    marks.append(least_marks(tokens))
                    if len(ranked):
                        at = np.minimum(np.searchsorted(ranked, tokens), len(ranked) - 1)
                        hit = ranked[at] == tokens
                        odd[-1] -= int(hit.sum())
                        if hit.any():
                            tokens = tokens[np.lexsort((tokens, np.where(hit, order[at] + 1, 0)))]
                    prefixes.append(tokens[:prefix_length(len(tokens), similarity)].view(np.int64))
            halves = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("code"), pa.array(n, pa.int32()), pa.array(halves[:, 0]),
                                              pa.array(halves[:, 1]), pa.array(odd, pa.int32()), pa.array(marks, pa.list_(pa.int64())), pa.array(prefixes, pa.list_(pa.int64()))], names=[x.split()[0] for x in _SETS.split(", ")])

    return stored(texts.mapInArrow(build, _SETS), "jaccard-sets")


def needed_overlap(a: Column, b: Column, similarity: int = SIMILARITY) -> Column:
    """Overlap from which sets of sizes a and b are similar."""
    return F.ceil((a + b) * similarity / F.lit(100 + similarity)).cast("long")


def with_block(lists: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """`lists` with the block of the set's size; similar sets are in the same or neighbouring blocks."""
    return lists.withColumn("block", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / similarity))).cast("long"))


def room(similarity: int = SIMILARITY) -> Column:
    """Whether the sets of a and b can be similar if the shingle is the first that their prefixes share."""
    return F.least(F.col("size_a") - F.col("i"), F.col("size_b") - F.col("j")) >= needed_overlap(F.col("size_a"), F.col("size_b"), similarity)


def reached_blocks(lists: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Entries as token, a, ca, size_a, i and each block that holds sets they can be similar to."""
    return with_block(lists, similarity).select("token", F.col("key").alias("a"), F.col("component").alias("ca"), F.col("n").alias("size_a"), F.col("position").alias("i"),
                                                F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)).alias("block"))


def list_leader_pairs(lists: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Pairs a < b: the classes of each list with the one of a block in which the list's shingle comes first."""
    order = F.struct("position", "key", "component", "n")
    leaders = with_block(lists, similarity).groupBy("token", "block").agg(F.min(order).alias("leader"))
    leaders = leaders.select("token", "block", F.col("leader.key").alias("b"), F.col("leader.component").alias("cb"), F.col("leader.n").alias("size_b"), F.col("leader.position").alias("j"))
    led = reached_blocks(lists, similarity).join(stored(leaders, "list-leaders").hint("shuffle_hash"), ["token", "block"]).filter((F.col("ca") != F.col("cb")) & room(similarity))
    return led.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def list_pairs(lists: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Pairs a < b of classes of different components that one list leaves possible."""
    right = with_block(lists, similarity).select("token", F.col("key").alias("b"), F.col("component").alias("cb"), F.col("n").alias("size_b"), F.col("position").alias("j"), "block")
    fits = (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & room(similarity)
    return reached_blocks(lists, similarity).join(right, ["token", "block"]).filter(fits).select("a", "b")


def open_lists(lists: DataFrame, known: DataFrame) -> DataFrame:
    """The lists (token, key, n, position) that hold several components, with the component of each entry; stored."""
    lists = lists.join(known, F.col("key") == F.col("node"), "left").withColumn("component", F.coalesce("component", "key")).drop("node")
    open_ = lists.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("token")
    return stored(lists.join(stored(open_, "open-tokens").hint("shuffle_hash"), "token", "left_semi"), "open-lists")


def likely_pairs(pairs: DataFrame, sets: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Those pairs (a, b) that can be similar by all shingles of their prefixes, with their number in common; stored."""
    pairs = stored(pairs.distinct(), "listed-pairs")
    asked = stored(pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).distinct(), "listed-keys").hint("shuffle_hash")
    prefixes = stored(sets.filter("prefix IS NOT NULL").select("key", "n", "prefix").join(asked, "key", "left_semi").dropDuplicates(["key"]), "listed-prefixes")
    left, right = (prefixes.select(F.col("key").alias(c), F.col("n").cast("long").alias(f"size_{c}"), F.col("prefix").alias(f"prefix_{c}")) for c in ("a", "b"))
    both = pairs.join(left, "a").join(right, "b").withColumn("shared", F.size(F.array_intersect("prefix_a", "prefix_b")).cast("long"))
    # Beyond the shared part of the prefix that ends first, at most the rest of that set overlaps.
    rest = F.greatest(*(F.ceil(F.col(c) * similarity / 100) for c in ("size_a", "size_b"))) - 1
    return stored(both.filter(F.col("shared") + rest >= needed_overlap(F.col("size_a"), F.col("size_b"), similarity)).select("a", "b", "shared"), "likely")


def check_pairs(texts: DataFrame, sets: DataFrame, pairs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Those pairs (a, b) of class keys whose sets are similar, by their full sets.

    The sets of a come to the set of b in groups of about GROUP, so that a set with many pairs is
    spread over tasks.
    """
    pairs = stored(pairs, "pairs")
    groups = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / F.lit(GROUP)).cast("long").alias("groups"))
    salted = pairs.join(groups, "b").select("a", "b", F.pmod(F.xxhash64("a"), "groups").alias("salt"))
    target = F.struct("b", "salt")
    wanted = (salted.select(F.col("a").alias("key"), target.alias("to"))
              .union(groups.select(F.col("b").alias("key"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("salt"), "b")
                     .select("key", target.alias("to"))))
    wanted = wanted.groupBy("key").agg(F.collect_set("to").alias("to"))
    # One text of each class.
    owners = sets.filter("prefix IS NOT NULL").groupBy("key").agg(F.min(F.struct("doc_id", "code")).alias("at"))
    wanted = stored(wanted.join(owners, "key").select("key", "to", "at.doc_id", "at.code"), "wanted").hint("shuffle_hash")
    found = texts.join(wanted.withColumnRenamed("doc_id", "_doc").withColumnRenamed("code", "_code"),
                       (F.col("code") == F.col("_code")) & F.col("doc_id").eqNullSafe(F.col("_doc")))

    def sent(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["key", "b", "salt", "tokens"])

    most = SENT_BYTES

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            keys, to, text = batch.column("key").to_pylist(), batch.column("to").to_pylist(), batch.column("text")
            for first, end, data, offsets in text_chunks(text):
                for i, tokens in zip(range(first, end), shingle_sets(data, offsets), strict=True):
                    half = int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()[:8], "little", signed=True)
                    if half != keys[i]:
                        continue
                    packed = tokens.tobytes()
                    for target in to[i]:
                        rows.append((keys[i], target["b"], target["salt"], packed))
                        size += len(packed) + 24
                        if size >= most:
                            yield sent(rows)
                            rows, size = [], 0
        if rows:
            yield sent(rows)

    def compare(group: tuple, rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        held = dict(zip(rows["key"], rows["tokens"], strict=True))
        whole = np.frombuffer(held[group[0]], np.uint64)
        similar = []
        for a in asked["a"]:
            tokens = np.frombuffer(held[a], np.uint64)
            overlap = len(np.intersect1d(tokens, whole, assume_unique=True))
            if 100 * overlap >= similarity * (len(tokens) + len(whole) - overlap):
                similar.append(a)
        return pd.DataFrame({"a": similar, "b": group[0]}, dtype="int64")

    shipped = found.select("key", "to", "text").mapInArrow(expand, "key long, b long, salt long, tokens binary")
    return stored(shipped.groupBy("b", "salt").cogroup(salted.groupBy("b", "salt")).applyInPandas(compare, "a long, b long"), "links")


def join_components(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id of every document row.

    A set holds the distinct runs of five words, A-Z as a-z, or all words of a shorter text. Rows
    are linked when 100 * overlap >= `similarity` * union; component_id is the smallest doc_id that
    links reach (null only where none has a doc_id). Null texts and texts without words have 0
    shingles and their own doc_id. Repeated rows have equal sets and are linked. Other columns are
    ignored; an empty table gives no rows.
    """
    with scratch_scope(docs.sparkSession) as keep:
        return keep(_join_components(_texts(docs), similarity))


def _join_components(texts: DataFrame, similarity: int) -> DataFrame:
    sets = with_prefixes(texts, common_shingles(texts), similarity)
    entries = sets.filter("prefix IS NOT NULL").select("key", "n", F.posexplode("prefix").alias("position", "token"))
    # A shuffled row of a list holds three numbers.
    entries = entries.select("token", "key", F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.col("position").cast("long")).alias("place"))
    # The leader of the classes that share a mark is the one with the fewest odd shingles: of edited copies, the least edited.
    marked = sets.filter("marks IS NOT NULL").select("key", "odd", F.posexplode("marks").alias("part", "mark"))
    leaders = marked.groupBy("part", "mark").agg(F.min(F.struct("odd", "key")).alias("leader"), F.min("key").alias("x"), F.max("key").alias("y"))
    leaders = leaders.filter("x < y").select("part", "mark", F.col("leader.key").alias("leader"))
    led = marked.join(leaders, ["part", "mark"]).filter("key <> leader").select(F.col("key").alias("a"), F.col("leader").alias("b")).distinct()
    links = check_pairs(texts, sets, led, similarity)
    # Lists of more than one class, then of more than one component.
    shared = entries.groupBy("token").agg(F.min("key").alias("x"), F.max("key").alias("y")).filter("x < y").select("token")
    shared = stored(shared, "shared").hint("shuffle_hash")  # stored, so that the join can split a hot list
    lists = stored(entries.join(shared, "token", "left_semi"), "lists").dropDuplicates(["token", "key"])
    lists = lists.select("token", "key", F.shiftright("place", 32).alias("n"), F.col("place").bitwiseAND(0xFFFFFFFF).alias("position"))
    lists = open_lists(lists, components(links))
    links = links.union(check_pairs(texts, sets, likely_pairs(list_leader_pairs(lists, similarity), sets, similarity).select("a", "b"), similarity))
    reached = components(links)
    lists = open_lists(lists.drop("component"), reached)
    open_pairs = likely_pairs(list_pairs(lists, similarity), sets, similarity)
    # First the pair of each set that shares most: its answer joins components, which closes the pairs within them.
    for turn in range(BEST_ROUNDS + 1):
        chosen = open_pairs.select("a", "b")
        if turn < BEST_ROUNDS:
            sides = open_pairs.select("a", "b", "shared").union(open_pairs.select("b", "a", "shared"))
            best = sides.groupBy("a").agg(F.max(F.struct("shared", "b")).alias("best"))
            chosen = best.select(F.least("a", "best.b").alias("a"), F.greatest("a", "best.b").alias("b")).distinct()
        chosen = stored(chosen, "chosen")
        links = links.union(check_pairs(texts, sets, chosen, similarity))
        reached = components(links)
        if turn < BEST_ROUNDS:
            left, right = (reached.select(F.col("node").alias(c), F.col("component").alias(f"{c}_in")) for c in ("a", "b"))
            still = open_pairs.join(chosen, ["a", "b"], "left_anti").join(left, "a", "left").join(right, "b", "left")
            open_pairs = stored(still.filter(F.coalesce("a_in", "a") != F.coalesce("b_in", "b")).select("a", "b", "shared"), "open-pairs")
    # A set without links is told by both halves of its hash.
    classes = sets.filter("n > 0").groupBy("key", "key2").agg(F.min("doc_id").alias("least"))
    classes = classes.join(reached, F.col("key") == F.col("node"), "left").select(
        "key", "key2", "least", F.coalesce("component", "key").alias("component"), F.when(F.col("node").isNull(), F.col("key2")).alias("alone"))
    smallest = classes.groupBy("component", "alone").agg(F.min("least").alias("component_id"))
    classes = (classes.alias("c").join(smallest.alias("s"), (F.col("c.component") == F.col("s.component")) & F.col("c.alone").eqNullSafe(F.col("s.alone")))
               .select("key", "key2", "component_id"))
    linked = sets.filter("n > 0").join(classes, ["key", "key2"]).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")
    empty = sets.filter("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(empty)


def first_of_components(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """The rows of `docs` with the smallest doc_id of their component; all columns stay, whatever their names.

    Of rows that share a doc_id, one stays. Rows without doc_id cannot be told apart and stay. Null
    and empty texts are linked with nothing; an empty table gives no rows.
    """
    with scratch_scope(docs.sparkSession) as keep:
        found = join_components(docs.select("doc_id", "text"), similarity)
        gone = stored(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct(), "gone").hint("shuffle_hash")
        rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("id"))
        kept = rows.join(gone, F.col("id") == F.col("gone"), "left_anti")
        again = stored(rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 AND id IS NOT NULL").select(F.col("id").alias("again")), "again").hint("shuffle_hash")
        once = kept.join(again, F.col("id") == F.col("again"), "left_anti")
        firsts = kept.join(again, F.col("id") == F.col("again"), "left_semi").dropDuplicates(["id"])
        return keep(once.unionByName(firsts).select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns)))

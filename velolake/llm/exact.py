"""Exact deduplication by radix tries that partitions of like length and content hash own.

Texts are equal when they are identical without white space. A first pass collapses the copies
within a batch of rows in tries of its own; each batch then sends one copy of a text, with its best
row and its count, to the owner of the text's length class and leading bits of its content hash. An
owner holds many texts: it inserts their full byte strings into one compressed radix trie, whose
terminal nodes keep the best row of all. Rows reach it in the order of their bytes, so whatever lies
left of the path of the last text is finished: when the edges pass HELD_BYTES, these subtrees are
given out whole, and only the path stays. The rows themselves wait in Spark's sort, which spills.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velolake.llm.common import bucket_bits
from velolake.session import stored

# Bytes on the edges of a trie, beyond which its finished subtrees are given out.
HELD_BYTES = 64 << 20

SPACE_BYTES = b" \t\n\x0b\x0c\r"

_LOCAL = "_row long, doc_id long, rep long, norm binary, length long, key long, chars long, best_id long, best_row long, n long"
_OWNED = "rep long, keep_id long, keep_row long, group_size long, text_sha256 string"


class Node:
    """A trie node: the bytes on the edge to it, its children by first byte, and a terminal's value."""

    __slots__ = ("children", "label", "value")

    def __init__(self, label: bytes = b"") -> None:
        self.label, self.children, self.value = label, {}, None


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix of `a` and of `b` from `start` on."""
    low, high = 0, min(len(a), len(b) - start)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[start + low:start + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def insert(root: Node, text: bytes) -> Node:
    """The terminal node of `text` below `root`, made if it is not there."""
    node, at = root, 0
    while at < len(text):
        child = node.children.get(text[at])
        if child is None:
            child = node.children[text[at]] = Node(text[at:])
            return child
        if text.startswith(child.label, at):
            node, at = child, at + len(child.label)
            continue
        shared = common_prefix(child.label, text, at)
        fork = node.children[text[at]] = Node(child.label[:shared])
        fork.children[child.label[shared]] = child
        child.label = child.label[shared:]
        node, at = fork, at + shared
    return node


def terminals(node: Node) -> Iterator[Node]:
    """The terminal nodes at and below `node`."""
    waiting = [node]
    while waiting:
        node = waiting.pop()
        if node.value is not None:
            yield node
        waiting.extend(node.children.values())


def spilled(root: Node, text: bytes) -> Iterator[Node]:
    """Cut off the subtrees beside the path of `text`; their terminal nodes."""
    node, at = root, 0
    while node.children:
        path = node.children.pop(text[at], None) if at < len(text) else None
        beside, node.children = node.children, {}
        for child in beside.values():
            yield from terminals(child)
        if path is None:
            return
        node.children[text[at]] = path
        node, at = path, at + len(path.label)


def better(row: tuple, best: tuple | None) -> bool:
    """Whether a row (code points, doc_id, row) is kept before `best`: longest, smallest doc_id, first row."""
    def rank(x: tuple) -> tuple:
        return (-x[0], x[1] is None, x[1] or 0, x[2])
    return best is None or rank(row) < rank(best)


def content_key(text: bytes) -> int:
    return int.from_bytes(hashlib.sha256(text).digest()[:8], "little", signed=True)


def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the row that stands for their text in the batch; that row carries the text."""
    schema = pa.schema([(n, pa.binary() if n == "norm" else pa.int64()) for n in (x.split()[0] for x in _LOCAL.split(", "))])
    row = TaskContext.get().partitionId() << 33
    for batch in batches:
        tries: dict[int, Node] = {}
        rows, first = [], {}
        texts = batch.column("text").cast(pa.large_binary())
        for doc_id, text, chars in zip(batch.column("doc_id").to_pylist(), texts, batch.column("chars").to_pylist(), strict=True):
            norm = (text.as_py() or b"").translate(None, SPACE_BYTES)
            key = (len(norm), content_key(norm))
            node = insert(tries.setdefault(len(norm).bit_length(), Node()), norm)
            mine = (chars, doc_id, row)
            if node.value is None:
                node.value = [row, mine, 0]
                first[row] = (norm, *key, node)
            node.value[2] += 1
            if better(mine, node.value[1]):
                node.value[1] = mine
            rows.append((row, doc_id, node.value[0]))
            row += 1
        out = []
        for number, doc_id, rep in rows:
            if number == rep:
                norm, length, key, node = first[number]
                out.append((number, doc_id, rep, norm, length, key, *node.value[1], node.value[2]))
            else:
                out.append((number, doc_id, rep, *[None] * 7))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)] if out
                                         else [pa.array([], t) for t in schema.types], schema=schema)


def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best row and the count of each text, for rows sorted by owner and text."""
    schema = pa.schema([("rep", pa.int64()), ("keep_id", pa.int64()), ("keep_row", pa.int64()), ("group_size", pa.int64()), ("text_sha256", pa.string())])

    def given(nodes: Iterator[Node]) -> Iterator[tuple]:
        for node in nodes:
            best, count, reps, sha = node.value
            for rep in reps:
                yield rep, best[1], best[2], count, sha

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    trie, owner, held, ready = Node(), None, 0, []
    for batch in batches:
        texts = batch.column("norm")
        columns = [batch.column(n).to_pylist() for n in ("owner", "rep", "chars", "best_id", "best_row", "n")]
        for text, its_owner, rep, chars, best_id, best_row, n in zip(texts, *columns, strict=True):
            if owner != its_owner:
                ready.extend(given(terminals(trie)))
                trie, owner, held = Node(), its_owner, 0
            norm, mine = text.as_py(), (chars, best_id, best_row)
            node = insert(trie, norm)
            if node.value is None:
                node.value = [mine, 0, [], hashlib.sha256(norm).hexdigest()]
                held += len(node.label)
            node.value[1] += n
            if better(mine, node.value[0]):
                node.value[0] = mine
            node.value[2].append(rep)
            if held > HELD_BYTES:
                ready.extend(given(spilled(trie, norm)))
                held = len(norm)
        while len(ready) >= 4096:
            yield batch_of(ready[:4096])
            ready = ready[4096:]
    ready.extend(given(terminals(trie)))
    if ready:
        yield batch_of(ready)


def dedup(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty, and all texts without other than white space are equal. Of equal
    texts the row with the most code points stays, then the smallest doc_id (null last); of rows
    that are alike in both, one. text_sha256 is of the text without white space. Other columns are
    ignored; an empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    rows = stored(texts.mapInArrow(collapse, _LOCAL), "exact-local")
    copies = rows.filter("n IS NOT NULL")
    bits = bucket_bits(copies.count())
    length_class = F.length(F.bin("length")).cast("long")
    owner = F.shiftleft(length_class, bits).bitwiseOR(F.pmod("key", F.lit(1 << bits)))
    copies = copies.select(owner.alias("owner"), "norm", "rep", "chars", "best_id", "best_row", "n")
    owned = copies.repartition("owner").sortWithinPartitions("owner", "norm").mapInArrow(own, _OWNED)
    return rows.select("_row", "doc_id", "rep").join(owned, "rep").select(
        "doc_id", "keep_id", "group_size", (F.col("_row") == F.col("keep_row")).alias("kept"), "text_sha256")


ORACLE = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (
  SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY norm) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""

"""Exact dedup against a dictionary of texts."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from velolake.llm import exact

SCHEMA = "doc_id long, text string"


def brute(rows):
    groups = defaultdict(list)
    for number, (doc_id, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, number))
    out = []
    for norm, members in groups.items():
        best = min(members)
        for m in members:
            out.append((None if m[1] else m[2], None if best[1] else best[2], len(members), m == best, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, schema=SCHEMA):
    return sorted((tuple(r) for r in exact.dedup(spark.createDataFrame(rows, schema)).collect()), key=str)


def test_copies(spark):
    pick = random.Random(4)
    texts = ["".join(pick.choice("ab é\n") for _ in range(pick.randint(0, 6))) for _ in range(60)] + ["x" * 5000, "x" * 4999 + "y"]
    rows = [(i, pick.choice(texts)) for i in range(400)]
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(3, None), (2, ""), (1, " \t"), (9, "a b"), (8, "ab"), (7, "a  b"), (6, "a b"), (None, "zz"), (5, "zz")]
    assert found(spark, rows) == brute(rows)
    again = found(spark, [(1, "q", 4, "k"), (1, "q", 4, "k"), (None, "q", 4, "k")], SCHEMA + ", keep_id int, norm string")
    assert sorted(r[3] for r in again) == [False, False, True] and {r[1:3] for r in again} == {(1, 3)}
    assert found(spark, []) == []


def test_trie_keeps_all_texts():
    pick = random.Random(5)
    texts = [bytes(pick.choice(b"ab") for _ in range(pick.randint(0, 10))) for _ in range(300)]
    root, nodes = exact.Node(), {}
    for text in texts:
        node = exact.insert(root, text)
        assert nodes.setdefault(text, node) is node
    assert len({id(n) for n in nodes.values()}) == len(set(texts))


def test_trie_shares_edges():
    root, shared = exact.Node(), b"terms of use, page "
    for number in range(100):
        exact.insert(root, shared + str(number).encode())
    assert [child.label for child in root.children.values()] == [shared]
    nodes, waiting = 0, [root]
    while waiting:
        node = waiting.pop()
        nodes += len(node.label)
        waiting.extend(node.children.values())
    assert nodes == len(shared) + 10 + 90


def test_an_owner_holds_many_texts(spark, monkeypatch):
    """All texts of a small table with one length class have few owners."""
    tries = []
    monkeypatch.setattr(exact, "terminals", lambda node, plain=exact.terminals: tries.append(node) or plain(node))
    texts = sorted({f"page {i:04d}".encode() for i in range(500)})
    owned(texts, [1] * len(texts))
    assert len([t for t in tries if t.children]) == 1


def owned(texts, owners):
    columns = {"owner": owners, "norm": texts, "rep": list(range(len(texts))), "chars": [len(t) for t in texts],
               "best_id": [1000 - i for i in range(len(texts))], "best_row": list(range(len(texts))), "n": [1] * len(texts)}
    rows = pa.RecordBatch.from_pydict(columns, schema=pa.schema([(n, pa.binary() if n == "norm" else pa.int64()) for n in columns]))
    batches = [rows.slice(i, 7) for i in range(0, rows.num_rows, 7)]
    return sorted(tuple(r.values()) for out in exact.own(iter(batches)) for r in out.to_pylist())


@pytest.mark.parametrize("held", [0, 1, 40, 90, 1 << 20])
def test_subtrees_are_spilled(monkeypatch, held):
    pick = random.Random(held)
    texts = [bytes(pick.choice(b"ab") for _ in range(pick.randint(0, 9))) for _ in range(400)]
    rows = sorted((len(t) > 5, t) for t in texts)
    owners, texts = [int(o) for o, _ in rows], [t for _, t in rows]
    cuts = []
    monkeypatch.setattr(exact, "HELD_BYTES", held)
    monkeypatch.setattr(exact, "spilled", lambda *path, plain=exact.spilled: cuts.append(path[1]) or plain(*path))
    last, counts = {t: i for i, t in enumerate(texts)}, Counter(texts)
    assert owned(texts, owners) == [(i, 1000 - last[t], last[t], counts[t], hashlib.sha256(t).hexdigest()) for i, t in enumerate(texts)]
    assert bool(cuts) == (held < 1 << 20)

"""Removal of repeated strings against a dictionary of all strings of 400 bytes."""

import hashlib
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from velolake.llm import suffixes

N = suffixes.LENGTH


def brute(rows):
    texts = [(t or "").encode() for _, t in rows]
    tally = Counter(t[i:i + N] for t in texts for i in range(len(t) - N + 1))
    out = []
    for (d, _), t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - N + 1):
            if tally[t[i:i + N]] > 1:
                gone[i:i + N] = b"\1" * N
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r))


def found(spark, rows, schema="doc_id long, text string"):
    rows = suffixes.dedup_strings(spark.createDataFrame(rows, schema)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r))


def passages(seed, texts):
    pick = random.Random(seed)
    letters = "abcdefghij é\n"
    parts = ["".join(pick.choice(letters) for _ in range(pick.choice([200, 399, 400, 401, 700, 1500]))) for _ in range(12)]
    rows = []
    for i in range(texts):
        text = ""
        for _ in range(pick.randint(0, 5)):
            part = pick.choice(parts) if pick.random() < 0.7 else "".join(pick.choice(letters) for _ in range(pick.randint(1, 900)))
            cut = pick.randint(0, 40) if pick.random() < 0.5 else 0
            text += part[cut:] + ("x" * pick.randint(0, 3))
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_passages(spark, seed):
    rows = passages(seed, 60)
    assert found(spark, rows) == brute(rows)


def test_split_prefixes(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT", 3)
    rows = passages(5, 40)
    assert found(spark, rows) == brute(rows)


def test_small_runs(spark, monkeypatch):
    rows = passages(6, 40)
    expected = brute(rows)
    monkeypatch.setattr(suffixes, "RUN_BYTES", 3000)
    assert found(spark, rows) == expected


def test_periodic_and_odd_texts(spark):
    rows = [(1, "ab" * 500), (2, "a" * 399), (3, "a" * 400), (4, "a" * 401), (5, None), (6, ""), (7, "Erti " * 100), (8, "x" + "Erti " * 100),
            (9, "abcdefg" * 80), (None, "q" * 500), (10, "unique" + "".join(map(chr, range(300, 700))))]
    assert found(spark, rows) == brute(rows)
    again = [(1, "".join(map(chr, range(300, 600))))] * 2 + [(2, "short")]
    out = found(spark, [(*r, 7, "z") for r in again], "doc_id long, text string, doc int, code string")
    assert out == brute(again)
    assert found(spark, []) == []


def test_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert found(spark, rows) == brute(rows)


def coded(strings):
    strings = sorted(strings)
    shared = [suffixes.common_prefix(a, b) for a, b in zip([b"", *strings], strings, strict=False)]
    return suffixes.Run(np.array(shared), np.array([len(s) - n for s, n in zip(strings, shared, strict=True)]), b"".join(s[n:] for s, n in zip(strings, shared, strict=True)))


@pytest.mark.parametrize("runs", [1, 2, 3, 7, 16])
def test_loser_tree(runs):
    pick = random.Random(runs)
    lists = [[bytes(pick.choice(b"ab") for _ in range(pick.randint(0, 12))) for _ in range(pick.randint(0, 30))] for _ in range(runs)]
    merged = [(text, shared) for _, _, text, shared in suffixes.merge_runs([coded(x) for x in lists])]
    texts = sorted(t for x in lists for t in x)
    assert [t for t, _ in merged] == texts
    assert [n for _, n in merged] == [suffixes.common_prefix(a, b) for a, b in zip([b"", *texts], texts, strict=False)]


def test_copies_give_few_spans(spark):
    """A bucket unites what overlaps in a document: copies do not give a row for every anchor in them."""
    pick = random.Random(12)
    text = "".join(pick.choice("abcdefgh ") for _ in range(20_000))
    docs = spark.createDataFrame([(i, text) for i in range(60)], "doc_id long, text string").coalesce(1)
    assert suffixes.removed(docs).count() < 60 * 30
    assert {(r.n_bytes, r.n_removed, r.n_spans) for r in suffixes.dedup_strings(docs).collect()} == {(20_000, 20_000, 1)}


def test_united_spans():
    rows = [(1, 7, 0, 400), (2, 7, 100, 500), (1, 7, 400, 900), (1, 7, 50, 450), (1, 8, 10, 410), (1, 7, 901, 1301), (2, 7, 600, 1000), (2, 7, 0, 2000)]
    spans = pd.DataFrame(rows, columns=["doc", "code", "first", "last"])
    assert suffixes.united(spans).values.tolist() == [[1, 7, 0, 900], [1, 7, 901, 1301], [1, 8, 10, 410], [2, 7, 0, 2000]]
    assert suffixes.united(spans.iloc[:0]).empty

"""Removal of passages of earlier documents against a dictionary of all windows."""

import random

import pytest

from velolake.llm import passages

N = passages.LENGTH


def brute(rows):
    owner = {}
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - N + 1):
            if d is not None:
                key = tuple(w[i:i + N])
                owner[key] = min(owner.get(key, d), d)
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - N + 1):
            if d is not None and owner[tuple(w[i:i + N])] < d:
                gone[i:i + N] = [True] * N
        spans, at = [], 0
        while at < len(w):
            end = at
            while end < len(w) and gone[end]:
                end += 1
            if end > at:
                spans.append((at, end))
            at = end + 1
        out.append((d, b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode(), len(w), sum(gone), spans))
    return sorted(out, key=str)


def found(spark, rows, schema="doc_id long, text string"):
    out = passages.dedup_passages(spark.createDataFrame(rows, schema)).collect()
    return sorted(((r.doc_id, r.text, r.n_words, r.n_removed, [tuple(s) for s in r.spans]) for r in out), key=str)


def texts(seed, count):
    pick = random.Random(seed)

    def words(n):
        return ["".join(pick.choice("abcdé") for _ in range(pick.randint(1, 3))) for _ in range(n)]

    parts = [words(pick.choice([30, 49, 50, 51, 80, 200])) for _ in range(10)]
    rows = []
    for i in range(count):
        text = []
        for _ in range(pick.randint(0, 5)):
            part = pick.choice(parts) if pick.random() < 0.7 else words(pick.randint(1, 90))
            text += part[pick.randint(0, 20) if pick.random() < 0.5 else 0:]
        rows.append((pick.randint(0, count), pick.choice([" ", "\n", " \t"]).join(text)) if i % 9 else (i, None))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_shared_passages(spark, seed):
    rows = texts(seed, 60)
    expected = brute(rows)
    assert sum(r[3] for r in expected) > 1000
    assert found(spark, rows) == expected


def test_cores_of_many_classes(spark, monkeypatch):
    monkeypatch.setattr(passages, "HOT", 2)
    rows = texts(4, 60)
    assert found(spark, rows) == brute(rows)


def test_one_passage_in_many_documents(spark):
    """More classes than HOT: the passage between words of each document's own."""
    pick = random.Random(9)
    passage = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([f"a{pick.random()}"] * 3 + passage[:pick.randint(48, 60)] + [f"b{i}"] * 3)) for i in range(120)]
    expected = brute(rows)
    assert sum(r[3] > 0 for r in expected) > 80
    assert found(spark, rows) == expected


def test_odd_rows(spark):
    same = " ".join(f"x{i}" for i in range(55))
    long = " ".join(f"y{i}" for i in range(30000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a b"), (5, same), (5, same), (6, same + " z"), (None, same), (None, same), (7, "q " * 300), (8, "q " * 200), (9, long), (10, "k " + long), (-3, same[3:])]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    more = spark.createDataFrame([(5, same, 1, "x", 2), (6, same, 1, "y", 3)], "doc_id long, text string, key long, whole string, spans int")
    assert sorted((r.doc_id, r.n_removed) for r in passages.dedup_passages(more).collect()) == [(5, 0), (6, 55)]

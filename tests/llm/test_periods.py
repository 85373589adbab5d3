"""Periodic runs against all periods of every text."""

import hashlib
import random
import zlib

import pytest

from velolake.llm import periods
from velolake.llm.common import table

FOLDER = "/root/testdata/sf0.001"


def brute_runs(w):
    out = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def brute(rows):
    out = []
    for d, t in rows:
        w = (t or "").encode().split()
        runs = brute_runs(w)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        out.append((d, len(w), runs, b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=str)


def found(spark, rows, schema="doc_id long, text string"):
    out = periods.periodic_runs(spark.createDataFrame(rows, schema)).collect()
    return sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.text) for r in out), key=str)


@pytest.mark.parametrize(("seed", "letters"), [(1, "ab"), (2, "abc"), (3, "abcdefgh")])
def test_few_words(spark, seed, letters):
    pick, rows = random.Random(seed), []
    for i in range(150):
        text = []
        while len(text) < 60:
            part = [pick.choice(letters) for _ in range(pick.randint(1, 12))]
            text += (part * pick.randint(1, 6))[:pick.randint(1, 80)]
        rows.append((i, " ".join(text[:pick.randint(0, 140)])))
    expected = brute(rows)
    assert sum(len(r[2]) for r in expected) > 100
    assert found(spark, rows) == expected


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a a a a a"), (5, "a\ta\na a  a a"), (6, "é é é é é é é b"), (7, "x y " * 3000), (8, "x y " * 3000), (8, "x y " * 3000), (None, "p q " * 4),
            (9, " ".join(map(str, range(20000)))), (10, " ".join(map(str, range(500))) + " " + " ".join(map(str, range(500))) * 1), (11, "a b a b a b a b c " * 5)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    more = spark.createDataFrame([(1, "a a a a a a", 5, "z", 1)], "doc_id long, text string, start int, runs string, period int")
    assert [tuple(x) for x in periods.periodic_runs(more).first().runs] == [(0, 6, 1)]


def test_planted_words_and_digests(spark):
    rows = [tuple(r) for r in table(spark, FOLDER, "documents").select("doc_id", "text").collect()] + [(None, "a b"), (10**12, None)]
    expected = []
    for d, t in rows:
        w = (t or "").encode().split()
        h = zlib.crc32(str(d).encode()) if d is not None else 1
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i if i < a else a + (i - a) % p] for i in range(len(w))]
        runs = brute_runs(w)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()
        expected.append((d, len(runs), s, n, q, 1000 * n // q if runs else None, hashlib.sha256(lines).hexdigest(),
                         hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()))
    df = periods.run_digests(periods.periodic_runs(periods.planted(spark.createDataFrame(rows, "doc_id long, text string"))))
    assert sorted(map(tuple, df.collect()), key=str) == sorted(expected, key=str)

"""Collocations against a count of all phrases."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from velolake.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, support=30, top=2000):
    counts, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            words[lang or "und"] += len(w)
            for n in range(1, 5):
                counts[lang or "und"].update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        rows = []
        for p, a in found.items():
            longer = [b for q, b in found.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= 80 * a for b in longer):
                continue
            score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, words[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def found(spark, rows, schema="lang string, text string", **options):
    return sorted(tuple(r) for r in collocations.collocations(spark.createDataFrame(rows, schema), **options).collect())


def texts(seed, count=120):
    pick, rows = random.Random(seed), []
    words = ["Da", "da", "é", "x-y", "zu", "ko", "\x1c", "mi'", "lo", "ra", "ne", " ", "ta", "vo"]
    phrases = [[pick.choice(words) for _ in range(pick.randint(2, 5))] for _ in range(8)]
    for _ in range(count):
        text = ""
        for _ in range(pick.randint(0, 25)):
            text += " ".join(pick.choice(phrases) if pick.random() < 0.6 else [pick.choice(words)]) + pick.choice([" ", "  ", "\t", ". ", ",", "\n", "!? ", "\x0b"])
        rows.append((pick.choice(["en", "en", "de", None]), text if pick.random() < 0.95 else None))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_all_phrases(spark, seed):
    rows = texts(seed)
    expected = brute(rows)
    assert len(expected) > 10
    assert found(spark, rows) == expected
    assert found(spark, rows, top=7) == brute(rows, top=7)


def test_small_chunks_and_filter(spark, monkeypatch):
    """Many chunks; a filter of so few bits that nearly everything passes."""
    rows = texts(3)
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 300)
    monkeypatch.setattr(collocations, "FILTER_BITS", 8)
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [("en", None), (None, ""), ("de", " \n.,")]) == []
    rows = [("en", "a b " * 20000), ("en", "A.B " * 40), (None, "c d;" * 29), (None, "c\td")] * 2
    assert found(spark, rows) == brute(rows)
    more = [(*r, "k", 3, 4) for r in rows]
    assert found(spark, more, "lang string, text string, phrase string, n int, key long") == brute(rows)


def test_cuts_whose_products_pass_64_bits(spark):
    counts = spark.createDataFrame([(10**13, 3 * 10**13, 10**13)], "a long, l long, r long")
    assert counts.selectExpr("cast((cast(2000000 AS decimal(10,0)) * cast(a AS decimal(19,0))) div (cast(l AS decimal(19,0)) + cast(r AS decimal(19,0))) AS long) AS s").first().s == 500000


def test_filter_holds_what_it_was_given(spark):
    keys = np.random.default_rng(1).integers(-2**63, 2**63, 5000)
    bits = collocations.sent_filter(spark.createDataFrame([(int(k),) for k in keys], "key long")).value
    assert collocations.passing(bits, keys.view(np.uint64)).all()
    others = np.random.default_rng(2).integers(-2**63, 2**63, 5000)
    assert collocations.passing(bits, others.view(np.uint64)).mean() < 0.01


def test_a_task_holds_one_chunk():
    """Counts are passed on chunk by chunk; what a task holds does not grow with its texts."""
    pick, read = random.Random(4), []
    every = np.full(1 << 10, ~np.uint64(0))

    def batches(count):
        for i in range(count):
            read.append(i)
            yield pa.RecordBatch.from_pydict({"lang": ["en", "de"] * 50, "text": [b"Ab " + b" ".join(b"%x" % pick.getrandbits(40) for _ in range(100)) for _ in range(100)]})

    def most(count):
        tracemalloc.start()
        rows = sum(part.num_rows for part in collocations.phrase_counts(batches(count), every, 50_000))
        assert rows > 30_000 * count
        held = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return held

    next(collocations.phrase_counts(batches(20), every, 50_000))
    assert len(read) == 1
    most(1)
    assert most(30) < 1.5 * most(3)


def test_phrases_that_share_a_key(monkeypatch):
    """Keys of few bits: other phrases with the same key are counted by themselves."""
    rows, keys = texts(5), collocations.Words.keys

    def few(self, size):
        all_keys, inside = keys(self, size)
        return all_keys % np.uint64(7), inside

    monkeypatch.setattr(collocations.Words, "keys", few)
    batch = pa.RecordBatch.from_pydict({"lang": [r[0] or "und" for r in rows], "text": [(r[1] or "").encode() for r in rows]})
    every, counts = np.full(1 << 10, ~np.uint64(0)), Counter()
    for part in collocations.phrase_counts(iter([batch]), every, 500):
        for row in part.to_pylist():
            counts[row["lang"], row["size"], row["phrase"].decode()] += row["n"]
    expected = Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            expected[lang or "und", 0, ""] += len(w)
            for n in range(1, 5):
                expected.update((lang or "und", n, " ".join(w[i:i + n])) for i in range(len(w) - n + 1))
    assert +counts == +expected

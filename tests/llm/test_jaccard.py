"""The n-gram Jaccard join against a plain search over all pairs with a common shingle."""

import random
import re
from collections import defaultdict

import pytest

from velolake.llm import jaccard
from velolake.llm.graph import components

SCHEMA = "doc_id long, text string"


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def roots(edges, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def brute(rows):
    sets = {d: shingles(t) for d, t in rows}
    index = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            index[x].append(d)
    common = defaultdict(int)
    for docs in index.values():
        for i, a in enumerate(docs):
            for b in docs[:i]:
                common[a, b] += 1
    edges = [(a, b) for (a, b), o in common.items() if 100 * o >= 80 * (len(sets[a]) + len(sets[b]) - o)]
    root = roots(edges, sets)
    return {(d, len(s), root[d]) for d, s in sets.items()}


def joined(spark, rows, schema=SCHEMA):
    return sorted(tuple(r) for r in jaccard.join_components(spark.createDataFrame(rows, schema)).select("doc_id", "n_shingles", "component_id").collect())


def test_edited_copies(spark):
    pick = random.Random(7)
    words = [f"w{i}" for i in range(3000)]
    rows, shared = [], [pick.choice(words) for _ in range(40)]
    for base in range(30):
        text = [pick.choice(words) for _ in range(pick.choice([3, 20, 60, 200]))]
        if base % 3 == 0:
            text += shared
        for _ in range(pick.choice([1, 2, 12])):
            copy = list(text)
            for _ in range(pick.randrange(4)):
                copy[pick.randrange(len(copy))] = pick.choice(words)
            if pick.random() < 0.3:
                copy = copy[:int(len(copy) * pick.uniform(0.75, 1))]
            rows.append((len(rows) * 7 % 1009, " ".join(copy).title() if pick.random() < 0.2 else " \n".join(copy)))
    pick.shuffle(rows)
    assert joined(spark, rows) == sorted(brute(rows))


def test_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert joined(spark, rows) == sorted(brute(rows))


def test_threshold_is_exact(spark):
    # 45 and 36 of 45 shingles: 4/5; one less is below
    words = [f"v{i}" for i in range(49)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:40])), (3, " ".join(words[:39] + ["x"]))]
    assert joined(spark, rows) == sorted(brute(rows))
    assert {r[0]: r[2] for r in joined(spark, rows)}[2] == 1


def test_odd_rows(spark):
    rows = [(5, None), (4, ""), (3, " \t\n"), (9, "one two"), (8, "ONE  two\n"), (7, "one two three"), (None, "one two"), (6, "a b c d e"),
            (6, "a b c d e"), (2, "É a b c d"), (1, "é a b c d")]
    found = joined(spark, [(*r, "x", 1) for r in rows if r[0] is not None], "doc_id long, text string, key string, n int")
    assert found == [(1, 1, 1), (2, 1, 2), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6), (6, 1, 6), (7, 1, 7), (8, 1, 8), (9, 1, 8)]
    alone = jaccard.join_components(spark.createDataFrame([(None, "q r s"), (None, "q r s")], SCHEMA)).collect()
    assert [tuple(r) for r in alone] == [(None, 1, None), (None, 1, None)]
    assert joined(spark, []) == []


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(3, 3)], [(i, i + 1) for i in range(40)], [(5, 1), (9, 5), (9, 2), (20, 30)]])
def test_components(spark, edges):
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert found == roots([e for e in edges if e[0] != e[1]], nodes)

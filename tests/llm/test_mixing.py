"""The mix against its definition on small tables."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from velolake.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def targets(sizes):
    """Water filling: source -> target."""
    names = sorted((s for s in sizes if s is not None), key=str) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        if not free:
            return capped
        level = (total - sum(capped.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not over:
            return capped | {s: level * weight[s] for s in free}
        capped |= {s: 3 * sizes[s] for s in over}


def check(spark, rows, schema=SCHEMA):
    out = mixing.mixed_totals(spark.createDataFrame(rows, schema)).collect()
    sizes = defaultdict(int)
    for _, text, source, *_ in rows:
        sizes[source] += len((text or "").split())
    expected = targets(sizes)
    assert sorted((r.doc_id or -1, r.size) for r in out) == sorted((d or -1, len((t or "").split())) for d, t, *_ in rows)
    taken = defaultdict(int)
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - expected[r.source]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - expected[s]) <= 1 for s in sizes)
    return sorted((r.doc_id or -1, r.size, r.taken) for r in out)


def test_random_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 16)
    pick = random.Random(1)
    rows = [(i, "w " * pick.choice([0, 1, 3, 40, 300]), pick.choice(["a", "a", "a", "b", "é", "Z", None])) for i in range(200)]
    rows += [(1000, "x " * 2, "tiny"), (1001, None, "none"), (1002, "", "none")]
    first = check(spark, rows)
    pick.shuffle(rows)
    assert check(spark, rows) == first  # neither order nor partitions matter


def test_odd_tables(spark):
    assert check(spark, []) == []
    check(spark, [(1, None, "a"), (2, " \n", None)])
    check(spark, [(1, "one two", "a")])
    check(spark, [(1, "a b c", "x"), (1, "a b c", "x"), (None, "a b", "y")])
    check(spark, [(1, "a b c", "x", 9, "q"), (2, "d", "y", 8, "r")], SCHEMA + ", size long, target string")


def test_schedule_is_even(spark):
    """Every stretch of the schedule holds the sources in nearly their shares."""
    rows = [(i, "w " * 50, "abc"[i % 3]) for i in range(300)]
    sized = mixing.sized_documents(spark.createDataFrame(rows, SCHEMA))
    slots = mixing.slot_schedule(mixing.source_targets(sized), 10).orderBy("turn").select("source_no", "rank").collect()
    seen = defaultdict(int)
    for n, slot in enumerate(slots, 1):
        assert slot["rank"] == seen[slot.source_no]
        seen[slot.source_no] += 1
        if n % 50 == 0:
            assert all(abs(seen[s] - n * (s + 1) / 6) < 8 for s in range(3))


def test_documents_of_the_mix(spark):
    docs = spark.createDataFrame([(i, f"a{i}  b\n c d", "xy"[i % 2], 12) for i in range(10)], SCHEMA + ", n_chars int")
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    words = out.groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), r"\s+"))).alias("n")).collect()
    assert {r.source: r.n for r in words} == {"x": 13, "y": 27}
    whole = {r.doc_id: r.text for r in docs.collect()}
    for r in out.collect():
        assert whole[r.doc_id].startswith(r.text) and r.n_chars == (12 if r.text == whole[r.doc_id] else len(r.text))

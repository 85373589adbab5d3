"""Packing: tokens, pieces, places and bounds."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from velolake.llm import packing

SCHEMA = "doc_id long, text string"


def expected_pieces(rows):
    tokenizer, out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            out.append((doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return sorted(out, key=str)


def check(spark, rows, schema=SCHEMA):
    out = packing.pack_documents(spark.createDataFrame(rows, schema)).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=str) == expected_pieces([r[:2] for r in rows])
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    return len(sequences), sum(r.length for r in out)


def test_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    count, tokens = check(spark, rows)
    assert count <= -(-tokens // 1024) + 1


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a"), (3, "x <|endoftext|> y"), (4, "déjà vu ✓ \n\n  " * 700), (5, "it's 'll   "), (6, "a" * 3000)]
    check(spark, rows)
    check(spark, [(1, "hello", 3, 4)], SCHEMA + ", piece int, offset int")
    assert check(spark, []) == (0, 0)


@pytest.mark.parametrize("lengths", [[1023] * 5, [512] * 7, [513] * 7, [341] * 6 + [342] * 6, [600, 400, 424, 24, 1000] * 9])
def test_bound_and_packing(lengths):
    pieces = np.array(lengths)
    bins, offsets = packing.best_fit_decreasing(pieces)
    sums = np.bincount(bins, pieces)
    assert sums.max() <= 1024 and len(set(zip(bins, offsets, strict=True))) == len(pieces)
    bound = packing.lower_bound(*np.unique(pieces, return_counts=True))
    assert bound <= bins.max() + 1
    if len(set(lengths)) == 1:
        assert bound == bins.max() + 1 == -(-len(lengths) // (1024 // lengths[0]))


def test_bound_is_never_too_high():
    pick = random.Random(6)
    for _ in range(200):
        full = []
        for _ in range(pick.randint(1, 6)):  # cut full sequences: their number is a packing
            left = 1024
            while left:
                part = min(left, pick.randint(1, 700))
                full.append(part)
                left -= part
        assert packing.lower_bound(*np.unique(full, return_counts=True)) == sum(full) // 1024
        some = [x for x in full if pick.random() < 0.8]
        assert packing.lower_bound(*np.unique(some, return_counts=True)) <= sum(full) // 1024


def test_a_partition_is_certified_by_the_function_of_all_pieces():
    bound, weights, denominator = packing.best_function(np.array([512, 300]), np.array([6, 4]))
    assert bound == packing.lower_bound(np.array([512, 300]), np.array([6, 4]))
    for lengths, certified in (([512] * 6, True), ([512] * 5, True), ([600, 600, 200], True), ([400, 400, 400, 700, 100], False)):
        frame = pd.DataFrame({"piece_id": range(len(lengths)), "length": lengths, "round": 0, "part": 0, "bin": 0, "offset": 0})
        _, table, below = packing.best_function(*np.unique(lengths if certified else [512], return_counts=True))
        out = packing._packer(0, 1024, table, below)((3,), frame)
        assert out["certified"].tolist() == [certified] * len(lengths)


def test_certified_partitions_settle_and_gaps_exchange(spark, monkeypatch):
    """Rounds that follow one with gaps deal the pieces of partitions with gaps only, until none is left."""
    pick = random.Random(5)
    lengths = [pick.randint(1, 1024) for _ in range(1500)]
    pieces = spark.createDataFrame(list(enumerate(lengths)), "piece_id long, length long")
    rounds = []
    keep = packing.stored

    def noted(df, name):
        rounds.append(keep(df, name))
        return rounds[-1]

    monkeypatch.setattr(packing, "stored", noted)
    packing.pack(pieces, partition_pieces=100)
    first, second = (df.toPandas() for df in rounds[:2])
    assert 0 < first["certified"].sum() < len(first)
    exchanged = first[(first["room"] > 0) & ~first["certified"]]
    assert set(second["piece_id"]) == set(exchanged["piece_id"])


def test_certificates_do_not_cost_sequences(spark):
    """Every partition of halves meets its bound, odd ones with half a sequence to spare: those are paired in the end."""
    pieces = spark.range(2000).select(F.col("id").alias("piece_id"), F.lit(512).cast("long").alias("length"))
    assert packing.pack(pieces, partition_pieces=50).select("sequence_id").distinct().count() == 1000


def test_partitions_exchange(spark):
    """Small partitions waste room; exchanging what is in sequences with room saves sequences."""
    pick = random.Random(8)
    lengths = [pick.randint(1, 1024) for _ in range(2000)]
    pieces = spark.createDataFrame(list(enumerate(lengths)), "piece_id long, length long")
    packed = packing.pack(pieces, partition_pieces=50).join(pieces, "piece_id")
    assert packed.count() == 2000 and packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("e"), F.count_distinct("offset").alias("d"),
                                             F.count("offset").alias("c")).filter("n <> e OR d <> c").count() == 0
    at_once = packing.best_fit_decreasing(np.array(lengths))[0].max() + 1
    apart = sum(packing.best_fit_decreasing(np.array(lengths[i:i + 50]))[0].max() + 1 for i in range(0, 2000, 50))
    assert packed.select("sequence_id").distinct().count() <= min(apart - 20, at_once * 1.03)

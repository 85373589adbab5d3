"""The quality classifier: accuracy on rows that it did not learn from, and its parts."""

import zlib

import numpy as np

from velolake.llm import quality

FOLDER = "/root/testdata/sf0.01"


def tables(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


def test_held_out_accuracy(spark):
    docs, labels = tables(spark)
    rows = quality.classify(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert len(unseen) > 50 and sum(r.predicted == r.quality for r in unseen) / len(unseen) >= 0.95
    good, bad = ([r.score for r in unseen if r.quality == q] for q in (1, 0))
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) >= 0.98


def test_held_out_labels_do_not_matter(spark):
    docs, labels = tables(spark)
    held = quality.held_out(labels["doc_id"])
    flipped = labels.withColumn("quality", quality.F.when(held, 1 - labels["quality"]).otherwise(labels["quality"]))
    one, other = ({r.doc_id: r.score for r in quality.classify(docs, x).collect()} for x in (labels, flipped))
    assert one == other


def test_interaction_is_learned():
    x = np.random.default_rng(1).random((4000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert ((model.scores(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 6), (2, " \n", 6), (None, "a b", 7), (3, "word " * 30000, 8)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (3, None, 0), (77, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    for marks in (labels, labels.limit(0), labels.filter("quality = 1")):
        out = quality.classify(docs, marks).collect()
        assert len(out) == 5 and all(0 <= r.score <= 1 and r.predicted in (0, 1) and r.held_out is not None for r in out)
    assert quality.classify(docs.limit(0), labels).count() == 0
    assert quality.accepted(docs, labels.filter("quality = 1")).columns == docs.columns


def test_trees():
    assert np.allclose(quality.shallow_tree(np.array([10.0, 10, -10, -10]), np.ones(4) * 1e3), [20 / 2005] * 2 + [-20 / 2005] * 2)
    gain, values = quality.pair_tree(np.array([[9.0, -9], [-9, 9]]), np.ones((2, 2)))
    assert gain > 0 and values[0, 0] > 0 > values[0, 1]

"""The language field: exact probabilities, accuracy on rows that it did not learn from, code-switched text."""

import itertools
import zlib

import numpy as np

from velolake.llm import langid
from velolake.llm.common import text_chunks

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert len(unseen) > 200 and sum(r.lang_pred == r.lang for r in unseen) / len(unseen) >= 0.98


def test_code_switched_text(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("lang IN ('de', 'es')").orderBy("doc_id").collect()
    model = langid.fit([r.text.lower() for r in docs[:120]], [r.lang for r in docs[:120]])
    parts = [next(r.text.lower() for r in docs[120:] if r.lang == lang and len(r.text) > 600)[:500].encode() for lang in ("de", "es")]
    data = np.frombuffer(b" ".join(parts), np.uint8)
    words = langid.words_of(data, np.array([0, len(data)]))
    split = len(langid.words_of(np.frombuffer(parts[0], np.uint8), np.array([0, len(parts[0])])))
    best = model.word_probabilities(words).argmax(1)
    assert (best[:split] == 0).mean() > 0.9 and (best[split:] == 1).mean() > 0.9


def test_forward_backward_is_exact():
    random = np.random.default_rng(4)
    scores, transition = random.normal(size=(9, 3)), random.normal(size=(3, 3))
    chain = np.array([0] * 6 + [1] * 1 + [2] * 2)
    found, moved = langid.marginals(scores, transition, chain, expected=True)
    expected, pairs = np.zeros((9, 3)), np.zeros((3, 3))
    for number in range(3):
        at = np.flatnonzero(chain == number)
        total, part, moves = 0.0, np.zeros((len(at), 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=len(at) + 1):  # the state before the chain comes first
            weight = np.exp(sum(scores[i, s] for i, s in zip(at, path[1:], strict=True)) + sum(transition[a, b] for a, b in itertools.pairwise(path)))
            total += weight
            for t, s in enumerate(path[1:]):
                part[t, s] += weight
            for a, b in itertools.pairwise(path):
                moves[a, b] += weight
        expected[at] = part / total
        pairs += moves / total
    assert np.allclose(found, expected) and np.allclose(moved, pairs)


def test_runs_make_no_difference(monkeypatch):
    random = np.random.default_rng(5)
    scores, transition, chain = random.normal(size=(700, 4)), random.normal(size=(4, 4)), np.repeat([0, 1, 2], [500, 1, 199])
    one = langid.marginals(scores, transition, chain)[0]
    monkeypatch.setattr(langid, "RUN", 7)
    assert np.allclose(one, langid.marginals(scores, transition, chain)[0])


def test_words():
    texts = ["ab, cd", "", "é3x", "9 !", "q"]
    import pyarrow as pa
    (_, _, data, offsets), = text_chunks(pa.array(texts))
    words = langid.words_of(data, offsets)
    assert words.text.tolist() == [0, 0, 2, 2, 4]
    again = langid.words_of(np.frombuffer(b"cd ab", np.uint8), np.array([0, 5]))
    assert again.code.tolist() == words.code[[1, 0]].tolist() and again.suffix.tolist() == words.suffix[[1, 0]].tolist()


def test_odd_tables(spark):
    schema = "doc_id long, text string, lang string, lang_pred string"
    docs = spark.createDataFrame([(1, "le la les", "fr", "x"), (4, "der die das", "de", "x"), (9, None, "fr", "x"), (10, "", None, "x"), (11, "1234 !?", "fr", "x"),
                                  (None, "die der", None, "x"), (1, "le la les", "fr", "x"), (12, "das die " * 40000, None, "x"), (13, "中文", "zh", "x")], schema)
    out = langid.identify(docs).collect()
    assert len(out) == 9 and {r.lang_pred for r in out if r.doc_id in (9, 10, 11)} == {"und"}
    assert all(r.lang_pred in ("fr", "de", "zh") for r in out if r.doc_id not in (9, 10, 11))
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", langid.F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.identify(docs.limit(0)).count() == 0

"""Quality classifier: a generalised additive model with pairwise interactions.

Text statistics are binned; cyclic boosting fits one shallow tree per feature and round on the
histogram of the residuals and adds it to the feature's lookup table, then does the same for the
pairs of features with the largest gain. A score is the sum of table entries through a sigmoid.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velolake.session import stored

# At most so many labelled rows are fitted: those with the smallest hash of their doc_id.
TRAINING_ROWS = 20_000
ACCEPTED = 0.7
BINS, PAIR_BINS, PAIRS = 48, 12, 6
ROUNDS, PAIR_ROUNDS, RATE, STIFFNESS = 120, 60, 0.15, 5.0

FEATURES = ("log_words", "word_bytes", "upper", "digits", "symbols", "stops", "distinct_words", "repeated_neighbours", "top_word",
            "line_words", "distinct_lines", "top_line", "compressed", "other_bytes", "bars", "commonest_symbol", "mean_run", "symbol_words")

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[44, 46]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[33:127] = True
_SYMBOL &= ~(_LETTER | _DIGIT | _STOP)


def text_features(text: bytes) -> list[float]:
    """The statistics of a whole text, in the order of FEATURES; all 0 without words."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    count, size = len(words), len(text)
    kinds = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    letters, symbols = int(kinds[_LETTER].sum()), int(kinds[_SYMBOL].sum())
    tally = Counter(words)
    neighbours = sum(map(eq, words, words[1:]))
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeats = Counter(lines)
    symbol_ends = sum(n for word, n in tally.items() if _SYMBOL[word[-1]])
    return [np.log1p(count), sum(map(len, words)) / count, kinds[_UPPER].sum() / max(letters, 1), kinds[_DIGIT].sum() / size,
            symbols / size, kinds[_STOP].sum() / count, len(tally) / count, neighbours / count, max(tally.values()) / count,
            count / len(lines), len(repeats) / len(lines), max(repeats.values()) / len(lines), len(zlib.compress(text, 1)) / size,
            kinds[128:].sum() / size, kinds[124] / count, kinds[_SYMBOL].max() / max(symbols, 1), count / max(count - neighbours, 1),
            symbol_ends / count]


def best_cut(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a histogram in two."""
    g, h = gradient.cumsum(), weight.cumsum()
    if len(g) < 2:
        return 0.0, 0
    left, right = g[:-1] ** 2 / (h[:-1] + STIFFNESS), (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + STIFFNESS)
    gains = left + right - g[-1] ** 2 / (h[-1] + STIFFNESS)
    at = int(gains.argmax())
    return float(gains[at]), at + 1


def shallow_tree(gradient: np.ndarray, weight: np.ndarray, leaves: int = 3) -> np.ndarray:
    """A step function over the bins with up to `leaves` steps, as one value per bin."""
    parts = [(0, len(gradient))]
    while len(parts) < leaves:
        cuts = [(*best_cut(gradient[a:b], weight[a:b]), a, b) for a, b in parts]
        gain, at, a, b = max(cuts)
        if gain <= 1e-9:
            break
        parts.remove((a, b))
        parts += [(a, a + at), (a + at, b)]
    out = np.zeros(len(gradient))
    for a, b in parts:
        out[a:b] = gradient[a:b].sum() / (weight[a:b].sum() + STIFFNESS)
    return out


def pair_tree(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree that cuts one feature of a pair, then the other on each side."""
    best, values = 0.0, np.zeros_like(gradient)
    whole = gradient.sum() ** 2 / (weight.sum() + STIFFNESS)
    for flip in (False, True):
        g, h = (gradient.T, weight.T) if flip else (gradient, weight)
        _, at = best_cut(g.sum(1), h.sum(1))
        if not at:
            continue
        out, gain = np.zeros_like(g), -whole
        for rows in (slice(None, at), slice(at, None)):
            _, cut = best_cut(g[rows].sum(0), h[rows].sum(0))
            for columns in ((slice(None, cut), slice(cut, None)) if cut else (slice(None),)):
                a, b = g[rows, columns].sum(), h[rows, columns].sum() + STIFFNESS
                out[rows, columns] = a / b
                gain += a * a / b
        if gain > best:
            best, values = gain, out.T if flip else out
    return best, values


@dataclass
class AdditiveModel:
    """Bin edges and lookup tables of the features and of pairs of them."""

    start: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for j, (edges, entries) in enumerate(zip(self.edges, self.tables, strict=True)):
            out += entries[np.searchsorted(edges, x[:, j], side="right")]
        for a, b, at_a, at_b, entries in self.pairs:
            out += entries[np.searchsorted(at_a, x[:, a], side="right"), np.searchsorted(at_b, x[:, b], side="right")]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """The model of labels `y` (0, 1). Without rows all scores are 0.5; with one label, near that label."""
    if not len(y):
        return AdditiveModel()
    rate = (y.sum() + 0.5) / (len(y) + 1)
    model = AdditiveModel(float(np.log(rate / (1 - rate))))
    if y.min() == y.max():
        return model
    raw = np.full(len(y), model.start)
    model.edges = [_edges(x[:, j], BINS) for j in range(x.shape[1])]
    binned = [np.searchsorted(edges, x[:, j], side="right") for j, edges in enumerate(model.edges)]
    model.tables = [np.zeros(len(edges) + 1) for edges in model.edges]
    for _ in range(ROUNDS):
        for at, entries in zip(binned, model.tables, strict=True):
            p = 1 / (1 + np.exp(-raw))
            step = RATE * shallow_tree(np.bincount(at, y - p, len(entries)), np.bincount(at, p * (1 - p), len(entries)))
            entries += step
            raw += step[at]
    coarse = [_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    cells = [np.searchsorted(edges, x[:, j], side="right") for j, edges in enumerate(coarse)]

    def histograms(a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        cell, p = cells[a] * shape[1] + cells[b], 1 / (1 + np.exp(-raw))
        return cell, *(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (y - p, p * (1 - p)))

    gains = [(pair_tree(*histograms(a, b)[1:])[0], a, b) for a in range(x.shape[1]) for b in range(a)]
    for _, a, b in sorted(gains, reverse=True)[:PAIRS]:
        model.pairs.append((a, b, coarse[a], coarse[b], np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1))))
    for _ in range(PAIR_ROUNDS):
        for a, b, _, _, entries in model.pairs:
            cell, g, h = histograms(a, b)
            step = RATE * pair_tree(g, h)[1]
            entries += step
            raw += step.ravel()[cell]
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the doc_id as text leaves 2 modulo 4. A null doc_id is not."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def with_features(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, features of every document and the columns after text, stored."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_features(t.as_py() or b"") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "features"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return stored(texts.mapInArrow(measure, "doc_id long, features array<double>"), "quality-features")


def train(features: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> AdditiveModel:
    """The model of `labels.quality`, from at most `rows` rows that are not held out; null labels do not count."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") >= 1).cast("int").alias("quality"))
    marked = marked.filter(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    known = features.join(marked, "doc_id").withColumn("order", F.xxhash64("doc_id"))
    count = known.count()
    # Only the rows of the lowest hashes, twice as many as needed, are ordered.
    low = known.filter(F.col("order") <= int(-(2**63) + 2**64 * min(1.0, 2 * rows / max(count, 1))) - 1) if count > 2 * rows else known
    sample = low.orderBy("order", "doc_id", "quality", "features").limit(rows).select("features", "quality").collect()
    x = np.array([r["features"] for r in sample]).reshape(len(sample), len(FEATURES))
    return fit(x, np.array([r["quality"] for r in sample], float))


def score(features: DataFrame, model: AdditiveModel) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of `features`."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("features").flatten().to_numpy().reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(x))], names=["doc_id", "score"])

    scored = features.select("doc_id", "features").mapInArrow(add, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= ACCEPTED).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1: accepted) of every document row.

    Only the text is scored. Null and empty texts have all features 0. Rows of documents and of
    labels may repeat and count as often. Other columns are ignored; an empty table gives no rows.
    """
    features = with_features(docs)
    return score(features, train(features, labels))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that the classifier accepts; all columns stay, whatever their names.

    Null and empty texts have all features 0 and are judged by them. Repeated rows are judged alike;
    an empty table gives no rows.
    """
    texts = docs.select("doc_id", "text")
    model = train(with_features(texts.join(labels.select(F.col("doc_id").alias("_labelled")).distinct(), F.col("doc_id") == F.col("_labelled"), "left_semi")), labels)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string()).cast(pa.large_binary())
            x = np.array([text_features(t.as_py() or b"") for t in texts]).reshape(batch.num_rows, len(FEATURES))
            yield batch.filter(pa.array(model.scores(x) >= ACCEPTED))

    return docs.mapInArrow(keep, docs.schema)

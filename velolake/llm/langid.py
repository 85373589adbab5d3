"""Language identification by a linear-chain conditional random field over words.

A word's score for a language sums weights of its byte trigrams (with word ends), of its prefix
and suffix, and of itself if it is in the lexicon of the training texts. Learned transitions link
neighbouring words, and forward-backward gives each word its language probabilities. A text's
language is the one with the largest mean probability over its words.

Forward-backward is exact over whole texts of any length: runs of words become small transfer
matrices, messages pass from run to run, then through the words of all runs at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velolake.llm.common import BYTE_CODES, mixed, powers, text_chunks
from velolake.llm.quality import held_out

# At most so many texts of each language are fitted: those with the smallest hash of their doc_id.
TRAINING_TEXTS = 300
UNKNOWN = "und"
RUN = 32
GRAM_BITS, AFFIX_BITS, LEXICON_WORDS = 15, 13, 4000
PASSES, STEP, DECAY = 6, 0.3, 1e-6
SEED = 42

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True


@dataclass
class Words:
    """The words of some texts: runs of letters of lower-cased UTF-8, with their features."""

    text: np.ndarray  # the text of each word
    first: np.ndarray  # first byte of each word in `grams`
    grams: np.ndarray  # trigram feature of each byte of a word
    prefix: np.ndarray
    suffix: np.ndarray
    code: np.ndarray  # hash of the word

    def __len__(self) -> int:
        return len(self.text)


def _bucket(codes: np.ndarray, bits: int) -> np.ndarray:
    return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of texts that stand one after the other in `data`."""
    # A separator before each text keeps words apart.
    spaced = np.zeros(len(data) + len(offsets) + 3, np.uint8)
    texts = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    place = np.arange(len(data)) + texts + 1
    spaced[place] = np.where(_LETTER[data], data, 0)
    letter = spaced > 0
    edge = np.flatnonzero(np.diff(letter.astype(np.int8)))
    starts, ends = edge[::2] + 1, edge[1::2] + 1
    lengths = ends - starts
    inside = np.flatnonzero(letter)
    wide = spaced.astype(np.uint64)
    grams = _bucket((wide[inside - 1] << np.uint64(16)) | (wide[inside] << np.uint64(8)) | wide[inside + 1], GRAM_BITS)
    first = np.concatenate(([0], lengths.cumsum()))[:-1]

    def affix(at: list[np.ndarray], salt: int) -> np.ndarray:
        code = np.full(len(starts), salt, np.uint64)
        for p in at:
            code = (code << np.uint64(8)) | np.where((p >= starts) & (p < ends), wide[np.clip(p, 0, len(wide) - 1)], np.uint64(0))
        return _bucket(code, AFFIX_BITS)

    bounds = np.arange(len(offsets) - 1) + offsets[:-1] + 1  # where each text begins in `spaced`
    code = np.zeros(len(starts), np.uint64)
    if len(starts):
        position = np.arange(len(inside)) - np.repeat(first, lengths)
        code = mixed(np.add.reduceat(BYTE_CODES[spaced[inside]] * powers(int(lengths.max()))[position], first))
    return Words(np.searchsorted(bounds, starts, side="right") - 1, first, grams, affix([starts, starts + 1, starts + 2, starts + 3], 1),
                 affix([ends - 4, ends - 3, ends - 2, ends - 1], 2), code)


def marginals(scores: np.ndarray, transition: np.ndarray, chain: np.ndarray, expected: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Probabilities of the states at each place of chains, and the expected counts of transitions.

    `scores` are log scores (places x states); `chain` numbers the chain of each place, ascending.
    A chain begins as if all states stood before it.
    """
    count, states = scores.shape
    weights = np.exp(scores - scores.max(1, keepdims=True)).astype(np.float64) + 1e-30
    moves = np.exp(transition - transition.max())
    begin = np.flatnonzero(np.append(True, chain[1:] != chain[:-1]))
    size = np.diff(np.append(begin, count))
    number = np.arange(count) - np.repeat(begin, size)
    runs_of = -(-size // RUN)
    run_first = np.concatenate(([0], runs_of.cumsum()))
    runs, place = int(run_first[-1]), np.repeat(run_first[:-1], size) + number // RUN
    slot = number % RUN
    grid, used = np.ones((runs, RUN, states)), np.zeros((runs, RUN), bool)
    grid[place, slot], used[place, slot] = weights, True
    # The transfer matrix of each run.
    matrix = np.broadcast_to(np.eye(states), (runs, states, states)).copy()
    for t in range(RUN):
        on = np.flatnonzero(used[:, t])
        step = (matrix[on] @ moves) * grid[on, t][:, None, :]
        matrix[on] = step / step.max(axis=(1, 2), keepdims=True)
    # Messages into each run, from run to run of a chain; all chains at once, longest first.
    ahead, back = np.full((runs, states), 1.0 / states), np.full((runs, states), 1.0)
    order = np.argsort(-runs_of, kind="stable")
    many, starts = runs_of[order], run_first[:-1][order]
    for k in range(1, int(many.max(initial=0))):
        now = starts[:np.searchsorted(-many, -k, side="left")] + k
        step = np.einsum("ri,rij->rj", ahead[now - 1], matrix[now - 1])
        ahead[now] = step / step.sum(1, keepdims=True)
    for k in range(int(many.max(initial=0)) - 2, -1, -1):
        now = starts[:np.searchsorted(-many, -(k + 1), side="left")] + k
        step = np.einsum("rij,rj->ri", matrix[now + 1], back[now + 1])
        back[now] = step / step.sum(1, keepdims=True)
    # Through the words of all runs.
    forward, before = np.empty_like(grid), np.empty_like(grid)
    message = ahead.copy()
    for t in range(RUN):
        on = np.flatnonzero(used[:, t])
        before[:, t] = message
        step = (message[on] @ moves) * grid[on, t]
        message[on] = step / step.sum(1, keepdims=True)
        forward[:, t] = message
    behind, message = np.empty_like(grid), back.copy()
    for t in range(RUN - 1, -1, -1):
        on = np.flatnonzero(used[:, t])
        behind[:, t] = message
        step = (grid[on, t] * message[on]) @ moves.T
        message[on] = step / step.sum(1, keepdims=True)
    both = (forward * behind)[place, slot]
    both /= both.sum(1, keepdims=True)
    if not expected:
        return both, None
    pair = before[place, slot][:, :, None] * moves * (grid * behind)[place, slot][:, None, :]
    return both, (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(0)


@dataclass
class ChainField:
    """Weights of the features and transitions of the languages."""

    languages: list[str]
    grams: np.ndarray
    prefix: np.ndarray
    suffix: np.ndarray
    lexicon: np.ndarray  # sorted codes of the words in it
    known: np.ndarray  # weights of these, and of all other words at the end
    transition: np.ndarray

    def entry(self, words: Words) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.lexicon, words.code), max(len(self.lexicon) - 1, 0))
        return np.where(self.lexicon[at] == words.code, at, len(self.lexicon)) if len(self.lexicon) else np.zeros(len(words), np.int64)

    def scores(self, words: Words) -> np.ndarray:
        out = np.add.reduceat(self.grams[words.grams], words.first, axis=0)
        return out + self.prefix[words.prefix] + self.suffix[words.suffix] + self.known[self.entry(words)]

    def word_probabilities(self, words: Words) -> np.ndarray:
        return marginals(self.scores(words), self.transition, words.text)[0]


def fit(texts: list[str], languages: list[str], seed: int = SEED) -> ChainField:
    """The field of lower-cased texts, each in one language.

    Half of the chains are whole texts; the others splice stretches of different texts, so that
    changes of language are learned too.
    """
    names = sorted(set(languages))
    random = np.random.default_rng(seed)
    encoded = [t.encode() for t in texts]
    words = words_of(np.frombuffer(b"".join(encoded), np.uint8), np.cumsum([0, *map(len, encoded)]))
    model = ChainField(names, *(np.zeros((1 << bits, len(names)), np.float32) for bits in (GRAM_BITS, AFFIX_BITS, AFFIX_BITS)),
                       np.empty(0, np.uint64), np.zeros((1, len(names)), np.float32), np.zeros((len(names), len(names))))
    if not len(words):
        return model
    codes, counts = np.unique(words.code, return_counts=True)
    model.lexicon = np.sort(codes[np.argsort(-counts, kind="stable")[:LEXICON_WORDS]])
    model.known = np.zeros((len(model.lexicon) + 1, len(names)), np.float32)
    label = np.array([names.index(x) for x in languages])[words.text]
    entry = model.entry(words)
    lengths = np.diff(np.append(words.first, len(words.grams)))
    # Chains: lists of stretches of word numbers.
    edge = np.flatnonzero(np.append(True, words.text[1:] != words.text[:-1]))
    spans = [np.arange(a, b) for a, b in zip(edge, np.append(edge[1:], len(words)), strict=True)]
    chains, loose = [], []
    for i, span in enumerate(spans):
        if i % 2:
            loose += np.split(span, np.arange(int(random.integers(8, 40)), len(span), int(random.integers(8, 40))))
        else:
            chains.append(span)
    random.shuffle(loose)
    chains += [np.concatenate(loose[i:i + 8]) for i in range(0, len(loose), 8)]
    random.shuffle(chains)
    batches, batch, held = [], [], 0
    for chain in chains:
        batch.append(chain)
        held += len(chain)
        if held >= 20_000:
            batches.append(batch)
            batch, held = [], 0
    batches += [batch] if batch else []
    tables = [model.grams, model.prefix, model.suffix, model.known]
    seen = [np.full(t.shape, 1e-8) for t in (*tables, model.transition)]
    for _ in range(PASSES):
        for batch in batches:
            at = np.concatenate(batch)
            chain = np.repeat(np.arange(len(batch)), [len(c) for c in batch])
            spread = np.repeat(words.first[at] - np.concatenate(([0], lengths[at].cumsum()[:-1])), lengths[at]) + np.arange(lengths[at].sum())
            grams = words.grams[spread]
            part = Words(chain, np.concatenate(([0], lengths[at].cumsum()[:-1])), grams, words.prefix[at], words.suffix[at], words.code[at])
            found, moved = marginals(model.scores(part), model.transition, chain, expected=True)
            slope = -found
            slope[np.arange(len(at)), label[at]] += 1
            inner = chain[1:] == chain[:-1]
            counted = np.zeros_like(model.transition)
            np.add.at(counted, (label[at][:-1][inner], label[at][1:][inner]), 1)
            starts = np.flatnonzero(np.append(True, ~inner))
            np.add.at(counted, (slice(None), label[at][starts]), 1 / len(names))
            for weights, sums, where, rows in zip(tables, seen, (grams, words.prefix[at], words.suffix[at], entry[at]),
                                                  (np.repeat(slope, lengths[at], axis=0), slope, slope, slope), strict=False):
                change = np.stack([np.bincount(where, rows[:, k], len(weights)) for k in range(len(names))], axis=1) - DECAY * len(at) * weights
                sums += change**2
                weights += (STEP * change / np.sqrt(sums)).astype(np.float32)
            change = counted - moved
            seen[-1] += change**2
            model.transition += STEP * change / np.sqrt(seen[-1])
    return model


def train(docs: DataFrame, texts: int = TRAINING_TEXTS) -> ChainField:
    """The field of at most `texts` texts per language, from rows with text and lang that are not held out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.withColumn("code", F.xxhash64("text"))
    # Ranked without the texts; then `texts` keys per language find theirs.
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "code")
    keys = rows.select("doc_id", "code", "lang").distinct().withColumn("n", F.row_number().over(first)).filter(F.col("n") <= texts).drop("n")
    found = rows.alias("r").join(F.broadcast(keys).alias("k"), (F.col("r.code") == F.col("k.code")) & (F.col("r.lang") == F.col("k.lang"))
                                 & F.col("r.doc_id").eqNullSafe(F.col("k.doc_id"))).select("r.*")
    sample = found.dropDuplicates(["doc_id", "code", "lang"]).orderBy("doc_id", "code", "lang").select("text", "lang").collect()
    return fit([r["text"] for r in sample], [r["lang"] for r in sample])


def predict(docs: DataFrame, model: ChainField) -> DataFrame:
    """doc_id, held_out, lang_pred, score (mean probability of lang_pred over the words) of every row.

    Texts that are null or have no letter are UNKNOWN with score 0; ties go to the language that
    sorts first.
    """
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named, sure = [], []
            for first, end, data, offsets in text_chunks(batch.column("text")):
                words = words_of(data, offsets)
                mean = np.zeros((end - first, max(len(model.languages), 1)))
                if len(words) and model.languages:
                    np.add.at(mean, words.text, model.word_probabilities(words))
                    mean /= np.maximum(np.bincount(words.text, minlength=end - first), 1)[:, None]
                best = mean.argmax(1)
                top = mean[np.arange(end - first), best]
                named += [model.languages[b] if m > 0 else UNKNOWN for b, m in zip(best, top, strict=True)]
                sure += np.minimum(top, 1.0).tolist()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(named, pa.string()), pa.array(sure, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(text.rlike(r"\p{L}"), F.lower(text)).alias("text"))
    found = texts.mapInArrow(label, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def identify(docs: DataFrame) -> DataFrame:
    """Train on the documents that are not held out, then predict all; see `predict`.

    Only the text is used to predict. Repeated rows are rows of their own; other columns are
    ignored; an empty table gives no rows, and without training texts all are UNKNOWN.
    """
    return predict(docs, train(docs))

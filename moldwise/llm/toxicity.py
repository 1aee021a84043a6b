"""Toxicity by multiple-instance learning: sentences are the instances, only documents have labels.

A sentence's logit is a bias plus the weights of its distinct words and of
their stems (first four bytes); a document is toxic if any sentence is (noisy-or over the sentences).  Weights
are fitted by gradient descent on the documents' likelihood, so the sentences
that carry a label are found without sentence labels.

A text grows longer by harmless sentences without getting likelier toxic: clean
texts weigh in the fit as texts joined of several, and a sentence counts only
by what its mass, -log(1 - probability), has over a floor.  The floor is the
least at which all clean texts of the fit, joined into one, stay clean.

Null and empty texts have no sentence and score 0.  Repeated rows score alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moldwise.llm.labelled import add_columns, bounded_sample, fitted
from moldwise.llm.textbytes import ALNUM, U64, Words, is_fold, mix, run_hashes, text_bytes

FOLDS, HELD_OUT = 5, 0
STEM = 4  # bytes of a word that are a feature besides the word
#: Clean texts that are joined in the fit; the excess that all of them together may have; what an excess counts.
JOINED, EXCESS, GAIN = 10, 0.1, 4.0
#: Sentence ends: full stop, exclamation and question mark, line feed.
BREAKS = np.zeros(256, bool)
BREAKS[[0x0A, 0x21, 0x2E, 0x3F]] = True


@dataclass(frozen=True)
class Model:
    words: np.ndarray  # sorted hashes of the words and stems that have a weight
    weights: np.ndarray
    bias: float
    floor: float = 0.0  # mass up to which a sentence counts as harmless
    gain: float = 1.0

    def mass(self, z: np.ndarray) -> np.ndarray:
        """What sentences with logits ``z`` add to -log(1 - probability) of their text."""
        return self.gain * np.maximum(np.logaddexp(0, z) - self.floor, 0)


def sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words; the sentence that each is of; the text of each sentence; the first word of each sentence."""
    words = Words(data, offsets, ALNUM)
    if not len(words):
        return words, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    text = words.text
    ends = np.cumsum(BREAKS[data], dtype=np.int64)[words.start]
    new = np.ones(len(words), bool)
    new[1:] = (text[1:] != text[:-1]) | (ends[1:] != ends[:-1])
    first = np.flatnonzero(new)
    return words, np.cumsum(new) - 1, text[first], first


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word and of its first four bytes (as far as it is longer), and which word each is of."""
    h = words.hashes()
    longer = np.flatnonzero(words.end - words.start > STEM)
    stems = run_hashes(words.data, words.start[longer], words.start[longer] + STEM)
    return np.concatenate([h, mix(stems + U64(STEM))]), np.concatenate([np.arange(len(h)), longer])


def _known(vocabulary: np.ndarray, h: np.ndarray, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and sentence of the words with a weight, once for each sentence."""
    if not len(vocabulary):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    hit = vocabulary[at] == h
    key = np.unique(sentence[hit] * len(vocabulary) + at[hit])
    return key % len(vocabulary), key // len(vocabulary)


def _parts(texts: list[str], limit: int = 1 << 20):
    """(number of the first text, words, sentence of each word, text of each sentence) of some texts at a time."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= limit):
            size += len(texts[to])
            to += 1
        words, sentence, text, _ = sentences(*text_bytes(pa.array(texts[at:to], pa.string())))
        if len(words):
            yield at, words, sentence, text
        at = to


def _vocabulary(texts: list[str], min_docs: int) -> np.ndarray | None:
    """Sorted hashes of the features in ``min_docs`` texts at least; None without any word."""
    known, count = np.empty(0, U64), np.empty(0, np.int64)
    for _, words, _, _ in _parts(texts):
        h, of_word = features(words)
        distinct, code = np.unique(h, return_inverse=True)
        n = len(words.at) - 1
        new = np.bincount(np.unique(code * n + words.text[of_word]) // n, minlength=len(distinct))  # once for each text
        known, code = np.unique(np.concatenate([known, distinct]), return_inverse=True)
        count = np.bincount(code, np.concatenate([count, new]), len(known)).astype(np.int64)
    return known[count >= min_docs] if len(known) else None


def _occurrences(texts: list[str], vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index and sentence of the features with a weight, and the text of each sentence."""
    found, before = [], 0
    for at, words, sentence, text in _parts(texts):
        h, of_word = features(words)
        word, of = _known(vocabulary, h, sentence[of_word])
        found.append((word, of + before, text + at))
        before += len(text)
    return tuple(np.concatenate(c) for c in zip(*found))


def fit(texts: list[str], labels: np.ndarray, min_docs: int = 5, steps: int = 250, rate: float = 0.1, decay: float = 2e-4) -> Model:
    """Fit word weights from document labels; words in fewer than ``min_docs`` sampled texts get none."""
    vocabulary = _vocabulary(texts, min_docs)
    if vocabulary is None or len(set(labels)) < 2:
        return Model(np.empty(0, np.uint64), np.empty(0), -6.0 if not len(labels) or not labels.max() else 0.0)
    word, of, text = _occurrences(texts, vocabulary)
    y = (labels > 0).astype(float)
    # the loss of a joined clean text is the sum of its parts' losses
    share = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 * JOINED / max((1 - y).sum(), 1))
    weights, bias = np.zeros(len(vocabulary)), -5.0
    moment = [np.zeros(len(vocabulary) + 1), np.zeros(len(vocabulary) + 1)]
    for step in range(1, steps + 1):
        z = bias + np.bincount(of, weights[word], len(text))
        mass = np.bincount(text, np.logaddexp(0, z), len(y))
        by_mass = share * np.where(y > 0, -1 / np.expm1(np.clip(mass, 1e-9, 500)), 1.0)
        by_z = by_mass[text] / (1 + np.exp(-np.clip(z, -500, 500)))
        slope = np.append(np.bincount(word, by_z[of], len(vocabulary)) + decay * weights, by_z.sum())
        moment[0] += 0.1 * (slope - moment[0])
        moment[1] += 0.01 * (slope**2 - moment[1])
        move = rate * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    clean = np.logaddexp(0, bias + np.bincount(of, weights[word], len(text)))[y[text] == 0]
    return Model(vocabulary, weights, float(bias), _floor(clean), GAIN)


def _floor(mass: np.ndarray) -> float:
    """The least floor (one of the masses) over which all of ``mass`` together has at most EXCESS."""
    down = np.sort(mass)[::-1]
    over = np.cumsum(down) - np.arange(1, len(down) + 1) * down  # with that mass as floor
    return float(down[np.searchsorted(over, EXCESS, "right") - 1]) if len(down) else 0.0


def score(model: Model, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each text: probability, sentences, sentences over one half, and the byte span of the worst sentence."""
    n = len(offsets) - 1
    words, sentence, text, first = sentences(data, offsets)
    h, of_word = features(words) if len(words) else (np.empty(0, U64), np.empty(0, np.int64))
    word, of = _known(model.words, h, sentence[of_word])
    z = model.bias + np.bincount(of, model.weights[word], len(text))
    mass = model.mass(z)
    probability = -np.expm1(-np.bincount(text, mass, n))
    worst = np.full(n, -1)
    order = np.lexsort((-np.arange(len(z)), z))  # the last written is the largest, the first one of equals
    worst[text[order]] = order
    last = np.append(first[1:], len(words)) - 1
    has = worst >= 0
    start, end = np.full(n, -1), np.full(n, -1)
    start[has] = words.start[first[worst[has]]] - offsets[:-1][has]
    end[has] = words.end[last[worst[has]]] - offsets[:-1][has]
    return [np.clip(probability, 0.0, 1.0), np.bincount(text, minlength=n), np.bincount(text, mass > np.log(2), n).astype(np.int64), start, end]


FIELDS = [
    T.StructField("toxic_score", T.DoubleType()),
    T.StructField("sentences", T.LongType()),
    T.StructField("toxic_sentences", T.LongType()),
    T.StructField("worst_start", T.LongType()),
    T.StructField("worst_end", T.LongType()),
]


def train(docs: DataFrame, labels: DataFrame, per_label: int = 3000, max_bytes: int = 1 << 20, label_bytes: int = 16 << 20) -> Model:
    """Fit on at most ``per_label`` documents of each label outside the held-out fold.

    Texts stay whole as far as ``label_bytes`` has room, as a toxic sentence may stand anywhere.
    """
    targets = labels.select("doc_id", F.col("toxic").alias("label"))
    return fitted(bounded_sample(docs, targets, FOLDS, HELD_OUT, per_label, max_bytes, label_bytes), fit)


def toxicity(docs: DataFrame, model: Model, prefix: str = "") -> DataFrame:
    """``docs`` with FIELDS appended, their names behind ``prefix``."""
    fields = [T.StructField(prefix + f.name, f.dataType) for f in FIELDS]
    return add_columns(docs, fields, lambda data, offsets: score(model, data, offsets))


def toxicity_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    model = train(docs, labels)
    scored = toxicity(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        is_fold(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= threshold).cast("int").alias("predicted"),
        "sentences", "toxic_sentences", "worst_start", "worst_end",
    )

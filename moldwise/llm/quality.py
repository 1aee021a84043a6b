"""Document quality by a byte-level convolutional network in numpy.

Bytes are embedded, 8-byte windows at every position of the document (filled
up with zeros to whole halves of a chunk) go through learned filters with a rectifier, and each filter is max-pooled over
chunks that overlap by half.  A chunk's logit is linear in its pooled values;
the document's logit is the mean over its chunks, so its whole length counts
and a long document isn't likelier to be rejected for one odd place.

Null and empty texts are one chunk of padding and get a score as well.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moldwise.llm.labelled import add_columns, bounded_sample, fitted
from moldwise.llm.textbytes import is_fold, text_bytes

FOLDS, HELD_OUT = 4, 2
WIDTH, HALF = 8, 256  # bytes that a filter sees; bytes of half a chunk
DIM, FILTERS = 8, 16
THRESHOLD = 0.7


@dataclass
class Model:
    embed: np.ndarray  # 256 x DIM
    filters: np.ndarray  # WIDTH * DIM x FILTERS
    shift: np.ndarray  # FILTERS
    weights: np.ndarray  # FILTERS
    bias: float


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with each text filled up with zeros to whole halves of a chunk and one width more; its first half and number of halves."""
    size = np.diff(offsets)
    halves = np.maximum(1, -(-size // HALF))
    first = np.cumsum(halves) - halves
    out = np.zeros(int(halves.sum()) * HALF + WIDTH, np.uint8)
    out[np.arange(len(data)) + np.repeat(first * HALF - offsets[:-1], size)] = data
    return out, first, halves


def convolve(model: Model, raw: np.ndarray) -> np.ndarray:
    """Filter responses at every position; the windows of one phase lie side by side, so nothing is copied."""
    n = len(raw) - WIDTH
    e = model.embed[raw]
    out = np.empty((n // WIDTH, WIDTH, model.filters.shape[1]), np.float32)
    for phase in range(WIDTH):
        out[:, phase] = e[phase : phase + n].reshape(-1, WIDTH * DIM) @ model.filters
    return out.reshape(n, -1)


def half_responses(model: Model, raw: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Responses by half and position; windows that would run past a text's ``last`` half are left out."""
    seen = convolve(model, raw).reshape(len(last), HALF, -1)
    seen[last, HALF - WIDTH + 1 :] = -np.inf
    return seen


def last_halves(first: np.ndarray, halves: np.ndarray) -> np.ndarray:
    """Which halves are the last of their text."""
    last = np.zeros(int(halves.sum()), bool)
    last[first + halves - 1] = True
    return last


def half_maxima(model: Model, raw: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Largest response of each filter in each half chunk, some halves at a time."""
    step, n = 256, len(last)
    out = np.empty((n, model.filters.shape[1]), np.float32)
    for at in range(0, n, step):
        to = min(n, at + step)
        out[at:to] = half_responses(model, raw[at * HALF : to * HALF + WIDTH], last[at:to]).max(axis=1)
    return np.maximum(out + model.shift, 0)


def chunk_pairs(first: np.ndarray, halves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The two halves of each chunk (twice the same in a text of one half) and the text of each chunk."""
    count = np.maximum(1, halves - 1)
    text = np.repeat(np.arange(len(halves)), count)
    left = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count) + first[text]
    return left, np.where(halves[text] > 1, left + 1, left), text


def score(model: Model, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The probability of label 1 for each text."""
    raw, first, halves = padded(data, offsets)
    top = half_maxima(model, raw, last_halves(first, halves))
    left, right, text = chunk_pairs(first, halves)
    logit = np.maximum(top[left], top[right]).astype(float) @ model.weights + model.bias
    mean = np.bincount(text, logit, len(halves)) / np.bincount(text, minlength=len(halves))
    return [1 / (1 + np.exp(-np.clip(mean, -500, 500)))]


def fit(texts: list[str], labels: np.ndarray, steps: int = 600, batch: int = 48, rate: float = 0.01, seed: int = 7) -> Model:
    """Adam on the documents' log loss, ``steps`` batches of shuffled documents; both labels weigh the same."""
    rng = np.random.default_rng(seed)
    model = Model(
        rng.normal(0, 0.5, (256, DIM)).astype(np.float32), rng.normal(0, (WIDTH * DIM) ** -0.5, (WIDTH * DIM, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32), rng.normal(0, 0.3, FILTERS), 0.0,
    )
    y = (labels > 0).astype(float)
    if not len(y) or y.min() == y.max():  # nothing to tell apart
        model.weights, model.bias = np.zeros(FILTERS), 0.0 if not len(y) else float(8 * y[0] - 4)
        return model
    share = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y).mean())
    names = ("embed", "filters", "shift", "weights", "bias")
    moments = {k: (np.zeros_like(getattr(model, k)), np.zeros_like(getattr(model, k))) for k in names}
    queue = np.empty(0, np.int64)
    for step in range(1, steps + 1):
        if len(queue) < batch:
            queue = np.append(queue, rng.permutation(len(y)))
        rows, queue = queue[:batch], queue[batch:]
        slopes = _slopes(model, [_cropped(texts[i], rng) for i in rows], y[rows], share[rows])
        now = rate * (1 - step / (steps + 1))
        for k in names:
            a, b = moments[k]
            a, b = 0.9 * a + 0.1 * slopes[k], 0.99 * b + 0.01 * slopes[k] ** 2
            moments[k] = (a, b)
            move = now * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
            setattr(model, k, float(model.bias - move) if k == "bias" else (getattr(model, k) - move).astype(getattr(model, k).dtype))
    return model


def _cropped(text: str, rng: np.random.Generator, share: float = 0.5) -> str:
    """The text, or now and then a short piece of its second half, so that short documents are learned too."""
    if rng.random() >= share or len(text) < 120:
        return text
    at = int(rng.integers(len(text) // 2, len(text) - 50))
    at = text.find(" ", at) + 1 or at
    return text[at : at + int(np.exp(rng.uniform(2.3, 6)))]  # 10 to 400 characters


def _slopes(model: Model, texts: list[str], y: np.ndarray, share: np.ndarray) -> dict:
    raw, first, halves = padded(*text_bytes(pa.array(texts, pa.string())))
    seen = half_responses(model, raw, last_halves(first, halves))
    where = seen.argmax(axis=1)  # the window that each maximum comes from
    top = np.maximum(np.take_along_axis(seen, where[:, None], 1)[:, 0] + model.shift, 0)
    left, right, text = chunk_pairs(first, halves)
    pooled = np.maximum(top[left], top[right])
    chunks = np.bincount(text, minlength=len(y))
    logit = np.bincount(text, pooled @ model.weights + model.bias, len(y)) / chunks
    by_logit = share * (1 / (1 + np.exp(-np.clip(logit, -500, 500))) - y) / len(y)
    by_chunk = (by_logit / chunks)[text]
    by_pool = by_chunk[:, None] * model.weights * (pooled > 0)
    by_top = np.zeros((len(top), FILTERS))
    goes_left = top[left] >= top[right]
    np.add.at(by_top, left, by_pool * goes_left)
    np.add.at(by_top, right, by_pool * ~goes_left)
    half, filt = np.nonzero(by_top)
    slope = by_top[half, filt].astype(np.float32)
    window = raw[(half * HALF + where[half, filt])[:, None] + np.arange(WIDTH)]  # bytes of each such window
    inputs = model.embed[window].reshape(len(half), -1)
    by_filters = np.stack([slope[filt == f] @ inputs[filt == f] for f in range(FILTERS)], axis=1)
    by_embed = np.zeros_like(model.embed)
    np.add.at(by_embed, window.ravel(), (slope[:, None] * model.filters.T[filt]).reshape(-1, DIM))
    return {"embed": by_embed, "filters": by_filters + 1e-4 * model.filters, "shift": np.bincount(filt, slope, FILTERS), "weights": by_chunk @ pooled + 1e-4 * model.weights, "bias": by_logit.sum()}


def train(docs: DataFrame, labels: DataFrame, per_label: int = 1200, max_bytes: int = 8192, label_bytes: int = 10 << 20) -> Model:
    """Fit on at most ``per_label`` documents of each label outside the held-out fold, excerpts of those over ``max_bytes``."""
    targets = labels.select("doc_id", F.col("quality").alias("label"))
    return fitted(bounded_sample(docs, targets, FOLDS, HELD_OUT, per_label, max_bytes, label_bytes), fit)


def quality(docs: DataFrame, model: Model, name: str = "quality_score") -> DataFrame:
    """``docs`` with the probability of label 1 appended."""
    return add_columns(docs, [T.StructField(name, T.DoubleType())], lambda data, offsets: score(model, data, offsets))


def quality_report(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    scored = quality(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        "doc_id",
        is_fold(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= threshold).cast("int").alias("predicted"),
    )

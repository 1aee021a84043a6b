"""Language of a text by a linear-chain conditional random field over its words.

Each word has features: its first and last one to three bytes, its byte
bigrams and trigrams, and the word itself if it is in the lexicon of words that
several sampled texts have.  A state for each learned language adds up its
weights of these features; learned weights of transitions let the language
change inside a text.  Forward-backward gives each word's probabilities; the
text gets the language with the largest sum over its words, and the share of
that sum as score.  The field is trained by the gradient of its likelihood on
texts whose words all carry the text's label, some of them joined pairwise at
word ends, so that changes of language are seen as well.

Words are runs of ASCII letters and of bytes from 0x80 on.  Texts that are
null or have no letter are `und` with score 0; repeated rows score alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moldwise.llm.labelled import bounded_sample, fitted
from moldwise.llm.textbytes import U64, Words, expand, is_fold, mix, prefix_sums, run_hashes, slices, text_bytes

FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
LOG2 = 18  # hashed weights for each language
SEGMENT = 128  # words that forward-backward takes in one run

_all = np.arange(256)
LETTERS = (_all >= 0x80) | ((_all >= 0x41) & (_all <= 0x5A)) | ((_all >= 0x61) & (_all <= 0x7A))
LOWER = _all.astype(np.uint8)
LOWER[0x41:0x5B] += 32


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # 2**LOG2 x languages
    lexicon: np.ndarray  # sorted word hashes
    lexical: np.ndarray  # words of the lexicon x languages
    start: np.ndarray
    change: np.ndarray  # from language x to language


def features(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words: (word, feature) pairs, word after word not kept in order."""
    size = end - start
    raw = LOWER[data[expand(start, size)]]
    stop = np.cumsum(size)
    begin = stop - size
    total = prefix_sums(raw, 2)
    words, found = [], []

    def add(which: np.ndarray, at: np.ndarray, length: np.ndarray | int, kind: int) -> None:
        h = run_hashes(raw, at, at + length, 2, total) + U64(kind * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        words.append(which)
        found.append((mix(h) >> U64(64 - LOG2)).astype(np.int32))

    every = np.arange(len(size))
    for n in (1, 2, 3):
        some = every[size >= n]
        add(some, begin[some], n, 1)
        add(some, stop[some] - n, n, 2)
    of = np.repeat(every, size)
    for n in (2, 3):
        at = np.arange(len(raw))
        at = at[at + n <= stop[of]]
        add(of[at], at, n, 3)
    return np.concatenate(words), np.concatenate(found)


def emissions(model: Model, data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Scores of each distinct word for each language, and which of them each word is."""
    h = words.hashes()
    distinct, first, which = np.unique(h, return_index=True, return_inverse=True)
    word, feature = features(data, words.start[first], words.end[first])
    out = np.empty((len(distinct), len(model.langs)))
    for k in range(len(model.langs)):
        out[:, k] = np.bincount(word, model.weights[:, k][feature], len(distinct))
    size = (words.end - words.start)[first]
    out /= np.sqrt(2.0 * size + 3)[:, None]
    if len(model.lexicon):
        at = np.minimum(np.searchsorted(model.lexicon, distinct), len(model.lexicon) - 1)
        out += model.lexical[at] * (model.lexicon[at] == distinct)[:, None]
    return out, which


def marginals(model: Model, scores: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each word's probabilities by forward-backward within its text.

    Texts are cut into segments that all advance together.  A segment is first
    taken as a linear map (a row for each state before it), maps are chained
    along each text, and the segments' real values follow from what comes in
    from either side, so very long texts need no more steps than short ones.
    """
    k = scores.shape[1]
    count = np.diff(bounds)
    pieces = np.maximum(-(-count // SEGMENT), 0)
    text = np.repeat(np.arange(len(count)), pieces)
    order = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = bounds[text] + order * SEGMENT
    size = np.minimum(SEGMENT, bounds[text + 1] - begin)
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    change = np.exp(model.change - model.change.max())
    n = len(begin)
    by_size = np.argsort(-size, kind="stable")
    live = [int(np.searchsorted(-size[by_size], -t, "left")) for t in range(SEGMENT)]  # segments with more than t words

    def run(state: np.ndarray, backward: bool, keep: np.ndarray | None) -> np.ndarray:
        """``state``: n x rows x k, advanced through all words; with ``keep``, what comes in at each word (rows: one)."""
        state = state.copy()
        for t in range(SEGMENT):
            seg = by_size[: live[t]]
            if not len(seg):
                break
            at = begin[seg] + (size[seg] - 1 - t if backward else t)
            now = state[seg]
            if keep is not None:
                keep[at] = now[:, 0]
            now = (now * emit[at][:, None, :]) @ (change.T if backward else change)
            state[seg] = now / now.sum(axis=(1, 2), keepdims=True)
        return state

    ones = np.broadcast_to(np.eye(k), (n, k, k))
    left, right = np.empty((n, k)), np.empty((n, k))
    several = np.flatnonzero(pieces > 1)
    head = np.cumsum(pieces) - pieces
    first = np.exp(model.start - model.start.max())
    left[head[pieces > 0]] = first
    right[(head + pieces - 1)[pieces > 0]] = 1.0
    if len(several):
        forth = run(ones, False, None)
        back = run(ones, True, None)
        for i in several:  # chain the maps of one text
            a, b = head[i], head[i] + pieces[i]
            for s in range(a + 1, b):
                v = left[s - 1] @ forth[s - 1]
                left[s] = v / v.sum()
            for s in range(b - 2, a - 1, -1):
                v = right[s + 1] @ back[s + 1]
                right[s] = v / v.sum()
    ahead, behind = np.empty_like(emit), np.empty_like(emit)
    run(left[:, None, :], False, ahead)
    run(right[:, None, :], True, behind)
    out = ahead * emit * behind
    return out / out.sum(axis=1, keepdims=True)


def predict(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text: index of the language (-1 without words), its share, and the number of words in other languages."""
    n = len(offsets) - 1
    words = Words(data, offsets, LETTERS)
    best, share, other = np.full(n, -1), np.zeros(n), np.zeros(n, np.int64)
    if len(words) and model.langs:
        table, which = emissions(model, data, words)
        p = marginals(model, table[which], words.at)
        text = words.text
        total = np.stack([np.bincount(text, p[:, k], n) for k in range(len(model.langs))], 1)
        some = words.counts > 0
        best[some] = total[some].argmax(axis=1)
        share[some] = total[some].max(axis=1) / words.counts[some]
        other = np.bincount(text, p.argmax(axis=1) != best[text], n).astype(np.int64)
    return best, np.clip(share, 0.0, 1.0), other


def _expected(model: Model, scores: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals, and expected transitions between neighbouring words of a text (rows: words but each text's first)."""
    k = scores.shape[1]
    p = marginals(model, scores, bounds)
    # pair probabilities follow from the marginals of the first word and the backward messages
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    change = np.exp(model.change - model.change.max())
    after = np.ones_like(p)
    length = np.diff(bounds)
    longest = int(length.max()) if len(length) else 0
    for t in range(1, longest):
        at = bounds[1:][length > t] - 1 - t
        v = (emit[at + 1] * after[at + 1]) @ change.T
        after[at] = v / v.sum(axis=1, keepdims=True)
    inner = np.ones(len(p), bool)
    inner[bounds[:-1][length > 0]] = False
    to = np.flatnonzero(inner)
    given = change[None] * (emit[to] * after[to])[:, None, :]
    given /= given.sum(axis=2, keepdims=True)
    return p, (p[to - 1][:, :, None] * given).sum(axis=0).reshape(k, k)


def fit(texts: list[str], labels: np.ndarray, steps: int = 60, rate: float = 0.15, words_each: int = 60, decay: float = 1e-4, seed: int = 11) -> Model:
    """Gradient descent (Adam) on the field's likelihood over runs of words of the sampled texts."""
    langs = sorted({str(x) for x in labels})
    k = len(langs)
    size = 1 << LOG2
    model = Model(langs, np.zeros((size, k)), np.empty(0, U64), np.empty((0, k)), np.zeros(k), np.zeros((k, k)))
    if not k:
        return model
    rng = np.random.default_rng(seed)
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    words = Words(data, offsets, LETTERS)
    index = np.array([langs.index(str(x)) for x in labels])
    h = words.hashes() if len(words) else np.empty(0, U64)
    pair = np.unique(np.stack([h, words.text.astype(U64)], 1), axis=0) if len(words) else np.empty((0, 2), U64)
    lexicon, docs = np.unique(pair[:, 0], return_counts=True)
    model.lexicon = lexicon[docs >= 5]
    model.lexical = np.zeros((len(model.lexicon), k))
    runs = []  # first word and number of words
    for i in np.flatnonzero(words.counts > 0):
        a, b = words.at[i], words.at[i + 1]
        at = int(rng.integers(a, max(a + 1, b - words_each + 1)))
        runs.append((at, min(words_each, b - at), index[i]))
    if not runs:
        return model
    order = rng.permutation(len(runs))
    chains, used = [], 0
    while used < len(order):
        take = 2 if rng.random() < 0.3 and used + 1 < len(order) else 1
        chains.append([runs[j] for j in order[used : used + take]])
        used += take
    flat = np.concatenate([np.arange(at, at + n) for chain in chains for at, n, _ in chain])
    gold = np.concatenate([np.full(n, lab) for chain in chains for _, n, lab in chain])
    bounds = np.append(0, np.cumsum([sum(n for _, n, _ in chain) for chain in chains]))
    distinct, first, which = np.unique(h[flat], return_index=True, return_inverse=True)
    starts, ends = words.start[flat][first], words.end[flat][first]
    word, feature = features(data, starts, ends)
    used_features, feature = np.unique(feature, return_inverse=True)
    scale = 1 / np.sqrt(2.0 * (ends - starts) + 3)
    lex = np.minimum(np.searchsorted(model.lexicon, distinct), max(0, len(model.lexicon) - 1)) if len(model.lexicon) else np.zeros(len(distinct), np.int64)
    in_lex = (model.lexicon[lex] == distinct) if len(model.lexicon) else np.zeros(len(distinct), bool)
    share = 1 / np.maximum(1, np.bincount(gold, minlength=k))
    weight = share[gold] / k  # every language weighs the same
    one = np.eye(k)[gold]
    inner = np.ones(len(flat), bool)
    inner[bounds[:-1]] = False
    seen = np.zeros((k, k))
    np.add.at(seen, (gold[:-1][inner[1:]], gold[1:][inner[1:]]), 1)
    params = {"weights": np.zeros((len(used_features), k)), "lexical": model.lexical, "start": model.start, "change": model.change}
    moments = {name: (np.zeros_like(v), np.zeros_like(v)) for name, v in params.items()}
    for step in range(1, steps + 1):
        table = np.stack([np.bincount(word, params["weights"][:, j][feature], len(distinct)) for j in range(k)], 1) * scale[:, None]
        if len(model.lexicon):
            table += params["lexical"][lex] * in_lex[:, None]
        model.start, model.change = params["start"], params["change"]
        p, pairs = _expected(model, table[which], bounds)
        error = (p - one) * weight[:, None]
        by_word = np.stack([np.bincount(which, error[:, j], len(distinct)) for j in range(k)], 1)
        slopes = {
            "weights": np.stack([np.bincount(feature, (by_word[:, j] * scale)[word], len(used_features)) for j in range(k)], 1),
            "lexical": np.zeros_like(params["lexical"]),
            "start": (p - one)[bounds[:-1]].mean(axis=0),
            "change": (pairs - seen) / max(1.0, seen.sum()),
        }
        np.add.at(slopes["lexical"], lex[in_lex], by_word[in_lex])
        for name, slope in slopes.items():
            slope = slope + decay * params[name]
            a, b = moments[name]
            moments[name] = a, b = 0.9 * a + 0.1 * slope, 0.99 * b + 0.01 * slope**2
            params[name] = params[name] - rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    model.weights[used_features] = params["weights"]
    model.lexical, model.start, model.change = params["lexical"], params["start"], params["change"]
    return model


FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("other_words", T.LongType())]


def train(docs: DataFrame, per_lang: int = 800, max_bytes: int = 16384, lang_bytes: int = 13 << 20) -> Model:
    """Fit on at most ``per_lang`` texts of each language outside the held-out fold, excerpts of those over ``max_bytes``."""
    targets = docs.select("doc_id", F.col("lang").alias("label"))
    return fitted(bounded_sample(docs.select("doc_id", "text"), targets, FOLDS, HELD_OUT, per_lang, max_bytes, lang_bytes), fit)


def languages(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and FIELDS of every whole text; ``other_words`` are labelled with another language than the text."""

    def run(batches):
        names = np.array([*model.langs, UNKNOWN], object)
        for batch in slices(batches):
            best, share, other = predict(model, *text_bytes(batch.column(1)))
            best = np.where(batch.column(2).to_numpy(zero_copy_only=False), best, -1)
            score = np.where(best < 0, 0.0, share)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names[best], pa.string()), pa.array(score), pa.array(other)], names=["doc_id", *(f.name for f in FIELDS)])

    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", has_letter)
    return rows.mapInArrow(run, T.StructType([T.StructField("doc_id", T.LongType()), *FIELDS]))


def language_report(docs: DataFrame) -> DataFrame:
    return languages(docs, train(docs)).select("doc_id", is_fold(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "lang_pred", "score", "other_words")

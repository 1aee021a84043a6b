"""Language model scoring with an Elias-Fano n-gram trie.

Counts come from all training texts.  Level 1 holds the words, as a rising
Elias-Fano sequence of their hashes: a word's id is its place.  Level n holds
the n-grams under their contexts, the nodes of level n - 1: in a shard of
consecutive contexts, the sequence context * V + word rises, so one successor
search relative to the context finds a child, and its place (plus those of the
shards before) is its id for the next level.  Rising pointers give the range of
each context's children.  Smoothing is Witten-Bell, interpolated: with c the
count of a context's children and t their number, a child has c(child) /
(c + t) and the context leaves t / (c + t) to the next shorter one; under the
words lies the base model.  Both are quantised to 8 bits by codebooks of equal
shares.  Levels are files in the shared folder, mapped by the tasks that count
the next level and score.

A text's first word has no context.  Null and empty texts are one end token.
Rows without an id count as training rows; repeated rows count each time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moldwise.llm.eliasfano import EliasFano, encode, filesystem, read_arrays, write_arrays
from moldwise.llm.textbytes import SPACED, U64, Words, is_fold, slices, text_bytes
from moldwise.session import checkpoint_dir

FOLDS, HELD_OUT = 10, 0
ORDER = 3
END = U64(0x6C62272E07BB0142)
GATHER = 1 << 22  # n-grams that a task sorts and counts at once
SLICE = 8 << 20


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, an end behind each text's words, and the n + 1 bounds of the texts."""
    words = Words(data, offsets, SPACED)
    bounds = words.at + np.arange(len(words.at))
    out = np.full(int(bounds[-1]), END, U64)
    if len(words):
        out[np.arange(len(words)) + words.text] = words.hashes()
    return out, bounds


def _pack(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted keys as steps, byte by byte; both compressed."""
    steps = np.diff(keys, prepend=U64(0))
    return pa.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True), pa.compress(counts.astype("<u4").tobytes(), "zstd", asbytes=True)


def _unpack(n: int, keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(pa.decompress(keys, 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(U64).ravel(), dtype=U64), np.frombuffer(pa.decompress(counts, 4 * n, "zstd", asbytes=True), "<u4")


def _counted(shard: np.ndarray, keys: np.ndarray, shards: int) -> pa.RecordBatch:
    """Distinct keys with counts, one row for each shard."""
    order = np.argsort(shard.astype(np.int16 if shards < 1 << 15 else np.int64), kind="stable")
    keys, bounds = keys[order], np.searchsorted(shard[order], np.arange(shards + 1))
    rows: list[list] = [[], [], [], []]
    for s in np.flatnonzero(np.diff(bounds)):
        mine, counts = np.unique(keys[bounds[s] : bounds[s + 1]], return_counts=True)
        for column, value in zip(rows, (s, len(mine), *_pack(mine, counts))):
            column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["shard", "n", "keys", "counts"])


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """8-bit codes and their codebook: the values themselves if few differ, else the means of equal shares."""
    book = np.unique(values)
    if len(book) <= 256:
        return np.searchsorted(book, values).astype(np.uint8), book
    ordered = np.sort(values)
    cuts = np.unique(ordered[(np.arange(1, 256) * len(ordered)) // 256])
    code = np.searchsorted(cuts, values, "right")
    count = np.bincount(code, minlength=len(cuts) + 1)
    return code.astype(np.uint8), np.bincount(code, values, len(cuts) + 1) / np.maximum(count, 1)


@dataclass
class Level:
    """The files of a level in order, and the first context and first node of each."""

    files: list[str]
    contexts: np.ndarray
    nodes: np.ndarray  # one more, the number of all


@dataclass
class Trie:
    total: int = 0
    levels: list[Level] = field(default_factory=list)

    @property
    def words(self) -> int:
        return int(self.levels[0].nodes[-1])

    def vocabulary(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and counts of words by hash."""
        level = self.levels[0]
        distinct, which = np.unique(h, return_inverse=True)
        ids, counts = np.full(len(distinct), -1, np.int64), np.zeros(len(distinct), np.int64)
        bounds = np.append(np.searchsorted(distinct, level.contexts), len(distinct))
        for s, file in enumerate(level.files):
            a, b = bounds[s], bounds[s + 1]
            if a < b:
                arrays = read_arrays(file)
                at = EliasFano(arrays).find(distinct[a:b] - level.contexts[s])
                ids[a:b] = np.where(at < 0, -1, at + level.nodes[s])
                counts[a:b] = np.where(at < 0, 0, arrays["counts"][np.maximum(at, 0)])
        return ids[which], counts[which]

    def children(self, n: int, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For contexts (nodes of level n - 1, -1: none) and words: node of level n or -1, its share, and what the context leaves to shorter ones."""
        level = self.levels[n - 1]
        node, share, left = np.full(len(context), -1, np.int64), np.zeros(len(context)), np.ones(len(context))
        shard = np.searchsorted(level.contexts, context, "right") - 1  # -1 without a context
        order = np.argsort(shard.astype(np.int16 if len(level.files) < 1 << 15 else np.int64), kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(len(level.files) + 1))
        for s, file in enumerate(level.files):
            mine = order[bounds[s] : bounds[s + 1]]
            if not len(mine):
                continue
            arrays = read_arrays(file)
            local = context[mine] - level.contexts[s]
            left[mine] = arrays["left_book"][arrays["left"][local]]
            mine, local = mine[word[mine] >= 0], local[word[mine] >= 0]
            at = EliasFano(arrays).find(local.astype(U64) * U64(self.words) + word[mine].astype(U64))
            mine, at = mine[at >= 0], at[at >= 0]
            node[mine], share[mine] = at + level.nodes[s], arrays["share_book"][arrays["share"][at]]
        return node, share, left

    def child_range(self, n: int, context: int) -> tuple[int, int]:
        """The nodes of level n under a context, by the pointers."""
        level = self.levels[n - 1]
        s = int(np.searchsorted(level.contexts, context, "right")) - 1
        at = EliasFano(read_arrays(level.files[s]), "to_").get(np.array([context - level.contexts[s], context - level.contexts[s] + 1]))
        return int(at[0]) + int(level.nodes[s]), int(at[1]) + int(level.nodes[s])

    def contexts(self, upto: int, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Nodes of level ``upto`` that end at each token; ``first``: tokens at the beginning of a text."""
        node = ids
        for n in range(2, upto + 1):
            node = self.children(n, _before(node, first), ids)[0]
        return node


def _before(node: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.full(len(node), -1, np.int64)
    out[1:] = node[:-1]
    out[first] = -1
    return out


def _firsts(bounds: np.ndarray) -> np.ndarray:
    return bounds[:-1]


def _gathered(batches, shards: int, keyed):
    """Counts of the keys that ``keyed(data, offsets)`` gives for slices of texts: (shard, key)."""
    held, parts = 0, []
    for batch in slices(batches, limit=SLICE):
        part = keyed(*text_bytes(batch.column(0)))
        parts.append(part)
        held += len(part[0])
        if held >= GATHER:
            yield _counted(*(np.concatenate(x) for x in zip(*parts)), shards)
            held, parts = 0, []
    if held:
        yield _counted(*(np.concatenate(x) for x in zip(*parts)), shards)


_COUNTS = "shard int, n long, keys binary, counts binary"
_META = "shard int, file string, nodes long, total long"


def _merged(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    parts = [_unpack(*r) for r in zip(*(rows.column(c).to_pylist() for c in ("n", "keys", "counts")))]
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts, first)


def _meta(shard: int, file: str, nodes: int, total: int) -> pa.Table:
    return pa.table({"shard": pa.array([shard], pa.int32()), "file": [file], "nodes": pa.array([nodes], pa.int64()), "total": pa.array([total], pa.int64())})


def _hash_bases(shards: int) -> np.ndarray:
    """The smallest hash of each shard."""
    return np.array([-(-s * (1 << 32) // shards) << 32 for s in range(shards)], U64)


def _vocabulary(texts: DataFrame, folder: str, shards: int) -> tuple[int, Level]:
    bases = _hash_bases(shards)

    def keyed(data, offsets):
        h, _ = tokens(data, offsets)
        shard = ((h >> U64(32)) * U64(shards) >> U64(32)).astype(np.int64)
        return shard, h - bases[shard]

    def build(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        keys, counts = _merged(rows)
        file = f"{folder}/words-{key[0].as_py()}-{uuid.uuid4().hex[:8]}"
        write_arrays(file, encode(keys, ((1 << 64) // shards) + (1 << 32)) | {"counts": counts})
        return _meta(key[0].as_py(), file, len(keys), int(counts.sum()))

    found = texts.mapInArrow(lambda batches: _gathered(batches, shards, keyed), _COUNTS).groupBy("shard").applyInArrow(build, _META).collect()
    return sum(r["total"] for r in found), _level(found, bases)


def _level(found: list, starts: np.ndarray) -> Level:
    """``found``: a row for each shard with nodes; others are left out."""
    found = sorted(found, key=lambda r: r["shard"])
    kept = [r["shard"] for r in found]
    return Level([r["file"] for r in found], starts[kept], np.append(0, np.cumsum([r["nodes"] for r in found])).astype(np.int64))


def _grams(texts: DataFrame, trie: Trie, n: int, folder: str, shards: int) -> Level:
    contexts = int(trie.levels[-1].nodes[-1])
    shards = max(1, min(shards, contexts))
    starts = np.array([s * contexts // shards for s in range(shards + 1)], np.int64)

    def keyed(data, offsets):
        h, bounds = tokens(data, offsets)
        ids, _ = trie.vocabulary(h)
        first = _firsts(bounds)
        context = _before(trie.contexts(n - 1, ids, first), first)
        has = context >= 0
        context, word = context[has], ids[has]
        shard = np.searchsorted(starts, context, "right") - 1
        return shard, (context - starts[shard]).astype(U64) * U64(trie.words) + word.astype(U64)

    def build(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        size = int(starts[shard + 1] - starts[shard])
        keys, counts = _merged(rows)
        context = (keys // U64(trie.words)).astype(np.int64)
        total = np.bincount(context, counts, size)
        kinds = np.bincount(context, minlength=size)
        share, share_book = quantise(counts / (total + kinds)[context])
        left, left_book = quantise(np.where(kinds > 0, kinds / np.maximum(total + kinds, 1), 1.0))
        pointers = encode(np.append(0, np.cumsum(kinds)).astype(U64), len(keys) + 1)
        arrays = encode(keys, size * trie.words) | {f"to_{k}": v for k, v in pointers.items()}
        file = f"{folder}/level{n}-{shard}-{uuid.uuid4().hex[:8]}"
        write_arrays(file, arrays | {"share": share, "share_book": share_book, "left": left, "left_book": left_book})
        return _meta(shard, file, len(keys), int(counts.sum()))

    found = texts.mapInArrow(lambda batches: _gathered(batches, shards, keyed), _COUNTS).groupBy("shard").applyInArrow(build, _META).collect()
    have = {r["shard"] for r in found}
    for shard in set(range(shards)) - have:  # contexts that nothing follows
        size = int(starts[shard + 1] - starts[shard])
        file = f"{folder}/level{n}-{shard}-{uuid.uuid4().hex[:8]}"
        pointers = encode(np.zeros(size + 1, U64), 1)
        write_arrays(file, encode(np.empty(0, U64), 1) | {f"to_{k}": v for k, v in pointers.items()} | {"share": np.empty(0, np.uint8), "share_book": np.empty(0), "left": np.zeros(size, np.uint8), "left_book": np.ones(1)})
        found.append({"shard": shard, "file": file, "nodes": 0})
    return _level(found, starts)


def train(docs: DataFrame, order: int = ORDER) -> Trie:
    """Count and build all levels from the rows outside the held-out fold; files stay in the shared folder."""
    spark = docs.sparkSession
    folder = f"{checkpoint_dir(spark)}/ngrams-{uuid.uuid4().hex}"
    where, base = filesystem(folder)
    where.create_dir(base, recursive=True)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.where(~is_fold(F.col("doc_id"), FOLDS, HELD_OUT)).select("text")
    total, words = _vocabulary(texts, folder, shards)
    trie = Trie(total, [words])
    while total and len(trie.levels) < order:
        trie.levels.append(_grams(texts, trie, len(trie.levels) + 1, folder, shards))
    return trie


def score(trie: Trie, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each text: tokens, known tokens, the base model's and the trie's log10 probability."""
    h, bounds = tokens(data, offsets)
    first = _firsts(bounds)
    ids, counts = trie.vocabulary(h)
    base = (counts + 0.1) / (trie.total + 0.1 * (trie.words + 1))
    chance, node = base.copy(), ids
    for n in range(2, len(trie.levels) + 1):
        node, share, left = trie.children(n, _before(node, first), ids)
        chance = share + left * chance
    total = lambda x: np.add.reduceat(x, first) if len(first) else np.empty(0)  # noqa: E731  each text has a token
    return [np.diff(bounds), total((counts > 0).astype(np.int64)), total(np.log10(base)), total(np.log10(chance))]


FIELDS = [T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())]


def scored(docs: DataFrame, trie: Trie) -> DataFrame:
    """``doc_id`` and FIELDS of every whole text."""

    def run(batches):
        for batch in slices(batches, limit=SLICE):
            columns = score(trie, *text_bytes(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names=["doc_id", *(f.name for f in FIELDS)])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, T.StructType([T.StructField("doc_id", T.LongType()), *FIELDS]))


def scoring_report(docs: DataFrame, order: int = ORDER) -> DataFrame:
    trie = train(docs, order)
    return scored(docs, trie).select(
        "doc_id", is_fold(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "n_tokens", "n_known",
        F.lit(trie.total).cast("long").alias("train_tokens"), "base_score", "score",
    )

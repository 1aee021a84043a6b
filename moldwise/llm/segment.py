"""Sampled SentencePiece segmentations: Gumbel top-k without replacement by perturbed A* search over the lattice.

The pieces of a public model span a lattice over a text's bytes (a blank is the
model's blank mark; a character without a piece goes byte by byte).  A piece's
weight falls as one over its rank in the vocabulary, and a segmentation's
probability is the product of its weights, normalised over the whole lattice.

The tree of partial segmentations is searched from the root, which has a
standard Gumbel key.  A path down the tree takes one edge after another by its
probability and keeps its key; what it leaves aside at each step, the other
edges there, is a region of known mass, whose best key is a Gumbel of that
mass cut off at the path's key.  The region with the best key is opened next.
So a text's first k paths are its k best perturbed segmentations, distinct by
construction, and the best key left over gives each its inclusion score, the
logarithm of the chance that it is among the k at that threshold.

Pieces never reach across the start of a blank, so the lattice is solved once
for each distinct word of a slice and walks go word by word, for all texts of
the slice at once.  Draws come from a counter hashed with the row's id: the
same row gets the same samples wherever it is handled.

Null and empty texts have one segmentation, without pieces.  Repeated rows get
the same samples; rows without an id share a seed.
"""

from __future__ import annotations

import heapq
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moldwise.llm.textbytes import U64, expand, mix, prefix_sums, run_hashes, slices, text_bytes

BLANK = "▁"
BEGIN = 5  # bytes of a text that must begin some longer piece before longer ones are looked up
SLICE = 3 << 18  # bytes of text that a task searches at once
LOOK = 20


@dataclass(frozen=True)
class Pieces:
    """Bytes and log weight of each id; sorted hashes of the ordinary pieces by length, and of how long ones begin; ids of the 256 bytes."""

    data: np.ndarray
    start: np.ndarray
    size: np.ndarray
    weight: np.ndarray
    by_size: dict[int, tuple[np.ndarray, np.ndarray]]
    begins: np.ndarray
    of_byte: np.ndarray
    may: np.ndarray  # by the first LOOK bits of a hash: whether a piece has them
    may_begin: np.ndarray


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    texts, ordinary, of_byte = [], [], np.zeros(256, np.int64)
    for i in range(n):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            of_byte[int(piece[3:5], 16)] = i
            texts.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            texts.append(b"")
        else:
            text = piece.replace(BLANK, " ").encode()
            if b" " in text.lstrip(b" "):
                raise ValueError(f"piece {i} reaches across a blank")
            texts.append(text)
            ordinary.append(i)
    size = np.array([len(t) for t in texts])
    start = np.cumsum(size) - size
    data = np.frombuffer(b"".join(texts), np.uint8)
    rank = np.full(n, len(ordinary), float)
    order = sorted(ordinary, key=lambda i: (-model.get_score(i), i))
    rank[order] = np.arange(len(order))
    weight = -np.log(rank + 10)
    ids = np.array(ordinary)
    h = run_hashes(data, start[ids], start[ids] + size[ids], 2)
    by_size = {}
    for length in np.unique(size[ids]):
        mine = ids[size[ids] == length]
        some = h[size[ids] == length]
        at = np.argsort(some)
        by_size[int(length)] = (some[at], mine[at].astype(np.int32))
    long = ids[size[ids] > BEGIN]
    begins = np.unique(run_hashes(data, start[long], start[long] + BEGIN, 2))
    may, may_begin = np.zeros(1 << LOOK, bool), np.zeros(1 << LOOK, bool)
    may[_look(h)] = True
    may_begin[_look(begins)] = True
    return Pieces(data, start, size, weight - np.log(np.exp(weight).sum()), by_size, begins, of_byte, may, may_begin)


def _look(h: np.ndarray) -> np.ndarray:
    return (h >> U64(64 - LOOK)).view(np.int64)


class Lattice:
    """Edges of the distinct words of a slice, by position, with the chance of each where it begins."""

    def __init__(self, pieces: Pieces, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        size = end - start
        self.end = np.cumsum(size)
        self.begin = self.end - size
        raw = data[expand(start, size)]
        n = len(raw)
        stop = np.repeat(self.end, size)
        total = prefix_sums(raw, 2)
        at, length, piece = [], [], []
        have = np.zeros(n, np.uint8)  # bytes of a character's own piece
        spots, narrowed = np.arange(n), False
        for step, (keys, ids) in sorted(pieces.by_size.items()):
            if step > BEGIN and not narrowed:
                spots, narrowed = spots[spots + BEGIN <= stop[spots]], True
                h = run_hashes(raw, spots, spots + BEGIN, 2, total)
                some = pieces.may_begin[_look(h)]
                spots, h = spots[some], h[some]
                spots = spots[pieces.begins[np.minimum(np.searchsorted(pieces.begins, h), len(pieces.begins) - 1)] == h]
            spots = spots[spots + step <= stop[spots]] if len(spots) else spots
            h = run_hashes(raw, spots, spots + step, 2, total)
            some = pieces.may[_look(h)]  # few others are searched for
            place, h = spots[some], h[some]
            key = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = keys[key] == h
            at.append(place[hit].astype(np.int32))
            length.append(np.full(int(hit.sum()), step, np.int32))
            piece.append(ids[key[hit]])
            if step <= 4:
                have[place[hit]] |= 1 << step
        lead = (raw & 0xC0) != 0x80
        width = np.select([raw < 0x80, raw < 0xE0, raw < 0xF0], [1, 2, 3], 4)
        unknown = lead & ((have >> width) & 1 == 0)
        first = np.maximum.accumulate(np.where(lead, np.arange(n), 0)) if n else np.arange(0)
        lone = np.flatnonzero(unknown[first]) if n else first
        at.append(lone.astype(np.int32))
        length.append(np.ones(len(lone), np.int32))
        piece.append(pieces.of_byte[raw[lone]].astype(np.int32))
        at, length, piece = at[-2::-1] + at[-1:], length[-2::-1] + length[-1:], piece[-2::-1] + piece[-1:]  # long ones first: mostly the likelier
        self.at, self.piece = np.concatenate(at), np.concatenate(piece)
        order = np.argsort(self.at, kind="stable")
        self.at, self.piece = self.at[order], self.piece[order]
        self.to = self.at + np.concatenate(length)[order]
        del at, length, piece, order, total, spots
        self.first = np.searchsorted(self.at, np.arange(n + 1))
        weight = pieces.weight[self.piece]
        some = np.diff(self.first) > 0  # inside a character with a piece of its own nothing begins
        # log of all completions' mass, from the words' ends backwards; a word's end is a position of its own
        left = stop - np.arange(n)
        mass = np.zeros(n + 1)
        order = np.argsort(left.astype(np.int16 if n and left.max() < 1 << 15 else np.int64), kind="stable")
        bounds = np.flatnonzero(np.append(True, left[order][1:] != left[order][:-1])) if n else np.empty(0, np.int64)
        last = np.repeat(self.end, np.diff(np.append(self.first[self.begin], len(self.at)))) if n else np.empty(0)
        closed = self.to == last
        for k, begin in enumerate(bounds):
            here = order[begin : bounds[k + 1] if k + 1 < len(bounds) else n]
            here = here[some[here]]
            if not len(here):
                continue
            count = self.first[here + 1] - self.first[here]
            e = expand(self.first[here], count)
            after = np.where(closed[e], 0.0, mass[np.minimum(self.to[e], n)])
            mass[here] = np.logaddexp.reduceat(weight[e] + after, np.cumsum(count) - count)
        self.log = np.minimum(weight + np.where(closed, 0.0, mass[np.minimum(self.to, n)]) - mass[self.at], 0.0)
        self.closed = closed
        chance = np.exp(self.log)
        run = np.cumsum(chance)
        before = np.repeat((run - chance)[self.first[:-1][some]], np.diff(self.first)[some])
        self.upto = run - before  # chance of an edge and those before it at its position

    def take(self, at: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edge at each position that a uniform number picks."""
        e, last = self.first[at], self.first[at + 1] - 1
        on = np.flatnonzero((self.upto[e] <= u) & (e < last))
        while len(on):
            e[on] += 1
            next_ = e[on]
            on = on[(self.upto[next_] <= u[on]) & (next_ < last[on])]
        return e

    def walk(self, word: np.ndarray, at: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Edges from given positions to the ends of their words, word after word, and how many each has."""
        count = np.zeros(len(word), np.int64)
        who, seen, step = np.arange(len(word)), [], 0
        at = at.copy()
        while len(who):
            e = self.take(at, uniform(seed[who] + U64(step * 0xA24BAED4963EE407 & (1 << 64) - 1)))
            seen.append((who, e))
            count[who] += 1
            go = ~self.closed[e]
            who, at, step = who[go], self.to[e[go]], step + 1
        start = np.cumsum(count) - count
        out = np.empty(int(count.sum()), np.int64)
        for step, (who, e) in enumerate(seen):
            out[start[who] + step] = e
        return out, count


def uniform(counter: np.ndarray) -> np.ndarray:
    return ((mix(counter) >> U64(11)).astype(float) + 0.5) * 2.0**-53


def cut_gumbel(mass: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel variables of the given log masses, cut off above ``bound``."""
    with np.errstate(divide="ignore", over="ignore"):
        return mass - np.log(np.exp(np.minimum(mass - bound, 700.0)) - np.log(u))


@dataclass
class Path:
    edges: np.ndarray
    word: np.ndarray  # which word of the text each edge is of
    logs: np.ndarray
    key: float


def _regions(doc: int, path: Path, after: int, seed: int, j: int, k: int) -> list[tuple]:
    """The k best regions that a path leaves aside, from step ``after`` on: (-key, text, path, step, edges taken there)."""
    logs = path.logs[after:]
    if not len(logs):
        return []
    before = np.cumsum(path.logs) - path.logs
    with np.errstate(divide="ignore"):
        mass = before[after:] + np.log(-np.expm1(logs))
    counter = np.arange(after, len(path.logs), dtype=U64) * U64(0x9FB21C651E98DF25) + U64((seed ^ (j + 1) * 0xD1B54A32D192ED03) & (1 << 64) - 1)
    key = np.where(np.isfinite(mass), cut_gumbel(mass, np.full(len(mass), path.key), uniform(counter)), -np.inf)
    best = np.argpartition(-key, min(k, len(key) - 1))[:k]
    return [(-key[i], doc, j, after + int(i), (int(path.edges[after + i]),)) for i in best.tolist() if key[i] > -np.inf]


class Sampler:
    """All texts of a slice: their words, lattice, and the search of each."""

    def __init__(self, pieces: Pieces, data: np.ndarray, offsets: np.ndarray, seeds: np.ndarray) -> None:
        self.pieces, self.seeds = pieces, seeds
        size = np.diff(offsets)
        some = size > 0
        self.offsets = np.append(0, np.cumsum(size + some))  # a blank before each text that isn't empty
        self.data = np.full(int(self.offsets[-1]), 0x20, np.uint8)
        self.data[np.arange(len(data)) + np.repeat(np.cumsum(some), size)] = data
        blank = self.data == 0x20
        begin = blank.copy()
        begin[1:] &= ~blank[:-1]
        begin[self.offsets[:-1][some]] = True
        start = np.flatnonzero(begin)
        end = np.append(start[1:], len(self.data))[: len(start)]
        h = run_hashes(self.data, start, end, 2)
        _, first, self.word = np.unique(h, return_index=True, return_inverse=True)
        self.lattice = Lattice(pieces, self.data, start[first], end[first])
        self.at = np.searchsorted(start, self.offsets)
        self.text = np.repeat(np.arange(len(size)), np.diff(self.at))

    def _seed(self, words: np.ndarray, j: int) -> np.ndarray:
        text = self.text[words]
        order = (words - self.at[text]).astype(U64)
        return mix(self.seeds[text] + U64((j + 1) * 0x8CB92BA72F3D8DD7 & (1 << 64) - 1)) + order * U64(0xE7037ED1A0B428DB)

    def _walked(self, words: np.ndarray, at: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray]:
        edges, count = self.lattice.walk(self.word[words], at, self._seed(words, j))
        return edges, np.repeat(words, count)

    def search(self, k: int) -> tuple[list[list[Path]], list[float]]:
        """Up to k paths of each text, by falling keys, and the best key of what is left."""
        n, log = len(self.seeds), self.lattice.log
        words = np.arange(len(self.word))
        edges, of = self._walked(words, self.lattice.begin[self.word], 0)
        bounds = np.searchsorted(of, self.at)
        root = -np.log(-np.log(uniform(self.seeds ^ U64(0x589965CC75374CC3))))
        paths: list[list[Path]] = []
        heaps: list[list[tuple]] = []
        for i in range(n):
            e = edges[bounds[i] : bounds[i + 1]]
            paths.append([Path(e, of[bounds[i] : bounds[i + 1]], log[e], float(root[i]))])
            heaps.append(sorted(_regions(i, paths[i][0], 0, int(self.seeds[i]), 0, k)))
        for j in range(1, k):
            opened = [(i, heapq.heappop(heaps[i])) for i in range(n) if heaps[i] and len(paths[i]) == j]
            if not opened:
                break
            heads, todo, spots = [], [], []
            for i, (key, _, source, step, taken) in opened:
                path = paths[i][source]
                edge, rest = self._sibling(int(path.edges[step]), taken, int(self.seeds[i]), j)
                heads.append((i, -key, source, step, taken, edge, rest))
                word = int(path.word[step])
                later = np.arange(word + 1, self.at[i + 1])
                inside = not self.lattice.closed[edge]
                todo.append(np.append(word, later) if inside else later)
                spots.append(np.append(self.lattice.to[edge], self.lattice.begin[self.word[later]]) if inside else self.lattice.begin[self.word[later]])
            edges, of = self._walked(np.concatenate(todo), np.concatenate(spots), j)
            bounds = np.searchsorted(self.text[of], [i for i, _ in opened] + [n])
            for (i, key, source, step, taken, edge, rest), a, b in zip(heads, bounds[:-1], bounds[1:]):
                old = paths[i][source]
                e = np.concatenate([old.edges[:step], [edge], edges[a:b]])
                path = Path(e, np.concatenate([old.word[: step + 1], of[a:b]]), log[e], key)
                paths[i].append(path)
                for region in _regions(i, path, step + 1, int(self.seeds[i]), j, k):
                    heapq.heappush(heaps[i], region)
                if rest > 1e-15:  # what is still left of the opened region
                    mass = float(old.logs[:step].sum() + np.log(rest))
                    u = uniform(np.array([int(self.seeds[i]) + (j + 1) * 0x2545F4914F6CDD1D & (1 << 64) - 1], U64))
                    best = float(cut_gumbel(np.array([mass]), np.array([key]), u)[0])
                    heapq.heappush(heaps[i], (-best, i, source, step, (*taken, edge)))
        return paths, [-h[0][0] if h else -np.inf for h in heaps]

    def _sibling(self, edge: int, taken: tuple, seed: int, j: int) -> tuple[int, float]:
        """Another edge from where ``edge`` begins, none of ``taken``, and the chance left to the others."""
        spot = self.lattice.at[edge]
        e = np.arange(self.lattice.first[spot], self.lattice.first[spot + 1])
        e = e[~np.isin(e, taken)]
        chance = np.exp(self.lattice.log[e])
        u = uniform(np.array([seed + (j + 1) * 0x9E6C63D0876A9A47 & (1 << 64) - 1], U64))[0]
        pick = min(int(np.searchsorted(np.cumsum(chance), u * chance.sum(), "right")), len(e) - 1)
        return int(e[pick]), float(max(0.0, chance.sum() - chance[pick]) if len(e) > 1 else 0.0)

    def spelled(self, paths: list[Path | None]) -> np.ndarray:
        """Whether the pieces of each text's path (None: no path) spell the text with its blank."""
        edges = [p.edges if p else np.empty(0, np.int64) for p in paths]
        ids = self.lattice.piece[np.concatenate(edges)]
        bounds = np.append(0, np.cumsum([len(e) for e in edges]))
        ends = np.append(0, np.cumsum(self.pieces.size[ids]))[bounds]
        same = np.diff(ends) == np.diff(self.offsets)
        mine = expand(self.offsets[:-1][same], np.diff(self.offsets)[same])
        drawn = self.pieces.data[expand(self.pieces.start[ids], self.pieces.size[ids])][expand(ends[:-1][same], np.diff(ends)[same])]
        wrong = np.append(0, np.cumsum(drawn != self.data[mine]))
        at = np.append(0, np.cumsum(np.diff(ends)[same]))
        same[same] = wrong[at[1:]] == wrong[at[:-1]]
        return same

    def ids(self, path: Path) -> np.ndarray:
        return self.lattice.piece[path.edges]


def decode(pieces: Pieces, ids: np.ndarray) -> bytes:
    """The text of a row of ids, without the blank before it."""
    return pieces.data[expand(pieces.start[ids], pieces.size[ids])].tobytes()[1:]


def log_inclusion(log: float, threshold: float) -> float:
    """Log of the chance that a segmentation's key is over the threshold."""
    x = log - threshold
    return x if x < -30 else float(np.log(-np.expm1(-np.exp(min(x, 700.0)))))


FIELDS = [
    T.StructField("sample", T.IntegerType()), T.StructField("n_pieces", T.LongType()), T.StructField("log_prob", T.DoubleType()),
    T.StructField("key", T.DoubleType()), T.StructField("log_inclusion", T.DoubleType()), T.StructField("decoded", T.BooleanType()),
]


def segmentations(docs: DataFrame, path: str, k: int = 2, seed: int = 0, with_ids: bool = True) -> DataFrame:
    """Up to ``k`` sampled segmentations of every whole text: ``doc_id``, FIELDS, and the ids.

    ``decoded`` says that the ids give back the text.  The ids are an array
    (``ids``), or with ``with_ids=False`` their checksum (``ids_crc32``, of
    little-endian 32-bit integers).
    """
    last = T.StructField("ids", T.ArrayType(T.IntegerType())) if with_ids else T.StructField("ids_crc32", T.LongType())
    names = ["doc_id", *(f.name for f in FIELDS), last.name]

    def run(batches):
        pieces = load(path)
        for batch in slices(batches, limit=SLICE):
            data, offsets = text_bytes(batch.column(1))
            sampler = Sampler(pieces, data, offsets, mix(batch.column(2).to_numpy().view(U64) + U64(seed)))
            paths, left = sampler.search(k)
            decoded = [sampler.spelled([p[j] if j < len(p) else None for p in paths]).tolist() for j in range(max(map(len, paths), default=0))]
            out: list[list] = [[] for _ in names]
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                for j, p in enumerate(paths[i]):
                    ids, log = sampler.ids(p), float(p.logs.sum())
                    end = ids.astype(np.int32) if with_ids else zlib.crc32(ids.astype("<u4").tobytes())
                    for column, value in zip(out, (doc_id, j, len(ids), log, p.key, log_inclusion(log, left[i]), decoded[j][i], end)):
                        column.append(value)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_(), pa.list_(pa.int32()) if with_ids else pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("doc_id").alias("row_key"))
    return rows.mapInArrow(run, T.StructType([T.StructField("doc_id", T.LongType()), *FIELDS, last]))


def segmentation_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return segmentations(docs, path, with_ids=False)

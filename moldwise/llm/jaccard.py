"""N-gram Jaccard join by PartEnum signatures, and the components of its links.

A document's set holds its distinct five-word shingles (64-bit hashes).  Two
sets link when 100 * intersection >= 75 * union, so their symmetric difference
is at most a seventh of the sum of their sizes.  Sizes fall into bands; a pair
meets in the band of the smaller set, where sizes up to a third over the
band's end take part as well.  In a band with largest difference k the feature
domain is hashed into more than k partitions: a linked pair agrees on at least
one whole partition.  The signature of a partition is a hash of what the set
has there.  A set that fills more partitions than its largest difference also
agrees with each partner on one that isn't empty; only sets that don't, sign
their empty partitions too.  So every linked pair shares a signature.

Sets alike in every shingle are one class (a 64-bit fingerprint).  Of the
classes with one signature all are compared with the smallest.  Components of
these links leave few pairs open: those of different components that share a
signature.  Of these each class is compared with the one that looks nearest
first, and, after the components have grown by the links found, with all that
are still open, in blocks where a signature has very many classes.  The links
of all rounds make the components.  Before sets are
compared, a parity bitmap of each (two to four bits a shingle) shows a lower
bound of the difference, which turns away unlike pairs.

Null and empty texts have an empty set and link with nothing; a text of fewer
than five words is one shingle of them all.  Repeated rows are in one class.
Rows without an id get the component's smallest id, or null alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moldwise.llm.components import components
from moldwise.llm.textbytes import SPACED, U64, Words, expand, grams, mix, release, slices, text_bytes
from moldwise.session import freed_shuffles, reliable_checkpoint

SHINGLE = 5
GROWTH, ROOM = 1.6, 1.2  # size of a band's end against its start; partitions for each possible difference
FLUSH = 1 << 20  # signatures that a task gathers before it deals them out
BLOCK = 512  # classes of one signature that are compared at once
PAIRS = 1 << 19  # pairs that a task looks at together
XOR_BYTES = 4 << 20  # of bitmaps that are laid on each other at once
FILTER_LOG2 = 23  # bits of the table that picks candidate documents out of a scan


def _bands() -> list[tuple[int, int]]:
    out, at = [], 1
    while at < 1 << 40:
        to = int(at * GROWTH)
        out.append((at, to))
        at = to + 1
    return out


BANDS = _bands()
_STARTS = np.array([a for a, _ in BANDS])


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted set of each text."""
    words = Words(data, offsets, SPACED)
    h = words.hashes() if len(words) else np.empty(0, U64)
    g = grams(h, SHINGLE)
    out = []
    for at, to in zip(words.at[:-1], words.at[1:]):
        if to - at >= SHINGLE:
            out.append(np.unique(g[at : to - SHINGLE + 1]))
        else:
            out.append(grams(h[at:to], int(to - at)) if to > at else np.empty(0, U64))
    return out


def fingerprint(values: np.ndarray) -> int:
    """A 64-bit name of a set, as a signed integer."""
    with np.errstate(over="ignore"):
        total = np.add.reduce(mix(values + U64(0x5851F42D4C957F2D)), dtype=U64)
    return int(mix(np.array([total + U64(len(values))], U64)).view(np.int64)[0])


def parity(values: np.ndarray) -> bytes:
    """A bitmap of the set, two to four bits a feature: bit by bit the parity of the features hashed to it."""
    log2 = max(6, int(len(values) - 1).bit_length() + 1)
    bits = np.bincount((mix(values ^ U64(0xA0761D6478BD642F)) >> U64(64 - log2)).astype(np.int64), minlength=1 << log2) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def folded(bitmap: bytes, size: int) -> np.ndarray:
    """A bitmap brought down to ``size`` bytes: a hash's first bits choose the place, so neighbouring bits fold into one."""
    x = np.frombuffer(bitmap, np.uint8)
    return x if len(x) == size else np.packbits(np.bitwise_xor.reduce(np.unpackbits(x).reshape(size * 8, -1), axis=1))


def differences(one: bytes, others: list[bytes]) -> np.ndarray:
    """Lower bounds of the symmetric differences of one set and others."""
    size = [min(len(one), len(other)) for other in others]
    return np.array([int(np.bitwise_count(folded(one, n) ^ folded(other, n)).sum()) for n, other in zip(size, others)], np.int64)


class Bitmaps:
    """Bitmaps of several sets, each also folded to the smaller sizes that occur among them."""

    def __init__(self, bitmaps: list[bytes]) -> None:
        self.size = np.array([len(b) for b in bitmaps], np.int64)
        self.rows: dict[int, np.ndarray] = {}
        self.at: dict[int, np.ndarray] = {}  # row of each set in the table of a size
        larger, who = np.empty((0, 0), np.uint8), np.empty(0, np.int64)
        for n in sorted(set(self.size.tolist()), reverse=True):
            while len(who) and larger.shape[1] > n:
                bits = np.unpackbits(larger, axis=1)
                larger = np.packbits(bits[:, ::2] ^ bits[:, 1::2], axis=1)
            own = np.flatnonzero(self.size == n)
            rows = np.frombuffer(b"".join(bitmaps[i] for i in own), np.uint8).reshape(-1, n)
            larger, who = np.concatenate([larger.reshape(-1, n), rows]), np.concatenate([who, own])
            self.rows[n] = np.ascontiguousarray(larger).view(U64)
            self.at[n] = np.full(len(bitmaps), -1)
            self.at[n][who] = np.arange(len(who))

    def differences(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lower bounds of the differences of paired sets."""
        out, least = np.empty(len(i), np.int64), np.minimum(self.size[i], self.size[j])
        for n in np.unique(least).tolist():
            mine = np.flatnonzero(least == n)
            rows, at = self.rows[n], self.at[n]
            step = max(1, XOR_BYTES // n)
            for k in range(0, len(mine), step):
                some = mine[k : k + step]
                out[some] = np.bitwise_count(rows[at[i[some]]] ^ rows[at[j[some]]]).sum(axis=1)
        return out


def possible(n: int, others: np.ndarray) -> np.ndarray:
    """Largest symmetric difference of linked sets of these sizes; -1 where sizes alone forbid a link."""
    small, large = np.minimum(n, others), np.maximum(n, others)
    return np.where(4 * small >= 3 * large, (small + large) // 7, -1)


def signatures(values: np.ndarray) -> np.ndarray:
    """The signatures of a set, for its band and, if it may be a larger partner there, the band before."""
    n, out = len(values), []
    own = int(np.searchsorted(_STARTS, n, "right")) - 1
    for band in (own, own - 1):
        if band < 0:
            continue
        end = BANDS[band][1]
        if band < own and n > 4 * end // 3:
            continue
        parts = int(ROOM * ((end + 4 * end // 3) // 7 + 1)) + 1
        salt = U64(0x9E3779B97F4A7C15 * (band + 1) & (1 << 64) - 1)
        mixed = mix(values ^ salt)
        place = ((mixed >> U64(32)) * U64(parts) >> U64(32)).astype(np.int64)
        content = np.zeros(parts, U64)
        np.add.at(content, place, mix(mixed + salt))
        filled = np.bincount(place, minlength=parts) > 0
        sign = mix(content + np.arange(parts, dtype=U64) * U64(0xD6E8FEB86659FD93) + salt)
        most = n // 3 if band == own else 2 * n // 7  # the largest difference to a partner met here
        out.append(sign[filled] if filled.sum() > most else sign)
    return np.concatenate(out)


_ROW = "kind int, shard int, doc_id long, n long, fp long, sketch binary, fps binary, counts binary, signs binary"
_TYPES = {"kind": pa.int32(), "shard": pa.int32(), "doc_id": pa.int64(), "n": pa.int64(), "fp": pa.int64(), "sketch": pa.binary(), "fps": pa.binary(), "counts": pa.binary(), "signs": pa.binary()}


def _batch(size: int, types: dict, /, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[k], t) if k in columns else pa.nulls(size, t) for k, t in types.items()], names=list(types))


def _dealt(fps: list[int], signs: list[np.ndarray], shards: int) -> pa.RecordBatch:
    """The signatures gathered so far, one row for each shard: classes, how many signatures each has there, and those (32 bits)."""
    count = np.array([len(s) for s in signs])
    sign = np.concatenate(signs)
    owner = np.repeat(np.arange(len(fps)), count)
    shard = ((sign >> U64(32)) * U64(shards) >> U64(32)).astype(np.int64)
    order = np.argsort(shard.astype(np.int32), kind="stable")  # owners stay in order
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    names = np.array(fps, np.int64)
    rows: dict[str, list] = {"shard": [], "fps": [], "counts": [], "signs": []}
    for s in range(shards):
        mine = order[bounds[s] : bounds[s + 1]]
        if len(mine):
            who, times = np.unique(owner[mine], return_counts=True)
            for k, v in (("shard", s), ("fps", names[who].tobytes()), ("counts", times.astype(np.uint32).tobytes()), ("signs", (sign[mine] & U64(0xFFFFFFFF)).astype(np.uint32).tobytes())):
                rows[k].append(v)
    n = len(rows["shard"])
    return _batch(n, _TYPES, kind=[1] * n, **rows)


def _sign(shards: int):
    """Rows of kind 0: a document and its class; of kind 1: signatures for one shard; of kind 2: a class's sketch."""

    def run(batches):
        fps, signs, held = [], [], 0
        for batch in slices(batches):
            sets = shingle_sets(*text_bytes(batch.column(1)))
            names = [fingerprint(s) if len(s) else None for s in sets]
            yield _batch(len(sets), _TYPES, kind=[0] * len(sets), shard=[i % shards for i in range(len(sets))], doc_id=batch.column(0), n=[len(s) for s in sets], fp=names)
            seen: dict[int, np.ndarray] = {}
            for name, s in zip(names, sets):
                if name is not None:
                    seen.setdefault(name, s)
            yield _batch(len(seen), _TYPES, kind=[2] * len(seen), shard=[name % shards for name in seen], n=[len(s) for s in seen.values()], fp=list(seen), sketch=[parity(s) for s in seen.values()])
            for name, s in seen.items():
                fps.append(name)
                signs.append(signatures(s))
                held += len(signs[-1])
                if held >= FLUSH:
                    yield _dealt(fps, signs, shards)
                    fps, signs, held = [], [], 0
        if fps:
            yield _dealt(fps, signs, shards)

    return run


_MET = {"kind": pa.int32(), "doc_id": pa.int64(), "n": pa.int64(), "fp": pa.int64(), "sketch": pa.binary(), "other": pa.int64(), "bucket": pa.int64()}


def _meet(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """One shard: documents and sketches as they came; kind 3: a class and the smallest one with the same signature; kind 4: the classes of a signature of three or more."""
    kind = rows.column("kind").to_numpy()
    plain = rows.filter(pa.array(kind != 1)).select(["kind", "doc_id", "n", "fp", "sketch"])
    out = [plain.append_column("other", pa.nulls(len(plain), pa.int64())).append_column("bucket", pa.nulls(len(plain), pa.int64())).cast(pa.schema(list(_MET.items())))]
    parts = rows.filter(pa.array(kind == 1))
    if len(parts):
        get = lambda name, kind: [np.frombuffer(b, kind) for b in parts.column(name).to_pylist()]
        fp = np.repeat(np.concatenate(get("fps", np.int64)), np.concatenate(get("counts", np.uint32)))
        sign = np.concatenate(get("signs", np.uint32))
        order = np.argsort(sign, kind="stable")
        sign, fp = sign[order], fp[order]
        several = np.zeros(len(sign), bool)
        several[1:] = sign[1:] == sign[:-1]
        several[:-1] |= several[1:].copy()
        sign, fp = sign[several], fp[several]
        order = np.lexsort((fp, sign))
        sign, fp = sign[order], fp[order]
        new = np.ones(len(sign), bool)
        new[1:] = (sign[1:] != sign[:-1]) | (fp[1:] != fp[:-1])
        sign, fp = sign[new], fp[new]
        if len(sign):
            start = np.flatnonzero(np.append(True, sign[1:] != sign[:-1]))
            size = np.diff(np.append(start, len(sign)))
            least = np.repeat(fp[start], size)
            pairs = np.unique(np.stack([least, fp], 1)[least != fp], axis=0)
            if len(pairs):
                out.append(pa.Table.from_batches([_batch(len(pairs), _MET, kind=np.full(len(pairs), 3), fp=pairs[:, 1], other=pairs[:, 0])]))
            name = np.add.reduceat(mix(fp.view(U64)), start)
            many = np.flatnonzero(size > 2)
            many = many[np.unique(name[many], return_index=True)[1]]  # the same classes meet under many signatures
            if len(many):
                take = np.repeat(start[many], size[many]) + (np.arange(size[many].sum()) - np.repeat(np.cumsum(size[many]) - size[many], size[many]))
                out.append(pa.Table.from_batches([_batch(len(take), _MET, kind=np.full(len(take), 4), fp=fp[take], bucket=np.repeat(name[many].view(np.int64), size[many]))]))
    return pa.concat_tables(out)


_MET_SCHEMA = "kind int, doc_id long, n long, fp long, sketch binary, other long, bucket long"


def _near(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that sizes and parity bitmaps allow to link."""

    def run(batches):
        for batch in batches:
            na, nb = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            a, b = batch.column(3).to_pylist(), batch.column(5).to_pylist()
            most = possible(na, nb)
            keep = [i for i in np.flatnonzero(most >= 0) if differences(a[i], [b[i]])[0] <= most[i]]
            yield batch.take(pa.array(keep, pa.int64())).select([0, 1])

    one = sketches.select(F.col("fp").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    two = sketches.select(F.col("fp").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "na", "sa", "nb", "sb").mapInArrow(run, "a long, b long")


def _sets_of(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(fp, values): the sets of the wanted classes, from one more scan of the texts.

    A table of 2**FILTER_LOG2 bits tells the scan which ids may be wanted (a
    bounded broadcast; others that it lets through are dropped by the join).
    """
    ids = classes.join(wanted, "fp", "left_semi").groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_LOG2))
    words = ids.select(spot.alias("spot")).select(F.shiftright("spot", 5).alias("word"), F.expr("shiftleft(1L, int(spot % 32))").alias("bit"))
    table = np.zeros(1 << (FILTER_LOG2 - 5), np.uint32)
    got = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table[got.column("word").to_numpy()] = got.column("bits").to_numpy().astype(np.uint32)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        table = shared.value
        for batch in batches:
            spot = batch.column(1).to_numpy()
            some = batch.filter(pa.array((table[spot >> 5] >> (spot % 32).astype(np.uint32)) & 1 == 1))
            for part in slices([some]):
                sets = [s for s in shingle_sets(*text_bytes(part.column(0))) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([fingerprint(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["fp", "values"])

    found = docs.select("text", F.coalesce(spot, F.lit(0)).alias("spot")).mapInArrow(run, "fp long, values binary")
    return found.join(wanted, "fp", "left_semi").groupBy("fp").agg(F.first("values").alias("values"))


def _linked(docs: DataFrame, classes: DataFrame, near: DataFrame) -> DataFrame:
    """The pairs whose sets link, counted exactly."""
    wanted = near.select(F.col("a").alias("fp")).unionByName(near.select(F.col("b").alias("fp"))).distinct()
    sets = reliable_checkpoint(_sets_of(docs, classes, wanted))

    def run(batches):
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
                both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                if 100 * both >= 75 * (len(x) + len(y) - both):
                    keep.append(i)
            yield batch.take(pa.array(keep, pa.int64())).select([0, 1])

    one = sets.select(F.col("fp").alias("a"), F.col("values").alias("xa"))
    two = sets.select(F.col("fp").alias("b"), F.col("values").alias("xb"))
    return near.join(one, "a").join(two, "b").select("a", "b", "xa", "xb").mapInArrow(run, "a long, b long")


def _open_pairs(buckets: DataFrame, labels: DataFrame, sketches: DataFrame, nearest: bool) -> DataFrame:
    """Pairs of different components in one bucket that may link; buckets of many classes in blocks.

    With ``nearest``, only the pair of each component in each block that looks
    nearest; a bucket without such a row has nothing to compare.
    """
    known = buckets.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    mixed = known.groupBy("bucket").agg(F.count("*").alias("size"), F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    rows = known.join(mixed, "bucket").join(sketches, "fp")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    cells = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select("bucket", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "own", "fp", "label", "n", "sketch")

    def pairs(rows: pa.Table) -> pa.RecordBatch:
        """The pairs of some whole cells (rows in order of cells), and a bucket of each."""
        bucket, one, two, own, fp, label, n = (rows.column(c).to_numpy() for c in ("bucket", "one", "two", "own", "fp", "label", "n"))
        start = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])))
        later = np.repeat(np.append(start[1:], len(fp)), np.diff(np.append(start, len(fp)))) - np.arange(len(fp)) - 1
        bitmaps = Bitmaps(rows.column("sketch").to_pylist())
        found = [[], [], []]
        at = 0
        while at < len(fp):
            to = max(at + 1, int(np.searchsorted(np.cumsum(later[at:]), PAIRS, "right")) + at)
            i = np.repeat(np.arange(at, to), later[at:to])
            j = expand(np.arange(at, to) + 1, later[at:to])
            may = (label[i] != label[j]) & ((one[i] == two[i]) | (own[i] != own[j]))
            i, j = i[may], j[may]
            most = possible(n[i], n[j])
            i, j, most = i[most >= 0], j[most >= 0], most[most >= 0]
            apart = bitmaps.differences(i, j)
            near = apart <= most
            for column, value in zip(found, (i[near], j[near], apart[near] / (n[i] + n[j])[near])):
                column.append(value)
            at = to
        i, j, apart = (np.concatenate(x) for x in found)
        if nearest:  # of each component in a cell, the pair that looks nearest
            cell = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(fp))))
            of, where, pair = np.concatenate([label[i], label[j]]), np.tile(cell[i], 2), np.tile(np.arange(len(i)), 2)
            order = np.lexsort((apart[pair], of, where))
            new = np.ones(len(order), bool)
            new[1:] = (of[order][1:] != of[order][:-1]) | (where[order][1:] != where[order][:-1])
            keep = np.unique(pair[order[new]])
            i, j = i[keep], j[keep]
        both = np.stack([np.minimum(fp[i], fp[j]), np.maximum(fp[i], fp[j]), bucket[i]], 1)
        both = np.unique(both, axis=0) if nearest else both[np.unique(both[:, :2], axis=0, return_index=True)[1]]
        return pa.RecordBatch.from_arrays([pa.array(both[:, k], pa.int64()) for k in range(3)], names=["a", "b", "bucket"])

    def run(batches):
        release()
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows = pa.Table.from_batches(held)
            last = [rows.column(c).to_numpy() for c in ("bucket", "one", "two")]
            same = np.logical_and.reduce([x == x[-1] for x in last])
            whole = len(rows) - int(np.argmin(same[::-1])) if not same.all() else 0  # the last cell may go on
            if whole:
                yield pairs(rows.slice(0, whole))
                held = rows.slice(whole).to_batches()
        if held:
            yield pairs(pa.Table.from_batches(held))

    parts = int(buckets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = cells.repartition(parts, "bucket", "one", "two").sortWithinPartitions("bucket", "one", "two", "fp")
    return ordered.mapInArrow(run, "a long, b long, bucket long")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) of every row of ``docs`` (``doc_id``, ``text``)."""
    return _labelled(docs).drop("label")


def _labelled(docs: DataFrame) -> DataFrame:
    """``jaccard_components`` with the smallest class of each row's component as ``label``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with freed_shuffles(docs.sparkSession):  # each step's shuffles go once its checkpoint is written
        classes, labels = _classes_and_labels(docs)
    by_class = classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = by_class.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    return by_class.join(least, "label", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("fp").alias("class_id"),
        F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"), "label",
    )


def _classes_and_labels(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, fp) of every row, and (node, label) of the classes that have links; both read from checkpoints."""
    spark = docs.sparkSession
    shards = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = reliable_checkpoint(docs.mapInArrow(_sign(shards), _ROW).groupBy("shard").applyInArrow(_meet, _MET_SCHEMA))
    classes = met.where("kind = 0").select("doc_id", "n", "fp")
    sketches = reliable_checkpoint(met.where("kind = 2").groupBy("fp").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    pairs = met.where("kind = 3").select(F.col("other").alias("a"), F.col("fp").alias("b")).distinct()
    links = reliable_checkpoint(_linked(docs, classes, reliable_checkpoint(_near(pairs, sketches))))
    labels = components(links)
    buckets = met.where("kind = 4").select("bucket", "fp").distinct()
    for nearest in (True, False):
        found = reliable_checkpoint(_open_pairs(buckets, labels, sketches, nearest))
        if not found.take(1):
            break  # bitmaps and sizes leave no pair open in any bucket
        links = reliable_checkpoint(links.unionByName(_linked(docs, classes, found.select("a", "b").distinct())))
        labels = components(links)
        buckets = reliable_checkpoint(buckets.join(found.select("bucket").distinct(), "bucket", "left_semi"))
    return classes, labels


def _class_of(docs: DataFrame) -> DataFrame:
    """``docs`` with the class of each row's set (null: empty set) as ``__class``."""
    names = [*docs.columns, "__class"]

    def run(batches):
        for batch in slices(batches):
            sets = shingle_sets(*text_bytes(batch.column(batch.schema.get_field_index("text"))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([fingerprint(s) if len(s) else None for s in sets], pa.int64())], names=names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("__class", T.LongType())]))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: one of its smallest id, or, if none of its rows has an id, any one.

    Rows with an empty set link with nothing and all stay.  Most rows are told
    by their id alone; only those that share an id, or have none, are looked at
    again for their class, and of several that could stay the one of the
    smallest text does.
    """
    found = reliable_checkpoint(_labelled(docs.select("doc_id", "text")))
    ids = found.where("doc_id is not null").groupBy("doc_id").agg(
        F.count("*").alias("rows"), F.bool_or(F.col("class_id").isNull() | (F.col("doc_id") == F.col("component_id"))).alias("keep"))
    alone = ids.where("rows = 1 and keep").select(F.col("doc_id").alias("__id"))
    several = ids.where("rows > 1").select(F.col("doc_id").alias("__id"))
    same = F.col("doc_id").cast("long") == F.col("__id")
    kept = docs.join(alone, same, "left_semi")
    odd = _class_of(docs.join(several, same, "left_semi").unionByName(docs.where(F.col("doc_id").isNull())))
    classes = found.where("label is not null").select(F.col("class_id").alias("__class"), F.col("label").alias("__label"), F.col("component_id").alias("__least")).distinct()
    odd = odd.join(classes, "__class", "left").where("__class is null or __least is null or doc_id = __least")
    # one row a component: the first by text, found map-side before the shuffle
    one = Window.partitionBy("__label").orderBy(F.xxhash64("text"), "text")
    chosen = odd.where("__class is not null").withColumn("__n", F.row_number().over(one)).where("__n = 1")
    return kept.unionByName(chosen.select(*docs.columns)).unionByName(odd.where("__class is null").select(*docs.columns))


#: Pairs of classes that share a shingle, by distinct sets; labels spread along links until they rest.
ORACLE_SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') as g from w, range(1, len(w) - least(len(w), 5) + 2) t(i) where len(w) > 0),
n as (select doc_id, count(*) as n from s group by doc_id),
pairs as (select x.doc_id as a, y.doc_id as b, count(*) as common from s x join s y on x.g = y.g and x.doc_id < y.doc_id group by all),
links as (select a, b from pairs join n na on a = na.doc_id join n nb on b = nb.doc_id where 100 * common >= 75 * (na.n + nb.n - common)),
ways as (select a, b from links union select b, a from links),
reach(doc_id, to_id) as (select a, a from ways union select r.doc_id, ways.b from reach r join ways on r.to_id = ways.a)
select w.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(c.least, w.doc_id) as component_id
from w left join n using (doc_id) left join (select doc_id, min(to_id) as least from reach group by doc_id) c using (doc_id)
"""

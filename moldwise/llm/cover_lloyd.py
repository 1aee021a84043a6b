"""Codes of vector parts by Lloyd rounds over partition-local cover trees.

Components become integers floor(scale * x) and vectors are cut into equal
parts.  Each task builds, once, a cover tree for each part position over some
thousand of its rows: a node's children lie within half its cover radius and
siblings lie farther apart than that, the points of a node are consecutive, and
cumulative sums give the sum of any node's points.  A round goes down the trees
level by level: by the triangle inequality an entry farther from a node's
centre than the nearest entry by more than twice the node's radius is nearest
to none of its points, and a node with one entry left is assigned whole.  Only
what is ambiguous descends, at last to exact comparisons of points.

All distances are integers; roots are only used to rule entries out, with a
margin.  Trees are written to the shared folder once and read by each round;
a round returns one row a part and entry.

Rows whose vector is null or holds null or non-finite components take no part,
nor do those whose length isn't a positive multiple of the parts, or isn't that
of the first row that is left (smallest id).  Components are held within
+-2**28 (x of +-65,536 at scale 4096; less where a part has over 8 components),
so squares add up exactly.  Rows without
an id come last in the order of ids, equal ids go by their components; repeated
rows count each.  Fewer rows than entries give fewer entries.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moldwise.session import checkpoint_dir

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
CHUNK_BYTES = 4 << 20  # of a chunk's components; a chunk has one tree a part
LEAF = 8
STEP = 1 << 15  # nodes or points that are compared at once


def held(width: int) -> int:
    """The largest component (a power of two) at which squared distances of parts of ``width`` components fit 63 bits."""
    return 1 << min(28, (60 - (max(width, 1) - 1).bit_length()) // 2)


def integers(x: np.ndarray, width: int, scale: float = SCALE) -> np.ndarray:
    limit = held(width)
    return np.clip(np.floor(x * scale), -limit, limit).astype(np.int32)


def squared(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Squared distances of paired rows."""
    gap = points.astype(np.int64) - others
    return (gap * gap).sum(axis=-1)


@dataclass
class CoverTree:
    points: np.ndarray  # in tree order
    order: np.ndarray  # place of each in its chunk
    low: np.ndarray  # of each node: its points are low to high
    high: np.ndarray
    centre: np.ndarray  # its centre, a place among the points
    radius: np.ndarray  # squared distance of its farthest point
    child: np.ndarray  # first child; children are consecutive
    children: np.ndarray  # how many; 0: a leaf

    @classmethod
    def build(cls, points: np.ndarray) -> CoverTree:
        """Level by level: the nodes of a level are cut at half their radius, all of them at once."""
        n = len(points)
        order = np.arange(n)
        low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
        levels: list[list[np.ndarray]] = []
        nodes = 0
        while len(low):
            size = high - low
            cell = np.repeat(np.arange(len(low)), size)
            place = np.arange(len(cell)) + np.repeat(low - np.append(0, np.cumsum(size)[:-1]), size)
            away = squared(points[order[place]], points[order[low]][cell])  # a node's first point is its centre
            starts = np.append(0, np.cumsum(size)[:-1])
            radius = np.maximum.reduceat(away, starts)
            nodes += len(low)
            split = (size > LEAF) & (radius > 0)
            child, children = np.zeros(len(low), np.int64), np.zeros(len(low), np.int64)
            new_low, new_high = np.empty(0, np.int64), np.empty(0, np.int64)
            if split.any():
                open_cell = split[cell]
                where = place[open_cell]
                group = (np.cumsum(split) - 1)[cell[open_cell]]
                net = _net(points, order[where], group, radius[split])
                sort = np.lexsort((where, net, group))
                order[where] = order[where][sort]  # the rows of a node stay its own
                group, net = group[sort], net[sort]
                first = np.ones(len(group), bool)
                first[1:] = (group[1:] != group[:-1]) | (net[1:] != net[:-1])
                new_low = where[first]
                last = np.append(np.flatnonzero(first)[1:], len(where)) - 1
                new_high = where[last] + 1
                children[split] = np.bincount(group[first], minlength=int(split.sum()))
                child[split] = nodes + np.append(0, np.cumsum(children[split])[:-1])
            levels.append([low, high, radius, child, children])
            low, high = new_low, new_high
        low, high, radius, child, children = (np.concatenate(c) for c in zip(*levels))
        # a node's centre stays its first point: it is the first of its first child, too
        return cls(points[order], order, low, high, low, radius, child, children)

    def assign(self, book: np.ndarray):
        """For runs of points (low, high, entry) that are nearest to one entry of ``book``: all points once."""
        node, left = np.zeros(1, np.int64), np.ones((1, len(book)), bool)
        runs = []
        while len(node):
            next_node, next_left = [], []
            for at in range(0, len(node), STEP):
                mine, mask = node[at : at + STEP], left[at : at + STEP]
                far = np.where(mask, squared(self.points[self.centre[mine]][:, None], book[None]), np.iinfo(np.int64).max)
                best = far.argmin(axis=1)
                reach = np.sqrt(far[np.arange(len(mine)), best].astype(float)) + 2 * np.sqrt(self.radius[mine].astype(float))
                mask = mask & ((np.sqrt(far.astype(float)) <= (reach * (1 + 1e-9) + 1e-6)[:, None]))
                sure = (mask.sum(axis=1) == 1) | (self.radius[mine] == 0)
                runs.append((self.low[mine[sure]], self.high[mine[sure]], best[sure]))
                leaf = ~sure & (self.children[mine] == 0)
                if leaf.any():
                    runs.append(self._points(mine[leaf], mask[leaf], book))
                deeper = ~sure & ~leaf
                count = self.children[mine[deeper]]
                first = self.child[mine[deeper]]
                next_node.append(np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum())))
                next_left.append(np.repeat(mask[deeper], count, axis=0))
            node, left = np.concatenate(next_node), np.concatenate(next_left)
        return tuple(np.concatenate(c) for c in zip(*runs))

    def _points(self, leaf: np.ndarray, mask: np.ndarray, book: np.ndarray):
        """Exact comparisons of the points of ambiguous leaves with the entries that are left."""
        count = self.high[leaf] - self.low[leaf]
        place = np.repeat(self.low[leaf] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        entry = np.empty(len(place), np.int64)
        of = np.repeat(np.arange(len(leaf)), count)
        for at in range(0, len(place), STEP):
            part = slice(at, at + STEP)
            far = squared(self.points[place[part]][:, None], book[None])
            entry[part] = np.where(mask[of[part]], far, np.iinfo(np.int64).max).argmin(axis=1)
        return place, place + 1, entry

    def totals(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many points each entry gets, and their sums, from cumulative sums."""
        running = np.zeros((len(self.points) + 1, self.points.shape[1]), np.int64)
        np.cumsum(self.points, axis=0, out=running[1:])
        low, high, entry = self.assign(book)
        sums = np.zeros((len(book), self.points.shape[1]), np.int64)
        np.add.at(sums, entry, running[high] - running[low])
        count = np.zeros(len(book), np.int64)
        np.add.at(count, entry, high - low)
        return count, sums

    def labels(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each point, in the order of the chunk."""
        low, high, entry = self.assign(book)
        sort = np.argsort(low)
        mine = np.repeat(entry[sort], (high - low)[sort])
        out, error = np.empty(len(mine), np.int64), np.empty(len(mine), np.int64)
        out[self.order] = mine
        error[self.order] = squared(self.points, book[mine])
        return out, error

    FIELDS = ("points", "order", "low", "high", "radius", "child", "children")

    def packed(self) -> list[bytes]:
        return [np.ascontiguousarray(getattr(self, f), "<i8" if f == "radius" else "<i4").tobytes() for f in self.FIELDS]

    @classmethod
    def unpacked(cls, data: list[bytes]) -> CoverTree:
        a = {f: np.frombuffer(d, "<i8" if f == "radius" else "<i4") for f, d in zip(cls.FIELDS, data)}
        wide = {f: a[f].astype(np.int64) for f in cls.FIELDS[1:]}
        return cls(a["points"].reshape(len(a["order"]), -1), centre=wide["low"], **wide)


def _net(points: np.ndarray, rows: np.ndarray, group: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each row the number of its child: greedy centres farther apart than half the radius, each row to the first that covers it.

    ``rows`` are grouped, each group's centre first; one centre of every open
    group is picked at a time.
    """
    net = np.zeros(len(rows), np.int64)
    limit = radius // 4  # (radius / 2) squared
    todo = np.arange(len(rows))
    pick = 0
    while len(todo):
        of = group[todo]
        first = np.ones(len(todo), bool)
        first[1:] = of[1:] != of[:-1]
        centre = np.flatnonzero(first)[np.cumsum(first) - 1]
        near = squared(points[rows[todo]], points[rows[todo[centre]]]) <= limit[of]
        net[todo[near]] = pick
        todo = todo[~near]
        pick += 1
    return net


def whole(vector, parts: int):
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & (F.size(vector) % parts == 0) & finite


@dataclass
class Codebooks:
    entries: np.ndarray  # part x entry x position
    scale: float = SCALE

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


class Trees:
    """The kept rows of ``vectors`` as cover trees in a shared folder, with their ids and labels."""

    def __init__(self, vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, scale: float = SCALE) -> None:
        spark = vectors.sparkSession
        self.parts, self.scale = parts, scale
        kept = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label").where(whole(F.col("embedding"), parts))
        order = [F.asc_nulls_last("vec_id"), F.asc("embedding")]
        first = kept.orderBy(*order).limit(entries).select("embedding").collect()
        self.dim = len(first[0][0]) if first else 0
        if any(len(r[0]) != self.dim for r in first):
            first = kept.where(F.size("embedding") == self.dim).orderBy(*order).limit(entries).select("embedding").collect()
        self.start = integers(np.array([r[0] for r in first], float).reshape(len(first), self.dim), self.dim // parts, scale).astype(np.int64)
        self.folder = f"{checkpoint_dir(spark)}/covertrees-{uuid.uuid4().hex}"
        self.types = [kept.schema["vec_id"].dataType, kept.schema["label"].dataType]
        kept.where(F.size("embedding") == self.dim).mapInArrow(self._builder(), self._schema()).write.parquet(self.folder)
        self.table = spark.read.schema(self._schema()).parquet(self.folder)

    def _schema(self) -> T.StructType:
        lists = [T.StructField(name, T.ArrayType(kind)) for name, kind in zip(("ids", "labels"), self.types)]
        return T.StructType([*lists, *(T.StructField(f, T.ArrayType(T.BinaryType())) for f in CoverTree.FIELDS)])

    def _builder(self):
        dim, parts, scale = self.dim, self.parts, self.scale
        rows = max(LEAF, CHUNK_BYTES // (8 * max(dim, 1)))

        def chunk(table: pa.Table) -> pa.RecordBatch:
            x = integers(table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim), dim // parts, scale)
            trees = [CoverTree.build(part).packed() for part in np.split(x, parts, axis=1)]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), table.column(c).combine_chunks()) for c in ("vec_id", "label")]
            fields = [pa.array([[tree[i] for tree in trees]], pa.list_(pa.binary())) for i in range(len(CoverTree.FIELDS))]
            return pa.RecordBatch.from_arrays([*lists, *fields], names=["ids", "labels", *CoverTree.FIELDS])

        def run(batches):
            held: list[pa.RecordBatch] = []
            for batch in batches:
                while batch.num_rows:
                    room = rows - sum(b.num_rows for b in held)
                    held.append(batch.slice(0, room))
                    batch = batch.slice(room)
                    if sum(b.num_rows for b in held) == rows:
                        yield chunk(pa.Table.from_batches(held))
                        held = []
            if held:
                yield chunk(pa.Table.from_batches(held))

        return run

    def totals(self, books: np.ndarray) -> dict[tuple[int, int], tuple[int, list[int]]]:
        """{(part, entry): (points, sums)}: one row a part and entry comes to the driver."""
        width = books.shape[2]

        def run(batches):
            for batch in batches:
                for packed in zip(*(batch.column(f).to_pylist() for f in CoverTree.FIELDS)):
                    found = [CoverTree.unpacked(list(tree)).totals(books[p]) for p, tree in enumerate(zip(*packed))]
                    count = np.concatenate([c for c, _ in found])
                    sums = np.concatenate([s for _, s in found])
                    names = np.divmod(np.arange(len(count)), books.shape[1])
                    yield pa.RecordBatch.from_arrays([*map(pa.array, (*names, count)), *map(pa.array, sums.T)], names=["part", "entry", "n", *(f"s{i}" for i in range(width))])

        schema = ", ".join(["part long", "entry long", "n long", *(f"s{i} long" for i in range(width))])
        sums = [F.sum(F.col(f"s{i}").cast("decimal(19,0)")).alias(f"s{i}") for i in range(width)]  # whole, however many rows
        rows = self.table.select(*CoverTree.FIELDS).mapInArrow(run, schema).groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect()
        return {(r["part"], r["entry"]): (r["n"], [int(r[f"s{i}"]) for i in range(width)]) for r in rows}

    def lloyd(self, rounds: int = ROUNDS) -> Codebooks:
        """Codebooks that begin with the first rows' parts, after some rounds."""
        books = np.stack(np.split(self.start, self.parts, axis=1)) if self.dim else np.empty((self.parts, 0, 0), np.int64)
        for _ in range(rounds if self.dim else 0):
            for (part, entry), (n, sums) in self.totals(books).items():
                if n:
                    books[part, entry] = [s // n for s in sums]
        return Codebooks(books, self.scale)

    def encoded(self, books: Codebooks) -> DataFrame:
        """(vec_id, label, code, error) of every row."""
        entries = books.entries

        def run(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    packed = [batch.column(f)[i].as_py() for f in CoverTree.FIELDS]
                    found = [CoverTree.unpacked(list(tree)).labels(entries[p]) for p, tree in enumerate(zip(*packed))]
                    code = np.stack([c for c, _ in found], axis=1).astype(np.uint8)
                    error = np.sum([e for _, e in found], axis=0)
                    text = code.tobytes().hex()
                    width = 2 * len(found)
                    codes = [text[at : at + width] for at in range(0, len(text), width)]
                    ids, labels = (batch.column(c).slice(i, 1).flatten() for c in ("ids", "labels"))
                    yield pa.RecordBatch.from_arrays([ids, labels, pa.array(codes, pa.string()), pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

        schema = T.StructType([T.StructField("vec_id", self.types[0]), T.StructField("label", self.types[1]), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
        return self.table.mapInArrow(run, schema)


def code_report(vectors: DataFrame) -> DataFrame:
    trees = Trees(vectors)
    books = trees.lloyd()
    # rows of codes are read twice, for the sums by label and for the result
    codes = f"{trees.folder}-codes"
    trees.encoded(books).write.parquet(codes)
    rows = vectors.sparkSession.read.parquet(codes)
    by_label = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = rows.join(by_label, rows["label"].eqNullSafe(by_label["of"]))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same by comparing every part with every entry, round after round."""
    steps = [f"""
v as (select row_number() over (order by vec_id nulls last, embedding) as r, vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as e
      from embeddings where embedding is not null and len(embedding) > 0 and len(embedding) % {parts} = 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (select r, k as part, e[k * (len(e) // {parts}) + 1 : (k + 1) * (len(e) // {parts})] as x from v, range({parts}) t(k)),
b0 as (select part, r - 1 as entry, x as c from p where r <= {entries})"""]
    nearest = "select r, p.part, any_value(x) as x, min((list_aggregate(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])), 'sum')::bigint, entry)) as near from p join b{} b on p.part = b.part group by r, p.part"
    for i in range(rounds):
        steps.append(f"a{i} as ({nearest.format(i)})")
        steps.append(f"""u{i} as (select part, entry, list(c order by j) as c from (
    select part, near[2] as entry, j, floor_div(sum(x[j + 1]), count(*)) as c from a{i}, range((select max(len(x)) from p)) t(j) group by 1, 2, 3) group by 1, 2)""")
        steps.append(f"b{i + 1} as (select b.part, b.entry, coalesce(u.c, b.c) as c from b{i} b left join u{i} u on b.part = u.part and b.entry = u.entry)")
    steps.append(f"z as ({nearest.format(rounds)})")
    steps.append("""w as (select r, string_agg(lpad(lower(to_hex(near[2])), 2, '0'), '' order by part) as code, sum(near[1])::bigint as error from z group by r)""")
    steps.append(f"h as (select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) as s from b{rounds})")
    body = ",".join(steps).replace("floor_div(sum(x[j + 1]), count(*))", "((sum(x[j + 1]) - (((sum(x[j + 1]) % count(*)) + count(*)) % count(*))) // count(*))::bigint")
    return f"with {body} select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, (select s from h) as codebooks_sha256 from v join w using (r)"


ORACLE_SQL = oracle_sql()

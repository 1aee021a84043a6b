import glob
import hashlib
import os
import random
import tempfile
import time

import numpy as np
import pytest

from moldwise import session
from moldwise.llm import decontaminate, jaccard, nearest
from moldwise.llm.components import components


def words_of(text, pattern=r"[^\x20\x09-\x0D]+"):
    import re

    return re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words_of(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain_components(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None and sets[i]:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted(((doc, len(sets[i]), least.get(root(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)), key=str)


def near_copies(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = " ".join(word() for _ in range(60))
    rows = []
    for size in (3, 6, 12, 40, 150, 400):
        base = [word() for _ in range(size)]
        for k in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, size // 25))):
                copy[rng.randrange(size)] = word()
            rows.append(" ".join(copy))
            base = copy if k % 2 else base  # chains
    rows += [passage + " " + " ".join(word() for _ in range(rng.randint(15, 60))) for _ in range(40)]
    rows += [rows[0]] * 5
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, block", [(1, 512), (2, 4)])
def test_components_equal_plain_version(spark, monkeypatch, seed, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = near_copies(seed)
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).drop("class_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_components(rows)


def test_components_of_odd_texts(spark, edge_docs, edge_rows, no_docs):
    got = jaccard.jaccard_components(edge_docs).drop("class_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_components(edge_rows)
    assert jaccard.jaccard_components(no_docs).count() == 0
    kept = jaccard.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert 0 in ids and 7 not in ids and 8 not in ids and 9 not in ids and {1, 2, 3} <= set(ids) and ids.count(14) == 0 and 4 in ids and None in ids
    assert jaccard.one_of_each(no_docs).count() == 0


def test_shuffles_of_the_join_go_with_their_steps(spark):
    conf = session.FREE_SHUFFLES
    top = os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", None) or tempfile.gettempdir()
    files = lambda: {*glob.glob(f"{top}/**/blockmgr-*/*/shuffle_*.data", recursive=True)}
    docs = spark.createDataFrame(near_copies(4), "doc_id long, text string")
    before, kept = files(), spark.conf.get(conf, None)
    found = jaccard.jaccard_components(docs)  # all steps but the last have run
    until = time.time() + 20  # files are removed in the background
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(conf, None) == kept
    assert found.count() == found.count() == docs.count()


def test_differences_in_small_steps(monkeypatch):
    rng = np.random.default_rng(8)
    bitmaps = [jaccard.parity(np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))) for n in (3, 40, 41, 90, 700, 700, 3000)]
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(bitmaps)), np.arange(len(bitmaps))))
    plain = [jaccard.differences(bitmaps[a], [bitmaps[b]])[0] for a, b in zip(i, j)]
    for limit in (1, 100, 4 << 20):
        monkeypatch.setattr(jaccard, "XOR_BYTES", limit)
        assert jaccard.Bitmaps(bitmaps).differences(i, j).tolist() == plain


def test_one_row_of_each_component(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))

    def near(text):
        words = text.split()
        words[rng.randrange(len(words))] = word()
        return " ".join(words)

    a, b, c, d, e = (" ".join(word() for _ in range(80)) for _ in range(5))
    rows = [(1, a), (1, a), (1, near(a)), (2, a)]  # one id, copies and a near copy
    rows += [(5, b), (5, c), (6, b), (7, c)]  # one id in two components
    rows += [(None, d), (None, d), (None, near(d)), (None, e), (9, e), (None, None), (None, ""), (3, None), (3, None)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, label string, component_id int").repartition(3)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert [i for i, _ in got].count(1) == 1 and sorted(t for i, t in got if i == 5) == sorted([b, c])
    assert not {2, 6, 7} & {i for i, _ in got} and (9, e) in got
    assert sorted(str(t) for i, t in got if i is None and not (t and len(t) > 9)) == ["", "None"] and sum(i is None and bool(t) for i, t in got) == 1
    assert got.count((3, None)) == 2


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(3)
    for n in [1, 2, 3, 4, 5, 6, 7, 8, 11, 12, 20, 33, 64, 100, 333, 1000]:
        for _ in range(40):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            most = n // 3  # only added: union up to 4/3
            added = rng.integers(0, 1 << 63, int(rng.integers(0, most + 1)), dtype=np.uint64)
            removed = 0
            while 100 * (n - removed - 1) >= 75 * (n + len(added)) and rng.random() < 0.7:
                removed += 1
            b = np.unique(np.concatenate([rng.permutation(a)[removed:], added]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 75 * (len(a) + len(b) - both):
                assert np.intersect1d(jaccard.signatures(a), jaccard.signatures(b)).size
                assert jaccard.differences(jaccard.parity(a), [jaccard.parity(b)])[0] <= len(a) + len(b) - 2 * both <= jaccard.possible(len(a), np.array([len(b)]))[0]


def test_bitmaps_in_arrays():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (1, 3, 9, 20, 40, 70, 70, 130, 300, 3)]
    maps = [jaccard.parity(s) for s in sets]
    i, j = map(np.array, zip(*[(a, b) for a in range(len(sets)) for b in range(a)]))
    assert jaccard.Bitmaps(maps).differences(i, j).tolist() == [jaccard.differences(maps[a], [maps[b]])[0] for a, b in zip(i, j)]


def test_star_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (102, 100), (200, 200)] + [(300, 300 + i) for i in range(1, 30)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and all(got[i] == 100 for i in (100, 101, 102)) and got[329] == 300 and 200 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_hits(rows, items):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = []
    for i, t in items:
        w = words_of(t, pattern)
        n = min(10, len(w))
        if i is not None:
            windows += [(str(i), w[k : k + n]) for k in range(len(w) - n + 1) if n]
    out = []
    for doc, t in rows:
        w, hit, found = words_of(t, pattern), set(), set()
        for name, win in windows:
            for k in range(len(w) - len(win) + 1):
                if w[k : k + len(win)] == win:
                    hit |= set(range(k, k + len(win)))
                    found.add(name)
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("part", [100_000, 7])
def test_contamination_equals_plain_version(spark, edge_docs, edge_rows, part):
    base, long = edge_rows[0][1].split(), edge_rows[6][1].split()
    items = [(1, " ".join(base[20:45])), (2, "ONE  two"), (10, " ".join(long[-12:])), (9, " ".join(base[30:41])), (3, None), (4, "!!"), (5, "a"), (None, " ".join(base[:30])), (5, "without, an id"), (6, " ".join(["never"] * 12)), (1, " ".join(base[20:45]))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination_report(edge_docs, benchmark, part=part).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_hits(edge_rows, items)


def test_contamination_without_rows(spark, edge_docs, edge_rows, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.contamination_report(edge_docs, none).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_hits(edge_rows, [])
    assert decontaminate.contamination_report(no_docs, spark.createDataFrame([(1, "a b c")], "item_id long, text string")).count() == 0


def product(v, w):
    total = 0.0
    for a, b in zip(v, w):  # sum() would compensate rounding
        total += a * b
    return total


def plain_nearest(rows, k=20):
    ok = {(i, tuple(float(x) for x in v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for i, v in ok:
        if i % 20 == 0:
            best = sorted((-product(v, w), j) for j, w in ok if j != i and len(w) == len(v))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 50])
def test_nearest_equals_plain_version(spark, monkeypatch, block):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=16)]) for i in range(400)]
    rows += [(400 + i, rows[i % 3][1]) for i in range(60)]  # equal vectors: ties
    rows += [(460, None), (480, [0.0] * 16), (500, [1.0, None] * 8), (520, [float("nan")] * 16), (540, [float("inf")] * 16), (560, []), (None, rows[0][1]), (580, [1.0, 2.0]), (581, [3.0, 1.0]), (0, rows[0][1]), (600, [1e3] * 16)]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, label int")
    monkeypatch.setattr(nearest, "TILE", 32)
    got = nearest.nearest(frame.where("vec_id % 20 = 0"), frame, block=block).collect()
    assert sorted(tuple(r) for r in got) == plain_nearest(rows)
    assert nearest.nearest_report(frame.where("false")).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(50, 40)) * 10 ** rng.uniform(-3, 3, (50, 1)), rng.normal(size=(60, 40))
    (qx, sx, nx, rx, ex), (qy, sy, ny, _, ey) = nearest.quantised(x), nearest.quantised(y)
    error = np.abs(nearest.tile_product(qx, qy) * sx[:, None] * sy - x @ y.T)
    assert (error <= ex[:, None] * ny + rx[:, None] * ey + 1e-12).all()

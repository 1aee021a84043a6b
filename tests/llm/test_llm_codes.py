import random

import numpy as np
import pytest

from moldwise.llm import cover_lloyd


def plain_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Every part against every entry, in Python integers."""
    def whole(v):
        return v and len(v) % parts == 0 and all(x is not None and np.isfinite(x) for x in v)

    rows = sorted((r for r in rows if whole(r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    rows = [r for r in rows if len(r[1]) == len(rows[0][1])]
    ints = [[int(np.floor(x * scale)) for x in r[1]] for r in rows]
    width = len(ints[0]) // parts if ints else 0
    out, books = [["", 0] for _ in rows], []
    for p in range(parts):
        mine = [v[p * width : (p + 1) * width] for v in ints]
        book = [list(x) for x in mine[:entries]]

        def nearest():
            return [min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(book)) for x in mine]

        for _ in range(rounds):
            near = nearest()
            for k in range(len(book)):
                got = [x for x, (_, j) in zip(mine, near) if j == k]
                if got:
                    book[k] = [sum(c) // len(got) for c in zip(*got)]
        for o, (d, k) in zip(out, nearest()):
            o[0] += f"{k:02x}"
            o[1] += d
        books += book
    by_label = {}
    for r, o in zip(rows, out):
        by_label[r[2]] = by_label.get(r[2], 0) + o[1]
    import hashlib

    sha = hashlib.sha256(",".join(str(x) for c in books for x in c).encode()).hexdigest()
    return sorted(((r[0], o[0], o[1], by_label[r[2]], sha) for r, o in zip(rows, out)), key=str)


def vectors(spark, rows, kind="float"):
    """With more columns, whose names the operator uses inside."""
    return spark.createDataFrame([(*r, "x", 1, [1]) for r in rows], f"vec_id long, embedding array<{kind}>, label int, code string, error long, points array<int>")


def odd_rows(rng):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(np.float32(rng.gauss(0, 0.2))) for _ in range(16)], rng.choice([0, 1, None])) for i in range(120)]
    rows += [(200 + i, rows[3][1], 5) for i in range(40)]  # copies
    rows += [(3, rows[3][1], 5), (3, rows[4][1], 5), (None, rows[5][1], 5)]
    rows += [(300, None, 1), (301, [None] + [0.5] * 15, 1), (302, [nan] + [0.5] * 15, 1), (303, [inf] + [0.5] * 15, 1), (304, [], 1)]
    rows += [(305, [0.5] * 8, 1), (306, [0.5] * 15, 1), (307, [0.0] * 16, 1), (308, [-1e-9] * 16, 1), (309, [50.0] * 16, 2)]
    rng.shuffle(rows)
    return rows


def test_codes_equal_plain_version(spark):
    rows = odd_rows(random.Random(3))
    got = cover_lloyd.code_report(vectors(spark, rows).repartition(3))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_codes(rows)


@pytest.mark.parametrize("n", [1, 5, 16])
def test_fewer_rows_than_entries(spark, n):
    rows = [(i, [float(np.float32(np.sin(i * j))) for j in range(8)], None) for i in range(n)]
    assert sorted((tuple(r) for r in cover_lloyd.code_report(vectors(spark, rows)).collect()), key=str) == plain_codes(rows)


def test_no_usable_vectors(spark):
    assert cover_lloyd.code_report(vectors(spark, [])).count() == 0
    assert cover_lloyd.code_report(vectors(spark, [(1, None, 1), (2, [0.1] * 7, 1)])).count() == 0


def test_huge_components_are_held(spark):
    rows = [(i, [1e30 * (-1) ** i if j == i else 0.25 for j in range(8)], 1) for i in range(20)]
    got = cover_lloyd.code_report(vectors(spark, rows, "double")).collect()
    held = [(i, [max(min(x, 65536.0), -65536.0) for x in v], label) for i, v, label in rows]
    assert sorted((tuple(r) for r in got), key=str) == plain_codes(held)


def test_trees_against_all_comparisons():
    rng = np.random.default_rng(5)
    for trial in range(120):
        n, width, m, size = int(rng.integers(1, 250)), int(rng.integers(1, 9)), int(rng.integers(1, 17)), int(rng.choice([2, 40, 3000, 1 << 28]))
        points = rng.integers(-size, size, (n, width)).astype(np.int32)
        if trial % 3 == 0:
            points[rng.integers(0, n, n)] = points[0]
        book = rng.integers(-size, size, (m, width))
        tree = cover_lloyd.CoverTree.unpacked(cover_lloyd.CoverTree.build(points).packed())
        for low, high, centre, radius, child, children in zip(tree.low, tree.high, tree.centre, tree.radius, tree.child, tree.children):
            assert cover_lloyd.squared(tree.points[low:high], tree.points[centre]).max() == radius
            if children:
                below = slice(child, child + children)
                assert tree.low[child] == low and tree.high[child + children - 1] == high and (tree.high[below][:-1] == tree.low[below][1:]).all()
                middle = tree.points[tree.centre[below]]
                apart = cover_lloyd.squared(middle[:, None], middle[None]) + np.where(np.eye(children, dtype=bool), np.iinfo(np.int64).max // 2, 0)
                assert apart.min() > radius // 4 and (tree.radius[below] <= radius // 4).all()
        far = cover_lloyd.squared(points[:, None], book[None])
        label, error = tree.labels(book)
        count, sums = tree.totals(book)
        assert (label == far.argmin(axis=1)).all() and (error == far.min(axis=1)).all()
        assert (count == np.bincount(label, minlength=m)).all()
        assert all((sums[k] == points[label == k].sum(axis=0)).all() for k in range(m))


def test_whole_subtrees_are_assigned():
    rng = np.random.default_rng(6)
    points = np.concatenate([rng.integers(-20, 20, (500, 8)) + c for c in (0, 5000, -5000)]).astype(np.int32)
    low, high, entry = cover_lloyd.CoverTree.build(points).assign(np.array([[0] * 8, [5000] * 8, [-5000] * 8]))
    assert (high - low).sum() == 1500 and len(low) < 20

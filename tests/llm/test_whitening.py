"""Whitening against a plain numpy version on the distinct integer vectors."""

import math

import numpy as np
import pytest

from shelfspark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, key string, dims int, n int"


def brute(rows, components=4, copies=False):
    kept = []
    for i, v, *_ in rows:
        if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v):
            kept.append((i, tuple(math.floor(256 * float(np.float32(c))) for c in v)))
    out = []
    for dims in {len(x) for _, x in kept}:
        mine = [(i, x) for i, x in kept if len(x) == dims]
        fit = [x for _, x in mine] if copies else sorted({x for _, x in mine})
        n, m = len(fit), np.array(fit, float)
        total = [sum(x[k] for x in fit) for k in range(dims)]
        c = m - np.array([t / n for t in total])
        e, u = np.linalg.eigh(c.T @ c / n)
        order = np.argsort(-e)[: min(components, dims)]
        for i, x in mine:
            dev = sum((n * a - t) ** 2 for a, t in zip(x, total))
            for k, j in enumerate(order):
                w = abs((np.array(x) - np.array(total) / n) @ u[:, j]) / math.sqrt(e[j]) if e[j] > 1e-9 else None
                out.append((i, k + 1, n, dev, w, e[j] / e.sum() if e.sum() > 0 else None))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3]))


def held(df, rows, **how):
    got = sorted(whitening.whiten(df, **how).collect(), key=lambda r: (r.vec_id is None, r.vec_id or 0, r.component, r.deviation))
    want = brute(rows, copies=how.get("weights") == "copies")
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert (g.vec_id, g.component, g.n, int(g.deviation)) == w[:4]
        assert (g.whitened is None) == (w[4] is None) and (w[4] is None or abs(abs(g.whitened) - w[4]) < 1e-6)
        assert (g.explained is None) == (w[5] is None) and (w[5] is None or abs(g.explained - w[5]) < 1e-9)
    return got


@pytest.mark.parametrize("weights", ["one", "copies"])
def test_against_numpy(spark, weights):
    rnd = np.random.default_rng(1)
    base = (rnd.normal(size=(60, 8)) * np.arange(1, 9)).astype(np.float32)
    rows = [(i, [float(c) for c in base[i % 60]], "k", 1, 2) for i in range(90)]
    rows += [(1000 + i, [float(c) for c in base[0]], "k", 1, 2) for i in range(200)]  # one vector with most of the rows
    rows += [(1, [float(c) for c in base[5]], "k", 1, 2), (None, [float(c) for c in base[6]], None, None, None)]
    rows += [(507, None, "", 0, 0), (508, [], "", 0, 0), (509, [1.0] * 7 + [None], "", 0, 0), (510, [1.0] * 7 + [float("nan")], "", 0, 0), (511, [float("inf")] + [0.0] * 7, "", 0, 0)]
    got = held(spark.createDataFrame(rows, SCHEMA), rows, weights=weights)
    assert max(r.identity_error for r in got) < 1e-9
    assert not {507, 508, 509, 510, 511} & {r.vec_id for r in got}
    by_vector = {}
    for r in got:  # equal vectors are whitened to the last bit alike
        if r.vec_id is not None and (r.vec_id >= 1000 or r.vec_id == 0):
            by_vector.setdefault(r.component, set()).add(r.whitened)
    assert all(len(v) == 1 for v in by_vector.values())


def test_lengths_wide_entries_and_no_variance(spark):
    rows = [(i, [float(i * 3e5), float(-i), float(i * i)], "", 0, 0) for i in range(12)] + [(50 + i, [0.5, float(i % 2)], "", 0, 0) for i in range(5)]
    held(spark.createDataFrame(rows, SCHEMA), rows)
    same = [(i, [1.0, 2.0], "", 0, 0) for i in range(3)]
    got = held(spark.createDataFrame(same, SCHEMA), same)
    assert {(r.whitened, r.explained, r.identity_error) for r in got} == {(None, None, None)}
    assert held(spark.createDataFrame([], SCHEMA), []) == []


def test_exact_deviation_beyond_a_long(spark):
    rows = [(i, [3e15 * i, 1.0 * i], "", 0, 0) for i in range(4)]
    got = held(spark.createDataFrame(rows, SCHEMA), rows)
    assert max(int(r.deviation) for r in got) > 1 << 63


def test_packing_keeps_equal_rows_equal():
    x = np.array([[1, -2], [300, 4], [70000, 1], [1 << 40, 0], [-128, 127], [-129, 0]], np.int64)
    packed = whitening.pack(x)
    assert [p[0] for p in packed] == [1, 2, 4, 8, 1, 2]
    assert (whitening.unpack(packed, 2) == x).all()

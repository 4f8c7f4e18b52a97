"""Clustering, top-k search and hard negatives against plain Python loops on exact integers."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from sigmawatch.llm import bit_slices, exact_vectors, laesa, strassen

SCHEMA = "vec_id long, embedding array<double>, label int, vec string, rank int, score string, cluster int"


def frame(spark, rows):
    """``rows``: (vec_id, vector, label); more columns whose names results use."""
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA)


def exact(vector, factor):
    return [math.floor(v * factor) if abs(v) < 2**52 else int(v) * factor for v in vector]


def takes_part(row):
    return row[1] is not None and all(v is not None and math.isfinite(v) for v in row[1])


def dot(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True))


def long(v):
    return v if -(1 << 63) <= v < 1 << 63 else None


def vectors(dims, seed=3, n=260, wide=True):
    """Ties, repeated rows, an id with two vectors, unusable and (if ``wide``) huge vectors."""
    rng = np.random.default_rng(seed)
    rows = [(i, np.round(rng.normal(size=dims), 1).tolist(), int(rng.integers(0, 3))) for i in range(n)]
    rows += [(i + n, rows[i][1], rows[i][2]) for i in range(30)]  # equal vectors, other ids
    rows += [rows[0], rows[100], rows[100]]  # repeated rows
    rows += [(50, (rng.normal(size=dims)).tolist(), 1)]  # an id with another vector
    rows += [(900, None, 1), (950, [None] * dims, 1), (1000, [math.nan] * dims, 1),
             (1050, [math.inf] * dims, 2), (None, rows[3][1], 1), (1100, rows[4][1], None),
             (1150, [0.0] * dims, 0), (1200, [0.5] * (dims + 1), 0), (1201, [0.25] * (dims + 1), 0),
             (1300, [], 0), (1301, [], 1)]
    if wide:
        rows += [(1400, [1e20] * dims, 0), (1401, [-1e300] + [1.0] * (dims - 1), 1),
                 (1402, [1e308] * dims, 2), (1403, [3e7] * dims, 1)]
    return rows


# ---- integers ---------------------------------------------------------------------------------

def test_order_keys_sort_like_integers():
    values = [0, 1, -1, 255, 256, -255, -256, 2**63, -2**63, 2**64, -2**2000, 2**2000, 77, -78]
    assert [exact_vectors.from_key(exact_vectors.order_key(v)) for v in values] == values
    assert sorted(values, key=exact_vectors.order_key) == sorted(values)


def test_whole_is_exact():
    x = np.array([[0.1, -0.1, 1e300], [2.0**60, -1e308, 5e-324]])
    assert exact_vectors.whole(x, 256).tolist() == [exact(r, 256) for r in x.tolist()]
    assert exact_vectors.whole(x[:1, :2], 256).dtype == np.int64
    assert [sum(p << 31 * i for i, p in enumerate(laesa.limbs(v))) for v in (0, -1, 5, -2**200, 2**99)] == [
        0, -1, 5, -2**200, 2**99]


# ---- clustering -------------------------------------------------------------------------------

def cluster_rows(rows, k, rounds, dims, factor):
    kept = [(i, exact(v, factor), v) for i, v, _ in filter(takes_part, rows) if len(v) == dims]
    ticket = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[2])
    centers = [r[1] for r in sorted(kept, key=ticket)[:k]]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v: min((away(v, c), n) for n, c in enumerate(centers))
    for _ in range(rounds):
        own = [near(v)[1] for _, v, _ in kept]
        members = [[v for (_, v, _), o in zip(kept, own, strict=True) if o == c] for c in range(len(centers))]
        centers = [[sum(col) // len(m) for col in zip(*m, strict=True)] if m else c
                   for m, c in zip(members, centers, strict=True)]
    final = [(i, *near(v)) for i, v, _ in kept]
    out = []
    for i, d, c in final:
        own = [e for _, e, o in final if o == c]
        fits = all(long(e) is not None for e in own)
        every = all(long(e) is not None for _, e, _ in final)
        out.append((i, c, long(d), long(sum(own)) if fits else None,
                    long(sum(e for _, e, _ in final)) if every else None,
                    hashlib.sha256(",".join(map(str, centers[c])).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("wide", [False, True])
def test_clusters_equal_plain_loop(spark, wide):
    rows = vectors(6, wide=wide)
    got = laesa.clusters(frame(spark, rows), k=5, rounds=3, dims=6)
    assert sorted(map(tuple, got.collect()), key=repr) == cluster_rows(rows, 5, 3, 6, 64)


def test_clusters_of_few_or_no_vectors(spark):
    few = vectors(6)[:3]
    got = laesa.clusters(frame(spark, few), k=16, dims=6)
    assert sorted(map(tuple, got.collect()), key=repr) == cluster_rows(few, 16, 3, 6, 64)
    none = laesa.clusters(frame(spark, few).limit(0), dims=6)
    assert none.columns == got.columns and none.count() == 0
    assert laesa.clusters(frame(spark, few), dims=64).count() == 0


def test_pivots_spare_distances_and_change_nothing():
    rng = np.random.default_rng(5)
    centers = rng.integers(-500, 500, (16, 64))
    x = np.repeat(centers, 200, 0) + rng.integers(-20, 20, (3200, 64))
    pivots, moved = centers, centers + rng.integers(-9, 9, centers.shape)
    label, best, spent = laesa.assign(x, laesa.pivot_distances(x, pivots), moved,
                                      laesa.pivot_distances(moved, pivots))
    every = ((x[:, None] - moved[None]) ** 2).sum(2)
    assert (label == every.argmin(1)).all() and (best == every.min(1)).all()
    assert spent < 2 * len(x)  # of 16 distances a row


# ---- top-k ------------------------------------------------------------------------------------

def distinct(rows):
    return list({repr(r): r for r in rows}.values())


def largest_rows(rows, k, step, factor):
    kept = distinct([(i, v) for i, v, _ in filter(takes_part, rows) if i is not None])
    out = []
    for q, qv in kept:
        if q % step == 0:
            scored = sorted((-dot(exact(qv, factor), exact(v, factor)), i) for i, v in kept
                            if i != q and len(v) == len(qv))
            out += [(q, n, i, long(-s)) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("wide", [False, True])
def test_largest_equals_brute_force(spark, wide, monkeypatch):
    rows = vectors(7, seed=4, wide=wide)
    want = largest_rows(rows, 5, 50, 256)
    assert any(r[3] is None for r in want) == wide
    for group_rows in (4_096, 40):  # one group, several groups
        monkeypatch.setattr(bit_slices, "GROUP_ROWS", group_rows)
        got = bit_slices.largest(frame(spark, rows))
        assert sorted(map(tuple, got.collect()), key=repr) == want
    assert bit_slices.largest(frame(spark, rows).limit(0)).count() == 0


def test_slices_rank_like_products():
    rng = np.random.default_rng(6)
    for low, high, n in ((-140, 140, 1000), (0, 1, 200), (-3, 0, 65), (-(1 << 20), 1 << 20, 130)):
        x = rng.integers(low, high + 1, (n, 9))
        x[n // 2:] = x[:n - n // 2]  # ties
        index = bit_slices.BitSlices(x)
        for query in rng.integers(low, high + 1, (20, 9)):
            scores = x @ query
            want = np.lexsort((np.arange(n), -scores))
            want = [r for r in want.tolist() if not 3 <= r < 5][:7]
            assert set(index.top(query.tolist(), 7, slice(3, 5))) == set(want)
    assert bit_slices.BitSlices(np.zeros((0, 4), np.int64)).top([1, 2, 3, 4], 5) == []


# ---- hard negatives ---------------------------------------------------------------------------

def negative_rows(rows):
    kept = [(i, lab, v) for i, v, lab in filter(takes_part, rows) if i is not None and lab is not None]
    kept = distinct([(i, (lab + 1) % 10 if i % 7 == 0 else lab, v) for i, lab, v in kept])
    out = []
    for a, lab, av in kept:
        if a % 100:
            continue
        scored = [(-dot(exact(av, 256), exact(v, 256)), i, o) for i, o, v in kept if i != a and len(v) == len(av)]
        for ps, p, _ in sorted(s for s in scored if s[2] == lab)[:5]:
            inside = sorted(s for s in scored if s[2] != lab and 30 * -ps <= 100 * -s[0] <= 90 * -ps)
            out += [(a, p, n, i, long(-ps), long(-s)) for n, (s, i, _) in enumerate(inside[:10], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("wide", [False, True])
def test_hard_negatives_equal_brute_force(spark, wide, monkeypatch):
    rows = vectors(7, seed=8, n=420, wide=wide)
    want = negative_rows(rows)
    assert len(want) > 50
    for group_rows in (4_096, 60):
        monkeypatch.setattr(exact_vectors, "MIN_GROUP_ROWS", group_rows)
        got = strassen.hard_negatives(frame(spark, rows))
        assert sorted(map(tuple, got.collect()), key=repr) == want
    assert strassen.hard_negatives(frame(spark, rows).limit(0)).count() == 0


def test_strassen_is_exact():
    rng = np.random.default_rng(7)
    for m, k, n in ((1, 1, 1), (3, 64, 200), (256, 64, 300), (70, 70, 70), (5, 0, 4), (0, 3, 2)):
        a, b = rng.integers(-2**24, 2**24, (m, k)), rng.integers(-2**24, 2**24, (k, n))
        assert (strassen.strassen(a, b, leaf=8) == a @ b).all()
    a = np.array([[2**200, -1, 3]] * 9, object)
    assert (strassen.strassen(a, a.T, leaf=2) == a @ a.T).all()


def test_heaps_merge():
    rng = np.random.default_rng(9)
    scores, ids = rng.integers(0, 5, 100), rng.permutation(100)
    want = sorted(zip((-scores).tolist(), ids.tolist(), strict=True))[:8]
    one, merged = strassen.Best(8), strassen.Best(8)
    strassen.offer(one, scores, ids, np.ones(100, bool))
    for part in np.array_split(np.arange(100), 7):
        heap = strassen.Best(8)
        strassen.offer(heap, scores[part], ids[part], np.ones(len(part), bool))
        merged.add(*(list(c) for c in zip(*heap.sorted(), strict=True)))
    assert one.sorted() == merged.sorted() == [(-s, i) for s, i in want]


def test_hot_vector_and_label(spark):
    # A third of the rows share one vector; its rows are dealt by the whole row, id included.
    rows = [(i, [1.0, 0.5] if i % 3 else [0.1 * (i % 11), -0.3], 1 if i % 3 else i % 4) for i in range(600)]
    assert sorted(map(tuple, bit_slices.largest(frame(spark, rows)).collect()), key=repr) == largest_rows(rows, 5, 50, 256)
    got = strassen.hard_negatives(frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=repr) == negative_rows(rows)

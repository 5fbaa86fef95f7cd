"""Brute force against the operators on vectors."""

import math
import random

import numpy as np
import pytest

from quire.llm import embedding_dedup, topk
from quire.llm.common import connected_components

SCHEMA = "vec_id long, embedding array<float>, label int, extra string, c int, v string"


def odd_vectors(n=260, dims=6, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 5 == 0 and rows:
            like = rows[rng.randrange(len(rows))]
            v = [x + rng.gauss(0, 0.06) for x in like[1]]
            label = like[2]
        else:
            v, label = [rng.gauss(0, 1) for _ in range(dims)], i % 3
        rows.append((i, v, label))
    rows += [(n, rows[3][1], rows[3][2]), (n + 1, rows[3][1], rows[3][2]), (n + 2, [0.0] * dims, 1), (n + 3, None, 1), (n + 4, [1.0, math.nan, 0.0, 0.0, 0.0, 0.0], 1)]
    rows += [(n + 5, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (n + 6, rows[3][1], None), (n + 7, [], 1), (n + 8, [math.inf] * dims, 0), (n + 9, [1.0, 2.0], 1), (n + 10, [1.0, 2.0], 1), (n + 1, rows[3][1], rows[3][2])]
    return [(i, v, label, "x", 1, "v") for i, v, label in rows]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(odd_vectors(), SCHEMA).repartition(3).cache()


def sound(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


@pytest.mark.parametrize("list_rows", [4, 512])
def test_near_duplicates(vectors, list_rows):
    rows = [(r.vec_id, r.embedding, r.label) for r in vectors.collect()]
    n = len(rows)
    part = list(range(n))

    def root(x):
        return x if part[x] == x else root(part[x])

    links = [0] * n
    for i in range(n):
        for j in range(i):
            (_, a, p), (_, b, q) = rows[i], rows[j]
            if p is None or p != q or not sound(a) or not sound(b) or len(a) != len(b) or not any(a) or not any(b):
                continue
            a, b = np.array(a, dtype=float), np.array(b, dtype=float)
            if a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= 0.98:
                links[i] += 1
                links[j] += 1
                part[root(i)] = root(j)
    least = {}
    for i in range(n):
        least[root(i)] = min(rows[i][0], least.get(root(i), rows[i][0]))
    want = sorted((rows[i][0], links[i], least[root(i)], rows[i][0] == least[root(i)]) for i in range(n))
    got = sorted(tuple(r) for r in embedding_dedup.near_duplicates(vectors, list_rows=list_rows, block_rows=16).collect())
    assert got == want
    assert sum(links) > 40


def test_near_duplicates_of_extreme_norms_and_many_lengths(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(100):
        v = rng.normal(size=8)
        rows += [(2 * k, v.tolist(), "a"), (2 * k + 1, (v * (1 + 1e-3 * rng.normal(size=8))).tolist(), "a")]
    rows += [(200, [1e-200] * 8, "a"), (201, [1e-210] * 8, "a"), (202, [1e200] * 8, "b"), (203, [3e300] * 8, "b")]
    rows += [(1000 + n, [1.0] * n, "c") for n in range(1, 1101)] + [(5000 + n, [2.0] * n, "c") for n in (1, 64, 1099, 1100)]
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string"), list_rows=16).collect()}
    assert all(got[2 * k].n_links == got[2 * k + 1].n_links == 1 and got[2 * k + 1].component_id == 2 * k for k in range(100))
    assert got[201].component_id == 200 and got[203].component_id == 202
    assert {r.vec_id for r in got.values() if r.vec_id > 999 and r.n_links} == {1000 + n for n in (1, 64, 1099, 1100)} | {5000 + n for n in (1, 64, 1099, 1100)}


def test_near_duplicates_empty(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_top_k(spark, vectors):
    rows = topk.numbered(topk.floored(vectors))
    got = sorted(tuple(r) for r in topk.top_k(rows.where("id % 20 = 0"), rows, block_rows=64, block_queries=4).collect())
    plain = [(r.id, r.v) for r in rows.collect()]
    assert len({i for i, _ in plain}) < len(plain)  # rows of one id are candidates, and queries, each
    want = []
    for at, (q, own) in enumerate(plain):
        if q % 20 == 0:
            scored = sorted((-int(sum(x * y for x, y in zip(own, v, strict=False))), i) for j, (i, v) in enumerate(plain) if j != at)
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])]
    assert got == sorted(want)
    none = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(topk.numbered(topk.floored(none)), topk.numbered(topk.floored(none))).count() == 0
    few = topk.numbered(topk.floored(vectors.where("vec_id < 3")))
    assert topk.top_k(few.where("id = 0"), few).count() == 2


def test_top_k_with_ties():
    rng = np.random.default_rng(1)
    values = rng.integers(-2, 3, size=(300, 5)).astype(float)
    lists = topk.SortedLists(np.arange(300), values)
    for q in range(20):
        rows, scores = lists.top(values[q], 5, q)
        full = values @ values[q]
        best = sorted((-full[i], i) for i in range(300) if i != q)[:5]
        assert [(-s, r) for s, r in zip(scores, rows, strict=True)] == best


def test_top_k_of_repeated_queries(spark):
    rows = topk.numbered(spark.createDataFrame([(0, [1.0, 2.0]), (0, [3.0, -1.0]), (7, [1.0, 1.0]), (7, [2.0**31, 2.0**31])], "id long, v array<double>"))
    got = sorted(tuple(r) for r in topk.top_k(rows.where("id = 0"), rows, k=2).collect())
    assert got == sorted([(0, 1, 7, 3 * 2**31), (0, 2, 7, 3), (0, 1, 7, 2 * 2**31), (0, 2, 7, 2)])


def test_reading_stops_before_the_lists_end():
    rng = np.random.default_rng(5)
    values = np.floor(256 * rng.normal(size=(4000, 12)))
    values[:, 0] *= 40
    lists = topk.SortedLists(np.arange(4000), values)
    for q in range(0, 400, 20):
        full = values @ values[q]
        full[q] = -np.inf
        best = sorted((-full[i], i) for i in range(4000))[:5]
        rows, scores = lists.top(values[q], 5, q)
        assert [(-s, r) for s, r in zip(scores, rows, strict=True)] == best and len(lists._candidates(values[q], 5, q)) <= 80


def test_queries_that_read_the_lists_together():
    """Each query gets what brute force gives it, whatever the others need: ties, copies, uneven lengths and sparse vectors."""
    rng = np.random.default_rng(0)
    for t in range(40):
        n, d = int(rng.integers(81, 900)), int(rng.integers(1, 20))
        values = np.floor(256 * rng.normal(size=(n, d)))
        if t % 5 == 1:
            values = rng.integers(-1, 2, size=(n, d)).astype(float)
        elif t % 5 == 2:
            values[rng.random(n) < 0.7] = values[0]
        elif t % 5 == 3:
            values *= 2.0 ** rng.integers(0, 14, size=(n, 1))
        elif t % 5 == 4:
            values *= rng.random((n, d)) < 0.2
        some = rng.choice(n, size=min(n, 100), replace=False).tolist()
        owns = [i if rng.random() < 0.8 else None for i in some]
        for i, own, (rows, scores) in zip(some, owns, topk.SortedLists(np.arange(n), values).tops(values[some], 5, owns), strict=True):
            full = values @ values[i]
            assert [(-s, r) for s, r in zip(scores, rows, strict=True)] == sorted((-full[j], j) for j in range(n) if j != own)[:5]


def test_connected_components(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(100, 140)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(5, 5), (None, 3)]
    part = {}

    def root(x):
        part.setdefault(x, x)
        return x if part[x] == x else root(part[x])

    for a, b in pairs:
        if a is not None and a != b:
            part[max(root(a), root(b))] = min(root(a), root(b))
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: root(x) for x in part}

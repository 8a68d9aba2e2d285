"""Whitening, hard negatives and mixing against plain versions."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugekeep.llm import hard_negatives, mixing, whitening

VECTORS = "vec_id long, embedding array<double>, label int, n int, x string, part long, i int"
NAN, INF = float("nan"), float("inf")


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, lab, 7, "x", 5, 3) for i, v, lab in rows], VECTORS)


@pytest.fixture(scope="module")
def some_rows():
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.normal(size=6) * [3, 2, 1, 1, .5, .1]], int(rng.integers(0, 4))) for i in range(300)]
    rows += [(i + 300, rows[i][1], rows[i][2]) for i in range(150)]  # copies under other ids
    rows += [(900 + i, [0.0] * 6, 1) for i in range(60)]
    rows += [rows[0], rows[0], (1, rows[2][1], 3)]  # repeated rows, an id of two rows
    rows += [(1000, None, 1), (1050, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (1100, [NAN, 0.0, 0.0, 0.0, 0.0, 0.0], 1),
             (1150, [INF, 0.0, 0.0, 0.0, 0.0, 0.0], 1), (1200, [1.0], 1), (1250, [], 1), (1300, [1.0] * 6, None), (None, [1.0] * 6, 1)]
    return rows


def sound(v):
    return v is not None and len(v) == 6 and all(c is not None and math.isfinite(c) for c in v)


# --------------------------------------------------------------- whitening


@pytest.mark.parametrize("make", [
    lambda g: g.normal(size=(50, 12)),
    lambda g: np.vstack([g.normal(size=(5, 12)), np.zeros((7, 12))]),
    lambda g: np.diag([3.0] * 5 + [2.0] * 4 + [1.0] * 3) @ np.linalg.qr(g.normal(size=(12, 12)))[0],
    lambda g: np.diag(5 + 1e-9 * np.arange(12)) @ np.linalg.qr(g.normal(size=(12, 12)))[0],
    lambda g: np.diag(list(5 + 1e-13 * np.arange(6)) + [1.0] * 6) @ np.linalg.qr(g.normal(size=(12, 12)))[0],
    lambda g: np.linalg.cholesky(np.diag(abs(np.arange(-10, 11)) + 20.0) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)).T,
])
def test_singular_values_and_directions(make):
    r = np.linalg.qr(make(np.random.default_rng(3)), mode="r")
    values, v = whitening.directions(r, 12)
    want = np.linalg.svd(r)[1][:12] ** 2
    assert np.abs(values - want).max() <= 1e-13 * want[0]
    on = want > 1e-20 * want[0]  # beyond rounding
    assert np.abs(r.T @ (r @ v) - v * values).max() <= 1e-13 * want[0]
    assert np.abs(v.T @ v - np.eye(v.shape[1]))[np.ix_(on, on)].max() <= 1e-12


def test_small_singular_values_keep_their_digits():
    a, b = 10.0 ** -np.arange(12), 0.5 * 10.0 ** -np.arange(11)
    values = np.sqrt(whitening.squared_singular_values(a, b))
    assert values.prod() == pytest.approx(a.prod(), rel=1e-13)  # the determinant
    flipped = np.sqrt(whitening.squared_singular_values(a[::-1], b[::-1]))
    assert np.abs(values / flipped - 1).max() < 1e-13


def test_whitening(spark, some_rows):
    got = whitening.whiten(vectors(spark, some_rows).repartition(40)).collect()
    kept = [(i, np.floor(256 * np.array(v))) for i, v, _ in some_rows if sound(v)]
    fit = np.unique(np.array([x for _, x in kept]), axis=0)
    n, s = len(fit), fit.sum(0)
    cov = np.cov(fit.T, bias=True)
    e = np.linalg.eigvalsh(cov)[::-1]
    assert Counter((r.vec_id, r.component) for r in got) == Counter((i, c) for i, _ in kept for c in (1, 2, 3, 4))
    u = np.linalg.eigh(cov)[1][:, ::-1]
    white = {(i, c): (x - s / n) @ u[:, c - 1] / math.sqrt(e[c - 1]) for i, x in kept if i not in (0, 1) for c in (1, 2, 3, 4)}
    sign = {c: math.copysign(1, next(r.whitened for r in got if (r.vec_id, r.component) == (5, c)) * white[5, c]) for c in (1, 2, 3, 4)}
    deviations = defaultdict(set)
    for i, x in kept:
        deviations[i].add(int(((n * x - s) ** 2).sum()))
    for r in got:
        assert r.n == n and r.deviation in deviations[r.vec_id]
        assert r.explained == pytest.approx(e[r.component - 1] / e.sum(), rel=1e-10)
        assert 0 <= r.identity_error < 1e-9
        if r.vec_id not in (0, 1):
            assert r.whitened == pytest.approx(sign[r.component] * white[r.vec_id, r.component], rel=1e-8, abs=1e-9)


def test_whitening_odd_tables(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, None, 1), (2, [NAN], 1), (3, [], 1)])).collect() == []
    same = whitening.whiten(vectors(spark, [(1, [0.5, 1.0], 1), (2, [0.5, 1.0], 1), (None, [0.5, 1.0], 1)])).collect()
    assert len(same) == 6 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {(1, 0, None, None, None)}
    line = whitening.whiten(vectors(spark, [(1, [0.0, 1.0], 1), (2, [1.0, 1.0], 1)])).orderBy("vec_id", "component").collect()
    assert [(r.component, r.explained) for r in line] == [(1, 1.0), (2, 0.0)] * 2
    assert sorted(r.whitened for r in line if r.component == 1) == pytest.approx([-1, 1]) and {r.whitened for r in line if r.component == 2} == {None}
    big = whitening.whiten(vectors(spark, [(1, [1e12, 0.0], 1), (2, [-1e300, 1.0], 1), (3, [2.0, 0.0], 1)])).collect()
    assert {r.deviation for r in big} == {None} and {r.n for r in big} == {3}


def test_whitening_far_from_zero(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(c) for c in rng.normal(size=3) * [2, 1, .5] + 1e9], 0) for i in range(200)]
    got = whitening.whiten(vectors(spark, rows)).collect()
    e = np.linalg.eigvalsh(np.cov(np.floor(256 * np.array([v for _, v, _ in rows])).T, bias=True))[::-1]
    assert {r.component: r.explained for r in got} == pytest.approx({k + 1: e[k] / e.sum() for k in range(3)}, rel=1e-6)
    assert {r.identity_error for r in got if r.identity_error > 1e-6} == set()


# ---------------------------------------------------------- hard negatives


@pytest.mark.parametrize("limit", [1, 200, 1 << 20, 1 << 27])
def test_packed_products_are_exact(limit):
    rng = np.random.default_rng(limit)
    x, a = rng.integers(-limit, limit + 1, (37, 15)), rng.integers(-limit, limit + 1, (5, 15))
    x[0], a[0], x[1], a[1] = limit, limit, -limit, -limit
    assert (hard_negatives.Packed(x, limit).scores(a) == a @ x.T).all()


def plain_negatives(rows, anchor, positives=5, negatives=3):
    best = {}
    for i, v, lab in rows:
        if i is not None and sound(v) and lab is not None:
            one = lab, [math.floor(256 * c) for c in v]
            best[i] = min(best.get(i, one), one)
    rows = [(i, (lab + 1) % 4 if i % 7 == 0 else lab, np.array(x)) for i, (lab, x) in best.items()]
    out = []
    for i, lab, x in rows:
        if not anchor(i):
            continue
        scored = sorted((-int(x @ y), j, other == lab) for j, other, y in rows if j != i)
        for s, j, _ in [t for t in scored if t[2]][:positives]:
            band = [t for t in scored if not t[2] and 50 * -s <= 100 * -t[0] <= 95 * -s]
            out += [(i, j, k + 1, t[1], -s, -t[0]) for k, t in enumerate(band[:negatives])]
    return out


@pytest.mark.parametrize("tile", [16_384, 64])
def test_hard_negatives(spark, some_rows, tile, monkeypatch):
    monkeypatch.setattr(hard_negatives, "TILE", tile)
    got = hard_negatives.mine(vectors(spark, some_rows), F.col("vec_id") % 2 == 0,
                              relabel=F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 4).otherwise(F.col("label")))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain_negatives(some_rows, lambda i: i % 2 == 0)
    assert len(want) > 1000 and sorted(map(tuple, got.collect())) == sorted(want)


def test_hard_negatives_odd_tables(spark):
    all_rows = F.lit(True)
    for rows in ([], [(1, None, 1), (2, [NAN], 1), (3, [], 2)], [(1, [1.0], 1)], [(1, [1.0], 1), (2, [1.0], 1)], [(1, [1.0], 1), (2, [1.0], 2)]):
        assert hard_negatives.mine(vectors(spark, rows), all_rows).collect() == []
    assert hard_negatives.mine(vectors(spark, [(1, [1.0], 1), (2, [1.0], 1), (3, [0.75], 2)]), F.lit(False)).collect() == []
    with pytest.raises(ValueError):
        hard_negatives.mine(vectors(spark, [(1, [1e9], 1), (2, [1.0], 1)]), all_rows)


# ------------------------------------------------------------------ mixing


def plain_mix(docs, quality, weights=(3, 1, 2), budget=1.5, most=2.0):
    """docs: (doc_id, text, source). The excess is dealt out round by round."""
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in docs]
    total = Counter()
    for (_, _, s), n in zip(docs, sizes, strict=True):
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, free = dict.fromkeys(order, 0.0), budget * sum(sizes), set(order)
    while left > 1e-9 and free:
        share = {s: left * w[s] / sum(w[t] for t in free) for s in free}
        left = 0.0
        for s, more in share.items():
            target[s] += more
            if target[s] >= most * total[s]:
                left += target[s] - most * total[s]
                target[s] = most * total[s]
                free.discard(s)
    out = []
    for s in order:
        words = math.floor(target[s] + 0.5 + 1e-9)
        epochs = words // total[s] if total[s] else 0
        rest = words - epochs * total[s]
        groups = defaultdict(list)
        for (i, _, of), n in zip(docs, sizes, strict=True):
            if of == s:
                h = int(hashlib.md5(f"mix{'' if i is None else i}".encode()).hexdigest()[:13], 16)
                q = quality.get(i)
                q = 1.0 if q is None else q if 0.01 < q < INF else 0.01
                groups[math.floor(-math.log((h + 0.5) / 2 ** 52) / q * 2 ** 48)].append((i, n))
        for place in sorted(groups):
            words = sum(n for _, n in groups[place])
            for i, n in groups[place]:
                part = n if words <= rest else rest * n // words
                out.append((i, n, s, total[s], round(target[s], 6), epochs * n + part))
            rest = max(0, rest - words)
    return sorted(out, key=repr)


def mixed(df):
    return sorted(((r.doc_id, r.size, r.source, r.source_size, round(r.target, 6), r.taken) for r in df.collect()), key=repr)


@pytest.mark.parametrize("weights", [(3, 1, 2), (1, 50)])
def test_mixing(spark, docs, weights):
    rng = np.random.default_rng(4)
    rows = [(r.doc_id, r.text, [None, "a", "b", "é", "Z", "only"][min(int(rng.integers(0, 9)), 4)]) for r in docs.collect()]
    rows += [(10_000, "one two", "only"), (10_001, None, "a"), (10_002, "", "no words"), (None, "a b c", "a"), (None, "a b", "a"), rows[0], rows[0]]
    quality = {r[0]: float(rng.choice([0.25, 1, 4, 0, NAN, INF])) for r in rows[:150]}
    table = spark.createDataFrame([(i, t, s, 1, 2) for i, t, s in rows], "doc_id long, text string, source string, place int, words int")
    given = spark.createDataFrame([(i, q) for i, q in quality.items()] + [(77, None), (None, 3.0)], "doc_id long, quality double")
    got = mixing.mix(table, weights, quality=given)
    assert mixed(got) == plain_mix(rows, quality, weights)
    assert mixed(mixing.mix(table.repartition(7), weights, quality=given)) == mixed(got)
    taken = Counter()
    for r in got.collect():
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source, r.target] += r.taken
    for (_, target), n in taken.items():
        assert abs(n - target) <= 3  # rows of one number share, rounded down


def test_mixing_odd_tables(spark, odd_docs, no_docs):
    assert mixing.mix(no_docs).collect() == []
    rows = [(r.doc_id, r.text, r.source) for r in odd_docs.collect()]
    assert mixed(mixing.mix(odd_docs)) == plain_mix(rows, {})
    empty = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mixing.mix(empty).collect()] == [(0, 0.0, 0)] * 2


def test_good_documents_come_earlier(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    quality = rows.select("doc_id", F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0).alias("quality"))
    share = {r.even: r.n for r in mixing.mix(rows, budget=0.5, quality=quality).groupBy((F.col("doc_id") % 2 == 0).alias("even")).agg(F.sum("taken").alias("n")).collect()}
    assert share[True] > 2.2 * share[False] and share[True] + share[False] == 6000

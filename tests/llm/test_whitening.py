import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mortar.llm import feast, whitening

TABLE = "/root/testdata/sf0.001/embeddings.parquet"
SCHEMA = "vec_id long, embedding array<float>, label int"


def test_inertia_and_pairs_equal_dense_solver():
    rng = np.random.default_rng(3)
    for d in (1, 2, 3, 8, 40):
        for kind in range(4):
            y = rng.standard_normal((3 * d, d)) * rng.exponential(1, d)
            a = y.T @ y / len(y)
            if kind == 1:
                a = np.eye(d) * 3
            if kind == 2:  # a cluster at the wanted end and rank d / 2
                q, _ = np.linalg.qr(rng.standard_normal((d, d)))
                a = q * np.concatenate([np.full(d - d // 2, 5.0), np.zeros(d // 2)]) @ q.T
            if kind == 3:
                a = a * 1e12
            e = np.linalg.eigvalsh(a)
            for bound in (e.max() * 0.5, e.mean(), e.min() - 1, e.max() + 1):
                if np.abs(e - bound).min() > 1e-9 * e.max():
                    assert feast.above(a, bound) == (e > bound).sum()
            values, vectors = feast.greatest(a, 4)
            true = np.sort(e[e > 1e-11 * e.max()])[::-1][:4]
            assert np.allclose(values, true, rtol=1e-12)
            assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
            assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * e.max()


def test_indefinite_inertia():
    rng = np.random.default_rng(4)
    for d in (2, 5, 30):
        a = rng.standard_normal((d, d))
        a = a + a.T
        assert feast.positive_count(a) == (np.linalg.eigvalsh(a) > 0).sum()
    assert feast.positive_count(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1
    assert feast.positive_count(np.zeros((3, 3))) == 0


def usable(v, d):
    return v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)


def expected(rows, d):
    """Row by row in plain Python integers; components from the dense solver."""
    xs = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows if usable(v, d)]
    fit = sorted({x for _, x in xs})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array(fit, float) - np.array([s / n for s in sums])
    covariance = centred.T @ centred / n
    e, u = np.linalg.eigh(covariance)
    e, u = e[::-1][:4], u[:, ::-1][:, :4]
    keep = e > 1e-11 * e.max()
    out = {}
    for i, x in xs:
        w = (np.array(x, float) - np.array([s / n for s in sums])) @ u[:, keep] / np.sqrt(e[keep])
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        for k, value in enumerate(w):
            out.setdefault((i, k + 1), []).append((n, deviation, float(value), float(e[k] / np.trace(covariance))))
    return out


def compare(report, rows, d):
    true, got, signs = expected(rows, d), {}, {}
    for r in report.collect():
        got.setdefault((r["vec_id"], r["component"]), []).append(r)
    assert set(got) == set(true)
    for key, all_rows in got.items():
        assert len(all_rows) == len(true[key])
        by_size = zip(sorted(all_rows, key=lambda r: r["deviation_exact"]), sorted(true[key], key=lambda t: t[1]))
        for r, (n, deviation, value, share) in by_size:
            assert r["n"] == n and r["deviation_exact"] == deviation
            assert r["deviation"] == (deviation if deviation < 2**63 else None)
            assert r["identity_error"] < 1e-9 and abs(r["explained"] / share - 1) < 1e-9
            if abs(value) > 1e-3:
                signs.setdefault(key[1], set()).add(r["whitened"] * value > 0)
            assert abs(abs(r["whitened"]) - abs(value)) < 1e-6
    assert all(len(s) == 1 for s in signs.values())


def test_report_equals_brute_force(spark):
    table = spark.read.parquet(TABLE)
    first = [(r["vec_id"], r["embedding"]) for r in table.orderBy("vec_id").limit(2).collect()]
    nan, inf = float("nan"), float("inf")
    v = list(first[0][1])
    extra = [
        (9001, None, 1), (9002, [], 1), (9003, v[:-1] + [None], 1), (9004, v[:-1] + [nan], 1), (9005, v[:-1] + [-inf], 1),
        (9006, v[:10], 1), (9007, v, 1), (9007, v, 1), (None, [c + 1 for c in v], None), (9008, v + [0.0], 2), (9009, [-0.0] * 64, 2),
    ] + [(i, [c * 2 for c in v], 0) for i in range(20_000, 20_300)]
    more = table.unionByName(spark.createDataFrame(extra, SCHEMA)).withColumns({"whitened": F.lit("kept"), "x": F.lit(1)})
    rows = [(r["vec_id"], r["embedding"]) for r in more.collect()]
    compare(whitening.report(more), rows, 64)
    model = whitening.fit(more)
    out, names = whitening.whiten(more, model)
    assert out.columns == [*more.columns, names["whitened"], names["deviation_exact"]]
    assert out.filter("whitened = 'kept'").count() == out.count()


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.integers(-(2**40), 2**40, 3)]) for i in range(50)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    compare(whitening.report(docs), rows, 3)
    # beyond the range of a long
    ends = spark.createDataFrame([(1, [1e300]), (2, [-1e300])], "vec_id long, embedding array<double>")
    assert {abs(r["whitened"]) for r in whitening.report(ends).collect()} == {1.0}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.25])] * 3])
def test_tables_without_components(spark, rows):
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.report(docs).collect() == []


def test_one_direction_only(spark):
    rows = [(i, [float(i), 2.0 * i, 1.0]) for i in range(7)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    report = whitening.report(docs)
    assert {r["component"] for r in report.collect()} == {1}
    compare(report, rows, 3)

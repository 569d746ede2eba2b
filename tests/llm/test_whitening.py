"""Whitening against a plain eigensolver, exact integer arithmetic, and matrices with clustered eigenvalues."""

from fractions import Fraction

import numpy as np
import pytest

from quire.llm import whitening

SF = "/root/testdata/sf0.01"


def rotation(rng, d):
    return np.linalg.qr(rng.standard_normal((d, d)))[0].astype(whitening.Wide)


@pytest.mark.parametrize("values", [
    [8, 4, 2, 1, 0.5, 0.25],
    [1, 1 + 1e-6, 1 + 2e-6, 1e-3, 1e-3 + 1e-12, 5],
    [2, 2, 2, 1, 1, 0],
    [1, 1, 1, 1, 1, 1],
    [1e12, 1e6, 1, 1 - 1e-9, 1e-3, 1e-6],
])
def test_refinement_handles_clusters(values):
    rng = np.random.default_rng(3)
    q = rotation(rng, 6)
    q = q @ (1.5 * np.eye(6) - 0.5 * q.T @ q)  # orthogonal beyond double precision
    a = q @ np.diag(np.array(values, whitening.Wide)) @ q.T
    found, x = whitening.refined((a + a.T) / 2)
    top = max(values)
    assert np.abs(np.sort(found)[::-1] - np.sort(np.array(values, whitening.Wide))[::-1]).max() < 1e-15 * top
    assert np.abs(x.T @ x - np.eye(6)).max() < 1e-16
    assert np.abs(a @ x - x * found).max() < 1e-15 * top


def test_separated_vectors_are_exact_to_double_precision():
    rng = np.random.default_rng(4)
    d = 24
    q = rotation(rng, d)
    for _ in range(2):
        q = q @ (1.5 * np.eye(d) - 0.5 * q.T @ q)
    values = 2.0 ** -np.arange(d) * 10
    values[5] = values[4] * (1 - 1e-7)  # float32 cannot tell them apart
    a = q @ np.diag(values.astype(whitening.Wide)) @ q.T
    x = whitening.refined((a + a.T) / 2)[1]
    for k in range(d):
        assert min(np.abs(x[:, k] - q[:, k]).max(), np.abs(x[:, k] + q[:, k]).max()) < (1e-9 if k in (4, 5) else 1e-11)


def test_sums_stay_exact_beyond_doubles():
    big = np.array([[2.0**40 + 1, 3.0], [2.0**40 + 3, -5.0]])
    want = [[sum(int(r[i]) * int(r[j]) for r in big) for j in range(2)] for i in range(2)]
    assert whitening.products(big).tolist() == want
    assert whitening.total(np.full((4, 1), 2.0**52)).tolist() == [2**54]
    assert float(whitening.covariance(3, [7, 7], [1, 1, 1, 1])[0, 0]) == float(Fraction(3 * 1 - 1, 9))


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows],
                                 f"vec_id long, embedding array<{kind}>, component string, n int")


def test_against_a_plain_solver(spark):
    got = whitening.op13_embedding_whitening(spark, SF).toPandas()
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    x = np.floor(64 * np.array(rows["embedding"].tolist()).astype(np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    v = y.T @ y / n
    values, q = np.linalg.eigh(v)
    values, q = values[::-1], q[:, ::-1]
    assert len(got) == 32 * n and (got["n"] == n).all()
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-9
    at = {i: r for r, i in enumerate(rows["vec_id"])}
    order = got["vec_id"].map(at).to_numpy()
    component = got["component"].to_numpy() - 1
    far = ((n * x - s) ** 2).sum(axis=1)
    assert (got["deviation"].to_numpy() == far[order]).all()
    plain = y @ q / np.sqrt(values)
    mine = np.zeros((n, 32))
    mine[order, component] = got["whitened"]
    signs = np.sign((mine * plain[:, :32]).sum(axis=0))
    assert np.abs(mine * signs - plain[:, :32]).max() < 1e-6
    assert np.abs(got["explained"].to_numpy() - (values / values.sum())[component]).max() < 1e-10


def test_odd_rows(spark):
    rows = [(1, [0.5, 1.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 0.0]), (5, [float("inf"), 0.0]), (6, []),
            (7, [-0.5, 0.25]), (7, [-0.5, 0.25]), (None, [0.1, 0.0]), (8, [1.0, 2.0, 3.0])]
    got = whitening.whiten(vectors(spark, rows)).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in got) == sorted(
        [(1, 1), (1, 2), (7, 1), (7, 2), (7, 1), (7, 2), (0, 1), (0, 2), (8, 1), (8, 2), (8, 3)])
    alone = [r for r in got if r["vec_id"] == 8]
    assert all(r["n"] == 1 and r["whitened"] is None and r["explained"] == 0 and r["deviation"] == 0 for r in alone)
    pairs = [r for r in got if r["n"] == 4]
    assert len(pairs) == 8 and all(abs(sum(r["whitened"] for r in pairs if r["component"] == c)) < 1e-9 for c in (1, 2))
    assert all(abs(sum(r["whitened"] ** 2 for r in pairs if r["component"] == c) - 4) < 1e-9 for c in (1, 2))


def test_equal_vectors_and_an_empty_table(spark):
    same = whitening.whiten(vectors(spark, [(i, [0.25, 0.5]) for i in range(5)], "double")).collect()
    assert len(same) == 10 and all(r["whitened"] is None and r["identity_error"] == 0 for r in same)
    assert whitening.whiten(vectors(spark, [])).collect() == []

"""Whitening against a dense eigensolver."""

import numpy as np
import pytest

from rtdw.llm.whitening import greatest_eigenpairs, op11_whitening, whitened


def dense(vectors):
    x = np.unique(np.floor(256 * np.array(vectors)), axis=0)
    centred = x - x.mean(0)
    values, directions = np.linalg.eigh(centred.T @ centred / len(x))
    return x, values[::-1], directions[:, ::-1]


def test_eigenpairs_of_many_matrices():
    rng = np.random.default_rng(1)
    for turn in range(120):
        size, rank = rng.integers(1, 40), rng.integers(1, 40)
        half = rng.standard_normal((size, rank)) * rng.random(rank) ** 3
        matrix = np.eye(size) if turn % 3 == 0 else half @ half.T * 10.0 ** rng.integers(-6, 7)
        values, vectors = greatest_eigenpairs(lambda v, m=matrix: m @ v, size, 4)
        want = np.linalg.eigvalsh(matrix)[::-1][:4]
        assert np.allclose(values, want, rtol=0, atol=1e-12 * want[0])
        assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-12 * want[0]
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)


def test_equal_to_dense_on_sample(spark, sf_dir):
    got = op11_whitening(spark, sf_dir).collect()
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    usable = [r for r in rows if r["embedding"] and all(c is not None and np.isfinite(c) for c in r["embedding"])]
    x, values, directions = dense([r["embedding"] for r in usable])
    n, sums = len(x), x.astype(np.int64).sum(0)
    own = {r["vec_id"]: np.floor(256 * np.array(r["embedding"])).astype(np.int64) for r in usable}
    assert len(got) == 4 * len(usable)
    signs = {}
    for r in got:
        at = r["component"] - 1
        want = (own[r["vec_id"]] - sums / n) @ directions[:, at] / np.sqrt(values[at])
        sign = signs.setdefault(at, np.sign(want * r["whitened"]) or 1)
        assert r["whitened"] * sign == pytest.approx(want, abs=1e-9)
        assert r["n"] == n and r["deviation"] == int(((n * own[r["vec_id"]] - sums) ** 2).sum())
        assert r["explained"] == pytest.approx(values[at] / values.sum(), rel=1e-9)
        assert r["identity_error"] < 1e-9


def test_few_or_equal_vectors(spark):
    def out(rows):
        return whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), ["vec_id"]).collect()

    assert out([]) == [] and out([(1, None)]) == [] and out([(1, [])]) == []
    assert out([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []  # no variance
    two = out([(1, [1.0, 2.0, 3.0]), (2, [3.0, 2.0, 1.0]), (2, [3.0, 2.0, 1.0])])
    assert [r["component"] for r in two] == [1, 1, 1] and {r["n"] for r in two} == {2}
    assert sorted(round(abs(r["whitened"]), 9) for r in two) == [1.0, 1.0, 1.0]
    short = out([(1, [1.0]), (2, [1.0, 0.0]), (3, [0.0, 5.0])])  # missing entries count as zeros
    assert len(short) == 3 and {r["n"] for r in short} == {2}


def test_odd_vectors_are_left_out(spark, odd_dir):
    ids = {r["vec_id"] for r in op11_whitening(spark, odd_dir).collect()}
    assert not ids & {40, 41, 42, 43, 46} and {None, 44, 45, 29} <= ids

import numpy as np
import pytest

from insight.operators import blocks
from insight.operators import stats as S
from pyspark.sql import functions as F


def wide_frame(spark, x, parts):
    """Rows of a matrix with NaN as null."""
    p = x.shape[1]
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    schema = ", ".join(f"c{i} double" for i in range(p))
    return spark.createDataFrame(rows, schema).repartition(parts)


def plain(x):
    """Moments pair by pair."""
    p, out = x.shape[1], {}
    for i in range(p):
        for j in range(p):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[both, i], x[both, j]
            out[i, j] = (len(a), a.mean() if len(a) else 0.0, ((a - a.mean()) ** 2).sum() if len(a) else 0.0,
                         ((a - a.mean()) * (b - b.mean())).sum() if len(a) else 0.0)
    return out


@pytest.mark.parametrize("parts", [1, 7, 200])
def test_comoments_with_missing_values(spark, parts, monkeypatch):
    monkeypatch.setattr(blocks, "FAN", 8)
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(400, 6)) * [1, 1e-3, 1e6, 1, 1, 0] + [0, 5, 1e9, 1, 1, 0.1]
    x[rnd.random(x.shape) < 0.2] = np.nan
    x[:, 4] = np.nan
    want = plain(x)
    got = {(r["i"], r["j"]): r for r in blocks.comoments(wide_frame(spark, x, parts), [f"c{i}" for i in range(6)]).collect()}
    assert set(got) == set(want)
    for k, (n, mean, sq, cross) in want.items():
        r = got[k]
        assert (r["rows"], r["n"]) == (400, n)
        assert np.isclose(r["mean_i"], mean, rtol=1e-12) and np.isclose(r["sq_i"], sq, rtol=1e-9, atol=1e-12)
        scale = np.sqrt(want[k][2] * want[k[1], k[0]][2])
        assert abs(r["cross"] - cross) <= 1e-9 * scale + 1e-12
    assert got[5, 5]["sq_i"] == 0.0  # a constant column, exactly


def test_correlation_of_200_columns(spark):
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(1500, 40)) @ rnd.normal(size=(40, 200)) + rnd.normal(size=(1500, 200)) + 1e4
    x[3, 7] = np.nan
    cols = [f"c{i}" for i in range(200)]
    got = np.full((200, 200), np.nan)
    for r in S.correlation_long(wide_frame(spark, x, 8), cols, digits=None).collect():
        got[r["ord_x"], r["ord_y"]] = np.nan if r["r"] is None else r["r"]
    want = np.corrcoef(x.T)
    assert np.isnan(got[7]).all() and np.isnan(got[:, 7]).all()
    keep = np.arange(200) != 7
    assert np.allclose(got[keep][:, keep], want[keep][:, keep], atol=1e-10)
    pairwise = {(r["ord_x"], r["ord_y"]): r["r"] for r in S.correlation_long(wide_frame(spark, x, 3), cols, digits=None, na_propagate=False).collect()}
    rest = np.delete(x, 3, axis=0)
    assert abs(pairwise[7, 9] - np.corrcoef(rest[:, 7], rest[:, 9])[0, 1]) < 1e-10 and abs(pairwise[8, 9] - want[8, 9]) < 1e-10


def test_empty_and_single_rows(spark):
    empty = spark.createDataFrame([], "a double, b double")
    assert S.correlation_long(empty, ["a", "b"]).count() == 0
    assert blocks.pair_counts(empty, [F.col("a"), F.col("b")], 4).count() == 0
    one = S.correlation_long(spark.createDataFrame([(1.0, 2.0)], "a double, b double"), ["a", "b"]).collect()
    assert len(one) == 4 and all(r["r"] is None for r in one)


def test_pair_counts(spark):
    rnd = np.random.default_rng(6)
    x = rnd.integers(-1, 4, size=(500, 4))
    df = spark.createDataFrame([tuple(None if v < 0 else int(v) for v in r) for r in x], "a int, b int, c int, d int").repartition(5)
    got = {(r["i"], r["j"], r["bin_i"], r["bin_j"]): r["n"] for r in blocks.pair_counts(df, [F.col(c) for c in "abcd"], 4).collect()}
    want = {}
    for r in x:
        for i in range(4):
            for j in range(i + 1, 4):
                if r[i] >= 0 and r[j] >= 0:
                    want[i, j, r[i], r[j]] = want.get((i, j, r[i], r[j]), 0) + 1
    assert got == want

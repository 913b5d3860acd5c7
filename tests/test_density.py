import numpy as np

from insight.operators.density import density


def plain(v, points):
    """Kernel density of the values themselves."""
    v = np.array(v)
    sd, spread = v.std(ddof=1), (np.quantile(v, 0.75) - np.quantile(v, 0.25)) / 1.34
    width = 0.9 * (min(sd, spread) or sd) * len(v) ** -0.2
    x = np.linspace(v.min(), v.max(), points)
    return x, np.exp(-0.5 * ((x[:, None] - v) / width) ** 2).sum(axis=1) / (len(v) * width * np.sqrt(2 * np.pi))


def test_close_to_the_kernel_density_of_the_values(spark):
    rnd = np.random.default_rng(4)
    a, b = rnd.gamma(2.0, 3.0, 4000), np.where(rnd.random(4000) < 0.9, 5.0, rnd.normal(5, 2, 4000))
    rows = [(float(x), float(y), 1.0) for x, y in zip(a, b)] + [(None, float("nan"), 1.0), (float("inf"), None, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, k double").repartition(5)
    got = {}
    for r in density(df, ["a", "b", "k"], 1024).collect():
        got.setdefault(r["var"], {})[r["point"]] = (r["x"], r["density"])
    assert set(got) == {"a", "b"}  # a constant column has no density
    for name, v in (("a", a), ("b", b)):
        x, want = plain(v, 1024)
        assert sorted(got[name]) == list(range(1024))
        assert np.allclose([got[name][i][0] for i in range(1024)], x)
        assert np.abs(np.array([got[name][i][1] for i in range(1024)]) - want).max() < 0.01 * want.max()


def test_empty(spark):
    assert density(spark.createDataFrame([], "a double"), ["a"]).count() == 0

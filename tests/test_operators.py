import math

from pyspark.sql import functions as F

from conftest import rows
from insight.operators import columns as C
from insight.operators import contingency as CT
from insight.operators import profile as P
from insight.operators import ranking as R
from insight.operators import stats as S
from insight.operators.aggregate import share_of_total, share_within, std_error


def test_top_n_keeps_ties_global(spark):
    df = spark.createDataFrame([("a", 10.0), ("b", 9.0), ("c", 9.0), ("d", 8.0), ("e", None)], "k string, w double")
    assert [r[0] for r in rows(R.top_n(df, 2, "w"), "k")] == ["a", "b", "c"]
    assert [r[0] for r in rows(R.top_n(df, 1, "w"), "k")] == ["a"]
    assert len(rows(R.top_n(df, 10, "w"))) == 4          # fewer rows than n, NA dropped


def test_top_n_text_weight_is_text_order(spark):
    df = spark.createDataFrame([("x", "27.59"), ("y", "9.87"), ("z", "10.00")], "k string, pct string")
    assert [r[0] for r in rows(R.top_n(df, 1, "pct"), "k")] == ["y"]


def test_top_n_per_group_with_ties(spark):
    df = spark.createDataFrame([("H", 1, 5), ("H", 2, 5), ("H", 3, 4), ("R", 1, 1), ("R", 2, 3)],
                               "g string, k int, w int")
    out = R.top_n(df, 1, "w", by="g")
    assert rows(out, "g", "k") == [("H", 1), ("H", 2), ("R", 2)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_first_and_last_rows(spark):
    df = spark.range(20).withColumnRenamed("id", "k")
    assert [r["k"] for r in R.first_rows(df, "k", 6).collect()] == [0, 1, 2, 3, 4, 5]
    assert [r["k"] for r in R.last_rows(df, "k", 6).collect()] == [14, 15, 16, 17, 18, 19]


def test_shares(spark):
    df = spark.createDataFrame([("H", 1.0), ("H", 3.0), ("R", 4.0)], "g string, v double")
    within = {(r["g"], r["v"]): r["s"] for r in share_within(df, "v", "g", "s").collect()}
    assert within == {("H", 1.0): 25.0, ("H", 3.0): 75.0, ("R", 4.0): 100.0}
    total = sorted(r["s"] for r in share_of_total(df, "v", "s").collect())
    assert total == [12.5, 37.5, 50.0]


def test_std_error(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "v double")
    se = std_error(df, None, "v").first()["std_error"]
    assert abs(se - math.sqrt(5.0 / 3.0) / 2.0) < 1e-12


def test_crosstab_zero_cells_and_na(spark):
    df = spark.createDataFrame([("City", 0.0), ("City", 1.0), ("Resort", 0.0), (None, 1.0), ("Resort", None)],
                               "hotel string, c double")
    out = rows(CT.crosstab(df, ["hotel", "c"]), "hotel", "c", "n")
    assert out == [("City", 0.0, 1), ("City", 1.0, 1), ("Resort", 0.0, 1), ("Resort", 1.0, 0)]
    assert rows(CT.frequency(df, "hotel")) == [("City", 2), ("Resort", 2)]


def test_crosstab_three_way_grid(spark):
    df = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "p string, q string, r int")
    out = CT.crosstab(df, ["p", "q", "r"])
    assert out.count() == 8 and sum(r["n"] for r in out.collect()) == 2


def test_confusion_includes_never_predicted(spark):
    pred = spark.createDataFrame([(1, "pos", "pos"), (2, "neg", "pos"), (3, "neu", "pos")],
                                 "id int, truth string, predicted string")
    levels = spark.createDataFrame([("neg", 1), ("pos", 2), ("neu", 3)], "label string, level int")
    conf = CT.confusion(pred, "truth", "predicted", levels)
    assert conf.count() == 9 and sum(r["n"] for r in conf.collect()) == 3
    from insight.operators.bayes import classification_metrics
    m = {r["label"]: r for r in classification_metrics(conf).collect()}
    assert m["neg"]["precision"] == 0.0 and m["neg"]["recall"] == 0.0 and m["neg"]["f1"] == 0.0
    assert m["pos"]["precision"] == 1.0 / 3.0 and m["pos"]["recall"] == 1.0


def test_correlation_edge_cases(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0, 1.0), (2.0, 4.1, 5.0, None), (3.0, 5.9, 5.0, 3.0),
                                (4.0, 8.2, 5.0, 4.0)], "a double, b double, k double, n double")
    cells = {(r["var_x"], r["var_y"]): r["r"] for r in S.correlation_long(df, ["a", "b", "k", "n"]).collect()}
    assert cells[("a", "a")] == 1.0 and cells[("a", "b")] == cells[("b", "a")]
    assert 0.99 < cells[("a", "b")] < 1.0
    assert cells[("a", "k")] is None and cells[("k", "k")] is None      # constant column
    assert cells[("a", "n")] is None                                       # NA propagates
    pairwise = {(r["var_x"], r["var_y"]): r["r"]
                for r in S.correlation_long(df, ["a", "n"], na_propagate=False).collect()}
    assert pairwise[("a", "n")] is not None
    up = S.upper_triangle(S.correlation_long(df, ["a", "b", "k"]))
    assert up.count() == 6


def test_column_summary_type7_quantiles(spark):
    df = spark.createDataFrame([(1.0, "x"), (2.0, "y"), (3.0, None), (10.0, "z"), (None, "w")], "v double, s string")
    out = {r["column"]: r for r in P.column_summary(df).collect()}
    assert set(out) == {"v", "s"}
    assert (out["s"]["kind"], out["s"]["n"], out["s"]["n_na"], out["s"]["mean"]) == ("text", 5, 1, None)
    r = out["v"]
    assert (r["min"], r["q1"], r["median"], r["q3"], r["max"], r["n_na"]) == (1.0, 1.75, 2.5, 4.75, 10.0, 1)
    assert r["mean"] == 4.0


def test_na_profiles(spark):
    df = spark.createDataFrame([(1, float("nan"), "a"), (2, None, None), (3, 1.0, "b")], "k int, x double, s string")
    counts = dict(rows(P.na_counts(df)))
    assert counts == {"k": 0, "x": 2, "s": 1}
    assert rows(P.na_positions(df, "k")) == [("s", 2), ("x", 1), ("x", 2)]


def test_mean_sd_non_numeric_and_na(spark):
    df = spark.createDataFrame([(1.0, 1.0, "a"), (3.0, None, "b")], "a double, b double, s string")
    out = {r["column"]: (r["mean"], r["sd"]) for r in P.column_mean_sd(df).collect()}
    assert out["a"][0] == 2.0 and abs(out["a"][1] - math.sqrt(2.0)) < 1e-12
    assert out["b"] == (None, None) and out["s"] == (None, None)


def test_distinct_values_keeps_na(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 1)], "s string, i int")
    assert rows(P.distinct_values(df)) == sorted([("i", "1"), ("i", None), ("s", "a"), ("s", None)], key=repr)


def test_first_seen_levels(spark):
    df = spark.createDataFrame([(5, "neg"), (1, "pos"), (3, "neg"), (9, "neu")], "k int, lab string")
    out = rows(P.first_seen_levels(df, "lab", "k"), "level", "value")
    assert out == [(1, "pos"), (2, "neg"), (3, "neu")]


def test_column_selection(spark):
    df = spark.createDataFrame([(1.0, 0.0, "x", -1.0), (2.0, 0.0, "y", 0.0)], "a double, z double, s string, m double")
    assert C.select_numeric(df).columns == ["a", "z", "m"]
    assert C.keep_nonzero_columns(C.select_numeric(df)).columns == ["a", "m"]
    assert C.keep_positive_sum_columns(C.select_numeric(df)).columns == ["a"]
    seq = C.mutate(df, ("a", F.col("a") * 10), ("b", F.col("a") + 1))
    assert [r["b"] for r in seq.collect()] == [11.0, 21.0]


def test_boxplot(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 100.0]
    df = spark.createDataFrame([("g", v) for v in vals] + [("h", 1.0)], "g string, v double")
    st = {r["g"]: r for r in S.boxplot_stats(df, ["g"], "v").collect()}
    g = st["g"]
    assert (g["q1"], g["median"], g["q3"]) == (3.0, 5.0, 7.0)
    assert (g["lower_whisker"], g["upper_whisker"], g["n_outliers"]) == (1.0, 8.0, 1)
    assert st["h"]["n"] == 1 and st["h"]["n_outliers"] == 0
    out = S.boxplot_outliers(df, ["g"], "v").collect()
    assert [(r["g"], r["v"]) for r in out] == [("g", 100.0)]


def test_censor_and_bins(spark):
    df = spark.createDataFrame([(0.0, 1.0), (5.0, 1.0), (10.0, 1.0), (None, 1.0)], "x double, k double")
    assert [r["c"] for r in df.select(S.censor("x", 1.0, 9.0).alias("c")).collect()] == [None, 5.0, None, None]
    h = {(r["var"], r["bin"]): r["n"] for r in S.histogram_long(df, ["x", "k"], 2).collect()}
    assert h == {("x", 0): 1, ("x", 1): 2, ("k", 0): 4}
    p = rows(S.pair_bins(df, ["x", "k"], 2), "bin_x", "bin_y", "n")
    assert p == [(0, 0, 1), (1, 0, 2)]


def test_share_within_na_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("R", 4.0)], "g string, v double")
    out = sorted((r["g"] or "", r["s"]) for r in share_within(df, "v", "g", "s").collect())
    assert out == [("", 25.0), ("", 75.0), ("R", 100.0)]


def test_crosstab_wide_zero_cells(spark):
    df = spark.createDataFrame([("City", "0"), ("City", "1"), ("Resort", "0"), (None, "1")], "h string, c string")
    out = {r["h"]: (r["0"], r["1"]) for r in CT.crosstab_wide(df, "h", "c").collect()}
    assert out == {"City": (1, 1), "Resort": (1, 0)}


def test_row_positions_match_a_sort(spark):
    import random
    keys = list(range(0, 3000, 3))
    random.Random(3).shuffle(keys)
    df = spark.createDataFrame([(k, None if k % 9 == 0 else 1.0) for k in keys], "k long, x double")
    got = {r["k"]: r["row"] for r in R.row_positions(df, "k").collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(keys))}
    na = {r["k"]: r["row"] for r in P.na_positions(df, "k", ["x"], row_numbers=True).collect()}
    assert na == {k: got[k] for k in keys if k % 9 == 0}


def test_row_positions_spread_null_and_repeated_keys(spark):
    df = spark.createDataFrame([(None if i % 3 else i % 5,) for i in range(3000)], "k int")
    out = [(r["row"], r["k"]) for r in R.row_positions(df, "k").collect()]
    assert sorted(p for p, _ in out) == list(range(1, 3001))
    assert [k for _, k in sorted(out)] == sorted((k for _, k in out), key=lambda k: (k is not None, k or 0))
    ranged = R.ranged(df.withColumn("t", F.monotonically_increasing_id()), ["k", "t"])
    nulls = ranged.filter("k IS NULL").groupBy("__part").count().collect()
    assert len(nulls) > 1 or spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"


def test_bins_leave_out_nan_and_infinities(spark):
    rows = [(float(i), 1.0) for i in range(100)] + [(float("nan"), 1.0), (float("inf"), 1.0), (float("-inf"), 1.0)]
    df = spark.createDataFrame(rows, "x double, k double")
    h = {r["bin"]: (r["n"], r["var_min"], r["var_max"]) for r in S.histogram_long(df, ["x"], 10).collect()}
    assert len(h) == 10 and sum(n for n, _, _ in h.values()) == 100 and set(h.values()) == {(10, 0.0, 99.0)}
    assert sum(r["n"] for r in S.pair_bins(df, ["x", "k"], 10).collect()) == 100


def test_summary_of_dates(spark):
    df = spark.sql("SELECT * FROM VALUES (DATE'1970-01-02', 'a'), (DATE'1970-01-04', NULL), (NULL, 'b') AS t(d, s)")
    d = {r["column"]: r for r in P.column_summary(df).collect()}["d"]
    assert (d["kind"], d["min"], d["median"], d["max"], d["n_na"]) == ("date", 86400.0, 172800.0, 259200.0, 1)


def test_crosstab_scans_once(spark):
    df = spark.createDataFrame([(i % 5, i % 3 if i % 5 else 0) for i in range(100)], "a int, b int")
    out = {(r["a"], r["b"]): r["n"] for r in CT.crosstab(df, ["a", "b"]).collect()}
    assert len(out) == 15 and out[(0, 1)] == 0 and sum(out.values()) == 100
    many = spark.range(12_000).selectExpr("id as a", "id % 2 as b")  # no limit on the number of levels
    assert CT.crosstab(many, ["a", "b"]).count() == 24_000

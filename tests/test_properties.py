"""Property checks against brute force on random small frames (hypothesis)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from insight.operators import contingency as CT
from insight.operators import ranking as R
from insight.operators.aggregate import share_within

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(st.tuples(st.sampled_from(["H", "R", None]), st.integers(0, 6) | st.none()),
                   min_size=1, max_size=40)


def min_rank_top(rows, n, by_group):
    out = []
    for i, (g, w) in enumerate(rows):
        if w is None:
            continue
        peers = [(gg, ww) for gg, ww in rows if ww is not None and (not by_group or gg == g)]
        if 1 + sum(1 for _, ww in peers if ww > w) <= n:
            out.append(i)
    return sorted(out)


@SETTINGS
@given(rows=rows_st, n=st.integers(1, 5))
def test_top_n_equals_min_rank(spark, rows, n):
    df = spark.createDataFrame([(i, g, w) for i, (g, w) in enumerate(rows)], "i int, g string, w int")
    assert sorted(r["i"] for r in R.top_n(df, n, "w").collect()) == min_rank_top(rows, n, False)
    got = sorted(r["i"] for r in R.top_n(df.filter("g IS NOT NULL"), n, "w", by="g").collect())
    assert got == min_rank_top([(g, w) if g is not None else (g, None) for g, w in rows], n, True)


@SETTINGS
@given(rows=rows_st)
def test_shares_sum_to_100_per_group(spark, rows):
    df = spark.createDataFrame([(g, float(w) + 1.0) for g, w in rows if w is not None] or [("H", 1.0)],
                               "g string, v double")
    sums = {}
    for r in share_within(df, "v", "g", "s").collect():
        sums[r["g"]] = sums.get(r["g"], 0.0) + r["s"]
    assert all(abs(s - 100.0) < 1e-9 for s in sums.values())


@SETTINGS
@given(rows=rows_st)
def test_contingency_total_is_non_null_rows(spark, rows):
    df = spark.createDataFrame(rows, "g string, w int")
    tab = CT.crosstab(df, ["g", "w"]).collect()
    complete = [(g, w) for g, w in rows if g is not None and w is not None]
    assert sum(r["n"] for r in tab) == len(complete)
    assert len(tab) == len({g for g, _ in complete}) * len({w for _, w in complete})

"""Smaller library paths: per-column apply, random split, type guessing, NA handling."""

from pyspark.sql import functions as F

from insight.operators import bayes as NB
from insight.operators.aggregate import std_error
from insight.operators.profile import apply_per_column
from insight.plans import bookings as B
from insight.sources.delimited import infer_types, normalise_na


def test_apply_per_column(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, 2.0)], "a double, b double")
    out = {r["column"]: r["value"] for r in apply_per_column(df, lambda c: F.sum(c.isNull().cast("int"))).collect()}
    assert out == {"a": 0, "b": 1}


def test_random_split_is_disjoint_and_whole(spark):
    df = spark.range(2000)
    train, test = NB.random_split(df, 0.25, seed=7)
    a, b = train.count(), test.count()
    assert a + b == 2000 and 350 < b < 650
    assert train.join(test, "id").count() == 0


def test_infer_types_all_na_column_stays_text(spark):
    raw = spark.createDataFrame([(" NA ", "1.5", "x"), ("NULL", "2", "2020-01-02")], "a string, b string, c string")
    types = infer_types(normalise_na(raw))
    assert types == {"a": "string", "b": "double", "c": "string"}


def test_std_error_na_rm(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "v double")
    assert std_error(df, None, "v").first()["std_error"] is None
    se = std_error(df, None, "v", na_rm=True).first()["std_error"]
    assert abs(se - 1.0) < 1e-12            # sd = sqrt(2), n = 2


def test_busy_months_divisor_from_data(spark):
    rows = [("H", 2015.0, "July", 3.0), ("H", 2016.0, "July", 3.0), ("H", 2017.0, "July", 3.0),
            ("H", 2016.0, "May", 4.0)]
    df = spark.createDataFrame(rows, "hotel string, arrival_date_year double, arrival_date_month string, guests double")
    out = {r["arrival_date_month"]: (r["n_years"], r["guests_month_norm"])
           for r in B.busy_months_by_year_count(df).collect()}
    assert out == {"July": (3, 3.0), "May": (1, 4.0)}
    fixed = {r["arrival_date_month"]: r["guests_month_norm"] for r in B.busy_months(df).collect()}
    assert fixed == {"July": 3.0, "May": 2.0}                 # 3 for July/August, 2 otherwise

"""Queries whose point is a special value return both special and ordinary ones."""

import math

import pytest

from insight.plans.registry import load_all

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def results(spark):
    plans, _ = load_all()
    return lambda name: plans[name](spark, SF).collect()


def test_rates_are_finite_and_infinite(results):
    texts = [r["rate_person_avg"] for r in results("avg_rate_per_person_text")]
    assert "Inf" in texts and any(t not in ("Inf", "NaN", "NA", "0.00") for t in texts)
    for name, mean, sd in (("rate_by_room_type_band", "mean_rp", "sd_rp"), ("rate_by_month_band", "rate_month_avg", "rate_month_sd")):
        rows = results(name)
        assert any(math.isinf(r[mean]) for r in rows) and any(math.isfinite(r[mean]) and r[mean] > 0 for r in rows)
        assert any(math.isnan(r[sd]) for r in rows) and any(math.isfinite(r[sd]) and r[sd] > 0 for r in rows)
    shown = [r["band_high_shown"] for r in results("rate_by_room_type_band")]
    assert any(s is None for s in shown) and any(s is not None for s in shown)


def test_missing_value_spellings_occur(results):
    assert all(r["n_na"] > 0 for r in results("na_normalise_orders"))


@pytest.mark.parametrize("name", ["freq_2way", "freq_3way", "freq_hotel_cancel_month"])
def test_tables_have_empty_cells(results, name):
    counts = [r["n"] for r in results(name)]
    assert 0 in counts and max(counts) > 0


def test_stop_words_and_reposts_occur(spark, results):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert docs.filter("text RLIKE '(^|[^A-Za-z])(the|de|la)([^A-Za-z]|$)'").count() > 0
    terms = {r["term"] for r in results("vocabulary")}
    assert {"of", "and"} <= terms
    found = results("post_search")
    assert found and docs.filter("text LIKE 'The %'").count() > 0 and not any(r["text"].startswith("The ") for r in found)

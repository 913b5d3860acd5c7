import math

from pyspark.sql import functions as F

from insight.functions.calendar import month_ordinal
from insight.functions.format import fixed2
from insight.functions.html import body_text, link_targets, resolve_url, url_host
from insight.functions.nulls import is_na, r_divide, r_mean, r_sd, r_sum, recode
from insight.functions.text import (bag_of_words_terms, clean_text, contains_word,
                                    flatten_whitespace, letter_tokens, remove_stop_words)


def one(df, expr):
    return df.select(expr.alias("x")).first()["x"]


def test_r_divide_zero_and_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-2.0, 0.0), (0.0, 0.0), (None, 0.0), (3.0, None), (6.0, 3.0)],
                               "n double, d double")
    out = [r["x"] for r in df.select(r_divide("n", "d").alias("x")).collect()]
    assert out[0] == math.inf and out[1] == -math.inf and math.isnan(out[2])
    assert out[3] is None and out[4] is None and out[5] == 2.0


def test_na_propagation_in_aggregates(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    r = df.agg(r_sum("x").alias("s"), r_mean("x").alias("m"), r_sd("x").alias("sd"),
               r_sum("x", na_rm=True).alias("s2")).first()
    assert r["s"] is None and r["m"] is None and r["sd"] is None and r["s2"] == 4.0
    single = spark.createDataFrame([(5.0,)], "x double")
    assert single.agg(r_sd("x").alias("sd")).first()["sd"] is None


def test_is_na_counts_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "x double")
    assert df.filter(is_na("x")).count() == 2


def test_fixed2_matches_c_printf(spark):
    df = spark.createDataFrame([(0.125,), (1.005,), (27.594,), (None,), (float("inf"),),
                                (float("nan"),), (12345678.9,)], "x double")
    out = [r["x"] for r in df.select(fixed2("x").alias("x")).collect()]
    assert out == ["0.12", "1.00", "27.59", "NA", "Inf", "NaN", "12345678.90"]


def test_recode_leaves_null_and_chains(spark):
    df = spark.createDataFrame([("CN",), ("TMP",), (None,), ("PRT",)], "c string")
    out = [r["x"] for r in df.select(recode("c", {"CN": "CHN", "TMP": "TLS"}).alias("x")).collect()]
    assert out == ["CHN", "TLS", None, "PRT"]


def test_month_ordinal_unknown_is_null(spark):
    df = spark.createDataFrame([("January",), ("December",), ("Smarch",)], "m string")
    assert [r["x"] for r in df.select(month_ordinal("m").alias("x")).collect()] == [1, 12, None]


def test_tokens_ascii_letters_case_kept(spark):
    df = spark.createDataFrame([("Café au-lait, x2 Yang yang\nok",)], "t string")
    assert one(df, letter_tokens("t")) == ["Caf", "au", "lait", "x", "Yang", "yang", "ok"]
    # stop words are case-sensitive
    assert one(df, remove_stop_words(letter_tokens("t"), ["yang"])) == ["Caf", "au", "lait", "x", "Yang", "ok"]
    assert one(df, clean_text("t", ["yang"])) == "Caf au lait x Yang ok"
    # bag of words: lower-cased, two letters or more
    assert one(df, bag_of_words_terms(letter_tokens("t"))) == ["caf", "au", "lait", "yang", "yang", "ok"]
    assert one(df, flatten_whitespace("t")) == "Café au-lait, x2 Yang yang ok"


def test_empty_text_tokens(spark):
    df = spark.createDataFrame([("",), ("123 !!",)], "t string")
    assert [r["x"] for r in df.select(clean_text("t").alias("x")).collect()] == ["", ""]


def test_contains_word_whole_words(spark):
    df = spark.createDataFrame([("The cat",), ("bathe",), ("x the",), ("other",)], "t string")
    assert df.filter(contains_word(F.col("t"), "the")).count() == 2


def test_body_text_rules(spark):
    html = ("<html><head><title>T</title><script>var s=\"</p>\";</script></head>"
            "<body class='x'><nav><a href=\"/a\">A&amp;B</a></nav><!-- c -->"
            "<p>Hello <b>wor</b>ld&nbsp;&lt;3</p><style>p{}</style><div>Bye &copy;</div>")
    df = spark.createDataFrame([(html,), ("<body><p>closed</p></body><p>after</p>",), ("no body",)], "h string")
    out = [r["x"] for r in df.select(body_text("h").alias("x")).collect()]
    assert out[0] == "A&B Hello world <3 Bye ©"
    assert out[1] == "closed"
    assert out[2] == "no body"


def test_links_and_resolution(spark):
    df = spark.createDataFrame([("<a href=\"/x\">1</a><a class=k href=\"https://o.org/y\">2</a>"
                                 "<a href=\"z.html\">3</a><a href=\"//cdn.net/q\">4</a>",
                                 "https://Sub.Example.com/dir/page?i=1#top")], "h string, u string")
    hrefs = one(df, link_targets("h"))
    assert hrefs == ["/x", "https://o.org/y", "z.html", "//cdn.net/q"]
    resolved = df.select(F.explode(link_targets("h")).alias("href"), "u") \
                 .select(resolve_url(F.col("href"), F.col("u")).alias("x")).collect()
    assert [r["x"] for r in resolved] == ["https://Sub.Example.com/x", "https://o.org/y",
                                          "https://Sub.Example.com/dir/z.html", "https:" + "//cdn.net/q"]
    assert one(df, url_host("u")) == "sub.example.com"

"""Registered profiling, contingency and statistics queries with SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from insight.operators import columns as C
from insight.operators import contingency as CT
from insight.operators import profile as P
from insight.operators import ranking as R
from insight.operators import stats as S
from insight.operators.aggregate import exact_sum, std_error
from insight.operators.density import density
from insight.plans import bookings as B
from insight.functions.nulls import r_divide
from insight.plans.hotel_queries import RP, bk_sql, clean_sql, rdiv_sql
from insight.plans.registry import register
from insight.sources.checkpoint import new_folder
from insight.sources.tables import read_table

# --------------------------------------------------------------------------
# frames shared by several queries


def _clean_cancel(spark, d, guest=True):
    """``hb_clean_cancel``: cleaned bookings including cancelled ones.

    ``guest=False`` leaves out the customer columns (country, meal) and so
    the customer join, for analyses of the numeric columns only.
    """
    return B.clean_bookings(B.bookings_view(spark, d, calendar=True, guest=guest),
                            keep_cancelled=True, country_recode=B.VIEW_COUNTRY_RECODE,
                            meal_recode=B.VIEW_MEAL_RECODE)


CLEAN_CANCEL_SQL = f"""
SELECT * REPLACE (
  CASE WHEN country = '5' THEN '6' WHEN country = '10' THEN '11' ELSE country END AS country,
  CASE WHEN meal = 'HOUSEHOLD' THEN 'FURNITURE' ELSE meal END AS meal)
FROM ({clean_sql(bk_sql(calendar=True, guest=True), keep_cancelled=True)})"""

NUMERIC_CANCEL_SQL = clean_sql(bk_sql(calendar=True), keep_cancelled=True)


def _labelled_docs(spark, d):
    """documents left-joined to labels: unlabelled documents carry NAs."""
    docs = read_table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(read_table(spark, d, "labels"), "doc_id", "left")


LABELLED_DOCS_SQL = ("SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic "
                     "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")


def _line_numbers(spark, d):
    """Numeric lineitem columns plus a nullable one and an all-zero one."""
    li = read_table(spark, d, "lineitem")
    return li.select("l_quantity", "l_extendedprice", "l_discount", "l_linenumber",
                     F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax_or_na"),
                     F.lit(0.0).alias("zero"))


LINE_NUMBERS_SQL = ("SELECT l_quantity, l_extendedprice, l_discount, l_linenumber, "
                    "nullif(l_tax, 0.0) AS l_tax_or_na, 0.0::DOUBLE AS zero FROM lineitem")

# --------------------------------------------------------------------------
# first / last rows, dimensions, structure

ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@register("head6", f"SELECT {ORDER_COLS} FROM orders ORDER BY o_orderkey LIMIT 6")
def head6(spark, d):
    return R.first_rows(read_table(spark, d, "orders"), "o_orderkey", 6)


@register("tail6", f"SELECT {ORDER_COLS} FROM orders ORDER BY o_orderkey DESC LIMIT 6")
def tail6(spark, d):
    return R.last_rows(read_table(spark, d, "orders"), "o_orderkey", 6)


@register("dims", "SELECT count(*) AS n_rows, 11 AS n_cols FROM lineitem")
def dims(spark, d):
    return P.dims(read_table(spark, d, "lineitem"))


_STRUCT_TYPES = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                 ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"),
                 ("o_orderpriority", "string")]
STRUCTURE_SQL = " UNION ALL ".join(
    f"SELECT {i + 1} AS position, '{c}' AS \"column\", '{t}' AS type, "
    f"(SELECT list(CAST({c} AS VARCHAR) ORDER BY o_orderkey) FROM "
    f"(SELECT * FROM orders ORDER BY o_orderkey LIMIT 5)) AS first_values"
    for i, (c, t) in enumerate(_STRUCT_TYPES))


@register("structure_orders", STRUCTURE_SQL)
def structure_orders(spark, d):
    return P.structure(read_table(spark, d, "orders"), "o_orderkey", 5)


# --------------------------------------------------------------------------
# summaries

SUMMARY_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber", "l_tax_or_na", "zero"]


def _summary_sql(src: str, kinds: dict[str, str]) -> str:
    parts = []
    for c, kind in kinds.items():
        none = ", ".join(f"NULL::DOUBLE AS {s}" for s in ("min", "q1", "median", "mean", "q3", "max"))
        x = f"epoch_us(CAST({c} AS TIMESTAMP)) / 1e6::DOUBLE" if kind == "date" else f"CAST({c} AS DOUBLE)"
        stats = none if kind == "text" else (
            f"min({x}) AS min, quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.5) AS median, avg({x}) AS mean, "
            f"quantile_cont({x}, 0.75) AS q3, max({x}) AS max")
        parts.append(f"SELECT '{c}' AS \"column\", '{kind}' AS kind, count(*) AS n, {stats}, "
                     f"count(*) - count({c}) AS n_na FROM ({src})")
    return " UNION ALL ".join(parts)


@register("column_summary", _summary_sql(LINE_NUMBERS_SQL, dict.fromkeys(SUMMARY_COLS, "numeric")),
          rounded=["mean", "q1", "median", "q3"])
def column_summary(spark, d):
    return P.column_summary(_line_numbers(spark, d))


ORDER_KINDS = {"o_orderkey": "numeric", "o_orderstatus": "text", "o_totalprice": "numeric", "o_orderdate": "date",
               "o_orderpriority": "text", "customer": "text"}
ORDERS_SQL = "SELECT *, CASE WHEN o_custkey % 4 <> 0 THEN 'c' || o_custkey END AS customer FROM orders"


@register("order_summary", _summary_sql(ORDERS_SQL, ORDER_KINDS), rounded=["mean", "q1", "median", "q3"], digits=3)
def order_summary(spark, d):
    """EX6 with number, date and text columns."""
    name = F.when(F.col("o_custkey") % 4 != 0, F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
    return P.column_summary(read_table(spark, d, "orders").withColumn("customer", name), list(ORDER_KINDS))


def _mean_sd_sql() -> str:
    numeric = {"order_key", "part_key", "customer_key", "is_canceled", "adr", "adults", "children",
               "babies", "stays_in_week_nights", "stays_in_weekend_nights", "arrival_date_year",
               "lead_time", "guests"}
    cols = ["order_key", "part_key", "hotel", "is_canceled", "adr", "adults", "children", "babies",
            "stays_in_week_nights", "stays_in_weekend_nights", "customer_key", "arrival_date_year",
            "arrival_date_month", "lead_time", "guests"]
    parts = []
    for c in cols:
        if c in numeric:
            x = f"CAST({c} AS DOUBLE)"
            parts.append(f"SELECT '{c}' AS \"column\", CASE WHEN count({x}) = count(*) THEN avg({x}) END AS mean, "
                         f"CASE WHEN count({x}) = count(*) THEN stddev_samp({x}) END AS sd FROM cc")
        else:
            parts.append(f"SELECT '{c}' AS \"column\", NULL::DOUBLE AS mean, NULL::DOUBLE AS sd")
    return f"WITH cc AS ({NUMERIC_CANCEL_SQL}) " + " UNION ALL ".join(parts)


@register("column_mean_sd", _mean_sd_sql(), rounded=["mean", "sd"])
def column_mean_sd(spark, d):
    return P.column_mean_sd(_clean_cancel(spark, d, guest=False))


UNIQUE_COLS = ["hotel", "is_canceled", "arrival_date_year", "arrival_date_month", "country", "meal"]


@register("column_uniques", f"WITH cc AS ({CLEAN_CANCEL_SQL}) " + " UNION ".join(
    f"SELECT DISTINCT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM cc" for c in UNIQUE_COLS))
def column_uniques(spark, d):
    return P.distinct_values(_clean_cancel(spark, d), UNIQUE_COLS)


@register("lang_levels_first_seen", """
SELECT value, first_key, CAST(row_number() OVER (ORDER BY first_key) AS INTEGER) AS level
FROM (SELECT lang AS value, min(doc_id) AS first_key FROM documents GROUP BY lang)""")
def lang_levels_first_seen(spark, d):
    return P.first_seen_levels(read_table(spark, d, "documents"), "lang", "doc_id")


NA_COLS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]


LEVEL_COLS = ["l_orderkey", "l_linestatus", "l_returnflag", "l_linenumber", "l_discount", "l_extendedprice"]
MOST_LEVELS = 50


@register("column_levels", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", n <= {MOST_LEVELS} AS listed, v AS value FROM (SELECT count(DISTINCT {c}) AS n FROM lineitem), "
    f"(SELECT DISTINCT CASE WHEN (SELECT count(DISTINCT {c}) FROM lineitem) <= {MOST_LEVELS} THEN CAST({c} AS VARCHAR) END AS v FROM lineitem)"
    for c in LEVEL_COLS))
def column_levels(spark, d):
    """EX12 with its guard: values of columns with few levels, one row for each of the others."""
    return P.column_levels(read_table(spark, d, "lineitem"), LEVEL_COLS, MOST_LEVELS).drop("n_levels")


@register("exact_totals", """
SELECT l_linestatus, l_returnflag, fsum(l_extendedprice) AS price, fsum(l_extendedprice * l_discount) AS discount
FROM lineitem GROUP BY l_linestatus, l_returnflag""", rounded=["price", "discount"], digits=4)
def exact_totals(spark, d):
    """T11: sums that do not depend on the order of the rows."""
    li = read_table(spark, d, "lineitem").withColumn("off", F.col("l_extendedprice") * F.col("l_discount"))
    keys = ["l_linestatus", "l_returnflag"]
    return exact_sum(li, keys, "l_extendedprice", "price").join(exact_sum(li, keys, "off", "discount"), keys)


@register("na_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_na FROM ({LABELLED_DOCS_SQL})"
    for c in NA_COLS))
def na_counts(spark, d):
    return P.na_counts(_labelled_docs(spark, d), NA_COLS)


@register("na_positions", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", doc_id FROM ({LABELLED_DOCS_SQL}) WHERE {c} IS NULL"
    for c in NA_COLS if c != "doc_id"))
def na_positions(spark, d):
    return P.na_positions(_labelled_docs(spark, d), "doc_id", NA_COLS)


@register("na_row_numbers", f"""
WITH ld AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS "row" FROM ({LABELLED_DOCS_SQL}))
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", doc_id, \"row\" FROM ld WHERE {c} IS NULL" for c in NA_COLS if c != "doc_id"))
def na_row_numbers(spark, d):
    """EX10 with R's 1-based row numbers (distributed numbering, no single-task sort)."""
    return P.na_positions(_labelled_docs(spark, d), "doc_id", NA_COLS, row_numbers=True)


@register("nonzero_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {i + 1} AS position, "
    f"CASE WHEN count({c}) = count(*) THEN sum(CAST({c} AS DOUBLE)) END AS col_sum, "
    f"CASE WHEN count({c}) = count(*) THEN CAST(count_if({c} <> 0) AS BIGINT) END AS n_nonzero "
    f"FROM ({LINE_NUMBERS_SQL})" for i, c in enumerate(SUMMARY_COLS)), rounded=["col_sum"])
def nonzero_columns(spark, d):
    return C.column_totals(_line_numbers(spark, d))


def _kept_sql(condition: str) -> str:
    """Rows of LINE_NUMBERS_SQL in long form, of the columns that meet a condition on their totals."""
    parts = [f"SELECT '{c}' AS \"column\", sum(CAST({c} AS DOUBLE)) AS total, min(CAST({c} AS DOUBLE)) AS low FROM src "
             f"HAVING count({c}) = count(*) AND {condition.replace('x', c)}" for c in SUMMARY_COLS]
    return f"WITH src AS ({LINE_NUMBERS_SQL}) " + " UNION ALL ".join(parts)


def _total_and_low(df):
    """UF1: one aggregate per column."""
    total = P.apply_per_column(df, lambda c: F.sum(c.cast("double")), name="total")
    return total.join(P.apply_per_column(df, lambda c: F.min(c.cast("double")), name="low"), "column")


@register("keep_nonzero_columns", _kept_sql("count_if(x <> 0) > 0"), rounded=["total"], digits=2)
def keep_nonzero_columns(spark, d):
    """PJ4 + PJ5, shown by what is left of the columns."""
    return _total_and_low(C.keep_nonzero_columns(C.select_numeric(_line_numbers(spark, d))))


@register("keep_positive_sum_columns", _kept_sql("sum(x) > 0"), rounded=["total"], digits=2)
def keep_positive_sum_columns(spark, d):
    """PJ6, shown by what is left of the columns."""
    return _total_and_low(C.keep_positive_sum_columns(_line_numbers(spark, d)))


@register("na_by_column_apply", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS n_na FROM ({LINE_NUMBERS_SQL})"
    for c in SUMMARY_COLS if c != "zero"))
def na_by_column_apply(spark, d):
    """UF1 on the columns that PJ3 leaves."""
    kept = C.drop_columns(_line_numbers(spark, d), ["zero"])
    return P.apply_per_column(kept, lambda c: F.count_if(c.isNull()), name="n_na")


@register("cancel_category", """
SELECT CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END AS status, count(*) AS n FROM lineitem GROUP BY 1""")
def cancel_category(spark, d):
    """PJ13: the cancellation flag as a category."""
    view = B.bookings_view(spark, d)
    return view.groupBy(C.as_category("is_canceled").alias("status")).agg(F.count(F.lit(1)).alias("n"))


@register("headerless_records", """
SELECT d.doc_id, regexp_replace(d.text, '\\s+', ' ', 'g') || '; "' || d.source || '"' AS tweet, l.quality AS sentiment
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def headerless_records(spark, d):
    """IO2: records of the form ``text;label`` without a header, quoted, parsed back."""
    from insight.sources.delimited import parse_lines
    docs = read_table(spark, d, "documents").join(read_table(spark, d, "labels"), "doc_id")
    field = F.concat(F.regexp_replace("text", r"\s+", " "), F.lit('; "'), F.col("source"), F.lit('"'))
    quoted = F.concat(F.lit('"'), F.replace(field, F.lit('"'), F.lit('""')), F.lit('"'))
    lines = docs.select("doc_id", F.concat_ws(";", quoted, F.col("quality").cast("string")).alias("line"))
    return parse_lines(lines, "line", ["tweet", "sentiment"], types={"sentiment": "int"})


@register("count_country_7", f"""
SELECT count(*) AS n FROM ({clean_sql(bk_sql(guest=True))}) WHERE country = '7'""")
def count_country_7(spark, d):
    clean = B.clean_bookings(B.bookings_view(spark, d, guest=True, kept_only=True, nation=7),
                             country_recode=B.VIEW_COUNTRY_RECODE, meal_recode=B.VIEW_MEAL_RECODE)
    return P.count_where(clean, F.col("country") == "7")


@register("fill_agent_company", f"""
SELECT agent = 0 AS no_agent, company = 0 AS no_company, sum(agent + company) AS total, count(*) AS n
FROM (SELECT coalesce(agent, 0.0) AS agent, coalesce(company, 0.0) AS company FROM ({bk_sql(agents=True)}))
GROUP BY 1, 2""")
def fill_agent_company(spark, d):
    """PJ7 on ``agent`` and ``company``."""
    filled = B.clean_bookings(B.bookings_view(spark, d, agents=True), keep_cancelled=True)
    return (filled.groupBy((F.col("agent") == 0).alias("no_agent"), (F.col("company") == 0).alias("no_company"))
            .agg(F.sum(F.col("agent") + F.col("company")).alias("total"), F.count(F.lit(1)).alias("n")))


@register("fill_recode", f"""
SELECT country, meal, children, count(*) AS n FROM ({CLEAN_CANCEL_SQL})
GROUP BY country, meal, children""")
def fill_recode(spark, d):
    return _clean_cancel(spark, d).groupBy("country", "meal", "children").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------
# contingency tables

@register("freq_1way", "SELECT l_linestatus, count(*) AS n FROM lineitem WHERE l_linestatus IS NOT NULL GROUP BY 1")
def freq_1way(spark, d):
    return CT.frequency(read_table(spark, d, "lineitem"), "l_linestatus")


def _grid_sql(cols: list[str], src: str) -> str:
    levels = " CROSS JOIN ".join(f"(SELECT DISTINCT {c} FROM s) AS t{i}" for i, c in enumerate(cols))
    keys = ", ".join(cols)
    on = " AND ".join(f"g.{c} = n.{c}" for c in cols)
    sel = ", ".join(f"g.{c}" for c in cols)
    return f"""
WITH s AS (SELECT {keys} FROM ({src}) WHERE {' AND '.join(f'{c} IS NOT NULL' for c in cols)}),
g AS (SELECT * FROM {levels}),
n AS (SELECT {keys}, count(*) AS n FROM s GROUP BY {keys})
SELECT {sel}, coalesce(n.n, 0) AS n FROM g LEFT JOIN n ON {on}"""


# one combination is left out, so that the tables have empty cells
SHIP_SQL = """SELECT l_linestatus, l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS ship_year FROM lineitem
WHERE NOT (l_linestatus = 'F' AND l_returnflag = 'A')"""


def _ship(spark, d):
    li = read_table(spark, d, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    return li.filter(~((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "A")))


@register("freq_2way", _grid_sql(["l_linestatus", "l_returnflag"], SHIP_SQL))
def freq_2way(spark, d):
    return CT.crosstab(_ship(spark, d), ["l_linestatus", "l_returnflag"])


@register("freq_3way", _grid_sql(["l_linestatus", "l_returnflag", "ship_year"], SHIP_SQL))
def freq_3way(spark, d):
    return CT.crosstab(_ship(spark, d), ["l_linestatus", "l_returnflag", "ship_year"])


@register("freq_2way_wide", """
SELECT l_linestatus, CAST(count_if(l_returnflag = 'A') AS BIGINT) AS "A",
       CAST(count_if(l_returnflag = 'N') AS BIGINT) AS "N", CAST(count_if(l_returnflag = 'R') AS BIGINT) AS "R"
FROM (""" + SHIP_SQL + """) WHERE l_linestatus IS NOT NULL AND l_returnflag IS NOT NULL GROUP BY l_linestatus""")
def freq_2way_wide(spark, d):
    return CT.crosstab_wide(_ship(spark, d), "l_linestatus", "l_returnflag")


@register("freq_hotel_cancel_month", _grid_sql(
    ["hotel", "is_canceled", "arrival_date_month"],
    f"SELECT * FROM ({bk_sql(calendar=True)}) WHERE NOT (hotel = 'F' AND is_canceled = 1 AND arrival_date_month = 'May')"))
def freq_hotel_cancel_month(spark, d):
    view = B.bookings_view(spark, d, calendar=True)
    some = ~((F.col("hotel") == "F") & (F.col("is_canceled") == 1) & (F.col("arrival_date_month") == "May"))
    return CT.crosstab(view.filter(some), ["hotel", "is_canceled", "arrival_date_month"])


# --------------------------------------------------------------------------
# correlation, pair data, box plot, standard error

CORR_COLS = ["adr", "adults", "children", "babies", "stays_in_week_nights",
             "stays_in_weekend_nights", "lead_time", "guests"]
# the reference drops three columns in one place and seven in another; keys stand
# for the further ones here
WIDE_CORR_COLS = ["order_key", "part_key", *CORR_COLS[:6], "customer_key", *CORR_COLS[6:]]
FEW_DROPPED = ["is_canceled", "arrival_date_year"]
MORE_DROPPED = [*FEW_DROPPED, "order_key", "part_key", "customer_key"]


def _corr_sql(cols: list[str], upper: bool) -> str:
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if upper and i > j:
                continue
            parts.append(
                f"SELECT '{a}' AS var_x, '{b}' AS var_y, {i} AS ord_x, {j} AS ord_y, "
                f"round(CASE WHEN count({a}) = count(*) AND count({b}) = count(*) THEN "
                f"covar_samp({a}, {b}) / nullif(stddev_samp({a}) * stddev_samp({b}), 0) END, 6) AS r FROM cc")
    return f"WITH cc AS ({NUMERIC_CANCEL_SQL}) " + " UNION ALL ".join(parts)


def _corr(spark, d, dropped):
    """PJ4, PJ3, AG12: the columns are those that are left, in their order."""
    num = C.drop_columns(C.select_numeric(_clean_cancel(spark, d, guest=False)), dropped)
    return S.correlation_long(num, num.columns)


@register("corr_matrix", _corr_sql(CORR_COLS, False))
def corr_matrix(spark, d):
    return _corr(spark, d, MORE_DROPPED)


@register("corr_matrix_wide", _corr_sql(WIDE_CORR_COLS, False))
def corr_matrix_wide(spark, d):
    return _corr(spark, d, FEW_DROPPED)


@register("corr_upper", _corr_sql(CORR_COLS, True))
def corr_upper(spark, d):
    return S.upper_triangle(_corr(spark, d, MORE_DROPPED))


PAIR_COLS = ["lead_time", "adr", "adults", "stays_in_week_nights", "stays_in_weekend_nights"]
BINS = 10


def _bin_sql(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL THEN NULL WHEN max_{c} = min_{c} THEN 0 "
            f"ELSE CAST(least(floor(({c} - min_{c}) / (max_{c} - min_{c}) * {float(BINS)}), {BINS - 1}) AS INTEGER) END")


def _ranges_sql(cols: list[str]) -> str:
    rng = ", ".join(f"min({c}) AS min_{c}, max({c}) AS max_{c}" for c in cols)
    return f"WITH cc AS ({NUMERIC_CANCEL_SQL}), r AS (SELECT {rng} FROM cc), b AS (SELECT * FROM cc, r) "


def _pair_sql(cols: list[str]) -> str:
    return _ranges_sql(cols) + " UNION ALL ".join(
        f"SELECT '{a}' AS var_x, '{b}' AS var_y, b_x AS bin_x, b_y AS bin_y, count(*) AS n FROM "
        f"(SELECT {_bin_sql(a)} AS b_x, {_bin_sql(b)} AS b_y FROM b) WHERE b_x IS NOT NULL AND b_y IS NOT NULL "
        f"GROUP BY b_x, b_y"
        for i, a in enumerate(cols) for b in cols[i + 1:])


@register("pair_bins", _pair_sql(PAIR_COLS))
def pair_bins(spark, d):
    return S.pair_bins(_clean_cancel(spark, d, guest=False), PAIR_COLS, BINS)


@register("pair_bins_all", _pair_sql(WIDE_CORR_COLS))
def pair_bins_all(spark, d):
    """The pair plot over all numeric columns."""
    num = C.drop_columns(C.select_numeric(_clean_cancel(spark, d, guest=False)), FEW_DROPPED)
    return S.pair_bins(num, num.columns, BINS)


@register("pair_histograms", _ranges_sql(PAIR_COLS) + " UNION ALL ".join(
    f"SELECT '{c}' AS var, bx AS bin, min(min_{c}) AS var_min, min(max_{c}) AS var_max, count(*) AS n FROM "
    f"(SELECT {_bin_sql(c)} AS bx, min_{c}, max_{c} FROM b) WHERE bx IS NOT NULL GROUP BY bx"
    for c in PAIR_COLS))
def pair_histograms(spark, d):
    return S.histogram_long(_clean_cancel(spark, d, guest=False), PAIR_COLS, BINS)


DENSITY_POINTS = 128


@register("pair_density", f"""
WITH cc AS ({NUMERIC_CANCEL_SQL}),
long AS ({" UNION ALL ".join(f"SELECT '{c}' AS var, CAST({c} AS DOUBLE) AS v FROM cc WHERE {c} IS NOT NULL" for c in PAIR_COLS)}),
s AS (SELECT var, count(*) AS n, stddev_samp(v) AS sd, min(v) AS lo, max(v) AS hi,
             (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) / 1.34 AS spread FROM long GROUP BY var HAVING max(v) > min(v)),
b AS (SELECT var, n, lo, (hi - lo) / {DENSITY_POINTS - 1} AS step,
             0.9 * CASE WHEN least(sd, spread) > 0 THEN least(sd, spread) ELSE sd END * pow(n, -0.2) AS width FROM s),
u AS (SELECT var, (v - lo) / step AS u FROM long JOIN b USING (var)),
parts AS (SELECT var, CAST(least(floor(u), {DENSITY_POINTS - 2}) AS INTEGER) AS cell, u FROM u),
weights AS (SELECT var, cell, sum(w) AS w FROM (
  SELECT var, cell, 1 - (u - cell) AS w FROM parts UNION ALL SELECT var, cell + 1, u - cell FROM parts) GROUP BY ALL),
points AS (SELECT CAST(unnest(range(0, {DENSITY_POINTS})) AS INTEGER) AS point)
SELECT var, point, min(lo) + point * min(step) AS x,
       sum(w * exp(-0.5 * pow((point - cell) * step / width, 2))) / (min(n) * min(width) * sqrt(2 * pi())) AS density
FROM weights JOIN b USING (var) CROSS JOIN points GROUP BY var, point""", rounded=["x", "density"], digits=9)
def pair_density(spark, d):
    """PD7 diagonal: the density curves."""
    return density(_clean_cancel(spark, d, guest=False), PAIR_COLS, DENSITY_POINTS)


def _status(df):
    """Status label (PJ14, levels mapped the right way round) and price per night."""
    nights = F.col("stays_in_week_nights") + F.col("stays_in_weekend_nights")
    return (df.withColumn("status", C.label_levels("is_canceled", C.CANCEL_LABELS))
              .withColumn("price_per_night", r_divide("adr", nights)))


STATUS_SQL = ("CASE WHEN is_canceled = 0.0 THEN 'Not Cancelled' WHEN is_canceled = 1.0 THEN 'Cancelled' END "
              "AS status, " + rdiv_sql("adr", "stays_in_week_nights + stays_in_weekend_nights")
              + " AS price_per_night")


def _box_sql(value: str) -> str:
    return f"""
WITH cc AS (SELECT * FROM (SELECT *, {STATUS_SQL} FROM ({NUMERIC_CANCEL_SQL})) WHERE {value} IS NOT NULL),
h AS (SELECT hotel, status, count(*) AS n, quantile_cont({value}, 0.25) AS q1,
             quantile_cont({value}, 0.5) AS median, quantile_cont({value}, 0.75) AS q3
      FROM cc GROUP BY hotel, status),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM h)
SELECT f.hotel, f.status, f.n, f.q1, f.median, f.q3,
       min(CASE WHEN cc.{value} BETWEEN f.lo AND f.hi THEN cc.{value} END) AS lower_whisker,
       max(CASE WHEN cc.{value} BETWEEN f.lo AND f.hi THEN cc.{value} END) AS upper_whisker,
       count(CASE WHEN NOT (cc.{value} BETWEEN f.lo AND f.hi) THEN 1 END) AS n_outliers
FROM cc JOIN f ON cc.hotel = f.hotel AND cc.status = f.status
GROUP BY f.hotel, f.status, f.n, f.q1, f.median, f.q3"""


@register("boxplot_stats", _box_sql("lead_time"), rounded=["q1", "median", "q3"])
def boxplot_stats(spark, d):
    return S.boxplot_stats(_status(_clean_cancel(spark, d, guest=False)), ["hotel", "status"], "lead_time")


@register("boxplot_stats_price_per_night", _box_sql("price_per_night"),
          rounded=["q1", "median", "q3", "lower_whisker", "upper_whisker"])
def boxplot_stats_price_per_night(spark, d):
    return S.boxplot_stats(_status(_clean_cancel(spark, d, guest=False)), ["hotel", "status"],
                           "price_per_night")


@register("boxplot_outliers", f"""
WITH cc AS (SELECT * FROM (SELECT *, {STATUS_SQL} FROM ({NUMERIC_CANCEL_SQL})) WHERE price_per_night IS NOT NULL),
f AS (SELECT hotel, status, quantile_cont(price_per_night, 0.25) AS q1,
             quantile_cont(price_per_night, 0.75) AS q3
      FROM cc GROUP BY hotel, status)
SELECT cc.hotel, cc.status, cc.order_key, cc.price_per_night FROM cc
JOIN f ON cc.hotel = f.hotel AND cc.status = f.status
WHERE NOT (cc.price_per_night BETWEEN f.q1 - 1.5 * (f.q3 - f.q1) AND f.q3 + 1.5 * (f.q3 - f.q1))""",
          rounded=["price_per_night"])
def boxplot_outliers(spark, d):
    return S.boxplot_outliers(_status(_clean_cancel(spark, d, guest=False)), ["hotel", "status"], "price_per_night",
                              key=["order_key"])


@register("std_error", f"""
SELECT hotel, reserved_room_type,
       CASE WHEN count(rate_person) = count(*) THEN stddev_samp(rate_person) END / sqrt(count(*)) AS std_error
FROM (SELECT *, {RP} AS rate_person FROM (
  SELECT * REPLACE (coalesce(children, 0.0) AS children) FROM ({bk_sql(room=True)})
  WHERE is_canceled = 0 AND (adults + children) > 0))
GROUP BY hotel, reserved_room_type""", rounded=["std_error"])
def std_error_query(spark, d):
    raw = B.bookings_view(spark, d, room=True)
    df = (raw.filter((F.col("is_canceled") == 0) & ((F.col("adults") + F.col("children")) > 0))
          .withColumn("children", F.coalesce("children", F.lit(0.0))))
    return std_error(B.rate_person(df), ["hotel", "reserved_room_type"], "rate_person")


# --------------------------------------------------------------------------
# IO1 query form: the reader's NA normaliser on text casts of a driver table

NA_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


#: Spellings planted by key, some with blanks around them (the reader trims).
PLANTED = ("", "NA", " NULL ", "NaN", "null", " Null", "<NA>", "n/a", "  ")


def _planted_sql(c: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(PLANTED))
    return f"CASE (o_orderkey + length('{c}')) % 31 {whens} ELSE CAST({c} AS VARCHAR) END"


@register("na_normalise_orders", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count_if(v IS NULL OR trim(v) IN "
    f"('', 'NA', 'NULL', 'NaN', 'null', 'Null', '<NA>')) AS BIGINT) AS n_na "
    f"FROM (SELECT {_planted_sql(c)} AS v FROM orders)" for c in NA_ORDER_COLS))
def na_normalise_orders(spark, d):
    """Every column read as text, the seven NA spellings planted, trimmed and
    turned into null (as the CSV reader does), then NA counts per column."""
    from insight.sources.delimited import normalise_na

    def planted(c):
        slot, out = (F.col("o_orderkey") + len(c)) % 31, F.col(c).cast("string")
        for i, t in enumerate(PLANTED):
            out = F.when(slot == i, F.lit(t)).otherwise(out)
        return out.alias(c)

    text = read_table(spark, d, "orders").select(*[planted(c) for c in NA_ORDER_COLS])
    return P.na_counts(normalise_na(text), NA_ORDER_COLS)


# --------------------------------------------------------------------------
# files without a key: the driver tables written as text and read back


def _written(df, key: str, header: bool = True) -> str:
    """Path of ``df`` as CSV files in key order."""
    path = new_folder(df.sparkSession, "csv")
    df.orderBy(key).write.option("header", header).option("escape", '"').csv(path)
    return path


FILE_COLS = ["o_custkey", "o_orderstatus", "o_orderpriority"]
FILE_SQL = f"SELECT row_number() OVER (ORDER BY o_orderkey) AS \"row\", {', '.join(FILE_COLS)} FROM orders"


@register("file_head_tail", f"""
WITH f AS ({FILE_SQL})
SELECT "row", CAST(o_custkey AS DOUBLE) AS o_custkey, o_orderstatus, o_orderpriority FROM f
WHERE "row" <= 6 OR "row" > (SELECT count(*) FROM f) - 6""")
def file_head_tail(spark, d):
    """EX1, EX2 on files without a key: the first and last six rows by their number."""
    from insight.sources.delimited import read_delimited
    path = _written(read_table(spark, d, "orders").select("o_orderkey", *FILE_COLS), "o_orderkey")
    rows = read_delimited(spark, path, row_numbers="row").select("row", *FILE_COLS)
    return R.first_rows(rows, "row", 6).unionByName(R.last_rows(rows, "row", 6)).distinct()


FILE_NA_COLS = ["lang", "n_chars", "quality", "toxic"]


@register("file_na_rows", f"""
WITH ld AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS "row" FROM ({LABELLED_DOCS_SQL}))
""" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", \"row\" FROM ld WHERE {c} IS NULL" for c in FILE_NA_COLS))
def file_na_rows(spark, d):
    """EX10, WN4 on files without a key: NA cells by row number."""
    from insight.sources.delimited import read_delimited
    path = _written(_labelled_docs(spark, d).select("doc_id", *FILE_NA_COLS), "doc_id")
    rows = read_delimited(spark, path, row_numbers="row").select("row", *FILE_NA_COLS)
    return P.na_positions(rows, "row", FILE_NA_COLS)


#: Columns of every kind, some mixed, with missing cells in between.
TYPED_COLS = {
    "flag": "CASE WHEN o_orderkey % 3 = 0 THEN 'TRUE' WHEN o_orderkey % 3 = 1 THEN 'F' ELSE 'NA' END",
    "whole": "CAST(o_custkey AS STRING)", "amount": "CAST(o_totalprice AS STRING)", "day": "date_format(o_orderdate, 'yyyy-MM-dd')",
    "clock": "CASE WHEN o_orderkey % 7 = 0 THEN '<NA>' ELSE concat('1', CAST(o_orderkey % 10 AS STRING), ':30') END",
    "stamp": "CASE WHEN o_orderkey % 2 = 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') ELSE date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') END",
    "code": "lpad(CAST(o_custkey AS STRING), 12, '0')", "mixed": "CASE WHEN o_orderkey % 5 = 0 THEN 'none' ELSE CAST(o_totalprice AS STRING) END",
    "words": "o_orderpriority", "nothing": "CASE WHEN o_orderkey % 2 = 0 THEN 'NULL' ELSE '' END", "numbers": "CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS STRING) ELSE '1e3' END",
}
TYPED_SQL = {c: x.replace("AS STRING", "AS VARCHAR").replace("date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')", "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')")
             .replace("date_format(o_orderdate, 'yyyy-MM-dd')", "strftime(o_orderdate, '%Y-%m-%d')") for c, x in TYPED_COLS.items()}


def _type_sql(c: str) -> str:
    tests = {"boolean": "v IN ('TRUE', 'FALSE', 'T', 'F')",
             "int": "try_cast(v AS INTEGER) IS NOT NULL AND v NOT LIKE '0_%' AND NOT contains(v, 'e') AND NOT contains(v, '.')",
             "double": "try_cast(v AS DOUBLE) IS NOT NULL AND (v NOT LIKE '0_%' OR v LIKE '0.%')",
             "date": "length(v) = 10 AND try_cast(v AS DATE) IS NOT NULL",
             "interval hour to second": "length(v) IN (5, 8) AND try_cast(v || ':00' AS TIME) IS NOT NULL",
             "timestamp": "try_cast(v AS TIMESTAMP) IS NOT NULL"}
    whens = " ".join(f"WHEN bool_and({x}) FILTER (v IS NOT NULL) THEN '{t}'" for t, x in tests.items())
    cell = TYPED_SQL[c]
    return (f"SELECT '{c}' AS \"column\", CASE WHEN count(v) = 0 THEN 'string' {whens} ELSE 'string' END AS type, count(*) - count(v) AS n_na "
            f"FROM (SELECT CASE WHEN {cell} IN ('', 'NA', 'NULL', '<NA>') THEN NULL ELSE {cell} END AS v FROM orders)")


@register("file_types", " UNION ALL ".join(_type_sql(c) for c in TYPED_COLS))
def file_types(spark, d):
    """IO1: the types that the reader guesses for a file, and the NA cells that it leaves after the casts."""
    from insight.sources.delimited import read_delimited
    src = read_table(spark, d, "orders").select("o_orderkey", *[F.expr(x).alias(c) for c, x in TYPED_COLS.items()])
    df = read_delimited(spark, _written(src, "o_orderkey"), integers=True).select(*TYPED_COLS)
    types = F.create_map(*[F.lit(x) for c, t in df.dtypes for x in (c, t)])
    return P.na_counts(df).select("column", types[F.col("column")].alias("type"), "n_na")


@register("quoted_records", """
SELECT doc_id, text AS tweet, source AS sentiment FROM documents WHERE text IS NOT NULL""")
def quoted_records(spark, d):
    """IO1, IO2: quoted fields with line breaks, read by many tasks and put together again."""
    from insight.sources.delimited import parse_lines, read_records
    docs = read_table(spark, d, "documents").where("text IS NOT NULL")
    quoted = F.concat(F.lit('"'), F.replace(F.col("text"), F.lit('"'), F.lit('""')), F.lit('"'))
    path = new_folder(spark, "records")
    docs.select(F.concat_ws(";", F.col("doc_id").cast("string"), quoted, F.col("source"))).write.text(path)
    return parse_lines(read_records(spark, path), "record", ["doc_id", "tweet", "sentiment"], types={"doc_id": "bigint"}).drop("row")


@register("lines_round_trip", """
SELECT row_number() OVER (ORDER BY doc_id, i) AS "row", line AS text FROM (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i
  FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))""")
def lines_round_trip(spark, d):
    """IO3, IO4: texts written as lines and read back with their line numbers."""
    from insight.sources.textfile import read_numbered_lines, write_lines
    path = new_folder(spark, "lines")
    write_lines(read_table(spark, d, "documents").orderBy("doc_id"), path)
    return read_numbered_lines(spark, path)

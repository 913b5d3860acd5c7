"""Registered bookings analyses over the driver tables, each with its SQL oracle."""

from __future__ import annotations

from insight.functions.calendar import MONTHS
from insight.plans import bookings as B
from insight.plans.registry import register

# --------------------------------------------------------------------------
# SQL building blocks (DuckDB dialect) mirroring bookings.bookings_view


def bk_sql(calendar: bool = False, guest: bool = False, room: bool = False, agents: bool = False) -> str:
    cols = [
        "l.l_orderkey AS order_key", "l.l_partkey AS part_key", "l.l_linestatus AS hotel",
        "CASE WHEN l.l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_canceled",
        "l.l_extendedprice AS adr",
        "CASE WHEN l.l_linestatus = 'F' AND l.l_partkey % 7 = 0 THEN 0.0::DOUBLE "
        "ELSE CAST(l.l_linenumber AS DOUBLE) END AS adults",
        "nullif(round(l.l_tax * 100.0), 0.0) AS children",
        "CAST(floor(l.l_quantity / 25.0) AS DOUBLE) AS babies",
        "CAST(l.l_linenumber AS DOUBLE) AS stays_in_week_nights",
        "CAST(floor(l.l_discount * 100.0 / 4.0) AS DOUBLE) AS stays_in_weekend_nights",
    ]
    if agents:
        cols += ["CASE WHEN l.l_suppkey % 5 <> 0 THEN CAST(l.l_suppkey AS DOUBLE) END AS agent",
                 "CASE WHEN l.l_partkey % 3 <> 0 THEN CAST(l.l_partkey AS DOUBLE) END AS company"]
    src = "lineitem l"
    if calendar or guest:
        cols += ["o.o_custkey AS customer_key",
                 "CAST(year(o.o_orderdate) AS DOUBLE) AS arrival_date_year",
                 "monthname(o.o_orderdate) AS arrival_date_month",
                 "CAST(CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE) AS DOUBLE) AS lead_time"]
        src += " JOIN orders o ON l.l_orderkey = o.o_orderkey"
    if guest:
        cols += ["CAST(c.c_nationkey AS VARCHAR) AS country", "c.c_mktsegment AS meal"]
        src += " JOIN customer c ON o.o_custkey = c.c_custkey"
    if room:
        cols += ["p.p_type AS reserved_room_type"]
        src += " JOIN part p ON l.l_partkey = p.p_partkey"
    return f"SELECT {', '.join(cols)} FROM {src}"


# cleaned bookings: children filled, guests added, non-cancelled with guests
CLEAN_COLS = "* REPLACE (coalesce(children, 0.0) AS children)"


def clean_sql(bk: str, keep_cancelled: bool = False) -> str:
    where = "" if keep_cancelled else "WHERE is_canceled = 0 AND guests > 0"
    return (f"SELECT * FROM (SELECT *, adults + children + babies AS guests FROM "
            f"(SELECT {CLEAN_COLS} FROM ({bk}))) {where}")


def fixed2_sql(x: str) -> str:
    return (f"CASE WHEN ({x}) IS NULL THEN 'NA' WHEN isnan({x}) THEN 'NaN' "
            f"WHEN ({x}) = 'inf'::DOUBLE THEN 'Inf' WHEN ({x}) = '-inf'::DOUBLE THEN '-Inf' "
            f"ELSE printf('%.2f', {x}) END")


def rdiv_sql(n: str, d: str) -> str:
    return (f"CASE WHEN ({n}) IS NULL OR ({d}) IS NULL THEN NULL "
            f"WHEN ({d}) = 0 THEN CASE WHEN ({n}) > 0 THEN 'inf'::DOUBLE "
            f"WHEN ({n}) < 0 THEN '-inf'::DOUBLE ELSE 'nan'::DOUBLE END "
            f"ELSE CAST({n} AS DOUBLE) / ({d}) END")


def rmean_sql(x: str) -> str:
    return f"CASE WHEN count({x}) = count(*) THEN avg({x}) END"


def rsd_sql(x: str) -> str:
    return f"CASE WHEN count({x}) = count(*) THEN stddev_samp({x}) END"


def rsum_sql(x: str) -> str:
    return f"CASE WHEN count({x}) = count(*) THEN sum({x}) END"


MONTH_ORD_SQL = ("CASE arrival_date_month " + " ".join(f"WHEN '{m}' THEN {i + 1}" for i, m in enumerate(MONTHS)) + " END")

DIM_SQL = ("SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS country_name "
           "FROM nation WHERE n_regionkey <> 0")

ORIGIN_SQL = f"""
WITH clean AS ({clean_sql(bk_sql())}),
per_code AS (
  SELECT CASE WHEN cc = '5' THEN '6' WHEN cc = '10' THEN '11' ELSE cc END AS country,
         sum(guests) AS guests
  FROM (SELECT coalesce(CAST(c.c_nationkey AS VARCHAR), 'unknown') AS cc, cl.guests
        FROM clean cl JOIN orders o ON cl.order_key = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey)
  GROUP BY 1),
origin AS (
  SELECT d.country_name, sum(p.guests) AS guests_country
  FROM per_code p LEFT JOIN ({DIM_SQL}) d ON p.country = d.code GROUP BY 1),
shares AS (
  SELECT country_name, guests_country,
         {fixed2_sql("guests_country * 100.0 / (SELECT sum(guests_country) FROM origin)")} AS guest_pct
  FROM origin)
"""


def _origin(spark, d, ordered=True):
    return B.guest_origin(B.guests_by_country(spark, d), B.country_dim(spark, d), ordered)


@register("guest_origin_share", ORIGIN_SQL + "SELECT * FROM shares")
def guest_origin_share(spark, d):
    return _origin(spark, d)


@register("guest_origin_top5_numeric", ORIGIN_SQL + """
SELECT country_name, guests_country, guest_pct FROM shares
WHERE guests_country IS NOT NULL
QUALIFY rank() OVER (ORDER BY guests_country DESC) <= 5""")
def guest_origin_top5_numeric(spark, d):
    return B.guest_origin_top(_origin(spark, d, ordered=False), 5, "guests_country")


@register("guest_origin_top5_text_weight", ORIGIN_SQL + """
SELECT country_name, guests_country, guest_pct FROM shares
WHERE guest_pct IS NOT NULL
QUALIFY rank() OVER (ORDER BY guest_pct DESC) <= 5""")
def guest_origin_top5_text_weight(spark, d):
    return B.guest_origin_top(_origin(spark, d, ordered=False), 5, "guest_pct")


# --------------------------------------------------------------------------
# rates

def _clean(spark, d, **kw):
    return B.clean_bookings(B.bookings_view(spark, d, kept_only=True, **kw),
                            country_recode=B.VIEW_COUNTRY_RECODE, meal_recode=B.VIEW_MEAL_RECODE)


@register("total_guests", f"SELECT {rsum_sql('guests')} AS total_guests FROM ({clean_sql(bk_sql())})")
def total_guests(spark, d):
    """AG1: the grand total of guests over the cleaned bookings (one row)."""
    from insight.operators.aggregate import grand_total
    return grand_total(_clean(spark, d), "guests", "total_guests")


@register("avg_rate", f"""
SELECT hotel, {rmean_sql('adr')} AS rate_avg
FROM ({clean_sql(bk_sql())}) GROUP BY hotel""", rounded=["rate_avg"])
def avg_rate(spark, d):
    return B.avg_rate(_clean(spark, d))


RP = rdiv_sql("adr", "adults + children")


@register("avg_rate_per_person_text", f"""
SELECT hotel, {fixed2_sql(rmean_sql('rate_person'))} AS rate_person_avg
FROM (SELECT *, {RP} AS rate_person FROM ({clean_sql(bk_sql())})) GROUP BY hotel""")
def avg_rate_per_person_text(spark, d):
    return B.avg_rate_per_person_text(_clean(spark, d))


def _band_sql(keys: str, mean: str, sd: str, bk: str, limits=None, extra: str = "") -> str:
    shown = ""
    if limits is not None:
        lo, hi = limits
        shown = "".join(
            f", CASE WHEN {c} BETWEEN {lo} AND {hi} THEN {c} END AS {c}_shown"
            for c in (mean, "band_low", "band_high"))
    return f"""
SELECT *{shown}{extra} FROM (
  SELECT *, {mean} - {sd} AS band_low, {mean} + {sd} AS band_high FROM (
    SELECT {keys}, {rmean_sql('rate_person')} AS {mean}, {rsd_sql('rate_person')} AS {sd}
    FROM (SELECT *, {RP} AS rate_person FROM ({clean_sql(bk)})) GROUP BY {keys}))"""


# the prices of the driver tables are higher than the reference's rates
ROOM_LIMITS = tuple(140.0 * x for x in B.ROOM_RATE_LIMITS)


BAND_ROUND = ["band_low", "band_high"]


@register("rate_by_room_type_band",
          _band_sql("hotel, reserved_room_type", "mean_rp", "sd_rp", bk_sql(room=True), ROOM_LIMITS),
          rounded=["mean_rp", "sd_rp", "mean_rp_shown", "band_low_shown", "band_high_shown"] + BAND_ROUND)
def rate_by_room_type_band(spark, d):
    return B.rate_by_room_type_band(_clean(spark, d, room=True), ROOM_LIMITS)


@register("rate_by_month_band",
          _band_sql("hotel, arrival_date_month", "rate_month_avg", "rate_month_sd",
                    bk_sql(calendar=True), None, f", {MONTH_ORD_SQL} AS month_ord"),
          rounded=["rate_month_avg", "rate_month_sd"] + BAND_ROUND)
def rate_by_month_band(spark, d):
    return B.rate_by_month_band(_clean(spark, d, calendar=True))


# --------------------------------------------------------------------------
# busy months

BUSY_LIMITS = B.BUSY_LIMITS


def _busy_sql(limits=None) -> str:
    shown = (f", CASE WHEN guests_month_norm BETWEEN {limits[0]} AND {limits[1]} "
             f"THEN guests_month_norm END AS guests_month_norm_shown") if limits else ""
    return f"""
SELECT *{shown} FROM (
  SELECT hotel, arrival_date_month, guests_month,
         CASE WHEN arrival_date_month IS NULL THEN NULL
              WHEN arrival_date_month IN ('July', 'August') THEN guests_month / 3.0
              ELSE guests_month / 2.0 END AS guests_month_norm,
         {MONTH_ORD_SQL} AS month_ord
  FROM (SELECT hotel, arrival_date_month, {rsum_sql('guests')} AS guests_month
        FROM ({clean_sql(bk_sql(calendar=True))}) GROUP BY hotel, arrival_date_month))"""


@register("busy_months_normalised", _busy_sql())
def busy_months_normalised(spark, d):
    return B.busy_months(_clean(spark, d, calendar=True))


@register("busy_months_censored", _busy_sql(BUSY_LIMITS))
def busy_months_censored(spark, d):
    return B.busy_months(_clean(spark, d, calendar=True), BUSY_LIMITS)


@register("busy_months_by_year_count", f"""
SELECT hotel, arrival_date_month, guests_month, n_years,
       guests_month / n_years AS guests_month_norm, {MONTH_ORD_SQL} AS month_ord
FROM (SELECT hotel, arrival_date_month, {rsum_sql('guests')} AS guests_month,
             count(DISTINCT arrival_date_year) AS n_years
      FROM ({clean_sql(bk_sql(calendar=True))}) GROUP BY hotel, arrival_date_month)""")
def busy_months_by_year_count(spark, d):
    return B.busy_months_by_year_count(_clean(spark, d, calendar=True))


# --------------------------------------------------------------------------
# stay length

STAY_SQL = f"""
WITH g AS (
  SELECT hotel, total_nights, count(*) AS num_trx FROM (
    SELECT *, stays_in_week_nights + stays_in_weekend_nights AS total_nights
    FROM ({clean_sql(bk_sql())})) WHERE total_nights > 0
  GROUP BY hotel, total_nights),
s AS (
  SELECT g.hotel, g.total_nights, g.num_trx,
         round({rdiv_sql('g.num_trx * 100.0', 't.tot')}, 2) AS num_trx_pct
  FROM g LEFT JOIN (SELECT hotel, sum(num_trx) AS tot FROM g GROUP BY hotel) t ON g.hotel = t.hotel)
"""


@register("stay_length_share", STAY_SQL + "SELECT * FROM s")
def stay_length_share(spark, d):
    return B.stay_length_share(_clean(spark, d))


@register("stay_length_top5_per_group", STAY_SQL + """
SELECT * FROM s WHERE num_trx_pct IS NOT NULL
QUALIFY rank() OVER (PARTITION BY hotel ORDER BY num_trx_pct DESC) <= 5""")
def stay_length_top5_per_group(spark, d):
    return B.stay_length_top(_clean(spark, d), 5)


# --------------------------------------------------------------------------
# year / month totals and prices (filter before fill)

def _raw_month_sql(year=None) -> str:
    yc = f" AND arrival_date_year = {year}" if year is not None else ""
    return f"""
SELECT * REPLACE (coalesce(children, 0.0) AS children,
                  CASE WHEN hotel = 'City Hotel' THEN 'city_hotel'
                       WHEN hotel = 'Resort Hotel' THEN 'resort_hotel' ELSE hotel END AS hotel)
FROM ({bk_sql(calendar=True)})
WHERE is_canceled = 0 AND (adults + children) > 0{yc}"""


@register("totals_by_year_month", f"""
SELECT hotel, arrival_date_year, arrival_date_month,
       {rsum_sql('adults + children + babies')} AS guest_month_total, {MONTH_ORD_SQL} AS month_ord
FROM ({_raw_month_sql()}) GROUP BY hotel, arrival_date_year, arrival_date_month""")
def totals_by_year_month(spark, d):
    return B.totals_by_year_month(B.bookings_view(spark, d, calendar=True, kept_only=True))


PRICE_YEAR = 1998.0


@register("year_price_by_month", f"""
SELECT hotel, arrival_date_year, arrival_date_month,
       {rmean_sql(RP)} AS month_avg, {MONTH_ORD_SQL} AS month_ord
FROM ({_raw_month_sql(PRICE_YEAR)}) GROUP BY hotel, arrival_date_year, arrival_date_month""",
          rounded=["month_avg"])
def year_price_by_month(spark, d):
    return B.year_price_by_month(B.bookings_view(spark, d, calendar=True, year=int(PRICE_YEAR), kept_only=True), PRICE_YEAR)

"""Hotel-booking analyses as DataFrame plans.

Two layers:

1. Analyses on a *bookings* frame with the hotel schema (``hotel``,
   ``is_canceled``, ``adr``, ``adults``, ``children``, ``babies``,
   ``country``, ``meal``, ``arrival_date_year``, ``arrival_date_month``,
   ``stays_in_week_nights``, ``stays_in_weekend_nights``,
   ``reserved_room_type``).  They work on a bookings CSV read with
   :func:`insight.sources.read_delimited` as well as on the view below.
2. :func:`bookings_view` derives that schema from the driver tables
   (lineitem, orders, customer, part, nation) so every analysis runs over
   whole tables and grows with them.  Joins are added only for the columns
   an analysis needs.

Fixed mapping of the driver tables onto the bookings schema:

    hotel                    <- l_linestatus
    is_canceled              <- 1.0 if l_returnflag = 'R' else 0.0
    adr                      <- l_extendedprice
    adults                   <- l_linenumber, but 0 for every seventh part of
                                line status F: some groups of rates divide by
                                zero, the others are finite
    children                 <- nullif(round(l_tax * 100), 0)   (nullable)
    agent, company           <- l_suppkey and l_partkey, null for every fifth
                                and third key (on request)
    babies                   <- floor(l_quantity / 25)
    stays_in_week_nights     <- l_linenumber
    stays_in_weekend_nights  <- floor(l_discount * 100 / 4)
    arrival_date_year        <- year(o_orderdate)
    arrival_date_month       <- English month name of o_orderdate
    lead_time                <- days from o_orderdate to l_shipdate
    country                  <- c_nationkey as text
    meal                     <- c_mktsegment
    reserved_room_type       <- p_type
    country dimension        <- nation rows with n_regionkey <> 0
                                (codes of region 0 stay unmatched)
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from insight.functions.calendar import month_name, month_ordinal
from insight.functions.format import fixed2, round_half_up
from insight.functions.nulls import fill_na, r_divide, r_mean, r_sd, r_sum, recode
from insight.operators.aggregate import share_of_total, share_within
from insight.operators.ranking import top_n
from insight.operators.stats import censor
from insight.sources.tables import read_table

# The recodes and fills of the bookings cleaning step.
COUNTRY_RECODE = {"CN": "CHN", "TMP": "TLS"}
MEAL_RECODE = {"Undefined": "SC"}
FILL_ZERO = ("children", "agent", "company")
FILL_COUNTRY = "unknown"

# Plot axis limits of the reference (per-person rate by room type;
# guests per month).
ROOM_RATE_LIMITS = (0.0, 120.0)
BUSY_LIMITS = (1500.0, 4500.0)

# Driver-table analogues of the two recodes (codes of region 0 have no name in
# the dimension; two of them are recoded onto named codes, as CN -> CHN).
VIEW_COUNTRY_RECODE = {"5": "6", "10": "11"}
VIEW_MEAL_RECODE = {"HOUSEHOLD": "FURNITURE"}


# --------------------------------------------------------------------------
# driver-table view

def bookings_view(spark: SparkSession, sf_dir: str, calendar: bool = False,
                  guest: bool = False, room: bool = False, year: int | None = None,
                  kept_only: bool = False, nation: int | None = None, agents: bool = False) -> DataFrame:
    """Bookings-shaped frame from the driver tables; joins only what is asked for.

    ``year`` keeps arrivals of one year as a date-range predicate on the
    order date, which reaches the parquet scan (``year(d) = y`` would not)
    and lets date-clustered files skip row groups.  ``kept_only`` leaves out
    cancelled bookings and ``nation`` keeps the guests of one nation, as
    predicates on the stored columns, which reach the scan as well.
    ``agents`` adds the nullable ``agent`` and ``company``.
    """
    li = read_table(spark, sf_dir, "lineitem")
    if kept_only:
        li = li.filter((F.col("l_returnflag") != "R") | F.col("l_returnflag").isNull())
    no_adults = (F.col("l_linestatus") == "F") & (F.col("l_partkey") % 7 == 0)
    df = li.select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_linestatus").alias("hotel"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("is_canceled"),
        F.col("l_extendedprice").alias("adr"),
        F.when(no_adults, 0.0).otherwise(F.col("l_linenumber").cast("double")).alias("adults"),
        F.nullif(F.round(F.col("l_tax") * 100.0), F.lit(0.0)).alias("children"),
        F.floor(F.col("l_quantity") / 25.0).cast("double").alias("babies"),
        F.col("l_linenumber").cast("double").alias("stays_in_week_nights"),
        F.floor(F.col("l_discount") * 100.0 / 4.0).cast("double").alias("stays_in_weekend_nights"),
        *([F.col("l_shipdate")] if (calendar or guest or year is not None) else []),
        *([F.when(F.col("l_suppkey") % 5 != 0, F.col("l_suppkey").cast("double")).alias("agent"),
           F.when(F.col("l_partkey") % 3 != 0, F.col("l_partkey").cast("double")).alias("company")] if agents else []),
    )
    if calendar or guest or year is not None:
        orders = read_table(spark, sf_dir, "orders")
        if year is not None:
            d = F.col("o_orderdate")
            orders = orders.filter((d >= F.lit(f"{year:04d}-01-01").cast("timestamp_ntz"))
                                   & (d < F.lit(f"{year + 1:04d}-01-01").cast("timestamp_ntz")))
        o = orders.select(
            F.col("o_orderkey").alias("order_key"),
            F.col("o_custkey").alias("customer_key"),
            F.year("o_orderdate").cast("double").alias("arrival_date_year"),
            month_name("o_orderdate").alias("arrival_date_month"),
            F.col("o_orderdate"),
        )
        df = (df.join(o, "order_key")
              .withColumn("lead_time", F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))
                          .cast("double"))
              .drop("o_orderdate", "l_shipdate"))
    if guest:
        customers = read_table(spark, sf_dir, "customer")
        if nation is not None:
            customers = customers.filter(F.col("c_nationkey") == nation)
        c = customers.select(
            F.col("c_custkey").alias("customer_key"),
            F.col("c_nationkey").cast("string").alias("country"),
            F.col("c_mktsegment").alias("meal"),
        )
        df = df.join(c, "customer_key")
    if room:
        p = read_table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("part_key"), F.col("p_type").alias("reserved_room_type"))
        df = df.join(p, "part_key")
    return df


def country_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code -> name dimension (unique on code); region-0 codes left out on purpose."""
    return (read_table(spark, sf_dir, "nation")
            .filter(F.col("n_regionkey") != 0)
            .select(F.col("n_nationkey").cast("string").alias("code"),
                    F.col("n_name").alias("country_name")))


# --------------------------------------------------------------------------
# cleaning (PJ7, PJ8, PJ10, FL1, PJ15) and the name lookup (JN1)

def clean_bookings(df: DataFrame, keep_cancelled: bool = False,
                   country_recode: Mapping[str, str] = COUNTRY_RECODE,
                   meal_recode: Mapping[str, str] = MEAL_RECODE) -> DataFrame:
    """Fill, recode, add ``guests`` and (unless ``keep_cancelled``) keep
    non-cancelled bookings with at least one guest.

    The country-name lookup is not part of this step: joining the dimension
    only where the name is read keeps it out of every other plan.
    """
    cols = set(df.columns)
    out = df
    for c in FILL_ZERO:
        if c in cols:
            out = out.withColumn(c, fill_na(c, 0.0))
    if "country" in cols:
        out = out.withColumn("country", recode(fill_na("country", FILL_COUNTRY), country_recode))
    if "meal" in cols:
        out = out.withColumn("meal", recode("meal", meal_recode))
    out = out.withColumn("guests", F.col("adults") + F.col("children") + F.col("babies"))
    if not keep_cancelled:
        out = out.filter((F.col("is_canceled") == 0) & (F.col("guests") > 0))
    return out


def with_country_name(df: DataFrame, dim: DataFrame, code: str = "country") -> DataFrame:
    """JN1: left lookup of the country name; an unknown code gives a null name."""
    d = dim.select(F.col("code").alias("__code"), "country_name")
    return df.join(d, df[code] == d["__code"], "left").drop("__code")


# --------------------------------------------------------------------------
# 6. where do the guests come from (AG1, AG2, SO1, SC2, WN2, SO2, PD1)

def guest_origin(guests_by_code: DataFrame, dim: DataFrame, ordered: bool = True) -> DataFrame:
    """Guests per country name with the share of all guests as text.

    ``guests_by_code`` holds ``(country, guests)`` -- bookings or any
    pre-aggregate of them.  Summing per code first, then looking names up and
    re-summing per name joins the dimension against one row per code instead
    of one row per booking; several codes (or all unmatched codes) may share
    a name, hence the second sum.
    """
    per_code = guests_by_code.groupBy("country").agg(F.sum("guests").alias("guests"))
    named = with_country_name(per_code, dim)
    origin = named.groupBy("country_name").agg(r_sum("guests").alias("guests_country"))
    shares = share_of_total(origin, "guests_country", "__pct")
    out = shares.select("country_name", "guests_country", fixed2("__pct").alias("guest_pct"))
    # SO1: descending, NA last (a sort of the small per-name result)
    if not ordered:
        return out
    return out.orderBy(F.col("guests_country").desc_nulls_last(), F.col("country_name").asc_nulls_last())


def guest_origin_top(origin: DataFrame, n: int = 5, weight: str = "guests_country") -> DataFrame:
    """``top_n(n)``.  The reference ranks by its last column, the text
    ``guest_pct`` (text order); pass ``weight='guest_pct'`` to reproduce that.
    Rows keep the descending order of the guest counts."""
    return top_n(origin, n, weight).orderBy(F.col("guests_country").desc_nulls_last(),
                                            F.col("country_name").asc_nulls_last())


def guests_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned guests per country code from the driver tables.

    Aggregates before every join: lines are summed per order (the aggregate's
    shuffle on the order key is the one the orders join needs), orders per
    customer, customers per code.  Only the first step touches line-level
    rows.
    """
    lines = clean_bookings(bookings_view(spark, sf_dir, kept_only=True))
    per_order = lines.groupBy("order_key").agg(F.sum("guests").alias("guests"))
    o = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("customer_key"))
    per_customer = per_order.join(o, "order_key").groupBy("customer_key").agg(F.sum("guests").alias("guests"))
    c = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_key"),
        F.col("c_nationkey").cast("string").alias("country"))
    joined = per_customer.join(c, "customer_key")
    country = recode(fill_na("country", FILL_COUNTRY), VIEW_COUNTRY_RECODE)
    return joined.groupBy(country.alias("country")).agg(F.sum("guests").alias("guests"))


# --------------------------------------------------------------------------
# 7-9. rates (AG3, AG4, PJ11, AG5, PD2, FL7)

def rate_person(df: DataFrame) -> DataFrame:
    """``rate_person = adr / (adults + children)`` with R's zero-divisor results."""
    return df.withColumn("rate_person", r_divide("adr", F.col("adults") + F.col("children")))


def avg_rate(clean: DataFrame) -> DataFrame:
    """AG3: mean daily rate per hotel."""
    return clean.groupBy("hotel").agg(r_mean("adr").alias("rate_avg"))


def avg_rate_per_person_text(clean: DataFrame) -> DataFrame:
    """AG4: mean rate per person per hotel, as two-decimal text."""
    return (rate_person(clean).groupBy("hotel")
            .agg(fixed2(r_mean("rate_person")).alias("rate_person_avg")))


def rate_band(clean: DataFrame, by: list[str], mean_name: str, sd_name: str,
              limits: tuple[float, float] | None = None) -> DataFrame:
    """PD2/PD3: mean +- sd of the per-person rate per group, optionally censored.

    ``limits`` mimics plot axis limits: values outside become null.
    """
    g = (rate_person(clean).groupBy(*by)
         .agg(r_mean("rate_person").alias(mean_name), r_sd("rate_person").alias(sd_name)))
    g = (g.withColumn("band_low", F.col(mean_name) - F.col(sd_name))
          .withColumn("band_high", F.col(mean_name) + F.col(sd_name)))
    if limits is not None:
        lo, hi = limits
        for c in (mean_name, "band_low", "band_high"):
            g = g.withColumn(f"{c}_shown", censor(c, lo, hi))
    return g


def rate_by_room_type_band(clean: DataFrame, limits=ROOM_RATE_LIMITS) -> DataFrame:
    return rate_band(clean, ["hotel", "reserved_room_type"], "mean_rp", "sd_rp", limits)


def rate_by_month_band(clean: DataFrame) -> DataFrame:
    """PD3 + SO4: monthly mean +- sd per hotel, with the month ordinal for ordering."""
    g = rate_band(clean, ["hotel", "arrival_date_month"], "rate_month_avg", "rate_month_sd")
    return (g.withColumn("month_ord", month_ordinal("arrival_date_month"))
            .orderBy("hotel", F.col("month_ord").asc_nulls_last()))


# --------------------------------------------------------------------------
# 11. busy months (AG6, PJ9, FL5, FL7, PD4)

def busy_months(clean: DataFrame, limits: tuple[float, float] | None = None,
                three_year_months=("July", "August")) -> DataFrame:
    """Guests per (hotel, month), divided by the number of years the month
    occurs in (3 for the listed months, 2 otherwise, as in the reference)."""
    g = (clean.groupBy("hotel", "arrival_date_month")
         .agg(r_sum("guests").alias("guests_month")))
    m = F.col("arrival_date_month")
    norm = (F.when(m.isNull(), F.lit(None).cast("double"))
            .when(m.isin(list(three_year_months)), F.col("guests_month") / 3.0)
            .otherwise(F.col("guests_month") / 2.0))
    g = g.withColumn("guests_month_norm", norm).withColumn("month_ord", month_ordinal(m))
    if limits is not None:
        g = g.withColumn("guests_month_norm_shown", censor("guests_month_norm", *limits))
    return g.orderBy("hotel", F.col("month_ord").asc_nulls_last())


def busy_months_by_year_count(clean: DataFrame) -> DataFrame:
    """Same, with the divisor computed from the data: distinct years per month."""
    g = (clean.groupBy("hotel", "arrival_date_month")
         .agg(r_sum("guests").alias("guests_month"),
              F.countDistinct("arrival_date_year").alias("n_years")))
    return (g.withColumn("guests_month_norm", F.col("guests_month") / F.col("n_years"))
             .withColumn("month_ord", month_ordinal("arrival_date_month"))
             .orderBy("hotel", F.col("month_ord").asc_nulls_last()))


# --------------------------------------------------------------------------
# 12. stay length (PJ10, FL3, AG9, WN1, SC1, SO3, PD5)

def stay_length_share(clean: DataFrame, ordered: bool = True) -> DataFrame:
    """Bookings per (hotel, total_nights) and their percent share within the hotel."""
    nights = (clean.withColumn("total_nights",
                               F.col("stays_in_week_nights") + F.col("stays_in_weekend_nights"))
              .filter(F.col("total_nights") > 0))
    g = nights.groupBy("hotel", "total_nights").agg(F.count(F.lit(1)).alias("num_trx"))
    s = share_within(g, "num_trx", "hotel", "__pct")
    out = s.select("hotel", "total_nights", "num_trx", round_half_up("__pct", 2).alias("num_trx_pct"))
    return out.orderBy("hotel", "total_nights") if ordered else out


def stay_length_top(clean: DataFrame, n: int = 5) -> DataFrame:
    """Top-n stay lengths per hotel by the last column (``num_trx_pct``), ties kept."""
    return (top_n(stay_length_share(clean, ordered=False), n, "num_trx_pct", by="hotel")
            .orderBy("hotel", "total_nights"))


# --------------------------------------------------------------------------
# 13 / 2017. guests and prices by year and month (FL2, FL4, AG7, AG8, PD8, PD9)

def _raw_month_frame(raw: DataFrame, year: float | None = None) -> DataFrame:
    """The later sections filter BEFORE filling nulls: a booking whose
    ``children`` is missing fails ``adults + children > 0`` and is gone."""
    cond = (F.col("is_canceled") == 0) & ((F.col("adults") + F.col("children")) > 0)
    if year is not None:
        cond = cond & (F.col("arrival_date_year") == year)
    return (raw.filter(cond)
            .withColumn("children", fill_na("children", 0.0))
            .withColumn("hotel", recode("hotel", {"City Hotel": "city_hotel",
                                                  "Resort Hotel": "resort_hotel"})))


def totals_by_year_month(raw: DataFrame) -> DataFrame:
    """PD8: guests per (hotel, year, month)."""
    df = _raw_month_frame(raw).withColumn(
        "guests", F.col("adults") + F.col("children") + F.col("babies"))
    return (df.groupBy("hotel", "arrival_date_year", "arrival_date_month")
            .agg(r_sum("guests").alias("guest_month_total"))
            .withColumn("month_ord", month_ordinal("arrival_date_month"))
            .orderBy("hotel", "arrival_date_year", F.col("month_ord").asc_nulls_last()))


def year_price_by_month(raw: DataFrame, year: float = 2017.0) -> DataFrame:
    """PD9: mean per-person rate per (hotel, year, month) for one year."""
    df = rate_person(_raw_month_frame(raw, year))
    return (df.groupBy("hotel", "arrival_date_year", "arrival_date_month")
            .agg(r_mean("rate_person").alias("month_avg"))
            .withColumn("month_ord", month_ordinal("arrival_date_month"))
            .orderBy("hotel", "arrival_date_year", F.col("month_ord").asc_nulls_last()))

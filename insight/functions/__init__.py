"""Column-level helpers; every function returns a ``pyspark.sql.Column``."""

from insight.functions.nulls import (  # noqa: F401
    r_divide, na_agg, r_mean, r_sd, r_sum, fill_na, recode, is_na, col_of,
)
from insight.functions.format import fixed2, round_half_up  # noqa: F401
from insight.functions.calendar import MONTHS, month_ordinal, month_name  # noqa: F401

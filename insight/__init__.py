"""insight: table and text analytics expressed as Spark DataFrame plans.

Every public operator takes DataFrames / Columns and returns DataFrames /
Columns.  Nothing here changes session configuration except the explicit
helpers in :mod:`insight.session`, which tests and the bench use.

Sub-packages
------------
functions   Column-level helpers (null/arithmetic rules, text, html, format).
sources     Readers and writers (delimited text with NA tokens, text lines,
            driver parquet tables).
operators   DataFrame operators (profiling, contingency tables, grouped
            aggregates, ranking, statistics, search, Naive Bayes).
plans       Named analyses built from the operators (bookings, text scoring)
            and the query registry used by ``__spark_entry__``.
streaming   Micro-batch form of the text-scoring plan.
"""

__version__ = "0.1.0"

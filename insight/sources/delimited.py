"""Delimited text input with several missing-value spellings.

Spark's CSV ``nullValue`` option accepts one token only, so the file is read
with every column as a string and each cell is normalised with one ``when``
(blank-trimmed match against the token list).  Types are then either given by
the caller or guessed in one aggregation pass over the data (R ``read_csv``
guesses too, from a sample of the rows; here all count); the cast is ``try_cast`` so a bad cell becomes null instead of
failing the job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from insight.sources.checkpoint import materialize
from insight.sources.textfile import in_file_order

# The missing-value spellings of the bookings reader.
NA_TOKENS = ("", "NA", "NULL", "NaN", "null", "Null", "<NA>")


# Fields in double quotes may hold separators, line breaks and doubled quotes.
# Spark's reader does not cut a file with quoted line breaks: a large one is
# read by read_records and parse_lines, many small ones by one task each.
QUOTING = {"quote": '"', "escape": '"', "multiLine": "true"}


def parse_lines(lines: DataFrame, column: str, names: Sequence[str], sep: str = ";",
                types: Mapping[str, str] | None = None) -> DataFrame:
    """Delimited records held in a text column: the other columns are kept, ``column`` is replaced by ``names``."""
    schema = ", ".join(f"`{n}` string" for n in names)
    record = F.from_csv(F.col(column), schema, {"sep": sep, "quote": '"', "escape": '"'})
    rest = [c for c in lines.columns if c != column]
    df = lines.withColumn("__record", record).select(*[F.col(f"`{c}`") for c in rest], "__record.*")
    return _apply_types(df, types or {})


def read_records(spark: SparkSession, path: str, record: str = "record", row: str = "row") -> DataFrame:
    """Quoted records of text files as ``(row, record)``, in file order, however the files are cut in blocks.

    A line break inside quotes does not end a record.  Lines are numbered in file order;
    a line begins a record if the quotes before it are even in number.  Quotes are counted
    per block and summed over the blocks, so the state at a block's start is known without
    reading the file from its beginning; lines of a record are put together by its number.
    """
    lines = in_file_order(spark.read.option("lineSep", "\n").text(path), "__line")
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    lines = lines.select("__line", "value", quotes.alias("__q"), F.floor((F.col("__line") - 1) / LINES).alias("__piece"))
    pieces = lines.groupBy("__piece").agg(F.sum("__q").alias("__q"))
    before = pieces.select("__piece", (F.sum("__q").over(Window.orderBy("__piece")) - F.col("__q")).alias("__before"))
    here = F.sum("__q").over(Window.partitionBy("__piece").orderBy("__line")) - F.col("__q")
    state = lines.withColumn("__here", here).join(before, "__piece")
    begins = ((F.col("__before") + F.col("__here")) % 2 == 0).cast("bigint")
    marked = materialize(state.select("__line", "value", "__piece", begins.alias("__begins")), "records")
    starts = marked.groupBy("__piece").agg(F.sum("__begins").alias("__n"))
    earlier = starts.select("__piece", (F.sum("__n").over(Window.orderBy("__piece")) - F.col("__n")).alias("__off"))
    number = F.sum("__begins").over(Window.partitionBy("__piece").orderBy("__line"))
    owned = marked.withColumn("__own", number).join(earlier, "__piece").withColumn(row, F.col("__own") + F.col("__off"))
    parts = F.array_sort(F.collect_list(F.struct("__line", "value")))
    joined = F.array_join(F.transform(parts, lambda p: p["value"]), "\n")
    return owned.groupBy(row).agg(F.regexp_replace(joined, r"\r$", "").alias(record))


def normalise_na(df: DataFrame, tokens: Sequence[str] = NA_TOKENS,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Trim string cells and turn every listed token into null."""
    cols = set(columns or [f.name for f in df.schema.fields
                           if isinstance(f.dataType, T.StringType)])
    out = []
    for name in df.columns:
        c = F.col(f"`{name}`")
        if name in cols:
            t = F.trim(c)
            c = F.when(t.isin(list(tokens)), F.lit(None).cast("string")).otherwise(t)
        out.append(c.alias(name))
    return df.select(*out)


#: Lines whose quotes are counted together.
LINES = 1 << 16
#: Types a cell can have, from the narrowest to the widest, each with its bit.  A column's
#: type is the first one that all its cells admit.
TYPE_BITS = {"boolean": 1, "int": 2, "double": 4, "date": 8, "interval hour to second": 16, "timestamp": 32}
ANY_TYPE = 63
# How the spreadsheet reader spells logical cells.
LOGICAL = ("T", "F", "TRUE", "FALSE", "True", "False", "true", "false")
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(?i:inf(inity)?)$"
LEADING_ZERO = r"^[+-]?0\d"
DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"
TIME = r"^([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d{1,6})?)?$"
STAMP = r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?$"


def cell_types(cell: Column, integers: bool = False) -> Column:
    """The bits of the types that a text cell admits; a missing cell admits all.

    Numbers with a leading zero are codes, hence text.  A date is a timestamp too.
    Integers are doubles unless ``integers`` is set, as the spreadsheet reader guesses.
    """
    number = cell.rlike(NUMBER) & ~cell.rlike(LEADING_ZERO)
    whole = F.lit(integers) & cell.rlike(r"^[+-]?\d+$") & cell.try_cast("int").isNotNull()
    date = cell.rlike(DATE) & cell.try_cast("date").isNotNull()
    stamp = date | cell.rlike(STAMP) & cell.try_cast("timestamp").isNotNull()
    tests = {"boolean": cell.isin(*LOGICAL), "int": number & whole, "double": number, "date": date,
             "interval hour to second": cell.rlike(TIME), "timestamp": stamp}
    bits = F.lit(0)
    for name, holds in tests.items():
        bits = bits + F.when(holds, F.lit(TYPE_BITS[name])).otherwise(F.lit(0))
    return F.when(cell.isNull(), F.lit(ANY_TYPE)).otherwise(bits)


def infer_types(df: DataFrame, integers: bool = False) -> dict[str, str]:
    """Guess a type per string column: the cells' sets of types are intersected in ONE aggregation job.

    A column gets the first type of ``TYPE_BITS`` that every non-null cell admits, else
    string; an all-null column stays a string.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not names:
        return {}
    cells = [F.col(f"`{n}`") for n in names]
    row = df.agg(*[F.bit_and(cell_types(c, integers)).alias(f"t{i}") for i, c in enumerate(cells)],
                 *[F.count(c).alias(f"n{i}") for i, c in enumerate(cells)]).first()
    return {n: next((t for t, bit in TYPE_BITS.items() if row[f"n{i}"] and row[f"t{i}"] & bit), "string") for i, n in enumerate(names)}


def _apply_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    cols = []
    for name in df.columns:
        c = F.col(f"`{name}`")
        t = types.get(name)
        if t == "interval hour to second":
            c = F.when(c.rlike(r"^\d+:\d+$"), F.concat(c, F.lit(":00"))).otherwise(c).try_cast(t)
        elif t and t != "string":
            c = c.try_cast(t)
        cols.append(c.alias(name))
    return df.select(*cols)


def read_delimited(spark: SparkSession, path: str, sep: str = ",", header: bool = True,
                   na_tokens: Sequence[str] = NA_TOKENS,
                   types: Mapping[str, str] | None = None, infer: bool = True, integers: bool = False,
                   row_numbers: str | None = None) -> DataFrame:
    """CSV with a header, several NA spellings and typed columns.

    ``types`` fixes column types (recommended on a cluster: no guessing
    pass); without it and with ``infer=True`` one aggregation job guesses them
    (:func:`infer_types`).  ``row_numbers`` names a column for the rows' numbers in file
    order, for files without a key.
    """
    raw = (spark.read.option("header", header).option("sep", sep)
           .options(**QUOTING).option("mode", "PERMISSIVE").csv(path))
    if row_numbers:
        raw = in_file_order(raw, row_numbers)
    clean = normalise_na(raw, na_tokens)
    if types is None and infer:
        types = infer_types(clean, integers)
    return _apply_types(clean, types or {})


def read_headerless(spark: SparkSession, path: str, names: Sequence[str], sep: str = ";",
                    types: Mapping[str, str] | None = None) -> DataFrame:
    """Headerless delimited file with caller-given column names."""
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    df = spark.read.schema(schema).option("header", False).option("sep", sep).options(**QUOTING).csv(path)
    return _apply_types(df, types or {})

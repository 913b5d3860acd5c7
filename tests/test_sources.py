import os
import tempfile

from insight.sources import read_delimited, read_headerless, read_lines, write_lines
from insight.sources.delimited import NA_TOKENS


def _tmpdir():
    return tempfile.mkdtemp(prefix="insight-test-", dir=os.environ.get("TMPDIR", "/tmp"))


def test_csv_with_seven_na_spellings(spark):
    d = _tmpdir()
    path = os.path.join(d, "bookings.csv")
    lines = ["hotel,children,country,adr,reservation_status_date"]
    for i, tok in enumerate(NA_TOKENS):
        lines.append(f"City Hotel, {tok} ,{tok},{10 + i},2015-07-0{i + 1}")
    lines.append("Resort Hotel,2,PRT,7.5,2015-08-01")
    open(path, "w").write("\n".join(lines) + "\n")
    df = read_delimited(spark, path)
    types = dict(df.dtypes)
    assert types["children"] == "double" and types["adr"] == "double"
    assert types["reservation_status_date"] == "date" and types["country"] == "string"
    assert df.filter("children IS NULL").count() == len(NA_TOKENS)
    assert df.filter("country IS NULL").count() == len(NA_TOKENS)
    assert df.filter("children = 2").count() == 1


def test_headerless_semicolon(spark):
    d = _tmpdir()
    path = os.path.join(d, "train.csv")
    open(path, "w").write("bagus sekali;positive\njelek;negative\n")
    df = read_headerless(spark, path, ["Tweet", "sentimen"])
    assert [tuple(r) for r in df.collect()] == [("bagus sekali", "positive"), ("jelek", "negative")]


def test_text_lines_round_trip(spark):
    d = _tmpdir()
    src = spark.createDataFrame([(1, "first line"), (2, ""), (3, "third")], "k int, text string")
    write_lines(src.orderBy("k").coalesce(1), os.path.join(d, "out"))
    back = read_lines(spark, os.path.join(d, "out"))
    got = [r["text"] for r in back.orderBy("line_id").collect()]
    assert got == ["first line", "", "third"]


def test_quoted_fields_with_breaks_and_doubled_quotes(spark):
    d = _tmpdir()
    path = os.path.join(d, "posts.csv")
    open(path, "w").write('id,text\n1,"a, ""b""\nsecond line"\n2," NA "\n3,plain\n')
    rows = {r["id"]: r["text"] for r in read_delimited(spark, path).collect()}
    assert rows == {1.0: 'a, "b"\nsecond line', 2.0: None, 3.0: "plain"}
    path = os.path.join(d, "train.csv")
    open(path, "w").write('"x ""q""; y";positive\n"two\nlines";negative\n')
    df = read_headerless(spark, path, ["tweet", "label"])
    assert sorted(tuple(r) for r in df.collect()) == [("two\nlines", "negative"), ('x "q"; y', "positive")]


def test_parse_lines_keeps_the_other_columns(spark):
    from insight.sources.delimited import parse_lines
    df = spark.createDataFrame([(1, '"a;b";2'), (2, "c;x")], "k int, line string")
    out = parse_lines(df, "line", ["t", "n"], types={"n": "int"})
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a;b", 2), (2, "c", None)]


def test_lines_of_several_files_sort_by_file_and_id(spark):
    d = _tmpdir()
    want = []
    for name, n in (("b.txt", 3), ("a.txt", 200), ("c.txt", 1)):
        lines = [f"{name} {i}" for i in range(n)] + [""]
        open(os.path.join(d, name), "w").write("\n".join(lines) + "\n")
        want.append((name, lines))
    got = {}
    for r in read_lines(spark, d).orderBy("file", "line_id").collect():
        got.setdefault(os.path.basename(r["file"]), []).append(r["text"])
    assert got == dict(want)


def test_lines_of_split_files_are_numbered_in_file_order(spark):
    """Many files, each cut in many blocks."""
    from insight.sources.textfile import read_numbered_lines
    d, want = _tmpdir(), []
    for k, n in enumerate((300, 1, 0, 2500, 40)):
        lines = [f"{k}-{i} " + "x" * (i % 90) for i in range(n)] + ([""] if n else [])
        with open(os.path.join(d, f"part-{k:02}.txt"), "w") as f:
            f.write("".join(x + "\n" for x in lines))
        want += lines
    conf = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        got = sorted((r["row"], r["text"]) for r in read_numbered_lines(spark, d).collect())
    finally:
        for k, v in conf.items():
            spark.conf.set(k, v)
    assert got == list(enumerate(want, 1))


def test_row_numbers_of_csv_files_skip_their_headers(spark):
    d = _tmpdir()
    for k in range(3):
        open(os.path.join(d, f"{k}.csv"), "w").write("a,b\n" + "".join(f"{k + 1}{i},NA\n" for i in range(5)))
    rows = read_delimited(spark, d, row_numbers="row").orderBy("row").collect()
    assert [r["row"] for r in rows] == list(range(1, 16)) and rows[5]["a"] == 20.0
    from insight.operators.profile import na_positions
    assert sorted(r["row"] for r in na_positions(read_delimited(spark, d, row_numbers="row"), "row").collect()) == list(range(1, 16))


CELLS = [  # cells of a column, the guess with and without integers
    (["1", "-2", "+3"], "int", "double"), (["1", "2.5", "-.5", "1e9", "Inf"], "double", "double"), (["99999999999"], "double", "double"),
    (["007", "1"], "string", "string"), (["0", "0.5"], "double", "double"), (["T", "FALSE", "true"], "boolean", "boolean"), (["T", "1"], "string", "string"),
    (["2020-01-31", "2020-2-1"], "date", "date"), (["2020-02-30"], "string", "string"), (["2020-01-31", "2020-01-31 10:00:00"], "timestamp", "timestamp"),
    (["2020-01-31T10:00:00Z"], "timestamp", "timestamp"), (["9:30", "23:59:59.5"], "interval hour to second", "interval hour to second"),
    (["24:00"], "string", "string"), (["9:30", "2020-01-31"], "string", "string"), ([None, None], "string", "string"), ([None, "5"], "int", "double"),
    (["NaN1", "1d"], "string", "string"), (["", "x"], "string", "string"),
]


def test_type_lattice(spark):
    from insight.sources.delimited import infer_types
    n = max(len(c) for c, *_ in CELLS)
    rows = [tuple(c[i] if i < len(c) else None for c, *_ in CELLS) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(len(CELLS)))).repartition(3)
    assert list(infer_types(df, integers=True).values()) == [a for _, a, _ in CELLS]
    assert list(infer_types(df).values()) == [b for *_, b in CELLS]


def test_clock_cells_become_intervals(spark):
    import datetime
    d = _tmpdir()
    path = os.path.join(d, "t.csv")
    open(path, "w").write("at,stamp\n9:30,2020-01-01\n10:00:05,2020-01-01 12:00:00\nNA,NA\n")
    rows = read_delimited(spark, path).collect()
    assert [r["at"] for r in rows] == [datetime.timedelta(hours=9, minutes=30), datetime.timedelta(hours=10, seconds=5), None]
    assert rows[0]["stamp"] == datetime.datetime(2020, 1, 1)

"""Results that do not depend on the partitioning: sums, splits, records; guards on numbers of levels."""

import math
import os
import random
import struct
import tempfile

import pytest

from insight.operators import bayes as NB
from insight.operators import contingency as CT
from insight.operators import profile as P
from insight.operators.aggregate import exact_sum
from insight.sources.delimited import parse_lines, read_headerless, read_records
from pyspark.sql import functions as F


def bits(x):
    return None if x is None else struct.pack(">d", x)


def hard_values(n=4000):
    rnd = random.Random(11)
    out = [math.ldexp(rnd.uniform(-1, 1), rnd.randint(-300, 300)) for _ in range(n)]
    return out + [0.1] * 500 + [2.0 ** k for k in range(-40, 41)] + [-(2.0 ** 31) + 2.0 ** -20, 5e-324, -5e-324, 1.7e308, -1.6e308, 0.0, -0.0]


def test_sums_have_equal_bits_over_any_partitioning(spark):
    rows = [(i % 3, v) for i, v in enumerate(hard_values())] + [(3, None), (4, float("inf")), (4, 1.0), (5, float("inf")), (5, float("-inf")), (6, float("nan"))]
    df = spark.createDataFrame(rows, "g int, v double")
    results = []
    for parts in (1, 7, 64):
        got = {r["g"]: r["total"] for r in exact_sum(df.repartition(parts).sortWithinPartitions(F.rand(parts)), "g", "v").collect()}
        results.append({g: bits(x) for g, x in got.items() if g != 6})
        assert math.isnan(got[6])
    assert results[0] == results[1] == results[2]
    for g in range(3):
        want = math.fsum(v for k, v in rows if k == g)
        assert abs(got[g] - want) <= 1e-13 * max(abs(v) for k, v in rows if k == g)
    assert got[3] is None and got[4] == math.inf and math.isnan(got[5])


def test_sums_are_exact_where_doubles_cancel(spark):
    df = spark.createDataFrame([(v,) for v in (1e100, 1.0, -1e100, 1e-30, 3.0, -4.0)], "v double")
    assert exact_sum(df, None, "v").first()["total"] == 1e-30
    assert exact_sum(df.where("v > 1e200"), None, "v").first()["total"] is None


@pytest.mark.parametrize("fraction", [0.25, 0.1])
def test_split_sizes_are_exact(spark, fraction):
    """Hot and tiny strata, a null one, a missing key."""
    rows = [(i * 7919, "hot") for i in range(3000)] + [(i, "tiny") for i in range(-3, 0)] + [(5_000_000, "one"), (6_000_000, None)]
    df = spark.createDataFrame(rows, "k bigint, s string").repartition(6)
    out = NB.exact_split(df, "k", "s", fraction).collect()
    assert len(out) == len(rows)
    sizes = {}
    for r in out:
        sizes.setdefault(r["s"], [0, 0])[0] += 1
        sizes[r["s"]][1] += r["is_test"]
    assert sizes == {s: [n, math.ceil(n * fraction)] for s, n in (("hot", 3000), ("tiny", 3), ("one", 1), (None, 1))}

    def place(k):
        return (k % NB.KEY_SPACE * NB.GOLDEN % NB.SPACE, k)
    for s in ("hot", "tiny"):
        keys = sorted((k for k, x in rows if x == s), key=place)
        assert {r["k"] for r in out if r["s"] == s and r["is_test"]} == set(keys[:sizes[s][1]])
    whole = NB.exact_split(df, "k", test_fraction=fraction)
    assert whole.where("is_test").count() == math.ceil(len(rows) * fraction)


def test_split_of_equal_hashes_goes_by_the_key(spark):
    rows = [(5 + j * NB.KEY_SPACE,) for j in range(40)] + [(9,)] * 3
    out = NB.exact_split(spark.createDataFrame(rows, "k bigint"), "k", test_fraction=0.25).collect()
    assert sum(r["is_test"] for r in out) == math.ceil(len(rows) * 0.25)
    assert NB.exact_split(spark.createDataFrame([], "k bigint"), "k").count() == 0


def test_records_of_many_blocks_equal_the_single_task_read(spark, monkeypatch):
    from insight.sources import delimited
    monkeypatch.setattr(delimited, "LINES", 7)
    rnd = random.Random(3)
    d = tempfile.mkdtemp(prefix="insight-test-", dir=os.environ.get("TMPDIR", "/tmp"))
    want = []
    for k in range(3):
        lines = []
        for i in range(200):
            text = "".join(rnd.choice(['a', 'b;c', '""', '\n', '\n\n', 'é ', '"";""']) for _ in range(rnd.randint(0, 9)))
            lines.append(f'"{text}";{k}-{i}\n' if rnd.random() < 0.8 else f"plain {i};{k}-{i}\n")
        open(os.path.join(d, f"{k}.csv"), "w").write("".join(lines))
    want = sorted(map(tuple, read_headerless(spark, d, ["tweet", "label"]).collect()), key=repr)
    conf = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        records = read_records(spark, d)
        parsed = parse_lines(records, "record", ["tweet", "label"]).collect()
    finally:
        for k, v in conf.items():
            spark.conf.set(k, v)
    assert sorted(((r["tweet"], r["label"]) for r in parsed), key=repr) == want and len(want) == 600
    assert [r["label"] for r in sorted(parsed, key=lambda r: r["row"])] == [f"{k}-{i}" for k in range(3) for i in range(200)]


def test_levels_are_guarded(spark):
    df = spark.range(5000).selectExpr("id", "id % 7 as few", "cast(null as string) as none", "if(id % 2 = 0, null, 'x') as some")
    got = {}
    for r in P.column_levels(df, most=100).collect():
        got.setdefault(r["column"], []).append((r["listed"], r["value"]))
    assert got["id"] == [(False, None)] and sorted(v for _, v in got["few"]) == [str(i) for i in range(7)]
    assert got["none"] == [(True, None)] and sorted(got["some"], key=repr) == [(True, "x"), (True, None)]
    with pytest.raises(ValueError, match="more than 100 levels"):
        CT.crosstab_wide(df, "few", "id", most=100)
    assert CT.crosstab_wide(df.withColumn("two", F.col("id") % 2), "few", "two", most=2).count() == 7

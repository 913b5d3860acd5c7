import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import lettered, spaced
from insight.llm.common import IS_LETTER, IS_SPACE, TO_LOWER, key_runs, text_slices, words_in

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aB9 .\n\t\x0bé漢😀-*", max_size=40)), max_size=12)


def words_by_text(column, kind, lower):
    out = []
    for _, _, raw, offs in text_slices(column, 16):
        data = TO_LOWER[raw] if lower else raw
        words = words_in(data, offs, kind)
        for t in range(len(offs) - 1):
            out.append([data[words.starts[k]:words.ends[k]].tobytes().decode()
                        for k in range(words.offsets[t], words.offsets[t + 1])])
    return out


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words_are_those_of_the_patterns(ts):
    column = pa.array(ts, pa.string())
    assert words_by_text(column, ~IS_SPACE, False) == [spaced(t) for t in ts]
    assert words_by_text(column, IS_LETTER, True) == [lettered(t) for t in ts]


def test_equal_words_have_equal_hashes_and_others_do_not():
    ts = ["alpha beta alpha", "beta a\u00e9 a", "ae a\u00e9"]
    hashes = {}
    for _, _, raw, offs in text_slices(pa.array(ts)):
        w = words_in(raw, offs, ~IS_SPACE)
        for h, a, b in zip(w.hashes, w.starts, w.ends):
            hashes.setdefault(raw[a:b].tobytes(), set()).add(int(h))
    assert all(len(v) == 1 for v in hashes.values())
    assert len({min(v) for v in hashes.values()}) == len(hashes)


def test_a_sliced_column_and_hidden_bytes_under_nulls():
    whole = pa.array(["skip", "one two", None, "three"])
    assert words_by_text(whole.slice(1), ~IS_SPACE, False) == [["one", "two"], [], ["three"]]


def test_key_runs_join_batches():
    batches = [pa.RecordBatch.from_pydict({"key": k}) for k in ([1, 1, 2], [2, 2], [3], [3, 4])]
    assert [t.column("key").to_pylist() for t in key_runs(iter(batches), "key")] == [[1, 1], [2, 2, 2], [3, 3], [4]]
    assert list(key_runs(iter([]), "key")) == []


def test_task_functions_travel_by_value(spark):
    from pyspark import cloudpickle
    import insight.llm.rules as rules
    assert b"insight.llm.rules\n" not in cloudpickle.dumps(rules.statistics)
    assert np.array_equal(cloudpickle.loads(cloudpickle.dumps(rules._repeated))(np.array([1, 2, 1])), [True, False, True])


def test_only_and_without_are_exact(spark, monkeypatch):
    import insight.llm.common as common
    df = spark.range(2000).selectExpr("id % 700 as k", "id as v", "'x' as __other")
    ids = spark.createDataFrame([(i,) for i in range(0, 900, 7)] + [(-5,)], "k bigint")
    want = [v for v in range(2000) if (v % 700) % 7 == 0]
    for bits in (1 << 26, 1 << 8):  # with few bits, many rows need the exact join
        monkeypatch.setattr(common, "FILTER_BITS", bits)
        assert sorted(r["v"] for r in common.only(df, "k", ids).collect()) == want
        assert sorted(r["v"] for r in common.without(df, "k", ids).collect()) == sorted(set(range(2000)) - set(want))
        assert common.only(df, "k", ids).columns == df.columns
    assert common.only(df, "k", ids.where("k < -9")).count() == 0
    assert common.without(df, "k", ids.where("k < -9")).count() == 2000

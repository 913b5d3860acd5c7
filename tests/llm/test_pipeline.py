import os

import pytest

import corpus_pipeline
from conftest import SF_SMALL
from helpers import DOCS, docs_frame, labels_frame, odd_labels, odd_rows
from insight.llm import decontaminate, jaccard, mixing, quality, rules
from insight.llm.queries import ORACLE, QUERIES
from oracle_harness import compare, duck

COLUMNS = {
    "op2": ["doc_id", "size", "source_size", "target", "taken"], "op3": ["doc_id", "held_out", "lang_pred", "score"],
    "op5": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op6": ["doc_id", "held_out", "score", "predicted"],
    "op7": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op8": ["page_id", "host", "path", "rule", "verdict"],
    "op9": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op10": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op11": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op12": ["lang", "source", "part", "item", "value", "rank"],
    "op13": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
}
#: Their rows are pairs of groups and nodes; the SQL says how many.
OTHER_ROWS = ("op12_source_audit", "op13_prefix_trie")


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(OTHER_ROWS)))
def test_queries_return_a_row_per_input_row(spark, name):
    out = QUERIES[name](spark, SF_SMALL)
    table = "pages" if name.startswith("op8_") else "documents"
    assert out.count() == spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count()
    assert out.columns[: len(COLUMNS.get(name.split("_")[0], []))] == COLUMNS.get(name.split("_")[0], [])


@pytest.mark.parametrize("name", OTHER_ROWS)
def test_columns_of_the_others(spark, name):
    assert QUERIES[name](spark, SF_SMALL).columns == COLUMNS[name.split("_")[0]]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    r = compare(spark, name, QUERIES[name], ORACLE[name], SF_SMALL, duck(SF_SMALL))
    assert r["ok"], r.get("why")
    assert not r["types"], r["types"]


def tables(spark, folder, rows, labels, items):
    docs_frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    labels_frame(spark, labels).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages_are_the_operators_one_after_the_other(spark, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "quality_rules", "jaccard_join", "decontamination", "source_mix"]
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"])
            for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()] + [
        (None if i is None else i + 5000, t, lang, s) for i, t, lang, s in odd_rows()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    sf = tables(spark, tmp_path, rows, labels, items)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    marks, bench = spark.read.parquet(f"{sf}/labels.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    whole = docs

    def ids(df):
        return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=repr)

    # each stage against the decisions of its operator on the same input
    step = [f for _, f in corpus_pipeline.STAGES]
    a = step[0](spark, docs, sf)
    assert ids(a) == ids(quality.resample(docs, marks).where("kept"))
    b = step[1](spark, a, sf)
    assert ids(b) == ids(rules.judge(a, rules.fit_rules(whole, marks)).where("kept"))
    b = mixing.stored(b, "test")
    c = mixing.stored(step[2](spark, b, sf), "test")
    classes = jaccard.near_duplicates(b)
    assert c.count() == classes.select("class_id").distinct().count()
    assert set(ids(c)) == {r["class_id"] for r in classes.collect()}
    d = mixing.stored(step[3](spark, c, sf), "test")
    clean = {r["doc_id"] for r in decontaminate.contamination(c, bench).where("not contaminated").collect()}
    assert clean <= set(ids(d))
    assert decontaminate.contamination(d, bench).where("contaminated").count() == 0
    before = {r["doc_id"]: r["text"] for r in c.collect()}
    assert all(r["text"] == before[r["doc_id"]] for r in d.collect() if r["doc_id"] in clean)
    e = step[4](spark, d, sf)
    want = []
    for r in mixing.mix_plan(d).collect():
        want += [r["doc_id"]] * r["copies"]
    assert ids(e) == sorted(want, key=repr)
    for df in (a, b, c, d, e):
        assert df.columns == docs.columns
    assert ids(corpus_pipeline.run(spark, sf)) == ids(e)


def test_empty_tables(spark, tmp_path):
    sf = tables(spark, tmp_path, [], [], [])
    out = corpus_pipeline.run(spark, sf)
    assert out.count() == 0 and out.columns == [c.split()[0] for c in DOCS.split(", ")]


def test_odd_tables(spark, tmp_path):
    sf = tables(spark, tmp_path, odd_rows(), odd_labels(), [(1, None), (2, "plain text number"), (None, "")])
    assert corpus_pipeline.run(spark, sf).count() >= 0
    assert os.path.isdir(sf)

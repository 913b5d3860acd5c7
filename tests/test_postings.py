import os
import tempfile

from insight.operators import postings as IX
from pyspark.sql import functions as F

TEXTS = {1: "The cat AND the dog", 2: "the-cat", 3: "cathode", 70_000: "dog, cat", -5: "cat dog!", 65_535: "cat", 65_536: "cat dog", None: "cat dog", 9: None, 10: ""}


def frame(spark, texts):
    return spark.createDataFrame(list(texts.items()), "k bigint, t string")


def folder():
    return os.path.join(tempfile.mkdtemp(prefix="insight-test-", dir=os.environ.get("TMPDIR", "/tmp")), "index")


def found(spark, path, terms):
    return sorted(r["k"] for r in IX.search_index(spark, path, terms, "k").collect())


def test_words_of_all_terms(spark):
    path = folder()
    IX.write_index(frame(spark, TEXTS), "k", F.col("t"), path)
    assert found(spark, path, ["cat"]) == [-5, 1, 2, 65_535, 65_536, 70_000]
    assert found(spark, path, ["Cat", "dog", "CAT"]) == [-5, 1, 65_536, 70_000]
    assert found(spark, path, ["cat", "none"]) == [] and found(spark, path, ["cathode"]) == [3]


def test_appended_documents_are_found(spark):
    path = folder()
    IX.write_index(frame(spark, TEXTS), "k", F.col("t"), path)
    IX.append_index(frame(spark, {4: "dog cat", 65_537: "cat", 200_000: "new dog cat"}), "k", F.col("t"), path)
    assert found(spark, path, ["cat", "dog"]) == [-5, 1, 4, 65_536, 70_000, 200_000]


def test_common_terms_are_cut_in_blocks(spark):
    """Only blocks with every term are compared; the rows of a term are read in order."""
    path = folder()
    docs = spark.range(200_000).selectExpr("id as k", "concat('common ', if(id % 50000 = 7, 'rare', string(id % 10))) as t")
    IX.write_index(docs, "k", F.col("t"), path)
    rows = spark.read.parquet(path).where("term = 'common'").collect()
    assert len(rows) == 4 and max(r["n"] for r in rows) == IX.BLOCK and all(r["places"] == sorted(r["places"]) for r in rows)
    assert found(spark, path, ["common", "rare"]) == [7, 50_007, 100_007, 150_007]
    plan = IX.search_index(spark, path, ["common", "rare"])._jdf.queryExecution().executedPlan().toString()
    assert "In(term, [common,rare])" in plan

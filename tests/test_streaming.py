import os
import tempfile

from pyspark.sql import functions as F

from insight.plans import text as TP
from insight.streaming.scoring import start_scoring

DOCS = [(1, "good great fine", "pos"), (2, "bad awful", "neg"), (3, "good ok", "pos"),
        (4, "awful bad ok", "neg"), (5, "great good", "pos"), (6, "terrible bad", "neg")]


def test_stream_scores_like_batch(spark):
    root = tempfile.mkdtemp(prefix="insight-stream-", dir=os.environ.get("TMPDIR", "/tmp"))
    src, sink = os.path.join(root, "in"), os.path.join(root, "out")
    os.makedirs(src)
    open(os.path.join(src, "a.txt"), "w").write("good good\nbad awful\n")
    open(os.path.join(src, "b.txt"), "w").write("nothing known\n\nok great\n")
    model = TP.train_model(spark.createDataFrame(DOCS, "doc_id long, text string, label string"))
    q = start_scoring(spark, model, src, sink, os.path.join(root, "ckpt"), available_now=True)
    q.awaitTermination(120)
    got = spark.read.parquet(sink)
    assert got.count() == 5                                    # every line, blank included
    lines = spark.createDataFrame([(i, t) for i, t in enumerate(
        ["good good", "bad awful", "nothing known", "", "ok great"])], "post_id long, text string")
    batch = {r["text_clean"]: r["predicted"] for r in TP.score_posts(model, lines, "post_id").collect()}
    for r in got.select("text_clean", "predicted").collect():
        assert batch[r["text_clean"]] == r["predicted"]
    assert got.select(F.countDistinct("file")).first()[0] == 2

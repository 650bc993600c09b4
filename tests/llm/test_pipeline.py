"""The pipeline against its operators, one stage after the other."""

import corpus_pipeline
from pyspark.sql import functions as F
from placeloom.llm import jaccard, pii


def test_each_stage_on_awkward_rows(spark, sf):
    """Null, empty, repeated and very long rows, null ids and sources, clashing names, and no rows."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    one = "a plain text of more than ten words, one after the other, that nothing is wrong with at all"
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, one), (5, one), (6, one + " mail me at x.y@z.org"), (7, " \n")]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, _row string, component string, _keep int, n int, key string"
    docs = spark.createDataFrame([(i, t, "en", None if i == 5 else "s", len(t or ""), "x", "y", 0, 1, "k") for i, t in rows], kinds)
    got = {name: f(spark, docs, sf) for name, f in corpus_pipeline.STAGES}
    for name in ("quality", "near_duplicates", "personal_data", "mix"):
        assert got[name].columns == docs.columns
    ids = lambda name: sorted((r.doc_id or 0 for r in got[name].collect()))
    assert set(ids("quality")) <= {0, 3, 5, 6} and ids("quality").count(3) in (0, 2)
    assert ids("near_duplicates") == [1, 2, 3, 5, 6, 7] or ids("near_duplicates") == [1, 2, 3, 5, 7]
    assert ids("personal_data") == [0, 1, 2, 3, 3, 5, 6, 7]
    assert {r.text for r in got["personal_data"].where("doc_id = 6").collect()} == {one + " mail me at [EMAIL]"}
    assert got["mix"].groupBy("doc_id", "text").count().where("count > 4").count() == 0
    assert got["encode"].count() == len(rows)
    for _, f in corpus_pipeline.STAGES:
        assert f(spark, docs.limit(0), sf).count() == 0


def test_stages(spark, sf, tmp_path):
    docs = start = spark.read.parquet(f"{sf}/documents.parquet")
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        docs = after[name] = spark.read.parquet(f"{tmp_path}/{name}")
    for name in ("quality", "near_duplicates", "personal_data", "mix"):
        assert after[name].columns == start.columns
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    good = start.join(labels.where("quality = 1"), "doc_id")
    assert good.join(after["quality"], "doc_id", "left_anti").count() <= 0.05 * good.count()
    linked = jaccard.link(after["quality"])
    assert after["near_duplicates"].count() == linked.select("component_id").distinct().count()
    assert pii.summary(pii.detect(after["personal_data"])).where("spans <> ''").count() == 0
    assert after["personal_data"].where("n_chars <> length(text)").count() == 0
    times = after["mix"].groupBy("doc_id").count()
    assert times.where("count > 2").count() == 0
    assert after["encode"].count() == after["mix"].count()
    want = after["mix"].select("doc_id", F.sha2("text", 256).alias("d"))
    assert want.exceptAll(after["encode"].select("doc_id", F.col("decoded_sha256").alias("d"))).count() == 0
    assert corpus_pipeline.run(spark, sf).count() == after["encode"].count()

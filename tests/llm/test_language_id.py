from conftest import SF_DIR
from pyspark.sql import functions as F

from tideline.llm import language_id, queries


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.QUERIES["op1_language_id"](spark, "/root/testdata/sf0.01").filter("held_out")
    right = got.join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.97


def test_training_never_sees_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    wrong = docs.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    assert "xx" not in language_id.learn(wrong).languages


def test_edges(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = language_id.learn(docs)
    text = docs.filter("lang = 'de'").orderBy(F.length("text").desc()).first().text
    rows = [(1, None, 0.1), (2, "", 0.1), (3, "12 34 !?", 0.1), (4, text, 0.1), (4, text, 0.1), (5, text * 20, None), (None, text, 0.5)]
    got = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, score double"), model).collect()
    assert [(r.doc_id, r.lang_pred) for r in got] == [(1, "und"), (2, "und"), (3, "und"), (4, "de"), (4, "de"), (5, "de"), (None, "de")]
    assert all(0 <= r.score <= 1 for r in got) and got[0].score == 0 and got[3].score == got[4].score
    nothing = docs.limit(0)
    assert language_id.learn(nothing) is None and language_id.identify(nothing, None).collect() == []
    assert {r.lang_pred for r in language_id.identify(docs, None).collect()} == {"und"}


def test_probability_is_a_mean_over_every_window(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = language_id.learn(docs)
    row = docs.orderBy(F.length("text").desc()).first()
    data = row.text.encode()
    parts = [data[i : i + language_id.WINDOW] for i in range(0, len(data), language_id.WINDOW)]
    by_window = model.windows(language_id._window_rows(parts))
    mean = sum(p * len(x) for p, x in zip(by_window, parts)) / len(data)
    got = language_id.identify(docs.filter(F.col("doc_id") == row.doc_id), model).first()
    assert abs(got.score - mean.max()) < 1e-5 and got.lang_pred == model.languages[int(mean.argmax())]


def test_sample_of_a_hot_language_is_that_of_a_single_rank(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("lang", F.lit("de"))
    docs = docs.unionByName(docs.limit(40))
    monkeypatch.setattr(language_id, "SAMPLE_DOCUMENTS", 50)
    monkeypatch.setattr(language_id, "train", lambda texts, languages: sorted(zip(texts, languages)))
    dealt = language_id.learn(docs)
    monkeypatch.setattr(language_id, "SAMPLE_PARTS", (1,))
    assert dealt == language_id.learn(docs) and len(dealt) > 50


def test_filters_on_both_answers_ask_once(spark):
    docs = spark.createDataFrame([(1, "ein Satz"), (2, None)], "doc_id long, text string")
    named = language_id.identify(docs, None).filter("lang_pred <> 'xx' and score >= 0")
    plan = named._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert sorted(named.select("doc_id", "lang_pred", "score").collect()) == [(1, "und", 0.0), (2, "und", 0.0)]

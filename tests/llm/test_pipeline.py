import corpus_pipeline
from conftest import SF_DIR
from test_jaccard_join import brute

from tideline.llm import language_id, packing, pii, queries


def test_pipeline_matches_its_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    named = language_id.identify(docs, language_id.learn(docs)).collect()
    kept = [r for r in named if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_SCORE]
    last = {}
    for r in sorted(kept, key=lambda r: r.doc_id):
        last[r.text] = r.doc_id
    single = [(i, t) for t, i in last.items()]
    firsts = {i for i, _, c in brute(single, 5, 80) if i == c}
    left = spark.createDataFrame([(i, t) for i, t in single if i in firsts], "doc_id long, text string")
    pieces = packing.token_pieces(pii.pseudonymise(left, queries.KEY), queries.TOKENIZER).collect()
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert {tuple(r)[:5] for r in got.collect()} == {tuple(r) for r in pieces}


def test_stages_keep_columns_and_take_empty_tables(spark):
    rows = [(1, None, "en", "s", None), (2, "", None, None, 0), (3, "123", "en", "s", 3), (4, "the cat and 152.143.123.131", "en", "s", 27),
            (5, "the cat and 152.143.123.131", None, "s", 27)]
    for given in (rows, []):
        docs = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            columns, docs = docs.columns, stage(spark, docs, None)
            assert docs.columns == columns
        assert {r.doc_id for r in docs.collect()} == ({5} if given else set())
        assert all(r.n_chars == len(r.text) and "152.143.123.131" not in r.text for r in docs.collect())

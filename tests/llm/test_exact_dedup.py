from tideline.llm.exact_dedup import drop_copies, exact_groups


def test_edges(spark):
    long = "x" * 50000
    rows = [(1, None, "p"), (2, "", "q"), (3, "a", "r"), (4, "b", "s"), (5, "a", None), (5, "a", "t"), (None, "a", "u"),
            (7, long, "v"), (8, long + "y", "w"), (9, long + "z", "w"), (10, long + "z", "w"), (None, "only", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = sorted(((r.doc_id, r.text or "", r.keep_id, r.group_size, r.kept) for r in exact_groups(docs).collect()), key=repr)
    assert got == sorted(
        [(1, "", 2, 2, False), (2, "", 2, 2, True), (3, "a", 5, 4, False), (4, "b", 4, 1, True), (5, "a", 5, 4, True),
         (5, "a", 5, 4, True), (None, "a", 5, 4, False), (7, long, 7, 1, True), (8, long + "y", 8, 1, True),
         (9, long + "z", 10, 2, False), (10, long + "z", 10, 2, True), (None, "only", None, 1, True)], key=repr)
    assert drop_copies(docs).columns == docs.columns
    assert exact_groups(docs.limit(0)).collect() == []


def test_hot_group_is_whole(spark):
    docs = spark.range(9000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same', concat('t', id)) as text")
    got = exact_groups(docs)
    assert got.filter("kept").count() == 6001
    assert [tuple(r) for r in got.filter("group_size > 1").select("keep_id", "group_size").distinct().collect()] == [(8997, 3000)]

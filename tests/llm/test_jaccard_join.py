import re

import pytest
from conftest import SF_DIR

from tideline.llm import queries
from tideline.llm.jaccard_join import one_per_component, shingle_components


def shingles(text, k):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return frozenset()
    size = min(k, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(rows, k, percent):
    sets = {i: shingles(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {(i, len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_components_match_brute_force(spark, k, percent):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {tuple(r) for r in shingle_components(docs, k=k, percent=percent).collect()}
    assert got == brute(rows, k, percent)
    firsts = {i for i, _, c in brute(rows, k, percent) if i == c}
    assert {r.doc_id for r in one_per_component(docs, k=k, percent=percent).collect()} == firsts


def test_edited_copies_chain_into_one_component(spark):
    base = [f"w{i}" for i in range(200)]
    rows = [(1000 + e * 50 + j, " ".join(base[:p] + [f"x{e}y{j}" for _ in range(e)] + base[p:])) for e in range(6) for j in range(12) for p in [j * 15]]
    rows += [(5000 + i, " ".join(base[i : 40 + i] + [f"z{i}q{j}" for j in range(30)])) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for k, percent in ((3, 90), (3, 96), (5, 80)):
        assert {tuple(r) for r in shingle_components(docs, k=k, percent=percent).collect()} == brute(rows, k, percent)


def test_edges(spark):
    long = " ".join(f"word{i % 977}" for i in range(60000))
    rows = [
        (1, None, "a"), (2, "", "b"), (3, " \t\n", "c"), (4, "one", "d"), (5, "ONE", None), (6, "one two", "e"),
        (7, "one\x0btwo", "f"), (8, long, "g"), (9, long + " end", "h"), (9, "one", "x"), (None, "one two", "y"), (10, "É two", "z"), (11, "é two", "z"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = {r.doc_id: r.component_id for r in shingle_components(docs, k=3, percent=90).collect() if r.doc_id}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 6, 8: 4, 9: 4, 10: 10, 11: 11}
    assert one_per_component(docs, k=3, percent=90).columns == docs.columns
    assert shingle_components(docs.limit(0)).collect() == []


def test_query_reads_all_documents(spark):
    assert queries.QUERIES["op4_jaccard_join"](spark, SF_DIR).count() == 200

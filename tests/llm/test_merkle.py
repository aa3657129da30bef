import datetime as dt
import hashlib

import pytest
from conftest import SF_DIR

from tideline.llm import merkle, queries


def brute(rows):
    """Rows by descending id, nulls last, equal ids by text, each with the row after it."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        prints = merkle.fingerprint(text), merkle.fingerprint(edited), merkle.fingerprint(after)
        near = merkle.likeness(prints[0], prints[1]), merkle.likeness(prints[0], prints[2])
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), *prints[:2], *near))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [merkle.RANGE_BYTES, 20_000])
def test_query_matches_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(merkle, "RANGE_BYTES", size)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted((tuple(r) for r in queries.QUERIES["op2_merkle"](spark, SF_DIR).collect()), key=repr) == want
    near = sum(r[-2] for r in want) / len(want), sum(r[-1] for r in want) / len(want)
    assert near[0] > 0.4 and near[1] < 0.15


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_BYTES", 40)
    rows = [(5, "é" * 30), (4, None), (4, "same"), (4, "same"), (3, ""), (2, "word " * 20000), (-1, "a b c d"), (None, "no id"), (9, "x")]
    for given in (rows, rows[:1], []):
        df = spark.createDataFrame([(*r, "k") for r in given], "doc_id long, text string, fingerprint string")
        got = merkle.compare_with_next(df).selectExpr("doc_id", "n_chars", "sha2(edited, 256)", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(given)


def test_fingerprints_tell_texts_apart():
    text = "one two three\nfour five\n\nsix seven"
    for other in (text + " ", text.replace("\n\n", "\n"), text.upper(), text[1:], text.replace("four", "for")):
        assert merkle.fingerprint(other) != merkle.fingerprint(text)
        assert merkle.likeness(merkle.fingerprint(text), merkle.fingerprint(other)) < 1 or other.lower() != text
    assert merkle.fingerprint("") == merkle.fingerprint(None)


def test_branches_locate_edits(spark):
    lines = [f"paragraph {i} says {i * 7}" for i in range(300)]
    old = spark.createDataFrame([(1, "\n".join(lines)), (2, "same\ntext"), (3, None)], "doc_id long, text string")
    lines[150] = "paragraph 150 says something else"
    new = spark.createDataFrame([(1, "\n".join(lines)), (2, "same\ntext"), (3, "")], "doc_id long, text string")
    found = merkle.edits(merkle.tree(old), merkle.tree(new)).collect()
    assert [(r.id, r.paragraph) for r in found] == [(1, 150)]
    whole = "\n".join(lines).encode()
    assert whole[found[0].start : found[0].start + found[0].size] == lines[150].encode() + b"\n"


def test_ids_of_other_types_and_great_ids(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_BYTES", 40)
    texts = [f"text number {i} " * (i % 4) for i in range(40)]
    great = [(2**60 + i, t) for i, t in enumerate(texts)] + [(None, "a"), (None, "b")]
    got = merkle.compare_with_next(spark.createDataFrame(great, "doc_id long, text string"))
    got = got.selectExpr("doc_id", "n_chars", "sha2(edited, 256)", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(great)
    for kind, name in (("string", lambda i: f"{i:04}"), ("date", None), ("double", lambda i: i / 7)):
        ids = [dt.date(2020, 1, 1) + dt.timedelta(i) for i in range(40)] if name is None else [name(i) for i in range(40)]
        plain = merkle.compare_with_next(spark.createDataFrame(list(zip(range(40), texts)), "doc_id long, text string"))
        other = merkle.compare_with_next(spark.createDataFrame(list(zip(ids, texts)), f"doc_id {kind}, text string"))
        want = {(ids[r.doc_id], r.edited, r.near_next) for r in plain.collect()}
        assert {(r.doc_id, r.edited, r.near_next) for r in other.collect()} == want


def test_each_range_has_a_partition(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_BYTES", 1000)
    docs = spark.createDataFrame([(i, "some words " * 20) for i in range(60)], "doc_id long, text string")
    assert merkle.compare_with_next(docs).rdd.getNumPartitions() >= 13

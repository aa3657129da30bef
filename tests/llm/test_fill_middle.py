import hashlib
import random
import re

import numpy as np
import pytest
import verify
from conftest import SF_DIR
from pyspark.sql import functions as F

from tideline.llm import fill_middle, queries

WORDS = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
LINES = re.compile("[^\n]*\n|[^\n]+")


def brute(id_, text, unit="word", seed="42", percent=50, spm_percent=80):
    text = text or ""
    parts = (WORDS if unit == "word" else LINES).findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if id_ is None else id_}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(parts)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    if h[3] % 100 < spm_percent:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(spark, rows, **settings):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made = fill_middle.fill_in_middle(df.withColumn("given", F.col("text")), **settings)
    made = made.withColumn("back", fill_middle.restored(F.col("output"), F.col("form")))
    got = [(r.doc_id, r.given, (r.n, r.form, r.prefix_chars, r.middle_chars, r.output), r.back) for r in made.collect()]
    want = [(i, t, brute(i, t, **settings), t or "") for i, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_query_matches_its_sql(spark):
    connection = verify.duck(SF_DIR)
    frame = queries.QUERIES["op13_fill_middle"](spark, SF_DIR)
    cursor = connection.execute(queries.ORACLES["op13_fill_middle"])
    assert verify.rows_of(frame.columns, frame.collect()) == verify.rows_of([d[0] for d in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("unit", ["word", "line"])
def test_random_texts(spark, unit):
    draw = random.Random(3)
    letters = ["a", "é", "日", "😀", " ", " ", "\x1c", " ", "  ", "\t", "\n", "\r\n", "\x0b", "<", "P>", "<S", ">", "word"]
    rows = [(i, "".join(draw.choices(letters, k=draw.randint(0, 40)))) for i in range(600)]
    check(spark, rows, unit=unit, percent=100)
    check(spark, rows, unit=unit, seed="other", percent=70, spm_percent=30)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " "), (4, "\n"), (5, "x"), (6, " x "), (None, "no id at all"), (8, "a<P>b"), (9, "<M>"),
            (10, "twice this"), (10, "twice this"), (11, "é " * 400_000), (12, "y" * 700_000), (13, "\n\n\n")]
    check(spark, rows, percent=100)
    check(spark, [])
    clash = spark.createDataFrame([(1, "a b c", "kept", "lost", 5)], "doc_id long, text string, source string, output string, n int")
    assert fill_middle.fill_in_middle(clash).columns == ["doc_id", "source", *fill_middle.RESULTS]
    named = spark.createDataFrame([("k1", "a b c")], "`the id` string, body string")
    (row,) = fill_middle.fill_in_middle(named, id_col="the id", text_col="body", percent=100).collect()
    assert tuple(row)[1:] == brute("k1", "a b c", percent=100)


def test_ranks_of_the_matrix():
    draw = np.random.default_rng(5)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = draw.integers(0, 7, size).astype(np.uint8)
        matrix = fill_middle.WaveletMatrix(symbols, 3)
        places = np.arange(size + 1)
        for symbol in range(8):
            assert (matrix.rank(symbol, places) == np.concatenate([[0], np.cumsum(symbols == symbol)])).all()

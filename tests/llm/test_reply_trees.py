import random

import verify
from conftest import SF_DIR
from pyspark.sql import functions as F

from tideline.llm import queries
from tideline.llm.reply_trees import branches, conversations, parsed, under_loss

SCHEMA = "tree long, node long, parent long, role string, text string, score double"


def test_query_matches_its_sql(spark):
    connection = verify.duck(SF_DIR)
    frame = queries.QUERIES["op6_chat"](spark, SF_DIR)
    cursor = connection.execute(queries.ORACLES["op6_chat"])
    want = verify.rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert verify.rows_of(frame.columns, frame.collect()) == want


def brute(rows, best):
    """Best root-to-leaf paths of every tree: turns by branch."""
    out = {}
    for tree in {r[0] for r in rows}:
        own = {r[1]: r for r in rows if r[0] == tree}
        parents = {r[2] for r in own.values()}
        found = []
        for leaf in own:
            if leaf in parents:
                continue
            path, node = [], leaf
            while node in own and len(path) <= len(own):
                path.append(own[node])
                node = own[node][2]
            if len(path) <= len(own):
                found.append((-sum(r[5] or 0 for r in path), leaf, path[::-1]))
        for rank, (_, leaf, path) in enumerate(sorted(found)[:best], 1):
            out[tree, rank] = leaf, [(r[3] or "", r[4] or "") for r in path]
    return out


def check(spark, rows, best):
    frame = conversations(spark.createDataFrame(rows, SCHEMA), best)
    frame = frame.withColumns({"back": parsed(F.col("formatted")), "spoken": under_loss(F.col("formatted"), F.col("loss"))})
    got = {(r.tree, r.rank): (r.leaf, [tuple(t) for t in r.back], r.spoken) for r in frame.collect()}
    want = brute(rows, best)
    assert {k: v[:2] for k, v in got.items()} == want
    assert all(v[2] == "".join(t for r, t in want[k][1] if r == "assistant") for k, v in got.items())


def test_random_trees(spark):
    draw = random.Random(4)
    pieces = ["<|im_end|>", "\n", "</s>", "[INST]", "<\\|im_start|>", "\\", "a", " ", "<", "[\\\\/INST]", "assistant", "é"]
    text = lambda: "".join(draw.choices(pieces, k=draw.randint(0, 8)))
    rows = []
    for tree in range(12):
        for node in range(draw.randint(1, 40)):
            parent = draw.randrange(node) if node and draw.random() < 0.95 else None
            rows.append((tree, node, parent, draw.choice(["user", "assistant", "a\nb\\n", text()]), text(), float(draw.randint(0, 3))))
    for best in (1, 3):
        check(spark, rows, best)


def test_long_chain_needs_few_joins(spark):
    check(spark, [(1, i, i - 1 if i else None, "user" if i % 2 else "assistant", f"t{i}", None) for i in range(700)], 1)


def test_edges(spark):
    rows = [(1, 1, None, None, None, None), (1, 2, 99, "assistant", "", 2.0), (None, 1, None, "user", "x" * 200_000, 0.0),
            (None, 2, 1, "assistant", "y", 0.0), (5, 1, 2, "user", "circle", 0.0), (5, 2, 1, "user", "circle", 0.0), (5, 3, 2, "user", "tail", 0.0)]
    check(spark, rows, 5)
    with_null = spark.createDataFrame([*rows, (1, None, None, "user", "lost", 0.0)], SCHEMA)
    assert conversations(with_null, 5).count() == 3
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations(empty).collect() == [] and branches(empty).collect() == []
